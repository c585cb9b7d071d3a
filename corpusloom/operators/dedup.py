"""Exact and near duplicates; every "first" is the first by an explicit order."""

from __future__ import annotations

import hashlib
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrow import arrow_udf
from ..session import durable


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key.  NULL keys are a key of their own.

    ``min_by`` over whole rows lets partial results combine before the shuffle,
    so a hot key sends one row per task, where a window would sort it whole.
    """
    rest = F.struct(*[c for c in df.columns])
    rows = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(rest, F.struct(*order)).alias("_row"))
    return rows.select("_row.*")


def duplicate_flag(df: DataFrame, key: str, order: str, name: str = "content_duplicate") -> DataFrame:
    """Marks all rows but the first of each key; NULL keys are no duplicates.

    The first by key comes from a partial aggregate and is joined back, so a key
    that holds a third of the rows is split by the skew handling of the join.
    """
    first = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first"))
    return df.join(first, F.col(key) == F.col("_key"), "left").withColumn(name, F.coalesce(F.col(order) > F.col("_first"), F.lit(False))).drop("_key", "_first")


def not_in_registry(df: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Rows whose key no registry holds; rows keep their multiplicity, NULL keys stay."""
    return df.join(registry.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def two_key_greedy(df: DataFrame, group: str = "domain", first: str = "url", second: str = "digest", order: str = "seq") -> DataFrame:
    """Keeps a row if neither of its keys was kept before in its group; skipped rows register no key.

    Blank and NULL second keys never collide.  Solved without a task per group:
    in each round the rows that are the earliest undecided of both their keys
    are kept, and rows that share a key with a kept one fall; rounds continue
    while any row is undecided.  This equals the sequential greedy order.
    """
    kept: DataFrame | None = None
    cols = df.columns
    todo = durable(df.withColumn("_d", F.nullif(F.col(second), F.lit(""))))
    while not todo.isEmpty():
        by_first = todo.groupBy(group, first).agg(F.min(order).alias("_m1"))
        by_second = todo.where("_d is not null").groupBy(group, "_d").agg(F.min(order).alias("_m2"))
        at = todo.join(by_first, [group, first]).join(by_second, [group, "_d"], "left")
        now = durable(at.where((F.col(order) == F.col("_m1")) & (F.col("_d").isNull() | (F.col(order) == F.col("_m2")))).drop("_m1", "_m2"))
        kept = now if kept is None else kept.unionByName(now)
        rest = todo.join(now.select(group, first).distinct(), [group, first], "left_anti")
        todo = durable(rest.join(now.where("_d is not null").select(group, "_d").distinct(), [group, "_d"], "left_anti").select(*todo.columns))
    return (df if kept is None else kept).select(*cols)


def blake_simhash(words: list[str], normalized: bool = True) -> int:
    """64-bit SimHash of the 3-word shingles with blake2b; ties give ones, no words give all ones."""
    feats = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 5 else words
    votes = [0] * 64
    for f, n in Counter(feats).items():
        h = int.from_bytes(hashlib.blake2b(f.encode(), digest_size=8).digest(), "big")
        for b in range(64):
            votes[b] += n if h >> b & 1 else -n
    return sum(1 << b for b in range(64) if votes[b] >= 0)


@arrow_udf("string")
def simhash_blake(words: pd.Series) -> pd.Series:
    """16 hex digits of blake_simhash of arrays of words; NULL stays NULL."""
    return words.map(lambda w: None if w is None else f"{blake_simhash(list(w)):016x}")


@arrow_udf("string")
def simhash_of_words(words: pd.Series) -> pd.Series:
    """16 hex digits of a 64-bit SimHash of arrays of words, with the first half of md5 as feature hash; NULL stays NULL."""
    import numpy as np

    out = []
    for w in words:
        if w is None:
            out.append(None)
            continue
        w = list(w)
        feats = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 5 else w
        digests = b"".join(hashlib.md5(f.encode()).digest()[:8] for f in feats)
        votes = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * votes >= len(feats)).tobytes().hex())
    return pd.Series(out, dtype=object)


def simhash_md5(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, simhash): 64-bit SimHash of the 3-word shingles of each text; texts without words get all ones.

    The votes of a text are counted where it stands; nothing is shuffled.
    """
    words = T.tokens(T.normalized_for_hash(F.coalesce(F.col(text), F.lit(""))))
    return df.select(key, simhash_of_words(words).alias("simhash"))


def bands(simhash: Column) -> Column:
    """The four 16-bit bands of 16 hex digits, each with its number."""
    return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.concat(i.cast("string"), F.lit(":"), simhash.substr(F.lit(13) - 4 * i, F.lit(4))))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two strings of 16 hex digits."""
    n = lambda x: F.conv(x, 16, -10).cast("long")
    return F.bit_count(n(a).bitwiseXOR(n(b)))


def block_keys(n: Column, threshold: int) -> Column:
    """Keys of 64-bit numbers, one of which any two share that share a 16-bit band and differ in at most ``threshold`` bits.

    The 48 bits outside a shared band are cut in threshold + 1 blocks; at most
    ``threshold`` of them can differ, so one is equal.  Band and block together
    make keys far rarer than bands alone.
    """
    keys = []
    for band in range(4):
        at = 16 * band
        own = F.shiftrightunsigned(n, at).bitwiseAND(0xFFFF)
        low = n.bitwiseAND((1 << at) - 1)
        rest = low.bitwiseOR(F.shiftleft(F.shiftrightunsigned(n, at + 16), at)) if band < 3 else low
        for block in range(threshold + 1):
            start, end = 48 * block // (threshold + 1), 48 * (block + 1) // (threshold + 1)
            part = F.shiftrightunsigned(rest, start).bitwiseAND((1 << (end - start)) - 1)
            keys.append(F.shiftleft(F.shiftleft(own, end - start).bitwiseOR(part), 8) + F.lit(16 * band + block))
    return F.array(*keys)


def near_pairs(hashes: DataFrame, key: str, threshold: int = 4) -> DataFrame:
    """(a, b, distance) of different hashes that share a band within the threshold, one row per pair.

    ``hashes`` has one row per different hash, so identical texts never make
    pairs with each other; the join is on ``block_keys``, with band and distance
    as residual conditions.
    """
    each = hashes.select(key, F.conv("simhash", 16, -10).cast("long").alias("n")).select(key, "n", F.explode(block_keys(F.col("n"), threshold)).alias("block"))
    l = each.select(F.col(key).alias("a"), F.col("n").alias("na"), "block")
    r = each.select(F.col(key).alias("b"), F.col("n").alias("nb"), "block")
    differ = F.col("na").bitwiseXOR(F.col("nb"))
    band = F.lit(False)
    for i in range(4):
        band = band | (F.shiftrightunsigned(differ, 16 * i).bitwiseAND(0xFFFF) == 0)
    pairs = l.join(r, "block").where("a < b").withColumn("distance", F.bit_count(differ)).where((F.col("distance") <= threshold) & band)
    return pairs.select("a", "b", "distance").distinct()


def near_resolve(df: DataFrame, key: str, threshold: int = 4) -> DataFrame:
    """(key, status) with status unique, exact_content_duplicate or near_semantic_duplicate, in order of the key.

    ``df`` has key, exact (hash of the normalised text) and simhash.  A row is
    compared with kept rows only.  Equal hashes collapse first; then the
    lexicographically first independent set of the pair graph is found in
    rounds: a row without undecided or kept earlier neighbours is kept, a row
    with a kept earlier neighbour falls.
    """
    first = df.groupBy("simhash").agg(F.min(key).alias("rep"))
    reps = durable(first.select(F.col("rep").alias(key), "simhash"))
    pairs = durable(near_pairs(reps, key, threshold).select("a", "b"))
    state = durable(reps.select(key, F.lit(None).cast("boolean").alias("kept")))
    while True:
        s = state.withColumnRenamed(key, "a")
        seen = pairs.join(s, "a").groupBy(F.col("b").alias(key)).agg(F.max(F.coalesce("kept", F.lit(False))).alias("hit"), F.max(F.col("kept").isNull()).alias("open"))
        new = state.join(seen, key, "left").select(key, F.coalesce("kept", F.when(F.col("hit"), False).when(~F.coalesce("open", F.lit(False)), True)).alias("kept"))
        state = durable(new)
        if state.where("kept is null").isEmpty():
            break
    kept = state.where("kept").select(F.col(key).alias("rep"))
    firsts = df.join(first, "simhash").join(kept.withColumn("k", F.lit(True)), "rep", "left")
    own = firsts.where((F.col(key) == F.col("rep")) & F.col("k")).select("exact").distinct().withColumn("e", F.lit(True))
    status = F.when((F.col(key) == F.col("rep")) & F.col("k"), "unique").when(F.col("e"), "exact_content_duplicate").otherwise("near_semantic_duplicate")
    return firsts.join(own, "exact", "left").select(key, status.alias("status"))
