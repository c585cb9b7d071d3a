"""One pass over the texts of extracted_text that the page operators share.

Each page is read once: wrongly decoded text is restored, its blocks are
labelled, and what the operators need comes out as a few compact columns, so
that later stages never carry the text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable, read_table, spread
from . import blocks as B
from . import dead, mojibake, spam

#: documented bound of the sample of weakly labelled rows that the trees are fitted on: of spam, of prose, and of other text that is no spam
SAMPLE = 3000
#: how far a host's rate of spam moves the log odds of its pages, and pages of the usual rate that every host is given
HOST_WEIGHT, HOST_PRIOR = 0.3, 8.0
#: probability from which a page is spam
SPAM_AT = 0.6
#: tasks that the pages of one host are spread over where its rate is joined
HOST_SALTS = 16

SCHEMA = "seq long, host string, dead boolean, share float, label int, shop boolean, features array<float>, lines array<int>, counts array<int>"
_ARROW = pa.schema([("seq", pa.int64()), ("host", pa.string()), ("dead", pa.bool_()), ("share", pa.float32()), ("label", pa.int32()), ("shop", pa.bool_()), ("features", pa.list_(pa.float32())), ("lines", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])


def host_of(url: str | None) -> str:
    """Host name in small letters without port; empty if there is none."""
    try:
        return (urlsplit(url.strip()).hostname or "") if url else ""
    except ValueError:
        return ""


def words_of(spark: SparkSession, sf_dir: str) -> list[str]:
    """The common words of all languages; a dictionary of fixed size."""
    return sorted({r[0] for r in read_table(spark, sf_dir, "common_words").select(F.lower("word")).distinct().limit(20_000).collect() if r[0]})


def is_blank(text: str | None) -> bool:
    return text is None or not text.strip(" \t\r\n 　​﻿")


_analyzers: dict[int, B.Analyzer] = {}


def analyzer(words: list[str]) -> B.Analyzer:
    """One analyzer per worker process, kept over its tasks."""
    key = hash(tuple(words))
    if key not in _analyzers:
        _analyzers.clear()
        _analyzers[key] = B.Analyzer(words)
    return _analyzers[key]


def read_page(a: B.Analyzer, text: str, title: str | None) -> tuple[B.Page, str]:
    """The labelled blocks of a page after repair, and its folded title."""
    text, title = mojibake.repair(text)[0], mojibake.repair(title or "")[0]
    page = a.page(text, title)
    return page, B.folded(title) if title else ""


def profile(df: DataFrame, words: list[str], want: frozenset[str] = frozenset({"dead", "spam", "lines"})) -> DataFrame:
    """(seq, url, title, text) to one compact row per page with a non-blank text.

    Blank and NULL texts give no row; NULL titles and urls count as empty.
    ``want`` leaves out columns (as NULL) that a query doesn't need; ``counts``
    are those of quality.page_counts for texts of one chunk.
    """
    from . import quality

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = analyzer(words)
        for batch in batches:
            out: list[list] = [[] for _ in _ARROW]
            seqs, urls, titles, texts = (batch.column(i) for i in range(4))
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                if is_blank(text):
                    continue
                url, title = urls[k].as_py(), titles[k].as_py()
                page, t = read_page(a, text, title)
                gone, share = dead.is_dead(page, t)
                label = shop = feats = lines = counts = None
                if not gone:
                    if "spam" in want:
                        feats = spam.features(page, a.common)
                        shop = spam.commercial(url, title)
                        label = spam.weak_label(feats, shop)
                    if "lines" in want:
                        lines = [i + 1 for i, v in enumerate(page.label) if v == B.FURNITURE]
                    if "counts" in want and len(text) <= quality.CHUNK:
                        counts = quality.page_counts(page)
                for col, v in zip(out, (seqs[k].as_py(), host_of(url), gone, share, label, shop, feats, lines, counts)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _ARROW)], schema=_ARROW)

    return spread(df.select("seq", "url", "title", "text")).mapInArrow(run, SCHEMA)


def fit_spam(prof: DataFrame) -> spam.BaggedTrees:
    """Bagged trees fitted on at most SAMPLE weakly labelled pages of each kind, taken by a hash of their ids.

    The kinds are counted first; a threshold on the hash leaves a few more rows
    than are wanted, and only those are ranked.
    """
    import numpy as np

    prose = F.col("features")[spam.NAMES.index("prose")] > 0.7
    kind = F.when(F.col("label") == 1, 2).when(F.col("label") == 0, prose.cast("int"))
    labelled = prof.select("label", "features", "seq", kind.alias("kind"), F.pmod(F.xxhash64("seq"), F.lit(1 << 30)).alias("h")).where("kind is not null")
    counts = {r[0]: r[1] for r in labelled.groupBy("kind").count().collect()}  # three rows
    near = F.lit(False)
    for k, n in counts.items():
        near = near | (F.col("kind") == k) & (F.col("h") <= int((1 << 30) * min(1.0, 1.2 * (SAMPLE + 100) / n)))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("h", "seq"))
    rows = labelled.where(near).withColumn("rank", rank).where(F.col("rank") <= SAMPLE).select("label", "features", "seq").collect()
    rows.sort(key=lambda r: (r.seq is None, r.seq))
    x = np.array([r.features for r in rows], dtype=float).reshape(len(rows), len(spam.NAMES))
    y = np.array([r.label for r in rows], dtype=float)
    return spam.BaggedTrees().fit(x, y)


def with_spam(prof: DataFrame, model: spam.BaggedTrees | None = None, earlier: DataFrame | None = None, host_weight: float = HOST_WEIGHT) -> DataFrame:
    """Adds ``own`` (what the trees say), ``p`` (smoothed by the host) and ``spam`` to a profile; dead pages are no spam.

    The log odds of a page move by ``host_weight`` times how far the rate of its
    host lies from the usual one; hosts with few pages are near the usual one.
    Only (host, sum, count) is aggregated, map side first, and the pages of a
    host are spread over HOST_SALTS tasks where the rate is joined.  ``earlier``
    has (host, own) of pages judged before, which count for the rates.
    """
    import numpy as np

    model = model or fit_spam(prof)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column(batch.schema.get_field_index("features"))
            known = np.array([v.is_valid for v in f], dtype=bool)
            p = np.zeros(batch.num_rows)
            if known.any():
                p[known] = model.predict(np.array([v.as_py() for v, k in zip(f, known) if k], dtype=float))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p, pa.float64())], names=[*batch.schema.names[:-1], "own"])

    kept = [c for c in prof.columns if c != "features"]
    schema = ", ".join(f"{c} {prof.schema[c].dataType.simpleString()}" for c in kept) + ", own double"
    scored = prof.select(*kept, "features").mapInArrow(predict, schema)
    each = scored.where("not dead").select("host", "own")
    sums = durable((each if earlier is None else each.unionByName(earlier.select("host", "own"))).groupBy("host").agg(F.sum("own").alias("_s"), F.count("*").alias("_n")))
    usual = sums.agg(F.coalesce(F.sum("_s") / F.sum("_n"), F.lit(0.0)).alias("usual"))
    odds = lambda x: F.log(F.greatest(F.least(x, F.lit(0.999)), F.lit(0.001)) / (1 - F.greatest(F.least(x, F.lit(0.999)), F.lit(0.001))))
    rates = sums.crossJoin(F.broadcast(usual)).select("host", ((F.col("_s") + HOST_PRIOR * F.col("usual")) / (F.col("_n") + HOST_PRIOR)).alias("rate"), "usual")  # one row of the usual rate
    rates = rates.select("host", (odds(F.col("rate")) - odds(F.col("usual"))).alias("moved"), F.explode(F.sequence(F.lit(0), F.lit(HOST_SALTS - 1))).alias("_salt"))
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(HOST_SALTS)).cast("int"))
    joined = salted.join(rates, ["host", "_salt"], "left").drop("_salt")
    p = 1 / (1 + F.exp(-(odds(F.col("own")) + host_weight * F.coalesce("moved", F.lit(0.0)))))
    return joined.withColumn("p", F.when(F.col("dead"), 0.0).otherwise(p)).drop("moved").withColumn("spam", ~F.col("dead") & (F.col("p") >= SPAM_AT))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "extracted_text").select("seq", "url", "title", "text")


def judged(spark: SparkSession, sf_dir: str, want: frozenset[str]) -> DataFrame:
    """The profile of all pages, written once, with spam decided."""
    return with_spam(durable(profile(pages(spark, sf_dir), words_of(spark, sf_dir), want | {"dead", "spam"})))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq of the pages whose main content is keywords, links or product tags.

    Blank and NULL texts and dead pages are no cases; pages that say the same
    are judged alike, each row by itself; an empty table gives no rows.
    """
    return judged(spark, sf_dir, frozenset()).where("spam").select("seq").distinct()


def p1_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, host and the smoothed probability of spam of every page with a non-blank text."""
    return judged(spark, sf_dir, frozenset()).select("seq", "host", F.round("p", 4).alias("p"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq of the pages that offer an error, a notice, filler or an unfilled template in place of content.

    Decided by the text: status and error of the manifest don't save a page and
    don't condemn one.  Blank and NULL texts are no cases.
    """
    prof = profile(pages(spark, sf_dir), words_of(spark, sf_dir), frozenset({"dead"}))
    return prof.where("dead").select("seq").distinct()


def p2_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How texts and manifest agree: rows by status, presence of an error and verdict on the text.

    Rows delivered twice in the manifest count once; pages without a manifest row have a NULL status.
    """
    prof = profile(pages(spark, sf_dir), words_of(spark, sf_dir), frozenset({"dead"})).select("seq", "dead")
    man = read_table(spark, sf_dir, "manifest").select("seq", "status", F.coalesce(F.col("error") != "", F.lit(False)).alias("has_error")).groupBy("seq").agg(F.min("status").alias("status"), F.max("has_error").alias("has_error"))
    return prof.join(man, "seq", "left").groupBy("status", "has_error", "dead").agg(F.count("*").alias("n"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, line_no) of each non-blank line outside the main body; lines count from 1.

    Pages of p1_found and p2_found have no body and give no rows.
    """
    j = judged(spark, sf_dir, frozenset({"lines"}))
    return j.where(~F.col("spam") & ~F.col("dead")).select("seq", F.explode("lines").alias("line_no")).distinct()


def p3_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq and body: the text with only the lines of the main body left, wrong decoding restored; NULL for blank, dead and spam pages' texts."""
    words = words_of(spark, sf_dir)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = analyzer(words)
        for batch in batches:
            body = []
            for text, title in zip(batch.column(1), batch.column(2)):
                x = text.as_py()
                if is_blank(x):
                    body.append(None)
                    continue
                page, t = read_page(a, x, title.as_py())
                body.append(None if dead.is_dead(page, t)[0] else "\n".join(page.lines[i].strip() for i in page.body()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(body, pa.string())], names=["seq", "body"])

    bodies = spread(read_table(spark, sf_dir, "extracted_text").select("seq", "text", "title")).mapInArrow(run, "seq long, body string")
    spam_rows = judged(spark, sf_dir, frozenset()).where("spam").select("seq")
    return bodies.join(spam_rows.withColumn("is_spam", F.lit(True)), "seq", "left").select("seq", F.when(F.col("is_spam").isNull(), F.col("body")).alias("body"))
