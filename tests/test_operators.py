import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import dedup as D
from corpusloom.operators import fetch as E
from corpusloom.operators import frontier as R
from corpusloom.operators import reports as A


def greedy(rows):
    kept, urls, digests = [], set(), set()
    for dom, seq, u, d in sorted(rows, key=lambda r: r[1]):
        if (dom, u) in urls or (d and (dom, d) in digests):
            continue
        urls.add((dom, u))
        if d:
            digests.add((dom, d))
        kept.append(seq)
    return kept


@pytest.mark.parametrize("seed", range(3))
def test_two_key_greedy(spark, seed):
    rnd = random.Random(seed)
    rows = [("d" + str(rnd.randrange(2)), i, f"u{rnd.randrange(12)}", rnd.choice([None, "", *(f"g{k}" for k in range(10))])) for i in range(80)]
    rows += [("x", 100, "u1", "d1"), ("x", 101, "u2", "d1"), ("x", 102, "u2", "d2")]
    df = spark.createDataFrame(rows, "domain string, seq long, url string, digest string")
    assert sorted(r.seq for r in D.two_key_greedy(df).collect()) == greedy(rows)
    assert D.two_key_greedy(df.limit(0)).count() == 0


def sequential(rows, threshold):
    exact, kept, out = set(), [], {}
    for k, e, h in sorted(rows):
        n = int(h, 16)
        if e in exact:
            out[k] = "exact_content_duplicate"
        elif any(any((n >> 16 * b) & 0xFFFF == (m >> 16 * b) & 0xFFFF for b in range(4)) and (n ^ m).bit_count() <= threshold for m in kept):
            out[k] = "near_semantic_duplicate"
        else:
            out[k] = "unique"
            exact.add(e)
            kept.append(n)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_near_resolve(spark, seed):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(6)]
    rows = []
    for k in range(60):
        h = rnd.choice(base)
        for _ in range(rnd.randrange(5)):
            h ^= 1 << rnd.randrange(64)
        rows.append((k, f"e{h}", f"{h:016x}"))
    rows += [(100, "none", "f" * 16), (101, "none", "f" * 16)]
    df = spark.createDataFrame(rows, "id long, exact string, simhash string")
    assert {r.id: r.status for r in D.near_resolve(df, "id").collect()} == sequential(rows, 4)


def test_simhash_md5_against_plain(spark):
    import hashlib

    texts = ["the quick brown fox jumps over the lazy dog", "", None, "one two", "naïve café größe straße über"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.simhash for r in D.simhash_md5(df, "id", "text").collect()}
    words = texts[0].split()
    votes = [0] * 64
    for i in range(len(words) - 2):
        h = int(hashlib.md5(" ".join(words[i : i + 3]).encode()).hexdigest()[:16], 16)
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    assert got[0] == f"{sum(1 << b for b in range(64) if votes[b] >= 0):016x}" and got[1] == got[2] == "f" * 16


def test_first_and_flags(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (2, "a")], "seq long, k string")
    assert sorted(r.seq for r in D.first_by(df, ["k"], ["seq"]).collect()) == [1, 3]
    assert sorted((r.seq, r.d) for r in D.duplicate_flag(df, "k", "seq", "d").collect()) == [(1, False), (2, True), (2, True), (3, False), (4, False)]
    reg = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(r.seq for r in D.not_in_registry(df, reg, "k").collect()) == [3, 4]


def test_reasons_and_cap(spark):
    rows = [(1, "http://a.com/x"), (2, "http://b.com/x"), (3, "http://b.com/x"), (4, "http://a.com/x#f"), (5, "bad"), (6, "http://a.com/y"), (7, None)]
    df = spark.createDataFrame(rows, "seq long, url string")
    ok = F.col("url").contains("a.com")
    got = {r.seq: r.reason for r in R.enqueue_reasons(df, "seq", ok).collect()}
    assert got == {1: "queued", 2: "out_of_scope", 3: "out_of_scope", 4: "duplicate_url", 5: "normalize_failed", 6: "queued", 7: "normalize_failed"}
    got = {r.seq: r.reason for r in R.enqueue_reasons(df, "seq", ok, 1).collect()}
    assert got[1] == "queued" and {got[k] for k in range(2, 8)} == {"max_discovered_reached"}
    c = R.candidate_reasons(df.withColumn("source", F.lit("feed")), "seq", F.col("normalized").contains("a.com"), [], F.lit("2025-01-01").cast("timestamp"))
    assert {r.seq: r.reason for r in c.collect()} == {1: "accepted", 2: "offsite", 3: "duplicate_url", 4: "duplicate_url", 5: "normalize_failed", 6: "accepted", 7: "normalize_failed"}


def test_scores(spark):
    at = F.lit("2025-02-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame([("feed", "http://e.com/docs/x?q=1", "2025-01-25"), ("other", "http://e.com/", None), ("sitemap", "http://e.com/", "bad date"), ("x", "http://e.com/", "2030-01-01")], "source string, url string, lastmod string")
    got = [round(r[0], 6) for r in df.select(R.score(F.col("source"), F.col("url"), F.col("lastmod"), at)).collect()]
    assert got == [100 + 10 + 29 + 15 - 10, 10, 90, 50]


def test_graph(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("d", "c"), ("x", "y"), ("c", "e"), ("a", None)], "from_url string, to_url string")
    seeds = spark.createDataFrame([("a",)], "url string")
    full = {"a": 0, "b": 1, "d": 1, "c": 2, "e": 3}
    for depth in range(4):
        assert {r.url: r.depth for r in R.bfs(edges, seeds, depth).collect()} == {k: v for k, v in full.items() if v <= depth}
    maps = spark.createDataFrame([("s1", "child", "s2"), ("s2", "child", "s1"), ("s2", "page", "p")], "sitemap string, kind string, url string")
    assert R.expand_sitemaps(maps, spark.createDataFrame([("s1",)], "url string")).count() == 3


@pytest.mark.parametrize("n", [1, 2, 4, 5, 11])
def test_percentiles(spark, n):
    values = list(range(10, 10 + n)) * 2
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    s = sorted(values)
    q = {"a": 0.25, "b": 0.5, "c": 0.9}
    got = A.nearest_rank(df, "v", q).first()
    assert [got[k] for k in q] == [s[min(len(s) - 1, max(0, int(round((len(s) - 1) * x))))] for x in q.values()]
    got = A.nearest_rank(df, "v", q, "floor").first()
    assert [got[k] for k in q] == [s[min(len(s) - 1, int(len(s) * x))] for x in q.values()]


def test_empty_reports(spark):
    df = spark.createDataFrame([], "v long")
    assert A.nearest_rank(df, "v", {"p": 0.5}).first().p == 0
    assert A.length_stats(df, "v").first().avg_len == 0.0
    one = spark.createDataFrame([(1, 0)], "a long, b long")
    assert one.select(A.ratio(F.col("a"), F.col("b"))).first()[0] == 0.0


def test_samples(spark):
    df = spark.createDataFrame([(i,) for i in range(23)], "i long")
    assert sorted(r.i for r in R.spread_sample(df, "i", 5).collect()) == [int(k * 23 / 5) for k in range(5)]
    assert R.spread_sample(df, "i", 0).count() == R.spread_sample(df, "i", 50).count() == 23
    assert sorted((r.i, r.shard) for r in R.round_robin(df, "i", 4).collect()) == [(i, i % 4) for i in range(23)]


def test_fetch_rules(spark):
    df = spark.createDataFrame([(None, "TimeoutError('x')"), (404, None), (429, ""), (500, "HTTP Error 500: x"), (304, None), (200, "403"), (None, "too_large")], "status int, error string")
    got = df.select(E.is_retryable(F.col("status"), F.col("error")).alias("r"), E.error_reason(F.col("status"), F.col("error")).alias("e")).collect()
    assert [r.r for r in got] == [True, False, True, True, False, False, False]
    assert [r.e for r in got] == ["TimeoutError", None, None, "http_500", None, "http_403", "too_large"]
