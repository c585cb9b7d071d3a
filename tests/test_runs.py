"""Archives, growing files, replaced states, block keys and page events."""

import gzip
import random

from pyspark.sql import functions as F

from corpusloom.functions import html as H
from corpusloom.operators import dedup as D
from corpusloom.operators import frontier as R
from corpusloom.sources import archives, readers, writers
from corpusloom.streaming import jobs as S


def test_archives_with_faults(spark, tmp_path):
    good = b"WARC/1.0\r\nWARC-Target-URI: http://a.example/\r\nWARC-Record-ID: <1>\r\nContent-Length: 12\r\n\r\nWARC/1.0 no!\r\n\r\n"
    bad = b"WARC/1.0\r\nContent-Length: many\r\n\r\nx\r\nWARC/1.0\r\nWARC-Target-URI: http://b.example/\r\nContent-Length: 99\r\n\r\ncut"
    (tmp_path / "a.wet.gz").write_bytes(gzip.compress(good))
    (tmp_path / "b.wet").write_bytes(bad)
    (tmp_path / "empty.wet").write_bytes(b"")
    got = sorted((r.path.rsplit("/", 1)[1], r.n, r.target_url, r.length) for r in archives.records(spark, str(tmp_path)).collect())
    assert got == [("a.wet.gz", 0, "http://a.example/", 12), ("b.wet", 0, None, None), ("b.wet", 1, "http://b.example/", 99)]
    assert archives.records(spark, str(tmp_path), 1).count() == 2


def test_growing_files(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    put = lambda name, text: (tmp_path / "in" / name).write_bytes(text.encode())
    lines = lambda: sorted(r.value for r in spark.read.text(target).collect())
    put("a", "é1\n2\nhalf")
    S.merge_lines(spark, source, target, state, "1")
    assert lines() == ["2", "é1"]  # a line that is still written waits
    S.merge_lines(spark, source, target, state, "1")
    assert lines() == ["2", "é1"]  # a repeated run writes over itself
    put("a", "é1\n2\nhalf done\n")
    put("b", "")
    S.merge_lines(spark, source, target, state, "2")
    assert lines() == ["2", "half done", "é1"]
    put("a", "new\n")
    S.merge_lines(spark, source, target, state, "3")
    assert lines() == ["2", "half done", "new", "é1"]


def test_states_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "state")
    for n in (3, 5, 1):
        writers.replace(spark.range(n), path)
        assert readers.current(spark, path).count() == n


def test_block_keys_find_all_near_pairs_that_share_a_band(spark):
    rnd = random.Random(2)
    hashes = [rnd.getrandbits(64) for _ in range(40)]
    for h in list(hashes):
        x = h
        for _ in range(rnd.randint(1, 6)):
            x ^= 1 << rnd.randrange(64)
        hashes.append(x)
    hashes += [0, (1 << 64) - 1, 1 << 63]
    hashes = list(dict.fromkeys(hashes))
    df = spark.createDataFrame([(i, f"{h:016x}") for i, h in enumerate(hashes)], "id long, simhash string")
    got = {(r.a, r.b, r.distance) for r in D.near_pairs(df, "id").collect()}
    want = set()
    for a, x in enumerate(hashes):
        for b in range(a + 1, len(hashes)):
            d = x ^ hashes[b]
            if d.bit_count() <= 4 and any(not d >> 16 * i & 0xFFFF for i in range(4)):
                want.add((a, b, d.bit_count()))
    assert got == want and want


def test_first_rows_of_large_groups(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("g"))
    got = R.per_group_cap(df, ["g"], ["id"], 1200)  # beyond what is cut before the shuffle
    assert {r.g: (r.n, r.m) for r in got.groupBy("g").agg(F.count("*").alias("n"), F.max("id").alias("m")).collect()} == {"a": (1200, 1799), "b": (1200, 3597)}


def test_pages_as_events():
    words = " ".join(f"word{i}" for i in range(30))
    page = f"<title>T</title><nav><a href='/n'>menu</a></nav><main><p>{words}</p><script>no()</script></main></nav><footer>foot</footer><link rel='alternate' type='application/atom+xml' href='/f'><link href='/Sitemap.xml'><a>x</a>"
    events = H.read_html(page)
    assert H.main_content(events) == (words, "main_content")
    assert H.main_content(H.read_html("<main>few words</main><p>rest</p>")) == ("few words\nrest", "fallback")
    assert H.page_links(events) == {"link": ["/n"], "canonical": [], "feed": ["/f"], "sitemap": ["/Sitemap.xml"]}
    assert H.read_html(None) == [] and H.main_content([]) == ("", "fallback")
