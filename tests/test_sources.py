import gzip
import json

from corpusloom.sources import readers, writers
from corpusloom.streaming import jobs

WET = b"WARC/1.0\r\nWARC-Target-URI: https://www.a.com/x\r\nWARC-Record-ID: <1>\r\nContent-Length: 20\r\n\r\nWARC/1.0 is no start\r\n\r\n" + b"WARC/1.0\r\nWARC-Target-URI: http://b.a.com/\r\nContent-Length: bad\r\n\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n\r\n"


def test_wet(spark, tmp_path):
    (tmp_path / "a.wet").write_bytes(WET)
    with gzip.open(tmp_path / "b.wet.gz", "wb") as f:
        f.write(WET)
    df = readers.wet(spark, str(tmp_path))
    assert df.count() == 6 and readers.wet(spark, str(tmp_path), 1).count() == 2
    sites, counts = readers.discovered_sites(df)
    assert [r.scope for r in sites.collect()] == ["a.com"] and sites.first().sample_url == "https://www.a.com/x"
    assert {r.reason: r.n for r in counts.collect()} == {"candidate_sites": 4, "missing_target_url": 2}


def test_lists_and_seeds(spark, tmp_path):
    (tmp_path / "l.txt").write_text("# c\n\n a \nb\n")
    assert sorted(r.value for r in readers.list_file(spark, str(tmp_path / "l.txt")).collect()) == ["a", "b"]
    (tmp_path / "s.tsv").write_text("# c\nhttp://a.com/\ta.com\n\nhttp://b.com/\tb.com\tbee\n")
    assert {r.scope: r.output_name for r in readers.seeds_tsv(spark, str(tmp_path / "s.tsv")).collect()} == {"a.com": "a.com", "b.com": "bee"}
    assert readers.seeds_tsv(spark, str(tmp_path / "s.tsv"), 3).count() == 1
    (tmp_path / "m.txt").write_text('{"url": "http://a/"}\nhttp://b/\n{"x": 1}\n')
    assert sorted(r.url for r in readers.seed_urls(spark, str(tmp_path / "m.txt")).collect()) == ["http://a/", "http://b/"]


def test_json_modes(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"url": "a", "status": "200"}\nbroken\n')
    p = str(tmp_path / "x.jsonl")
    assert readers.jsonl(spark, p, readers.SCHEMAS["index_records"]).count() == 1
    rows = readers.jsonl_checked(spark, p, readers.SCHEMAS["index_records"]).collect()
    assert sorted(r.bad_line is not None for r in rows) == [False, True]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("é", "t", 1)], "a string, text string, n int")
    writers.jsonl(df, str(tmp_path / "j"), drop=["text"])
    line = "".join(p.read_text() for p in (tmp_path / "j").glob("part*.json"))
    assert json.loads(line) == {"a": "é", "n": 1} and "é" in line
    writers.csv_rows(df, str(tmp_path / "c"), ["n", "missing", "a"])
    assert "".join(p.read_text() for p in (tmp_path / "c").glob("part*.csv")).splitlines()[0] == "n,missing,a"
    for _ in range(2):
        writers.append_registry(df, str(tmp_path / "r"), "a")
    assert readers.registry(spark, str(tmp_path / "r"), "a").count() == 1 and spark.read.text(str(tmp_path / "r")).count() == 1
    assert writers.merged([df, df.drop("n")]).count() == 2


def test_files_are_merged_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    run = lambda: jobs.merge_files(spark, str(src), str(tmp_path / "out"), "a int", str(tmp_path / "cp"))
    (src / "1.json").write_text('{"a": 1}\n')
    run()
    run()
    (src / "2.json").write_text('{"a": 2}\n')
    run()
    assert sorted(r.a for r in spark.read.json(str(tmp_path / "out")).collect()) == [1, 2]


def test_cache(spark):
    df = spark.createDataFrame([(1, "h", "u", "e1", ""), (3, "h", "u", "", None), (2, "h", "u", "e2", ""), (4, None, "u", "e", "")], "seq long, url_hash string, url string, etag string, last_modified string")
    r = readers.latest_cache(df).collect()
    assert len(r) == 1 and r[0].etag == "" and r[0].last_modified is None
    up = jobs.upsert_latest(jobs.upsert_latest(None, df.where("seq < 3 and url_hash is not null"), "url_hash", "seq"), df.where("seq = 3"), "url_hash", "seq").collect()
    assert [x.seq for x in up] == [3]
