"""Every dealt operator on odd tables: NULLs everywhere, empty tables, very long texts, repeated rows, extra columns."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from corpusloom.llm.queries import QUERIES
from corpusloom.llm.tokens import codec, default_path

X = pa.schema([("seq", pa.int64()), ("batch_id", pa.int32()), ("url", pa.string()), ("url_hash", pa.string()), ("source", pa.string()), ("depth", pa.int32()), ("title", pa.string()), ("text_length", pa.int64()), ("content_hash", pa.string()), ("extractor", pa.string()), ("text_preview", pa.string()), ("text", pa.string()), ("fetched_at", pa.timestamp("us"))])
M = pa.schema([("seq", pa.int64()), ("status", pa.int32()), ("error", pa.string())])
D = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("url", pa.string()), ("fetched_at", pa.timestamp("us"))])
I = pa.schema([("item_id", pa.int64()), ("task", pa.string()), ("text", pa.string())])
W = pa.schema([("lang", pa.string()), ("word", pa.string())])
#: columns that the operators use as names of their own
CLASH = ["host", "lines", "features", "key", "keys", "line", "n", "h", "piece", "words", "body", "spam", "p", "ids", "state", "word", "field", "a", "b", "zone", "counts"]
PROSE = "The keeper walked to the harbour and looked at the old boats, which were tied up for the winter. "
LONG = (PROSE * 3 + "\n") * 700  # about 210,000 characters
RUN = "x" * 150_000


def _write(folder, name, schema, rows, extra=()):
    rows = [dict(zip(schema.names, r)) if not isinstance(r, dict) else r for r in rows]
    full = schema
    for c in extra:
        full = full.append(pa.field(c, pa.string()))
    pq.write_table(pa.Table.from_pylist([{**{f.name: None for f in full}, **r} for r in rows], schema=full), folder / f"{name}.parquet")


def _tables(folder, x=(), m=(), d=(), i=(), w=(("en", "the"), ("en", "and"), ("en", "to"), ("en", "at"), (None, None)), extra=()):
    _write(folder, "extracted_text", X, x, extra)
    _write(folder, "manifest", M, m, extra)
    _write(folder, "documents", D, d, extra)
    _write(folder, "eval_items", I, i, extra)
    _write(folder, "common_words", W, w)
    return str(folder)


def _page(seq, text, **k):
    return {"seq": seq, "batch_id": 1, "url": f"https://a.example/p/{seq}", "text": text, "fetched_at": dt.datetime(2025, 1, 1), **k}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    assert QUERIES[name](spark, _tables(tmp_path)).count() == 0


def _odd(tmp_path):
    x = [
        {}, _page(1, None), _page(2, ""), _page(3, " \n\t "), _page(4, PROSE, url=None, title=None, batch_id=None), _page(5, LONG), _page(5, LONG), _page(6, RUN), _page(7, "\n" * 5000), _page(8, PROSE, url="http://[bad", title=""),
        _page(9, "â€œIt was latÃ©â€\x9d", title="CafÃ©"), _page(10, "404 Not Found"), _page(11, LONG + PROSE), _page(12, PROSE * 8), _page(13, PROSE * 8 + "And so on it went."),
    ]
    d = [
        {}, {"doc_id": 1}, {"doc_id": 2, "text": ""}, {"doc_id": 3, "text": " "}, {"doc_id": 4, "text": LONG, "source": "s"}, {"doc_id": 4, "text": LONG, "source": "s"}, {"doc_id": 5, "text": RUN}, {"doc_id": 6, "text": "<|endoftext|> é漢🎉"},
        {"doc_id": 7, "text": "One two three four five six, SEVEN eight_nine ten eleven twel­ve!"}, {"doc_id": 4, "text": LONG + "!"}, {"doc_id": 8, "text": PROSE + "The harbour was al"},
    ]
    i = [{}, {"item_id": 1, "text": "one two three four five six seven eight nine ten eleven twelve thirteen"}, {"item_id": 2, "text": "too short"}, {"item_id": 3, "text": ""}]
    return _tables(tmp_path, x, [{}, {"seq": 10, "status": 404, "error": "http_404"}, {"seq": 10, "status": 404, "error": "http_404"}], d, i, extra=CLASH), d


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows(spark, tmp_path, name):
    folder, docs = _odd(tmp_path)
    rows = [tuple(r) for r in QUERIES[name](spark, folder).collect()]
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
    if name == "p8_ids":
        c = codec(default_path())
        want = sorted((r.get("doc_id") is None, r.get("doc_id") or 0, c.encode(r.get("text") or "")) for r in docs)
        assert sorted((r[0] is None, r[0] or 0, list(r[1])) for r in rows) == want
    if name == "p2_found":
        assert rows == [(10,)]
    if name == "p4_found":
        assert sorted(rows) == [(9, "text"), (9, "title")]
    if name == "p5_found":
        assert set(rows) == {(4, 8), (5, 11), (12, 13)}
    if name == "p9_found":
        assert rows == [(7, 1)]
    if name == "p10_found":
        assert (8,) in rows
    if name == "p7_stats":
        assert len(rows) == sum(r.get("text") is not None for r in [{"text": 1}] * 0) + 13
