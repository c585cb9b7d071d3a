"""Operators over Spark against brute force on small tables."""

import random

import duckdb
import pytest

from corpusloom.llm import history, leak, quality, repeats, tokens
from corpusloom.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("extracted_text", "documents", "eval_items"):
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    df = QUERIES[name](spark, small)
    want = con.execute(ORACLE[name]).df()
    cols = sorted(df.columns)
    assert sorted(want.columns) == cols
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(map(tuple, want[cols].itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_and_is_unique(spark, small, name):
    rows = [tuple(r) for r in QUERIES[name](spark, small).collect()]
    if name.endswith("_found"):
        assert rows
        assert len(rows) == len(set(rows))


def test_long_texts_are_cut_and_counted_alike(spark):
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice(["the boat ", "x.\n", "日本 ", "\n", "1. a"]) for _ in range(rnd.randint(0, 300)))) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, text string")
    words = ["the"]
    whole = {r.id: list(r.counts) for r in quality.text_counts(df, words).collect()}
    cut = {r.id: list(r.counts) for r in quality.text_counts(df, words, chunk=17, fan_in=8).collect()}
    assert whole == cut
    docs = df.withColumnRenamed("id", "doc_id")
    a = {r.doc_id: list(r.ids) for r in tokens.encode_texts(docs).collect()}
    b = {r.doc_id: list(r.ids) for r in tokens.encode_texts(docs, piece=23, fan_in=8).collect()}
    assert a == b


def row(body):
    return [x.tolist() if hasattr(x, "tolist") else x for x in history.index_row(body)]


def _bodies(n=160, seed=5):
    """Random bodies with copies, near copies and chains of near copies."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        if i > 10 and rnd.random() < 0.5:
            w = list(rnd.choice(out))
            for _ in range(rnd.choice([0, 0, 1, 3, 6, 9])):
                k = rnd.randrange(len(w))
                if rnd.random() < 0.5:
                    del w[k : k + 1]
                else:
                    w.insert(k, f"n{rnd.randrange(10**6)}")
        else:
            w = [f"t{rnd.randrange(400)}" for _ in range(rnd.choice([20, 70, 120]))]
        out.append(w)
    return out


def test_history_against_brute_force(spark):
    bodies = _bodies()
    rows = []
    for seq, w in enumerate(bodies, 1):
        h, h2, n, ids, keys, coarse, piv = row(" ".join(w))
        rows.append((seq, 0 if seq < 60 else 1, h, h2, n, ids, keys, coarse, piv))
    df = spark.createDataFrame(rows, history._COLS)
    got = {r.seq_b: r.seq_a for r in history.repeats(df).collect()}

    def near(x, y):
        return x == y or (min(len(x), len(y)) >= 60 and history.lcs(list(map(hash, x)), list(map(hash, y))) >= 0.75 * max(len(x), len(y)))

    want = {}
    for b in range(60, len(bodies) + 1):
        a = next((a for a in range(1, b) if near(bodies[a - 1], bodies[b - 1])), None)
        if a:
            want[b] = a
    # keys are a sample of the runs of words
    missing = {b: a for b, a in want.items() if got.get(b) != a}
    assert not set(got) - set(want)
    assert len(missing) <= 0.02 * len(want), missing


def test_hot_keys_are_searched_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(history, "FIRST", 2)
    monkeypatch.setattr(history, "GROWTH", 2)
    monkeypatch.setattr(history, "CHUNK", 7)
    monkeypatch.setattr(history, "SALT", 3)
    monkeypatch.setattr(history, "COMMON", 1)
    monkeypatch.setattr(history, "LEAST_KEYS", history.KEYS)
    base = [f"s{i}" for i in range(80)]
    rows = []
    for seq in range(1, 40):
        # one run that all share, and bodies that are else different; the last repeats the thirtieth
        own = [f"x{seq}_{i}" for i in range(60)] if seq < 39 else [f"x30_{i}" for i in range(60)]
        h, h2, n, ids, keys, coarse, piv = row(" ".join(base[:20] + own + ([] if seq < 39 else ["end"])))
        rows.append((seq, 1, h, h2, n, ids, keys, coarse, piv))
    got = {r.seq_b: r.seq_a for r in history.repeats(spark.createDataFrame(rows, history._COLS)).collect()}
    assert got == {39: 30}


def test_line_counts_merge(spark):
    rows = [(i, i % 3, f"http://H{i % 2}.example/x", f"Same line {i}\nown {chr(97 + i)}\nSAME  LINE") for i in range(9)]
    df = spark.createDataFrame(rows, "seq long, batch_id int, url string, text string")
    parts = [repeats.count_lines(df.where(f"batch_id = {b}")) for b in range(3)]
    merged = repeats.merge_counts(repeats.merge_counts(parts[0], parts[1]), parts[2])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, repeats.count_lines(df).collect()))
    found = repeats.occurrences(df, repeats.excessive(merged)).collect()
    assert {(r.seq, r.line_no) for r in found} == {(i, k) for i in range(9) for k in (1, 3)}
    left = {r.seq: r.text for r in repeats.strip_lines(df, repeats.occurrences(df, repeats.excessive(merged))).collect()}
    assert left[0] == "own a"


def test_leaks_against_scanning(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = spark.read.parquet(f"{small}/eval_items.parquet")
    got = {(r.doc_id, r.item_id) for r in leak.leaked_spans(docs, items).collect()}
    grams = {}
    for r in items.collect():
        w = leak.words_of(r.text)
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = leak.words_of(r.text)
        for k in range(len(w) - 11):
            want |= {(r.doc_id, i) for i in grams.get(tuple(w[k : k + 12]), ())}
    assert got == want


def test_items_beyond_the_bound_take_more_passes(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = spark.read.parquet(f"{small}/eval_items.parquet")
    once = sorted(map(tuple, leak.leaked_spans(docs, items).collect()))
    assert once and once == sorted(map(tuple, leak.leaked_spans(docs, items, most_bytes=20_000).collect()))


def test_a_text_of_twenty_megabytes(spark):
    """Cutting, counting and encoding grow with the text and not with its square."""
    import time

    text = "The old boat was in the harbour, and 22 keepers of the light's dog sang. " * 270_000
    df = spark.createDataFrame([(1, text)], "id long, text string")
    began = time.time()
    counts = quality.text_counts(df, ["the", "was", "in"]).first().counts
    ids = tokens.encode_texts(df.withColumnRenamed("id", "doc_id")).first().ids
    assert counts[0] == len(text) and len(ids) > 4_000_000
    assert time.time() - began < 120
