import pytest

from corpusloom.llm import blocks as B
from corpusloom.llm import dead, pages, spam
from corpusloom.llm.spam import BaggedTrees

COMMON = "the a of and to in was is it on at for with that which had by from be".split()


@pytest.fixture(scope="module")
def a():
    return B.Analyzer(COMMON)


def furniture(a, text, title=None):
    p = a.page(text, title)
    return [i + 1 for i, v in enumerate(p.label) if v == B.FURNITURE]


PROSE = "The keeper of the harbour was at the gate and looked for a boat that had come in."


def test_furniture_around_a_body(a):
    text = f"* Shop\n* My account\nHome > Docs > A boat\nA boat\nPosted by Ann Lee on 3 May 2021\n{PROSE}\nShort heading\n{PROSE}\nShare this:\n© 2021 Some Site. All rights reserved."
    assert furniture(a, text, "A boat") == [1, 2, 3, 5, 9, 10]


def test_related_list_ends_at_the_body(a):
    assert furniture(a, f"Related articles\nA first title here\nAnother title here\n{PROSE}") == [1, 2, 3]


def test_sentence_that_mentions_furniture_stays(a):
    assert furniture(a, "He read that all rights were reserved for the mixer, and that cookies were on the table at noon.\n" + PROSE) == []


def test_lists_and_tables_are_body(a):
    p = a.page("News\n1. red boat\n2. blue boat\n3. green boat\n4. old boat\nBack to top", None)
    assert p.label[1:5] == [B.BODY] * 4 and p.label[0] == p.label[5] == B.FURNITURE
    p = a.page("\n".join(f"item {i}\t{i * 3}\t{i}%\tn/a" for i in range(5)), None)
    assert set(p.label) == {B.BODY} and set(p.kind) == {B.ROW}


def test_blank_and_empty(a):
    assert a.page("", None).label == [B.BLANK]
    assert a.page("\n \n", "").label == [B.BLANK] * 3


@pytest.mark.parametrize("text", ["404 Not Found", "Please enable JavaScript to view this page.", "Welcome to {{ name }}\nItem: <PRICE goes here>", "Lorem ipsum dolor sit amet, massa velit quam rutrum.", "ページが見つかりません", "Checking your browser before accessing a.example.\nRay 12ab34cd"])
def test_dead(a, text):
    assert dead.is_dead(a.page(text, None), "")[0]


@pytest.mark.parametrize("text", [PROSE, PROSE + "\n404 Not Found was the name of the boat that was in the harbour for a year, and it was well liked.", "1. red boat\n2. blue boat\n3. green boat\n4. old boat"])
def test_not_dead(a, text):
    assert not dead.is_dead(a.page(text, None), "")[0]


def test_commercial_addresses():
    assert spam.commercial("https://a.example/x/buy-red-boat-near-me-7", None)
    assert not spam.commercial("https://a.example/reviews/red-boat-7", "Notes on a red boat")
    assert not spam.commercial(None, None)


def test_trees_learn_a_rule():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((600, len(spam.NAMES)))
    y = ((x[:, 3] > 0.5) & (x[:, 7] < 0.6)).astype(float)
    p = BaggedTrees().fit(x[:400], y[:400]).predict(x[400:])
    assert ((p > 0.5) == (y[400:] > 0.5)).mean() > 0.93
    assert BaggedTrees().fit(x[:0], y[:0]).predict(x[:3]).tolist() == [0.0] * 3


def test_host_names():
    assert pages.host_of("HTTP://U@WWW.A.Example:8080/x") == "www.a.example"
    assert pages.host_of(None) == pages.host_of("http://[bad") == ""


def test_held_out_agreement(spark):
    """Trees fitted on one table agree with the weak labels of another."""
    d = "/root/testdata/sf0.01"
    words = pages.words_of(spark, d)
    prof = pages.durable(pages.profile(pages.pages(spark, d), words))
    from pyspark.sql import functions as F

    train, test = prof.where(F.pmod("seq", F.lit(2)) == 0), prof.where(F.pmod("seq", F.lit(2)) == 1)
    scored = pages.with_spam(test, pages.fit_spam(train)).where("label >= 0")
    r = scored.agg(F.avg((F.col("spam") == (F.col("label") == 1)).cast("double")).alias("ok"), F.count("*").alias("n")).first()
    assert r.n > 300 and r.ok > 0.97
