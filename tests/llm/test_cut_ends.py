"""What vouches for an open end, and the limits at which open ends pile up."""

from corpusloom.llm import cutoff


def _judged(spark, docs, words=()):
    """docs: (doc_id, source, n, bytes, state, word, line, same_text)."""
    rows = [(0, *d, False, None) for d in docs] + [(1, None, None, None, None, None, w, None, None, None, c) for w, c in words]
    return {r.doc_id: r for r in cutoff.judge(spark.createDataFrame(rows, cutoff._SCHEMA)).collect()}


def test_copies_dont_vouch_for_each_other(spark):
    docs = [(i, "s", 300 + i, 300 + i, cutoff.OPEN, "start\n", 7, 1) for i in range(5)]
    assert all(r.cut for r in _judged(spark, docs).values())


def test_a_usual_line_is_still_cut_in_mid_word(spark):
    docs = [(i, "s", 300 + 40 * i, 300 + 40 * i, cutoff.OPEN, "harbo", 7, i) for i in range(5)]
    assert all(r.cut for r in _judged(spark, docs, [("harbour", 50)]).values())


def test_chance_meetings_stay_rare_in_a_large_source(spark):
    docs = [(i, "s", 300 + 40 * i, 300 + 40 * i, cutoff.OPEN, "x\n", 7 if i < 4 else 1000 + i, i) for i in range(400)]
    assert all(r.cut for r in _judged(spark, docs).values())


def test_footers_of_a_source_stay_whole(spark):
    docs = [(i, "s", 300 + 40 * i, 300 + 40 * i, cutoff.OPEN, "x\n", 7, i) for i in range(30)]
    assert not any(r.cut for r in _judged(spark, docs).values())


def _noise(n, first=10_000):
    """Whole texts of the source, and open ends at lengths of their own."""
    return [(first + i, "s", 200 + 7 * i, 200 + 7 * i, cutoff.WHOLE, "", first + i, first + i) for i in range(n)]


def test_limits_in_bytes(spark):
    docs = [(i, "s", 900 + 30 * i, 2048 - i % 2, cutoff.OPEN, "", i, i) for i in range(8)] + _noise(300)
    got = _judged(spark, docs)
    assert all(got[i].cut and got[i].at_limit for i in range(8)) and not any(got[d[0]].cut for d in docs[8:])


def test_second_limit_and_small_share(spark):
    docs = [(i, "s", 600 if i < 12 else 1500, 4000 + 200 * i, cutoff.OPEN, "", i, i) for i in range(20)] + _noise(2000)
    got = _judged(spark, docs)
    assert all(got[i].cut for i in range(20)) and got[0].char_limits == [600, 1500]


def test_copies_are_no_limit(spark):
    docs = [(i, "s", 600, 600, cutoff.OPEN, "", 5, 5) for i in range(20)] + _noise(50)
    assert not any(r.cut for r in _judged(spark, docs).values())


def test_what_earlier_lines_leave_open():
    import re as _re

    from corpusloom.llm import cutoff

    assert cutoff.unclosed("He said (see\nthe list.\nIt was so.") == ["("]
    assert cutoff.unclosed("<div>\n<ul class='x'>\nText.\n</ul>") == ["<div>"]
    assert cutoff.unclosed("```\ncode()\nmore.") == ["```"]
    assert cutoff.unclosed("„So ist es“, sagte sie. «Oui.» a) b) Home » Shop <br> <BODY TEXT goes here>") == []
    assert cutoff.unclosed("(a [b) c] \"d\"") == []
    assert not _re.search("contributors|reproduced", open(cutoff.__file__).read())


def test_the_stack_decides_unless_the_source_is_sloppy(spark):
    from pyspark.sql import functions as F

    from corpusloom.llm import cutoff

    story = "The old boat was in the harbour, and the keeper of the light was on the pier with his dog."
    neat = [(i, "neat.example", f"{story} Number {i}.") for i in range(30)] + [(30, "neat.example", f"He said (see\nthe list.\n{story}")]
    sloppy = [(100 + i, "sloppy.example", f"{story} (Number {i}.") for i in range(30)]
    df = spark.createDataFrame(neat + sloppy, "doc_id long, source string, text string")
    rows = cutoff.endings(df, ["the", "was", "in", "of", "and", "on", "with", "his"])
    got = {r.doc_id for r in cutoff.judge(rows).where("cut").collect()}
    off = {r.doc_id for r in cutoff.judge(rows.withColumn("left", F.lit(False))).where("cut").collect()}
    assert got == {30} and off == set()
