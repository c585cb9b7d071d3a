"""One rule for pages of all lengths."""

from corpusloom.llm import quality
from tests.llm.test_edges import PROSE, _page, _tables


def test_the_same_page_on_both_sides_of_a_chunk(spark, tmp_path):
    # a garbled story with short lines under its paragraphs, once and then over again past 65,536 characters
    block = PROSE.replace("old", "oldâ€”and cafÃ©").strip() + "\n" + "Harbour notes\n" * 3
    short = block * 20
    long = block * (65_536 // len(block) + 20)
    table = "".join(f"Pier {i} | {i * 7} | {i * 3} | {i % 9}\n" for i in range(3000))
    x = [_page(1, short), _page(2, long), _page(3, table[:2000]), _page(4, table), _page(5, table + "\n404 Not Found")]
    found = {r.seq for r in quality.p7_found(spark, _tables(tmp_path, x)).collect()}
    assert (1 in found) == (2 in found) and {3, 4} <= found


def test_short_furniture_of_a_long_page_is_no_body(spark, tmp_path):
    block = PROSE.strip() + "\n" + "Home\nQuux zed\nContact us\n" * 30
    x = [_page(1, block * 5), _page(2, block * (65_536 // len(block) + 20))]
    found = {r.seq for r in quality.p7_found(spark, _tables(tmp_path, x)).collect()}
    assert (1 in found) == (2 in found)
