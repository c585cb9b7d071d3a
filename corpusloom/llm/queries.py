"""Queries of the llm subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cutoff, history, leak, mojibake, pages, quality, repeats, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": pages.p1_found,
    "p1_scores": pages.p1_scores,
    "p2_found": pages.p2_found,
    "p2_by_status": pages.p2_by_status,
    "p3_found": pages.p3_found,
    "p3_bodies": pages.p3_bodies,
    "p4_found": mojibake.p4_found,
    "p4_fixed": mojibake.p4_fixed,
    "p4_lossy": mojibake.p4_lossy,
    "p5_found": history.p5_found,
    "p5_appended": history.p5_appended,
    "p5_table": history.p5_table,
    "p6_found": repeats.p6_found,
    "p6_crossed": repeats.p6_crossed,
    "p6_stripped": repeats.p6_stripped,
    "p7_found": quality.p7_found,
    "p7_stats": quality.p7_stats,
    "p8_ids": tokens.p8_ids,
    "p8_counts": tokens.p8_counts,
    "p9_found": leak.p9_found,
    "p9_spans": leak.p9_spans,
    "p9_items": leak.p9_items,
    "p10_found": cutoff.p10_found,
    "p10_sources": cutoff.p10_sources,
}
ORACLE: dict[str, str] = {**repeats.SQL, **leak.SQL}
