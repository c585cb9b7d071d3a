"""Long texts in pieces that can be worked on wherever they land."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: characters of pieces handed over at once
BATCH = 4_000_000


def cut(df: DataFrame, key: str, text: str, size: int, prepare: Callable[[str], str] | None = None) -> tuple[DataFrame, DataFrame]:
    """((key, h, piece, text), (key, h, copies)) of the texts with more than ``size`` characters.

    ``h`` is a hash of the whole text, so rows that share a key but not a text
    stay apart; rows that are equal in both are cut once and counted.  A text is
    read once and handed on piece by piece; ``prepare`` changes it before that.
    """
    long = df.where(F.length(text) > size).select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("piece", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for k, t in zip(b.column(0), b.column(1)):
                whole = t.as_py()
                h = xxhash.xxh64_intdigest(whole.encode("utf-8", "surrogatepass")) - (1 << 63)
                whole = prepare(whole) if prepare else whole
                for piece in range(max(1, -(-len(whole) // size))):
                    part = whole[piece * size : (piece + 1) * size]
                    rows.append((k.as_py(), h, piece, part))
                    held += len(part)
                    if held >= BATCH:
                        yield _rows(rows, schema)
                        rows, held = [], 0
            if rows:
                yield _rows(rows, schema)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs = [xxhash.xxh64_intdigest(t.as_py().encode("utf-8", "surrogatepass")) - (1 << 63) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hs, pa.int64())], names=["key", "h"])

    # different keys and texts are told apart before pieces move, so that copies of a row don't
    pieces = long.mapInArrow(run, "key long, h long, piece int, text string").dropDuplicates(["key", "h", "piece"])
    copies = long.mapInArrow(mark, "key long, h long").groupBy("key", "h").agg(F.count("*").alias("copies"))
    return pieces.withColumnRenamed("key", key), copies.withColumnRenamed("key", key)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def repeat(results: DataFrame, copies: DataFrame, key: str) -> DataFrame:
    """The results of cut texts, as often as their rows stood in the table; ``h`` is dropped."""
    c = copies.withColumnRenamed(key, "_key").withColumnRenamed("h", "_h")
    joined = results.join(c, results[key].eqNullSafe(c["_key"]) & (results["h"] == c["_h"]))
    return joined.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_key", "_h", "h", "copies", "_k")
