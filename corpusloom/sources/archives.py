"""WARC and WET archives read through Spark's own binary source, so that any file system the cluster knows will do."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import warc_headers

_SCHEMA = pa.schema([("path", pa.string()), ("n", pa.int64()), ("target_url", pa.string()), ("record_id", pa.string()), ("length", pa.int64())])


def records(spark: SparkSession, path: str | list[str], most: int | None = None) -> DataFrame:
    """(path, n, target_url, record_id, length): the headers of the records of archives, plain or zipped, by file and position.

    One row of the source is one file, so a task holds one packed file at a
    time; it is unpacked as a stream and bodies are skipped.  A length that is
    no number is NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, content in zip(b.column(0), b.column(1)):
                raw = io.BytesIO(content.as_py())
                stream = gzip.GzipFile(fileobj=raw) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw
                rows = []
                for n, head in enumerate(warc_headers(stream, most)):
                    length = head.get("Content-Length", "")
                    rows.append((at.as_py(), n, head.get("WARC-Target-URI"), head.get("WARC-Record-ID"), int(length) if length.isdigit() else None))
                    if len(rows) >= 10_000:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, n long, target_url string, record_id string, length long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, _SCHEMA)], schema=_SCHEMA)


def write(df: DataFrame, path: str) -> None:
    """Rows of (target_url, record_id, text) as zipped archives of one record after the other."""
    body = F.coalesce("text", F.lit(""))
    head = [F.lit("WARC/1.0\r\nWARC-Type: conversion\r\n"), F.when(F.col("target_url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), "target_url", F.lit("\r\n"))).otherwise("")]
    rest = [F.lit("WARC-Record-ID: "), F.col("record_id"), F.lit("\r\nContent-Type: text/plain\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n")]
    df.select(F.concat(*head, *rest).alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(path)
