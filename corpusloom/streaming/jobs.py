"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, durable, folder


def event_stream(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """The events of parquet files as a stream with a timestamp of the session's zone; schema taken from the files once."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    import os

    folder, name = os.path.split(path.rstrip("/"))
    df = r.option("pathGlobFilter", name).parquet(folder) if os.path.isfile(path) else r.parquet(path)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling_rates(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) by window; rows later than the watermark are left out of closed windows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events without a longer gap."""
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def seen_once(events: DataFrame, keys: list[str], late: str | None = None) -> DataFrame:
    """The first event of each key: for all time, or with bounded state within a watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys) if late else events.dropDuplicates(keys)


def run_to_table(df: DataFrame, name: str, mode: str = "complete", checkpoint: str | None = None) -> DataFrame:
    """Runs a stream over what is there now into a table of the shared folder, and gives the table.

    ``complete`` writes the result of each batch over the last one, ``append``
    adds to it; a batch that is repeated after a failure writes its own part again.
    """
    spark = df.sparkSession
    path = folder(spark, name)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch=0" if mode == "complete" else f"{path}/batch={number}")

    q = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint or folder(spark, name + "-offsets")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def run_batches(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands each new batch to a function; a restart goes on after the last finished batch."""
    q = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def merge_files(spark: SparkSession, source: str, target: str, schema: str, checkpoint: str | None = None) -> None:
    """Appends to the target what files of the source folder hold that wasn't merged before."""
    at = checkpoint or checkpoint_dir(spark) + "/merge-files"
    q = spark.readStream.schema(schema).json(source).writeStream.format("json").option("checkpointLocation", at).option("path", target).trigger(availableNow=True).start()
    q.awaitTermination()


def write_one(df: DataFrame, folder_path: str, name: str) -> None:
    """Writes lines as one file of a given name, over an earlier one of that name."""
    spark = df.sparkSession
    part = folder(spark, "one")
    df.coalesce(1).write.option("lineSep", "\n").text(part)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(part).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = [f.getPath() for f in fs.listStatus(path(part)) if f.getPath().getName().startswith("part-")]
    fs.mkdirs(path(folder_path))
    fs.delete(path(f"{folder_path}/{name}"), False)
    fs.rename(made[0], path(f"{folder_path}/{name}"))


def merge_lines(spark: SparkSession, source: str, target: str, state: str, run: str) -> None:
    """Appends to the target the lines that the files of a folder gained since the last run.

    The state holds by file the bytes merged so far.  A file that is shorter than
    that was cut or replaced and begins anew.  Bytes are those of whole lines,
    so a line that is still being written waits for the next run.  The lines of
    a run go to a part of its own, so a repeated run writes over itself.
    """
    files = spark.read.format("binaryFile").load(source).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"), "content")
    try:
        known = spark.read.parquet(state).where(F.col("run") != run).groupBy("file").agg(F.max_by("bytes", "made").alias("bytes"), F.max("made").alias("made"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = spark.createDataFrame([], "file string, bytes long, made long")
    start = F.when(F.coalesce("bytes", F.lit(0)) <= F.col("size"), F.coalesce("bytes", F.lit(0))).otherwise(0)
    new = files.join(known, "file", "left").withColumn("start", start)
    whole = F.col("size") - F.octet_length(F.substring_index(F.decode("content", "ISO-8859-1"), "\n", -1))
    new = durable(new.select("file", "start", whole.alias("bytes"), F.expr("substring(content, cast(start + 1 as int))").alias("added"), (F.coalesce("made", F.lit(0)) + 1).alias("made")))
    text = F.decode(F.expr("substring(added, 1, cast(greatest(bytes - start, 0) as int))"), "UTF-8")
    new.select(F.explode(F.split(text, "\n")).alias("value")).where("value <> ''").write.mode("overwrite").text(f"{target}/run={run}")
    new.select("file", "bytes", "made").write.mode("overwrite").parquet(f"{state}/run={run}")


def upsert_latest(state: DataFrame | None, batch: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key over a state and a new batch."""
    rows = batch if state is None else state.unionByName(batch)
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("_v")).select("_v.*")


def revisit(fetched: DataFrame, cache: DataFrame) -> DataFrame:
    """Adds to fetches by url_hash whether a validator was there (conditional) and whether the page is to be extracted again (changed)."""
    known = cache.select("url_hash", ((F.coalesce("etag", F.lit("")) != "") | (F.coalesce("last_modified", F.lit("")) != "")).alias("_known"))
    x = fetched.join(known, "url_hash", "left")
    return x.withColumn("conditional", F.coalesce("_known", F.lit(False))).withColumn("changed", F.coalesce(F.col("status") == 200, F.lit(False))).drop("_known")
