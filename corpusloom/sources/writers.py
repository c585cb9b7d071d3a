"""Sinks. Writes go through Spark's commit protocol, so a half-written result is never read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jsonl(df: DataFrame, path: str, drop: list[str] | None = None, mode: str = "overwrite") -> None:
    """JSON lines; columns such as the full text can be left out."""
    df.drop(*(drop or [])).write.mode(mode).json(path)


def csv_rows(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """CSV with a header in a fixed order of columns; absent ones are blank."""
    cols = [F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    df.select(*cols).write.mode(mode).csv(path, header=True)


def seeds_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select("seed_url", "scope", "output_name").write.mode(mode).csv(path, sep="\t")


def append_registry(df: DataFrame, path: str, key: str) -> None:
    """Adds keys that the registry doesn't hold yet.

    Two writers at once may both add a key; readers take keys once (``readers.registry``).
    """
    spark = df.sparkSession
    new = df.select(F.col(key).cast("string").alias("value")).where("value is not null and value <> ''").distinct()
    try:
        new = new.join(spark.read.text(path), "value", "left_anti")
    except Exception as e:  # no registry yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    new.write.mode("append").text(path)


def summary(df: DataFrame, path: str) -> None:
    """A summary of one row as one JSON object in one file."""
    df.limit(1).coalesce(1).write.mode("overwrite").json(path)


def replace(df: DataFrame, path: str) -> None:
    """Replaces a state table: the new version is written whole beside the old one before a marker names it as current."""
    import uuid

    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/version={version}")
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_current/{version}")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [f.getPath() for f in fs.listStatus(marker.getParent())] if fs.exists(marker.getParent()) else []
    fs.create(marker).close()
    for m in old:
        fs.delete(m, False)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/version={m.getName()}"), True)


def merged(parts: list[DataFrame]) -> DataFrame:
    """The rows of the parts of several workers; absent columns are NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def html_store(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Page bodies under a name from sha1 of the final address, partitioned by its first two digits."""
    name = F.sha1("final_url")
    rest = [c for c in df.columns if c not in ("name", "final_url", "html", "part")]
    df.select(name.alias("name"), "final_url", "html", *rest, F.concat(F.lit("h"), F.substring(name, 1, 2)).alias("part")).write.mode(mode).partitionBy("part").parquet(path)
