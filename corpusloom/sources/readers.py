"""Readers with fixed schemas, registries, and a data source for WARC and WET headers."""

from __future__ import annotations

import gzip
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import url as U

SCHEMAS = {
    "index_records": "url string, digest string, mime string, status string",
    "extracted": "url string, url_hash string, source string, depth int, title string, text_length bigint, content_hash string, extractor string, text_preview string, text string",
    "manifest": "url string, url_hash string, source string, depth int, from_url string, ok boolean, status int, final_url string, content_type string, bytes bigint, canonical string, title string, text_length bigint, content_hash string, extractor string, error string, content_duplicate boolean, not_modified boolean, sitemap_child_count int, sitemap_page_count int, feed_item_count int",
    "links": "from_url string, to_url string, source string",
    "http_cache": "url_hash string, url string, etag string, last_modified string",
}


def jsonl(spark: SparkSession, path: str | list[str], schema: str, strict: bool = False) -> DataFrame:
    """JSON lines; strict fails on a bad line, otherwise bad lines are left out."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def jsonl_checked(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines with the text of bad ones in ``bad_line``."""
    return spark.read.schema(schema + ", bad_line string").json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="bad_line")


def csv_rows(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def list_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value): lines of a plain or zipped list without blank ones and comments."""
    v = F.trim("value")
    return spark.read.text(path).select(v.alias("value")).where((v != "") & ~v.startswith("#"))


def seeds_tsv(spark: SparkSession, path: str | list[str], least_columns: int = 2) -> DataFrame:
    """(seed_url, scope, output_name) of a seeds file; a missing name is made from the scope."""
    df = spark.read.schema("seed_url string, scope string, output_name string").csv(path, sep="\t", comment="#")
    df = df.where("seed_url is not null and scope is not null")
    if least_columns >= 3:
        df = df.where("output_name is not null")
    return df.withColumn("output_name", F.coalesce("output_name", U.safe_name(F.col("scope"))))


def seed_urls(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(url) of a file of JSON rows and bare URLs, line by line; JSON without a url is left out."""
    v = F.trim("value")
    return spark.read.text(path).select(F.when(v.startswith("{"), F.get_json_object(v, "$.url")).otherwise(v).alias("url")).where("url is not null and url <> '' and url not like '#%'")


def registry(spark: SparkSession, path: str | list[str], key: str) -> DataFrame:
    """A registry of seen keys."""
    return list_file(spark, path).select(F.col("value").alias(key)).distinct()


def per_site(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """JSON files of all sites with the site's folder as ``site``."""
    return spark.read.schema(schema).json(glob).withColumn("site", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def line_counts(spark: SparkSession, glob: str) -> DataFrame:
    """(path, lines) of the non-blank lines of each file."""
    return spark.read.text(glob).where(F.trim("value") != "").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("lines"))


def file_stats(spark: SparkSession, glob: str) -> DataFrame:
    """(path, size, modified) of files, without their content."""
    return spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def file_listing(names: DataFrame, stats: DataFrame, name: Column) -> DataFrame:
    """(name, exists, size, age_seconds) of files by name, absent ones too."""
    found = stats.withColumn("name", name).groupBy("name").agg(F.sum("size").alias("size"), F.max("modified").alias("modified"))
    age = F.unix_micros(F.current_timestamp()) / 1e6 - F.unix_micros("modified") / 1e6
    return names.join(found, "name", "left").select("name", F.col("modified").isNotNull().alias("exists"), F.coalesce("size", F.lit(0)).alias("size"), age.alias("age_seconds"))


def current(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a state table that ``writers.replace`` wrote."""
    jvm = spark.sparkContext._jvm
    marks = jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    fs = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    newest = max(fs.listStatus(marks), key=lambda f: f.getModificationTime())
    return spark.read.parquet(f"{path}/version={newest.getPath().getName()}")


def first_there(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of several tables that is there."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        if at.getFileSystem(conf).exists(at):
            return spark.read.parquet(p)
    raise FileNotFoundError(", ".join(paths))


def tail(df: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows of an order."""
    return df.orderBy(F.desc(order)).limit(n)


def latest_cache(df: DataFrame, order: str = "seq") -> DataFrame:
    """The last version of each validator, also where its fields are blank; NULL keys are left out."""
    return df.where("url_hash is not null").groupBy("url_hash").agg(F.max_by(F.struct("url", "etag", "last_modified"), order).alias("v")).select("url_hash", "v.*")


def warc_headers(stream, most: int | None = None) -> Iterator[dict[str, str]]:
    """Headers of the records of a stream; bodies are skipped, a bad length counts as 0."""
    n = 0
    while most is None or n < most:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (line := stream.readline()) and line.strip():
            name, sep, value = line.decode("utf-8", "replace").partition(":")
            if sep:
                head[name.strip()] = value.strip()
        try:
            skip = max(0, int(head.get("Content-Length", "0")))
        except ValueError:
            skip = 0
        while skip > 0:
            got = len(stream.read(min(skip, 1 << 20)))
            if not got:
                break
            skip -= got
        n += 1
        yield head


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _WetReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        path = options["path"]
        if os.path.isdir(path):
            self.paths = sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith((".wet", ".warc", ".gz")))
        else:
            self.paths = path.split(",")
        self.most = int(options["maxrecords"]) if "maxrecords" in options else None

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, part: _File):
        with open(part.path, "rb") as f:
            zipped = f.read(2) == b"\x1f\x8b"
        with gzip.open(part.path, "rb") if zipped else open(part.path, "rb") as stream:
            for n, head in enumerate(warc_headers(stream, self.most)):
                yield (part.path, n, head.get("WARC-Target-URI"), head.get("WARC-Record-ID"), head)


class WetSource(DataSource):
    """``spark.read.format("wet").load(folder or files)``: headers of WARC and WET files, one task per file."""

    @classmethod
    def name(cls):
        return "wet"

    def schema(self):
        return "path string, n bigint, target_url string, record_id string, headers map<string,string>"

    def reader(self, schema):
        return _WetReader(self.options)


def wet(spark: SparkSession, path: str, max_records: int | None = None) -> DataFrame:
    spark.dataSource.register(WetSource)
    r = spark.read.format("wet")
    return (r.option("maxRecords", max_records) if max_records else r).load(path)


def discovered_sites(headers: DataFrame, seen: DataFrame | None = None, english_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sites, reason counts) of record headers: the first record of each registrable domain that no registry holds."""
    x = headers.withColumn("site", U.site_of(F.col("target_url"), english_only))
    counts = x.groupBy(F.coalesce("site.reason", F.lit("candidate_sites")).alias("reason")).agg(F.count("*").alias("n"))
    good = x.where("site.reason is null").select("path", "n", "record_id", F.col("target_url").alias("sample_url"), "site.seed_url", "site.scope", "site.host")
    if seen is not None:
        good = good.join(seen, "scope", "left_anti")
    sites = good.groupBy("scope").agg(F.min_by(F.struct("seed_url", "host", "sample_url", "record_id", "path"), F.struct("path", "n")).alias("v")).select("scope", "v.*")
    return sites, counts
