"""Queries of sources and sinks: a table is written the way the sink writes it, read the way the source reads it, and must come back.

The files lie in the shared folder of the session and go with the application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from ..session import durable, folder, read_table, spread
from ..sources import archives, readers, writers
from . import queries as Q
from .queries import query


@query
def jsonl_strict(spark, d):
    """JSON lines written and read strictly; letters beyond ASCII and NULLs come back."""
    path = folder(spark, "jsonl")
    writers.jsonl(read_table(spark, d, "extracted_text").select("seq", "url", "title", "text"), path)
    x = readers.jsonl(spark, path, "seq long, url string, title string, text string", strict=True)
    return x.select("seq", "url", "title", F.md5("text").alias("text_md5"))


@query
def jsonl_without_text(spark, d):
    """JSON lines without the full text."""
    path = folder(spark, "no-text")
    writers.jsonl(read_table(spark, d, "extracted_text").select("seq", "title", "text_length", "text"), path, drop=["text"])
    x = spark.read.json(path)
    return x.select("seq", "title", "text_length", F.lit("text" in x.columns).alias("has_text"))


def _broken_index(spark, d) -> str:
    """Index records as JSON lines; those without a type were cut off in mid-line."""
    path = folder(spark, "index")
    line = F.to_json(F.struct("seq", "url", "digest", "mime", "status"))
    cut = F.when(F.coalesce("mime", F.lit("")) == "", F.expr("substring(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    read_table(spark, d, "index_records").withColumn("line", line).select(cut.alias("value")).write.text(path)
    return path


@query
def jsonl_lenient(spark, d):
    """JSON lines of which broken ones are left out."""
    return readers.jsonl(spark, _broken_index(spark, d), "seq long, url string, digest string, mime string, status string").select("seq", "url", "mime")


@query
def index_lines(spark, d):
    """Lines of an index by whether they can be read; the filter reasons of those that can."""
    x = durable(readers.jsonl_checked(spark, _broken_index(spark, d), "seq long, " + readers.SCHEMAS["index_records"]))
    reasons = Q.R.index_reason(x.where("bad_line is null")).select(F.coalesce("reason", F.lit("checked")).alias("reason"))
    bad = x.where("bad_line is not null").select(F.lit("bad_index_lines").alias("reason"))
    return reasons.unionByName(bad).groupBy("reason").agg(F.count("*").alias("n"))


@query
def csv_round_trip(spark, d):
    """CSV with a header in a fixed order of columns, one of them absent from the table; all columns are read as strings."""
    path = folder(spark, "csv")
    writers.csv_rows(read_table(spark, d, "manifest").dropDuplicates(["seq"]).select("seq", "url", "status"), path, ["url", "status", "lastmod", "seq"])
    x = readers.csv_rows(spark, path, "url string, status string, lastmod string, seq string")
    return x.select(F.col("seq").cast("long").alias("seq"), "url", "status", F.coalesce("lastmod", F.lit("")).alias("lastmod"))


def _seed_file(spark, d) -> str:
    """A seeds file: names only where a sample was seen."""
    path = folder(spark, "seeds")
    writers.seeds_tsv(read_table(spark, d, "site_seeds").withColumn("output_name", F.when(F.col("sample_url").isNotNull(), F.col("output_name"))), path)
    return path


@query
def seeds_two_columns(spark, d):
    """Seeds with at least two columns; a missing name is made from the scope."""
    return readers.seeds_tsv(spark, _seed_file(spark, d))


@query
def seeds_three_columns(spark, d):
    """Seeds of which all three columns are there."""
    return readers.seeds_tsv(spark, _seed_file(spark, d), 3)


@query
def seeds_mixed(spark, d):
    """A file of JSON rows and bare addresses, line by line."""
    path = folder(spark, "mixed")
    line = F.when(F.col("sample_url").isNotNull(), F.to_json(F.struct(F.col("sample_url").alias("url"), "host"))).otherwise(F.col("seed_url"))
    read_table(spark, d, "site_seeds").select(line.alias("value")).write.text(path)
    return readers.seed_urls(spark, path)


@query
def registry_appended(spark, d):
    """A registry of hosts that two runs append to; what it holds already isn't added again."""
    path = folder(spark, "registry")
    hosts = read_table(spark, d, "site_seeds").select("host")
    writers.append_registry(hosts.where("source_wet_path is not null"), path, "host")
    writers.append_registry(hosts, path, "host")
    return spark.read.text(path).groupBy(F.col("value").alias("host")).agg(F.count("*").alias("lines"))


@query
def archive_paths(spark, d):
    """A zipped list of archive paths without blank lines and comments, made absolute."""
    path = folder(spark, "paths")
    lines = read_table(spark, d, "site_seeds").select(F.explode(F.array("source_wet_path", F.lit(""), F.concat(F.lit("# "), "host"))).alias("value"))
    lines.where("value is not null").write.option("compression", "gzip").text(path)
    return readers.list_file(spark, path).select(U.absolute_path(F.col("value")).alias("url")).groupBy("url").agg(F.count("*").alias("n"))


def _archives(spark, d) -> str:
    path = folder(spark, "wet")
    x = spread(read_table(spark, d, "extracted_text").select("seq", "url", "text"))
    archives.write(x.select(F.col("url").alias("target_url"), F.concat(F.lit("<urn:"), "seq", F.lit(">")).alias("record_id"), "text"), path)
    return path + "/*.gz"


@query
def archive_headers(spark, d):
    """Headers of zipped archives that hold every text as a record."""
    return archives.records(spark, _archives(spark, d)).select("target_url", "record_id", "length")


@query
def archive_discovery(spark, d):
    """Reasons for the records of archives, with sites that a registry holds (those of seeds without a sample)."""
    seen = read_table(spark, d, "site_seeds").where("sample_url is null").select("scope").distinct()
    return Q.discovery(archives.records(spark, _archives(spark, d)).withColumn("order", F.regexp_extract("record_id", r"(\d+)", 1).cast("long")), "target_url", "order", seen).groupBy("reason").agg(F.count("*").alias("n"))


@query
def frontier_dump(spark, d):
    """The open frontier written as JSON lines and read again."""
    path = folder(spark, "frontier")
    writers.jsonl(Q.resume_frontier(spark, d), path)
    return readers.jsonl(spark, path, "normalized string")


@query
def summary_file(spark, d):
    """The summary of a run as one JSON object in one file."""
    path = folder(spark, "summary")
    writers.summary(Q.run_rollup(spark, d), path)
    return readers.jsonl(spark, path, "sites long, complete long, capped long, fetched long, ok long, unique_text long, open long", strict=True)


@query
def state_replaced(spark, d):
    """A state table that is replaced as a whole: readers see the old or the new one, here the new one."""
    path = folder(spark, "state")
    x = read_table(spark, d, "http_cache").select("seq", "url_hash", "etag")
    writers.replace(x.where("etag is null"), path)
    writers.replace(x, path)
    return readers.current(spark, path)


@query
def html_store(spark, d):
    """Stored page bodies by name, partition and the name with number and slug."""
    path = folder(spark, "html")
    x = read_table(spark, d, "manifest").dropDuplicates(["seq"]).where("final_url is not null").select("seq", "final_url", F.concat(F.lit("<title>"), F.coalesce("title", F.lit("")), F.lit("</title>")).alias("html"))
    writers.html_store(x.withColumn("artifact", U.artifact_name(F.col("seq").cast("int"), F.col("final_url"))), path)
    return spark.read.parquet(path).select("name", F.col("part").cast("string").alias("part"), "final_url", F.md5("html").alias("html_md5"), F.substring_index("artifact", "_", 1).alias("number"))


def _site_files(spark, d) -> str:
    """One folder of JSON lines for each source of the manifest."""
    path = folder(spark, "sites")
    read_table(spark, d, "manifest").dropDuplicates(["seq"]).where("source is not null").select("seq", "url", "status", F.col("source").alias("folder")).write.partitionBy("folder").json(path)
    return path


@query
def per_site_files(spark, d):
    """Files of all folders of a glob, with the folder each came from."""
    x = readers.per_site(spark, _site_files(spark, d) + "/*/*.json", "seq long, url string, status int")
    return x.select("seq", F.regexp_replace("site", "^folder=", "").alias("site"))


@query
def file_line_counts(spark, d):
    """Lines of the files of each folder."""
    x = readers.line_counts(spark, _site_files(spark, d) + "/*/*.json")
    return x.groupBy(F.regexp_extract("path", "folder=([^/]*)", 1).alias("site")).agg(F.sum("lines").alias("lines"))


@query
def file_listing(spark, d):
    """Presence, size and age of files by name; names that are not there count as absent."""
    path = folder(spark, "listed")
    read_table(spark, d, "site_seeds").select(F.col("host").alias("value")).coalesce(1).write.option("lineSep", "\n").text(path)
    names = spark.createDataFrame([("part",), ("absent",)], "name string")
    x = readers.file_listing(names, readers.file_stats(spark, path + "/part-*"), F.regexp_extract("path", r"([a-z]+)-[^/]*$", 1))
    return x.select("name", "exists", "size", (F.coalesce("age_seconds", F.lit(0.0)) >= 0).alias("aged"))


@query
def worker_files_merged(spark, d):
    """Files of several workers with different columns, laid together."""
    paths = [folder(spark, "worker") for _ in range(3)]
    x = read_table(spark, d, "extracted_text")
    writers.jsonl(x.where("depth <= 1").select("seq", "url"), paths[0])
    writers.jsonl(x.where("depth > 1").select("seq", "url", "title"), paths[1])
    writers.jsonl(x.where("depth is null").select("seq", "source"), paths[2])
    schema = ("seq long, url string", "seq long, url string, title string", "seq long, source string")
    return writers.merged([readers.jsonl(spark, p, s) for p, s in zip(paths, schema)]).select("seq", "url", "title", "source")


@query
def log_tail(spark, d):
    """The last 20 rows of a written log, by the number each row was given."""
    path = folder(spark, "log")
    writers.jsonl(Q._events(spark, d).select("event_id", "event_type"), path)
    return readers.tail(readers.jsonl(spark, path, "event_id long, event_type string"), "event_id", 20)


@query
def sample_pages(spark, d):
    """Rows to look at: of the pages where they were kept, else of what was extracted."""
    x = readers.first_there(spark, [f"{d}/pages_that_were_not_kept.parquet", f"{d}/extracted_text.parquet"])
    return x.select("seq", "url", "title").orderBy("seq").limit(15)
