"""Lines repeated across the documents of one host, on incremental line-count tables.

A count table holds, by host and line, the number of rows the line stands on,
and by host (line key 0) the number of rows with a non-blank text.  New
partitions are counted alone and merged in; a line crosses the threshold when
the merged table makes it excessive, and only documents that hold a crossed
line are looked at again.  Hosts and lines are 64-bit keys, so a table row is
small and the texts are never shuffled; they are read once, into the keys of
their lines.

A state folder holds the count tables of the partitions counted so far
(``advance``); a partition of a known name is written over, so a failed call
can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, folder, read_table, spread, stored

LEAST_ROWS, LEAST_PERCENT = 4, 15
_DROPPED = " \t\r 0123456789"


def host_column(url: Column) -> Column:
    """Host name in small letters without user and port; NULL if there is none."""
    h = F.lower(F.regexp_extract(url, r"(?i)^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@\\]*@)?(\[[^\]]*\]|[^/?#:\\\s]+)", 1))
    return F.when(h != "", h)


def line_keys(df: DataFrame) -> DataFrame:
    """(seq, batch_id, host, keys): the key of each line of each non-blank text by position; NULL for lines that don't count.

    Rows without a host are left out; blank and NULL texts too; no batch is batch 0.
    """
    key = lambda x: F.xxhash64(F.translate(F.lower(x), _DROPPED, ""))
    keys = F.transform(F.split("text", "\n", -1), lambda x: F.when(F.translate(x, _DROPPED, "") != "", F.when(key(x) == 0, F.lit(1).cast("long")).otherwise(key(x))))
    full = F.col("text").isNotNull() & (F.regexp_replace("text", r"[\s 　​﻿]+", "") != "")
    batch = F.coalesce("batch_id", F.lit(0)) if "batch_id" in df.columns else F.lit(0)
    host = host_column(F.col("url"))
    return df.where(full).select("seq", batch.alias("batch_id"), host.alias("h"), keys.alias("keys")).where("h is not null").select("seq", "batch_id", F.xxhash64("h").alias("host"), "keys")


def count_keys(keyed: DataFrame, *by: str) -> DataFrame:
    """The count table of lines read by ``line_keys``: (host, line, n); line 0 counts the rows of the host.

    A line counts once per row.  Partial sums are made before the shuffle, so a
    hot host or line sends one row per task.
    """
    each = F.concat(F.array(F.lit(0).cast("long")), F.array_distinct(F.filter("keys", lambda k: k.isNotNull())))
    return keyed.select(*by, "host", F.explode(each).alias("line")).groupBy(*by, "host", "line").agg(F.count("*").alias("n"))


def count_lines(df: DataFrame) -> DataFrame:
    """The count table of one partition of texts."""
    return count_keys(line_keys(df))


def merge_counts(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Adds a partition's count table to the state."""
    return state.unionByName(delta).groupBy("host", "line").agg(F.sum("n").alias("n"))


def excessive(counts: DataFrame) -> DataFrame:
    """(host, line) of the lines that stand on enough rows of their host."""
    candidates = counts.where((F.col("line") != 0) & (F.col("n") >= LEAST_ROWS))
    totals = counts.where("line = 0").select("host", F.col("n").alias("total"))
    return candidates.join(totals, "host").where(F.col("n") * 100 >= F.col("total") * LEAST_PERCENT).select("host", "line")


def crossed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Lines that became excessive between two states."""
    return excessive(after).join(excessive(before), ["host", "line"], "left_anti")


def advance(spark: SparkSession, path: str, name: str, delta: DataFrame) -> DataFrame:
    """Adds a partition's count table to the state folder and gives the (host, line) that cross the threshold with it.

    A line that the partition doesn't hold can't cross: its host only gets more
    rows.  So of the state only the lines of the partition and the totals of
    its hosts are summed.
    """
    delta.write.mode("overwrite").parquet(f"{path}/name={name}")
    new = spark.read.parquet(f"{path}/name={name}")
    state = spark.read.parquet(path).join(new.select("host", "line"), ["host", "line"], "left_semi")
    mine = F.when(F.col("name") == name, F.col("n")).otherwise(0)
    sums = state.groupBy("host", "line").agg(F.sum("n").alias("after"), F.sum(F.col("n") - mine).alias("before"))
    at = lambda n: excessive(sums.select("host", "line", F.col(n).alias("n")))
    return at("after").join(at("before"), ["host", "line"], "left_anti")


def occurrences_of(keyed: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows of the lines, with (seq, line_no) of each of their occurrences; line numbers count from 1."""
    each = keyed.select("seq", "batch_id", "host", F.posexplode("keys").alias("pos", "line")).where("line is not null")
    return each.join(lines, ["host", "line"]).withColumn("line_no", F.col("pos") + 1)


def occurrences(df: DataFrame, lines: DataFrame) -> DataFrame:
    """(seq, line_no) of each occurrence of the given (host, line) pairs in texts."""
    return occurrences_of(line_keys(df), lines).select("seq", "line_no")


def strip_lines(df: DataFrame, found: DataFrame) -> DataFrame:
    """(seq, text) of the documents that hold found lines, without these lines."""
    nos = found.groupBy("seq").agg(F.collect_set("line_no").alias("nos"))  # bounded by the lines of one document
    kept = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct((i + 1).alias("no"), x.alias("x"))), lambda s: ~F.array_contains("nos", s["no"]))
    return df.select("seq", "text").join(nos, "seq").select("seq", F.array_join(F.transform(kept, lambda s: s["x"]), "\n").alias("text"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "extracted_text").select("seq", "batch_id", "url", "text")


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line keys of all texts, written once."""
    return stored(line_keys(spread(_texts(spark, sf_dir))), "lines")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, line_no) of every occurrence of a line that is excessive on its host.

    Batch 0 makes the state, the later batches are merged in as one delta.  Rows
    without a host, blank and NULL texts give no rows.
    """
    keyed, path = _keyed(spark, sf_dir), folder(spark, "counts")
    count_keys(keyed.where("batch_id = 0")).write.parquet(f"{path}/name=history")
    count_keys(keyed.where("batch_id > 0")).write.parquet(f"{path}/name=later")
    state = spark.read.parquet(path)
    return occurrences_of(keyed, excessive(durable(merge_counts(state.where("name = 'history'").drop("name"), state.where("name = 'later'").drop("name"))))).select("seq", "line_no").distinct()


def p6_crossed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batch_id, seq, line_no): the lines that become excessive with each batch from 1 on, wherever they stand in the rows so far.

    The batches join a stored state one after the other; the rows of a text are
    looked at again only for lines that crossed.
    """
    keyed, path = _keyed(spark, sf_dir), folder(spark, "counts")
    batches = [r[0] for r in keyed.select("batch_id").distinct().orderBy("batch_id").collect()]  # the batches of one table
    crossed_at: DataFrame | None = None
    for b in batches:
        new = advance(spark, path, str(b), count_keys(keyed.where(F.col("batch_id") == b)))
        if b > 0:
            new = durable(new.withColumn("at", F.lit(b)))
            crossed_at = new if crossed_at is None else crossed_at.unionByName(new)
    if crossed_at is None:
        return spark.createDataFrame([], "batch_id int, seq long, line_no int")
    return occurrences_of(keyed, crossed_at).where("batch_id <= at").select(F.col("at").alias("batch_id"), "seq", "line_no").distinct()


def p6_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, text) of the documents that lose excessive lines."""
    return strip_lines(_texts(spark, sf_dir), p6_found(spark, sf_dir))


_NORM = "regexp_replace(lower(x), '[ \\t\\r\\x{00A0}0-9]', '', 'g')"
_SQL_LINES = f"""
t AS (SELECT seq, batch_id, lower(regexp_extract(url, '(?i)^\\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\\s]+)', 1)) AS host, text FROM extracted_text
      WHERE text IS NOT NULL AND regexp_replace(text, '[\\s\\x{{00A0}}\\x{{3000}}\\x{{200B}}\\x{{FEFF}}]+', '', 'g') <> ''),
l AS (SELECT seq, batch_id, host, {_NORM} AS line, i AS line_no FROM (SELECT seq, batch_id, host, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM t WHERE host <> '')),
k AS (SELECT * FROM l WHERE line <> '')"""
_SQL_EXCESS = """
{name} AS (SELECT c.host, c.line FROM (SELECT host, line, count(DISTINCT seq) AS n FROM k {where} GROUP BY host, line) c
      JOIN (SELECT host, count(*) AS total FROM t {where} GROUP BY host) h ON h.host = c.host WHERE c.n >= 4 AND c.n * 100 >= h.total * 15)"""
_BY_BATCH = """
b AS (SELECT DISTINCT coalesce(batch_id, 0) AS upto FROM t), n AS (SELECT upto, host, line, count(DISTINCT seq) AS n FROM k JOIN b ON coalesce(k.batch_id, 0) <= upto GROUP BY ALL),
h AS (SELECT upto, host, count(*) AS total FROM t JOIN b ON coalesce(t.batch_id, 0) <= upto GROUP BY ALL),
e AS (SELECT n.upto, n.host, n.line FROM n JOIN h ON h.upto = n.upto AND h.host = n.host WHERE n >= 4 AND n * 100 >= total * 15),
c AS (SELECT e.* FROM e WHERE upto > 0 AND NOT EXISTS (SELECT 1 FROM e p WHERE p.host = e.host AND p.line = e.line AND p.upto = (SELECT max(b.upto) FROM b WHERE b.upto < e.upto)))"""
SQL = {
    "p6_found": f"WITH {_SQL_LINES}, {_SQL_EXCESS.format(name='e', where='')} SELECT DISTINCT k.seq, k.line_no::INT AS line_no FROM k JOIN e ON e.host = k.host AND e.line = k.line",
    "p6_crossed": f"WITH {_SQL_LINES}, {_BY_BATCH} SELECT DISTINCT c.upto::INT AS batch_id, k.seq, k.line_no::INT AS line_no FROM k JOIN c ON c.host = k.host AND c.line = k.line AND coalesce(k.batch_id, 0) <= c.upto",
}
SQL["p6_stripped"] = f"""{SQL['p6_found'].split(' SELECT DISTINCT k.seq')[0]}, f AS (SELECT DISTINCT k.seq, k.line_no FROM k JOIN e ON e.host = k.host AND e.line = k.line),
z AS (SELECT seq, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM extracted_text WHERE seq IN (SELECT seq FROM f))
SELECT z.seq, coalesce(string_agg(z.x, chr(10) ORDER BY z.i) FILTER (f.seq IS NULL), '') AS text FROM z LEFT JOIN f ON f.seq = z.seq AND f.line_no = z.i GROUP BY z.seq"""
