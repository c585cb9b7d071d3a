"""Frontier operators: why a URL is taken or refused, scores, limits, link graphs.

Where the order of arrival decides, the order column is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..functions import url as U
from ..session import durable


def _first_of_key(df: DataFrame, key: str, order: str, among: Column) -> DataFrame:
    """Adds ``_first``: the least order of the key among the rows that hold ``among``; partial sums before the shuffle."""
    firsts = df.where(among & F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(order).alias("_first"))
    return df.join(firsts, F.col(key) == F.col("_k"), "left").drop("_k")


def index_reason(df: DataFrame, html_only: bool = True) -> DataFrame:
    """Adds normalized, and why an index record is skipped before the search for duplicates; NULL if it isn't."""
    n = U.normalize(F.col("url"))
    other = F.lit(html_only) & (F.coalesce("mime", F.lit("")) != "") & ~F.lower("mime").contains("html")
    return df.withColumn("normalized", n).withColumn("reason", F.when(other, "skipped_non_html").when(F.col("normalized").isNull(), "skipped_normalize_failed"))


def enqueue_reasons(df: DataFrame, order: str, allowed: Column, cap: int | None = None) -> DataFrame:
    """Adds normalized and reason: normalize_failed, duplicate_url, out_of_scope, robots_disallow or queued.

    A URL is known only once it was accepted, so a repeated URL out of scope is
    out_of_scope each time.  ``allowed`` is the scope; a boolean column
    ``robots`` may say what robots rules allow.  With a cap, rows after so many
    accepted ones are max_discovered_reached whatever they are.
    """
    robots = F.col("robots") if "robots" in df.columns else F.lit(True)
    x = df.withColumn("normalized", U.normalize(F.col("url"))).withColumn("_in", F.col("normalized").isNotNull() & allowed)
    x = _first_of_key(x.withColumn("_good", F.col("_in") & robots), "normalized", order, F.col("_good"))
    reason = (
        F.when(F.col("normalized").isNull(), "normalize_failed")
        .when(F.col("_first") < F.col(order), "duplicate_url")
        .when(~F.col("_in"), "out_of_scope")
        .when(~F.col("_good"), "robots_disallow")
        .otherwise("queued")
    )
    x = x.withColumn("reason", reason).drop("_in", "_good", "_first")
    if cap is None:
        return x
    # the cap falls right after the cap-th accepted row: found by numbers given range by range
    x = durable(x)
    last = numbered(x.where("reason = 'queued'").select(order), order).where(F.col("_i") == cap - 1).agg(F.max(order).alias("_last"))
    x = x.crossJoin(F.broadcast(last))  # one row
    late = F.coalesce(F.col(order) > F.col("_last"), F.lit(False)) if cap else F.lit(True)
    return x.withColumn("reason", F.when(late, "max_discovered_reached").otherwise(F.col("reason"))).drop("_last")


def score(source: Column, url: Column, lastmod: Column, as_of: Column) -> Column:
    """Worth of a candidate: source, presence and freshness of its date, content path, query.

    A date that can't be read still counts as present; age is in whole days, not negative.
    """
    base = F.lit(K.OTHER_SCORE)
    for s, v in K.SOURCE_SCORES.items():
        base = F.when(source == s, v).otherwise(base)
    has = F.coalesce(lastmod, F.lit("")) != ""
    seconds = F.unix_timestamp(as_of) - F.unix_timestamp(F.try_to_timestamp(lastmod))
    age = F.greatest(F.floor(seconds / 86400), F.lit(0))
    fresh = F.when(seconds.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), K.FRESH_SCORE - F.least(F.lit(K.FRESH_SCORE), age / K.DAYS_PER_POINT)))
    path = F.lower(U.path_of(url))
    content = F.lit(False)
    for step in K.CONTENT_STEPS:
        content = content | path.contains(step)
    return base + F.when(has, fresh + K.DATED_SCORE).otherwise(0.0) + F.when(content, K.CONTENT_SCORE).otherwise(0.0) - F.when(U.query_of(url) != "", K.QUERY_SCORE).otherwise(0.0)


def candidate_reasons(df: DataFrame, order: str, hosts: Column, prefixes: list[str], as_of: Column) -> DataFrame:
    """Adds normalized, reason and score: a URL is known from its first sight on, accepted or not.

    Rules in order: normalize_failed, duplicate_url, offsite, path_prefix_filtered, low_value, robots_disallow, accepted.
    """
    robots = F.col("robots") if "robots" in df.columns else F.lit(True)
    x = df.withColumn("normalized", U.normalize(F.col("url"), "scored"))
    x = _first_of_key(x, "normalized", order, F.lit(True))
    reason = (
        F.when(F.col("normalized").isNull(), "normalize_failed")
        .when(F.col("_first") < F.col(order), "duplicate_url")
        .when(~F.coalesce(hosts, F.lit(False)), "offsite")
        .when(~U.path_allowed(F.col("normalized"), prefixes), "path_prefix_filtered")
        .when(U.is_low_value(F.col("normalized")), "low_value")
        .when(~robots, "robots_disallow")
        .otherwise("accepted")
    )
    last = F.col("lastmod") if "lastmod" in df.columns else F.lit(None).cast("string")
    x = x.withColumn("reason", reason).drop("_first")
    return x.withColumn("score", F.when(F.col("reason") == "accepted", score(F.col("source"), F.col("normalized"), last, as_of)))


def top_candidates(df: DataFrame, k: int) -> DataFrame:
    """The k best accepted candidates by score, then URL."""
    return df.where("reason = 'accepted'").orderBy(F.desc("score"), "normalized").limit(k)


def spread_sample(df: DataFrame, order: str, k: int) -> DataFrame:
    """k rows evenly over the order (row floor(i * n / k)); all rows if k is 0 or there are no more."""
    n = df.count()
    if not k or n <= k:
        return df
    return numbered(df, order).where(F.floor((F.ceil(F.col("_i") * k / n)) * n / k) == F.col("_i")).drop("_i")


def numbered(df: DataFrame, order: str) -> DataFrame:
    """Adds ``_i``: position from 0 in the order, numbered range by range and not in one task.

    Rows are range-partitioned by the order, counted by partition, and each
    partition adds the count of those before it.
    """
    ranged = df.repartitionByRange(order).withColumn("_p", F.spark_partition_id())
    ranged = durable(ranged)
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # a row per partition
    local = Window.partitionBy("_p").orderBy(order)
    return ranged.withColumn("_r", F.row_number().over(local) - 1).join(F.broadcast(before), "_p").withColumn("_i", F.col("_r") + F.col("_off")).drop("_p", "_r", "_off")


def round_robin(df: DataFrame, order: str, n: int) -> DataFrame:
    """Adds shard: position in the order modulo n."""
    return numbered(df, order).withColumn("shard", F.pmod(F.col("_i"), F.lit(n)).cast("int")).drop("_i")


def _ranked(df: DataFrame, group: list[str], order: list[str], k: int, name: str) -> DataFrame:
    """Adds the rank of a row in its group, for the first k rows of each group at least and no more than a few times as many.

    Spark cuts groups before the shuffle up to WINDOW_CUT rows; for more, each
    group is cut in CHUNKS parts first, so that no task sorts all of a hot group.
    """
    if k > WINDOW_CUT:
        part = F.pmod(F.xxhash64(*order), F.lit(CHUNKS))
        df = df.withColumn("_part", part).withColumn("_pre", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))).where(F.col("_pre") <= k).drop("_part", "_pre")
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


#: rows up to which Spark cuts the groups of a rank before the shuffle, and parts of a group beyond that
WINDOW_CUT, CHUNKS = 1000, 64


def per_group_cap(df: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    """At most k rows of each group in the order; groups are cut before the shuffle."""
    return _ranked(df, group, order, k, "_rn").where(F.col("_rn") <= k).drop("_rn")


def fair_interleave(df: DataFrame, site: str, order: str, budget: int, least: int = 4) -> DataFrame:
    """Adds turn: at most max(least, budget // sites) rows of each site, to be taken turn by turn."""
    sites = df.agg(F.count_distinct(site).alias("_sites"))
    most = max(least, budget)
    quota = F.greatest(F.lit(least), F.floor(F.lit(budget) / F.greatest(F.col("_sites"), F.lit(1))))
    return _ranked(df, [site], [order], most, "turn").where(F.col("turn") <= most).crossJoin(F.broadcast(sites)).where(F.col("turn") <= quota).drop("_sites")


def bfs(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """(url, depth): shortest distance of every URL reached from the seeds in at most max_depth steps.

    ``edges`` has from_url and to_url, ``seeds`` url.  Each level joins the new
    rows only and drops what was seen; cycles end by themselves.
    """
    edges = durable(edges.where("from_url is not null and to_url is not null").select("from_url", "to_url").distinct())
    # levels stay where they were written; only the new one is written in each round
    seen = new = durable(seeds.where("url is not null").select("url").distinct().withColumn("depth", F.lit(0)))
    for depth in range(1, max_depth + 1):
        step = edges.join(new.select(F.col("url").alias("from_url")), "from_url").select(F.col("to_url").alias("url")).distinct()
        new = durable(step.join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)))
        if new.isEmpty():
            break
        seen = seen.unionByName(new)
    return seen


def expand_sitemaps(sitemaps: DataFrame, roots: DataFrame) -> DataFrame:
    """(sitemap, kind, url) reached from the roots: children are followed once each until none is new, pages are collected.

    ``sitemaps`` has sitemap, kind (child or page), url.  A cycle ends by itself.
    """
    sitemaps = durable(sitemaps.select("sitemap", "kind", "url").distinct())
    seen = todo = durable(roots.select(F.col("url").alias("sitemap")).distinct())
    while not todo.isEmpty():
        children = sitemaps.where("kind = 'child'").join(todo, "sitemap").select(F.col("url").alias("sitemap")).distinct()
        todo = durable(children.join(seen, "sitemap", "left_anti"))
        seen = seen.unionByName(todo)
    return sitemaps.join(seen, "sitemap", "left_semi")


def with_fallback(primary: DataFrame, fallback: DataFrame, site: str) -> DataFrame:
    """The primary rows, and the fallback rows of sites that have no primary one."""
    return primary.unionByName(fallback.join(primary.select(site).distinct(), site, "left_anti"))


def link_edges(pages: DataFrame) -> DataFrame:
    """(from_url, to_url, source, depth) of the links of pages (url, depth, links); one kind for each link."""
    x = pages.select(F.col("url").alias("from_url"), (F.col("depth") + 1).alias("depth"), F.explode("links").alias("to_url"))
    kind = T.link_kind(F.col("to_url"))
    return x.withColumn("source", F.when(kind == "sitemap", "sitemap_link").when(kind == "feed", "feed").when(kind == "page", "page_link")).where("source is not null")


def one_hop(candidates: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    """Targets of the links of the first n candidates by score and URL, as candidates of source link_depth1."""
    top = top_candidates(candidates, n).select(F.col("normalized").alias("from_url"))
    return edges.join(top, "from_url").select(F.col("to_url").alias("url"), F.lit("link_depth1").alias("source")).distinct()
