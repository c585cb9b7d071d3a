"""Queries of the crawl operators over the tables of a folder.

Each takes (spark, folder) and runs over its whole tables.  Where a table has no
arrival order of its own, the order is named in the query.  Page bodies and XML
don't come with the tables; those queries build them from texts and links by
expressions that the checking SQL repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import html as H
from ..functions import text as T
from ..functions import url as U
from ..operators import dedup as D
from ..operators import fetch as E
from ..operators import frontier as R
from ..operators import reports as A
from ..session import durable, read_table, spread
from ..sources import readers
from ..streaming import jobs as S

QUERIES: dict = {}
AS_OF = "2025-06-01 00:00:00"


def query(f):
    QUERIES[f.__name__] = f
    return f


def _x(spark, d):
    return read_table(spark, d, "extracted_text")


def _manifest(spark, d):
    """The manifest without rows delivered twice."""
    return read_table(spark, d, "manifest").dropDuplicates(["seq"])


def _links(spark, d):
    return read_table(spark, d, "links")


def _index(spark, d):
    return read_table(spark, d, "index_records")


def _seeds(spark, d):
    return read_table(spark, d, "site_seeds")


def _html() -> Column:
    """A page body around title and text."""
    return F.concat(
        F.lit("<html><head><title>"), F.coalesce("title", F.lit("")), F.lit("</title><script>var a = '<p>x</p>';</script></head><body><p>"),
        F.regexp_replace("text", "\n", "</p>\n<p>"), F.lit('</p><a href="'), F.coalesce("url", F.lit("")), F.lit('">link</a><a href="/feed.xml">feed</a></body></html>'),
    )


# --- URL functions -----------------------------------------------------------


@query
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return _x(spark, d).select("seq", U.normalize(u).alias("strict"), U.normalize(u, "scored").alias("scored"), U.normalize(u, "fast").alias("fast"))


@query
def url_normalize_links(spark, d):
    return _links(spark, d).select("to_url", U.normalize(F.col("to_url")).alias("normalized")).distinct()


@query
def url_resolve(spark, d):
    """Link targets against the page they stand on, by the Arrow form."""
    x = spread(_links(spark, d).select("from_url", "to_url").distinct())
    return x.select("from_url", "to_url", U.normalize_udf()(F.col("to_url"), F.col("from_url")).alias("normalized"))


@query
def url_hashes(spark, d):
    n = U.normalize(F.col("url"))
    return _x(spark, d).select("seq", U.url_hash(n).alias("strict_hash"), U.url_hash(U.normalize(F.col("url"), "fast"), "fast").alias("fast_hash"))


@query
def url_root_host(spark, d):
    return _x(spark, d).select("seq", U.root_url(F.col("url")).alias("root"), U.host_of(F.col("url")).alias("host"))


@query
def url_in_scope(spark, d):
    """Link targets under a domain of the seeds, by a join on host suffixes."""
    domains = _seeds(spark, d).select(F.col("registrable_domain").alias("suffix")).distinct()
    hosts = _links(spark, d).select(U.host_of(F.col("to_url")).alias("host")).where("host <> ''").distinct()
    hit = hosts.select("host", F.explode(U.host_suffixes(F.col("host"))).alias("suffix")).join(domains, "suffix").select("host").distinct().withColumn("in_scope", F.lit(True))
    return hosts.join(hit, "host", "left").select("host", F.coalesce("in_scope", F.lit(False)).alias("in_scope"))


@query
def url_same_site(spark, d):
    """Links that stay on their host."""
    return _links(spark, d).groupBy((U.host_of(F.col("from_url")) == U.host_of(F.col("to_url"))).alias("same_site")).agg(F.count("*").alias("n"))


@query
def url_low_value(spark, d):
    return _x(spark, d).select("seq", F.coalesce(U.is_low_value(F.col("url")), F.lit(False)).alias("low_value"), U.path_allowed(F.col("url"), ["/docs", "/guide/", "/wiki"]).alias("allowed"))


@query
def registrable_domain(spark, d):
    return _seeds(spark, d).select("host", U.registrable_domain(F.col("host")).alias("domain"), U.is_english_host(F.col("host")).alias("english"))


@query
def site_from_url(spark, d):
    s = U.site_of(F.col("url"))
    return _x(spark, d).select("seq", s["reason"].alias("reason"), s["seed_url"].alias("seed_url"), s["scope"].alias("scope"), s["host"].alias("host"))


@query
def discovery_reject_counts(spark, d):
    s = U.site_of(F.col("to_url"))
    return _links(spark, d).groupBy(F.coalesce(s["reason"], F.lit("candidate_sites")).alias("reason")).agg(F.count("*").alias("n"))


def discovery(df: DataFrame, url: str, order: str, seen: DataFrame) -> DataFrame:
    """Adds scope and reason: missing_target_url, invalid_site, already_known, duplicate_site or accepted, in order of arrival.

    ``seen`` has the scopes that earlier runs know; NULL order comes last.
    """
    site = U.site_of(F.col(url))
    x = df.withColumn("scope", site["scope"]).withColumn("_why", site["reason"])
    known = seen.select("scope").where("scope is not null").distinct().withColumn("_known", F.lit(True))
    first = x.where("scope is not null").groupBy("scope").agg(F.min(order).alias("_first"))
    x = x.join(known, "scope", "left").join(first, "scope", "left")
    reason = F.when(F.col("_why").isNotNull(), F.col("_why")).when(F.col("_known"), "already_known").when(F.coalesce(F.col(order) > F.col("_first"), F.lit(False)), "duplicate_site").otherwise("accepted")
    return x.withColumn("reason", reason).drop("_why", "_known", "_first")


@query
def tld_top50(spark, d):
    host = U.host_of(F.col("to_url"))
    return A.top_counts(_links(spark, d).select(host.alias("h")).where("h like '%.%'").select(F.element_at(F.split("h", r"\."), -1).alias("tld")), "tld", 50)


@query
def static_ext_filter(spark, d):
    path = U.path_of(F.col("to_url"))
    return _links(spark, d).groupBy(F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)).alias("ext"), U.is_static(path).alias("is_static")).agg(F.count("*").alias("n"))


@query
def tracking_params(spark, d):
    """Query parameters of links by name, and whether they only track."""
    p = F.explode(F.split(U.query_of(F.col("to_url")), "&"))
    k = _links(spark, d).select(p.alias("p")).where("p <> ''").select(F.lower(F.substring_index("p", "=", 1)).alias("name"))
    return k.groupBy("name", U._tracking(F.col("name"), "strict").alias("tracking")).agg(F.count("*").alias("n"))


@query
def sitemap_feed_candidates(spark, d):
    seed = F.col("seed_url")
    s = _seeds(spark, d).select("seed_url", F.explode(U.usual_urls(seed, K.SITEMAP_PATHS)).alias("candidate")).withColumn("kind", F.lit("sitemap"))
    f = _seeds(spark, d).select("seed_url", F.explode(U.usual_urls(seed, K.FEED_PATHS)).alias("candidate")).withColumn("kind", F.lit("feed"))
    return s.unionByName(f)


@query
def names_and_buckets(spark, d):
    x = _seeds(spark, d)
    return x.select("host", U.safe_name(F.col("scope")).alias("safe"), U.absolute_path(F.col("source_wet_path")).alias("wet_url"), U.stable_bucket(F.col("host"), 16).alias("bucket"), U.artifact_name(F.lit(7), F.col("seed_url")).alias("artifact"))


# --- texts -------------------------------------------------------------------


@query
def content_hashes(spark, d):
    t = F.col("text")
    return _x(spark, d).select("seq", T.content_hash(t).alias("strict_hash"), T.content_hash(t, "fast").alias("fast_hash"))


@query
def stored_hash_check(spark, d):
    """How stored content hashes agree with the text: strict, fast or neither."""
    stored, t = F.col("content_hash"), F.col("text")
    kind = F.when(stored.isNull(), "none").when(stored == T.content_hash(t, "fast"), "fast").when(stored == T.content_hash(t), "strict").when(stored == F.sha2(t, 256), "raw_sha256").otherwise("other")
    return _x(spark, d).groupBy("extractor", kind.alias("kind")).agg(F.count("*").alias("n"))


@query
def clean_texts(spark, d):
    c = T.clean_text(F.col("text"))
    return _x(spark, d).select("seq", F.md5(c).alias("clean_md5"), F.length(c).alias("clean_length"), F.md5(T.preview(F.col("text"))).alias("preview_md5"))


@query
def token_shingles(spark, d):
    t = T.tokens(T.normalized_for_hash(F.col("text")))
    return read_table(spark, d, "documents").where("text is not null").select("doc_id", F.size(t).alias("tokens"), F.md5(F.array_join(T.shingles(t), "|")).alias("shingles_md5"))


@query
def regex_extract_text(spark, d):
    h = _html()
    return spread(_x(spark, d).where("text is not null").select("seq", "title", "text", "url")).select("seq", T.title_of_html(h).alias("title"), F.md5(T.text_of_html(h)).alias("text_md5"))


@query
def regex_extract_links(spark, d):
    x = spread(_x(spark, d).where("text is not null").select("seq", "title", "text", "url")).select("seq", F.explode(T.hrefs(_html())).alias("href"))
    n = U.normalize(F.col("href"))
    return x.select("seq", "href", n.alias("normalized"), T.link_kind(n).alias("kind")).where("normalized is not null")


@query
def challenge_flags(spark, d):
    return _x(spark, d).select("seq", T.is_challenge(F.col("text")).alias("challenge")).where("challenge")


@query
def charset_decode(spark, d):
    """Texts written in UTF-8 and UTF-16 and read back by header."""
    x = spread(_x(spark, d).where("text is not null").select("seq", "text"))
    return x.select("seq", (H.decoded(F.encode("text", "UTF-8"), F.lit("text/html; charset=utf-8")) == F.col("text")).alias("utf8"), (H.decoded(F.encode("text", "UTF-16LE"), F.lit("text/html; charset=utf-16-le")) == F.col("text")).alias("utf16"))


def _sitemaps(spark, d) -> DataFrame:
    """XML of one sitemap per host, with the host's page links."""
    link = F.concat(F.lit("<url><loc>"), F.regexp_replace("to_url", "&", "&amp;"), F.lit("</loc><lastmod>2025-01-02</lastmod></url>"))
    x = _links(spark, d).where("source = 'sitemap_link'").withColumn("host", U.host_of(F.col("to_url"))).where("host <> ''").select("host", "to_url").distinct()
    parts = x.withColumn("part", F.pmod(F.xxhash64("to_url"), F.lit(64)))
    xml = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.array_sort(F.collect_list(link)), ""), F.lit("</urlset>"))
    return parts.groupBy("host", "part").agg(xml.alias("xml"))


@query
def sitemap_parse(spark, d):
    s = _sitemaps(spark, d).select("host", H.parsed_sitemap(F.encode("xml", "UTF-8")).alias("p"))
    return s.select("host", F.explode("p.pages").alias("e")).select("host", "e.url", "e.lastmod")


@query
def feed_parse(spark, d):
    link = F.concat(F.lit('<entry><link href="'), F.regexp_replace(F.regexp_replace("to_url", "&", "&amp;"), "<", "&lt;"), F.lit('"/></entry>'))
    # each address once for a page, in feeds of a share of its addresses
    x = _links(spark, d).where("source = 'feed' and to_url is not null and to_url <> ''").select("from_url", "to_url").distinct()
    x = x.select("from_url", link.alias("e"), F.pmod(F.xxhash64("to_url"), F.lit(64)).alias("part"))
    xml = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), F.array_join(F.collect_list("e"), ""), F.lit("</feed>"))
    g = x.groupBy("from_url", "part").agg(xml.alias("xml"))
    return g.select("from_url", F.explode(H.parsed_feed(F.encode("xml", "UTF-8"), F.col("from_url"))).alias("url")).distinct()


@query
def robots_allowed(spark, d):
    """Rows whose URL the rules of its site allow; every site here forbids /archive/ and /news/ to all."""
    x = spread(_x(spark, d).where("url is not null").select("seq", "url"))
    return x.select("seq", H.robots_allow("corpusloom")(F.lit("User-agent: *\nDisallow: /archive/\nDisallow: /news/\n"), F.lower("url")).alias("allowed"))


# --- duplicates --------------------------------------------------------------


@query
def url_dedup(spark, d):
    x = _x(spark, d).select("seq", U.normalize(F.col("url")).alias("normalized")).where("normalized is not null")
    return D.first_by(x, ["normalized"], ["seq"])


@query
def content_duplicates(spark, d):
    x = _x(spark, d).where("text is not null").select("seq", T.content_hash(F.col("text")).alias("hash"))
    return D.duplicate_flag(x, "hash", "seq").select("seq", "content_duplicate")


@query
def doc_exact_dedup(spark, d):
    x = read_table(spark, d, "documents").where("text is not null").select("doc_id", T.content_hash(F.col("text")).alias("hash"))
    return x.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query
def site_dedup(spark, d):
    s = U.site_of(F.col("url"))
    x = _x(spark, d).select("seq", s["scope"].alias("scope"), s["seed_url"].alias("seed_url")).where("scope is not null")
    return D.first_by(x, ["scope"], ["seq"])


@query
def seed_merge(spark, d):
    return D.first_by(_seeds(spark, d).select("scope", "seed_url", "host"), ["scope"], ["host"])


@query
def seen_antijoin(spark, d):
    """Index records whose URL was never fetched."""
    x = _index(spark, d).select("seq", U.normalize(F.col("url")).alias("normalized")).where("normalized is not null")
    return D.not_in_registry(x, _manifest(spark, d).select(U.normalize(F.col("url")).alias("normalized")), "normalized").select("seq", "normalized")


@query
def index_two_key_dedup(spark, d):
    x = R.index_reason(_index(spark, d)).where("reason is null").select("domain", "seq", F.col("normalized").alias("url"), "digest")
    return D.two_key_greedy(x).select("domain", "seq", "url")


@query
def index_filter_reasons(spark, d):
    return R.index_reason(_index(spark, d)).groupBy(F.coalesce("reason", F.lit("checked")).alias("reason")).agg(F.count("*").alias("n"))


@query
def seeder_summary(spark, d):
    """Index records, skipped ones by reason, and exported ones."""
    x = R.index_reason(_index(spark, d))
    kept = D.two_key_greedy(x.where("reason is null").select("domain", "seq", F.col("normalized").alias("url"), "digest"))
    base = x.agg(F.count("*").alias("index_records"), F.count_if(F.col("reason") == "skipped_non_html").alias("non_html"), F.count_if(F.col("reason") == "skipped_normalize_failed").alias("failed"))
    return base.crossJoin(kept.agg(F.count("*").alias("exported"), F.count_distinct("domain").alias("domains")))  # two single rows


@query
def cross_shard_dedup(spark, d):
    """Texts of all batches by stored hash, blank hashes left out, the first arrival kept."""
    x = _x(spark, d).where("content_hash is not null and content_hash <> ''").select("seq", "batch_id", "content_hash")
    return D.first_by(x, ["content_hash"], ["seq"])


@query
def resume_frontier(spark, d):
    """URLs that were discovered and have no manifest row."""
    found = _links(spark, d).select(U.normalize(F.col("to_url")).alias("normalized")).where("normalized is not null").distinct()
    return D.not_in_registry(found, _manifest(spark, d).select(U.normalize(F.col("url")).alias("normalized")), "normalized")


@query
def ordered_distinct(spark, d):
    """Sources of the links to each host in order of name, each once."""
    x = _links(spark, d).withColumn("host", U.host_of(F.col("to_url"))).where("host <> ''").groupBy("host").agg(F.array_sort(F.collect_set("source")).alias("s"))
    return x.select("host", F.array_join(F.array_distinct("s"), ",").alias("sources"))


def _hashed(spark, d) -> DataFrame:
    return D.simhash_md5(spread(read_table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text")


@query
def simhash_md5(spark, d):
    return _hashed(spark, d)


@query
def simhash_blake2b(spark, d):
    x = spread(read_table(spark, d, "documents").select("doc_id", T.tokens(T.normalized_for_hash(F.coalesce("text", F.lit("")))).alias("w")))
    return x.select("doc_id", D.simhash_blake(F.col("w")).alias("simhash"))


@query
def near_dup_pairs(spark, d):
    """Pairs between the first documents of different hashes."""
    reps = durable(_hashed(spark, d)).groupBy("simhash").agg(F.min("doc_id").alias("doc_id"))
    return D.near_pairs(reps, "doc_id").select("a", "b", F.col("distance").cast("int").alias("distance"))


@query
def near_dup_resolve(spark, d):
    hashed = durable(_hashed(spark, d))
    exact = read_table(spark, d, "documents").select("doc_id", T.content_hash(F.coalesce("text", F.lit("")), "scored").alias("exact"))
    return D.near_resolve(durable(hashed.join(exact, "doc_id")), "doc_id")


# --- filters and limits ------------------------------------------------------


def _allowed(spark, d) -> DataFrame:
    """Index records with whether their host belongs to a seed."""
    hosts = _seeds(spark, d).select(F.col("host").alias("h")).distinct().withColumn("allowed", F.lit(True))
    x = _index(spark, d).withColumn("h", U.host_of(F.col("url")))
    return x.join(hosts, "h", "left").withColumn("allowed", F.coalesce("allowed", F.lit(False))).drop("h")


@query
def enqueue_reasons(spark, d):
    return R.enqueue_reasons(_allowed(spark, d), "seq", F.col("allowed")).select("seq", "reason")


@query
def enqueue_capped(spark, d):
    return R.enqueue_reasons(_allowed(spark, d), "seq", F.col("allowed"), 500).groupBy("reason").agg(F.count("*").alias("n"))


def _candidates(spark, d) -> DataFrame:
    source = F.when(F.col("source") == "feed_item", "feed").when(F.col("source") == "sitemap_link_page", "sitemap").when(F.col("depth") == 1, "link_depth1").when(F.col("source") == "seed", "homepage_link").otherwise("other")
    x = _x(spark, d).select("seq", "url", source.alias("source"), F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("lastmod"))
    return R.candidate_reasons(x, "seq", U.host_of(F.col("normalized")).like("%.example"), [], F.lit(AS_OF).cast("timestamp"))


@query
def candidate_reasons(spark, d):
    return _candidates(spark, d).groupBy("reason").agg(F.count("*").alias("n"))


@query
def candidate_scores(spark, d):
    return _candidates(spark, d).where("reason = 'accepted'").select("seq", "normalized", F.bround("score", 6).alias("score"))


@query
def candidate_topk(spark, d):
    return R.top_candidates(_candidates(spark, d), 1000).select("seq", "normalized", F.bround("score", 6).alias("score"))


@query
def fetch_classes(spark, d):
    m = _manifest(spark, d)
    ch = E.error_reason(F.col("status"), F.col("error")) == "challenge_page"
    return m.select(
        "seq", E.turbo_class(F.col("status"), F.col("content_type"), ch).alias("turbo"), E.batch_class(F.col("status"), F.col("content_type")).alias("batch"),
        E.fast_class(F.col("status"), F.col("content_type"), F.col("bytes"), ch, F.col("text_length"), 50_000).alias("fast"), E.is_retryable(F.col("status"), F.col("error")).alias("retryable"),
    )


@query
def error_top10(spark, d):
    x = _manifest(spark, d).select(E.error_reason(F.col("status"), F.col("error")).alias("reason")).where("reason is not null")
    return A.top_counts(x, "reason", 10)


@query
def depth_filter(spark, d):
    return _manifest(spark, d).groupBy((F.coalesce("depth", F.lit(0)) <= 3).alias("within")).agg(F.count("*").alias("n"))


def _sites(spark, d) -> DataFrame:
    """One row for each host of the manifest with the counts of its run."""
    m = _manifest(spark, d).withColumn("host", U.host_of(F.col("url"))).withColumn("reason", E.error_reason(F.col("status"), F.col("error")))
    fetched = m.groupBy("host").agg(
        F.count("*").alias("fetched"), F.count_if(F.coalesce("ok", F.lit(False))).alias("ok"), F.count_if(F.coalesce("content_duplicate", F.lit(False))).alias("duplicates"),
        F.count_if(F.coalesce("not_modified", F.lit(False))).alias("not_modified"), F.count_if(E.is_blocking(F.col("reason"))).alias("blocking"),
        (F.count_distinct("content_hash")).alias("unique_text"),
    )
    open_ = resume_frontier(spark, d).select(U.host_of(F.col("normalized")).alias("host")).groupBy("host").agg(F.count("*").alias("open"))
    return fetched.join(open_, "host", "left").withColumn("open", F.coalesce("open", F.lit(0)))


def _completed(spark, d) -> DataFrame:
    """The sites with why each stopped and whether it is complete."""
    why = E.stopped_reason(F.col("open"), F.col("fetched"), F.col("fetched") + F.col("open"), 200, 400)
    s = _sites(spark, d).withColumn("stopped_reason", why)
    return s.withColumn("complete", (F.col("open") == 0) & (F.col("stopped_reason") == "frontier_exhausted"))


@query
def site_completion(spark, d):
    return _completed(spark, d).select("host", "fetched", "open", "stopped_reason", "complete")


@query
def likely_blocked(spark, d):
    s = _sites(spark, d)
    return s.select("host", "unique_text", "fetched", "blocking", E.likely_blocked(F.col("unique_text"), F.col("fetched"), F.col("blocking")).alias("blocked"))


@query
def unfinished_sites(spark, d):
    """Seeds whose site isn't complete."""
    return D.not_in_registry(_seeds(spark, d).select("host", "seed_url"), site_completion(spark, d).where("complete"), "host")


@query
def spread_sample(spark, d):
    return R.spread_sample(_seeds(spark, d).select("host"), "host", 10)


@query
def round_robin_shards(spark, d):
    return R.round_robin(_seeds(spark, d).select("host"), "host", 8)


@query
def per_site_cap(spark, d):
    x = _x(spark, d).select("seq", U.host_of(F.col("url")).alias("host"))
    return R.per_group_cap(x, ["host"], ["seq"], 20)


@query
def fair_interleave(spark, d):
    x = _x(spark, d).select("seq", U.host_of(F.col("url")).alias("host"))
    return R.fair_interleave(x, "host", "seq", 512)


# --- reports -----------------------------------------------------------------


@query
def manifest_rollup(spark, d):
    m = _manifest(spark, d)
    return m.agg(F.count("*").alias("fetched"), F.count_if(F.coalesce("ok", F.lit(False))).alias("ok"), F.count_if(F.coalesce("content_duplicate", F.lit(False))).alias("duplicates"), F.count_if(F.coalesce("not_modified", F.lit(False))).alias("not_modified"), F.count_if(F.coalesce("error", F.lit("")) != "").alias("errors"))


def _counts(spark, d) -> DataFrame:
    m = _manifest(spark, d).agg(
        F.count("*").alias("manifest_records"), F.count_if(F.coalesce("ok", F.lit(False))).alias("ok_records"), F.count_if(F.coalesce("ok", F.lit(False)) & (F.coalesce("text_length", F.lit(0)) > 0)).alias("non_empty"),
        F.count_if(F.coalesce("content_duplicate", F.lit(False))).alias("duplicates"), A.duplicates_left(None, "url_hash").alias("url_left"), F.count(F.nullif("url_hash", F.lit(""))).alias("url_hashes"),
    )
    x = _x(spark, d).agg(F.count("*").alias("extracted"), F.count_if(F.coalesce("text_length", F.lit(0)) > 0).alias("extracted_non_empty"), A.duplicates_left(None, "content_hash").alias("content_left"), F.count(F.nullif("content_hash", F.lit(""))).alias("content_hashes"))
    e = _links(spark, d).agg(F.count("*").alias("link_edges"))
    return m.crossJoin(x).crossJoin(e)  # three single rows


@query
def quality_counts(spark, d):
    return _counts(spark, d)


@query
def quality_rates(spark, d):
    c, r = _counts(spark, d), A.ratio
    k = F.col
    return c.select(
        r(k("ok_records"), k("manifest_records")).alias("fetch_success_rate"), r(k("non_empty"), k("ok_records")).alias("non_empty_rate"), r(k("extracted"), k("ok_records")).alias("keep_rate"), r(k("duplicates"), k("ok_records")).alias("duplicate_rate"),
        r(k("extracted_non_empty"), k("extracted")).alias("output_non_empty_rate"), r(k("url_left"), k("url_hashes")).alias("url_left_rate"), r(k("content_left"), k("content_hashes")).alias("content_left_rate"),
    )


@query
def text_length_stats(spark, d):
    return A.length_stats(_x(spark, d).select("text_length"), "text_length")


@query
def manifest_length_stats(spark, d):
    return A.length_stats(_manifest(spark, d).where("ok").select("text_length"), "text_length")


@query
def percentile_floor(spark, d):
    return A.nearest_rank(_sites(spark, d).select("fetched"), "fetched", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, "floor")


@query
def histograms(spark, d):
    return A.histograms(_manifest(spark, d).select(F.col("status").cast("string").alias("status"), "content_type", "error", "source", F.col("depth").cast("string").alias("depth"), "extractor"), ["status", "content_type", "error", "source", "depth", "extractor"])


@query
def sample_titles(spark, d):
    return _x(spark, d).select("seq", "url", "title").orderBy("seq").limit(20)


@query
def sample_errors(spark, d):
    return _manifest(spark, d).where("error is not null and error <> ''").select("seq", "url", "error").orderBy("seq").limit(20)


@query
def site_verify(spark, d):
    """Completeness of each seed's site and the overall report columns."""
    s = site_completion(spark, d)
    return _seeds(spark, d).select("host").join(s, "host", "left").select("host", F.coalesce("fetched", F.lit(0)).alias("fetched"), F.coalesce("complete", F.lit(False)).alias("verified"))


@query
def run_rollup(spark, d):
    return _completed(spark, d).agg(
        F.count("*").alias("sites"), F.count_if("complete").alias("complete"), F.count_if(F.col("stopped_reason") != "frontier_exhausted").alias("capped"),
        F.sum("fetched").alias("fetched"), F.sum("ok").alias("ok"), F.sum("unique_text").alias("unique_text"), F.sum("open").alias("open"),
    )


@query
def cross_site_summary(spark, d):
    """Sites by completion with the first non-zero of three record counts."""
    records = A.first_truthy(F.col("unique_text"), F.col("ok"), F.col("fetched"))
    return _completed(spark, d).groupBy("complete").agg(F.count("*").alias("sites"), F.sum(records).alias("records"))


@query
def pages_per_site(spark, d):
    s = _sites(spark, d)
    return s.agg(F.bround(F.avg("unique_text"), 4).alias("mean_all"), F.coalesce(F.bround(F.avg(F.when(F.col("unique_text") > 0, F.col("unique_text"))), 4), F.lit(0.0)).alias("mean_nonzero"), F.coalesce(F.median(F.when(F.col("unique_text") > 0, F.col("unique_text"))), F.lit(0.0)).alias("median_nonzero"))


@query
def scale_estimate(spark, d):
    s = U.site_of(F.col("url"))["scope"]
    m = _manifest(spark, d).select(s.alias("scope")).agg(F.count("*").alias("records"), F.count("scope").alias("candidates"), (F.count("scope") - F.count_distinct("scope")).alias("duplicates"))
    p = _sites(spark, d).agg(F.count("*").alias("sites"), F.count_if(F.col("unique_text") > 0).alias("nonzero_sites"), F.sum("unique_text").alias("pages"))
    w = _seeds(spark, d).agg(F.count_distinct("source_wet_path").alias("ok_files"))
    return A.scale_estimate(m.crossJoin(p).crossJoin(w).withColumn("rate", F.lit(100.0)))  # three single rows


@query
def sitemap_reports(spark, d):
    return _manifest(spark, d).where("source in ('sitemap', 'sitemap_link', 'feed')").groupBy("source", F.coalesce("ok", F.lit(False)).alias("ok")).agg(F.count("*").alias("n"), F.coalesce(F.sum("sitemap_child_count"), F.lit(0)).alias("children"), F.coalesce(F.sum("sitemap_page_count"), F.lit(0)).alias("pages"), F.coalesce(F.sum("feed_item_count"), F.lit(0)).alias("items"))


def _events(spark, d) -> DataFrame:
    return read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query
def rate_per_hour(spark, d):
    """Hourly snapshots of the events: rows so far, change and rate against the hour before, ratio to a target."""
    h = _events(spark, d).groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"))
    return A.rates(h, "hour", "n", 0.25).select(F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"), "n", "delta", "per_minute", "target_ratio")


@query
def peak_rate(spark, d):
    h = _events(spark, d).groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"))
    return A.rates(h, "hour", "n", 1.0).agg(F.max(F.col("delta") / 3600.0).alias("peak"))


@query
def engine_stats(spark, d):
    """Events in windows of ten minutes by type."""
    return _events(spark, d).groupBy(F.window("ts", "10 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), F.bround(F.sum("value"), 2).alias("total")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", "total")


@query
def progress_running(spark, d):
    """Running totals by day and type."""
    from pyspark.sql import Window

    day = _events(spark, d).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))
    w = Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return day.withColumn("so_far", F.sum("n").over(w))


@query
def worker_rollup(spark, d):
    x = _events(spark, d).withColumn("worker", F.pmod("user_id", F.lit(8)).cast("int"))
    return A.latest_then_sum(x, "worker", ["ts", "event_id"], ["event_id", "value"])


# --- graphs ------------------------------------------------------------------


@query
def link_kinds(spark, d):
    n = U.normalize(F.col("to_url"))
    return _links(spark, d).groupBy("source", T.link_kind(n).alias("kind")).agg(F.count("*").alias("n"))


def _edges(spark, d) -> DataFrame:
    return _links(spark, d).select(U.normalize(F.col("from_url")).alias("from_url"), U.normalize(F.col("to_url")).alias("to_url"))


def _starts(spark, d) -> DataFrame:
    """The seed pages of the manifest."""
    return _manifest(spark, d).where("source = 'seed'").select(U.normalize(F.col("url")).alias("url")).where("url is not null").distinct()


@query
def bfs_depth(spark, d):
    return R.bfs(_edges(spark, d), _starts(spark, d), 4)


@query
def link_edges(spark, d):
    pages = _links(spark, d).where("from_url is not null").groupBy("from_url").agg(F.collect_set(U.normalize(F.col("to_url"))).alias("links")).select(F.col("from_url").alias("url"), F.lit(0).alias("depth"), "links")
    return R.link_edges(pages)


@query
def one_hop_expand(spark, d):
    hop = R.one_hop(_candidates(spark, d), _edges(spark, d), 50)
    return hop


@query
def sitemap_expand(spark, d):
    """From the seed pages: links of source sitemap_link are followed, page links are collected, over any number of rounds."""
    f, t = U.normalize(F.col("from_url")), U.normalize(F.col("to_url"))
    s = _links(spark, d).where("source <> 'feed'").select(f.alias("sitemap"), F.when(F.col("source") == "sitemap_link", "child").otherwise("page").alias("kind"), t.alias("url")).where("sitemap is not null and url is not null").distinct()
    return R.expand_sitemaps(s, _starts(spark, d))


@query
def candidate_assembly(spark, d):
    """Sitemap, feed and page candidates of each host; page links only where a host has no sitemap."""
    x = _links(spark, d).select(U.host_of(F.col("to_url")).alias("host"), U.normalize(F.col("to_url")).alias("url"), "source").where("url is not null").distinct()
    return R.with_fallback(x.where("source = 'sitemap_link'"), x.where("source = 'page_link'"), "host").unionByName(x.where("source = 'feed'"))


# --- incremental and streaming -----------------------------------------------


@query
def http_cache_latest(spark, d):
    return readers.latest_cache(read_table(spark, d, "http_cache"))


@query
def http_cache_upsert(spark, d):
    """The cache merged in two batches: the same as the latest rows of all."""
    c = read_table(spark, d, "http_cache").where("url_hash is not null")
    mid = c.agg(F.percentile_approx("seq", 0.5)).first()[0] or 0
    return S.upsert_latest(S.upsert_latest(None, c.where(F.col("seq") <= mid), "url_hash", "seq"), c.where(F.col("seq") > mid), "url_hash", "seq")


@query
def conditional_revisit(spark, d):
    m = _manifest(spark, d).select("seq", "url_hash", "status")
    r = S.revisit(m, readers.latest_cache(read_table(spark, d, "http_cache")))
    return r.groupBy("conditional", "changed").agg(F.count("*").alias("n"))


def _stream(spark, d) -> DataFrame:
    return S.event_stream(spark, f"{d}/events.parquet")


@query
def stream_tumbling(spark, d):
    t = S.run_to_table(S.tumbling_rates(_stream(spark, d)), "stream_tumbling_out")
    return t.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.bround("total", 2).alias("total"))


@query
def stream_sessions(spark, d):
    t = S.run_to_table(S.sessions(_stream(spark, d)), "stream_sessions_out", "complete")
    return t.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))


@query
def stream_seen(spark, d):
    return S.run_to_table(S.seen_once(_stream(spark, d).select("user_id", "event_type"), ["user_id", "event_type"]), "stream_seen_out", "append").select("user_id", "event_type")


from . import files, runs  # noqa: E402, F401  (they add their queries)
