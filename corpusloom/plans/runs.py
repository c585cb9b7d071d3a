"""Queries of whole runs: discovery, resuming, limits, reports, and functions over bodies that are built from the tables."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..functions import url as U
from ..operators import dedup as D
from ..operators import fetch as E
from ..operators import frontier as R
from ..operators import reports as A
from ..session import durable, folder, read_table, spread
from ..streaming import jobs as S
from . import queries as Q
from .queries import query

# --- bodies --------------------------------------------------------------------


def _escaped(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def _page() -> Column:
    """A page with navigation, an article of one paragraph for each line, links of all kinds and a footer."""
    u = F.regexp_replace(F.coalesce("url", F.lit("")), '"', "&quot;")
    u = F.regexp_replace(F.regexp_replace(u, "&(?!quot;)", "&amp;"), "<", "&lt;")
    head = [F.lit("<html><head><title>"), _escaped(F.coalesce("title", F.lit(""))), F.lit('</title><link rel="canonical" href="'), u, F.lit('"><link rel="alternate" type="application/rss+xml" href="/rss.xml"><link rel="sitemap" href="/sitemap.xml"></head>')]
    body = [F.lit("<body><nav>Home Contact</nav><script>var a = '<p>x</p>';</script><article><p>"), F.regexp_replace(_escaped(F.col("text")), "\n", "</p>\n<p>"), F.lit("</p></article><a href=\""), u, F.lit('">link</a><a href="/feed.xml">feed</a><footer>© all</footer></body></html>')]
    return F.concat(*head, *body)


def _bodies(spark, d) -> DataFrame:
    return spread(read_table(spark, d, "extracted_text").where("text is not null").select("seq", "url", "title", "text"))


@query
def main_content(spark, d):
    """Main content of pages, with all visible text where there is too little of it."""
    x = _bodies(spark, d).select("seq", H.extract(_page(), "main_content").alias("p"))
    return x.select("seq", "p.extractor", F.md5("p.text").alias("text_md5"))


@query
def extractors_compared(spark, d):
    """Pages by extractor and by whether its text holds the navigation."""
    x = _bodies(spark, d).select("seq", _page().alias("h"))
    parts = [x.select(F.lit(e).alias("asked"), H.extract(F.col("h"), e)["text"].contains("Home Contact").alias("navigation")) for e in ("main_content", "parser", "regex")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("asked", "navigation").agg(F.count("*").alias("n"))


@query
def link_modes(spark, d):
    """Link targets of pages by the parser and by pattern: pages by how many each finds."""
    x = _bodies(spark, d).where("url is not null").select(_page().alias("h"), "url")
    n = x.select(F.size(H.links_of(F.col("h"), F.col("url"))).alias("parser"), F.size(H.links_of(F.col("h"), F.col("url"), "regex")).alias("regex"))
    return n.groupBy("parser", "regex").agg(F.count("*").alias("n"))


@query
def parser_extract_text(spark, d):
    x = _bodies(spark, d).select("seq", H.extract(_page(), "parser").alias("p"))
    return x.select("seq", "p.title", F.md5("p.text").alias("text_md5"), "p.extractor")


@query
def parser_extract_links(spark, d):
    """(seq, role, url) of the links of pages, resolved against their own address."""
    x = _bodies(spark, d).where("url is not null").select("seq", H.parsed_links(_page(), F.col("url")).alias("p"))
    each = lambda role, urls: x.select("seq", F.lit(role).alias("role"), F.explode(urls).alias("url"))
    return each("link", "p.links").unionByName(each("feed", "p.feeds")).unionByName(each("sitemap", "p.sitemaps")).unionByName(x.select("seq", F.lit("canonical").alias("role"), F.col("p.canonical").alias("url")).where("url <> ''"))


@query
def hrefs_of_limited_length(spark, d):
    """The fast form of link extraction: href values of at most 60 characters."""
    return _bodies(spark, d).select("seq", F.size(T.hrefs(Q._html(), 60)).alias("n"))


@query
def xml_sniff(spark, d):
    """Bodies and types that look like XML: bodies are built by source, types are those of the manifest."""
    body = F.when(F.col("source") == "feed", "  <?xml version='1.0'?><feed/>").when(F.col("source") == "sitemap_link", "<URLSET></URLSET>").when(F.col("source") == "sitemap", F.concat(F.lit(" " * 600), F.lit("<urlset>"))).otherwise("<html><p>rss</p></html>")
    return Q._manifest(spark, d).groupBy("source", "content_type", T.looks_like_xml(body, F.col("content_type")).alias("xml")).agg(F.count("*").alias("n"))


@query
def sitemap_index_parse(spark, d):
    """Zipped sitemap indexes and page lists with all their fields; one list for each link of a sitemap."""
    x = spread(Q._links(spark, d).where("source = 'sitemap_link' and trim(to_url) <> ''").select("to_url").distinct())
    u = F.regexp_replace(F.regexp_replace("to_url", "&", "&amp;"), "<", "&lt;")
    index = F.concat(F.lit("<sitemapindex><sitemap><loc> "), u, F.lit(" </loc></sitemap><sitemap><lastmod>2025</lastmod></sitemap></sitemapindex>"))
    pages = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>'), u, F.lit("</loc><changefreq>daily</changefreq><priority>0.5</priority></url></urlset>"))
    i, p = H.parsed_sitemap(F.encode(index, "UTF-8")), H.parsed_sitemap(F.encode(pages, "UTF-8"))
    a = x.select(F.explode(i["children"]).alias("e")).select(F.lit("child").alias("kind"), "e.*")
    return a.unionByName(x.select(F.explode(p["pages"]).alias("e")).select(F.lit("page").alias("kind"), "e.*"))


@query
def charset_fast(spark, d):
    """Bodies in three encodings read by the fast form: by header, by the page's own word, by guess."""
    t = F.concat(F.lit("<meta charset=utf-16le>"), "text")
    x = _bodies(spark, d).where("length(text) > 0")
    return x.select("seq", (H.decoded_fast(F.encode("text", "UTF-8"), F.lit(None).cast("string")) == F.col("text")).alias("guessed"), (H.decoded_fast(F.encode("text", "UTF-16BE"), F.lit("text/plain; charset=UTF-16BE")) == F.col("text")).alias("by_header"), H.decoded_fast(F.encode(t, "UTF-8"), F.lit("text/html; charset=utf-8")).endswith(F.col("text")).alias("header_first"))


@query
def gzip_bodies(spark, d):
    """Zipped bodies unpacked, others as they are."""
    @F.pandas_udf("binary")
    def zipped(s: pd.Series) -> pd.Series:
        return s.map(lambda x: gzip.compress(x.encode("utf-8"), 1))

    x = _bodies(spark, d)
    return x.select("seq", F.md5(H.gunzipped(zipped("text"))).alias("unpacked"), F.md5(H.gunzipped(F.encode("text", "UTF-8"))).alias("plain"))


def _headers() -> Column:
    """Headers of a fetch, in odd spellings."""
    return F.map_from_arrays(F.array(F.lit("Content-TYPE"), F.lit("retry-After")), F.array(F.coalesce("content_type", F.lit("")), F.when(F.col("status") == 503, "120").when(F.col("status") == 429, "2.5").otherwise("soon")))


@query
def header_lookup(spark, d):
    h = _headers()
    return Q._manifest(spark, d).select("seq", T.header(h, "Content-Type").alias("type"), T.header(h, "X-None", "none").alias("absent"))


@query
def retry_delays(spark, d):
    """Seconds to wait by status: what the header says up to 30, else one second."""
    return Q._manifest(spark, d).groupBy("status", T.retry_after(T.header(_headers(), "Retry-After"), 1.0).alias("seconds")).agg(F.count("*").alias("n"))


@query
def robots_by_site(spark, d):
    """What rules of each site allow, and the sitemaps they name; a site without rules allows all."""
    host = U.host_of(F.col("url"))
    rules = F.when(host.like("www.%"), F.concat(F.lit("User-agent: *\nCrawl-delay: 5\nDisallow: /news/\nSitemap: https://"), host, F.lit("/sitemap.xml\n"))).when(host.like("blog.%"), "User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /wiki/\n")
    x = spread(Q._x(spark, d).where("url is not null").select("seq", "url", rules.alias("rules")))
    return x.select("seq", H.robots_allow("corpusloom")(F.col("rules"), F.lower("url")).alias("allowed"), F.coalesce(F.array_join(H.robots_sitemaps(F.col("rules")), " "), F.lit("")).alias("sitemaps"))


@query
def feed_expand(spark, d):
    """Entries of feeds as candidates of the feed's page, each address once over all feeds of a host."""
    x = Q.feed_parse(spark, d).select(U.host_of(F.col("from_url")).alias("host"), "url")
    return x.distinct()


@query
def single_sitemap(spark, d):
    """The pages that the sitemap links of each page name, at most 50 children of one page followed."""
    x = Q._links(spark, d).where("source = 'sitemap_link'").select("from_url", U.normalize(F.col("to_url")).alias("url")).where("from_url is not null and url is not null").distinct()
    return R.per_group_cap(x, ["from_url"], ["url"], 50)


# --- discovery and resuming ------------------------------------------------------


@query
def discovery_reasons(spark, d):
    """Reasons for every record, duplicates and known sites too; known are the scopes of seeds without a sample."""
    seen = read_table(spark, d, "site_seeds").where("sample_url is null").select("scope").distinct()
    return Q.discovery(Q._x(spark, d), "url", "seq", seen).select("seq", "reason")


@query
def discovery_summary(spark, d):
    """Counters of a discovery and its yields; nothing found gives 0."""
    seen = read_table(spark, d, "site_seeds").where("sample_url is null").select("scope").distinct()
    x = Q.discovery(Q._x(spark, d), "url", "seq", seen)
    c = lambda *r: F.count_if(F.col("reason").isin(*r))
    s = x.agg(F.count("*").alias("records"), c("missing_target_url").alias("missing"), c("invalid_site").alias("invalid"), c("duplicate_site", "already_known", "accepted").alias("candidates"), c("duplicate_site").alias("duplicates"), c("already_known").alias("known"), c("accepted").alias("sites"))
    return s.select("*", A.ratio(F.col("candidates"), F.col("records")).alias("candidate_rate"), A.ratio(F.col("sites"), F.col("candidates")).alias("site_rate"), A.ratio(F.col("sites"), F.col("records")).alias("yield"))


@query
def site_dedup_runs(spark, d):
    """The first record of each site that no earlier run knows."""
    seen = read_table(spark, d, "site_seeds").where("sample_url is null").select("scope").distinct()
    s = U.site_of(F.col("url"))
    x = Q._x(spark, d).select("seq", s["scope"].alias("scope"), s["seed_url"].alias("seed_url")).where("scope is not null")
    return D.first_by(D.not_in_registry(x, seen, "scope"), ["scope"], ["seq"])


@query
def target_dedup(spark, d):
    """One target for each registrable domain of the seeds, the first by host."""
    x = Q._seeds(spark, d).select(U.registrable_domain(F.col("host")).alias("domain"), "host", "seed_url")
    return D.first_by(x, ["domain"], ["host"])


@query
def ordered_sources(spark, d):
    """The sources of the pages of each host in order of first sight, each once."""
    x = Q._x(spark, d).select(U.host_of(F.col("url")).alias("host"), "source", "seq").where("source is not null").groupBy("host", "source").agg(F.min("seq").alias("at"))
    return x.groupBy("host").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "source"))), lambda s: s["source"]), ",").alias("sources"))  # the kinds of sources


@query
def resume_state(spark, d):
    """What a resumed run knows: URLs that were fetched, and hashes of contents that were kept."""
    m = Q._manifest(spark, d)
    urls = m.select(U.normalize(F.col("url")).alias("key")).where("key is not null").distinct().withColumn("kind", F.lit("url"))
    return urls.unionByName(m.where("ok and content_hash is not null and content_hash <> ''").select(F.col("content_hash").alias("key")).distinct().withColumn("kind", F.lit("content")))


@query
def resumable_sites(spark, d):
    """Sites with fetches and without a finished summary."""
    done = Q._completed(spark, d).where("complete").select("host")
    hosts = Q._manifest(spark, d).select(U.host_of(F.col("url")).alias("host")).distinct()
    return Q._seeds(spark, d).select("host", "seed_url").join(hosts, "host", "left_semi").join(done, "host", "left_anti")


@query
def active_refill(spark, d):
    """The next 25 unfinished sites in order of their first fetch."""
    first = Q._manifest(spark, d).groupBy(U.host_of(F.col("url")).alias("host")).agg(F.min("seq").alias("first"))
    done = Q._completed(spark, d).where("complete").select("host")
    return first.join(done, "host", "left_anti").orderBy("first").limit(25)


@query
def processed_archives(spark, d):
    """Archives still to be read: those that no run read to the end; an archive with a failed seed counts as unread."""
    seeds = Q._seeds(spark, d).where("source_wet_path is not null")
    whole = seeds.groupBy("source_wet_path").agg(F.max(F.col("sample_url").isNull().cast("int")).alias("failed")).where("failed = 0").select("source_wet_path")
    return D.not_in_registry(seeds.select("source_wet_path").distinct(), whole, "source_wet_path")


@query
def refilter_after_hop(spark, d):
    """Candidates together with the targets one hop on, filtered again: what is known from the first round is a duplicate."""
    first = Q._candidates(spark, d)
    hop = R.one_hop(first, Q._edges(spark, d), 50).where("url is not null").select("url", "source").withColumn("lastmod", F.lit(None).cast("string"))
    last = first.agg(F.max("seq")).first()[0] or 0
    hop = R.numbered(hop, "url").withColumn("seq", F.col("_i") + 1 + last).drop("_i")
    both = first.select("seq", "url", "source", "lastmod").unionByName(hop.select("seq", "url", "source", "lastmod"))
    again = R.candidate_reasons(both, "seq", U.host_of(F.col("normalized")).like("%.example"), [], F.lit(Q.AS_OF).cast("timestamp"))
    return again.groupBy("source", "reason").agg(F.count("*").alias("n"))


# --- limits ------------------------------------------------------------------------


@query
def sorted_urls(spark, d):
    """The pages in order of their address, with their position."""
    x = Q._x(spark, d).select(U.normalize(F.col("url")).alias("url")).where("url is not null").distinct()
    return R.numbered(x, "url").select(F.col("_i").alias("position"), "url")


@query
def prefix_sample(spark, d):
    """The first ten seeds by host: the plain form of a sample."""
    return R.numbered(Q._seeds(spark, d).select("host"), "host").where(F.col("_i") < 10).select("host")


@query
def first_outlinks(spark, d):
    """At most 3 outlinks of each page in order of address."""
    x = Q._links(spark, d).where("source = 'page_link' and from_url is not null and to_url is not null").select("from_url", "to_url").distinct()
    return R.per_group_cap(x, ["from_url"], ["to_url"], 3)


@query
def per_domain_cap(spark, d):
    """At most 1,200 index records of each domain in order of arrival, and whether the domain was capped."""
    x = Q._index(spark, d).select("domain", "seq")
    kept = R.per_group_cap(x, ["domain"], ["seq"], 1200).groupBy("domain").agg(F.count("*").alias("kept"), F.max("seq").alias("last"))
    every = x.groupBy("domain").agg(F.count("*").alias("n"))
    return every.join(kept, every["domain"].eqNullSafe(kept["domain"])).select(every["domain"], "kept", "last", (F.col("n") > F.col("kept")).alias("capped"))


# --- reports -----------------------------------------------------------------------


@query
def xml_result_classes(spark, d):
    """Results of fetched sitemaps and feeds: sitemap_not_xml, feed_not_xml, http_N, fetch_error or ok."""
    m = Q._manifest(spark, d).where("source in ('sitemap', 'sitemap_link', 'feed')")
    c = E.xml_class(F.col("source"), F.col("status"), T.looks_like_xml(F.lit(None).cast("string"), F.col("content_type")))
    return m.groupBy("source", c.alias("result")).agg(F.count("*").alias("n"))


@query
def manifest_errors(spark, d):
    """Fetches, good ones and how often each error reason stands among all fetches."""
    m = Q._manifest(spark, d).withColumn("reason", E.error_reason(F.col("status"), F.col("error")))
    total = m.agg(F.count("*").alias("fetched"), F.count_if(F.coalesce("ok", F.lit(False))).alias("ok"))
    by = m.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    return by.crossJoin(F.broadcast(total)).select("reason", "n", "fetched", "ok", A.ratio(F.col("n"), F.col("fetched")).alias("share"))  # one row of totals


@query
def verification_report(spark, d):
    """The overall report of the verification: sites, verified ones, and at most 100 hosts of those that aren't."""
    v = Q.site_verify(spark, d)
    bad = v.where("not verified").select("host").orderBy("host").limit(100).agg(F.array_join(F.array_sort(F.collect_list("host")), " ").alias("incomplete"))
    return v.agg(F.count("*").alias("sites"), F.count_if("verified").alias("verified"), F.coalesce(F.every("verified"), F.lit(True)).alias("all_verified"), F.sum("fetched").alias("fetched")).crossJoin(bad)  # two single rows


@query
def run_status(spark, d):
    """Sites that are finished, running (fetched within 30 days of the last fetch) or stalled, with their totals."""
    host = U.host_of(F.col("url"))
    last = Q._manifest(spark, d).groupBy(host.alias("host")).agg(F.max("fetched_at").alias("at"))
    newest = last.agg(F.max("at").alias("newest"))
    age = (F.unix_micros(F.col("newest").cast("timestamp")) - F.unix_micros(F.col("at").cast("timestamp"))) / 86_400e6
    s = Q._completed(spark, d).join(last, "host").crossJoin(F.broadcast(newest))  # one row
    status = F.when(F.col("complete"), "finished").when(F.coalesce(age <= 30, F.lit(False)), "running").otherwise("stalled")
    return s.groupBy(status.alias("status")).agg(F.count("*").alias("sites"), F.sum("fetched").alias("fetched"), F.sum("ok").alias("ok"), F.sum("unique_text").alias("unique_text"))


@query
def first_numbers(spark, d):
    """By source the sum of the first number there is: text length, bytes, or 0."""
    return Q._manifest(spark, d).groupBy("source").agg(F.sum(A.first_numeric(F.col("text_length"), F.col("bytes"))).alias("total"))


@query
def probe_summary(spark, d):
    """What a look at each host shows: sitemaps, feeds and pages that its links name, and whether its seed is secure."""
    x = Q._links(spark, d).withColumn("host", U.host_of(F.col("to_url"))).groupBy("host").agg(F.count_if(F.col("source") == "sitemap_link").alias("sitemaps"), F.count_if(F.col("source") == "feed").alias("feeds"), F.count_if(F.col("source") == "page_link").alias("pages"))
    s = Q._seeds(spark, d).select("host", F.col("seed_url").startswith("https").alias("secure"))
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return s.join(x, "host", "left").select("host", "secure", n("sitemaps"), n("feeds"), n("pages"), (F.coalesce("sitemaps", F.lit(0)) + F.coalesce("feeds", F.lit(0)) > 0).alias("discoverable"))


@query
def progress_snapshots(spark, d):
    """A snapshot after every 500 fetches: fetches, good ones and duplicates so far."""
    m = R.numbered(Q._manifest(spark, d).select("seq", F.coalesce("ok", F.lit(False)).alias("ok"), F.coalesce("content_duplicate", F.lit(False)).alias("dup")), "seq")
    step = m.groupBy(F.floor(F.col("_i") / 500).alias("step")).agg(F.count("*").alias("n"), F.count_if("ok").alias("ok"), F.count_if("dup").alias("dup"))
    w = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)  # a row for each 500 fetches
    return step.select("step", F.sum("n").over(w).alias("fetched"), F.sum("ok").over(w).alias("ok"), F.sum("dup").over(w).alias("duplicates"))


@query
def approximate_hosts(spark, d):
    """Different link targets, exactly and by a sketch within 5 %; the sketch is the form for very many."""
    x = Q._links(spark, d).agg(F.count_distinct("to_url").alias("exact"), F.approx_count_distinct("to_url", 0.01).alias("about"))
    return x.select("exact", (F.abs(F.col("about") - F.col("exact")) <= 0.05 * F.col("exact")).alias("close"))


# --- increments and streams ----------------------------------------------------------


@query
def revisit_classes(spark, d):
    """Fetches against validators: not modified ones keep what was extracted before."""
    m = Q._manifest(spark, d).select("seq", "url_hash", "status")
    r = S.revisit(m, Q.readers.latest_cache(read_table(spark, d, "http_cache")))
    kept = F.when(F.col("status") == 304, F.when(F.col("conditional"), "kept").otherwise("unasked")).when(F.col("changed"), "extract").otherwise("none")
    return r.groupBy("conditional", kept.alias("action")).agg(F.count("*").alias("n"))


@query
def merge_with_offsets(spark, d):
    """Growing files merged three times: the second time only what was added, the third time a file that was cut begins anew."""
    source, target, state = folder(spark, "growing"), folder(spark, "merged"), folder(spark, "offsets")
    x = Q._events(spark, d).select(F.format_string("%08d", "event_id").alias("value"), (F.col("user_id") % 2).alias("file"))
    one = x.where("file = 0").coalesce(1).sortWithinPartitions("value")
    two = x.where("file = 1").coalesce(1).sortWithinPartitions("value")
    files = [durable(one.select("value")), durable(two.select("value"))]
    S.write_one(files[0].limit(100), source, "a.txt")
    S.merge_lines(spark, source, target, state, "1")
    S.write_one(files[0], source, "a.txt")
    S.write_one(files[1], source, "b.txt")
    S.merge_lines(spark, source, target, state, "2")
    S.write_one(files[1].limit(10), source, "b.txt")
    S.merge_lines(spark, source, target, state, "3")
    return spark.read.text(target).groupBy("value").agg(F.count("*").alias("times"))


@query
def stream_resumed(spark, d):
    """A stream that is stopped after the first files and goes on at its checkpoint: every event once."""
    source, at, out = folder(spark, "incoming"), folder(spark, "at"), folder(spark, "resumed")
    x = Q._events(spark, d).select("event_id", "event_type")
    x.where("event_id % 2 = 0").write.json(source + "/part=0")
    S.merge_files(spark, source, out, "event_id long, event_type string", at)
    x.where("event_id % 2 = 1").write.json(source + "/part=1")
    S.merge_files(spark, source, out, "event_id long, event_type string", at)
    return spark.read.schema("event_id long, event_type string").json(out).groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query
def stream_snapshots(spark, d):
    """A snapshot of the totals after each batch of at most one file; the last one holds all events."""
    t = S.run_to_table(S.event_stream(spark, f"{d}/events.parquet", 1).groupBy("event_type").agg(F.count("*").alias("n")), "snapshots")
    return t.select("event_type", "n")


@query
def stream_seen_in_window(spark, d):
    """The first event of each key within a watermark, so that the state stays bounded; all events are within it here."""
    t = S.run_to_table(S.seen_once(Q._stream(spark, d).select("ts", "user_id", "event_type"), ["user_id", "event_type"], "3650 days"), "seen_window", "append")
    return t.select("user_id", "event_type")
