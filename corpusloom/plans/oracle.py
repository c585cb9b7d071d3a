"""SQL that checks the crawl queries, for DuckDB over the same tables."""

from __future__ import annotations

from ..functions import constants as K

SQL: dict[str, str] = {}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(xs) -> str:
    return "(" + ", ".join(q(x) for x in xs) + ")"


_ANATOMY = q(r"^(https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$")


def strip(u: str) -> str:
    return f"regexp_replace({u}, '^\\s+|\\s+$', '', 'g')"


def part(u: str, i: int) -> str:
    return f"regexp_extract({strip(u)}, {_ANATOMY}, {i}, 'is')"


def host(u: str) -> str:
    return f"coalesce(lower(regexp_extract({part(u, 2)}, '^(?:.*@)?(\\[[^\\]]*\\]|[^:]*)', 1)), '')"


def static(path: str, scored: bool = False) -> str:
    ends = [e for e in K.STATIC_EXTENSIONS if not scored or e not in K.NOT_STATIC_WHEN_SCORED]
    return f"regexp_matches(lower({path}), '\\.({'|'.join(ends)})$')"


def norm(u: str, profile: str = "strict") -> str:
    """The canonical form of URLs without characters that need quoting."""
    key = "split_part(p, '=', 1)"
    val = "(CASE WHEN contains(p, '=') THEN substr(p, strpos(p, '=') + 1) ELSE '' END)"
    tracked = f"lower({key}) IN {listed(K.TRACKING_KEYS)} OR " + " OR ".join(f"starts_with({key if profile == 'fast' else f'lower({key})'}, {q(x)})" for x in K.TRACKING_PREFIXES)
    keep = f"p <> '' AND NOT ({tracked})" + ("" if profile == "fast" else f" AND {val} <> ''")
    pairs = f"list_filter(string_split({part(u, 4)}, '&'), lambda p: {keep})"
    if profile != "fast":
        pairs = f"list_sort({pairs})"
    path = f"regexp_replace({part(u, 3)}, ';[^/]*$', '')"
    port = f"regexp_extract({part(u, 2)}, ':(\\d+)$', 1)"
    default = f"(lower({part(u, 1)}) = 'http' AND {port} = '80') OR (lower({part(u, 1)}) = 'https' AND {port} = '443')"
    query = f"array_to_string({pairs}, '&')"
    return (
        f"(CASE WHEN {host(u)} = '' OR {u} IS NULL OR {static(path, profile == 'scored')} THEN NULL ELSE lower({part(u, 1)}) || '://' || {host(u)} || (CASE WHEN {port} = '' OR {default} THEN '' ELSE ':' || {port} END)"
        f" || (CASE WHEN {path} = '' THEN '/' ELSE regexp_replace({path}, '/+', '/', 'g') END) || (CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END) END)"
    )


def domain(h: str) -> str:
    n = f"len(string_split({h}, '.'))"
    tail = lambda k: f"array_to_string(list_slice(string_split({h}, '.'), -{k}, NULL), '.')"
    tail = lambda k: f"regexp_extract({h}, '([^.]*(?:\\.[^.]*){{{k - 1}}})$', 1)"  # noqa: E731, F811
    return f"(CASE WHEN {n} <= 2 THEN {h} WHEN {tail(2)} IN {listed(K.TWO_LABEL_SUFFIXES)} THEN {tail(3)} ELSE {tail(2)} END)"


def english(h: str) -> str:
    return f"(regexp_matches({h}, '^[a-z0-9-]+(\\.[a-z0-9-]+)*$') AND NOT regexp_matches({h}, '(^|\\.)(-|xn--)|-(\\.|$)') AND regexp_extract({h}, '([^.]*)$', 1) IN {listed(K.ENGLISH_TLDS)})"


def site(u: str, field: str) -> str:
    h = f"regexp_replace({host(u)}, '^\\.+|\\.+$', '', 'g')"
    spam = " OR ".join(f"contains({h}, {q(t)})" for t in K.SPAM_TERMS)
    reason = f"(CASE WHEN coalesce({u}, '') = '' THEN 'missing_target_url' WHEN {h} = '' OR NOT contains({h}, '.') OR regexp_matches({h}, '^\\d+\\.\\d+\\.\\d+\\.\\d+$') OR NOT regexp_matches(split_part({h}, '.', 1), '[a-z]') OR {spam} THEN 'invalid_site' END)"
    if field == "reason":
        return reason
    value = {
        "host": h, "scope": domain(h),
        "seed_url": f"(CASE WHEN lower({part(u, 1)}) = 'https' THEN 'https' ELSE 'http' END) || '://' || (CASE WHEN starts_with({h}, 'www.') AND {h} <> 'www.' || {domain(h)} THEN substr({h}, 5) ELSE {h} END) || '/'",
    }[field]
    return f"(CASE WHEN {reason} IS NULL THEN {value} END)"


def kind(u: str) -> str:
    l = f"lower({u})"
    return f"(CASE WHEN {u} IS NULL OR contains({l}, '/_static/') THEN NULL WHEN contains({l}, 'sitemap') THEN 'sitemap' WHEN contains({l}, 'rss') OR contains({l}, 'atom') OR ends_with({l}, '/feed') OR ends_with({l}, '/feed.xml') THEN 'feed' WHEN ends_with({l}, '.xml') THEN NULL ELSE 'page' END)"


_S = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}\x{000B}]"


def stripped(s: str) -> str:
    return f"regexp_replace({s}, '^{_S}+|{_S}+$', '', 'g')"


def strict_hash(t: str) -> str:
    return f"sha256({stripped(f'''regexp_replace(lower({t}), '{_S}+', ' ', 'g')''')})"


def clean(t: str) -> str:
    return stripped(f"""regexp_replace(regexp_replace({t}, '[ \\t\\r\\f\\x0B]+', ' ', 'g'), '\\n{_S}*\\n+', chr(10), 'g')""")


def for_hash(t: str) -> str:
    return stripped(f"""regexp_replace(regexp_replace(regexp_replace(lower({t}), 'https?://[^\\s\\x{{00A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{0085}}\\x{{000B}}]+', ' ', 'g'), '[^\\p{{L}}\\p{{N}}_\\s]+', ' ', 'g'), '{_S}+', ' ', 'g')""")


_M = "(SELECT DISTINCT ON (seq) * FROM manifest)"
_TOK = f"list_filter(regexp_extract_all(lower({for_hash('text')}), '[\\p{{L}}\\p{{N}}_]+'), lambda t: length(t) >= 3)"
_SHINGLES = "(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) ELSE w END)"

# --- URL functions
SQL["url_normalize"] = f"SELECT seq, {norm('url')} AS strict, {norm('url', 'scored')} AS scored, {norm('url', 'fast')} AS fast FROM extracted_text"
SQL["url_normalize_links"] = f"SELECT DISTINCT to_url, {norm('to_url')} AS normalized FROM links"
SQL["url_hashes"] = f"SELECT seq, sha256({norm('url')}) AS strict_hash, substr(md5({norm('url', 'fast')}), 1, 16) AS fast_hash FROM extracted_text"
SQL["url_root_host"] = f"SELECT seq, CASE WHEN {part('url', 2)} <> '' THEN lower({part('url', 1)}) || '://' || {part('url', 2)} || '/' END AS root, {host('url')} AS host FROM extracted_text"
SQL["url_in_scope"] = f"""WITH h AS (SELECT DISTINCT {host('to_url')} AS host FROM links), k AS (SELECT * FROM h WHERE host <> '')
SELECT host, EXISTS (SELECT 1 FROM site_seeds s WHERE k.host = s.registrable_domain OR ends_with(k.host, '.' || s.registrable_domain)) AS in_scope FROM k"""
SQL["url_same_site"] = f"SELECT {host('from_url')} = {host('to_url')} AS same_site, count(*) AS n FROM links GROUP BY 1"
_PATH, _QUERY = f"coalesce({part('url', 3)}, '')", f"coalesce({part('url', 4)}, '')"
_PATH1 = f"(CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END)"
_LOW = f"(list_has_any(regexp_split_to_array(lower({{p}}), '[^a-z0-9]+'), {[*K.LOW_VALUE_PARTS]}) OR len(list_filter(string_split({{q}}, '&'), lambda p: p <> '')) > 3 OR regexp_matches(lower({{p}}), '/(page|p)/\\d{{{{4,}}}}(/|$)'))"
SQL["url_low_value"] = f"SELECT seq, coalesce({_LOW.format(p=_PATH, q=_QUERY)}, false) AS low_value, " + " OR ".join(f"({_PATH1} = {q(p)} OR starts_with({_PATH1}, {q(p.rstrip('/') + '/')}))" for p in ("/docs", "/guide/", "/wiki")) + " AS allowed FROM extracted_text"
SQL["registrable_domain"] = f"SELECT host, {domain('host')} AS domain, {english('host')} AS english FROM site_seeds"
SQL["site_from_url"] = "SELECT seq, " + ", ".join(f"{site('url', f)} AS {f}" for f in ("reason", "seed_url", "scope", "host")) + " FROM extracted_text"
SQL["discovery_reject_counts"] = f"SELECT coalesce({site('to_url', 'reason')}, 'candidate_sites') AS reason, count(*) AS n FROM links GROUP BY 1"
SQL["tld_top50"] = f"SELECT regexp_extract(h, '([^.]*)$', 1) AS tld, count(*) AS n FROM (SELECT {host('to_url')} AS h FROM links) WHERE contains(h, '.') GROUP BY 1 ORDER BY n DESC, tld LIMIT 50"
_LP = f"coalesce({part('to_url', 3)}, '')"
SQL["static_ext_filter"] = f"SELECT lower(regexp_extract({_LP}, '\\.([A-Za-z0-9]+)$', 1)) AS ext, {static(_LP)} AS is_static, count(*) AS n FROM links GROUP BY 1, 2"
SQL["tracking_params"] = f"""SELECT name, name IN {listed(K.TRACKING_KEYS)} OR {' OR '.join(f"starts_with(name, {q(p)})" for p in K.TRACKING_PREFIXES)} AS tracking, count(*) AS n
FROM (SELECT lower(split_part(p, '=', 1)) AS name FROM (SELECT unnest(string_split({part('to_url', 4)}, '&')) AS p FROM links) WHERE p <> '') GROUP BY 1, 2"""
SQL["sitemap_feed_candidates"] = f"""SELECT seed_url, rtrim(seed_url, '/') || p AS candidate, 'sitemap' AS kind FROM site_seeds, (SELECT unnest({[*K.SITEMAP_PATHS]}) AS p)
UNION ALL SELECT seed_url, rtrim(seed_url, '/') || p, 'feed' FROM site_seeds, (SELECT unnest({[*K.FEED_PATHS]}) AS p)"""
SQL["names_and_buckets"] = f"""SELECT host, coalesce(nullif(trim(regexp_replace(scope, '[^A-Za-z0-9_.-]+', '_', 'g'), '_'), ''), 'site') AS safe,
CASE WHEN regexp_matches(source_wet_path, '^https?://') THEN source_wet_path ELSE '{K.DATA_ROOT}' || ltrim(source_wet_path, '/') END AS wet_url,
(('0x' || substr(md5(lower(host)), 1, 15))::BIGINT % 16)::BIGINT AS bucket, '000007_' || {host('seed_url')} || '_home_' || substr(sha1(seed_url), 1, 12) || '.html' AS artifact FROM site_seeds"""

# --- texts
SQL["content_hashes"] = f"SELECT seq, {strict_hash('text')} AS strict_hash, md5(text) AS fast_hash FROM extracted_text"
SQL["stored_hash_check"] = f"""SELECT extractor, CASE WHEN content_hash IS NULL THEN 'none' WHEN content_hash = md5(text) THEN 'fast' WHEN content_hash = {strict_hash('text')} THEN 'strict' WHEN content_hash = sha256(text) THEN 'raw_sha256' ELSE 'other' END AS kind, count(*) AS n
FROM extracted_text GROUP BY 1, 2"""
SQL["clean_texts"] = f"SELECT seq, md5(c) AS clean_md5, length(c)::INT AS clean_length, md5(substr(text, 1, 1000)) AS preview_md5 FROM (SELECT seq, text, {clean('text')} AS c FROM extracted_text)"
SQL["token_shingles"] = f"SELECT doc_id, len(w)::INT AS tokens, md5(array_to_string({_SHINGLES}, '|')) AS shingles_md5 FROM (SELECT doc_id, {_TOK} AS w FROM documents WHERE text IS NOT NULL)"
_HTML = """'<html><head><title>' || coalesce(title, '') || '</title><script>var a = ''<p>x</p>'';</script></head><body><p>' || replace(text, chr(10), '</p>' || chr(10) || '<p>') || '</p><a href="' || coalesce(url, '') || '">link</a><a href="/feed.xml">feed</a></body></html>'"""


def unescape(s: str) -> str:
    for name, c in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("apos", "''"), ("nbsp", " "), ("middot", "·"), ("copy", "©"), ("mdash", "—"), ("ndash", "–"), ("hellip", "…"), ("amp", "&")):
        s = f"replace({s}, '&{name};', '{c}')"
    return s


_HID = "|".join(f"<{t}[^>]*>.*?</{t}>" for t in ("script", "style", "noscript", "svg", "canvas", "template"))
_NOHID = f"regexp_replace(h, '{_HID}', ' ', 'gis')"
_BLOCKS = f"regexp_replace({_NOHID}, '</(p|div|section|article|li|tr|h[1-6]|br)>\\s*', chr(10), 'gi')"
_TITLE = stripped(unescape("regexp_replace(regexp_extract(h, '<title[^>]*>(.*?)</title>', 1, 'is'), '<[^>]+>', ' ', 'gs')"))
SQL["regex_extract_text"] = f"SELECT seq, {_TITLE} AS title, md5({clean(unescape(f'''regexp_replace({_BLOCKS}, '<[^>]+>', ' ', 'gs')'''))}) AS text_md5 FROM (SELECT seq, {_HTML} AS h FROM extracted_text WHERE text IS NOT NULL)"
SQL["regex_extract_links"] = f"""SELECT seq, href, {norm('href')} AS normalized, {kind(norm('href'))} AS kind FROM (SELECT seq, unnest(regexp_extract_all(h, '\\bhref\\s*=\\s*["'']([^"''#\\s>]+)["'']', 1, 'i')) AS href FROM (SELECT seq, {_HTML} AS h FROM extracted_text WHERE text IS NOT NULL)) WHERE {norm('href')} IS NOT NULL"""
SQL["challenge_flags"] = "SELECT seq, true AS challenge FROM extracted_text WHERE " + " OR ".join(f"contains(lower(substr(text, 1, 4096)), {q(m)})" for m in K.CHALLENGE_MARKERS)
SQL["charset_decode"] = "SELECT seq, true AS utf8, true AS utf16 FROM extracted_text WHERE text IS NOT NULL"
SQL["robots_allowed"] = f"SELECT seq, NOT (starts_with({_PATH}, '/archive/') OR starts_with({_PATH}, '/news/')) AS allowed FROM extracted_text WHERE url IS NOT NULL"
SQL["sitemap_parse"] = f"SELECT DISTINCT {host('to_url')} AS host, trim(to_url) AS url, '2025-01-02' AS lastmod FROM links WHERE source = 'sitemap_link' AND {host('to_url')} <> ''"

# --- duplicates
SQL["url_dedup"] = f"SELECT min(seq) AS seq, normalized FROM (SELECT seq, {norm('url')} AS normalized FROM extracted_text) WHERE normalized IS NOT NULL GROUP BY normalized"
SQL["content_duplicates"] = f"SELECT seq, seq > min(seq) OVER (PARTITION BY h) AS content_duplicate FROM (SELECT seq, {strict_hash('text')} AS h FROM extracted_text WHERE text IS NOT NULL)"
SQL["doc_exact_dedup"] = f"SELECT h AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM (SELECT doc_id, {strict_hash('text')} AS h FROM documents WHERE text IS NOT NULL) GROUP BY h"
SQL["site_dedup"] = f"SELECT min(seq) AS seq, scope, arg_min(seed_url, seq) AS seed_url FROM (SELECT seq, {site('url', 'scope')} AS scope, {site('url', 'seed_url')} AS seed_url FROM extracted_text) WHERE scope IS NOT NULL GROUP BY scope"
SQL["seed_merge"] = "SELECT scope, arg_min(seed_url, host) AS seed_url, min(host) AS host FROM site_seeds GROUP BY scope"
SQL["seen_antijoin"] = f"SELECT seq, normalized FROM (SELECT seq, {norm('url')} AS normalized FROM index_records) i WHERE normalized IS NOT NULL AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT {norm('url')} AS m FROM manifest) WHERE m = normalized)"
_IDX = f"CASE WHEN coalesce(mime, '') <> '' AND NOT contains(lower(mime), 'html') THEN 'skipped_non_html' WHEN {norm('url')} IS NULL THEN 'skipped_normalize_failed' END"
SQL["index_filter_reasons"] = f"SELECT coalesce({_IDX}, 'checked') AS reason, count(*) AS n FROM index_records GROUP BY 1"
SQL["cross_shard_dedup"] = "SELECT min(seq) AS seq, arg_min(batch_id, seq) AS batch_id, content_hash FROM extracted_text WHERE content_hash <> '' GROUP BY content_hash"
_FRONTIER = f"SELECT DISTINCT {norm('to_url')} AS normalized FROM links WHERE {norm('to_url')} IS NOT NULL AND {norm('to_url')} NOT IN (SELECT {norm('url')} FROM manifest WHERE {norm('url')} IS NOT NULL)"
SQL["resume_frontier"] = _FRONTIER
SQL["ordered_distinct"] = f"SELECT host, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM (SELECT {host('to_url')} AS host, source FROM links) WHERE host <> '' GROUP BY host"
_VOTES = ", ".join(f"sum(CASE WHEN (h >> {b}) & 1 = 1 THEN 1 ELSE -1 END) >= 0 AS b{b}" for b in range(64))
_HEX = " || ".join("substr('0123456789abcdef', 1 + " + " + ".join(f"(b{4 * k + j})::INT * {1 << j}" for j in range(4)) + ", 1)" for k in range(15, -1, -1))
_SIM = f"""WITH w AS (SELECT doc_id, {_TOK.replace('lower(text)', "lower(coalesce(text, ''))")} AS w FROM documents), f AS (SELECT doc_id, unnest({_SHINGLES}) AS f FROM w),
v AS (SELECT doc_id, {_VOTES} FROM (SELECT doc_id, ('0x' || substr(md5(f), 1, 16))::UBIGINT AS h FROM f) GROUP BY doc_id),
s AS (SELECT d.doc_id, coalesce({_HEX}, repeat('f', 16)) AS simhash FROM documents d LEFT JOIN v ON v.doc_id = d.doc_id)"""
SQL["simhash_md5"] = _SIM + " SELECT doc_id, simhash FROM s"
SQL["near_dup_pairs"] = _SIM + """, r AS (SELECT simhash, min(doc_id) AS doc_id, ('0x' || simhash)::UBIGINT AS n FROM s GROUP BY simhash),
b AS (SELECT doc_id, n, i, (n >> (16 * i)) & 65535 AS band FROM r, (SELECT unnest([0, 1, 2, 3]) AS i))
SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, bit_count(xor(x.n, y.n))::INT AS distance FROM b x JOIN b y ON x.i = y.i AND x.band = y.band AND x.doc_id < y.doc_id WHERE bit_count(xor(x.n, y.n)) <= 4"""

# --- filters and limits
_ENQ = f"""WITH a AS (SELECT seq, {norm('url')} AS n, {host('url')} IN (SELECT host FROM site_seeds) AS allowed FROM index_records),
r AS (SELECT seq, CASE WHEN n IS NULL THEN 'normalize_failed' WHEN min(CASE WHEN allowed THEN seq END) OVER (PARTITION BY n) < seq THEN 'duplicate_url' WHEN NOT allowed THEN 'out_of_scope' ELSE 'queued' END AS reason FROM a)"""
SQL["enqueue_reasons"] = _ENQ + " SELECT seq, reason FROM r"
SQL["enqueue_capped"] = _ENQ + ", c AS (SELECT seq, reason, coalesce(sum((reason = 'queued')::INT) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r) SELECT CASE WHEN before >= 500 THEN 'max_discovered_reached' ELSE reason END AS reason, count(*) AS n FROM c GROUP BY 1"
_NP, _NQ = f"coalesce({part('n', 3)}, '')", f"coalesce({part('n', 4)}, '')"
_CAND = f"""WITH a AS (SELECT seq, {norm('url', 'scored')} AS n, CASE WHEN source = 'feed_item' THEN 'feed' WHEN source = 'sitemap_link_page' THEN 'sitemap' WHEN depth = 1 THEN 'link_depth1' WHEN source = 'seed' THEN 'homepage_link' ELSE 'other' END AS source, date_trunc('second', fetched_at) AS lm FROM extracted_text),
r AS (SELECT *, CASE WHEN n IS NULL THEN 'normalize_failed' WHEN min(seq) OVER (PARTITION BY n) < seq THEN 'duplicate_url' WHEN NOT ends_with({host('n')}, '.example') THEN 'offsite' WHEN {_LOW.format(p=_NP, q=_NQ)} THEN 'low_value' ELSE 'accepted' END AS reason FROM a),
s AS (SELECT seq, n AS normalized, round_even(CASE source WHEN 'feed' THEN 100 WHEN 'sitemap' THEN 80 WHEN 'link_depth1' THEN 50 WHEN 'homepage_link' THEN 40 ELSE 10 END
  + CASE WHEN lm IS NULL THEN 0 ELSE 10 + greatest(0, 30 - least(30, greatest(0, floor((epoch(TIMESTAMP '2025-06-01 00:00:00') - epoch(lm)) / 86400)) / 7)) END
  + CASE WHEN regexp_matches(lower({_NP}), '/(docs|reference|tutorial|guide|article|wiki|publication)/') THEN 15 ELSE 0 END - CASE WHEN {_NQ} <> '' THEN 10 ELSE 0 END, 6)::DOUBLE AS score FROM r WHERE reason = 'accepted')"""
SQL["candidate_reasons"] = _CAND + " SELECT reason, count(*) AS n FROM r GROUP BY reason"
SQL["candidate_scores"] = _CAND + " SELECT seq, normalized, score FROM s"
SQL["candidate_topk"] = _CAND + " SELECT seq, normalized, score FROM s ORDER BY score DESC, normalized LIMIT 1000"
_ERR = "(CASE WHEN regexp_extract(error, '(?:^|http_|HTTP Error )(\\d{3})\\b', 1) <> '' THEN 'http_' || regexp_extract(error, '(?:^|http_|HTTP Error )(\\d{3})\\b', 1) ELSE coalesce(nullif(regexp_extract(error, '^(\\w+)\\(', 1), ''), nullif(error, '')) END)"
_HT = "coalesce(contains(lower(content_type), 'html'), false)"
SQL["fetch_classes"] = f"""SELECT seq, CASE WHEN status IS NULL THEN 'fetch_error' WHEN status = 304 THEN 'not_modified' WHEN status <> 200 THEN 'http_' || status WHEN NOT {_HT} THEN 'non_html' WHEN coalesce({_ERR} = 'challenge_page', false) THEN 'challenge_page' ELSE 'ok' END AS turbo,
CASE WHEN coalesce(status <> 200, true) OR NOT {_HT} THEN 'non_html_or_non_200' ELSE 'ok' END AS batch,
CASE WHEN status IS NULL THEN 'fetch_error' WHEN status <> 200 THEN status::VARCHAR WHEN NOT {_HT} THEN 'non_html' WHEN coalesce(bytes > 50000, false) THEN 'too_large' WHEN coalesce({_ERR} = 'challenge_page', false) THEN 'challenge_page' WHEN coalesce(text_length, 0) <= 50 THEN 'empty_content' ELSE 'ok' END AS fast,
(status IS NULL OR status >= 400) AND NOT coalesce(status = 304 OR (status >= 400 AND status < 500 AND status <> 429), false) AND NOT coalesce(contains(lower(error), 'too large') OR error = 'too_large', false) AS retryable FROM {_M}"""
SQL["error_top10"] = f"SELECT reason, count(*) AS n FROM (SELECT {_ERR} AS reason FROM {_M}) WHERE reason IS NOT NULL GROUP BY reason ORDER BY n DESC, reason LIMIT 10"
SQL["depth_filter"] = f"SELECT coalesce(depth, 0) <= 3 AS within, count(*) AS n FROM {_M} GROUP BY 1"
_SITES = f"""WITH m AS (SELECT *, {host('url')} AS host, {_ERR} AS reason FROM {_M}), o AS (SELECT {host('normalized')} AS host, count(*) AS open FROM ({_FRONTIER}) GROUP BY 1),
s AS (SELECT m.host, count(*) AS fetched, count(*) FILTER (ok) AS ok, count(*) FILTER (reason IN {listed(K.BLOCKING_ERRORS)}) AS blocking, count(DISTINCT content_hash) AS unique_text, coalesce(any_value(o.open), 0) AS open FROM m LEFT JOIN o ON o.host = m.host GROUP BY m.host),
c AS (SELECT *, CASE WHEN open > 0 AND fetched >= 200 THEN 'max_pages_reached' WHEN open > 0 AND fetched + open >= 400 THEN 'max_discovered_reached' ELSE 'frontier_exhausted' END AS stopped_reason FROM s)"""
_COMPLETE = "(open = 0 AND stopped_reason = 'frontier_exhausted')"
SQL["site_completion"] = _SITES + f" SELECT host, fetched, open, stopped_reason, {_COMPLETE} AS complete FROM c"
SQL["likely_blocked"] = _SITES + " SELECT host, unique_text, fetched, blocking, unique_text = 0 AND fetched > 0 AND blocking >= greatest(1, fetched * 0.5) AS blocked FROM s"
SQL["unfinished_sites"] = _SITES + f" SELECT host, seed_url FROM site_seeds WHERE host NOT IN (SELECT host FROM c WHERE {_COMPLETE})"
SQL["spread_sample"] = "WITH h AS (SELECT host, row_number() OVER (ORDER BY host) - 1 AS i, count(*) OVER () AS n FROM site_seeds) SELECT host FROM h WHERE n <= 10 OR i IN (SELECT floor(k * (SELECT count(*) FROM site_seeds) / 10.0) FROM range(10) t(k))"
SQL["round_robin_shards"] = "SELECT host, ((row_number() OVER (ORDER BY host) - 1) % 8)::INT AS shard FROM site_seeds"
_XH = f"SELECT seq, {host('url')} AS host FROM extracted_text"
SQL["per_site_cap"] = f"SELECT seq, host FROM ({_XH}) QUALIFY row_number() OVER (PARTITION BY host ORDER BY seq) <= 20"
SQL["fair_interleave"] = f"SELECT seq, host, turn::INT AS turn FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY seq) AS turn, (SELECT count(DISTINCT host) FROM ({_XH})) AS k FROM ({_XH})) WHERE turn <= greatest(4, 512 // greatest(k, 1))"

# --- reports
_RATIO = lambda a, b: f"(CASE WHEN coalesce({b}, 0) = 0 THEN 0 ELSE round_even({a}::DOUBLE / {b}, 4) END)::DOUBLE"
SQL["manifest_rollup"] = f"SELECT count(*) AS fetched, count(*) FILTER (ok) AS ok, count(*) FILTER (content_duplicate) AS duplicates, count(*) FILTER (not_modified) AS not_modified, count(*) FILTER (error <> '') AS errors FROM {_M}"
_COUNTS = f"""WITH a AS (SELECT count(*) AS manifest_records, count(*) FILTER (ok) AS ok_records, count(*) FILTER (ok AND text_length > 0) AS non_empty, count(*) FILTER (content_duplicate) AS duplicates, count(nullif(url_hash, '')) - count(DISTINCT nullif(url_hash, '')) AS url_left, count(nullif(url_hash, '')) AS url_hashes FROM {_M}),
b AS (SELECT count(*) AS extracted, count(*) FILTER (text_length > 0) AS extracted_non_empty, count(nullif(content_hash, '')) - count(DISTINCT nullif(content_hash, '')) AS content_left, count(nullif(content_hash, '')) AS content_hashes FROM extracted_text), c AS (SELECT count(*) AS link_edges FROM links)"""
SQL["quality_counts"] = _COUNTS + " SELECT * FROM a, b, c"
SQL["quality_rates"] = _COUNTS + f" SELECT {_RATIO('ok_records', 'manifest_records')} AS fetch_success_rate, {_RATIO('non_empty', 'ok_records')} AS non_empty_rate, {_RATIO('extracted', 'ok_records')} AS keep_rate, {_RATIO('duplicates', 'ok_records')} AS duplicate_rate, {_RATIO('extracted_non_empty', 'extracted')} AS output_non_empty_rate, {_RATIO('url_left', 'url_hashes')} AS url_left_rate, {_RATIO('content_left', 'content_hashes')} AS content_left_rate FROM a, b, c"
_PCT = lambda k, x: f"coalesce(list_sort(list(v))[greatest(0, least(count(*) - 1, round_even((count(*) - 1) * {x}::DOUBLE, 0)))::BIGINT + 1], 0)::BIGINT AS {k}"
_LEN = "SELECT coalesce(min(v), 0) AS min_len, coalesce(max(v), 0) AS max_len, coalesce(round_even(avg(v), 2), 0)::DOUBLE AS avg_len, count(*) FILTER (v < 200) AS thin, count(*) FILTER (v >= 500) AS good, count(*) FILTER (v >= 2000) AS long_text, " + ", ".join(_PCT(k, x) for k, x in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95)))
SQL["text_length_stats"] = _LEN + " FROM (SELECT coalesce(text_length, 0) AS v FROM extracted_text)"
SQL["manifest_length_stats"] = _LEN + f" FROM (SELECT coalesce(text_length, 0) AS v FROM {_M} WHERE ok)"
SQL["percentile_floor"] = _SITES + " SELECT " + ", ".join(f"coalesce(list_sort(list(fetched))[least(count(*) - 1, floor(count(*) * {x}))::BIGINT + 1], 0)::BIGINT AS {k}" for k, x in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))) + " FROM s"
SQL["histograms"] = "SELECT dimension, value, n FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS dimension, coalesce({c}::VARCHAR, '') AS value, count(*) AS n FROM {_M} GROUP BY 2" for c in ("status", "content_type", "error", "source", "depth", "extractor")) + ") QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) <= 20"
SQL["sample_titles"] = "SELECT seq, url, title FROM extracted_text ORDER BY seq LIMIT 20"
SQL["sample_errors"] = f"SELECT seq, url, error FROM {_M} WHERE error <> '' ORDER BY seq LIMIT 20"
SQL["site_verify"] = _SITES + f" SELECT h.host, coalesce(c.fetched, 0) AS fetched, coalesce({_COMPLETE}, false) AS verified FROM site_seeds h LEFT JOIN c ON c.host = h.host"
SQL["run_rollup"] = _SITES + f" SELECT count(*) AS sites, count(*) FILTER ({_COMPLETE}) AS complete, count(*) FILTER (stopped_reason <> 'frontier_exhausted') AS capped, sum(fetched)::BIGINT AS fetched, sum(ok)::BIGINT AS ok, sum(unique_text)::BIGINT AS unique_text, sum(open)::BIGINT AS open FROM c"
SQL["cross_site_summary"] = _SITES + f" SELECT {_COMPLETE} AS complete, count(*) AS sites, sum(coalesce(nullif(unique_text, 0), nullif(ok, 0), nullif(fetched, 0), 0))::BIGINT AS records FROM c GROUP BY 1"
SQL["pages_per_site"] = _SITES + " SELECT round_even(avg(unique_text), 4) AS mean_all, coalesce(round_even(avg(unique_text) FILTER (unique_text > 0), 4), 0)::DOUBLE AS mean_nonzero, coalesce(median(unique_text) FILTER (unique_text > 0), 0)::DOUBLE AS median_nonzero FROM s"
SQL["scale_estimate"] = _SITES + f""", a AS (SELECT count(*) AS records, count(sc) AS candidates, count(sc) - count(DISTINCT sc) AS duplicates FROM (SELECT {site('url', 'scope')} AS sc FROM {_M})),
b AS (SELECT count(*) AS sites, count(*) FILTER (unique_text > 0) AS nonzero_sites, sum(unique_text)::BIGINT AS pages FROM s), w AS (SELECT count(DISTINCT source_wet_path) AS ok_files FROM site_seeds),
x AS (SELECT *, round_even(candidates::DOUBLE / records, 12) AS cand, least(0.95::DOUBLE, round_even(duplicates::DOUBLE / candidates, 12) + 0.12::DOUBLE * log10(greatest(1.0, 90000.0::DOUBLE / greatest(1, ok_files)))) AS dup FROM a, b, w),
y AS (SELECT *, floor(floor(2700000000 * cand) * (1 - dup)) AS u FROM x), z AS (SELECT *, u * round_even(nonzero_sites::DOUBLE / sites, 12) * round_even(pages::DOUBLE / nonzero_sites, 12) AS moderate FROM y)
SELECT round_even(cand, 6) AS candidate_rate, round_even(dup, 6) AS duplicate_rate, u::BIGINT AS unique_sites, round_even(u * round_even(pages::DOUBLE / sites, 12), 0) AS pages_conservative, round_even(moderate, 0) AS pages_moderate, round_even(moderate / 360000.0::DOUBLE, 2) AS hours FROM z"""
SQL["sitemap_reports"] = f"SELECT source, coalesce(ok, false) AS ok, count(*) AS n, coalesce(sum(sitemap_child_count), 0)::BIGINT AS children, coalesce(sum(sitemap_page_count), 0)::BIGINT AS pages, coalesce(sum(feed_item_count), 0)::BIGINT AS items FROM {_M} WHERE source IN ('sitemap', 'sitemap_link', 'feed') GROUP BY 1, 2"
_HOUR = "WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1), r AS (SELECT hour, n, coalesce(n - lag(n) OVER (ORDER BY hour), 0) AS delta, coalesce(round_even((n - lag(n) OVER (ORDER BY hour)) * 60.0::DOUBLE / (epoch(hour) - epoch(lag(hour) OVER (ORDER BY hour))), 2), 0)::DOUBLE AS per_minute FROM h)"
SQL["rate_per_hour"] = _HOUR + " SELECT strftime(hour, '%Y-%m-%d %H:%M') AS hour, n, delta, per_minute, round_even(per_minute / 0.25::DOUBLE, 4) AS target_ratio FROM r"
SQL["peak_rate"] = _HOUR + " SELECT max(delta / 3600.0::DOUBLE) AS peak FROM r"
SQL["engine_stats"] = "SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round_even(sum(value), 2) AS total FROM events GROUP BY 1, 2"
SQL["progress_running"] = "SELECT day, event_type, n, sum(n) OVER (PARTITION BY event_type ORDER BY day)::BIGINT AS so_far FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)"
SQL["worker_rollup"] = "SELECT count(*) AS workers, sum(event_id)::BIGINT AS event_id, sum(value) AS value FROM (SELECT user_id % 8 AS w, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1)"

# --- graphs and increments
SQL["link_kinds"] = f"SELECT source, {kind(norm('to_url'))} AS kind, count(*) AS n FROM links GROUP BY 1, 2"
SQL["bfs_depth"] = f"""WITH RECURSIVE e AS (SELECT DISTINCT {norm('from_url')} AS f, {norm('to_url')} AS t FROM links), w AS (SELECT DISTINCT {norm('url')} AS url, 0 AS depth FROM manifest WHERE source = 'seed' AND {norm('url')} IS NOT NULL
UNION SELECT e.t, w.depth + 1 FROM w JOIN e ON e.f = w.url WHERE w.depth < 4 AND e.t IS NOT NULL) SELECT url, min(depth)::INT AS depth FROM w GROUP BY url"""
SQL["sitemap_expand"] = f"""WITH RECURSIVE e AS (SELECT DISTINCT {norm('from_url')} AS f, CASE WHEN source = 'sitemap_link' THEN 'child' ELSE 'page' END AS kind, {norm('to_url')} AS t FROM links WHERE source <> 'feed'),
w AS (SELECT DISTINCT {norm('url')} AS url FROM manifest WHERE source = 'seed' AND {norm('url')} IS NOT NULL UNION SELECT e.t FROM w JOIN e ON e.f = w.url WHERE e.kind = 'child' AND e.t IS NOT NULL)
SELECT DISTINCT e.f AS sitemap, e.kind, e.t AS url FROM w JOIN e ON e.f = w.url WHERE e.t IS NOT NULL"""
SQL["link_edges"] = f"SELECT DISTINCT from_url, n AS to_url, CASE {kind('n')} WHEN 'sitemap' THEN 'sitemap_link' WHEN 'feed' THEN 'feed' ELSE 'page_link' END AS source, 1 AS depth FROM (SELECT from_url, {norm('to_url')} AS n FROM links WHERE from_url IS NOT NULL) WHERE {kind('n')} IS NOT NULL"
SQL["one_hop_expand"] = _CAND + f", k AS (SELECT normalized FROM s ORDER BY score DESC, normalized LIMIT 50) SELECT DISTINCT {norm('to_url')} AS url, 'link_depth1' AS source FROM links WHERE {norm('from_url')} IN (SELECT normalized FROM k)"
SQL["candidate_assembly"] = f"""WITH x AS (SELECT DISTINCT {host('to_url')} AS host, {norm('to_url')} AS url, source FROM links WHERE {norm('to_url')} IS NOT NULL)
SELECT host, url, source FROM x WHERE source IN ('sitemap_link', 'feed') OR (source = 'page_link' AND host NOT IN (SELECT host FROM x WHERE source = 'sitemap_link'))"""
SQL["http_cache_latest"] = "SELECT url_hash, arg_max_null(url, seq) AS url, arg_max_null(etag, seq) AS etag, arg_max_null(last_modified, seq) AS last_modified FROM http_cache WHERE url_hash IS NOT NULL GROUP BY url_hash"
SQL["http_cache_upsert"] = "SELECT seq, url_hash, url, etag, last_modified FROM http_cache WHERE url_hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY seq DESC) = 1"
SQL["conditional_revisit"] = f"WITH c AS ({SQL['http_cache_latest']}) SELECT coalesce(coalesce(c.etag, '') <> '' OR coalesce(c.last_modified, '') <> '', false) AND c.url_hash IS NOT NULL AS conditional, coalesce(m.status = 200, false) AS changed, count(*) AS n FROM {_M} m LEFT JOIN c ON c.url_hash = m.url_hash GROUP BY 1, 2"
SQL["stream_tumbling"] = "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round_even(sum(value), 2) AS total FROM events GROUP BY 1, 2"
SQL["stream_sessions"] = "WITH g AS (SELECT user_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM events) SELECT user_id, sum(new)::BIGINT AS sessions, count(*) AS events FROM g GROUP BY user_id"
SQL["stream_seen"] = "SELECT DISTINCT user_id, event_type FROM events"

# --- files: what comes back is what was written
SQL["jsonl_strict"] = "SELECT seq, url, title, md5(text) AS text_md5 FROM extracted_text"
SQL["jsonl_without_text"] = "SELECT seq, title, text_length, false AS has_text FROM extracted_text"
SQL["jsonl_lenient"] = "SELECT seq, url, mime FROM index_records WHERE coalesce(mime, '') <> ''"
SQL["index_lines"] = f"SELECT CASE WHEN coalesce(mime, '') = '' THEN 'bad_index_lines' ELSE coalesce({_IDX}, 'checked') END AS reason, count(*) AS n FROM index_records GROUP BY 1"
SQL["csv_round_trip"] = f"SELECT seq, url, status::VARCHAR AS status, '' AS lastmod FROM {_M}"
_SAFE = "coalesce(nullif(trim(regexp_replace(scope, '[^A-Za-z0-9_.-]+', '_', 'g'), '_'), ''), 'site')"
SQL["seeds_two_columns"] = f"SELECT seed_url, scope, CASE WHEN sample_url IS NOT NULL THEN coalesce(output_name, {_SAFE}) ELSE {_SAFE} END AS output_name FROM site_seeds WHERE seed_url IS NOT NULL AND scope IS NOT NULL"
SQL["seeds_three_columns"] = "SELECT seed_url, scope, output_name FROM site_seeds WHERE seed_url IS NOT NULL AND scope IS NOT NULL AND sample_url IS NOT NULL AND output_name IS NOT NULL"
SQL["seeds_mixed"] = "SELECT coalesce(sample_url, seed_url) AS url FROM site_seeds WHERE coalesce(sample_url, seed_url) <> ''"
SQL["registry_appended"] = "SELECT DISTINCT host, 1::BIGINT AS lines FROM site_seeds WHERE host <> ''"
SQL["archive_paths"] = f"SELECT CASE WHEN regexp_matches(source_wet_path, '^https?://') THEN source_wet_path ELSE '{K.DATA_ROOT}' || ltrim(source_wet_path, '/') END AS url, count(*) AS n FROM site_seeds WHERE source_wet_path IS NOT NULL GROUP BY 1"
SQL["archive_headers"] = "SELECT url AS target_url, '<urn:' || seq || '>' AS record_id, octet_length(encode(coalesce(text, '')))::BIGINT AS length FROM extracted_text"
_DISCOVERED = f"""WITH known AS (SELECT DISTINCT scope FROM site_seeds WHERE sample_url IS NULL AND scope IS NOT NULL), x AS (SELECT seq, {site('url', 'reason')} AS why, {site('url', 'scope')} AS scope FROM extracted_text),
r AS (SELECT seq, coalesce(why, CASE WHEN scope IN (SELECT scope FROM known) THEN 'already_known' WHEN seq > min(seq) OVER (PARTITION BY scope) THEN 'duplicate_site' ELSE 'accepted' END) AS reason FROM x)"""
SQL["archive_discovery"] = _DISCOVERED + " SELECT reason, count(*) AS n FROM r GROUP BY reason"
SQL["frontier_dump"] = _FRONTIER
SQL["summary_file"] = SQL["run_rollup"]
SQL["state_replaced"] = "SELECT seq, url_hash, etag FROM http_cache"
SQL["html_store"] = f"SELECT sha1(final_url) AS name, 'h' || substr(sha1(final_url), 1, 2) AS part, final_url, md5('<title>' || coalesce(title, '') || '</title>') AS html_md5, lpad(seq::VARCHAR, 6, '0') AS number FROM {_M} WHERE final_url IS NOT NULL"
SQL["per_site_files"] = f"SELECT seq, source AS site FROM {_M} WHERE source IS NOT NULL"
SQL["file_line_counts"] = f"SELECT source AS site, count(*) AS lines FROM {_M} WHERE source IS NOT NULL GROUP BY source"
SQL["file_listing"] = "SELECT 'part' AS name, true AS exists, sum(octet_length(encode(host)) + 1)::BIGINT AS size, true AS aged FROM site_seeds UNION ALL SELECT 'absent', false, 0, true"
SQL["worker_files_merged"] = """SELECT seq, url, NULL AS title, NULL AS source FROM extracted_text WHERE depth <= 1 UNION ALL SELECT seq, url, title, NULL FROM extracted_text WHERE depth > 1 UNION ALL SELECT seq, NULL, NULL, source FROM extracted_text WHERE depth IS NULL"""
SQL["log_tail"] = "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 20"
SQL["sample_pages"] = "SELECT seq, url, title FROM extracted_text ORDER BY seq LIMIT 15"

# --- bodies


def lines(t: str) -> str:
    """Lines without white space at their ends and without blank ones."""
    return stripped(f"regexp_replace(regexp_replace({t}, '[ \\t\\r\\f\\x0B]+', ' ', 'g'), '{_S}*\\n{_S}*', chr(10), 'g')")


_TEXT, _TTL = lines("text"), stripped("regexp_replace(coalesce(title, ''), '[ \\t\\r\\f\\x0B]+', ' ', 'g')")
_ALL = f"concat_ws(chr(10), nullif({_TTL}, ''), nullif({_TEXT}, ''), 'link', 'feed')"
_WORDS = f"len(list_filter(regexp_split_to_array({_TEXT}, '{_S}+'), lambda w: w <> ''))"
SQL["main_content"] = f"SELECT seq, CASE WHEN {_WORDS} >= 25 THEN 'main_content' ELSE 'fallback' END AS extractor, md5(CASE WHEN {_WORDS} >= 25 THEN {_TEXT} ELSE {_ALL} END) AS text_md5 FROM extracted_text WHERE text IS NOT NULL"
SQL["parser_extract_text"] = f"SELECT seq, {_TTL} AS title, md5({_ALL}) AS text_md5, 'fallback' AS extractor FROM extracted_text WHERE text IS NOT NULL"
SQL["extractors_compared"] = "SELECT asked, asked = 'regex' AS navigation, count(*) AS n FROM extracted_text, (SELECT unnest(['main_content', 'parser', 'regex']) AS asked) WHERE text IS NOT NULL GROUP BY asked"
_ROOT = f"lower({part('url', 1)}) || '://' || {part('url', 2)}"
SQL["parser_extract_links"] = f"""WITH x AS (SELECT seq, url, {_ROOT} AS root FROM extracted_text WHERE text IS NOT NULL AND url IS NOT NULL), y AS (SELECT seq, 'link' AS role, {norm('url')} AS url FROM x UNION ALL SELECT seq, 'canonical', {norm('url')} FROM x
UNION ALL SELECT seq, 'link', {norm("(root || '/feed.xml')")} FROM x UNION ALL SELECT seq, 'feed', {norm("(root || '/rss.xml')")} FROM x UNION ALL SELECT seq, 'sitemap', {norm("(root || '/sitemap.xml')")} FROM x) SELECT * FROM y WHERE url IS NOT NULL"""
SQL["link_modes"] = f"""SELECT 1 + good::INT AS parser, 2 * (good AND NOT regexp_matches(url, '[#\\s]'))::INT AS regex, count(*) AS n FROM (SELECT url, {norm('url')} IS NOT NULL AS good FROM extracted_text WHERE text IS NOT NULL AND url IS NOT NULL) GROUP BY 1, 2"""
SQL["hrefs_of_limited_length"] = f"""SELECT seq, len(regexp_extract_all(h, '\\bhref\\s*=\\s*["'']([^"''#\\s>]{{1,60}})["'']', 1, 'i'))::INT AS n FROM (SELECT seq, {_HTML} AS h FROM extracted_text WHERE text IS NOT NULL)"""
SQL["xml_sniff"] = f"SELECT source, content_type, coalesce(contains(lower(content_type), 'xml'), false) OR coalesce(source IN ('feed', 'sitemap_link'), false) AS xml, count(*) AS n FROM {_M} GROUP BY 1, 2, 3"
SQL["sitemap_index_parse"] = """WITH x AS (SELECT DISTINCT to_url FROM links WHERE source = 'sitemap_link' AND trim(to_url) <> '') SELECT 'child' AS kind, trim(to_url) AS url, '' AS lastmod, '' AS changefreq, '' AS priority FROM x UNION ALL SELECT 'page', trim(to_url), '', 'daily', '0.5' FROM x"""
SQL["charset_fast"] = "SELECT seq, true AS guessed, true AS by_header, true AS header_first FROM extracted_text WHERE length(text) > 0"
SQL["gzip_bodies"] = "SELECT seq, md5(text) AS unpacked, md5(text) AS plain FROM extracted_text WHERE text IS NOT NULL"
SQL["header_lookup"] = f"SELECT seq, coalesce(content_type, '') AS type, 'none' AS absent FROM {_M}"
SQL["retry_delays"] = f"SELECT status, CASE status WHEN 503 THEN 30.0 WHEN 429 THEN 2.5 ELSE 1.0 END::DOUBLE AS seconds, count(*) AS n FROM {_M} GROUP BY 1, 2"
_RH = host("url")
SQL["robots_by_site"] = f"""SELECT seq, CASE WHEN starts_with({_RH}, 'www.') THEN NOT starts_with(lower({_PATH}), '/news/') WHEN starts_with({_RH}, 'blog.') THEN NOT starts_with(lower({_PATH}), '/wiki/') ELSE true END AS allowed,
CASE WHEN starts_with({_RH}, 'www.') THEN 'https://' || {_RH} || '/sitemap.xml' ELSE '' END AS sitemaps FROM extracted_text WHERE url IS NOT NULL"""
_TARGET = "(CASE WHEN starts_with(to_url, '#') THEN from_url ELSE to_url END)"
_FEED = f"SELECT DISTINCT from_url, {norm(_TARGET)} AS url FROM links WHERE source = 'feed' AND {norm(_TARGET)} IS NOT NULL"
SQL["feed_parse"] = _FEED
SQL["feed_expand"] = f"SELECT DISTINCT {host('from_url')} AS host, url FROM ({_FEED})"
SQL["url_resolve"] = f"SELECT DISTINCT from_url, to_url, {norm(_TARGET)} AS normalized FROM links"
SQL["single_sitemap"] = f"SELECT from_url, url FROM (SELECT DISTINCT from_url, {norm('to_url')} AS url FROM links WHERE source = 'sitemap_link' AND from_url IS NOT NULL AND {norm('to_url')} IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY from_url ORDER BY url) <= 50"

# --- runs
SQL["discovery_reasons"] = _DISCOVERED + " SELECT seq, reason FROM r"
SQL["discovery_summary"] = _DISCOVERED + f""", s AS (SELECT count(*) AS records, count(*) FILTER (reason = 'missing_target_url') AS missing, count(*) FILTER (reason = 'invalid_site') AS invalid, count(*) FILTER (reason IN ('duplicate_site', 'already_known', 'accepted')) AS candidates,
count(*) FILTER (reason = 'duplicate_site') AS duplicates, count(*) FILTER (reason = 'already_known') AS known, count(*) FILTER (reason = 'accepted') AS sites FROM r) SELECT *, {_RATIO('candidates', 'records')} AS candidate_rate, {_RATIO('sites', 'candidates')} AS site_rate, {_RATIO('sites', 'records')} AS "yield" FROM s"""
SQL["site_dedup_runs"] = f"SELECT min(seq) AS seq, scope, arg_min(seed_url, seq) AS seed_url FROM (SELECT seq, {site('url', 'scope')} AS scope, {site('url', 'seed_url')} AS seed_url FROM extracted_text) WHERE scope IS NOT NULL AND scope NOT IN (SELECT scope FROM site_seeds WHERE sample_url IS NULL AND scope IS NOT NULL) GROUP BY scope"
SQL["target_dedup"] = f"SELECT domain, min(host) AS host, arg_min(seed_url, host) AS seed_url FROM (SELECT {domain('host')} AS domain, host, seed_url FROM site_seeds) GROUP BY domain"
SQL["ordered_sources"] = f"SELECT host, string_agg(source, ',' ORDER BY first) AS sources FROM (SELECT {host('url')} AS host, source, min(seq) AS first FROM extracted_text WHERE source IS NOT NULL GROUP BY 1, 2) GROUP BY host"
SQL["resume_state"] = f"SELECT DISTINCT {norm('url')} AS key, 'url' AS kind FROM manifest WHERE {norm('url')} IS NOT NULL UNION ALL SELECT DISTINCT content_hash, 'content' FROM {_M} WHERE ok AND content_hash <> ''"
SQL["resumable_sites"] = _SITES + f" SELECT host, seed_url FROM site_seeds WHERE host IN (SELECT host FROM m) AND host NOT IN (SELECT host FROM c WHERE {_COMPLETE})"
SQL["active_refill"] = _SITES + f" SELECT host, min(seq) AS first FROM m WHERE host NOT IN (SELECT host FROM c WHERE {_COMPLETE}) GROUP BY host ORDER BY first LIMIT 25"
SQL["processed_archives"] = "SELECT source_wet_path FROM site_seeds WHERE source_wet_path IS NOT NULL GROUP BY source_wet_path HAVING bool_or(sample_url IS NULL)"
_HOP = _CAND + f""", k AS (SELECT normalized FROM s ORDER BY score DESC, normalized LIMIT 50), hop AS (SELECT DISTINCT {norm('to_url')} AS url FROM links WHERE {norm('from_url')} IN (SELECT normalized FROM k) AND {norm('to_url')} IS NOT NULL),
u AS (SELECT seq, n, source FROM a UNION ALL SELECT (SELECT max(seq) FROM a) + row_number() OVER (ORDER BY url), {norm('url', 'scored')}, 'link_depth1' FROM hop)"""
SQL["refilter_after_hop"] = _HOP + f""", v AS (SELECT source, CASE WHEN n IS NULL THEN 'normalize_failed' WHEN min(seq) OVER (PARTITION BY n) < seq THEN 'duplicate_url' WHEN NOT ends_with({host('n')}, '.example') THEN 'offsite' WHEN {_LOW.format(p=_NP, q=_NQ)} THEN 'low_value' ELSE 'accepted' END AS reason FROM u)
SELECT source, reason, count(*) AS n FROM v GROUP BY 1, 2"""
SQL["sorted_urls"] = f"SELECT row_number() OVER (ORDER BY url) - 1 AS position, url FROM (SELECT DISTINCT {norm('url')} AS url FROM extracted_text) WHERE url IS NOT NULL"
SQL["prefix_sample"] = "SELECT host FROM site_seeds ORDER BY host LIMIT 10"
SQL["first_outlinks"] = "SELECT from_url, to_url FROM (SELECT DISTINCT from_url, to_url FROM links WHERE source = 'page_link' AND from_url IS NOT NULL AND to_url IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY from_url ORDER BY to_url) <= 3"
SQL["per_domain_cap"] = "SELECT domain, least(count(*), 1200) AS kept, max(seq) FILTER (i <= 1200) AS last, count(*) > 1200 AS capped FROM (SELECT domain, seq, row_number() OVER (PARTITION BY domain ORDER BY seq) AS i FROM index_records) GROUP BY domain"
SQL["xml_result_classes"] = f"SELECT source, CASE WHEN status IS NULL THEN 'fetch_error' WHEN status <> 200 THEN 'http_' || status WHEN NOT coalesce(contains(lower(content_type), 'xml'), false) THEN CASE WHEN source = 'feed' THEN 'feed_not_xml' ELSE 'sitemap_not_xml' END ELSE 'ok' END AS result, count(*) AS n FROM {_M} WHERE source IN ('sitemap', 'sitemap_link', 'feed') GROUP BY 1, 2"
SQL["manifest_errors"] = f"WITH m AS (SELECT ok, {_ERR} AS reason FROM {_M}), t AS (SELECT count(*) AS fetched, count(*) FILTER (ok) AS ok FROM m), b AS (SELECT reason, count(*) AS n FROM m WHERE reason IS NOT NULL GROUP BY reason) SELECT reason, n, fetched, ok, {_RATIO('n', 'fetched')} AS share FROM b, t"
SQL["verification_report"] = f"WITH v AS ({SQL['site_verify']}) SELECT count(*) AS sites, count(*) FILTER (verified) AS verified, bool_and(verified) AS all_verified, sum(fetched)::BIGINT AS fetched, coalesce((SELECT string_agg(host, ' ' ORDER BY host) FROM (SELECT host FROM v WHERE NOT verified ORDER BY host LIMIT 100)), '') AS incomplete FROM v"
SQL["run_status"] = _SITES + f", l AS (SELECT host, max(fetched_at) AS latest FROM m GROUP BY host) SELECT CASE WHEN {_COMPLETE} THEN 'finished' WHEN coalesce(epoch((SELECT max(latest) FROM l)) - epoch(latest) <= 30 * 86400, false) THEN 'running' ELSE 'stalled' END AS status, count(*) AS sites, sum(fetched)::BIGINT AS fetched, sum(ok)::BIGINT AS ok, sum(unique_text)::BIGINT AS unique_text FROM c JOIN l ON l.host = c.host GROUP BY 1"
SQL["first_numbers"] = f"SELECT source, sum(coalesce(text_length, bytes, 0))::BIGINT AS total FROM {_M} GROUP BY source"
SQL["probe_summary"] = f"""WITH x AS (SELECT {host('to_url')} AS host, count(*) FILTER (source = 'sitemap_link') AS sitemaps, count(*) FILTER (source = 'feed') AS feeds, count(*) FILTER (source = 'page_link') AS pages FROM links GROUP BY 1)
SELECT s.host, starts_with(seed_url, 'https') AS secure, coalesce(sitemaps, 0) AS sitemaps, coalesce(feeds, 0) AS feeds, coalesce(pages, 0) AS pages, coalesce(sitemaps, 0) + coalesce(feeds, 0) > 0 AS discoverable FROM site_seeds s LEFT JOIN x ON x.host = s.host"""
SQL["progress_snapshots"] = f"SELECT step, sum(n) OVER w::BIGINT AS fetched, sum(ok) OVER w::BIGINT AS ok, sum(dup) OVER w::BIGINT AS duplicates FROM (SELECT (i - 1) // 500 AS step, count(*) AS n, count(*) FILTER (ok) AS ok, count(*) FILTER (content_duplicate) AS dup FROM (SELECT *, row_number() OVER (ORDER BY seq) AS i FROM {_M}) GROUP BY 1) WINDOW w AS (ORDER BY step)"
SQL["approximate_hosts"] = "SELECT count(DISTINCT to_url) AS exact, true AS close FROM links"

# --- greedy orders, one row after the other
_KEPT = f"""WITH RECURSIVE f AS (SELECT domain, seq, {norm('url')} AS url, nullif(digest, '') AS d FROM index_records WHERE ({_IDX}) IS NULL), r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY seq) AS i FROM f),
g AS (SELECT domain, 0::BIGINT AS i, []::VARCHAR[] AS us, []::VARCHAR[] AS ds, NULL::BIGINT AS seq, NULL::VARCHAR AS url, false AS kept FROM (SELECT DISTINCT domain FROM r)
UNION ALL SELECT domain, i, CASE WHEN k THEN list_append(us, url) ELSE us END, CASE WHEN k AND d IS NOT NULL THEN list_append(ds, d) ELSE ds END, seq, url, k
FROM (SELECT g.domain, r.i, g.us, g.ds, r.seq, r.url, r.d, NOT list_contains(g.us, r.url) AND (r.d IS NULL OR NOT list_contains(g.ds, r.d)) AS k FROM g JOIN r ON r.domain IS NOT DISTINCT FROM g.domain AND r.i = g.i + 1))"""
SQL["index_two_key_dedup"] = _KEPT + " SELECT domain, seq, url FROM g WHERE kept"
SQL["seeder_summary"] = _KEPT + f", b AS (SELECT count(*) AS index_records, count(*) FILTER (reason = 'skipped_non_html') AS non_html, count(*) FILTER (reason = 'skipped_normalize_failed') AS failed FROM (SELECT {_IDX} AS reason FROM index_records)), e AS (SELECT count(*) AS exported, count(DISTINCT domain) AS domains FROM g WHERE kept) SELECT * FROM b, e"
SQL["near_dup_resolve"] = _SIM.replace("WITH w AS", "WITH RECURSIVE w AS") + f""", x AS MATERIALIZED (SELECT s.doc_id, ('0x' || simhash)::UBIGINT AS n, sha256({for_hash("coalesce(text, '')")}) AS e, row_number() OVER (ORDER BY s.doc_id) AS i FROM s JOIN documents d ON d.doc_id = s.doc_id),
g AS (SELECT 0::BIGINT AS i, []::UBIGINT[] AS ns, []::VARCHAR[] AS es, NULL::BIGINT AS doc_id, NULL::VARCHAR AS status
UNION ALL SELECT i, CASE WHEN status = 'unique' THEN list_append(ns, n) ELSE ns END, CASE WHEN status = 'unique' THEN list_append(es, e) ELSE es END, doc_id, status FROM (
SELECT x.i, g.ns, g.es, x.n, x.e, x.doc_id, CASE WHEN list_contains(g.es, x.e) THEN 'exact_content_duplicate'
WHEN len(list_filter(g.ns, lambda m: bit_count(xor(m, x.n)) <= 4 AND ((m & 65535) = (x.n & 65535) OR ((m >> 16) & 65535) = ((x.n >> 16) & 65535) OR ((m >> 32) & 65535) = ((x.n >> 32) & 65535) OR (m >> 48) = (x.n >> 48)))) > 0 THEN 'near_semantic_duplicate' ELSE 'unique' END AS status
FROM g JOIN x ON x.i = g.i + 1))
SELECT doc_id, status FROM g WHERE doc_id IS NOT NULL"""

# --- increments and streams
SQL["revisit_classes"] = f"WITH c AS ({SQL['http_cache_latest']}), r AS (SELECT m.status, coalesce(coalesce(c.etag, '') <> '' OR coalesce(c.last_modified, '') <> '', false) AND c.url_hash IS NOT NULL AS conditional FROM {_M} m LEFT JOIN c ON c.url_hash = m.url_hash) SELECT conditional, CASE WHEN status = 304 THEN CASE WHEN conditional THEN 'kept' ELSE 'unasked' END WHEN status = 200 THEN 'extract' ELSE 'none' END AS action, count(*) AS n FROM r GROUP BY 1, 2"
SQL["merge_with_offsets"] = "SELECT printf('%08d', event_id) AS value, CASE WHEN user_id % 2 = 1 AND row_number() OVER (PARTITION BY user_id % 2 ORDER BY event_id) <= 10 THEN 2 ELSE 1 END::BIGINT AS times FROM events"
SQL["stream_resumed"] = "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type"
SQL["stream_snapshots"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
SQL["stream_seen_in_window"] = SQL["stream_seen"]
