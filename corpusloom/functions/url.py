"""URL functions as Spark columns.

A URL is taken apart by one anchored pattern, so that odd hosts and paths never
fail a job; everything stays in generated code.  ``normalize_udf`` is the same
function over Arrow batches by the standard library, for relative references
and for what the native form leaves out (see ``normalize``).
"""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, quote, urldefrag, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

_ANATOMY = r"(?is)^(https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, _ANATOMY, i)


def _stripped(url: Column) -> Column:
    return F.regexp_replace(url, r"^\s+|\s+$", "")


def host_of(url: Column) -> Column:
    """Host name in small letters without user and port; empty if there is none, also for NULL."""
    h = F.regexp_extract(_part(_stripped(url), 2), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1)
    return F.coalesce(F.lower(h), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(_part(_stripped(url), 3), F.lit(""))


def query_of(url: Column) -> Column:
    return F.coalesce(_part(_stripped(url), 4), F.lit(""))


def root_url(url: Column) -> Column:
    """Scheme and authority as they stand, and a slash; NULL for what is no http URL."""
    u = _stripped(url)
    return F.when(_part(u, 2) != "", F.concat(F.lower(_part(u, 1)), F.lit("://"), _part(u, 2), F.lit("/")))


def is_static(path: Column, profile: str = "strict") -> Column:
    """Whether a path ends like a file that is no page."""
    ends = [e for e in K.STATIC_EXTENSIONS if profile != "scored" or e not in K.NOT_STATIC_WHEN_SCORED]
    return F.lower(path).rlike(r"\.(" + "|".join(ends) + r")$")


def _quoted(s: Column, safe: str) -> Column:
    """Percent-encodes the UTF-8 bytes of all but safe characters."""
    one = lambda c: F.when(c.rlike(f"^[{safe}]$"), c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1"))
    return F.when(s.rlike(f"^[{safe}]*$"), s).otherwise(F.array_join(F.transform(F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0)), one), ""))


def _form(s: Column) -> Column:
    """Form encoding: space to plus, letters, digits and _.-~ kept."""
    kept = "A-Za-z0-9_.~-"
    return F.when(s.rlike(f"^[{kept}]*$"), s).otherwise(F.regexp_replace(_quoted(s, kept), "%20", "+"))


def _decoded(s: Column) -> Column:
    plus = F.regexp_replace(s, r"\+", " ")
    return F.when(s.rlike("%[0-9A-Fa-f]{2}"), F.coalesce(F.call_function("try_url_decode", s), plus)).otherwise(plus)


def _tracking(key: Column, profile: str) -> Column:
    low = F.lower(key)
    prefixed = key if profile == "fast" else low
    out = low.isin(*K.TRACKING_KEYS)
    for p in K.TRACKING_PREFIXES:
        out = out | prefixed.startswith(p)
    return out


def _query(query: Column, profile: str) -> Column:
    keep_blank = profile == "fast"
    pair = lambda p: F.struct(_decoded(F.regexp_extract(p, "(?s)^([^=]*)", 1)).alias("k"), _decoded(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v"))
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), pair)
    kept = F.filter(pairs, lambda p: (F.lit(True) if keep_blank else p["v"] != "") & ~_tracking(p["k"], profile))
    if profile != "fast":
        kept = F.array_sort(kept)
    return F.array_join(F.transform(kept, lambda p: F.concat(_form(p["k"]), F.lit("="), _form(p["v"]))), "&")


def normalize(url: Column, profile: str = "strict", allow_static: bool = False) -> Column:
    """The canonical form of an absolute URL, or NULL.

    Profiles ``strict`` and ``scored`` sort the query and drop blank values,
    ``fast`` keeps both; ``scored`` knows fewer static endings.  Fragment, user,
    default port and tracking parameters go; NULL, relative and non-http URLs
    and static files give NULL.  A malformed percent sign in a query is kept as
    it stands.
    """
    u = F.regexp_replace(_stripped(url), "(?s)#.*$", "")
    scheme = F.lower(_part(u, 1))
    host = host_of(u)
    port = F.regexp_extract(_part(u, 2), r":(\d+)$", 1)
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    netloc = F.when((port == "") | default, host).otherwise(F.concat(host, F.lit(":"), F.regexp_replace(port, "^0+(?=.)", "")))
    raw = F.regexp_replace(_part(u, 3), ";[^/]*$", "")
    path = F.when(raw == "", "/").otherwise(F.regexp_replace(raw, "/{2,}", "/"))
    query = _query(_part(u, 4), profile)
    out = F.concat(scheme, F.lit("://"), netloc, _quoted(path, "A-Za-z0-9_.~/%:@-"), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    sound = F.regexp_replace(_part(u, 2), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", "").rlike(r"^(:\d*)?$")
    good = (host != "") & sound & (F.lit(True) if allow_static else ~is_static(path, profile))
    return F.when(good, out)


def normalize_one(raw: str | None, base: str | None = None, profile: str = "strict", allow_static: bool = False) -> str | None:
    """The same for one URL, with relative references resolved against a base; malformed URLs give None."""
    if not raw:
        return None
    try:
        u = urlsplit(urldefrag((urljoin(base, raw) if base else raw).strip())[0])
        host, port = (u.hostname or "").lower(), u.port
    except ValueError:
        return None
    if u.scheme not in ("http", "https") or not host:
        return None
    head, _, last = u.path.rpartition("/")
    path = re.sub("/{2,}", "/", (head + "/" if _ else "") + last.split(";", 1)[0]) or "/"
    ends = tuple("." + e for e in K.STATIC_EXTENSIONS if profile != "scored" or e not in K.NOT_STATIC_WHEN_SCORED)
    if not allow_static and path.lower().endswith(ends):
        return None
    netloc = host if port in (None, 0, {"http": 80, "https": 443}[u.scheme]) else f"{host}:{port}"
    pairs = []
    for k, v in parse_qsl(u.query, keep_blank_values=profile == "fast"):
        name = k if profile == "fast" else k.lower()
        if k.lower() not in K.TRACKING_KEYS and not name.startswith(K.TRACKING_PREFIXES):
            pairs.append((k, v))
    return urlunsplit((u.scheme, netloc, quote(path, safe="/%:@"), urlencode(pairs if profile == "fast" else sorted(pairs)), ""))


def normalize_udf(profile: str = "strict", allow_static: bool = False):
    """normalize_one over Arrow batches: (url, base) to URL."""

    @F.pandas_udf("string")
    def f(url: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([normalize_one(u, b, profile, allow_static) for u, b in zip(url, base)], dtype=object)

    return f


def url_hash(url: Column, profile: str = "strict") -> Column:
    """64 hex digits by sha256; in the fast profile 16 by md5."""
    return F.substring(F.md5(url), 1, 16) if profile == "fast" else F.sha2(url, 256)


def registrable_domain(host: Column) -> Column:
    """The last two labels of a host, or three after a public suffix of two labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    tail = lambda k: F.array_join(F.slice(labels, n - k + 1, F.lit(k)), ".")
    return F.when(n <= 2, host).when(tail(2).isin(*K.TWO_LABEL_SUFFIXES), tail(3)).otherwise(tail(2))


def is_english_host(host: Column) -> Column:
    """Whether a host is plain ASCII with sound labels under a top-level domain read as English."""
    labels = F.split(host, r"\.")
    sound = F.forall(labels, lambda x: x.rlike("^[a-z0-9-]+$") & ~x.rlike("^-|-$|^xn--"))
    return F.coalesce(sound & F.element_at(labels, -1).isin(*K.ENGLISH_TLDS), F.lit(False))


def in_scope(host: Column, hosts: list[str], domains: list[str], subdomains: bool) -> Column:
    """Whether a host is one of the hosts or domains, or under one of the domains."""
    out = host.isin(hosts) | host.isin(domains) if hosts or domains else F.lit(False)
    if subdomains:
        for d in domains:
            out = out | host.endswith("." + d)
    return F.coalesce(out, F.lit(False))


def host_suffixes(host: Column) -> Column:
    """All suffixes of a host at label borders, so that scope by subdomain is a join on equal keys."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def path_allowed(url: Column, prefixes: list[str]) -> Column:
    """Whether the path is one of the prefixes or under one; no prefixes allow all."""
    if not prefixes:
        return F.lit(True)
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    out = F.lit(False)
    for p in prefixes:
        out = out | (path == p) | path.startswith(p.rstrip("/") + "/")
    return out


def is_low_value(url: Column) -> Column:
    """Whether path or query promise little: accounts, tags, search, more than three parameters, deep paging."""
    path, query = F.lower(path_of(url)), query_of(url)
    parts = F.arrays_overlap(F.split(path, "[^a-z0-9]+"), F.array(*map(F.lit, K.LOW_VALUE_PARTS)))
    return parts | (F.size(F.filter(F.split(query, "&"), lambda p: p != "")) > 3) | path.rlike(r"/(page|p)/\d{4,}(/|$)")


def site_of(url: Column, english_only: bool = False) -> Column:
    """struct(reason, seed_url, scope, host) of a target URL; reason is NULL for a usable site."""
    host = F.regexp_replace(host_of(url), r"^\.+|\.+$", "")
    domain = registrable_domain(host)
    spam = F.lit(False)
    for term in K.SPAM_TERMS:
        spam = spam | host.contains(term)
    reason = (
        F.when(F.coalesce(url, F.lit("")) == "", "missing_target_url")
        .when((host == "") | ~host.contains(".") | host.rlike(r"^\d+\.\d+\.\d+\.\d+$") | ~F.substring_index(host, ".", 1).rlike("[a-z]") | spam, "invalid_site")
        .when(F.lit(english_only) & ~is_english_host(host), "invalid_site")
    )
    canonical = F.when(host.startswith("www.") & (host != F.concat(F.lit("www."), domain)), F.substring(host, 5, 1000)).otherwise(host)
    scheme = F.when(F.lower(_part(_stripped(url), 1)) == "https", "https").otherwise("http")
    ok = reason.isNull()
    return F.struct(reason.alias("reason"), F.when(ok, F.concat(scheme, F.lit("://"), canonical, F.lit("/"))).alias("seed_url"), F.when(ok, domain).alias("scope"), F.when(ok, host).alias("host"))


def safe_name(s: Column) -> Column:
    """A name fit for files; ``site`` if nothing is left."""
    x = F.regexp_replace(F.regexp_replace(s, "[^A-Za-z0-9_.-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("site"))


def absolute_path(s: Column) -> Column:
    """A relative archive path under the data root; URLs as they are."""
    return F.when(s.rlike("^https?://"), s).otherwise(F.concat(F.lit(K.DATA_ROOT), F.regexp_replace(s, "^/+", "")))


def usual_urls(seed: Column, paths: list[str]) -> Column:
    """Where sitemaps or feeds of a site usually are."""
    root = F.regexp_replace(root_url(seed), "/+$", "")
    return F.transform(F.array(*map(F.lit, paths)), lambda p: F.concat(root, p))


def stable_bucket(key: Column, n: int) -> Column:
    """A bucket from 0 to n - 1 by the first 15 hex digits of md5 of the lower-case key."""
    return F.pmod(F.conv(F.substring(F.md5(F.lower(key)), 1, 15), 16, 10).cast("long"), F.lit(n))


def artifact_name(index: Column, url: Column) -> Column:
    """File name of a stored page: number, host, slug of at most 80 characters, 12 hex digits of sha1."""
    slug = F.substring(F.regexp_replace(F.regexp_replace(F.regexp_replace(path_of(url), "^/+|/+$", ""), "[^a-zA-Z0-9]+", "-"), "^-+|-+$", ""), 1, 80)
    host = F.when(host_of(url) == "", "unknown").otherwise(host_of(url))
    return F.format_string("%06d_%s_%s_%s.html", index, host, F.coalesce(F.nullif(slug, F.lit("")), F.lit("home")), F.substring(F.sha1(url), 1, 12))
