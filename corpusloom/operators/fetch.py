"""What became of a fetch: classes, retries, completion, blocking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import constants as K


def _is_html(content_type: Column) -> Column:
    return F.coalesce(F.lower(content_type).contains("html"), F.lit(False))


def turbo_class(status: Column, content_type: Column, challenge: Column) -> Column:
    """not_modified, http_N, fetch_error, non_html, challenge_page or ok."""
    return (
        F.when(status.isNull(), "fetch_error").when(status == 304, "not_modified").when(status != 200, F.concat(F.lit("http_"), status.cast("string")))
        .when(~_is_html(content_type), "non_html").when(F.coalesce(challenge, F.lit(False)), "challenge_page").otherwise("ok")
    )


def batch_class(status: Column, content_type: Column) -> Column:
    """non_html_or_non_200 or ok."""
    return F.when(F.coalesce(status != 200, F.lit(True)) | ~_is_html(content_type), "non_html_or_non_200").otherwise("ok")


def fast_class(status: Column, content_type: Column, size: Column, challenge: Column, text_length: Column, most: int) -> Column:
    """Bare status, fetch_error, non_html, too_large, challenge_page, empty_content (50 characters or fewer) or ok."""
    return (
        F.when(status.isNull(), "fetch_error").when(status != 200, status.cast("string")).when(~_is_html(content_type), "non_html")
        .when(F.coalesce(size > most, F.lit(False)), "too_large").when(F.coalesce(challenge, F.lit(False)), "challenge_page")
        .when(F.coalesce(text_length, F.lit(0)) <= 50, "empty_content").otherwise("ok")
    )


def xml_class(source: Column, status: Column, is_xml: Column) -> Column:
    """Result of a fetched sitemap or feed: fetch_error, http_N, sitemap_not_xml, feed_not_xml or ok."""
    not_xml = F.when(source == "feed", "feed_not_xml").otherwise("sitemap_not_xml")
    return F.when(status.isNull(), "fetch_error").when(status != 200, F.concat(F.lit("http_"), status.cast("string"))).when(~F.coalesce(is_xml, F.lit(False)), not_xml).otherwise("ok")


def is_retryable(status: Column, error: Column) -> Column:
    """Worth another try: no 304, no client error but 429, nothing too large."""
    too_large = F.coalesce(F.lower(error).contains("too large") | (error == "too_large"), F.lit(False))
    bad = F.coalesce((status == 304) | ((status >= 400) & (status < 500) & (status != 429)), F.lit(False))
    failed = status.isNull() | (status >= 400)
    return failed & ~bad & ~too_large


def error_reason(status: Column, error: Column) -> Column:
    """One spelling of an error for all engines: http_N, a bare reason, or NULL where there is none."""
    e = F.nullif(error, F.lit(""))
    number = F.nullif(F.regexp_extract(e, r"(?:^|http_|HTTP Error )(\d{3})\b", 1), F.lit(""))
    named = F.nullif(F.regexp_extract(e, r"^(\w+)\(", 1), F.lit(""))
    return F.when(number.isNotNull(), F.concat(F.lit("http_"), number)).otherwise(F.coalesce(named, e))


def stopped_reason(open_rows: Column, scheduled: Column, discovered: Column, max_pages: int, max_discovered: int) -> Column:
    return F.when((open_rows > 0) & (scheduled >= max_pages), "max_pages_reached").when((open_rows > 0) & (discovered >= max_discovered), "max_discovered_reached").otherwise("frontier_exhausted")


def is_blocking(reason: Column) -> Column:
    return F.coalesce(reason.isin(*K.BLOCKING_ERRORS), F.lit(False))


def likely_blocked(unique_text: Column, fetched: Column, blocking: Column) -> Column:
    """No text at all, and at least half of the fetches (and one) met a block."""
    return (unique_text == 0) & (fetched > 0) & (blocking >= F.greatest(F.lit(1.0), fetched * 0.5))
