"""Word lists and patterns that results depend on."""

# File endings that are no pages.
STATIC_EXTENSIONS = (
    "jpg", "jpeg", "png", "gif", "webp", "svg", "ico", "css", "js", "zip", "tar", "gz", "tgz", "bz2", "xz", "rar", "7z", "pdf", "epub", "mp3", "mp4",
    "avi", "mov", "wmv", "woff", "woff2", "ttf", "eot", "apk", "dmg", "exe",
)
# The endings that the scored profile doesn't know.
NOT_STATIC_WHEN_SCORED = ("eot", "apk", "dmg", "exe")
# Query parameters that only track.
TRACKING_PREFIXES = ("utm_", "gad_")
TRACKING_KEYS = (
    "fbclid", "gclid", "yclid", "mc_cid", "mc_eid", "sessionid", "sid", "spm", "ref", "source", "from", "__hsfp", "__hssc", "__hstc", "gbraid",
    "wbraid", "msclkid", "trk", "trkcampaign",
)
# Where sitemaps and feeds usually are.
SITEMAP_PATHS = (
    "/sitemap.xml", "/sitemap.xml.gz", "/sitemap_index.xml", "/sitemap-index.xml", "/sitemap1.xml", "/sitemaps.xml", "/wp-sitemap.xml",
    "/post-sitemap.xml", "/page-sitemap.xml", "/news-sitemap.xml", "/sitemap-news.xml", "/sitemap_news.xml", "/sitemap/sitemap.xml",
    "/sitemaps/sitemap.xml",
)
FEED_PATHS = (
    "/feed", "/rss", "/rss.xml", "/atom.xml", "/feed.xml", "/index.xml",
)
# Steps of a path that promise little.
LOW_VALUE_PARTS = (
    "login", "signup", "register", "cart", "checkout", "search", "tag", "tags", "calendar", "account", "author", "category", "archive", "privacy",
    "terms",
)
# Steps of a path that promise content.
CONTENT_STEPS = ("/docs/", "/reference/", "/tutorial/", "/guide/", "/article/", "/wiki/", "/publication/")
# Parts of host names that mark spam, top-level domains read as English, public suffixes of two labels.
SPAM_TERMS = (
    "sex", "porn", "xxx", "casino", "bet", "gambling", "viagra", "loan", "payday",
)
ENGLISH_TLDS = (
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "pro", "io", "co", "ai", "app", "dev", "tech", "cloud", "site", "online",
    "blog", "news", "media", "digital", "software", "systems", "company", "services", "solutions", "us", "uk", "ca", "au", "nz", "ie",
)
TWO_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "sch.uk", "net.uk", "me.uk", "ltd.uk", "plc.uk", "co.nz", "org.nz", "net.nz", "govt.nz", "ac.nz", "com.au",
    "net.au", "org.au", "gov.au", "edu.au", "id.au", "co.ie", "org.ie", "co.il", "gov.il", "co.in", "gov.in", "co.za", "org.za", "gov.za", "com.sg",
    "com.hk", "com.my",
)
# Beginnings of pages that check for robots.
CHALLENGE_MARKERS = ("checking your browser", "just a moment", "cf-browser-verification", "cf-chl-", "verify you are human", "enable javascript and cookies", "attention required! | cloudflare", "captcha", "access denied")
# Errors that mean a site blocks its visitor.
BLOCKING_ERRORS = ("http_403", "http_429", "http_503", "403", "429", "503", "challenge_page")
# Base scores of candidates by source.
SOURCE_SCORES = {"feed": 100.0, "sitemap": 80.0, "link_depth1": 50.0, "homepage_link": 40.0}
OTHER_SCORE = 10.0
# Fixed value: root of relative archive paths.
DATA_ROOT = "https://data.commoncrawl.org/"
# What a candidate gains by a date, at most by its freshness and by a content path, and loses by a query; days for a point of freshness.
DATED_SCORE, FRESH_SCORE, CONTENT_SCORE, QUERY_SCORE, DAYS_PER_POINT = 10.0, 30.0, 15.0, 10.0, 7.0
