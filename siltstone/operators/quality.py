"""What a page must be to count as a posting, what a batch must be to pass, and how complete tables are."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.markup import JOB_KEYWORDS, NAV_TITLES, job_keyword

# Last parts of paths, and pieces of paths, that name sections; ends of titles that name categories; hosts of profiles.
SECTION_SEGMENTS = (
    "about", "about-us", "advice", "article", "articles", "blog", "blogs", "browse", "browse-jobs", "career", "career-advice", "careers", "candidate", "candidates", "candidat", "category", "categories", "companies", "company",
    "contact", "cookie", "cookies", "discover", "employer", "employers", "faq", "featured", "focus-on", "help", "home", "job", "job-category", "job-search", "job-tag", "jobs", "login", "menu", "news", "newsletter", "privacy",
    "register", "saved", "saved-jobs", "savjet", "search", "signin", "sign-in", "signup", "sign-up", "support", "tag", "tags", "terms", "terms-of-service", "today", "vacancies", "vacancy",
)
SECTION_FRAGMENTS = (
    "/news/", "/blog/", "/article/", "/articles/", "/advice/", "/career-advice/", "/focus-on/", "/site-highlight/", "/savjet/", "/discover/", "/category/", "/job-category/", "/job-tag/", "/job-search/", "/mot-cle", "/categorie_",
    "/companies/", "/company/", "/employers/", "/employer/", "/help/", "/support/", "/privacy", "/terms", "/cookie", "/login", "/signin", "/sign-in", "/signup", "/sign-up", "/register", "/search", "/browse-jobs", "/saved-jobs", "/classifieds",
)
CATEGORY_SUFFIXES = (" jobs", " job", " jobs in", " vacancies", " careers", " job search", " recruitment")
PROFILE_HOSTS = ("linkedin.com", "facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com", "apps.apple.com", "itunes.apple.com", "music.apple.com", "play.google.com", "t.me", "whatsapp.com")
LEAST_DESCRIPTION, CATEGORY_TITLE_CHARS = 80, 60


def host_of(url: Column) -> Column:
    """The host in lower case without www.; null where there is none."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), "^www[.]", "")


def same_site(host: Column, site: Column) -> Column:
    """Whether host is the site or one of its sub-domains; false where either is missing."""
    h, s = (F.regexp_replace(F.lower(c), "^www[.]", "") for c in (host, site))
    return F.coalesce((F.length(h) > 0) & (F.length(s) > 0) & ((h == s) | h.endswith(F.concat(F.lit("."), s))), F.lit(False))


def path_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def reject_reason(url: Column, title: Column, description: Column, site: Column | None = None, detail_pattern: str = "", least: int = LEAST_DESCRIPTION) -> Column:
    """The first reason why a page is no posting, by its address, then by its text; null if there is none.

    A path that fits the site's own detail_pattern is not judged further, its
    title and description are.
    """
    path = path_of(url)
    parts = _segments(path)
    last = F.try_element_at(parts, F.lit(-1))
    stem = F.when(last.contains("."), F.regexp_replace(last, r"[.][^.]*$", "")).otherwise(last)
    host = host_of(url)
    offsite = F.lit(False) if site is None else (F.length(host) > 0) & (F.length(site) > 0) & ~same_site(host, site)
    detail = (path.rlike(f"(?i){detail_pattern}") | url.rlike(f"(?i){detail_pattern}")) if detail_pattern else F.lit(False)
    section = F.coalesce(*[F.when(path.contains(f), f"section path ({f.strip('/')})") for f in SECTION_FRAGMENTS])
    listing = stem.isin(*SECTION_SEGMENTS) | ((F.size(parts) == 1) & stem.rlike("|".join(JOB_KEYWORDS)))
    by_path = F.when(section.isNotNull(), section).when(path.rlike(r"/\d{4}/\d{2}/\d{2}/"), "news article path (dated)").when(~job_keyword(path), "path has no job keyword")
    by_path = by_path.when(listing, F.concat(F.lit("listing page (/"), last, F.lit(")"))).when(last.rlike("(?:-jobs|-job|_jobs)$") & (last != "saved-jobs"), "category path (ends in -jobs)")
    named = F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)^\s+|\s+$", "")
    bare = F.regexp_replace(F.lower(named), r"^[ .:!\-–—]+|[ .:!\-–—]+$", "")
    body = F.regexp_replace(F.coalesce(description, F.lit("")), r"(?U)^\s+|\s+$", "")
    by_text = F.when(named == "", "no title").when(bare.isin(*NAV_TITLES), "navigation title")
    by_text = by_text.when((F.length(named) <= CATEGORY_TITLE_CHARS) & F.exists(F.array(*map(F.lit, CATEGORY_SUFFIXES)), lambda s: bare.endswith(s)), "category title").when(F.length(named) < 3, "title too short")
    by_text = by_text.when(F.length(body) < least, F.concat(F.lit("no job description ("), F.length(body).cast("string"), F.lit(" chars)")))
    address = F.when(F.size(parts) == 0, "site root, not a posting").when(offsite, F.concat(F.lit("offsite link ("), host, F.lit(")"))).when(~detail, by_path)
    return F.when(url.isNull() | (url == ""), "no url").otherwise(F.coalesce(address, by_text))


def job_link(link: Column) -> Column:
    """Whether a link looks like a posting's own page: a path with a posting's word that names no section and no category."""
    path = path_of(link)
    last = F.try_element_at(_segments(path), F.lit(-1))
    section = reduce(lambda a, b: a | b, [path.contains(f) for f in SECTION_FRAGMENTS])
    profile = F.coalesce(host_of(link).rlike("(?:^|[.])(?:" + "|".join(h.replace(".", "[.]") for h in PROFILE_HOSTS) + ")$"), F.lit(False))
    return (F.length(path) > 1) & job_keyword(path) & ~section & ~F.coalesce(last.isin(*SECTION_SEGMENTS) | last.rlike("-jobs?$") | last.contains("-jobs-in-"), F.lit(False)) & ~profile


def links(page: Column, base: Column) -> Column:
    """The links of a page's anchors that look like postings, each once, on the page's own host where they are relative."""
    hrefs = F.array_distinct(F.regexp_extract_all(page, F.lit(r"(?i)<a\b[^>]*?\shref=\"([^\"#]+)"), F.lit(1)))
    root = F.regexp_extract(base, r"^([A-Za-z]+://[^/?#]+)", 1)
    whole = F.transform(hrefs, lambda h: F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h).when(h.startswith("/"), F.concat(root, h)).otherwise(F.concat(root, F.lit("/"), h)))
    return F.filter(whole, job_link)


def completeness(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """column_name, n_null and null_pct (to the tenth), worst first: one pass over the rows."""
    columns = list(columns)
    counts = rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    shown = counts.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns])).alias("x"))
    return shown.select("x.column_name", "x.n_null", F.round(100.0 * F.col("x.n_null") / F.nullif("total", F.lit(0)), 1).alias("null_pct")).orderBy(F.desc("null_pct"), "column_name")


def batch_report(raw: DataFrame, parsed: DataFrame, key: str, missing: dict[str, Column], least: int, most_skipped: float) -> DataFrame:
    """One row on a batch: totals, skip_rate, duplicate_ids (sorted), the rate at which each field is missing, issues, passed. Rates of fields are told, not judged."""
    n_raw = raw.agg(F.count(F.lit(1)).alias("total_raw"))
    sums = parsed.agg(F.count(F.lit(1)).alias("total_parsed"), *[F.count_if(c).alias(f"missing_{name}") for name, c in missing.items()])
    twice = parsed.groupBy(key).count().where("count > 1").agg(F.sort_array(F.collect_set(key)).alias("duplicate_ids"))
    one = n_raw.crossJoin(sums).crossJoin(twice)  # one row each
    one = one.withColumn("skip_rate", F.when(F.col("total_raw") > 0, (F.col("total_raw") - F.col("total_parsed")) / F.col("total_raw")).otherwise(0.0))
    rates = [F.when(F.col("total_parsed") > 0, F.col(f"missing_{name}") / F.col("total_parsed")).otherwise(0.0).alias(f"missing_{name}") for name in missing]
    issues = F.array_compact(F.array(F.when(F.col("total_raw") == 0, "no raw records"), F.when(F.col("total_parsed") < least, "too few parsed"), F.when(F.col("skip_rate") > most_skipped, "too many skipped"), F.when(F.size("duplicate_ids") > 0, "duplicate ids")))
    return one.select("total_raw", "total_parsed", "skip_rate", "duplicate_ids", *rates, issues.alias("issues"), (F.size(issues) == 0).alias("passed"))
