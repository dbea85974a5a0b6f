"""Payload normalisation: landed raw API responses -> typed entity rows.

Input frames carry the request context (company, subreddit, board, ...) next to the
raw response text ``payload``. Each normaliser is a pure DataFrame -> DataFrame
function built from ``from_json`` / ``inline`` / ``posexplode`` and column defaults, so
Catalyst prunes JSON fields that are not used downstream and the parse runs in
whole-stage code, one pass per payload.

Records that lack a required field (or whose element is not valid JSON) are not
silently dropped: ``quarantine_split`` separates them with a reason so the batch keeps
going (per record, where the single-machine original lost the whole fetch).
"""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas
from kestrel.functions.scalars import falsy_coalesce, nonempty, story_key

PAYLOAD = "payload"
BAD = "_bad"


#: Column of quarantined rows that holds the text of a page that could not be read.
PAGE_TEXT = "_page"


def _broken_page(payload: Column, parsed: Column, opens: str) -> Column:
    """The text of a page that is not wholly the JSON it should be (truncated, an error object, a web page), else null."""
    whole = F.try_parse_json(payload).isNotNull() & parsed.isNotNull() & F.ltrim(payload).startswith(opens)
    return F.when(payload.isNotNull() & ~F.coalesce(whole, F.lit(False)), payload)


def _number(text: Column) -> Column:
    """An integer sent as a number or as text; null where it is neither or does not fit."""
    return text.try_cast("double").try_cast("int")


def _keys(elem: Column) -> Column:
    return F.coalesce(F.json_object_keys(elem), F.array().cast("array<string>"))


def tag_bad(df: DataFrame, required: Sequence[str], extra_bad: Column | None = None) -> DataFrame:
    """``df`` with a ``_bad`` column: why a row is no valid record, null if it is one."""
    reason = F.lit(None).cast("string")
    for c in reversed(list(required)):
        reason = F.when(F.col(c).isNull(), F.lit(f"missing {c}")).otherwise(reason)
    if extra_bad is not None:
        reason = F.when(extra_bad.isNotNull(), extra_bad).otherwise(reason)
    return df.withColumn(BAD, reason)


def quarantine_split(df: DataFrame, required: Sequence[str], extra_bad: Column | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with a ``_bad`` reason). One pass over ``df`` each."""
    tagged = tag_bad(df, required, extra_bad)
    return tagged.where(F.col(BAD).isNull()).drop(BAD), tagged.where(F.col(BAD).isNotNull())


def _outcome(tagged: DataFrame, with_quarantine: bool, as_tagged: bool):
    """What a parser returns: valid rows, (valid, quarantined), or all rows with ``_bad`` (for one pass over both)."""
    if as_tagged:
        return tagged
    valid = tagged.where(F.col(BAD).isNull()).drop(BAD, PAGE_TEXT)
    return (valid, tagged.where(F.col(BAD).isNotNull())) if with_quarantine else valid


# --- N1 repo list -> github_repos -------------------------------------------------------------
# Required fields of a repo record (the request supplies org).
REPO_REQUIRED = [c for c in schemas.REQUIRED["github_repos"] if c != "org"]


def parse_repos(df: DataFrame, org: str = "org", scraped_at: Column | None = None,
                with_quarantine: bool = False, keep: Sequence[str] = (), tagged: bool = False):
    """Repo list payload (a JSON array) -> github_repos rows.

    ``stargazers_count``/``forks_count``/``open_issues_count`` map to stars/forks/open_issues,
    the short names are accepted too. ``description`` may be absent, ``language`` may be null
    but its key is required. Each element is parsed once, as a map, which gives key presence
    and values together; numbers sent as text are accepted (lax coercion), other
    mismatches, and numbers that do not fit, become nulls and the record is quarantined. A page
    that is no list is one quarantined row with the page's text. ``keep`` names context columns, or
    ``position`` (the place in the page), to carry along.
    """
    ctx = [c for c in df.columns if c not in (PAYLOAD, "position")]
    page = F.from_json(F.col(PAYLOAD), "array<map<string,string>>")
    read = df.select(*ctx, PAYLOAD, page.alias("__items"))  # parsed once, for both uses
    broken = _broken_page(F.col(PAYLOAD), F.col("__items"), "[")
    el = read.select(*ctx, broken.alias("__page"), F.posexplode_outer("__items").alias("position", "__m"))
    el = el.where(F.col("position").isNotNull() | F.col("__page").isNotNull())
    m = F.col("__m")

    def num(*names: str) -> Column:
        return F.coalesce(*[F.expr(f"try_cast(__m['{n}'] AS BIGINT)") for n in names]).try_cast("int")

    out = el.select(
        *[c for c in keep if c in el.columns], F.col("__page").alias(PAGE_TEXT),
        m["full_name"].alias("full_name"), F.col(org).alias("org"), m["name"].alias("name"),
        m["description"].alias("description"), m["language"].alias("language"),
        num("stargazers_count", "stars").alias("stars"),
        num("forks_count", "forks").alias("forks"),
        num("open_issues_count", "open_issues").alias("open_issues"),
        F.expr("try_cast(__m['pushed_at'] AS TIMESTAMP)").alias("pushed_at"),
        (scraped_at if scraped_at is not None else F.lit(None).cast("timestamp")).alias("scraped_at"),
        F.when(F.col("__page").isNotNull(), F.lit("unparsable page"))
        .when(m.isNull(), F.lit("malformed record"))
        .when(~F.map_contains_key(m, "language"), F.lit("missing language")).alias("__why"),
    )
    return _outcome(tag_bad(out, REPO_REQUIRED, F.col("__why")).drop("__why"), with_quarantine, tagged)


# --- N2 contributors ------------------------------------------------------------------------
CONTRIB_ITEMS = "array<struct<login: string, contributions: string, avatar_url: string>>"


def parse_contributors(df: DataFrame, with_quarantine: bool = False, tagged: bool = False):
    """Contributor list payload -> (context, login, contributions, avatar_url), every entry of every page.

    An entry without login or contributions, and a page that is no list, is quarantined.
    """
    ctx = [c for c in df.columns if c != PAYLOAD]
    page = F.from_json(F.col(PAYLOAD), CONTRIB_ITEMS)
    ex = df.select(*ctx, _broken_page(F.col(PAYLOAD), page, "[").alias("__page"), F.posexplode_outer(page).alias("__at", "__c"))
    c = F.col("__c")
    out = ex.where(F.col("__at").isNotNull() | F.col("__page").isNotNull()).select(
        *ctx, c["login"].alias("login"), _number(c["contributions"]).alias("contributions"),
        c["avatar_url"].alias("avatar_url"), F.col("__page").alias(PAGE_TEXT),
    )
    why = F.when(F.col(PAGE_TEXT).isNotNull(), F.lit("unparsable page"))
    return _outcome(tag_bad(out, ["login", "contributions"], why), with_quarantine, tagged)


# --- N3 story search -> hn stories ----------------------------------------------------------------
HIT_ITEM = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("story_title", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("points", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("created_at", T.TimestampType()),
    T.StructField("num_comments", T.StringType()),
])


def parse_stories(df: DataFrame, company: str = "company", key_form: str = "item",
                  scraped_at: Column | None = None, with_quarantine: bool = False, tagged: bool = False):
    """Story search payload ``{"hits": [...]}`` -> hn story rows (missing ``hits`` -> no rows).

    title = title or story_title or "(no title)"; points / num_comments falsy -> 0;
    author falsy -> "anonymous"; url kept as sent; ``story_url`` = url or a fallback key. Numbers sent
    as text are accepted; a number that does not fit, and a page that is no object, is quarantined.
    """
    page = F.from_json(F.col(PAYLOAD), T.StructType([T.StructField("hits", T.ArrayType(HIT_ITEM))]))
    ctx = [c for c in df.columns if c != PAYLOAD]
    read = df.select(*ctx, PAYLOAD, page.alias("__read"))  # parsed once, for both uses
    ex = read.select(*ctx, _broken_page(F.col(PAYLOAD), F.col("__read"), "{").alias("__page"), F.posexplode_outer(F.col("__read")["hits"]).alias("position", "__h"))
    ex = ex.where(F.col("position").isNotNull() | F.col("__page").isNotNull())
    h = F.col("__h")
    unfit = [F.coalesce(h[c], F.lit("0")).isNotNull() & _number(F.coalesce(h[c], F.lit("0"))).isNull() for c in ("points", "num_comments")]
    why = F.when(F.col("__page").isNotNull(), F.lit("unparsable page")).when(unfit[0], F.lit("bad points")).when(unfit[1], F.lit("bad num_comments"))
    title = falsy_coalesce(h["title"], h["story_title"], default="(no title)")
    out = ex.select(
        *ctx, "position",
        title.alias("title"), h["url"].alias("url"),
        F.coalesce(_number(h["points"]), F.lit(0)).alias("points"),
        falsy_coalesce(h["author"], default="anonymous").alias("author"),
        h["created_at"].alias("created_at"),
        F.coalesce(_number(h["num_comments"]), F.lit(0)).alias("num_comments"),
        F.col("__page").alias(PAGE_TEXT), why.alias("__why"),
    )
    out = out.select(
        "*", story_key(F.col("url"), F.col("title"), F.col("created_at"), form=key_form).alias("story_url"),
        (scraped_at if scraped_at is not None else F.lit(None).cast("timestamp")).alias("scraped_at"),
    )
    return _outcome(tag_bad(out, ["created_at"], F.col("__why")).drop("__why"), with_quarantine, tagged)


# --- N4 forum listing -> posts ----------------------------------------------------------------
POST_ITEM = T.StructType([
    T.StructField("subreddit", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("num_comments", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("created_utc", T.DoubleType()),
    T.StructField("permalink", T.StringType()),
])
LISTING = T.StructType([T.StructField("data", T.StructType([
    T.StructField("children", T.ArrayType(T.StructType([T.StructField("data", POST_ITEM)]))),
]))])


def parse_posts(df: DataFrame, subreddit: str = "subreddit", with_quarantine: bool = False, tagged: bool = False):
    """Listing ``{"data": {"children": [{"data": {...}}]}}`` -> forum posts with falsy defaults.

    subreddit -> the requested one; title -> "(no title)"; score / comments -> 0;
    author -> "[deleted]"; created_utc epoch seconds (0 when falsy) -> UTC timestamp; permalink -> "".
    A number that does not fit, and a page that is no listing, is quarantined.
    """
    listing = F.from_json(F.col(PAYLOAD), LISTING)
    ctx = [c for c in df.columns if c != PAYLOAD]
    broken = _broken_page(F.col(PAYLOAD), listing["data"], "{")
    ex = df.select(*ctx, broken.alias("__page"), F.posexplode_outer(listing["data"]["children"]).alias("__at", "__c"))
    ex = ex.where(F.col("__at").isNotNull() | F.col("__page").isNotNull())
    d = F.col("__c")["data"]
    why = F.when(F.col("__page").isNotNull(), F.lit("unparsable page")).when(d.isNull(), F.lit("malformed record"))
    for name in ("score", "num_comments"):
        why = why.when(d[name].isNotNull() & _number(d[name]).isNull(), F.lit(f"bad {name}"))
    out = ex.select(
        *[c for c in ctx if c != subreddit],
        falsy_coalesce(d["subreddit"], F.col(subreddit)).alias("subreddit"),
        falsy_coalesce(d["title"], default="(no title)").alias("title"),
        F.coalesce(_number(d["score"]), F.lit(0)).alias("score"),
        F.coalesce(_number(d["num_comments"]), F.lit(0)).alias("num_comments"),
        falsy_coalesce(d["author"], default="[deleted]").alias("author"),
        F.timestamp_seconds(F.coalesce(d["created_utc"], F.lit(0.0))).alias("created_utc"),
        F.coalesce(d["permalink"], F.lit("")).alias("permalink"),
        F.col("__page").alias(PAGE_TEXT), why.alias("__why"),
    )
    return _outcome(tag_bad(out, [], F.col("__why")).drop("__why"), with_quarantine, tagged)


# --- N5/N6 encyclopedia facts ----------------------------------------------------------------
SEARCH = "query struct<search: array<struct<title: string>>>"
SUMMARY = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("extract", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("content_urls", T.StructType([T.StructField("desktop", T.StructType([
        T.StructField("page", T.StringType())]))])),
    T.StructField("thumbnail", T.StructType([T.StructField("source", T.StringType())])),
])


def resolve_titles(search: DataFrame, name: str = "name") -> DataFrame:
    """Search payload -> (name, title of the first hit, or null when there is none)."""
    hits = F.from_json(F.col(PAYLOAD), SEARCH)["query"]["search"]
    return search.select(F.col(name).alias("name"), F.get(hits, 0)["title"].alias("searched_title"))


def parse_facts(titles: DataFrame, summaries: DataFrame, scraped_at: Column | None = None,
                with_quarantine: bool = False, tagged: bool = False):
    """(name, searched_title) x (name, status, payload) -> company facts.

    No search hit or a 404 summary gives no row. ``title`` falls back to the searched
    title only when the key is absent from the summary. Any other response than a 200 (a missing status counts as one)
    with a JSON object is quarantined, so that it overwrites no stored facts.
    """
    parsed = F.from_json(F.col(PAYLOAD), SUMMARY)
    s = summaries.select(
        F.col("name"), F.coalesce(F.col("status"), F.lit(200)).alias("status"), parsed.alias("__s"), _keys(F.col(PAYLOAD)).alias("__k"),
        F.coalesce(_broken_page(F.col(PAYLOAD), parsed, "{"), F.when(F.col(PAYLOAD).isNull(), F.lit(""))).alias("__page"), F.col(PAYLOAD).alias("__sent"),
    )
    j = titles.where(F.col("searched_title").isNotNull()).join(s, "name", "inner").where(F.col("status") != 404)
    d = F.col("__s")
    title = F.when(F.array_contains("__k", "title"), d["title"]).otherwise(F.col("searched_title"))
    why = F.when(F.col("status") != 200, F.concat(F.lit("status "), F.col("status").cast("string"))).when(F.col("__page").isNotNull(), F.lit("unparsable page"))
    out = j.select(
        F.col("name"), title.alias("title"), d["extract"].alias("summary"), d["description"].alias("description"),
        d["content_urls"]["desktop"]["page"].alias("url"), d["thumbnail"]["source"].alias("thumbnail_url"),
        (scraped_at if scraped_at is not None else F.lit(None).cast("timestamp")).alias("scraped_at"),
        F.when(why.isNotNull(), F.coalesce("__sent", "__page")).alias(PAGE_TEXT), why.alias("__why"),
    )
    return _outcome(tag_bad(out, ["name", "title"], F.col("__why")).drop("__why"), with_quarantine, tagged)


# --- N8 job-board HTML -> listings -----------------------------------------------------------
# Board rules (fixed values). A posting block is cut either by a closing tag
# (``block``) or by splitting at each posting start (``split``).
def _cls(token: str) -> str:
    """Regex for a class attribute holding ``token`` as one whitespace-separated class."""
    return rf"""class\s*=\s*["'](?:[^"']*\s)?{token}(?:\s[^"']*)?["']"""


JOB_BOARDS = {
    "lever": {
        "url": "https://jobs.lever.co/{slug}",
        "split": rf"<div[^>]*{_cls('posting')}[^>]*>",
        "title": r"(?s)<h5[^>]*>(.*?)</h5>",
        "location": rf"(?s){_cls('posting-categories')}.*?{_cls('location')}[^>]*>(.*?)</",
        "link": rf"<a[^>]*{_cls('posting-title')}[^>]*>",
    },
    "greenhouse": {
        "url": "https://boards.greenhouse.io/{slug}",
        "split": rf"<div[^>]*{_cls('opening')}[^>]*>",
        "title": r"(?s)<a[^>]*>(.*?)</a>",
        "location": rf"(?s){_cls('location')}[^>]*>(.*?)</",
        "link": r"<a[^>]*>",
    },
    "links": {
        "url": "{slug}",
        "block": r"(?s)<li[^>]*>(.*?)</li>",
        "title": r"(?s)<a[^>]*>(.*?)</a>",
        "location": None,
        "link": r"<a[^>]*>",
    },
}

# Character references decoded in extracted text (fixed values).
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                 ("&nbsp;", " "), ("&amp;", "&")]


_REFERENCE = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _decoded(reference: Column) -> Column:
    """The character of a numeric or named reference; an unknown one stays as written."""
    names = {f"&{name};": chr(code) for name, code in sorted(name2codepoint.items())} | dict(HTML_ENTITIES)
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[reference]
    digits = F.regexp_extract(reference, "&#[xX]?([0-9a-fA-F]+);", 1)
    code = F.conv(digits, 10, 16)
    code = F.when(F.lower(reference).startswith("&#x"), digits).otherwise(code)
    point = F.conv(code, 16, 10).cast("long")
    valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    numeric = F.when((digits != "") & valid, F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32"))
    return F.coalesce(known, numeric, reference)


def html_text(c: Column) -> Column:
    """Inner text of an HTML fragment: tags removed, character references decoded once, whitespace trimmed."""
    out = F.regexp_replace(c, r"<[^>]+>", "")
    between = F.split(out, _REFERENCE, -1)
    found = F.transform(F.regexp_extract_all(out, F.lit(_REFERENCE), 0), _decoded)
    pairs = F.arrays_zip(between.alias("t"), found.alias("r"))
    joined = F.array_join(F.transform(pairs, lambda p: F.concat(p["t"], F.coalesce(p["r"], F.lit("")))), "")
    return F.trim(F.when(F.contains(out, F.lit("&")), joined).otherwise(out))


def _href(tag: Column) -> Column:
    return F.coalesce(nonempty(F.regexp_extract(tag, r'href\s*=\s*"([^"]*)"', 1)), F.regexp_extract(tag, r"href\s*=\s*'([^']*)'", 1))


def parse_listings(pages: DataFrame, board: str, url: str = "url", html: str = "html",
                   company: str = "company") -> DataFrame:
    """Job-board pages of one board -> listings (blank titles dropped, href defaults to the page URL)."""
    if board not in JOB_BOARDS:
        raise ValueError(f"No rules for job board {board!r}; there are rules for {', '.join(sorted(JOB_BOARDS))}")
    rule = JOB_BOARDS[board]
    if "block" in rule:
        blocks = F.regexp_extract_all(F.col(html), F.lit(rule["block"]), 1)
    else:
        blocks = F.slice(F.split(F.col(html), rule["split"]), 2, 1 << 30)
    ex = pages.select(F.col(company).alias("company"), F.col(url).alias("__page"), F.explode(blocks).alias("__b"))
    b = F.col("__b")
    title = html_text(F.regexp_extract(b, rule["title"], 1))
    location = (F.when(F.regexp_extract(b, rule["location"], 0) != "", html_text(F.regexp_extract(b, rule["location"], 1)))
                if rule["location"] else F.lit(None).cast("string"))
    href = _href(F.regexp_extract(b, rule["link"], 0))
    out = ex.select(
        "company", title.alias("title"), location.alias("location"),
        F.lit(None).cast("string").alias("posted_at"),
        F.coalesce(nonempty(href), F.col("__page")).alias("source_url"),
    )
    return out.where(F.col("title") != "")


def board_url(board: str, slug: str) -> str:
    return JOB_BOARDS[board]["url"].format(slug=slug)
