"""Company signals beyond the gold rollup: shares, cadence, contributors, volume, sentiment,
hiring, keyword alerts, peer ranks, page extraction, mention matching, integrity and
baselines. Each is a DataFrame job; no driver-side loops over data.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.operators.dq import is_missing
from kestrel.operators.ranking import rank_within
from kestrel.sources.payloads import html_text

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def ngrams(toks: Column, k: int) -> Column:
    """Space-joined k-grams of a token array, built in O(n k) by zipping shifted copies."""
    if k == 1:
        return toks
    out = toks
    for j in range(1, k):
        shifted = F.slice(toks, j + 1, F.greatest(F.size(toks) - j, F.lit(0)))
        out = F.zip_with(out, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_compact(out)


def tokens(text: Column) -> Column:
    """Lower-cased word tokens of a whole text (letters and digits; everything else separates)."""
    return F.array_remove(F.split(F.lower(text), TOKEN_SPLIT), "")


# --- X5 language share ----------------------------------------------------------------------
def language_share(repos: DataFrame) -> DataFrame:
    """Per (org, language): repo count, stars, and the share of the org's repos.

    The window runs over the aggregated (org, language) rows - at most a few per org.
    """
    agg = repos.groupBy("org", "language").agg(
        F.count(F.lit(1)).alias("repo_count"), F.sum("stars").cast("bigint").alias("total_stars")
    )
    w = Window.partitionBy("org")
    return agg.withColumn("share", F.round(F.col("repo_count") / F.sum("repo_count").over(w), 6))


# --- X6 cadence -----------------------------------------------------------------------------
def cadence(df: DataFrame, group: str, ts: str) -> DataFrame:
    """Mean gap (days) between consecutive events per group.

    The mean of consecutive gaps telescopes to (last - first) / (n - 1), so this is one
    aggregate - no per-group sort, nothing skew-sensitive.
    """
    agg = df.where(F.col(ts).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("events"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at")
    )
    span_days = (F.unix_micros(F.col("last_at").cast("timestamp")) - F.unix_micros(F.col("first_at").cast("timestamp"))) / F.lit(86_400_000_000.0)
    return agg.withColumn(
        "mean_gap_days", F.when(F.col("events") > 1, F.round(span_days / (F.col("events") - 1), 6))
    )


# --- X7 contributors ------------------------------------------------------------------------
def contributor_stats(contributors: DataFrame, repo: str = "repo", order_key: str | None = None) -> DataFrame:
    """Per repo: contributor count, total contributions, top contributor (ties: smallest ``order_key``)."""
    tie = -F.col(order_key) if order_key else F.lit(0)
    return contributors.groupBy(repo).agg(
        F.count("login").alias("contributors"),
        F.sum("contributions").cast("bigint").alias("contributions"),
        F.max_by("login", F.struct(F.col("contributions"), tie)).alias("top_contributor"),
    )


# --- X9 volume ------------------------------------------------------------------------------
def forum_volume(posts: DataFrame, company: str = "company") -> DataFrame:
    """Per (company, subreddit): mentions, comment volume and score."""
    return posts.groupBy(company, "subreddit").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.sum("num_comments").cast("bigint").alias("total_comments"),
        F.sum("score").cast("bigint").alias("total_score"),
    )


# --- X10 sentiment --------------------------------------------------------------------------
# Sentiment lexicon (fixed values): word -> weight, four languages.
LEXICON = {
    "good": 1.0, "great": 1.0, "best": 1.0, "excellent": 1.0, "love": 1.0, "happy": 1.0,
    "bon": 1.0, "bien": 1.0, "gut": 1.0, "bueno": 1.0, "mejor": 1.0, "super": 1.0,
    "bad": -1.0, "worst": -1.0, "poor": -1.0, "hate": -1.0, "terrible": -1.0, "awful": -1.0,
    "mal": -1.0, "mauvais": -1.0, "schlecht": -1.0, "malo": -1.0, "peor": -1.0,
}


def sentiment(docs: DataFrame, group: str, lexicon: dict[str, float] | None = None, text: str = "text") -> DataFrame:
    """Per group: documents, tokens, lexicon hits and score = sum(weight) / tokens.

    The lexicon is a literal map and each text is weighed within its row, so one small aggregate
    per group is all that is shuffled.
    """
    words = lexicon or LEXICON
    weights = F.create_map(*[F.lit(x) for pair in sorted(words.items()) for x in pair])
    each = docs.select(group, tokens(F.col(text)).alias("__t")).select(
        group, F.greatest(F.size("__t"), F.lit(0)).alias("__n"), F.filter("__t", lambda x: x.isin(*sorted(words))).alias("__h"))
    agg = each.groupBy(group).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("__n").cast("bigint").alias("tokens"),
        F.sum(F.greatest(F.size("__h"), F.lit(0))).cast("bigint").alias("hits"),
        F.sum(F.aggregate("__h", F.lit(0.0), lambda a, x: a + weights[x])).alias("__w"),
    )
    return agg.select(
        group, "documents", "tokens", "hits",
        F.when(F.col("tokens") > 0, F.round(F.coalesce(F.col("__w"), F.lit(0.0)) / F.col("tokens"), 6)).alias("score"),
    )


def mention_sentiment(docs: DataFrame, names: Sequence[str], within: int = 10, lexicon: dict[str, float] | None = None,
                      text: str = "text") -> DataFrame:
    """Per company: documents and mentions of it, the lexicon words within ``within`` tokens of a mention, and their mean weight.

    A name is matched on token boundaries. The tokens near any mention of a name are a set of places, so a word counts
    once for a name however many mentions it is near; the name's own tokens never count. All of it happens within the row, in
    time linear in the text and ``within`` * mentions; one row per document and company found is aggregated.
    """
    words = lexicon or LEXICON
    weights = F.create_map(*[F.lit(x) for pair in sorted(words.items()) for x in pair])
    split = {n: [t for t in re.split(r"[\W_]+", n.lower()) if t] for n in names}
    lengths = sorted({len(t) for t in split.values() if t})
    each = docs.select(tokens(F.col(text)).alias("__t")).select("__t", *[ngrams(F.col("__t"), k).alias(f"__g{k}") for k in lengths])

    def told(name: str, toks: list[str]) -> Column:
        k = len(toks)
        starts = F.filter(F.transform(f"__g{k}", lambda g, i: F.when(g == " ".join(toks), i)), lambda i: i.isNotNull())
        return F.struct(F.lit(name).alias("company"), F.lit(k).alias("k"), starts.alias("starts"))

    found = F.filter(F.array(*[told(n, t) for n, t in split.items() if t]), lambda x: F.size(x["starts"]) > 0)
    rows = each.select("__t", F.explode(found).alias("m"))
    near = F.flatten(F.transform("m.starts", lambda i: F.sequence(F.greatest(i - within, F.lit(0)), F.least(i + F.col("m.k") - 1 + within, F.size("__t") - 1))))
    own = F.flatten(F.transform("m.starts", lambda i: F.sequence(i, i + F.col("m.k") - 1)))
    heard = rows.select(F.col("m.company").alias("company"), F.size("m.starts").cast("bigint").alias("n"), "__t", F.array_except(near, own).alias("__at"))
    heard = heard.select("company", "n", F.filter(F.transform("__at", lambda i: weights[F.get("__t", i)]), lambda w: w.isNotNull()).alias("__w"))
    agg = heard.groupBy("company").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n").alias("mentions"), F.sum(F.size("__w")).cast("bigint").alias("hits"),
        F.sum(F.aggregate("__w", F.lit(0.0), lambda a, w: a + w)).alias("__sum"))
    return agg.select("company", "documents", "mentions", "hits", F.round(F.when(F.col("hits") > 0, F.col("__sum") / F.col("hits")), 6).alias("score"))


# --- X11 hiring -----------------------------------------------------------------------------
# Role families (fixed values): first matching rule wins, else "other".
ROLE_FAMILIES = [
    ("engineering", "engineer|developer|programmer|sre|devops"),
    ("data", "data|analyst|analytics|scientist|machine learning|ml"),
    ("product", "product|designer|ux|ui"),
    ("sales", "sales|account executive|business development"),
    ("operations", "operations|support|recruiter|finance|legal"),
]


def word_pattern(alternatives: str) -> str:
    """Case-insensitive match of any alternative as whole words (letters/digits delimit words)."""
    return rf"(?i)(^|[^\p{{L}}\p{{N}}])({alternatives})([^\p{{L}}\p{{N}}]|$)"


def role_family(title: Column) -> Column:
    expr = F.lit("other")
    for name, pattern in reversed(ROLE_FAMILIES):
        expr = F.when(title.rlike(word_pattern(pattern)), F.lit(name)).otherwise(expr)
    return expr


def hiring_signals(listings: DataFrame) -> DataFrame:
    """Open roles per company x location x role family."""
    return listings.groupBy("company", "location", role_family(F.col("title")).alias("role_family")).agg(
        F.count(F.lit(1)).alias("openings")
    )


def posting_periods(listings: DataFrame, posting: str = "source_url", scraped_on: str = "scraped_on", snapshots: DataFrame | None = None) -> DataFrame:
    """When each posting of each company was open: company, ``posting``, opened, closed.

    A company's board is looked at on its snapshot days: those of ``snapshots`` (company, day), which also holds days on
    which a board was empty, or else those on which it had a posting. A period is a stretch of neighbouring snapshots that all
    show the posting; it is closed on the first snapshot without it (null: still open on the last one). The windows run over
    a company's days and a posting's days, never over raw rows.
    """
    shown = listings.select("company", posting, F.col(scraped_on).cast("date").alias("day")).dropna().distinct()
    days = shown.select("company", "day") if snapshots is None else snapshots.select("company", F.col("day").cast("date").alias("day")).union(shown.select("company", "day"))
    following = days.distinct().withColumn("__next", F.lead("day").over(Window.partitionBy("company").orderBy("day")))
    own = Window.partitionBy("company", posting).orderBy("day")
    rows = shown.join(following, ["company", "day"]).withColumn("__new", F.coalesce(F.lag("__next").over(own) != F.col("day"), F.lit(True)).cast("int"))
    rows = rows.withColumn("__period", F.sum("__new").over(own))
    return rows.groupBy("company", posting, "__period").agg(F.min("day").alias("opened"), F.max_by("__next", "day").alias("closed")).drop("__period")


def hiring_activity(periods: DataFrame, days: int = 7, sigma: float = 3.0) -> DataFrame:
    """Openings and closings per company and day, and whether the openings stand out from the trailing ``days`` days."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    opened = periods.select("company", F.col("opened").alias("day"), one.alias("n"), none.alias("closings"))
    closed = periods.where(F.col("closed").isNotNull()).select("company", F.col("closed").alias("day"), none.alias("n"), one.alias("closings"))
    daily = opened.unionByName(closed).groupBy("company", "day").agg(F.sum("n").alias("n"), F.sum("closings").alias("closings"))
    checked = rolling_baseline(daily.select("company", "day", "n"), "company", days=days, sigma=sigma)
    out = checked.join(daily.select("company", "day", "closings"), ["company", "day"], "left")
    return out.select("company", "day", F.col("n").alias("openings"), F.coalesce("closings", none).alias("closings"), "baseline_mean", "z",
                      (~F.col("passed") & (F.col("z") > 0)).alias("spike"))


# --- X12 keyword alerts ---------------------------------------------------------------------
# Alert rules (fixed values): rule name -> case-insensitive pattern on whole texts.
ALERT_RULES = [
    ("funding", "raises|raise|raised|funding round|series [a-e]|seed round|venture capital|investors|investor"),
    ("acquisition", "acquires|acquire|acquired|acquisition|merger"),
    ("licensing", "licensed under|license|licence"),
    ("security", "password|passwd|secret|api[ _-]?key|token|private key"),
]


def keyword_alerts(docs: DataFrame, id_col: str, segment_col: str, table: str, text: str = "text",
                   as_of=None) -> DataFrame:
    """One alert row (DQ-result envelope) per (document, rule) that matches anywhere in the text.

    One regex pass per whole text finds the phrases of all rules together (zero-width
    lookahead for the right boundary, so adjacent phrases are all seen). The phrases are
    generated as rows (the regex runs once, inside the generator), attributed to their
    rule, and only those few rows are de-duplicated per (document, rule).
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    every = "|".join(p for _, p in ALERT_RULES)
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"(^|[^\p{{L}}\p{{N}}])({every})(?=[^\p{{L}}\p{{N}}]|$)"), 2)
    phrases = docs.select(id_col, segment_col, F.explode(found).alias("__m"))
    rule = F.lit(None).cast("string")
    for name, pattern in reversed(ALERT_RULES):
        rule = F.when(F.col("__m").rlike(f"^({pattern})$"), F.lit(name)).otherwise(rule)
    hits = phrases.select(id_col, segment_col, rule.alias("__rule")).dropDuplicates([id_col, "__rule"])
    return hits.select(
        F.concat(F.lit("mention["), F.col("__rule"), F.lit("]")).alias("check_name"),
        F.lit(table).alias("table"), F.lit(False).alias("passed"), F.lit("info").alias("severity"),
        F.concat(F.lit(f"{id_col}="), F.col(id_col).cast("string")).alias("message"),
        now.alias("measured_at"), F.col(segment_col).cast("string").alias("segment"),
    )


# --- X14 peer ranks -------------------------------------------------------------------------
def peer_rank(gold: DataFrame, peers: DataFrame, metric: str = "total_stars", peer_col: str = "peer_group",
              buckets: int = 32) -> DataFrame:
    """Dense rank and share of ``metric`` within each company's peer group (skew-safe rank).

    Companies without a peer group, or missing from ``peers``, form the group null.
    """
    j = gold.join(peers, "org", "left")
    ranked = rank_within(j, peer_col, metric, out="peer_rank", method="dense_rank", buckets=buckets)
    totals = j.groupBy(F.col(peer_col).alias("__group")).agg(F.sum(metric).alias("__peer_total"))
    out = ranked.join(totals, ranked[peer_col].eqNullSafe(totals["__group"]), "inner")
    return out.select(
        "org", peer_col, metric, "peer_rank",
        F.round(F.when(F.col("__peer_total") != 0, F.col(metric) / F.col("__peer_total")), 6).alias("peer_share"),
    )


def snapshot_delta(history: DataFrame, key: str, ts: str, metrics: Sequence[str]) -> DataFrame:
    """Change of each metric since the previous snapshot of the same key (null for the first).

    The window runs per key over its snapshots only (one row per publish), so its size
    grows with the number of runs, not with the data.
    """
    w = Window.partitionBy(key).orderBy(ts)
    return history.select(
        key, ts, *metrics,
        *[(F.col(m) - F.lag(m).over(w)).alias(f"{m}_delta") for m in metrics],
    )


# --- X17 page extraction --------------------------------------------------------------------
def page_extract(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """Title, first heading, language, link count and visible text length of whole pages."""
    h = F.col(html)
    body = without_scripts(h)
    return pages.select(
        id_col,
        html_text(F.regexp_extract(h, r"(?s)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        html_text(F.regexp_extract(h, r"(?s)<h1[^>]*>(.*?)</h1>", 1)).alias("heading"),
        F.regexp_extract(h, r"""<html[^>]*\blang\s*=\s*["']([^"']*)["']""", 1).alias("lang"),
        F.size(F.regexp_extract_all(h, F.lit(r"<a\s[^>]*href="), 0)).cast("bigint").alias("links"),
        F.length(html_text(body)).cast("bigint").alias("text_chars"),
    )


# Tags that end a block of text (fixed values).
BLOCK_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
BLOCK_SPLIT = rf"(?i)</?({BLOCK_TAGS})(\s[^>]*)?/?>"
MIN_BLOCK_CHARS, MAX_LINK_PERCENT = 25, 33
ANCHOR = r"(?is)<a\s[^>]*>.*?</a>"


def without_scripts(h: Column) -> Column:
    for pattern in (r"(?s)<script[^>]*>.*?</script>", r"(?s)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->"):
        h = F.regexp_replace(h, pattern, " ")
    return h


def main_text(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """Id, main text and block counts: blocks of text of some length of which at most a third is link text, joined by line breaks.

    Blocks are what lies between block tags, so menus and link lists, whose text is all links, drop out.
    """
    blocks = F.split(without_scripts(F.coalesce(F.col(html), F.lit(""))), BLOCK_SPLIT)
    each = pages.select(id_col, F.transform(blocks, lambda x: F.struct(
        html_text(x).alias("text"), html_text(F.array_join(F.regexp_extract_all(x, F.lit(ANCHOR), 0), "")).alias("linked"))).alias("__b"))

    def kept(x: Column) -> Column:
        return (F.length(x["text"]) >= MIN_BLOCK_CHARS) & (F.length(x["linked"]) * 100 <= F.length(x["text"]) * MAX_LINK_PERCENT)

    main = each.select(id_col, F.size(F.filter("__b", lambda x: x["text"] != "")).cast("bigint").alias("blocks"), F.filter("__b", kept).alias("__k"))
    return main.select(id_col, "blocks", F.size("__k").cast("bigint").alias("main_blocks"), F.array_join(F.transform("__k", lambda x: x["text"]), "\n").alias("text"))


def page_links(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """A row per link: id, position on the page, href (either quote style, or none) and text."""
    each = pages.select(id_col, F.posexplode(F.regexp_extract_all(without_scripts(F.col(html)), F.lit(ANCHOR), 0)).alias("position", "__a"))
    tag = F.regexp_extract("__a", r"(?s)^<[^>]*>", 0)
    href = F.coalesce(*[F.nullif(F.regexp_extract(tag, p, 1), F.lit("")) for p in (r'(?i)\shref\s*=\s*"([^"]*)"', r"(?i)\shref\s*=\s*'([^']*)'", r"""(?i)\shref\s*=\s*([^\s"'>]+)""")])
    return each.select(id_col, "position", href.alias("href"), html_text(F.col("__a")).alias("text"))


def page_headings(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """A row per heading: id, position among the page's headings, level and text."""
    found = F.regexp_extract_all(without_scripts(F.col(html)), F.lit(r"(?is)<h[1-6][\s>].*?</h[1-6]>"), 0)
    each = pages.select(id_col, F.posexplode(found).alias("position", "__h"))
    return each.select(id_col, "position", F.substring("__h", 3, 1).cast("int").alias("level"), html_text(F.col("__h")).alias("text"))


# --- E1 mention matching --------------------------------------------------------------------
# Tracked company names (fixed values).
TRACKED_NAMES = ["databricks", "snowflake-labs", "apache", "dbt-labs"]


def name_frame(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    return spark.createDataFrame([(n,) for n in (names or TRACKED_NAMES)], "name string")


#: Bits of the fixed-size set of hashed first tokens (128 KB).
FIRST_BITS = 1 << 20


def _first_tokens(grams: DataFrame) -> bytes:
    """The hashed first tokens of all names as a bit set of fixed size, whatever the number of names."""
    slot = F.pmod(F.xxhash64(F.substring_index("gram", " ", 1)), F.lit(FIRST_BITS))
    of_byte = grams.select(slot.alias("s")).groupBy(F.shiftright("s", 3).alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(s % 8 AS INT))")).alias("bits"))
    bits = bytearray(FIRST_BITS // 8)
    for r in of_byte.collect():
        bits[r["byte"]] = r["bits"]
    return bytes(bits)


def candidate_grams(toks: Column, lengths: Sequence[int], first: bytes) -> Column:
    """The n-grams of the given lengths that begin with a token in the bit set ``first``; other places form none."""
    hashed = F.transform(toks, lambda t: F.pmod(F.xxhash64(t), F.lit(FIRST_BITS)))
    byte = lambda s: F.conv(F.hex(F.substring(F.lit(first), (F.shiftright(s, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    places = F.filter(F.transform(hashed, lambda s, i: F.when(F.getbit(byte(s), (s % 8).cast("int")) == 1, i)), lambda i: i.isNotNull())
    at = lambda i: F.array(*[F.when(i + k <= F.size(toks), F.array_join(F.slice(toks, i + 1, F.lit(k)), " ")) for k in lengths])
    return F.array_compact(F.flatten(F.transform(places, at)))


def mention_match(docs: DataFrame, names: Sequence[str] | DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """Occurrences of each name in each whole text, on token boundaries, case-insensitive.

    Names are tokenised like the text; a k-token name matches k consecutive tokens, however many. A list of names
    is a literal: n-grams are tested within the row and only hits leave it. A name table of any size is joined with
    n-grams; only places whose token starts some name (by a bit set of fixed size) form any.
    """
    t = docs.select(id_col, tokens(F.col(text)).alias("__t"))
    table = names if isinstance(names, DataFrame) else name_frame(docs.sparkSession, names)
    nm = table.select("name", tokens(F.col("name")).alias("g")).where(F.size("g") > 0).select("name", F.array_join("g", " ").alias("gram"), F.size("g").alias("k"))
    lengths = sorted(r["k"] for r in nm.select("k").distinct().collect())
    if not lengths:
        return docs.sparkSession.createDataFrame([], f"{id_col} {docs.schema[id_col].dataType.simpleString()}, name string, mentions bigint")
    if isinstance(names, DataFrame):
        every = candidate_grams(F.col("__t"), lengths, _first_tokens(nm))
    else:
        grams = [ngrams(F.col("__t"), k) for k in lengths]
        wanted = [r["gram"] for r in nm.select("gram").distinct().collect()]
        every = F.filter(F.concat(*grams) if len(grams) > 1 else grams[0], lambda g: g.isin(*wanted))
    hits = t.select(id_col, F.explode(every).alias("gram")).join(nm.select("name", "gram"), "gram")
    return hits.groupBy(id_col, "name").agg(F.count(F.lit(1)).alias("mentions"))


# --- X3 referential integrity ---------------------------------------------------------------
def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(child_rows, orphan_rows, orphan_keys): child rows whose non-null key has no parent.

    Child keys are first collapsed to distinct keys with counts (a hot key becomes one
    row), then anti-joined with the parent keys. On columnar storage a scan reads only the
    key column, so checking several keys of one table as separate relations costs no extra
    I/O over a single combined scan, and the keys keep their native types.
    """
    ck = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("__k")).agg(
        F.count(F.lit(1)).alias("__n"))
    pk = parent.select(F.col(parent_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    miss = ck.join(pk, "__k", "left_anti")
    zero = F.lit(0).cast("bigint")
    total = child.select(F.lit(1).cast("bigint").alias("child_rows"), zero.alias("orphan_rows"), zero.alias("orphan_keys"))
    orphan = miss.select(zero.alias("child_rows"), F.col("__n").alias("orphan_rows"), F.lit(1).cast("bigint").alias("orphan_keys"))
    # One aggregate over both sides (no join of the two totals).
    return total.unionByName(orphan).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("child_rows", "orphan_rows", "orphan_keys")])


# --- X1 rolling baseline --------------------------------------------------------------------
def daily_counts(df: DataFrame, ts: str, group: str | None = None) -> DataFrame:
    keys = ([group] if group else []) + [F.to_date(F.col(ts)).alias("day")]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _every_day(counts: DataFrame, groups: list[str]) -> DataFrame:
    """``counts`` with a zero row for every day between a group's first and last that has none."""
    ends = counts.groupBy(*groups).agg(F.min("day").alias("__a"), F.max("day").alias("__z"))
    days = ends.where(F.col("__a").isNotNull()).select(*groups, F.explode(F.sequence("__a", "__z")).alias("day"))
    zero = days.select(*[F.col(c) if c in (*groups, "day") else F.lit(0).cast(t).alias(c) for c, t in counts.dtypes])
    return counts.unionByName(zero).groupBy(*groups, "day").agg(F.sum("n").alias("n")).select(*counts.columns)


def _previous_days(groups: list[str], days: int):
    """The ``days`` calendar days before a row's own."""
    w = Window.partitionBy(*groups) if groups else Window.partitionBy()
    return w.orderBy(F.unix_date("day")).rangeBetween(-days, -1)


def rolling_baseline(counts: DataFrame, group: str | None = None, days: int = 7, sigma: float = 3.0) -> DataFrame:
    """Each day's count vs the mean / population std of the previous ``days`` calendar days (std 0 -> 1).

    A day without rows counts zero: it is checked, and it is part of later baselines. The window
    runs over daily aggregates (one row per group and day), never raw rows.
    """
    groups = [group] if group else []
    counts = _every_day(counts, groups)
    w = _previous_days(groups, days)
    mean, std, nb = F.avg("n").over(w), F.stddev_pop("n").over(w), F.count("n").over(w)
    out = counts.select("*", mean.alias("baseline_mean"), std.alias("__std"), nb.alias("baseline_days"))
    std_eff = F.when(F.col("__std").isNull() | (F.col("__std") == 0), F.lit(1.0)).otherwise(F.col("__std"))
    z = (F.col("n") - F.col("baseline_mean")) / std_eff
    return out.select(
        *counts.columns,
        F.round("baseline_mean", 6).alias("baseline_mean"), F.round("__std", 6).alias("baseline_std"),
        F.col("baseline_days").cast("bigint").alias("baseline_days"),
        F.round(z, 6).alias("z"),
        F.when(F.col("baseline_days") > 0, F.abs(z) <= F.lit(sigma)).otherwise(F.lit(True)).alias("passed"),
    )


# --- X2 null-rate drift ---------------------------------------------------------------------
def null_rate_drift(df: DataFrame, ts: str, columns: Sequence[str], days: int = 7, max_delta: float = 0.1) -> DataFrame:
    """Per (column, day with rows): null rate (NaN counts as null) minus the mean rate of the previous ``days`` calendar days."""
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.sum(is_missing(df.schema[c]).cast("bigint")).alias(f"__z_{c}") for c in columns]
    daily = df.groupBy(F.to_date(F.col(ts)).alias("day")).agg(*aggs)
    long = daily.select("day", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col(f"`__z_{c}`") / F.col("__n")).alias("null_rate")) for c in columns
    ])))
    out = long.select("*", F.avg("null_rate").over(_previous_days(["column"], days)).alias("__base"))
    delta = F.col("null_rate") - F.col("__base")
    return out.select(
        "column", "day", F.round("null_rate", 6).alias("null_rate"), F.round("__base", 6).alias("baseline"),
        F.round(delta, 6).alias("delta"),
        F.coalesce(delta <= F.lit(max_delta), F.lit(True)).alias("passed"),
    )
