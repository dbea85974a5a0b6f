"""Personal data: pattern spans, and terms that give a protected value away.

Patterns find e-mail addresses, network addresses, card and phone numbers. Each distinct value is a
protected entity. A term is a run of letters, marks and digits, case folded. What a term t tells about
an entity e is measured on the whole corpus, in bits, with probabilities as shares of documents:
PMI(e; t) = log2(p(e, t) / (p(e) p(t))), against IC(e) = -log2 p(e), the information needed to name e.
PMI / IC is 1 where t never occurs without e. Terms of a ratio of at least ``GENERALISE`` are replaced
by a class name, of at least ``REMOVE`` taken out, wherever they stand in a document that holds e. A
pair must be seen with ``SUPPORT`` different contexts of e, the ``CONTEXT`` characters on either side of it up to its
neighbours of the same kind: one document alone gives no estimate, nor do its copies, exact or with changes elsewhere.

Co-occurrence is counted over whole documents. Of N documents, df hold t, e_df hold e and both hold
the two, at most e_df. A ratio of r needs df <= both * (N / e_df)^(1 - r), so t is joined to e only where
df <= e_df * (N / e_df)^(1 - r): no pair that could reach r is left out. Entities that the same documents hold (a
directory's, say) tell the same about every term and are counted as one. Only DataFrame operations are used.

Defined results: a null text is empty and has no spans; repeated rows are scanned row by row; an
empty table yields no rows; a text of any length, with any number of spans and telling terms, is scanned and
rebuilt without a search that grows with their product (possessive quantifiers, sorts of its words); other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, text_or_empty

# The kinds in their order, and their patterns. Possessive quantifiers and the
# look-behinds change no match; they keep long runs linear and off the regex engine's stack.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for its kind to be looked for at all.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TERM = r"[\p{L}\p{M}\p{N}]++"
SUPPORT = 2
CONTEXT = 32
#: Characters of a text that are cut out together when it is rebuilt.
BLOCK = 256
GENERALISE, REMOVE = 0.8, 0.95


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum holds: from the right, every second digit counts double, less 9 if over 9."""

    def share(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), share), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def is_valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)

    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(F.when(F.length(bare) <= 3, bare.try_cast("int")), F.lit(0)) <= 255)

    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", F.forall(F.split(value, r"\."), small))
        .when(kind == "card", F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False))
        .otherwise(F.length(digits).between(9, 15))
    )


def _matches(kind: str, gaps: str, found: str) -> Column:
    """One struct per match: kind, place among its kind, value, length of the gap before it, and a hash of its context."""
    following = F.slice(gaps, F.lit(2), F.size(gaps))
    zipped = F.arrays_zip(F.col(found).alias("m"), F.col(gaps).alias("g"), following.alias("f"))

    def one(x: Column, i: Column) -> Column:
        context = F.xxhash64(F.substring(x["g"], -CONTEXT, CONTEXT), F.substring(x["f"], 1, CONTEXT))
        return F.struct(F.lit(kind).alias("kind"), i.alias("place"), x["m"].alias("value"), F.length(x["g"]).cast("long").alias("gap"), context.alias("context"))

    each = F.transform(zipped, one)
    return F.filter(each, lambda x: x["value"].isNotNull())


def scan(docs: DataFrame, carry: list[str]) -> DataFrame:
    """One staged row per document: rid, doc (struct of ``carry``), found (all pattern matches, still unchecked), text where one is valid."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), text_or_empty().alias("text"))
    for kind in KINDS:
        pattern, held = PATTERNS[kind], F.col("text").rlike(HINTS[kind])
        df = df.withColumn(f"m_{kind}", F.when(held, F.regexp_extract_all("text", F.lit(pattern), 0)).otherwise(F.array().cast("array<string>")))
    for kind in KINDS:
        some = F.size(f"m_{kind}") > 0
        df = df.withColumn(f"g_{kind}", F.when(some, F.split("text", PATTERNS[kind], -1)).otherwise(F.array().cast("array<string>")))
    found = F.concat(*[_matches(kind, f"g_{kind}", f"m_{kind}") for kind in KINDS])
    df = df.select("doc", "text", found.alias("found"))
    text = F.when(F.exists("found", lambda x: is_valid(x["kind"], x["value"])), F.col("text"))
    return materialize(df.select(F.monotonically_increasing_id().alias("rid"), "doc", "found", text.alias("text")), "pii-scan")


def entities(scanned: DataFrame) -> DataFrame:
    """One row per valid span: rid, kind, value, start and end (code points, end exclusive), context."""
    each = scanned.select("rid", F.explode("found").alias("x")).select("rid", "x.*")
    so_far = W.partitionBy("rid", "kind").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(so_far)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    return placed.filter(is_valid(F.col("kind"), F.col("value"))).select("rid", "kind", "value", "start", "end", "context")


def _terms(text: Column) -> Column:
    """The terms of a text in their order, folded."""
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), 0), F.lower)


def term_documents(docs: DataFrame) -> DataFrame:
    """term and df: the number of documents of the whole corpus that hold it."""
    words = F.array_distinct(_terms(text_or_empty()))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def together(scanned: DataFrame, spans: DataFrame, terms: DataFrame, n_docs: int, support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """One row per document, set of entities with the same documents, and term it holds that could reach the threshold: rid, held, e_df, context, term, df.

    ``held`` is a hash of the documents that hold the entities; a document's contexts of them are taken together.
    """
    per_row = materialize(spans.groupBy("rid", "kind", "value").agg(F.bit_xor("context").alias("context")), "pii-entities")
    shown = per_row.groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("e_df"), F.bit_xor(F.xxhash64("rid")).alias("held"), F.count_distinct("context").alias("contexts"))
    repeated = shown.filter((F.col("contexts") >= support) & (F.col("e_df") < n_docs)).drop("contexts")
    # Just above the bound of the module's docstring, so that rounding loses no pair.
    most = F.col("e_df") * F.pow(F.lit(n_docs) / F.col("e_df"), F.lit(1 - threshold)) * (1 + 1e-9)
    # Written tables on both sides: a value or term that a third of all rows share is split at run time.
    known = materialize(repeated.withColumn("most", most), "pii-held")
    frequent = materialize(terms.filter(F.col("df") >= support), "pii-terms")
    named = per_row.join(known, ["kind", "value"]).groupBy("rid", "held", "e_df", "most").agg(F.bit_xor("context").alias("context"))
    named = materialize(named, "pii-named")
    reach = materialize(named.groupBy("rid").agg(F.max("most").alias("reach")), "pii-reach")
    words = scanned.select("rid", "text").join(reach, "rid").select("rid", "reach", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    inside = words.join(frequent, "term").filter(F.col("df") <= F.col("reach")).select("rid", "term", "df")
    return named.join(inside, "rid").filter(F.col("df") <= F.col("most")).select("rid", "held", "e_df", "context", "term", "df")


def disclosing(near: DataFrame, n_docs: int, support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """held, e_df, term, ratio of the pairs that reach the threshold."""
    counts = near.groupBy("held", "e_df", "term", "df").agg(F.count(F.lit(1)).alias("both"), F.count_distinct("context").alias("contexts"))
    ic = F.log2(F.lit(n_docs) / F.col("e_df"))
    pmi = F.log2(F.col("both") * F.lit(n_docs) / (F.col("e_df") * F.col("df")))
    return counts.filter(F.col("contexts") >= support).select("held", "e_df", "term", (pmi / ic).alias("ratio")).filter(F.col("ratio") >= threshold)


def occurrences(scanned: DataFrame, told: DataFrame) -> DataFrame:
    """rid, start, end, ratio of every place where a document holds one of its terms in ``told`` (rid, term, ratio).

    A told term is one more row among the words of its document, so no word is searched for in a list.
    """
    zipped = F.arrays_zip(F.regexp_extract_all("text", F.lit(TERM), 0).alias("t"), F.split("text", TERM, -1).alias("g"))
    inside = scanned.select("rid", "text").join(told.select("rid").distinct(), "rid", "left_semi").select("rid", F.posexplode(zipped).alias("place", "x"))
    words = inside.filter(F.col("x.t").isNotNull()).select(
        "rid", "place", F.lower("x.t").alias("term"), F.length("x.t").alias("size"), F.length("x.g").alias("gap"), F.lit(None).cast("double").alias("ratio"))
    listed = told.select("rid", F.lit(-1).alias("place"), "term", F.lit(0).alias("size"), F.lit(0).alias("gap"), "ratio")
    so_far = W.partitionBy("rid").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    both = words.unionByName(listed).withColumn("end", F.sum((F.col("gap") + F.col("size")).cast("long")).over(so_far))
    rated = both.withColumn("ratio", F.max("ratio").over(W.partitionBy("rid", "term")))
    return rated.filter((F.col("place") >= 0) & F.col("ratio").isNotNull()).select("rid", (F.col("end") - F.col("size")).alias("start"), "end", "ratio")


def _clear_of(patterns: DataFrame, terms: DataFrame) -> DataFrame:
    """Pattern spans, and the terms that do not lie wholly within one of them."""
    both = patterns.unionByName(terms.select("rid", "start", F.lit(len(KINDS) + 1).alias("rank"), "end", F.lit("term").alias("kind"), "ratio"))
    pattern = F.col("rank") <= len(KINDS)
    reach = F.max(F.when(pattern, F.col("end"))).over(W.partitionBy("rid").orderBy("start").rangeBetween(W.unboundedPreceding, W.currentRow))
    return both.withColumn("reach", reach).filter(pattern | (F.coalesce(F.col("reach"), F.lit(-1)) < F.col("end"))).drop("reach")


def _all_spans(docs: DataFrame, carry: list[str], support: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The scanned documents, and one row per span: rid, start, rank, end, kind, ratio; rank is the kind's place, terms last."""
    scanned = scan(docs, carry)
    spans = materialize(entities(scanned), "pii-spans")
    n_docs = scanned.count()
    near = materialize(together(scanned, spans, term_documents(docs), n_docs, support, threshold), "pii-near")
    pairs = materialize(disclosing(near, n_docs, support, threshold), "pii-pairs")

    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    patterns = spans.select("rid", "start", rank.alias("rank"), "end", "kind", F.lit(None).cast("double").alias("ratio"))
    # Tables on both sides: a value that a third of all spans share is split at run time.
    told = near.join(pairs, ["held", "e_df", "term"]).groupBy("rid", "term").agg(F.max("ratio").alias("ratio"))
    return scanned, _clear_of(patterns, occurrences(scanned, materialize(told, "pii-told")))


def find(docs: DataFrame, carry: list[str], support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """doc (struct of ``carry``) and spans: structs (start, rank, end, kind, ratio), ordered; rank is the kind's place, terms last."""
    scanned, spans = _all_spans(docs, carry, support, threshold)
    per_row = spans.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind", "ratio"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,ratio:double>>")
    return scanned.select("rid", "doc").join(per_row, "rid", "left").select("doc", F.coalesce("spans", none).alias("spans"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def only_patterns(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["rank"] <= len(KINDS))


def _replaced(text: Column, cover: Column) -> Column:
    """``text`` with the stretches of ``cover`` (start, end, mark; in order, apart) replaced by their marks.

    The text is cut into blocks once, and what stands between two stretches is taken from its own blocks: a
    substring of the whole text would be counted from its first character for every stretch.
    """

    def between(blocks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / BLOCK).cast("int")
        own = F.array_join(F.slice(blocks, first + 1, (F.ceil(end / BLOCK) - first).cast("int")), "")
        return F.substring(own, (start - F.lit(BLOCK) * first + 1).cast("int"), (end - start).cast("int"))

    def rebuilt(x: Column) -> Column:
        blocks, spans = x["blocks"], x["cover"]
        starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
        ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(x["size"]))
        marks = F.concat(F.transform(spans, lambda s: s["mark"]), F.array(F.lit("")))
        parts = F.arrays_zip(starts.alias("start"), ends.alias("end"), marks.alias("mark"))
        kept = F.transform(parts, lambda p: F.when(p["end"] > p["start"], between(blocks, p["start"], p["end"])).otherwise(F.lit("")))
        return F.array_join(F.zip_with(kept, parts, lambda k, p: F.concat(k, p["mark"])), "")

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), 0)
    # A lambda's variable is worked out once, whatever the optimiser makes of the columns.
    once = F.array(F.struct(blocks.alias("blocks"), cover.alias("cover"), F.length(text).cast("long").alias("size")))
    return F.get(F.transform(once, rebuilt), 0)


def sanitise(docs: DataFrame, support: int = SUPPORT, threshold: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``docs`` with every pattern span and telling term replaced; ``n_chars``, if there, is brought up to date.

    A pattern span or a term below ``remove`` is generalised to its kind in angle brackets, a term
    from ``remove`` up is taken out. Where pattern spans overlap, the text they cover together is
    replaced once, by the kind of the first. Texts without a span pass untouched.
    """
    columns = docs.columns
    scanned, spans = _all_spans(docs, columns, support, threshold)
    earlier = W.partitionBy("rid").orderBy("start", "rank", "end")
    reach = F.max("end").over(earlier.rowsBetween(W.unboundedPreceding, -1))
    apart = spans.withColumn("fresh", F.when(reach > F.col("start"), 0).otherwise(1))
    apart = apart.withColumn("island", F.sum("fresh").over(earlier.rowsBetween(W.unboundedPreceding, 0)))
    covers = apart.groupBy("rid", "island").agg(F.min(F.struct("start", "rank", "end", "kind", "ratio")).alias("first"), F.max("end").alias("end"))
    mark = F.when(F.col("first.ratio") >= remove, F.lit("")).otherwise(F.concat(F.lit("<"), F.upper("first.kind"), F.lit(">")))
    cover = F.sort_array(F.collect_list(F.struct(F.col("first.start").alias("start"), "end", mark.alias("mark"))))
    found = scanned.select("rid", "doc").join(covers.groupBy("rid").agg(cover.alias("cover")), "rid", "left")
    new = F.when(F.col("cover").isNotNull(), _replaced(F.col("doc.text"), F.col("cover"))).otherwise(F.col("doc.text"))
    out = found.select("doc", new.alias("new"))
    return out.select(*[
        F.col("new").alias(c) if c == "text" else (F.length("new").cast(docs.schema[c].dataType) if c == "n_chars" else F.col(f"doc.`{c}`")).alias(c)
        for c in columns
    ])
