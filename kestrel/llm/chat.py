"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbouring turns of one role
share a block; array functions write the blocks under the template

    <|role:NAME|>TEXT</turn>TEXT</turn><|end|>

in which every text ends in ``</turn>``, so merged turns stay apart. Inside texts and role names
``&``, ``<`` and ``>`` are written ``&amp;``, ``&lt;`` and ``&gt;``, so that no text can form a mark of the
template, and undoing it gives the text back. The loss mask is a list of spans of the formatted
string, one for each assistant text, without its ``</turn>``.

Defined results: turns are ordered by turn (nulls first), then role, then text, so ties and
repeated rows have one order and all stay; a null text or role is empty; rows without conv_id
are one conversation; an empty table yields no rows; other columns are ignored. A conversation is
one output value, so its turns meet in one task, where they are taken ``CHUNK`` at a time: offsets are
added up within chunks and over chunks, and masked text is cut chunk by chunk, so that
the work of 100,000 turns stays near that of reading them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNT = "assistant"
#: Turns, or spans, that are handled together.
CHUNK = 256
# The marks of the template, and what stands for its control characters, in order.
OPEN, CLOSE, TURN, END = "<|role:", "|>", "</turn>", "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def sorted_turns(rows: DataFrame) -> DataFrame:
    """conv_id and turns: sorted structs (turn, role, text)."""
    empty = F.lit("")
    one = F.struct("turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))


def _pieces(turns: Column) -> Column:
    """What each turn writes: (head, body, tail). A head opens a block where the role changes; a tail ends it."""
    count = F.size(turns)
    nobody = F.array(F.lit(None).cast("string"))
    roles = F.transform(turns, lambda t: t["role"])
    zipped = F.arrays_zip(
        turns.alias("t"),
        F.slice(F.concat(nobody, roles), 1, count).alias("before"),
        F.slice(F.concat(roles, nobody), 2, count).alias("after"),
    )

    def piece(x: Column) -> Column:
        role = x["t"]["role"]
        opens = F.when(x["before"].eqNullSafe(role), F.lit("")).otherwise(F.concat(F.lit(OPEN), escape(role), F.lit(CLOSE)))
        ends = F.when(x["after"].eqNullSafe(role), F.lit(TURN)).otherwise(F.lit(TURN + END))
        return F.struct(opens.alias("head"), escape(x["t"]["text"]).alias("body"), ends.alias("tail"), (role == LEARNT).alias("learnt"))

    return F.transform(zipped, piece)


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted and loss: spans (start, end) of the formatted string in code points, end exclusive."""
    written = sorted_turns(rows).select("conv_id", _pieces(F.col("turns")).alias("p"))
    text = F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], x["tail"])), "")

    chunked = written.select("conv_id", text.alias("formatted"), _chunks(F.col("p")).alias("chunks"))
    sized = chunked.withColumn("sizes", F.transform("chunks", lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + _written(x))))
    placed = sized.withColumn("placed", F.arrays_zip("chunks", _running(F.col("sizes")).alias("at")))
    return placed.select("conv_id", "formatted", F.flatten(F.transform("placed", lambda c: _spans(c["chunks"], c["at"]))).alias("loss"))


def _written(piece: Column) -> Column:
    return F.length(piece["head"]) + F.length(piece["body"]) + F.length(piece["tail"])


def _chunks(items: Column, size: int = CHUNK) -> Column:
    """``items`` cut into arrays of at most ``size``."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(items, s, F.lit(size)))


def _running(sizes: Column) -> Column:
    """The sum of what stands before each number."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))
    return F.aggregate(sizes, zero, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["before"], F.array(acc["at"])).alias("before")), lambda acc: acc["before"])


def _spans(pieces: Column, at: Column) -> Column:
    """Spans of the learnt texts among ``pieces``, the first of which starts at ``at``."""
    heads = F.transform(F.arrays_zip(pieces.alias("p"), _running(F.transform(pieces, _written)).alias("before")), lambda x: F.struct(x["p"].alias("p"), (at + x["before"] + F.length(x["p"]["head"])).alias("start")))
    learnt = F.filter(heads, lambda x: x["p"]["learnt"])
    return F.transform(learnt, lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["p"]["body"])).alias("end")))


def parse(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted conversation; escaped texts hold no mark, so plain splitting is safe."""

    def within(blocks: Column) -> Column:
        return F.slice(blocks, 1, F.size(blocks) - 1)

    def block(b: Column) -> Column:
        head = F.substring_index(b, CLOSE, 1)
        role = unescape(F.substring(head, F.lit(len(OPEN) + 1), F.length(head)))
        body = F.substring(b, F.length(head) + len(CLOSE) + 1, F.length(b))
        return F.transform(within(F.split(body, TURN, -1)), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(within(F.split(formatted, END.replace("|", r"\|"), -1)), block))


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask (spans in order), unescaped, nothing between."""

    def cut(spans: Column) -> Column:
        first = F.element_at(spans, 1)["start"]
        part = F.struct(F.substring(formatted, first + 1, F.element_at(spans, -1)["end"] - first).alias("text"), spans.alias("spans"))
        return F.transform(F.array(part), lambda c: F.array_join(F.transform(c["spans"], lambda s: unescape(F.substring(c["text"], s["start"] - first + 1, s["end"] - s["start"]))), ""))[0]

    return F.array_join(F.transform(_chunks(loss), cut), "")
