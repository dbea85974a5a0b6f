"""Column expressions shared by the parsers, keyed tables and sinks. All JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonempty(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Null when the value is falsy in the Python sense: null, '' for text, 0 for numbers, false."""
    col = _c(c)
    if dtype is None or isinstance(dtype, T.StringType):
        return F.when(col != F.lit(""), col)
    if isinstance(dtype, T.BooleanType):
        return F.when(col, col)
    if isinstance(dtype, T.NumericType):
        return F.when(col != F.lit(0), col)
    return col


def falsy_coalesce(*cols: ColumnOrName, default=None, dtype: T.DataType | None = None) -> Column:
    """``a or b or default``: null and falsy values fall through to the next candidate."""
    parts = [nonempty(c, dtype) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def story_key(url: ColumnOrName, title: ColumnOrName, created_at: ColumnOrName | None = None,
              form: str = "item") -> Column:
    """Surrogate story key: the URL when non-empty, else a deterministic fallback.

    ``form="item"`` gives ``https://news.ycombinator.com/item?<title>`` (batch refresh form);
    ``form="hash"`` gives ``hn://<created_at ISO>/<sha256(title)>`` (stable replacement of the
    per-process salted string hash used by the one-off CLI path).
    """
    if form == "item":
        fallback = F.concat(F.lit("https://news.ycombinator.com/item?"), _c(title))
    elif form == "hash":
        if created_at is None:
            raise ValueError("form='hash' needs created_at")
        fallback = F.concat(F.lit("hn://"), iso_text(created_at), F.lit("/"), F.sha2(_c(title), 256))
    else:
        raise ValueError(f"unknown story key form {form!r}")
    return F.coalesce(nonempty(url), fallback)


def iso_text(c: ColumnOrName) -> Column:
    """Timestamp as Python's ``datetime.isoformat()`` of a UTC value (``T`` separator, ``+00:00``)."""
    col = _c(c)
    micros = F.unix_micros(col.cast("timestamp")) % F.lit(1_000_000)
    return F.when(micros == 0, F.date_format(col, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def timestamp_text(c: ColumnOrName) -> Column:
    """Timestamp rendered the way a pandas ``str()`` of a UTC timestamp reads.

    ``2026-05-30 12:00:00+00:00``; microseconds are appended when non-zero.
    """
    col = _c(c)
    micros = F.unix_micros(col.cast("timestamp")) % F.lit(1_000_000)
    return F.when(col.isNull(), F.lit(None)).when(
        micros == 0, F.date_format(col, "yyyy-MM-dd HH:mm:ssxxx")
    ).otherwise(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"))


def json_bytes(*cols: ColumnOrName, keep_nulls: bool = True) -> Column:
    """Record -> UTF-8 JSON bytes (message value). Nulls are written as ``null`` by default."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[_c(c) for c in cols]), opts).cast("binary")
