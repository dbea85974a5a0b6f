"""DuckDB SQL fragments that mirror the Spark column helpers (oracle side only)."""

from __future__ import annotations


def fmt(expr: str, decimals: int) -> str:
    """``format_string('%.<d>f', x)`` as Spark renders it (half-up on the shortest decimal form)."""
    return (
        f"CAST(CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {decimals}) "
        f"AS DECIMAL(38,{decimals})) AS VARCHAR)"
    )


def ts_text(expr: str) -> str:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss[.ffffff]+00:00``."""
    return (
        f"CASE WHEN ({expr}) IS NULL THEN NULL "
        f"WHEN microsecond({expr}) % 1000000 = 0 THEN strftime({expr}, '%Y-%m-%d %H:%M:%S') || '+00:00' "
        f"ELSE strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') || '+00:00' END"
    )


def timedelta_text(micros: str) -> str:
    """Microsecond duration as Python's ``str(timedelta)``."""
    d = f"CAST(floor(({micros}) / 86400000000.0) AS BIGINT)"
    rem = f"(({micros}) - {d} * 86400000000)"
    h = f"CAST(floor({rem} / 3600000000.0) AS BIGINT)"
    m = f"CAST(floor(({rem} % 3600000000) / 60000000.0) AS BIGINT)"
    s = f"CAST(floor(({rem} % 60000000) / 1000000.0) AS BIGINT)"
    us = f"({rem} % 1000000)"
    clock = f"printf('%d:%02d:%02d', {h}, {m}, {s}) || CASE WHEN {us} <> 0 THEN printf('.%06d', {us}) ELSE '' END"
    days = (
        f"CASE WHEN {d} = 0 THEN '' WHEN abs({d}) = 1 THEN CAST({d} AS VARCHAR) || ' day, ' "
        f"ELSE CAST({d} AS VARCHAR) || ' days, ' END"
    )
    return f"CASE WHEN ({micros}) IS NULL THEN NULL ELSE {days} || {clock} END"


def sev(passed: str, failing: str) -> str:
    return f"CASE WHEN {passed} THEN 'info' ELSE '{failing}' END"
