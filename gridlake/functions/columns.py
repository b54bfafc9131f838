"""Column expressions.

Each helper takes a column *name* (or a Column). Given a name, the
expression is composed as Spark SQL text and handed to the JVM in one call
(``F.expr``): wide projections of dozens of CASE expressions then cost one
Py4J round trip per column instead of dozens, which keeps plan construction
in the milliseconds. Given a Column, the same logic is built with the
Column API.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlake.registry import GLOBAL_ID_SEP

# An integral-looking number: optional sign, digits, optional fraction, with
# surrounding whitespace. Matches what a legacy (non-ANSI) string->integer cast
# accepts; the fraction is truncated, as that cast does.
_INTEGRAL = r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$"


def q(name: str) -> str:
    """Quote an identifier for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def lit_sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql(col) -> str | None:
    return q(col) if isinstance(col, str) else None


def _c(col) -> Column:
    return F.col(q(col)) if isinstance(col, str) else col


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


# -- SQL text builders (used by the helpers below and by wide projections) --

def null_if_token_sql(c: str, tokens: Iterable[str]) -> str:
    toks = ", ".join(lit_sql(t) for t in tokens)
    return f"CASE WHEN trim({c}) IN ({toks}) THEN NULL ELSE {c} END"


def integral_sql(c: str, type_name: str) -> str:
    # Fast path: a plain (optionally signed, padded) integer is what try_cast
    # already accepts, so most values never reach the regex. Otherwise the
    # integral part of a ``12.9``-style value is extracted (no match -> ''
    # -> NULL), exactly as the legacy cast truncates.
    pat = lit_sql(_INTEGRAL)
    return (f"coalesce(try_cast({c} AS {type_name}), "
            f"try_cast(regexp_extract({c}, {pat}, 1) AS {type_name}))")


def convert_sql(c: str, kind: str) -> str:
    if kind == "text":
        return f"trim({c})"
    if kind == "lower":
        return f"lower(trim({c}))"
    if kind == "double":
        return f"try_cast({c} AS DOUBLE)"
    if kind == "long":
        return integral_sql(c, "BIGINT")
    if kind == "int":
        return integral_sql(c, "INT")
    if kind == "bool":
        return f"try_cast({c} AS BOOLEAN)"
    if kind == "ts":
        return f"try_to_timestamp({c})"
    raise ValueError(f"unknown conversion kind {kind!r}")


def first_match_sql(flag_columns: Iterable[str], names: Mapping[str, str] | None = None) -> str:
    names = names or {}
    arms = [f"CASE WHEN try_cast({q(c)} AS DOUBLE) > 0 THEN {lit_sql(names.get(c, c))} END"
            for c in flag_columns]
    return f"coalesce({', '.join(arms + ['CAST(NULL AS STRING)'])})"


# -- Column helpers ----------------------------------------------------------

def null_if_token(col, tokens: Iterable[str]) -> Column:
    """NULL when the space-trimmed value is one of ``tokens`` (case-sensitive);
    otherwise the original, untrimmed value."""
    s = _sql(col)
    if s is not None:
        return F.expr(null_if_token_sql(s, tokens))
    c = _c(col)
    return F.when(F.trim(c).isin(list(tokens)), F.lit(None)).otherwise(c)


def convert(col, kind: str) -> Column:
    """Apply a registry conversion kind to a raw text column."""
    s = _sql(col)
    if s is not None:
        return F.expr(convert_sql(s, kind))
    c = col
    if kind == "text":
        return F.trim(c)
    if kind == "lower":
        return F.lower(F.trim(c))
    if kind == "double":
        return c.try_cast("double")
    if kind in ("long", "int"):
        t = "bigint" if kind == "long" else "int"
        return F.coalesce(c.try_cast(t), F.regexp_extract(c, _INTEGRAL, 1).try_cast(t))
    if kind == "bool":
        return c.try_cast("boolean")
    if kind == "ts":
        return F.try_to_timestamp(c)
    raise ValueError(f"unknown conversion kind {kind!r}")


def lenient_double(col) -> Column:
    """string -> double; unparseable text gives NULL (never raises)."""
    return convert(col, "double")


def lenient_long(col) -> Column:
    """string -> bigint with legacy semantics: ``12.9`` -> 12, ``00123`` ->
    123, ``1e3``/``abc``/overflow -> NULL."""
    return convert(col, "long")


def lenient_int(col) -> Column:
    return convert(col, "int")


def lenient_bool(col) -> Column:
    """t/true/y/yes/1 -> true, f/false/n/no/0 -> false, anything else NULL."""
    return convert(col, "bool")


def lenient_ts(col) -> Column:
    """Default-format timestamp parse (``yyyy-MM-dd[ HH:mm:ss]``, ISO ``T``);
    NULL on failure."""
    return convert(col, "ts")


def first_match(flag_columns: Iterable[str], names: Mapping[str, str] | None = None) -> Column:
    """Wide technology flags -> one type: the name of the first column (in the
    given priority order) whose numeric value is > 0, else NULL. A column with
    no entry in ``names`` stands for itself."""
    return F.expr(first_match_sql(list(flag_columns), names))


def global_id(utility_col, local_col, sep: str = GLOBAL_ID_SEP) -> Column:
    """``utility::local`` with concat_ws semantics: NULL parts are skipped, so
    a NULL local id yields just the utility id."""
    return F.concat_ws(sep, _c(utility_col), _c(local_col))


def global_id_nullsafe(utility_col, local_col, sep: str = GLOBAL_ID_SEP) -> Column:
    """``utility::local``, or NULL when the local id is NULL."""
    local = _c(local_col)
    return F.when(local.isNotNull(), global_id(utility_col, local, sep))


def map_values(col, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Code -> canonical lookup through a literal map folded into the
    expression (no join, no shuffle). Unmapped codes fall back to ``default``
    (the code itself when not given)."""
    c = _c(col)
    if not mapping:
        return c if default is None else default
    pairs = ", ".join(f"{lit_sql(k)}, {lit_sql(v)}" for k, v in mapping.items())
    lookup = F.expr(f"map({pairs})")
    return F.coalesce(F.try_element_at(lookup, c), c if default is None else default)


def rating_to_kw(col, unit: str | Column) -> Column:
    """Normalise a rating to kW given its declared unit (``watts`` or ``kw``)."""
    c = _c(col)
    u = F.lit(unit) if isinstance(unit, str) else unit
    return F.when(F.lower(u) == "watts", c / F.lit(1000.0)).otherwise(c)
