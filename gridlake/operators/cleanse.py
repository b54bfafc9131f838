"""DataFrame -> DataFrame cleansing operators (Silver building blocks)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridlake.functions import (
    first_match,
    global_id,
    global_id_nullsafe,
)
from gridlake.functions.columns import null_if_token_sql, q
from gridlake.registry import NULL_TOKENS_9


def normalize_nulls(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS_9,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Null-like text tokens -> SQL NULL, in one projection over the string
    columns (or the given ones). Other columns pass through untouched."""
    tokens = list(tokens)
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.selectExpr(*[
        f"{null_if_token_sql(q(c), tokens)} AS {q(c)}" if c in targets else q(c)
        for c in df.columns
    ])


# Between packed values; what stands for an empty value, and begins what stands
# for these two bytes inside of values.
_END, _MARK = "CAST(X'00' AS STRING)", "CAST(X'01' AS STRING)"
_ESCAPED = ((_MARK, "CAST(X'0103' AS STRING)"), (_END, "CAST(X'0102' AS STRING)"))
#: Text columns in a row from which on they are packed.
PACK_FROM = 4


def pack_sql(columns: Sequence[str]) -> list[str]:
    """The text columns as one text, which compares byte by byte as the columns
    do one after the other, NULL first, and the lengths of eight of them in each
    of some numbers (-1: a value is long or has one of the two bytes). A row
    holds 16 bytes and some padding for each text column: packed, they take two
    bytes beside their text."""
    def values(shape) -> str:
        return f"concat_ws({_END}, {', '.join(f"CASE WHEN {c} IS NULL THEN '' WHEN {c} = '' THEN {_MARK} ELSE {shape(c)} END" for c in names)})"

    def escaped(c: str) -> str:
        for byte, stands in _ESCAPED:
            c = f"replace({c}, {byte}, {stands})"
        return c
    names = [q(c) for c in columns]
    text = f"concat_ws('', {', '.join(names)})"
    odd = f"(contains({text}, {_END}) OR contains({text}, {_MARK}))"
    size = [f"CASE WHEN {c} = '' THEN 1 ELSE coalesce(octet_length({c}), 0) END" for c in names]
    rare = f"(greatest({', '.join(size)}) > 254 OR {odd})"
    lengths = [" | ".join(f"shiftleft(CAST({n} AS BIGINT), {8 * k})" for k, n in enumerate(size[at:at + 8])) for at in range(0, len(size), 8)]
    return [f"CASE WHEN {odd} THEN {values(escaped)} ELSE {values(str)} END", *[f"CASE WHEN {rare} THEN -1L ELSE {n} END" for n in lengths]]


def _unpack(df: DataFrame, packed: Mapping[str, Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """``columns`` of df, those of the packed ones from ``packed`` (name ->
    columns). Each is cut out alone, by bytes: what is not read costs nothing."""
    values = {}
    for name, held in packed.items():
        p, numbers = q(name), [q(f"{name}_{k}") for k in range(-(-len(held) // 8))]
        size = [f"(shiftrightunsigned({numbers[i // 8]}, {8 * (i % 8)}) & 255L)" for i in range(len(held))]
        for i, c in enumerate(held):
            start = " + ".join([*size[:i], f"{i + 1}"])
            cut = f"CAST(substring(CAST({p} AS BINARY), CAST({start} AS INT), CAST({size[i]} AS INT)) AS STRING)"
            upto = f"substring_index({p}, {_END}, {i + 1})" if i < len(held) - 1 else p
            back = rare = f"substring_index({upto}, {_END}, -1)" if i else upto
            for byte, stands in reversed(_ESCAPED):
                back = f"replace({back}, {stands}, {byte})"
            values[c] = (f"CASE WHEN {numbers[0]} = -1L THEN CASE WHEN {rare} = '' THEN NULL WHEN {rare} = {_MARK} THEN '' ELSE {back} END "
                         f"WHEN {size[i]} = 0L THEN NULL WHEN {size[i]} = 1L THEN replace({cut}, {_MARK}, '') ELSE {cut} END AS {q(c)}")
    return df.selectExpr(*[values.get(c, q(c)) for c in columns])


def _text_runs(df: DataFrame, columns: Sequence[str]) -> list[list[str]]:
    """The columns in order, consecutive text columns (compared by bytes) together."""
    runs: list[list[str]] = []
    last = False
    for c in columns:
        text = df.schema[c].dataType == StringType()
        if text and last:
            runs[-1].append(c)
        else:
            runs.append([c])
        last = text
    return runs


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: str = "_ingestion_ts",
                   tie_breakers: Sequence[str] | None = None, keep_null_keys: bool = False,
                   trim_key: bool = False) -> DataFrame:
    """Keep the latest row per natural key (``order`` descending, NULLs last).

    Ties on ``order`` are broken deterministically by ``tie_breakers``
    (descending); by default ``_source_file`` and then every other column, so
    the winner never depends on partitioning. Rows whose key is NULL form one
    group (only one survives) unless ``keep_null_keys``.

    Planned as row_number() = 1, which Catalyst turns into a partial
    WindowGroupLimit *before* the shuffle: each map task forwards at most one
    row per key, so a hot key costs one row per task, not a third of the data.
    Text columns that follow each other as tie-breakers are packed into one
    before the two sorts and the shuffle, and unpacked behind them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if tie_breakers is None:
        rest = [c for c in df.columns if c not in keys and c != order]
        tie_breakers = (["_source_file"] if "_source_file" in rest else []) + \
            sorted(c for c in rest if c != "_source_file")
    part = [f"trim({q(k)})" if trim_key else q(k) for k in keys]
    columns, packed, ties = df.columns, {}, []
    for run in _text_runs(df, [c for c in dict.fromkeys(tie_breakers) if c not in keys and c != order]):
        if len(run) < PACK_FROM:
            ties += run
        else:
            ties.append(f"_packed{len(packed)}")
            packed[ties[-1]] = run
    ordering = ", ".join(f"{q(c)} DESC NULLS LAST" for c in [order, *ties])
    if keep_null_keys:
        # Every row with a NULL key becomes its own group (keyed by its scan
        # position, stable across task retries), so all of them survive in
        # the same single pass, and they never gather in one task.
        any_null = " OR ".join(f"{q(k)} IS NULL" for k in keys)
        df = df.selectExpr("*", f"CASE WHEN {any_null} THEN monotonically_increasing_id() END AS _nk")
        part.append("_nk")
    if packed:
        inside = {c for run in packed.values() for c in run}
        df = df.selectExpr(*[q(c) for c in df.columns if c not in inside],
                           *[f"{e} AS {q(name + (f'_{k - 1}' if k else ''))}" for name, run in packed.items() for k, e in enumerate(pack_sql(run))])
    rn = f"row_number() OVER (PARTITION BY {', '.join(part)} ORDER BY {ordering}) AS _rn"
    out = df.selectExpr("*", rn).filter("_rn = 1").drop("_rn")
    if packed:
        return _unpack(out, packed, columns)
    return out.drop("_nk") if keep_null_keys else out


def apply_column_map(df: DataFrame, mapping: Mapping[str, str], missing: str = "null") -> DataFrame:
    """canonical -> source column map applied as one projection. Source
    columns absent from ``df`` become NULL (``missing="null"``) or raise."""
    present = set(df.columns)
    cols = []
    for canonical, source in mapping.items():
        if source in present:
            cols.append(F.col(f"`{source}`").alias(canonical))
        elif missing == "null":
            cols.append(F.lit(None).cast("string").alias(canonical))
        else:
            raise KeyError(f"source column {source!r} not in frame")
    return df.select(*cols)


def derive_type(df: DataFrame, flag_columns: Sequence[str], names: Mapping[str, str] | None = None,
                output: str = "der_type") -> DataFrame:
    """Wide technology flags -> single type column (first flag > 0 wins)."""
    present = [c for c in flag_columns if c in df.columns]
    return df.withColumn(output, first_match(present, names))


def add_global_id(df: DataFrame, utility_col: str, local_id_col: str, output_col: str,
                  null_safe: bool = True) -> DataFrame:
    """``utility::local`` id; NULL local id -> NULL (``null_safe``) or the
    bare utility id (concat_ws semantics)."""
    fn = global_id_nullsafe if null_safe else global_id
    return df.withColumn(output_col, fn(utility_col, local_id_col))
