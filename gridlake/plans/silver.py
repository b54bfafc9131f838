"""Silver: raw text -> cleansed, typed, latest-per-key tables.

One builder serves all six datasets; the registry's DatasetSpec says which
source column feeds which output and how it is converted. Plan per table:
scan -> null-token projection -> top-1 per key (partial WindowGroupLimit,
one shuffle on the key) -> one typed projection -> drop expectations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from gridlake.functions.columns import convert_sql, first_match_sql, lit_sql, q
from gridlake.operators.cleanse import latest_per_key, normalize_nulls
from gridlake.operators.quality import apply_expectations
from gridlake.registry import TYPE_MAPS, U2_TYPE_TO_CANONICAL, Col, DatasetSpec, Derived, RunOptions

_LINEAGE_TYPES = {"_source_file": "string", "_ingestion_ts": "timestamp"}


def _source_columns(s: DatasetSpec, present: set) -> list[str]:
    used = [c.source for c in s.columns if isinstance(c, Col)]
    if any(isinstance(c, Derived) and c.rule == "der_type_wide" for c in s.columns):
        used += list(s.tech_columns)
    return [c for c in dict.fromkeys(used) if c in present]


_NULL_TYPES = {"text": "STRING", "lower": "STRING", "double": "DOUBLE", "long": "BIGINT",
               "int": "INT", "bool": "BOOLEAN", "ts": "TIMESTAMP"}


def _output_sql(s: DatasetSpec, present: set, options: RunOptions) -> list[str]:
    """The typed projection as SQL text (one JVM call for the whole list)."""
    out: dict[str, str] = {}
    for c in s.columns:
        if isinstance(c, Col):
            if c.source in present:
                e = convert_sql(q(c.source), c.kind)
            else:  # column not (yet) delivered by this utility: typed NULL
                e = f"CAST(NULL AS {_NULL_TYPES[c.kind]})"
            if c.name == "nameplate_rating_kw" and options.convert_units and s.rating_unit == "watts":
                e = f"({e}) / 1000.0"
            if (c.name == "feeder_id" and options.canonical_feeder_ids and c.source in present
                    and s.utility_id == "utility_1" and s.dataset != "circuits"):
                # same integral reading the feeder dimension applies to its ids
                e = f"coalesce(CAST({convert_sql(q(c.source), 'long')} AS STRING), {e})"
            out[c.name] = e
        elif c.rule == "der_type_wide":
            out[c.name] = first_match_sql([t for t in s.tech_columns if t in present],
                                          TYPE_MAPS[s.utility_id])
        elif c.rule == "false":
            out[c.name] = "false"
        elif c.rule == "feeder_missing":
            out[c.name] = f"({out['feeder_id']}) IS NULL"
        elif c.rule == "utility":
            out[c.name] = lit_sql(s.utility_id)
        elif c.rule == "lineage":
            out[c.name] = q(c.name) if c.name in present else f"CAST(NULL AS {_LINEAGE_TYPES[c.name]})"
        else:
            raise ValueError(c.rule)
    if options.map_types and s.utility_id == "utility_2" and "der_type" in out:
        pairs = ", ".join(f"{lit_sql(k)}, {lit_sql(v)}" for k, v in U2_TYPE_TO_CANONICAL.items())
        d = out["der_type"]
        out["der_type"] = f"coalesce(try_element_at(map({pairs}), {d}), {d})"
    return [f"{e} AS {q(name)}" for name, e in out.items()]


def build_typed(raw: DataFrame, s: DatasetSpec, options: RunOptions | None = None) -> DataFrame:
    """Raw text table -> typed, latest-per-key rows, before expectations."""
    options = options or RunOptions()
    present = set(raw.columns)
    if s.key not in present:
        raise KeyError(f"{s.raw_table}: key column {s.key!r} missing")
    cleaned = normalize_nulls(raw, s.null_tokens)
    # Tie-breakers: the lineage file, then every source column the output
    # reads. Rows tying on all of them produce identical output rows, so the
    # result is deterministic without ordering on unread columns (which
    # keeps column pruning at the scan).
    ties = (["_source_file"] if "_source_file" in present else []) + \
        [c for c in _source_columns(s, present) if c != s.key]
    latest = latest_per_key(cleaned, s.key, order="_ingestion_ts", tie_breakers=ties,
                            keep_null_keys=options.keep_null_keys, trim_key=options.trim_key)
    return latest.selectExpr(*_output_sql(s, present, options))


def build_silver(raw: DataFrame, s: DatasetSpec, options: RunOptions | None = None,
                 observation: Observation | None = None, typed: DataFrame | None = None) -> DataFrame:
    """Raw text table -> Silver table for dataset spec ``s`` (expectations
    applied: metrics observed, ``drop`` violators removed)."""
    if typed is None:
        typed = build_typed(raw, s, options)
    return apply_expectations(typed, s.expectations, observation)
