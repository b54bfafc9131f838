"""DuckDB oracle SQL for the registered queries.

Independent re-statement of each query in plain SQL over the driver's
tables, used to check the Spark results. The raw derivations are shared
text (gridlake.sources.derived) — they define the *input*; every Silver,
Gold and Platinum step below is written out separately in SQL.
"""

from __future__ import annotations

from gridlake.registry import (
    GOLD_EXPECTATIONS,
    NULL_TOKENS_8,
    NULL_TOKENS_9,
    SPECS,
    STALE_AFTER_DAYS,
    U1_PROJECT_TYPE_TO_CANONICAL,
    U2_TYPE_TO_CANONICAL,
    CONTRACTS,
    TYPE_MAPS,
    Col,
    spec,
)
from gridlake.sources.derived import DERIVATIONS, derivation, raw_sql

AS_OF = "TIMESTAMP '2024-02-15 00:00:00'"
_INTEGRAL = r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(tokens) -> str:
    return "(" + ", ".join(_lit(t) for t in tokens) + ")"


def raw_columns(name: str) -> list[str]:
    if name == "u1_der_raw":
        return list(dict.fromkeys(raw_columns("u1_install_der_raw") + raw_columns("u1_planned_der_raw")))
    d = derivation(name)
    return [c for c, _ in d.columns] + ["_utility_id", "_environment"]


def normalize_sql(src: str, columns: list[str], tokens) -> str:
    sel = []
    for c in columns:
        if c == "_ingestion_ts":
            sel.append(c)
        else:
            sel.append(f"CASE WHEN trim({c}) IN {_in_list(tokens)} THEN NULL ELSE {c} END AS {c}")
    return f"SELECT {', '.join(sel)} FROM {src}"


def convert_sql(c: str, kind: str) -> str:
    if kind == "text":
        return f"trim({c})"
    if kind == "lower":
        return f"lower(trim({c}))"
    if kind == "double":
        return f"TRY_CAST({c} AS DOUBLE)"
    if kind in ("long", "int"):
        t = "BIGINT" if kind == "long" else "INTEGER"
        return (f"CASE WHEN regexp_matches({c}, {_lit(_INTEGRAL)}) "
                f"THEN TRY_CAST(regexp_extract({c}, {_lit(_INTEGRAL)}, 1) AS {t}) END")
    if kind == "bool":
        return (f"CASE WHEN lower(trim({c})) IN ('t', 'true', 'y', 'yes', '1') THEN TRUE "
                f"WHEN lower(trim({c})) IN ('f', 'false', 'n', 'no', '0') THEN FALSE END")
    if kind == "ts":
        return f"TRY_CAST({c} AS TIMESTAMP)"
    raise ValueError(kind)


def first_match_sql(flags, names) -> str:
    parts = [f"CASE WHEN TRY_CAST({c} AS DOUBLE) > 0 THEN {_lit(names.get(c, c))} END" for c in flags]
    return f"COALESCE({', '.join(parts)}, CAST(NULL AS VARCHAR))"


def map_sql(c: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {c} {whens} ELSE {c} END"


def order_desc(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


class Oracle:
    """Named CTEs with explicit dependencies; ``query`` emits a WITH clause
    holding just what a final SELECT needs."""

    def __init__(self):
        self.ctes: dict[str, tuple[str, tuple]] = {}
        for d in DERIVATIONS:
            self.add(d.name, raw_sql(d))
        self.add("u1_der_raw", "SELECT * FROM u1_install_der_raw UNION ALL BY NAME SELECT * FROM u1_planned_der_raw",
                 ["u1_install_der_raw", "u1_planned_der_raw"])
        for s in SPECS:
            self._silver(s)
        self._gold()
        self._platinum()

    def add(self, name: str, sql: str, deps=()):
        self.ctes[name] = (sql, tuple(deps))

    def query(self, final: str, deps) -> str:
        order: list[str] = []

        def visit(n):
            if n in order:
                return
            for d in self.ctes[n][1]:
                visit(d)
            order.append(n)

        for d in deps:
            visit(d)
        with_ = ",\n".join(f"{n} AS (\n{self.ctes[n][0]}\n)" for n in order)
        return f"WITH {with_}\n{final}"

    # -- Silver -------------------------------------------------------------
    def _silver(self, s):
        cols = raw_columns(s.raw_table)
        norm = f"{s.silver_table}__norm"
        self.add(norm, normalize_sql(s.raw_table, cols, s.null_tokens), [s.raw_table])
        used = [c.source for c in s.columns if isinstance(c, Col)]
        if s.tech_columns:
            used += list(s.tech_columns)
        ties = ["_ingestion_ts", "_source_file"] + [c for c in dict.fromkeys(used) if c != s.key]
        ranked = f"{s.silver_table}__latest"
        self.add(ranked, f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {s.key} "
                         f"ORDER BY {order_desc(ties)}) AS _rn FROM {norm}) WHERE _rn = 1", [norm])
        sel = []
        exprs = {}
        for c in s.columns:
            if isinstance(c, Col):
                e = convert_sql(c.source, c.kind)
            elif c.rule == "der_type_wide":
                e = first_match_sql(s.tech_columns, TYPE_MAPS[s.utility_id])
            elif c.rule == "false":
                e = "FALSE"
            elif c.rule == "feeder_missing":
                e = f"({exprs['feeder_id']}) IS NULL"
            elif c.rule == "utility":
                e = _lit(s.utility_id)
            else:
                e = c.name
            exprs[c.name] = e
            sel.append(f"{e} AS {c.name}")
        typed = f"{s.silver_table}__typed"
        self.add(typed, f"SELECT {', '.join(sel)} FROM {ranked}", [ranked])
        drops = [e.predicate for e in s.expectations if e.action == "drop"]
        where = (" WHERE " + " AND ".join(f"COALESCE({p}, FALSE)" for p in drops)) if drops else ""
        self.add(s.silver_table, f"SELECT * FROM {typed}{where}", [typed])

    # -- Gold ---------------------------------------------------------------
    def _gold(self):
        picks = ["voltage_kv", "feeder_max_hc_mw", "feeder_min_hc_mw", "hca_date", "feeder_name"]
        self.add("u1_feeders", f"""
SELECT CAST(feeder_id AS VARCHAR) AS feeder_id, 'utility_1' AS utility_id, feeder_name, voltage_kv,
       feeder_max_hc_mw AS max_hosting_capacity_mw, feeder_min_hc_mw AS min_hosting_capacity_mw,
       hca_date AS hca_refresh_date, segment_count,
       CAST(NULL AS VARCHAR) AS map_color, CAST(NULL AS DOUBLE) AS dg_since_refresh_mw
FROM (SELECT *, row_number() OVER (PARTITION BY feeder_id
                ORDER BY {order_desc(['_ingestion_ts', 'section_id'] + picks)}) AS _rn,
             count(section_id) OVER (PARTITION BY feeder_id) AS segment_count
      FROM u1_circuits_clean) WHERE _rn = 1""", ["u1_circuits_clean"])
        self.add("feeder_rollup", """
SELECT CAST(feeder_id AS BIGINT) AS feeder_id, voltage_kv, max_hosting_capacity_mw,
       min_hosting_capacity_mw, hca_refresh_date, feeder_name, segment_count
FROM u1_feeders""", ["u1_feeders"])
        self.add("dim_feeder", f"""
SELECT concat_ws('::', utility_id, feeder_id) AS global_feeder_id, feeder_id, utility_id, feeder_name,
       voltage_kv, max_hosting_capacity_mw, min_hosting_capacity_mw, hca_refresh_date, segment_count,
       map_color, dg_since_refresh_mw, max_hosting_capacity_mw > 0 AS has_hosting_capacity,
       {AS_OF} AS _gold_created_ts
FROM (SELECT * FROM u1_feeders
      UNION ALL
      SELECT feeder_id, 'utility_2', CAST(NULL AS VARCHAR), voltage_kv, feeder_max_hc_mw,
             feeder_min_hc_mw, hca_date, CAST(1 AS BIGINT), map_color, dg_since_refresh_mw
      FROM u2_circuits_clean)""", ["u1_feeders", "u2_circuits_clean"])
        ids = ("concat_ws('::', utility_id, der_id) AS global_der_id, "
               "CASE WHEN feeder_id IS NOT NULL THEN concat_ws('::', utility_id, feeder_id) END "
               "AS global_feeder_id")
        self.add("fact_installed_der", f"""
SELECT *, {ids}, 'installed' AS der_status, feeder_id IS NULL AS _feeder_missing,
       {AS_OF} AS _gold_created_ts
FROM (SELECT project_id AS der_id, feeder_id, _utility_id AS utility_id, der_type, nameplate_rating_kw,
             is_hybrid, project_type AS source_type_code, CAST(NULL AS VARCHAR) AS service_address,
             CAST(NULL AS DOUBLE) AS interconnection_cost
      FROM u1_install_der_clean
      UNION ALL
      SELECT der_id, feeder_id, _utility_id, der_type, nameplate_rating_kw, is_hybrid,
             CAST(NULL AS VARCHAR), service_address, interconnection_cost
      FROM u2_install_der_clean)""", ["u1_install_der_clean", "u2_install_der_clean"])
        self.add("fact_planned_der", f"""
SELECT *, {ids}, 'planned' AS der_status, {AS_OF} AS _gold_created_ts
FROM (SELECT project_id AS der_id, feeder_id, _utility_id AS utility_id, der_type, nameplate_rating_kw,
             is_hybrid, project_status AS queue_status, in_service_date AS planned_date, _feeder_missing
      FROM u1_planned_der_clean
      UNION ALL
      SELECT request_id, feeder_id, _utility_id, der_type, nameplate_rating_kw, is_hybrid,
             der_status, planned_install_date, _feeder_missing
      FROM u2_planned_der_clean)""", ["u1_planned_der_clean", "u2_planned_der_clean"])

    # -- Platinum -----------------------------------------------------------
    def _platinum(self):
        held = "(abs({c}) < 1e20 AND CAST(TRY_CAST({c} AS DECIMAL(38,6)) AS DOUBLE) IS NOT DISTINCT FROM CAST({c} AS DOUBLE))"
        some = "CAST(SUM(CASE WHEN " + held + " THEN TRY_CAST({c} AS DECIMAL(38,6)) END) AS DOUBLE)"
        rest = "SUM(CASE WHEN NOT " + held + " THEN CAST({c} AS DOUBLE) END)"
        exact = "coalesce(" + some + " + " + rest + ", " + some + ", " + rest + ")"
        avg = "CASE WHEN COUNT({c}) = 0 THEN NULL ELSE " + exact + " / COUNT({c}) END"
        self.add("v_feeders_by_hc", """
SELECT global_feeder_id, feeder_id, utility_id, feeder_name, voltage_kv, max_hosting_capacity_mw,
       min_hosting_capacity_mw, hca_refresh_date, segment_count, has_hosting_capacity
FROM dim_feeder""", ["dim_feeder"])
        cols = ("feeder_id, global_feeder_id, utility_id, der_type, nameplate_rating_kw, is_hybrid, "
                "der_status")
        self.add("v_der_by_feeder", f"""
SELECT global_der_id AS der_id, {cols} FROM fact_installed_der
UNION ALL
SELECT global_der_id AS der_id, {cols} FROM fact_planned_der""",
                 ["fact_installed_der", "fact_planned_der"])
        self.add("v_feeder_map_summary", f"""
SELECT f.global_feeder_id, f.feeder_id, f.utility_id, f.voltage_kv, f.max_hosting_capacity_mw,
       f.min_hosting_capacity_mw, f.has_hosting_capacity,
       COALESCE(i.installed_der_count, 0) AS installed_der_count,
       COALESCE(i.installed_capacity_kw, 0) AS installed_capacity_kw,
       COALESCE(i.installed_type_count, 0) AS installed_type_count,
       COALESCE(p.planned_der_count, 0) AS planned_der_count,
       COALESCE(p.planned_capacity_kw, 0) AS planned_capacity_kw,
       COALESCE(i.installed_der_count, 0) + COALESCE(p.planned_der_count, 0) AS total_der_count
FROM dim_feeder f
LEFT JOIN (SELECT utility_id, feeder_id, COUNT(*) AS installed_der_count,
                  {exact.format(c='nameplate_rating_kw')} AS installed_capacity_kw,
                  COUNT(DISTINCT der_type) AS installed_type_count
           FROM fact_installed_der WHERE feeder_id IS NOT NULL GROUP BY utility_id, feeder_id) i
  ON f.utility_id = i.utility_id AND f.feeder_id = i.feeder_id
LEFT JOIN (SELECT utility_id, feeder_id, COUNT(*) AS planned_der_count,
                  {exact.format(c='nameplate_rating_kw')} AS planned_capacity_kw
           FROM fact_planned_der WHERE feeder_id IS NOT NULL GROUP BY utility_id, feeder_id) p
  ON f.utility_id = p.utility_id AND f.feeder_id = p.feeder_id""",
                 ["dim_feeder", "fact_installed_der", "fact_planned_der"])
        self.add("v_data_quality_report", f"""
SELECT utility_id, installed_total_rows, installed_null_feeder_count, installed_avg_rating_kw,
       installed_distinct_types, installed_null_feeder_pct, planned_total_rows,
       planned_null_feeder_count, planned_null_feeder_pct, feeder_count, feeders_with_hc,
       avg_max_hc_mw, {AS_OF} AS _report_ts
FROM (SELECT utility_id, COUNT(*) AS installed_total_rows,
             CAST(SUM(CASE WHEN _feeder_missing THEN 1 ELSE 0 END) AS BIGINT) AS installed_null_feeder_count,
             {avg.format(c='nameplate_rating_kw')} AS installed_avg_rating_kw,
             COUNT(DISTINCT der_type) AS installed_distinct_types,
             round(CAST(SUM(CASE WHEN _feeder_missing THEN 1 ELSE 0 END) AS BIGINT) / COUNT(*) * 100, 2)
               AS installed_null_feeder_pct
      FROM fact_installed_der GROUP BY utility_id) i
FULL OUTER JOIN
     (SELECT utility_id, COUNT(*) AS planned_total_rows,
             CAST(SUM(CASE WHEN _feeder_missing THEN 1 ELSE 0 END) AS BIGINT) AS planned_null_feeder_count,
             round(CAST(SUM(CASE WHEN _feeder_missing THEN 1 ELSE 0 END) AS BIGINT) / COUNT(*) * 100, 2)
               AS planned_null_feeder_pct
      FROM fact_planned_der GROUP BY utility_id) p USING (utility_id)
FULL OUTER JOIN
     (SELECT utility_id, COUNT(*) AS feeder_count,
             CAST(SUM(CASE WHEN has_hosting_capacity THEN 1 ELSE 0 END) AS BIGINT) AS feeders_with_hc,
             {avg.format(c='max_hosting_capacity_mw')} AS avg_max_hc_mw
      FROM dim_feeder GROUP BY utility_id) f USING (utility_id)""",
                 ["dim_feeder", "fact_installed_der", "fact_planned_der"])
        parts = []
        for s in SPECS:
            parts.append(f"""
SELECT MAX(_ingestion_ts) AS last_ingestion_ts, COUNT(*) AS total_rows,
       COUNT(DISTINCT _source_file) AS source_file_count, {_lit(s.utility_id)} AS utility_id,
       {_lit(s.dataset)} AS dataset_type, {_lit(s.raw_table)} AS source_table,
       CAST(date_diff('day', CAST(MAX(_ingestion_ts) AS DATE), CAST({AS_OF} AS DATE)) AS INTEGER)
         AS days_since_last_load
FROM {s.raw_table}""")
        self.add("v_ingestion_metadata", f"""
SELECT *, days_since_last_load > {STALE_AFTER_DAYS} AS is_stale, {AS_OF} AS _report_ts
FROM ({' UNION ALL '.join(parts)})""", [s.raw_table for s in SPECS])


_O: Oracle | None = None


def oracle() -> Oracle:
    global _O
    if _O is None:
        _O = Oracle()
    return _O


def expectation_metrics_sql(o: Oracle) -> str:
    parts, deps = [], []
    for s in SPECS:
        # metrics are taken before the drop rule removes violators
        src = f"{s.silver_table}__typed"
        for e in s.expectations:
            parts.append(f"SELECT {_lit(s.silver_table)} AS table_name, {_lit(e.name)} AS expectation, "
                         f"{_lit(e.action)} AS action, COUNT(*) AS total_rows, "
                         f"CAST(COUNT(*) FILTER (WHERE NOT COALESCE({e.predicate}, FALSE)) AS BIGINT) "
                         f"AS failed_rows FROM {src}")
        deps.append(src)
    for table, exps in GOLD_EXPECTATIONS.items():
        for e in exps:
            parts.append(f"SELECT {_lit(table)}, {_lit(e.name)}, {_lit(e.action)}, COUNT(*), "
                         f"CAST(COUNT(*) FILTER (WHERE NOT COALESCE({e.predicate}, FALSE)) AS BIGINT) "
                         f"FROM {table}")
        deps.append(table)
    return o.query("\nUNION ALL\n".join(parts), deps)


def expectation_quarantine_sql(o: Oracle) -> str:
    parts, deps = [], []
    for s in SPECS:
        src = f"{s.silver_table}__typed"
        drops = " OR ".join(f"NOT COALESCE({e.predicate}, FALSE)" for e in s.expectations if e.action == "drop") or "FALSE"
        for e in s.expectations:
            fails = f"CAST(COUNT(*) FILTER (WHERE NOT COALESCE({e.predicate}, FALSE)) AS BIGINT)"
            parts.append(f"SELECT {_lit(s.silver_table)} AS table_name, {_lit(e.name)} AS expectation, {_lit(e.action)} AS action, "
                         f"{fails} AS failed_rows, {fails} AS stored_failed_rows, "
                         f"CAST(COUNT(*) FILTER (WHERE NOT ({drops})) AS BIGINT) AS kept_rows, "
                         f"CAST(COUNT(*) FILTER (WHERE {drops}) AS BIGINT) AS quarantined_rows FROM {src}")
        deps.append(src)
    return o.query("\nUNION ALL\n".join(parts), deps)


def contract_violations_sql(o: Oracle) -> str:
    parts, deps = [], []
    for (layer, table), cols in CONTRACTS.items():
        for name, _typ, nullable in cols:
            if not nullable:
                parts.append(f"SELECT {_lit(table)} AS table_name, {_lit(name)} AS column_name, "
                             f"'null_in_non_nullable' AS violation, 'not null' AS expected, "
                             f"'null' AS actual, COUNT(*) FILTER (WHERE {name} IS NULL) AS rows "
                             f"FROM {table}")
        deps.append(table)
    return o.query("SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE rows > 0", deps)


def refresh_tables_sql(o: Oracle) -> str:
    """Bronze holds every raw row; a fact holds a row for each key of its two
    raw tables, the rows without a key counting as one key."""
    parts = [f"SELECT 'bronze.{s.raw_table}' AS table_name, {_lit(s.utility_id)} AS utility_id, "
             f"'dev' AS environment, COUNT(*) AS n_rows, COUNT(*) AS from_own_drop, "
             f"CAST(1 AS BIGINT) AS load_times FROM {s.raw_table} HAVING COUNT(*) > 0" for s in SPECS]
    facts = {"installed_der": "gold.fact_installed_der", "planned_der": "gold.fact_planned_der"}
    for s in SPECS:
        if s.dataset in facts:
            key = f"CASE WHEN trim({s.key}) IN {_in_list(s.null_tokens)} THEN NULL ELSE {s.key} END"
            parts.append(f"SELECT {_lit(facts[s.dataset])}, {_lit(s.utility_id)}, CAST(NULL AS VARCHAR), "
                         f"COUNT(DISTINCT {key}) + MAX(CASE WHEN ({key}) IS NULL THEN 1 ELSE 0 END), "
                         f"CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM {s.raw_table} HAVING COUNT(*) > 0")
    return o.query("\nUNION ALL\n".join(parts), [s.raw_table for s in SPECS])


def refresh_failed_run_sql(o: Oracle) -> str:
    """Both ways of reading give the rows of the first run."""
    parts = [f"SELECT '{t}' AS table_name, '{how}' AS read_through, utility_id, COUNT(*) AS n_rows, TRUE AS of_first_run "
             f"FROM {t} GROUP BY utility_id" for t in ("dim_feeder", "fact_installed_der", "fact_planned_der")
             for how in ("catalog", "pointer")]
    return o.query("\nUNION ALL\n".join(parts), ["dim_feeder", "fact_installed_der", "fact_planned_der"])


def zorder_lookup_sql(o: Oracle) -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n_rows, TRUE AS skips "
             f"FROM v_feeder_map_summary WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("utility_id", "feeder_id")]
    return o.query("\nUNION ALL\n".join(parts), ["v_feeder_map_summary"])


def contract_drift_sql(o: Oracle) -> str:
    """Run 2 holds utility 2 and departs in three columns."""
    found = (("nameplate_rating_kw", "type_mismatch", "'double'", "'string'"), ("is_hybrid", "missing_column", "'boolean'", "NULL"),
             ("remark", "unknown_column", "NULL", "'string'"))
    parts = [f"SELECT 'fact_installed_der' AS table_name, 'run_2' AS folder, '{c}' AS column_name, '{v}' AS violation, "
             f"CAST({e} AS VARCHAR) AS expected, CAST({a} AS VARCHAR) AS actual, COUNT(*) AS n_rows "
             f"FROM fact_installed_der WHERE utility_id = 'utility_2' HAVING COUNT(*) > 0" for c, v, e, a in found]
    return o.query("\nUNION ALL\n".join(parts), ["fact_installed_der"])


def sql_for(name: str) -> str:
    """Oracle SQL for a registered query name."""
    o = oracle()
    u1c = spec("utility_1", "circuits")
    u1i = spec("utility_1", "installed_der")
    if name in o.ctes and not name.endswith("_raw") and "__" not in name and name not in (
            "u1_feeders",):
        return o.query(f"SELECT * FROM {name}", [name])
    if name == "null_tokens_9":
        return o.query(normalize_sql("u1_circuits_raw", raw_columns("u1_circuits_raw"), NULL_TOKENS_9),
                       ["u1_circuits_raw"])
    if name == "null_tokens_8":
        return o.query(normalize_sql("u1_der_raw", raw_columns("u1_der_raw"), NULL_TOKENS_8),
                       ["u1_der_raw"])
    if name == "lenient_casts":
        return o.query(f"""
SELECT NYHCPV_csv_NSECTION, {convert_sql('NYHCPV_csv_NSECTION', 'long')} AS section_id,
       NYHCPV_csv_NFEEDER, {convert_sql('NYHCPV_csv_NFEEDER', 'long')} AS feeder_id,
       NYHCPV_csv_NVOLTAGE, {convert_sql('NYHCPV_csv_NVOLTAGE', 'double')} AS voltage_kv,
       Circuits_Phase3_NUMPHASES, {convert_sql('Circuits_Phase3_NUMPHASES', 'int')} AS num_phases,
       NYHCPV_csv_FHCADATE, {convert_sql('NYHCPV_csv_FHCADATE', 'ts')} AS hca_date
FROM u1_circuits_raw""", ["u1_circuits_raw"])
    if name == "lenient_bool_dates":
        return o.query(f"""
SELECT ProjectID, Hybrid, {convert_sql('Hybrid', 'bool')} AS is_hybrid,
       InServiceDate, {convert_sql('InServiceDate', 'ts')} AS in_service_date,
       CompletionDate, {convert_sql('CompletionDate', 'ts')} AS completion_date,
       NamePlateRating, {convert_sql('NamePlateRating', 'double')} AS nameplate_rating
FROM u1_der_raw""", ["u1_der_raw"])
    if name in ("latest_per_key", "latest_incremental"):
        cols = raw_columns("u1_circuits_raw")
        o.add("q_norm9", normalize_sql("u1_circuits_raw", cols, NULL_TOKENS_9), ["u1_circuits_raw"])
        rest = [c for c in cols if c not in (u1c.key, "_ingestion_ts")]
        ties = ["_ingestion_ts", "_source_file"] + sorted(c for c in rest if c != "_source_file")
        return o.query(f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY "
                       f"{u1c.key} ORDER BY {order_desc(ties)}) AS _rn FROM q_norm9) WHERE _rn = 1",
                       ["q_norm9"])
    if name == "latest_null_key":
        cols = raw_columns("u1_der_raw")
        o.add("q_norm8", normalize_sql("u1_der_raw", cols, NULL_TOKENS_8), ["u1_der_raw"])
        rest = [c for c in cols if c not in (u1i.key, "_ingestion_ts")]
        ties = ["_ingestion_ts", "_source_file"] + sorted(c for c in rest if c != "_source_file")
        return o.query(f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY "
                       f"{u1i.key} ORDER BY {order_desc(ties)}) AS _rn FROM q_norm8 "
                       f"WHERE {u1i.key} IS NOT NULL) WHERE _rn = 1 "
                       f"UNION ALL SELECT {', '.join(cols)} FROM q_norm8 WHERE {u1i.key} IS NULL",
                       ["q_norm8"])
    if name == "first_match_type":
        return o.query(f"SELECT ProjectID, "
                       f"{first_match_sql(u1i.tech_columns, TYPE_MAPS['utility_1'])} AS der_type "
                       f"FROM u1_der_raw", ["u1_der_raw"])
    if name == "column_map":
        return o.query("""
SELECT DER_ID AS der_id, DER_TYPE AS der_type, DER_NAMEPLATE_RATING AS nameplate_rating,
       DER_INTERCONNECTION_LOCATION AS feeder_id, SERVICE_STREET_ADDRESS AS service_address,
       INTERCONNECTION_COST AS interconnection_cost
FROM u2_install_der_raw
UNION ALL BY NAME
SELECT DER_TYPE AS der_type, DER_NAMEPLATE_RATING AS nameplate_rating,
       DER_INTERCONNECTION_LOCATION AS feeder_id, INTERCONNECTION_QUEUE_REQUEST_ID AS request_id,
       INTERCONNECTION_QUEUE_POSITION AS queue_position, PLANNED_INSTALLATION_DATE AS planned_date,
       DER_STATUS AS status, DER_STATUS_RATIONALE AS status_rationale
FROM u2_planned_der_raw""", ["u2_install_der_raw", "u2_planned_der_raw"])
    if name == "column_maps":
        return o.query("""
SELECT 'utility_1' AS utility_id, 'circuits' AS dataset, NYHCPV_csv_NSECTION AS section_id, NYHCPV_csv_NFEEDER AS feeder_id,
       NYHCPV_csv_FFEEDER AS feeder_name, NYHCPV_csv_NVOLTAGE AS voltage_kv, NYHCPV_csv_NMAXHC AS segment_max_hc_mw,
       NYHCPV_csv_FMAXHC AS feeder_max_hc_mw, NYHCPV_csv_FMINHC AS feeder_min_hc_mw, NYHCPV_csv_FHCADATE AS hca_date,
       Circuits_Phase3_CIRCUIT AS circuit_id, Circuits_Phase3_NUMPHASES AS num_phases, NYHCPV_csv_NMAPCOLOR AS map_color
FROM u1_circuits_raw
UNION ALL BY NAME
SELECT 'utility_1' AS utility_id, 'installed_der' AS dataset, ProjectID AS project_id, ProjectType AS project_type,
       NamePlateRating AS nameplate_rating, ProjectCircuitID AS feeder_id, Hybrid AS is_hybrid
FROM u1_install_der_raw
UNION ALL BY NAME
SELECT 'utility_1' AS utility_id, 'planned_der' AS dataset, ProjectID AS project_id, ProjectType AS project_type,
       ProjectStatus AS project_status, NamePlateRating AS nameplate_rating, ProjectCircuitID AS feeder_id,
       InServiceDate AS in_service_date, CompletionDate AS completion_date, Hybrid AS is_hybrid
FROM u1_planned_der_raw
UNION ALL BY NAME
SELECT 'utility_2' AS utility_id, 'circuits' AS dataset, Master_CDF AS feeder_id, feeder_voltage AS voltage_kv,
       feeder_max_hc AS feeder_max_hc_mw, feeder_min_hc AS feeder_min_hc_mw,
       feeder_dg_connected_since_refresh AS dg_since_refresh, hca_refresh_date AS hca_date, color AS map_color
FROM u2_circuits_raw
UNION ALL BY NAME
SELECT 'utility_2' AS utility_id, 'installed_der' AS dataset, DER_ID AS der_id, DER_TYPE AS der_type,
       DER_NAMEPLATE_RATING AS nameplate_rating, DER_INTERCONNECTION_LOCATION AS feeder_id,
       SERVICE_STREET_ADDRESS AS service_address, INTERCONNECTION_COST AS interconnection_cost
FROM u2_install_der_raw
UNION ALL BY NAME
SELECT 'utility_2' AS utility_id, 'planned_der' AS dataset, DER_TYPE AS der_type, DER_NAMEPLATE_RATING AS nameplate_rating,
       DER_INTERCONNECTION_LOCATION AS feeder_id, INTERCONNECTION_QUEUE_REQUEST_ID AS request_id,
       INTERCONNECTION_QUEUE_POSITION AS queue_position, PLANNED_INSTALLATION_DATE AS planned_date,
       DER_STATUS AS status, DER_STATUS_RATIONALE AS status_rationale
FROM u2_planned_der_raw""", [f"u{u}_{d}_raw" for u in (1, 2) for d in ("circuits", "install_der", "planned_der")])
    if name == "der_for_requested_feeders":
        return o.query("SELECT * FROM v_der_by_feeder WHERE feeder_id IN (SELECT feeder_id FROM v_feeders_by_hc "
                       "WHERE utility_id = 'utility_1' AND max_hosting_capacity_mw >= 9000.0)", ["v_der_by_feeder", "v_feeders_by_hc"])
    if name == "type_map":
        return o.query(f"SELECT DER_ID, INTERCONNECTION_QUEUE_REQUEST_ID, trim(DER_TYPE) AS der_type_source, "
                       f"{map_sql('trim(DER_TYPE)', U2_TYPE_TO_CANONICAL)} AS der_type "
                       f"FROM (SELECT * FROM u2_install_der_raw UNION ALL BY NAME SELECT * FROM u2_planned_der_raw)",
                       ["u2_install_der_raw", "u2_planned_der_raw"])
    if name == "project_type_map":
        return o.query(f"SELECT ProjectID, ProjectType, "
                       f"{map_sql('ProjectType', U1_PROJECT_TYPE_TO_CANONICAL)} AS project_type_canonical "
                       f"FROM u1_der_raw", ["u1_der_raw"])
    if name == "unit_normalize":
        kw = "SELECT project_id, nameplate_rating_kw FROM "
        return o.query("SELECT project_id, nameplate_rating_kw AS nameplate_rating_w, "
                       f"nameplate_rating_kw / 1000.0 AS nameplate_rating_kw FROM ({kw} u1_install_der_clean "
                       f"UNION ALL {kw} u1_planned_der_clean)", ["u1_install_der_clean", "u1_planned_der_clean"])
    if name == "global_ids":
        ids = "SELECT project_id, feeder_id, _utility_id FROM "
        return o.query("SELECT project_id, feeder_id, "
                       "concat_ws('::', _utility_id, feeder_id) AS global_feeder_id_concat, "
                       "CASE WHEN feeder_id IS NOT NULL THEN concat_ws('::', _utility_id, feeder_id) END "
                       f"AS global_feeder_id_nullsafe FROM ({ids} u1_install_der_clean "
                       f"UNION ALL {ids} u1_planned_der_clean)", ["u1_install_der_clean", "u1_planned_der_clean"])
    if name == "refresh_tables":
        return refresh_tables_sql(o)
    if name == "expectation_quarantine":
        return expectation_quarantine_sql(o)
    if name == "refresh_failed_run":
        return refresh_failed_run_sql(o)
    if name == "contract_drift":
        return contract_drift_sql(o)
    if name == "bronze_compaction":
        return o.query("SELECT * FROM u1_circuits_raw", ["u1_circuits_raw"])
    if name == "freshness_ledger":
        return o.query("SELECT * FROM v_ingestion_metadata", ["v_ingestion_metadata"])
    if name == "bucketed_map_summary":
        return o.query("SELECT * FROM v_feeder_map_summary", ["v_feeder_map_summary"])
    if name == "zorder_lookup":
        return zorder_lookup_sql(o)
    if name == "expectation_metrics":
        return expectation_metrics_sql(o)
    if name == "contract_violations":
        return contract_violations_sql(o)
    if name in ("feeders_by_hc_lookup", "clustered_hc_lookup"):
        return o.query("SELECT * FROM v_feeders_by_hc WHERE max_hosting_capacity_mw >= 500.0",
                       ["v_feeders_by_hc"])
    if name == "feeders_by_hc_utility_lookup":
        return o.query("SELECT * FROM v_feeders_by_hc WHERE max_hosting_capacity_mw >= 0.0 "
                       "AND utility_id = 'utility_2'", ["v_feeders_by_hc"])
    if name in ("der_for_feeder_lookup", "clustered_der_lookup"):
        return o.query("SELECT * FROM v_der_by_feeder WHERE feeder_id = '24'", ["v_der_by_feeder"])
    if name == "stale_datasets":
        return o.query("SELECT * FROM v_ingestion_metadata WHERE is_stale", ["v_ingestion_metadata"])
    if name == "dq_alerts":
        return o.query("SELECT * FROM v_data_quality_report WHERE installed_null_feeder_pct > 5.0",
                       ["v_data_quality_report"])
    if name in ("csv_landing_read", "bronze_stream_ingest", "bronze_arrivals"):
        cols = [c for c in raw_columns("u1_der_raw")
                if c not in ("_source_file", "_ingestion_ts", "_utility_id", "_environment")]
        src = ("SELECT " + ", ".join(cols) + ", CASE WHEN _source_file >= "
               "'landing/utility_1/installed_der/der_1998.csv' THEN 'added' END AS Notes "
               "FROM u1_der_raw")
        o.add("q_landed", src, ["u1_der_raw"])
        return o.query(normalize_sql("q_landed", cols + ["Notes"], NULL_TOKENS_8), ["q_landed"])
    raise KeyError(name)
