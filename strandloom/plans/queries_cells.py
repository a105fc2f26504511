"""Queries over cells: event log, state, registry, merge, sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import expr as X
from strandloom.operators import events, identity, merge, registry, relational, sheets
from strandloom.plans.catalog import query

AS_OF = "2024-01-15T00:00:00Z"
LATEST = "row_number() OVER (PARTITION BY tsid, field ORDER BY append_seq DESC, event_seq DESC)"


def state_sql(where: str = "true", columns: str = "tsid, field, new_value AS value, dataset_id, ts AS updated_at, source, actor") -> str:
    return f"SELECT {columns} FROM (SELECT *, {LATEST} AS r FROM {{log}} WHERE {where}) WHERE r = 1 AND new_present"


STATE = state_sql(columns="tsid, field, new_value AS value, dataset_id")
OLD, NEW = state_sql(f"ts <= '{AS_OF}'", "tsid, field, new_value AS value, dataset_id"), STATE

query("state_as_of", lambda t: events.state_at(t.log, AS_OF), state_sql(f"ts <= '{AS_OF}'"))
query("state_current", lambda t: events.state_at(t.log), state_sql())
query("cell_history", lambda t: events.history(t.log, "T8", "error").select("append_seq", "event_seq", "ts", "new_value", "new_present"), "SELECT append_seq, event_seq, ts, new_value, new_present FROM {log} WHERE tsid = 'T8' AND field = 'error'")
query("event_log_ordered", lambda t: events.ordered_log(t.log.withColumn("file", F.format_string("%06d_x.csv", "append_seq")).drop("append_seq")).select("event_id", "append_seq", "event_seq"), "SELECT event_id, append_seq + 1 AS append_seq, event_seq FROM {log}")
query("diff_to_events", lambda t: events.diff_to_events(events.state_at(t.log, AS_OF), events.state_at(t.log)), f"""WITH b AS ({OLD}), a AS ({NEW})
  SELECT coalesce(b.tsid, a.tsid) AS tsid, coalesce(b.field, a.field) AS field, coalesce(a.dataset_id, b.dataset_id) AS dataset_id, b.value AS old_value, b.tsid IS NOT NULL AS old_present, a.value AS new_value, a.tsid IS NOT NULL AS new_present
  FROM b FULL JOIN a ON b.tsid = a.tsid AND b.field = a.field WHERE (b.tsid IS NULL) <> (a.tsid IS NULL) OR b.value IS DISTINCT FROM a.value""")
query("diff_apply_roundtrip", lambda t: events.apply_events(events.state_at(t.log, AS_OF), events.diff_to_events(events.state_at(t.log, AS_OF), events.state_at(t.log))), STATE)
query("validate_events", lambda t: events.event_violations(t.log.withColumn("source", F.when(F.col("event_id") % 50 == 0, "odd").otherwise(F.col("source"))).withColumn("tsid", F.when(F.col("event_id") % 70 != 0, F.col("tsid"))).withColumn("new_value", F.when(F.col("event_id") % 90 == 0, F.lit("x")).otherwise(F.col("new_value")))), """
  SELECT 'bad_source' AS rule, count(*) FILTER (event_id % 50 = 0) AS n_events FROM {log} UNION ALL SELECT 'blank_tsid', count(*) FILTER (event_id % 70 = 0) FROM {log} UNION ALL SELECT 'blank_field', 0 FROM {log} WHERE event_id = 0
  UNION ALL SELECT 'present_without_value', 0 FROM {log} WHERE event_id = 0 UNION ALL SELECT 'value_without_presence', count(*) FILTER (event_id % 90 = 0) FROM {log}""")
query("state_hash", lambda t: events.state_fingerprint(events.state_at(t.log)), f"SELECT {X.sql_row_fingerprint('tsid', 'field', 'value', 'dataset_id')} AS state_hash FROM ({STATE})")
query("retire", lambda t: events.retire(events.state_at(t.log), t.rows("select tsid from {log} where event_id % 400 = 1"), "closed"), f"""SELECT tsid, field, dataset_id, value AS old_value, true AS old_present, CAST(NULL AS VARCHAR) AS new_value, false AS new_present, 'curator' AS source, 'closed' AS reason
  FROM ({STATE}) WHERE tsid IN (SELECT tsid FROM {{log}} WHERE event_id % 400 = 1)""")
query("event_append", lambda t: events.stamp_batch(events.diff_to_events(events.state_at(t.log, AS_OF), events.state_at(t.log)).withColumns({"run_id": F.lit(None).cast("string"), "ts": F.lit(None).cast("string"), "event_seq": F.lit(None).cast("long")}), "run7", "2024-02-01T00:00:00Z").select("run_id", "ts", "event_seq", "tsid", "field", "new_value"), f"""WITH b AS ({OLD}), a AS ({NEW}),
  d AS (SELECT coalesce(b.tsid, a.tsid) AS tsid, coalesce(b.field, a.field) AS field, a.value AS new_value FROM b FULL JOIN a ON b.tsid = a.tsid AND b.field = a.field WHERE (b.tsid IS NULL) <> (a.tsid IS NULL) OR b.value IS DISTINCT FROM a.value)
  SELECT 'run7' AS run_id, '2024-02-01T00:00:00Z' AS ts, row_number() OVER (ORDER BY substr(md5(tsid), 1, 2), tsid, field, new_value NULLS FIRST) AS event_seq, tsid, field, new_value FROM d""")
BATCH = "select cast(null as string) as run_id, cast(null as string) as ts, cast(null as bigint) as event_seq, event_id + 1 as position, 'P' || cast(user_id % 40 as string) as tsid, 'f' || cast(event_id % 3 as string) as field, case when event_id % 4 <> 0 then cast(event_id as string) end as new_value, event_id % 4 <> 0 as new_present, 1 as append_seq, 'D' as dataset_id, 'sheet' as source, 'a' as actor from {events}"
query("event_append_ties", lambda t: events.state_at(events.stamp_batch(t.rows(BATCH), "run7", "2024-02-01T00:00:00Z")).select("tsid", "field", "value"), f"SELECT tsid, field, arg_max(CASE WHEN new_present THEN new_value ELSE '' END, position) AS value FROM ({BATCH}) GROUP BY 1, 2 HAVING value <> ''")
query("seed_baseline", lambda t: events.diff_to_events(t.base.limit(0), t.base), "SELECT tsid, field, dataset_id, CAST(NULL AS VARCHAR) AS old_value, false AS old_present, value AS new_value, true AS new_present FROM {base}")

# -- registry ---------------------------------------------------------------------------------------------------------
FIRST_RULE = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qc_name ORDER BY group_order, role) AS r FROM {registry}) WHERE r = 1)"
query("field_rule", lambda t: registry.field_rule(t.field_names, t.registry), f"SELECT f.field, r.role, r.ownership, coalesce(r.nullable, false) AS nullable, r.role IS NOT NULL AS known FROM {{field_names}} f LEFT JOIN {FIRST_RULE} r ON f.field = r.qc_name")
query("canonical_field", lambda t: registry.canonical_field(t.field_names, t.registry), f"SELECT f.field, coalesce(nullif(r.canonical, ''), f.field) AS canonical FROM {{field_names}} f LEFT JOIN {FIRST_RULE} r ON f.field = r.qc_name")
query("display_field", lambda t: registry.display_field(t.field_names, t.registry), "SELECT f.field, coalesce((SELECT qc_name FROM {registry} r WHERE r.canonical = f.field ORDER BY n_filled DESC, qc_name LIMIT 1), f.field) AS display FROM {field_names} f")
query("registry_violations", lambda t: registry.violations(t.registry), f"""SELECT 'duplicate_name' AS rule, qc_name FROM {{registry}} GROUP BY qc_name HAVING count(*) > 1
  UNION ALL SELECT 'orphan_synonym', qc_name FROM {{registry}} WHERE role = 'synonym' AND canonical NOT IN (SELECT qc_name FROM {{registry}})
  UNION ALL SELECT 'bad_role', qc_name FROM {{registry}} WHERE role NOT IN {registry.ROLES} UNION ALL SELECT 'bad_ownership', qc_name FROM {{registry}} WHERE ownership NOT IN {registry.OWNERS}
  UNION ALL SELECT 'nullable_not_curator', qc_name FROM {{registry}} WHERE nullable AND ownership <> 'curator' UNION ALL SELECT 'csm_without_key', qc_name FROM {{registry}} WHERE role = 'csm' AND NOT regexp_matches(csm_flat_key, '^[A-Za-z0-9]+_csm_.+$')""")
query("column_order", lambda t: registry.column_order(t.field_names, t.registry), f"SELECT f.field, r.group_order, row_number() OVER (ORDER BY r.group_order NULLS LAST, f.field) AS place FROM {{field_names}} f LEFT JOIN {FIRST_RULE} r ON f.field = r.qc_name")
query("build_registry", lambda t: registry.build(t.rows("select * from (values ('c_name', 'curator'), ('c_acctbal', 'machine'), ('c_comment', 'none')) as o(qc_name, ownership)"), t.rows("select field as qc_name, count(value) as n_filled from {base} group by field union all select 'geo_x', 0 union all select 'TSid', 9 union all select 'inLac', 4 union all select 'climateInterpretation1_x', 5")), """
  WITH u AS (SELECT field AS qc_name, count(value) AS n_filled FROM {base} GROUP BY field UNION ALL SELECT 'geo_x', 0 UNION ALL SELECT 'TSid', 9 UNION ALL SELECT 'inLac', 4 UNION ALL SELECT 'climateInterpretation1_x', 5),
  o AS (SELECT * FROM (VALUES ('c_name', 'curator'), ('c_acctbal', 'machine'), ('c_comment', 'none')) o(qc_name, ownership))
  SELECT u.qc_name, CASE WHEN u.qc_name = 'TSid' THEN 'key' WHEN u.qc_name LIKE 'in%' THEN 'membership' WHEN ownership = 'none' OR n_filled = 0 THEN 'unused' WHEN ownership IS NULL THEN 'control' ELSE 'merged' END AS role, ownership,
  CASE WHEN u.qc_name ILIKE '%interpretation%' THEN 'interpretation' WHEN u.qc_name LIKE 'geo\\_%' ESCAPE '\\' THEN 'geo' ELSE 'root' END AS "group", n_filled FROM u LEFT JOIN o ON u.qc_name = o.qc_name""")

# -- merge ------------------------------------------------------------------------------------------------------------
EQ = X.sql_values_equal
NOT_KEY = "coalesce(role <> 'key', true)"
PLAN = f"""WITH j AS (SELECT coalesce(b.tsid, s.tsid, f.tsid) AS tsid, coalesce(b.field, s.field, f.field) AS field, f.dataset_id, b.value AS base, s.value AS sheet, f.value AS file, s.tsid IS NOT NULL AS in_sheet
  FROM {{base}} b FULL JOIN {{sheet}} s ON b.tsid = s.tsid AND b.field = s.field FULL JOIN {{file_cells}} f ON coalesce(b.tsid, s.tsid) = f.tsid AND coalesce(b.field, s.field) = f.field),
  g AS (SELECT j.*, r.role, r.ownership, r.role IS NOT NULL AS known, coalesce(r.nullable, false) AS nullable FROM j LEFT JOIN {{registry}} r ON j.field = r.qc_name WHERE r.role IS NULL OR r.role IN ('merged', 'membership', 'key')),
  c AS (SELECT *, coalesce(sheet = '<<CLEAR>>', false) OR (in_sheet AND coalesce(sheet, '') = '' AND nullable AND coalesce(base, '') <> '') AS cleared FROM g),
  e AS (SELECT *, CASE WHEN cleared THEN NULL WHEN coalesce(sheet, '') = '' THEN base ELSE sheet END AS s_eff, CASE WHEN coalesce(file, '') = '' THEN base ELSE file END AS f_eff FROM c),
  h AS (SELECT *, NOT {EQ('s_eff', 'base', NOT_KEY)} AND coalesce(ownership <> 'machine', true) AS s_ch, NOT {EQ('f_eff', 'base', NOT_KEY)} AS f_ch FROM e),
  p AS (SELECT *, CASE WHEN NOT s_ch AND NOT f_ch THEN 'unchanged' WHEN s_ch AND NOT f_ch THEN 'sheet' WHEN NOT s_ch AND f_ch THEN 'file' WHEN {EQ('s_eff', 'f_eff', NOT_KEY)} THEN 'converged' WHEN role = 'key' THEN 'error' WHEN ownership = 'curator' THEN 'sheet' WHEN ownership = 'machine' THEN 'file' ELSE 'conflict' END AS resolution FROM h),
  plan AS (SELECT tsid, field, dataset_id, base, sheet, file, known, cleared, resolution, CASE WHEN resolution IN ('sheet', 'converged') THEN s_eff WHEN resolution = 'file' THEN f_eff ELSE base END AS value FROM p)"""


def plan_of(t):
    return merge.merge_three_way(t.base, t.sheet, t.file_cells, t.registry)


query("merge_three_way", plan_of, f"{PLAN} SELECT * FROM plan")
query("plan_state", lambda t: merge.plan_state(plan_of(t)), f"{PLAN} SELECT tsid, field, value, dataset_id FROM plan WHERE coalesce(value, '') <> ''")
query("plan_summary", lambda t: merge.plan_summary(plan_of(t)), f"{PLAN} SELECT count(*) AS n_cells, count(*) FILTER (resolution IN ('sheet', 'file', 'converged')) AS n_changed, count(*) FILTER (resolution = 'conflict') AS n_conflicts, count(*) FILTER (resolution = 'error') AS n_errors, count(*) FILTER (cleared) AS n_cleared, count(DISTINCT CASE WHEN NOT known THEN field END) AS n_unknown_fields FROM plan")
query("conflicts_by_field", lambda t: merge.conflicts_by_field(plan_of(t)), f"{PLAN} SELECT field, count(*) AS n FROM plan WHERE resolution = 'conflict' GROUP BY field")
query("write_set", lambda t: merge.write_set(plan_of(t), "c_mktsegment"), f"{PLAN} SELECT tsid, field, value, dataset_id FROM plan WHERE resolution = 'sheet' AND field <> 'c_mktsegment'")


def merged_again(t):
    state = merge.plan_state(plan_of(t)).withColumn("dataset_id", F.coalesce("dataset_id", F.lit("D0")))
    return merge.merge_with_itself(state, t.registry).groupBy("resolution").agg(F.count("*").alias("n"))


query("merge_idempotent", merged_again, f"{PLAN} SELECT 'unchanged' AS resolution, count(*) AS n FROM plan WHERE coalesce(value, '') <> ''")
query("values_equal", lambda t: t.base.select("tsid", "field", F.col("value").alias("a")).join(t.sheet.select("tsid", "field", F.col("value").alias("b")), ["tsid", "field"], "left").select("tsid", "field", X.values_equal("a", "b").alias("equal")), f"SELECT x.tsid, x.field, {EQ('x.value', 'y.value')} AS equal FROM {{base}} x LEFT JOIN {{sheet}} y ON x.tsid = y.tsid AND x.field = y.field")
query("validate_values", lambda t: merge.validate_values(t.file_cells, t.registry, {"c_nationkey": (1.0, 20.0)}), """SELECT CASE WHEN r.type = 'number' AND n IS NULL THEN 'not_a_number' ELSE 'out_of_range' END AS "check", 'error' AS severity, tsid, field, value
  FROM (SELECT *, CASE WHEN regexp_matches(value, '^[+-]?[0-9.]+$') THEN TRY_CAST(value AS DOUBLE) END AS n FROM {file_cells}) c JOIN {registry} r ON c.field = r.qc_name WHERE value <> '' AND ((r.type = 'number' AND n IS NULL) OR (field = 'c_nationkey' AND NOT n BETWEEN 1 AND 20))""")
query("drop_cells", lambda t: merge.drop_cells(t.base, t.sheet.where("value = ''")).select("tsid", "field", "value"), "SELECT tsid, field, value FROM {base} b WHERE NOT EXISTS (SELECT 1 FROM {sheet} s WHERE s.value = '' AND s.tsid = b.tsid AND s.field = b.field)")
query("inconsistent_fields", lambda t: merge.inconsistent_fields(t.base, t.registry), """SELECT b.dataset_id, b.field, b.tsid, b.value, d.n AS n_values FROM {base} b JOIN (SELECT dataset_id, field, count(DISTINCT value) AS n FROM {base} WHERE field IN (SELECT qc_name FROM {registry} WHERE cardinality = 'dataset') GROUP BY 1, 2 HAVING count(DISTINCT value) > 1) d ON b.dataset_id = d.dataset_id AND b.field = d.field""")
query("collateral", lambda t: merge.collateral(t.file_cells, t.sheet.where("k % 3 = 0 and dataset_id <> 'D5'")), "SELECT DISTINCT dataset_id FROM {file_cells} WHERE dataset_id NOT IN (SELECT dataset_id FROM {sheet} WHERE k % 3 = 0 AND dataset_id <> 'D5')")
query("filter_cells", lambda t: relational.keep_true(t.sheet, F.when(F.col("value") != "", F.length("value") > 10)).select("tsid", "field"), "SELECT tsid, field FROM {sheet} WHERE value <> '' AND length(value) > 10")
query("case_priority", lambda t: t.base.select("tsid", "field", F.when(F.col("k") % 2 == 0, "even").when(F.col("k") % 3 == 0, "third").when(F.nullif(F.col("k") % 5, F.lit(0)) > 2, "high").otherwise("rest").alias("class")), """SELECT tsid, field, CASE WHEN k % 2 = 0 THEN 'even' WHEN k % 3 = 0 THEN 'third' WHEN nullif(k % 5, 0) > 2 THEN 'high' ELSE 'rest' END AS "class" FROM {base}""")

# -- sheets -----------------------------------------------------------------------------------------------------------
FIELDS = ["c_name", "c_mktsegment", "c_acctbal", "c_nationkey", "c_comment"]
WIDE = ", ".join(f"max(CASE WHEN field = '{f}' THEN value END) AS {f}" for f in FIELDS)


def wide_sheet(t):
    return sheets.to_sheet(t.sheet, FIELDS, {"c_comment": "site"})


query("cells_to_sheet", lambda t: sheets.to_sheet(t.sheet, FIELDS), f'SELECT tsid AS "TSid", min(dataset_id) AS "datasetId", {WIDE} FROM {{sheet}} GROUP BY tsid')
query("sheet_pull", lambda t: sheets.pull(wide_sheet(t), t.registry), """SELECT tsid, coalesce(r.canonical, s.f) AS field, nullif(value, '') AS value, coalesce(value, '') <> '' AS present, dataset_id
  FROM (SELECT *, CASE WHEN field = 'c_comment' THEN 'site' ELSE field END AS f FROM {sheet}) s LEFT JOIN (SELECT DISTINCT qc_name, canonical, nullable FROM {registry} WHERE qc_name <> 'odd') r ON s.f = r.qc_name WHERE coalesce(value, '') <> '' OR coalesce(nullable, false)""")
query("sheet_push_block", lambda t: sheets.push_block(t.file_cells.where("value <> ''"), sheets.to_sheet(t.sheet, FIELDS[:3]).drop("datasetId")), """SELECT s.tsid AS "TSid", """ + ", ".join(f"coalesce(max(CASE WHEN f.field = '{x}' THEN f.value END), max(CASE WHEN s.field = '{x}' THEN s.value END)) AS {x}" for x in FIELDS[:3]) + """
  FROM {sheet} s LEFT JOIN {file_cells} f ON s.tsid = f.tsid AND s.field = f.field AND f.value <> '' GROUP BY s.tsid""")
query("patch_cells", lambda t: sheets.patch(t.file_cells, t.sheet), f"SELECT f.tsid, f.field, s.value AS old_value, f.value FROM {{file_cells}} f LEFT JOIN {{sheet}} s ON f.tsid = s.tsid AND f.field = s.field WHERE NOT {EQ('f.value', 's.value')}")
query("dedupe_columns", lambda t: sheets.first_columns(t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("c_name"), F.lit(1).alias(" "))), "SELECT c_custkey, c_name FROM customer")
query("compilation_sheet", lambda t: sheets.compilation_sheet(t.clean_series.select("tsid", "dataset_id", F.lit("variable").alias("field"), F.col("variable").alias("value")), t.clean_series, ["variable"], "cR"), """SELECT tsid AS "TSid", dataset_id AS "datasetId", variable, CASE WHEN list_contains(compilations, 'cR') THEN 'TRUE' ELSE 'FALSE' END AS "incR" FROM {clean_series}""")
query("rle_groups", lambda t: sheets.runs(t.lines, "l_orderkey", "n", "l_returnflag").select("l_orderkey", "l_returnflag", "first", "last", F.col("n")), """SELECT l_orderkey, l_returnflag, min(n) AS "first", max(n) AS "last", count(*) AS n FROM (SELECT *, n - row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY n) AS g FROM {lines}) GROUP BY l_orderkey, l_returnflag, g""")
query("col_letter", lambda t: t.part.select("p_partkey", X.column_letters(F.col("p_partkey") + 1).alias("letters")), "SELECT p_partkey, CASE WHEN p_partkey < 26 THEN chr(CAST(65 + p_partkey AS INTEGER)) WHEN p_partkey < 702 THEN chr(CAST(64 + p_partkey // 26 AS INTEGER)) || chr(CAST(65 + p_partkey % 26 AS INTEGER)) ELSE chr(CAST(65 + (p_partkey - 702) // 676 AS INTEGER)) || chr(CAST(65 + (p_partkey - 702) // 26 % 26 AS INTEGER)) || chr(CAST(65 + (p_partkey - 702) % 26 AS INTEGER)) END AS letters FROM part")
query("col_index", lambda t: t.part.select("p_partkey", X.column_number(X.column_letters(F.col("p_partkey") + 1)).alias("n")), "SELECT p_partkey, p_partkey + 1 AS n FROM part")
query("sheet_title", lambda t: t.ledger.select("ledger_seq", X.sheet_title(F.when(F.col("ledger_seq") % 3 == 0, F.concat(F.col("compilation"), F.lit(" QC v1_2_3"))).when(F.col("ledger_seq") % 3 == 1, F.lit("My sheet")), F.col("version"), F.col("compilation")).alias("title")), "SELECT ledger_seq, CASE WHEN ledger_seq % 3 = 1 THEN 'My sheet' ELSE compilation || ' QC' END || ' v' || version AS title FROM {ledger}")
query("sheet_read", lambda t: t.sheet.select("tsid", "field", F.when(F.col("value") != "", F.col("value")).alias("value")), "SELECT tsid, field, nullif(value, '') AS value FROM {sheet}")
query("issue_counts", lambda t: identity.issue_counts(merge.validate_values(t.file_cells, t.registry, {"c_nationkey": (1.0, 20.0)})), """SELECT count(*) AS n_error, 0 AS n_warn, 0 AS n_info FROM {file_cells} c JOIN {registry} r ON c.field = r.qc_name WHERE value <> '' AND r.type = 'number' AND (NOT regexp_matches(value, '^[+-]?[0-9.]+$') OR (field = 'c_nationkey' AND NOT TRY_CAST(value AS DOUBLE) BETWEEN 1 AND 20))""")
