"""Queries over documents, versions and duplicates, and the relational building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import expr as X
from strandloom.operators import dedupe, documents, relational, versions
from strandloom.plans.catalog import query
from strandloom.sources import archives


def nested(t):
    """The series as one nested document for each dataset."""
    column = F.struct("tsid", "variable", F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("units"), "compilations")
    listed = t.series.groupBy("dataset_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", column.alias("c")))), lambda x: x["c"]).alias("columns"))
    return listed.select("dataset_id", F.concat(F.lit("N"), F.col("dataset_id")).alias("name"), F.array(F.struct(F.lit("paleo").alias("kind"), F.array(F.struct(F.lit("m1").alias("name"), F.filter("columns", lambda c: c["variable"] != "RF").alias("columns")), F.struct(F.lit("m2").alias("name"), F.filter("columns", lambda c: c["variable"] == "RF").alias("columns"))).alias("tables"))).alias("blocks"))


WALK = """WITH w AS (SELECT dataset_id, 'N' || dataset_id AS name, 'paleo' AS kind, 1 AS block_pos, CASE WHEN variable = 'RF' THEN 2 ELSE 1 END AS table_pos, row_number() OVER (PARTITION BY dataset_id, variable = 'RF' ORDER BY n) AS column_pos, tsid, variable, 'u' || l_suppkey AS units, compilations FROM {series})"""

# -- documents --------------------------------------------------------------------------------------------------------
query("walk_columns", lambda t: documents.walk_columns(nested(t)).drop("compilations"), f"{WALK} SELECT dataset_id, name, kind, block_pos, table_pos, column_pos, tsid, variable, units FROM w WHERE tsid <> ''")
query("column_compilations", lambda t: documents.column_compilations(t.clean_series), "SELECT tsid, array_to_string(list_sort(list_distinct(list_filter(compilations, lambda x: x IS NOT NULL))), ',') AS compilations FROM {clean_series}")
query("frame_cells", lambda t: documents.frame_cells(nested(t), t.rows("select * from (values ('paleoData_variableName'), ('dataSetName'), ('paleoData_units')) as r(qc_name)")), f"""{WALK}, o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tsid ORDER BY block_pos, table_pos, column_pos, dataset_id) AS r FROM w WHERE tsid <> '') WHERE r = 1)
  SELECT tsid, 'dataSetName' AS field, name AS value, dataset_id FROM o UNION ALL SELECT tsid, 'paleoData_variableName', variable, dataset_id FROM o UNION ALL SELECT tsid, 'paleoData_units', units, dataset_id FROM o""")
query("membership_frame", lambda t: documents.membership_frame(t.clean_series, "cR"), "SELECT tsid, 'incR' AS field, CASE WHEN list_contains(compilations, 'cR') THEN 'TRUE' ELSE 'FALSE' END AS value, dataset_id FROM {clean_series}")
TAB = "select name, case when o_orderkey % 7 = 0 then ' False' when o_orderkey % 5 = 0 then 'TRUE' end as include from {datasets} where o_orderkey % 3 = 0 union all select 'N-none' || cast(o_orderkey as string), 'TRUE' from {datasets} where o_orderkey % 400 = 0"
query("considered_datasets", lambda t: documents.considered_datasets(t.rows(TAB), t.datasets), f"SELECT name, CASE WHEN lower(trim(coalesce(include, ''))) = 'false' THEN 'excluded' WHEN name NOT IN (SELECT name FROM {{datasets}}) THEN 'missing' ELSE 'considered' END AS state FROM ({TAB})")
WISH = "select tsid, case when l_suppkey % 5 = 0 then 'TRUE' when l_suppkey % 5 = 1 then 'FALSE' when l_suppkey % 5 = 2 then '' end as value from {clean_series}"
DELTA = f"SELECT tsid, CASE WHEN value = 'TRUE' AND NOT m THEN 'add' WHEN value = 'FALSE' AND m THEN 'drop' END AS change FROM (SELECT w.tsid, w.value, list_contains(s.compilations, 'cR') AS m FROM ({WISH}) w JOIN {{clean_series}} s ON w.tsid = s.tsid) WHERE CASE WHEN value = 'TRUE' AND NOT m THEN 'add' WHEN value = 'FALSE' AND m THEN 'drop' END IS NOT NULL"


def delta(t):
    return documents.membership_delta(t.rows(WISH), documents.members_of(t.clean_series, "cR"))


query("membership_delta", delta, DELTA)
query("membership_apply", lambda t: documents.apply_membership(t.clean_series, delta(t), "cR").select("tsid", F.array_join("compilations", ",").alias("compilations")), f"""SELECT s.tsid, CASE WHEN len(l) > 0 THEN array_to_string(list_filter(l, lambda x: x IS NOT NULL), ',') END AS compilations FROM (SELECT s.tsid, CASE WHEN change = 'add' THEN list_append(compilations, 'cR') WHEN change = 'drop' THEN list_filter(compilations, lambda x: x <> 'cR') ELSE compilations END AS l FROM {{clean_series}} s LEFT JOIN ({DELTA}) d ON s.tsid = d.tsid) s""")
query("create_compilation", lambda t: documents.create_compilation(t.clean_series, t.rows("select tsid from {clean_series} where l_suppkey % 9 = 0 union all select 'no-' || tsid from {clean_series} where l_suppkey % 50 = 0"), "cR"), "SELECT tsid, CASE WHEN list_contains(compilations, 'cR') THEN 'already' ELSE 'added' END AS outcome FROM {clean_series} WHERE l_suppkey % 9 = 0 UNION ALL SELECT 'no-' || tsid, 'unknown' FROM {clean_series} WHERE l_suppkey % 50 = 0")
PATH = "target, \"index\", scope, name, level"
ROUTE = """(SELECT *, CASE field WHEN 'geo_latitude' THEN 'geo' WHEN 'pub2_title' THEN 'pub' WHEN 'paleoData_units' THEN 'column' WHEN 'chronData_units' THEN 'column' WHEN 'climateInterpretation2_variable' THEN 'interpretation' WHEN 'interpretation1_scope' THEN 'interpretation' WHEN 'calibration_method' THEN 'calibration' ELSE 'root' END AS target,
  CASE field WHEN 'pub2_title' THEN 2 WHEN 'climateInterpretation2_variable' THEN 2 WHEN 'interpretation1_scope' THEN 1 END AS "index", CASE field WHEN 'climateInterpretation2_variable' THEN 'climate' END AS scope, CASE field WHEN 'archiveType' THEN field WHEN 'geo_latitude' THEN 'latitude' WHEN 'pub2_title' THEN 'title' WHEN 'climateInterpretation2_variable' THEN 'variable' WHEN 'interpretation1_scope' THEN 'scope' WHEN 'calibration_method' THEN 'method' ELSE 'units' END AS name,
  CASE WHEN field IN ('geo_latitude', 'pub2_title', 'archiveType') THEN 'dataset' ELSE 'column' END AS level FROM {field_cells})"""
query("apply_route", lambda t: documents.route_cells(t.field_cells), f"SELECT dataset_id, tsid, field, value, {PATH} FROM {ROUTE}")
query("field_path", lambda t: documents.route_cells(t.field_cells).select("field", "target", "index", "scope", "name", "level").distinct(), f"SELECT DISTINCT field, {PATH} FROM {ROUTE}")
query("dataset_field_disagrees", lambda t: documents.dataset_field_disagrees(t.field_cells), f"SELECT dataset_id, field, count(DISTINCT value) AS n_values, count(*) AS n_cells FROM {ROUTE} WHERE level = 'dataset' GROUP BY 1, 2 HAVING count(DISTINCT value) > 1")
query("coerce_value", lambda t: t.field_cells.select("tsid", X.coerce_kind("value").alias("kind")), f"SELECT tsid, CASE WHEN value IS NULL THEN 'remove' WHEN value IN ('TRUE', 'FALSE') THEN 'logical' WHEN regexp_matches(value, '{X.NUMBER}') THEN 'number' ELSE 'text' END AS kind FROM {{field_cells}}")
query("scope_ordinals", lambda t: documents.scope_ordinals(t.entries), 'SELECT tsid, pos, scope, row_number() OVER (PARTITION BY tsid, scope ORDER BY pos) AS "index" FROM {entries}')
query("interp_slot", lambda t: documents.interpretation_slot(t.entries, t.entries.select("tsid", "scope").distinct().withColumn("index", F.lit(2).cast("long"))), 'SELECT w.tsid, w.scope, 2 AS "index", e.pos FROM (SELECT DISTINCT tsid, scope FROM {entries}) w LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY tsid, scope ORDER BY pos) AS i FROM {entries}) e ON e.tsid = w.tsid AND e.scope = w.scope AND e.i = 2')
LEAVES = "(SELECT coalesce(o.dataset, n.dataset) AS dataset, coalesce(o.tsid, n.tsid) AS tsid, coalesce(o.path, n.path) AS path, o.value AS old_value, n.value AS new_value, CASE WHEN o.value IS NULL THEN 'only_new' WHEN n.value IS NULL THEN 'only_old' ELSE 'differs' END AS kind FROM {leaves_old} o FULL JOIN {leaves_new} n ON o.dataset IS NOT DISTINCT FROM n.dataset AND o.tsid IS NOT DISTINCT FROM n.tsid AND o.path = n.path WHERE o.value IS DISTINCT FROM n.value)"
query("shadow_diff", lambda t: documents.leaf_diff(t.leaves_old, t.leaves_new), f"SELECT * FROM {LEAVES}")
query("shadow_summary", lambda t: documents.leaf_summary(documents.leaf_diff(t.leaves_old.withColumn("path", F.col("dataset")), t.leaves_new.withColumn("path", F.col("dataset")), ("tsid", "path")).where("tsid is not null")), """SELECT kind, path, count(*) AS n FROM (SELECT coalesce(o.dataset, n.dataset) AS path, CASE WHEN o.value IS NULL THEN 'only_new' WHEN n.value IS NULL THEN 'only_old' ELSE 'differs' END AS kind FROM (SELECT * FROM {leaves_old} WHERE tsid IS NOT NULL) o FULL JOIN (SELECT * FROM {leaves_new} WHERE tsid IS NOT NULL) n ON o.tsid = n.tsid AND o.dataset = n.dataset WHERE o.value IS DISTINCT FROM n.value) GROUP BY 1, 2 ORDER BY n DESC, kind, path LIMIT 15""")
query("ignore_paths", lambda t: documents.ignore_paths(t.leaves_old, ["^p[.]1[0-9]*$", "7$"]), "SELECT * FROM {leaves_old} WHERE NOT regexp_matches(path, '^p[.]1[0-9]*$') AND NOT regexp_matches(path, '7$')")
CHANGES = f"""(SELECT coalesce(o.path, n.path) AS path, coalesce(n.field, o.field) AS field, o.value AS old_value, n.value AS new_value, CASE WHEN o.value IS NULL THEN 'added' WHEN n.value IS NULL THEN 'removed' ELSE 'changed' END AS change, coalesce(o.dataset_id, n.dataset_id) AS dataset_id
  FROM {{doc_old}} o FULL JOIN {{doc_new}} n ON o.path = n.path WHERE coalesce(n.field, o.field) NOT IN {documents.VOLATILE} AND NOT {X.sql_values_equal('o.value', 'n.value')})"""


def changes(t):
    where = t.doc_old.select("path", "dataset_id").union(t.doc_new.select("path", "dataset_id")).distinct()
    return documents.changelog_diff(t.doc_old, t.doc_new).join(where, "path")


query("changelog_diff", lambda t: documents.changelog_diff(t.doc_old, t.doc_new), f"SELECT path, field, old_value, new_value, change FROM {CHANGES}")
query("changelog_entry", lambda t: documents.changelog_entry(changes(t)), f"SELECT dataset_id, string_agg(CASE change WHEN 'added' THEN field || ' added: ' || new_value WHEN 'removed' THEN field || ' removed: ' || old_value ELSE field || ': ' || old_value || ' -> ' || new_value END, '; ' ORDER BY path) AS entry, count(*) AS n_changes FROM {CHANGES} GROUP BY dataset_id")
query("changelog_cells", lambda t: t.series.where("tsid is not null").select("dataset_id", "tsid", "n", F.col("variable"), F.format_string("%.2f", "l_quantity").alias("quantity")).unpivot(["dataset_id", "tsid", "n"], ["variable", "quantity"], "field", "value").select(F.concat_ws(".", "dataset_id", "tsid", F.col("n").cast("string"), "field").alias("path"), "tsid", "field", "value"), "SELECT dataset_id || '.' || tsid || '.' || n || '.' || field AS path, tsid, field, value FROM (SELECT dataset_id, tsid, n, 'variable' AS field, variable AS value FROM {series} WHERE tsid IS NOT NULL UNION ALL SELECT dataset_id, tsid, n, 'quantity', CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) FROM {series} WHERE tsid IS NOT NULL)")
PRIVATE = "select 'T' || cast(l_orderkey as string) as tsid, case when l_suppkey % 3 <> 0 then 'c' || cast(l_suppkey % 3 as string) end as compilation, l_returnflag as key, l_linestatus as value from {lineitem}"
MEMBER = "select distinct 'T' || cast(l_orderkey as string) as tsid, 'c' || cast(l_partkey % 4 as string) as compilation from {lineitem}"
query("csm_migrate", lambda t: documents.move_private_keys(t.rows(PRIVATE), t.rows(MEMBER)), f"""WITH k AS ({PRIVATE}), m AS ({MEMBER}), p AS (SELECT * FROM k WHERE compilation IS NOT NULL UNION ALL SELECT k.tsid, m.compilation, k.key, k.value FROM k JOIN m ON k.tsid = m.tsid WHERE k.compilation IS NULL)
  SELECT p.tsid, p.compilation, p.key, string_agg(DISTINCT p.value, '; ' ORDER BY p.value) AS value, CASE WHEN bool_or(m.tsid IS NOT NULL) THEN 'moved' ELSE 'orphan' END AS outcome FROM p LEFT JOIN m ON p.tsid = m.tsid AND p.compilation = m.compilation GROUP BY 1, 2, 3""")
ROOT = "select 'D' || cast(p_size as string) as dataset_id, p_type as key, case when p_partkey % 11 = 0 then '' when p_partkey % 4 = 0 then upper(p_name) || '.' else p_name end as value from {part}"
COLS = "select 'D' || cast(p_size as string) as dataset_id, p_type as key, p_name as value from {part} where p_partkey % 3 <> 0"
PLAIN = "lower(regexp_replace({}, '[^A-Za-z0-9]', '', 'g'))"
query("root_key_disposition", lambda t: documents.root_key_disposition(t.rows(ROOT), t.rows(COLS)), f"WITH r AS ({ROOT}), c AS ({COLS}) SELECT dataset_id, key, value, CASE WHEN value = '' THEN 'empty' WHEN EXISTS (SELECT 1 FROM c WHERE c.dataset_id = r.dataset_id AND c.key = r.key AND c.value = r.value) THEN 'duplicate' WHEN EXISTS (SELECT 1 FROM c WHERE c.dataset_id = r.dataset_id AND c.key = r.key AND {PLAIN.format('c.value')} = {PLAIN.format('r.value')}) THEN 'restatement' ELSE 'unmatched' END AS disposition FROM r")
query("wrap_scalar", lambda t: t.supplier.select("s_suppkey", F.to_json(F.array(F.struct(F.col("s_name").alias("name")))).alias("authors")), """SELECT s_suppkey, '[{"name":"' || s_name || '"}]' AS authors FROM supplier""")
PAIRS = "select event_id as document, event_type as scope, case when user_id % 3 = 0 then 'pub' || cast(user_id % 4 as string) || '_title' else 'k' end as key, props as value from {events}"
query("key_inventory", lambda t: documents.key_inventory(t.rows(PAIRS)), f"SELECT CASE WHEN key = 'k' THEN key ELSE 'pub_title' END AS key, scope, count(*) AS n, count(DISTINCT document) AS n_documents, arg_min(value, document) AS example FROM ({PAIRS}) GROUP BY 1, 2")
query("short_example", lambda t: t.benchmark.select("item_id", X.short_example("text").alias("example")), "SELECT item_id, CASE WHEN length(text) > 60 THEN substr(text, 1, 57) || '...' ELSE text END AS example FROM benchmark")
query("value_count", lambda t: t.base.groupBy("dataset_id").agg(F.count(X.number("value")).alias("n_values")), "SELECT dataset_id, count(CASE WHEN regexp_matches(value, '^[+-]?[0-9.]+$') THEN 1 END) AS n_values FROM {base} GROUP BY dataset_id")
query("geo_extract", lambda t: t.sites.select("id", F.to_json(F.struct(F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry"), F.when(F.col("kind") == "n1", F.col("lat") + 0).alias("latitude"))).alias("j")).select("id", F.round(F.coalesce(F.get_json_object("j", "$.latitude"), F.get_json_object("j", "$.geometry.coordinates[1]")).cast("double"), 6).alias("lat"), F.round(F.get_json_object("j", "$.geometry.coordinates[0]").cast("double"), 6).alias("lon")), "SELECT id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM {sites}")
GEO = "select id, cast(cast(lat as decimal(18,2)) as string) as sheet_lat, cast(cast(case when id like '%7' then lat + 1 else lat end as decimal(18,4)) as string) as file_lat from {sites}"
query("geo_drift", lambda t: t.rows(GEO).where(~X.values_equal("sheet_lat", "file_lat")).select("id", "sheet_lat", "file_lat", X.decimals("sheet_lat").cast("long").alias("d_sheet"), X.decimals("file_lat").cast("long").alias("d_file")), f"SELECT id, sheet_lat, file_lat, 2 AS d_sheet, 4 AS d_file FROM ({GEO}) WHERE NOT {X.sql_values_equal('sheet_lat', 'file_lat')}")
query("data_hash", lambda t: t.lines.groupBy("l_orderkey").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "l_partkey", "l_suppkey"))), lambda x: F.concat_ws(",", x["l_partkey"].cast("string"), x["l_suppkey"].cast("string"))), "\n")).alias("hash"), F.count("*").alias("n_rows")), "SELECT l_orderkey, md5(string_agg(l_partkey || ',' || l_suppkey, chr(10) ORDER BY n)) AS hash, count(*) AS n_rows FROM {lines} GROUP BY l_orderkey")

# -- versions ---------------------------------------------------------------------------------------------------------
query("tick_version", lambda t: versions.tick(t.version_cases).select("k", "version", "n_added", "n_removed"), """WITH s AS (SELECT *, len(list_filter(list_distinct(now), lambda x: x IS NOT NULL AND NOT list_contains(before, x))) AS a, len(list_filter(list_distinct(before), lambda x: x IS NOT NULL AND NOT list_contains(now, x))) AS r, string_split(prev, '_') AS v FROM {version_cases})
  SELECT k, CASE WHEN publish THEN (coalesce(CAST(v[1] AS INTEGER), 0) + 1) || '_0_0' WHEN prev IS NULL THEN '0_0_1' WHEN a = 0 AND r = 0 THEN v[1] || '_' || v[2] || '_' || (CAST(v[3] AS INTEGER) + 1) ELSE v[1] || '_' || (CAST(v[2] AS INTEGER) + 1) || '_0' END AS version, a AS n_added, r AS n_removed FROM s""")
query("version_parse", lambda t: versions.parse(t.ledger.select("version").distinct()), "SELECT DISTINCT version, CAST(split_part(version, '_', 1) AS INTEGER) AS publication, CAST(split_part(version, '_', 2) AS INTEGER) AS dataset, CAST(split_part(version, '_', 3) AS INTEGER) AS metadata FROM {ledger}")
query("version_current", lambda t: versions.current(t.ledger), "SELECT compilation, arg_max(version, ledger_seq) AS version FROM {ledger} GROUP BY compilation")
query("version_ledger", lambda t: versions.ledger_view(t.ledger), "SELECT compilation, ledger_seq, version, n_members, n_members - coalesce(lag(n_members) OVER (PARTITION BY compilation ORDER BY ledger_seq), 0) AS delta FROM {ledger}")
TOP = "SELECT {k}, max([CAST(x AS INTEGER) FOR x IN string_split(version, '{s}')]) AS v FROM {t} GROUP BY {k}"
query("latest_published", lambda t: versions.greatest(t.ledger, "compilation", separator="_"), f"SELECT compilation, array_to_string(v, '_') AS version FROM ({TOP.format(k='compilation', s='_', t='{ledger}')})")
query("max_version", lambda t: versions.greatest(t.versions, "dataset_id"), f"SELECT dataset_id, array_to_string(v, '.') AS version FROM ({TOP.format(k='dataset_id', s='.', t='{versions}')})")
query("next_version", lambda t: versions.next_patch(t.versions, "dataset_id"), f"SELECT dataset_id, CASE WHEN v IS NULL THEN '1.0.0' ELSE v[1] || '.' || v[2] || '.' || (v[3] + 1) END AS version FROM ({TOP.format(k='dataset_id', s='.', t='{versions}')})")
query("set_hash", lambda t: versions.set_hashes(t.series, "dataset_id", "item"), "SELECT dataset_id, md5(string_agg(DISTINCT item, chr(10) ORDER BY item)) AS hash FROM {series} GROUP BY dataset_id")

# -- duplicates -------------------------------------------------------------------------------------------------------
VALUES = "select l_orderkey % 200 as dataset_id, case when l_suppkey % 4 = 0 then 'Age' else l_returnflag end as variable, case when l_quantity <> 7 then cast(l_extendedprice as double) / 7e3 end as v, l_orderkey, n from {lines}"
query("value_hashes", lambda t: dedupe.value_hashes(t.rows(VALUES).groupBy("dataset_id", "variable").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "n", "v"))), lambda x: x["v"]).alias("vals"))), f"""SELECT DISTINCT dataset_id, md5(string_agg(printf('%.6g', v), ',' ORDER BY l_orderkey, n)) AS hash FROM ({VALUES}) WHERE v IS NOT NULL AND variable <> 'Age' GROUP BY dataset_id, variable HAVING count(*) >= 20""")
KM = X.sql_haversine_km("a.lat", "a.lon", "b.lat", "b.lon")
NEAR = "abs(floor(a.lat / {step!r}::DOUBLE) - floor(b.lat / {step!r}::DOUBLE)) <= 1 AND abs(floor(a.lon / {step!r}::DOUBLE) - floor(b.lon / {step!r}::DOUBLE)) <= 1"


def quoted(advice: str) -> str:
    return "'" + dedupe.ADVICE[advice].replace("'", "''") + "'"


def filled(advice: str, *columns: str) -> str:
    parts = [f"'{p}'" for p in dedupe.ADVICE[advice].replace("'", "''").split("{}")]
    return " || ".join(x for pair in zip(parts, [*columns, None], strict=True) for x in pair if x)


query("grid_self_join", lambda t: dedupe.grid_pairs(t.sites, 50.0), f"SELECT a.id, b.id AS id_b, round({KM}, 6) AS km FROM {{sites}} a JOIN {{sites}} b ON a.id < b.id AND {NEAR.format(step=50 / 111)} WHERE {KM} <= 50")
OVER = "coalesce(greatest(least(a.last, b.last) - greatest(a.first, b.first), 0) / nullif(least(a.last - a.first, b.last - b.first), 0), 0)"
YEARS = "greatest(least(a.last, b.last) - greatest(a.first, b.first), 0.0::DOUBLE)"
LIKE = "(len(list_intersect(a.{c}, b.{c})) / CAST(len(list_distinct(list_concat(a.{c}, b.{c}))) AS DOUBLE))"
query("duplicate_candidates", lambda t: dedupe.duplicate_candidates(t.sites, 60.0), f"""WITH c AS (SELECT a.id, b.id AS id_b, round({KM}, 6) AS km, a.doi <> '' AND a.doi = b.doi AS same_doi, a.kind = b.kind AS same_kind, a.name = b.name AS same_site, round({LIKE.format(c='vars')}, 6) AS var_overlap, round({LIKE.format(c='tsids')}, 6) AS ts_overlap, {YEARS} AS year_overlap, b.last - b.first > a.last - a.first AS longer
  FROM {{sites}} a JOIN {{sites}} b ON a.id < b.id AND {NEAR.format(step=60 / 111)} WHERE {KM} <= 60),
  r AS (SELECT *, CASE WHEN ts_overlap > 0 OR (same_doi AND var_overlap >= 0.8) THEN 'already_present' WHEN same_doi AND var_overlap > 0 THEN 'partial_overlap' WHEN km < 1 AND same_kind AND var_overlap >= 0.8 THEN 'already_present' WHEN km < 1 AND same_kind AND var_overlap > 0 THEN 'partial_overlap' WHEN km < 1 AND same_kind OR same_site AND same_kind THEN 'same_site_different_record' ELSE 'nearby_unrelated' END AS disposition FROM c)
  SELECT * EXCLUDE (longer), CASE WHEN disposition = 'already_present' AND longer THEN {quoted('longer')} WHEN disposition = 'already_present' THEN {quoted('present')} WHEN disposition = 'partial_overlap' THEN {quoted('part')} WHEN disposition = 'same_site_different_record' THEN {quoted('same_site')} ELSE {quoted('unrelated')} END AS recommendation FROM r""")
query("cross_conflicts", lambda t: dedupe.cross_conflicts(t.compilation_cells), f"""SELECT tsid, field, count(DISTINCT compilation) AS n_compilations, count(DISTINCT value) AS n_values, count(DISTINCT {PLAIN.format('value')}) AS n_plain, string_agg(DISTINCT value, ' | ' ORDER BY value) AS "values", CASE WHEN count(DISTINCT {PLAIN.format('value')}) = 1 THEN 'cosmetic' ELSE 'substantive' END AS kind FROM {{compilation_cells}} WHERE value <> '' GROUP BY 1, 2 HAVING count(DISTINCT compilation) > 1 AND count(DISTINCT value) > 1""")

# -- pairs and offers over whole tables ---------------------------------------------------------------------------------
query("offer", lambda t: documents.offer(t.rows(TAB), t.datasets), f"SELECT name, include FROM ({TAB}) UNION ALL SELECT name, NULL FROM {{datasets}} WHERE name NOT IN (SELECT name FROM ({TAB}))")
query("haversine_pairs", lambda t: dedupe.key_pairs(t.sites.select("id", "name", F.radians("lat").alias("y"), F.radians("lon").alias("x"), F.cos(F.radians("lat")).alias("c")), "name", lambda a, b: X.radian_km(a("y"), a("x"), a("c"), b("y"), b("x"), b("c"))).select("id", "id_b", X.rounded("value", 4).alias("km")).union(t.sites.select("id", F.lit("origin"), X.rounded(X.haversine_km("lat", "lon", F.lit(0.0), F.lit(0.0)), 4))), f"SELECT a.id, b.id AS id_b, round({KM}, 4) AS km FROM {{sites}} a JOIN {{sites}} b ON a.name = b.name WHERE a.id < b.id UNION ALL SELECT id, 'origin', round({X.sql_haversine_km('lat', 'lon', '0.0::DOUBLE', '0.0::DOUBLE')}, 4) FROM {{sites}}")
query("interval_overlap", lambda t: dedupe.key_pairs(t.sites.select("id", "name", "first", "last"), "name", lambda a, b: F.coalesce(dedupe.interval_overlap(*[F.col(c) for c in (a("first"), a("last"), b("first"), b("last"))]), F.lit(0.0))).select("id", "id_b", X.rounded("value", 6).alias("overlap")), f"SELECT a.id, b.id AS id_b, round({OVER}, 6) AS overlap FROM {{sites}} a JOIN {{sites}} b ON a.name = b.name WHERE a.id < b.id")
query("jaccard_pairs", lambda t: dedupe.jaccard_pairs(t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("item")), 0.5).withColumn("jaccard", F.round("jaccard", 6)), """WITH s AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS item FROM lineitem), n AS (SELECT id, count(*) AS n FROM s GROUP BY id), p AS (SELECT a.id, b.id AS id_b, count(*) AS k FROM s a JOIN s b ON a.item = b.item AND a.id < b.id GROUP BY 1, 2)
  SELECT p.id, p.id_b, round(k / CAST(x.n + y.n - k AS DOUBLE), 6) AS jaccard FROM p JOIN n x ON p.id = x.id JOIN n y ON p.id_b = y.id WHERE k / CAST(x.n + y.n - k AS DOUBLE) >= 0.5""")
HASHED = "select distinct 'O' || cast(l_orderkey as string) as dataset_id, md5(cast(l_partkey as string)) as hash, l_orderkey, l_partkey from {lineitem}"
NEW_SIDE, OLD_SIDE = "l_orderkey % 4 = 0", "(l_orderkey % 4 <> 0 or l_orderkey % 8 = 0 and l_partkey % 3 <> 0 or l_orderkey % 12 = 0)"
query("duplicate_screen", lambda t: dedupe.duplicate_screen(t.rows(HASHED).where(NEW_SIDE), t.rows(HASHED).where(OLD_SIDE)).withColumn("containment", F.round("containment", 6)), f"""WITH h AS ({HASHED}), a AS (SELECT DISTINCT dataset_id, hash FROM h WHERE {NEW_SIDE}), b AS (SELECT DISTINCT dataset_id, hash FROM h WHERE {OLD_SIDE}), na AS (SELECT dataset_id, count(*) AS n FROM a GROUP BY 1), nb AS (SELECT dataset_id, count(*) AS n FROM b GROUP BY 1),
  s AS (SELECT a.dataset_id AS new_id, b.dataset_id AS old_id, count(*) AS n_shared FROM a JOIN b ON a.hash = b.hash GROUP BY 1, 2), x AS (SELECT s.*, na.n AS n_new, nb.n AS n_old, new_id = old_id AS same_name, n_shared / CAST(least(na.n, nb.n) AS DOUBLE) AS c FROM s JOIN na ON na.dataset_id = new_id JOIN nb ON nb.dataset_id = old_id)
  SELECT new_id, old_id, n_shared, n_new, n_old, same_name, round(c, 6) AS containment, CASE WHEN c >= 1 AND n_new > n_old THEN 'already_present_incoming_has_more' WHEN c >= 1 THEN 'already_present' ELSE 'partial_overlap' END AS disposition,
  CASE WHEN c >= 1 AND n_new > n_old THEN {filled('already_present_incoming_has_more', 'old_id')} WHEN c >= 1 AND same_name THEN {filled('update', 'old_id')} WHEN c >= 1 THEN {filled('already_present', 'old_id', 'old_id')} ELSE {filled('partial_overlap', 'n_shared', 'n_old', 'old_id')} END AS recommendation FROM x""")
# -- relational building blocks ---------------------------------------------------------------------------------------
query("count_by", lambda t: t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")), "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
query("topk_fields", lambda t: relational.top_counts(t.lineitem, "l_partkey", 15), "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 15")
query("sorted_set_agg", lambda t: relational.sorted_set(t.lineitem, "l_orderkey", "l_suppkey"), "SELECT l_orderkey, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ', ' ORDER BY CAST(l_suppkey AS VARCHAR)) AS items FROM lineitem GROUP BY 1")
query("example_values", lambda t: relational.examples(t.part, "p_brand", "p_name"), "SELECT p_brand, string_agg(p_name, ' | ' ORDER BY p_name) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name) AS r FROM (SELECT DISTINCT p_brand, p_name FROM part)) WHERE r <= 4 GROUP BY 1")
query("term_variance", lambda t: t.compilation_cells.groupBy("field", "tsid").agg(F.count_distinct("value").alias("n_values")).groupBy("field").agg(F.count("*").alias("n_series"), F.count_if(F.expr("n_values > 1")).alias("n_varying"), F.max("n_values").alias("most")), "SELECT field, count(*) AS n_series, count(*) FILTER (n > 1) AS n_varying, max(n) AS most FROM (SELECT field, tsid, count(DISTINCT value) AS n FROM {compilation_cells} GROUP BY 1, 2) GROUP BY 1")
query("classify_terms", lambda t: t.base.groupBy("field").agg(F.count_if(~X.blank("value")).alias("n_filled"), F.count_distinct("value").alias("n_values"), F.avg(F.when(X.number("value").isNotNull(), 1.0).otherwise(0.0)).alias("numeric")).select("field", "n_filled", "n_values", F.when(F.col("numeric") > 0.99, "number").when(F.col("n_values") <= 10, "category").when(F.col("n_values") == F.col("n_filled"), "identifier").otherwise("text").alias("class")), """SELECT field, count(*) AS n_filled, count(DISTINCT value) AS n_values, CASE WHEN avg(CASE WHEN regexp_matches(value, '^[+-]?[0-9.]+$') THEN 1.0 ELSE 0.0 END) > 0.99 THEN 'number' WHEN count(DISTINCT value) <= 10 THEN 'category' WHEN count(DISTINCT value) = count(*) THEN 'identifier' ELSE 'text' END AS "class" FROM {base} GROUP BY field""")
query("quantile_buckets", lambda t: t.lineitem.groupBy("l_returnflag").agg(*[F.round(F.percentile("l_extendedprice", q), 4).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.9)]), "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1")
query("first_per_key", lambda t: relational.first_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey"), "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
query("slice_max_one", lambda t: t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("o_orderkey"), F.max("o_totalprice").alias("top")), "SELECT o_custkey, o_orderkey, o_totalprice AS top FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
query("slice_head_n", lambda t: relational.head_per_key(t.orders, ["o_custkey"], ["o_orderkey"], 3).select("o_custkey", "o_orderkey"), "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r <= 3")
query("ordered_report", lambda t: t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")).withColumn("rank", F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)).orderBy("rank", F.desc("n")), "SELECT o_orderpriority, o_orderstatus, count(*) AS n, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS rank FROM orders GROUP BY 1, 2")
QUOTA = [("big", "p_size > 40", 20), ("promo", "p_type = 'PROMO'", 15), ("rest", "true", 10)]
query("quota_sample", lambda t: relational.quota_sample(t.part, "p_partkey", [(r, F.expr(w), n) for r, w, n in QUOTA], F.md5(F.col("p_partkey").cast("string"))), """WITH a AS (SELECT p_partkey, 'big' AS reason FROM part WHERE p_size > 40 ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 20), b AS (SELECT p_partkey, 'promo' AS reason FROM part WHERE p_type = 'PROMO' AND p_partkey NOT IN (SELECT p_partkey FROM a) ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 15),
  c AS (SELECT p_partkey, 'rest' AS reason FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM a UNION ALL SELECT p_partkey FROM b) ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 10) SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""")
query("set_delta", lambda t: relational.set_delta(t.orders.where("o_orderkey % 3 <> 0").select("o_custkey"), t.orders.where("o_orderkey % 5 <> 0 and o_custkey % 7 <> 0").select("o_custkey"), ["o_custkey"]), "WITH b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 5 <> 0 AND o_custkey % 7 <> 0) SELECT coalesce(b.o_custkey, n.o_custkey) AS o_custkey, CASE WHEN b.o_custkey IS NULL THEN 'added' WHEN n.o_custkey IS NULL THEN 'removed' ELSE 'kept' END AS change FROM b FULL JOIN n ON b.o_custkey = n.o_custkey")
query("distinct_pairs", lambda t: t.lineitem.select("l_partkey", "l_suppkey").distinct(), "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
query("lookup_left", lambda t: t.customer.join(t.nation.where("n_nationkey % 3 <> 0"), t.customer.c_nationkey == t.nation.n_nationkey, "left").select("c_custkey", "n_name"), "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 3 <> 0")
query("lookup_first", lambda t: relational.lookup_first(t.customer.select("c_custkey", F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"), "s_suppkey"), "k", ["s_suppkey"]), "SELECT c_custkey, c_nationkey AS k, (SELECT min(s_suppkey) FROM supplier WHERE s_nationkey = c_nationkey) AS s_suppkey FROM customer")
query("semi_members", lambda t: t.customer.join(t.orders.where("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
query("sources_pairing", lambda t: t.pages.select("page_id", F.regexp_extract("url", "^(.*)/", 1).alias("dir")).join(t.pages.where("page_id % 5 = 0").groupBy(F.regexp_extract("url", "^(.*)/", 1).alias("dir")).agg(F.count("*").alias("n_beside")), "dir", "left").select("page_id", F.coalesce("n_beside", F.lit(0)).alias("n_beside")), "SELECT page_id, coalesce(n, 0) AS n_beside FROM (SELECT page_id, regexp_extract(url, '^(.*)/', 1) AS dir FROM pages) p LEFT JOIN (SELECT regexp_extract(url, '^(.*)/', 1) AS dir, count(*) AS n FROM pages WHERE page_id % 5 = 0 GROUP BY 1) q ON p.dir = q.dir")

# -- files that only code reads ---------------------------------------------------------------------------------------
query("flatten_leaves", lambda t: archives.leaves(archives.packed(t.documents)))