"""Queries over scans, the index, incoming records and vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import expr as X
from strandloom.functions import text as T
from strandloom.operators import dedupe, documents, identity, relational, vocab
from strandloom.plans.catalog import query


def issue_sql(rows: list[tuple[str, str, str, dict[str, str]]]) -> str:
    """UNION ALL of issues: (check, severity, FROM clause, columns)."""
    parts = []
    for check, severity, source, columns in rows:
        named = {"check": f"'{check}'", "severity": f"'{severity}'", **columns}
        parts.append("SELECT " + ", ".join(f'CAST({named.get(c, "NULL")} AS VARCHAR) AS "{c}"' for c in identity.ISSUE_COLUMNS) + f" FROM {source}")
    return " UNION ALL ".join(parts)


def dup_sql(column: str) -> str:
    return f"(SELECT {column} AS value, string_agg(CAST(file AS VARCHAR), ', ' ORDER BY file) AS files, count(*) AS n FROM {{datasets}} WHERE {column} <> '' GROUP BY {column} HAVING count(*) > 1)"


SCOPE = "(SELECT tsid, count(*) AS n, CASE WHEN count(DISTINCT dataset_id) = 1 THEN 'within_dataset' ELSE 'across_datasets' END AS scope, string_agg(DISTINCT dataset_id, ';' ORDER BY dataset_id) AS datasets FROM {series} WHERE tsid <> '' GROUP BY tsid HAVING count(*) > 1)"
OWN = {"datasetId": "datasetId", "dataSetName": "dataSetName", "path": "file"}
IDENTITY = issue_sql([
    ("unreadable", "error", "{datasets} WHERE parse_error IS NOT NULL", OWN),
    ("missing_datasetId", "warn", "{datasets} WHERE coalesce(datasetId, '') = '' AND parse_error IS NULL", OWN),
    ("missing_dataSetName", "error", "{datasets} WHERE coalesce(dataSetName, '') = '' AND parse_error IS NULL", OWN),
    ("filename_metadata_mismatch", "warn", "{datasets} WHERE dataSetName <> '' AND fileDataSetName <> dataSetName", OWN),
    ("missing_TSid", "warn", "{series} WHERE coalesce(tsid, '') = ''", {"datasetId": "dataset_id"}),
    ("no_timeseries", "warn", "{datasets} d WHERE NOT EXISTS (SELECT 1 FROM {series} s WHERE s.dataset_id = d.datasetId) AND parse_error IS NULL", OWN),
    ("duplicate_datasetId", "warn", dup_sql("datasetId"), {"value": "value", "message": "files"}),
    ("duplicate_dataSetName", "warn", dup_sql("dataSetName"), {"value": "value", "message": "files"}),
    ("duplicate_filename", "error", dup_sql("fileDataSetName"), {"value": "value", "message": "files"}),
    ("duplicate_TSid", "warn", SCOPE, {"TSid": "tsid", "message": "scope", "value": "datasets"}),
])


def identity_issues(t):
    return identity.validate_identity(t.datasets, t.series)


# -- scans and index --------------------------------------------------------------------------------------------------
query("scan_hash", lambda t: t.documents.select(F.concat(F.lit("d"), F.col("doc_id")).alias("name"), F.md5("text").alias("md5")), "SELECT name, md5 FROM {scan_old}")
query("scan_diff", lambda t: identity.scan_diff(t.scan_old, t.scan_new), "SELECT coalesce(o.name, n.name) AS name, CASE WHEN o.name IS NULL THEN 'added' WHEN n.name IS NULL THEN 'removed' ELSE 'changed' END AS change FROM {scan_old} o FULL JOIN {scan_new} n ON o.name = n.name WHERE o.md5 IS DISTINCT FROM n.md5")
MANIFEST = "select 'd' || cast(doc_id as string) as path, md5(text) as md5, n_chars as bytes from {documents} where doc_id % 41 <> 0", "select 'd' || cast(doc_id as string) as path, md5(case when doc_id % 9 = 0 then text || '!' else text end) as md5, case when doc_id % 9 = 0 then n_chars + 1 else n_chars end as bytes from {documents} where doc_id % 43 <> 0"
query("manifest_diff", lambda t: identity.manifest_diff(t.rows(MANIFEST[0]), t.rows(MANIFEST[1])), f"SELECT coalesce(o.path, n.path) AS path, CASE WHEN o.md5 IS NULL THEN 'added' WHEN n.md5 IS NULL THEN 'removed' WHEN o.md5 <> n.md5 THEN 'changed' ELSE 'same' END AS change, coalesce(n.bytes, 0) - coalesce(o.bytes, 0) AS delta FROM ({MANIFEST[0]}) o FULL JOIN ({MANIFEST[1]}) n ON o.path = n.path")
query("fingerprint", lambda t: identity.scan_fingerprint(t.scan_old), f"SELECT {X.sql_row_fingerprint('name', 'md5')} AS fingerprint FROM {{scan_old}}")
query("index_datasets", lambda t: t.datasets.join(t.series.groupBy(F.col("dataset_id").alias("datasetId")).agg(F.count("*").alias("n_ts")), "datasetId", "left").select("datasetId", "dataSetName", "file", "parse_error", F.coalesce("n_ts", F.lit(0)).alias("n_ts")), "SELECT d.datasetId, d.dataSetName, d.file, d.parse_error, coalesce(s.n, 0) AS n_ts FROM {datasets} d LEFT JOIN (SELECT dataset_id, count(*) AS n FROM {series} GROUP BY 1) s ON d.datasetId = s.dataset_id")
query("index_timeseries", lambda t: t.series.select("tsid", "dataset_id", "variable", F.array_join(F.filter("compilations", lambda x: x.isNotNull()), ",").alias("compilations")), "SELECT tsid, dataset_id, variable, array_to_string(list_filter(compilations, lambda x: x IS NOT NULL), ',') AS compilations FROM {series}")
query("validate_identity", identity_issues, IDENTITY)
query("issue_summary", lambda t: identity.issue_summary(identity_issues(t)), f"""SELECT severity, "check", count(*) AS n, CASE severity WHEN 'error' THEN 1 WHEN 'warn' THEN 2 ELSE 3 END AS rank FROM ({IDENTITY}) GROUP BY severity, "check" """)
query("duplicate_values", lambda t: identity.duplicate_values(t.datasets, "dataSetName"), f"SELECT value, n, files FROM {dup_sql('dataSetName')}")
query("duplicate_tsid_scope", lambda t: identity.duplicate_tsid_scope(t.series), f"SELECT tsid, n, scope, datasets FROM {SCOPE}")
query("union_frames", lambda t: identity.bind(t.datasets.select("file", "parse_error"), t.series.select("tsid", F.col("dataset_id").alias("file"))), "SELECT file, parse_error, NULL AS tsid FROM {datasets} UNION ALL SELECT dataset_id, NULL, tsid FROM {series}")
query("scope_timeseries", lambda t: t.clean_series.where("variable like 'R%'").join(t.datasets.where("parse_error is null").select(F.col("datasetId").alias("dataset_id")), "dataset_id", "left_semi").select("tsid", "dataset_id").distinct(), "SELECT DISTINCT tsid, dataset_id FROM {clean_series} WHERE variable LIKE 'R%' AND dataset_id IN (SELECT datasetId FROM {datasets} WHERE parse_error IS NULL)")
query("members_of", lambda t: documents.members_of(t.clean_series, "cR"), "SELECT DISTINCT tsid, dataset_id FROM {clean_series} WHERE list_contains(compilations, 'cR')")
query("promote_plan", lambda t: t.scan_old.select("name", F.col("md5").alias("old_md5")).join(t.scan_new.select("name", F.col("md5").alias("new_md5")), "name", "full_outer").select("name", F.when(F.col("old_md5").isNull(), "add").when(F.col("new_md5").isNull(), "delete").when(F.col("old_md5") == F.col("new_md5"), "same").otherwise("replace").alias("action"), "old_md5", "new_md5"), "SELECT coalesce(o.name, n.name) AS name, CASE WHEN o.md5 IS NULL THEN 'add' WHEN n.md5 IS NULL THEN 'delete' WHEN o.md5 = n.md5 THEN 'same' ELSE 'replace' END AS action, o.md5 AS old_md5, n.md5 AS new_md5 FROM {scan_old} o FULL JOIN {scan_new} n ON o.name = n.name")
query("gc_plan", lambda t: t.receipts.select("run_id").distinct().join(relational.head_per_key(t.receipts.select("run_id").distinct().withColumn("one", F.lit(1)), ["one"], [F.desc("run_id")], 3).select("run_id", F.lit(True).alias("kept")), "run_id", "left").select("run_id", F.coalesce("kept", F.lit(False)).alias("kept")), "SELECT run_id, run_id IN (SELECT DISTINCT run_id FROM {receipts} ORDER BY run_id DESC LIMIT 3) AS kept FROM (SELECT DISTINCT run_id FROM {receipts})")
query("write_log", lambda t: t.receipts.groupBy("run_id").agg(*[F.count_if(F.col("action") == a).alias(f"n_{a}") for a in ("add", "replace", "delete")], F.count_distinct("file").alias("n_files")).orderBy(F.desc("run_id")), "SELECT run_id, count(*) FILTER (action = 'add') AS n_add, count(*) FILTER (action = 'replace') AS n_replace, count(*) FILTER (action = 'delete') AS n_delete, count(DISTINCT file) AS n_files FROM {receipts} GROUP BY run_id")

# -- incoming records -------------------------------------------------------------------------------------------------
INCOMING = "select 'f' || cast(cast(floor(l_orderkey / 3) as bigint) as string) as file, l_orderkey * 100 + n as position, case when l_orderkey % 7 = 0 then cast(null as string) when l_orderkey % 5 = 0 then cast(l_orderkey as string) || '-' || cast(n as string) when l_orderkey % 4 = 0 then 'new-' || cast(l_orderkey % 50 as string) else 'own-' || cast(l_orderkey as string) || '-' || cast(n as string) end as tsid, case when l_orderkey % 10 = 0 then cast(null as string) when l_orderkey % 15 = 0 then 'Oother' else 'O' || cast(l_orderkey as string) end as dataset_id, 'N' || cast(l_orderkey as string) as dataset_name, case when l_orderkey % 211 = 0 then 'bad' end as error from {lines}"
INDEX = "select tsid, dataset_id, 'N' || substr(dataset_id, 2, 20) as dataset_name from {clean_series}"
ACTION = f"""WITH inc AS ({INCOMING}), idx AS ({INDEX}), f AS (SELECT tsid, count(DISTINCT file) AS n FROM inc GROUP BY tsid),
  plan AS (SELECT inc.file, inc.position, inc.tsid, CASE WHEN inc.error IS NOT NULL THEN 'error' WHEN inc.tsid IS NULL THEN 'mint' WHEN idx.dataset_id = inc.dataset_id OR (inc.dataset_id IS NULL AND idx.dataset_name = inc.dataset_name) THEN 'keep' WHEN idx.tsid IS NOT NULL OR f.n > 1 THEN 'remint' ELSE 'keep' END AS action, idx.dataset_id AS claimed_by
  FROM inc LEFT JOIN idx ON inc.tsid = idx.tsid LEFT JOIN f ON inc.tsid = f.tsid)"""


def id_plan(t):
    return identity.ingest_identity(t.rows(INCOMING), t.rows(INDEX))


query("ingest_identity", id_plan, f"{ACTION} SELECT * FROM plan")
query("ingest_mint", lambda t: identity.minted(id_plan(t), t.rows(INDEX), "run1").select("file", "position", "action", F.length("new_tsid").alias("n")).where("action in ('mint', 'remint')"), f"{ACTION} SELECT file, position, action, 22 AS n FROM plan WHERE action IN ('mint', 'remint')")
query("ingest_issues", lambda t: identity.ingest_issues(id_plan(t)), ACTION + " " + issue_sql([("ingest_identity", "x", "plan WHERE action IN ('remint', 'error')", {"severity": "CASE WHEN action = 'remint' THEN 'warn' ELSE 'error' END", "TSid": "tsid", "message": "action", "path": "file"})]))
CHECKED = "select 'f' || cast(o_orderkey as string) as file, case when o_orderkey % 13 = 0 then 'Other.Name.1999' else n end as file_name, n as name, case when o_orderkey % 17 = 0 then '' else o_orderstatus end as archive, case when o_orderkey % 19 = 0 then cast(null as double) else o_orderkey % 200 - 95e0 end as latitude, o_custkey % 400 - 185e0 as longitude, o_orderkey % 3 = 0 as has_publication, case when o_orderkey % 101 = 0 then 'bad' end as error from (select *, case when o_orderkey % 23 = 0 then '' when o_orderkey % 29 = 0 then 'test.Author.2001' when o_orderkey % 31 = 0 then 'Site name.Author.2001' when o_orderkey % 37 = 0 then 'Si:te.Author.1200' else 'S' || cast(o_orderkey as string) || '.Author.' || cast(1990 + o_orderkey % 50 as string) end as n from {orders}) q"
THERE = "select 'S' || cast(o_orderkey as string) || '.Author.' || cast(1990 + o_orderkey % 50 as string) as name from {orders} where o_orderkey % 41 = 0"
CHECKS = [
    ("unreadable", "error", "error IS NOT NULL"), ("name_missing", "error", "ok AND name = ''"), ("name_illegal", "error", "named AND regexp_matches(name, '[/\\\\:*?\"<>|]')"), ("name_placeholder", "warn", "named AND regexp_matches(name, '(?i)^(test|untitled|unknown|new)([.]|$)')"),
    ("name_space", "warn", "named AND contains(name, ' ')"), ("name_unconventional", "info", f"named AND NOT regexp_matches(name, '{identity.NAME}')"), ("name_year", "warn", "named AND NOT CAST(right(name, 4) AS INTEGER) BETWEEN 1500 AND 2030"), ("name_file_mismatch", "warn", "named AND file_name <> name"),
    ("name_update", "info", "named AND name IN (SELECT name FROM there)"), ("archive_missing", "error", "ok AND archive = ''"), ("coordinates_missing", "error", "ok AND latitude IS NULL"), ("latitude_range", "error", "ok AND NOT latitude BETWEEN -90 AND 90"), ("longitude_range", "error", "ok AND NOT longitude BETWEEN -180 AND 360"), ("publication_missing", "warn", "ok AND NOT has_publication"),
]
query("ingest_validate", lambda t: identity.ingest_validate(t.rows(CHECKED), t.rows(THERE)), f"WITH i AS ({CHECKED}), there AS ({THERE}), c AS (SELECT *, error IS NULL AS ok, error IS NULL AND name <> '' AS named FROM i) " + " UNION ALL ".join(f"SELECT '{c}' AS \"check\", '{s}' AS severity, file, name FROM c WHERE {w}" for c, s, w in CHECKS))
PLANNED, STAGED = "select dataset_id as file, n as position, variable from {clean_series}", "select dataset_id as file, n as position, case when l_suppkey = 7 then 'XX' else variable end as variable from {clean_series} where dataset_id <> 'O5'"
LISTED = "SELECT file, string_agg(variable, ',' ORDER BY position) AS v FROM ({}) GROUP BY file"
query("structure_mismatch", lambda t: identity.structure_mismatch(t.rows(PLANNED), t.rows(STAGED)), f"SELECT coalesce(a.file, b.file) AS file, a.v AS planned, b.v AS staged FROM ({LISTED.format(PLANNED)}) a FULL JOIN ({LISTED.format(STAGED)}) b ON a.file = b.file WHERE a.v IS DISTINCT FROM b.v")
query("lost_values", lambda t: identity.lost_values(t.rows("select dataset_id as file, count(*) as n_values from {clean_series} group by dataset_id"), t.rows("select dataset_id as file, count(*) as n_values from {clean_series} where l_suppkey <> 3 group by dataset_id")), "SELECT dataset_id AS file, count(*) AS n_before, count(*) FILTER (l_suppkey <> 3) AS n_after FROM {clean_series} GROUP BY dataset_id HAVING count(*) FILTER (l_suppkey <> 3) < count(*)")
query("ingest_scan", lambda t: documents.walk_columns(t.clean_series.groupBy("dataset_id").agg(F.array(F.struct(F.lit("paleo").alias("kind"), F.array(F.struct(F.lit("m").alias("name"), F.transform(F.array_sort(F.collect_list(F.struct("n", "tsid", "variable", "compilations"))), lambda c: F.struct(F.when(c["n"] != 2, c["tsid"]).alias("tsid"), c["variable"].alias("variable"), F.lit(None).cast("string").alias("units"), c["compilations"].alias("compilations"))).alias("columns"))).alias("tables"))).alias("blocks")).withColumn("name", F.col("dataset_id")), with_id_only=False).select("dataset_id", "column_pos", "tsid", "variable"), "SELECT dataset_id, n AS column_pos, CASE WHEN n <> 2 THEN tsid END AS tsid, variable FROM {clean_series}")
query("ingest_pipeline", lambda t: id_plan(t).join(identity.ingest_validate(t.rows(CHECKED), t.rows(THERE)).where("severity = 'error'").select("file").distinct(), "file", "left_anti").groupBy("file").agg(F.count("*").alias("n_columns"), F.count_if(F.expr("action = 'keep'")).alias("n_kept")), f"""{ACTION}, i AS ({CHECKED}), there AS ({THERE}), c AS (SELECT *, error IS NULL AS ok, error IS NULL AND name <> '' AS named FROM i), bad AS (""" + " UNION ALL ".join(f"SELECT file FROM c WHERE {w}" for _, s, w in CHECKS if s == "error") + ") SELECT file, count(*) AS n_columns, count(*) FILTER (action = 'keep') AS n_kept FROM plan WHERE file NOT IN (SELECT file FROM bad) GROUP BY file")

# -- vocabulary -------------------------------------------------------------------------------------------------------
TRIM = "regexp_replace(input, '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g')"


def best(test: str, column: str) -> str:
    return f"(SELECT arg_min(name, place) FROM {{vocab}} v WHERE v.vocab_key = i.vocab_key AND {test.format(column)})"


STANDARD = f"""WITH i AS (SELECT DISTINCT vocab_key, value AS input FROM {{vocab_input}}),
  s AS (SELECT *, {best("v.{} = input", "name")} AS a, {best("v.{} = input", "synonym")} AS b, coalesce({best("lower(v.{}) = lower(input)", "name")}, {best("lower(v.{}) = lower(input)", "synonym")}) AS c, coalesce({best("lower(v.{}) = lower(" + TRIM + ")", "name")}, {best("lower(v.{}) = lower(" + TRIM + ")", "synonym")}) AS d FROM i),
  standard AS (SELECT vocab_key, input, CASE WHEN coalesce(input, '') = '' THEN input ELSE coalesce(a, b, c, d, input) END AS value, coalesce(input, '') <> '' AND coalesce(a, b, c, d) IS NOT NULL AS matched,
  CASE WHEN coalesce(input, '') = '' OR coalesce(a, b, c, d) IS NULL THEN 'none' WHEN a IS NOT NULL THEN 'canonical' WHEN b IS NOT NULL THEN 'synonym' WHEN c IS NOT NULL THEN 'case' ELSE 'trim' END AS rule FROM s)"""


def unknown(t):
    return vocab.unmatched(t.vocab_input, t.vocab)


query("vocab_load", lambda t: t.vocab.groupBy("vocab_key").agg(F.count("*").alias("n_rows"), F.count_distinct("name").alias("n_names")), "SELECT vocab_key, count(*) AS n_rows, count(DISTINCT name) AS n_names FROM {vocab} GROUP BY vocab_key")
query("vocab_standardize", lambda t: vocab.standardize(t.vocab_input, t.vocab), f"{STANDARD} SELECT * FROM standard")
query("vocab_check", unknown, f"{STANDARD} SELECT vocab_key, input AS value FROM standard WHERE NOT matched AND coalesce(input, '') <> ''")
query("standardize_batch", lambda t: t.vocab_input.join(vocab.standardize(t.vocab_input, t.vocab).withColumnRenamed("value", "new_value").withColumnRenamed("input", "value"), ["vocab_key", "value"]).where("matched and value <> new_value").groupBy("vocab_key", "rule").agg(F.count("*").alias("n"), F.count_distinct("dataset_id").alias("n_datasets")), f"{STANDARD} SELECT v.vocab_key, s.rule, count(*) AS n, count(DISTINCT v.dataset_id) AS n_datasets FROM {{vocab_input}} v JOIN standard s ON v.vocab_key = s.vocab_key AND v.value = s.input WHERE matched AND s.input <> s.value GROUP BY 1, 2")
query("vocab_overlay", lambda t: vocab.overlay(t.vocab, t.decisions), """WITH n AS (SELECT DISTINCT vocab_key, target AS name, value AS synonym FROM {decisions} WHERE decision = 'synonym' OR (decision = 'new_term' AND also_field IS NULL))
  SELECT vocab_key, name, synonym FROM {vocab} v WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.vocab_key = v.vocab_key AND n.synonym = v.synonym) UNION ALL SELECT * FROM n""")
query("vocab_remap", lambda t: vocab.remap(t.decisions), "SELECT vocab_key, value, target, also_field, also_value FROM {decisions} WHERE decision = 'decompose' OR (decision = 'new_term' AND target <> '' AND also_field <> '')")
query("apply_remap", lambda t: vocab.apply_remap(t.rows("select p_partkey, p_name, case when p_partkey % 3 = 0 then p_brand else '' end as color from {part}"), vocab.remap(t.decisions), "p_name", "color"), "SELECT p_partkey, CASE WHEN p_name = 'red widget' THEN 'PROMO' ELSE p_name END AS p_name, CASE WHEN p_partkey % 3 = 0 THEN p_brand WHEN p_name = 'red widget' THEN 'red' ELSE '' END AS color FROM {part}")
SCORE = "levenshtein(lower(value), lower(term)) / CAST(greatest(length(value), length(term)) AS DOUBLE) - CASE WHEN contains(lower(value), lower(term)) OR contains(lower(term), lower(value)[1:40]) THEN 0.6::DOUBLE ELSE 0 END - CASE WHEN len(list_filter(string_split_regex(lower(value), '[^a-z0-9]+'), lambda w: length(w) >= 4 AND (starts_with(lower(term), w) OR starts_with(w, lower(term)[1:5])))) > 0 THEN 0.25::DOUBLE ELSE 0 END"
PLACED = "select * from {vocab} union all select 'type', 'unknown', 'ECONOMYX', 20 union all select 'type', 'PLATED', cast(null as string), 21 union all select 'type', 'unknown', 'brushed tin', 22"
query("vocab_candidates", lambda t: vocab.candidates(unknown(t), t.rows(PLACED)).withColumn("score", F.round("score", 6)), f"""{STANDARD}, u AS (SELECT vocab_key, input AS value FROM standard WHERE NOT matched AND coalesce(input, '') <> ''), v AS ({PLACED}), f AS (SELECT vocab_key, name, name AS term, 1 AS rank, place FROM v UNION ALL SELECT vocab_key, name, synonym, 2, place FROM v WHERE synonym IS NOT NULL),
  e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vocab_key, term ORDER BY rank, place) AS q FROM f WHERE term <> 'unknown') WHERE q = 1), y AS (SELECT u.vocab_key, value, name, rank, place, {SCORE} AS score FROM u JOIN e ON u.vocab_key = e.vocab_key),
  z AS (SELECT *, row_number() OVER (PARTITION BY vocab_key, value ORDER BY score, rank, place) AS o FROM y), g AS (SELECT vocab_key, value, name, min(o) AS o, arg_min(score, o) AS score FROM z WHERE o <= 15 AND name <> 'unknown' GROUP BY 1, 2, 3)
  SELECT vocab_key, value, name, round(score, 6) AS score, place FROM (SELECT *, row_number() OVER (PARTITION BY vocab_key, value ORDER BY o) AS place FROM g) WHERE place <= 5""")
query("thesaurus_load", lambda t: t.vocab.groupBy("vocab_key", "name").agg(F.array_join(F.array_sort(F.collect_set("synonym")), " | ").alias("alt"), F.min("place").alias("id")), "SELECT vocab_key, name, string_agg(DISTINCT synonym, ' | ' ORDER BY synonym) AS alt, min(place) AS id FROM {vocab} GROUP BY 1, 2")
query("thesaurus_match", lambda t: vocab.thesaurus_match(t.vocab_input, t.vocab.groupBy("vocab_key", F.col("name").alias("label")).agg(F.collect_set("synonym").alias("alt"), F.min("place").alias("id"))).withColumn("score", F.round("score", 6)), f"""WITH v AS (SELECT DISTINCT vocab_key, value, lower({TRIM.replace("input", "value")}) AS a FROM {{vocab_input}} WHERE value <> ''), c AS (SELECT vocab_key, name AS label, lower(name) AS b, list(DISTINCT lower(synonym)) AS alt, min(place) AS id FROM {{vocab}} GROUP BY 1, 2),
  j AS (SELECT v.vocab_key, value, id, label, a = b AS exact, list_contains(alt, a) AS in_alt, contains(b, a) OR len(list_filter(alt, lambda x: contains(x, a))) > 0 AS holds, length(a) > 5 AND length(b) > 3 AND contains(a, b) AS held, levenshtein(a, b) / CAST(greatest(length(a), length(b)) AS DOUBLE) AS far FROM v JOIN c ON v.vocab_key = c.vocab_key),
  s AS (SELECT *, far - CASE WHEN exact THEN 10::DOUBLE ELSE 0 END - CASE WHEN in_alt THEN 8::DOUBLE ELSE 0 END - CASE WHEN holds THEN 1.2::DOUBLE ELSE 0 END - CASE WHEN held THEN 0.8::DOUBLE ELSE 0 END AS score FROM j)
  SELECT vocab_key, value, id, label, CASE WHEN exact THEN 'exact' WHEN in_alt THEN 'altLabel' WHEN holds OR held THEN 'contains' ELSE 'similar' END AS rule, round(score, 6) AS score, place FROM (SELECT *, row_number() OVER (PARTITION BY vocab_key, value ORDER BY score, id) AS place FROM s) WHERE place <= 3 AND (exact OR in_alt OR holds OR held OR far <= 0.45::DOUBLE)""")
query("review_queue", lambda t: vocab.review_queue(t.vocab_input.join(unknown(t), ["vocab_key", "value"]), t.decisions), f"""{STANDARD} SELECT i.vocab_key, i.value, count(*) AS n, min(tsid) AS example, string_agg(DISTINCT dataset_id, ',' ORDER BY dataset_id) AS datasets FROM {{vocab_input}} i JOIN standard s ON i.vocab_key = s.vocab_key AND i.value = s.input WHERE NOT matched AND i.value <> '' AND NOT EXISTS (SELECT 1 FROM {{decisions}} d WHERE d.vocab_key = i.vocab_key AND d.value = i.value) GROUP BY 1, 2""")
query("anti_decided", lambda t: unknown(t).join(t.decisions.select("vocab_key", "value"), ["vocab_key", "value"], "left_anti"), f"{STANDARD} SELECT vocab_key, input AS value FROM standard s WHERE NOT matched AND coalesce(input, '') <> '' AND NOT EXISTS (SELECT 1 FROM {{decisions}} d WHERE d.vocab_key = s.vocab_key AND d.value = s.input)")
query("vocab_accept", lambda t: vocab.accept(t.review, "medium").select("vocab_key", "value", "decision", "target", "accepted", "confidence"), "SELECT vocab_key, value, CASE WHEN a THEN proposed ELSE decision END AS decision, CASE WHEN a THEN proposed_target ELSE target END AS target, a AS accepted, confidence FROM (SELECT *, decision IS NULL AND proposed IS NOT NULL AND coalesce(confidence, 'low') IN ('medium', 'high') AS a FROM {review})")
query("review_violations", lambda t: vocab.review_violations(t.review, t.vocab), """WITH d AS (SELECT r.*, target IN (SELECT name FROM {vocab} WHERE vocab_key = 'type') AS known, count(*) OVER (PARTITION BY vocab_key, value) AS n FROM {review} r WHERE decision IS NOT NULL)
  SELECT 'synonym_target' AS rule, vocab_key, value FROM d WHERE decision = 'synonym' AND NOT known UNION ALL SELECT 'new_term_exists', vocab_key, value FROM d WHERE decision = 'new_term' AND known UNION ALL SELECT 'decompose_incomplete', vocab_key, value FROM d WHERE decision = 'decompose' AND (also_field IS NULL OR also_value IS NULL) UNION ALL SELECT 'decided_twice', vocab_key, value FROM d WHERE n > 1""")
query("vocab_patches", lambda t: vocab.patches(t.decisions, t.vocab), "SELECT DISTINCT vocab_key, target AS name, CASE WHEN decision = 'synonym' THEN value END AS synonym FROM {decisions} d WHERE decision IN ('synonym', 'new_term') AND NOT EXISTS (SELECT 1 FROM {vocab} v WHERE v.vocab_key = d.vocab_key AND v.name = d.target AND v.synonym IS NOT DISTINCT FROM CASE WHEN decision = 'synonym' THEN value END)")
query("review_groups", lambda t: vocab.review_groups(t.review), "SELECT decision, target, vocab_key, count(*) AS n, min(value) AS first_value FROM {review} GROUP BY 1, 2, 3")
query("vocab_pin", lambda t: vocab.pin(t.vocab), f"SELECT vocab_key, {X.sql_row_fingerprint('name', 'synonym')} AS pin FROM {{vocab}} GROUP BY vocab_key")
query("review_read", lambda t: t.review.select(F.from_json(F.to_json(F.struct("vocab_key", "value", F.struct("proposed", "proposed_target", "confidence").alias("p"))), "vocab_key string, value string, p struct<proposed: string, proposed_target: string, confidence: string>").alias("j")).select("j.vocab_key", "j.value", "j.p.*"), "SELECT vocab_key, value, proposed, proposed_target, confidence FROM {review}")
query("review_export", lambda t: t.vocab_input.groupBy("vocab_key", "value").agg(F.array_join(F.array_sort(F.collect_set("dataset_id")), "|").alias("datasets")), "SELECT vocab_key, value, string_agg(DISTINCT dataset_id, '|' ORDER BY dataset_id) AS datasets FROM {vocab_input} GROUP BY 1, 2")

# -- text that no expression reads ------------------------------------------------------------------------------------
query("mojibake", lambda t: t.documents.select("doc_id", T.repaired(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")).alias("r")).select("doc_id", "r.*").where("encoding is not null"))
query("mojibake_cells", lambda t: t.documents.select("doc_id", F.posexplode(F.split(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"), "\n")).alias("row", "line")).withColumn("r", T.repaired("line")).where("r.encoding is not null").select("doc_id", F.concat(X.column_letters(F.lit(2)), (F.col("row") + 2).cast("string")).alias("cell"), "r.repaired"))
query("canonical_number", lambda t: t.customer.select("c_custkey", T.canonical_number("c_acctbal").alias("number")), "SELECT c_custkey, printf('%.15g', CAST(c_acctbal AS DOUBLE)) AS number FROM customer")
query("text_nfc", lambda t: t.documents.select("doc_id", F.md5(T.nfc("text")).alias("md5")), "SELECT doc_id, md5(nfc_normalize(text)) AS md5 FROM documents")