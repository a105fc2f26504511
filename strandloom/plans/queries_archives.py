"""Queries over whole dataset archives: cells out of them, cells and ids back into staged copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.plans.catalog import query
from strandloom.sources import archives, dataset_cells

REGISTRY = """select * from (values ('dataSetName', 'merged', '', 1), ('archiveType', 'merged', '', 2), ('geo_latitude', 'merged', '', 3), ('geo_siteName', 'merged', 'site', 4), ('pub1_title', 'merged', '', 5), ('pub2_title', 'merged', '', 6),
  ('pub4_title', 'merged', '', 7), ('paleoData_variableName', 'merged', '', 8), ('paleoData_units', 'merged', '', 9), ('TSid', 'key', '', 10), ('paleoData_notes', 'unused', '', 11)) as r(qc_name, role, canonical, group_order)"""

# What archives.packed() makes of each document: its words, how many columns they become, and which archives are damaged.
DOCS = r"""WITH d AS (SELECT doc_id AS i, lang, source, list_slice(regexp_extract_all(coalesce(text, ''), '[^\s\x0b\x1c-\x1f]+'), 1, 5) AS words FROM documents),
  p AS (SELECT *, '/' || i || '.lpd' AS path, 'ID' || i AS ident, i % 29 = 0 AS bad, CAST(least(1 + i % 3, len(words)) AS BIGINT) AS n, CASE WHEN i % 23 = 0 THEN CAST(NULL AS VARCHAR) ELSE 'S' || i || '.Author.' || (1990 + i % 30) END AS own_name FROM d),
  k AS (SELECT p.*, g AS k, 'T' || i || '-' || (g - 1) AS tsid FROM p, unnest(range(1, n + 1)) AS u(g) WHERE NOT bad)"""


def cells_sql(fields: dict[str, str]) -> str:
    """Rows of the frame from a field's value by the columns of k."""
    return " UNION ALL ".join(f"SELECT tsid, '{f}' AS field, CAST({v} AS VARCHAR) AS value, ident AS dataset_id FROM k WHERE coalesce(CAST({v} AS VARCHAR), '') <> ''" for f, v in fields.items())


def packed(t):
    return archives.packed(t.documents)


query("identity_extract", lambda t: archives.identities(packed(t)), f"""{DOCS} SELECT path, CASE WHEN NOT bad THEN own_name END AS "dataSetName", CASE WHEN NOT bad THEN ident END AS "datasetId", CASE WHEN NOT bad THEN '1.0.' || greatest(i % 12, 3) END AS "datasetVersion",
  CASE WHEN NOT bad AND lang <> '' THEN lang END AS "archiveType", CASE WHEN bad THEN 0 ELSE n END AS n_ts, CASE WHEN bad THEN 'BadZipFile: File is not a zip file' END AS parse_error FROM p""")
query("verify_staged", lambda t: archives.verify(packed(t)), f"""{DOCS} SELECT path, 'too_small' AS "check", '9' AS value FROM p WHERE bad UNION ALL SELECT path, 'unreadable', 'File is not a zip file' FROM p WHERE bad UNION ALL SELECT path, 'no_name', NULL FROM p WHERE NOT bad AND i % 23 = 0
  UNION ALL SELECT path, 'no_geo', NULL FROM p WHERE NOT bad AND i % 19 = 0 UNION ALL SELECT path, 'author_not_listed', NULL FROM p WHERE NOT bad AND i % 17 = 0 AND source IS NOT NULL UNION ALL SELECT path, 'few_columns', NULL FROM p WHERE NOT bad AND n < 2""")
query("index_archives", lambda t: archives.series(packed(t)).select("path", "datasetId", "TSid", "variableName", F.array_join("compilations", ",").alias("compilations")), f"""{DOCS} SELECT path, ident AS "datasetId", tsid AS "TSid", words[k] AS "variableName", coalesce(source, '') AS compilations FROM k""")
query("frame_archives", lambda t: dataset_cells.frame(packed(t), t.rows(REGISTRY)), f"""{DOCS} {cells_sql({"dataSetName": "coalesce(own_name, CAST(i AS VARCHAR))", "archiveType": "lang", "geo_latitude": "CASE WHEN i % 19 <> 0 THEN i % 90 END", "site": "CASE WHEN i % 19 <> 0 THEN source END", "pub1_title": "array_to_string(words, ' ')", "paleoData_variableName": "words[k]"})}""")
CELLS = """select tsid, field, value, cast(null as string) as dataset_id from (select 'T' || cast(doc_id as string) || '-0' as tsid, doc_id from {documents}) d cross join
  (select * from (values ('archiveType'), ('paleoData_units'), ('pub2_title'), ('pub4_title'), ('paleoData_notes')) as f(field)) f
  join (select doc_id as id, 'archiveType' as f2, 'Arch' || cast(doc_id % 7 as string) as value from {documents} union all select doc_id, 'paleoData_units', case when doc_id % 3 <> 0 then cast(doc_id % 10 as string) || '.5' end from {documents}
  union all select doc_id, 'pub2_title', 'Second' from {documents} union all select doc_id, 'pub4_title', 'far' from {documents} union all select doc_id, 'paleoData_notes', 'unused' from {documents}) v on v.id = d.doc_id and v.f2 = f.field"""


def applied(t):
    files = packed(t)
    return dataset_cells.apply_cells(files, t.rows(CELLS), t.rows(REGISTRY), archives.series(files))


query("apply_cells", lambda t: dataset_cells.frame(applied(t)[0].where("content is not null"), t.rows(REGISTRY)).where("field in ('archiveType', 'paleoData_units', 'pub2_title', 'pub4_title')"), f"""{DOCS} {cells_sql({"archiveType": "'Arch' || i % 7", "paleoData_units": "CASE WHEN k = 1 AND i % 3 <> 0 THEN i % 10 || '.5' END", "pub2_title": "'Second'"})}""")
query("apply_issues", lambda t: applied(t)[0].select("path", F.inline("issues")).select("path", "check", "field").unionByName(applied(t)[1].select(F.lit(None).cast("string").alias("path"), "check", "field")), f"""{DOCS} SELECT path, 'pub_index_gap' AS "check", 'pub4_title' AS field FROM p WHERE NOT bad AND n > 0
  UNION ALL SELECT NULL, 'tsid_not_in_database', f FROM p, unnest(['archiveType', 'paleoData_units', 'pub2_title', 'pub4_title']) AS u(f) WHERE bad OR n = 0""")


def assigned(t):
    files = packed(t)
    doc = F.regexp_extract("path", "([0-9]+)", 1).cast("long")
    plan = dataset_cells.walked(files).select("path", "position", F.when(doc % 7 == 0, F.concat("variable", F.lit("x"))).otherwise(F.col("variable")).alias("variable"), F.when(doc % 11 == 0, "error").otherwise("mint").alias("action"), F.concat(F.lit("N-"), F.col("position").cast("string")).alias("new_tsid"))
    return dataset_cells.assign_ids(files, plan, "run1")


query("assign_ids", lambda t: dataset_cells.walked(assigned(t).where("content is not null")), f"{DOCS} SELECT path, k AS position, words[k] AS variable, 'N-' || k AS tsid FROM k WHERE i % 7 <> 0 AND i % 11 <> 0")
query("assign_issues", lambda t: assigned(t).select("path", F.inline("issues")).select("path", "check", "severity"), f"""{DOCS} SELECT path, 'structure_mismatch' AS "check", 'error' AS severity FROM p WHERE NOT bad AND n > 0 AND i % 7 = 0 AND i % 11 <> 0""")
RULES = "select * from (values ('variableName', 'The', 'Definite'), ('variableName', 'In', 'Inside'), ('variableName', 'By', 'Near'), ('units', 'x', 'y')) as r(field, value, new_value)"
query("standardize_archives", lambda t: dataset_cells.standardize_archives(packed(t), t.rows(RULES))[1], f"{DOCS} SELECT path, tsid, 'variableName' AS field, words[k] AS value, CASE words[k] WHEN 'The' THEN 'Definite' WHEN 'In' THEN 'Inside' ELSE 'Near' END AS new_value FROM k WHERE words[k] IN ('The', 'In', 'By')")
