"""Cells of whole datasets, and cells and ids written back into staged copies."""

import json

from strandloom.functions.text import six_digits
from strandloom.operators import dedupe, vocab
from strandloom.sources import archives, dataset_cells

REGISTRY = "qc_name string, role string, canonical string, group_order int"
META = {
    "dataSetName": "Lake.Author.2001", "datasetId": "D1", "archiveType": "Lake", "climateInterpretation1_variable": "old copy",
    "geo": {"siteName": "Deep", "geometry": {"type": "Point", "coordinates": [12.5, -45, 300]}},
    "pub": [{"doi": "10/x"}, {"doi": "10/y"}],
    "paleoData": [{
        "measurementTable": [{"columns": [
            {"TSid": "T1", "variableName": "temperature", "units": "degC", "calibration": {"method": "linear"}, "interpretation": [{"scope": "climate", "variable": "T"}, {"scope": "isotope", "variable": "d18O"}, {"scope": "Climate", "variable": "P"}, {"variable": "loose"}]},
            {"TSid": "T2", "variableName": "depth", "archiveType": "own"}, {"variableName": "no id"}]}],
        "model": [{"summaryTable": [{"columns": [{"TSid": "T3", "variableName": "fit"}]}]}],
    }],
    "chronData": [{"measurementTable": [{"columns": [{"TSid": "C1", "variableName": "age"}]}]}],
}


def registry(spark):
    fields = ["dataSetName", "archiveType", "geo_latitude", "geo_longitude", "geo_elevation", "geo_siteName", "pub1_doi", "pub2_doi", "paleoData_variableName", "paleoData_units", "climateInterpretation1_variable", "climateInterpretation2_variable", "isotopeInterpretation1_variable", "interpretation1_variable", "calibration_method", "TSid", "pub4_doi", "pub3_doi", "environmentInterpretation1_variable"]
    return spark.createDataFrame([(f, "key" if f == "TSid" else "merged", "site" if f == "geo_siteName" else None, i) for i, f in enumerate(fields)] + [("geo_type", "unused", None, 99)], REGISTRY)


def files(spark, *metas):
    rows = [(f"/x/{m['datasetId']}.lpd", archives.pack(m, {"d.csv": "1,2\n"})) for m in metas]
    return spark.createDataFrame([*rows, ("/x/bad.lpd", b"no zip")], "path string, content binary")


def test_frame_holds_every_kind_of_field(spark):
    rows = {(r.tsid, r.field): r.value for r in dataset_cells.frame(files(spark, META), registry(spark)).collect()}
    shared = {"dataSetName": "Lake.Author.2001", "archiveType": "Lake", "geo_longitude": "12.5", "geo_latitude": "-45", "geo_elevation": "300", "site": "Deep", "pub1_doi": "10/x", "pub2_doi": "10/y"}
    own = {"paleoData_variableName": "temperature", "paleoData_units": "degC", "calibration_method": "linear", "climateInterpretation1_variable": "T", "climateInterpretation2_variable": "P", "isotopeInterpretation1_variable": "d18O", "interpretation1_variable": "loose"}
    assert {f: v for (t, f), v in rows.items() if t == "T1"} == {**shared, **own}
    assert rows["T2", "archiveType"] == "own" and rows["T3", "paleoData_variableName"] == "fit" and not any(t == "C1" for t, _ in rows)
    assert dataset_cells.frame(files(spark, META).limit(0), registry(spark)).count() == 0


def test_cells_are_written_where_they_belong(spark):
    cells = [("T1", "paleoData_units", None), ("T1", "climateInterpretation2_variable", "Q"), ("T1", "environmentInterpretation1_variable", "E"), ("T2", "calibration_method", "m"), ("C1", "paleoData_units", "yr"), ("T1", "geo_latitude", "4.50"), ("T2", "geo_latitude", "4.50"),
             ("T1", "archiveType", "a"), ("T2", "archiveType", "b"), ("T1", "pub3_doi", "10/z"), ("T1", "geo_type", "x"), ("nowhere", "archiveType", "x"), ("T3", "paleoData_units", "TRUE")]
    source = files(spark, META)
    made, orphans = dataset_cells.apply_cells(source, spark.createDataFrame([(*c, "D1") for c in cells], "tsid string, field string, value string, dataset_id string"), registry(spark), archives.series(source))
    (row,) = made.collect()
    m = archives.metadata(bytes(row.content))
    t1, t2 = m["paleoData"][0]["measurementTable"][0]["columns"][:2]
    assert "units" not in t1 and [e.get("variable") for e in t1["interpretation"]] == ["T", "d18O", "Q", "loose", "E"] and t1["interpretation"][4]["scope"] == "environment"
    assert t2["calibration"] == {"method": "m"} and m["chronData"][0]["measurementTable"][0]["columns"][0]["units"] == "yr"
    assert m["geo"]["latitude"] == 4.5 and m["archiveType"] == "Lake" and m["pub"][2] == {"doi": "10/z"}
    assert sorted((i.check, i.tsid, i.field) for i in row.issues) == [("dataset_field_disagrees", "T1", "archiveType"), ("dataset_field_disagrees", "T2", "archiveType"), ("tsid_not_in_dataset", "T3", "paleoData_units")]
    assert [(r.check, r.tsid) for r in orphans.collect()] == [("tsid_not_in_database", "nowhere")]
    assert archives.data_members(bytes(row.content)) == {"d.csv": [["1", "2"]]}


def test_values_become_what_documents_hold():
    known = {"TRUE": True, "true": "true", "5": 5, "-5.25": -5.25, " 7 ": 7, "1e3": 1000, "1.2.3": "1.2.3", "NA": "NA", "": ""}
    assert {k: dataset_cells.coerce_value(k) for k in known} == known and dataset_cells.coerce_value(None) is None


def test_ids_are_assigned_only_where_the_plan_fits(spark, tmp_path):
    other = json.loads(json.dumps(META)) | {"datasetId": None, "dataSetName": "Other"}
    source = spark.createDataFrame([("/x/a.lpd", archives.pack(META)), ("/x/b.lpd", archives.pack(other)), ("/x/c.lpd", b"no zip")], "path string, content binary")
    walk = dataset_cells.walked(source)
    assert [(r.position, r.variable) for r in walk.where("path = '/x/a.lpd'").orderBy("position").collect()] == [(1, "temperature"), (2, "depth"), (3, "no id"), (4, "fit"), (5, "age")]
    plan = walk.selectExpr("path", "position", "variable", "'mint' as action", "case when position = 3 then 'NEW' end as new_tsid").where("not (path = '/x/a.lpd' and position = 5)")
    rows = {r.path: r for r in dataset_cells.assign_ids(source, plan.union(spark.createDataFrame([("/x/c.lpd", 1, "v", "mint", None)], plan.schema)), "r1").collect()}
    assert [(p, rows[p].content is None, [i.check for i in rows[p].issues]) for p in sorted(rows)] == [("/x/a.lpd", True, ["structure_mismatch"]), ("/x/b.lpd", False, []), ("/x/c.lpd", True, ["unreadable"])]
    m = archives.metadata(bytes(rows["/x/b.lpd"].content))
    assert m["paleoData"][0]["measurementTable"][0]["columns"][2]["TSid"] == "NEW" and m["datasetId"].startswith("SLD")
    made = dataset_cells.assign_ids(source, plan, "r1")
    assert dataset_cells.stage(made, f"file://{tmp_path}/staged") == 1
    assert [r.datasetId for r in archives.identities(archives.read_archives(spark, f"file://{tmp_path}/staged")).collect()] == [m["datasetId"]]


def test_standardized_archives_hold_the_new_values(spark):
    table = spark.createDataFrame([("units", "degC", "celsius"), ("units", "celsius", "kelvin")], "field string, value string, new_value string")
    made, changes = dataset_cells.standardize_archives(files(spark, META), table)
    assert [tuple(r) for r in changes.collect()] == [("/x/D1.lpd", "T1", "units", "degC", "celsius")]
    staged = {r.path: r.content for r in made.collect()}
    assert archives.metadata(bytes(staged["/x/D1.lpd"]))["paleoData"][0]["measurementTable"][0]["columns"][0]["units"] == "celsius" and staged["/x/bad.lpd"] is None


def test_small_values_have_hashes_of_their_own(spark):
    rows = [("a", "v", [k * 1e-4 for k in range(30)]), ("b", "v", [k * 1.5e-4 for k in range(30)]), ("c", "v", [k * 1e-4 * (1 + 1e-9) for k in range(30)]), ("d", "Age", [float(k) for k in range(30)])]
    got = {r.dataset_id: r.hash for r in dedupe.value_hashes(spark.createDataFrame(rows, "dataset_id string, variable string, vals array<double>")).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"] == got["c"] != got["b"]
    assert spark.createDataFrame([([1e-7, 123456.7, 2.0],)], "v array<double>").select(six_digits("v").alias("t")).first().t == "1e-07,123457,2"


def test_canonical_spellings_are_candidates(spark):
    terms = spark.createDataFrame([("k", "LakeSediment", "Lagoon", 1), ("k", "deleteMe", "LakeSedimentx", 2), ("k", "Wood", None, 3)], "vocab_key string, name string, synonym string, place int")
    got = vocab.candidates(spark.createDataFrame([("k", "LakeSedimentt")], "vocab_key string, value string"), terms).orderBy("place").collect()
    assert [r.name for r in got] == ["LakeSediment", "Wood"] and got[0].score < 0
