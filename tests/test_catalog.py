"""Every registered query against its SQL on the smallest tables, plus the plans that matter."""

import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from strandloom.functions import expr as X
from strandloom.plans.library import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
#: Compared with plain code in test_whole_texts.py and test_whole_archives.py, as SQL can't express them.
WITHOUT_SQL = {"mojibake", "mojibake_cells", "flatten_leaves"}
#: Queries that read zip files or need text functions which Spark lacks.
PYTHON = WITHOUT_SQL | {"canonical_number", "text_nfc", "value_hashes", "identity_extract", "verify_staged", "index_archives", "frame_archives", "apply_cells", "apply_issues", "assign_ids", "assign_issues", "standardize_archives"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert name in WITHOUT_SQL
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON))
def test_built_in_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan and "CartesianProduct" not in plan


def test_entry_and_guard(spark, monkeypatch):
    import builtins

    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    real = builtins.__import__

    def gone(name, *a, **k):
        if name.startswith("strandloom.llm") or name == "strandloom.llm" or (a and len(a) > 2 and a[2] and "queries" in a[2] and "llm" in name):
            raise ImportError(name)
        return real(name, *a, **k)

    monkeypatch.setattr(builtins, "__import__", gone)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)


def test_letters_and_numbers(spark):
    known = {1: "A", 26: "Z", 27: "AA", 52: "AZ", 702: "ZZ", 703: "AAA", 18278: "ZZZ"}
    df = spark.createDataFrame([(n,) for n in known], "n long").select("n", X.column_letters("n").alias("c"))
    assert {r.n: r.c for r in df.collect()} == known
    assert df.where(X.column_number("c") != F.col("n")).count() == 0


def test_wide_column_numbers(spark):
    known = {475254: "ZZZZ", 475255: "AAAAA", 1200000: "BPGCV", 2**53 + 3: "BKTXHSOGHKKI", 2**63 - 1: "CRPXNLSKVLJFHG", 0: "", None: None}
    assert {n: _letters(n) for n in known} == known
    df = spark.createDataFrame([(n,) for n in known], "n long").select("n", X.column_letters("n").alias("c"))
    assert {r.n: r.c for r in df.collect()} == known
    assert df.where(~X.column_number("c").eqNullSafe(F.col("n"))).count() == 0


def _letters(n):
    """The reference's loop."""
    out = ""
    while n and n > 0:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return None if n is None else out


def test_field_paths(spark):
    known = {"geo_latitude": ("geo", None, None, "latitude", "dataset"), "pub2_title": ("pub", 2, None, "title", "dataset"), "paleoData_units": ("column", None, None, "units", "column"), "climateInterpretation2_variable": ("interpretation", 2, "climate", "variable", "column"),
             "interpretation1_scope": ("interpretation", 1, None, "scope", "column"), "calibration_method": ("calibration", None, None, "method", "column"), "archiveType": ("root", None, None, "archiveType", "dataset")}
    df = spark.createDataFrame([(f,) for f in known], "f string").select("f", X.field_path("f").alias("p"))
    assert {r.f: (r.p.target, r.p["index"], r.p.scope, r.p.name, r.p.level) for r in df.collect()} == known
