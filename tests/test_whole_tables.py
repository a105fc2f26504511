"""Whole-table queries compare rows that fixed ids would leave out."""

import pytest
from pyspark.sql import functions as F

from strandloom.functions import expr as X
from strandloom.operators import dedupe
from strandloom.plans.library import QUERIES


@pytest.fixture
def folder(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/{name}.parquet")
        return f"file://{tmp_path}"

    return write


def test_late_orders_are_compared(spark, folder):
    lines = [(70000, 1), (70000, 2), (70001, 1), (70001, 2), (70001, 3), (70003, 9)]
    at = folder("lineitem", lines, "l_orderkey long, l_partkey long")
    assert [tuple(r) for r in QUERIES["jaccard_pairs"](spark, at).collect()] == [(70000, 70001, 0.666667)]
    got = sorted((r.new_id, r.old_id, r.n_shared, r.containment, r.same_name, r.disposition) for r in QUERIES["duplicate_screen"](spark, at).collect())
    assert got == [("O70000", "O70000", 2, 1.0, True, "already_present"), ("O70000", "O70001", 2, 1.0, False, "already_present")]


def test_all_sites_are_paired(spark, folder):
    folder("supplier", [(5, "x", 1)], "s_suppkey long, s_name string, s_nationkey long")
    at = folder("customer", [(20, "x", 1), (31, "x", 1), (42, "y", 1)], "c_custkey long, c_mktsegment string, c_nationkey long")
    wanted = {("c20", "c31"), ("c20", "s5"), ("c31", "s5")}
    assert {(r.id, r.id_b) for r in QUERIES["interval_overlap"](spark, at).collect()} == wanted
    assert {(r.id, r.id_b) for r in QUERIES["haversine_pairs"](spark, at).collect()} == wanted | {(i, "origin") for i in ("c20", "c31", "c42", "s5")}


def test_rows_of_one_key_meet_in_many_tasks(spark, folder, tmp_path):
    folder("supplier", [], "s_suppkey long, s_name string, s_nationkey long")
    at = f"file://{tmp_path}"
    spark.range(2500).selectExpr("id as c_custkey", "'x' as c_mktsegment", "id % 25 as c_nationkey").coalesce(1).write.parquet(f"{at}/customer.parquet")
    for name in ("haversine_pairs", "interval_overlap"):
        pairs = QUERIES[name](spark, at).where("id_b <> 'origin'")
        assert pairs.where("id < id_b").select("id", "id_b").distinct().count() == pairs.count() == 2500 * 2499 // 2
        assert pairs.select(F.spark_partition_id()).distinct().count() > 1


def test_pairs_of_a_key_by_plain_join(spark):
    rows = [(f"r{i % 40}", "k" if i % 3 else "m", float(i)) for i in range(60)] + [("z", None, 1.0), (None, "k", 1.0)]
    df = spark.createDataFrame(rows, "id string, name string, v double")
    got = dedupe.key_pairs(df, "name", lambda a, b: F.abs(F.col(a("v")) - F.col(b("v"))), block=7)
    wanted = [(a[0], b[0], abs(a[2] - b[2])) for a in rows for b in rows if a[0] and b[0] and a[0] < b[0] and a[1] and a[1] == b[1]]
    assert sorted(tuple(r) for r in got.collect()) == sorted(wanted)


def records_shuffled(spark):
    """Records written to shuffles by all stages of the session so far."""
    sc = spark.sparkContext
    listed = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(listed.apply(i).shuffleWriteRecords() for i in range(listed.size()))


def test_rows_of_one_key_are_not_copied_for_each_block(spark):
    df = spark.range(2000).selectExpr("concat('r', id) as id", "'k' as name", "cast(id as double) as v")
    before = records_shuffled(spark)
    pairs = dedupe.key_pairs(df, "name", lambda a, b: F.abs(F.col(a("v")) - F.col(b("v"))), block=50)
    assert pairs.count() == 2000 * 1999 // 2
    assert 2000 <= records_shuffled(spark) - before < 5 * 2000


def test_overlaps_of_many_blocks_shuffle_rows_not_copies(spark, folder, tmp_path):
    folder("supplier", [], "s_suppkey long, s_name string, s_nationkey long")
    at = f"file://{tmp_path}"
    spark.range(9000).selectExpr("id as c_custkey", "'x' as c_mktsegment", "id % 25 as c_nationkey").coalesce(1).write.parquet(f"{at}/customer.parquet")
    before = records_shuffled(spark)
    assert QUERIES["interval_overlap"](spark, at).selectExpr("count(*) as n", "count_if(id < id_b) as m").first() == (9000 * 8999 // 2,) * 2
    assert records_shuffled(spark) - before < 5 * 9000


def test_rounded_doubles(spark):
    known = {0.0078125: 0.007813, 2.0: 2.0, 1e300: 1e300, float("inf"): float("inf"), None: None}
    df = spark.createDataFrame([(x,) for x in known], "x double").select("x", X.rounded("x", 6).alias("y"))
    assert {r.x: r.y for r in df.collect()} == known


def test_late_orders_are_offered(spark, folder):
    at = folder("orders", [(70001, 1), (70002, 1)], "o_orderkey long, o_custkey long")
    assert {r.name for r in QUERIES["offer"](spark, at).collect()} == {"N70001", "N70002"}


def test_pairs_of_blocks_are_written_in_runs(spark, tmp_path):
    df = spark.range(6000).selectExpr("concat('r', id * 7919 % 6000) as id", "'k' as name", "cast(id % 2 as double) as v")
    pairs = dedupe.key_pairs(df, "name", lambda a, b: F.col(a("v")) + F.col(b("v")), block=1000)
    pairs.write.parquet(str(tmp_path / "pairs"))
    size = sum(p.stat().st_size for p in (tmp_path / "pairs").rglob("*.parquet"))
    assert spark.read.parquet(str(tmp_path / "pairs")).count() == 6000 * 5999 // 2
    assert size < 1.5 * 6000 * 5999 / 2  # bytes a pair
