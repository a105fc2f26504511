"""Whole rows stay in the partitions that they were read in."""

import pytest
from pyspark.sql import functions as F

from strandloom.llm import decided, mixing
from strandloom.llm.common import staged


def test_mix_shuffles_no_whole_rows(spark, tmp_path, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df.union(df.limit(3)).repartition(3).write.parquet(f"file://{tmp_path}/docs")
    docs = spark.read.parquet(f"file://{tmp_path}/docs")
    mixed = mixing.mix(docs)
    assert "Exchange" not in mixed._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(decided, "reachable", lambda _: False)
    joined = mixing.mix(docs)
    assert mixed.exceptAll(joined).count() == 0 and joined.count() == mixed.count() > 0


def test_row_without_decision_is_an_error(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1).withColumn("part", decided.part())
    known = rows.where("doc_id = 1").selectExpr("part", "doc_id", "2 as copies")
    assert decided.taken(rows.where("doc_id = 1"), known, ["doc_id", "text"], ["doc_id"], "part", "text").count() == 2
    with pytest.raises(Exception, match="decisions were made"):
        decided.taken(rows, known, ["doc_id", "text"], ["doc_id"], "part", "text").count()


def test_mix_runs_no_python(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    mixed = mixing.mix(docs)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    got = sorted(map(repr, mixed.collect()))
    monkeypatch.setattr(decided, "HELD", 0)
    assert got == sorted(map(repr, mixing.mix(docs).collect())) and got


def test_place_without_its_decision_is_an_error(spark):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string").coalesce(3)
    mark = F.xxhash64("doc_id", "text")
    known = staged(rows.select(decided.part().alias("part"), decided.place().alias("place"), F.lit(2).alias("copies"), mark.alias("mark")), "known")
    assert sorted(r.doc_id for r in decided.repeated(rows, known, mark).collect()) == sorted([*range(50)] * 2)
    for wrong in (known.where("place < 5"), known.withColumn("mark", F.expr("mark + 1"))):
        with pytest.raises(Exception, match="decisions were made"):
            decided.repeated(rows, wrong, mark).count()
    with pytest.raises(Exception, match="more than 127 copies"):
        decided.repeated(rows, known.withColumn("copies", F.lit(128)), mark).count()
