"""Sheets: wide tables of text with display names, to and from cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.expr import blank, values_equal


def first_columns(df: DataFrame) -> DataFrame:
    """df with the first of columns of one name, and without nameless ones. Columns are renamed by position first."""
    names = df.columns
    keep = [i for i, n in enumerate(names) if n.strip() and n not in names[:i]]
    numbered = df.toDF(*[f"_{i}" for i in range(len(names))])
    return numbered.select(*[F.col(f"_{i}").alias(names[i]) for i in keep])


def pull(sheet: DataFrame, registry: DataFrame, tsid: str = "TSid", dataset: str = "datasetId") -> DataFrame:
    """Cells of a wide sheet: canonical names, no row without an id, blanks only for fields that curators may clear (present false)."""
    fields = [c for c in sheet.columns if c not in (tsid, dataset)]
    long = sheet.where(~blank(tsid)).select(F.col(tsid).alias("tsid"), F.col(dataset).alias("dataset_id"), *[F.col(c).cast("string").alias(c) for c in fields]).unpivot(["tsid", "dataset_id"], fields, "display", "value")
    rules = registry.select(F.col("qc_name").alias("display"), F.coalesce("canonical", "qc_name").alias("field"), "nullable").dropDuplicates(["display"])
    named = long.join(rules, "display", "left").withColumn("field", F.coalesce("field", "display"))
    kept = named.where(~blank("value") | F.coalesce("nullable", F.lit(False)))
    return kept.select("tsid", "field", F.when(~blank("value"), F.col("value")).alias("value"), (~blank("value")).alias("present"), "dataset_id")


def to_sheet(cells: DataFrame, fields: list[str], display: dict[str, str] | None = None) -> DataFrame:
    """A wide sheet with the given columns in order. The list of fields is given, so the pivot needs no extra pass."""
    display = display or {}
    once = cells.select("tsid", "dataset_id", "field", "value")
    ids = once.groupBy("tsid").agg(F.min("dataset_id").alias("datasetId"), *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(display.get(f, f)) for f in fields])
    return ids.withColumnRenamed("tsid", "TSid")


def push_block(cells: DataFrame, sheet: DataFrame, key: str = "TSid") -> DataFrame:
    """The sheet's rows and columns with the cells' values where they have one, else the sheet's own."""
    fields = [c for c in sheet.columns if c != key]
    wide = cells.groupBy(F.col("tsid").alias(key)).agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"_{f}") for f in fields])
    return sheet.join(wide, key, "left").select(key, *[F.coalesce(f"_{f}", f).alias(f) for f in fields])


def patch(cells: DataFrame, current: DataFrame) -> DataFrame:
    """Only the cells that differ from what the sheet shows. Both: tsid, field, value."""
    old = current.select("tsid", "field", F.col("value").alias("old_value"))
    return cells.select("tsid", "field", "value").join(old, ["tsid", "field"], "left").where(~values_equal("value", "old_value")).select("tsid", "field", "old_value", "value")


def patched(sheet: DataFrame, changes: DataFrame) -> DataFrame:
    """Cells of a sheet after changes: changed ones replaced, new ones added, others kept. Both: row, col, value."""
    kept = sheet.join(changes.select("row", "col"), ["row", "col"], "left_anti")
    return kept.select("row", "col", "value").union(changes.select("row", "col", "value"))


def compilation_sheet(cells: DataFrame, series: DataFrame, fields: list[str], compilation: str) -> DataFrame:
    """A sheet for a compilation's series and the flag of membership."""
    flags = series.select(F.col("tsid").alias("TSid"), F.when(F.array_contains("compilations", compilation), "TRUE").otherwise("FALSE").alias(f"in{compilation}")).distinct()
    return to_sheet(cells, fields).join(flags, "TSid", "left")


def runs(df: DataFrame, partition: str, order: str, group: str) -> DataFrame:
    """Runs of equal neighbours: first and last position and length of each."""
    w = Window.partitionBy(partition).orderBy(order)
    new = F.when(F.lag(group).over(w).eqNullSafe(F.col(group)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    numbered = df.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(partition, "run", group).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
