"""Versions by sets of members: P_D_M moves P when published, D when the set changes, M otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.expr import set_digest, version_array, version_text

SHAPE = r"^[0-9]+_[0-9]+_[0-9]+$"


def tick(cases: DataFrame) -> DataFrame:
    """The next version from prev (null: none), before and now (arrays) and publish; added and removed members by count.

    A previous version of another shape is an error.
    """
    prev = F.when(F.col("prev").isNull() | F.col("prev").rlike(SHAPE), F.col("prev")).otherwise(F.raise_error(F.concat(F.lit("no version: "), F.col("prev"))))
    clean = lambda c: F.filter(F.array_distinct(c), lambda x: x.isNotNull())
    df = cases.withColumns({"v": version_array(prev, "_"), "b": clean("before"), "n": clean("now")})
    df = df.withColumns({"n_added": F.size(F.array_except("n", "b")).cast("long"), "n_removed": F.size(F.array_except("b", "n")).cast("long")})
    same = (F.col("n_added") == 0) & (F.col("n_removed") == 0)
    v = F.col("v")
    zero = F.lit(0)
    nxt = (
        F.when(F.col("publish"), F.array(F.coalesce(F.get(v, 0), zero) + 1, zero, zero))
        .when(F.col("prev").isNull(), F.array(zero, zero, F.lit(1)))
        .when(same, F.array(F.get(v, 0), F.get(v, 1), F.get(v, 2) + 1))
        .otherwise(F.array(F.get(v, 0), F.get(v, 1) + 1, zero))
    )
    return df.withColumn("version", version_text(nxt, "_")).drop("v", "b", "n")


def parse(df: DataFrame, column: str = "version") -> DataFrame:
    v = F.when(F.col(column).rlike(SHAPE), version_array(column, "_"))
    return df.select(column, *[F.get(v, i).alias(n) for i, n in enumerate(("publication", "dataset", "metadata"))])


def current(ledger: DataFrame) -> DataFrame:
    """The version appended last for each compilation, whatever its number."""
    return ledger.groupBy("compilation").agg(F.max_by("version", "ledger_seq").alias("version"))


def ledger_view(ledger: DataFrame) -> DataFrame:
    """The ledger with the member count's change since the version before."""
    w = Window.partitionBy("compilation").orderBy("ledger_seq")
    return ledger.select("compilation", "ledger_seq", "version", "n_members", (F.col("n_members") - F.coalesce(F.lag("n_members").over(w), F.lit(0))).alias("delta"))


def greatest(df: DataFrame, key: str, column: str = "version", separator: str = "[.]") -> DataFrame:
    """The greatest version of each key, number by number."""
    return df.groupBy(key).agg(F.max(version_array(column, separator)).alias("v")).select(key, version_text("v", "." if separator == "[.]" else "_").alias("version"))


def next_patch(df: DataFrame, key: str, column: str = "version") -> DataFrame:
    """The version after the greatest, by its last number; 1.0.0 where there is none."""
    top = df.groupBy(key).agg(F.max(version_array(column)).alias("v"))
    return top.select(key, F.when(F.col("v").isNull(), "1.0.0").otherwise(version_text(F.array(F.get("v", 0), F.get("v", 1), F.get("v", 2) + 1))).alias("version"))


def set_hashes(members: DataFrame, key: str, item: str) -> DataFrame:
    """A digest of each key's set of items."""
    return members.groupBy(key).agg(set_digest(F.collect_set(item)).alias("hash"))
