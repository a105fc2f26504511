"""Relational building blocks with the semantics that the domain operators lean on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_true(df: DataFrame, test: Column) -> DataFrame:
    """Rows for which the test is true; null counts as false."""
    return df.where(F.coalesce(test, F.lit(False)))


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by a stated total order."""
    return head_per_key(df, keys, order, 1)


def head_per_key(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def lookup_first(df: DataFrame, table: DataFrame, key: str, order: list) -> DataFrame:
    """A left join with the first row of the table for each key; null where there is none, and never more rows."""
    return df.join(first_per_key(table, [key], order), key, "left")


def set_delta(before: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """Items added, removed and kept between two sets."""
    b = before.select(*keys).distinct().withColumn("_b", F.lit(True))
    n = now.select(*keys).distinct().withColumn("_n", F.lit(True))
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_n").isNull(), "removed").otherwise("kept")
    return b.join(n, keys, "full_outer").select(*keys, change.alias("change"))


def top_counts(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent values of a column; a report, so limited."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def sorted_set(df: DataFrame, key: str, item: str, separator: str = ", ") -> DataFrame:
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.col(item).cast("string"))), separator).alias("items"))


def examples(df: DataFrame, key: str, item: str, n: int = 4) -> DataFrame:
    """The n smallest distinct items of each key, found without listing all of them."""
    once = df.select(key, item).where(F.col(item).isNotNull()).distinct()
    few = head_per_key(once, [key], [item], n)
    return few.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.col(item).cast("string"))), " | ").alias("examples"))


def quota_sample(df: DataFrame, key: str, quotas: list[tuple[str, Column, int]], rank: Column) -> DataFrame:
    """For each quota in turn its first rows by rank among those that meet its condition and that no earlier quota took."""
    taken = None
    for reason, test, n in quotas:
        pool = keep_true(df, test) if taken is None else keep_true(df, test).join(taken.select(key), key, "left_anti")
        picked = pool.orderBy(rank, key).limit(n).select(key, F.lit(reason).alias("reason"))
        taken = picked if taken is None else taken.unionByName(picked)
    return taken
