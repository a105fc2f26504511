"""The field registry: rules, synonyms and their checks. Dimension tables join without hints; Spark broadcasts by size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.expr import blank

# Roles of fields.
ROLES = ("merged", "membership", "csm", "csm_pending", "key", "synonym", "control", "unused", "delete")
OWNERS = ("curator", "machine", "shared", "key")


def first_rule(registry: DataFrame) -> DataFrame:
    """The first row of each field name, by registry order."""
    w = Window.partitionBy("qc_name").orderBy("group_order", "role")
    return registry.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def field_rule(fields: DataFrame, registry: DataFrame) -> DataFrame:
    rules = first_rule(registry).select(F.col("qc_name").alias("field"), "role", "ownership", "nullable")
    return fields.join(rules, "field", "left").select("field", "role", "ownership", F.coalesce("nullable", F.lit(False)).alias("nullable"), F.col("role").isNotNull().alias("known"))


def canonical_field(fields: DataFrame, registry: DataFrame) -> DataFrame:
    """Synonyms become the canonical name, other names stay."""
    names = first_rule(registry).where(~blank("canonical")).select(F.col("qc_name").alias("field"), "canonical")
    return fields.join(names, "field", "left").select("field", F.coalesce("canonical", "field").alias("canonical"))


def display_field(fields: DataFrame, registry: DataFrame) -> DataFrame:
    """The alias of a canonical name that most sheets fill, else the name itself."""
    w = Window.partitionBy("canonical").orderBy(F.desc("n_filled"), "qc_name")
    best = registry.where(~blank("canonical")).withColumn("_r", F.row_number().over(w)).where("_r = 1").select(F.col("canonical").alias("field"), F.col("qc_name").alias("display"))
    return fields.join(best, "field", "left").select("field", F.coalesce("display", "field").alias("display"))


def violations(registry: DataFrame) -> DataFrame:
    """Rows that break a rule of the registry itself: (rule, qc_name)."""
    names = registry.select(F.col("qc_name").alias("canonical")).distinct()
    twice = registry.groupBy("qc_name").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_name").alias("rule"), "qc_name")
    orphans = registry.where((F.col("role") == "synonym") & ~blank("canonical")).join(names, "canonical", "left_anti").select(F.lit("orphan_synonym").alias("rule"), "qc_name")
    tests = {
        "bad_role": ~F.coalesce(F.col("role").isin(*ROLES), F.lit(False)),
        "bad_ownership": F.col("ownership").isNotNull() & ~F.col("ownership").isin(*OWNERS),
        "nullable_not_curator": F.coalesce(F.col("nullable"), F.lit(False)) & ~F.col("ownership").eqNullSafe(F.lit("curator")),
        "csm_without_key": (F.col("role") == "csm") & ~F.coalesce(F.col("csm_flat_key").rlike("^[A-Za-z0-9]+_csm_.+$"), F.lit(False)),
    }
    found = F.filter(F.array(*[F.when(test, F.lit(rule)) for rule, test in tests.items()]), lambda x: x.isNotNull())
    return registry.select(F.explode(found).alias("rule"), "qc_name").union(twice).union(orphans)


def build(ownership: DataFrame, usage: DataFrame) -> DataFrame:
    """A registry from ownership decisions and usage counts: role and group by ordered rules."""
    joined = usage.join(ownership, "qc_name", "left")
    name, own = F.col("qc_name"), F.col("ownership")
    role = F.when(name == "TSid", "key").when(name.startswith("in"), "membership").when(own == "none", "unused").when(F.col("n_filled") == 0, "unused").when(own.isNull(), "control").otherwise("merged")
    group = F.when(name.rlike("(?i)interpretation"), "interpretation").when(name.rlike("^geo_"), "geo").when(name.rlike("^pub[0-9]*_"), "pub").when(name.rlike("^(paleo|chron)Data_"), "data").otherwise("root")
    return joined.select("qc_name", role.alias("role"), own.alias("ownership"), group.alias("group"), "n_filled")


def column_order(fields: DataFrame, registry: DataFrame) -> DataFrame:
    """Fields with their place in a sheet: by group order as a number, unknown last, then by name."""
    known = first_rule(registry).select(F.col("qc_name").alias("field"), "group_order")
    joined = fields.join(known, "field", "left")
    place = F.row_number().over(Window.orderBy(F.col("group_order").cast("int").asc_nulls_last(), "field"))  # a few hundred field names
    return joined.select("field", "group_order", place.cast("long").alias("place"))
