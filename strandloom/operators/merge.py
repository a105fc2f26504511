"""The three-way merge of stored, curated and source cells under per-field ownership.

base is the stored state, sheet what curators wrote, file what the documents say. Presence is carried by marker columns
made before the joins, so that an absent cell, a blank one and one with a value stay three different things.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.expr import blank, equal_parts, number, with_parts
from strandloom.operators.relational import first_per_key

CLEAR = "<<CLEAR>>"
KEYS = ("tsid", "field")
IN_PLAY = ("merged", "membership", "key")


def _sides(tagged: DataFrame) -> DataFrame:
    """One row a cell with every side's value and presence, by one shuffle."""
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return tagged.groupBy(*KEYS).agg(
        of("b", "value").alias("base"), of("s", "value").alias("sheet"), of("f", "value").alias("file"),
        F.max(F.col("side") == "s").alias("in_sheet"), F.max(F.col("side") == "f").alias("in_file"), F.max(F.col("side") == "b").alias("in_base"), of("f", "dataset_id").alias("dataset_id"),
    )


def duplicate_cells(cells: DataFrame) -> DataFrame:
    """Cells that a side holds more than once; they are to be reported before a merge."""
    return cells.groupBy(*KEYS).agg(F.count("*").alias("n")).where("n > 1")


def merge_three_way(base: DataFrame, sheet: DataFrame, file: DataFrame, registry: DataFrame, clear: str = CLEAR) -> DataFrame:
    """Every cell's resolution and value. Each side has a cell once at most (see duplicate_cells)."""
    tagged = reduce(DataFrame.unionByName, [df.select(*KEYS, "value", "dataset_id", F.lit(side).alias("side")) for side, df in (("b", base), ("s", sheet), ("f", file))])
    return _resolved(tagged, registry, clear)


def merge_with_itself(state: DataFrame, registry: DataFrame, clear: str = CLEAR) -> DataFrame:
    """The merge of a state with itself on all sides, which must change nothing; the state is computed once."""
    sides = F.explode(F.array(*[F.lit(s) for s in "bsf"])).alias("side")
    return _resolved(state.select(*KEYS, "value", "dataset_id", sides), registry, clear)


def _resolved(tagged: DataFrame, registry: DataFrame, clear: str) -> DataFrame:
    order = [c for c in ("group_order", "role") if c in registry.columns]
    first = first_per_key(registry, ["qc_name"], order)  # a doubled name must not double cells
    rules = first.select(F.col("qc_name").alias("field"), "role", "ownership", "nullable")
    cells = _sides(tagged).join(rules, "field", "left").withColumns({"known": F.col("role").isNotNull(), "nullable": F.coalesce("nullable", F.lit(False))})
    cells = cells.where(~F.col("known") | F.col("role").isin(*IN_PLAY))
    b, s, f, key, machine = F.col("base"), F.col("sheet"), F.col("file"), F.coalesce(F.col("role") == "key", F.lit(False)), F.coalesce(F.col("ownership") == "machine", F.lit(False))
    explicit = F.coalesce(s == clear, F.lit(False))
    clears = explicit | (F.col("in_sheet") & blank(s) & F.col("nullable") & ~blank(b))
    cells = cells.withColumns({"clears": clears, "s_eff": F.when(clears, F.lit(None)).when(blank(s), b).otherwise(s), "f_eff": F.when(blank(f), b).otherwise(f)})
    cells = with_parts(cells, "base", "s_eff", "f_eff")
    cells = cells.withColumns({"s_ch": ~equal_parts("s_eff", "base", ~key) & ~machine, "f_ch": ~equal_parts("f_eff", "base", ~key), "agree": equal_parts("s_eff", "f_eff", ~key)})
    resolution = (
        F.when(~F.col("s_ch") & ~F.col("f_ch"), "unchanged")
        .when(F.col("s_ch") & ~F.col("f_ch"), "sheet")
        .when(~F.col("s_ch") & F.col("f_ch"), "file")
        .when(F.col("agree"), "converged")
        .when(key, "error")
        .when(F.col("ownership") == "curator", "sheet")
        .when(machine, "file")
        .otherwise("conflict")
    )
    cells = cells.withColumn("resolution", resolution)
    value = F.when(F.col("resolution").isin("sheet", "converged"), F.col("s_eff")).when(F.col("resolution") == "file", F.col("f_eff")).otherwise(b)
    return cells.select(*KEYS, "dataset_id", "base", "sheet", "file", "known", F.col("clears").alias("cleared"), "resolution", value.alias("value"))


def plan_state(plan: DataFrame) -> DataFrame:
    return plan.where(~blank("value")).select(*KEYS, "value", "dataset_id")


def plan_summary(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count("*").alias("n_cells"),
        F.count_if(F.col("resolution").isin("sheet", "file", "converged")).alias("n_changed"),
        F.count_if(F.col("resolution") == "conflict").alias("n_conflicts"),
        F.count_if(F.col("resolution") == "error").alias("n_errors"),
        F.count_if("cleared").alias("n_cleared"),
        F.count_distinct(F.when(~F.col("known"), F.col("field"))).alias("n_unknown_fields"),
    )


def conflicts_by_field(plan: DataFrame) -> DataFrame:
    return plan.where("resolution = 'conflict'").groupBy("field").agg(F.count("*").alias("n"))


def check_plan(plan: DataFrame, strict: bool = False) -> None:
    """Raise if a key would change, or under strict if anything conflicts."""
    n = plan_summary(plan).first()
    if n["n_errors"] or strict and n["n_conflicts"]:
        raise ValueError(f"{n['n_errors']} key errors and {n['n_conflicts']} conflicts")


def write_set(plan: DataFrame, membership: str) -> DataFrame:
    """Cells to write into documents: what the sheet decided, but for membership."""
    return plan.where((F.col("resolution") == "sheet") & (F.col("field") != membership)).select(*KEYS, "value", "dataset_id")


def drop_cells(cells: DataFrame, issues: DataFrame) -> DataFrame:
    """Cells without quarantined ones."""
    return cells.join(issues.select(*KEYS).distinct(), list(KEYS), "left_anti")


def validate_values(cells: DataFrame, registry: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Issues for cells whose field asks for a number they don't spell, or whose number is out of its field's range."""
    order = [c for c in ("group_order", "role") if c in registry.columns]
    types = first_per_key(registry, ["qc_name"], order).select(F.col("qc_name").alias("field"), "type")
    typed = cells.join(types, "field", "left").withColumn("n", number("value"))  # ranges hold for unregistered fields, too
    outside = reduce(lambda a, b: a | b, [(F.col("field") == f) & ~F.col("n").between(low, high) for f, (low, high) in ranges.items()], F.lit(False))
    check = F.when(F.col("type").isin("numeric", "number") & F.col("n").isNull(), "not_a_number").when(outside, "out_of_range")
    return typed.where(~blank("value")).withColumn("check", check).where("check is not null").select("check", F.lit("error").alias("severity"), "tsid", "field", "value")


def inconsistent_fields(cells: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of dataset-wide fields that disagree inside a dataset."""
    wide = registry.where("cardinality = 'dataset'").select(F.col("qc_name").alias("field"))
    own = cells.join(wide, "field", "left_semi")
    differ = own.groupBy("dataset_id", "field").agg(F.count_distinct("value").alias("n_values")).where("n_values > 1")
    return own.join(differ, ["dataset_id", "field"]).select("dataset_id", "field", "tsid", "value", "n_values")


def collateral(touched: DataFrame, considered: DataFrame) -> DataFrame:
    """Datasets that a run touched without having considered them; should be empty."""
    return touched.select("dataset_id").distinct().join(considered.select("dataset_id"), "dataset_id", "left_anti")
