"""Nested dataset documents: walking their column tree, flattening to cells, membership, diffs and changelogs.

A document row: dataset_id, name, and `blocks`: array of (kind, tables: array of (name, columns: array of (tsid,
variable, units, compilations))). Trees are taken apart with posexplode, so positions are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.expr import blank, field_path, values_equal


def walk_columns(documents: DataFrame, with_id_only: bool = True) -> DataFrame:
    """One row for each column of each table of each block, with 1-based positions."""
    b = documents.select("dataset_id", "name", F.posexplode("blocks").alias("block_pos", "block"))
    t = b.select("dataset_id", "name", "block_pos", F.col("block.kind").alias("kind"), F.posexplode("block.tables").alias("table_pos", "table"))
    c = t.select("dataset_id", "name", "block_pos", "kind", "table_pos", F.posexplode("table.columns").alias("column_pos", "c"))
    rows = c.select("dataset_id", "name", "kind", *[(F.col(p) + 1).cast("long").alias(p) for p in ("block_pos", "table_pos", "column_pos")], F.col("c.tsid").alias("tsid"), F.col("c.variable").alias("variable"), F.col("c.units").alias("units"), F.col("c.compilations").alias("compilations"))
    return rows.where(~blank("tsid")) if with_id_only else rows.where(~blank("variable"))


def column_compilations(series: DataFrame) -> DataFrame:
    """Each series' distinct, non-null compilation names."""
    return series.select("tsid", F.array_join(F.array_sort(F.array_distinct(F.filter("compilations", lambda x: x.isNotNull()))), ",").alias("compilations"))


def members_of(series: DataFrame, compilation: str) -> DataFrame:
    return series.where(F.array_contains("compilations", compilation)).select("tsid", "dataset_id").distinct()


def membership_frame(series: DataFrame, compilation: str) -> DataFrame:
    """A TRUE or FALSE cell for each series."""
    value = F.when(F.array_contains("compilations", compilation), "TRUE").otherwise("FALSE")
    return series.select("tsid", F.lit(f"in{compilation}").alias("field"), value.alias("value"), "dataset_id")


def considered_datasets(tab: DataFrame, datasets: DataFrame) -> DataFrame:
    """Datasets of a membership tab that aren't explicitly false, and whether they exist. tab: name, include."""
    state = F.when(F.coalesce(F.lower(F.trim("include")), F.lit("")) == "false", "excluded").when(F.col("there").isNull(), "missing").otherwise("considered")
    return tab.join(datasets.select("name", F.lit(True).alias("there")).distinct(), "name", "left").select("name", state.alias("state"))


def membership_delta(cells: DataFrame, members: DataFrame) -> DataFrame:
    """Series to add (literal TRUE, no member yet) and to drop (literal FALSE, member). Blank says nothing."""
    joined = cells.select("tsid", "value").join(members.select("tsid", F.lit(True).alias("member")), "tsid", "left")
    change = F.when((F.col("value") == "TRUE") & F.col("member").isNull(), "add").when((F.col("value") == "FALSE") & F.col("member").isNotNull(), "drop")
    return joined.select("tsid", change.alias("change")).where("change is not null")


def apply_membership(series: DataFrame, delta: DataFrame, compilation: str) -> DataFrame:
    """Series with the compilation added to or dropped from their list; an emptied list becomes null."""
    joined = series.join(delta, "tsid", "left")
    name, old = F.lit(compilation), F.coalesce("compilations", F.expr("cast(array() as array<string>)"))
    new = F.when(F.col("change") == "add", F.array_append(old, name)).when(F.col("change") == "drop", F.filter(old, lambda x: x != name)).otherwise(old)
    return joined.withColumn("compilations", F.when(F.size(new) > 0, new)).select(*series.columns)


def create_compilation(series: DataFrame, tsids: DataFrame, compilation: str) -> DataFrame:
    """What adding a compilation to listed series does: added, already in, or unknown."""
    known = series.select("tsid", F.coalesce(F.array_contains("compilations", compilation), F.lit(False)).alias("member"))  # a null entry would make it null
    outcome = F.when(F.col("member").isNull(), "unknown").when(F.col("member"), "already").otherwise("added")
    return tsids.select("tsid").distinct().join(known, "tsid", "left").select("tsid", outcome.alias("outcome"))


def offer(tab: DataFrame, names: DataFrame) -> DataFrame:
    """The tab with names it doesn't list yet appended, undecided."""
    new = names.select("name").distinct().join(tab.select("name"), "name", "left_anti")
    return tab.select("name", "include").union(new.select("name", F.lit(None).cast("string")))


def frame_cells(documents: DataFrame, registry: DataFrame) -> DataFrame:
    """Cells of the paleo series' names and units for fields in the registry; the name is repeated for each series; first row wins.

    For documents in this nested form only; sources/dataset_cells.py takes every field out of archives.
    """
    rows = walk_columns(documents).where("kind = 'paleo'")
    wide = rows.select("tsid", "dataset_id", "block_pos", "table_pos", "column_pos", F.col("name").alias("dataSetName"), F.col("variable").alias("paleoData_variableName"), F.col("units").alias("paleoData_units"))
    first = Window.partitionBy("tsid").orderBy("block_pos", "table_pos", "column_pos", "dataset_id")
    once = wide.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    long = once.unpivot(["tsid", "dataset_id"], ["dataSetName", "paleoData_variableName", "paleoData_units"], "field", "value")
    return long.join(registry.select(F.col("qc_name").alias("field")).distinct(), "field", "left_semi").where(~blank("value")).select("tsid", "field", "value", "dataset_id")


def route_cells(cells: DataFrame) -> DataFrame:
    """Where each cell goes in its document."""
    return cells.withColumn("p", field_path("field")).select("dataset_id", "tsid", "field", "value", F.col("p.target").alias("target"), F.col("p.index").alias("index"), F.col("p.scope").alias("scope"), F.col("p.name").alias("name"), F.col("p.level").alias("level"))


def dataset_field_disagrees(cells: DataFrame) -> DataFrame:
    """Dataset-level fields whose cells disagree inside a dataset; they aren't written."""
    routed = route_cells(cells).where("level = 'dataset'")
    return routed.groupBy("dataset_id", "field").agg(F.count_distinct("value").alias("n_values"), F.count("*").alias("n_cells")).where("n_values > 1")


def scope_ordinals(entries: DataFrame) -> DataFrame:
    """The running number of each entry inside its own scope. entries: tsid, pos, scope."""
    return entries.withColumn("index", F.row_number().over(Window.partitionBy("tsid", "scope").orderBy("pos")).cast("long"))


def interpretation_slot(entries: DataFrame, wanted: DataFrame) -> DataFrame:
    """Position of the n-th entry of a scope, or null if there is none. wanted: tsid, scope, index."""
    return wanted.join(scope_ordinals(entries), ["tsid", "scope", "index"], "left").select("tsid", "scope", "index", "pos")


def leaf_diff(old: DataFrame, new: DataFrame, keys=("dataset", "tsid", "path")) -> DataFrame:
    """differs, only_old or only_new for leaves of two corpora; null keys are equal. Decided by the values' nullness."""
    o, n = old.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("value").alias("old_value")), new.select(*[F.col(k).alias(f"n_{k}") for k in keys], F.col("value").alias("new_value"))
    same = None
    for k in keys:
        test = F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}"))
        same = test if same is None else same & test
    kind = F.when(F.col("old_value").isNull(), "only_new").when(F.col("new_value").isNull(), "only_old").otherwise("differs")
    both = o.join(n, same, "full_outer").where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    return both.select(*[F.coalesce(f"o_{k}", f"n_{k}").alias(k) for k in keys], "old_value", "new_value", kind.alias("kind"))


def leaf_summary(diff: DataFrame, top: int = 15) -> DataFrame:
    """The most frequent paths of each kind; a report, so limited."""
    return diff.groupBy("kind", "path").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind", "path").limit(top)


def ignore_paths(leaves: DataFrame, patterns: list[str]) -> DataFrame:
    """Leaves whose path matches none of the patterns."""
    return leaves.where(~F.coalesce(F.col("path").rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False)))


# Fields that change on every run. A corpus that also stores a link to its own web site adds that field's name.
VOLATILE = ("changelog", "tagMD5", "measurementTableMD5", "paleoMeasurementTableMD5", "dataMD5", "datasetVersion", "googleMetadataWorksheet", "googleSpreadSheetKey", "googleWorkSheetKey")


def changelog_diff(old: DataFrame, new: DataFrame, volatile=VOLATILE) -> DataFrame:
    """added, removed or changed cells between two versions of a document, by the tolerant equality, but for volatile fields. Both: path, field, value."""
    o, n = old.select("path", F.col("field").alias("f_o"), F.col("value").alias("old_value")), new.select("path", F.col("field").alias("f_n"), F.col("value").alias("new_value"))
    both = o.join(n, "path", "full_outer").withColumn("field", F.coalesce("f_n", "f_o"))
    change = F.when(F.col("old_value").isNull(), "added").when(F.col("new_value").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("field").isin(*volatile) & ~values_equal("old_value", "new_value")).select("path", "field", "old_value", "new_value", change.alias("change"))


def changelog_entry(diff: DataFrame, key: str = "dataset_id") -> DataFrame:
    """One text for each document: a sentence for each change, in path order."""
    sentence = F.when(F.col("change") == "added", F.concat(F.col("field"), F.lit(" added: "), F.col("new_value"))).when(F.col("change") == "removed", F.concat(F.col("field"), F.lit(" removed: "), F.col("old_value"))).otherwise(F.concat(F.col("field"), F.lit(": "), F.col("old_value"), F.lit(" -> "), F.col("new_value")))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("path", sentence.alias("s")))), lambda x: x["s"])
    return diff.groupBy(key).agg(F.array_join(lines, "; ").alias("entry"), F.count("*").alias("n_changes"))


def move_private_keys(keys: DataFrame, memberships: DataFrame) -> DataFrame:
    """Compilation-private keys under the membership entries of their series; several values join, none is reported as an orphan.

    keys: tsid, compilation (null: shared by all), key, value. memberships: tsid, compilation.
    """
    own, shared = keys.where("compilation is not null"), keys.where("compilation is null").drop("compilation")
    placed = own.unionByName(shared.join(memberships, "tsid").select("tsid", "compilation", "key", "value"))
    held = placed.join(memberships.withColumn("there", F.lit(True)), ["tsid", "compilation"], "left")
    grouped = held.groupBy("tsid", "compilation", "key").agg(F.array_join(F.array_sort(F.collect_set("value")), "; ").alias("value"), F.max("there").alias("there"))
    return grouped.select("tsid", "compilation", "key", "value", F.when(F.col("there"), "moved").otherwise("orphan").alias("outcome"))


def root_key_disposition(root: DataFrame, columns: DataFrame) -> DataFrame:
    """What a document's root keys are beside its columns' ones: empty, duplicate, restatement or unmatched. Both: dataset_id, key, value."""
    c = columns.groupBy("dataset_id", "key").agg(F.collect_set("value").alias("values"))
    joined = root.join(c, ["dataset_id", "key"], "left")
    plain = lambda x: F.lower(F.regexp_replace(x, "[^A-Za-z0-9]", ""))
    rule = F.when(blank("value"), "empty").when(F.array_contains("values", F.col("value")), "duplicate").when(F.exists("values", lambda v: plain(v) == plain(F.col("value"))), "restatement").otherwise("unmatched")
    return joined.select("dataset_id", "key", "value", rule.alias("disposition"))


def key_inventory(pairs: DataFrame) -> DataFrame:
    """Every key by scope: occurrences, documents, first example. pairs: document, scope, key, value. Numbers before an underscore are dropped from keys."""
    from strandloom.functions.expr import short_example

    plain = F.regexp_replace("key", "([A-Za-z]+)[0-9]+_", "$1_")
    grouped = pairs.groupBy(plain.alias("key"), "scope").agg(F.count("*").alias("n"), F.count_distinct("document").alias("n_documents"), F.min_by("value", "document").alias("example"))
    return grouped.withColumn("example", short_example("example"))
