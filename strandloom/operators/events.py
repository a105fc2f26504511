"""The event log and the state it tells: append-only cell changes that keep an absent cell apart from an empty one.

A log row holds run_id, event_seq, append_seq, ts, compilation, tsid, dataset_id, field, old_value, old_present,
new_value, new_present, source, actor, reason. The latest event of a cell is that with the greatest (append_seq,
event_seq), whatever its ts; a tombstone (new_present false) as latest removes the cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.expr import blank, row_fingerprint

KEYS = ("tsid", "field")
# Sources of events.
SOURCES = ("sheet", "lipd", "curator", "migration", "resolver", "vocab")


def ordered_log(log: DataFrame, file: str = "file") -> DataFrame:
    """append_seq from the files' names: equal for a file's events, rising with the name."""
    names = log.select(file).distinct()  # as many rows as files; only they go through one window
    ranked = names.select(file, F.dense_rank().over(Window.orderBy(file)).cast("long").alias("append_seq"))
    return log.join(ranked, file)


def state_at(log: DataFrame, as_of: str | None = None, keys=KEYS) -> DataFrame:
    """The cells that were present at a moment (inclusive, compared as text), or now. One grouped maximum, no window."""
    seen = log if as_of is None else log.where(F.col("ts") <= F.lit(as_of))
    latest = F.max_by(F.struct("new_value", "new_present", "dataset_id", "ts", "source", "actor"), F.struct("append_seq", "event_seq"))
    cells = seen.groupBy(*keys).agg(latest.alias("e")).where("e.new_present")
    return cells.select(*keys, F.col("e.new_value").alias("value"), F.col("e.dataset_id").alias("dataset_id"), F.col("e.ts").alias("updated_at"), F.col("e.source").alias("source"), F.col("e.actor").alias("actor"))


def history(log: DataFrame, tsid: str, field: str) -> DataFrame:
    """All events of one cell, oldest first."""
    return log.where((F.col("tsid") == tsid) & (F.col("field") == field)).orderBy("append_seq", "event_seq")


def diff_to_events(before: DataFrame, after: DataFrame, keys=KEYS) -> DataFrame:
    """Changes that lead from one table of cells to another: presence or exact text differs. Gone cells become tombstones."""
    b = before.select(*keys, F.col("value").alias("old_value"), F.col("dataset_id").alias("b_id"), F.lit(True).alias("b_in"))
    a = after.select(*keys, F.col("value").alias("new_value"), F.col("dataset_id").alias("a_id"), F.lit(True).alias("a_in"))
    both = b.join(a, list(keys), "full_outer").withColumns({"old_present": F.coalesce("b_in", F.lit(False)), "new_present": F.coalesce("a_in", F.lit(False))})
    changed = (F.col("old_present") != F.col("new_present")) | ~F.col("old_value").eqNullSafe(F.col("new_value"))
    return both.where(changed).select(*keys, F.coalesce("a_id", "b_id").alias("dataset_id"), "old_value", "old_present", "new_value", "new_present")


def apply_events(cells: DataFrame, events: DataFrame, keys=KEYS) -> DataFrame:
    """Cells after events with one event a cell at most: changed ones replaced, tombstoned ones gone."""
    kept = cells.join(events.select(*keys), list(keys), "left_anti").select(*keys, "value", "dataset_id")
    return kept.union(events.where("new_present").select(*keys, F.col("new_value").alias("value"), "dataset_id"))


def event_violations(log: DataFrame, sources=SOURCES) -> DataFrame:
    """How many events break each rule, in one aggregate."""
    rules = {
        "bad_source": ~F.coalesce(F.col("source").isin(*sources), F.lit(False)),
        "blank_tsid": blank("tsid"),
        "blank_field": blank("field"),
        "present_without_value": F.col("new_present") & F.col("new_value").isNull(),
        "value_without_presence": ~F.col("new_present") & F.col("new_value").isNotNull(),
    }
    one = log.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return one.unpivot([], list(rules), "rule", "n_events")


def retire(state: DataFrame, tsids: DataFrame, reason: str) -> DataFrame:
    """Tombstones for all cells of some series. A reason is asked for."""
    if not reason:
        raise ValueError("retiring needs a reason")
    gone = state.join(tsids.select("tsid").distinct(), "tsid", "left_semi")
    return gone.select("tsid", "field", "dataset_id", F.col("value").alias("old_value"), F.lit(True).alias("old_present"), F.lit(None).cast("string").alias("new_value"), F.lit(False).alias("new_present"), F.lit("curator").alias("source"), F.lit(reason).alias("reason"))


def stamp_batch(events: DataFrame, run_id: str, ts: str) -> DataFrame:
    """Events ready to append: run id and time where missing, and event_seq, unique in the batch.

    A column `position`, the events' places in their input, becomes event_seq, so the later of two events of a cell wins.
    Without it the numbers run from 1 through 256 parts of the series by a digest, and in each by series, field and value:
    no part but a small share of a batch goes through one task, and only the parts' counts meet.
    """
    filled = events.withColumns({"run_id": F.coalesce("run_id", F.lit(run_id)), "ts": F.coalesce("ts", F.lit(ts))})
    if "position" in events.columns:
        return filled.withColumn("event_seq", F.coalesce("event_seq", F.col("position").cast("long"))).drop("position")
    parted = filled.withColumn("_part", F.substring(F.md5(F.coalesce("tsid", F.lit(""))), 1, 2))
    counts = parted.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # 256 rows at most
    own = F.row_number().over(Window.partitionBy("_part").orderBy("tsid", "field", "new_value"))
    numbered = parted.withColumn("_own", own).join(before, "_part")
    return numbered.withColumn("event_seq", F.coalesce("event_seq", F.col("_before") + F.col("_own"))).drop("_part", "_own", "_before")


def state_fingerprint(state: DataFrame) -> DataFrame:
    """One row that is equal for equal states, in any order."""
    return state.agg(row_fingerprint("tsid", "field", "value", "dataset_id").alias("state_hash"))
