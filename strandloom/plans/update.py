"""Updating one compilation: three inputs, a merge, a gate, events. Lazy up to the gate; only the end writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators import documents, events, merge, sheets
from strandloom.plans.control import Settings
from strandloom.sources.event_store import EventStore
from strandloom.sources.sheet_store import SheetBackend


@dataclass
class Update:
    plan: DataFrame
    state: DataFrame
    changes: DataFrame
    quarantined: DataFrame
    appended: str | None = None


def run(config: Settings, store: EventStore, backend: SheetBackend, series: DataFrame, frame: DataFrame, registry: DataFrame, ranges: dict[str, tuple[float, float]], run_id: str, ts: str) -> Update:
    """Merge stored state, sheet and documents of a compilation; append the events unless it is a dry run.

    The plan feeds several outputs, so it is kept while they are made.
    """
    base = store.state(config.compilation)
    membership = f"in{config.compilation}"
    sheet = sheets.pull(backend.read(config.sheets, "QC"), registry)
    twice = merge.duplicate_cells(sheet)
    if not twice.isEmpty():
        raise ValueError(f"the sheet has cells twice: {[tuple(r)[:2] for r in twice.limit(3).collect()]}")
    file = frame.unionByName(documents.membership_frame(series, config.compilation))
    plan = merge.merge_three_way(base, sheet, file, registry).persist()
    try:
        merge.check_plan(plan, config.strict)
        state = merge.plan_state(plan)
        bad = merge.validate_values(merge.write_set(plan, membership), registry, ranges)
        changes = events.diff_to_events(base, state).withColumns({"source": F.lit("resolver"), "actor": F.lit("engine"), "reason": F.lit(run_id)})
        out = Update(plan, state, changes, bad)
        if not config.dry_run:
            out.appended = store.append(config.compilation, changes, run_id, ts)
        return out
    finally:
        plan.unpersist()


def changes_again(config: Settings, store: EventStore, backend: SheetBackend, series: DataFrame, frame: DataFrame, registry: DataFrame) -> int:
    """Changes that a second run would make; none after a run that was appended and written."""
    file = frame.unionByName(documents.membership_frame(series, config.compilation))
    plan = merge.merge_three_way(store.state(config.compilation), sheets.pull(backend.read(config.sheets, "QC"), registry), file, registry)
    return merge.plan_summary(plan).first()["n_changed"]
