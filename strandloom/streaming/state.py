"""The current state kept up with a growing event log. An extension: the batch operators are the reference semantics.

Order is by (append_seq, event_seq), never by event time, so no watermark may drop anything: a file that comes late with a
greater sequence still wins. State is one row a cell, merged into a table batch by batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.sources.files import Folder

KEYS = ["tsid", "field"]
COLUMNS = "tsid string, field string, append_seq long, event_seq long, new_value string, new_present boolean, dataset_id string"


def _latest(events: DataFrame) -> DataFrame:
    best = F.max_by(F.struct("append_seq", "event_seq", "new_value", "new_present", "dataset_id"), F.struct("append_seq", "event_seq"))
    return events.groupBy(*KEYS).agg(best.alias("e")).select(*KEYS, "e.*")


class LiveState:
    """Tables `<folder>/v<batch>`: the newest complete one is the state. Each batch writes the next, so a repeated batch rewrites its own."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _versions(self) -> list[int]:
        return sorted(int(n[1:]) for n in Folder(self.spark, self.folder).names(r"^v\d+$") if "_SUCCESS" in Folder(self.spark, f"{self.folder}/{n}").names())

    def table(self, before: int | None = None) -> DataFrame:
        """Latest event of every cell, tombstones too."""
        versions = [v for v in self._versions() if before is None or v < before]
        return self.spark.read.schema(COLUMNS).parquet(f"{self.folder}/v{versions[-1]}") if versions else self.spark.createDataFrame([], COLUMNS)

    def state(self) -> DataFrame:
        return self.table().where("new_present").select(*KEYS, F.col("new_value").alias("value"), "dataset_id")

    def absorb(self, batch: DataFrame, batch_id: int) -> None:
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        merged = _latest(self.table(before=batch_id).select(*names).unionByName(batch.select(*names)))
        merged.select(*names).write.mode("overwrite").parquet(f"{self.folder}/v{batch_id}")
        for old in [v for v in self._versions() if v < batch_id][:-1]:  # the one before stays, for a repeat of this batch
            Folder(self.spark, f"{self.folder}/v{old}").delete()

    def follow(self, stream: DataFrame, checkpoint: str, **trigger):
        """Start a query that absorbs a streaming log."""
        return stream.writeStream.foreachBatch(self.absorb).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
