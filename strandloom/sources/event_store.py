"""The event log on disk: one gzipped CSV file for each append, named by its place in the log."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.expr import row_fingerprint
from strandloom.operators.events import event_violations, ordered_log, state_at
from strandloom.sources.files import Folder

SCHEMA = "run_id string, event_seq long, ts string, compilation string, tsid string, dataset_id string, field string, old_value string, old_present boolean, new_value string, new_present boolean, source string, actor string, reason string"
DECISION = "vocab_key string, value string, decision string, target string, also_field string, also_value string, actor string, run_id string, ts string"
# What a review can decide.
DECIDED = ("synonym", "new_term", "decompose", "leave")
CSV = {"header": True, "multiLine": True, "escape": '"', "nullValue": "", "emptyValue": '""', "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"}


class EventStore:
    """Logs of several compilations under one folder; files are read by Spark, so any store will do."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.columns = spark.createDataFrame([], SCHEMA).columns

    def _files(self, compilation: str) -> list[str]:
        return Folder(self.spark, f"{self.folder}/{compilation}").names(r"^\d{6,}_.*$")

    def append(self, compilation: str, events: DataFrame, run_id: str, ts: str) -> str | None:
        """Validate and append one batch; an empty one is no append. Returns the batch's name."""
        from strandloom.operators.events import stamp_batch

        full = self.spark.createDataFrame([], SCHEMA).unionByName(events, allowMissingColumns=True).withColumn("compilation", F.lit(compilation))
        stamped = stamp_batch(full, run_id, ts).select(*self.columns)
        bad = {r["rule"]: r["n_events"] for r in event_violations(stamped).collect() if r["n_events"]}
        if bad:
            raise ValueError(f"events break rules: {bad}")
        if stamped.isEmpty():
            return None
        number = 1 + max((int(n.split("_")[0]) for n in self._files(compilation)), default=0)
        name = f"{number:06d}_{re.sub('[^0-9]', '', ts)}_{run_id}"
        stamped.sortWithinPartitions("event_seq").write.options(**CSV).option("compression", "gzip").mode("error").csv(f"{self.folder}/{compilation}/{name}")
        return name

    def _read(self, compilation: str, names: list[str]) -> DataFrame:
        read = self.spark.read.schema(SCHEMA).options(**CSV).csv([f"{self.folder}/{compilation}/{n}" for n in names])
        return read.withColumn("file", F.regexp_extract("_metadata.file_path", r"/(\d{6,}_[^/]*)/[^/]*$", 1))

    def log(self, compilation: str) -> DataFrame:
        """All events with append_seq."""
        names = self._files(compilation)
        if not names:
            return self.spark.createDataFrame([], SCHEMA + ", append_seq long")
        return ordered_log(self._read(compilation, names)).drop("file")

    def state(self, compilation: str, as_of: str | None = None) -> DataFrame:
        return state_at(self.log(compilation), as_of)

    def compact(self, compilation: str, run_id: str, dry_run: bool = True) -> tuple[int, str]:
        """Rewrite each append as one gzipped file, without changing any event; returns how many files there were, and the log's fingerprint.

        Every event keeps its place, time and run, so the state at any moment stays. The new files must have the fingerprint
        of the old ones, append by append, before they take their place; the old ones go to a trash folder.
        """
        names, live = self._files(compilation), Folder(self.spark, f"{self.folder}/{compilation}")
        read = self._read(compilation, names) if names else self.log(compilation).withColumn("file", F.lit(""))
        files = sum(len(Folder(self.spark, f"{live.path}/{n}").names(r".*[.]csv([.]gz)?$")) for n in names)
        marks = lambda df: {r["file"]: r["mark"] for r in df.groupBy("file").agg(row_fingerprint(*self.columns).alias("mark")).collect()}
        before = marks(read)
        mark = ";".join(f"{k}={v}" for k, v in sorted(before.items()))
        if dry_run or not names:
            return files, mark
        fresh = f"{self.folder}/.compact-{run_id}"
        one = read.select(*self.columns, "file").repartition("file").sortWithinPartitions("file", "event_seq")
        one.write.partitionBy("file").options(**CSV).option("compression", "gzip").csv(fresh)
        for n in names:
            Folder(self.spark, f"{fresh}/file={n}").move(f"{fresh}/{compilation}/{n}")
        if marks(EventStore(self.spark, fresh)._read(compilation, names)) != before:
            Folder(self.spark, fresh).delete()
            raise ValueError("compaction would change the log; nothing was replaced")
        live.move(f"{self.folder}/.trash-{run_id}/{compilation}")
        Folder(self.spark, f"{fresh}/{compilation}").move(live.path)
        Folder(self.spark, fresh).delete()
        return files, mark

    def decisions(self) -> DataFrame:
        """Recorded vocabulary decisions, each with its place in the log; none if there are none."""
        place = Folder(self.spark, f"{self.folder}/.vocab")
        kept = self.spark.read.schema(DECISION).options(**CSV).csv([f"{place.path}/{n}" for n in place.names(r"^\d{6,}_")]) if place.names(r"^\d{6,}_") else None
        return kept if kept is not None else self.spark.createDataFrame([], DECISION)

    def decide(self, rows: DataFrame, actor: str, run_id: str, ts: str) -> str | None:
        """Append decisions (vocab_key, value, decision, target, also_field, also_value); returns the batch's name."""
        bad = rows.where(~F.coalesce(F.col("decision").isin(*DECIDED), F.lit(False))).limit(1).collect()
        if bad:
            raise ValueError(f"no decision: {bad[0]['decision']}")
        if rows.isEmpty():
            return None
        place = Folder(self.spark, f"{self.folder}/.vocab")
        number = 1 + max((int(n.split("_")[0]) for n in place.names(r"^\d{6,}_")), default=0)
        name = f"{number:06d}_{re.sub('[^0-9]', '', ts)}_{run_id}"
        full = rows.withColumns({"actor": F.lit(actor), "run_id": F.lit(run_id), "ts": F.lit(ts)})
        full.select(*self.spark.createDataFrame([], DECISION).columns).write.options(**CSV).csv(f"{place.path}/{name}")
        return name
