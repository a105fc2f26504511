"""Moving staged archives into a corpus, all or nothing, with trash, receipts and rollback."""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strandloom.sources import archives
from strandloom.sources.files import Folder


class Corpus:
    """A folder of archives with `.trash/<run>` and `.receipts/<run>.json` beside them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def names(self) -> dict[str, str]:
        """Archives by their name in normal form C; a file system may hold another form."""
        return {unicodedata.normalize("NFC", n): n for n in Folder(self.spark, self.folder).names(r".*\.lpd$")}

    def plan(self, staging: str, allow_delete: bool = False, partial: bool = True) -> list[dict]:
        staged, live = Corpus(self.spark, staging).names(), self.names()
        actions = [{"name": n, "action": "replace" if n in live else "add", "old": live.get(n)} for n in sorted(staged)]
        gone = [] if partial else sorted(set(live) - set(staged))
        if gone and not allow_delete:
            raise ValueError(f"{len(gone)} archives would be deleted: {gone[:3]}")
        return [*actions, *({"name": n, "action": "delete", "old": live[n]} for n in gone)]

    def promote(self, staging: str, run_id: str, dry_run: bool = True, verify: bool = True, allow_delete: bool = False, partial: bool = True) -> list[dict]:
        """Verify and move in what is staged; a failure on the way puts everything back. A run id serves once."""
        plan = self.plan(staging, allow_delete, partial)
        if f"{run_id}.json" in Folder(self.spark, f"{self.folder}/.receipts").names():
            raise ValueError(f"run {run_id} has a receipt already")
        if verify and plan:
            bad = archives.verify(archives.read_archives(self.spark, staging)).limit(5).collect()
            if bad:
                raise ValueError(f"staged archives are not valid: {[(r['path'], r['check']) for r in bad]}")
        if dry_run:
            return plan
        done: list[dict] = []
        try:
            for step in plan:
                if step["old"]:
                    Folder(self.spark, f"{self.folder}/{step['old']}").move(f"{self.folder}/.trash/{run_id}/{step['old']}")
                done.append(step)
                if step["action"] != "delete":
                    Folder(self.spark, f"{staging}/{step['name']}").move(f"{self.folder}/{step['name']}")
            place = Folder(self.spark, f"{self.folder}/.receipts")
            place.make()
            place.write_text(f"{run_id}.json", json.dumps({"run_id": run_id, "files": plan}))
        except Exception:
            self._undo(done, run_id)
            raise
        return plan

    def _undo(self, steps: list[dict], run_id: str) -> None:
        for step in reversed(steps):
            if step["action"] != "delete":
                placed = Folder(self.spark, f"{self.folder}/{step['name']}")
                if placed.exists():
                    placed.delete()
            if step["old"]:
                Folder(self.spark, f"{self.folder}/.trash/{run_id}/{step['old']}").move(f"{self.folder}/{step['old']}")

    def receipt(self, run_id: str) -> dict:
        return json.loads(Folder(self.spark, f"{self.folder}/.receipts").read_text(f"{run_id}.json"))

    def log(self) -> list[str]:
        """Run ids, newest first."""
        return sorted((n.removesuffix(".json") for n in Folder(self.spark, f"{self.folder}/.receipts").names()), reverse=True)

    def rollback(self, run_id: str) -> None:
        self._undo(self.receipt(run_id)["files"], run_id)
        Folder(self.spark, f"{self.folder}/.receipts/{run_id}.json").delete()

    def snapshot(self, target: str) -> int:
        """Copy the archives and a manifest (name, md5, bytes) into a new folder; returns how many there are."""
        if Folder(self.spark, target).exists():
            raise FileExistsError(target)
        manifest = archives.read_archives(self.spark, self.folder).select("path", "md5", F.length("content").alias("bytes")).toLocalIterator()
        lines, place = ["name,md5,bytes"], Folder(self.spark, f"{target}/db")
        place.make()
        for row in manifest:
            name = row["path"].rsplit("/", 1)[-1]
            Folder(self.spark, f"{self.folder}/{name}").copy(f"{target}/db/{name}")
            lines.append(f"{name},{row['md5']},{row['bytes']}")
        Folder(self.spark, target).write_text("manifest.csv", "\n".join([lines[0], *sorted(lines[1:])]) + "\n")
        return len(lines) - 1

    def restore(self, snapshot: str, run_id: str) -> list[dict]:
        """Make the corpus what a snapshot holds, by promotion: what is replaced or has gone since goes to the trash of the run."""
        staging = f"{self.folder}/.restore-{run_id}"
        Folder(self.spark, f"{snapshot}/db").copy(staging)
        done = self.promote(staging, run_id, dry_run=False, verify=False, allow_delete=True, partial=False)
        Folder(self.spark, staging).delete()
        return done

    def collect_trash(self, keep: int) -> list[str]:
        """Delete all but the newest generations of trash."""
        old = Folder(self.spark, f"{self.folder}/.trash").names()
        old = old[: max(0, len(old) - keep)]
        for run in old:
            Folder(self.spark, f"{self.folder}/.trash/{run}").delete()
        return old
