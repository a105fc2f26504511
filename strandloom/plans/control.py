"""The control plane on the driver: settings, run ids, locks, a content-keyed stage cache, retries."""

from __future__ import annotations

import hashlib
import json
import os
import random
import re
import socket
import string
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, fields, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from strandloom.sources.files import Folder


@dataclass(frozen=True)
class Settings:
    """Layers: these defaults, then a registry row, then a compilation's own, then overrides. Enums are checked."""

    compilation: str = ""
    data: str = ""
    store: str = ""
    sheets: str = ""
    age_or_year: str = "age"
    strict: bool = False
    dry_run: bool = True
    keep_trash: int = 3

    def __post_init__(self):
        if self.age_or_year not in ("age", "year"):
            raise ValueError(f"age_or_year is {self.age_or_year!r}, not age or year")
        if self.keep_trash < 0:
            raise ValueError("keep_trash is negative")


def settings(*layers: dict) -> Settings:
    known, out = {f.name for f in fields(Settings)}, Settings()
    for layer in layers:
        unknown = set(layer) - known
        if unknown:
            raise ValueError(f"unknown settings {sorted(unknown)}")
        out = replace(out, **{k: v for k, v in layer.items() if v is not None})
    return out


def path_from_env(name: str, default: str | None = None) -> str:
    """A path from STRANDLOOM_<NAME>; set but empty is an error."""
    value = os.environ.get(f"STRANDLOOM_{name.upper()}", default)
    if not value:
        raise ValueError(f"STRANDLOOM_{name.upper()} is not set")
    return value


def actor() -> str:
    """Who acts: STRANDLOOM_ACTOR, else the login name, else unknown."""
    for name in ("STRANDLOOM_ACTOR", "USER", "LOGNAME"):
        if os.environ.get(name, "").strip():
            return os.environ[name].strip()
    return "unknown"


def now_utc() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def run_id() -> str:
    """UTC time and six random characters."""
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ") + "-" + "".join(random.choices(string.ascii_lowercase + string.digits, k=6))


def safe_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]", "_", name)


class Lock:
    """A lock folder with its holder and age; a lock of a dead process on this machine, or older than `stale` seconds, may be broken."""

    def __init__(self, spark: SparkSession, folder: str, name: str, stale: float = 6 * 3600):
        self.spark, self.at, self.stale = spark, f"{folder.rstrip('/')}/{safe_name(name)}.lock", stale

    def status(self) -> dict | None:
        place = Folder(self.spark, self.at)
        return json.loads(place.read_text("holder")) if "holder" in place.names() else None

    def is_stale(self, holder: dict) -> bool:
        if time.time() - holder["since"] > self.stale:
            return True
        if holder["host"] != socket.gethostname():
            return False
        try:
            os.kill(holder["pid"], 0)
        except ProcessLookupError:
            return True
        except PermissionError:
            return False
        return False

    def take(self) -> None:
        place = Folder(self.spark, self.at)
        if not place.make():
            holder = self.status()
            if holder is None or not self.is_stale(holder):
                raise RuntimeError(f"{self.at} is held by {holder}")
            place.delete()
            if not place.make():
                raise RuntimeError(f"{self.at} was taken meanwhile")
        place.write_text("holder", json.dumps({"pid": os.getpid(), "host": socket.gethostname(), "since": time.time()}))

    def release(self) -> None:
        Folder(self.spark, self.at).delete()

    @contextmanager
    def held(self) -> Iterator[None]:
        self.take()
        try:
            yield
        finally:
            self.release()


class StageCache:
    """Parquet results under a key of stage, version and inputs. An unfinished write is never found, as it is moved in whole."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def key(self, stage: str, version: int, inputs) -> str:
        return hashlib.md5(json.dumps([stage, version, inputs], sort_keys=True, default=str).encode()).hexdigest()

    def get(self, stage: str, version: int, inputs, make: Callable[[], DataFrame], use: bool = True) -> DataFrame:
        at = f"{self.folder}/{safe_name(stage)}/{self.key(stage, version, inputs)}"
        if use and "_SUCCESS" in Folder(self.spark, at).names():
            return self.spark.read.parquet(at)
        made = make()
        if not use:
            return made
        Folder(self.spark, at).delete()
        part = f"{at}.part-{run_id()}"
        made.write.parquet(part)
        Folder(self.spark, part).move(at)
        return self.spark.read.parquet(at)

    def clear(self, stage: str) -> None:
        Folder(self.spark, f"{self.folder}/{safe_name(stage)}").delete()

    def info(self) -> dict[str, int]:
        return {s: len(Folder(self.spark, f"{self.folder}/{s}").names(r"^[0-9a-f]{32}$")) for s in Folder(self.spark, self.folder).names()}


def with_retry(make: Callable, tries: int = 4, base: float = 2.0, sleep: Callable[[float], None] = time.sleep):
    """make(), again after 2, 4, 8 ... seconds if it fails."""
    for attempt in range(1, tries + 1):
        try:
            return make()
        except Exception:
            if attempt == tries:
                raise
            sleep(base**attempt)
