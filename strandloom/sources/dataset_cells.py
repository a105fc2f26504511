"""Cells out of whole dataset archives, and cells and series ids back into staged copies of them.

Metadata is nested JSON of any shape, which no expression takes apart, so archives go through Arrow batches one by one.
Nothing is changed in place: results hold new contents, which stage() writes beside the corpus for promotion.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.documents import route_cells
from strandloom.operators.registry import canonical_field, first_rule
from strandloom.sources.archives import columns_of, metadata, text_of
from strandloom.sources.files import Folder

_NUMBER = re.compile(r"\s*-?[0-9.]+([eE][-+]?[0-9]+)?\s*")
_PREFIX = re.compile(r"^(paleoData|chronData|geo|pub[0-9]*|calibration)_")
_ROOT_SKIPPED = {"paleoData", "chronData", "pub", "geo", "@context"}
_OLD_ROOT_KEY = re.compile(r"Interpretation[0-9]+_")
_NOT_CELLS = {"TSid", "datasetId"}
ISSUE = "array<struct<check: string, severity: string, tsid: string, field: string, value: string>>"
_ISSUE = pa.list_(pa.struct([(n, pa.string()) for n in ("check", "severity", "tsid", "field", "value")]))


def issue(check: str, severity: str, tsid: str | None = None, field: str | None = None, value: str | None = None) -> dict:
    return {"check": check, "severity": severity, "tsid": tsid, "field": field, "value": value}


def coerce_value(text: str | None):
    """What a cell's text is in a document: null removes the field, TRUE and FALSE and numbers become themselves."""
    if text is None:
        return None
    if text in ("TRUE", "FALSE"):
        return text == "TRUE"
    if _NUMBER.fullmatch(text):
        try:
            value = float(text)
        except ValueError:
            return text
        return int(value) if value.is_integer() and abs(value) < 1 << 53 else value
    return text


def _set(place: dict, key: str, value) -> None:
    if value is None:
        place.pop(key, None)
    else:
        place[key] = value


# -- cells out of documents -------------------------------------------------------------------------------------------
def _paleo_columns(meta: dict) -> Iterator[dict]:
    for block in meta.get("paleoData") or []:
        tables = [*(block.get("measurementTable") or []), *(t for m in block.get("model") or [] for k in ("summaryTable", "ensembleTable") for t in m.get(k) or [])]
        for table in tables:
            listed = table.get("columns", table) if isinstance(table, dict) else []
            for column in listed.values() if isinstance(listed, dict) else listed:
                if isinstance(column, dict) and text_of(column.get("TSid")):
                    yield column


def dataset_values(meta: dict, stem: str) -> Iterator[tuple[str, str | None]]:
    """(name, value) of everything that holds for the dataset: root keys, places with coordinates in longitude, latitude, elevation order, numbered publications."""
    for key, value in meta.items():
        if key not in _ROOT_SKIPPED and not _OLD_ROOT_KEY.search(key):
            yield key, text_of(value)
    geo = meta.get("geo") if isinstance(meta.get("geo"), dict) else {}
    for key, value in geo.items():
        if key == "geometry" and isinstance(value, dict):
            for name, number in zip(("longitude", "latitude", "elevation"), value.get("coordinates") or [], strict=False):
                yield f"geo_{name}", text_of(number)
            for name, other in value.items():
                if name != "coordinates":
                    yield f"geo_{name}", text_of(other)
        else:
            yield f"geo_{key}", text_of(value)
    for i, pub in enumerate(meta.get("pub") or [], 1):
        for key, value in pub.items() if isinstance(pub, dict) else ():
            yield f"pub{i}_{key}", text_of(value)
    yield "dataSetName", text_of(meta.get("dataSetName")) or stem


def column_values(column: dict) -> Iterator[tuple[str, str | None, bool]]:
    """(name, value, fully named) of a column: its scalars by their bare names, interpretations numbered inside their own scope, calibration."""
    for key, value in column.items():
        if key == "interpretation" and isinstance(value, list):
            seen: dict[str, int] = {}
            for entry in value:
                if isinstance(entry, dict):
                    scope = (text_of(entry.get("scope")) or "").lower()
                    seen[scope] = seen.get(scope, 0) + 1
                    prefix = f"{scope}Interpretation{seen[scope]}" if scope else f"interpretation{seen[scope]}"
                    yield from ((f"{prefix}_{k}", text_of(v), False) for k, v in entry.items())
        elif key == "calibration" and isinstance(value, dict):
            yield from ((f"calibration_{k}", text_of(v), True) for k, v in value.items())
        elif not isinstance(value, (dict, list)):
            yield key, text_of(value), False


def document_cells(meta: dict, stem: str, full: dict[str, str], bare: dict[str, str]) -> Iterator[tuple[str, str, str]]:
    """(tsid, field, value): the dataset's values on each of its series, then the column's own, which win."""
    shared = {full[k]: v for k, v in dataset_values(meta, stem) if k in full and v}
    for column in _paleo_columns(meta):
        own = dict(shared)
        own.update((names[k], v) for k, v, named in column_values(column) if v and k in (names := full if named else bare))
        yield from ((text_of(column["TSid"]), f, v) for f, v in own.items() if f not in _NOT_CELLS)


def frame(archives: DataFrame, registry: DataFrame) -> DataFrame:
    """tsid, field, value, dataset_id for the registry's merged and key fields; of a repeated cell the first by path and place stays.

    The registry is collected: a few hundred names. A file that can't be read has no cells; identities() reports it.
    """
    rules = first_rule(registry).where("role in ('merged', 'key')")
    names = canonical_field(rules.select(F.col("qc_name").alias("field"), "group_order"), registry)
    listed = rules.select(F.col("qc_name").alias("field"), "group_order").join(names, "field").orderBy("group_order", "field").collect()
    full = {r["field"]: r["canonical"] for r in listed}
    bare: dict[str, str] = {}
    for r in listed:
        bare.setdefault(_PREFIX.sub("", r["field"]), r["canonical"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    meta = metadata(content)
                except Exception:  # noqa: BLE001  damaged files are reported by identities()
                    continue
                stem = re.sub(r"\.[^./]*$", "", path.rsplit("/", 1)[-1])
                ident = text_of(meta.get("datasetId"))
                rows += [(path, n, t, f, v, ident) for n, (t, f, v) in enumerate(document_cells(meta, stem, full, bare))]
            kinds = [pa.string(), pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["path", "n", "tsid", "field", "value", "dataset_id"])

    cells = archives.select("path", "content").mapInArrow(run, "path string, n long, tsid string, field string, value string, dataset_id string")
    first = F.min_by(F.struct("value", "dataset_id"), F.struct("path", "n")).alias("c")
    return cells.groupBy("tsid", "field").agg(first).select("tsid", "field", "c.value", "c.dataset_id")


# -- cells into documents ---------------------------------------------------------------------------------------------
def interpretation_at(entries: list, scope: str | None, index: int | None) -> int | None:
    """The position of a scope's n-th entry in the list that mixes scopes, or None if there are fewer."""
    wanted = (scope or "").lower()
    held = [i for i, e in enumerate(entries) if ((text_of(e.get("scope")) if isinstance(e, dict) else None) or "").lower() == wanted]
    return held[(index or 1) - 1] if (index or 1) <= len(held) else None


def apply_to_column(column: dict, cells: list[dict]) -> None:
    for cell in cells:
        value, name = coerce_value(cell["value"]), cell["name"]
        if cell["target"] == "column":
            _set(column, name, value)
        elif cell["target"] == "calibration":
            if not isinstance(column.get("calibration"), dict):
                column["calibration"] = {}
            _set(column["calibration"], name, value)
        elif cell["target"] == "interpretation":
            entries = column["interpretation"] if isinstance(column.get("interpretation"), list) else []
            column["interpretation"] = entries
            at = interpretation_at(entries, cell["scope"], cell["index"])
            if at is None:  # appended: a position in use would overwrite another scope's entry
                entries.append({"scope": cell["scope"]} if cell["scope"] else {})
                at = len(entries) - 1
            _set(entries[at], name, value)


def apply_to_dataset(meta: dict, cells: list[dict]) -> list[dict]:
    """Write routed cells into a document; what can't be applied comes back as issues."""
    found, by_field = [], {}
    for cell in (c for c in cells if c["level"] == "dataset"):
        by_field.setdefault(cell["field"], []).append(cell)
    for own in by_field.values():
        if len({c["value"] for c in own if c["value"] is not None}) > 1:
            found += [issue("dataset_field_disagrees", "warn", c["tsid"], c["field"], c["value"]) for c in own]
            continue
        cell, value = own[0], coerce_value(own[0]["value"])
        if cell["target"] == "root":
            _set(meta, cell["name"], value)
        elif cell["target"] == "geo":
            if not isinstance(meta.get("geo"), dict):
                meta["geo"] = {}
            _set(meta["geo"], cell["name"], value)
        else:
            pubs = meta["pub"] = meta.get("pub") or []
            if cell["index"] > len(pubs) + 1:  # no run of empty publications on the way to a far one
                found.append(issue("pub_index_gap", "warn", None, cell["field"], cell["value"]))
                continue
            if cell["index"] == len(pubs) + 1:
                pubs.append({})
            _set(pubs[cell["index"] - 1], cell["name"], value)
    wanted: dict[str, list[dict]] = {}
    for cell in (c for c in cells if c["level"] == "column"):
        wanted.setdefault(cell["tsid"], []).append(cell)
    for _, place, column in columns_of(meta):
        own = wanted.pop(text_of(column.get("TSid")), None) if place == "measurement" else None
        if own:
            apply_to_column(column, own)
    return found + [issue("tsid_not_in_dataset", "warn", t, c["field"], c["value"]) for t, own in wanted.items() for c in own]


def with_metadata(content: bytes, meta: dict) -> bytes:
    """The archive with new metadata; data members stay byte for byte, times are fixed."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            body = json.dumps(meta, ensure_ascii=False).encode() if name.endswith(".jsonld") else old.read(name)
            new.writestr(zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0)), body)
    return out.getvalue()


def _rewritten(work: DataFrame, change) -> DataFrame:
    """path, content and issues where change(meta, work item) has rewritten a document or found something; content is null where nothing is to be staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, issues = [], []
            for content, items in zip(batch.column("content").to_pylist(), batch.column("work").to_pylist(), strict=True):
                try:
                    meta = metadata(content)
                except Exception as error:  # noqa: BLE001  any damage is the file's state
                    contents.append(None)
                    issues.append([issue("unreadable", "error", value=str(error))])
                    continue
                found = change(meta, items)
                stop = any(f["severity"] == "error" for f in found)
                contents.append(None if stop else with_metadata(content, meta))
                issues.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(contents, pa.binary()), pa.array(issues, _ISSUE)], ["path", "content", "issues"])

    return work.select("path", "content", "work").mapInArrow(run, f"path string, content binary, issues {ISSUE}")


def apply_cells(archives: DataFrame, cells: DataFrame, registry: DataFrame, series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged copies (path, content, issues) of the archives that cells change, and issues of cells whose series no archive has.

    series: TSid and path of each (see archives.series). Only merged and key fields are written. A dataset's cells meet in
    one row, as they go into one file.
    """
    kept = cells.join(first_rule(registry).where("role in ('merged', 'key')").select(F.col("qc_name").alias("field")), "field", "left_semi")
    placed = route_cells(kept).join(series.groupBy(F.col("TSid").alias("tsid")).agg(F.min("path").alias("path")), "tsid", "left")
    orphans = placed.where("path is null").select(F.lit("tsid_not_in_database").alias("check"), F.lit("warn").alias("severity"), "tsid", "field", "value")
    item = F.struct("tsid", "field", "value", "target", "index", "scope", "name", "level")
    work = placed.where("path is not null").groupBy("path").agg(F.array_sort(F.collect_list(item)).alias("work"))
    return _rewritten(archives.select("path", "content").join(work, "path"), apply_to_dataset), orphans


# -- ids into incoming archives ---------------------------------------------------------------------------------------
def walked(archives: DataFrame) -> DataFrame:
    """path, position from 1 and variable of every column of measurement and model tables, in the order in which ids are assigned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    rows += [(path, n, text_of(c.get("variableName")), text_of(c.get("TSid"))) for n, (_, _, c) in enumerate(columns_of(metadata(content)), 1)]
                except Exception:  # noqa: BLE001  damaged files are reported by identities()
                    continue
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string(), pa.string()))], ["path", "position", "variable", "tsid"])

    return archives.select("path", "content").mapInArrow(run, "path string, position long, variable string, tsid string")


def assign_to_dataset(meta: dict, plan: list[dict]) -> list[dict]:
    """Give a document's columns the plan's ids; nothing is assigned unless number, order and names of the columns agree with the plan."""
    columns = [c for _, _, c in columns_of(meta)]
    if [text_of(c.get("variableName")) for c in columns] != [p["variable"] for p in plan]:
        return [issue("structure_mismatch", "error", value=f"the plan has {len(plan)} columns, the file {len(columns)}")]
    for column, step in zip(columns, plan, strict=True):
        if step["new_tsid"] is not None:
            column["TSid"] = step["new_tsid"]
    if text_of(meta.get("datasetId")) is None and plan:
        meta["datasetId"] = plan[0]["new_dataset_id"]
    return []


def assign_ids(archives: DataFrame, plan: DataFrame, run_id: str) -> DataFrame:
    """Staged copies with the plan's ids. plan: path, position, variable, action, new_tsid; files with an error in it are left out.

    A missing dataset id becomes a digest of run and path, so that a task that runs again makes the same.
    """
    bad = plan.where("action = 'error'").select("path").distinct()
    ident = F.concat(F.lit("SLD"), F.substring(F.md5(F.concat_ws("\x1f", F.lit(run_id), "path")), 1, 24))
    steps = plan.join(bad, "path", "left_anti").withColumn("new_dataset_id", ident)
    work = steps.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("position", "variable", "new_tsid", "new_dataset_id"))).alias("work"))
    return _rewritten(archives.select("path", "content").join(work, "path"), assign_to_dataset)


def standardize_archives(archives: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged copies with column values rewritten by a table (field, value, new_value), and the changes: path, tsid, field, value, new_value.

    The table holds distinct values that a vocabulary changes, so it is collected: as many rows as a vocabulary has spellings.
    """
    rules = {(r["field"], r["value"]): r["new_value"] for r in table.select("field", "value", "new_value").collect()}

    def change(meta: dict, _) -> list[dict]:
        found = []
        for _, _, column in columns_of(meta):
            for field in list(column):
                old = text_of(column[field]) if not isinstance(column[field], (dict, list)) else None
                new = rules.get((field, old))
                if new is not None and new != old:
                    column[field] = new
                    found.append(issue("standardized", "info", text_of(column.get("TSid")), field, f"{old}\x1f{new}"))
        return found

    made = _rewritten(archives.select("path", "content").withColumn("work", F.array().cast("array<string>")), change)
    changes = made.select("path", F.explode("issues").alias("i")).where("i.check = 'standardized'")
    parts = F.split("i.value", "\x1f")
    return made.where("size(issues) > 0"), changes.select("path", "i.tsid", "i.field", F.get(parts, 0).alias("value"), F.get(parts, 1).alias("new_value"))


def stage(made: DataFrame, folder: str) -> int:
    """Write the contents of staged copies into a folder, one archive at a time; returns how many."""
    spark, n = made.sparkSession, 0
    place = Folder(spark, folder)
    place.make()
    for row in made.where("content is not null").select("path", "content").toLocalIterator():
        place.write_bytes(row["path"].rsplit("/", 1)[-1], bytes(row["content"]))
        n += 1
    return n

