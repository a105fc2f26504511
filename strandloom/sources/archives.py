"""Dataset archives: a zip with one JSON-LD metadata member and CSV data members, read and written over Arrow batches.

Files come from Spark's binaryFile reader, so any store that Spark reads will do. Metadata and data members have readers
of their own: a query on identity never parses data.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.text import number_text

META = "bag/data/metadata.jsonld"
IDENTITY = "path string, dataSetName string, datasetId string, datasetVersion string, archiveType string, n_ts int, parse_error string"
COLUMN = "path string, datasetId string, dataSetName string, TSid string, tableType string, tableKind string, variableName string, compilations array<string>"


def read_archives(spark: SparkSession, folder: str, pattern: str = "*.lpd") -> DataFrame:
    """path, name, md5 and content of each archive; names filter before any parsing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1)
    return files.select("path", stem.alias("name"), F.md5("content").alias("md5"), "content")


def scan(archives: DataFrame) -> DataFrame:
    return archives.select("name", "md5", "path")


def pack(meta: dict, members: dict[str, str] | None = None) -> bytes:
    """An archive's bytes; times are fixed so that equal contents make equal files."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in [(META, json.dumps(meta, ensure_ascii=False)), *((f"bag/data/{k}", v) for k, v in (members or {}).items())]:
            z.writestr(zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0)), text)
    return out.getvalue()


def metadata(content: bytes) -> dict:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if n.endswith(".jsonld")]
        if len(names) != 1:
            raise ValueError(f"{len(names)} metadata members")
        return json.loads(z.read(names[0]))


def data_members(content: bytes) -> dict[str, list[list[str]]]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return {n.rsplit("/", 1)[-1]: list(csv.reader(io.StringIO(z.read(n).decode("utf-8")))) for n in z.namelist() if n.endswith(".csv")}


def text_of(value) -> str | None:
    """A scalar as text; null, empty and nested values are no value."""
    if isinstance(value, list):
        value = value[0] if len(value) == 1 else None
    if value is None or isinstance(value, dict) or value == "":
        return None
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    return number_text(float(value)) if isinstance(value, (int, float)) else str(value)


def columns_of(meta: dict) -> Iterator[tuple[str, str, dict]]:
    """(paleo or chron, measurement or model, column) in file order; both layouts of columns."""
    for kind in ("paleo", "chron"):
        for block in meta.get(f"{kind}Data") or []:
            tables = [("measurement", t) for t in block.get("measurementTable") or []]
            tables += [("model", t) for m in block.get("model") or [] for k in ("summaryTable", "ensembleTable", "distributionTable") for t in m.get(k) or []]
            for place, table in tables:
                listed = table.get("columns")
                named = [c for c in table.values() if isinstance(c, dict) and "variableName" in c] if listed is None else []
                for column in named if listed is None else listed.values() if isinstance(listed, dict) else listed:
                    yield kind, place, column


def memberships(column: dict) -> list[str]:
    found = column.get("inCompilation") or column.get("inCompilationBeta") or []
    found = [found] if isinstance(found, (str, dict)) else found
    names = [e.get("compilationName") if isinstance(e, dict) else e for e in found]
    return list(dict.fromkeys(n for n in map(text_of, names) if n))


def version_of(meta: dict) -> str | None:
    versions = [text_of(c.get("version")) for c in meta.get("changelog") or [] if isinstance(c, dict)]
    numbers = [[int(p) for p in v.split(".")] for v in versions if v and all(p.isdigit() for p in v.split("."))]
    return ".".join(map(str, max(numbers))) if numbers else None


def _each(df: DataFrame, make, schema: str) -> DataFrame:
    """Rows that make(path, content) gives for each archive."""
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema)
    kinds = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}[f.dataType.simpleString()] for f in fields]

    def run(batches):
        for batch in batches:
            rows = [r for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True) for r in make(path, content)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], fields.names)

    return df.select("path", "content").mapInArrow(run, schema)


def identities(archives: DataFrame) -> DataFrame:
    """One row for each archive; a file that can't be read has its error and no more."""

    def make(path, content):
        try:
            m = metadata(content)
            n = sum(1 for *_, c in columns_of(m) if text_of(c.get("TSid")))
            yield path, text_of(m.get("dataSetName")), text_of(m.get("datasetId")), version_of(m), text_of(m.get("archiveType")), n, None
        except Exception as error:  # noqa: BLE001  any damage is the file's state, not the job's
            yield path, None, None, None, None, 0, f"{type(error).__name__}: {error}"

    return _each(archives, make, IDENTITY)


def series(archives: DataFrame, with_id_only: bool = True) -> DataFrame:
    """One row for each column with an id, or with a variable name."""

    def make(path, content):
        try:
            m = metadata(content)
        except Exception:  # noqa: BLE001  identities() reports it
            return
        for kind, place, c in columns_of(m):
            if text_of(c.get("TSid" if with_id_only else "variableName")):
                yield path, text_of(m.get("datasetId")), text_of(m.get("dataSetName")), text_of(c.get("TSid")), kind, place, text_of(c.get("variableName")), memberships(c)

    return _each(archives, make, COLUMN)


def flatten(value, path: str = "") -> Iterator[tuple[str, str | None]]:
    """(path, value) leaves of nested JSON; a list of scalars is one leaf with its length and digest."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from flatten(v, f"{path}.{k}" if path else k)
    elif isinstance(value, list):
        if value and not any(isinstance(v, (dict, list)) for v in value):
            yield path, text_of(value) if len(value) == 1 else f"<{len(value)}:{hashlib.md5(','.join(text_of(v) or '' for v in value).encode()).hexdigest()[:12]}>"
        else:
            for i, v in enumerate(value):
                yield from flatten(v, f"{path}[{i}]")
    else:
        yield path, text_of(value)


def leaves(archives: DataFrame) -> DataFrame:
    """Every leaf of each archive: dataset, tsid, path, value. Columns are keyed by their ids, data members by a digest of their parsed cells."""

    def make(path, content):
        try:
            m = metadata(content)
        except Exception as error:  # noqa: BLE001
            yield path, None, "error", str(error)
            return
        name = text_of(m.get("dataSetName"))
        for p, v in flatten({k: v for k, v in m.items() if k not in ("paleoData", "chronData")}):
            yield name, None, p, v
        for kind, place, c in columns_of(m):
            for p, v in flatten({k: v for k, v in c.items() if k != "TSid"}):
                yield name, text_of(c.get("TSid")), f"{kind}.{place}.{p}", v
        for member, rows in data_members(content).items():
            body = "\n".join(",".join(cell.strip() for cell in row) for row in rows)
            yield name, None, f"data.{member}", f"<{len(rows)} x {max(map(len, rows), default=0)}:{hashlib.md5(body.encode()).hexdigest()[:12]}>"

    return _each(archives, make, "dataset string, tsid string, path string, value string")


def verify(archives: DataFrame, least: int = 200) -> DataFrame:
    """Issues of staged archives: too small, unreadable, nameless, or not structurally valid."""

    def make(path, content):
        if len(content) < least:
            yield path, "too_small", str(len(content))
        try:
            m = metadata(content)
        except Exception as error:  # noqa: BLE001
            yield path, "unreadable", str(error)
            return
        if not text_of(m.get("dataSetName")):
            yield path, "no_name", None
        if not isinstance(m.get("geo"), dict):
            yield path, "no_geo", None
        if any(isinstance(p.get("author"), str) for p in m.get("pub") or []):
            yield path, "author_not_listed", None
        if sum(1 for _ in columns_of(m)) < 2:
            yield path, "few_columns", None

    return _each(archives, make, "path string, check string, value string")


def packed(documents: DataFrame) -> DataFrame:
    """Archives made from the driver's documents, to show the readers at work: some damaged, some small, some nameless.

    A data member holds the whole text, a row for each piece of it, as the csv module reads no longer fields.
    """

    def pieces(text):
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows([text[k : k + 32768]] for k in range(0, len(text), 32768))
        return out.getvalue()

    def run(batches):
        for batch in batches:
            paths, contents = [], []
            for i, text, lang, source, n in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang", "source", "n_chars")), strict=True):
                words = (text or "").split(None, 40)[:40]
                meta = {"dataSetName": None if i % 23 == 0 else f"S{i}.Author.{1990 + i % 30}", "datasetId": f"ID{i}", "archiveType": lang, "changelog": [{"version": f"1.0.{i % 12}"}, {"version": "1.0.3"}], "geo": {"latitude": i % 90, "siteName": source} if i % 19 else None,
                        "pub": [{"author": [{"name": source}] if i % 17 else source, "title": " ".join(words[:5])}],
                        "paleoData": [{"measurementTable": [{"columns": [{"TSid": f"T{i}-{k}", "variableName": w, "values": [n, k], "inCompilation": [{"compilationName": source}]} for k, w in enumerate(words[: 1 + i % 3])]}]}]}
                paths.append(f"/{i}.lpd")
                contents.append(b"not a zip" if i % 29 == 0 else pack(meta, {"d.csv": "1,2\n3,4\n", "text.csv": pieces(text or "")}))
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(contents, pa.binary())], ["path", "content"])

    return documents.select("doc_id", "text", "lang", "source", "n_chars").mapInArrow(run, "path string, content binary")
