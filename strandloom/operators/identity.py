"""Scans, the index of datasets and series, identity checks, and safe ids for incoming records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.expr import blank, row_fingerprint

ISSUE_COLUMNS = ("check", "severity", "message", "datasetId", "dataSetName", "TSid", "field", "value", "path")


def issues(df: DataFrame, check: str, severity, **columns) -> DataFrame:
    """Rows as issues with the fixed columns; severity is info, warn or error, or a column of them."""
    if isinstance(severity, str):
        if severity not in ("info", "warn", "error"):
            raise ValueError(f"no severity {severity}")
        severity = F.lit(severity)
    named = {"check": F.lit(check), "severity": severity, **columns}
    return df.select(*[named.get(c, F.lit(None)).cast("string").alias(c) for c in ISSUE_COLUMNS])


def bind(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def issue_counts(found: DataFrame) -> DataFrame:
    return found.agg(*[F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in ("error", "warn", "info")])


def issue_summary(found: DataFrame) -> DataFrame:
    """Counts by severity and check, errors first."""
    rank = F.when(F.col("severity") == "error", 1).when(F.col("severity") == "warn", 2).otherwise(3)
    return found.groupBy("severity", "check").agg(F.count("*").alias("n")).withColumn("rank", rank).orderBy("rank", F.desc("n"), "check")


def check_issues(found: DataFrame, path: str | None = None, what: str = "validation") -> DataFrame:
    """found, unless it holds errors: then the whole report is written first, if a path is given, and the run stops."""
    n = issue_counts(found).first()["n_error"]
    if not n:
        return found
    if path is not None:
        found.write.mode("error").option("header", True).csv(path)
    raise ValueError(f"{what} found {n} errors" + (f"; the report is in {path}" if path else ""))


def scan_fingerprint(scan: DataFrame) -> DataFrame:
    """One row over (name, md5) pairs, in any order and without times."""
    return scan.agg(row_fingerprint("name", "md5").alias("fingerprint"))


def scan_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Names added, removed or changed between two scans."""
    o, n = old.select("name", F.col("md5").alias("o")), new.select("name", F.col("md5").alias("n"))
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o") != F.col("n"), "changed")
    return o.join(n, "name", "full_outer").select("name", change.alias("change")).where("change is not null")


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every path of two manifests with what became of it and by how many bytes. Both: path, md5, bytes."""
    o, n = old.select("path", F.col("md5").alias("o"), F.col("bytes").alias("old_bytes")), new.select("path", F.col("md5").alias("n"), F.col("bytes").alias("new_bytes"))
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o") != F.col("n"), "changed").otherwise("same")
    return o.join(n, "path", "full_outer").select("path", change.alias("change"), (F.coalesce("new_bytes", F.lit(0)) - F.coalesce("old_bytes", F.lit(0))).alias("delta"))


def duplicate_values(df: DataFrame, column: str, file: str = "file") -> DataFrame:
    """Values that are not blank and occur more than once, with their sorted files."""
    grouped = df.where(~blank(column)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(F.col(file).cast("string"))), ", ").alias("files"))
    return grouped.where("n > 1")


def duplicate_tsid_scope(series: DataFrame) -> DataFrame:
    """Series ids that occur more than once, and whether inside one dataset or across."""
    grouped = series.where(~blank("tsid")).groupBy("tsid").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("dataset_id")).alias("d"))
    scope = F.when(F.size("d") == 1, "within_dataset").otherwise("across_datasets")
    return grouped.where("n > 1").select("tsid", "n", scope.alias("scope"), F.array_join("d", ";").alias("datasets"))


def validate_identity(datasets: DataFrame, series: DataFrame, strict: bool = False) -> DataFrame:
    """Issues of an index: unreadable files, missing, mismatching and duplicate names and ids, series without ids or datasets without series."""
    hard = "error" if strict else "warn"
    name, ident, file = F.col("dataSetName"), F.col("datasetId"), F.col("file")
    keep = {"datasetId": ident, "dataSetName": name, "path": file}
    found = [
        issues(datasets.where("parse_error is not null"), "unreadable", "error", **keep),
        issues(datasets.where(blank("datasetId") & F.col("parse_error").isNull()), "missing_datasetId", "warn", **keep),
        issues(datasets.where(blank("dataSetName") & F.col("parse_error").isNull()), "missing_dataSetName", "error", **keep),
        issues(datasets.where(~blank("dataSetName") & (F.col("fileDataSetName") != name)), "filename_metadata_mismatch", "warn", **keep),
        issues(series.where(blank("tsid")), "missing_TSid", "warn", datasetId=F.col("dataset_id")),
        issues(datasets.join(series.select(F.col("dataset_id").alias("datasetId")).distinct(), "datasetId", "left_anti").where("parse_error is null"), "no_timeseries", "warn", **keep),
    ]
    for column, check, severity in (("datasetId", "duplicate_datasetId", hard), ("dataSetName", "duplicate_dataSetName", hard), ("fileDataSetName", "duplicate_filename", "error")):
        found.append(issues(duplicate_values(datasets, column), check, severity, value=F.col("value"), message=F.col("files")))
    found.append(issues(duplicate_tsid_scope(series), "duplicate_TSid", hard, TSid=F.col("tsid"), message=F.col("scope"), value=F.col("datasets")))
    return bind(*found)


def ingest_identity(incoming: DataFrame, index: DataFrame) -> DataFrame:
    """For each incoming column keep, mint or remint its series id, or report an error in its file.

    index: tsid, dataset_id, dataset_name of what is there. A claimed id is kept only where the incoming dataset updates
    the claiming one; an unclaimed id that several incoming files use is reminted everywhere.
    """
    claim = index.groupBy("tsid").agg(F.min(F.struct("dataset_id", "dataset_name")).alias("c"))
    files = incoming.where(~blank("tsid")).groupBy("tsid").agg(F.count_distinct("file").alias("n_files"))
    joined = incoming.join(claim, "tsid", "left").join(files, "tsid", "left")
    claimed = F.col("c").isNotNull()
    update = claimed & ((F.col("c.dataset_id") == F.col("dataset_id")) | (F.col("dataset_id").isNull() & (F.col("c.dataset_name") == F.col("dataset_name"))))
    action = (
        F.when(F.col("error").isNotNull(), "error")
        .when(blank("tsid"), "mint")
        .when(F.coalesce(update, F.lit(False)), "keep")
        .when(claimed, "remint")
        .when(F.col("n_files") > 1, "remint")
        .otherwise("keep")
    )
    return joined.select("file", "position", "tsid", action.alias("action"), F.col("c.dataset_id").alias("claimed_by"))


def minted(plan: DataFrame, taken: DataFrame, run_id: str, tries: int = 3) -> DataFrame:
    """plan with new ids for mint and remint rows, from a hash of run, file and position, so that a retried task makes the same.

    Each try that meets a taken or repeated id moves on to the next; an id that is still taken after them is an error.
    """
    make = lambda k: F.concat(F.lit("SL"), F.substring(F.md5(F.concat_ws("\x1f", F.lit(f"{run_id}/{k}"), "file", F.col("position").cast("string"))), 1, 20))
    wanted = plan.where(F.col("action").isin("mint", "remint")).withColumn("options", F.array(*[make(k) for k in range(tries)]))
    used = taken.select(F.col("tsid").alias("option")).distinct()
    free = wanted.select("file", "position", F.posexplode("options").alias("k", "option")).join(used, "option", "left_anti")
    chosen = free.groupBy("file", "position").agg(F.min(F.struct("k", "option")).alias("o")).select("file", "position", F.col("o.option").alias("new_tsid"))
    out = plan.join(chosen, ["file", "position"], "left")
    return out.withColumn("new_tsid", F.when(F.col("action").isin("mint", "remint"), F.coalesce("new_tsid", F.raise_error("no free id")))).withColumn("new_tsid", F.coalesce("new_tsid", F.when(F.col("action") == "keep", F.col("tsid"))))


def ingest_issues(plan: DataFrame) -> DataFrame:
    picked = plan.where(F.col("action").isin("remint", "error"))
    severity = F.when(F.col("action") == "remint", "warn").otherwise("error")
    return issues(picked, "ingest_identity", severity, TSid=F.col("tsid"), message=F.col("action"), path=F.col("file"))


NAME = r"^[A-Za-z0-9-]+[.][A-Za-z-]+[.][0-9][0-9][0-9][0-9]$"


def ingest_validate(incoming: DataFrame, index: DataFrame) -> DataFrame:
    """Checks on incoming datasets, one projection of all conditions and one explode.

    incoming: file, file_name, name, archive, latitude, longitude, has_publication, error. index: name of datasets there.
    """
    there = index.select("name").distinct().withColumn("is_there", F.lit(True))
    name, year = F.col("name"), F.regexp_extract("name", r"([0-9]{4})$", 1).try_cast("int")
    joined = incoming.join(there, "name", "left")
    ok = F.col("error").isNull()
    named = ok & ~blank(name)
    checks = [
        ("unreadable", "error", ~ok),
        ("name_missing", "error", ok & blank(name)),
        ("name_illegal", "error", named & name.rlike(r"[/\\:*?\"<>|]")),
        ("name_placeholder", "warn", named & name.rlike(r"(?i)^(test|untitled|unknown|new)([.]|$)")),
        ("name_space", "warn", named & name.contains(" ")),
        ("name_non_ascii", "warn", named & name.rlike(r"[^\x00-\x7F]")),
        ("name_unconventional", "info", named & ~name.rlike(NAME)),
        ("name_year", "warn", named & year.isNotNull() & ~year.between(1500, 2030)),
        ("name_file_mismatch", "warn", named & (F.col("file_name") != name)),
        ("name_update", "info", named & F.coalesce("is_there", F.lit(False))),
        ("archive_missing", "error", ok & blank("archive")),
        ("coordinates_missing", "error", ok & (F.col("latitude").isNull() | F.col("longitude").isNull())),
        ("latitude_range", "error", ok & ~F.col("latitude").between(-90, 90)),
        ("longitude_range", "error", ok & ~F.col("longitude").between(-180, 360)),
        ("publication_missing", "warn", ok & ~F.col("has_publication")),
    ]
    found = F.filter(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(c).alias("check"), F.lit(s).alias("severity"))) for c, s, test in checks]), lambda x: x.isNotNull())
    return joined.select("file", "name", F.inline(found)).select("check", "severity", "file", "name")


def structure_mismatch(planned: DataFrame, staged: DataFrame) -> DataFrame:
    """Files whose staged columns differ from the plan in number, order or name. Both: file, position, variable."""
    listed = lambda df, n: df.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "variable"))), lambda x: x["variable"]), ",").alias(n))
    return listed(planned, "planned").join(listed(staged, "staged"), "file", "full_outer").where(~F.col("planned").eqNullSafe(F.col("staged")))


def lost_values(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files with fewer numeric values after staging than before. Both: file, n_values."""
    a = after.select("file", F.col("n_values").alias("n_after"))
    return before.select("file", F.col("n_values").alias("n_before")).join(a, "file", "left").withColumn("n_after", F.coalesce("n_after", F.lit(0).cast("long"))).where("n_after < n_before")
