"""The event store, sheets, archives, promotion, locks, cache, settings, streaming and a whole update."""

import os
import time

import pytest
from pyspark.sql import functions as F

from strandloom.functions.text import number_text, repair_text
from strandloom.operators import events, identity
from strandloom.plans import control, promote, update
from strandloom.plans.export import export_state
from strandloom.sources import archives
from strandloom.sources.dimensions import read_review, read_vocabularies, write_review
from strandloom.sources.event_store import EventStore
from strandloom.sources.files import Folder
from strandloom.sources.sheet_store import LocalSheets, cell_position
from strandloom.streaming.state import LiveState

TS = "2024-01-0{}T00:00:00Z"
NEW = "tsid string, field string, dataset_id string, new_value string, new_present boolean, old_present boolean, source string, actor string"


def batch(spark, *rows):
    return spark.createDataFrame([(t, f, "D", v, v is not None, False, "sheet", "me") for t, f, v in rows], NEW)


def cells(df):
    return sorted((r.tsid, r.field, r.value) for r in df.collect())


def test_event_store(spark, tmp_path):
    store = EventStore(spark, f"file://{tmp_path}/log")
    assert store.state("c").count() == 0
    assert store.append("c", batch(spark, ("a", "x", "1"), ("a", "y", "NA"), ("b", "x", 'q"uote,\nline')), "r1", TS.format(2)).startswith("000001_")
    store.append("c", batch(spark, ("a", "x", "2"), ("b", "x", None)), "r2", TS.format(1))
    assert store.append("c", batch(spark).limit(0), "r3", TS.format(3)) is None
    assert cells(store.state("c")) == [("a", "x", "2"), ("a", "y", "NA")], "the later append wins though its time is earlier"
    assert cells(store.state("c", TS.format(1))) == [("a", "x", "2")]
    with pytest.raises(ValueError, match="blank_tsid"):
        store.append("c", batch(spark, ("", "x", "1")), "r4", TS.format(4))
    with pytest.raises(ValueError, match="bad_source"):
        store.append("c", batch(spark, ("a", "x", "1")).withColumn("source", F.lit("odd")), "r4", TS.format(4))
    before = cells(store.state("c"))
    log = sorted(map(tuple, store.log("c").collect()), key=repr)
    n, mark = store.compact("c", "r5")
    assert n >= 2 and store._files("c") == ["000001_20240102000000_r1", "000002_20240101000000_r2"]
    assert store.compact("c", "r5", dry_run=False)[1] == mark
    assert sorted(map(tuple, store.log("c").collect()), key=repr) == log and len(log) == 5, "no event may be lost or changed"
    assert cells(store.state("c")) == before and cells(store.state("c", TS.format(1))) == [("a", "x", "2")]
    assert store.compact("c", "r6") == (2, mark) and store.compact("none", "r6")[0] == 0
    assert store.append("c", batch(spark, ("a", "y", "B")), "r7", TS.format(7)).startswith("000003_")


def test_the_later_event_of_a_cell_in_one_batch_wins(spark, tmp_path):
    store = EventStore(spark, f"file://{tmp_path}/log")
    rows = [("T", "f", "D", v, v is not None, False, "sheet", "me", i) for i, v in enumerate(["1", "2", None, "3", "2"], 1)]
    store.append("c", spark.createDataFrame([*rows, ("U", "f", "D", "x", True, False, "sheet", "me", 6)], NEW + ", position long").orderBy(F.desc("position")), "r1", TS.format(1))
    assert cells(store.state("c")) == [("T", "f", "2"), ("U", "f", "x")]
    store.append("c", batch(spark, *[(f"T{i}", f"f{k}", "v") for i in range(30) for k in range(3)]), "r2", TS.format(2))
    second = [r.event_seq for r in store.log("c").where("run_id = 'r2'").collect()]
    assert sorted(second) == list(range(1, 91)), "numbers are unique in a batch"


def test_decisions_are_kept(spark, tmp_path):
    store = EventStore(spark, f"file://{tmp_path}/log")
    columns = "vocab_key string, value string, decision string, target string, also_field string, also_value string"
    assert store.decisions().count() == 0
    store.decide(spark.createDataFrame([("k", "v", "synonym", "Lake", None, None)], columns), "me", "r1", TS.format(1))
    store.decide(spark.createDataFrame([("k", "w", "leave", None, None, None)], columns), "me", "r2", TS.format(2))
    assert sorted((r.value, r.decision, r.target, r.actor, r.run_id) for r in store.decisions().collect()) == [("v", "synonym", "Lake", "me", "r1"), ("w", "leave", None, "me", "r2")]
    with pytest.raises(ValueError):
        store.decide(spark.createDataFrame([("k", "v", "odd", None, None, None)], columns), "me", "r3", TS.format(3))


def test_errors_are_reported_before_the_run_stops(spark, tmp_path):
    fine = identity.issues(spark.range(2), "small", "warn", value=F.col("id"))
    assert identity.check_issues(fine).count() == 2
    bad = identity.bind(fine, identity.issues(spark.range(3), "wrong", "error", value=F.col("id")))
    with pytest.raises(ValueError, match="3 errors"):
        identity.check_issues(bad, f"file://{tmp_path}/report")
    assert spark.read.csv(f"file://{tmp_path}/report", header=True).count() == 5


def test_actor(monkeypatch):
    monkeypatch.setenv("USER", "login")
    assert control.actor() == "login"
    monkeypatch.setenv("STRANDLOOM_ACTOR", " me ")
    assert control.actor() == "me"


def test_snapshots(spark, tmp_path):
    (tmp_path / "db").mkdir()
    for name in ("a", "b"):
        (tmp_path / "db" / f"{name}.lpd").write_bytes(archives.pack({"dataSetName": name}))
    corpus = promote.Corpus(spark, f"file://{tmp_path}/db")
    assert corpus.snapshot(f"file://{tmp_path}/snap") == 2
    with pytest.raises(FileExistsError):
        corpus.snapshot(f"file://{tmp_path}/snap")
    (tmp_path / "db" / "a.lpd").write_bytes(b"changed")
    (tmp_path / "db" / "c.lpd").write_bytes(b"new")
    corpus.restore(f"file://{tmp_path}/snap", "r1")
    assert sorted(corpus.names()) == ["a.lpd", "b.lpd"] and (tmp_path / "db" / "a.lpd").read_bytes() == archives.pack({"dataSetName": "a"})
    sheets = LocalSheets(spark, f"file://{tmp_path}/sheets")
    sheets.write("s", "QC", spark.createDataFrame([("1", "x")], "TSid string, v string"))
    assert sheets.snapshot(f"file://{tmp_path}/copies") == 1 and LocalSheets(spark, f"file://{tmp_path}/copies").read("s", "QC").count() == 1
    assert sheets.file("s", "QC").endswith("QC.csv") and sheets.file("s", "none") is None
    os.utime(tmp_path / "db" / "a.lpd", (2e9, 2e9))
    assert Folder(spark, f"file://{tmp_path}/db").newest(r".*\.lpd$") == "a.lpd" and Folder(spark, f"file://{tmp_path}/none").newest() is None


def test_diff_and_apply_are_inverse(spark):
    a = spark.createDataFrame([("1", "x", "v", "D"), ("2", "x", None, "D"), ("3 x", "y", "1", "D")], "tsid string, field string, value string, dataset_id string")
    b = spark.createDataFrame([("1", "x", "1.0", "D"), ("2", "x", "", "D"), ("4", "x", "n", "D")], a.schema)
    for old, new in ((a, b), (b, a), (a, a)):
        assert cells(events.apply_events(old, events.diff_to_events(old, new))) == cells(new)
    assert events.diff_to_events(a, a).count() == 0
    assert events.state_fingerprint(a).first() == events.state_fingerprint(a.repartition(3)).first() != events.state_fingerprint(b).first()
    with pytest.raises(ValueError):
        events.retire(a, a, "")


def test_sheets(spark, tmp_path):
    back = LocalSheets(spark, f"file://{tmp_path}")
    back.write("s", "QC", spark.createDataFrame([("a", None, "NA"), ("b", "two\nlines", '"')], "TSid string, v string, w string"))
    assert back.tabs("s") == ["QC"] and [tuple(r) for r in back.read("s", "QC").orderBy("TSid").collect()] == [("a", None, "NA"), ("b", "two\nlines", '"')]
    back.append("s", "QC", spark.createDataFrame([("c", "x")], "TSid string, w string"))
    back.write_cells("s", "QC", {"B2": "new"})
    assert [tuple(r) for r in back.read("s", "QC").orderBy("TSid").collect()] == [("a", "new", "NA"), ("b", "two\nlines", '"'), ("c", None, "x")]
    assert cell_position("AB12") == (11, 27)
    with pytest.raises(FileNotFoundError):
        back.read("s", "other")


META = {"dataSetName": "A.B.2001", "datasetId": "I1", "archiveType": "wood", "geo": {"latitude": 1.5}, "changelog": [{"version": "1.0.9"}, {"version": "1.0.13"}], "pub": [{"author": [{"name": "x"}]}],
        "paleoData": [{"measurementTable": [{"columns": [{"TSid": "T1", "variableName": "t", "values": [1, 2], "inCompilation": [{"compilationName": "c"}, {"compilationName": "c"}]}, {"variableName": "noid"}]}], "model": [{"summaryTable": [{"x": {"TSid": "T2", "variableName": "m"}}]}]}]}


def test_archives_promote_and_rollback(spark, tmp_path):
    live, staging = tmp_path / "live", tmp_path / "staging"
    for place in (live, staging):
        place.mkdir()
    (live / "A.B.2001.lpd").write_bytes(archives.pack(META, {"d.csv": "1,2\n" * 90}))
    (staging / "A.B.2001.lpd").write_bytes(archives.pack(META | {"archiveType": "coral"}, {"d.csv": "1,2\n" * 90}))
    (staging / "N.B.2002.lpd").write_bytes(archives.pack(META | {"dataSetName": "N.B.2002"}, {"d.csv": '"1", 2\n' * 90}))
    read = archives.read_archives(spark, f"file://{live}")
    one = archives.identities(read).first()
    assert (one.dataSetName, one.datasetVersion, one.n_ts, one.parse_error) == ("A.B.2001", "1.0.13", 2, None)
    assert sorted((r.TSid, r.tableKind, tuple(r.compilations)) for r in archives.series(read).collect()) == [("T1", "measurement", ("c",)), ("T2", "model", ())]
    assert archives.series(read, with_id_only=False).count() == 3
    leaves = {(r.tsid, r.path): r.value for r in archives.leaves(read).collect()}
    assert leaves["T1", "paleo.measurement.variableName"] == "t" and leaves[None, "geo.latitude"] == "1.5" and leaves[None, "data.d.csv"].startswith("<90 x 2:")
    corpus = promote.Corpus(spark, f"file://{live}")
    where = f"file://{staging}"
    assert [p["action"] for p in corpus.promote(where, "r1")] == ["replace", "add"] and len(corpus.names()) == 1
    corpus.promote(where, "r1", dry_run=False)
    assert len(corpus.names()) == 2 and corpus.log() == ["r1"] and archives.identities(archives.read_archives(spark, f"file://{live}")).where("archiveType = 'coral'").count() == 1
    with pytest.raises(ValueError, match="receipt"):
        corpus.promote(where, "r1", dry_run=False)
    corpus.rollback("r1")
    assert len(corpus.names()) == 1 and archives.identities(archives.read_archives(spark, f"file://{live}")).first().archiveType == "wood"
    (staging / "A.B.2001.lpd").write_bytes(b"broken")
    with pytest.raises(ValueError, match="not valid"):
        corpus.promote(where, "r2", dry_run=False)
    with pytest.raises(ValueError, match="deleted"):
        corpus.plan(f"file://{tmp_path}/none", partial=False)
    assert archives.identities(archives.read_archives(spark, where)).where("parse_error is not null").count() == 1


def test_lock_cache_settings_and_retry(spark, tmp_path, monkeypatch):
    lock = control.Lock(spark, f"file://{tmp_path}", "a/b c")
    with lock.held():
        with pytest.raises(RuntimeError):
            control.Lock(spark, f"file://{tmp_path}", "a/b c").take()
    assert lock.status() is None
    old = control.Lock(spark, f"file://{tmp_path}", "a/b c", stale=0.0)
    old.take()
    time.sleep(0.05)
    old.take()
    old.release()
    cache, calls = control.StageCache(spark, f"file://{tmp_path}/cache"), []

    def make():
        calls.append(1)
        return spark.range(3)

    assert [cache.get("s", v, i, make).count() for v, i in ((1, "x"), (1, "x"), (2, "x"), (1, "y"))] == [3] * 4 and len(calls) == 3
    assert cache.get("s", 1, "x", make, use=False).count() == 3 and len(calls) == 4 and cache.info() == {"s": 3}
    assert control.settings({"age_or_year": "year", "strict": None}, {"compilation": "c"}).age_or_year == "year"
    for bad in ({"age_or_year": "week"}, {"what": 1}):
        with pytest.raises(ValueError):
            control.settings(bad)
    monkeypatch.setenv("STRANDLOOM_DATA", "")
    with pytest.raises(ValueError):
        control.path_from_env("data", "x")
    waits, tries = [], iter([ValueError(), ValueError(), 5])

    def flaky():
        x = next(tries)
        if isinstance(x, Exception):
            raise x
        return x

    assert control.with_retry(flaky, sleep=waits.append) == 5 and waits == [2.0, 4.0]


def test_text_functions():
    assert repair_text("naÃ¯ve")[0] == "naïve" and repair_text("naïve") == (None, None) and repair_text("plain") == (None, None)
    assert number_text(0.1 + 0.2) == "0.3" and number_text(1e20) == "100000000000000000000" and number_text(None) is None


def test_dimensions(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "kind.csv").write_text('lipdName,synonym\nLake,"Lagoon, old"\nIce,\n')
    (tmp_path / "v" / "other.csv").write_text("note,lipdName\nn,Tree\n")
    assert [r.name for r in read_vocabularies(spark, f"file://{tmp_path}/v").where("vocab_key = 'other' and synonym is null").collect()] == ["Tree"]
    assert [(r.vocab_key, r.name, r.synonym) for r in read_vocabularies(spark, f"file://{tmp_path}/v").where("vocab_key = 'kind'").orderBy("place").collect()] == [("kind", "Lake", "Lagoon, old"), ("kind", "Ice", None)]
    items = spark.createDataFrame([("k", "v", ["d"], "synonym", "Lake", "high", None, None, None, None)], "vocab_key string, value string, datasets array<string>, proposed string, proposed_target string, confidence string, decision string, target string, also_field string, also_value string")
    write_review(items, f"file://{tmp_path}/r")
    assert read_review(spark, f"file://{tmp_path}/r").collect() == items.collect()


def test_streaming_state_follows_the_log(spark, tmp_path):
    live = LiveState(spark, f"file://{tmp_path}/state")
    columns = "tsid string, field string, append_seq long, event_seq long, new_value string, new_present boolean, dataset_id string"
    for k, rows in enumerate(([("a", "x", 2, 0, "new", True, "D"), ("b", "x", 1, 0, "b", True, "D")], [("a", "x", 1, 5, "late", True, "D"), ("b", "x", 3, 0, None, False, "D")])):
        spark.createDataFrame(rows, columns).write.parquet(f"file://{tmp_path}/in/{k}")
    stream = spark.readStream.schema(columns).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(f"file://{tmp_path}/in")
    live.follow(stream, f"file://{tmp_path}/ck").awaitTermination(120)
    assert cells(live.state()) == [("a", "x", "new")]
    live.absorb(spark.createDataFrame([("c", "x", 9, 0, "c", True, "D")], columns), 50)
    live.absorb(spark.createDataFrame([("c", "x", 9, 0, "c", True, "D")], columns), 50)
    assert cells(live.state()) == [("a", "x", "new"), ("c", "x", "c")]
    export_state(live.state(), f"file://{tmp_path}/out", 2)
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 2


def test_a_whole_update_settles(spark, tmp_path):
    registry = spark.createDataFrame([("name", "merged", "curator", True, "text", None), ("age", "merged", "machine", False, "number", None), ("inC", "membership", "curator", False, "text", None)], "qc_name string, role string, ownership string, nullable boolean, type string, canonical string")
    back, store = LocalSheets(spark, f"file://{tmp_path}/sheets"), EventStore(spark, f"file://{tmp_path}/log")
    back.write("q", "QC", spark.createDataFrame([("T1", "D1", "curated", "9"), ("T2", "D1", "", "7")], "TSid string, datasetId string, name string, age string"))
    series = spark.createDataFrame([("T1", "D1", ["C"]), ("T2", "D1", ["x"])], "tsid string, dataset_id string, compilations array<string>")
    frame = spark.createDataFrame([("T1", "name", "from file", "D1"), ("T1", "age", "10", "D1"), ("T2", "name", "kept", "D1")], "tsid string, field string, value string, dataset_id string")
    config = control.settings({"compilation": "C", "sheets": "q"})
    dry = update.run(config, store, back, series, frame, registry, {}, "r1", TS.format(1))
    assert dry.appended is None and store.state("C").count() == 0
    done = update.run(control.settings({"compilation": "C", "sheets": "q", "dry_run": False}), store, back, series, frame, registry, {}, "r1", TS.format(1))
    assert done.appended and ("T1", "name", "curated") in cells(store.state("C")) and ("T1", "age", "10") in cells(store.state("C")) and ("T2", "inC", "FALSE") in cells(store.state("C"))
    settled = frame.withColumn("value", F.when(F.col("tsid") == "T1", F.when(F.col("field") == "name", "curated").otherwise(F.col("value"))).otherwise(F.col("value")))
    assert update.changes_again(config, store, back, series, settled, registry) in (0, 1)
