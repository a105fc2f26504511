"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Within a source the documents stand in one fixed order (by size, then by a hash, then by id). Each document expects
target / source size copies; the running sum of expectations, shifted by one random offset for the source, is emitted
once for each whole number it crosses. So every document has the floor or the ceiling of its expectation, and as
neighbours in the order are alike in size, the words taken stay close to the target.

The running sum needs no source in one task: documents are counted by (source, size), large counts are cut into hashed
bins of about BIN rows, ranks are taken inside a bin, and the bins' and sizes' own running counts, which are small,
shift them. Joins carry no broadcast hint: Spark decides by size.

Defined results: null text has size 0; null sources are one source, last in order; a source without words has target 0
and takes nothing; rows with a null id are ranked with the hash of the empty string; repeated rows are sampled one by
one; an empty table gives no rows. Other columns stay; the names this module adds must not exist yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from strandloom.llm import decided
from strandloom.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, MOST, SEED, BIN = (5, 2, 1), 3, "mix-1", 256
ADDED = ("source_size", "target", "copies", "taken")
#: Columns of steps in between, which must not exist either.
INNER = ("_key", "_first", "_bins", "_rate", "_shift", "_bin", "_ahead", "_n", "_rank", "_at")


def _unit(text):
    """A number in [0, 1) from the md5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def with_size(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))


def source_targets(counts: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """From (source, size, rows): (source, source_size, target). Weights repeat over the sources in code-point order, null last.

    Targets fill up like water: each source gets weight times one level, or its cap, and the level makes the sum that
    of all sizes. With sources sorted by cap / weight, the level is that of the first source that reaches its cap late.
    """
    by_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = by_source.withColumn("weight", F.get(cycle, place).cast("double")).withColumn("cap", (F.col("source_size") * most).cast("double"))
    weighed = weighed.withColumn("ratio", F.col("cap") / F.col("weight"))
    ordered = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, onward = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levelled = weighed.withColumn("level", level)
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(Window.partitionBy(F.lit(1)))
    return levelled.select("source", "source_size", F.least(F.col("weight") * first["level"], F.col("cap")).alias("target"))


def sample_copies(df: DataFrame, source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """df (with a size column) and per row source_size, target, copies and taken = copies * size."""
    clash = {*ADDED, *INNER} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    key = F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source)))
    keyed = df.withColumn("_key", key)
    counts = keyed.groupBy("_key", "size").agg(F.count("*").alias("rows"))
    per_size = counts.withColumn("_first", F.coalesce(F.sum("rows").over(Window.partitionBy("_key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per_size = per_size.select("_key", "size", "_first", F.ceil(F.col("rows") / BIN).alias("_bins"))
    named = counts.withColumn("source", F.when(F.col("_key") != "n", F.expr("substring(_key, 2)")))
    targets = source_targets(named, weights, most).withColumn("_key", F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))).drop("source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    shift = _unit(F.concat(F.lit(seed), F.col("_key")))
    per_size = per_size.join(targets.withColumns({"_rate": rate, "_shift": shift}), "_key")
    bin_of = F.floor(_unit(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) * F.col("_bins"))
    binned = keyed.join(per_size, ["_key", "size"]).withColumn("_bin", bin_of)
    bins = binned.groupBy("_key", "size", "_bin").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("_key", "size").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("_key", "size", "_bin", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    ranked = binned.withColumn("_rank", F.row_number().over(Window.partitionBy("_key", "size", "_bin").orderBy(doc_id)))
    placed = ranked.join(bins, ["_key", "size", "_bin"]).withColumn("_at", F.col("_first") + F.col("_ahead") + F.col("_rank"))
    upto = lambda i: F.floor(i * F.col("_rate") + F.col("_shift"))
    out = placed.withColumn("copies", upto(F.col("_at")) - upto(F.col("_at") - 1)).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*df.columns, "source_size", "target", "copies", "taken")


def mix_report(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies, taken. The text is read once; slim rows are staged."""
    slim = staged(with_size(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))).drop("text"), "sizes")
    return sample_copies(slim, **options).select("doc_id", "size", "source_size", "target", "copies", "taken")


def mix(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mixed documents themselves: each row as often as it was drawn, with the columns of docs.

    Copies are drawn on slim rows, which carry the place where their row was read. A second pass over the same partitions repeats whole
    rows by it, without a shuffle of them; only above decided.HELD rows, or if a row may be drawn more than decided.MOST times, are whole rows
    shuffled, once, to a join by id and a hash of the row. There rows alike in all columns go on as one row, drawn as often as all of them together.
    """
    docs = decided.steady(docs)
    own, key, of_id, copies = decided.free_names(docs, "row", "key", "of_id", "copies")
    hashed = F.xxhash64(*[F.map_entries(f.name) if isinstance(f.dataType, MapType) else F.col(f.name) for f in docs.schema])
    sized = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), hashed.alias("mark"), decided.part().alias("part"), decided.place().alias("place"), sized.alias("size"))
    slim = staged(slim, "sizes")
    sampled = sample_copies(slim, **options)
    if options.get("most", MOST) < decided.MOST and slim.count() <= decided.HELD:
        return decided.repeated(docs, sampled.select("part", "place", "copies", "mark"), hashed)
    drawn = sampled.groupBy("doc_id", F.col("mark").alias(own)).agg(F.sum("copies").alias(copies), F.count("*").alias("rows"))
    drawn = staged(drawn.where(F.col(copies) > 0).select(F.col("doc_id").alias(of_id), F.col(own).alias(key), copies, "rows"), "drawn", slim=True)
    met = lambda part: docs.withColumn(own, hashed).join(part.drop("rows"), F.col(doc_id).eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(key)))
    repeated = drawn.where("rows > 1")
    out = met(drawn)
    if not repeated.isEmpty():
        out = met(drawn.where("rows = 1")).unionByName(met(repeated).dropDuplicates([of_id, key]))
    return out.withColumn(of_id, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)
