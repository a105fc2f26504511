"""Whole rows kept or repeated by what was decided on slim ones, without a shuffle of the whole rows.

Slim rows carry the number of the partition that they were read in. What is decided on them is written by that number to
the shared folder, and a second pass over the same partitions looks its own rows up there (taken). A task holds the decisions of its
partition only. Where no Python is wanted, decisions are looked up by a row's place in its partition instead (repeated).
A row without a decision is an error, so partitions that were dealt anew between the passes can't lose one.
"""

from __future__ import annotations

import glob
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.common import _STAGED, bounded, row_blocks, staged, work_dir

#: Copies of a row that repeated() can hold, and rows whose decisions it takes to all tasks (two bytes each).
MOST, HELD = 127, 1 << 24


def part():
    """The number of the partition that a row is read in."""
    return F.spark_partition_id()


def place():
    """The position of a row in the partition that it is read in, from 0."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def reachable(spark: SparkSession) -> bool:
    """Whether Python workers can open the shared folder as files."""
    return urlparse(work_dir(spark)).scheme in ("", "file")


def steady(df: DataFrame) -> DataFrame:
    """df so that its partitions are the same whenever it is read: staged where an exchange deals its rows, with the number of splits held."""
    spark, key = df.sparkSession, "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    dealt = "Exchange" in df._jdf.queryExecution().sparkPlan().toString() or "Exchange" in df._jdf.queryExecution().executedPlan().toString()
    return staged(df, "steady") if dealt else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names with underscores in front until no column of df is called so."""
    held = {c.lower() for c in df.columns}
    ahead = "_"
    while any(ahead + n in held for n in names):
        ahead += "_"
    return [ahead + n for n in names]


def taken(rows: DataFrame, decided: DataFrame, columns: list[str], keys: list[str], at: str, text: str) -> DataFrame:
    """The columns of rows, each row as often as decided says.

    rows: columns, keys and the partition under the name at. decided: part, copies and keys by their order.
    """
    spark = rows.sparkSession
    path = f"{work_dir(spark)}/strandloom/decided-{uuid.uuid4().hex}"
    named = decided.select("part", "copies", *[F.col(c).alias(f"k{i}") for i, c in enumerate(c for c in decided.columns if c not in ("part", "copies"))])
    named.repartition("part").write.partitionBy("part").parquet(path)
    _STAGED.append(path)
    local = unquote(urlparse(path).path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = {}, None
        for block in row_blocks(batches, text):
            found = block.column(at)[0].as_py()
            if found != own:
                own, held = found, {}
                for file in glob.glob(f"{glob.escape(local)}/part={own}/*.parquet"):
                    table = pq.ParquetFile(file).read()
                    held.update(zip(zip(*[table.column(f"k{i}").to_pylist() for i in range(len(keys))], strict=True), table.column("copies").to_pylist(), strict=True))
            wanted = np.zeros(block.num_rows, np.int64)
            for i, key in enumerate(zip(*[block.column(c).to_pylist() for c in keys], strict=True)):
                if key not in held:
                    raise RuntimeError(f"partition {own} has a row that was not in it when decisions were made")
                wanted[i] = held[key]
            yield block.select(columns).take(pa.array(np.repeat(np.arange(block.num_rows), wanted)))

    return rows.select(*columns, *[c for c in [*keys, at] if c not in columns]).transform(bounded).mapInArrow(run, rows.select(*columns).schema)


def repeated(rows: DataFrame, decided: DataFrame, mark) -> DataFrame:
    """Each row as often as decided says, with DataFrame functions only: no shuffle, no join and no Python on whole rows.

    decided: part, place, copies and mark, a long for each row, that must be the same in rows. Copies, up to MOST, and eight bits of the
    mark are packed in two bytes a row, which all tasks get as one value, an array for each partition. A row whose decision is missing or has another mark is an error.
    """
    code = F.when(F.col("copies").between(0, MOST), (F.col("copies") * 256 + F.pmod("mark", F.lit(256))).cast("smallint"))
    code = F.coalesce(code, F.raise_error(F.lit(f"more than {MOST} copies of a row")).cast("smallint"))
    lists = decided.select("part", "place", code.alias("code")).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("place", "code"))).alias("codes"))
    lists = lists.select("part", F.transform("codes", lambda c: c["code"]).alias("codes"))
    by_part = F.map_from_entries(F.collect_list(F.struct("part", "codes")))
    dense = F.transform(F.sequence(F.lit(0), F.max("part")), lambda p: F.try_element_at(by_part, p))
    (own,) = free_names(rows, "code")
    table = staged(lists.agg(dense.alias("codes")), "decided").select("codes").scalar()
    found = F.get(F.get(table, part()), place().cast("int"))
    told = rows.withColumn(own, found.cast("int"))
    lost = F.raise_error(F.lit("a partition has a row that was not in it when decisions were made")).cast("int")
    copies = F.when(F.pmod(F.col(own), F.lit(256)) == F.pmod(mark, F.lit(256)), F.floor(F.col(own) / 256).cast("int")).otherwise(lost)
    return told.withColumn(own, F.explode(F.array_repeat(F.lit(0), copies))).select(*rows.columns)
