"""Near-duplicate embeddings by lattice hashing.

Each table projects unit vectors at random to eight dimensions and takes the nearest points of the E8 lattice; the
nearest is a vector's home cell, the next ones are neighbouring cells that it probes. Two vectors meet in a cell that
is home to one of them and home or probed to the other; meetings are verified by cosine in double precision.

Equal vectors form a class and go on as one row with a count. In a cell, a pair counts only where it is the first of
all cells in which the two meet (both lists of cells are worked out anew from the vectors), so each linked pair is
counted once without listing pairs. Cells of more than BLOCK members are cut into blocks, and each pair of blocks is a
group of its own, so no cell has to fit in one task. A vector is in a fixed number of cells whatever the table's size.

SCALE sets how fine the cells are: at 1.0 there are on the order of 10^5 of them in a table for unit vectors of many
dimensions, good for some 10^7 vectors; two vectors at cosine 0.95 meet in one table with a chance of about a half.

Defined results: null, zero and empty vectors, and those with null or non-finite components, link with nothing;
vectors of different lengths don't link; a row with a null id is counted by others but can't be the component's id;
repeated rows are copies and link with each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import bounded, staged
from strandloom.llm.components import components

TABLES, CELLS, SCALE, BLOCK, SEED = 14, 3, 1.0, 1024, 8
#: Pairs whose cells are compared at once.
PAIRS = 1 << 15


def nearest_points(x: np.ndarray, count: int) -> np.ndarray:
    """The count nearest E8 points (in half units, integers) to each row of x, nearest first.

    E8 is the integer points with an even sum, and those moved by a half in all coordinates. In either part the nearest
    is the rounded point, or that with its least certain coordinate rounded the other way where the sum is odd; the
    next ones turn other uncertain coordinates, two of them where the sum is even.
    """
    found, gaps = [], []
    rows = np.arange(len(x))
    for shift in (0.0, 0.5):
        y = x - shift
        r = np.rint(y)
        err = y - r
        order = np.argsort(-np.abs(err), axis=1)
        other = np.where(err >= 0, 1.0, -1.0)
        odd = np.rint(r.sum(1)).astype(np.int64) & 1
        for first, second in (((), ()), ((1,), (0, 1)), ((2,), (0, 2))):
            point = r.copy()
            for turn, wanted in ((first or (0,), odd == 1), (second, odd == 0)):
                for t in turn:
                    c = order[:, t]
                    point[rows, c] += np.where(wanted, other[rows, c], 0)
            point += shift
            found.append(point)
            gaps.append(((x - point) ** 2).sum(1))
    best = np.argsort(np.stack(gaps, 1), axis=1, kind="stable")[:, :count]
    return np.rint(2 * np.stack(found, 1)[rows[:, None], best]).astype(np.int64)


@lru_cache(maxsize=8)
def _projection(dims: int) -> np.ndarray:
    return np.random.default_rng([SEED, dims]).standard_normal((TABLES, dims, 8)) * SCALE


def cells_of(units: np.ndarray) -> np.ndarray:
    """(vectors, TABLES, CELLS) hashed cells; the first of the last axis is home."""
    out = np.empty((len(units), TABLES, CELLS), np.int64)
    mult = np.random.default_rng(SEED + 1).integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for t in range(TABLES):
        points = nearest_points(units @ _projection(units.shape[1])[t], CELLS)
        with np.errstate(over="ignore"):
            h = (points.astype(np.uint64) * mult).sum(2) + np.uint64(t) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(units.shape[1])
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out[:, t] = (h ^ (h >> np.uint64(32))).view(np.int64)
    return out


def usable(vector: list | None) -> np.ndarray | None:
    if not vector or any(v is None for v in vector):
        return None
    x = np.array(vector, dtype=np.float64)
    if not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    return x / top / np.linalg.norm(x / top) + 0.0 if top > 0 else None


def first_meeting(cells: np.ndarray, here: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each pair's first common cell, one of them being home, is the given one."""
    a, b = cells[pairs[0]].reshape(len(pairs[0]), -1), cells[pairs[1]].reshape(len(pairs[0]), -1)
    home = np.zeros(a.shape[1], bool)
    home[::CELLS] = True
    least = np.full(len(a), np.iinfo(np.int64).max)
    for t in range(TABLES):
        at = slice(t * CELLS, (t + 1) * CELLS)
        met = (a[:, at, None] == b[:, None, at]) & (home[at][:, None] | home[at][None, :])
        least = np.minimum(least, np.where(met, a[:, at, None], np.iinfo(np.int64).max).min((1, 2)))
    return least == here


def near_vectors(df: DataFrame, least: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of df."""
    slim = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [usable(v) for v in batch.column("embedding").to_pylist()]
            packed = [None if u is None else u.tobytes() for u in units]
            keys = [None if p is None else hashlib.blake2b(p, digest_size=16).digest() for p in packed]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], ["vec_id", "key", "unit"])

    named = staged(slim.transform(bounded).mapInArrow(keyed, "vec_id long, key binary, unit binary").withColumn("node", F.xxhash64("key")), "units")
    classes = staged(named.where("key is not null").groupBy("node").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("unit").alias("unit")), "classes")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, units = batch.column("node").to_pylist(), batch.column("unit").to_pylist()
            for dims in sorted({len(u) for u in units}):
                own = [i for i, u in enumerate(units) if len(u) == dims]
                cells = cells_of(np.frombuffer(b"".join(units[i] for i in own), np.float64).reshape(len(own), -1))
                flat = cells.reshape(len(own), -1)
                home = np.tile(np.arange(CELLS) == 0, TABLES)
                yield pa.RecordBatch.from_arrays([pa.array(flat.ravel()), pa.array(np.repeat([nodes[i] for i in own], flat.shape[1]), pa.int64()), pa.array(np.tile(home, len(own)))], ["cell", "node", "home"])

    member = staged(classes.select("node", "unit").transform(bounded).mapInArrow(placed, "cell long, node long, home boolean"), "cells")
    shared = staged(member.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("home")).where("n > 1 and home").select("cell", "n"), "shared")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", "cell"), F.col("blocks")).cast("int")
    met = member.join(shared, "cell").withColumn("blocks", blocks).withColumn("own", own)
    other = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = other.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "home")
    full = groups.join(classes.select("node", "copies", "unit"), "node").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (held[-1]["cell"], held[-1]["i"], held[-1]["j"]) != (row["cell"], row["i"], row["j"]):
                    yield from _links(held)
                    held = []
                held.append(row)
        if held:
            yield from _links(held)

    def _links(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        units, side = [r["unit"] for r in rows], np.array([r["own"] for r in rows])
        if len(rows) < 2 or len({len(u) for u in units}) > 1:
            return
        x = np.frombuffer(b"".join(units), np.float64).reshape(len(rows), -1)
        home = np.array([r["home"] for r in rows])
        cross, cells, found = rows[0]["i"] != rows[0]["j"], None, []
        a, b = np.nonzero(np.triu(x @ x.T >= least - 1e-9, 1))
        keep = (home[a] | home[b]) & ((side[a] != side[b]) if cross else True)
        a, b = a[keep], b[keep]
        for k in range(0, len(a), PAIRS):
            p, q = a[k : k + PAIRS], b[k : k + PAIRS]
            near = np.einsum("ij,ij->i", x[p], x[q]) >= least
            p, q = p[near], q[near]
            if len(p):
                cells = cells_of(x) if cells is None else cells
                first = first_meeting(cells, rows[0]["cell"], (p, q))
                found.append((p[first], q[first]))
        if not found:
            return
        a, b = (np.concatenate(side_) for side_ in zip(*found, strict=True))
        copies, nodes = np.array([r["copies"] for r in rows]), np.array([r["node"] for r in rows])
        counts = np.bincount(a, weights=copies[b], minlength=len(rows)) + np.bincount(b, weights=copies[a], minlength=len(rows))
        lowest = np.arange(len(rows))
        for _ in range(len(rows)):
            before = lowest.copy()
            np.minimum.at(lowest, a, lowest[b])
            np.minimum.at(lowest, b, lowest[a])
            if (before == lowest).all():
                break
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[at], pa.int64()), pa.array(nodes[lowest[at]], pa.int64()), pa.array(counts[at].astype(np.int64))], ["node", "root", "links"])

    found = staged(full.transform(bounded).mapInArrow(linked, "node long, root long, links long"), "linked")
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = classes.select("node", "rep", "copies").join(labels, "node", "left").join(counts, "node", "left").withColumn("label", F.coalesce("label", "node"))
    joined = staged(joined, "joined")
    least_id = staged(joined.groupBy("label").agg(F.min("rep").alias("component_id")), "least")
    of_class = staged(joined.join(least_id, "label").select("node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "of_class")
    out = named.select("vec_id", "key", "node").join(of_class, "node", "left")
    component = F.when(F.col("key").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
