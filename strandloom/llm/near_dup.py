"""Near-duplicate documents by a chosen-path set similarity join over word shingles.

1. Sketch. Each text becomes the set of its hashed word shingles, a digest of that set, one minwise token for each tree,
   64 one-byte minwise values and BRANCHING four-byte ones. Documents with equal sets form a class, which goes on as one row.
2. Trees. In each of TREES independent trees a class starts at the node of its minwise token. Nodes of one class end;
   nodes of up to NODE classes are compared exhaustively; larger nodes branch by runs of the four-byte values, chosen
   by the node, into as many children as keep a pair at the threshold together once on average at every level. The
   values are so wide that only classes which share a shingle meet again. Nodes that are still large after the last
   level are compared exhaustively too, in pairs of blocks; so are, earlier, large nodes with one label but for a few
   members. The first trees only join dense groups, so that the others meet them joined: they branch less, and once
   deal large nodes to blocks that share four of their members.
3. Candidates. Inside a node, pairs whose one-byte values agree enough and whose set sizes allow the threshold join up to
   groups. Equal groups from several trees are kept once; a group whose sets together exceed HELD shingles is cut into
   blocks, and every two blocks are a group.
4. Links. Groups get their members' full sets, and a member is compared with all others that no verified chain of
   links joins to it, by one count over an inverted list of the group's shingles. Trees are taken in two rounds; in the
   second, nodes whose members the first has all joined end at once, so large groups of copies go through few trees.
5. Components of the verified links, and back from classes to documents.

Only hashed paths, sketches and the sets of candidate classes are shuffled. No group is listed pair by pair.

Defined results: empty or null text, or text without words, has no shingle and stands alone; text with fewer words
than a shingle is one shingle; repeated rows are copies of each other; a null doc_id takes part but is never the
component's id unless all are null; one doc_id with different texts counts as different documents of that id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import decided
from strandloom.llm.common import bounded, ragged, row_blocks, staged
from strandloom.llm.components import components

TREES, VALUES, BRANCHING, NODE = 14, 64, 32, 768
#: Lengths of the runs by which large nodes branch: in the first trees, one child or two; in the others, children enough for a pair at the threshold.
FIRST_LEVELS, LEVELS = (1, 2, 3, 6, 14, 34), (1, 2, 3, 6)
ROUNDS = ((0, 1), (2, TREES - 1))
#: The level at which large nodes of the first trees are dealt to blocks, as well as branched.
DEALT = 1
#: Standard errors of the estimate by which a pair may miss the threshold and still be verified.
SLACK = 3.5
#: Shingles of all sets of a group that one task holds at once.
HELD = 1 << 22

_rng = np.random.default_rng(20240229)
_BYTES, _TAKES = (_rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in (256, 16))
_MULS, _XORS = (_rng.integers(1, 1 << 63, TREES + VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_SPACE = np.zeros(256, bool)
_SPACE[9:14] = _SPACE[32] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        step = 0x9E3779B97F4A7C15
        for name, base in (("up", step), ("down", pow(step, -1, 1 << 64))):
            _POWERS[name] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))]))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; words are runs without ASCII white space, A-Z in lower case."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
    bounds = 1 + np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    inside = ~_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    first = np.searchsorted(starts, bounds)
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * up)])
        words = _mixed((sums[ends] - sums[starts]) * down[starts])
        shingles = sum(words[k : len(words) - width + 1 + k] * _TAKES[k] for k in range(width)) if len(words) >= width else np.zeros(0, np.uint64)
        shingles = _mixed(shingles)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(shingles[a : b - width + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                out.append(_mixed(np.array([(words[a:b] * _TAKES[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minwise(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For non-empty sets: TREES minwise tokens (64 bits), VALUES one-byte minwise values and BRANCHING of four bytes each."""
    joined, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    found = np.empty((len(sets), TREES + VALUES), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(TREES + VALUES):
            found[:, k] = np.minimum.reduceat((joined ^ _XORS[k]) * _MULS[k], starts)
        values = _mixed(found[:, TREES:])
    return found[:, :TREES], (values >> np.uint64(56)).astype(np.uint8), (values[:, :BRANCHING] >> np.uint64(16)).astype("<u4")


def packed_set(values: np.ndarray) -> bytes:
    """The upper 48 bits of each shingle's hash, which tell the shingles of a group apart: 2**22 of them coincide in 0.03 places on average."""
    return (values >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_set(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def sketches(df: DataFrame, width: int) -> DataFrame:
    """doc_id, mark, part, n_shingles, key, paths, sig, wide; the last four are null for an empty set. df has doc_id, mark, part and text."""
    names = ["doc_id", "mark", "part", "n_shingles", "key", "paths", "sig", "wide"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "text"):
            sets = shingle_sets(block.column("text").to_pylist(), width)
            full = [k for k, s in enumerate(sets) if len(s)]
            keys, sigs, paths, wide = [None] * len(sets), [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if full:
                tokens, values, long = minwise([sets[k] for k in full])
                for i, k in enumerate(full):
                    keys[k], sigs[k], paths[k], wide[k] = set_key(sets[k]), values[i].tobytes(), tokens[i].view(np.int64).tolist(), long[i].tobytes()
            columns = [block.column("doc_id"), block.column("mark"), block.column("part"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(paths, pa.list_(pa.int64())), pa.array(sigs, pa.binary()), pa.array(wide, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.transform(bounded).mapInArrow(run, "doc_id long, mark long, part int, n_shingles long, key binary, paths array<long>, sig binary, wide binary")


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Runs of rows with one key, from batches sorted by it."""
    held: list[dict] = []
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


class Joined:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def candidate_groups(sigs: np.ndarray, sizes: np.ndarray, labels: np.ndarray, percent: int) -> list[list[int]]:
    """Positions joined by pairs of different labels whose values agree and whose sizes fit, in groups of two at least."""
    t = percent / 100
    chance = t + (1 - t) / 256
    least = VALUES * chance - SLACK * np.sqrt(VALUES * chance * (1 - chance))
    joined = Joined(len(sigs))
    for i in range(len(sigs) - 1):
        same = (sigs[i + 1 :] == sigs[i]).sum(1) >= least
        low, high = np.minimum(sizes[i + 1 :], sizes[i]), np.maximum(sizes[i + 1 :], sizes[i])
        for j in np.flatnonzero(same & (100 * low >= percent * high) & (labels[i + 1 :] != labels[i])).tolist():
            joined.join(i, i + 1 + j)
    groups: dict[int, list[int]] = {}
    for i in range(len(sigs)):
        groups.setdefault(joined.root(i), []).append(i)
    return [g for g in groups.values() if len(g) > 1]


def block_pairs(nodes: DataFrame) -> DataFrame:
    """(tree, path, node) with a node for every two blocks of each given node, so that any two members meet. nodes: tree, path, node, n."""
    blocks = F.ceil(F.col("n") / (NODE // 2)).cast("int")
    own = nodes.withColumn("m", blocks).withColumn("b", F.pmod(F.xxhash64("node", "path"), F.col("m")).cast("int"))
    met = own.select("tree", "path", "node", "b", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("o"))
    return met.select("tree", F.xxhash64("path", F.least("b", "o"), F.greatest("b", "o"), F.lit("pair")).alias("path"), "node")


def by_main_label(big: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Large nodes whose members all have one label but for a node's worth of others, as blocks of that label's members with all the others; and the rest.

    A block holds a node's worth of members, so the others' rows are hardly more than the members'.
    """
    of_label = big.groupBy("path", "label").agg(F.count("*").alias("c"))
    main = staged(of_label.groupBy("path").agg(F.max_by("label", "c").alias("main"), F.max("c").alias("most")), "mains", slim=True)
    told = big.join(main, "path")
    few = F.col("n") - F.col("most") <= NODE
    blocks = F.ceil(F.col("most") / NODE).cast("int")
    own = F.when(F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("node", "path"), blocks).cast("int"))).otherwise(F.sequence(F.lit(0), blocks - 1))
    ended = told.where(few).select("tree", "path", "node", F.explode(own).alias("b")).select("tree", F.xxhash64("path", "b", F.lit("star")).alias("path"), "node")
    return ended, told.where(~few).drop("main", "most")


def tree_nodes(classes: DataFrame, low: int, high: int, percent: int) -> DataFrame:
    """(tree, path, node) for the small nodes of trees low to high that hold different labels, and for blocks of large ones. classes: node, label, paths, wide."""
    levels = LEVELS if low else FIRST_LEVELS
    pick = F.posexplode(F.slice("paths", low + 1, high - low + 1)).alias("k", "token")
    current = classes.select("node", "label", pick).select("node", "label", (F.col("k") + low).alias("tree"), F.xxhash64(F.col("k") + low, "token").alias("path"))
    ranks = [] if low else [F.xxhash64("node", "tree", F.lit(k)) for k in (1, 2)]
    ends = [f(r).alias(f"end{i}{j}") for i, r in enumerate(ranks) for j, f in enumerate((F.min, F.max))]
    leaves = None
    for level in range(len(levels) + 1):
        sizes = staged(current.groupBy("path").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), *ends).where("lo < hi").drop("lo", "hi"), "sizes", slim=True)
        hit = staged(current.join(sizes, "path"), "nodes", slim=True)
        small = hit.where(F.col("n") <= NODE).select("tree", "path", "node")
        leaves = small if leaves is None else leaves.union(small)
        if sizes.where(F.col("n") > NODE).isEmpty():
            break
        big = staged(hit.where(F.col("n") > NODE), "big", slim=True)  # a table of its own, so that joins are planned by its size
        if low:
            ended, big = by_main_label(big)
            leaves = leaves.union(ended)
            if level == len(levels):
                leaves = leaves.union(block_pairs(big))
        elif level in (DEALT, len(levels)):
            blocks = F.ceil(F.col("n") / (NODE // 2))
            hub = ranks[0].isin(F.col("end00"), F.col("end01")) | ranks[1].isin(F.col("end10"), F.col("end11"))
            own = F.when(hub, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64("node", "path"), blocks)))
            leaves = leaves.union(big.select("tree", "path", "node", F.explode(own).alias("block")).select("tree", F.xxhash64("path", "block", F.lit("block")).alias("path"), "node"))
        if level == len(levels):
            break
        twice = F.concat("wide", "wide")
        at = lambda salt: F.pmod(F.xxhash64("path", F.lit(salt)), F.lit(BRANCHING)).cast("int") * 4 + 1
        child = lambda salt: F.xxhash64("path", F.lit(salt), F.substring(twice, at(salt), F.lit(4 * levels[level])))
        wanted = (percent / 100) ** -levels[level] if low or not level else 1.0
        least, rest = divmod(round(10000 * wanted), 10000)
        again = F.pmod(F.xxhash64("path", F.lit(99)), F.lit(10000)) < rest
        always = [child(k + 1) for k in range(least)]
        paths = F.when(again, F.array(*always, child(least + 1))).otherwise(F.array(*always))
        current = staged(big.join(classes.select("node", "wide"), "node").select("node", "label", "tree", F.explode(paths).alias("path")), "branches", slim=True)
    return leaves


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs; percent is the least Jaccard similarity of linked sets."""
    return _labelled(docs, width, percent, doc_id, text).select("doc_id", "n_shingles", "component_id", "kept")


def _labelled(docs: DataFrame, width: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """near_duplicates with mark, a hash of the row's text, part, the partition that it was read in, and label, which names its component (null without shingles)."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketch = staged(sketches(slim.select("doc_id", F.xxhash64("text").alias("mark"), decided.part().alias("part"), "text"), width).withColumn("node", F.xxhash64("key")), "sketches")
    full = sketch.where("n_shingles > 0")
    once = [F.first(c).alias(n) for c, n in (("node", "node"), ("n_shingles", "n"), ("paths", "paths"), ("sig", "sig"), ("wide", "wide"))]
    classes = staged(full.groupBy("key").agg(F.min("doc_id").alias("rep"), *once).drop("key"), "classes")
    links = labels = full_sets = None
    for low, high in ROUNDS:
        if labels is None:
            labelled = classes.withColumn("label", F.col("node"))
        else:
            labelled = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        groups = _groups(labelled, low, high, percent)
        wanted = groups.select("node").distinct()
        if full_sets is not None:
            wanted = wanted.join(full_sets.select("node"), "node", "left_anti")
        reps = staged(wanted.join(classes.select("node", "rep"), "node").select(F.col("rep").alias("doc_id")).distinct(), "wanted", slim=True)
        new_sets = staged(_sets(slim.join(reps, "doc_id", "left_semi"), width), "sets")
        full_sets = new_sets if full_sets is None else full_sets.union(new_sets)
        placed = groups.join(full_sets, "node").repartition("gid").sortWithinPartitions("gid").select("gid", "node", "label", "vals")
        found = staged(placed.transform(bounded).mapInArrow(_verifier(percent), "a long, b long"), "verified")
        links = found if links is None else links.union(found)
        labels = staged(components(links), "labels", slim=True)

    named = classes.join(labels, "node", "left").select("node", "rep", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = named.join(staged(least, "least", slim=True), "label").select("node", "label", "component_id")
    out = sketch.select("doc_id", "mark", "part", "n_shingles", "node").join(staged(of_class, "components", slim=True), "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "mark", "part", "n_shingles", "label", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _groups(classes: DataFrame, low: int, high: int, percent: int) -> DataFrame:
    """(gid, node, label) of the candidate groups in trees low to high; equal groups of several nodes once. classes: node, label, n, paths, sig, wide."""
    leaves = tree_nodes(classes.select("node", "label", "paths", "wide"), low, high, percent).join(classes.select("node", "label", "n", "sig"), "node")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _batched(grouped(batches, "path")):
            rows: list[tuple[int, int, int]] = []
            for group in block:
                labels, sizes = {r["node"]: r["label"] for r in group}, {r["node"]: r["n"] for r in group}
                found = candidate_groups(np.array([list(r["sig"]) for r in group], np.uint8), np.array([r["n"] for r in group]), np.array([r["label"] for r in group]), percent)
                for nodes in (part for g in found for part in within(sorted({group[i]["node"] for i in g}), sizes)):
                    name = int.from_bytes(hashlib.blake2b(np.array(nodes, np.int64).tobytes(), digest_size=8).digest(), "little", signed=True)
                    rows += [(name, n, labels[n]) for n in nodes]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["gid", "node", "label"])

    ordered = leaves.repartition("path").sortWithinPartitions("path").select("path", "node", "label", "n", "sig")
    return staged(ordered.transform(bounded).mapInArrow(candidates, "gid long, node long, label long").distinct(), "groups", slim=True)


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, vals) of the texts' classes; a repeated row repeats its class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "text"):
            made = [s for s in shingle_sets(block.column("text").to_pylist(), width) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in made], pa.binary()), pa.array([packed_set(s) for s in made], pa.binary())], ["key", "vals"])

    return texts.transform(bounded).mapInArrow(run, "key binary, vals binary").select(F.xxhash64("key").alias("node"), "vals")


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "gid"):
            once = list({r["node"]: r for r in group}.values())
            links = links_within([r["node"] for r in once], [r["label"] for r in once], [unpacked_set(r["vals"]) for r in once], percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _batched(groups: Iterator[list[dict]], rows: int = 5000) -> Iterator[list[list[dict]]]:
    held, size = [], 0
    for g in groups:
        held.append(g)
        size += len(g)
        if size >= rows:
            yield held
            held, size = [], 0
    if held:
        yield held


def within(nodes: list[int], sizes: dict[int, int], held: int | None = None) -> Iterator[list[int]]:
    """The nodes as one group, or, if their sets together exceed held, the unions of every two blocks of at most half of it (or of one node)."""
    held = held or HELD
    if sum(sizes[n] for n in nodes) <= held:
        yield nodes
        return
    blocks: list[list[int]] = []
    size = held
    for n in nodes:
        if size + sizes[n] > held // 2:
            blocks.append([])
            size = 0
        blocks[-1].append(n)
        size += sizes[n]
    for i, first in enumerate(blocks):
        for second in blocks[i + 1 :]:
            yield sorted([*first, *second])


def shared_counts(codes: np.ndarray, starts: np.ndarray, counts: np.ndarray, members: np.ndarray, n: int, step: int = 1 << 14) -> np.ndarray:
    """How many of the codes each of n members holds, by the members listed for each code, some codes at a time."""
    out = np.zeros(n, np.int64)
    for k in range(0, len(codes), step):
        own = codes[k : k + step]
        out += np.bincount(members[ragged(starts[own], counts[own])], minlength=n)
    return out


def links_within(nodes: list[int], labels: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Verified links that join all members of a group that can be joined; members of one label count as joined."""
    n, out = len(nodes), []
    sizes, label = np.array([len(s) for s in sets]), np.unique(np.array(labels), return_inverse=True)[1]
    values, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    members = np.repeat(np.arange(n, dtype=np.int32), sizes)[np.argsort(codes, kind="stable")]
    starts, bounds = np.cumsum(counts) - counts, np.concatenate([[0], np.cumsum(sizes)])
    own = [codes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for i in sorted(range(n), key=lambda i: -counts[own[i]].mean()):
        open_ = (label != label[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        if not open_.any():
            continue
        shared = shared_counts(own[i], starts, counts, members, n)
        for j in np.flatnonzero(open_ & (100 * shared >= percent * (sizes + sizes[i] - shared))).tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((nodes[i], nodes[j]))
    return out


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: that of the smallest id, of several texts with that id one in a fixed order.

    Rows without shingles or without an id all stay; of rows with one id and one text one stays.
    """
    names = docs.columns
    docs = decided.steady(docs)
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("label"))
    rows = staged(_labelled(docs, width, percent).select("part", "doc_id", "mark", linked.alias("label")), "rows")
    found = rows.where("label is not null")
    first = staged(found.groupBy("label").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts", slim=True)
    if decided.reachable(docs.sparkSession):
        kept = rows.join(first, "label", "left").select("part", "doc_id", "mark", F.when(F.struct("doc_id", "mark") != F.col("first"), 0).otherwise(1).alias("copies"))
        id_, mark, part = decided.free_names(docs, "id", "mark", "part")
        keyed = docs.withColumns({id_: F.col("doc_id").cast("long"), mark: F.xxhash64(F.col("text").cast("string")), part: decided.part()})
        left = decided.taken(keyed, kept, names, [id_, mark], part, "text")
    else:
        lost = found.join(first, "label").where(F.struct("doc_id", "mark") != F.col("first")).select(F.col("doc_id").alias("_lost_id"), F.col("mark").alias("_lost_mark")).distinct()
        lost = staged(lost, "dropped", slim=True)
        left = docs.join(lost, (docs["doc_id"].cast("long") == F.col("_lost_id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("_lost_mark")), "left_anti")
    again = staged(found.groupBy("doc_id", "mark").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_again_id")).distinct(), "again", slim=True)
    if again.isEmpty():
        return left.select(*names)
    same = left["doc_id"].cast("long") == F.col("_again_id")
    repeated = left.join(again, same, "left_semi").withColumn("_mark", F.xxhash64("text"))
    blank = ~F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]") | F.col("text").isNull()
    once = repeated.where(~blank).dropDuplicates(["doc_id", "_mark"]).union(repeated.where(blank))
    return left.join(again, same, "left_anti").select(*names).union(once.select(*names))
