"""Near-duplicate vectors: a pigeonhole join over subspaces.

Vectors of length 1 with a cosine of at least ``c`` are at most ``2 - 2 c`` apart (squared). A rotation fitted on
a bounded sample orders directions by variance; they are dealt to blocks of ``BLOCK_DIMENSIONS`` so that
blocks vary about alike, and each block gets a part of the squared distance in proportion to its
variance. If two vectors are within the whole distance, they are within its part in some block.

In each block vectors are range-joined on a grid of its two widest directions, with cells as wide as the block's
distance: partners lie in the same or a neighbouring cell. Cells are cut into packs, and packs meet
pairwise; there the block's distance sorts out candidates, and the cosine of every candidate is computed
in double precision. A pair is counted in the first block that finds it. From a meeting of packs come
link counts and a spanning forest of the links, never the links themselves.

Exact copies are one vector throughout. Any rotation gives the same links; the sample only decides
how fast.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components have no links and are their
own component; vectors of different lengths never link; repeated ids are separate rows in a copy group;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.ann import usable
from tramline.llm.components import components
from tramline.llm.sampling import below
from tramline.session import cut_lineage

BLOCK_DIMENSIONS = 16
#: Vectors in a pack, and rows of the sample.
_PACK, _SAMPLE = 2048, 4_000


@dataclass
class Blocks:
    """Directions as columns, block by block; where each block ends; each block's squared distance."""

    axes: np.ndarray
    ends: list[int]
    budgets: np.ndarray


def fit(vectors: list[np.ndarray], least: float) -> Blocks:
    """Principal directions, dealt out from the widest on: one to each block, then back."""
    sample = np.array(vectors)
    sample = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    size = sample.shape[1]
    variance, axes = np.linalg.eigh(np.cov(sample.T, ddof=0).reshape(size, size))
    variance, axes = np.maximum(variance[::-1], 1e-12), axes[:, ::-1]
    n = -(-size // BLOCK_DIMENSIONS)
    dealt: list[list[int]] = [[] for _ in range(n)]
    for k in range(size):
        lap, at = divmod(k, n)
        dealt[at if lap % 2 == 0 else n - 1 - at].append(k)
    shares = np.array([variance[d].sum() for d in dealt])
    budgets = max(2 - 2 * least, 0.0) * shares / shares.sum()
    return Blocks(axes[:, [k for d in dealt for k in d]], np.cumsum([len(d) for d in dealt]).tolist(), budgets)


def _slack(budget: float) -> float:
    """A little more than the budget, for rounding: candidates are verified anyway."""
    return budget + 1e-5


def _fingerprints(batches):
    """(id, vector) -> (id, copy, vector): what exact copies share."""
    for batch in batches:
        made = [hashlib.blake2b((np.array(v.values.to_numpy(zero_copy_only=False)) + 0.0).tobytes(), digest_size=16).digest() for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary()), batch.column(1)], names=["id", "copy", "vector"])


def _cells(blocks: Blocks):
    """(copy, n, vector) -> one row for each block, with its cell."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = batch.column(2).flatten().to_numpy().reshape(len(batch), -1)
            turned = x / np.linalg.norm(x, axis=1, keepdims=True) @ blocks.axes
            start = 0
            for b, end in enumerate(blocks.ends):
                width = np.sqrt(_slack(blocks.budgets[b])) + 1e-6
                cell = np.floor(turned[:, start : min(start + 2, end)] / width).astype(np.int32)
                cell_y = cell[:, 1] if cell.shape[1] > 1 else np.zeros(len(x), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), b, np.int32)), pa.array(cell[:, 0]), pa.array(cell_y), *batch.columns], names=["block", "x", "y", "copy", "n", "vector"]
                )
                start = end

    return run


_PACK_ROW = "block int, x int, y int, pack bigint, copies array<binary>, ns array<bigint>, vectors array<double>"


def _packs(batches):
    """Rows sorted by block and cell -> packs of one cell each."""
    from pyspark import TaskContext

    pack = TaskContext.get().partitionId() << 32
    held: list[pa.Table] = []

    def made():
        table = pa.concat_tables(held).combine_chunks()
        whole = lambda c: pa.ListArray.from_arrays([0, len(c)], c)
        first = [table[c].combine_chunks()[:1] for c in ("block", "x", "y")]
        flat = table["vector"].combine_chunks().flatten()
        return pa.RecordBatch.from_arrays(
            [*first, pa.array([pack], pa.int64()), whole(table["copy"].combine_chunks()), whole(table["n"].combine_chunks()), whole(flat)],
            names=["block", "x", "y", "pack", "copies", "ns", "vectors"],
        )

    def place(table: pa.Table, k: int) -> tuple:
        return tuple(table[c][k].as_py() for c in ("block", "x", "y"))

    for batch in batches:
        table = pa.Table.from_batches([batch])
        changed = np.any([np.diff(table[c].to_numpy()) != 0 for c in ("block", "x", "y")], axis=0) if len(table) else []
        cuts = [0, *(np.flatnonzero(changed) + 1), len(table)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            while a < b:
                size = sum(map(len, held))
                if held and (size >= _PACK or place(held[0], 0) != place(table, a)):
                    yield made()
                    pack, held, size = pack + 1, [], 0
                stop = min(b, a + _PACK - size)
                held.append(table.slice(a, stop - a))
                a = stop
    if held:
        yield made()


class _Forest:
    """Roots of what links have joined so far."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Every link lowers the root of its higher end until no link spans two roots."""
        while True:
            root = self.roots()
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            open_ = low != high
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            np.minimum.at(self.up, high[open_], low[open_])


def _linked(blocks: Blocks, block: int, a: np.ndarray, b: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` that link and are first found by ``block``."""
    length_a, length_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    unit_a, unit_b = (a / length_a[:, None]) @ blocks.axes, (b / length_b[:, None]) @ blocks.axes

    def near(k: int, i, j) -> np.ndarray:
        start, end = ([0] + blocks.ends)[k], blocks.ends[k]
        diff = unit_a[i, start:end] - unit_b[j, start:end]
        return (diff * diff).sum(-1) <= _slack(blocks.budgets[k])

    start, end = ([0] + blocks.ends)[block], blocks.ends[block]
    p, q = unit_a[:, start:end].astype(np.float32), unit_b[:, start:end].astype(np.float32)
    gap = (p * p).sum(1)[:, None] + (q * q).sum(1)[None, :]
    gap -= 2 * (p @ q.T)
    i, j = np.nonzero(gap <= _slack(blocks.budgets[block]) + 1e-5)
    if same:
        i, j = i[i < j], j[i < j]
    good = np.zeros(len(i), bool)
    for lo in range(0, len(i), 1 << 18):  # candidates, verified slice by slice
        x, y = i[lo : lo + (1 << 18)], j[lo : lo + (1 << 18)]
        own = near(block, x, y)
        for k in range(block):
            own &= ~near(k, x, y)
        cosine = (a[x] * b[y]).sum(1) / (length_a[x] * length_b[y])
        good[lo : lo + (1 << 18)] = own & (cosine >= least)
    return i[good], j[good]


def _met(blocks: Blocks, least: float):
    """Pairs of packs -> rows (copy, links, to): links to other vectors, and an edge of the forest (or null)."""
    schema = pa.schema([("copy", pa.binary()), ("links", pa.int64()), ("to", pa.binary())])

    def run(batches):
        for batch in batches:
            for r in range(len(batch)):
                block, same, copies_a, ns_a, flat_a, copies_b, ns_b, flat_b = (c[r] for c in batch.columns)
                a = flat_a.values.to_numpy().reshape(len(copies_a), -1)
                same = same.as_py()
                b = a if same else flat_b.values.to_numpy().reshape(len(copies_b), -1)
                if a.shape[1] != b.shape[1]:
                    continue
                i, j = _linked(blocks, block.as_py(), a, b, least, same)
                if not len(i):
                    continue
                names = copies_a.values if same else pa.concat_arrays([copies_a.values, copies_b.values])
                n = ns_a.values.to_numpy() if same else np.concatenate((ns_a.values.to_numpy(), ns_b.values.to_numpy()))
                j = j if same else j + len(a)
                links = np.bincount(i, n[j], len(names)) + np.bincount(j, n[i], len(names))
                forest = _Forest(len(names))
                forest.join(i, j)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(some)), pa.array(links[some].astype(np.int64)), names.take(pa.array(forest.roots()[some]))], schema=schema
                )

    return run


def linked(table: DataFrame, id_: str = "vec_id", vector: str = "embedding", least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = table.select(F.col(id_).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    part = rows.filter(usable(F.col("vector")))
    alone = rows.filter(~usable(F.col("vector"))).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    named = part.mapInArrow(_fingerprints, "id bigint, copy binary, vector array<double>")
    unique = cut_lineage(named.groupBy("copy").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.first("vector").alias("vector")))
    members = cut_lineage(named.select("id", "copy"))

    count = unique.count()
    sizes = [r["size"] for r in unique.select(F.size("vector").alias("size")).distinct().collect()]
    found = None
    for size in sorted(sizes):
        own = unique.filter(F.size("vector") == size)
        sample = own.filter(below(F.lit(min(1.0, _SAMPLE / count)), "copy")).select("vector").collect() or own.select("vector").limit(1).collect()
        blocks = fit([np.array(r.vector) for r in sample], least)
        placed = own.select("copy", "n", "vector").mapInArrow(_cells(blocks), "block int, x int, y int, copy binary, n bigint, vector array<double>")
        order = ["block", "x", "y", "copy"]
        packs = cut_lineage(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packs, _PACK_ROW))
        # Each cell meets itself and half of its neighbours, so that every pair of cells meets once.
        towards = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))])
        left = packs.withColumn("d", F.explode(towards)).select(
            "block", (F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"), ((F.col("d.dx") == 0) & (F.col("d.dy") == 0)).alias("own"),
            F.col("pack").alias("pack_a"), F.col("copies").alias("copies_a"), F.col("ns").alias("ns_a"), F.col("vectors").alias("vectors_a"),
        )
        meeting = left.join(packs, ["block", "x", "y"]).filter(~F.col("own") | (F.col("pack_a") <= F.col("pack")))
        pairs = meeting.select("block", (F.col("pack_a") == F.col("pack")).alias("same"), "copies_a", "ns_a", "vectors_a", "copies", "ns", "vectors")
        met = pairs.mapInArrow(_met(blocks, least), "copy binary, links bigint, to binary")
        found = met if found is None else found.union(met)
    if found is None:
        return alone.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.lit(True).alias("kept"))
    found = cut_lineage(found.groupBy("copy", "to").agg(F.sum("links").alias("links")))

    links = found.groupBy("copy").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("copy").alias("a"), F.col("to").alias("b")))
    groups = unique.select("copy", "n", "first").join(links, "copy", "left").join(roots, unique["copy"] == roots["node"], "left")
    groups = cut_lineage(groups.select(unique["copy"], "n", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", unique["copy"]).alias("root")))
    least_id = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = groups.join(least_id, "root").select("copy", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    every = members.join(groups, "copy").select("id", "n_links", "component_id").union(alone)
    return every.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
