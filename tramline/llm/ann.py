"""Nearest neighbours by inner product over several shifted Hilbert curves.

A model fitted on a bounded sample holds, for each curve, a random projection to a few dimensions and the
ranges from which coordinates are cut into cells; another projection for each curve shifts and turns the
cells. Every vector is put on every curve. Each curve is range-partitioned by Hilbert key, and cut
into blocks of neighbouring keys. A query meets the blocks up to ``reach`` before and after its own on
each curve; the best of all blocks are merged, after exact scoring in double precision.

How many curves and what reach are needed depends on the data: a fixed number of probe queries is compared
with all rows in blocks, and the cheapest choice that finds ``recall`` of their true neighbours is taken. If the
vectors have no structure that a curve could follow, that choice is one curve and nearly every block.

Every length of vectors is searched by itself, as there is no inner product between lengths: a driver loop, since a
table holds the vectors of a few models. Short blocks never starve a query: the reach is at least so wide that the blocks
around every place of the first curve hold ``k`` rows beside the query.

Defined cases: vectors that are null, empty, zero, or hold null or
non-finite components take no part; vectors of different lengths never meet; equal scores go to the smaller id; a query never finds its own row, but
does find other rows with the same vector; rows of one id and vector count once in a result; several query rows of one id
are answered by one list, the best of all of them; an empty table gives no rows;
further columns are ignored. Blocks, not vectors, are replicated, and a group in which blocks of queries
meet a block of candidates holds at most ``_TOGETHER`` of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.sampling import below
from tramline.session import cut_lineage

CURVES, DIMENSIONS, BITS = 4, 8, 7
#: Rows in a block, and blocks of queries that meet a block of candidates in one group.
_BLOCK, _TOGETHER = 4096, 64
_SAMPLE, _PROBES = 4_000, 200
#: Queries of a block multiplied at once with all candidates of another.
_STRIP = 256


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of rows of cell numbers below ``2 ** bits``.

    From the highest bit on, each dimension's bit decides whether the lower bits of the first dimension are
    flipped or exchanged with its own (the turn of the sub-cube); a Gray code then orders the bits.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(up, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= turn
    key = np.zeros_like(turn)
    for k in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> k & 1)
    return key


@dataclass
class Curves:
    """size: length of a vector; for each curve its projection, and lower limit and width of the cells."""

    size: int
    projections: np.ndarray
    low: np.ndarray
    width: np.ndarray

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        cells = np.floor((vectors @ self.projections[curve] - self.low[curve]) / self.width[curve])
        return hilbert_keys(np.clip(cells, 0, (1 << BITS) - 1))


def fit(vectors: DataFrame, seed: int = 11) -> Curves | None:
    """vectors: id, vector. Fitted on about ``_SAMPLE`` rows, chosen by hash of the id.

    A projection is random within the sample's principal directions, so that it follows what varies.
    """
    count = vectors.count()
    if not count:
        return None
    rows = vectors.filter(below(F.lit(min(1.0, _SAMPLE / count)), "id")).select("vector").collect() or vectors.select("vector").limit(1).collect()
    sizes = [len(r.vector) for r in rows]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    sample = np.array([r.vector for r in rows if len(r.vector) == size], float)
    rng = np.random.Generator(np.random.PCG64(seed))
    spread = np.linalg.svd(sample - sample.mean(0), full_matrices=False)
    axes = (spread[2] * (spread[1] / (spread[1].max() or 1.0))[:, None]).T
    projections = np.stack([axes @ rng.standard_normal((axes.shape[1], DIMENSIONS)) for _ in range(CURVES)])
    if len(sample) < DIMENSIONS:
        projections = rng.standard_normal((CURVES, size, DIMENSIONS))
    low, width = [], []
    for p in projections:
        seen = sample @ p
        span = np.maximum(seen.max(0) - seen.min(0), 1e-9) * 1.25
        shift = rng.random(DIMENSIONS) * span * 0.2
        low.append(seen.min(0) - shift)
        width.append(span / (1 << BITS))
    return Curves(size, projections, np.array(low), np.array(width))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _placed(curves: Curves):
    schema = pa.schema([("curve", pa.int32()), ("key", pa.int64()), ("id", pa.int64()), ("query", pa.bool_()), ("vector", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(2))
            for c in range(CURVES if len(x) else 0):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, np.int32)), pa.array(curves.keys(x, c)), batch.column(0), batch.column(1), batch.column(2)], schema=schema
                )

    return run


_BLOCK_ROW = "curve int, part int, seq int, ids array<bigint>, queries array<boolean>, vectors array<double>"


def _blocks(batches):
    """Sorted rows -> blocks of neighbours on one curve."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    seq: dict[int, int] = {}
    held: list[pa.Table] = []

    def made():
        table = pa.concat_tables(held).combine_chunks()
        curve = table["curve"][0].as_py()
        seq[curve] = seq.get(curve, -1) + 1
        one = lambda x, t: pa.array([x], t)
        return pa.RecordBatch.from_arrays(
            [
                one(curve, pa.int32()), one(part, pa.int32()), one(seq[curve], pa.int32()),
                pa.ListArray.from_arrays([0, len(table)], table["id"].combine_chunks()), pa.ListArray.from_arrays([0, len(table)], table["query"].combine_chunks()),
                pa.ListArray.from_arrays([0, len(flat := table["vector"].combine_chunks().flatten())], flat),
            ],
            names=["curve", "part", "seq", "ids", "queries", "vectors"],
        )

    for batch in batches:
        table = pa.Table.from_batches([batch])
        curves = table["curve"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(curves)) + 1), len(table)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            while a < b:
                size = sum(map(len, held))
                if held and (held[0]["curve"][0].as_py() != curves[a] or size >= _BLOCK):
                    yield made()
                    held, size = [], 0
                stop = min(b, a + _BLOCK - size)
                held.append(table.slice(a, stop - a))
                a = stop
    if held:
        yield made()


def _best(rough: np.ndarray, query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own: int | None, k: int) -> tuple[list[int], list[float]]:
    """The ``k`` best rows: ``rough``, a row of a matrix product, finds the candidates, which are scored again one by one.

    The second scoring adds up each row in the same order wherever it stands, so equal vectors tie exactly.
    """
    if own is not None:
        rough[own] = -np.inf
    if not len(rough):
        return [], []
    least = np.partition(rough, -k)[-k] if len(rough) > k else -np.inf
    (near,) = np.nonzero(rough >= least - 1e-9 * (1 + abs(least))) if np.isfinite(least) else np.nonzero(np.isfinite(rough))
    score = (vectors[near] * query).sum(1)
    order = np.lexsort((ids[near], -score))[:k]
    return ids[near][order].tolist(), score[order].tolist()


def _searched(k: int):
    """Blocks of queries meeting a block of candidates -> the best of that block for each query."""

    def run(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(candidates):
            one = candidates.iloc[0]
            ids = np.asarray(one.ids)
            vectors = np.asarray(one.vectors).reshape(len(ids), -1)
            for q in queries.itertuples():
                asked = np.asarray(q.vectors).reshape(len(q.ids), -1)
                for first in range(0, len(asked), _STRIP):
                    rough = asked[first : first + _STRIP] @ vectors.T
                    for x, line in enumerate(rough, first):
                        found, score = _best(line, asked[x], ids, vectors, int(q.places[x]) if q.place == one.place else None, k)
                        rows.append((q.place, x, q.ids[x], found, score))
        return pd.DataFrame(rows, columns=["place", "nth", "query_id", "ids", "scores"])

    return run


def _probe_truth(probes: list[tuple[int, np.ndarray]], k: int):
    """Rows id, query, vector -> for each probe the best of a partition: ``k`` rows for each of a fixed number of probes."""
    asked = np.array([v for _, v in probes])

    def run(batches):
        best: list[list[tuple[float, int]]] = [[] for _ in probes]
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(2))
            if not len(x):
                continue
            for n, line in enumerate(asked @ x.T):
                own = np.flatnonzero(ids == probes[n][0])
                found, score = _best(line, asked[n], ids, x, int(own[0]) if len(own) else None, k)
                best[n] = sorted([*best[n], *zip([-s for s in score], found, strict=True)])[:k]
        flat = [(probes[n][0], i, -away) for n, list_ in enumerate(best) for away, i in list_]
        yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in flat], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["probe", "id", "score"])

    return run


def _enough(sizes: np.ndarray, k: int) -> int:
    """The least reach with which the blocks around every place hold ``k`` rows and the query, or all there are."""
    wanted = min(k + 1, int(sizes.sum()))
    before = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(len(sizes))
    reach = 0
    while (before[np.minimum(at + reach + 1, len(sizes))] - before[np.maximum(at - reach, 0)]).min() < wanted:
        reach += 1
    return reach


def _reach(rows: DataFrame, places: DataFrame, total: list[int], k: int, recall: float) -> tuple[int, int]:
    """Curves and reach of the cheapest search that finds ``recall`` of the probes' true neighbours."""
    whole = max(total)
    asked = rows.filter("query")
    n = asked.count()
    probes = [(r.id, np.array(r.vector)) for r in asked.filter(below(F.lit(min(1.0, _PROBES / max(n, 1))), "id")).select("id", "vector").collect()]
    if not probes or whole == 1:
        return 1, whole
    near = rows.mapInArrow(_probe_truth(probes, k), "probe bigint, id bigint, score double")
    # One short list per probe and partition meets in a group; k rows per probe come to the driver.
    lists = near.groupBy("probe").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("away"), "id"))), 1, k).alias("best"))
    truth = lists.select("probe", F.explode("best").alias("b")).select("probe", "b.id").toPandas()
    if truth.empty:
        return 1, whole
    wanted = sorted({*truth.probe, *truth.id})
    seen = places.filter(F.col("id").isin(wanted)).collect()
    place = {(r.curve, r.id): r.place for r in seen}
    apart = np.array([[abs(place[c, p] - place[c, i]) for c in range(CURVES)] for p, i in zip(truth.probe, truth.id, strict=True)])
    best = (1, whole, whole)
    for curves in range(1, CURVES + 1):
        needed = int(np.sort(apart[:, :curves].min(1))[max(int(np.ceil(recall * len(apart))) - 1, 0)])
        cost = curves * min(2 * needed + 1, whole)
        if cost < best[2]:
            best = (curves, needed, cost)
    return best[:2]


def nearest(table: DataFrame, is_query: Column, id_: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = 0.97) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every query row its ``k`` nearest other rows found, best first."""
    rows = table.filter(usable(F.col(vector))).select(F.col(id_).cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), F.col(vector).cast("array<double>").alias("vector"))
    sizes = sorted(r["size"] for r in rows.select(F.size("vector").alias("size")).distinct().collect())
    found = [_found(rows.filter(F.size("vector") == size), k, recall) for size in sizes]
    if not found:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return _merged(reduce(DataFrame.union, found), k)


def _found(rows: DataFrame, k: int, recall: float) -> DataFrame:
    """Rows id, query, vector, all of one length -> for every query row a list of the best of each block it meets."""
    spark = rows.sparkSession
    curves = fit(rows.select("id", "vector"))
    placed = rows.mapInArrow(_placed(curves), "curve int, key bigint, id bigint, query boolean, vector array<double>")
    # A key that very many rows share is spread over ranges by the hash of the id.
    order = [F.col("curve"), F.col("key"), F.xxhash64("id")]
    blocks = cut_lineage(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks, _BLOCK_ROW))

    # Blocks in order along each curve: one count for each curve and partition comes to the driver.
    # All blocks of a partition but its last are full.
    counts = sorted(map(tuple, blocks.groupBy("curve", "part").agg(F.count(F.lit(1)), F.sum(F.size("ids"))).collect()))
    total, start, sizes = [0] * CURVES, {}, []
    for c, part, n, held in counts:
        start[c, part] = total[c]
        total[c] += n
        if c == 0:
            sizes += [_BLOCK] * (n - 1) + [held - (n - 1) * _BLOCK]
    starts = spark.createDataFrame([(c, p, n) for (c, p), n in start.items()], "curve int, part int, start int")
    blocks = blocks.join(F.broadcast(starts), ["curve", "part"]).withColumn("place", F.col("start") + F.col("seq")).drop("part", "seq", "start")
    places = blocks.select("curve", "place", F.explode("ids").alias("id"))
    used, reach = _reach(rows, places, total, k, recall)
    reach = max(reach, _enough(np.array(sizes), k))

    blocks = blocks.filter(F.col("curve") < used)
    size = F.lit(curves.size)
    at = F.filter(F.sequence(F.lit(0), F.size("ids") - 1), lambda i: F.col("queries")[i])
    asking = blocks.filter(F.exists("queries", lambda q: q)).withColumn("places", at).select(
        "curve", "place", "places", F.transform("places", lambda i: F.col("ids")[i]).alias("ids"),
        F.flatten(F.transform("places", lambda i: F.slice("vectors", i * size + 1, size))).alias("vectors"),
    )
    ends = F.element_at(F.array(*[F.lit(n - 1) for n in total]), F.col("curve") + 1)
    targets = F.sequence(F.greatest(F.col("place") - reach, F.lit(0)), F.least(F.col("place") + reach, ends))
    asking = asking.withColumn("target", F.explode(targets)).withColumn("together", F.floor(F.col("place") / _TOGETHER))
    first, last = F.greatest(F.col("place") - reach, F.lit(0)), F.least(F.col("place") + reach, ends)
    together = F.explode(F.sequence(F.floor(first / _TOGETHER), F.floor(last / _TOGETHER)))
    offered = blocks.select(*[F.col(c).alias(c) for c in ("curve", "place", "ids", "vectors")], together.alias("together"))
    return (
        asking.groupBy("curve", "target", "together")
        .cogroup(offered.groupBy("curve", "place", "together"))
        .applyInPandas(_searched(k), "place int, nth int, query_id bigint, ids array<bigint>, scores array<double>")
    )


def _merged(found: DataFrame, k: int) -> DataFrame:
    """One list for each query: what several curves found counts once."""
    pair = F.transform(F.arrays_zip("ids", "scores"), lambda x: F.struct((-x["scores"]).alias("away"), x["ids"].alias("id")))
    lists = found.select("query_id", pair.alias("found"))
    best = lists.groupBy("query_id").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))), 1, k).alias("found"))
    return best.select("query_id", F.posexplode("found").alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.away")).alias("score")
    )
