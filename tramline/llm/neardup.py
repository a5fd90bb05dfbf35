"""Near-duplicate documents: weighted Jaccard similarity of TF-IDF shingles, by consistent weighted sampling.

Texts are lower-cased runs of letters and digits; a shingle is five words (a shorter text is one shingle). A
shingle weighs its count in the text times an idf that is 1 up to a document share of ``COMMON`` and
falls logarithmically above it, so that passages which many documents share count less. Document
frequencies are exact and cover every document: shingles are counted by hash bucket first, and only those in
buckets that reach the share are counted one by one. How many can reach it depends on the length of
the documents, not on their number.

Improved consistent weighted sampling draws ``BANDS * ROWS`` samples of a text; two texts agree in a
sample with the probability of their weighted Jaccard similarity. Texts that agree in all samples of
a band share a bucket. Buckets are searched in two steps, and every similarity is computed from the texts:

1. every text against the first and the last of its bucket (linear in the bucket);
2. where a bucket still holds texts of several components, all pairs across components, in blocks.

Exact copies are one text throughout, whatever their number. Two texts linked by a similarity of at
least ``least`` and sharing a bucket end in one class; at 0.8 a pair shares none in one of 1,300 cases.

In a large group of near copies what they share counts less than their edits. With ``either``, texts are also
linked if their Jaccard similarity by counts alone is at least ``least``. Texts that lose over ``LOSS`` of their weight to
the idf then have ``PLAIN_BANDS`` more bands, drawn by counts; a pair of others at 0.8 by counts is at 0.789 or more by
weights. Such a pair shares no bucket in one of 850 cases at most.

Defined cases: null and empty texts are in a class of their own; a text without words is equal to its
exact copies only; the class id is the smallest non-null id of its documents; rows that share an id are
told apart by their text; an empty table gives no rows; further columns are ignored or, in
``deduplicated``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.batches import small, tidy
from tramline.llm.components import components
from tramline.session import cut_lineage

WORDS, BANDS, ROWS, COMMON = 5, 10, 3, 0.05
#: Bands by counts: with more rows, as passages that many documents share are not held down in them.
PLAIN_BANDS, PLAIN_ROWS, LOSS = 18, 5, 0.05
_BUCKETS = 1 << 16
_DRAWS = 1 << 16
#: Bytes of text worked on at a time, and members and bytes of a block.
_SLICE, _MEMBERS, _BLOCK = 1 << 21, 64, 1 << 22

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SPREAD = np.array([pow(0xBF58476D1CE4E5B9, k + 1, 1 << 64) for k in range(WORDS)], _U)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and last byte + 1 of every word: differences of a polynomial's prefix sums, moved to exponent 0."""
    word = _IS_WORD[data]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    n = len(data)
    sums = np.concatenate(([_U(0)], np.cumsum((data.astype(_U) + _U(1)) * _powers(_BASE, n), dtype=_U)))
    return _mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(_U)), ends


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, limits) of runs of rows of about ``_SLICE`` bytes; a longer text is alone in its run."""
    texts = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    limits = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(int(np.searchsorted(limits, limits[first] + _SLICE, "right")) - 1, first + 1)
        yield first, data[limits[first] : limits[last]], limits[first : last + 1] - limits[first]
        first = last


def _words(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts one after another, and where each text's words end."""
    spaced = np.zeros(len(data) + len(limits) - 1, np.uint8)  # a zero byte behind every text
    row = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    spaced[np.arange(len(data)) + row] = data
    hashes, ends = [], []
    a = 0
    while a < len(spaced):
        b = min(a + _SLICE, len(spaced))
        if b < len(spaced) and _IS_WORD[spaced[b - 1]]:  # to the end of a word
            stop = np.flatnonzero(~_IS_WORD[spaced[b : b + _SLICE]])
            while not len(stop) and b + _SLICE < len(spaced):
                b += _SLICE
                stop = np.flatnonzero(~_IS_WORD[spaced[b : b + _SLICE]])
            b += int(stop[0]) if len(stop) else 0
        h, e = _word_hashes(spaced[a:b])
        hashes.append(h)
        ends.append(e + a)
        a = b
    limit = limits[1:] + np.arange(1, len(limits))
    every = np.concatenate(ends) if ends else np.empty(0, np.int64)
    return np.concatenate(hashes) if hashes else np.empty(0, _U), np.searchsorted(every, limit, "right")


def shingles(texts: pa.Array) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, for each row of a run its different shingles, sorted, and their counts)."""
    for first, data, limits in _slices(texts):
        words, upto = _words(data, limits)
        out = []
        for a, b in zip(np.concatenate(([0], upto[:-1])), upto, strict=True):
            own = words[a:b]
            if len(own) < WORDS:
                made = _mixed((own * _SPREAD[: len(own)]).sum(dtype=_U, keepdims=True) + _U(len(own))) if len(own) else own
            else:
                made = np.zeros(len(own) - WORDS + 1, _U)
                for k in range(WORDS):
                    made += own[k : len(own) - WORDS + 1 + k] * _SPREAD[k]
                made = _mixed(made)
            out.append(np.unique(made, return_counts=True))
        yield first, out


class Weights:
    """The idf of common shingles (sorted by hash); all others have 1. ``either``: similarity by counts links as well."""

    def __init__(self, hashes: np.ndarray, idf: np.ndarray, either: bool = False):
        self.hashes, self.idf, self.either = hashes, idf, either

    def of(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = counts.astype(float)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            weights *= np.where(self.hashes[at] == found, self.idf[at], 1.0)
        return weights


def _bucket_counts(batches):
    total = np.zeros(_BUCKETS, np.int64)
    for batch in batches:
        for _, rows in shingles(batch.column(0)):
            total += np.bincount(np.concatenate([s for s, _ in rows]).astype(np.int64) & (_BUCKETS - 1), minlength=_BUCKETS)
    (found,) = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["key", "n"])


def _counts_in(buckets: np.ndarray):
    def run(batches):
        for batch in batches:
            for _, rows in shingles(batch.column(0)):
                found = np.concatenate([s for s, _ in rows]).view(np.int64)
                key, n = np.unique(found[buckets[found & (_BUCKETS - 1)]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    return run


def weigh(texts: DataFrame, either: bool = False) -> Weights:
    """The idf of shingles in at least ``COMMON`` of all documents; column ``text``.

    To the driver come at most ``_BUCKETS`` bucket counts, and then the common shingles: no more than the
    mean number of shingles of a document divided by ``COMMON``.
    """
    texts = texts.select("text")
    none = Weights(np.empty(0, _U), np.empty(0), either)
    documents = texts.filter("text <> ''").count()
    if not documents:
        return none
    least = max(2, COMMON * documents)

    def counted(run):
        return texts.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).toArrow()

    full = counted(_bucket_counts)
    if not full.num_rows:
        return none
    buckets = np.zeros(_BUCKETS, bool)
    buckets[full["key"].to_numpy()] = True
    common = counted(_counts_in(buckets))
    hashes, n = common["key"].to_numpy().view(_U), common["n"].to_numpy()
    order = np.argsort(hashes)
    return Weights(hashes[order], np.log1p(documents / n[order]) / np.log1p(1 / COMMON), either)


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of the sampling's random values: r and ln c of gamma(2, 1), and beta of the unit interval."""
    rng = np.random.Generator(np.random.PCG64(20))
    r, c = rng.gamma(2.0, size=_DRAWS), rng.gamma(2.0, size=_DRAWS)
    return r.astype(np.float32), np.log(c).astype(np.float32), rng.random(_DRAWS).astype(np.float32)


def band_keys(found: np.ndarray, weights: np.ndarray, limits: np.ndarray, bands: int = BANDS, rows: int = ROWS, first: int = 0) -> np.ndarray:
    """One row of ``bands`` keys for each text; ``limits`` are the starts of the texts' shingles (none is empty).

    ``first``: number of the first sample.
    """
    r_of, c_of, beta_of = _draws()
    log_weight = np.log(weights).astype(np.float32)
    sizes = np.diff(np.append(limits, len(found)))
    keys = np.zeros((len(limits), bands), _U)
    low = _U(_DRAWS - 1)
    for k in range(bands * rows):
        draw = _mixed(found + _U((first + k + 1) * _BASE % (1 << 64)))
        r, beta = r_of[(draw & low).astype(np.int64)], beta_of[(draw >> _U(16) & low).astype(np.int64)]
        step = np.floor(log_weight / r + beta)
        cost = c_of[(draw >> _U(32) & low).astype(np.int64)] - r * (step - beta + 1)
        least = np.repeat(np.minimum.reduceat(cost, limits), sizes)
        (hits,) = np.nonzero(cost == least)
        at = hits[np.searchsorted(hits, limits)]  # the first of each text: ties go to the smaller shingle
        sample = _mixed(found[at] ^ (step[at].astype(np.int64).view(_U) * _U(_INVERSE)))
        keys[:, k // rows] = _mixed(keys[:, k // rows] * _U(31) + sample)
    return keys.view(np.int64)


def keys(text: Column, weights: Weights) -> Column:
    """Array of band keys, those by counts last; null for texts without words."""

    @F.arrow_udf("array<bigint>")
    @tidy()
    def run(texts: pa.Array) -> pa.Array:
        made: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
        for first, rows in shingles(texts):
            full = [i for i, (s, _) in enumerate(rows) if len(s)]
            if not full:
                continue
            given = [weights.of(*rows[i]) for i in full]
            limits = np.cumsum([0] + [len(w) for w in given])[:-1]
            for i, own in zip(full, band_keys(np.concatenate([rows[i][0] for i in full]), np.concatenate(given), limits), strict=True):
                made[first + i] = own
            light = [i for i, w in zip(full, given, strict=True) if w.sum() < (1 - LOSS) * rows[i][1].sum()] if weights.either else []
            if not light:
                continue
            limits = np.cumsum([0] + [len(rows[i][0]) for i in light])[:-1]
            counts = np.concatenate([rows[i][1] for i in light]).astype(float)
            more = band_keys(np.concatenate([rows[i][0] for i in light]), counts, limits, PLAIN_BANDS, PLAIN_ROWS, BANDS * ROWS)
            for i, own in zip(light, more, strict=True):
                made[first + i] = np.concatenate((made[first + i], own))
        size = np.array([len(x) for x in made], np.int64)
        offsets = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *made])), mask=pa.array(size == 0))

    return run(text)


class _Text:
    """A text's shingles, weighted; ``plain`` has their counts as weights, where similarity by counts links as well."""

    def __init__(self, found: np.ndarray, weights: np.ndarray):
        self.found, self.weights, self.total = found, weights, float(weights.sum())
        self.plain = self


def _weighted(texts: pa.Array, weights: Weights) -> list[_Text]:
    out = []
    for _, rows in shingles(texts):
        for found, counts in rows:
            out.append(_Text(found, weights.of(found, counts)))
            if weights.either and out[-1].total < counts.sum():
                out[-1].plain = _Text(found, counts.astype(float))
    return out


def similarity(a: _Text, b: _Text, least: float = 0.0) -> float:
    """Weighted Jaccard similarity; 0 as soon as it must be below ``least``."""
    if min(a.total, b.total) < least * max(a.total, b.total) or not len(a.found) or not len(b.found):
        return 0.0
    if len(a.found) > len(b.found):
        a, b = b, a
    at = np.minimum(np.searchsorted(b.found, a.found), len(b.found) - 1)
    common = float(np.minimum(a.weights, b.weights[at])[b.found[at] == a.found].sum())
    return common / (a.total + b.total - common)


def _alike(a: _Text, b: _Text, least: float) -> bool:
    return similarity(a, b, least) >= least or ((a.plain is not a or b.plain is not b) and similarity(a.plain, b.plain, least) >= least)


def _verified(weights: Weights, least: float):
    """(a, b, text_a, text_b) -> (a, b) of similar texts. Rows come ordered by b, so its shingles are often at hand."""

    def run(batches):
        for batch in batches:
            a, b, text_a, text_b = batch.columns
            good = np.zeros(len(batch), bool)
            again = np.concatenate(([False], np.array(pc.equal(b[1:], b[:-1])))) if len(batch) else np.zeros(0, bool)
            held = None
            for start in range(0, len(batch), 256):
                own = _weighted(text_a[start : start + 256], weights)
                for k, one in enumerate(own, start):
                    if held is None or not again[k]:
                        (held,) = _weighted(text_b[k : k + 1], weights)
                    good[k] = _alike(one, held, least)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(good))

    return run


_BLOCK_ROW = "band int, key bigint, block bigint, low binary, high binary, nodes array<binary>, labels array<binary>, bands array<array<bigint>>, texts array<string>"


def _blocks(batches):
    """Rows (band, key, label, node, bands, text) sorted by bucket and label -> blocks of one bucket each."""
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    size = 0
    names = ["band", "key", "block", "low", "high", "nodes", "labels", "bands", "texts"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())]

    def made():
        band, key, *_ = held[0]
        labels = [x[2] for x in held]
        row = [band, key, block, min(labels), max(labels), [x[3] for x in held], labels, [x[4] for x in held], [x[5] for x in held]]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (row[:2] != held[0][:2] or len(held) >= _MEMBERS or size > _BLOCK):
                yield made()
                block, held, size = block + 1, [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield made()


def _across(weights: Weights, least: float):
    """Pairs of blocks of one bucket -> links between texts of different labels.

    A pair is tested in the first band it shares; labels joined by a link found here are not tested again.
    """

    def run(batches):
        root: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        for batch in batches:
            found_a, found_b = [], []
            for r in range(len(batch)):
                (band, same, nodes_a, labels_a, bands_a, texts_a, nodes_b, labels_b, bands_b, texts_b) = (c[r] for c in batch.columns)
                band, same = band.as_py(), same.as_py()
                upto = lambda bands: np.array([x[:band] for x in bands.as_py()])  # noqa: B023, E731
                a = (nodes_a.as_py(), labels_a.as_py(), upto(bands_a), _weighted(texts_a.values, weights))
                b = a if same else (nodes_b.as_py(), labels_b.as_py(), upto(bands_b), _weighted(texts_b.values, weights))
                for i in range(len(a[0])):
                    earlier = (b[2] == a[2][i]).any(1)
                    for j in range(i + 1 if same else 0, len(b[0])):
                        if earlier[j] or a[1][i] == b[1][j] or find(a[1][i]) == find(b[1][j]):
                            continue
                        if _alike(a[3][i], b[3][j], least):
                            root[find(a[1][i])] = find(b[1][j])
                            found_a.append(a[0][i])
                            found_b.append(b[0][j])
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())], names=["a", "b"])

    return run


def node(text: Column) -> Column:
    """What all exact copies of a text share; null for null and empty texts."""
    return F.when(text != "", F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32)))


def _links(docs: DataFrame, sketches: DataFrame, weights: Weights, least: float) -> DataFrame | None:
    """docs: node, text; sketches: node, bands -> a, b: links that connect every class."""
    unique = sketches.filter("bands is not null").groupBy("node").agg(F.first("bands").alias("bands"))
    spread = unique.select("node", "bands", F.posexplode("bands").alias("band", "key"))
    shared = spread.groupBy("band", "key").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cut_lineage(spread.join(shared, ["band", "key"]))
    involved = members.select("node").distinct()
    texts = cut_lineage(docs.join(involved, "node").dropDuplicates(["node"]))

    def pair(to: str) -> DataFrame:
        return members.filter(F.col("node") != F.col(to)).select(F.col("node").alias("a"), F.col(to).alias("b"))

    pairs = pair("first").union(pair("last")).distinct()
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    stars = cut_lineage(both.mapInArrow(_verified(weights, least), "a binary, b binary"))
    labels = components(stars)

    # The first and the last of a bucket have met all others, so only larger ones can hold more.
    open_ = members.filter("size > 3").join(labels, "node", "left").select("band", "key", F.coalesce("root", "node").alias("label"), "node", "bands")
    mixed = open_.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("band", "key")
    rest = open_.join(mixed, ["band", "key"]).join(texts, "node").select("band", "key", "label", "node", "bands", "text")
    order = ["band", "key", "label", "node"]
    blocks = cut_lineage(rest.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks, _BLOCK_ROW))
    left, right = blocks.alias("l"), blocks.alias("r")
    to_test = left.join(
        right, (F.col("l.band") == F.col("r.band")) & (F.col("l.key") == F.col("r.key")) & (F.col("l.block") <= F.col("r.block"))
        & ~((F.col("l.low") == F.col("l.high")) & (F.col("r.low") == F.col("r.high")) & (F.col("l.low") == F.col("r.low"))),
    )
    to_test = to_test.select(
        "l.band", (F.col("l.block") == F.col("r.block")).alias("same"), "l.nodes", "l.labels", "l.bands", "l.texts",
        *[F.col(f"r.{c}").alias(f"{c}_b") for c in ("nodes", "labels", "bands", "texts")],
    )
    across = to_test.mapInArrow(_across(weights, least), "a binary, b binary")
    return cut_lineage(stars.union(across))


def classes(docs: DataFrame, doc: str = "doc_id", text: str = "text", least: float = 0.8, either: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, node, root (what a class shares) and class_id."""
    plain = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    small(docs.sparkSession)
    weights = weigh(plain, either)
    sketches = cut_lineage(plain.select("doc_id", node(F.col("text")).alias("node"), keys(F.col("text"), weights).alias("bands")))
    links = _links(plain.select(node(F.col("text")).alias("node"), "text"), sketches.select("node", "bands"), weights, least)
    rows = sketches.select("doc_id", "node").join(components(links), "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    rows = cut_lineage(rows)
    ids = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(ids, "root", "left").select("doc_id", "node", "root", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def deduplicated(docs: DataFrame, doc: str = "doc_id", text: str = "text", least: float = 0.8, either: bool = False) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the one with the smallest id stays.

    Ties go to the smaller text hash, then to the smaller other values; equal rows are one. Null and empty texts stay.
    """
    other = F.to_json(F.struct(*[c for c in docs.columns if c != text] or [F.lit(0)]))
    marked = docs.withColumns({"dup__node": node(F.col(text)), "dup__other": other})
    found = classes(docs, doc, text, least, either).filter("root is not null").select("node", "root").distinct()
    place = F.struct(F.col(doc).isNull(), F.col(doc), F.col("dup__node"), F.col("dup__other")).alias("place")
    small = marked.filter("dup__node is not null").select(F.col("dup__node").alias("node"), place)
    chosen = small.join(found, "node").groupBy("root").agg(F.min("place").alias("p")).select(F.col("p.dup__node").alias("dup__node"), F.col("p.dup__other").alias("dup__other"))
    first = marked.join(chosen, ["dup__node", "dup__other"], "left_semi").dropDuplicates(["dup__node", "dup__other"])
    return first.select(docs.columns).union(docs.filter(F.col(text).isNull() | (F.col(text) == "")))
