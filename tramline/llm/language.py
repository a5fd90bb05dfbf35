"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts up to ``ORDER`` bytes with the counts of what followed. A byte
is coded in the longest context seen in that language; where it has not followed there, an escape is
coded (method C: as likely as the number of different bytes seen there) and the next shorter context is
tried, without the bytes already ruled out; the last resort is an even choice among the bytes left. The
statistics are frozen after training, so the code length of a byte depends on it and the three before it
only: all lengths are worked out once as a table of (context, byte), and scoring a text is looking
them up and adding. The language with the shortest code wins.

Training uses a bounded sample of labelled rows (``rows`` of each language); every text is scored whole.

Defined cases: a null text or one without a letter is ``und`` with score 0; equal code lengths go to the
smaller name; without labelled rows everything is ``und``; rows with a null label or text are not learned
from; further columns pass through (``lang_pred``, ``score`` and ``bits`` are replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.batches import small, tidy
from tramline.llm.sampling import bounded

ORDER = 3
#: Bytes looked up at a time.
_SLICE = 1 << 20
UNDETERMINED = "und"


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another (null: none), and the limits between them."""
    large = texts.cast(pa.large_string())
    lengths = np.diff(np.frombuffer(large.buffers()[1], np.int64, len(large) + 1, large.offset * 8)) if len(large) else np.empty(0, np.int64)
    ends = np.frombuffer(large.buffers()[1], np.int64, len(large) + 1, large.offset * 8) if len(large) else np.zeros(1, np.int64)
    data = np.frombuffer(large.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data, np.concatenate(([0], np.cumsum(lengths)))


def _counted(batches):
    """(lang, text) -> (lang, size, gram, n): grams of 1 to ORDER + 1 bytes, as numbers, within texts."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        out: dict[str, list] = {"lang": [], "size": [], "gram": [], "n": []}
        for lang in sorted(set(langs)):
            data, limits = _joined(batch.column(1).filter(pa.array(langs == lang)))
            row = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
            gram = np.zeros(len(data), np.int64)
            for size in range(1, ORDER + 2):
                if len(data) < size:
                    break
                gram = gram[: len(data) - size + 1] * 256 + data[size - 1 :]
                found, n = np.unique(gram[row[: len(gram)] == row[size - 1 :]], return_counts=True)
                out["lang"] += [lang] * len(found)
                out["size"] += [size] * len(found)
                out["gram"] += found.tolist()
                out["n"] += n.tolist()
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())]))


@dataclass
class Model:
    """langs; symbol of each byte; state of the last ORDER symbols; bits[state, symbol, language]."""

    langs: list[str]
    symbols: np.ndarray
    states: np.ndarray
    bits: np.ndarray

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of each text in each language, worked out for runs of texts of about ``_SLICE`` bytes."""
        data, limits = _joined(texts)
        total, first = [np.zeros((0, len(self.langs)))], 0
        while first < len(texts):
            last = max(int(np.searchsorted(limits, limits[first] + _SLICE, "right")) - 1, first + 1)
            total.append(self._run(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first]))
            first = last
        return np.concatenate(total)

    def _run(self, data: np.ndarray, limits: np.ndarray) -> np.ndarray:
        rows, width = len(limits) - 1, self.bits.shape[1]
        edge = width - 1  # stands before a text: no context reaches across it
        stream = np.full(len(data) + ORDER * rows, edge, np.uint16)
        ends = limits[1:] + ORDER * np.arange(1, rows + 1)
        for k in range(rows):
            stream[ends[k] - (limits[k + 1] - limits[k]) : ends[k]] = self.symbols[data[limits[k] : limits[k + 1]]]
        table = self.bits.reshape(-1, len(self.langs))
        total = np.zeros((rows, len(self.langs)))
        for a in range(ORDER, len(stream), _SLICE):
            b = min(a + _SLICE, len(stream))
            context = np.zeros(b - a, np.int64)
            for back in range(ORDER, 0, -1):
                context = context * width + stream[a - back : b - back]
            bits = table[self.states[context].astype(np.int64) * width + stream[a:b]]
            first, last = np.searchsorted(ends, [a, b - 1], "right")
            limit = np.minimum(ends[first : last + 1], b) - a
            row = np.repeat(np.arange(last - first + 1), np.diff(limit, prepend=0))
            for k in range(len(self.langs)):
                total[first : last + 1, k] += np.bincount(row, weights=bits[:, k], minlength=last - first + 1)
        return total


def _build(counts: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]) -> Model:
    """counts: (lang, size) -> grams, n."""
    langs = sorted({lang for lang, _ in counts})
    seen = np.unique(np.concatenate([counts[lang, 1][0] for lang in langs]))
    n_seen = len(seen)
    width = n_seen + 2  # seen bytes, any unseen byte, the edge of a text
    symbols = np.full(256, n_seen, np.uint16)
    symbols[seen] = np.arange(n_seen)

    def packed(grams: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(len(grams), np.int64)
        for k in range(size - 1, -1, -1):
            out = out * width + symbols[(grams >> (8 * k)) & 255].astype(np.int64)
        return out

    grams = {(lang, size): (packed(g, size), n) for (lang, size), (g, n) in counts.items()}
    contexts = [np.zeros(1, np.int64)]  # by order: contexts seen in any language
    for k in range(1, ORDER + 1):
        contexts.append(np.unique(np.concatenate([grams[lang, k + 1][0] // width for lang in langs if (lang, k + 1) in grams] or [np.zeros(0, np.int64)])))
    starts = np.cumsum([0] + [len(c) for c in contexts])
    states = np.zeros(width**ORDER, np.int32)
    every = np.arange(width**ORDER)
    for k in range(1, ORDER + 1):
        if len(contexts[k]):
            suffix = every % width**k
            place = np.minimum(np.searchsorted(contexts[k], suffix), len(contexts[k]) - 1)
            states = np.where(contexts[k][place] == suffix, starts[k] + place, states).astype(np.int32)

    bits = np.zeros((starts[-1], width, len(langs)), np.float32)
    for index, lang in enumerate(langs):
        table = []  # by order: counts[context, symbol]
        for k in range(ORDER + 1):
            n = np.zeros((len(contexts[k]), n_seen + 1), np.int32)
            if (lang, k + 1) in grams:
                key, found = grams[lang, k + 1]
                n[np.searchsorted(contexts[k], key // width), key % width] = found
            table.append(n)
        for k in range(ORDER + 1):
            escaped = np.ones(len(contexts[k]))
            chance = np.zeros((len(contexts[k]), n_seen + 1))
            open_ = np.ones(chance.shape, bool)
            for level in range(k, -1, -1):
                at = np.searchsorted(contexts[level], contexts[k] % width**level)
                at = np.minimum(at, len(contexts[level]) - 1)
                n = table[level][at] * open_
                kinds = (n > 0).sum(1)
                total = n.sum(1) + kinds
                share = np.divide(escaped, total, out=np.zeros_like(escaped), where=total > 0)
                chance += n * share[:, None]
                escaped = np.where(total > 0, share * kinds, escaped)
                open_ &= n == 0
            rest = 256 - (~open_).sum(1)
            chance += open_ * (escaped / np.maximum(rest, 1))[:, None]
            bits[starts[k] : starts[k + 1], : n_seen + 1, index] = -np.log2(np.maximum(chance, 1e-300))
    return Model(langs, symbols, states, bits)


def train(labelled: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = 400) -> Model | None:
    """Learn from about ``rows`` labelled rows of each language (all, if there are fewer).

    The counts come to the driver: one row per language and gram of that bounded sample.
    """
    usable = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(text) != ""))
    sample = bounded(usable, rows, [doc], group=lang).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = sample.mapInArrow(_counted, "lang string, size int, gram bigint, n bigint").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not counted.num_rows:
        return None
    langs, sizes = np.array(counted["lang"].to_pylist(), dtype=object), counted["size"].to_numpy()
    grams, n = counted["gram"].to_numpy(), counted["n"].to_numpy()
    counts = {}
    for x in sorted(set(langs)):
        for size in range(1, ORDER + 2):
            own = (langs == x) & (sizes == size)
            if own.any():
                counts[x, size] = (grams[own], n[own])
    return _build(counts)


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All columns and lang_pred, score (0 to 1) and bits (code length per byte in that language)."""
    rest = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score", "bits")])
    if model is None:
        return rest.select("*", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"))
    small(docs.sparkSession)
    shared = _shared(docs.sparkSession, model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double,bits:double>")
    @tidy()
    def best(texts: pa.Array) -> pa.Array:
        m = shared.value
        lengths = m.code_lengths(texts)
        chosen = lengths.argmin(1)
        least = lengths[np.arange(len(lengths)), chosen]
        score = 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(1)
        size = np.maximum(np.array(pa.compute.fill_null(pa.compute.binary_length(texts), 0)), 1)
        names = pa.array(m.langs, pa.string()).take(pa.array(chosen))
        return pa.StructArray.from_arrays([names, pa.array(score), pa.array(least / size)], fields=list(kind))

    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return rest.withColumn("lang__", best(F.col(text))).select(
        *rest.columns,
        F.when(letters, F.col("lang__.lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(letters, F.col("lang__.score")).otherwise(0.0).alias("score"),
        F.when(letters, F.col("lang__.bits")).alias("bits"),
    )


def _shared(spark: SparkSession, model: Model):
    """The model's size is bounded by the training sample, not by the table it is applied to."""
    return spark.sparkContext.broadcast(model)


def speakable(docs: DataFrame, model: Model | None, text: str = "text", most_bits: float = 8.0) -> DataFrame:
    """The rows whose text is in a learned language: not ``und``, and coded in fewer bits than its plain bytes."""
    found = identify(docs, model, text)
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("bits") < most_bits)).select(docs.columns)
