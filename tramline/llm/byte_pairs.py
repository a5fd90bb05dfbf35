"""Byte-level BPE by replaying the merges over a whole block of text at once.

**Method.** The distinct pattern matches ("words") of a block lie one after the other in one byte array; every byte starts as
the token of that byte. An inverted index leads from the rank of a token pair to the positions where such a pair starts. The
ranks are taken in ascending order; each merges all its positions in one array operation, leftmost first where they overlap
(``aaa``), and only the pairs with the touched neighbours are entered anew. What is left are the words' ids; a document's ids
are gathered from them by word number. Blocks are Arrow batches: no shuffle, a lost executor repeats only its own blocks. A
worker remembers words of earlier blocks up to ``REMEMBERED`` letters and then starts anew; results do not depend on it.

A merge can make a pair of a *lower* rank than its own only in rank files whose ranks were not learned in that order. Words where
that happens are done again one merge at a time, so the ids are those of the plain procedure for any rank file.

**Ranks** are a file of lines ``base64 rank`` that holds all 256 bytes; its path must be readable by every worker. A word that is
in the file as a whole is that one id. There are no special tokens: their strings are ordinary text.

**Defined results.** Null text gives null ids; digests read null as empty. An empty text has no ids. Texts of any length are
encoded whole, words of any length too. Rows are independent: ties, repeated rows, null and repeated ids of documents and an empty
table need no rule. All other columns are kept; a column named like the result is replaced. Decoding null gives null; an id
outside the file is an error that names it.
"""

from __future__ import annotations

import base64
import re
from array import array
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.batches import held, small, tidy

#: Letters of distinct words that a worker remembers, and the length up to which a word is worth remembering.
REMEMBERED, LONGEST = 6_000_000, 64
#: Texts above this many characters are split into words piece by piece.
_LONG = 1 << 20

# Code points that Unicode made letters and numbers after its version 16, which the tiktoken library's pattern
# classes follow; the pattern library here knows later versions.
NEWER_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 "
    "1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NEWER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def _ranges(listed: str) -> str:
    """The inside of a character class."""
    ends = ([int(x, 16) for x in part.split("-")] for part in listed.split())
    return "".join(f"{chr(e[0])}-{chr(e[-1])}" for e in ends)


class Merges:
    """The rank file as tables: token of a byte, rank of a pair of tokens, bytes of a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the rank file lacks the bytes {missing[:5]}")
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        for t, k in ranks.items():
            lengths[k] = len(t)
        self.lengths, self.starts = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.data = np.frombuffer(b"".join(t for t, _ in sorted(ranks.items(), key=lambda x: x[1])), np.uint8)
        self.size = size
        pairs = [
            (ranks[t[:i]] * size + ranks[t[i:]], k) for t, k in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        pairs.sort()
        self.pair_keys, self.pair_ranks = np.array([p for p, _ in pairs] + [size * size], np.int64), np.array([k for _, k in pairs] + [-1], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, -1 where none."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.int32(-1))

    def plain(self, word: bytes) -> list[int]:
        """One word, always its leftmost pair of lowest rank; the procedure that the replay must equal."""
        tok, end = [int(self.of_byte[b]) for b in word], list(range(1, len(word) + 1))
        before = list(range(-1, len(word) - 1))
        rank = self.ranks.get
        heap = [(r, i) for i in range(len(word) - 1) if (r := rank(word[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            if tok[i] < 0 or end[i] >= len(word) or end[end[i]] - i != self.lengths[r]:
                continue
            j = end[i]
            tok[i], tok[j], end[i] = r, -1, end[j]
            if end[i] < len(word):
                before[end[i]] = i
                if (k := rank(word[i : end[end[i]]])) is not None:
                    heappush(heap, (k, i))
            if before[i] >= 0 and (k := rank(word[before[i] : end[i]])) is not None:
                heappush(heap, (k, before[i]))
        return [t for t in tok if t >= 0]

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids' bytes in a row, and how many bytes the first k ids have; gathered in parts, so that positions take little memory."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size and (self.lengths[ids] > 0).all()):
            raise ValueError(f"id {next(i for i in ids.tolist() if not 0 <= i < self.size or not self.lengths[i])} is not in the rank file")
        lengths = self.lengths[ids]
        upto = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        out = np.empty(upto[-1], np.uint8)
        for a in range(0, len(ids), 1 << 20):
            part, n = ids[a : a + (1 << 20)], lengths[a : a + (1 << 20)]
            base = int(upto[a])
            shift = np.repeat(self.starts[part] - (upto[a : a + len(part)] - base), n)
            out[base : base + len(shift)] = self.data[shift + np.arange(len(shift))]
        return out, upto

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and the number of ids of each (no word is empty)."""
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        tok = self.of_byte[data]
        end = np.arange(1, n + 1, dtype=np.int32)  # where the token that starts here ends
        before = np.arange(-1, n, dtype=np.int32)  # where the token before the one that starts here starts
        edge = np.zeros(n + 1, bool)  # words begin here
        edge[first] = True
        index: dict[int, array] = {}
        again: set[int] = set()

        def enter(at: np.ndarray, ranks: np.ndarray, now: int) -> None:
            hit = ranks >= 0
            if not hit.all():
                at, ranks = at[hit], ranks[hit]
            if now >= 0 and len(ranks) and ranks.min() < now:  # a rank that was due before
                early = ranks < now
                again.update((np.searchsorted(first, at[early], "right") - 1).tolist())
                at, ranks = at[~early], ranks[~early]
            if len(at) < 48:
                for r, p in zip(ranks.tolist(), at.tolist()):
                    if r in index:
                        index[r].append(p)
                    else:
                        index[r] = array("i", (p,))
                        heappush(due, r)
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                r, part = int(ranks[a]), at[a:b].astype(np.int32).tobytes()
                if r not in index:
                    index[r] = array("i")
                    heappush(due, r)
                index[r].frombytes(part)

        due: list[int] = []
        left = np.flatnonzero(~edge[1:n]) if n else np.zeros(0, np.int64)
        enter(left, self.rank_of(tok[left], tok[left + 1]), -1)
        while due:
            r = heappop(due)
            at = np.unique(np.frombuffer(index.pop(r), np.int32))
            length = int(self.lengths[r])
            middle = end[at]
            live = (tok[at] >= 0) & ~edge[middle]
            if not live.all():
                at, middle = at[live], middle[live]
            stop = end[middle]
            live = stop - at == length
            if not live.all():
                at, middle, stop = at[live], middle[live], stop[live]
            if len(at) > 1:
                meets = at[1:] < stop[:-1]
                if meets.any():  # of overlapping places every second one, from the left
                    k = np.arange(len(at))
                    run = np.maximum.accumulate(np.where(np.concatenate([[True], ~meets]), k, 0))
                    keep = (k - run) % 2 == 0
                    at, middle, stop = at[keep], middle[keep], stop[keep]
            if not len(at):
                continue
            side = np.flatnonzero((stop[:-1] == at[1:]) & ~edge[stop[:-1]])
            if len(side):  # one by one, the left merge would for a moment stand beside the first half of the right one
                passing = self.rank_of(np.full(len(side), r), tok[at[side + 1]])
                early = (passing >= 0) & (passing < r)
                again.update((np.searchsorted(first, at[side[early]], "right") - 1).tolist())
            tok[at], tok[middle], end[at], before[stop] = r, -1, stop, at
            onward, back = at[~edge[stop]], at[~edge[at]]
            back = before[back]
            lefts = np.concatenate([onward, back])
            enter(lefts, self.rank_of(tok[lefts], tok[end[lefts]]), r)
        alive = tok >= 0
        counts = np.add.reduceat(alive, first[:-1], dtype=np.int64) if n else np.zeros(0, np.int64)
        ids = tok[alive]
        if again:
            cuts = np.cumsum(counts)[:-1]
            parts = [p if k not in again else np.array(self.plain(words[k]), np.int32) for k, p in enumerate(np.split(ids, cuts))]
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, counts


class _Numbered(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Encoder:
    """Encodes blocks of texts; remembers words between blocks."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.pattern = merges, regex.compile(pattern)
        # Where a text has one of the newer code points, classes without them: [^\\s\\p{L}\\p{N}] gains what \\p{L} and \\p{N} lose.
        letters, numbers = (f"[\\p{{{k}}}--[{_ranges(v)}]]" for k, v in (("L", NEWER_LETTERS), ("N", NEWER_NUMBERS)))
        self.strict = regex.compile("(?V1)" + pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers))
        self.newer = re.compile(f"[{_ranges(NEWER_LETTERS)}{_ranges(NEWER_NUMBERS)}]")
        self.forget()

    def forget(self) -> None:
        self.numbers, self.letters = _Numbered(), 0
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _words(self, text: str):
        pattern = self.strict if not text.isascii() and self.newer.search(text) else self.pattern
        if len(text) <= _LONG:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while part := list(islice(found, 100_000)):
            yield part

    def block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids end."""
        if self.letters > REMEMBERED:
            self.forget()
        known, number, used, ends = len(self.numbers), self.numbers.__getitem__, array("i"), []
        for text in texts:
            for words in self._words(text):
                used.extend(map(number, words))
            ends.append(len(used))
        if fresh := list(islice(self.numbers, known, None)):
            self._learn(fresh)
        used = np.frombuffer(used, np.int32)
        counts = self.counts[used]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(upto[-1], np.int32)
        for a in range(0, len(used), 1 << 20):  # gathered in parts, so that the positions take little memory
            part, c = used[a : a + (1 << 20)], counts[a : a + (1 << 20)]
            base = int(upto[a])
            shift = np.repeat(self.starts[part] - (upto[a : a + len(part)] - base), c)
            ids[base : base + len(shift)] = self.ids[shift + np.arange(len(shift))]
        ends = upto[np.array(ends, np.int64)] if ends else np.zeros(0, np.int64)
        if any(len(w) > LONGEST for w in fresh):
            self.forget()
        return ids, ends

    def _learn(self, fresh: list[str]) -> None:
        coded = [w.encode() for w in fresh]
        whole = [self.merges.ranks.get(w, -1) for w in coded]
        ids, counts = self.merges.replay([w for w, k in zip(coded, whole) if k < 0])
        all_counts = np.ones(len(coded), np.int64)
        whole = np.array(whole, np.int64)
        all_counts[whole < 0] = counts
        upto = np.cumsum(all_counts)
        merged = np.empty(upto[-1], np.int32)
        single = whole >= 0
        at = upto - all_counts
        merged[at[single]] = whole[single]
        rest = np.ones(len(merged), bool)
        rest[at[single]] = False
        merged[rest] = ids
        self.starts = np.concatenate([self.starts, at + len(self.ids)])
        self.ids, self.counts = np.concatenate([self.ids, merged]), np.concatenate([self.counts, all_counts])
        self.letters += sum(map(len, coded))


def merges(path: str) -> Merges:
    """A rank file's tables."""
    with open(path, "rb") as lines:
        return Merges({base64.b64decode(t): int(k) for t, k in map(bytes.split, filter(None, map(bytes.strip, lines)))})


def encoder(path: str, pattern: str = "") -> Encoder:
    """One encoder per worker."""
    return held(("byte_pairs", path, pattern), lambda: Encoder(merges(path), pattern))


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """All columns and ``into``: the ids of ``text``, each match of ``pattern`` encoded by itself."""
    small(docs.sparkSession)

    @F.arrow_udf("array<int>")
    @tidy(keep=True)
    def ids(texts: pa.Array) -> pa.Array:
        found, ends = encoder(ranks, pattern).block([x.as_py() or "" for x in texts])
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(found), mask=texts.is_null())

    return docs.withColumn(into, ids(F.col(text)))


def decode(docs: DataFrame, ranks: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns and ``into``: the bytes of ``ids``."""

    @F.arrow_udf("binary")
    @tidy(keep=True)
    def joined(rows: pa.Array) -> pa.Array:
        values = rows.flatten().to_numpy(zero_copy_only=False)
        counts = np.asarray(rows.value_lengths().fill_null(0), np.int64) if len(rows) else np.zeros(0, np.int64)
        out, upto = encoder(ranks).merges.bytes_of(values)
        offsets = np.concatenate([[0], upto[np.cumsum(counts)]]).astype(np.int32)
        none = pa.py_buffer(np.packbits(np.asarray(rows.is_valid()), bitorder="little").tobytes())
        return pa.Array.from_buffers(pa.binary(), len(rows), [none, pa.py_buffer(offsets), pa.py_buffer(out)])

    return docs.withColumn(into, joined(F.col(ids)))


def digests(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns and, of ``encode`` and ``decode`` in one worker, ``n_tokens``, ``ids_sha256`` (hex digest of the ids as
    little-endian unsigned 32-bit integers) and ``decoded_sha256`` (of the decoded bytes). Null text counts as empty.
    """
    small(docs.sparkSession)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    @tidy(keep=True)
    def both(texts: pa.Array) -> pa.Array:
        e = encoder(ranks, pattern)
        found, ends = e.block([x.as_py() or "" for x in texts])
        data, upto = e.merges.bytes_of(found)
        starts = np.concatenate([[0], ends]).astype(np.int64)[:-1]
        coded = np.ascontiguousarray(found, "<u4")
        digest = lambda rows, a, b: [sha256(rows[i:j]).hexdigest() for i, j in zip(a.tolist(), b.tolist())]
        made = [pa.array(ends - starts, pa.int64()), pa.array(digest(coded, starts, ends), pa.string()), pa.array(digest(data, upto[starts], upto[ends]), pa.string())]
        return pa.StructArray.from_arrays(made, names=["n_tokens", "ids_sha256", "decoded_sha256"])

    # Declared non-deterministic so that the optimizer does not run it once per use of its fields.
    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    done = docs.withColumn("__both", both.asNondeterministic()(F.col(text)))
    return done.withColumns({c: F.col(f"__both.{c}") for c in names}).drop("__both")
