"""SentencePiece encoding and decoding with weighted finite-state transducers.

A model file is compiled into three transducers: the normaliser (longest-match rewriting by the model's
character map, then its rules on white space), the pieces (a trie whose arcs spell a piece and give its id
at the cost of its negated score) and the byte fallback (a character without a piece becomes its UTF-8
bytes' ids). An input is normalised and composed with the last two, and the path of least total
weight through that lattice, in the tropical semiring, is its encoding.

For unigram models that is the model's best segmentation. A BPE model means merging pairs best score
first, which a sum of piece scores cannot say; its pieces cost nothing, and an arc may follow another
only if merging would have left these two side by side (``_Bpe.joins``). One path remains then, and it is
the one that merging yields. Pieces of one lowest score that are made of each other (runs of word marks)
are composed afterwards, from left to right.

No arc of the lattice passes between two characters that follow each other in no piece, as mostly an
ordinary character and a word mark. The text is cut there, the shortest path is found part by part, and parts met
before are looked up.

Decoding runs the transducers backwards: pieces to text, byte runs to characters (each byte outside
valid UTF-8 to U+FFFD), word marks to spaces, without the leading space that encoding added.

Defined cases: a null text gives null ids, an empty one no ids; characters beyond the model are bytes or,
without byte fallback, one unknown id a run; repeated rows give repeated results; further columns pass
through. Texts are encoded whole; a text without word ends costs time in proportion to its length.
"""

from __future__ import annotations

import math
import re
import struct
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.batches import held, small, tidy

MARK = "▁"
#: Words and pairs remembered by a worker before its memory starts afresh, and the longest word remembered.
_REMEMBERED, _LONGEST = 240_000, 48
#: Characters that mostly decide which arcs start at a place.
_WINDOW = 6
#: Bytes of text a worker is handed at a time; ids are several times as long.
_BATCH = 4 << 20
#: Characters cut into parts at a time.
_STRIP = 1 << 16
# Types of pieces and model types in a SentencePiece model file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


class _Model:
    """A model file: pieces with score and type, and what the normaliser needs."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.pieces = [(p.piece, p.score, p.type) for p in model.pieces]
        self.kind = model.trainer_spec.model_type
        self.byte_fallback = model.trainer_spec.byte_fallback
        self.unk_surface = model.trainer_spec.unk_surface
        n = model.normalizer_spec
        self.add_prefix, self.strip, self.charsmap = n.add_dummy_prefix, n.remove_extra_whitespaces, n.precompiled_charsmap
        self.escape = n.escape_whitespaces
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        if self.kind not in (_UNIGRAM, _BPE) or self.suffix:
            raise ValueError("only unigram and BPE models with leading word marks are supported")


class _Normaliser:
    """Rewrites by the longest key of the character map, then spaces: stripped, prefixed, turned into marks."""

    def __init__(self, model: _Model):
        self.model = model
        self.units: tuple[int, ...] = ()
        if model.charsmap:
            (size,) = struct.unpack_from("<I", model.charsmap)
            self.units = struct.unpack_from(f"<{size // 4}I", model.charsmap, 4)
            self.words = model.charsmap[4 + size :]

    def _longest(self, data: bytes, at: int) -> tuple[int, int]:
        """Length of the longest key at a place, and where its replacement starts."""
        units, found = self.units, (0, 0)
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for k in range(at, len(data)):
            node ^= data[k]
            unit = units[node]
            if (unit & 0x800000FF) != data[k]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = (k + 1 - at, units[node] & 0x7FFFFFFF)
        return found

    def _mapped(self, text: str) -> str:
        if not self.units:
            return text
        data, out, at = text.encode(), [], 0
        while at < len(data):
            size, word = self._longest(data, at)
            if size:
                out.append(self.words[word : self.words.index(b"\0", word)])
            else:
                first = data[at]
                size = 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4
                out.append(data[at : at + size])
            at += size
        return b"".join(out).decode()

    def __call__(self, text: str) -> str:
        m = self.model
        text = self._mapped(text)
        if m.strip:
            text = re.sub(" +", " ", text.strip(" "))
        if text and m.add_prefix:
            text = " " + text
        return text.replace(" ", MARK) if m.escape else text


class _Bpe:
    """Which symbols may stand side by side once all merges are done."""

    def __init__(self, scores: dict[str, float]):
        order = sorted((p for p in scores if len(p) > 1), key=lambda p: (-scores[p], p))
        ranks: dict[float, int] = {}
        self.rank = {p: ranks.setdefault(scores[p], len(ranks)) for p in order}
        self.parts: dict[str, tuple[str, str]] = {}
        self.follows: dict[str, dict[str, bool]] = {}  # remembered: which arcs may follow a symbol
        self.size = 0
        for p in order:  # children come before their piece: merging makes them first
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                if self._earlier(a, p) and self._earlier(b, p) and self._side_by_side(a, b, self.rank[p]):
                    self.parts[p] = (a, b)
                    break
        # Pieces of one score that are made of each other, as runs of marks are: they merge last.
        self.last: set[str] = set()
        tied = {self.rank[p] for p in order if p not in self.parts and any(self.rank.get(p[:k]) == self.rank[p] or self.rank.get(p[k:]) == self.rank[p] for k in range(1, len(p)))}
        if tied:
            if tied != {len(ranks) - 1}:
                raise ValueError("pieces of equal score that are made of each other must have the lowest score")
            self.last = {p for p in order if self.rank[p] == len(ranks) - 1}
            for p in self.last:
                del self.rank[p]
                self.parts.pop(p, None)

    def _earlier(self, part: str, whole: str) -> bool:
        return len(part) == 1 or part in self.parts and self.rank[part] < self.rank[whole]

    def made(self, piece: str) -> bool:
        """False for pieces that merging never yields."""
        return len(piece) == 1 or piece in self.parts

    def _side_by_side(self, a: str, b: str, before: float) -> bool:
        """Undo the merges inside ``a`` and ``b`` that lie at their border, latest first.

        At each moment the two symbols at the border coexisted; had their own merge come first, it would
        have been taken. Equal merges are taken from left to right.
        """
        rank = self.rank
        while True:
            joined = rank.get(a + b)
            if joined is not None and joined < before:
                return False
            left, right = rank[a] if len(a) > 1 else -1, rank[b] if len(b) > 1 else -1
            if left < 0 and right < 0:
                return True
            if left > right:
                before, a = left, self.parts[a][1]
            else:
                before, b = right + 1, self.parts[b][0]

    def absorbed(self, symbols: list[str]) -> list[str]:
        """The merges that come last, leftmost first."""
        out: list[str] = []
        for symbol in symbols:
            out.append(symbol)
            while len(out) > 1 and out[-2] + out[-1] in self.last:
                out[-2:] = [out[-2] + out[-1]]
        return out

    def joins(self, a: str, b: str) -> bool:
        return self._side_by_side(a, b, math.inf)

    def forget(self) -> None:
        self.follows.clear()
        self.size = 0


class _Memory(dict):
    """What was looked up lately, made where it is new: entries not met again while the next half fills are dropped."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.make = make

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > _LONGEST:
                return found
            if 2 * len(self) >= _REMEMBERED:
                self.older = dict(self)
                self.clear()
        self[key] = found
        return found


class _Cuts:
    """Where a text comes apart: two characters that follow each other in no piece part the lattice, every path passes between them.

    ``bits`` holds one bit for every pair of a first and a second character of some piece, row by row.
    """

    def __init__(self, inner: set[tuple[str, str]]):
        firsts, seconds = ({c: k for k, c in enumerate(sorted({pair[i] for pair in inner}), 1)} for i in (0, 1))
        self.row, self.column = np.zeros(0x110000, np.int32), np.zeros(0x110000, np.int32)
        table = np.zeros((len(firsts) + 1, (len(seconds) // 8 + 1) * 8), bool)
        for c, k in firsts.items():
            self.row[ord(c)] = k
        for c, k in seconds.items():
            self.column[ord(c)] = k
        for x, y in inner:
            table[firsts[x], seconds[y]] = True
        self.wide = table.shape[1] // 8
        self.bits = np.packbits(table, axis=1, bitorder="little").ravel()

    def parts(self, text: str) -> Iterator[list[str]]:
        """The text's parts in order, a strip of it at a time."""
        at, size = 0, _STRIP
        while at < len(text):
            strip = text[at : at + size]
            codes = np.frombuffer(strip.encode("utf-32-le", "surrogatepass"), np.uint32)
            column = self.column[codes[1:]]
            byte = self.bits[self.row[codes[:-1]].astype(np.int64) * self.wide + (column >> 3)]
            cuts = np.flatnonzero((byte >> (column & 7).astype(np.uint8) & 1) == 0) + 1
            if at + len(strip) < len(text):
                if not len(cuts):  # one part, longer than the strip
                    size *= 2
                    continue
                strip, cuts = strip[: cuts[-1]], cuts[:-1]
            at, size = at + len(strip), _STRIP
            if "\0" in strip:
                ends = cuts.tolist()
                yield [strip[i:j] for i, j in zip([0, *ends], [*ends, len(strip)])]
            else:
                yield np.insert(codes[: len(strip)], cuts, 0).tobytes().decode("utf-32-le", "surrogatepass").split("\0")


class Transducer:
    """A compiled model."""

    def __init__(self, path: str):
        self.model = _Model(path)
        self.normalise = _Normaliser(self.model)
        pieces = self.model.pieces
        self.unk = next(i for i, (_, _, kind) in enumerate(pieces) if kind == _UNKNOWN)
        byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.byte_ids = [byte_ids[b] for b in range(256)] if self.model.byte_fallback else []
        self.byte_of = {i: b for b, i in byte_ids.items()}
        self.is_byte = np.array([kind == _BYTE for _, _, kind in pieces])
        self.user = re.compile("|".join(sorted((re.escape(p) for p, _, k in pieces if k == _USER), key=len, reverse=True)) or "(?!)")
        self.id_of = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (_NORMAL, _USER, _UNUSED)}
        self.code_of = {p: array("i", [i]).tobytes() for p, i in self.id_of.items()}
        spelled = {p: s for p, s, kind in pieces if kind == _NORMAL}
        self.bpe = _Bpe(spelled) if self.model.kind == _BPE else None
        self.least = min(spelled.values(), default=0.0) - 10.0  # score of an unknown character
        self.cost = {p: 0.0 if self.bpe else -s for p, s in spelled.items() if not self.bpe or self.bpe.made(p)}
        self.prefixes = {p[:k] for p in self.cost for k in range(1, len(p) + 1)}
        self.trie: dict = {}
        for p in self.cost:
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p
        self.arcs_at: dict[str, tuple[str, ...]] = {}
        self.text_of = [self._text(i) for i in range(len(pieces))]
        self._cuts = _Cuts({pair for p in spelled for pair in zip(p, p[1:])})
        self._known = _Memory(self._path)

    def _text(self, i: int) -> str:
        piece, _, kind = self.model.pieces[i]
        if kind == _CONTROL:
            return ""
        return self.model.unk_surface if kind == _UNKNOWN else piece.replace(MARK, " ") if self.model.escape else piece

    def _path(self, word: str) -> bytes:
        """Ids along the shortest path through a part's lattice, as 32-bit integers; without byte fallback, unknown characters as -1 - code point."""
        path = self._only_path(word) if self.bpe else self._best_path(word)
        try:
            return b"".join(map(self.code_of.__getitem__, path))
        except KeyError:
            ids = [self.id_of.get(piece, -1 - ord(piece[0])) for piece in path]
            return array("i", self._bytes(ids) if self.byte_ids else ids).tobytes()

    def _bytes(self, path: list[int]) -> list[int]:
        """Unknown characters as their bytes' ids."""
        return [x for i in path for x in ((i,) if i >= 0 else [self.byte_ids[b] for b in chr(-1 - i).encode()])]

    def _best_path(self, word: str) -> list[str]:
        """Forward over the lattice: the least weight at every place, and the arc that brought it."""
        n = len(word)
        best, back = [math.inf] * (n + 1), [""] * (n + 1)
        best[0] = 0.0
        cost, prefixes = self.cost, self.prefixes
        for i in range(n):
            here, j = best[i], i + 1
            arc = word[i:j]
            if arc not in cost and here - self.least < best[j]:  # a character of no piece: bytes or unknown
                best[j], back[j] = here - self.least, arc
            while arc in prefixes:
                weight = cost.get(arc)
                if weight is not None and here + weight < best[j]:
                    best[j], back[j] = here + weight, arc
                j += 1
                if j > n:
                    break
                arc = word[i:j]
        path: list[str] = []
        while n:
            path.append(back[n])
            n -= len(back[n])
        path.reverse()
        return path

    def _only_path(self, word: str) -> list[str]:
        """All arcs weigh nothing here, so any path through is shortest: depth first, longest arcs first.

        A place that is reached is reached by one path only, so a place without a way on is never tried again.
        """
        bpe, arcs_at = self.bpe, self.arcs_at
        if bpe.size > _REMEMBERED:
            bpe.forget()
        if len(arcs_at) > _REMEMBERED:
            arcs_at.clear()
        follows = bpe.follows
        n, at, last = len(word), 0, ""
        path: list[str] = []
        dead: set[int] = set()
        shorter_than = n + 1
        while at < n:
            after = follows.get(last)
            if after is None:
                after = follows[last] = {}
            for arc in arcs_at.get(word[at : at + _WINDOW]) or self._arcs(word, at):
                if dead and (len(arc) >= shorter_than or at + len(arc) in dead):
                    continue
                fits = after.get(arc)
                if fits is None:
                    bpe.size += 1
                    fits = after[arc] = not last or bpe.joins(last, arc)
                if fits:
                    path.append(arc)
                    last = arc
                    at += len(arc)
                    shorter_than = n + 1
                    break
            else:  # no way on: back to the place before, and a shorter arc from there
                dead.add(at)
                shorter_than = len(path[-1])
                at -= len(path.pop())
                last = path[-1] if path else ""
        return bpe.absorbed(path) if bpe.last and MARK * 2 in word else path

    def _arcs(self, word: str, at: int) -> tuple[str, ...]:
        """The arcs from a place, longest first; remembered if the next few characters decide them."""
        node, found = self.trie, []
        for k in range(at, len(word)):
            node = node.get(word[k])
            if node is None:
                break
            if "" in node:
                found.append(node[""])
        else:
            k = len(word)
        if not found or len(found[0]) > 1:
            found.insert(0, word[at])  # a character of no piece: bytes or unknown
        arcs = tuple(reversed(found))
        if k - at < _WINDOW:
            self.arcs_at[word[at : at + _WINDOW]] = arcs
        return arcs

    def _unknown(self, path: array) -> list[int]:
        """Each run of unknown characters as one unknown id."""
        return [i if i >= 0 else self.unk for k, i in enumerate(path) if i >= 0 or k == 0 or path[k - 1] >= 0]

    def _words(self, text: str) -> bytes:
        known = self._known
        return b"".join([b"".join(map(known.__getitem__, parts)) for parts in self._cuts.parts(text)])

    def coded(self, text: str) -> array:
        """The text's ids."""
        out: list[bytes] = []
        text, at = self.normalise(text), 0
        for m in self.user.finditer(text):  # user-defined symbols are taken as they are
            out.append(self._words(text[at : m.start()]))
            out.append(array("i", [self.id_of[m[0]]]).tobytes())
            at = m.end()
        out.append(self._words(text[at:] if at else text))
        ids = array("i")
        for part in out:
            ids.frombytes(part)
        return ids if self.byte_ids else array("i", self._unknown(ids))

    def encode(self, text: str) -> list[int]:
        return self.coded(text).tolist()

    def _has_bytes(self, ids: Sequence[int]) -> bool:
        found = np.asarray(ids, np.int64)
        return bool(self.is_byte[found].any())

    def decode(self, ids: Sequence[int]) -> str:
        text_of, byte_of = self.text_of, self.byte_of
        if byte_of and self._has_bytes(ids):
            out: list[str] = []
            held = bytearray()
            for i in ids:
                if i in byte_of:
                    held.append(byte_of[i])
                    continue
                if held:
                    out.append(_characters(bytes(held)))
                    held.clear()
                out.append(text_of[i])
            out.append(_characters(bytes(held)))
            text = "".join(out)
        else:
            text = "".join(map(text_of.__getitem__, ids))
        if self.model.add_prefix and text.startswith(" "):
            first = next(i for i in ids if i in byte_of or text_of[i])
            return text if first in byte_of else text[1:]
        return text


def _characters(data: bytes) -> str:
    """Bytes as characters; each byte outside valid UTF-8 is U+FFFD."""
    out = []
    while data:
        try:
            return "".join(out) + data.decode()
        except UnicodeDecodeError as e:
            out.append(data[: e.start].decode() + "�")
            data = data[e.start + 1 :]
    return "".join(out)


def transducer(path: str) -> Transducer:
    """One compiled model per worker."""
    return held(("pieces", path), lambda: Transducer(path))


def encode(docs: DataFrame, model: str, text: str = "text", into: str = "ids") -> DataFrame:
    """All columns and ``into``: the ids of ``text``. ``model`` is a path every worker can open."""
    small(docs.sparkSession, _BATCH)

    @F.arrow_udf("array<int>")
    @tidy(keep=True)
    def ids(texts: pa.Array) -> pa.Array:
        t = transducer(model)
        values, ends = array("i"), array("i", [0])
        for x in texts:
            values.extend(t.coded(x.as_py() or ""))
            ends.append(len(values))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(values, np.int32)), mask=texts.is_null())

    return docs.withColumn(into, ids(F.col(text)))


def read_back(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass of one worker: all columns, ``ids`` and ``decoded``."""
    return _both(docs, model, text, ids, decoded, "string", lambda read, _: read)


def round_trips(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", same: str = "round_trip") -> DataFrame:
    """As ``read_back``, but instead of the decoded text whether it is the text itself (true of a null): it does not travel back."""
    return _both(docs, model, text, ids, same, "boolean", lambda read, before: read == before)


def _both(docs: DataFrame, model: str, text: str, ids: str, out: str, kind: str, result: Callable[[str | None, str | None], object]) -> DataFrame:
    small(docs.sparkSession, _BATCH)

    @F.arrow_udf(f"struct<ids:array<int>,out:{kind}>")
    @tidy(keep=True)
    def both(texts: pa.Array) -> pa.Array:
        t = transducer(model)
        values, ends, read = array("i"), array("i", [0]), []
        for part in (texts[k : k + 500] for k in range(0, len(texts), 500)):
            made = []
            for x in part:
                before = x.as_py()
                own = t.coded(before or "")
                values.extend(own)
                ends.append(len(values))
                made.append(result(None if before is None else t.decode(own), before))
            read.append(pa.array(made, pa.string() if kind == "string" else pa.bool_()))
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(values, np.int32)), mask=texts.is_null())
        return pa.StructArray.from_arrays([listed, pa.chunked_array(read, pa.string() if kind == "string" else pa.bool_()).combine_chunks()], names=["ids", "out"])

    # Declared non-deterministic so that the optimizer does not run it once per use of its fields.
    done = docs.withColumn("__both", both.asNondeterministic()(F.col(text)))
    return done.withColumns({ids: F.col("__both.ids"), out: F.col("__both.out")}).drop("__both")


def decode(docs: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns and ``into``: the text of ``ids``."""

    @F.arrow_udf("string")
    @tidy(keep=True)
    def texts(rows: pa.Array) -> pa.Array:
        t = transducer(model)
        parts = [rows[k : k + 500] for k in range(0, max(len(rows), 1), 500)]
        made = [pa.array([t.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in part], pa.string()) for part in parts]
        return pa.concat_arrays(made)

    return docs.withColumn(into, texts(F.col(ids)))
