"""Secret scans: three base patterns, and formats inferred from what they find.

The values that the base patterns find are labelled credentials. For each kind their prefix tree is
folded into a probabilistic automaton: states whose ending and leaving frequencies do not differ
statistically (Hoeffding bound) are merged, so that fixed parts stay as paths and random parts become
loops. Any other run of credential characters, and what base spans leave of a run, is then scored by its likelihood
under these automata against that under background automata, character chains learned from runs the patterns do
not mark (long and short, with and without letters). A piece that was cut off from a base span is scored with and without the separators at the cut.

The base patterns run over all documents; the automata are learned from a bounded sample of the different values
found, the background from one of documents. Every text is scanned whole. Base spans are
never dropped: inferred ones (kind ``format``) are only added where no base span lies.

Defined cases: null and empty texts have no spans; a very long run is scored like any other; documents
are scanned row by row, so repeated rows give repeated results; further columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict, deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.batches import small, tidy
from tramline.llm.sampling import bounded
from tramline.session import cut_lineage

# The base patterns, which part must have how many characters, and the order of kinds.
_RULES = (
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 1, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+", re.ASCII), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+", re.ASCII), 0, 32),
)
KINDS = [kind for kind, *_ in _RULES]
FORMAT = "format"
SHORTEST = min(least for *_, least in _RULES)  # a candidate is as long as the shortest labelled value
_RUN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{SHORTEST},}}", re.ASCII)
_SEPARATORS = frozenset("+/_.=-")
_LONG, _LETTER = 16, re.compile(r"[A-Za-z]")
_REMEMBERED = 100_000
_LETTERS = 68  # characters of a run, and its end


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, order of kind, end, value) of the base matches, by start, then kind."""
    found = []
    for order, (_, pattern, part, least) in enumerate(_RULES):
        found += [(m.start(), order, m.end(), m[part]) for m in pattern.finditer(text) if len(m[part]) >= least]
    return sorted(found)


def pieces(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, int]]:
    """What ``spans`` (sorted by start) leave of runs of credential characters, if long enough.

    (start, end, and both again without the separators that join the piece to a span).
    """
    out, k, reach = [], 0, 0

    def add(a: int, b: int, left: bool, right: bool) -> None:
        if b - a < SHORTEST:
            return
        c, d = a, b
        while left and c < d and text[c] in _SEPARATORS:
            c += 1
        while right and c < d and text[d - 1] in _SEPARATORS:
            d -= 1
        out.append((a, b, c, d) if d - c >= SHORTEST else (a, b, a, b))

    for m in _RUN.finditer(text):
        at, end = m.span()
        while k < len(spans) and spans[k][0] <= at:
            reach = max(reach, spans[k][2])
            k += 1
        cut = reach > at
        at = max(at, reach)
        while k < len(spans) and spans[k][0] < end:
            start, _, stop, _ = spans[k]
            k += 1
            if start > at:
                add(at, start, cut, True)
            if stop > at:
                at, cut = stop, True
        reach = max(reach, at)
        add(at, end, cut, False)
    return out


def runs(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int]]:
    """Runs of credential characters, without what ``spans`` (sorted by start) cover."""
    return [p[2:] for p in pieces(text, spans)]


class Automaton:
    """A probabilistic automaton folded from a prefix tree by merging compatible states."""

    def __init__(self, words: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter[str]] = [Counter()]
        self.ends = [0]
        for word, n in sorted(Counter(words).items()):
            state = 0
            for c in word:
                self.count[state][c] += n
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                    self.ends.append(0)
                state = self.next[state][c]
            self.ends[state] += n
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._fold()
        self.weights = self._weights()

    def _total(self, s: int) -> int:
        return self.ends[s] + sum(self.count[s].values())

    def _apart(self, a: int, n_a: int, b: int, n_b: int) -> bool:
        return bool(n_a and n_b) and abs(a / n_a - b / n_b) > self._bound * (1 / math.sqrt(n_a) + 1 / math.sqrt(n_b))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n_a, n_b = self._total(a), self._total(b)
            if self._apart(self.ends[a], n_a, self.ends[b], n_b):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                if self._apart(self.count[a][c], n_a, self.count[b][c], n_b):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _merge(self, into: int, tree: int) -> None:
        """Add the subtree below ``tree`` to what stands at ``into``."""
        todo = [(into, tree)]
        while todo:
            into, tree = todo.pop()
            self.ends[into] += self.ends[tree]
            for c, child in self.next[tree].items():
                self.count[into][c] += self.count[tree][c]
                if c in self.next[into]:
                    todo.append((self.next[into][c], child))
                else:
                    self.next[into][c] = child

    def _fold(self) -> None:
        """Settle states from the root on: a new state joins the first settled one it is compatible with."""
        settled = [0]
        border = deque((0, c) for c in sorted(self.next[0]))
        known = {0}
        while border:
            parent, c = border.popleft()
            state = self.next[parent][c]
            if state in known:
                continue
            for other in settled:
                if self._compatible(other, state):
                    self.next[parent][c] = other
                    self._merge(other, state)
                    border.extend((other, x) for x in sorted(self.next[other]) if self.next[other][x] not in known)
                    break
            else:
                settled.append(state)
                known.add(state)
                border.extend((state, x) for x in sorted(self.next[state]))

    def _weights(self) -> dict[int, tuple[dict[str, tuple[float, int]], float]]:
        """Reachable states: bits and target by character, bits of an end. Unseen characters keep a small share."""
        out, todo = {}, [0]
        while todo:
            s = todo.pop()
            if s in out:
                continue
            total = self._total(s) + 1
            out[s] = ({c: (-math.log2(self.count[s][c] / total), t) for c, t in self.next[s].items()}, -math.log2((self.ends[s] + 1 / _LETTERS) / total))
            todo += self.next[s].values()
        self._miss = {s: math.log2((self._total(s) + 1) * _LETTERS) for s in out}
        self.next = self.count = self.ends = []  # type: ignore[assignment]
        return out

    def bits(self, word: str) -> float:
        """Code length of ``word``, ended."""
        state, total = 0, 0.0
        for c in word:
            steps, _ = self.weights[state]
            cost, state = steps.get(c) or (self._miss[state], state)
            total += cost
        return total + self.weights[state][1]


class Background:
    """Chain of characters over runs that no base pattern marks; unseen steps keep a small share."""

    def __init__(self, words: list[str]):
        pairs: dict[str, Counter[str]] = defaultdict(Counter)
        for word in words:
            for a, b in zip("^" + word, word + "$", strict=True):
                pairs[a][b] += 1
        self.cost = {a: {b: -math.log2((n + 1 / _LETTERS) / (sum(c.values()) + 1)) for b, n in c.items()} for a, c in pairs.items()}
        self.miss = {a: math.log2((sum(c.values()) + 1) * _LETTERS) for a, c in pairs.items()}

    def bits(self, word: str) -> float:
        empty: dict[str, float] = {}
        return sum(self.cost.get(a, empty).get(b) or self.miss.get(a, math.log2(_LETTERS)) for a, b in zip("^" + word, word + "$", strict=True))


def _stratum(word: str) -> str:
    """Runs by length and by letters: words are so many that numbers and long runs would teach their background nothing."""
    return f"{FORMAT}-{'long' if len(word) >= _LONG else 'short'}-{'letters' if _LETTER.search(word) else 'numbers'}"


class Formats:
    """What was learned: an automaton for each kind, and a background for each stratum; the best of them counts."""

    def __init__(self, labelled: dict[str, list[str]], others: list[str]):
        self.automata = {kind: Automaton(words) for kind, words in sorted(labelled.items()) if words}
        strata: dict[str, list[str]] = defaultdict(list)
        for word in others:
            strata[_stratum(word)].append(word)
        self.backgrounds = [Background(words) for _, words in sorted(strata.items())] or [Background([])]
        self._known: dict[tuple[str, float], float] = {}

    def _piece(self, text: str, piece: tuple[int, int, int, int], least_gain: float) -> tuple[int, int] | None:
        """The span to add for ``piece``: the better one of the two, if any reaches ``least_gain``."""
        a, b, c, d = piece
        best = self._remembered(text[a:b], least_gain)
        if (c, d) != (a, b) and (inner := self._remembered(text[c:d], least_gain)) > best:
            a, b, best = c, d, inner
        return (a, b) if best >= least_gain else None

    def _remembered(self, word: str, least: float) -> float:
        """``gain``; most candidates are words that come again."""
        if len(word) > 32:
            return self.gain(word, least)
        known = self._known.get((word, least))
        if known is None:
            if len(self._known) >= _REMEMBERED:
                self._known.clear()
            known = self._known[word, least] = self.gain(word, least)
        return known

    def gain(self, word: str, least: float = -math.inf) -> float:
        """Bits by which the best format explains ``word`` better than the background does; any smaller value below ``least``."""
        plain = math.inf
        for background in self.backgrounds:
            plain = min(plain, background.bits(word))
            if plain < least:  # no code is shorter than 0 bits
                return -math.inf
        return plain - min((a.bits(word) for a in self.automata.values()), default=math.inf)

    def spans(self, text: str, least_gain: float) -> list[tuple[int, int, int, str]]:
        base = base_spans(text)
        found = (self._piece(text, p, least_gain) for p in pieces(text, base))
        added = [(a, len(KINDS), b, text[a:b]) for a, b in filter(None, found)]
        return sorted(base + added)


_VALUES = pa.schema([("kind", pa.string()), ("value", pa.string())])


def _labelled(batches):
    for batch in batches:
        found = [(KINDS[order], value) for text in batch.column(0).to_pylist() for _, order, _, value in base_spans(text or "")]
        yield pa.RecordBatch.from_pydict({"kind": [k for k, _ in found], "value": [v for _, v in found]}, schema=_VALUES)


def _others(batches):
    for batch in batches:
        found = [t[a:b] for t in batch.column(0).to_pylist() if t for a, b in runs(t, base_spans(t))]
        yield pa.RecordBatch.from_pydict({"kind": [_stratum(w) for w in found], "value": found}, schema=_VALUES)


def learn(docs: DataFrame, doc: str = "doc_id", text: str = "text", documents: int = 10_000, values: int = 1_000, longest: int = 1_000) -> Formats:
    """Formats from about ``values`` different credentials of each kind in all documents, and about ``values`` other runs of each stratum of ``documents`` documents.

    ``values`` bounds what comes to the driver, with ``longest``, the length up to which a value teaches a format.
    """
    sample = bounded(docs.select(doc, text), documents, [doc]).select(text)
    found = docs.select(text).mapInArrow(_labelled, "kind string, value string").union(sample.mapInArrow(_others, "kind string, value string"))
    found = cut_lineage(found.filter(F.length("value") <= longest).distinct())
    rows = bounded(found, values, ["value"], group="kind").collect()
    by_kind: dict[str, list[str]] = defaultdict(list)
    for kind, value in sorted(map(tuple, rows)):
        by_kind[kind].append(value)
    others = [w for kind in list(by_kind) if kind not in KINDS for w in by_kind.pop(kind)]
    return Formats(by_kind, others)


def scan(docs: DataFrame, formats: Formats, text: str = "text", least_gain: float = 16.0) -> DataFrame:
    """All columns and ``found``: array of kind, start, end (code points, end exclusive) by start, then kind."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    small(docs.sparkSession)
    names = [*KINDS, FORMAT]

    @F.arrow_udf("array<struct<kind:string,start:int,end:int>>")
    @tidy()
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([[(names[k], a, b) for a, k, b, _ in formats.spans(t, least_gain)] if t else [] for t in texts.to_pylist()], kind)

    return docs.withColumn("found", spans(F.col(text)))


def digest(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s.kind == kind)).cast("bigint")


def base_only(found: Column) -> Column:
    return F.filter(found, lambda s: s.kind != FORMAT)


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every stretch covered by spans replaced by ``mark``."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("upto"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s.start >= acc.upto
        more = F.when(fresh, F.concat(acc.text, F.substring(text, acc.upto + 1, s.start - acc.upto), F.lit(mark))).otherwise(acc.text)
        return F.struct(more.alias("text"), F.greatest(acc.upto, s.end).alias("upto"))

    end = F.aggregate(found, start, step, lambda acc: F.concat(acc.text, F.substring(text, acc.upto + 1, F.length(text))))
    return F.when(text.isNotNull(), end)

