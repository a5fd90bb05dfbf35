"""Repair of conversations whose roles must read ``(s?(ua)+)?`` by their initials (system, user, assistant).

**Method.** A row may be kept, given another role, or deleted, and empty rows may be inserted; each edit has a cost and a letter, and the
cheapest sequence is wanted, the ASCII-least letters where costs tie. Both are one integer: the cost in the high digits, the
letters as digits of fixed width below, the first letter highest, zeros at the end. An edge of the DAG (row by role state) puts its
letter on top and moves what follows one digit down; the plain minimum of integers then decides everything. Letters stand in
ASCII order, zero is less than all, so integers compare as the strings do. As an insertion costs something, no two sequences of
equal cost have the one as beginning of the other, so the least sequence is made of least parts.

**Scale.** Rows are sorted by range, so a conversation with a third of all rows lies in many partitions; places are counted by
partition with what the one before ended in. Its rows are cut into blocks of ``BLOCK`` rows. Each block becomes a 4 x 4 matrix of such integers
(cheapest way from any role state to any other), in a task of its own; matrices of a conversation are joined from the end.
What meets in one row per conversation are its matrices and its letters. Repeats are found by the first place of a digest of
role and text, summed before shuffling. Repaired rows come out distributed; only the query's hash reads a conversation in one
stream, a batch at a time.

**Defined results.** Null ids form one conversation of their own. Null role or text is one space; a null turn sorts first. Rows of one
turn are ordered by role, then text. A role that does not start with s, u or a (an empty one too) cannot be kept. A conversation without
rows has cost 0 and no letters. Repeated rows are duplicates. An empty table gives no rows. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.session import cut_lineage

#: Rows whose edits are decided together.
BLOCK = 256
#: Space, and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
DELETE, INSERT, KEEP, REROLE = "DIKR"
_DIGIT = {letter: k for k, letter in enumerate("DIKR", 1)}
_BITS = 3
# Role states: nothing yet, after s, after u, after a. A conversation may end in the first and the last.
_START, _S, _U, _A = range(4)
_NEXT = {(_START, _S): _S, (_START, _U): _U, (_S, _U): _U, (_A, _U): _U, (_U, _A): _A}
_FAULTS = ("ok", "blank", "duplicate", "truncated")


def key_of(conv: Column) -> Column:
    """The conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-"))


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with rows dropped, emptied, stripped of marks, repeated or given to the user, by crc32 of ``conv_id:turn``."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), how.alias("how")).filter("how <> 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("how") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def _state_of(role: Column) -> Column:
    """The role state a kept row leads to; 0 for none."""
    first = F.substring(role, 1, 1)
    return F.when(first == "s", _S).when(first == "u", _U).when(first == "a", _A).otherwise(0)


def placed(turns: DataFrame) -> DataFrame:
    """key, turn, role, text -> also ``pos`` (from 0, in the conversation), ``state`` (of the role) and ``illegal`` (with the row before)."""
    ordered = cut_lineage(turns.withColumn("state", _state_of(F.col("role"))).orderBy("key", F.col("turn").asc_nulls_first(), "role", "text"))
    tagged = ordered.withColumn("part", F.spark_partition_id())

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last conversation of a partition: its rows there, its last state, and whether the partition holds no other."""
        part, key, rows, state, only = None, None, 0, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch["key"].to_pylist()
            part, state = batch["part"][0].as_py(), batch["state"][-1].as_py()
            for k in keys:
                if key is not None and k != key:
                    rows, only = 0, False
                key, rows = k, rows + 1
        if part is not None:
            yield pa.RecordBatch.from_pylist([{"part": part, "key": key, "rows": rows, "state": state, "only": only}])

    start: dict[int, tuple[str, int, int]] = {}
    key, rows, state = "", 0, 0
    found = tagged.select("key", "state", "part").mapInArrow(ends, "part long, key string, rows long, state long, only boolean")
    for e in sorted(found.collect()):
        start[e["part"]] = (key, rows, state)
        rows = e["rows"] + (rows if e["only"] and e["key"] == key else 0)
        key, state = e["key"], e["state"]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, pos, before = now or start[batch["part"][0].as_py()]
            at, wrong = [], []
            for k, s in zip(batch["key"].to_pylist(), batch["state"].to_pylist()):
                if k != key:
                    key, pos = k, 0
                wrong.append(int(pos > 0 and (before, s) not in ((_S, _U), (_U, _A), (_A, _U))))
                at.append(pos)
                pos, before = pos + 1, s
            now = (key, pos, before)
            columns = [batch[c] for c in ("key", "turn", "role", "text", "state")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(at, pa.int64()), pa.array(wrong, pa.int64())], names=[*names, "pos", "illegal"])

    names = ["key", "turn", "role", "text", "state"]
    kind = turns.schema["turn"].dataType.simpleString()
    return tagged.mapInArrow(places, f"key string, turn {kind}, role string, text string, state int, pos long, illegal long")


def faults(rows: DataFrame) -> DataFrame:
    """``placed`` rows with ``fault``: 1 blank, 2 duplicate (role and text seen earlier), 3 truncated, 0 none; the first that holds."""
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    first = rows.groupBy("key", said.alias("said")).agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("first"))
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(shown == "", 1).when(F.col("first").isNull(), 2).when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    return rows.join(first, ["key", "pos"], "left").withColumn("fault", fault).drop("first")


class Costs:
    """Cost of each edit; ``truncated`` is added to a truncated row that stays."""

    def __init__(self, rerole: int = 1, delete: int = 2, insert: int = 5, truncated: int = 5):
        if min(rerole, delete, truncated) < 0 or insert < 1:
            raise ValueError("costs must not be negative, and an insertion must cost something")
        self.rerole, self.delete, self.insert, self.truncated = rerole, delete, insert, truncated

    def edges(self, state: int, fault: int) -> list[tuple[int, int, int, str]]:
        """from, to, cost, letter for a row."""
        found = [(s, s, self.delete, DELETE) for s in range(4)]
        if fault in (1, 2):
            return found
        more = self.truncated if fault == 3 else 0
        found += [(a, b, more, KEEP) for (a, r), b in _NEXT.items() if r == state]
        return found + [(a, b, self.rerole + more, REROLE) for (a, r), b in _NEXT.items() if r != _S]

    def inserts(self) -> list[tuple[int, int, int, str]]:
        return [(a, b, self.insert, INSERT) for (a, r), b in _NEXT.items() if r != _S]


class Weights:
    """Integers of a cost and ``width`` letters."""

    def __init__(self, width: int):
        self.top, self.all = _BITS * (width - 1), _BITS * width
        self.mask = (1 << self.all) - 1

    def led(self, weight: int, cost: int, letter: str) -> int:
        """An edge before what ``weight`` says."""
        return (((weight >> self.all) + cost) << self.all) | (_DIGIT[letter] << self.top) | ((weight & self.mask) >> _BITS)

    def split(self, weight: int) -> tuple[int, str]:
        """Cost and letters."""
        digits, letters = weight & self.mask, []
        for at in range(self.top, -1, -_BITS):
            d = (digits >> at) & 7
            if not d:
                break
            letters.append("DIKR"[d - 1])
        return weight >> self.all, "".join(letters)


def _least(ways: dict[int, int], edges: list[tuple[int, int, int, str]], weights: Weights) -> dict[int, int]:
    """From each state the least of an edge and what its end says."""
    found: dict[int, int] = {}
    for a, b, cost, letter in edges:
        if b in ways:
            w = weights.led(ways[b], cost, letter)
            if a not in found or w < found[a]:
                found[a] = w
    return found


def _inserted(ways: dict[int, int], costs: Costs, weights: Weights) -> dict[int, int]:
    """The same with insertions first; more than two in a row would come back to a state."""
    for _ in range(2):
        more = _least(ways, costs.inserts(), weights)
        ways = {s: min(w for w in (ways.get(s), more.get(s)) if w is not None) for s in ways.keys() | more.keys()}
    return ways


def block_ways(codes: list[int], costs: Costs) -> list[list[tuple[int, str] | None]]:
    """codes (4 x state + fault of each row) -> cost and letters of the least way between any two states."""
    weights = Weights(3 * len(codes))
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    for end in range(4):
        ways = {end: 0}
        for code in reversed(codes):
            ways = _inserted(_least(ways, costs.edges(code // 4, code % 4), weights), costs, weights)
        for a, w in ways.items():
            table[a][end] = weights.split(w)
    return table


def _digits(letters: str) -> int:
    """Letters as an integer, the first highest."""
    return int("".join(map(str, map(_DIGIT.__getitem__, letters))) or "0", 8)


def joined_ways(blocks: list[list[list[tuple[int, str] | None]]], rows: int, costs: Costs) -> tuple[int, list[tuple[int, str]], str]:
    """Block tables in order -> cost, (state before, letters) of each block, letters of insertions at the end."""
    weights = Weights(3 * rows + 2)
    ends = _inserted({_START: 0, _A: 0}, costs, weights)
    ways, choices = ends, []
    for table in reversed(blocks):
        now: dict[int, int] = {}
        choice: dict[int, int] = {}
        for a in range(4):
            for b in ways:
                if (way := table[a][b]) is None:
                    continue
                cost, letters = way
                used = _BITS * len(letters)
                w = ((ways[b] >> weights.all) + cost << weights.all) | (_digits(letters) << weights.all - used) | ((ways[b] & weights.mask) >> used)
                if a not in now or w < now[a]:
                    now[a], choice[a] = w, b
        ways = now
        choices.append(choice)
    state, parts = _START, []
    for table, choice in zip(blocks, reversed(choices)):
        parts.append((state, table[state][choice[state]][1]))
        state = choice[state]
    return ways[_START] >> weights.all, parts, weights.split(ends[state])[1]


def repaired_entries(codes: list[int], state: int, letters: str) -> list[dict]:
    """What stays of a block, in order: the row's place in it (none for an insertion) and its role (none where it is kept)."""
    out, at = [], 0
    for letter in letters:
        code = 0
        if letter != INSERT:
            code, at = codes[at], at + 1
        if letter == DELETE:
            continue
        role = code // 4 if letter == KEEP else (_A if state == _U else _U)
        state = _NEXT[state, role]
        out.append({"row": at - 1 if letter != INSERT else None, "role": None if letter == KEEP else ("user" if role == _U else "assistant")})
    return out


class Repair:
    """Results of a repair: ``rows`` with fault and edits' base, ``plans`` per conversation, ``repaired`` rows."""

    def __init__(self, turns: DataFrame, costs: Costs | None = None):
        """turns: conv_id, turn, role, text (no nulls in role and text)."""
        costs = costs or Costs()
        keyed = turns.select(key_of(F.col("conv_id")).alias("key"), "turn", "role", "text")
        self.rows = cut_lineage(faults(placed(keyed)))
        code = (F.col("state") * 4 + F.col("fault")).alias("code")
        listed = F.sort_array(F.collect_list(F.struct("pos", code)))
        blocks = self.rows.groupBy("key", F.floor(F.col("pos") / BLOCK).alias("block")).agg(listed["code"].alias("codes"))

        @F.arrow_udf("array<struct<cost:bigint,letters:string>>")
        def ways(codes: pa.Array) -> pa.Array:
            seen: dict[tuple, list] = {}
            out = []
            for row in codes.to_pylist():
                if (key := tuple(row)) not in seen:
                    if len(seen) > 5_000:
                        seen.clear()
                    seen[key] = [None if w is None else {"cost": w[0], "letters": w[1]} for line in block_ways(row, costs) for w in line]
                out.append(seen[key])
            return pa.array(out, pa.list_(pa.struct([("cost", pa.int64()), ("letters", pa.string())])))

        part = "struct<block:bigint,state:int,letters:string>"

        @F.arrow_udf(f"struct<cost:bigint,ending:string,parts:array<{part}>>")
        def least(tables: pa.Array, rows: pa.Array) -> pa.Array:
            out = []
            for listed, n in zip(tables.to_pylist(), rows.to_pylist()):
                shaped = [[[(w["cost"], w["letters"]) if w else None for w in t["ways"][4 * a : 4 * a + 4]] for a in range(4)] for t in listed]
                cost, parts, ending = joined_ways(shaped, n, costs)
                named = [{"block": t["block"], "state": s, "letters": x} for t, (s, x) in zip(listed, parts)]
                out.append({"cost": cost, "ending": ending, "parts": named})
            kind = pa.struct([("block", pa.int64()), ("state", pa.int32()), ("letters", pa.string())])
            return pa.array(out, pa.struct([("cost", pa.int64()), ("ending", pa.string()), ("parts", pa.list_(kind))]))

        blocks = cut_lineage(blocks.withColumn("ways", ways.asNondeterministic()("codes")))
        tables = blocks.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("block", "ways"))).alias("tables"), F.sum(F.size("codes")).alias("n"))
        solved = cut_lineage(tables.select("key", least.asNondeterministic()("tables", "n").alias("found")))
        #: key, cost, audit
        self.plans = solved.select(
            "key", "found.cost", F.concat(F.array_join(F.col("found.parts.letters"), ""), F.col("found.ending")).alias("audit")
        )

        @F.arrow_udf("array<struct<row:int,role:string>>")
        def entries(codes: pa.Array, states: pa.Array, letters: pa.Array) -> pa.Array:
            out = [repaired_entries(*x) for x in zip(codes.to_pylist(), states.to_pylist(), letters.to_pylist())]
            return pa.array(out, pa.list_(pa.struct([("row", pa.int32()), ("role", pa.string())])))

        parts = solved.select("key", F.explode("found.parts").alias("part")).select("key", "part.*")
        made = blocks.select("key", "block", "codes").join(parts, ["key", "block"]).select("key", "block", entries("codes", "state", "letters").alias("made"))
        each = made.select("key", "block", F.posexplode("made").alias("at", "entry"))
        each = each.select("key", "block", "at", (F.col("block") * BLOCK + F.col("entry.row")).alias("pos"), F.col("entry.role").alias("new_role"))
        # Insertions at the very end follow the last block: their roles go on alternating, and the last is the assistant's.
        tail = solved.filter(F.length("found.ending") > 0)
        ends = tail.select("key", F.length("found.ending").alias("k"), F.posexplode(F.split("found.ending", "")).alias("at", "letter")).filter("letter <> ''")
        ends = ends.select(
            "key", F.lit(1 << 62).alias("block"), "at", F.lit(None).cast("bigint").alias("pos"),
            F.when((F.col("k") - F.col("at")) % 2 == 1, "assistant").otherwise("user").alias("new_role"),
        )
        texts = self.rows.select("key", "pos", "role", "text")
        #: key, block, at (order), role, text
        self.repaired = each.unionByName(ends).join(texts, ["key", "pos"], "left").select(
            "key", "block", "at", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
        )


def hashes(repaired: DataFrame) -> DataFrame:
    """key, sha256: hex digest of a conversation's ``role:text``, newline-joined; reads each conversation as a stream."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            done = []
            for k, role, text in zip(*(batch[c].to_pylist() for c in ("key", "role", "text"))):
                if k != key:
                    if held is not None:
                        done.append({"key": key, "sha256": held.hexdigest()})
                    key, held = k, sha256()
                else:
                    held.update(b"\n")
                held.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_pylist(done)
        if held is not None:
            yield pa.RecordBatch.from_pylist([{"key": key, "sha256": held.hexdigest()}])

    whole = repaired.repartition("key").sortWithinPartitions("key", "block", "at")
    return whole.select("key", "role", "text").mapInArrow(digests, "key string, sha256 string")


def report(turns: DataFrame, costs: Costs | None = None) -> DataFrame:
    """conv_id, turn, role, text as recorded -> after damage and repair: one row per recorded conv_id."""
    done = Repair(damage(turns), costs)
    spans = done.rows.groupBy("key", "turn").agg(
        *[F.sum((F.col("fault") == k).cast("bigint")).alias(name) for k, name in enumerate(_FAULTS) if k], F.sum("illegal").alias("illegal")
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint")
    counts = spans.groupBy("key").agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in (*_FAULTS[1:], "illegal")])
    all_keys = turns.groupBy(key_of(F.col("conv_id")).alias("key")).agg(F.max("conv_id").alias("conv_id"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    found = all_keys.join(counts, "key", "left").join(done.plans, "key", "left").join(hashes(done.repaired), "key", "left")
    return found.select(
        "conv_id", *[zero(c) for c in ("gaps", *_FAULTS[1:], "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
