"""Spelling variants: words that differ by one code point, found through pairs of trie nodes.

**Method.** All words are sorted; the nodes of their trie are numbered: the word at which a node first appears owns it, and its number
is the letters of all words before plus its depth. The same is done for the reversed words. So a prefix is one integer and
a suffix is one integer. A word of length L leaves out each position i in turn, which gives the integer pair (node of the letters
before i, node of the letters after i): two words share such a pair just if one letter is replaced. Cut (with nothing left out)
at each of its L + 1 gaps, a word meets a longer word that leaves a letter out there: one letter is inserted or deleted. A letter
within a run of equal letters could be left out at several places with the same result; only the first counts for inserting, so every
pair of near words meets in exactly one integer pair. No strings are compared and nothing is missed or found falsely.

**Size of a group.** The words sharing an integer pair differ in the one letter at that place, and at most one has none there, so a group
has at most one member more than the alphabet has letters (91 by that pattern), whatever the corpus. Each member takes its
count and best partner from its group; no pair is emitted.

**Scale.** Occurrences are summed before they are shuffled. Numbering takes two sorts; the driver gets the letter count, the
first and the last word of each partition. Following forms doubles its reach in every round: forms
grow at least fivefold in n, so the rounds are few.

**Defined results.** Null and empty texts have no words; texts are read whole. A null id counts as the text ``null`` in the damage. Repeated
rows count as often as they occur. Of equally frequent near words the smallest in code-point order is the form. Empty tables give
no rows. Other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.session import cut_lineage

#: What lies between words: all but A-Z, a-z and U+00C0 to U+00FF.
BETWEEN = r"[^A-Za-zÀ-ÿ]+"


def lowered(word: Column) -> Column:
    """A-Z as a-z; all other letters stay."""
    return F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def damaged(doc_id: Column, word: Column, every: int = 199) -> Column:
    """The word, or without one letter, if ``every`` divides the crc32 of ``<doc_id>:<word>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % every == 0, F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))).otherwise(word)


def words(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5) -> DataFrame:
    """docs: doc_id, text -> word, n: distinct words of at least ``shortest`` letters and ``least`` occurrences."""
    runs = docs.select("doc_id", F.explode(F.split("text", BETWEEN)).alias("run"))
    found = runs.filter("run <> ''").select("doc_id", lowered(F.col("run")).alias("run")).select(damaged(F.col("doc_id"), F.col("run"), every).alias("word"))
    return found.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:  # a[:low] is shared
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _path(path: list[int], last: str, word: str, letters: int) -> list[int]:
    """Node numbers of ``word`` by depth, from those of the word before it and the letters of all words before."""
    keep = _shared(last, word)
    return path[: keep + 1] + list(range(letters + keep + 1, letters + len(word) + 1))


def numbered(sorted_words: DataFrame, word: str, into: str) -> DataFrame:
    """All columns, ``row`` (place among all words) and ``into``: node numbers of the word's prefixes, from the empty one on.

    ``sorted_words`` is a checkpointed table of distinct words in order, within and across partitions.
    """
    tagged = sorted_words.withColumn("part", F.spark_partition_id())

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, letters, first, last, path = -1, 0, 0, "", "", [0]
        for batch in batches:
            for text in batch[word].to_pylist():
                if not rows:
                    part, first = batch["part"][0].as_py(), text
                path = _path(path, last, text, letters)
                rows, letters, last = rows + 1, letters + len(text), text
        if rows:
            yield pa.RecordBatch.from_pylist([{"part": part, "rows": rows, "letters": letters, "first": first, "last": last, "path": path}])

    schema = "part long, rows long, letters long, first string, last string, path array<long>"
    start: dict[int, tuple[int, int, str, list[int]]] = {}
    rows, letters, last, path = 0, 0, "", [0]
    for e in sorted(tagged.select(word, "part").mapInArrow(ends, schema).collect()):
        keep = _shared(last, e["first"])
        start[e["part"]] = (rows, letters, e["first"][:keep], path[: keep + 1])
        head = _path(path, last, e["first"], letters)
        same = _shared(e["first"], e["last"])
        path = head[: same + 1] + [letters + k for k in e["path"][same + 1 :]]
        rows, letters, last = rows + e["rows"], letters + e["letters"], e["last"]

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            row, letters, last, path = state or start[batch["part"][0].as_py()]
            paths = []
            for text in batch[word].to_pylist():
                path = _path(path, last, text, letters)
                paths.append(path)
                letters, last = letters + len(text), text
            state = (row + len(paths), letters, last, path)
            columns = [batch[c] for c in batch.schema.names if c != "part"]
            numbers = pa.array(range(row, row + len(paths)), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, numbers, pa.array(paths, pa.list_(pa.int64()))], names=names)

    names = [*sorted_words.columns, "row", into]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_words.schema.fields)
    return tagged.mapInArrow(nodes, f"{kept}, row long, `{into}` array<long>")


def pairs(trie: DataFrame) -> DataFrame:
    """word, row, n, heads, tails -> every integer pair (head, tail) a word has, and how: 0 cut, 1 left out, 2 left out first of its run."""
    letters = F.split("word", "")
    how = F.zip_with(letters, F.concat(F.array(F.lit("")), letters), lambda x, before: F.when(x == before, 1).otherwise(2))
    size, back = F.length("word"), F.reverse("tails")
    place = lambda head, tail: F.struct(head.alias("head"), tail.alias("tail"))
    full = lambda at, how: F.struct(at["head"].alias("head"), at["tail"].alias("tail"), how.alias("how"))
    out = F.zip_with(F.zip_with(F.slice("heads", 1, size), F.slice(back, 2, size), place), F.slice(how, 1, size), full)
    cut = F.transform(F.zip_with("heads", back, place), lambda at: full(at, F.lit(0)))
    return trie.select("row", "n", F.explode(F.concat(out, cut)).alias("pair")).select("pair.*", "row", "n")


def neighbours(held: DataFrame) -> DataFrame:
    """pairs -> row, n_near, best (struct of n and negative row of the near word of largest n, smallest row)."""
    groups = held.groupBy("head", "tail").agg(F.collect_list(F.struct("how", "row", "n")).alias("m")).filter(F.size("m") > 1)
    near = lambda x: lambda y: (x["row"] != y["row"]) & (((x["how"] > 0) & (y["how"] > 0)) | (x["how"] + y["how"] == 2))
    met = F.transform("m", lambda x: F.struct(x["row"].alias("row"), F.filter("m", near(x)).alias("near")))
    best = F.array_max(F.transform(F.col("met.near"), lambda y: F.struct(y["n"].alias("n"), (-y["row"]).alias("back"))))
    each = groups.select(F.explode(met).alias("met")).filter(F.size("met.near") > 0)
    each = each.select(F.col("met.row").alias("row"), F.size("met.near").cast("bigint").alias("n_near"), best.alias("best"))
    return each.groupBy("row").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """row, to (no cycles) -> row, root: the end of the chain from each row."""
    done = cut_lineage(links.select("row", F.col("to").alias("root")))
    while True:
        on = done.select(F.col("row").alias("root"), F.col("root").alias("further"))
        step = cut_lineage(done.join(on, "root", "left").select("row", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        done = step.select("row", "root")
        if not step.filter("moved").take(1):
            return done


def variants(found: DataFrame, ratio: int = 5) -> DataFrame:
    """found: word, n (distinct words) -> word, n, form, root, n_near, form_n.

    ``form`` is the near word of largest n, if that is at least ``ratio`` times the word's n; ``root`` is where following forms
    ends. Null and empty words are left out.
    """
    ordered = cut_lineage(found.filter("word <> ''").select("word", "n").orderBy("word"))
    heads = cut_lineage(numbered(ordered, "word", "heads"))
    back = cut_lineage(heads.select(F.col("row").alias("id"), F.reverse("word").alias("drow")).orderBy("drow"))
    tails = numbered(back, "drow", "tails").select(F.col("id").alias("row"), "tails")
    near = neighbours(pairs(heads.join(tails, "row")))
    plain = heads.select("row", "word", "n")
    formed = F.col("best.n") >= F.col("n") * ratio
    known = cut_lineage(plain.join(near, "row", "left").select(
        "row", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(formed, -F.col("best.back")).alias("to"), F.when(formed, F.col("best.n")).alias("form_n"),
    ))
    linked = known.filter(F.col("to").isNotNull()).select("row", "to")
    name = lambda key, into: plain.select(F.col("row").alias(key), F.col("word").alias(into))
    ends = linked.join(roots(linked), "row").join(name("to", "form"), "to").join(name("root", "root_word"), "root").select("row", "form", "root_word")
    return known.join(ends, "row", "left").select(
        "word", "n", "form", F.coalesce("root_word", "word").alias("root"), "n_near", "form_n"
    )
