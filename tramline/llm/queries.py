"""The operators applied to the test tables; ``SQL`` has what DuckDB can say of them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import ann, byte_pairs, chat, html_text, language, mixing, neardup, pieces, pigeonhole, repair, secrets, spelling, warc
from tramline.session import table


#: Public vocabulary files; see the README of that folder.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def op1_sentencepiece(spark: SparkSession, folder: str, model: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    """Every document's ids, and whether decoding them gives its text back."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    read = pieces.round_trips(docs, model)
    return read.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_ids"), "round_trip")


def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts look like control strings."""
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.digests(chat.examples(turns.unionByName(planted)))


def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, repeating."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Links of cosine 0.9 and more among all vectors, and their components."""
    return pigeonhole.linked(table(spark, folder, "embeddings"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those whose id's crc32 mod 4 is not 2."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language.train(docs.filter(~held_out))
    return language.identify(docs.drop("lang"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits")


def page_records(pages: DataFrame) -> DataFrame:
    """Every page as a full response, and as a not-modified answer a day later.

    One in ten answers has another entity tag, one in ten comes before its response.
    """
    k = F.col("page_id")
    base = F.timestamp_seconds(k * 60)
    text = F.coalesce("html", F.lit(""))
    tag = F.md5(text)
    response = pages.select(
        (2 * k).alias("record_id"), "url", F.lit(False).alias("is_revisit"), base.alias("date"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("ETag"), F.concat(F.lit("W/"), tag), F.lit("Content-Length"), F.length(text).cast("string"), F.lit("Age"), F.lit("0")).alias("headers"),
        "html",
    )
    late = F.when(k % 10 == 7, F.timestamp_seconds(k * 60 - 86_400_000)).otherwise(F.timestamp_seconds(k * 60 + 30))
    revisit = pages.select(
        (2 * k + 1).alias("record_id"), "url", F.lit(True).alias("is_revisit"), late.alias("date"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("etag"), F.when(k % 10 == 3, "other").otherwise(tag), F.lit("content-length"), F.lit("0"), F.lit("age"), (k % 7).cast("string")).alias("headers"),
        F.lit(None).cast("string").alias("html"),
    )
    return response.union(revisit).withColumnRenamed("html", "payload")


def op7_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's not-modified answer resolved to a full response."""
    found = warc.resolve(page_records(table(spark, folder, "pages")))
    header = lambda k: F.col("headers")[k].alias(k.replace("-", "_"))
    return found.select("record_id", "resolved_id", "status", header("etag"), header("content-length"), header("age"), F.length("payload").cast("bigint").alias("n_chars"))


def op8_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.learn(docs)).select("doc_id", "found")
    base = secrets.base_only(F.col("found"))
    count = {k: secrets.count_of(F.col("found"), k).alias(f"n_{k}") for k in [*secrets.KINDS, secrets.FORMAT]}
    return found.select(
        "doc_id", *[count[k] for k in secrets.KINDS], F.sha2(secrets.digest(base).cast("binary"), 256).alias("base_sha256"),
        secrets.digest(F.col("found")).alias("spans"), count[secrets.FORMAT],
    )


def op9_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document; the one that gives the class its id is kept."""
    found = neardup.classes(table(spark, folder, "documents").select("doc_id", "text"), either=True)
    return found.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = html_text.extract(table(spark, folder, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's byte-level BPE ids and what they decode to, as digests."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = byte_pairs.digests(docs, ranks, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, some of them damaged, with their commoner spellings."""
    found = spelling.words(table(spark, folder, "documents"))
    return spelling.variants(found).select("word", "form", "root", "n", "n_near", "form_n")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of all conversations after damage, their cheapest repair and a hash of the result."""
    return repair.report(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_source_mixing": op4_source_mixing,
    "op5_embedding_neardup": op5_embedding_neardup,
    "op6_language_id": op6_language_id,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_secret_scans": op8_secret_scans,
    "op9_minhash_neardup": op9_minhash_neardup,
    "op10_html_extraction": op10_html_extraction,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}

_TURNS = """turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
numbered AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(27 + length(role) + length(text) + length(regexp_replace(role || text, '[^<\\[\\\\]', '', 'g'))) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))"""

#: crc32 of a list of bytes ``{0}``, for DuckDB.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, {0}), lambda c, b:
  list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""
#: The UTF-8 bytes of text ``{0}`` with code points below U+0800.
_BYTES = """flatten(list_transform(string_split({0}, ''), lambda a:
  CASE WHEN unicode(a) < 128 THEN [unicode(a)::BIGINT] ELSE [192 + (unicode(a)::BIGINT >> 6), 128 + (unicode(a)::BIGINT & 63)] END))"""

SQL: dict[str, str] = {
    "op13_conversation_repair": f"""WITH RECURSIVE told AS (
  SELECT conv_id, coalesce('=' || conv_id, '-') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format(_BYTES.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"))} % 20 AS how FROM conversations),
after AS (
  SELECT key, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN how = 1 THEN '' WHEN how = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy FROM told WHERE how <> 0),
placed AS (
  SELECT *, row_number() OVER w AS pos, row_number() OVER (PARTITION BY key, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    substr(role, 1, 1) AS c, lag(substr(role, 1, 1)) OVER w AS before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
  FROM after WINDOW w AS (PARTITION BY key ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    (pos > 1 AND before || c NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM placed),
added(a, b, cost, letters, out) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 5, 'I', chr(10) || 'user:'), (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 2, 5, 'I', chr(10) || 'user:'),
  (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 3, 5, 'I', chr(10) || 'assistant:'), (3, 2, 5, 'I', chr(10) || 'user:')),
edits(a, b, cost, letter, c, role) AS (VALUES (0, 0, 2, 'D', NULL, NULL), (1, 1, 2, 'D', NULL, NULL), (2, 2, 2, 'D', NULL, NULL), (3, 3, 2, 'D', NULL, NULL),
  (0, 1, 0, 'K', 's', NULL), (0, 2, 0, 'K', 'u', NULL), (1, 2, 0, 'K', 'u', NULL), (3, 2, 0, 'K', 'u', NULL), (2, 3, 0, 'K', 'a', NULL),
  (0, 2, 1, 'R', NULL, 'user'), (1, 2, 1, 'R', NULL, 'user'), (3, 2, 1, 'R', NULL, 'user'), (2, 3, 1, 'R', NULL, 'assistant')),
walk AS (
  SELECT key, 0::BIGINT AS pos, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'out': ''}} AS best FROM (SELECT DISTINCT key FROM judged)
  UNION ALL
  SELECT w.key, j.pos, e.b, min({{'cost': (best.cost + i.cost + e.cost + CASE WHEN j.fault = 'truncated' AND letter <> 'D' THEN 5 ELSE 0 END)::BIGINT,
    'audit': best.audit || i.letters || letter,
    'out': best.out || i.out || CASE WHEN letter = 'D' THEN '' ELSE chr(10) || coalesce(e.role, j.role) || ':' || j.text END}})
  FROM walk w JOIN judged j ON j.key = w.key AND j.pos = w.pos + 1 JOIN added i ON i.a = w.state JOIN edits e ON e.a = i.b
  WHERE (letter = 'D' OR j.fault NOT IN ('blank', 'duplicate')) AND (e.c IS NULL OR e.c = j.c)
  GROUP BY w.key, j.pos, e.b),
counts AS (
  SELECT key, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    sum(illegal)::BIGINT AS illegal FROM judged GROUP BY key),
ended AS (
  SELECT w.key, min({{'cost': (best.cost + i.cost)::BIGINT, 'audit': best.audit || i.letters, 'out': best.out || i.out}}) AS best
  FROM walk w JOIN counts USING (key) JOIN added i ON i.a = w.state WHERE w.pos = n AND i.b IN (0, 3) GROUP BY w.key)
SELECT any_value(t.conv_id) AS conv_id, coalesce(any_value(gaps), 0) AS gaps, coalesce(any_value(blank), 0) AS blank, coalesce(any_value(duplicate), 0) AS duplicate,
  coalesce(any_value(truncated), 0) AS truncated, coalesce(any_value(illegal), 0) AS illegal, coalesce(any_value(best.cost), 0) AS cost,
  coalesce(any_value(best.audit), '') AS audit, sha256(coalesce(substr(any_value(best.out), 2), '')) AS repaired_sha256
FROM told t LEFT JOIN counts USING (key) LEFT JOIN ended USING (key) GROUP BY key""",
    "op12_spelling_variants": f"""WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT *, {_CRC.format(_BYTES.format("coalesce(doc_id::VARCHAR, 'null') || ':' || run"))} AS h FROM counted),
damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
w AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
held AS (
  SELECT word, n, substr(word, 1, i::INT) AS head, substr(word, i::INT + 2) AS tail FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM held a JOIN held b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM held a JOIN w b ON a.head || a.tail = b.word
  UNION SELECT b.word, a.word, a.n FROM held a JOIN w b ON a.head || a.tail = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS form_n FROM near GROUP BY word),
known AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 5 * w.n THEN other END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at FROM known
  UNION ALL SELECT walk.word, known.form FROM walk JOIN known ON known.word = walk.at WHERE known.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN known ON known.word = walk.at WHERE known.form IS NULL)
SELECT known.word, form, root, n, n_near, form_n FROM known JOIN ends USING (word)""",
    "op2_chat_formatting": f"""WITH {_TURNS}
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars,
  (count(*) FILTER (role = 'assistant' OR k = n))::BIGINT AS n_examples
FROM numbered GROUP BY conv_id""",
    "op7_warc_revisits": r"""WITH parts AS (
  SELECT page_id AS k, coalesce(html, '') AS html, regexp_replace(url, '#.*$', '') AS plain FROM pages),
canon AS (
  SELECT k, html, regexp_replace(regexp_replace(lower(regexp_extract(plain, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)), '^(http://.*):80$', '\1'), '^(https://.*):443$', '\1') AS origin,
    regexp_replace(regexp_replace(plain, '\?.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(plain, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|gclid|fbclid)='))) AS params
  FROM parts),
r AS (
  SELECT k, html, md5(html) AS tag, origin || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS place FROM canon),
v AS (SELECT *, CASE WHEN k % 10 = 7 THEN k * 60 - 86400000 ELSE k * 60 + 30 END AS at, CASE WHEN k % 10 = 3 THEN 'other' ELSE tag END AS own FROM r),
f AS (
  SELECT v.k, v.own, max(x.k) AS hit FROM v LEFT JOIN r x ON x.place = v.place AND x.k * 60 < v.at GROUP BY v.k, v.own),
g AS (SELECT f.*, x.tag, x.html, CASE WHEN hit IS NULL THEN 'missing' WHEN x.tag = own THEN 'resolved' ELSE 'contradicted' END AS status FROM f LEFT JOIN r x ON x.k = f.hit)
SELECT 2 * k + 1 AS record_id, CASE WHEN status = 'resolved' THEN 2 * hit END AS resolved_id, status, own AS etag,
  CASE WHEN status = 'resolved' THEN length(html)::VARCHAR ELSE '0' END AS content_length, (k % 7)::VARCHAR AS age,
  CASE WHEN status = 'resolved' THEN length(html) END AS n_chars FROM g""",
    "op4_source_mixing": r"""WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')), 1, 15) AS place FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM sized GROUP BY source),
limits AS (SELECT *, 3.0::DOUBLE * source_size / weight AS cap, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights FROM sources),
levels AS (
  SELECT *, (total - 3.0::DOUBLE * coalesce(sum(source_size) OVER w, 0)) / (weights - coalesce(sum(weight) OVER w, 0)) AS level
  FROM limits WINDOW w AS (ORDER BY cap, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
leveled AS (SELECT *, max(level) FILTER (level <= cap) OVER () AS found FROM levels),
goals AS (
  SELECT source, source_size, CASE WHEN found IS NULL OR cap < found THEN 3.0::DOUBLE * source_size ELSE found * weight END AS target FROM leveled),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goals),
places AS (
  SELECT s.source, s.place, sum(s.size) AS size, p.target - p.whole * p.source_size AS budget
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source WHERE s.size > 0 GROUP BY s.source, s.place, p.target, p.whole, p.source_size),
running AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place) AS upto FROM places),
cuts AS (
  SELECT source, min(place) AS place, arg_min(2 * (budget - (upto - size)) > size, place) AS more
  FROM running WHERE budget > 0 AND upto > budget GROUP BY source)
SELECT s.doc_id, s.size, p.source_size, p.target,
  (p.whole + (c.place IS NOT NULL AND (s.place < c.place OR (s.place = c.place AND c.more)))::INT)::BIGINT * s.size AS taken,
  (p.whole + (c.place IS NOT NULL AND (s.place < c.place OR (s.place = c.place AND c.more)))::INT)::BIGINT AS copies
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source""",
}
