"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: tags and runs of text, each with the open elements around it. How often a
token occurs on each page of a host is its occurrence vector; tokens with the same vector form an
equivalence class. A class is valid if it is large, occurs on a good share of the host's pages and
holds tags of its own: text that merely recurs (a quoted passage, a copied article) has a vector without tags and
stays content. The class that occurs once on every page is the template's frame; other valid classes are
nested in it, as their tokens' open elements say. What lies between template tokens are slots. On a page whose tokens do
not follow a class's order, that class is not applied.

Slots are content if no element around them says otherwise: menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and comments are told by tag, role and class names. If a page has an ``article`` or
``main`` element with text, content is what lies inside. Runs of text that belong to the template are left out.

Vectors are compared by sums of hashes over pages, so no host's pages ever meet in one place; a
template is bounded by the tokens of a page divided by ``SHARE``. Hosts with fewer than ``PAGES`` different pages
teach no template; their pages are told by elements alone.

Defined cases: a null or empty page has the empty text; a null or odd url is a host of its own name; broken
markup is read as browsers read it (open elements are closed by their parents, an unfinished tag is text, an unfinished
comment runs to the end); equal pages of a host count once; a run of text inside an article is template only if it
stands in articles with different texts; further columns pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tramline.llm.batches import small
from tramline.session import cut_lineage

#: A class is large with so many tokens, occurs on this share of a host's pages; a host teaches with so many pages.
TOKENS, SHARE, PAGES = 3, 0.1, 4
#: Copied pages (host and hash) that are broadcast.
_FEW = 100_000
#: Hosts with more than this share of all pages (so fewer than 1,000: their list may be broadcast) are dealt over so many parts.
HOT, _PARTS = 0.001, 64
#: Paths longer than this are carried as their hash.
_PATH = 2_000

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in "script style textarea title xmp iframe noembed noframes".split()}
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that end an open element of the same group when they start, up to one of the given parents.
_SIBLINGS = [({"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dl"}), ({"tr"}, {"table"}), ({"td", "th"}, {"tr", "table"}), ({"option"}, {"select"})]
_LEAVE_OUT = frozenset(
    "head nav footer aside form script style noscript template svg math iframe object button select textarea input dialog menu audio video canvas search".split()
)
_LEAVE_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog toolbar".split())
_LEAVE_OUT_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer disqus"
    " dropdown footer gdpr login menu modal nav navbar navigation newsletter notice notices notification pagination popup promo promoted promotion related"
    " replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
_HEADER_WORDS = frozenset(["header", "masthead", "topbar"])


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip(" /\n\t") else {}


def _left_out(name: str, attrs: dict[str, str], inside_article: bool) -> bool:
    """True for elements whose text is not content."""
    if name in _LEAVE_OUT or (name == "header" and not inside_article):
        return True
    if not attrs or name in ("html", "body"):
        return False
    if attrs.get("role", "").lower() in _LEAVE_OUT_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    words = {w.lower() for w in _NAME_WORD.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")}
    if name in ("article", "main"):
        return bool(words & {"comment", "comments", "reply", "ad", "advert", "sponsored", "promo", "related"})
    return bool(words & _LEAVE_OUT_WORDS) or (not inside_article and bool(words & _HEADER_WORDS))


def events(page: str) -> Iterator[tuple[str, str, str, bool, bool]]:
    """(kind, path, value, content, inside): kind is tag, end, text; content and inside tell of the elements around it."""
    open_: list[tuple[str, str, bool, bool]] = []  # name, path, content, inside an article
    at, size = 0, len(page)

    def around() -> tuple[str, bool, bool]:
        return open_[-1][1:] if open_ else ("", True, False)

    def close(names: set[str], until: set[str]) -> None:
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] in names:
                del open_[k:]
                return
            if open_[k][0] in until:
                return

    while at < size:
        m = _MARKUP.search(page, at)
        upto = m.start() if m else size
        if upto > at:
            path, content, inside = around()
            yield "text", path, page[at:upto], content, inside
        if not m:
            return
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    yield "end", open_[k][1], name, open_[k][2], open_[k][3]
                    del open_[k:]
                    break
            else:
                yield "end", around()[0], name, *around()[1:]
            continue
        attrs = _attributes(m["attrs"] or m["attrs2"] or "")
        if name in _BLOCK:
            close({"p"}, _BLOCK - {"p"})
        for group, parents in _SIBLINGS:
            if name in group:
                close(group, parents)
        path, content, inside = around()
        first = attrs.get("class", "").split()
        path = f"{path}/{name}" + (f".{first[0]}" if first else "")
        if len(path) > _PATH:  # of deep nesting: the same for the same path, and no longer
            path = f"{_key(path):x}"
        content = content and not _left_out(name, attrs, inside)
        inside = inside or (name in ("article", "main") or attrs.get("role") in ("main", "article")) and content
        yield "tag", path, name, content, inside
        if name in _VOID:
            continue
        if name in _RAW:
            end = _RAW[name].search(page, at)
            stop = end.start() if end else size
            if stop > at:
                yield "text", path, page[at:stop], content and name in ("textarea", "title", "xmp"), inside
            at = stop
        open_.append((name, path, content, inside))


def _key(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _spaced(text: str) -> str:
    return " ".join(html.unescape(text).split())


def tokens(page: str) -> Iterator[tuple[int, bool, str | None]]:
    """Key of each token in order, whether it is a tag, and the words of a run of text inside an article."""
    for kind, path, value, content, inside in events(page):
        if kind != "text":
            yield _key(kind, path, value), True, None
        elif said := _spaced(value):
            yield _key(kind, path, said), False, said if inside and content else None


def _page_tokens(batches):
    """(host, html) -> (host, token, is_tag, n, place, v, w, article): v and w are two hashes of (page, n).

    ``article`` is a hash of the article's text, for runs of text inside it.
    """
    schema = pa.schema([("host", pa.string()), ("token", pa.int64()), ("is_tag", pa.bool_()), ("n", pa.int64()), ("place", pa.float64()), ("v", pa.int64()), ("w", pa.int64()), ("article", pa.int32())])
    for batch in batches:
        for start in range(0, len(batch), 500):
            part = batch.slice(start, 500)
            out: list[tuple] = []
            for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                page = page or ""
                own = str(_key(page))
                seen: dict[int, list] = {}
                words = []
                for k, (token, is_tag, said) in enumerate(tokens(page)):
                    x = seen.setdefault(token, [is_tag, 0, k, said is not None])
                    x[1] += 1
                    if said is not None:
                        words.append(said)
                article = _key(*words) & 0x7FFFFFFF
                for token, (is_tag, n, first, inside) in seen.items():
                    both = _key(own, str(n))
                    out.append((host, token, is_tag, n, float(first), both & 0x7FFFFFFF, both >> 32 & 0x7FFFFFFF, article if inside else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, schema.types, strict=True)], schema=schema)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")), url, F.lit("")))


def templates(pages: DataFrame) -> DataFrame:
    """pages: host, html -> host, template: array of token, class, place in the class's order.

    Sums over pages are made before tokens meet; only tokens of at least ``PAGES`` different pages go on. Only pages that
    occur more than once are brought together by their text.
    """
    pages = pages.select("host", "html", F.xxhash64("html").alias("page"))
    copied = pages.groupBy("host", "page").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("host", "page")
    copied = cut_lineage(copied)
    if copied.count() <= _FEW:  # else their join may shuffle the pages
        copied = F.broadcast(copied)
    alone = pages.join(copied, ["host", "page"], "left_anti").select("host", "html", "page")
    pages = alone.union(pages.join(copied, ["host", "page"], "left_semi").select("host", "html", "page").dropDuplicates(["host", "page"]))
    found = pages.select("host", "html").mapInArrow(_page_tokens, "host string, token bigint, is_tag boolean, n bigint, place double, v bigint, w bigint, article int")
    vectors = found.groupBy("host", "token", "is_tag").agg(
        F.count(F.lit(1)).alias("support"), F.sum("n").alias("n"), F.sum("place").alias("place"), F.sum("v").alias("v"), F.sum("w").alias("w"),
        F.min("article").alias("low"), F.max("article").alias("high"),
    )
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= PAGES)
    vectors = vectors.filter(F.col("low").isNull() | (F.col("low") < F.col("high")))
    frequent = vectors.filter(F.col("support") >= PAGES).join(hosts, "host").filter(F.col("support") >= SHARE * F.col("pages"))
    vector = ["host", "support", "n", "v", "w"]
    member = F.struct((F.col("place") / F.col("support")).alias("place"), "token")
    classes = frequent.groupBy(*vector).agg(F.collect_list(member).alias("members"), F.max("is_tag").alias("tags"))
    classes = classes.filter(F.col("tags") & (F.size("members") >= TOKENS)).withColumn("class", F.xxhash64(*vector[1:]))
    ordered = classes.select("host", "class", F.posexplode(F.array_sort("members")).alias("at", "member"))
    row = F.struct(F.col("member.token").alias("token"), F.col("class"), F.col("at"))
    return ordered.groupBy("host").agg(F.collect_list(row).alias("template"))


def blocks(page: str, template: dict[int, tuple[int, int]]) -> list[str]:
    """The content of a page, block by block. ``template``: class and place in its order, by token."""
    out: list[tuple[str, bool]] = []
    parts: list[str] = []
    within = False
    seen = list(events(page))
    keyed: list[int | None] = [None] * len(seen)
    if template:
        order: dict[int, int] = {}
        broken: set[int] = set()
        for k, (kind, path, value, _, _) in enumerate(seen):
            said = value if kind != "text" else _spaced(value)
            if said and (place := template.get(_key(kind, path, said))):
                keyed[k] = place[0]
                if place[1] < order.get(place[0], -1):
                    broken.add(place[0])
                order[place[0]] = place[1]
        keyed = [None if x in broken else x for x in keyed]

    def flush() -> None:
        text = _spaced("".join(parts))
        if text:
            out.append((text, within))
        parts.clear()

    for (kind, _, value, content, inside), in_template in zip(seen, keyed, strict=True):
        if kind == "text":
            if content and in_template is None:
                if inside != within:
                    flush()
                    within = inside
                parts.append(value)
        elif value in _BLOCK:
            flush()
        elif value == "br":
            parts.append("\n")
    flush()
    best = [text for text, inside in out if inside]
    return best or [text for text, _ in out]


def extract(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """All columns and ``text``: the main text, blocks joined by two line ends."""
    small(pages.sparkSession)
    rest = pages.select(*[c for c in pages.columns if c != "text"], host(F.col(url)).alias("page__host"))
    found = templates(rest.select(F.col("page__host").alias("host"), F.col(page).alias("html"))).withColumnRenamed("host", "page__of")

    @F.arrow_udf("string")
    def text(htmls: pa.Array, given: pa.Array) -> pa.Array:
        known: dict[str, dict] = {}
        out = []
        for h, t in zip(htmls, given, strict=True):
            rows = t.as_py() or []
            key = str(hash(tuple((r["token"], r["class"]) for r in rows)))
            if key not in known:
                known[key] = {r["token"]: (r["class"], r["at"]) for r in rows}
            out.append("\n\n".join(blocks(h.as_py() or "", known[key])))
        return pa.array(out, pa.string())

    # Pages of a hot host are dealt over parts, and its template is repeated for each part.
    per_host = rest.groupBy("page__host").agg(F.count(F.lit(1)).alias("n"))
    hot = per_host.filter(F.col("n") > HOT * per_host.agg(F.sum("n")).scalar()).select(F.col("page__host").alias("page__hot"))
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in rest.schema if isinstance(f.dataType, AtomicType)])
    dealt = rest.join(F.broadcast(hot), F.col("page__host") == F.col("page__hot"), "left").withColumn(
        "page__part", F.when(F.col("page__hot").isNotNull(), F.pmod(whole, F.lit(_PARTS)).cast("int")).otherwise(0)
    )
    parts = F.when(F.col("page__hot").isNotNull(), F.sequence(F.lit(0), F.lit(_PARTS - 1))).otherwise(F.array(F.lit(0)))
    given = found.join(F.broadcast(hot), F.col("page__of") == F.col("page__hot"), "left").select("page__of", "template", F.explode(parts).alias("page__at"))
    joined = dealt.join(given, (F.col("page__host") == F.col("page__of")) & (F.col("page__part") == F.col("page__at")), "left")
    return joined.select(*[c for c in rest.columns if c != "page__host"], text(F.col(page), F.col("template")).alias("text"))
