"""Main text of web pages by equivalence-class template deduction.

Pages of one host share a template. A page is cut into tokens: its elements (each by its path of
tags and classes) and its text blocks (each by path and text). Tokens of a host that occur
equally often on each of its pages have one occurrence vector and form an equivalence class. A
class is valid if it is frequent (on at least `support` of the host's pages and on at least
`min_pages` of them) and holds an element, so that its texts are nested in template markup. Valid
classes nest: the section (div, article, body and the like) that holds a text of a valid class is
fixed if all its texts on the host are of valid classes, and has a slot if any is not. The texts of
fixed sections (share lines, notices, fixed headings) are boilerplate. A text that recurs in a section
with a slot stays, as does a list, table or quotation that recurs in one: what versions of an article
share is part of it. The slots inside the page's content element, without elements whose role is not
content, are the main text. A template frames an <article> or <main> and never makes up most of it: on a
page where it would take half of such an element's text or more, nothing goes.

Pages are counted as distinct pages of a host: those with the same content texts are copies, of
which one votes, so that a repeated article is no template. The template goes from all rows.

A vector is never built: its signature is a count, a sum and an exclusive-or of hashes over the
pages, which Spark adds up per map task, so a host with a third of all pages ships one row per
token and task. Pages are parsed once and landed as blocks."""

from __future__ import annotations

import html
import re
from array import array

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import land, ship_package, slices

# Elements by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
            "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu "
            "nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
NOT_CONTENT = set("aside button datalist dialog footer form head header input label link menu meta nav "
                  "object option select title".split())
NOT_CONTENT_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar "
                        "navigation search toolbar".split())
NOT_CONTENT_NAMES = set(
    "ad ads adbox advert adverts advertisement advertising banner banners breadcrumb breadcrumbs "
    "comment comments consent cookie cookies disqus footer gdpr login masthead menu menus modal nav "
    "navbar navigation newsletter notice notices notification pagination pager popup promo promoted "
    "related replies respond share sharing sidebar signup skyscraper social sponsor sponsored "
    "subscribe subscription toolbar topbar widget widgets".split())
# names that state what a page has or lacks, by their first or last word: no-sidebar, comments-open
STATES_FIRST, STATES_LAST = set("has no with without".split()), set("open closed enabled disabled".split())
# words that say what a part is made of; beside one of these, and not beside a subject, a name above
# names a part of the page also within an article: share-links, but not share-price
PART_WORDS = set("area areas bar block blocks body box button buttons col column container content entry form group "
                 "head header heading icon icons inner item items link links list listing module outer panel post posts "
                 "article articles row section stories text thread title wrap wrapper".split())
NOT_CONTENT_WHOLE = set("header site-header page-header site_header page_header top-header bottom".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|math|canvas|object|audio|video|xmp|noembed|noframes"

_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
_NAME = re.compile(r"[\s_-]+")
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_KEEPS_OPEN = set("article aside blockquote body button div dl footer form header html main nav ol section "
                  "table tbody thead tfoot ul".split())

SECTION = set("article body div html main section".split())  # elements that hold a template's texts

OWN = ["host", "page_no", "copy", "variant", "inside", "blocks", "tokens"]  # with an underscore beside the pages' own columns
PARSED = ("_host string, _page_no bigint, _copy bigint, _variant bigint, _inside boolean, "
          "_blocks array<struct<token:bigint,text:string>>, _tokens array<struct<token:bigint,n:int,section:bigint>>")


def _signed(path: str | bytes) -> int:
    h = xxhash.xxh64_intdigest(path.encode("utf-8", "surrogatepass") if isinstance(path, str) else path)
    return h - (1 << 64) if h >> 63 else h


def _named(value: str, inside: bool) -> bool:
    """Whether a class or id value has a name that is not content: by any of its words, or, `inside` an
    article or main, by a name whose words all name parts of a page."""
    if NOT_CONTENT_NAMES.isdisjoint(_NAME.split(value)):
        return not NOT_CONTENT_WHOLE.isdisjoint(value.split())
    for name in value.split():
        words = [w for w in _NAME.split(name) if w]
        states = len(words) > 1 and (words[0] in STATES_FIRST or words[-1] in STATES_LAST)
        part = not inside or all(w in NOT_CONTENT_NAMES or w in PART_WORDS for w in words)
        if name in NOT_CONTENT_WHOLE or part and not states and not NOT_CONTENT_NAMES.isdisjoint(words):
            return True
    return False


def _roles(tag: str, attrs: str, inside: bool) -> tuple[str, int]:
    """The element's name in paths, and whether it is not content: 2 by its role, 1 by its class or
    id alone, else 0."""
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return tag, 2 * (tag in NOT_CONTENT)
    out, named, name = tag in NOT_CONTENT, False, tag
    for kind, a, b, c in _ATTR.findall(attrs):
        kind, value = kind.lower(), (a or b or c).strip().lower()
        if kind == "role":
            out |= value in NOT_CONTENT_ROLES
        elif kind == "hidden" or kind == "aria-hidden":
            out |= kind == "hidden" or value == "true"
        else:
            named |= tag not in ("body", "html") and _named(value, inside)
            if kind == "class":
                name = f"{tag}.{value}"
    return name, 2 if out else int(named)


def parse(page: str) -> tuple[list[tuple[int, str]], dict[int, int], dict[int, int], bool]:
    """Content blocks (token, text) in page order, all tokens with their counts, the section that holds
    each token that is a text, and whether the blocks are of an <article> or <main>. The content element is every <article> that is no part of something else, else
    every <main>, else the page.

    Where an <article> or <main> without a name has content, one with a name (reader comments, teasers,
    sidebar items) adds nothing. Where none has, a name alone drops no <article> or <main>: one that is
    named, or held by a named element, but not both, is content beside the rest, unless it is a part of
    an <article> (or a <main> of a <main>). If nothing else is content, what names alone drop is."""
    # tag, path, not content (1 by name, 2 by role), inside (1 main, 2 article, 10 more where named)
    stack = [("", "", 0, 0)]
    blocks: list[tuple[int, str, int]] = []
    counts: dict[int, int] = {}
    sections: dict[int, int] = {}
    parts: list[str] = []
    spare: list[tuple[int, str, int]] = []  # what names alone drop
    spare_parts: list[str] = []

    def text_token(text):
        token = _signed(f"{stack[-1][1]}\0{text}")
        if token not in sections:
            sections[token] = _signed(next((s[1] for s in reversed(stack) if s[0] in SECTION), ""))
        return token

    def flush():
        if spare_parts:
            text = " ".join(html.unescape("".join(spare_parts)).split())
            spare_parts.clear()
            if text:
                spare.append((text_token(text), text, 0))
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                token = text_token(text)
                counts[token] = counts.get(token, 0) + 1
                blocks.append((token, text, stack[-1][3]))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and stack[-1][2] < 2:
            (spare_parts if stack[-1][2] else parts).append(page[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        block = tag in BLOCK
        if block:
            flush()
        elif tag == "br":
            parts.append(" ")
            spare_parts.append(" ")
        if m["end"] or m["end2"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    if not block and any(s[0] in _KEEPS_OPEN for s in stack[k:]):
                        break  # a stray end of an inline element from outside this block
                    if any(s[0] in BLOCK for s in stack[k:]):
                        flush()
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            continue
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in _CLOSES.get(tag, ()):
                del stack[k:]
                break
            if stack[k][0] in _KEEPS_OPEN:
                break
        _, path, outside, inside = stack[-1]
        name, out = _roles(tag, m["attrs"] or m["attrs2"] or "", inside % 10 > 0)
        path = f"{path}/{name}"
        token = _signed(path)
        counts[token] = counts.get(token, 0) + 1
        level = 2 if tag == "article" else 1 if tag == "main" else 0
        if level > inside % 10:
            if outside + out == 1:  # by one name alone
                outside, out, inside = 0, 0, 10
            inside = inside // 10 * 10 + level
        stack.append((tag, path, max(outside, out), inside))
    if at < len(page) and stack[-1][2] < 2:
        (spare_parts if stack[-1][2] else parts).append(page[at:])
    flush()
    if not blocks:
        for token, _, _ in spare:
            counts[token] = counts.get(token, 0) + 1
        blocks = spare
    best = {kind: max((b[2] for b in blocks if b[2] // 10 == kind), default=0) for kind in (0, 1)}
    kinds = (0,) if best[0] else (0, 1)
    return [(t, text) for t, text, inside in blocks
            if inside // 10 in kinds and inside == best[inside // 10]], counts, sections, max(best[k] for k in kinds) % 10 > 0


def _parsed(pages: DataFrame, keep: list[str], url: str, page: str) -> DataFrame:
    rows = pages.select(*keep, F.coalesce(F.translate(F.regexp_extract(
        F.coalesce(F.col(url), F.lit("")), r"://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz"), F.lit("")).alias("_host"), F.col(page).cast("string").alias("_html"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(keep)])
    block_type = pa.list_(pa.struct([("token", pa.int64()), ("text", pa.string())]))
    token_type = pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int32()), ("section", pa.int64())]))

    def work(batches):
        row = TaskContext.get().partitionId() << 33
        for b in slices(batches, 500):
            blocks, tokens, copies, variants, insides = [], [], [], [], []
            for text in b["_html"].to_pylist():
                found, counts, sections, inside = parse(text or "")
                insides.append(inside)
                blocks.append([{"token": t, "text": x} for t, x in found])
                mine = {t for t, _ in found}
                tokens.append([{"token": t, "n": n, "section": sections.get(t)}
                               for t, n in counts.items() if t not in sections or t in mine])
                # equal for equal content texts, and for equal tokens
                copies.append(_signed("\0".join([x for _, x in found])))
                variants.append(_signed(array("q", [v for t in tokens[-1] for v in (t["token"], t["n"])]).tobytes()))
            yield pa.record_batch([*b.columns[:len(keep)], b["_host"],
                                    pa.array(range(row, row + b.num_rows), pa.int64()),
                                    pa.array(copies, pa.int64()), pa.array(variants, pa.int64()),
                                    pa.array(insides, pa.bool_()),
                                    pa.array(blocks, block_type), pa.array(tokens, token_type)],
                                   [*keep, *("_" + c for c in OWN)])
            row += b.num_rows

    return rows.mapInArrow(work, f"{kept}, {PARSED}" if kept else PARSED)


def templates(parsed: DataFrame, support: float, min_pages: int) -> DataFrame:
    """Per host the texts of its fixed sections: host, template (array of tokens). Tokens on fewer
    than `min_pages` distinct pages have too short vectors and are no template."""
    page = F.xxhash64("page_no", "n")
    # one page of each group of copies votes, whatever the order of rows. Landed, so that the join
    # takes it by its known size; the numbers are unique, so no host and no page is hot there
    voters = land(parsed.groupBy("host", "copy").agg(F.min(F.struct("variant", "page_no")).alias("v"))
                  .select("host", F.col("v.page_no").alias("page_no")), "voters")
    seen = (parsed.join(voters.select("page_no"), "page_no", "left_semi")
            .select("host", "page_no", F.explode("tokens").alias("t"))
            .select("host", "page_no", "t.token", "t.n", "t.section"))
    vectors = seen.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("occurrences"),
        F.bit_xor(page).alias("signature"), F.max("section").alias("section"))
    # landed, so that the join takes it by its known size and does not deal the tokens by host
    sizes = land(voters.groupBy("host").agg(F.count(F.lit(1)).alias("of")), "host-sizes")
    frequent = (F.col("pages") >= min_pages) & (F.col("pages") >= support * F.col("of"))
    vectors = land(vectors.join(sizes, "host").select(
        "host", "token", "section", F.when(frequent, F.struct("pages", "occurrences", "signature")).alias("vector")),
        "vectors")
    classes = vectors.where("vector is not null").groupBy("host", "vector").agg(
        F.collect_list(F.when(F.col("section").isNotNull(), F.struct("token", "section"))).alias("texts"),
        F.bool_or(F.col("section").isNull()).alias("valid"))
    texts = land(classes.select("host", "valid", F.inline("texts")), "class-texts")
    slots = (vectors.where("vector is null and section is not null").select("host", "section")
             .union(texts.where("not valid").select("host", "section")).distinct())
    return (texts.where("valid").join(slots, ["host", "section"], "left_anti")
            .groupBy("host").agg(F.collect_list("token").alias("template")))


def extract(pages: DataFrame, keep: list[str] | None = None, url: str = "url", page: str = "html",
            support: float = 0.5, min_pages: int = 3) -> DataFrame:
    """The columns `keep` of `pages` (all but the page by default) with text and n_chars (replaced
    if there): the blocks of the main text in page order, joined by an empty line, each with its
    white space turned into single spaces and its character references decoded.

    A null or empty page has an empty text; a null url belongs to the host of the empty name;
    repeated pages are extracted each and alike, and count once towards the template of their
    host; an empty table stays empty."""
    ship_package(pages.sparkSession)
    keep = [c for c in (keep or [c for c in pages.columns if c != page]) if c not in ("text", "n_chars")]
    parsed = land(_parsed(pages, keep, url, page), "pages")
    # landed, so that its size is known: Spark broadcasts it below the session's threshold only,
    # and beyond joins by host, splitting the rows of a large one
    template = land(templates(parsed.select(*("_" + c for c in OWN)).toDF(*OWN), support, min_pages)
                    .withColumnRenamed("host", "_of"), "templates")
    joined = parsed.drop("_tokens").join(template, F.col("_host") == F.col("_of"), "left")
    slots = F.when(F.col("template").isNull(), F.col("_blocks")).otherwise(
        F.filter("_blocks", lambda b: ~F.array_contains(F.col("template"), b["token"])))

    def text(blocks):
        return F.coalesce(F.array_join(F.transform(blocks, lambda b: b["text"]), "\n\n"), F.lit(""))

    whole, rest = text(F.col("_blocks")), text(slots)
    mostly = F.col("_inside") & (2 * F.length(rest) <= F.length(whole))
    return (joined.withColumn("text", F.when(mostly, whole).otherwise(rest))
            .withColumn("n_chars", F.length("text").cast("long")).select(*keep, "text", "n_chars"))
