"""Main text of web pages (operator 5).

Pages are parsed into blocks. Structure decides two kinds of them: what it marks as surroundings goes - menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, hidden parts and reader comments -, and what stands in an
article or main element stays. Repeats can't decide there: quotations and copied articles repeat across pages too.

Of all other blocks the host's suffix array decides. The suffixes are those of each page's token stream of such
blocks, ordered to the depth of RUN tokens: an exchange brings suffixes of one host with the same first RUN tokens
together - one interval of the array -, however many pages the host has. Intervals that enough distinct pages share
are boilerplate; blocks that these cover go, unique ones stay.

Defined cases: null or empty html gives an empty text; null urls are one host; unclosed tags, stray ends and broken
attributes are read as browsers do, roughly; repeated rows get equal results; an empty table gives an empty result;
other columns are kept, but for `text`, and 64-bit ids stay exact.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, small_batches, weights, words

#: Tokens in a row, and the share of a host's distinct pages with undecided blocks (three at least), that make a repeat.
RUN, SHARE, PAGES = 5, 0.2, 3
#: Share of a block's tokens that repeats must cover.
COVER = 0.8
_W = weights(RUN, 41)
#: Parts into which copies of one page are dealt where pages meet their repeats.
SALT = 8

_tag = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>", re.S)
_attribute = re.compile(r"(class|id|role|style|hidden|aria-hidden|aria-label)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_form_end, _main, _paragraph = re.compile(r"</form\b", re.I), re.compile(r"<(?:article|main)\b", re.I), re.compile(r"<p\b", re.I)
_parts = re.compile(r"[a-z]+|[A-Z][a-z]*")
# Element names of HTML and names that surroundings go by.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe template svg select head xmp".split())
AWAY = frozenset("nav header footer aside form button dialog menu fieldset".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar "
    "footer sidebar aside widget cookie cookies consent gdpr notice notices notification banner popup modal overlay newsletter subscribe subscription signup "
    "login related recommended recommendations share sharing social comment comments commentlist disqus respond replies pagination pager toolbar skip".split()
)
# Names of an article's own head; they end like a page's header but stay.
HEADS = frozenset("page entry article post content section story chapter".split())
# Parts of names that say nothing of their own as the first part: what they stand for may be an article's topic.
TOPICS = frozenset("social related share sharing header login notice notices skip recommended comment respond widget".split())
# Whole class and id names that also go inside an article; there, a mere part of a name says nothing.
WITHIN = frozenset(
    "ad ads adv advert adverts advertisement advertising ad-slot ad-unit ad-container ad-wrapper adsbygoogle sponsored promo newsletter newsletter-signup subscribe "
    "share sharing share-buttons share-bar share-links social-share social-buttons social-links sharedaddy related-posts related-articles "
    "comments comment-list commentlist comment-form comment-respond comments-area disqus_thread respond cookie-notice cookie-banner breadcrumb breadcrumbs pagination".split()
)
# Inside an article block elements also go by the last part of their name, or by the first if the last one says box.
LAST = frozenset("comments comment commentlist sidebar ad ads advert adverts advertisement newsletter promo".split())
FIRST = frozenset("ad ads advert adverts advertisement promo sponsor sponsored newsletter comments comment cookie".split())
BOXES = frozenset("banner box slot unit container wrapper wrap block area signup form widget panel space frame section list thread".split())
_P_ENDS = BLOCK - {"li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
_SAME = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",), "option": ("select",)}


def _wraps(page: str, at: int) -> bool:
    """Whether the form that opened before `at` stands around the page's article, or around most of its paragraphs."""
    shut = _form_end.search(page, at)
    inside = page[at : shut.start() if shut else len(page)]
    if _main.search(inside):
        return True
    held = len(_paragraph.findall(inside))
    return held >= 3 and 2 * held > len(_paragraph.findall(page))


def _away(name: str, attributes: str, in_main: bool) -> bool:
    """Whether an element is part of a page's surroundings."""
    if name in AWAY and not (name == "header" and in_main):
        return True
    if name in ("html", "body", "main") or not attributes.strip():
        return False
    for key, a, b, c in _attribute.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id"):
            for token in value.split():
                words = [w.lower() for w in _parts.findall(token)]
                if token.lower() in WITHIN:
                    return True
                if in_main:
                    if name in BLOCK and words and (words[-1] in LAST or words[0] in FIRST and words[-1] in BOXES):
                        return True
                elif words and not (words[-1] == "header" and words[0] in HEADS):
                    if words[-1] in NAMES or words[0] in NAMES and not (len(words) > 1 and words[0] in TOPICS and words[-1] not in BOXES):
                        return True
    return False


def blocks(page: str) -> list[tuple[str, bool, bool]]:
    """(text, away, in an article or main element) of each block with text, in page order."""
    out: list[tuple[str, bool, bool]] = []
    buffer: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, away, main: with all that it stands in

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                out.append((text, *(stack[-1][1:] if stack else (False, False))))
            buffer.clear()

    def close(name: str, until: tuple[str, ...] = ()) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                flush()
                del stack[k:]
                return
            if stack[k][0] in until:
                return

    at, end = 0, len(page)
    while at < end:
        m = _tag.search(page, at)
        if m is None:
            buffer.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            buffer.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name in BLOCK:
                flush()
                close(name, ("table",) if name != "table" else ())
            else:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k]
                        break
                    if stack[k][0] in BLOCK:
                        break
            continue
        attributes = m[3] or m[6] or ""
        if name in RAW:
            shut = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            if not attributes.rstrip().endswith("/"):
                at = shut.end() if shut else end
            continue
        if name in BLOCK:
            flush()
            if name in _P_ENDS:
                close("p", ("table", "td", "th"))
            if name in _SAME:
                close(name, _SAME[name])
        elif name in ("br", "img", "wbr"):
            buffer.append(" " if name != "wbr" else "")
        if name not in VOID:
            away, main = stack[-1][1:] if stack else (False, False)
            wraps = name == "form" and _wraps(page, at)
            stack.append((name, away or not wraps and _away(name, attributes, main), main or name in ("article", "main")))
            # inline elements only matter if they are surroundings
            if name not in BLOCK and not stack[-1][1]:
                stack.pop()
            elif name not in BLOCK and not away:
                last = stack.pop()
                flush()
                stack.append(last)
    flush()
    return out


def _undecided(found: list[tuple[str, bool, bool]]) -> list[str]:
    return [text for text, away, main in found if not away and not main]


def runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the stream's runs of RUN tokens, one a suffix that is long enough, and the tokens of each text."""
    owner, _, _, h, _ = words([t.encode("utf-8", "surrogatepass") for t in texts], lower=False)
    size = np.bincount(owner, minlength=len(texts))
    out = np.zeros(max(0, len(h) - RUN + 1), np.uint64)
    for k in range(RUN):
        out += h[k : len(h) - RUN + 1 + k] * _W[k]
    return mix(out).view(np.int64), size


def main_text(page: str, repeats: np.ndarray) -> str:
    """Main text of a page, given its host's repeated runs (or as many of them as this page has)."""
    found = blocks(page)
    away = [a for _, a, _ in found]
    texts = _undecided(found)
    if texts and len(repeats):
        at, size = runs(texts)
        mask = np.zeros(int(size.sum()), bool)
        start = np.flatnonzero(np.isin(at, repeats))
        for k in range(RUN):
            mask[start + k] = True
        edge = np.cumsum(size) - size
        covered = iter([n > 0 and mask[a : a + n].mean() >= COVER for a, n in zip(edge.tolist(), size.tolist(), strict=True)])
        away = [a or (not main and next(covered)) for _, a, main in found]
    return "\n".join(text for (text, _, _), a in zip(found, away, strict=True) if not a)


def extract(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """pages with `text`, the main text, instead of the html."""
    small_batches(pages)
    kept = [f for f in pages.schema.fields if f.name not in (page, "text")]
    names = [f"__c{i}" for i in range(len(kept))]
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    rows = pages.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(kept, names, strict=True)], F.col(f"`{page}`").alias("__html"), host.alias("__host"))

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, found = [], [], []
            for h, k, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                texts = _undecided(blocks(t))
                if texts:
                    r = np.unique(runs(texts)[0]).tolist()
                    hosts += [h] * len(r)
                    keys += [k] * len(r)
                    found += r
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(found, pa.int64())], ["host", "page", "run"])

    asked = rows.where("__html is not null").select("__host", F.xxhash64("__html").alias("__page"), "__html")
    held = cut(asked.mapInArrow(suffixes, "host string, page long, run long").distinct())

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            html_, runs_ = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("__html", "__runs"))
            text = [main_text(t, np.array(r, np.int64) if r else none) if t else "" for t, r in zip(html_, runs_, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(text, pa.string())], [*names, "text"])

    schema = ", ".join([f"{n} {f.dataType.simpleString()}" for f, n in zip(kept, names, strict=True)] + ["text string"])
    told = [*[F.col(n).alias(f.name) for f, n in zip(kept, names, strict=True)], "text"]
    columns = [F.col(f"`{n}`") for n in [*names, "__html"]]
    no_runs = F.lit(None).cast("array<long>").alias("__runs")
    if held.isEmpty():  # structure decides every block of every page: no page needs an exchange
        return rows.select(*columns, no_runs).mapInArrow(finish, schema).select(*told)
    need = held.groupBy("host").agg(F.greatest(F.lit(PAGES), F.ceil(F.count_distinct("page") * SHARE)).alias("need"))
    often = held.groupBy("host", "run").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES).join(need, "host").where("n >= need")
    marks = held.join(often.select("host", "run"), ["host", "run"]).groupBy("host", "page").agg(F.collect_list("run").alias("__runs"))
    marks = marks.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = rows.where("__html is not null").withColumns({"__page": F.xxhash64("__html"), "__salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int")})
    marked = salted.join(marks.withColumnsRenamed({"host": "__host", "page": "__page"}), ["__host", "__page", "__salt"], "left")
    both = marked.select(*columns, "__runs").unionAll(rows.where("__html is null").select(*columns, no_runs))
    return both.mapInArrow(finish, schema).select(*told)
