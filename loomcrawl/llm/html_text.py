"""Main text of web pages by template deduction over equivalence classes of tokens.

Tokens of a page are its tags, told apart by the path of elements they stand in, and its blocks of
text. Over the pages of a host, tokens with the same occurrence vector (how often a token occurs, page
by page) form an equivalence class. Classes that occur in at least half of the host's pages are large;
those whose spans nest in or lie beside each other, from the most frequent down, are valid and make
up the host's template. What lies between template tokens are slots. The main text is what the slots
of the article hold: template text, and everything in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments, and what is hidden, is left out.

Vectors are never gathered: a token's vector is represented by its count of pages and the XOR of one
hash per page and count, which tasks combine before the shuffle, so a host with a third of all pages
costs each task one row per token. A template holds at most twice the tokens of an average page, as
each is in half of the pages. Pages are read a second time with their host's template; they are not
moved where Spark finds the templates small enough to send, and joined by host beyond that.

Which region is the article is told by slot text: article and main elements where they hold at least half of it, else
the whole page. The template decides inside article and main elements too: a notice that repeats over a host is left
out there whatever its class name is. Copies of an article are no template: a class that makes up at
least `copied` of the article text of the pages it is in is such a copy, its text stays, and so does that
of classes in no more pages than it, which are parts that some copies lack. The text of a page that has
nothing but template text stays. On a host of one page nothing repeats, so it has no template; the element
rules still hold.

A null html is an empty page with empty text. Pages that share an id are pages of their own. A null
url counts as a host of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

# Element and class names of HTML pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
HOLDS_ITEMS = frozenset("ul ol dl table select menu div article section main body".split())
NOT_TEXT = frozenset("head nav footer aside form button select iframe dialog menu object video audio canvas fieldset".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert".split())
#: Words that mark a region as the whole of a class or id, or with others of them and of those that tell a place only.
NOT_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars aside widget widgets footer masthead topbar toolbar related recommended recommendations share sharing social "
    "comment comments discussion disqus replies reply respond feedback disclaimer copyright".split()
)
PLACES = frozenset(
    "site page main top bottom left right center upper lower inner outer global primary secondary container wrapper wrap box block section area region zone panel pane bar strip slot unit row col column "
    "list item items links link button buttons text title label form body content header head group holder frame layer mobile desktop fixed sticky js the my reader readers user users visitor article articles post posts entry entries story stories reading".split()
)
LIST_ITEMS = frozenset("li dt dd".split())
RAW = "script|style|noscript|template|svg|math|textarea|title|xmp|noembed|noframes"

# Attributes up to the end of a tag: a value's quotes count where the value ends with its tag or before more of it,
# so a quote that is never closed, or closed in another tag, ends with its own tag. A tag cut off by the page's end is one.
_ATTRIBUTES = r"(?:=\s*\"[^\"]*\"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|=|[^>=]+)*+(?:>|\Z)"
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b{_ATTRIBUTES}.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PARTS = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")


@dataclass(frozen=True)
class ExtractParams:
    #: Share of a host's pages that a large class is in, and pages at least, as a template is what repeats.
    share: float = 0.5
    min_pages: int = 2
    #: Share of its pages' article text from which on a class is a copied article.
    copied: float = 0.8


@dataclass(slots=True)
class Block:
    """A block of text: `article` if it is inside an article or main element, `out` if inside a region that holds no main text, `link` if it is mostly links, `listed` if inside an item of a list."""

    text: str
    token: int
    article: bool
    out: bool
    link: bool
    listed: bool = False


def _marks_region(name: str) -> bool:
    """Whether a class or id is a region's: `site-footer` and `cookie-banner` are, `related-work` and `share-price` are not."""
    parts = [p.lower() for p in PARTS.split(name) if p and not p.isdigit()]
    return any(p in NOT_TEXT_NAMES for p in parts) and all(p in NOT_TEXT_NAMES or p in PLACES for p in parts)


def _is_out(name: str, attributes: str, in_article: bool) -> bool:
    if name in NOT_TEXT or (name == "header" and not in_article):
        return True
    if not attributes or name in ("body", "html"):
        return False
    if HIDDEN.search(attributes):
        return True
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        if key.lower() == "role":
            if value.lower() in NOT_TEXT_ROLES:
                return True
        elif any(_marks_region(name) for name in value.split()):
            return True
    return False


def parse(page: str) -> tuple[list[Block], list[int]]:
    """Blocks of text of a page, and the hashes of its tokens (tags with their paths, and blocks) in page order."""
    blocks, tokens = [], []
    # (name, path hash, in an article, in a region without main text, in an item of a list) of the open elements
    stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
    run: list[str] = []
    links = words = 0

    def flush() -> None:
        nonlocal links, words
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                token = xxhash.xxh64_intdigest(f"{stack[-1][1]}\0{text}")
                tokens.append(token)
                blocks.append(Block(text, token, stack[-1][2], stack[-1][3], 2 * links > words, stack[-1][4]))
            run.clear()
        links = words = 0

    def add(text: str) -> None:
        nonlocal links, words
        if text:
            run.append(text)
            words += len(text)
            if stack[-1][0] == "a":
                links += len(text)

    end = 0
    for m in TOKEN.finditer(page):
        add(page[end : m.start()])
        end = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            flush()
        if m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    tokens.append(stack[k][1] ^ 1)
                    del stack[k:]
                    break
            continue
        if name in CLOSES_ITSELF:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] in HOLDS_ITEMS:
                    break
        _, path, article, out, listed = stack[-1]
        attributes = m[4].removesuffix(">")
        path = xxhash.xxh64_intdigest(name, path) & ~1
        tokens.append(path)
        if name in VOID or attributes.endswith("/"):
            continue
        stack.append((name, path, article or name in ("article", "main") or "role" in attributes and bool(re.search(r"role\s*=\s*[\"']?main\b", attributes)), out or _is_out(name, attributes, article), listed or name in LIST_ITEMS))
    add(page[end:])
    flush()
    return blocks, tokens


def article_of(blocks: list[Block]) -> list[Block]:
    """Of a page's blocks outside regions without main text those of the article.

    Article elements are the article where they hold most of what there is besides links; otherwise it is all
    blocks, without items of lists that are links beside other such items.
    """
    inside = [b for b in blocks if b.article]
    if inside and 2 * sum(len(b.text) for b in inside) >= sum(len(b.text) for b in blocks if b.article or not b.link):
        return inside
    item = [False, *(b.link and b.listed for b in blocks), False]
    return [b for k, b in enumerate(blocks, 1) if not (item[k] and (item[k - 1] or item[k + 1]))]


def main_text(blocks: list[Block], template: frozenset[int] | set[int]) -> str:
    """The article of the slots, in page order; a page of nothing but template text keeps it."""
    free = [b for b in blocks if not b.out]
    return " ".join(b.text for b in article_of([b for b in free if b.token not in template] or free))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _count(batches: Iterator[pa.RecordBatch], sizes: bool = False) -> Iterator[pa.RecordBatch]:
    """Per host and token of a batch: pages it is in, XOR of the hashes of (page, count), sum of its first places.

    Token 0 stands for the page itself. With sizes also, of tokens that are article text: its characters, and
    those of all article text of the pages it is in.
    """
    names = ["host", "token", "pages", "vector", "place", "size", "whole"][: 7 if sizes else 5]
    task, row = TaskContext.get().partitionId(), 0
    for b in batches:
        found: dict[tuple[str, int], list[int]] = {}
        for host, page in zip(b.column(0).to_pylist(), b.column(1)):
            row += 1
            seed = xxhash.xxh64_intdigest(f"{task}:{row}")
            blocks, tokens = parse(page.as_py() or "")
            size: Counter[int] = Counter()
            for x in article_of([x for x in blocks if not x.out]):
                size[x.token] += len(x.text)
            whole = size.total()
            first: dict[int, int] = {}
            for k, t in enumerate(tokens):
                first.setdefault(t, k)
            for t, n in [*Counter(tokens).items(), (0, 1)]:
                x = found.setdefault((host, t), [0] * 5)
                x[0] += 1
                x[1] ^= xxhash.xxh64_intdigest(n.to_bytes(4, "little"), seed)
                x[2] += first.get(t, 0)
                if t in size:
                    x[3] += size[t]
                    x[4] += whole
        keys, values = list(found), np.array(list(found.values()), np.uint64).reshape(-1, 5).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in keys], pa.string()), pa.array(np.array([t for _, t in keys], np.uint64).view(np.int64)), *map(pa.array, values.T[: len(names) - 2].copy())], names)


def valid_classes(vector: np.ndarray, pages: np.ndarray, place: np.ndarray) -> np.ndarray:
    """True for tokens of classes that nest: no two of their spans, from the first token to the last, overlap in part."""
    keep = np.zeros(len(vector), bool)
    _, of = np.unique(np.stack([pages, vector], 1), axis=0, return_inverse=True)
    order = np.argsort(of, kind="stable")
    begin = np.flatnonzero(np.concatenate(([True], of[order][1:] != of[order][:-1]))) if len(of) else np.empty(0, np.int64)
    size = np.diff(np.append(begin, len(of)))
    low, high = (f.reduceat(place[order], begin) if len(begin) else np.empty(0) for f in (np.minimum, np.maximum))
    at, known = np.empty((2, len(begin))), 0
    for k in np.lexsort((-size, -pages[order][begin])).tolist():  # the most frequent first, of those the largest
        a, b = low[k], high[k]
        x, y = at[:, :known]
        if ((b < x) | (y < a) | (x <= a) & (b <= y) | (a <= x) & (y <= b)).all():
            at[:, known] = a, b
            known += 1
            keep[order[begin[k] : begin[k] + size[k]]] = True
    return keep


def copied_articles(vector: np.ndarray, pages: np.ndarray, size: np.ndarray, whole: np.ndarray, copied: float) -> np.ndarray:
    """True for tokens of article text that are copies of an article, by the share that their class has of its pages' article text."""
    classes: dict[tuple[int, int], list[int]] = {}
    for k in np.flatnonzero(size).tolist():
        classes.setdefault((int(pages[k]), int(vector[k])), []).append(k)
    most = max((n for (n, _), members in classes.items() if size[members].sum() >= copied * whole[members].max()), default=0)
    return (size > 0) & (pages <= most)


def deduce_templates(pages: DataFrame, params: ExtractParams = ExtractParams(), html: str = "html", url: str = "url") -> DataFrame:
    """(host, template): the tokens of each host's valid classes, without copied articles; hosts without any class have no row."""
    found = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).mapInArrow(partial(_count, sizes=True), "host string, token long, pages long, vector long, place long, size long, whole long")
    tokens = saved(found.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), *(F.sum(c).alias(c) for c in ("place", "size", "whole"))), "tokens")
    hosts = saved(tokens.where(f"token = 0 and pages >= {params.min_pages}").select(F.col("host").alias("of"), F.col("pages").alias("all_pages")), "hosts")
    large = tokens.where(f"token <> 0 and pages >= {params.min_pages}").join(hosts, F.col("host") == F.col("of")).where(F.col("pages") >= F.col("all_pages") * params.share)

    def nest(key, t):
        ok = valid_classes(t.vector.to_numpy(), t.pages.to_numpy(), (t.place / t.pages).to_numpy())
        ok &= ~copied_articles(t.vector.to_numpy(), t.pages.to_numpy(), t["size"].to_numpy(), t.whole.to_numpy(), params.copied)
        import pandas as pd

        return pd.DataFrame({"host": [key[0]], "template": [t.token[ok].tolist()]})

    # a host's rows here are at most twice the tokens of its average page
    return large.select("host", "token", "pages", "vector", "place", "size", "whole").groupBy("host").applyInPandas(nest, "host string, template array<long>")


def extract_text(pages: DataFrame, params: ExtractParams = ExtractParams(), page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars (code points)."""
    templates = saved(deduce_templates(pages, params, html, url).withColumnRenamed("host", "of"), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for page, template in zip(b.column(2), b.column(3)):
                blocks, _ = parse(page.as_py() or "")
                known = frozenset() if not template.is_valid else frozenset(np.asarray(template.values).view(np.uint64).tolist())
                texts.append(main_text(blocks, known))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(F.col(url)).alias("host"))
    joined = rows.join(templates, rows["host"] == templates["of"], "left").select("page_id", "url", "html", "template")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
