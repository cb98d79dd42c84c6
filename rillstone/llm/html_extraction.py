"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of elements. For every element the tree keeps how often each presentation
(the sequence of its children) and each content (its own text) occurs. Where presentations and contents are the same on
many pages their entropy shows it: the element is of low importance, and its branch is removed from every page of the host.
Contents are judged by themselves as well: a text that stands in the same element of most pages of a host goes from there,
whatever its markup, also out of an article. Navigation, adverts, forms, comments and the like, whose contents may differ
from page to page, are removed by what their markup says they are. Where a page has a ``main``, its main text is what is in
there, or in its ``article`` if that holds most of it; else it is what is in an ``article``.
"""

from __future__ import annotations

import html as entities
import re
from zlib import crc32

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import add_columns, emit_rows, saved, table

# An element on fewer different pages of a host is taken as important.
LEAST_PAGES = 4
# Branches of lower importance are removed.
THRESHOLD = 0.25
# Share of the contents below an element in its importance; the rest is its presentation.
CONTENT_SHARE = 0.9
# A text in one element of such a share of a host's different pages is of no importance, if there are so many pages.
COMMON = 0.6
COMMON_PAGES = 8
# Elements nested deeper count as their ancestor of this depth in the tree; their texts stay apart.
DEPTH = 64

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg textarea title select audio video noembed noframes".split())
# In an article these hold text that is shown.
_SHOWN = frozenset("noscript svg".split())
_NOISE_TAGS = frozenset("nav header footer aside form head dialog menu button".split())
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle banner promo promoted sponsor sponsored sidebar menu nav navbar navigation"
    " breadcrumb breadcrumbs footer masthead comment comments commentlist reply replies respond disqus cookie cookies consent notice notices"
    " popup modal overlay newsletter subscribe subscription share sharing social related widget widgets pagination pager skip toolbar".split()
)
# What a name of noise may be followed by.
_NOISE_PARTS = frozenset("area bar block box button buttons container content item items list panel section slot unit wrap wrapper".split())
# Names under which an article is not the main one.
_TALK = frozenset("comment comments commentlist reply replies respond disqus related".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar".split())
# A start tag of the first kind ends an open element of the second kinds.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
    "tbody": {"td", "th", "tr", "thead", "tbody"}, "tfoot": {"td", "th", "tr", "thead", "tbody"},
}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:(?:"[^"]*"|'[^']*')[^>"']*+)*+)>""")
_SIMPLE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_PARTS = re.compile(r"[-_]+")
_SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "path", "noise", "firm", "own", "main", "article", "children", "depth")

    def __init__(self, tag, path, noise, firm, own, main, article, depth):
        self.tag, self.path, self.noise, self.main, self.article, self.depth = tag, path, noise, main, article, depth
        # ``firm`` noise stays so around an article, noise by a name only does not; ``own`` is that of the element itself.
        self.firm, self.own = firm, own
        self.children: list[str] = []


def _named_noise(token: str) -> bool:
    """Whether a class or id is a name of noise as a whole: its parts are such names, parts after the first may be plain."""
    first, *others = _PARTS.split(token.strip("-_")) or [""]
    return first in _NOISE_WORDS and all(w in _NOISE_WORDS or w in _NOISE_PARTS for w in others)


def _described(attributes: str) -> tuple[str, bool, bool]:
    """(name of the element from class and id, whether they tell noise, whether role or ``hidden`` do)."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return "", False, False
    names, noise, firm = [], False, False
    for m in _ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or "").lower()
        if kind == "role":
            firm |= value.strip() in _NOISE_ROLES
        elif kind == "hidden":
            firm |= value != "until-found"
        else:
            tokens = value.split()
            noise |= any(map(_named_noise, tokens))
            names += [("#" if kind == "id" else ".") + re.sub("[0-9]+", "0", w) for w in tokens]
    return "".join(sorted(set(names))), noise, firm


def blocks_of(page: str | None, on_close=None) -> list[tuple[Element, str]]:
    """The blocks of text in page order, each with the element that holds it. ``on_close`` gets every element of the tree."""
    page = page or ""
    root = Element("#page", "", False, False, False, False, False, 0)
    stack, open_, out, words = [root], {}, [], []
    at, tag = 0, _TAG

    def flush():
        if words:
            text = _SPACE.sub(" ", entities.unescape("".join(words))).strip()
            if text:
                out.append((stack[-1], text))
            words.clear()

    def close():
        e = stack.pop()
        open_[e.tag] -= 1
        if on_close and e.path != stack[-1].path:
            on_close(e)

    while True:
        lt = page.find("<", at)
        if lt < 0:
            words.append(page[at:])
            break
        if lt > at:
            words.append(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = len(page) if end < 0 else end + 1
            continue
        m = tag.match(page, lt)
        if not m:
            after = page[lt + 1 : lt + 3].lstrip("/")[:1]
            if after.isascii() and after.isalpha() and tag is _TAG:
                tag = _SIMPLE_TAG  # a quote is never closed: from here on tags end at the next bracket
                continue
            if after.isascii() and after.isalpha():
                break  # a tag that never ends takes the rest of the page
            words.append("<")
            at = lt + 1
            continue
        at = m.end()
        name = m[2].lower()
        if m[1]:
            if open_.get(name):
                if name in _BLOCKS:
                    flush()
                while stack[-1].tag != name:
                    if stack[-1].tag in _BLOCKS:
                        flush()
                    close()
                if stack[-1].own:
                    flush()
                close()
            elif name == "p":
                flush()
            elif name == "br":
                words.append(" ")
            continue
        if name in _RAW and not (name in _SHOWN and (stack[-1].main or stack[-1].article)):
            shut = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = len(page) if not shut else (page.find(">", shut.end()) + 1 or len(page))
            words.append(" " if name != "title" else "")
            continue
        if name in _VOID:
            if name in _BLOCKS:
                flush()
            elif name == "br":
                words.append(" ")
            continue
        described, named, firm = _described(m[3])
        if name in _BLOCKS:
            flush()
            # Markup of text ends at a block, what is noise itself goes on around it.
            while len(stack) > 1 and (stack[-1].tag == "p" or stack[-1].tag not in _BLOCKS and not stack[-1].own or stack[-1].tag in _ENDS.get(name, ())):
                close()
        elif not named and not firm and name not in _NOISE_TAGS:
            continue  # inline markup leaves no trace
        else:
            flush()
        top = stack[-1]
        holder = name in ("article", "main")
        talk = holder and noise_article(described)
        if holder:
            firm, named = talk, False
        elif name in ("html", "body"):
            firm = named = False
        else:
            firm = firm or name in _NOISE_TAGS and not (name == "header" and (top.main or top.article))
            firm = firm or named and any(w in _TALK for w in _WORD.findall(described))
        own = firm or named
        noise = top.firm or firm or (own or top.noise) and not holder
        key = name + described
        path = f"{top.path}>{key}" if top.depth < DEPTH else top.path
        if not top.children or top.children[-1] != key:
            top.children.append(key)
        stack.append(Element(name, path, noise, top.firm or firm, own, top.main or name == "main", top.article or name == "article", top.depth + 1))
        open_[name] = open_.get(name, 0) + 1
    flush()
    while len(stack) > 1:
        close()
    return out


def noise_article(described: str) -> bool:
    """Comments are often articles of their own; the main one may carry any other name."""
    return any(w in ("comment", "comments", "reply", "replies") for w in _WORD.findall(described))


def _signed(h: int) -> int:
    return h - (h >> 63 << 64)


def _hash(path: str, text: int | None = None) -> int:
    """Spark's xxhash64 of a path, or of a path and the hash of a text."""
    h = xxhash.xxh64_intdigest(path.encode(), 42)
    return _signed(h if text is None else xxhash.xxh64_intdigest(text.to_bytes(8, "little"), h))


def _text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 1) >> 1


def _cut(path: str, dropped: frozenset[int]) -> bool:
    at = len(path)
    while at > 0:
        if _hash(path[:at]) in dropped:
            return True
        at = path.rfind(">", 0, at)
    return False


def main_text(page: str | None, dropped: frozenset[int] = frozenset()) -> str:
    """The text of the kept blocks, an empty line between them. ``dropped`` has the hashes of branches, and of texts in them."""
    blocks, known = [], {}
    for e, text in blocks_of(page):
        if not e.noise:
            if dropped and e.path not in known:
                known[e.path] = _cut(e.path, dropped)
            if not dropped or not known[e.path] and _hash(e.path, _text_hash(text)) not in dropped:
                blocks.append((e, text))
    within, article = ([b for b in blocks if test(b[0])] for test in (lambda e: e.main, lambda e: e.article))
    inner = [b for b in within if b[0].article]
    size = lambda some: sum(len(t) for _, t in some)
    if within:
        chosen = inner if 2 * size(inner) > size(within) else within
    else:
        chosen = article or blocks
    return "\n\n".join(t for _, t in chosen)


def page_features(host: str, page: str | None) -> set[tuple[str, str, str, int, int]]:
    """(host, path, kind, feature, page): presence, presentation and contents of every element outside of noise."""
    own = xxhash.xxh64_intdigest((page or "").encode(), 1) >> 1
    rows = set()

    def closed(e: Element) -> None:
        if not e.noise:
            rows.add((host, e.path, "page", 0, own))
            rows.add((host, e.path, "style", crc32(">".join(e.children).encode()), own))

    for e, text in blocks_of(page, closed):
        if not e.noise:
            rows.add((host, e.path, "text", _text_hash(text), own))
    return rows


def _host(url):
    return F.coalesce(F.regexp_extract(F.lower(url), r"^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#\s]*)", 1), F.lit(""))


def features(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, path, kind, feature, n)``: on how many different pages of a host an element has a feature."""

    def work(hosts, texts):
        rows = [r for h, t in zip(hosts, texts) for r in page_features(h, t)]
        return [*zip(*rows)] or [[]] * 5

    named = pages.select(_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    seen = emit_rows(named, ["host", "html"], "host string, path string, kind string, feature bigint, page bigint", work).distinct()
    return seen.groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("n"))


def common_texts(counted: DataFrame, share: float = COMMON, least_pages: int = COMMON_PAGES) -> DataFrame:
    """``(host, hash)`` of texts that stand in the same element on such a share of the pages of their host.

    A page has so many blocks, and of all texts of a host only so many more can be on most of its pages.
    """
    size = counted.filter("kind = 'page'").groupBy("host").agg(F.max("n").alias("m")).filter(F.col("m") >= least_pages)
    met = counted.filter("kind = 'text' AND path <> ''").join(size, "host").filter(F.col("n") >= share * F.col("m"))
    return met.select("host", F.xxhash64("path", "feature").alias("hash"))


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The tree of :func:`features` of ``pages``."""
    return importances(features(pages, url, html))


def importances(each: DataFrame) -> DataFrame:
    """``(host, path, pages, importance)`` for every element of every host; equal pages of a host count once.

    ``importance`` is the share ``CONTENT_SHARE`` of the contents below the element (1 less the mean normalised entropy
    over pages of each different text, so 0 if all are on all pages) and for the rest the entropy of its presentations.
    """

    page, style, text = (F.col("kind") == k for k in ("page", "style", "text"))
    n, logs = F.col("n"), F.log("n")
    own = each.filter("path <> ''").groupBy("host", "path").agg(
        F.max(F.when(page, n)).alias("m"),
        F.sum(F.when(style, n * logs)).alias("style"),
        F.count(F.when(text, n)).alias("texts"),
        F.sum(F.when(text, logs)).alias("spread"),
    )
    # Presentations: the entropy over pages, to the base of the number of pages. log(m) is 0 for a single page.
    m = F.col("m")
    look = F.when(m > 1, (F.log(m) - F.coalesce("style", F.lit(0.0)) / m) / F.log(m)).otherwise(1.0)
    common = F.when(m > 1, F.coalesce("spread", F.lit(0.0)) / F.log(m)).otherwise(0.0)
    # Written down, as it is read twice below and pages are long to parse.
    own = saved(own.select("host", "path", "m", look.alias("look"), "texts", common.alias("common")), "elements")
    # Contents of a branch: its own and those of all elements below it.
    steps = F.split("path", ">")
    above = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), ">"))
    below = own.filter("texts > 0").select("host", F.explode(above).alias("path"), "texts", "common")
    below = below.groupBy("host", "path").agg(F.sum("texts").alias("texts"), F.sum("common").alias("common"))
    branch = own.select("host", "path", "m", "look").join(below, ["host", "path"], "left")
    content = F.when(F.col("texts") > 0, 1 - F.col("common") / F.col("texts"))
    return branch.select(
        "host", "path", F.col("m").alias("pages"),
        F.coalesce(CONTENT_SHARE * content + (1 - CONTENT_SHARE) * F.col("look"), F.lit(1.0)).alias("importance"),
    )


def low_branches(tree: DataFrame, least_pages: int = LEAST_PAGES, threshold: float = THRESHOLD) -> DataFrame:
    """``(host, path)`` of the branches to remove.

    Never the whole page or what holds an article, and of an article only elements with a class or id: the texts of plain
    ones are judged one by one.
    """
    last = F.element_at(F.split("path", ">"), -1)
    inside = F.col("path").rlike(">(article|main)")
    named = last.rlike("[.#]") & ~last.rlike("^(article|main)")
    low = tree.filter((F.col("pages") >= least_pages) & (F.col("importance") < threshold) & (F.size(F.split("path", ">")) > 3) & (~inside | named))
    holds = tree.filter(F.col("path").rlike(">(article|main)")).select("host", F.regexp_extract("path", "^(.*?)>(?:article|main)", 1).alias("held")).distinct()
    around = F.concat("held", F.lit(">")).startswith(F.concat("path", F.lit(">")))
    return low.join(holds.withColumnRenamed("host", "of"), (F.col("host") == F.col("of")) & around, "left_anti").select("host", "path")


def extract(
    pages: DataFrame, url: str = "url", html: str = "html", least_pages: int = LEAST_PAGES, threshold: float = THRESHOLD
) -> DataFrame:
    """``pages`` without its markup, with ``text`` and ``n_chars``.

    A null or empty page has an empty text; pages without a readable address share one nameless host. Broken markup is
    read as far as it goes, unclosed elements end with their parents. Pages of any length are read whole. Equal pages get
    equal texts, columns that already have one of the new names are replaced, an empty table gives an empty one.
    """
    counted = saved(features(pages, url, html), "style-features")
    branches = low_branches(importances(counted), least_pages, threshold).select("host", F.xxhash64("path").alias("hash"))
    gone = branches.union(common_texts(counted)).groupBy("host").agg(F.sort_array(F.collect_set("hash")).alias("_gone"))
    dropped = saved(gone.select(F.col("host").alias("_of_host"), "_gone"), "style-tree")
    kept = [c for c in pages.columns if c != html and c.lower() not in ("text", "n_chars")]
    named = pages.select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(kept)], F.col(html).alias("_html"), _host(F.col(url)).alias("_host"))
    joined = named.join(dropped, F.col("_host") == F.col("_of_host"), "left")

    def work(texts, hashes):
        made = [main_text(t, frozenset(h or ())) for t, h in zip(texts, hashes)]
        return [made, [len(t) for t in made]]

    own = [f"_{k}" for k in range(len(kept))]
    made = add_columns(joined, ["_html", "_gone"], "_text string, _n bigint", work, keep=own)
    return made.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(kept)], F.col("_text").alias("text"), F.col("_n").alias("n_chars"))


def op6_site_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages").select("page_id", "url", "html"))


QUERIES = {"op6_site_style_tree": op6_site_style_tree}
SQL: dict[str, str] = {}
