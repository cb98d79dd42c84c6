"""Benchmark decontamination by Wu-Manber search over words.

The letters of the search are words. For every pattern length there is a shift table over blocks of two words: a block
that no pattern holds lets the search jump over almost a whole pattern. Where the shift is nought, the block's bucket
gives, by the first words, the few patterns that may end here, and a direct comparison confirms them.
"""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import add_columns, emit_rows, saved, table

WINDOW = 10
# Words of the benchmark that one pass over the documents searches for; a larger benchmark takes several passes.
PASS_WORDS = 200_000
PART_WORDS = 10_000

_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LETTERS).split()


class Search:
    """Patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = defaultdict(dict)
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                key = words[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            prefixes = self.buckets[words[length - self.block :]]
            prefixes.setdefault(words[: self.block], []).append((words, items))

    def found(self, words: list[bytes]):
        """(first word, items) of every occurrence."""
        m, far, shift, i, n = self.length, self.far, self.shift, self.length - 1, len(words)
        pair = self.block == 2
        while i < n:
            key = (words[i - 1], words[i]) if pair else (words[i],)
            skip = shift.get(key, far)
            if skip:
                i += skip
                continue
            first = i - m + 1
            for pattern, items in self.buckets[key].get(tuple(words[first : first + self.block]), ()):
                if tuple(words[first : i + 1]) == pattern:
                    yield first, items
            i += 1


def searches(parts: list[tuple[str, bytes]], window: int) -> list[Search]:
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for item, text in parts:
        words = text.split(b" ")
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            by_length[size][tuple(words[i : i + size])].add(item)
    return [Search(size, patterns) for size, patterns in sorted(by_length.items())]


_BUILT: OrderedDict[str, list[Search]] = OrderedDict()


def _built(name: str, sent, window: int) -> list[Search]:
    if name not in _BUILT:
        if len(_BUILT) >= 2:
            _BUILT.popitem(last=False)
        _BUILT[name] = searches(sent.value, window)
    return _BUILT[name]


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Disjoint spans as start, end, start, end and so on."""
    out: list[int] = []
    for s, e in sorted(spans):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _parts(window: int):
    """Items as runs of words that overlap by a window less one, so that no part is long."""

    def work(items, texts):
        rows = []
        for item, text in zip(items, texts):
            words = words_of(text)
            for i in range(0, max(len(words) - window, 0) + 1 if words else 0, PART_WORDS):
                own = words[i : i + PART_WORDS + window - 1]
                rows.append((item or "", i, len(own), b" ".join(own)))
        return [*zip(*rows)] or [[], [], [], []]

    return work


def _annotated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
    pass_words: int = PASS_WORDS,
) -> DataFrame:
    """``docs``, its columns named ``_0``, ``_1`` and so on, with the columns of :func:`annotate`.

    Narrow: documents are not shuffled. The benchmark is searched in passes of bounded size, one for all but huge ones. What a
    pass has found is written before the next one, so that a task and the driver hold the words of one pass at a time.
    """
    named = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("binary").alias("words"))
    parts = emit_rows(named, ["item", "words"], "item string, at bigint, n bigint, words binary", _parts(window))
    parts = saved(parts, "benchmark").distinct()
    total = parts.agg(F.sum("n")).first()[0] or 0
    passes = max(1, -(-total // pass_words))
    # Columns of any name are carried under others meanwhile.
    columns = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)]
    empty = {"_hits": F.array().cast("array<int>"), "_items": F.array().cast("array<string>")}
    out = docs.select(*columns, F.col(text).cast("binary").alias("_raw")).withColumns(empty)
    for k in range(passes):
        own = parts.filter(F.pmod(F.xxhash64("item", "at"), F.lit(passes)) == k) if passes > 1 else parts
        sent = docs.sparkSession.sparkContext.broadcast([(r.item, bytes(r.words)) for r in own.collect()])
        out = add_columns(out, ["_raw", "_hits", "_items"], "_n_words bigint, _hits array<int>, _items array<string>", _search(sent, window))
        if k < passes - 1:
            out = saved(out, "pass")
            sent.unpersist()
    return out.drop("_raw")


def annotate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with ``_n_words``, ``_hits`` (disjoint word spans, start and end in turn) and ``_items`` (ids as text)."""
    new = ["_n_words", "_hits", "_items"]
    plain = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in new])
    return _named(plain, _annotated(plain, benchmark, **options), *new)


def _named(docs: DataFrame, found: DataFrame, *more) -> DataFrame:
    return found.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)], *more)


def _search(sent, window: int):
    name = uuid4().hex

    def work(texts, hits, items):
        sizes, spans, names = [], [], []
        for text, old, ids in zip(texts, hits, items):
            words, own, found = words_of(text), [*zip(old[::2], old[1::2])], set(ids)
            for search in _built(name, sent, window):
                for first, its in search.found(words):
                    own.append((first, first + search.length))
                    found |= its
            sizes.append(len(words))
            spans.append(merged(own))
            names.append(sorted(found))
        return sizes, spans, names

    return work


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    A null text has no words and is clean; so is every document where the benchmark is empty. Items under ten words are
    looked for whole. Repeated items count once, an item without an id is named by an empty text. Columns that already
    have one of the new names are replaced.
    """
    new = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    plain = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in new])
    found = _annotated(plain, benchmark, **options)
    hit = F.aggregate(F.transform("_hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0), lambda a, x: a + x)
    values = (
        F.col("_n_words"), hit.cast("bigint"), F.size("_items").cast("bigint"), F.sha2(F.array_join(F.sort_array("_items"), ","), 256),
        F.size("_hits") > 0,
    )
    return _named(plain, found, *[v.alias(c) for v, c in zip(values, new)])


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of a benchmark item, with their columns as they were."""
    return _named(docs, _annotated(docs, benchmark, **options).filter(F.size("_hits") == 0))


def op4_wu_manber(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, folder, "benchmark")).drop("text")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

QUERIES = {"op4_wu_manber": op4_wu_manber}
SQL = {
    "op4_wu_manber": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), {WINDOW}) AS m FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g FROM sized),
lengths AS (SELECT DISTINCT m FROM windows),
spots AS (SELECT doc_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: {{'p': i, 'g': array_to_string(w[i:i + m - 1], ' ')}})) AS x FROM d, lengths),
hits AS (SELECT doc_id, item, spots.m AS m, x.p AS p FROM spots JOIN windows ON windows.m = spots.m AND windows.g = x.g),
places AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""
}
