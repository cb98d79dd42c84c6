"""Similarity join of documents on the Jaccard coefficient of their word n-grams, by T-occurrence search.

Two sets that link share so many n-grams that they also share some in their prefixes, the first part of each set in one
order of all n-grams. A document whose prefix holds too few n-grams of others can link with nothing. For the others the
n-grams that two prefixes share are counted over short lists of holders; what long lists could add is bounded by how many
of them a document stands in. Pairs that may share enough, and neighbours in long lists, make components, and links exist
only inside a component. There the search runs: every n-gram has an inverted list, and a document wants all others that
stand in at least T of its lists. By DivideSkip its short lists are merged, which leaves those that occur there often
enough, and the long ones are only probed for these.

Components larger than a block are cut, and every two cuts meet, so no task holds more than two cuts. Equal texts are one
set. The order of n-grams puts the frequent ones of a sample last; any order gives the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.common import bounded_batches, emit_rows, saved, table
from rillstone.llm.components import stars
from rillstone.llm.simhash import forest
from rillstone.operators.ordered import running, slice_groups

WORDS = 5
PERCENT = 80
# One of so many different texts tells which n-grams are frequent; at most so many are told apart, so their list is bounded.
SAMPLE = 32
FREQUENT = 8
KNOWN = 1 << 16
# A prefix holds one n-gram in so many more than one shared n-gram would need.
EXTRA = 10
# Holders in one row of a list. Complete lists of fewer give pairs, the shortest first, up to so many pairs a holder.
HOLDERS = 64
PAIRS = 4
# Bits of the bitmap that rules out texts without a component before they are shuffled; 2 MB.
BITS = 1 << 24
# Documents and n-grams of a cut.
BLOCK = 2048
BLOCK_GRAMS = 1 << 21
# Weight of a binary probe against a step of the merge, as in the DivideSkip formula for the number of long lists.
PROBE = 1.0


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The 64-bit hashes of the distinct n-grams, ascending; a text of fewer words is one n-gram."""
    w = (text or "").encode().lower().split()  # both for ASCII only, as bytes know no others
    if not w:
        return np.zeros(0, "u8")
    joined, width = b" ".join(w), min(words, len(w))
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = [0, *ends[: len(w) - width].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s : e - 1]) for s, e in zip(starts, ends[width - 1 :].tolist())], "u8"))


def _ceil(a, b: int):
    return -(-a // b)


def prefix_sizes(n: int, percent: int = PERCENT, extra: int = EXTRA) -> tuple[int, int]:
    """(n-grams in the prefix of a set of ``n``, how many of them another set that links must at least share).

    A partner has at least ``percent`` of ``n`` n-grams, and the overlap at least ``T``. Prefixes that are ``k`` longer than
    ``n - T`` share ``k``; the smaller one's ``k`` counts.
    """
    least = _ceil(percent * n, 100)
    return n - least + _ceil(n, extra), _ceil(least, extra)


def frequent_grams(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """Hashes of n-grams that many different texts of the sample hold; at most ``KNOWN`` reach the driver."""
    sample = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("key"))
    sample = sample.filter(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0)

    def work(texts, keys):
        grams = [shingles(t, words) for t in texts]
        return [np.concatenate(grams).view("i8"), np.repeat(np.array(keys, "i8"), [len(g) for g in grams])]

    held = emit_rows(sample, ["text", "key"], "gram bigint, key bigint", work)
    # Copies of one text in a sample make an n-gram frequent only together with another text.
    counted = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    top = counted.filter(f"n >= {FREQUENT} and low < high").orderBy(F.desc("n"), "gram").limit(KNOWN)
    return np.sort(np.array([r.gram for r in top.select("gram").collect()], "i8").view("u8"))


def _told(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("key"), F.col(f"`{text}`").alias("text"))


def _one_each(told: DataFrame, sets: DataFrame) -> DataFrame:
    """``told`` without rows that repeat a text with many copies; the list of these is bounded."""
    many = sets.filter(F.col("copies") >= FREQUENT).orderBy(F.desc("copies"), "key").limit(KNOWN)
    many = F.broadcast(many.select(F.col("key").alias("m_key"), F.col("first").alias("m_first")))
    marked = told.join(many, F.col("key") == F.col("m_key"), "left")
    return marked.filter("m_key is null or id <=> m_first").drop("m_key", "m_first")


def _marks(told: DataFrame, words: int, percent: int, extra: int, known: np.ndarray) -> DataFrame:
    """``(key, n, prefix, n_known)``: a text's set size and prefix, the known frequent n-grams at its end."""

    def work(keys, texts):
        out = []
        for text in texts:
            grams = shingles(text, words)
            late = np.isin(grams, known, assume_unique=True)
            size = prefix_sizes(len(grams), percent, extra)[0]
            early = grams[~late][:size]
            rest = grams[late][: size - len(early)]
            out.append((len(grams), np.concatenate([early, rest]).view("i8"), len(rest)))
        return [keys, *([o[k] for o in out] for k in range(3))]

    return emit_rows(told, ["key", "text"], "key bigint, n bigint, prefix array<bigint>, n_known bigint", work)


class Lists:
    """Inverted lists of some sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        grams = np.concatenate(sets)
        order = np.argsort(grams, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.grams, self.start = np.unique(grams[order], return_index=True)
        self.end = np.append(self.start[1:], len(grams))
        # (list, owner) ascending in one array, so that any list is probed by binary search in it.
        self.keyed = np.repeat(np.arange(len(self.grams)), self.end - self.start) * len(sets) + self.owner

    def merged(self, lists: np.ndarray) -> np.ndarray:
        """All entries of these lists in ascending order; the stable sort merges the ordered runs."""
        sizes = self.end[lists] - self.start[lists]
        offsets = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.start[lists] - offsets, sizes)
        return np.sort(self.owner[at], kind="stable")

    def holders(self, query: np.ndarray, percent: int, below: int) -> np.ndarray:
        """Sets before ``below`` that link with ``query``: those in at least T of its lists, T by the size of both."""
        n = len(query)
        least = _ceil(percent * n, 100)
        t = _ceil(percent * (n + least), 100 + percent)
        at = np.searchsorted(self.grams, query)
        at = at[at < len(self.grams)] if len(query) and at[-1] >= len(self.grams) else at
        lists = at[self.grams[at] == query[: len(at)]]
        if len(lists) < t:
            return lists[:0]
        sizes = self.end[lists] - self.start[lists]
        lists = lists[np.argsort(-sizes, kind="stable")]
        n_long = min(t - 1, int(t / (PROBE * log2(max(2, sizes.max())) + 1)))
        entries = self.merged(lists[n_long:])
        edge = np.flatnonzero(np.diff(entries, prepend=-1))
        count = np.diff(np.append(edge, len(entries)))
        found = entries[edge]
        need = _ceil(percent * (n + self.sizes[found]), 100 + percent)
        open_ = (count >= need - n_long) & (found < below) & (100 * np.minimum(n, self.sizes[found]) >= percent * np.maximum(n, self.sizes[found]))
        found, count, need = found[open_], count[open_], need[open_]
        step = max(1, 200_000 // max(1, len(found)))
        for k in range(0, n_long, step):
            if not len(found):
                break
            wanted = lists[k : min(k + step, n_long), None] * len(self.sizes) + found
            place = np.minimum(np.searchsorted(self.keyed, wanted), len(self.keyed) - 1)
            count = count + (self.keyed[place] == wanted).sum(axis=0)
            alive = count + max(0, n_long - k - step) >= need
            found, count, need = found[alive], count[alive], need[alive]
        return found


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all linked pairs inside ``left``, or between ``left`` and ``right``."""
    lists = Lists(left)
    queries = left if right is None else right
    found = [lists.holders(q, percent, k if right is None else len(left)) for k, q in enumerate(queries)]
    return np.concatenate(found), np.repeat(np.arange(len(queries)), [len(f) for f in found])


def _block_links(rows: list[tuple], words: int, percent: int) -> list[np.ndarray]:
    """Key, links in copies, and least linked key for each set of one pair of cuts."""
    low, high = rows[0][1], rows[0][2]
    by = {r[4]: r for r in rows}  # repeated rows of one text
    left = [r for r in by.values() if r[3] == low]
    right = [r for r in by.values() if r[3] == high] if low != high else []
    members = left + right
    key, copies = (np.array([m[k] for m in members], "i8") for k in (4, 5))
    if not left or (low != high and not right):
        i = j = np.zeros(0, "i8")
    else:
        sets = [shingles(m[6], words) for m in members]
        i, j = linked(sets[: len(left)], sets[len(left) :] if low != high else None, percent)
        j = j + (len(left) if low != high else 0)
    links = np.zeros(len(members), "i8")
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    rank = np.argsort(key, kind="stable")
    place = np.empty(len(key), "i8")
    place[rank] = np.arange(len(key))
    root = forest(len(key), place[i], place[j])
    return [key, links, key[rank[root[place]]]]


def links(shards: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(key, links, low)`` of every set in every pair of cuts: copies it links with there, and the least key linked."""
    cut = ["root", "low", "high"]
    ordered = shards.repartition(*cut).sortWithinPartitions(*cut, "own", "n", "key").select(*cut, "own", "key", "copies", "text")
    bounded_batches(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            made = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if held and held[0][:3] != row[:3]:
                    made.append(_block_links(held, words, percent))
                    held = []
                held.append(row)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([m[k] for m in made])) for k in range(3)], ["key", "links", "low"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _block_links(held, words, percent)], ["key", "links", "low"])

    return ordered.mapInArrow(run, "key bigint, links bigint, low bigint")


def _lists(early: DataFrame) -> DataFrame:
    """``(gram, part, members)``: who holds an n-gram that several sets hold, ``HOLDERS`` of them in a row; ``members`` are ``(key, n)``."""
    # Most n-grams have one holder, and they go before anything else is done.
    apart = early.selectExpr("gram", "key", "n", "min(key) over (partition by gram) as l", "max(key) over (partition by gram) as h")
    held = apart.filter("l < h").select("gram", "key", "n").distinct()
    at = F.row_number().over(Window.partitionBy("gram").orderBy("key"))
    parts = held.withColumn("part", F.floor((at - 1) / HOLDERS).cast("int"))
    return parts.groupBy("gram", "part").agg(F.collect_list(F.struct("key", "n")).alias("members"))


def _short(lists: DataFrame) -> int:
    """Up to which length lists give pairs, so that there are at most ``PAIRS`` pairs for each holder."""
    sizes = sorted(map(tuple, lists.groupBy(F.size("members"), F.col("part") == 0).count().collect()))
    most, pairs = PAIRS * sum(size * n for size, _, n in sizes), 0
    for size, whole, n in sizes:
        pairs += n * size * (size - 1) // 2 if whole else 0
        if size >= HOLDERS or pairs > most:
            return size - 1
    return HOLDERS - 1


def _pairs(short: DataFrame, percent: int) -> DataFrame:
    """``(a, b, a_n, b_n, both)``: in how many of these lists two sets near enough in size stand together."""
    # Lists with the same least holder meet in a task, where most of their pairs are added up.
    dealt = short.select("members").repartition(F.expr("array_min(members).key"))
    first = dealt.select("members", F.posexplode("members").alias("at", "x"))
    pairs = first.select("x", F.explode(F.expr("slice(members, at + 2, size(members))")).alias("y"))
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).selectExpr("x.key as a", "y.key as b", "x.n as a_n", "y.n as b_n")
    near = pairs.filter(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    return near.groupBy("a", "b", "a_n", "b_n").agg(F.count(F.lit(1)).alias("both"))


def _wanted(n: Column, percent: int, extra: int) -> Column:
    """How many n-grams of its prefix a set of ``n`` must share with any that links, as in ``prefix_sizes``."""
    return F.ceil(F.ceil(n * percent / 100) / extra)


def _in_components(early: DataFrame, late: DataFrame, sizes: DataFrame, percent: int, extra: int) -> DataFrame:
    """``(key, n, root)`` of the sets that can link, ``root`` equal for those that may, directly or over others.

    Linked sets share as many n-grams of their prefixes as each wants. Short lists tell how many two sets share there, and
    long lists and frequent n-grams can add no more than the fewer that one of the two stands in. Sets that share
    nothing in short lists must both stand in as many long ones as they want. Of these sets in a long list, ordered by size, only
    neighbours near enough in size are joined: the sets between two that may link are near enough to their neighbours
    as well. Ranges of the order keep a frequent n-gram out of one task.
    """
    lists = saved(_lists(early), "lists")
    most = _short(lists)
    is_short = (F.col("part") == 0) & (F.size("members") <= most)
    held = lists.select(is_short.alias("short"), F.explode("members").alias("m")).groupBy(F.col("m.key").alias("key"))
    held = held.agg(F.count(F.lit(1)).alias("shared"), F.count_if(~F.col("short")).alias("in_long"))
    counted = sizes.filter("n > 0").join(held, "key", "left").na.fill(0, ["shared", "in_long"])
    alive = counted.filter(F.col("shared") + F.col("n_known") >= _wanted(F.col("n"), percent, extra))
    alive = saved(alive.select("key", "n", (F.col("in_long") + F.col("n_known")).alias("room")), "candidates")

    pairs = _pairs(lists.filter(is_short), percent)
    for end in ("a", "b"):
        pairs = pairs.join(alive.select(F.col("key").alias(end), F.col("room").alias(f"{end}_room")), end)
    may = F.col("both") + F.least("a_room", "b_room") >= _wanted(F.greatest("a_n", "b_n"), percent, extra)
    long = lists.filter(~is_short).select("gram", F.explode("members").alias("m")).select("gram", "m.key")
    strong = alive.filter(F.col("room") >= _wanted(F.col("n"), percent, extra)).select("key", "n")
    rows = slice_groups(long.union(late).join(strong, "key"), ["gram"], ["n", "key"])
    ordered = running(rows, {"b": ("last", F.col("key")), "b_n": ("last", F.col("n"))}, inclusive=False).rows()
    near = ordered.filter((F.col("b") != F.col("key")) & (100 * F.col("b_n") >= percent * F.col("n")))
    star = stars(pairs.filter(may).select("a", "b").union(near.select(F.col("key").alias("a"), "b")).distinct())
    named = star.select(F.col("a").alias("key"), F.col("b").alias("root"))
    return alive.select("key", "n").join(named, "key", "left").withColumn("root", F.coalesce("root", "key"))


def _sieved(rows: DataFrame, keys: DataFrame, bits: int = BITS) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``keys``, and with all that are; ``bits`` is a multiple of 64."""
    words = keys.groupBy(F.expr(f"cast(pmod(key, {bits}) div 64 as int)").alias("s_at"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(key, 64) as int))")).alias("s_word"))
    met = rows.join(F.broadcast(words), F.expr(f"cast(pmod(key, {bits}) div 64 as int)") == F.col("s_at"))
    return met.filter("(shiftright(s_word, cast(pmod(key, 64) as int)) & 1) = 1").drop("s_at", "s_word")


def similar(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT,
    extra: int = EXTRA, block: int = BLOCK, block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)`` for every row of ``docs``.

    ``n_links`` counts the other rows that a row links with, copies included. Null and empty texts, and texts without words,
    have no n-gram, link with nothing and are their own component. Repeated rows stay and link with each other. A null id
    names a component only where there is no other (the component is null). Texts of any length are taken whole. An empty
    table gives no row; other columns are not read. N-grams and texts are told apart by 64-bit hashes.
    """
    told = _told(docs, doc_id, text)
    ids = saved(told.select("id", "key"), "texts")
    sets = saved(ids.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")), "sets")
    once = _one_each(told, sets)
    known = frequent_grams(docs, text, words)
    marks = saved(_marks(once, words, percent, extra, known), "prefixes")

    # Frequent n-grams are shared anyway and do not take part in the lists; of the others no list is very long.
    early = marks.select("key", "n", F.explode(F.expr("slice(prefix, 1, cast(size(prefix) - n_known as int))")).alias("gram"))
    late = marks.filter("n_known > 0").select(F.explode(F.expr("slice(prefix, cast(size(prefix) - n_known + 1 as int), cast(n_known as int))")).alias("gram"), "key").distinct()
    sizes = marks.select("key", "n", "n_known").distinct()
    placed = _in_components(early, late, sizes, percent, extra)
    large = placed.groupBy("root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("grams")).filter("docs > 1")
    large = large.select("root", F.ceil(F.greatest(F.col("docs") / block, F.col("grams") / block_grams)).cast("int").alias("cuts"))
    dealt = placed.join(large, "root").withColumn("own", F.pmod(F.xxhash64("key", F.lit(11)), F.col("cuts")).cast("int"))
    dealt = saved(dealt.join(sets, "key").select("key", "first", "root", "cuts", "own", "copies", "n"), "dealt")

    placed_once = _sieved(once, dealt)
    dealt = dealt.withColumnsRenamed({"key": "d_key", "first": "d_first"})
    texts = placed_once.join(dealt, (F.col("key") == F.col("d_key")) & F.col("id").eqNullSafe(F.col("d_first"))).drop("id", "d_key", "d_first")
    shards = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    shards = shards.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "cuts")
    found = saved(links(shards, words, percent), "links")

    star = stars(found.filter("low <> key").select(F.col("key").alias("a"), F.col("low").alias("b")))
    total = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = sets.join(star.select(F.col("a").alias("key"), F.col("b").alias("root")), "key", "left")
    named = named.withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(least, "root").join(sizes.select("key", "n"), "key").join(total, "key", "left")
    told = named.select("key", "component", "n", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = ids.join(told, "key")
    alone = F.col("n") == 0
    return out.select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("links")).cast("bigint").alias("n_links"),
    )


def op11_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar(table(spark, folder, "documents").select("doc_id", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11_SQL = rf"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS MATERIALIZED (
    SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS g
    FROM words
),
grams AS MATERIALIZED (SELECT rid, len(g) AS n, unnest(g) AS gram FROM sets),
pairs AS MATERIALIZED (
    SELECT x.rid AS a, y.rid AS b FROM grams x JOIN grams y ON x.gram = y.gram AND x.rid <> y.rid
    GROUP BY x.rid, y.rid, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
),
reach AS (SELECT rid AS a, rid AS b FROM sets UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b),
named AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN sets ON rid = b GROUP BY a),
linked AS (SELECT a, count(*) AS n_links FROM pairs GROUP BY a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM sets JOIN named ON named.a = rid LEFT JOIN linked ON linked.a = rid
"""

QUERIES = {"op11_ngram_jaccard_join": op11_ngram_jaccard_join}
SQL = {"op11_ngram_jaccard_join": OP11_SQL}
