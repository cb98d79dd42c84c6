"""Phrase collocations counted through a prefix-free parse.

A text is a sequence of words and breaks. Wherever the hash of ``longest - 1`` neighbouring symbols falls on a multiple of
``MODULUS`` a chunk ends and the next one begins, sharing these symbols. Equal passages are cut alike wherever they stand,
so that a dictionary of distinct chunks and their frequencies stands for the corpus. Phrases are counted once per distinct
chunk, weighted by its frequency; one that begins in the shared symbols belongs to the later chunk alone.

A phrase is never more frequent than its parts. Words, then pairs, then longer phrases are counted in passes over the
dictionary, and each pass leaves out what a bitmap of the parts found so far rules out. A bitmap has a fixed size and only
false positives, so counts are exact: what passes is counted by its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.common import bounded_batches, saved, table

LONGEST = 3
LEAST = 10
# Percent of a phrase's occurrences that lie in one longer phrase, from which on the longer one stands for it.
COVERED = 50
TOP = 2000
# A chunk has so many symbols of its own on average.
MODULUS = 32
# Bits of the bitmap that rules phrases out; 8 MB, whatever the size of the corpus.
BITS = 1 << 26
# Symbols that a task holds at a time.
HELD = 1 << 20

BREAK = "\n"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _symbols(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words and breaks of all texts in one array, and how many each text has."""
    low = pc.ascii_lower(texts)
    broken = pc.replace_substring_regex(low, r"[\x20\x09]*[.,;:!?\x0A-\x0D][\x20\x09.,;:!?\x0A-\x0D]*", " \n ")
    even = pc.utf8_trim(pc.replace_substring_regex(broken, r"[\x20\x09]+", " "), " \n")
    parts = pc.split_pattern(even, " ")
    sizes = np.where(pc.equal(even, "").to_numpy(zero_copy_only=False), 0, np.diff(parts.offsets.to_numpy()))
    flat = parts.flatten()
    return flat.filter(pc.not_equal(flat, "")), sizes


def _hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()], "u8")


def _joined(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A hash of a sequence and one more symbol."""
    x = (h * _MIX) ^ (more + (h >> np.uint64(29)))
    return x * _MIX ^ (x >> np.uint64(32))


def _cut(texts: pa.Array, shared: int, modulus: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(chunk, whether it ends in symbols of the next one, number of its text) for all texts."""
    flat, sizes = _symbols(texts)
    if not len(flat):
        return pa.array([], pa.string()), np.zeros(0, bool), np.zeros(0, "i8")
    encoded = flat.dictionary_encode()
    codes = encoded.indices.to_numpy()
    own = _hashes(encoded.dictionary)[codes]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n = len(codes)
    window = own.copy()
    for k in range(1, shared):
        window[: n - k] = _joined(window[: n - k], own[k:])
    first = np.ones(n, bool)
    first[1:] = owner[1:] != owner[:-1]
    whole = np.zeros(n, bool)
    if n >= shared:
        whole[: n - shared + 1] = owner[: n - shared + 1] == owner[shared - 1 :]
    starts = np.flatnonzero(first | (whole & (window % np.uint64(modulus) == 0)))
    following = np.append(starts[1:], n)
    closed = np.append(~first[starts[1:]], False)
    ends = following + np.where(closed, shared, 0)
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, lengths)
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), flat.take(pa.array(at)))
    return pc.binary_join(lists, " "), closed, owner[starts]


def parse(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, modulus: int = MODULUS) -> DataFrame:
    """The dictionary of ``docs``: ``(lang, chunk, closed, times)``.

    The symbols of a chunk are joined by spaces, a break is a line feed. A closed chunk ends in ``longest - 1`` symbols
    with which the next one begins.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks, closed, owner = _cut(batch.column(1), longest - 1, modulus)
            if len(chunks):
                langs = batch.column(0).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([langs, chunks.cast(pa.string()), pa.array(closed)], ["lang", "chunk", "closed"])

    read = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    chunks = read.mapInArrow(run, "lang string, chunk string, closed boolean")
    return chunks.groupBy("lang", "chunk", "closed").agg(F.count(F.lit(1)).alias("times"))


class Grams:
    """All phrases that begin in the own part of a batch of chunks, grown by a word at a time."""

    def __init__(self, langs: pa.Array, chunks: pa.Array, closed: np.ndarray, times: np.ndarray, shared: int):
        parts = pc.split_pattern(chunks, " ")
        sizes = np.diff(parts.offsets.to_numpy())
        words, language = parts.flatten().dictionary_encode(), langs.dictionary_encode()
        self.words, self.langs = words.dictionary, language.dictionary
        self.codes = words.indices.to_numpy().astype("i8")
        self.tongue = np.repeat(language.indices.to_numpy().astype("i8"), sizes)
        self.weight = np.repeat(times, sizes)
        self.end = np.repeat(np.cumsum(sizes), sizes)
        own_end = self.end - np.repeat(np.where(closed, shared, 0), sizes)
        self.word = np.append(~pc.equal(self.words, BREAK).to_numpy(zero_copy_only=False)[self.codes], False)
        spelled = _hashes(self.words)
        self.spelled = np.append(spelled[self.codes], np.uint64(0))
        self.at = np.flatnonzero((np.arange(len(self.codes)) < own_end) & self.word[:-1])
        self.size = 1
        self.ids = self.tongue[self.at] * len(self.words) + self.codes[self.at]
        self.hash = _joined(_hashes(self.langs)[self.tongue[self.at]], self.spelled[self.at])

    def keep(self, which: np.ndarray) -> None:
        self.at, self.ids, self.hash = self.at[which], self.ids[which], self.hash[which]

    def grow(self) -> None:
        """Phrases of one more word; those at a break or at the end of their chunk are gone."""
        nxt = self.at + self.size
        self.keep((nxt < self.end[self.at]) & self.word[np.minimum(nxt, len(self.word) - 1)])
        nxt = self.at + self.size
        _, ids = np.unique(self.ids, return_inverse=True)
        self.ids = ids * len(self.words) + self.codes[nxt]
        self.hash = _joined(self.hash, self.spelled[nxt])
        self.size += 1

    def tail_hash(self) -> np.ndarray:
        """The hash of each phrase without its first word, as that phrase alone would have it."""
        h = _joined(_hashes(self.langs)[self.tongue[self.at]], self.spelled[self.at + 1])
        for k in range(2, self.size):
            h = _joined(h, self.spelled[self.at + k])
        return h

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Position of one occurrence of each phrase, and its frequency."""
        _, first, number = np.unique(self.ids, return_index=True, return_inverse=True)
        total = np.zeros(len(first), "i8")
        np.add.at(total, number, self.weight[self.at])
        return first, total

    def spelled_out(self, first: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Language and text of the phrases at these positions."""
        at = self.at[first]
        words = [self.words.take(pa.array(self.codes[at + k])) for k in range(self.size)]
        text = pc.binary_join_element_wise(*words, " ") if self.size > 1 else words[0]
        return self.langs.take(pa.array(self.tongue[at])), text


def _over(dictionary: DataFrame, longest: int, schema: str, work: Callable[[Grams], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``work`` over the chunks, so many at a time that a task holds about ``HELD`` symbols."""
    bounded_batches(dictionary.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            closed, times = (whole.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            yield from work(Grams(whole.column(0), whole.column(1), closed, times, longest - 1))

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.column(1).nbytes // 6
                if size >= HELD:
                    yield from close()
                    held.clear()
                    size = 0
        if held:
            yield from close()

    return dictionary.select("lang", "chunk", "closed", "times").mapInArrow(run, schema)


def _sieve(frequent: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the hashes ``frequent.h``; at most ``bits / 64`` rows reach the driver."""
    slot = F.pmod(F.col("h"), F.lit(bits))
    words = frequent.groupBy((slot / 64).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(h, {bits}) % 64 as int))")).alias("word"))
    got = words.toArrow()
    out = np.zeros(bits // 64, "u8")
    out[got["at"].to_numpy()] = got["word"].to_numpy().view("u8")
    return out


def _passes(sieve: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h % np.uint64(len(sieve) * 64)
    return (sieve[(slot >> np.uint64(6)).astype("i8")] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _positive(h: np.ndarray) -> np.ndarray:
    """The hash without its highest bit, so that signed and unsigned remainders agree."""
    return h & np.uint64(0x7FFFFFFFFFFFFFFF)


def frequencies(dictionary: DataFrame, longest: int = LONGEST, least: int = LEAST, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``(words, phrases)``: ``(lang, phrase, f)`` of every word, and ``(lang, phrase, size, f)`` of every phrase of 2 to
    ``longest`` words that occurs ``least`` times or more."""

    def words(grams: Grams) -> Iterator[pa.RecordBatch]:
        first, total = grams.counted()
        yield pa.RecordBatch.from_arrays([*grams.spelled_out(first), pa.array(_positive(grams.hash[first]).view("i8")), pa.array(total)], ["lang", "phrase", "h", "f"])

    found = _over(dictionary, longest, "lang string, phrase string, h bigint, f bigint", words)
    single = saved(found.groupBy("lang", "phrase", "h").agg(F.sum("f").alias("f")), "words")
    sieves = [_sieve(single.filter(F.col("f") >= least), bits)]

    def sifted(grams: Grams, size: int) -> None:
        """Grow to ``size`` words; both parts of one word less must have passed."""
        while grams.size < size:
            grams.keep(_passes(sieves[grams.size - 1], _positive(grams.hash)))
            grams.grow()
            grams.keep(_passes(sieves[grams.size - 2], _positive(grams.tail_hash())))

    def hashed(size: int) -> Callable[[Grams], Iterator[pa.RecordBatch]]:
        def work(grams: Grams) -> Iterator[pa.RecordBatch]:
            sifted(grams, size)
            first, total = grams.counted()
            yield pa.RecordBatch.from_arrays([pa.array(_positive(grams.hash[first]).view("i8")), pa.array(total)], ["h", "f"])

        return work

    for size in range(2, longest):
        counts = _over(dictionary, longest, "h bigint, f bigint", hashed(size)).groupBy("h").agg(F.sum("f").alias("f"))
        sieves.append(_sieve(counts.filter(F.col("f") >= least), bits))

    def phrases(grams: Grams) -> Iterator[pa.RecordBatch]:
        for size in range(2, longest + 1):
            sifted(grams, size)
            if size < longest:
                grams.keep(_passes(sieves[size - 1], _positive(grams.hash)))
            first, total = grams.counted()
            yield pa.RecordBatch.from_arrays([*grams.spelled_out(first), pa.array(np.full(len(first), size, "i4")), pa.array(total)], ["lang", "phrase", "size", "f"])

    found = _over(dictionary, longest, "lang string, phrase string, size int, f bigint", phrases)
    many = found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return single.drop("h"), saved(many, "phrases")


def _part(first: int | Column, size: Column) -> Column:
    return F.array_join(F.slice("w", first, size), " ")


def scores(words: DataFrame, phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``phrases`` with ``a, l, r`` and ``score`` of their worst cut."""
    known = words.select("lang", F.col("phrase").alias("part"), F.col("f").alias("of")).union(phrases.select("lang", "phrase", "f"))
    split = phrases.select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))
    cuts = split.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = [F.struct(F.lit(0).alias("side"), _part(1, F.col("k")).alias("part")), F.struct(F.lit(1).alias("side"), _part(F.col("k") + 1, F.col("size")).alias("part"))]
    parts = cuts.select("lang", "phrase", "size", "a", "k", F.inline(F.array(*sides)))
    told = parts.join(known, ["lang", "part"]).groupBy("lang", "phrase", "size", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("of"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("of"))).alias("r")
    )
    # Decimals of 38 digits hold 10^6 a^2 up to a = 10^16, and div cuts them without rounding.
    exact = F.expr("(cast(1000000 as decimal(7,0)) * (cast(a as decimal(19,0)) * cast(a as decimal(19,0)))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    worst = told.withColumn("score", exact.cast("bigint")).groupBy("lang", "phrase", "size", "a")
    return worst.agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "size", "a", "c.l", "c.r", "c.score")


def without_covered(scored: DataFrame, phrases: DataFrame, longest: int = LONGEST, covered: int = COVERED) -> DataFrame:
    """``scored`` without phrases that mostly occur inside one longer phrase."""
    long = phrases.filter(F.col("size") > 2).select("lang", "size", "f", F.split("phrase", " ", -1).alias("w"))
    spans = [F.struct(F.lit(s).alias("at"), F.lit(n).alias("n")) for n in range(2, longest) for s in range(1, longest - n + 2)]
    if not spans:
        return scored
    inner = long.select("*", F.inline(F.array(*spans))).filter(F.col("at") + F.col("n") - 1 <= F.col("size")).filter(F.col("n") < F.col("size"))
    most = inner.select("lang", _part(F.col("at"), F.col("n")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
    joined = scored.join(most, ["lang", "phrase"], "left")
    return joined.filter(F.expr(f"coalesce(100 * _longer < {covered} * a, true)")).drop("_longer")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, covered: int = COVERED,
    top: int = TOP, modulus: int = MODULUS, bits: int = BITS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of every language.

    Null texts are empty, a null language is ``und``; empty texts and an empty table give no row. Repeated rows count
    again. Long texts are cut into chunks like any other and a text without triggers is one chunk. Ties go by frequency,
    then by the bytes of the phrase. Other columns are not read.
    """
    dictionary = saved(parse(docs, text, lang, longest, modulus), "chunks")
    words, phrases = frequencies(dictionary, longest, least, bits)
    best = without_covered(scores(words, phrases, longest), phrases, longest, covered)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents").select("text", "lang"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP13_SQL = rf"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)
),
grams AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
    FROM pieces, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size
),
counts AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10),
parts AS (
    SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1 :], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
),
left_parts AS MATERIALIZED (SELECT p.*, x.f AS l FROM parts p JOIN counts x ON x.lang = p.lang AND x.phrase = p.first),
cuts AS (
    SELECT p.*, y.f AS r, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * y.f) AS score
    FROM left_parts p JOIN counts y ON y.lang = p.lang AND y.phrase = p.rest
),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
    SELECT lang, inner_phrase, max(a) AS most
    FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS inner_phrase FROM candidates WHERE size = 3)
    GROUP BY ALL
),
ranked AS (
    SELECT t.*, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, encode(t.phrase)) AS rank
    FROM worst t LEFT JOIN longer o ON o.lang = t.lang AND o.inner_phrase = t.phrase
    WHERE coalesce(100 * most < 50 * a, true)
)
SELECT k.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked k JOIN (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang) t ON t.lang = k.lang
WHERE rank <= 2000
"""

QUERIES = {"op13_phrase_collocations": op13_phrase_collocations}
SQL = {"op13_phrase_collocations": OP13_SQL}
