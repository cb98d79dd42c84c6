"""Quality rules: surface rules, then a log-likelihood ratio of hashed n-grams.

The n-grams are all character trigrams of the text, inside words and where they meet, its white space taken as single
spaces. They are hashed into buckets. Two multinomials over the buckets are counted, one over the whole corpus and one over
its trusted documents. The trusted one backs off to the classes of the characters (capital, letter, digit, punctuation,
symbol, space): a trigram that no trusted document holds speaks against a text mostly by its class, so letters of a language
without labels say little and symbols inside words much. A document's score is the mean log ratio of its trigrams; those
below a fixed threshold are rejected. Ratios are rounded to integers, so that sums do not depend on the order of addition.

A text is a list of tokens, words with a space on each side and what meets between two words, and each trigram lies in
exactly one of them. Trigrams are counted over different tokens, and the sums of frequent ones are known when texts are scored.
Both passes deal texts into rows of one word and the next, which Spark compiles, and add up before they shuffle: what moves
is a row for each different token and one for each text, never a text, and what reaches the driver has a fixed size. The ids of trusted documents are sent to all tasks up
to a stated number; beyond it texts are joined with them in a shuffle.

Only DataFrame functions are used.
"""

from __future__ import annotations

import json
from math import exp, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import saved, table, with_fixed

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
BUCKETS = 1 << 16
KNOWN = 1 << 19  # slots for frequent tokens, 8 MB that all tasks get
SENT_IDS = 1 << 20  # trusted ids that are sent to all tasks, 8 MB of long ones
SCALE = 1 << 20
THRESHOLD = -0.5
SMOOTHING = 5
LEAST = log(1 / 200)  # no ratio of counts falls lower, however large the corpus
MASS = 2.0  # weight of a trigram's class, as a share of its expected count
# Later patterns leave the names of earlier classes alone.
CLASSES = (
    (r"[#*$%&|<>]|[^\p{L}\p{M}\p{N}\p{P} ]", "#"), (r"[\p{P}&&[^#]]", "."), (r"\p{Lu}", "A"), (r"[\p{L}\p{M}&&[^A]]", "a"), (r"\p{N}", "0"),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def windows_of(words: Column) -> Column:
    """A 64-bit hash of each three-word window."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )


def repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur more than once."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twins = _let(
        placed,
        lambda s: F.filter(s, lambda e, k: (e["h"] == F.get(s, k + 1)["h"]) | (e["h"] == F.get(s, k - 1)["h"])),
    )
    places = F.sort_array(F.transform(twins, lambda e: e["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        places,
        start,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _in_pairs(docs: DataFrame, text: str, *keep: Column) -> DataFrame:
    """A row ``(w, nxt)`` for each word and the one after it, null after the last."""
    fixed = with_fixed(docs.select(*keep, F.col(text).alias("_text")), "_words", words_of(F.col("_text"))).drop("_text")
    others = [c for c in fixed.columns if c != "_words"]
    following = F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1)))
    return fixed.select(*others, F.inline(F.arrays_zip(F.col("_words").alias("w"), following.alias("nxt"))))


def _inside() -> Column:
    return F.concat(F.lit(" "), F.col("w"), F.lit(" "))


def _meet() -> Column:
    """The last and first character around the space after the word; null after the last word."""
    return F.concat(F.substring("w", -1, 1), F.lit(" "), F.substring("nxt", 1, 1))


def _starts() -> Column:
    """Where the trigrams of ``token`` begin."""
    return F.sequence(F.lit(1), F.length("token") - 2)


def _gram() -> Column:
    return F.substr(F.col("token"), F.col("i"), F.lit(3))


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def classes_of(token: Column) -> Column:
    """The token with each character replaced by its class."""
    for pattern, name in CLASSES:
        token = F.regexp_replace(token, pattern, name)
    return token


class Ratios(list):
    """Rounded log ratio of each bucket; ``frequent`` is a table ``(f_h, f_sum)`` of hashes of frequent tokens and the sums of
    their ratios, at most ``KNOWN`` rows, or nothing. It changes no result."""

    frequent: DataFrame | list = []
    _table: DataFrame | None = None

    def weigh(self, rows: DataFrame, bucket: Column, name: str) -> DataFrame:
        """``rows`` with the ratio of a bucket, null for none. The buckets are a small table that is sent to all tasks; as a
        literal they would fill the texts of all plans."""
        if self._table is None:
            listed = F.posexplode(F.from_json(F.lit(json.dumps(self)), "array<bigint>")).alias("_k", "_w")
            self._table = saved(rows.sparkSession.range(1).select(listed), "ratios")
        known = F.broadcast(self._table.withColumnRenamed("_w", name))
        return rows.withColumn("_b", bucket).join(known, F.col("_b") == F.col("_k"), "left").drop("_b", "_k")


def bucket_ratios(
    docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS
) -> Ratios:
    """Rounded log ratio of each bucket, trusted documents against all; ``buckets`` numbers whatever the corpus holds.

    ``trusted`` has the ids of the trusted documents in its first column. All documents are counted.
    """
    marked = trusted.select(F.col(trusted.columns[0]).alias("_t_id")).filter("_t_id IS NOT NULL").distinct()
    marked = saved(marked.withColumn("_trusted", F.lit(1)), "trusted")
    marked = F.broadcast(marked) if marked.count() <= SENT_IDS else marked.hint("shuffle_hash")
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    joined = texts.join(marked, F.col("_id") == F.col("_t_id"), "left")
    pairs = _in_pairs(joined, "_text", F.col("_trusted"))
    tally = [F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("own")]
    words = pairs.groupBy("w").agg(*tally).select(_inside().alias("token"), "raw", "own")
    borders = pairs.filter("nxt IS NOT NULL").groupBy(F.substring("w", -1, 1).alias("w"), F.substring("nxt", 1, 1).alias("nxt")).agg(*tally)
    each = saved(words.unionByName(borders.select(_meet().alias("token"), "raw", "own")), "tokens")
    grams = each.select("raw", "own", "token", F.explode(_starts()).alias("i")).groupBy(_gram().alias("g"))
    grams = grams.agg(F.sum("raw").alias("raw"), F.sum("own").alias("own"))
    counts = grams.groupBy(bucket_of(F.col("g"), buckets).alias("b"), classes_of(F.col("g")).alias("c"))
    counts = counts.agg(F.sum("raw").alias("raw"), F.sum("own").alias("own")).collect()
    out = Ratios(backed_off(sorted(map(tuple, counts)), buckets))
    # Tokens of ordinary length only, one for each slot.
    slots = each.filter(F.length("token") <= 64).groupBy(F.pmod(F.xxhash64("token"), F.lit(KNOWN)).alias("slot"))
    spread = slots.agg(F.max_by("token", "raw").alias("token")).select("token", F.explode(_starts()).alias("i"))
    weighed = out.weigh(spread, bucket_of(_gram(), buckets), "w")
    out.frequent = saved(weighed.groupBy(F.xxhash64("token").alias("f_h")).agg(F.sum("w").alias("f_sum")), "frequent")
    return out


def backed_off(counts: list[tuple[int, str, int, int]], buckets: int) -> list[int]:
    """``ratios`` of buckets from (bucket, class, raw, own), with the ratio of the classes in it as what is expected of a
    bucket: their mean by raw count. It weighs ``MASS`` times the expected count, whatever the size of the corpus."""
    raw, own, back = [0] * buckets, [0] * buckets, [0.0] * buckets
    places = {c: i for i, c in enumerate(sorted({c for _, c, _, _ in counts}))}
    many, trusted = [0] * len(places), [0] * len(places)
    for b, c, r, t in counts:
        raw[b], own[b] = raw[b] + r, own[b] + t
        many[places[c]], trusted[places[c]] = many[places[c]] + r, trusted[places[c]] + t
    if not any(own):
        return [0] * buckets
    of_class = [exp(w / SCALE) for w in ratios(many, trusted)]
    for b, c, r, _ in counts:
        back[b] += r * of_class[places[c]]
    share = sum(own) / sum(raw)
    # raw * share is the expected count, back * share what the classes make of it
    return [round(SCALE * log((t + MASS * k * share) / ((1 + MASS) * r * share))) if r else 0 for r, t, k in zip(raw, own, back)]


def ratios(raw: list[int], own: list[int]) -> list[int]:
    """Log of what the trusted documents hold of each bucket over what they would hold if they were like all; both plus
    ``SMOOTHING``, so that rare buckets say little, and never below ``LEAST``."""
    if not any(own):
        return [0] * len(raw)  # nothing is trusted, so nothing is told apart
    share = sum(own) / sum(raw)
    return [round(SCALE * max(LEAST, log((t + SMOOTHING) / (r * share + SMOOTHING)))) for r, t in zip(raw, own)]


def totals(docs: DataFrame, weights: Ratios, text: str = "text") -> DataFrame:
    """``(_key, _total, _grams, _copies)`` for each different text with words: the sum of its log ratios and the number of its
    trigrams, over all of its rows, and how many these are."""
    none = docs.sparkSession.createDataFrame([], "f_h bigint, f_sum bigint")
    frequent = F.broadcast(weights.frequent if isinstance(weights.frequent, DataFrame) else none)  # at most KNOWN rows
    pairs = _in_pairs(docs, text, F.xxhash64(text).alias("_key"))
    pairs = pairs.select("_key", _inside().alias("token"), _meet().alias("meet")).withColumn("h", F.xxhash64("token"))
    pairs = weights.weigh(pairs, F.when(F.col("meet").isNotNull(), bucket_of(F.col("meet"), len(weights))), "after")
    met = pairs.join(frequent, F.col("h") == F.col("f_h"), "left")
    # A frequent token is one row, any other one a row for each trigram; the first one of a token also counts what follows.
    rows = met.select("_key", "token", "after", "f_sum", F.explode(F.when(F.col("f_h").isNotNull(), F.array(F.lit(0))).otherwise(_starts())).alias("i"))
    rows = weights.weigh(rows, F.when(F.col("i") > 0, bucket_of(_gram(), len(weights))), "inside")
    once, follows = F.col("i") <= 1, F.col("after").isNotNull()
    size = F.length("token") - 2 + F.when(follows, 1).otherwise(0)
    return rows.groupBy("_key").agg(
        F.sum(F.coalesce("inside", "f_sum") + F.when(once & follows, F.col("after")).otherwise(0)).alias("_total"),
        F.sum(F.when(once, size).otherwise(0).cast("bigint")).alias("_grams"),
        F.sum(F.when(once & ~follows, 1).otherwise(0)).alias("_copies"),
    )


def judge(docs: DataFrame, weights: Ratios, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the surface counts, ``base_failed``, ``score`` and ``kept``; whole texts.

    A null or empty text has no words and fails. Repeated rows are judged alike, columns that already have one of the new
    names are replaced, an empty table gives an empty one. A mean ratio of exactly the threshold is kept. Scores meet the
    rows by a hash of the text, so a column that is not used later does not move.
    """
    words = F.col("_words")
    helpers = ["_s_key", "_sum", "_of", "_copies", "_key", "_windows"]
    scored = totals(docs, weights, text).withColumnsRenamed({"_total": "_sum", "_key": "_s_key", "_grams": "_of"})
    out = with_fixed(docs.drop("_words", *helpers), "_words", words_of(F.col(text)))
    out = with_fixed(out, "_windows", windows_of(words))
    out = out.withColumns(
        {
            "_key": F.xxhash64(text),
            "n_words": F.size(words).cast("bigint"),
            "n_symbols": F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(f"[{SYMBOLS}]")).cast("bigint"),
            "n_dup_lines": repeated_lines(F.col(text)).cast("bigint"),
            "n_repeat_words": repeated_words(F.col("_windows")).cast("bigint"),
        }
    ).drop("_words", "_windows")
    out = out.join(scored, F.col("_key") == F.col("_s_key"), "left")
    # Equal texts have added up; each has its even share. All trigrams but one for each space between words begin at a letter.
    total, grams = (F.coalesce(F.expr(f"{c} div _copies"), F.lit(0)) for c in ("_sum", "_of"))
    out = out.withColumn("word_chars", F.when(F.col("n_words") > 0, grams - F.col("n_words") + 1).otherwise(0)).select("*", total.alias("_t"))
    grams = F.greatest(grams, F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    least = F.lit(round(threshold * SCALE)) * grams
    out = out.withColumns({"base_failed": failed, "score": F.col("_t") / (grams * SCALE), "kept": ~failed & (F.col("_t") >= least)})
    return out.drop("_t", *helpers)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.filter("quality = 1").select("doc_id")


def kept_documents(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass, with their columns as they were."""
    named = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)])
    own = f"_{docs.columns.index(text)}"
    judged = judge(named, bucket_ratios(docs, trusted, doc_id, text), own).filter("kept")
    return judged.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def op2_likelihood_ratio(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return saved(judge(docs, bucket_ratios(docs, trusted_ids(table(spark, folder, "labels")))).drop("text"), "judged")


QUERIES = {"op2_likelihood_ratio": op2_likelihood_ratio}
SQL: dict[str, str] = {}
