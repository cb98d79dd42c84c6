"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints that differ in at most ``radius`` bits agree in all but ``radius`` of any number of bands, so they meet in a
bucket of one of the tables. In a bucket the fingerprints are stored as bit planes, 64 to a word. Carry-save counters add
up the differences of 64 candidates at a time, and a word is given up as soon as all its candidates exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.common import add_columns, saved, table
from rillstone.llm.components import stars

SHINGLE = 4
RADIUS = 4
SEED = 42
# Fingerprints of a bucket that are compared at a time. Larger buckets are cut, and every two cuts meet.
BLOCK = 1024

_BITS = np.array([[b >> k & 1 for k in range(8)] for b in range(256)], "i8")


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit k is set if it is set in over half of the hashes of the word shingles, repeats included; 0 without words."""
    words = (text or b"").lower().split()  # both for ASCII only, as bytes know no others
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(shingle, len(words))
    first = [0, *ends[: len(words) - width].tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s : e - 1], seed) for s, e in zip(first, ends[width - 1 :].tolist())], "<u8")
    octets = hashes.view("u1").reshape(-1, 8)
    bits = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return sum(1 << k for k in np.flatnonzero(2 * bits > len(hashes)).tolist())


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``) with ``_fp``, the fingerprint as a signed integer."""
    raw = docs.withColumn("_raw", F.col(text).cast("binary"))

    def work(texts):
        return [np.array([fingerprint(t, shingle, seed) for t in texts], "u8").view("i8")]

    return add_columns(raw, ["_raw"], "_fp bigint", work, keep=keep if keep is not None else docs.columns)


def bands(n: int, radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the bands: as few as keep the mean bucket of ``n`` fingerprints below a block."""
    count = radius + 1
    while n > BLOCK << (64 * (count - radius) // count) and count < radius + 5:
        count += 1
    cuts = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def tables(bits: list[tuple[int, int]], radius: int) -> list[int]:
    """A mask for each way to choose the bands that agree."""
    whole = [((1 << n) - 1) << s for s, n in bits]
    return [sum(chosen) for chosen in combinations(whole, len(bits) - radius)]


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Plane k holds bit k of all values, 64 values to a word."""
    padded = np.zeros(-(-len(values) // 64) * 64, "<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view("u1").reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int, same_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs at most ``radius`` (under 8) bits apart. The bits ``same_bits`` are known to agree."""
    planes, words = bit_planes(right), -(-len(right) // 64)
    q, w = np.repeat(np.arange(len(left)), words), np.tile(np.arange(words), len(left))
    ones = twos = fours = over = np.zeros(len(q), "u8")
    order = [k for k in range(64) if not same_bits >> k & 1]
    for at in range(0, len(order), 3):
        x, y, z = (
            planes[k][w] ^ np.where(left[q] >> np.uint64(k) & np.uint64(1), _ALL, np.uint64(0)) if k is not None else np.zeros(len(q), "u8")
            for k in (order[at : at + 3] + [None] * 2)[:3]
        )
        total, carry = x ^ y ^ z, (x & y) | (z & (x ^ y))
        ones, t = ones ^ total, ones & total
        twos, carry = twos ^ carry ^ t, (twos & carry) | (t & (twos ^ carry))
        over = over | (fours & carry)
        fours = fours ^ carry
        over = over | _above(radius, ones, twos, fours)
        if at % 6 == 3:
            alive = over != _ALL
            if not alive.all():
                q, w, ones, twos, fours, over = (v[alive] for v in (q, w, ones, twos, fours, over))
            if not len(q):
                break
    near = np.unpackbits((~over).view("u1").reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(near)
    i, j = q[row], w[row] * 64 + lane
    real = j < len(right)
    return i[real], j[real]


def _above(radius: int, ones: np.ndarray, twos: np.ndarray, fours: np.ndarray) -> np.ndarray:
    """Where the three-bit counts exceed the radius."""
    more = np.zeros(len(ones), "u8")
    equal = np.full(len(ones), _ALL)
    for bit, counter in ((4, fours), (2, twos), (1, ones)):
        if radius & bit:
            equal = equal & counter
        else:
            more |= equal & counter
            equal = equal & ~counter
    return more


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least position that each position is linked to, over any number of links."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    while (root != root[root]).any():
        root = root[root]
    return root


def _block_edges(left: np.ndarray, right: np.ndarray | None, radius: int, mask: int) -> list[np.ndarray]:
    """Edges that connect what is linked inside a block, at most one for each fingerprint."""
    own = left if right is None else np.concatenate([left, right])
    i, j = near_pairs(left, left if right is None else right, radius, mask)
    j = j if right is None else j + len(left)
    root = forest(len(own), i, j)
    moved = np.flatnonzero(root != np.arange(len(own)))
    return [own[moved].view("i8"), own[root[moved]].view("i8")]


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that connect all of ``prints.fp`` (distinct) that are linked; not every pair is listed."""
    n = prints.count()
    masks = tables(bands(n, radius), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("t", "key"))
    large = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    cuts = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
    dealt = keyed.join(large, ["t", "key"], "left").select("t", "key", "fp", cuts.alias("cuts"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("cuts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    key = ["t", "key", "low", "high"]
    met = dealt.select("t", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "fp")
    ordered = met.repartition(*[F.col(c) for c in key]).sortWithinPartitions(*key, "own", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        ready: list[list[np.ndarray]] = []

        def close() -> None:
            rows = np.concatenate(held)
            t, low, high, own = rows[0, 0], rows[0, 2], rows[0, 3], rows[:, 4]
            fp = rows[:, 5].view("u8") if rows.flags.c_contiguous else np.ascontiguousarray(rows[:, 5]).view("u8")
            if len(fp) > 1:
                parts = (fp, None) if low == high else (fp[own == low], fp[own == high])
                if low == high or (len(parts[0]) and len(parts[1])):
                    ready.append(_block_edges(*parts, radius, masks[t]))
            held.clear()

        for batch in batches:
            rows = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False).astype("i8") for k in range(6)])
            if not len(rows):
                continue
            starts = [0, *(np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1).tolist(), len(rows)]
            for s, e in zip(starts, starts[1:]):
                if held and (held[-1][-1, :4] != rows[s, :4]).any():
                    close()
                held.append(rows[s:e])
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([r[k] for r in ready])) for k in (0, 1)], ["a", "b"])
                ready.clear()
        if held:
            close()
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([r[k] for r in ready])) for k in (0, 1)], ["a", "b"])

    return ordered.select(*key, "own", "fp").mapInArrow(run, "a bigint, b bigint")


def components(marked: DataFrame, doc_id: str = "doc_id", radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(_fp, root, least)`` for each different fingerprint of ``marked``: its component, and its least id, nulls last."""
    first = F.min(F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id")))
    prints = marked.groupBy(F.col("_fp").alias("fp")).agg(first.alias("least"))
    star = stars(links(prints.select("fp"), radius, block)).withColumnsRenamed({"a": "fp", "b": "root"})
    return prints.join(star, "fp", "left").select(F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("root"), "least")


def classes(marked: DataFrame, doc_id: str = "doc_id", radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(_fp, component_id)`` for each different fingerprint of ``marked``; the id is the least reachable ``doc_id``."""
    roots = components(marked, doc_id, radius, block)
    least = roots.groupBy("root").agg(F.min("least")["id"].alias("component_id"))
    return roots.join(least, "root").select("_fp", "component_id")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Null and empty texts have the fingerprint nought and are linked like any other. Repeated rows stay, a null id never
    names a component unless it has no other id (then the component is null). An empty table gives no row.
    """
    marked = saved(fingerprints(docs, text, shingle, keep=[doc_id]), "fingerprints")
    named = marked.join(classes(marked, doc_id, radius, block), "_fp")
    return named.select(doc_id, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with its columns as they were: the least id, then fingerprint, then text; null ids last."""
    named = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)])
    own_id, own_text = (f"_{docs.columns.index(c)}" for c in (doc_id, text))
    marked = saved(fingerprints(named, own_text, shingle), "fingerprints")
    chosen = components(marked, own_id, radius).groupBy("root").agg(F.min(F.struct("least", "_fp")).alias("c"))
    chosen = chosen.select(F.col("c")["_fp"].alias("c_fp"), F.col("c")["least"]["id"].alias("c_id"))
    own = marked.join(chosen, (F.col("_fp") == F.col("c_fp")) & F.col(own_id).eqNullSafe(F.col("c_id")), "left_semi")
    first = Window.partitionBy("_fp", own_id).orderBy(F.col(own_text).asc_nulls_last())
    kept = own.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return kept.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def op8_bit_sliced_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {"op8_bit_sliced_simhash": op8_bit_sliced_simhash}
SQL: dict[str, str] = {}
