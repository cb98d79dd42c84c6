import random
import re

import numpy as np
import pytest
import xxhash

from rillstone.llm import components, simhash
from rillstone.llm.common import table


def slow_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [words[i : i + 4] for i in range(len(words) - 3)] or [words]
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def slow_classes(prints, radius=4):
    """From (id, fingerprint) pairs."""
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array([p for _, p in prints], "u8")
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= radius).tolist():
            a, b = top(i), top(j)
            parent[max(a, b)] = min(a, b)
    groups = {}
    for k, (i, _) in enumerate(prints):
        groups.setdefault(top(k), []).append(i)
    least = {t: min((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return [least[top(k)] for k in range(len(prints))]


def same(df, docs):
    prints = [(i, slow_print(t)) for i, t in docs]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, slow_classes(prints))]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_whole_table(spark, folder):
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    same(simhash.op8_bit_sliced_simhash(spark, folder), docs)


def test_edges(spark):
    docs = [(5, None), (4, ""), (3, " \n"), (None, "x y"), (None, "x Y"), (9, "a b c d"), (9, "a b c d"), (7, "Ünïç ÀB " * 3000), (8, "ünïç Àb " * 3000)]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in docs], "doc_id long, text string, fingerprint string, own int")
    same(simhash.near_duplicates(df), docs)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    top = dict(zip(range(len(docs)), slow_classes([(i, slow_print(t)) for i, (_, t) in enumerate(docs)])))
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        str(min((docs[k][0] for k in top if top[k] == t and docs[k][0] is not None), default=None)) for t in set(top.values())
    )


@pytest.mark.parametrize("radius", [1, 3, 4, 5, 7])
def test_pairs_of_blocks(radius):
    r = np.random.default_rng(radius)
    left = r.integers(0, 1 << 63, 150, dtype="u8") << np.uint64(1)
    right = left[r.integers(0, 150, 200)].copy()
    for k in range(200):
        for bit in r.integers(0, 64, k % 9):
            right[k] ^= np.uint64(1) << np.uint64(bit)
    i, j = simhash.near_pairs(left, right, radius, 0)
    want = {(a, b) for a in range(150) for b in range(200) if int(left[a] ^ right[b]).bit_count() <= radius}
    assert set(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("block", [64, 1024])
def test_links_in_large_buckets(spark, block):
    """Many fingerprints around few centres fill single buckets; chains reach further than the radius."""
    r = random.Random(3)
    values = {0}
    for _ in range(3):
        c = r.getrandbits(64)
        for _ in range(200):
            for bit in r.sample(range(64), r.randint(0, 3)):
                c ^= 1 << bit
            values.add(c)
    values |= {r.getrandbits(64) for _ in range(100)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    marked = spark.createDataFrame(list(enumerate(signed)), "doc_id long, _fp long")
    got = {r._fp: r.component_id for r in simhash.classes(marked, block=block).collect()}
    assert [got[v] for v in signed] == slow_classes(list(enumerate(values)))


@pytest.mark.parametrize("n", [0, 10**5, 10**8, 10**10])
def test_tables_miss_no_pair_within_the_radius(n):
    masks = simhash.tables(simhash.bands(n, 4), 4)
    r = random.Random(n)
    for _ in range(2000):
        difference = sum(1 << b for b in r.sample(range(64), 4))
        assert any(not difference & m for m in masks)


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 300)] + [(7, i) for i in range(400, 900)] + [(5, 5), (None, 3), (1, 2), (2, 1)]
    star = dict(map(tuple, components.stars(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 100 for i in range(101, 301)} | {i: 7 for i in range(400, 900)} | {2: 1}
    assert star == want
