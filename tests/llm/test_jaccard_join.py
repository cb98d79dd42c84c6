import random
import re

import numpy as np
import pytest

from rillstone.llm import jaccard_join as jj
from verification.check import compare


def slow_sets(texts, words=5):
    out = []
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    return out


def slow(docs, words=5, percent=80):
    """From (id, text) pairs."""
    sets = slow_sets([t for _, t in docs], words)
    near = [[] for _ in docs]
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                near[i].append(j)
                near[j].append(i)
    rows, seen = [None] * len(docs), set()
    for i in range(len(docs)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            new = [k for k in near[todo.pop()] if k not in group]
            group.update(new)
            todo += new
        seen |= group
        least = min((docs[k][0] for k in group if docs[k][0] is not None), default=None)
        for k in group:
            rows[k] = (docs[k][0], len(sets[k]), least, len(near[k]))
    return sorted(rows, key=str)


def changed(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"q{rng.random():.8f}"
    return out


def made(seed, families=12, copies=9):
    """Near copies around the threshold, exact copies, boilerplate and short texts."""
    rng = random.Random(seed)
    line = [f"common{i}" for i in range(14)]
    docs = []
    for f in range(families):
        base = [f"w{rng.randrange(30000)}" for _ in range(rng.choice([3, 5, 6, 30, 80, 200]))]
        for _ in range(rng.randint(1, copies)):
            words = changed(rng, base, rng.randint(0, max(1, len(base) // 20)))
            docs.append(" ".join((line if rng.random() < 0.5 else []) + words))
    docs += [docs[0]] * 3 + [docs[1].upper(), "", " \t\n", None, "a b c", "A b  c", "a b c d"]
    rng.shuffle(docs)
    return [(k, t) for k, t in enumerate(docs)]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("percent, block, extra, frequent", [(80, 1024, 20, 8), (80, 4, 3, 1), (60, 1024, 20, 8)])
def test_against_all_pairs(spark, monkeypatch, percent, block, extra, frequent):
    monkeypatch.setattr(jj, "SAMPLE", 2)
    monkeypatch.setattr(jj, "FREQUENT", frequent)
    docs = made(percent + block)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert got(jj.similar(df, percent=percent, block=block, extra=extra)) == slow(docs, percent=percent)


def test_search_against_all_pairs():
    rng = np.random.default_rng(5)
    for _ in range(40):
        base = rng.integers(0, 400, rng.integers(1, 60))
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(1, len(base) + 1)), base[: rng.integers(0, len(base) + 1)]])).astype("u8") for _ in range(25)]
        near = lambda x, y: 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))
        i, j = jj.linked(sets, None)
        assert sorted(zip(i, j)) == [(a, b) for a in range(25) for b in range(a + 1, 25) if near(sets[a], sets[b])]
        i, j = jj.linked(sets[:10], sets[10:])
        assert sorted(zip(i, j)) == [(a, b) for a in range(10) for b in range(15) if near(sets[a], sets[10 + b])]


def test_prefixes_keep_every_link():
    """Whatever the order, linked sets share as much of their prefixes as is asked of each."""
    rng = random.Random(1)
    for _ in range(2000):
        base = rng.sample(range(10**6), rng.randint(1, 120))
        x = set(base)
        y = set(base[: rng.randint(1, len(base))]) | set(rng.sample(range(10**6), rng.randint(0, 20)))
        if 100 * len(x & y) >= 80 * len(x | y):
            (a, need_x), (b, need_y) = jj.prefix_sizes(len(x)), jj.prefix_sizes(len(y))
            shared = set(sorted(x)[:a]) & set(sorted(y)[:b])
            assert len(shared) >= max(need_x, need_y)


def test_long_lists_are_probed():
    """The count of long lists follows from T, and a set that only stands in them is not found by the merge."""
    common = np.arange(50, dtype="u8")
    sets = [np.append(common, np.uint64(100 + k)) for k in range(40)]
    i, _ = jj.linked(sets, None)
    assert len(i) == 40 * 39 // 2


def test_edges(spark):
    docs = [(None, "x y"), (None, "x Y"), (5, None), (5, None), (4, ""), (3, " \n"), (9, "a b c d e"), (9, "a b c d e"), (7, "Ünïç ÀB c d " * 3000), (8, "ünïç Àb c d " * 3000)]
    df = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id bigint, text string, key int, root int, n int")
    # ASCII letters alone are folded, so the long texts differ.
    assert got(jj.similar(df)) == slow(docs)
    assert jj.similar(df.limit(0)).collect() == []
    ids = jj.similar(spark.createDataFrame([("b", "x y z"), ("a", "x y z")], "name string, body string"), "name", "body")
    assert got(ids) == [("a", 1, "a", 1), ("b", 1, "a", 1)]


def test_large_group_of_copies(spark):
    """Near copies in many cuts and copies of one text keep exact counts."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    docs = [(k, " ".join(changed(rng, base, 1))) for k in range(150)] + [(1000 + k, " ".join(base)) for k in range(100)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(jj.similar(df, block=40)) == slow(docs)


def carried(monkeypatch):
    """How many texts each call of ``links`` is given."""
    seen, real = [], jj.links

    def links(shards, *rest):
        seen.append(shards.count())
        return real(shards, *rest)

    monkeypatch.setattr(jj, "links", links)
    return seen


def test_shared_passages_make_no_component(spark, monkeypatch):
    """Texts that share much with all others together, but little with each, are not carried from cut to cut."""
    m = 14
    parts = [[] for _ in range(m)]
    for i in range(m):
        for j in range(i):
            passage = [f"p{i}x{j}x{k}" for k in range(6)]
            for own in (i, j):
                parts[own] += passage
    docs = [(k, " ".join(p)) for k, p in enumerate(parts)]
    rng = random.Random(4)
    base = [f"w{k}" for k in range(90)]
    docs += [(100 + k, " ".join(changed(rng, base, 1))) for k in range(3)]
    seen = carried(monkeypatch)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(jj.similar(df, block=4)) == slow(docs)
    assert seen == [3]


@pytest.mark.parametrize("holders, pairs, frequent", [(2, 0, 8), (3, 1, 1), (5, 4, 8), (64, 0, 1)])
def test_long_and_short_lists(spark, monkeypatch, holders, pairs, frequent):
    """Links stay whole however many lists count as long, and however these are parted."""
    for name, value in (("HOLDERS", holders), ("PAIRS", pairs), ("SAMPLE", 2), ("FREQUENT", frequent)):
        monkeypatch.setattr(jj, name, value)
    docs = made(holders + pairs, families=10, copies=11)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert got(jj.similar(df, block=6)) == slow(docs)


def test_lists_give_pairs_up_to_a_bound(spark, monkeypatch):
    rows = [(0, [1] * size) for size in (2, 2, 2, 5, 9)] + [(0, [1] * 12), (1, [1] * 3)]
    lists = spark.createDataFrame(rows, "part int, members array<int>")
    bounds = []
    for most in (0, 1, 2, 4):
        monkeypatch.setattr(jj, "PAIRS", most)
        bounds.append(jj._short(lists))
    # 3 pairs, 13, 49 and 115, for 35 holders; the list of 12 and 3 is one of 15 where rows hold 12.
    assert bounds == [1, 8, 11, 63]
    monkeypatch.setattr(jj, "HOLDERS", 12)
    assert jj._short(lists) == 11


def test_sieve_keeps_all_that_count(spark):
    rng = random.Random(6)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(2000)] + [0, -1, 63, 64, -64, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(k, str(k)) for k in keys], "key bigint, text string")
    some = {*keys[:20], *keys[-7:]}
    kept = [tuple(r) for r in jj._sieved(df, df.filter(df.key.isin(*some)).select("key"), bits=1 << 16).collect()]
    assert some <= {k for k, _ in kept} and len(kept) == len(set(kept)) < 100
    assert all(t == str(k) for k, t in kept)
    assert jj._sieved(df, df.select("key").limit(0)).count() == 0


def test_whole_table(spark, folder):
    assert compare(spark, folder, jj.op11_ngram_jaccard_join, jj.OP11_SQL) == ""
