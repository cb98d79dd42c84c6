import hashlib
import random
import re
import zlib

import pytest

from rillstone.llm import conversation_trie as ct
from verification.check import compare

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def slow_talks(rows, rebuild=True):
    """{id: [(role, text), ...]} from (id, turn, role, text) rows."""
    own = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((r or "", x or ""))
    if not rebuild:
        return own
    out = {}
    for c, talk in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + talk[h:]
    return out


def slow(talks):
    nodes = {}
    for c, talk in talks.items():
        for d in range(len(talk) + 1):
            nodes.setdefault(tuple(talk[:d]), []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[c] for c in children.get(p, ())) or 1
        saved[p] = sum(saved[c] for c in children.get(p, ())) + (len(nodes[p]) - 1) * words
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(talks[c]) == len(p)))
        up = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), up, len(members), len(children.get(p, ())), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n, deep=5):
    """Talks from few turns, so that prefixes, whole talks and first turns are shared."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), n):
        first = 0 if rng.random() < 0.4 else rng.randrange(6)
        for t in range(rng.randint(1, deep)):
            k = first if t == 0 else rng.randrange(3)
            rows.append((c, t, rng.choice(["user", "user", None]), "word " * k + f"t{k}"))
    return rows


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed, range_turns", [(1, 10**6), (2, 40), (3, 12), (4, 3)])
def test_against_brute_force(spark, seed, range_turns):
    rows = made(seed, 120) + [(1000, 0, "user", None), (1001, None, None, ""), (1002, None, "user", None), (1002, 3, "user", " a\tb\n")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(ct.trie(ct.rebuilt(ct.turns(df)), range_turns)) == slow(slow_talks(rows))
    assert got(ct.trie(ct.sequences(ct.turns(df)), range_turns)) == slow(slow_talks(rows, rebuild=False))


def test_borders_of_ranges(spark):
    """Prefixes that are talks themselves, at every border: one talk is the beginning of the next one."""
    rows = [(c, t, "user", f"w {t}") for c in range(30) for t in range(c + 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for range_turns in (2, 60):
        assert got(ct.trie(ct.sequences(ct.turns(df)), range_turns)) == slow(slow_talks(rows, rebuild=False))


def test_one_range_adds_up():
    """The root of a range has all members, leaves and savings of its nodes."""
    rows = made(9, 60)
    talks = slow_talks(rows, rebuild=False)
    codes = {s: k for k, s in enumerate(sorted({s for t in talks.values() for s in t}))}
    by = {}
    for c, t in talks.items():
        by.setdefault(tuple(codes[s] for s in t), []).append(c)
    table = [(list(p), [1] * len(p), len(m), min(m), "x") for p, m in sorted(by.items())]
    whole = [n for n in ct._range_nodes(0, list(table))]
    root = next(n for n in whole if n[1] == 0)
    assert root[2] == len(talks)
    assert root[5] == sum(n[4] == 0 for n in whole)
    assert root[6] == sum(n[2] - 1 for n in whole if n[1])


def test_tree_is_balanced():
    """With the median first, many siblings are found in few steps."""
    tree = ct.TernaryTree()
    tree.fill([([k], [1], 1, k, "") for k in range(1000)])

    def height(k):
        return 0 if k < 0 else 1 + max(height(tree.low[k]), height(tree.high[k]))

    assert height(tree.child[0]) <= 11


def test_same_talk_in_many_ids(spark):
    """A third of all conversations are one; their ids are hashed in blocks."""
    rows = [(c, 0, "user", "hello there") for c in range(20_000)] + [(c, 0, "user", f"x{c}") for c in range(20_000, 20_050)]
    out = ct.trie(ct.sequences(ct.turns(spark.createDataFrame(rows, SCHEMA))))
    top = out.filter("n_convs = 20000").first()
    assert top.ends_sha256 == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()
    assert (top.conv_id, top.saved_tokens, out.filter("depth = 0").first().n_leaves) == (0, 2 * 19_999, 51)


def test_edges(spark):
    assert ct.trie(ct.rebuilt(ct.turns(spark.createDataFrame([], SCHEMA)))).collect() == []
    rows = [(None, 0, "user", "lost"), (7, 0, "a", "b c"), (7, 0, "a", "b c"), (7, 0, "a", "x" * 300_000)]
    clash = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], SCHEMA + ", pos int, code string, words int")
    assert got(ct.trie(ct.sequences(ct.turns(clash)))) == slow(slow_talks(rows, rebuild=False))
    # The border between role and text counts.
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc")]
    assert got(ct.trie(ct.sequences(ct.turns(spark.createDataFrame(rows, SCHEMA))))) == slow(slow_talks(rows, rebuild=False))


def test_whole_table(spark, folder):
    assert compare(spark, folder, ct.op12_conversation_trie, ct.OP12_SQL) == ""
