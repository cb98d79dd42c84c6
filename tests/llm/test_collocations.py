import random
import re
from collections import Counter

import pytest

from rillstone.llm import collocations
from rillstone.llm.common import table
from verification.check import compare


def slow(docs, longest=3, least=10, covered=50, top=2000):
    """From (text, lang) pairs."""
    counts, total = Counter(), Counter()
    for text, lang in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    counts["und" if lang is None else lang, tuple(w[i : i + n])] += 1
    longer = Counter()
    for (lang, v), f in counts.items():
        for i in range(len(v) if f >= least else 0):
            for j in range(i + 1, len(v) + 1):
                if j - i < len(v):
                    longer[lang, v[i:j]] = max(longer[lang, v[i:j]], f)
    out = {}
    for (lang, w), a in counts.items():
        if len(w) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, w[:k]], counts[lang, w[k:]]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        if 100 * longer[lang, w] < covered * a:
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    rows = []
    for lang, found in out.items():
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(rows)


def made(seed, n, lang="en"):
    rng = random.Random(seed)
    words = ["the", "Of", "é", "new", "york", "x\x00y", "ab", "Rare"]
    joints = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; "]
    return [("".join(rng.choice(words) + rng.choice(joints) for _ in range(rng.randint(0, 60))), lang) for _ in range(n)]


@pytest.mark.parametrize("longest, modulus, bits", [(3, 32, 1 << 26), (3, 2, 64), (4, 3, 1 << 10), (2, 5, 1 << 10)])
def test_against_counting(spark, longest, modulus, bits):
    docs = made(1, 60) + made(2, 30, "fr") + [(None, "en"), ("", "fr"), (" . ,", None), ("a b " * 500, None), ("x " * 3000, "de")]
    docs += [docs[0]] * 200
    df = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    got = collocations.collocations(df, longest=longest, modulus=modulus, bits=bits, top=50)
    assert sorted(map(tuple, got.collect())) == slow(docs, longest, top=50)


def test_overlap_counts_once(spark):
    """Chunks overlap at nearly every word, yet each occurrence counts once."""
    docs = spark.createDataFrame([("a b c d e f g " * 20, "en")], "text string, lang string")
    dictionary = collocations.parse(docs, modulus=1)
    assert dictionary.filter("times > 1").count() > 0
    words, phrases = collocations.frequencies(dictionary)
    assert {r.phrase: r.f for r in words.collect()} == dict.fromkeys("abcdefg", 20)
    assert {r.phrase: r.f for r in phrases.filter("size = 2").collect()}["g a"] == 19


def test_copies_are_one_entry(spark):
    """A passage of a third of the corpus is one row of the dictionary, wherever it stands."""
    common = "one two three four five six seven eight nine ten " * 30
    docs = [(f"start{i} {common} end{i}", "en") for i in range(50)]
    dictionary = collocations.parse(spark.createDataFrame(docs, "text string, lang string"), modulus=4)
    assert dictionary.agg({"times": "max"}).first()[0] >= 50
    assert dictionary.count() < 50 * 4


def test_edges(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).count() == 0
    clash = spark.createDataFrame([("a b " * 12, None, 1, 2, 3)], "text string, lang string, phrase int, n int, chunk int")
    assert [tuple(r) for r in collocations.collocations(clash).collect()] == slow([("a b " * 12, None)])


def test_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000
    words = spark.createDataFrame([("en", "a", big + 1), ("en", "b", big)], "lang string, phrase string, f bigint")
    phrases = spark.createDataFrame([("en", "a b", 2, big - 1)], "lang string, phrase string, size int, f bigint")
    assert collocations.scores(words, phrases).first().score == 10**6 * (big - 1) ** 2 // ((big + 1) * big)


def test_whole_table(spark, folder):
    assert compare(spark, folder, collocations.op13_phrase_collocations, collocations.OP13_SQL) == ""
    docs = [(r.text, r.lang) for r in table(spark, folder, "documents").collect()]
    assert collocations.op13_phrase_collocations(spark, folder).count() == len(slow(docs)) > 100
