import hashlib
import random
import re

import pytest

from rillstone.llm import decontamination as dc
from verification.check import compare


def brute(docs, items, window=10):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    grams = {}
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1) if w else []:
            grams.setdefault(tuple(w[k : k + m]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for m in range(1, window + 1):
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in grams:
                    hit |= set(range(k, k + m))
                    found |= grams[tuple(w[k : k + m])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("passes", [1, 3])
def test_against_brute_force(spark, passes):
    r = random.Random(7)
    some = lambda n: " ".join(r.choice("a b c D É x1 of,the".split()) for _ in range(n))
    items = [(k, some(r.choice([1, 2, 3, 12, 14, 40]))) for k in range(12)] + [(None, "zz yy"), (3, ""), (4, None), (5, "a b c")]
    docs = [(k, some(r.randint(0, 60)) + (r.choice(items)[1] or "") * (k % 3 == 0) if k % 7 else None) for k in range(60)] + [(1, "same same"), (1, "same same"), (None, "q ZZ! yy")]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, N_HIT int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, source string")
    total = sum(len(t.split()) for _, t in items if t)
    got = dc.contamination(d, b, pass_words=-(-total // passes) + 1 if passes > 1 else dc.PASS_WORDS).select(NAMES).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(docs, items), key=str)
    kept = dc.without_leaks(d, b)
    assert kept.columns == d.columns
    assert kept.count() == sum(not r.contaminated for r in got)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert not dc.contamination(d, b).first().contaminated
    assert dc.contamination(d.limit(0), b).count() == 0


def test_long_items_are_cut_without_loss(spark):
    words = [f"w{i}" for i in range(25_000)]
    b = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    d = spark.createDataFrame([(i, " ".join(words[i : i + 10])) for i in (0, 9_995, 10_000, 19_999, 24_990)], "doc_id long, text string")
    assert {r.n_hit for r in dc.contamination(d, b).collect()} == {10}


def test_query_matches_sql(spark, folder):
    assert compare(spark, folder, dc.op4_wu_manber, dc.SQL["op4_wu_manber"]) == ""


def test_passes_are_written_and_names_stay(spark):
    """Ten passes: each is a stage of its own, with one Python worker; columns may have any name."""
    items = [(k, " ".join(f"w{k}x{j}" for j in range(12))) for k in range(30)]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(k, t, "h", 5) for k, t in items], "doc_id long, text string, _hits string, _raw int")
    found = dc.contamination(d, b, pass_words=40)
    assert found.columns == [*d.columns, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert {(r.n_hit, r.n_items, r._hits, r._raw) for r in found.collect()} == {(12, 1, "h", 5)}
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert dc.without_leaks(d, b, pass_words=40).count() == 0
