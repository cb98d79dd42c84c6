import random
import re
from collections import Counter

import pytest
import xxhash

from rillstone.llm import quality_rules as qr
from rillstone.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def buckets(text):
    words = WORD.findall(text or "")
    one = [xxhash.xxh64_intdigest(w[-2:].encode(), seed=42) for w in words]
    last = [xxhash.xxh64_intdigest(w[-1].encode(), seed=42) for w in words]
    two = [xxhash.xxh64_intdigest(b[0].encode(), seed=h) for h, b in zip(last, words[1:])]
    return [h % qr.BUCKETS for h in one + two]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def expected(docs, trusted):
    raw, own = Counter(), Counter()
    for i, t in docs:
        raw.update(buckets(t))
        if i in trusted:
            own.update(buckets(t))
    weights = qr.ratios([raw[b] for b in range(qr.BUCKETS)], [own[b] for b in range(qr.BUCKETS)])
    out = []
    for i, t in docs:
        b = base(t)
        grams = buckets(t)
        total = sum(weights[x] for x in grams)
        out.append((i, *b, not b[-1] and total >= round(qr.THRESHOLD * qr.SCALE) * max(1, len(grams))))
    return out


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


@pytest.fixture(scope="module")
def whole(spark, folder):
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    trusted = {r.doc_id for r in table(spark, folder, "labels").collect() if r.quality == 1}
    return expected(docs, trusted)


def test_whole_table(spark, folder, whole):
    got = qr.op2_likelihood_ratio(spark, folder).select(NAMES).collect()
    assert sorted(map(tuple, got)) == sorted(whole)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_clean_stay_and_junk_goes(spark, size):
    """Also documents without a label: they are junk where symbols or capitals follow each other or cells are cut by bars."""
    folder = f"/root/testdata/{size}"
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    rows = [r for r in qr.op2_likelihood_ratio(spark, folder).collect() if not r.base_failed]
    looks = re.compile(r"[A-Z]{2}\S*!!|&&&|\*\*\*|%%%|\$\$\$|###|( \| .*){6}")
    clean = [r.kept for r in rows if labels.get(r.doc_id, 0 if looks.search(texts[r.doc_id]) else 1) == 1]
    junk = [r.kept for r in rows if labels.get(r.doc_id, 0 if looks.search(texts[r.doc_id]) else 1) == 0]
    assert len(clean) > 100 and all(clean)
    assert junk and not any(junk)


def test_odd_rows(spark):
    texts = [None, "", " \n\t", "one two", "a b c " * 40, "x\n\ny\nx\r\nx \n", " ünï\x0bco\x0cde " * 60, "#*|<> a&b " * 30, "é\xa0ß  x" * 70]
    docs = [*enumerate(texts), (4, "a b c " * 40), (None, "q w e r t y " * 10)]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in docs], "doc_id long, text string, KEPT string, _words int")
    trusted = spark.createDataFrame([(6, "a"), (6, "b"), (None, "c"), (99, "d")], "doc_id long, other string")
    got = qr.judge(df, qr.bucket_ratios(df, trusted)).select(NAMES).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected(docs, {6}), key=str)
    kept = qr.kept_documents(df, trusted)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.kept for r in got)
    empty = df.limit(0)
    assert qr.judge(empty, qr.bucket_ratios(empty, trusted)).count() == 0


def test_only_spark_functions(spark, folder):
    plan = qr.op2_likelihood_ratio(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def spoiled(spark, folder, spoil):
    """Scores of 60 clean documents whose longer words are spoiled, judged in one table with all the others."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    good = {r.doc_id for r in table(spark, folder, "labels").collect() if r.quality == 1}
    clean = [(i, t) for i, t in sorted(docs.collect()) if i in good and not base(t)[-1]][:60]
    junk = [(-1 - i, re.sub(r"\S{5,}", lambda m: spoil(m[0]), t)) for i, t in clean]
    trusted = spark.createDataFrame([(i,) for i in good], "doc_id long")
    df = docs.unionByName(spark.createDataFrame(junk, "doc_id long, text string"))
    rows = qr.judge(df, qr.bucket_ratios(df, trusted)).filter("NOT base_failed").collect()
    return [r for r in rows if r.doc_id < 0], [r for r in rows if r.doc_id in good]


@pytest.mark.parametrize("kind", ["symbols", "letters and digits"])
def test_junk_inside_words_goes(spark, kind):
    r = random.Random(1)
    some = lambda: "#$%&|<>*" if kind == "symbols" else "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(6))
    times = 3 if kind == "symbols" else 1
    junk, clean = spoiled(spark, "/root/testdata/sf0.01", lambda w: w[:2] + "".join(some() + w[2 + k : 3 + k] for k in range(times)) + w[2 + times :])
    assert len(junk) > 40 and not any(x.kept for x in junk)
    assert len(clean) > 100 and all(x.kept for x in clean)


def test_trigrams_against_plain_python(spark):
    texts = ["a bc déf\n\U0001f642x#1 \t Ab1", "x" * 300 + " y", "q"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    weights = qr.bucket_ratios(df, df.limit(1))
    for frequent in (weights.frequent, []):
        weights.frequent = frequent
        for r in qr.judge(df, weights).collect():
            s = " " + " ".join(WORD.findall(texts[r.doc_id])) + " "
            grams = [s[i : i + 3] for i in range(len(s) - 2)]
            total = sum(weights[xxhash.xxh64_intdigest(g.encode(), 42) % qr.BUCKETS] for g in grams)
            assert r.score == total / (len(grams) * qr.SCALE)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_a_clean_language_without_labels_stays(spark, size):
    folder = f"/root/testdata/{size}"
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    labels = table(spark, folder, "labels")
    foreign = docs.filter("lang = 'es'").select("doc_id")
    trusted = qr.trusted_ids(labels).join(foreign, "doc_id", "left_anti")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in qr.judge(docs, qr.bucket_ratios(docs, trusted)).collect() if not r.base_failed]
    spanish = [r for r in rows if r.lang == "es" and quality.get(r.doc_id) == 1]
    assert len(spanish) > 3 and all(r.kept for r in spanish)
    assert not any(r.kept for r in rows if quality.get(r.doc_id) == 0)


def test_weights_of_unseen_buckets_do_not_grow_with_the_corpus():
    for back in ("aaa", "###"):
        made = [qr.backed_off([(0, "aaa", 900 * k, 800 * k), (1, back, 100 * k, 0)], 2)[1] / qr.SCALE for k in (10**3, 10**9)]
        assert abs(made[0] - made[1]) < 0.01 and made[0] > -6
