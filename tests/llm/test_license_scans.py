import random
import re
from fractions import Fraction

import pytest

from rillstone.llm import license_scans as ls
from verification.check import compare


def brute(text, templates=ls.TEMPLATES):
    """Every stretch of one and a half templates from every word on; no windows, no hashes."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    grams = ls.shingles(words)
    found = []
    for name, notice in templates:
        own = set(ls.shingles(ls.template_words(notice)))
        long = len(own) + len(own) // 2
        places = [k for k, g in enumerate(grams) if g in own]
        for s in places:
            inside = [k for k in places if s <= k < s + long]
            n = len({grams[k] for k in inside})
            if 100 * n >= 80 * len(own):
                found.append((name, s, inside[-1] + 5, Fraction(n, len(own)), n))
    names = {x[0] for x in found if not any(y[0] != x[0] and x[1] < y[2] and y[1] < x[2] and y[3:] > x[3:] for y in found)}
    return len(words), len(names), ",".join(sorted(names))


@pytest.fixture(scope="module")
def changed():
    r = random.Random(2)
    texts = []
    for k in range(150):
        _, notice = r.choice(ls.TEMPLATES)
        words = notice.split()
        for _ in range(k % 4):
            words[r.randrange(len(words))] = r.choice(["X", "the", ""])
        filler = [" ".join(r.choice("under the license of a GNU b2".split()) for _ in range(r.randint(0, 60))) for _ in range(2)]
        texts.append(f"{filler[0]} {' '.join(words).upper() if k % 5 == 0 else ' '.join(words)} {filler[1]}")
    return texts


def test_changed_notices_against_brute_force(spark, changed):
    texts = [*changed, None, "", "MIT", "Released under the MIT License", "é " * 9, "x " * 30_000 + ls.TEMPLATES[1][1] + " y" * 30_000]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(3, texts[3], "z"), (None, "Licensed under CC BY-NC 4.0.", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, MATCHES string")
    got = ls.find_licenses(df).select("doc_id", "n_words", "n_licenses", "licenses").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert sum(r.n_licenses > 0 for r in got) > 50
    assert ls.find_licenses(df.limit(0)).count() == 0


def inserted(notice, count, at):
    words = notice.split()
    middle = len(words) // 2
    return " ".join(["filler"] * at + words[:middle] + ["new"] * count + words[middle:] + ["more"] * 40)


def test_inserted_words_at_every_start(spark):
    """Words put into the middle of a notice, up to half of its length, are no matter where windows begin."""
    texts = [(name, inserted(notice, count, at)) for name, notice in (ls.TEMPLATES[k] for k in (1, 5, 6)) for count in range(2, 13) for at in range(12)]
    df = spark.createDataFrame(texts, "name string, text string")
    for r in ls.find_licenses(df).select("name", "text", "licenses").collect():
        assert r.licenses == brute(r.text)[2] and r.name in r.licenses.split(",")


@pytest.mark.parametrize("license", ["GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "ISC", "CC-BY-SA-4.0"])
def test_versions_of_a_notice_keep_their_names(spark, license):
    text = next(t for n, t in ls.TEMPLATES if n == license)
    df = spark.createDataFrame([(1, f"You can use {text} Really."), (2, "a " * 30 + text.replace("License", "LICENSE") + " b" * 30)], "doc_id long, text string")
    assert {r.licenses for r in ls.find_licenses(df).collect()} == {license}


def test_two_notices_in_one_text(spark):
    gpl2, gpl3 = (next(t for n, t in ls.TEMPLATES if n == f"GPL-{v}.0-or-later") for v in (2, 3))
    df = spark.createDataFrame([(1, f"{gpl2} {gpl3}"), (2, f"{ls.TEMPLATES[0][1]} {ls.TEMPLATES[2][1]}")], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in ls.find_licenses(df).collect()}
    assert got == {1: "GPL-2.0-or-later,GPL-3.0-or-later", 2: "Apache-2.0,MIT"}


def test_too_many_templates_are_refused(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError, match="templates"):
        ls.find_licenses(df, [("X", f"one two three four five {k}") for k in range(ls.MOST + 1)])


def test_matches_tell_where(spark):
    text = "one two " * 20 + ls.TEMPLATES[7][1] + " three" * 20
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    m = ls.find_licenses(df).first().matches
    assert {x.license for x in m} == {"BSD-3-Clause"} and max(x.percent for x in m) == 100
    assert any(x.first_word <= 40 < x.first_word + x.words for x in m)


def test_template_hashes_are_those_of_spark(spark):
    row = spark.sql("SELECT xxhash64('a b c d e'), xxhash64(xxhash64('a b c d e'), 7)").first()
    h = ls.shingle_hash("a b c d e")
    assert row[0] == h and row[1] == ls.band_value(h, 7)


def test_query_matches_sql(spark, folder):
    assert compare(spark, folder, ls.op10_minhash_licenses, ls.SQL["op10_minhash_licenses"]) == ""


def test_only_spark_functions(spark, folder):
    plan = ls.op10_minhash_licenses(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
