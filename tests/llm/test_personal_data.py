import hashlib
import re

import pytest

from rillstone.llm import personal_data as pd
from rillstone.llm.common import table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(t):
    return re.sub("[^0-9]", "", t)


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0


def plain(t):
    t = t or ""
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15]
    return out


def agree(rows, texts):
    for r in rows:
        base = plain(texts[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in base) for k in pd.KINDS], texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    rows = pd.op3_skip_chain_crf(spark, folder).collect()
    assert len(rows) == len(texts)
    agree(rows, texts)
    assert all(not r.spans for r in rows if not plain(texts[r.doc_id]))


ODD = [
    None, "", "a@b.c%x@y.z a@b @c.d x@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3", "4111 1111-1111 1111 4111111111111112",
    "+1 (068) 555-2748) +12 +1.......2 +123456789012345678", "é" * 50 + " ü.x+1@mail.example.com.", "9" * 4000, "a" * 4000 + "@",
    "1." * 3000, "@" * 3000, "+1 " * 500, "1 2 " * 2000,
]


@pytest.fixture(scope="module")
def field():
    return pd.Field({})


def test_odd_texts(spark, field):
    texts = dict(enumerate(ODD))
    df = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id long, text string, SPANS int")
    rows = pd.find(df, field).collect()
    agree(rows, texts)
    assert pd.find(df.limit(0), field).count() == 0
    assert pd.train(df.limit(0)).own == {}
    hidden = pd.redact(df, field)
    assert hidden.columns == df.columns and hidden.count() == len(ODD)


def test_alike_tokens_get_one_label(field):
    text = "call +1 (068) 555-2748 now. Again: 555-2748 or 555 2748, mail jane.doe77@mail.example.com, that is jane.doe77 at work; room 555-2749"
    base, every = field.spans(text)
    found = {text[s:e] for _, s, e in every}
    assert {"+1 (068) 555-2748", "jane.doe77@mail.example.com"} == {text[s:e] for _, s, e in base}
    assert found == {"+1 (068) 555-2748", "jane.doe77@mail.example.com", "555-2748", "jane.doe77"}


def test_message_passing_is_exact_on_trees(field):
    """On a graph without loops the labels are those of the full joint distribution."""
    from itertools import product

    import numpy as np

    tokens = [(0, 0, 1), (1, 2, 3), (9, 4, 5)]
    words = ["5552748", "x1", "068-555-2748"]
    known = [4, 0, 0]
    score = [field.own.get(pd.shape(w), field.unknown) for w in words]
    best = np.zeros((3, 5))
    for y in product(range(5), repeat=3):
        if y[0] == 4:
            p = np.exp(sum(s[k] for s, k in zip(score[1:], y[1:])) + field.pair["chain"][y[0], y[1]] + field.pair["skip"][y[0], y[2]])
            for k in range(3):
                best[k, y[k]] += p
    got = field.labels(tokens, words, known, rounds=60)
    assert pd.skip_edges(words) == [(0, 2)]
    assert got[2] == best[2].argmax() and got[0] == 4 and got[1] == 0


def test_redaction(spark, field):
    df = spark.createDataFrame([(1, "to a.b@c.de or 1.2.3.4!", 99)], "doc_id long, text string, n_chars long")
    r = pd.redact(df, field).first()
    assert (r.text, r.n_chars) == ("to [EMAIL] or [IP]!", 19)
