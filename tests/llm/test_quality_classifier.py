from zlib import crc32

import numpy as np

from rillstone.llm import quality_classifier as qc
from rillstone.llm.common import table


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    rows = qc.op7_attention_bags(spark, folder).collect()
    assert len(rows) == table(spark, folder, "documents").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    test = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = np.array([s for s, y, _ in test if y == 1]), np.array([s for s, y, _ in test if y == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert np.mean([p == y for _, y, p in test]) > 0.97
    assert np.mean([p for _, y, p in test if y == 1]) > 0.99


def test_gradient_learns_which_passage_matters():
    r = np.random.default_rng(0)
    bags, labels = [], []
    for k in range(300):
        rows = r.normal(size=(r.integers(1, 8), 6))
        rows[:, 0] = 0
        if k % 2:
            rows[r.integers(len(rows)), 0] = 3
        bags.append(rows)
        labels.append(k % 2)
    model = qc.fit(bags[:200], labels[:200])
    assert np.mean([(model.score(b) > 0.5) == y for b, y in zip(bags[200:], labels[200:])]) > 0.95


def test_passages_against_plain_counts():
    text = ("Some wörds, here | and &&& there!!\n" * 40 + "  tail tail  ").encode()
    rows, words = qc.passages(text), text.split()
    assert len(rows) == -(-len(words) // qc.PASSAGE)
    for k in range(len(rows)):
        own = words[k * qc.PASSAGE : (k + 1) * qc.PASSAGE]
        assert np.isclose(rows[k, -2], len(set(own)) / len(own))
    assert np.allclose((rows[:, : qc.CLASSES] ** 2).sum(1), 1)


def test_long_texts_are_read_whole():
    text = b"word " * 500_000 + b"END!!"
    rows = qc.passages(text)
    assert rows[-1, 3] > 0 and sum(1 for _ in qc._stretches(text)) == 3


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, " \n", 2), (None, "a b", 3)], "doc_id long, text string, SCORE int")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert qc.train(docs, labels.limit(0)).score(qc.passages(b"x")) == 0.5
    scored = qc.score(docs, qc.train(docs, labels))
    assert scored.columns == ["doc_id", "text", "score", "predicted"]
    assert scored.count() == 4 and all(0 <= r.score <= 1 for r in scored.collect())
    assert qc.score(docs.limit(0), qc.train(docs, labels)).count() == 0


def test_passages_of_long_texts_have_64_words(monkeypatch):
    """Where a text is read in stretches, passages are those of the text in one but for what crosses a border."""
    r = np.random.default_rng(2)
    text = b" ".join(b"w%d " % k * int(n) for k, n in enumerate(r.integers(1, 4, 3000))) + b"\nend"
    whole = qc.passages(text)
    monkeypatch.setattr(qc, "STRETCH", 1000)
    parts = list(qc._stretches(text))
    assert b"".join(parts) == text and len(parts) > 10
    assert all(len(p.split()) % qc.PASSAGE == 0 for p in parts[:-1])
    assert np.allclose(np.delete(qc.passages(text), slice(qc.CLASSES, qc.CLASSES + qc.PAIRS + 1), 1), np.delete(whole, slice(qc.CLASSES, qc.CLASSES + qc.PAIRS + 1), 1))


def test_fitting_takes_documents_whole(spark):
    """A label that one passage in the middle tells is learned; documents beyond the bound are passed over, none is cut."""
    r = np.random.default_rng(1)
    docs = [(k, " ".join("word" if n != 1000 or k % 2 else "&&&#" * 40 for n in range(2000 + int(r.integers(9))))) for k in range(80)]
    df = spark.createDataFrame([*docs, (999, "long " * 400_000)], "doc_id long, text string")
    labels = spark.createDataFrame([*((k, 1 - k % 2) for k, _ in docs), (999, 0)], "doc_id long, quality int")
    model = qc.train(df, labels, fitted=5000)
    scores = {x.doc_id: x.score for x in qc.score(df, model).collect()}
    assert min(scores[k] for k in range(0, 80, 2)) > max(scores[k] for k in range(1, 80, 2))


def test_names_of_columns(spark):
    df = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id long, text string, _raw string, PREDICTED int")
    model = qc.fit([], [])
    assert [tuple(x) for x in qc.score(df, model).collect()] == [(1, "a b", "x", 0.5, 1)]
