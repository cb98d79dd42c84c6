from collections import Counter

import public_tokenizers
import pytest
from test_decontamination import brute as leaks
from test_quality_rules import expected as judged
from test_simhash import slow_classes, slow_print
from tokenizers import Tokenizer

import corpus_pipeline
from rillstone.llm import personal_data
from rillstone.llm.common import table


def plain(folder, spark):
    """(doc_id, tokens) of what should be packed."""
    docs = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    trusted = {r.doc_id for r in table(spark, folder, "labels").collect() if r.quality == 1}
    kept = {r[0] for r in judged([*docs.items()], trusted) if r[-1]}
    docs = {i: t for i, t in docs.items() if i in kept}
    least = slow_classes([(i, slow_print(t)) for i, t in docs.items()])
    docs = {i: t for (i, t), c in zip(docs.items(), least) if i == c}
    items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
    clean = {r[0] for r in leaks([*docs.items()], items) if not r[-1]}
    docs = {i: t for i, t in docs.items() if i in clean}
    counts = Counter()
    for t in docs.values():
        counts += personal_data.factor_counts(t) if any(c in "0123456789@" for c in t) else Counter()
    field = personal_data.Field(counts)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = {}
    for i, t in docs.items():
        for kind, s, e in sorted(field.spans(t)[1], key=lambda x: -x[1]):
            t = f"{t[:s]}[{kind.upper()}]{t[e:]}"
        out[i] = len(lib.encode(t, add_special_tokens=False).ids) + 1
    return out


def test_rows_against_plain_python(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert got == plain(folder, spark)
    assert 0 < len(got) < table(spark, folder, "documents").count()
    places = Counter((r.sequence_id, r.offset) for r in rows)
    assert max(places.values()) == 1


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, folder, name, stage):
    odd = [(None, None), (1, None), (2, ""), (3, "a"), (3, "a"), (4, "mail a.b@c.de " * 60), (None, "word " * 3000), (5, "Ünï " * 60)]
    docs = spark.createDataFrame([(i, t, None, None, None, 1) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long, KEPT int")
    out = stage(spark, docs, folder)
    if name != "best_fit_packing":
        assert out.columns == docs.columns
    assert out.count() <= len(odd) + (name == "best_fit_packing")  # one text is cut in two
    assert stage(spark, docs.limit(0), folder).count() == 0
