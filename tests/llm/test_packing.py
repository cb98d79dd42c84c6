import random
from zlib import crc32

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from rillstone.llm import packing
from rillstone.llm.common import table


def check(df, texts, size):
    """Every piece is right and every sequence is filled without gaps."""
    lib = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = {}
    for i, t in texts.items():
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        count = -(-len(ids) // size)
        at = 0
        for k in range(count):
            n = len(ids) - size * (count - 1) if k == 0 else size
            want[i, k] = (at, n, crc32(np.array(ids[at : at + n], "<u4").tobytes()))
            at += n
    rows = df.collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
        assert filled[r.sequence_id] <= size
    return len(filled), -(-sum(n for _, n, _ in want.values()) // size)


def best_fit(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(size - n)
        else:
            rooms[rooms.index(fit)] -= n
    return len(rooms)


def test_plan_needs_as_many_sequences_as_best_fit():
    for seed in range(30):
        r = random.Random(seed)
        size = r.choice([7, 20, 64])
        many = [r.randint(1, size) for _ in range(r.randint(1, 200))]
        lengths = {n: many.count(n) for n in set(many)}
        rows = packing.plan(lengths, size)
        slots, ends = {}, {}
        for length, rank, n, first, wide, offset in rows:
            for k in range(n):
                slots[length, rank + k] = (first + k % wide, offset + k // wide * length, length)
        assert sorted(slots) == sorted((n, k) for n, c in lengths.items() for k in range(c))
        for s, o, n in sorted(slots.values()):
            assert ends.get(s, 0) == o
            ends[s] = o + n
            assert ends[s] <= size
        assert len(ends) == best_fit(many, size)


def test_whole_table(spark, folder):
    docs = table(spark, folder, "documents")
    used, least = check(packing.op5_best_fit_packing(spark, folder), {r.doc_id: r.text for r in docs.collect()}, 2048)
    assert used <= least * 1.02 + 1


def test_edges(spark):
    texts = {1: None, 2: "", 3: "a " * 500, 4: "x<|endoftext|>y", 5: "  \n　 é 汉字 🙂 it's 12", 6: "same", 7: "same"}
    rows = [(i, t, "src", 0, 9) for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, offset int, rank int")
    check(packing.pack(df, size=16), texts, 16)
    placed = packing.pack(df, size=16, with_ids=True)
    packed = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert packed[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert packing.pack(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(None, "b"), (None, "b"), (1, "b")], "doc_id long, text string")
    assert packing.pack(twice).agg({"length": "sum"}).first()[0] == 6


def test_many_of_one_length(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'a b c' ELSE repeat('z ', int(id % 40)) END AS text")
    check(packing.pack(df, size=32), {r.doc_id: r.text for r in df.collect()}, 32)


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "three " * 3000), (None, None)], "name string, body string")
    out = packing.pack(docs, "name", "body")
    assert out.columns[0] == "name" and dict(out.dtypes)["name"] == "string"
    assert {r.name for r in out.collect()} == {"a", "b", None}
