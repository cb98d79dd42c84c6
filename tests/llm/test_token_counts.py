import public_tokenizers
from tokenizers import Tokenizer

from rillstone.llm import token_counts
from rillstone.llm.common import table

ODD = [
    None, "", " ", "It's 'tis WE'LL 12 ³", "<|endoftext|> a <|startoftext|>b", "ΣΊΣΥΦΟΣ İstanbul", "é ​　x", "汉字 🙂",
    "a" * 5000, "x y\x1cz\x85w", "<|endoftext|", "Ünïcode ﬁ ŉ ſ", "n\n\n\tm!!??",
]


def library(texts):
    lib = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    return [len(e.ids) for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_whole_table(spark, folder):
    docs = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    got = {r.doc_id: r for r in token_counts.op1_token_counts(spark, folder).collect()}
    assert {i: r.n_tokens for i, r in got.items()} == dict(zip(docs, library(docs.values())))
    assert all(r.n_bytes == len(docs[i].encode()) and r.over_limit == (r.n_tokens > 2048) for i, r in got.items())


def test_odd_texts_and_clashing_columns(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(0, "Ab ab", "y"), (None, "Ab ab", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS string")
    out = token_counts.count_tokens(df)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((str(r.text), r.n_tokens) for r in out.collect())
    assert got == sorted(zip(map(str, [r[1] for r in rows]), library([r[1] for r in rows])))
    assert token_counts.count_tokens(df.limit(0)).count() == 0


def test_every_character_below_the_bound_is_split_like_the_library(spark):
    texts = [f"a{chr(c)}B {chr(c)}{chr(c)}'s1" for c in range(1, 0x2100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df).collect()}
    assert [got[i] for i in range(len(texts))] == library(texts)
