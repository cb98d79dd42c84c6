"""Token counts by a whole-token shortcut.

Before any text is read, every string of the vocabulary that ends a word is put to the library alone; those that come
back as exactly one token are kept. A pre-token of a text that is such a string counts one without being merged. Only the
rest is merged, each different string once per worker.
"""

from __future__ import annotations

from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import add_columns, table
from rillstone.llm.pretokens import WORD_SPLIT, Pieces, byte_letters, tokenizer

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
LIMIT = 2048


def _spelled(token: str, codes: dict[str, int]) -> str | None:
    """The text that a byte-level token stands for."""
    raw = bytearray()
    for c in token:
        if c not in codes:
            return None
        raw.append(codes[c])
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Strings of the vocabulary that, encoded alone, are proven to be one token."""
    library = tokenizer(path)
    codes = {letter: byte for byte, letter in byte_letters().items()}
    spelled = (_spelled(t.removesuffix(WORD_END), codes) for t in library.get_vocab() if t.endswith(WORD_END))
    strings = sorted({s for s in spelled if s})
    encoded = library.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded) if len(e.ids) == 1)


@lru_cache(maxsize=4)
def _pieces(path: str) -> Pieces:
    return Pieces(path, WORD_SPLIT, True, len, dict.fromkeys(whole_tokens(path), 1))


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``; no shuffle.

    A null or empty text has no bytes and no tokens. Texts of any length are counted whole, repeated rows each by
    themselves, an empty table gives an empty one, and columns that already have one of the new names are replaced.
    ``path`` is a vocabulary file with word ends, lower case and white space dropped.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def work(texts):
        n = [sum(v) for v in _pieces(path).values(texts)]
        return [[len((t or "").encode()) for t in texts], n, [x > limit for x in n]]

    return add_columns(docs, [text], "n_bytes bigint, n_tokens bigint, over_limit boolean", work)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.col("text"))
    return count_tokens(docs).drop("text")


QUERIES = {"op1_token_counts": op1_token_counts}
SQL: dict[str, str] = {}
