"""Word counts and inverted indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions.text import distinct_tokens, tokens
from rillstone.operators.ordered import numbered_blocks


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of each token, the empty token included."""
    return df.select(F.explode(tokens(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def inverted_index(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", block_rows: int = 1000, max_rows: int | None = None
) -> DataFrame:
    """``(word, block, doc_ids)``: the documents of each word, ids sorted as text.

    A posting list is stored in blocks of ``block_rows`` ids, so a word that occurs everywhere is
    many bounded rows; the blocks in order are the whole list.
    """
    words = df.select(
        F.explode(distinct_tokens(F.col(text))).alias("word"), F.col(doc_id).cast("string").alias("doc_id")
    )
    blocks = numbered_blocks(words, ["word"], ["doc_id"], block_rows, max_rows)
    return blocks.groupBy("word", "block").agg(F.array_sort(F.collect_list("doc_id")).alias("doc_ids"))
