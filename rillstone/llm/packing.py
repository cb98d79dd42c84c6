"""Best-fit packing planned on the histogram of lengths.

How many pieces there are of each length is all that best fit needs: there are at most ``size`` lengths, so the plan is
made from a table whose size does not depend on the number of documents. It says for each run of ranks within a length
which sequences and places they take. Pieces then take their places by their rank among those of the same length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.common import add_columns, emit_rows, saved, table
from rillstone.llm.pretokens import BYTE_SPLIT, Pieces

VOCABULARY = "byte_bpe_50k.json"
SIZE = 2048
END_ID = 0
# Ranks are counted in parts of about this many pieces, so that a frequent length is shared among tasks.
RANK_ROWS = 1000

PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint"


def _ids_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=4)
def _encoder(path: str) -> Pieces:
    return Pieces(path, BYTE_SPLIT, False, _ids_bytes)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: all of ``size`` but perhaps the first."""
    first = n - size * ((n - 1) // size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def token_pieces(docs: DataFrame, doc_id: str, text: str, path: str, size: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document, named by ``doc_id`` of any type; with ``with_ids`` also its token ids."""
    end = _ids_bytes([end_id])

    def work(ids, texts):
        rows = []
        for i, parts in zip(ids, _encoder(path).values(texts)):
            data = b"".join(parts) + end
            for k, (s, n) in enumerate(cut(len(data) // 4, size)):
                own = data[4 * s : 4 * (s + n)]
                rows.append((i, k, s, n, crc32(own), *([np.frombuffer(own, "<u4").astype("i4")] if with_ids else [])))
        return [*zip(*rows)]

    kind = docs.schema[doc_id].dataType.simpleString()
    return emit_rows(docs, [doc_id, text], f"doc_id {kind}, {PIECE}" + ", ids array<int>" * with_ids, work)


def plan(lengths: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts: rows (length, first rank, pieces, first sequence, sequences, offset).

    In a row the ranks go round the sequences; each round is one length further inside them.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> runs of sequences (first, how many)
    rooms: list[int] = []
    fresh, rows = 0, []

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if not free[room]:
                insort(rooms, room)
            free[room].append((first, n))

    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = free[room].pop()
                if not free[room]:
                    rooms.pop(at)
            else:
                room, first, n = size, fresh, -(-left // (size // length))
                fresh += n
            each = room // length
            whole = min(n, left // each)
            if whole:
                rows.append((length, rank, whole * each, first, whole, size - room))
                rank, left = rank + whole * each, left - whole * each
                put(room - each * length, first, whole)
            if left and whole < n:  # fewer than ``each`` are left: they share one sequence
                rows.append((length, rank, left, first + whole, 1, size - room))
                put(room - left * length, first + whole, 1)
                rank, left, whole = rank + left, 0, whole + 1
            put(room, first + whole, n - whole)
    return rows


def ranked(pieces: DataFrame, lengths: dict[int, int], size: int) -> DataFrame:
    """Adds ``rank``, from 0, among the pieces of the same length. No task holds all pieces of a frequent length."""
    parts = F.array(*[F.lit(-(-lengths.get(n, 1) // RANK_ROWS)) for n in range(1, size + 1)])
    part = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.element_at(parts, F.col("length").cast("int"))).alias("part")
    rows = pieces.select("*", part)
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = rows.withColumn("rank", F.row_number().over(own) - 1)
    return numbered.join(offsets, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, size: int = SIZE, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece with its ``sequence_id`` and ``offset``; sequences hold at most ``size`` tokens without gaps.

    A null or empty text is the end id alone. Texts above ``size`` are cut, none is shortened. Repeated rows and null ids
    each keep their own places, ties go by id and piece, other columns are left out, an empty table gives no row.
    Pieces are written to the shared folder once; only counts per length reach the driver, at most ``size`` rows.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    pieces = saved(token_pieces(docs, doc_id, text, path, size, end_id, with_ids), "pieces")
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = np.array(sorted(plan(lengths, size)), dtype="i8").reshape(-1, 6)
    shift = np.int64(1 << 45)
    starts, sent = rows[:, 0] * shift + rows[:, 1], docs.sparkSession.sparkContext.broadcast(rows)

    def place(length, rank):
        length, rank, rows = np.array(length, "i8"), np.array(rank, "i8"), sent.value
        at = rows[np.searchsorted(starts, length * shift + rank, "right") - 1]
        turn, within = np.divmod(rank - at[:, 1], at[:, 4])
        return [at[:, 3] + within, at[:, 5] + turn * length]

    placed = add_columns(ranked(pieces, lengths, size), ["length", "rank"], "sequence_id bigint, offset bigint", place)
    named = [F.col("doc_id").alias(doc_id), *pieces.columns[1:]]
    return placed.select(*named, "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed token ids, ``(sequence_id, ids)``, from ``pack(..., with_ids=True)``. A group has at most ``size`` tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


QUERIES = {"op5_best_fit_packing": op5_best_fit_packing}
SQL: dict[str, str] = {}
