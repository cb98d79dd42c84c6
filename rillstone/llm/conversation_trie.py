"""The prefix trie of conversations, built as ternary search trees on ranges of their turn sequences.

A turn is coded by the hash of role and text, a conversation is the sequence of its codes, and equal sequences are one row.
The sequences are dealt into ranges of their order. Each range becomes a ternary search tree whose sequences go in median
first, so that the trees of siblings stay balanced; nodes are then visited from the last to the first, every one after
its descendants, to add up members, leaves and savings.

Only the nodes on the first and the last path of a range can also stand in other ranges. They meet by a hash of their path:
members add up, and what two ranges both count (shared children, leaves that go on in the next range, the one member that is
not saved) is put right by one value for each node on the border of two ranges. A border is never longer than a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.common import bounded_batches, saved, table

# Turns in a range, all held by one task.
RANGE_TURNS = 200_000
# Ids are hashed in blocks of text of about so many characters.
BLOCK_CHARS = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()


def turns(talks: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, pos, code, words)``: turns from 1 on, null first, ties by role and text; rows without an id are left out."""
    plain = talks.filter(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    coded = plain.select(
        "conv_id", "turn", F.xxhash64("role", "text").alias("code"),
        F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).cast("bigint").alias("words"), "role", F.xxhash64("text").alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return coded.select("conv_id", F.row_number().over(order).alias("pos"), "code", "words")


def _gathered(rows: DataFrame) -> DataFrame:
    """``(conv_id, codes, words)`` from ``(conv_id, pos, code, words)``; a null position stands for no turn."""
    step = F.when(F.col("pos").isNotNull(), F.struct("pos", "code", "words"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return lists.select("conv_id", F.col("steps.code").alias("codes"), F.col("steps.words").alias("words"))


def sequences(rows: DataFrame) -> DataFrame:
    """The conversations of ``turns`` as they are."""
    return _gathered(rows)


def rebuilt(rows: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """The conversations of ``turns`` after each has taken the head of the first of its group.

    Of the first conversation of a ``group`` of ids come the first ``h`` turns, ``h`` being the CRC-32 of the id as text
    modulo ``heads``, then the own turns after the first ``h``. At most ``2 * group - 1`` conversations share a head.
    """
    h: Column = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    own = rows.filter(F.col("pos") > h)
    all_ids = rows.filter("pos = 1").select("conv_id")
    wanted = all_ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h"))
    first = rows.filter(F.col("pos") < heads).withColumnRenamed("conv_id", "base")
    taken = wanted.join(first, "base").filter("pos <= h").select("conv_id", "pos", "code", "words")
    none = all_ids.select("conv_id", *[F.lit(None).cast(kind).alias(c) for c, kind in (("pos", "int"), ("code", "bigint"), ("words", "bigint"))])
    return _gathered(own.union(taken).union(none))


def paths(talks: DataFrame) -> DataFrame:
    """``(codes, words, n, least, ends)`` for every different sequence: its conversations, and the hash of their ids.

    Ids are sorted in ranges, put into blocks of text there, and the blocks of a sequence are hashed one after the other;
    nothing holds the ids of a sequence.
    """
    bounded_batches(talks.sparkSession)
    schema = "codes array<bigint>, words array<bigint>, least bigint, n bigint, ids string"
    names = ["codes", "words", "least", "n", "ids"]
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = words = None
        ids: list[str] = []
        size = least = 0
        ready: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], names)

        for batch in batches:
            for c, w, i in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if ids and (c != codes or size > BLOCK_CHARS):
                    ready.append((codes, words, least, len(ids), ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    codes, words, least = c, w, i
                ids.append(str(i))
                size += len(ids[-1]) + 1
            if len(ready) > 256:
                yield batch_of()
                ready = []
        if ids:
            ready.append((codes, words, least, len(ids), ",".join(ids)))
        if ready:
            yield batch_of()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list = []
        ready: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], names)

        for batch in batches:
            for c, w, i, n, ids in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if open_ and open_[0] == c:
                    open_[3] += n
                    open_[4].update(b"," + ids.encode())
                else:
                    if open_:
                        ready.append((*open_[:4], open_[4].hexdigest()))
                    open_ = [c, w, i, n, hashlib.sha256(ids.encode())]
            if len(ready) > 256:
                yield batch_of()
                ready = []
        if open_:
            ready.append((*open_[:4], open_[4].hexdigest()))
            yield batch_of()

    sorted_ids = talks.select("codes", "words", "conv_id").repartitionByRange("codes", "conv_id").sortWithinPartitions("codes", "conv_id")
    parts = sorted_ids.mapInArrow(blocks, schema)
    whole = parts.repartition("codes").sortWithinPartitions("codes", "least").mapInArrow(hashed, schema)
    return whole.withColumnRenamed("ids", "ends")


class TernaryTree:
    """A ternary search tree of code sequences; node 0 is the root of the trie, the others hold a code each."""

    def __init__(self):
        self.code, self.low, self.high, self.child = [0], [-1], [-1], [-1]
        self.parent, self.depth, self.words = [-1], [0], [0]
        self.n, self.least, self.ends = [0], [None], [None]

    def _new(self, code: int, words: int, parent: int) -> int:
        for values, v in (
            (self.code, code), (self.low, -1), (self.high, -1), (self.child, -1), (self.parent, parent),
            (self.depth, self.depth[parent] + 1), (self.words, words), (self.n, 0), (self.least, None), (self.ends, None),
        ):
            values.append(v)
        return len(self.code) - 1

    def insert(self, codes: list[int], words: list[int], n: int, least: int, ends: str) -> None:
        at = 0
        for code, w in zip(codes, words):
            links, slot = self.child, at
            while (now := links[slot]) >= 0 and self.code[now] != code:
                links, slot = (self.low, now) if code < self.code[now] else (self.high, now)
            if now < 0:
                now = links[slot] = self._new(code, w, at)
            at = now
        self.n[at], self.least[at], self.ends[at] = n, least, ends

    def fill(self, rows: list[tuple]) -> None:
        """Rows in ascending order, the median of every part first."""
        todo = [(0, len(rows))]
        while todo:
            a, b = todo.pop()
            if a < b:
                middle = (a + b) // 2
                self.insert(*rows[middle])
                todo += [(a, middle), (middle + 1, b)]

    def path(self, codes: list[int]) -> list[int]:
        """The nodes of a sequence that was inserted, root first."""
        out = [0]
        for code in codes:
            now = self.child[out[-1]]
            while self.code[now] != code:
                now = self.low[now] if code < self.code[now] else self.high[now]
            out.append(now)
        return out

    def add_up(self) -> tuple[list[int], list[int], list[int]]:
        """(children, leaves, savings) of every node; members and least ids are added up in place.

        A node is made after its parent, so the order of making, backwards, meets descendants first.
        """
        size = len(self.code)
        children, leaves, saving = [0] * size, [0] * size, [0] * size
        for k in range(size - 1, -1, -1):
            leaves[k] = leaves[k] or 1
            saving[k] += (self.n[k] - 1) * self.words[k]
            p = self.parent[k]
            if p >= 0:
                children[p] += 1
                leaves[p] += leaves[k]
                saving[p] += saving[k]
                self.n[p] += self.n[k]
                if self.least[p] is None or self.least[k] < self.least[p]:
                    self.least[p] = self.least[k]
        return children, leaves, saving


_NODE = (
    "shard int, depth bigint, n bigint, least bigint, children bigint, leaves bigint, saved bigint, ends string, up_least bigint, "
    "key binary, up_key binary, on_first boolean, on_last boolean, through bigint, before bigint"
)


def _range_nodes(shard: int, rows: list[tuple]) -> Iterator[tuple]:
    """Rows of ``_NODE`` for the trie of one range. Nodes on its first or last path have a key, and the words up to them."""
    rows.sort(key=lambda r: r[0])
    tree = TernaryTree()
    tree.fill(rows)
    children, leaves, saving = tree.add_up()
    edge: dict[int, list] = {}
    for side, row in ((0, rows[0]), (1, rows[-1])):
        key, through = b"", 0
        for k in tree.path(row[0]):
            key = hashlib.blake2b(key + tree.code[k].to_bytes(8, "little", signed=True) if k else b"", digest_size=16).digest()
            through += tree.words[k]
            edge.setdefault(k, [key, False, False, through])[1 + side] = True
    for k in range(len(tree.code)):
        p = tree.parent[k]
        key, first, last, through = edge.get(k, (None, False, False, None))
        up_key = edge[p][0] if p in edge else None
        yield (
            shard, tree.depth[k], tree.n[k], tree.least[k], children[k], leaves[k], saving[k], tree.ends[k],
            tree.least[p] if p >= 0 and up_key is None else None, key, up_key, first, last, through, None if through is None else through - tree.words[k],
        )


def _range_tries(rows: DataFrame, range_turns: int) -> DataFrame:
    """The nodes of all ranges; the number of ranges follows from the number of turns."""
    size = rows.agg(F.sum(F.size("codes") + 1)).first()[0] or 0
    dealt = rows.repartitionByRange(max(1, -(-size // range_turns)), "codes").withColumn("shard", F.spark_partition_id())
    fields = [f.strip().split(" ") for f in _NODE.split(",")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        shard = 0
        for batch in batches:
            if batch.num_rows:
                shard = batch.column(5)[0].as_py()
                held.extend(zip(*(batch.column(k).to_pylist() for k in range(5))))
        made: list[tuple] = []
        for node in _range_nodes(shard, held) if held else ():
            made.append(node)
            if len(made) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[f[1]]) for c, f in zip(zip(*made), fields)], [f[0] for f in fields])
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[f[1]]) for c, f in zip(zip(*made), fields)], [f[0] for f in fields])

    return dealt.select("codes", "words", "n", "least", "ends", "shard").mapInArrow(run, _NODE)


_SUMS = ("n", "children", "leaves", "saved")


def _merged(edges: DataFrame) -> DataFrame:
    """``(key, least, up_key, depth, ends)`` and the sums of the nodes on borders, each once."""
    seen = edges.groupBy("key").agg(F.count(F.lit(1)).alias("ranges"), F.min("shard").alias("since"))
    told = edges.join(seen, "key")
    begun = told.filter("on_first and since < shard").select("shard", "key", "depth", "through", "before")
    deepest = begun.groupBy("shard").agg(F.max("depth").alias("deepest"), F.max("through").alias("to_words"))
    shared = begun.join(deepest, "shard").select(
        "key", F.lit(0).alias("n"), F.when(F.col("depth") < F.col("deepest"), -1).otherwise(0).alias("children"), F.lit(0).alias("leaves"),
        (F.col("to_words") - F.col("before")).alias("saved"),
    )
    going_on = told.filter("on_last and children = 0 and ranges > 1 and since = shard").select("shard")
    no_leaves = told.filter("on_last").join(going_on, "shard", "left_semi").select("key", F.lit(0).alias("n"), F.lit(0).alias("children"), F.lit(-1).alias("leaves"), F.lit(0).alias("saved"))
    parts = edges.select("key", *_SUMS).union(shared).union(no_leaves)
    sums = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in _SUMS])
    facts = edges.groupBy("key").agg(F.min("least").alias("least"), F.max("up_key").alias("up_key"), F.max("depth").alias("depth"), F.max("ends").alias("ends"))
    return facts.join(sums, "key")


def trie(talks: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """The nodes of the prefix trie of ``(conv_id, codes, words)``, one row per conversation.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``. A conversation without
    turns ends at the root. Equal conversations are members of the same nodes. An empty table has no node. A sequence of any
    length is one row, so a conversation must fit a task.
    """
    nodes = saved(_range_tries(saved(paths(talks), "paths"), range_turns), "trie")
    edges = nodes.filter("key is not null")
    merged = saved(_merged(edges), "borders")
    up = merged.select(F.col("key").alias("up_key"), F.col("least").alias("up_least"))
    border = merged.join(up, "up_key", "left").select("least", "depth", "up_least", *_SUMS, "ends")
    inner = nodes.filter("key is null")
    deep = inner.filter("up_key is null").select("least", "depth", "up_least", *_SUMS, "ends")
    # By range as well, since one node may have a large part of all nodes as its children.
    above = edges.select("shard", F.col("key").alias("up_key")).join(up, "up_key")
    top = inner.filter("up_key is not null").drop("up_least").join(above, ["shard", "up_key"]).select("least", "depth", "up_least", *_SUMS, "ends")
    every = border.union(deep).union(top)
    return every.select(
        F.col("least").alias("conv_id"), "depth", F.col("up_least").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
    )


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie(rebuilt(turns(table(spark, folder, "conversations"))))


# CRC-32 (polynomial EDB88320) bit by bit over the digits of an id.
OP12_SQL = r"""
WITH own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
ids AS (
    SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
           xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
               lambda c, b: list_reduce(list_concat([xor(c, b)], CAST(range(8) AS BIGINT[])), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
    FROM own
),
steps AS (
    SELECT conv_id, pos, role, text FROM own JOIN ids USING (conv_id) WHERE pos > h
    UNION ALL
    SELECT ids.conv_id, pos, role, text FROM ids JOIN own ON own.conv_id = base WHERE pos <= h
),
talks AS (
    SELECT ids.conv_id,
           coalesce(list(length(role) || ':' || role || text ORDER BY pos) FILTER (pos IS NOT NULL), []) AS seq,
           coalesce(list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS words
    FROM ids LEFT JOIN steps ON steps.conv_id = ids.conv_id GROUP BY ids.conv_id
),
nodes AS (
    SELECT seq[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n, coalesce(max(words[d]), 0) AS w,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(seq) = d), '')) AS ends
    FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM talks) GROUP BY 1, 2
),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.path = n.path),
below AS (
    SELECT path[1:d] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * w) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_nodes) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM full_nodes n JOIN below b ON b.path = n.path LEFT JOIN nodes p ON p.path = n.path[1:n.depth - 1] AND n.depth > 0
"""

QUERIES = {"op12_conversation_trie": op12_conversation_trie}
SQL = {"op12_conversation_trie": OP12_SQL}
