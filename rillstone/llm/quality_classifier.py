"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded, a gated attention gives each a weight, and the
weighted sum of the encodings is scored. Encoder, attention and score are learned together from labels of documents
alone. Fitting uses a bounded sample of labelled documents, at most ``SAMPLE`` with ``FITTED`` passages in all, each of them
with all of its passages; every passage of every document takes part in its score.
"""

from __future__ import annotations

import re
from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import add_columns, saved, table

PASSAGE = 64
SAMPLE = 2000
FITTED = 50_000
FOLDS = 5
CUT = 0.3
# Texts are encoded in stretches of about so many bytes.
STRETCH = 1 << 20

_GROUPS = (b" \t\x0b\x0c\r", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b"!?", b"|", b"#", b"*", b"$", b"%", b"&", b"<>", bytes(range(128, 256)))
_CLASS = np.full(256, len(_GROUPS), "i8")
for _k, _own in enumerate(_GROUPS):
    _CLASS[list(_own)] = _k
CLASSES = len(_GROUPS) + 1
PAIRS = 64
WIDTH = CLASSES + PAIRS + 3


_NEXT_WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]*[ \t\n\x0b\x0c\r]+|[^ \t\n\x0b\x0c\r]+\Z")


def _stretches(text: bytes):
    """Parts of the text that end before a word; all but the last have a whole number of passages."""
    at = 0
    while at < len(text):
        end = at + STRETCH
        if end < len(text):
            end = _NEXT_WORD.match(text, end - 1).end()
            for _ in range(-len(text[at:end].split()) % PASSAGE):
                step = _NEXT_WORD.match(text, end)
                end = step.end() if step else len(text)
        yield text[at:end]
        at = end


def _encode(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, "u1")
    classes = _CLASS[raw]
    letter = classes > 1
    starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
    words = text.split()
    if not words:
        return np.zeros((0, WIDTH))
    bounds = starts[::PASSAGE].copy()
    bounds[0] = 0
    n = len(bounds)
    sizes = np.diff(np.append(bounds, len(raw)))
    own = np.repeat(np.arange(n), sizes)
    counts = np.bincount(own * CLASSES + classes, minlength=n * CLASSES).reshape(n, CLASSES)
    pair = (raw[:-1].astype("i8") * 37 + raw[1:]) % PAIRS
    pairs = np.bincount(own[:-1] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
    many = np.diff(np.append(np.arange(0, len(words), PASSAGE), len(words)))
    again = np.add.reduceat(np.fromiter(map(eq, words, [b"", *words[:-1]]), "f8", len(words)), np.arange(0, len(words), PASSAGE))
    different = np.array([len(set(words[i : i + PASSAGE])) for i in range(0, len(words), PASSAGE)])
    return np.column_stack([np.sqrt(counts / sizes[:, None]), np.sqrt(pairs / sizes[:, None]), again / many, different / many, sizes / many / 10])


def passages(text: bytes | None) -> np.ndarray:
    """A row per passage; a text without words is one passage of noughts."""
    parts = [_encode(s) for s in _stretches(text or b"")]
    rows = np.concatenate(parts) if parts else np.zeros((0, WIDTH))
    return rows if len(rows) else np.zeros((1, WIDTH))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    def __init__(self, mean, scale, weights: dict[str, np.ndarray], constant: float | None = None):
        self.mean, self.scale, self.weights, self.constant = mean, scale, weights, constant

    def score(self, rows: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        w = self.weights
        h = np.tanh((rows - self.mean) / self.scale @ w["E"] + w["e"])
        s = (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["w"]
        a = np.exp(s - s.max())
        return float(_sigmoid((a / a.sum()) @ h @ w["c"] + w["b"][0]))


def fit(bags: list[np.ndarray], labels: list[int], hidden: int = 24, gates: int = 12, steps: int = 200, seed: int = 5) -> Model:
    """Full-batch Adam on the logarithmic loss. Without both labels the score is constant."""
    if len(set(labels)) < 2:
        return Model(None, None, {}, float(labels[0]) if labels else 0.5)
    y = np.array(labels, "f8")
    flat = np.concatenate(bags)
    mean, scale = flat.mean(0), np.maximum(flat.std(0), 0.02)
    x = (flat - mean) / scale
    sizes = np.array([len(b) for b in bags])
    first = np.cumsum(sizes) - sizes
    spread = lambda v: np.repeat(v, sizes, axis=0)  # noqa: E731, from documents to their passages
    within = lambda v: np.add.reduceat(v, first, axis=0)  # noqa: E731, sums over the passages of each document
    r = np.random.default_rng(seed)
    shapes = {"E": (x.shape[1], hidden), "e": (hidden,), "V": (hidden, gates), "U": (hidden, gates), "w": (gates,), "c": (hidden,), "b": (1,)}
    w = {k: r.normal(0, s[0] ** -0.5, s) if len(s) > 1 or k in "wc" else np.zeros(s) for k, s in shapes.items()}
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        h = np.tanh(x @ w["E"] + w["e"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        s = (t * g) @ w["w"]
        a = np.exp(s - spread(np.maximum.reduceat(s, first)))
        a /= spread(within(a))
        z = within(a[:, None] * h)
        d = (_sigmoid(z @ w["c"] + w["b"][0]) - y) / len(y)
        dz = spread(d[:, None] * w["c"])
        da = (dz * h).sum(1)
        ds = a * (da - spread(within(a * da)))
        dt, dg = ds[:, None] * w["w"] * g * (1 - t * t), ds[:, None] * w["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        grads = {"E": x.T @ dh, "e": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds, "c": z.T @ d, "b": d.sum(keepdims=True)}
        for k, v in w.items():
            grad = grads[k] + 1e-4 * v * (v.ndim > 1)
            m1[k] = 0.9 * m1[k] + 0.1 * grad
            m2[k] = 0.999 * m2[k] + 0.001 * grad * grad
            w[k] = v - 0.01 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def fold(doc_id):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE,
    fitted: int = FITTED,
) -> Model:
    """Fit on at most ``sample`` labelled documents of the folds 1 to 4, those first by a hash of their ids.

    A document with several labels takes the greatest; null ids and labels are left out. Documents are taken whole, in the
    order of the hash, as long as they have at most ``fitted`` passages together, and only these reach the driver; one that
    would go beyond is passed over.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_y")).filter("_id IS NOT NULL AND _y IS NOT NULL")
    known = known.filter(fold("_id") != 0).groupBy("_id").agg(F.max("_y").alias("_y"))
    chosen = known.select("_id", "_y", F.xxhash64("_id").alias("_turn")).orderBy("_turn", "_id").limit(sample)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("_text")).join(F.broadcast(chosen), "_id")

    def work(raw):
        made = [passages(t) for t in raw]
        return [[len(m) for m in made], [m.astype("f4").ravel() for m in made]]

    found = add_columns(texts, ["_text"], "n bigint, rows array<float>", work, keep=["_id", "_y", "_turn"])
    found = saved(found, "passages")
    taken, left = [], fitted
    for r in sorted(found.groupBy("_id", "_turn").agg(F.max("n").alias("n")).collect(), key=lambda r: (r["_turn"], r["_id"])):
        if r["n"] <= left:
            taken.append(r["_id"])
            left -= r["n"]
    one = found.filter(F.col("_id").isin(taken)).groupBy("_id").agg(F.max(F.struct("n", "_y", "rows")).alias("bag")).collect()
    bags = [r["bag"] for r in sorted(one, key=lambda r: r["_id"])]
    return fit([np.array(b["rows"], "f8").reshape(-1, WIDTH) for b in bags], [int(b["_y"] > 0) for b in bags])


def score(docs: DataFrame, model: Model, text: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with ``score`` between 0 and 1 and ``predicted``; whole texts, no shuffle.

    Null and empty texts, and texts without words, are scored as one passage of noughts. Repeated rows get the same
    score, columns that already have one of the new names are replaced, an empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    own = [f"_{k}" for k in range(len(kept))]
    raw = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(kept, own)], F.col(text).cast("binary").alias("_raw"))

    def work(texts):
        scores = [model.score(passages(t)) for t in texts]
        return [scores, [int(s >= cut) for s in scores]]

    made = add_columns(raw, ["_raw"], "score double, predicted int", work, keep=own)
    return made.select(*[F.col(o).alias(c) for c, o in zip(kept, own)], "score", "predicted")


def op7_attention_bags(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = train(docs, table(spark, folder, "labels"))
    scored = score(docs, model).drop("text")
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")


QUERIES = {"op7_attention_bags": op7_attention_bags}
SQL: dict[str, str] = {}
