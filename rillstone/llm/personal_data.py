"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and telephone numbers. The field then labels every token that holds a
digit or an at sign. Neighbouring tokens share a potential, and so do distant tokens that are equal or alike (the same
letters and digits, the same last digits, the local part of an address). Loopy message passing makes their labels agree,
so that a number found once is also found where it is written differently in the same document. Tokens of pattern
spans keep their labels; tokens of other labels become further spans.

All potentials are counted over the whole corpus, with the pattern spans as labels (piecewise training).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from math import log

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import add_columns, emit_rows, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_HINT = re.compile("[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile("[^0-9]+")
_NOT_ALNUM = re.compile("[^0-9A-Za-z]+")
_EDGE = "\"'`.,;:!?*#$%&|<>[]{}()=/\\"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, end := m.end()))
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches, leftmost and non-overlapping for each kind; by kind as listed, then start."""
    out = [("email", s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def tokens_of(text: str) -> list[tuple[int, int, int]]:
    """(number of the word, start, end) of words with a digit or an at sign, without punctuation around them."""
    out = []
    for n, m in enumerate(_TOKEN.finditer(text)):
        word = m[0]
        if _HINT.search(word):
            left = len(word) - len(word.lstrip(_EDGE))
            out.append((n, m.start() + left, m.start() + len(word.rstrip(_EDGE))))
    return [t for t in out if t[1] < t[2]]


def shape(word: str) -> str:
    """The features of a token that its own potential depends on."""
    digits = _NOT_DIGIT.sub("", word)
    size = min(len(digits), 20)
    letters = any(c.isalpha() for c in word)
    lengths = "0" if not size else "1-6" if size < 7 else "7-15" if size < 16 else "16-19" if size < 20 else "20+"
    return f"{lengths} {min(word.count('.'), 4)} {int('@' in word)} {int(word[0] == '+')} {int(letters)} {int(16 <= size <= 19 and luhn(digits))}"


def alike_keys(word: str) -> list[str]:
    """Tokens with a common key share a potential."""
    plain, digits = _NOT_ALNUM.sub("", word).lower(), _NOT_DIGIT.sub("", word)
    keys = []
    if len(plain) >= 6:
        keys.append("=" + plain)
    if len(digits) >= 7 and len(digits) >= len(plain) - 1:
        keys.append("#" + digits[-7:])
    local = _NOT_ALNUM.sub("", word.partition("@")[0]).lower()
    if len(local) >= 5 and ("@" in word or local != digits):
        keys.append("@" + local)
    return keys


def skip_edges(words: list[str]) -> list[tuple[int, int]]:
    """Each token with the last one of the same key, and with the first."""
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    edges = {}
    for k, word in enumerate(words):
        for key in alike_keys(word):
            if key in first:
                edges[last[key], k] = edges[first[key], k] = None
            first.setdefault(key, k)
            last[key] = k
    return [*edges]


def chain_edges(numbers: list[int]) -> list[tuple[int, int]]:
    return [(k, k + 1) for k in range(len(numbers) - 1) if numbers[k + 1] == numbers[k] + 1]


def observed(tokens: list[tuple[int, int, int]], spans: list[tuple[str, int, int]]) -> list[int]:
    """The label of each token: the first listed kind of span that it overlaps, else 0."""
    out = [0] * len(tokens)
    for kind in reversed(KINDS):
        own, k = [s for s in spans if s[0] == kind], 0
        for _, s, e in own:
            while k < len(tokens) and tokens[k][2] <= s:
                k += 1
            j = k
            while j < len(tokens) and tokens[j][1] < e:
                out[j] = LABELS.index(kind)
                j += 1
    return out


def factor_counts(text: str) -> Counter:
    """What one document adds to the counts of the factors."""
    tokens = tokens_of(text)
    words = [text[s:e] for _, s, e in tokens]
    labels = observed(tokens, base_spans(text))
    counts = Counter((f"own {shape(w)}", 0, y) for w, y in zip(words, labels))
    counts.update(("chain", labels[a], labels[b]) for a, b in chain_edges([t[0] for t in tokens]))
    counts.update(("skip", *sorted((labels[a], labels[b]))) for a, b in skip_edges(words))
    return counts


# Counts assumed beforehand, for equal labels and for others: like tokens have like labels, neighbours have any.
_ASSUMED = {"skip": (10.0, 0.05), "chain": (1.0, 1.0)}
_LEAST = 0.02
_MOST = 4.0


class Field:
    """Potentials from counts of (factor, label, label)."""

    def __init__(self, counts: dict[tuple[str, int, int], int]):
        n = len(LABELS)
        own: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n))
        pair = {k: np.full((n, n), other) + np.eye(n) * (equal - other) for k, (equal, other) in _ASSUMED.items()}
        for (factor, a, b), c in counts.items():
            if factor.startswith("own "):
                own[factor[4:]][b] += c
            else:
                pair[factor][a, b] += c
        self.own = {k: np.log(np.maximum(v / v.sum(), _LEAST)) for k, v in own.items()}
        self.unknown = np.array([0.0] + [log(_LEAST)] * (n - 1))
        self.pair = {}
        for k, v in pair.items():
            v = v + v.T if k == "skip" else v
            p = v / v.sum()
            self.pair[k] = np.clip(np.log(p / p.sum(1, keepdims=True) / p.sum(0, keepdims=True)), -_MOST, _MOST)

    def labels(self, tokens: list[tuple[int, int, int]], words: list[str], known: list[int], rounds: int = 12) -> list[int]:
        """Most likely label of each token after loopy message passing (in logarithms, damped by half)."""
        if not tokens:
            return []
        score = np.array([self.own.get(shape(w), self.unknown) for w in words])
        for k, y in enumerate(known):
            if y:
                score[k] = -30.0
                score[k, y] = 0.0
        chain, skip = chain_edges([t[0] for t in tokens]), skip_edges(words)
        if not skip:
            return known  # without distant links only the patterns speak
        edges = np.array(chain + skip)
        potential = np.stack([self.pair["chain"]] * len(chain) + [self.pair["skip"]] * len(skip))
        source, target = np.concatenate([edges, edges[:, ::-1]]).T
        potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
        half = len(edges)
        back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
        sent = np.zeros((2 * half, len(LABELS)))
        for _ in range(rounds):
            belief = score.copy()
            np.add.at(belief, target, sent)
            out = belief[source] - sent[back]
            new = np.logaddexp.reduce(out[:, :, None] + potential, axis=1)
            new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
            if np.abs(new - sent).max() < 1e-6:
                break
            sent = (sent + new) / 2
        belief = score.copy()
        np.add.at(belief, target, sent)
        linked = {k for e in skip for k in e}
        return [y or (int(belief[k].argmax()) if k in linked else 0) for k, y in enumerate(known)]

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Spans of tokens outside the pattern spans; neighbours of one label are one span."""
        tokens = tokens_of(text)
        words = [text[s:e] for _, s, e in tokens]
        known = observed(tokens, base)
        out: list[tuple[str, int, int]] = []
        before = None
        for (n, s, e), old, y in zip(tokens, known, self.labels(tokens, words, known)):
            if y and not old:
                kind = LABELS[y]
                if before == (n - 1, kind):
                    out[-1] = (kind, out[-1][1], e)
                else:
                    out.append((kind, s, e))
                before = (n, kind)
            else:
                before = None
        return out

    def spans(self, text: str) -> tuple[list, list]:
        """(pattern spans, all spans), each by kind as listed, then start."""
        if not _HINT.search(text):
            return [], []
        base = base_spans(text)
        order = {k: n for n, k in enumerate(KINDS)}
        return base, sorted(base + self.added(text, base), key=lambda s: (order[s[0]], s[1:]))


def train(docs: DataFrame, text: str = "text") -> Field:
    """Counts over all documents. The table that reaches the driver has a row per shape and label pair, a few hundred."""

    def work(texts):
        counts: Counter = Counter()
        for t in texts:
            if t and _HINT.search(t):
                counts.update(factor_counts(t))
        return [*zip(*((f, a, b, n) for (f, a, b), n in counts.items()))] or [[], [], [], []]

    rows = emit_rows(docs, [text], "factor string, a int, b int, n bigint", work)
    return Field({(r.factor, r.a, r.b): r.n for r in rows.groupBy("factor", "a", "b").agg(F.sum("n").alias("n")).collect()})


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with counts of the pattern spans, their digest and all spans; no shuffle.

    Spans are ``kind:start:end`` in code points. A null text is empty; a text without digits and at signs has no spans.
    Texts of any length are read whole in time that grows with their length, repeated rows are treated alike, and columns
    that already have one of the new names are replaced. An empty table gives an empty one.
    """

    def work(texts):
        base, every = zip(*(field.spans(t or "") for t in texts))
        counts = [[sum(s[0] == k for s in b) for b in base] for k in KINDS]
        return [*counts, [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], [_joined(e) for e in every]]

    return add_columns(
        docs, [text], "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string", work
    )


def redact(docs: DataFrame, field: Field, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; a column ``length`` is brought up to date."""

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        out, end = [], 0
        for kind, s, e in sorted(field.spans(t)[1], key=lambda x: (x[1], -x[2])):
            if s >= end:
                out += [t[end:s], f"[{kind.upper()}]"]
            end = max(end, e)
        return "".join([*out, t[end:]])

    changed = add_columns(docs, [text], f"`{text}` string", lambda texts: [[clean(t) for t in texts]])
    if length in docs.columns:
        changed = changed.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return changed.select(*[f"`{c}`" for c in docs.columns])


def op3_skip_chain_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return find(docs, train(docs)).drop("text")


QUERIES = {"op3_skip_chain_crf": op3_skip_chain_crf}
SQL: dict[str, str] = {}
