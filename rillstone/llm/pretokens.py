"""Encoding texts by their pre-tokens: each different pre-token is merged once, then looked up."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

# Characters whose class, case and composition are the same for Python and for the tokenizers library.
# A text with any other character is encoded whole by the library.
PLAIN = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xa1-įı-ſ‐-‧]*")
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACE = "\t\n\x0b\x0c\r\x20"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# The splits named in the two vocabulary files, over plain characters.
WORD_SPLIT = f"{CONTRACTIONS}|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+"
BYTE_SPLIT = f"{CONTRACTIONS}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

# Remembered pre-tokens of a worker; beyond it the worker starts anew.
REMEMBERED = 300_000


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The letter that stands for a byte in the vocabulary: printable bytes themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Pieces:
    """Values of texts as sums of the values of their pre-tokens.

    ``value`` turns the ids of a pre-token into what is remembered. ``start`` holds values known beforehand.
    """

    def __init__(self, path: str, split: str, lower: bool, value: Callable[[list[int]], object], start: dict | None = None):
        self.library = tokenizer(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.find = re.compile(split).findall
        self.lower, self.value, self.start = lower, value, start or {}
        self.known = dict(self.start)

    def split(self, text: str) -> list[str] | None:
        """The pre-tokens of a text, or None where only the library may split it."""
        if not PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return None
        return self.find(text.lower() if self.lower else text)

    def merged(self, part: str) -> list[int]:
        """Ids of one pre-token."""
        letters = part.encode().decode("latin-1").translate(byte_letters())
        return [t.id for t in self.model.tokenize(letters)]

    def values(self, texts: Iterable[str | None]) -> Iterable[list]:
        """For each text the values of its pre-tokens (of the whole text where the library splits it)."""
        for text in texts:
            parts = self.split(text or "")
            if parts is None:
                yield [self.value(self.library.encode(text, add_special_tokens=False).ids)]
                continue
            known = self.known
            try:
                yield [known[p] for p in parts]
            except KeyError:
                if len(known) > REMEMBERED:
                    self.known = known = dict(self.start)
                new = [p for p in dict.fromkeys(parts) if p not in known]
                for p in new:
                    known[p] = self.value(self.merged(p))
                yield [known[p] for p in parts]
