"""Token ids of public tokenizers, with a cache of word pieces.

Both vocabularies never join what a single space parts, so a text is encoded
piece by piece and equal pieces only once.  Plain words go straight to the
tokenizer's model; all else goes through the whole tokenizer.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: A worker keeps at most so many pieces, then starts anew.
CACHE_LIMIT = 400_000

_PARTS = re.compile(r"(?<=\S)(?=[ \n]\S)")


def _byte_chars() -> list[str]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stays, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Pieces(dict):
    """Maps a piece of text to its ids, packed as little-endian unsigned integers.

    ``lead`` is what stands before each piece: a space, a line's end or nothing.
    """

    def __init__(self, owner: PieceEncoder, lead: str):
        super().__init__()
        self.owner, self.lead = owner, lead

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_LIMIT:
            self.clear()
        word = piece.rstrip(".,")
        o = self.owner
        if word.isalpha() and (word.isascii() or max(word) < "Ā"):
            found = o.word(self.lead + word) if self.lead != "\n" else o.word("\n") + o.word(word)
            if len(word) < len(piece):
                found += o.word(piece[len(word) :])
        else:
            found = o.packed(self.lead + piece)
        self[piece] = found
        return found


class PieceEncoder:
    """A tokenizer with its caches."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.lower = self.whole.normalizer is not None
        self.dtype = np.dtype("<u2") if self.whole.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.chars = {b: c for b, c in enumerate(_byte_chars())}
        self.words: dict[str, bytes] = {}
        self.bare, self.spaced, self.broken = Pieces(self, ""), Pieces(self, " "), Pieces(self, "\n")

    def packed(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def word(self, text: str) -> bytes:
        """The ids of one word of the tokenizer's own splitting."""
        if self.lower:
            text = text.lower()
        found = self.words.get(text)
        if found is None:
            mapped = text.encode().decode("latin-1").translate(self.chars)
            found = np.array([t.id for t in self.model.tokenize(mapped)], self.dtype).tobytes()
            if len(self.words) >= CACHE_LIMIT:
                self.words.clear()
            self.words[text] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if not text:
            return np.zeros(0, self.dtype)
        if self.lower:
            bare = self.bare
            return np.frombuffer(b"".join([bare[p] for p in text.replace("\n", " ").split(" ") if p]), self.dtype)
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[-1] in " \n" or text[0] in " \n":
            return np.frombuffer(b"".join([self._any(p) for p in _PARTS.split(text)]), self.dtype)
        spaced, broken, out = self.spaced, self.broken, []
        for k, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            out.append(broken[first] if k else self.bare[first])
            out += [spaced[p] for p in rest]
        return np.frombuffer(b"".join(out), self.dtype)

    def _any(self, part: str) -> bytes:
        """A part that starts with one space or line end at most, or with an unusual run of white space."""
        if any(c.isspace() for c in part[1:]):
            return self.packed(part)
        if part[:1] == " ":
            return self.spaced[part[1:]]
        return self.broken[part[1:]] if part[:1] == "\n" else self.bare[part]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process and vocabulary."""
    return PieceEncoder(path)


def resolve(tokenizer: str | Callable[[], str]) -> str:
    """The place of a vocabulary file, on whatever machine this runs."""
    if callable(tokenizer):
        return tokenizer()
    if "/" in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)
