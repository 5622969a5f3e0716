"""Worker-side encoding of whole texts, pre-token by pre-token.

The tokenizer drops white space and merges only inside pre-tokens, so the ids
of a text are the ids of its pre-tokens in order. Each worker keeps the ids of
pre-tokens it has met in a bounded cache and asks the library only for new
ones. Texts of printable ASCII and Latin letters are cut with the tokenizer's
own pre-token pattern; a word with any other character, or with the start of
a special string, goes to the library as a whole.
"""

from __future__ import annotations

import re

import numpy as np

CACHE_ENTRIES = 400_000      # pre-tokens kept per worker; beyond that the cache starts anew
CACHED_LENGTH = 48           # longer pre-tokens are encoded but not kept

# Characters whose case folding, composition and letter class are those of
# plain Unicode tables in every library: printable ASCII, tab, line ends and
# the letters U+00C0..U+017F (without the signs D7 and F7, and without U+0130,
# whose lower case is two characters).
_SAFE = "\\t\\n\\r\\x20-\\x7eÀ-ÖØ-öø-įı-ſ"
_LETTER = "a-zß-öø-įı-ſ"
_SAFE_TEXT = re.compile(f"[{_SAFE}]*")
# Fixed value: the pattern of the tokenizer file, on lower-cased safe text.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^ \\t\\n\\r0-9{_LETTER}]+")
_GAP = re.compile("[ \\t\\n\\r]+")


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte (byte-level BPE rule:
    printable Latin-1 bytes are themselves, the others count up from 256)."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, n = [], 0
    for b in range(256):
        out.append(chr(b) if b in own else chr(256 + n))
        n += b not in own
    return out


class Tokens:
    """Library tokenizer and the cutting rule; ``ids`` are exact library ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.chars = _byte_chars()

    def pieces(self, text: str) -> list[str] | None:
        """Pre-tokens of a plain text; None if some word needs the library."""
        if _SAFE_TEXT.fullmatch(text) is None or "<|" in text:
            return None
        return _PIECE.findall(text.lower())

    def piece_ids(self, piece: str) -> list[int]:
        mapped = piece if piece.isascii() else "".join([self.chars[b] for b in piece.encode()])
        return [t.id for t in self.model.tokenize(mapped)]

    def word_ids(self, word: str) -> list[int]:
        return self.library.encode(word, add_special_tokens=False).ids

    def words(self, text: str) -> list[str]:
        return [w for w in _GAP.split(text) if w]


class IdBytes(dict):
    """pre-token -> its ids as little-endian bytes of ``dtype``; bounded."""

    def __init__(self, tokens: Tokens, dtype: str):
        super().__init__()
        self.tokens, self.dtype = tokens, dtype

    def __missing__(self, piece: str) -> bytes:
        value = np.array(self.tokens.piece_ids(piece), dtype=self.dtype).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = value
        return value

    def encode(self, text: str) -> bytes:
        pieces = self.tokens.pieces(text)
        if pieces is not None:
            return b"".join(map(self.__getitem__, pieces))
        out = []
        for word in self.tokens.words(text):
            pieces = self.tokens.pieces(word)
            if pieces is not None:
                out.extend(map(self.__getitem__, pieces))
            else:
                out.append(np.array(self.tokens.word_ids(word), dtype=self.dtype).tobytes())
        return b"".join(out)


_WORKER: dict = {}


def worker(key: str, version, make):
    """The object a worker process keeps between tasks. There is one at a time:
    a task that asks for another key or version frees the one before, so the
    caches of several operators never add up in a worker's memory."""
    if (key, version) not in _WORKER:
        _WORKER.clear()
        _WORKER[key, version] = make()
    return _WORKER[key, version]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
