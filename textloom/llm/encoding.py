"""Exact encoding of whole texts with the tokenizers library, each distinct piece once.

A byte-pair tokenizer cuts a text into pieces before it merges anything, and no merge
crosses a piece. So a text may be cut at points that are always piece borders, and the
ids of a chunk between two such points depend on the chunk alone. Chunks repeat far more
often than texts do; each worker keeps the ids of recent chunks in a bounded memo. What
is not in the memo goes piece by piece to the library's own merge model, and a text
whose white space makes the safe points doubtful goes to the library whole.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import regex

#: The piece patterns of the two public vocabularies, as their files state them.
BYTE_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_SPACE_INSIDE = regex.compile(r"\s")
_READY: dict[str, "Encoder"] = {}


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str) -> "Encoder":
    """This process's encoder for a vocabulary file's name or path; its memo lives as long as the worker."""
    if name not in _READY:
        _READY[name] = Encoder(name if os.path.sep in name else vocabulary(name))
    return _READY[name]


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte.

    Printable Latin-1 bytes stand for themselves; the others take the letters from
    U+0100 on, in ascending order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()
_SPACE = _LETTERS[0x20]


class Memo(dict):
    """The ids of recent keys: two generations of at most `cap` keys, the older one dropped whole."""

    def __init__(self, make, cap: int):
        super().__init__()
        self.make, self.cap, self.older = make, cap, {}

    def __missing__(self, key):
        found = self.older.get(key, self)
        if found is self:
            found = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.cap:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class Encoder:
    """Ids (and character spans) of whole texts under one vocabulary file.

    Word-end vocabularies lower-case and drop white space, byte-level ones keep every
    byte. Both give exactly what Tokenizer.encode(text, add_special_tokens=False) gives; so
    a text that holds the string of an added token goes to the library whole.
    """

    def __init__(self, path: str, memo: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        added = self.whole.get_added_tokens_decoder().values()
        self._added = tuple(t.content for t in added if not t.normalized)
        self._added_lower = tuple(t.content.lower() for t in added if t.normalized)  # found in normalised texts
        self.model = self.whole.model
        self._tokenize = self.model.tokenize
        self.words = self.model.end_of_word_suffix is not None
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self._pieces = regex.compile(WORD_PIECES if self.words else BYTE_PIECES)
        self._code = self.dtype.char
        self._ids = Memo(self._word_ids if self.words else self._chunk_ids, memo)
        self._spans = Memo(self._chunk_spans, memo)
        self._get, self._get_spans = self._ids.__getitem__, self._spans.__getitem__

    def ids(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text; null and empty texts have none."""
        if not text:
            return np.zeros(0, self.dtype)
        if self._holds_added(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.dtype)
        if self.words:
            return np.frombuffer(b"".join(map(self._get, text.replace("\n", " ").split(" "))), self.dtype)
        if "\0" not in text:
            try:
                return np.frombuffer(b"".join(map(self._get, _chunks(text))), self.dtype)
            except TypeError:  # a chunk that only the whole text can settle
                pass
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.dtype)

    def spans(self, text: str | None) -> np.ndarray:
        """Start and end of each token in characters, one row a token; byte-level vocabularies only.

        A character whose bytes fall to several tokens lies in the span of each.
        """
        if self.words:
            raise ValueError("spans are kept for byte-level vocabularies")
        if not text:
            return np.zeros((0, 2), np.int64)
        if "\0" not in text and not self._holds_added(text):
            chunks = _chunks(text)
            try:
                found = list(map(self._get_spans, chunks))
                inside = np.frombuffer(b"".join(found), "<u2").reshape(-1, 2).astype(np.int64)
            except TypeError:
                pass
            else:
                sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
                counts = np.fromiter(map(len, found), np.int64, len(found)) >> 2
                return inside + np.repeat(np.cumsum(sizes) - sizes, counts)[:, None]
        return np.array(self.whole.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)

    def _holds_added(self, text: str) -> bool:
        for content in self._added:
            if content in text:
                return True
        return bool(self._added_lower) and any(content in text.lower() for content in self._added_lower)

    def _word_ids(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if max(chunk) >= "\u0250":  # beyond Latin letters, normalisation is the library's business
            return array(self._code, self.whole.encode(chunk, add_special_tokens=False).ids).tobytes()
        chunk = chunk.lower()
        if chunk.isalpha():
            return array(self._code, [t.id for t in self._tokenize(chunk)]).tobytes() if chunk.isascii() else self._merged(chunk)
        pieces = self._pieces.findall(chunk)
        return self._merged(chunk) if pieces == [chunk] else b"".join(map(self._get, pieces))

    def _chunk_ids(self, chunk: str) -> bytes | None:
        """Ids of a chunk that is one piece, or of its pieces, each of which is a chunk too."""
        rest = chunk[1:]
        if rest.isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
            if chunk.isascii():  # letters stand for themselves
                return array(self._code, [t.id for t in self._tokenize(_SPACE + rest if chunk[0] == " " else chunk)]).tobytes()
            return self._merged(chunk)
        if _doubtful(chunk):
            return None
        pieces = self._pieces.findall(chunk)
        return self._merged(chunk) if pieces == [chunk] else b"".join(map(self._get, pieces))

    def _merged(self, piece: str) -> bytes:
        return array(self._code, [t.id for t in self._tokens(piece)]).tobytes()

    def _tokens(self, piece: str):
        return self._tokenize(piece.encode().decode("latin-1").translate(_LETTERS))

    def _chunk_spans(self, chunk: str) -> bytes | None:
        if _doubtful(chunk) or len(chunk) > 60_000:
            return None
        spans, at = [], 0
        for piece in self._pieces.findall(chunk):
            owner = [at + i for i, c in enumerate(piece) for _ in c.encode()]
            byte = 0
            for token in self._tokens(piece):
                after = byte + len(token.value)
                spans += (owner[byte], owner[after - 1] + 1)
                byte = after
            at += len(piece)
        return np.array(spans, "<u2").tobytes()


def _chunks(text: str) -> list[str]:
    """Cut before every space and on both sides of every line feed."""
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


def _doubtful(chunk: str) -> bool:
    """Whether white space may join with that of the next chunk, so that a cut is no piece border.

    True for an empty chunk (two cuts met), a space alone, and any white space besides a
    leading space or a line feed alone.
    """
    return chunk in ("", " ") or chunk != "\n" and _SPACE_INSIDE.search(chunk, 1) is not None or chunk[0].isspace() and chunk[0] not in " \n"
