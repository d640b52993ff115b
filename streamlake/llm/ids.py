"""Token ids of whole texts through the tokenizers library, with a cache of repeated pieces.

The library takes about a second per megabyte, nearly all of it in pre-tokenization. Its
byte-pair step never looks across pre-tokens, so a text may be cut where a pre-token
certainly ends and each distinct piece encoded once. Where a cut is not certain, or the
text holds the string of an added token, the library gets the whole text.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np

CACHE_PIECES = 600_000  # with the next, bounds the cache at some 90 MB a worker, 220 MB at worst
CACHED_CHARS = 64  # a longer piece is encoded each time
# A run of these after a letter or digit is a pre-token of its own. No apostrophe: it starts contractions.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_CONTROL = ("\x1c", "\x1d", "\x1e", "\x1f")  # white space to Python, not to the tokenizer


def space_pieces(text: str) -> list[str] | None:
    """Cuts before single spaces and around single line feeds; None where white space is not
    that regular. For byte-level tokenizers that join one space to the word after it."""
    if len(text.split()) != 1 + text.count(" ") + text.count("\n") or "\x00" in text:
        return None
    return text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split("\x00")


def spaced_word(piece: str) -> str | None:
    """The piece, if it is letters with at most one space before them: a single pre-token."""
    return piece if piece.removeprefix(" ").isalpha() else None


def bare_pieces(text: str) -> list[str] | None:
    """The words; for tokenizers that drop white space and never join across it."""
    if any(c in text for c in _CONTROL):
        return None
    return text.split()


def lower_word(piece: str) -> str | None:
    """The normal form of a piece of letters whose lower case and composition are plain."""
    return piece.lower() if piece.isalpha() and max(piece) < "\u0130" else None


def byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write a byte as a character: printable ones as themselves, the
    others in turn from code point 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}


class _Pieces(dict):
    """Pieces and their ids; a new piece is learned when it is looked up."""

    def __init__(self, learn: Callable[[str], bytes]):
        self._learn = learn

    def __missing__(self, piece: str) -> bytes:
        return self._learn(piece)


class TextEncoder:
    """Texts to id arrays; one per worker and file, see ``encoder``.

    Strings of special tokens get the tokens' ids, as the library has it, unless
    ``special_as_text``.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task owns one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = special_as_text
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content for t in added if not t.normalized]
        self._added_lower = [t.content.lower() for t in added if t.normalized]
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._model = self._tokenizer.model
        self._letters = byte_letters()
        self._packs = [struct.Struct(f"<{n}{self.dtype.char}").pack for n in range(CACHED_CHARS)]
        self._pieces, self._word = self._cutters()
        self._cache = _Pieces(self._learn)

    def _cutters(self):
        """How texts are cut, and which pieces are one pre-token; by the kind of tokenizer."""
        spec = json.loads(self._tokenizer.to_str())
        before, normal = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
        steps = before.get("pretokenizers", [])
        if spec["model"]["type"] == "BPE":
            if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not normal:
                return space_pieces, spaced_word
            words = [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"]
            plain = [s["type"] for s in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            if words and plain and steps[0]["behavior"] == "Removed" and steps[0]["invert"]:
                return bare_pieces, lower_word
        return lambda text: None, lambda piece: None

    def _bytes(self, ids: list[int]) -> bytes:
        if len(ids) < CACHED_CHARS:
            return self._packs[len(ids)](*ids)
        return struct.pack(f"<{len(ids)}{self.dtype.char}", *ids)

    def _encode_word(self, word: str) -> bytes:
        """Ids of a single pre-token, straight from the byte-pair step; the rest of the way takes most of the time."""
        if word.isascii():
            shown = word.replace(" ", self._letters[0x20])  # ASCII letters are written as themselves
        else:
            shown = word.encode().decode("latin-1").translate(self._letters)
        return self._bytes([t.id for t in self._model.tokenize(shown)])

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [self._bytes(e.ids) for e in found]

    def _learn(self, piece: str) -> bytes:
        """Ids of a new piece, cached; one that ends in marks, from its two parts."""
        word = self._word(piece)
        if word is not None:
            found = self._encode_word(word)
        else:
            stem = piece.rstrip(_MARKS)
            if stem != piece and stem[-1:].isalnum():
                found = self._cache[stem] + self._cache[piece[len(stem) :]]
            else:
                found = self._encode([piece])[0]
        if len(piece) <= CACHED_CHARS:
            self._cache[piece] = found
        return found

    def _has_added(self, text: str) -> bool:
        """Whether the text holds the string of an added token, which pieces might cut."""
        lower = text.lower() if self._added_lower else ""
        return any(c in text for c in self._added) or any(c in lower for c in self._added_lower)

    def encode(self, texts: Iterable[str | None], end_id: int) -> Iterator[np.ndarray]:
        """Ids of each text (null: none), with ``end_id`` appended."""
        end = self._bytes([end_id])
        for text in texts:
            pieces = (None if self._has_added(text) else self._pieces(text)) if text else []
            if pieces is None:
                body = self._encode([text])[0]
            else:
                if len(self._cache) > CACHE_PIECES:
                    self._cache.clear()
                body = b"".join(map(self._cache.__getitem__, pieces))
            yield np.frombuffer(body + end, self.dtype)


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a tokenizer file; its cache lives across tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
