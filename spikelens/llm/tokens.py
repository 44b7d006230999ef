"""Token ids of whole texts by a public tokenizer file, cheap for long runs of common words."""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import public_tokenizers

from spikelens.llm.common import trim

WORD_BPE = "word_bpe_49k.json"

# The classes below are exact for these characters only; any other chunk is left to the tokenizer itself.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_ENDS = frozenset(".,;:!?")  # signs that make a piece of their own behind letters
_CACHE_CHUNKS = 400_000


def _byte_letters() -> str:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in printable else chr(next(spare)) for b in range(256))


class WordTokenizer:
    """Ids of a text, found chunk by chunk between blanks.

    No token crosses a blank, so a chunk's ids do not depend on its neighbours and are kept. Chunks of
    plain letters, digits and signs go to the vocabulary's merge rules directly; the rest go through the
    whole tokenizer. What is kept is bounded: the memory is emptied at ``_CACHE_CHUNKS`` chunks.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merge = self.whole.model
        self.letters = _byte_letters()
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.chunks: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.special = [t for t in self.whole.get_added_tokens_decoder().values()]
        self.marks = tuple(str(t.content) for t in self.special)
        self.signs = tuple({m[0] for m in self.marks if m})
        self.kind = next(k for k in "HILQ" if array(k).itemsize == self.dtype.itemsize)

    def _pack(self, ids: Iterable[int]) -> bytes:
        packed = array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            coded = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
            found = self.pieces[piece] = self._pack([t.id for t in self.merge.tokenize(coded)])
        return found

    def _chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk) and not (any(s in chunk for s in self.signs) and any(m in chunk for m in self.marks)):
            lower = chunk.lower()
            if lower.isalpha():
                return self._piece(lower)
            if lower[:-1].isalpha() and lower[-1] in _ENDS:
                return self._piece(lower[:-1]) + self._piece(lower[-1])
            return b"".join(map(self._piece, _PIECE.findall(lower)))
        return self._pack(self.whole.encode(chunk, add_special_tokens=False).ids)

    def packed(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian integers of ``dtype``."""
        if any(" " in m for m in self.marks):
            return self._pack(self.whole.encode(text, add_special_tokens=False).ids)
        words = text.replace("\n", " ").split(" ")
        if len(self.chunks) > _CACHE_CHUNKS:
            self.chunks = {"": b""}
        if len(self.pieces) > _CACHE_CHUNKS:
            self.pieces = {}
        known = self.chunks
        for word in set(words):
            if word not in known:
                known[word] = self._chunk(word)
        return b"".join(map(known.__getitem__, words))


@lru_cache(maxsize=2)
def tokenizer(name: str = WORD_BPE) -> WordTokenizer:
    """One tokenizer per process, until ``forget``; ``name`` is a file of the public tokenizers or a full path."""
    return WordTokenizer(name if os.path.isabs(name) else public_tokenizers.path(name))


def forget() -> None:
    """Let go of the tokenizers and all they keep: an idle worker would hold them through later stages."""
    tokenizer.cache_clear()
    trim()
