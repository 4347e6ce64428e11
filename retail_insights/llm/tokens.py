"""Token ids of whole texts with the ``tokenizers`` library, inside a task.

The byte-level pre-tokenizer always splits before a single space that stands
between two other characters, and around a line break between two of them, so
a text is cut there.  The ids of a chunk are found once while a worker process
remembers it: plain words by the library's model, other chunks by the whole
library.  The store has two generations of bounded size: what is used moves to
the younger one, and when that is full the older one is dropped.  The ids do not
depend on it.

A worker process keeps one encoder for all its tasks.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np

END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Bytes that a generation of the chunk store may take, by the estimate below.
STORE_BYTES = 64 << 20
#: Bytes of an entry besides its characters and ids: two objects and a slot.
ENTRY_BYTES = 190

#: The special token of the vocabulary; its text in a document gives its id, as the library does by default.
MARK = "<|endoftext|>"
#: Marks that end a chunk often; after letters they are tokens of their own.
MARKS = frozenset(".,!?;:")
#: Letters below this character are letters in every version of Unicode in use.
LETTERS_BELOW = "\u0250"

_SPACES = re.compile(r"\s\s")
#: Other white space than the space and the line break, in ASCII and beyond.
OTHER_SPACES = [chr(c) for c in range(128) if chr(c).isspace() and c not in (10, 32)]
WIDE_SPACES = [chr(c) for c in range(128, 1 << 16) if chr(c).isspace()]
_CUT = re.compile(r"(?<=\S) (?=\S)")


def process_encoder(name: str = TOKENIZER) -> ChunkEncoder:
    """The encoder of this worker process, made at first use.  Task functions
    arrive by value, without the globals of their module, so it is kept with the
    interpreter."""
    kept = sys.__dict__.setdefault("_retail_insights_encoders", {})
    if name not in kept:
        kept[name] = ChunkEncoder(name)
    return kept[name]


def _is_word(chunk: str) -> bool:
    """Letters alone: the pre-tokenizer keeps them in one piece."""
    return chunk.isalpha() and (chunk.isascii() or max(chunk) < LETTERS_BELOW)


def _plainly_spaced(text: str) -> bool:
    """True if all white space of a text is single spaces and line breaks, none
    beside another.  Searches for fixed strings are much faster than the pattern."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return False
    return not any(c in text for c in OTHER_SPACES) and (
        text.isascii() or not any(c in text for c in WIDE_SPACES))


class _Chunks(dict):
    """Chunk -> ids (bytes); a missing one is found and kept."""

    def __init__(self, find, limit: int):
        self.find, self.limit, self.held, self.older = find, limit, 0, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.find(chunk)
        self.held += len(chunk) + len(ids) + ENTRY_BYTES
        if self.held > self.limit:
            self.older = dict(self)
            self.clear()
            self.held = len(chunk) + len(ids) + ENTRY_BYTES
        self[chunk] = ids
        return ids


class ChunkEncoder:
    """``encode(texts)`` gives one little-endian id array (bytes) per text,
    two bytes an id where the vocabulary allows it, else four."""

    def __init__(self, name: str = TOKENIZER, store_bytes: int = STORE_BYTES):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenize = self.tok.model.tokenize
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # The vocabulary's characters for bytes: printable ones of Latin-1 stand for themselves, the others follow 255.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.signs = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)).difference(plain)))}
        self.space, self.line = self.signs[32], self.library("\n")
        self.first = _Chunks(self._first, store_bytes // 4)  # chunks that begin a text
        self.rest = _Chunks(self._rest, store_bytes)  # chunks after a space, or that begin with a line break

    def _packed(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def library(self, text: str) -> bytes:
        return self._packed(self.tok.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str, lead: str) -> bytes:
        """Ids of a word after ``lead``, by the library's model in its own
        characters (those of ASCII letters are the letters)."""
        piece = word if word.isascii() else word.encode().decode("latin-1").translate(self.signs)
        return self._packed([t.id for t in self.tokenize(lead + piece)])

    def _first(self, chunk: str) -> bytes:
        return self._word(chunk, "") if _is_word(chunk) else self.library(chunk)

    def _rest(self, chunk: str) -> bytes:
        if _is_word(chunk):
            return self._word(chunk, self.space)
        if chunk[-1:] in MARKS:
            head = chunk[:-1]
            if _is_word(head) or head[:1] == "\n" and _is_word(head[1:]):
                return self.rest[head] + self.first[chunk[-1]]  # a word and the one mark after it are two pieces
        if chunk[:1] == "\n":
            # The line break is a piece of its own, and the word after it takes no space.
            return self.line + self.first[chunk[1:]] if _is_word(chunk[1:]) else self.library(chunk)
        return self.library(" " + chunk)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        first, found, out = self.first, self.rest.__getitem__, []
        for t in texts:
            t = t or ""
            # Where no two white-space characters meet, a line break starts a chunk that takes no space.
            plain = _plainly_spaced(t) or not _SPACES.search(t)
            parts = t.replace("\n", " \n").split(" ") if plain else _CUT.split(t)
            head = first[parts[0]]
            del parts[0]
            out.append(head + b"".join(map(found, parts)))
        return out
