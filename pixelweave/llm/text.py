"""Words, bytes and tokens of whole texts, as the language operators see them inside a task."""

from __future__ import annotations

import gc
import os
import re
import struct
import sys
import types
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# Fixed value: the characters that separate words, x20 and x09-x0D. bytes.split()
# without an argument cuts at exactly these.
SPACES = " \t\n\r\x0b\x0c"

# Entries of a worker's word cache before it starts anew; about 200 bytes each.
CACHED_WORDS = 700_000


def texts(column: pa.Array) -> list[str]:
    """Python strings of a text column; null counts as empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


def few_texts(column: pa.Array, rows: int = 500) -> Iterator[list[str]]:
    """``texts`` of some rows at a time, so that a worker holds no batch twice."""
    for first in range(0, len(column), rows):
        yield texts(column.slice(first, rows))


def first_of_each(batch: pa.RecordBatch, columns: Sequence[str], seen: set[tuple]) -> pa.RecordBatch:
    """The rows whose values in ``columns`` are not in ``seen`` yet, which learns them. For few
    distinct values."""
    first = []
    for values in zip(*(batch.column(c).to_pylist() for c in columns)):
        first.append(values not in seen)
        seen.add(values)
    return batch.filter(pa.array(first, pa.bool_()))


def words_of(text: str) -> list[bytes]:
    """Maximal runs of characters that are no separators, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def word_chars(text: str) -> int:
    """Code points that belong to words."""
    return len(text) - sum(map(text.count, SPACES))


def fold(key: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of a key's text; null keys fall into fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


# Marks between an ASCII letter and white space are a token run of their own.
_MARK = "[.,;:!?*#$%&]"
_MARKS = re.compile(rf"{_MARK}(?<=[A-Za-z]{_MARK}){_MARK}*(?=[ \n])")

# Words that one call of the library encodes.
_TOGETHER = 20_000

# Words of Latin letters whose normal form is their lower case: one token run each, for which the
# library's merges are enough.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


_SHOWN = str.maketrans({chr(byte): shown for shown, byte in byte_level().items()})


class Encoder:
    """Token ids of texts by a tokenizers file, as little-endian unsigned 32-bit bytes.

    The file drops white space and separates letters from marks before its merges, so no token
    spans a blank, a line end or the place between a word and its closing marks, and a text's ids are the
    ids of the pieces between these in order. Each distinct piece is encoded once by the
    library and kept for the worker's life; the cache starts anew when it holds
    ``cached`` entries, so memory is bounded and results are not affected.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        self._cached = cached
        # Spark runs a task per core already; more threads only add to the work.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        holder = sys.modules.setdefault("_word_ids", types.ModuleType("_word_ids"))
        if getattr(holder, "path", None) != path:
            holder.path, holder.words = path, {}
            holder.tokenizer = Tokenizer.from_file(path)
        self._held = holder

    def encode_column(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of every text of a column; null counts as empty."""
        for part in few_texts(column):
            yield from self.encode(part)

    def encode(self, batch: Sequence[str]) -> Iterable[bytes]:
        """Ids of every text of a batch."""
        held = self._held
        for first in range(0, len(batch), 500):
            part = batch[first : first + 500]
            pieces = [_MARKS.sub(r" \g<0>", t).replace("\n", " ").split(" ") for t in part]
            if len(held.words) > self._cached:
                held.words = {}
            yield from self._encoded(pieces)

    def _encoded(self, pieces: list[list[str]]) -> list[bytes]:
        # Millions of objects come and go here without a cycle among them.
        collects = gc.isenabled()
        gc.disable()
        try:
            get = self._held.words.get
            found = [list(map(get, words)) for words in pieces]
            gaps = [[i for i, ids in enumerate(of) if ids is None] for of in found]
            self._learn(list({words[i] for words, at in zip(pieces, gaps) for i in at}))
            for words, ids, at in zip(pieces, found, gaps):
                for i in at:
                    ids[i] = get(words[i])
            return list(map(b"".join, found))
        finally:
            if collects:
                gc.enable()

    def _learn(self, fresh: list[str]) -> None:
        """Encode new words: those of letters by the merges alone, the others as a text."""
        words, tokenize, pack = self._held.words, self._held.tokenizer.model.tokenize, struct.pack
        others = []
        for word in fresh:
            if not _LETTERS.fullmatch(word):
                others.append(word)
                continue
            lower = word.lower()
            ids = words.get(lower)
            if ids is None:
                spelt = lower if lower.isascii() else lower.encode().decode("latin-1").translate(_SHOWN)
                words[lower] = ids = pack(f"<{len(found := tokenize(spelt))}I", *[t.id for t in found])
            words[word] = ids
        self._learn_text(others)

    def _learn_text(self, fresh: list[str]) -> None:
        for first in range(0, len(fresh), _TOGETHER):
            words = fresh[first : first + _TOGETHER]
            encoding = self._held.tokenizer.encode(" ".join(words), add_special_tokens=False)
            ids = np.array(encoding.ids, "<u4").tobytes()
            starts = np.array([start for start, _ in encoding.offsets], np.int64)
            # A token belongs to the word in which it starts.
            begin = np.cumsum([0, *(len(w) + 1 for w in words)])
            cuts = (4 * np.searchsorted(starts, begin)).tolist()
            for word, a, b in zip(words, cuts, cuts[1:]):
                self._held.words[word] = ids[a:b]
