"""Cross-tokenizer alignment (operator 12).

Every text is encoded by two tokenizers: A, a byte-level BPE file of the tokenizers library, on the
text after a space, and B, a sentencepiece file, which adds that space itself. Byte offsets where
a token of A and one of B both end cut the text into groups, and a token of A is linked to
every token of B in its group. A pair's count is the number of documents that hold it linked.

Counting is external. A task aligns blocks of documents and spills each block's records (pair,
document, links) to a file, radix-partitioned by the id of A, one zstd frame per partition; what
moves is a run per block and partition: its pairs in order with the documents that hold them.
One task per partition merges the runs with a heap in the order of the ids of A, so that all pairs
of an id are there together: their counts add up and the highest is known, and for every pair of
every run its total and whether it is the highest stream back to the block. There the records
turn them into sums per document. A record is written once and never shuffled, and an id that
every document holds is one entry per block and pair.

Texts are cut at single blanks and line ends between other characters. Neither tokenizer has a
token across such a place (A starts a token there by its pattern, B has no piece with a blank
inside), so the parts are aligned one by one, and a part that came before is not encoded again.

Defined cases: a null or empty text, and one whose tokens of A or B do not spell the text (B reads
U+2581 as a blank), has no tokens: zeros and the digest ''; special tokens written in a text are
plain text; repeated rows are documents of their own; null keys stay null; an empty table gives an
empty result; extra columns are ignored; a text of any length is aligned whole, in portions of
``PORTION`` characters cut at such places. Ties for the highest count all count.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import types
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from pixelweave.functions.storage import locate
from pixelweave.llm.text import byte_level, texts
from pixelweave.workspace import fresh_path, materialize

# A block ends with the document that makes it this large, in characters or documents (places of
# documents are 16 bits wide).
BLOCK_CHARS = 16 << 20
BLOCK_DOCS = 1 << 16
# Characters that are aligned at a time.
PORTION = 2 << 20
# Characters of parts that a worker keeps; a part has about ten and takes 300 bytes.
CACHED_CHARS = 3_000_000
# Parts that are encoded and aligned in one go.
_JOINED = 10_000

# Bits of an id of B in a pair's code; ids of both have to fit a 32-bit number.
_B_BITS = 15

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


# Fixed value: the pattern by which byte-level tokenizers cut texts.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_level_bpe(path: str):
    """Bytes of every id of a byte-level BPE file of the tokenizers library, and an encoder.

    Ids in the order of the merges are what tiktoken calls ranks, so its encoder gives the ids of
    the file, several times as fast. Special entries are no ids here: texts cannot hold them.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, cut = held["model"], held["pre_tokenizer"]
    byte, ids = byte_level(), model["vocab"]
    merged = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    plain = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
    if held["normalizer"] or not plain or merged != list(range(256, 256 + len(merged))):
        raise ValueError("not a plain byte-level BPE file")
    ranks = {bytes(byte[c] for c in t): i for t, i in ids.items() if i < 256 + len(merged)}
    encoder = tiktoken.Encoding("aligned", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return sorted(ranks, key=ranks.get), encoder


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    """Bytes of a sentencepiece token."""
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


class _Rows:
    """Numbers that grow at the end, as one array."""

    def __init__(self, width: int = 0):
        self._held = np.empty((1 << 16, width) if width else 1 << 16, np.int64)
        self.n = 0

    def add(self, rows) -> None:
        while self.n + len(rows) > len(self._held):
            self._held = np.concatenate([self._held, np.empty_like(self._held)])
        if len(rows):
            self._held[self.n : self.n + len(rows)] = rows
        self.n += len(rows)

    @property
    def all(self) -> np.ndarray:
        return self._held[: self.n]


def groups(a: list[int], b: list[int], size_a: list[int], size_b: list[int]) -> Iterator[tuple[list[int], list[int]]]:
    """Ids of A and B between places where tokens of both end; both spell the same bytes."""
    i = j = first_a = first_b = end_a = end_b = 0
    while i < len(a) or j < len(b):
        if end_a <= end_b:
            end_a += size_a[i]
            i += 1
        else:
            end_b += size_b[j]
            j += 1
        if end_a == end_b:
            yield a[first_a:i], b[first_b:j]
            first_a, first_b = i, j


class Aligner:
    """Aligns texts; what it learned of their parts is kept for the worker's life."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        holder = sys.modules.setdefault("_alignment", types.ModuleType("_alignment"))
        if getattr(holder, "paths", None) != (path_a, path_b):
            holder.bytes_a, holder.a = byte_level_bpe(path_a)
            holder.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
            n_a, n_b = len(holder.bytes_a), holder.b.get_piece_size()
            if n_b > 1 << _B_BITS or n_a > 1 << 32 - _B_BITS:
                raise ValueError("the vocabularies are too large")
            holder.bytes_b = [piece_bytes(holder.b.id_to_piece(i), holder.b.is_byte(i)) for i in range(n_b)]
            holder.size_a = np.array([len(t) for t in holder.bytes_a])
            holder.size_b = np.array([len(t) for t in holder.bytes_b])
            # Ids as they are written after what may stand before them.
            holder.written_a = [f"{mark}{i}" for mark in "\n;," for i in range(n_a)]
            holder.written_b = [f"{mark}{i}" for mark in "|," for i in range(n_b)]
            holder.paths = path_a, path_b
            self._forget(holder)
        self._held = holder

    @staticmethod
    def _forget(holder) -> None:
        holder.simple, holder.other, holder.chars = {}, {}, 0
        holder.written = []
        # Tokens of A and B, groups, links and whether the part is spelt right; then its pairs.
        holder.stats, holder.codes, holder.links, holder.ends = _Rows(5), _Rows(), _Rows(), _Rows()
        holder.ends.add([0])

    def _learn(self, parts: list[str]) -> list[int]:
        """Align parts that begin with a blank or a line end and have no other white space at
        their ends; their places."""
        first = self._held.stats.n
        for at in range(0, len(parts), _JOINED):
            some = parts[at : at + _JOINED]
            if not self._learn_joined(some):
                self._learn_each(some)
        return range(first, self._held.stats.n)

    def _learn_joined(self, parts: list[str]) -> bool:
        """Align parts as one text, array by array; False if its tokens do not spell it or if groups
        are large."""
        held = self._held
        joined = "".join(parts)
        raw = joined.encode("utf-8", "surrogatepass")
        part_ends = np.cumsum([len(p) if p.isascii() else len(p.encode("utf-8", "surrogatepass")) for p in parts])
        a = np.array(held.a.encode_ordinary(joined))
        # The library adds the blank that a text begins with, and one too many before a line end.
        b = np.array(held.b.encode(joined[1:])) if joined[0] == " " else np.array(held.b.encode(joined)[1:])
        ends_a, ends_b = np.cumsum(held.size_a[a]), np.cumsum(held.size_b[b])
        if not (b"".join(map(held.bytes_a.__getitem__, a.tolist())) == raw
                == b"".join(map(held.bytes_b.__getitem__, b.tolist()))):
            return False
        at_a, at_b = np.zeros((2, len(raw) + 1), bool)
        at_a[ends_a] = at_b[ends_b] = True
        both = at_a & at_b
        last_a, last_b = both[ends_a], both[ends_b]
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n_a, n_b = np.bincount(group_a), np.bincount(group_b)
        if not both[part_ends].all() or (n_a * n_b).sum() > 20 * len(a):
            return False
        part = np.searchsorted(part_ends, ends_a[last_a])
        stats = np.stack([np.bincount(part, w, len(parts)).astype(np.int64)
                          for w in (n_a, n_b, np.ones(len(part)), n_a * n_b)], 1)
        # Every token of A beside all of B in its group.
        first_b = np.cumsum(n_b) - n_b
        times = n_b[group_a]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        code = np.repeat(a, times) << _B_BITS | b[np.repeat(first_b[group_a], times) + nth]
        key, links = _merged(np.repeat(part[group_a], times) << 32 | code, np.ones(len(code), np.int64))
        per_part = np.bincount(key >> 32, minlength=len(parts))
        # Tokens in the order of writing: of a group those of A, then those of B.
        first_a = np.cumsum(n_a) - n_a
        new_group = np.r_[True, last_a[:-1]]
        new_part = np.zeros(len(a), bool)
        new_part[first_a[np.searchsorted(part, np.arange(len(parts)))]] = True
        mark_a = np.where(new_part, 0, np.where(new_group, 1, 2))
        mark_b = np.where(np.r_[True, last_b[:-1]], 0, 1)
        words = np.empty(len(a) + len(b), object)
        words[np.arange(len(a)) + first_b[group_a]] = list(
            map(held.written_a.__getitem__, (mark_a * len(held.bytes_a) + a).tolist()))
        words[np.arange(len(b)) + (first_a + n_a)[group_b]] = list(
            map(held.written_b.__getitem__, (mark_b * len(held.bytes_b) + b).tolist()))
        held.written += "".join(words.tolist()).split("\n")[1:]
        held.stats.add(np.c_[stats, np.ones(len(parts), np.int64)])
        held.codes.add(key & 0xFFFFFFFF)
        held.links.add(links)
        held.ends.add(held.ends.all[-1] + np.cumsum(per_part))
        held.chars += len(joined)
        return True

    def _learn_each(self, parts: list[str]) -> list[int]:
        """Align parts that begin with a blank or a line end, one by one; their places."""
        held = self._held
        encoded_a = list(map(held.a.encode_ordinary, parts))
        encoded_b = held.b.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        stats, codes, links, ends, first = [], [], [], [], held.stats.n
        total = int(held.ends.all[-1])
        for part, a, b in zip(parts, encoded_a, encoded_b):
            if part[0] != " ":
                b = b[1:]
            raw = part.encode("utf-8", "surrogatepass")
            parts_a, parts_b = [held.bytes_a[i] for i in a], [held.bytes_b[i] for i in b]
            fits = b"".join(parts_a) == raw == b"".join(parts_b)
            pairs: Counter[int] = Counter()
            written, n_links = [], 0
            if fits:
                for ids_a, ids_b in groups(a, b, [*map(len, parts_a)], [*map(len, parts_b)]):
                    written.append(f"{','.join(map(str, ids_a))}|{','.join(map(str, ids_b))}")
                    n_links += len(ids_a) * len(ids_b)
                    if len(ids_a) == len(ids_b) == 1:
                        pairs[ids_a[0] << _B_BITS | ids_b[0]] += 1
                        continue
                    times_b = Counter(ids_b).items()
                    for x, n in Counter(ids_a).items():
                        for y, m in times_b:
                            pairs[x << _B_BITS | y] += n * m
            stats.append((len(a), len(b), len(written), n_links, fits))
            codes += pairs.keys()
            links += pairs.values()
            total += len(pairs)
            ends.append(total)
            held.written.append(";".join(written))
            held.chars += len(part)
        for rows, new in ((held.stats, stats), (held.codes, codes), (held.links, links), (held.ends, ends)):
            rows.add(new)
        return range(first, held.stats.n)

    @staticmethod
    def _pieces(real: str) -> list[str]:
        """Parts of a text that begins with a blank or line end, cut at every blank and line end;
        those after a blank come without it."""
        found = real.replace("\n", " \n").split(" ")
        return found[1:]

    @staticmethod
    def _is_simple(piece: str) -> bool:
        body = piece[1:] if piece[:1] == "\n" else piece
        return bool(body) and not body[0].isspace() and not body[-1].isspace()

    def places(self, reals: list[str]) -> list[np.ndarray]:
        """For each text, which begins with a blank or a line end, the places of its parts."""
        held = self._held
        if held.chars > CACHED_CHARS:
            self._forget(held)
        cut = list(map(self._pieces, reals))
        fresh = list(set().union(*cut).difference(held.simple))
        simple = [p for p in fresh if self._is_simple(p)]
        held.simple.update(dict.fromkeys(fresh, -1))
        held.simple.update(zip(simple, self._learn([p if p[0] == "\n" else " " + p for p in simple])))
        look, out = held.simple.__getitem__, []
        for real, pieces in zip(reals, cut):
            found = np.array(list(map(look, pieces)), np.int64)
            if found.min() < 0:
                # White space in a row: cut only where the cut is sure.
                parts = _CUT.split(real)
                fresh = list(set(parts).difference(held.other))
                held.other.update(zip(fresh, self._learn_each(fresh)))
                found = np.array(list(map(held.other.__getitem__, parts)), np.int64)
            out.append(found)
        return out

    def written(self, places: np.ndarray) -> bytes:
        return ";".join(map(self._held.written.__getitem__, places.tolist())).encode()

    def tally(self, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the texts' statistics, a row each, and their distinct (text, code, links)."""
        held = self._held
        text = np.repeat(np.arange(len(places)), [*map(len, places)])
        key, times = np.unique(text << 40 | np.concatenate(places), return_counts=True)
        text, part = key >> 40, key & (1 << 40) - 1
        sums = np.zeros((len(places), 5), np.int64)
        stats = held.stats.all[part] * times[:, None]
        stats[:, 4] = held.stats.all[part, 4] == 0
        heads = np.searchsorted(text, np.arange(len(places)))
        sums[:] = np.add.reduceat(stats, heads, axis=0)
        ends = held.ends.all
        size = ends[part + 1] - ends[part]
        at = np.repeat(ends[part] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        links = held.links.all[at] * np.repeat(times, size)
        return sums, _merged(np.repeat(text, size) << 32 | held.codes.all[at], links)


def _merged(key: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their links."""
    if not len(key):
        return key, links
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[heads], np.add.reduceat(links[order], heads)


def _portions(text: str) -> Iterator[str]:
    """A text after a blank, in portions that begin with a blank or a line end."""
    text, at = " " + text, 0
    while len(text) - at > PORTION and (cut := _CUT.search(text, at + PORTION)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _packed(*arrays: np.ndarray) -> bytes:
    """Equal-length arrays of little-endian numbers, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


class Block:
    """The documents and records of one spilled block."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.keys: list = []
        self.sums: list[np.ndarray] = []
        self.digests: list[str] = []
        self.records: list[tuple[np.ndarray, np.ndarray]] = []
        self.chars = 0

    def add(self, aligner: Aligner, keys: list, batch: list[str]) -> None:
        """Take the documents of a batch that together are about a portion."""
        first = len(self.keys)
        self.keys += keys
        doc, reals = [], []
        for i, text in enumerate(batch):
            self.chars += len(text)
            if text:
                found = list(_portions(text))
                doc += [i] * len(found)
                reals += found
        sums = np.zeros((len(batch), 5), np.int64)
        digest = [hashlib.sha256() if text else None for text in batch]
        started: set[int] = set()
        at = 0
        while at < len(reals):
            # Portions of a long text are aligned one after the other.
            end, size = at, 0
            while end < len(reals) and (end == at or size + len(reals[end]) <= PORTION):
                size += len(reals[end])
                end += 1
            places = aligner.places(reals[at:end])
            counted, (key, links) = aligner.tally(places)
            owner = np.array(doc[at:end])
            np.add.at(sums, owner, counted)
            self.records.append(((first + owner[key >> 32]) << 32 | key & 0xFFFFFFFF, links))
            for i, found in zip(doc[at:end], places):
                digest[i].update((b";" if i in started else b"") + aligner.written(found))
                started.add(i)
            at = end
        misspelt = sums[:, 4] > 0
        sums[misspelt] = 0
        sums[:, 4] = misspelt
        self.sums.append(sums)
        self.digests += [d.hexdigest() if d and not bad else "" for d, bad in zip(digest, misspelt)]

    def spill(self, path: str) -> Iterator[tuple[int, bytes]]:
        """Write the records and documents to a file; the runs, a bucket each."""
        sums = np.concatenate(self.sums)
        key = np.concatenate([k for k, _ in self.records] or [np.empty(0, np.int64)])
        links = np.concatenate([n for _, n in self.records] or [np.empty(0, np.int64)])
        right = sums[key >> 32, 4] == 0
        key, links = key[right], links[right]
        doc, code = key >> 32, key & 0xFFFFFFFF
        bucket = (code >> _B_BITS) % self.buckets
        # By bucket, pair and document; a document of several portions may hold a pair twice.
        by_pair, links = _merged_pairs(bucket, code, doc, links)
        bucket, code, doc = by_pair
        heads = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.empty(0, np.int64)
        holds = np.diff(np.r_[heads, len(code)])
        present = np.unique(bucket)
        pair_cut = np.searchsorted(bucket[heads], np.r_[present, self.buckets])
        cut = np.r_[heads, len(code)][pair_cut]
        frames, runs = [], []
        for i, b in enumerate(present.tolist()):
            pairs, rows = slice(pair_cut[i], pair_cut[i + 1]), slice(cut[i], cut[i + 1])
            frames.append(_packed(holds[pairs].astype("<u4"), doc[rows].astype("<u2"), links[rows].astype("<u8")))
            codes = code[heads[pairs]]
            runs.append((b, _packed(np.diff(codes, prepend=0).astype("<u4"), holds[pairs].astype("<u4"))))
        docs = pa.RecordBatch.from_arrays(
            [pa.array(self.keys, pa.int64()), *(pa.array(c) for c in sums.T[:4]), pa.array(self.digests, pa.string())],
            [f"c{i}" for i in range(6)],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(docs)
        table = sink.getvalue().to_pybytes()
        head = np.array([len(present), len(table), *present, *np.cumsum([*map(len, frames)])], "<i8")
        filesystem, place = locate(path)
        with filesystem.open_output_stream(place) as out:
            for data in (head.tobytes(), table, *frames):
                out.write(data)
        yield from runs


def _merged_pairs(bucket, code, doc, links):
    """Records in the order of bucket, pair and document, equal ones added up."""
    order = np.lexsort((doc, code, bucket))
    bucket, code, doc, links = bucket[order], code[order], doc[order], links[order]
    if len(code):
        heads = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])])
        bucket, code, doc, links = bucket[heads], code[heads], doc[heads], np.add.reduceat(links, heads)
    return (bucket, code, doc), links


_RUN = StructType([StructField("block", StringType()), StructField("bucket", IntegerType()),
                   StructField("run", BinaryType())])


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "integer": pa.int32(), "binary": pa.binary()}
    types_ = [kinds[f.dataType.typeName()] for f in schema]
    columns = list(zip(*rows)) or [[]] * len(types_)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types_)], schema.names)


def spill(docs: DataFrame, path_a: str, path_b: str, folder: str, buckets: int) -> DataFrame:
    """Align ``docs`` (key, text) and spill blocks to ``folder``: a row per run, and one with
    bucket -1 per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        filesystem, base = locate(folder)
        filesystem.create_dir(base, recursive=True)
        block = Block(buckets)

        def flush() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.block"
            return _batch([(path, -1, None), *((path, b, data) for b, data in block.spill(path))], _RUN)

        for batch in batches:
            for keys, part in _dealt(batch):
                block.add(aligner, keys, part)
                if block.chars >= BLOCK_CHARS or len(block.keys) >= BLOCK_DOCS - _TOGETHER:
                    yield flush()
                    block = Block(buckets)
        if block.keys:
            yield flush()

    return materialize(docs.mapInArrow(run, _RUN), "runs")


# Documents that are aligned together at most.
_TOGETHER = 1_000


def _dealt(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts of a batch, about a portion at a time."""
    keys, column, at = batch.column(0).to_pylist(), texts(batch.column(1)), 0
    sizes = np.cumsum([len(t) for t in column])
    while at < len(keys):
        before = sizes[at - 1] if at else 0
        end = max(at + 1, min(int(np.searchsorted(sizes, before + PORTION, "right")), at + _TOGETHER))
        yield keys[at:end], column[at:end]
        at = end


def merge(runs: list[bytes]) -> list[bytes]:
    """Merge the runs of one bucket in the order of the ids of A; for each run the totals of its
    pairs and whether they are the highest of their id of A."""
    codes, holds, cuts, replies = [], [], [], []
    for data in runs:
        found = np.frombuffer(_unpacked(data), "<u4")
        codes.append(np.cumsum(found[: len(found) // 2], dtype=np.int64))
        holds.append(found[len(found) // 2 :].astype(np.int64))
        side = codes[-1] >> _B_BITS
        cuts.append(np.r_[np.flatnonzero(np.r_[True, side[1:] != side[:-1]]), len(side)].tolist())
        replies.append([np.empty(len(side), np.int64), np.empty(len(side), bool)])
    # (id of A, run, which of the run's ids)
    heap = [(int(c[0]) >> _B_BITS, r, 0) for r, c in enumerate(codes)]
    heapq.heapify(heap)
    while heap:
        side, same = heap[0][0], []
        while heap and heap[0][0] == side:
            _, r, nth = heap[0]
            lo, hi = cuts[r][nth], cuts[r][nth + 1]
            same.append((r, lo, hi))
            if hi < len(codes[r]):
                heapq.heapreplace(heap, (int(codes[r][hi]) >> _B_BITS, r, nth + 1))
            else:
                heapq.heappop(heap)
        if len(same) == 1:
            r, lo, hi = same[0]
            back = holds[r][lo:hi]
        else:
            pairs, place = np.unique(np.concatenate([codes[r][lo:hi] for r, lo, hi in same]), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, place, np.concatenate([holds[r][lo:hi] for r, lo, hi in same]))
            back = total[place]
        best, at = back == back.max(), 0
        for r, lo, hi in same:
            replies[r][0][lo:hi], replies[r][1][lo:hi] = back[at : at + hi - lo], best[at : at + hi - lo]
            at += hi - lo
    return [_packed(total.astype("<i8"), best.astype("u1")) for total, best in replies]


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge buckets that come one after the other."""
    bucket, held = None, []

    def merged() -> pa.RecordBatch:
        back = merge([data for _, data in held])
        return _batch([(path, bucket, data) for (path, _), data in zip(held, back)], _RUN)

    for batch in batches:
        for path, b, data in zip(*(c.to_pylist() for c in batch.columns)):
            if b != bucket and held:
                yield merged()
                held = []
            bucket = b
            held.append((path, data))
    if held:
        yield merged()


_RESULT = StructType([
    *(StructField(n, LongType()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
    StructField("groups_sha256", StringType()),
])


def _settle(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """A block's documents with what the pairs' totals add up to."""
    filesystem, place = locate(key[0].as_py())
    with filesystem.open_input_stream(place) as file:
        data = file.read()
    n, size = np.frombuffer(data, "<i8", 2).tolist()
    present, ends = np.frombuffer(data, "<i8", 2 * n, 16).reshape(2, n)
    at = 16 * (n + 1)
    docs = pa.ipc.open_stream(data[at : at + size]).read_all()
    starts = at + size + np.r_[0, ends[:-1]]
    frames = {b: (s, at + size + e) for b, s, e in zip(present.tolist(), starts.tolist(), ends.tolist())}
    n_best, count_sum = np.zeros((2, docs.num_rows), np.int64)
    for b, answer in zip(rows.column("bucket").to_pylist(), rows.column("run").to_pylist()):
        if b < 0:
            continue
        answer = _unpacked(answer)
        n_pairs = len(answer) // 9
        total, best = np.frombuffer(answer, "<i8", n_pairs), np.frombuffer(answer, "u1", n_pairs, 8 * n_pairs)
        frame = _unpacked(data[slice(*frames[b])])
        holds = np.frombuffer(frame, "<u4", n_pairs).astype(np.int64)
        n_rows = int(holds.sum())
        doc = np.frombuffer(frame, "<u2", n_rows, 4 * n_pairs)
        links = np.frombuffer(frame, "<u8", n_rows, 4 * n_pairs + 2 * n_rows).astype(np.int64)
        np.add.at(count_sum, doc, links * np.repeat(total, holds))
        np.add.at(n_best, doc, links * np.repeat(best.astype(np.int64), holds))
    columns = [docs.column(f"c{i}") for i in range(5)]
    columns += [pa.array(n_best), pa.array(count_sum), docs.column("c5")]
    return pa.table(columns, names=_RESULT.names)


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, tokens of A and B, groups, links, links whose pair is the most
    frequent of its id of A, the sum of the links' counts, and the SHA-256 of the groups."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    runs = spill(rows, path_a, path_b, fresh_path(spark, "blocks"), buckets)
    sorted_ = runs.where("bucket >= 0").repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
    answers = materialize(sorted_.mapInArrow(_answer, _RUN), "answers")
    both = runs.where("bucket < 0").unionByName(answers)
    return both.groupBy("block").applyInArrow(_settle, _RESULT)
