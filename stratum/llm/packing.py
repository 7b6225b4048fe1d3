"""Sequence packing by best-fit decreasing.

Each task tokenizes the documents of its partition, cuts overlong ones into
full windows and packs the pieces, pool by pool, into windows of ``size``
tokens.  A segment tree over the remaining capacities gives the tightest open
window that still takes a piece.  Nothing is shuffled: a pool of some thousand
pieces already fills its windows almost completely, and a recomputed partition
packs the same rows in the same way, so sequence ids are stable.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

PIECES = "doc_id long, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long"
CHECKED = PIECES.replace("ids array<int>", "ids_crc32 long")


class CapacityTree:
    """Open windows by remaining capacity; ``tightest`` finds the least one that fits."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        node = self.leaves + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) with the least capacity >= need."""
        node, count = self.leaves + need, self.count
        if not count[node]:
            # climb until a right sibling holds a window, then go down leftmost
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        window = self.windows[capacity].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return capacity, window


def best_fit_decreasing(lengths: list[int], size: int) -> list[tuple[int, int]]:
    """(window, offset) of each piece; windows are numbered from 0."""
    tree, placed, opened = CapacityTree(size), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.tightest(lengths[i])
        capacity, window = found if found else (size, opened)
        opened += found is None
        placed[i] = (window, size - capacity)
        if capacity > lengths[i]:
            tree.add(capacity - lengths[i], window)
    return placed


class ChunkIndex(dict):
    """Number of each chunk; new chunks are numbered as they are asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        self.new.append(chunk)
        number = self[chunk] = len(self)
        return number


class ChunkTokens:
    """Token ids of texts from cached ids of their white-space separated chunks.

    The tokenizer drops white space, so no token spans two chunks.  Chunks of
    letters alone are normalized here and sent to the bare model many at a
    time; every other chunk goes through the whole tokenizer.
    """

    GROUP = 64

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.limit, self.full = limit, Tokenizer.from_file(path)
        spec = json.loads(self.full.to_str())
        spec["normalizer"] = None
        level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, level]}
        self.bare = Tokenizer.from_str(json.dumps(spec))
        vocabulary = self.full.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.reset()

    def reset(self) -> None:
        self.index = ChunkIndex()
        self.starts = self.sizes = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)
        self.used = 0

    def _learn(self) -> None:
        """Tokenize the chunks that have a number but no ids yet."""
        chunks, self.index.new = self.index.new, []
        first = len(self.index) - len(chunks)
        plain, words, other = [], [], []
        for number, chunk in enumerate(chunks, first):
            if chunk.isalpha():  # ASCII letters, in lower case
                plain.append(number)
                words.append(chunk.decode())
                continue
            text = chunk.decode()
            word = unicodedata.normalize("NFC", text).lower()
            # capital sigma: Python's lower() looks at its neighbours, the tokenizer's doesn't
            if text.isalpha() and word.isalpha() and "\u03a3" not in text:
                plain.append(number)
                words.append(word)
            else:
                other.append(number)
        numbers, parts, sizes = [], [], []
        groups = [slice(i, i + self.GROUP) for i in range(0, len(words), self.GROUP)]
        encoded = self.bare.encode_batch_fast([" ".join(words[g]) for g in groups], add_special_tokens=False)
        for g, one in zip(groups, encoded, strict=True):
            ids = np.array(one.ids, np.int32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(words[g]):
                numbers += plain[g]
                parts.append(ids)
                sizes.append(np.diff(cuts, prepend=0))
            else:
                other += plain[g]
        rest = self.full.encode_batch_fast([chunks[n - first].decode() for n in other], add_special_tokens=False)
        rest = [np.array(one.ids, np.int32) for one in rest]
        sizes = np.concatenate([*sizes, [len(ids) for ids in rest]]).astype(np.int64)
        flat = np.concatenate([*parts, *rest]) if len(sizes) else np.empty(0, np.int32)
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(self.flat), len(flat), 1 << 16), np.int32)])
        self.flat[self.used : self.used + len(flat)] = flat
        at = np.array(numbers + other, np.int64) - first
        grown = np.empty((2, len(chunks)), np.int64)
        grown[0, at], grown[1, at] = self.used + np.cumsum(sizes) - sizes, sizes
        self.starts, self.sizes = np.concatenate([self.starts, grown[0]]), np.concatenate([self.sizes, grown[1]])
        self.used += len(flat)

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of each text followed by ``end``."""
        if len(self.index) > self.limit:
            self.reset()
        number, numbered = self.index.__getitem__, []
        for text in texts:
            # bytes.split() cuts at ASCII white space only; what else the tokenizer
            # takes for white space stays inside a chunk and is left to it.  The
            # tokenizer ignores case but for special tokens, which begin with <|.
            raw = text.encode()
            chunks = (raw if b"<|" in raw else raw.lower()).split()
            numbered.append(np.fromiter(map(number, chunks), np.int64, len(chunks)))
        if self.index.new:
            self._learn()
        out = []
        for at in numbered:
            sizes = self.sizes[at]
            total = int(sizes.sum())
            ids = np.empty(total + 1, np.int32)
            shift = self.starts[at] - (np.cumsum(sizes) - sizes)
            ids[:total] = self.flat[np.arange(total) + np.repeat(shift, sizes)]
            ids[total] = end
            out.append(ids)
        return out


_tokens: dict[tuple[str, int], ChunkTokens] = {}


def chunk_tokens(path: str, limit: int) -> ChunkTokens:
    """One cache per Python worker, kept from task to task."""
    if (path, limit) not in _tokens:
        _tokens[path, limit] = ChunkTokens(path, limit)
    return _tokens[path, limit]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4096,
    end_id: int = 2,
    pool: int = 16384,
    cached_words: int = 700_000,
    checksums: bool = False,
) -> DataFrame:
    """Pack every document into sequences of at most ``size`` tokens.

    One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id,
    offset``.  A document's tokens are those of its text followed by
    ``end_id``; documents over ``size`` tokens are cut into full windows and a
    rest.  Pieces of up to ``pool`` documents are packed together, which bounds
    a task's memory whatever the size of its partition.  With ``checksums`` a
    piece has ``ids_crc32``, the CRC-32 of its ids as little-endian unsigned
    32-bit numbers, in place of ``ids``, which then don't leave the task.

    A null or empty text is the end token alone.  Repeated rows and null ids
    are packed like any other row; an empty table gives no rows.  Other columns
    are ignored.  A partition with a few short documents leaves its last
    window part empty.
    """

    schema = CHECKED if checksums else PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = chunk_tokens(tokenizer_path, cached_words)
        first = TaskContext.get().partitionId() << 40
        opened, waiting, held = 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal opened, waiting, held
            pieces = [(d, s, ids[s : s + size], len(ids)) for d, ids in waiting for s in range(0, len(ids), size)]
            placed = best_fit_decreasing([len(p[2]) for p in pieces], size)
            base, step = first + opened, 2048
            opened += 1 + max((w for w, _ in placed), default=-1)
            waiting, held = [], 0
            for i in range(0, len(pieces), step):
                part, where = pieces[i : i + step], placed[i : i + step]
                lengths = np.array([len(p[2]) for p in part], np.int64)
                if checksums:
                    ids = pa.array([zlib.crc32(p[2].astype("<u4").tobytes()) for p in part], pa.int64())
                else:
                    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                    ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([p[2] for p in part])))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for p in part], pa.int64()),
                        pa.array([p[1] for p in part], pa.int64()),
                        pa.array(lengths),
                        ids,
                        pa.array([p[3] for p in part], pa.int64()),
                        pa.array([base + w for w, _ in where], pa.int64()),
                        pa.array([o for _, o in where], pa.int64()),
                    ],
                    names=[field.split()[0] for field in schema.split(", ")],
                )

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [text or "" for text in part.column(1).to_pylist()]
                encoded = tokens.encode(texts, end_id)
                waiting.extend(zip(part.column(0).to_pylist(), encoded, strict=True))
                held += sum(map(len, encoded))
                if len(waiting) >= pool or held >= pool * 1024:
                    yield from flush()
        if waiting:
            yield from flush()

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, schema)


def piece_checksums(pieces: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``: the CRC-32 of the little-endian unsigned 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, cuts = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            columns = [pa.array(sums, pa.int64()) if n == "ids" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                columns, names=["ids_crc32" if n == "ids" else n for n in batch.schema.names]
            )

    return pieces.mapInArrow(run, PIECES.replace("ids array<int>", "ids_crc32 long"))
