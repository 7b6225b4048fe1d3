"""BPE encoding of whole texts by tree concatenation, and decoding.

A text of at most ``piece`` characters is encoded at once.  A longer one is cut
into halves, and these again, until every part is short enough; the parts are
rows of their own, so the tasks of a stage encode them in parallel.  Going up
the tree, neighbours are joined: a window of text around the cut is encoded,
and grown until its tokens agree with those of both sides, which then replace
the tokens in between.

*Agreement at a word.*  The tokenizer cuts a text into words from left to
right and looks only a few characters ahead, so two encodings that share a
word start share all that follows, up to the reach of their ends
(``Splitter.guard``).  The window shares one with the left side, from there on
it is right, and one with the right side, from there on that is right.

*Agreement in a word.*  A cut inside a long run (letters or marks without a
break) is joined token by token.  Merges run in order of rank and each token
has one way to arise, so a sequence of tokens is the encoding of its run if
and only if every two neighbours are that of theirs.  A window of tokens whose
first and last token are those of the sides leaves all neighbours as they are
in an encoding.  A tokenizer file of which this isn't true gets larger windows
of text instead, up to the whole of both sides.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from operator import attrgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDS = "doc_id long, n_tokens long, ids array<int>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _steady(ch: str) -> bool:
    """Normalization and lower case neither join ``ch`` with what stands before it nor make more of it."""
    code = ord(ch)
    if code < 0x300:  # up to the first combining mark; capital I with a dot becomes two characters
        return code != 0x130
    return 0x400 <= code <= 0x482 or 0x4E00 <= code <= 0x9FFF or 0xAC00 <= code <= 0xD7A3


class Part:
    """A text with its tokens and, per token, the offset at which its word starts."""

    __slots__ = ("at", "ids", "text")

    def __init__(self, text: str, ids: np.ndarray, at: np.ndarray):
        self.text, self.ids, self.at = text, ids, at

    def first_at(self, offset: int) -> int:
        return int(np.searchsorted(self.at, offset))


class Chunk(NamedTuple):
    """What is kept of a piece of text without white space."""

    count: int
    ids: bytes  # 32-bit
    numbers: bytes
    decoded: bytes


COUNT, NUMBERS, DECODED = map(attrgetter, ("count", "numbers", "decoded"))


def chunk_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of ``text.encode().split()`` start and end, in characters."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    white = np.ones(len(codes) + 2, bool)
    white[1:-1] = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edges = np.flatnonzero(white[1:] != white[:-1])
    return edges[::2], edges[1::2]


class Splitter:
    """Encodes texts with a tokenizer file, whole or as joined parts; decodes ids.

    Where white space is no part of any token, texts are cut at it and the
    chunks between, short ones, are encoded once and kept, about ``limit`` of
    them at most; those not met for the longest time go first.
    """

    WINDOWS = (64, 256, 1024)
    SHORT = 256
    MARK = "\x01"  # stands between chunks that are encoded together
    TOGETHER = 512

    def __init__(self, path: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one thread
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        spec = json.loads(self.full.to_str())
        model = spec["model"]
        self.plain_decode = spec["decoder"] is None
        size = 1 + max(self.full.get_vocab(with_added_tokens=True).values())
        self.tokens = [self.full.id_to_token(i) for i in range(size)]
        self.numbers = [str(i) for i in range(size)]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = [token["content"] for token in spec["added_tokens"]]
        self.guard = 8 + max(map(len, self.added), default=0)
        self.by_rank = self._by_rank(model)
        self.limit, self.chunks, self.older = limit, {}, {}
        probe = "a b\t1 \n! 's\r\x0b\x0cx  \n"
        self.spaced = self.full.pre_tokenizer is not None and not any(
            set(word) & set(" ĠĊ\t\n") for word, _ in self.full.pre_tokenizer.pre_tokenize_str(probe)
        )
        mark = self.full.encode(self.MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        # the model alone on symbols: a run's inside, and a run's end
        bare = {**spec, "normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []}
        self.end = Tokenizer.from_str(json.dumps(bare))
        self.inside = Tokenizer.from_str(json.dumps({**bare, "model": {**model, "end_of_word_suffix": None}}))

    @staticmethod
    def _by_rank(model: dict) -> bool:
        """Each token arises from one merge, of symbols or of tokens of lesser rank."""
        if model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("dropout"):
            return False
        rank: dict[str, int] = {}
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            if a + b in rank:
                return False
            rank[a + b] = len(rank)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        return all(rank.get(side, -1) < rank[a + b] for a, b in pairs for side in (a, b))

    # ---------------------------------------------------------------- whole

    def _encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        """The ids of each chunk; many are encoded as one text, with a mark between each two.

        The mark's token shows where they part.  Where it turns up more or less
        often than that, the chunks are encoded one by one.
        """
        out: list[list[int]] = []
        step = 1 if self.mark is None else self.TOGETHER
        blocks = [chunks[i : i + step] for i in range(0, len(chunks), step)]
        together = self.full.encode_batch_fast([f" {self.MARK} ".join(some) for some in blocks], add_special_tokens=False)
        for some, one in zip(blocks, together, strict=True):
            ids = one.ids
            if len(some) > 1 and ids.count(self.mark) == len(some) - 1 and not any(self.MARK in chunk for chunk in some):
                start = 0
                for _ in range(len(some) - 1):
                    end = ids.index(self.mark, start)
                    out.append(ids[start:end])
                    start = end + 1
                out.append(ids[start:])
            elif len(some) > 1:
                out += [each.ids for each in self.full.encode_batch_fast(some, add_special_tokens=False)]
            else:
                out.append(ids)
        return out

    def _chunked(self, texts: list[str]) -> list[list[Chunk]]:
        """The chunks of each text; those that aren't kept yet are encoded together."""
        if len(self.chunks) > self.limit // 2:
            self.older, self.chunks = self.chunks, {}
        # bytes.split() cuts at ASCII white space, which no normalization joins with its neighbours
        split = [text.encode().split() for text in texts]
        wanted, new = set().union(*split).difference(self.chunks), []
        for chunk in wanted:
            kept = self.older.pop(chunk, None)
            if kept is None:
                new.append(chunk)
            else:
                self.chunks[chunk] = kept
        ids = self._encode_chunks([chunk.decode() for chunk in new])
        numbers = self.numbers.__getitem__
        for chunk, some, text in zip(new, ids, self.decode(ids), strict=True):
            kept = Chunk(len(some), array("i", some).tobytes(), " ".join(map(numbers, some)).encode(), text.encode())
            self.chunks[chunk] = kept
        return [list(map(self.chunks.__getitem__, one)) for one in split]

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.spaced:
            return [one.ids for one in self.full.encode_batch_fast(texts, add_special_tokens=False)]
        return [np.frombuffer(b"".join([c.ids for c in one]), np.int32).tolist() for one in self._chunked(texts)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        if self.plain_decode:
            return [" ".join(map(self.tokens.__getitem__, one)) for one in ids]
        return self.full.decode_batch(ids, skip_special_tokens=False)

    def written(self, ids: list[list[int]]) -> list[tuple[int, bytes, bytes]]:
        """Per text: tokens, decimal ids joined by a space, decoded text."""
        numbers = (" ".join(map(self.numbers.__getitem__, one)).encode() for one in ids)
        return list(zip(map(len, ids), numbers, (text.encode() for text in self.decode(ids)), strict=True))

    def encode_written(self, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
        """``written`` of the encoded texts, put together from that of their chunks."""
        if not self.spaced or not self.plain_decode:
            return self.written(self.encode(texts))
        out = []
        for some in self._chunked(texts):
            counts = list(map(COUNT, some))
            if not all(counts):
                some = [chunk for chunk in some if chunk.count]
            out.append((sum(counts), b" ".join(map(NUMBERS, some)), b" ".join(map(DECODED, some))))
        return out

    # ---------------------------------------------------------------- parts

    def part(self, text: str) -> Part:
        """A text with all its word starts."""
        one = self.full.encode(text, add_special_tokens=False)
        ids, words = np.array(one.ids, np.int32), one.word_ids
        offsets = np.fromiter((a for a, _ in one.offsets), np.int64, len(ids))
        starts = np.fromiter(
            (w is None or i == 0 or w != words[i - 1] for i, w in enumerate(words)), bool, len(ids)
        )
        return Part(text, ids, offsets[np.maximum.accumulate(np.where(starts, np.arange(len(ids)), 0))])

    def coarse_part(self, text: str) -> Part:
        """A text with the word starts of its long chunks, and the starts of its short ones."""
        if not self.spaced:
            return self.part(text)
        begins, ends = chunk_spans(text)
        long = np.flatnonzero(ends - begins > self.SHORT)
        fine = {i: self.part(text[begins[i] : ends[i]]) for i in long.tolist()}
        if fine:
            spans = enumerate(zip(begins.tolist(), ends.tolist(), strict=True))
            short = iter(self._chunked([" ".join([text[a:b] for i, (a, b) in spans if i not in fine])])[0])
            found = [fine[i].ids if i in fine else np.frombuffer(next(short).ids, np.int32) for i in range(len(begins))]
            counts = np.array(list(map(len, found)), np.int64)
            ids = np.concatenate(found)
        else:
            chunks = self._chunked([text])[0]
            counts = np.array(list(map(COUNT, chunks)), np.int64)
            ids = np.frombuffer(b"".join([chunk.ids for chunk in chunks]), np.int32)
        at, stops = np.repeat(begins, counts), np.cumsum(counts)
        for i, part in fine.items():
            at[stops[i] - counts[i] : stops[i]] += part.at
        return Part(text, ids, at)

    def join(self, left: Part, right: Part) -> Part:
        """The encoding of both texts in a row."""
        if not left.text or not right.text:
            return right if not left.text else left
        sizes, whole = list(self.WINDOWS), max(len(left.text), len(right.text))
        for size in sizes:
            found = self._by_words(left, right, size)
            if found is None and size == self.WINDOWS[-1]:
                found = self._by_tokens(left, right)
            if found is not None:
                return found
            if size == sizes[-1] and size < whole:
                sizes.append(4 * size)
        return self.part(left.text + right.text)

    def _by_words(self, left: Part, right: Part, size: int) -> Part | None:
        cut, text = len(left.text), left.text + right.text
        a, b = max(0, cut - size), min(len(text), cut + size)
        window = self.part(text[a:b])
        at = window.at + a

        def shared(side: np.ndarray, low: int, high: int) -> list[int]:
            near = side[np.searchsorted(side, low) : np.searchsorted(side, high, "right")]
            return [int(p) for p in np.intersect1d(at, near) if _steady(text[p])]

        from_left = [0] if a == 0 else shared(left.at, a, cut - self.guard)
        to_right = shared(right.at + cut, cut, b - self.guard)
        if not from_left or not (to_right or b == len(text)):
            return None
        p = from_left[-1]
        q = to_right[0] if to_right else len(text)
        i, j = left.first_at(p), right.first_at(q - cut)
        inner = slice(*np.searchsorted(at, [p, q]))
        return Part(
            text,
            np.concatenate([left.ids[:i], window.ids[inner], right.ids[j:]]),
            np.concatenate([left.at[:i], at[inner], right.at[j:] + cut]),
        )

    def _kind(self, ch: str) -> str | None:
        """What run ``ch`` starts or goes on with: letters or marks."""
        if not _steady(ch) or ch.isspace() or ch.isnumeric() or ch == "'":
            return None
        return "letters" if ch.isalpha() else "marks"

    def _by_tokens(self, left: Part, right: Part) -> Part | None:
        """Join at a cut inside a run of letters or marks."""
        cut = len(left.text)
        if not self.by_rank or not len(left.ids) or not len(right.ids) or right.at[0] != 0:
            return None
        # the words next to the cut; of a short chunk only its own start is known
        last = int(left.at[-1])
        tail = self.part(left.text[last:]) if cut - last <= self.SHORT else None
        p = last if tail is None else last + int(tail.at[-1])
        first = re.match(r"[^ \t-\r]*", right.text).group()
        head = self.part(first) if self.spaced and len(first) <= self.SHORT else None
        kind = self._kind(left.text[p])
        around = left.text[-self.guard :] + right.text[: self.guard]
        if p > cut - self.guard or kind is None or any(token in around for token in self.added):
            return None
        if self._kind(left.text[-1]) != kind or self._kind(right.text[0]) != kind:
            return None
        i = left.first_at(p) if tail is None else len(left.ids) - int((tail.at == tail.at[-1]).sum())
        j = int(np.searchsorted((right if head is None else head).at, 0, "right"))
        ours, theirs = left.ids[i:], right.ids[:j]
        # ours end in a word's end, which the run now has at the end of theirs
        symbols = [self.tokens[k] for k in ours]
        symbols[-1] = symbols[-1].removesuffix(self.suffix)
        after = [self.tokens[k] for k in theirs]
        after[-1] = after[-1].removesuffix(self.suffix)
        width = 8
        while True:
            reaches, ends = width >= len(ours), width >= len(theirs)
            text = "".join(symbols[-width:]) + "".join(after[:width])
            found = (self.end if ends else self.inside).encode(text, add_special_tokens=False).ids
            if (reaches or found[0] == ours[-width]) and (ends or found[-1] == theirs[width - 1]):
                break
            width *= 4
        kept = max(len(ours) - width, 0)
        run = np.concatenate([ours[:kept], np.array(found, np.int32), theirs[width:]])
        return Part(
            left.text + right.text,
            np.concatenate([left.ids[:i], run, right.ids[j:]]),
            np.concatenate([left.at[:i], np.full(len(run), p, np.int64), right.at[j:] + cut]),
        )

    def joined(self, parts: list[Part]) -> Part:
        """All parts of a text, joined in pairs up the tree."""
        while len(parts) > 1:
            pairs = [self.join(*parts[i : i + 2]) for i in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[2 * len(pairs) :]
        return parts[0]


_splitters: dict[str, Splitter] = {}


def splitter(path: str) -> Splitter:
    """One per Python worker, kept from task to task."""
    if path not in _splitters:
        _splitters[path] = Splitter(path)
    return _splitters[path]


class AsIds:
    """Output rows with the ids themselves."""

    schema = IDS

    def of_texts(self, coder: Splitter, doc_ids: list, texts: list[str]) -> pa.RecordBatch:
        return self.of_ids(coder, doc_ids, coder.encode(texts))

    def of_ids(self, coder: Splitter, doc_ids: list, found: list[list[int]]) -> pa.RecordBatch:
        columns = [pa.array(doc_ids, pa.int64()), pa.array(list(map(len, found)), pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(found, pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids"]
        )


class AsDigests:
    """Output rows with digests of the ids and of the decoded text."""

    schema = DIGESTS

    def of_texts(self, coder: Splitter, doc_ids: list, texts: list[str]) -> pa.RecordBatch:
        return self._rows(doc_ids, coder.encode_written(texts))

    def of_ids(self, coder: Splitter, doc_ids: list, found: list[list[int]]) -> pa.RecordBatch:
        return self._rows(doc_ids, coder.written(found))

    @staticmethod
    def _rows(doc_ids: list, found: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        def digests(texts: list[bytes]) -> pa.Array:
            return pa.array([hashlib.sha256(text).hexdigest() for text in texts], pa.string())

        columns = [
            pa.array(doc_ids, pa.int64()),
            pa.array([count for count, _, _ in found], pa.int64()),
            digests([numbers for _, numbers, _ in found]),
            digests([text for _, _, text in found]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _encode(docs: DataFrame, path: str, out: AsIds | AsDigests, id_col: str, text_col: str, piece: int) -> DataFrame:
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = splitter(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                yield out.of_texts(coder, some.column(0).to_pylist(), some.column(1).to_pylist())

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = splitter(path)
        for batch in batches:
            found = [coder.coarse_part(text) for text in batch.column("text").to_pylist()]
            ids = pa.array([part.ids for part in found], pa.list_(pa.int32()))
            at = pa.array([part.at.astype(np.int32) for part in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, at], [*batch.schema.names, "ids", "starts"])

    def join_parts(group: pa.Table) -> pa.Table:
        coder = splitter(path)
        group = group.sort_by("part")
        columns = (group.column(name).combine_chunks() for name in ("text", "ids", "starts"))
        parts = [
            Part(text.as_py(), ids.values.to_numpy(), at.values.to_numpy().astype(np.int64))
            for text, ids, at in zip(*columns, strict=True)
        ]
        ids = coder.joined(parts).ids.tolist()
        return pa.Table.from_batches([out.of_ids(coder, group.column("doc_id").to_pylist()[:1], [ids])])

    long = F.length("text") > piece
    # 2^levels equal parts: the leaves of a tree of halves
    leaves = F.pow(F.lit(2.0), F.ceil(F.log2(F.length("text") / piece)))
    width = F.ceil(F.length("text") / leaves).cast("int")
    steps = F.sequence(F.lit(0), F.length("text") - 1, width)
    parts = (
        rows.filter(long)
        .withColumn("row_no", F.monotonically_increasing_id())
        .select("row_no", "doc_id", "text", width.alias("width"), F.posexplode(steps).alias("part", "begin"))
        .select("row_no", "doc_id", "part", F.substring("text", F.col("begin") + 1, F.col("width")).alias("text"))
        .repartition("row_no", "part")
        .mapInArrow(encode_parts, "row_no long, doc_id long, part int, text string, ids array<int>, starts array<int>")
    )
    joined = parts.groupBy("row_no").applyInArrow(join_parts, out.schema)
    return rows.filter(~long).mapInArrow(whole, out.schema).unionByName(joined)


def encode_texts(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", piece: int = 16384
) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document, as the tokenizer encodes its whole text.

    Texts of more than ``piece`` characters are encoded as parts on several
    tasks and joined; one task holds the tokens of one text at a time.  Special
    tokens are not added, and those spelled out in a text are encoded as the
    tokenizer does by itself.  A null or empty text has no tokens.  Repeated
    rows and null ids are encoded like any other row; an empty table gives no
    rows.  Other columns are ignored.
    """
    return _encode(docs, tokenizer_path, AsIds(), id_col, text_col, piece)


def decode_ids(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, text`` of rows as ``encode_texts`` returns them, by the tokenizer's decoder.

    Null or empty ids give an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = splitter(tokenizer_path)
        for batch in batches:
            texts = coder.decode([ids or [] for ids in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encoding_digests(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", piece: int = 16384
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: ``encode_texts`` and ``decode_ids`` as digests.

    Made where the tokens are made, so that these don't leave the task.  Rows
    and odd values as in ``encode_texts``.
    """
    return _encode(docs, tokenizer_path, AsDigests(), id_col, text_col, piece)
