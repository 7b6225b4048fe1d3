"""Removal of byte strings that an earlier document has, by suffix arrays.

1. Every window of ``length`` bytes picks an anchor, the gram in it with the
   least hash.  Equal windows pick the same anchor, so a repeat shares it.
2. Anchors found in one text only are dropped; the others go, with the bytes of
   their windows, to the task of their gram.
3. There an enhanced suffix array (sorted right contexts and their common
   prefixes) is scanned with a stack for the common-prefix interval tree.  In
   each interval the occurrences are split by their left contexts: a class
   that has no common longer left extension is a maximal repeat with all its
   occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import MIX_A, MIX_B, mix, stored

BUFFER = 1 << 20  # bytes hashed at a time
GRAM = 16
BLOCKS = 5  # left offsets to a key of a frequent gram
ENDS = 2  # anchors at either end of a chain of frequent ones that form runs of their own
RUN = 16  # one in so many other anchors of a chain, told by its hash, ends a run
REPEATS = "gkey long, doc long, tid long, start long, stop long, length long, first_doc long"
MARKS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte strings, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * MIX_A
    size = 1
    while size < GRAM:
        h = (h[:-size] ^ (h[:-size] >> np.uint64(29))) * MIX_B + h[size:]
        size *= 2
    return mix(h)


def _segments(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Buffers of (row, start, bytes); pieces of a long text overlap by length - 1."""
    held, size = [], 0
    for row, text in enumerate(texts):
        if len(text) < length:
            continue
        for start in range(0, len(text) - length + 1, BUFFER - length + 1):
            part = text[start : start + BUFFER]
            if size + len(part) > BUFFER:
                yield held
                held, size = [], 0
            held.append((row, start, part))
            size += len(part)
    if held:
        yield held


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per buffer: data, and for each anchor its row, hash, position, the first
    and last start of the windows that pick it (in the buffer), and the shift
    from there to the text."""
    span = length - GRAM + 1
    for held in _segments(texts, length):
        sizes = np.array([len(part) for *_, part in held])
        data = np.frombuffer(b"".join(part for *_, part in held), np.uint8)
        owner = np.repeat(np.arange(len(held)), sizes)
        h = gram_hashes(data)
        # hash above, position below (the later of equal hashes is the least)
        key = (h >> np.uint64(20) << np.uint64(20)) | (np.uint64(BUFFER - 1) - np.arange(len(h), dtype=np.uint64))
        least, wide = key, 1
        while 2 * wide <= span:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if span > wide:
            least = np.minimum(least[: wide - span], least[span - wide :])
        windows = np.flatnonzero(owner[: len(data) - length + 1] == owner[length - 1 :])
        picked = least[windows]
        first = np.flatnonzero(np.concatenate([[True], (picked[1:] != picked[:-1]) | (np.diff(owner[windows]) != 0)]))
        at = (BUFFER - 1) - (picked[first] & np.uint64(BUFFER - 1)).astype(np.int64)
        last = np.concatenate([first[1:], [len(windows)]]) - 1
        of = owner[at]
        begins = np.cumsum(sizes) - sizes
        shift = np.array([start for _, start, _ in held])[of] - begins[of]
        rows = np.array([row for row, *_ in held])[of]
        yield data, rows, h[at].view(np.int64), at, windows[first], windows[last], shift


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Binary array of data[start : start + size]."""
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
    cuts = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(cuts), pa.py_buffer(data[at])])


def _texts(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.cast(pa.large_binary()).to_pylist()]


def anchor_grams(texts: DataFrame, length: int) -> DataFrame:
    """(h, tid) of every anchor of (tid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tids = batch.column(0).to_numpy()
            for _, rows, h, *_ in anchors(_texts(batch.column(1)), length):
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(tids[rows])], names=["h", "tid"])

    return texts.mapInArrow(run, "h long, tid long")


CONTEXTS = "gkey long, doc long, tid long, start long, rel long, ctx binary"


def _context_rows(data, doc, tid, at, low, high, shift, gkey, length: int) -> list[pa.Array]:
    columns = [pa.array(c) for c in (gkey, doc, tid, low + shift, at - low)]
    return [*columns, gathered(data, low, high + length - low)]


def anchor_contexts(texts: DataFrame, length: int) -> DataFrame:
    """``gkey, doc, tid, start, rel, ctx, hot`` of the shared anchors of (doc, tid, text, grams, hot_grams).

    ``gkey`` is the anchor's gram, ``ctx`` has the bytes of the windows that
    pick it and ``rel`` its place in them.  Frequent anchors (``hot``) that
    follow each other come as runs, with the bytes of all their windows, the
    first one's gram and ``rel`` 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                docs, tids = part.column(0).to_numpy(), part.column(1).to_numpy()
                shared, frequent = ([np.asarray(x) for x in part.column(k).to_pylist()] for k in (3, 4))
                for data, rows, h, at, low, high, shift in anchors(_texts(part.column(2)), length):
                    known, often = np.zeros(len(h), bool), np.zeros(len(h), bool)
                    cuts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1], [True]]))
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        known[a:b] = np.isin(h[a:b], shared[rows[a]])
                        often[a:b] = np.isin(h[a:b], frequent[rows[a]])
                    one, (head, tail) = np.flatnonzero(known & ~often), frequent_runs(often, rows, h)
                    for first, last, place, hot in ((one, one, at[one], False), (head, tail, low[head], True)):
                        if len(first):
                            columns = _context_rows(
                                data, docs[rows[first]], tids[rows[first]], place, low[first], high[last], shift[first],
                                h[first], length,
                            )
                            names = ["gkey", "doc", "tid", "start", "rel", "ctx", "hot"]
                            yield pa.RecordBatch.from_arrays([*columns, pa.array([hot] * len(first))], names=names)

    return texts.mapInArrow(run, f"{CONTEXTS}, hot boolean")


def frequent_runs(often: np.ndarray, rows: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last anchor of each run of frequent anchors that follow each other in a text.

    The windows of the outer anchors of a chain reach into what surrounds a
    shared passage, so these stand alone; the others are cut by their hashes,
    hence alike in every text that has the passage.
    """
    at = np.flatnonzero(often)
    if not len(at):
        return at, at
    apart = (np.diff(at) != 1) | (np.diff(rows[at]) != 0)
    begins, ends = np.flatnonzero(np.append(True, apart)), np.flatnonzero(np.append(apart, True))
    size = np.repeat(ends - begins + 1, ends - begins + 1)
    place = np.arange(len(at)) - np.repeat(begins, ends - begins + 1)
    cut = (mix(h[at].view(np.uint64)) % np.uint64(RUN) == 0) | (place < ENDS) | (place >= size - ENDS - 1)
    return at[np.append(True, cut[:-1])], at[np.append(cut[:-1], True)]


def run_contexts(runs: DataFrame, length: int) -> DataFrame:
    """The contexts of the anchors of each run; its bytes give the same anchors as the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(n) for n in batch.schema.names}
            doc, tid, start = (column[n].to_numpy() for n in ("doc", "tid", "start"))
            for data, rows, h, at, low, high, shift in anchors(_texts(column["ctx"]), length):
                columns = _context_rows(
                    data, doc[rows], tid[rows], at, low, high, start[rows] + shift, h, length
                )
                yield pa.RecordBatch.from_arrays(columns, names=["gkey", "doc", "tid", "start", "rel", "ctx"])

    return runs.mapInArrow(run, CONTEXTS)


def block_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """The windows of each context cut, by their offset from the anchor, into blocks.

    The bytes that all windows of a block have are part of its ``gkey``, so
    what meets there agrees in nearly a whole window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(n) for n in batch.schema.names}
            gkey, doc, tid, start, rel = (column[n].to_numpy() for n in ("gkey", "doc", "tid", "start", "rel"))
            data, low, sizes = _bytes_of(column["ctx"])
            p, high = low + rel, low + sizes - length
            for block in range(0, length - GRAM + 1, BLOCKS):
                far = min(block + BLOCKS - 1, length - GRAM)  # windows start block..far bytes before the anchor
                first, last = np.maximum(low, p - far), np.minimum(high, p - block)
                ok = np.flatnonzero(first <= last)
                if not len(ok):
                    continue
                key = mix(gkey[ok].view(np.uint64) + np.uint64(block) * MIX_A)
                for i in range(length - far + block):
                    key = mix(key + (data[p[ok] - block + i].astype(np.uint64) + np.uint64(1)) * MIX_B)
                columns = _context_rows(
                    data, doc[ok], tid[ok], p[ok], first[ok], last[ok], start[ok] - low[ok], key.view(np.int64), length
                )
                yield pa.RecordBatch.from_arrays(columns, names=["gkey", "doc", "tid", "start", "rel", "ctx"])

    return contexts.mapInArrow(run, CONTEXTS)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data, starts and sizes of a binary array."""
    cuts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), cuts[:-1], np.diff(cuts)


def prefix_intervals(lcp: np.ndarray, least: int) -> np.ndarray:
    """(depth, first, last) of the common-prefix interval tree, by one scan with a stack.

    ``lcp[i]`` belongs to the sorted suffixes i - 1 and i.
    """
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp[1:].tolist(), 0], 1):
        if not stack and depth < least:
            continue
        first = i - 1
        while stack and stack[-1][0] > depth:
            inner, first = stack.pop()
            found.append((inner, first, i - 1))
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return np.array(found, np.int64).reshape(-1, 3)


def _matrix(values: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of ``size`` bytes from ``start`` in direction ``step``, padded with zeros."""
    reach = np.arange(width)
    at = start[:, None] + step * reach[None, :]
    inside = reach[None, :] < size[:, None]
    return np.where(inside, values[np.where(inside, at, 0)], 0).astype(np.uint8)


def _common(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Common prefix of each row and the one before; 0 for the first."""
    same = rows[1:] == rows[:-1]
    until = np.where(same.all(1), rows.shape[1], same.argmin(1))
    return np.concatenate([[0], np.minimum(until, np.minimum(size[1:], size[:-1]))])


def _order(rows: np.ndarray, size: np.ndarray, *first: np.ndarray) -> np.ndarray:
    """Sort by ``first``, then the bytes of the rows, then their size."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    return np.lexsort((size, *(words[:, i] for i in range(words.shape[1] - 1, -1, -1)), *reversed(first)))


def maximal_repeats(
    gkey: np.ndarray, doc: np.ndarray, rel: np.ndarray, ctx: pa.Array, length: int
) -> tuple[np.ndarray, ...]:
    """(occurrence, left, right, first doc) of maximal repeats that an earlier document has.

    All rows of a gkey share its anchor.  ``left`` and ``right`` are the
    repeat's bytes before and from the anchor on.  An occurrence is listed
    once for each interval, at its longest left extension that some smaller
    doc shares: there its class splits, so the repeat is left-diverse, and it
    is right-diverse as a common-prefix interval.
    """
    values, begin, sizes = _bytes_of(ctx)
    right_width, left_width = -(-length // 8) * 8, -(-(length - GRAM) // 8) * 8
    right_size = sizes - rel
    right = _matrix(values, begin + rel, right_size, right_width, 1)
    order = _order(right, right_size, gkey)
    lcp = _common(right[order], right_size[order])
    lcp[1:][gkey[order][1:] != gkey[order][:-1]] = 0
    tree = prefix_intervals(lcp, GRAM)
    none = np.empty(0, np.int64)
    if not len(tree):
        return none, none, none, none
    members = tree[:, 2] - tree[:, 1] + 1
    node = np.repeat(np.arange(len(tree)), members)
    starts = np.cumsum(members) - members
    at = order[np.arange(len(node)) - np.repeat(starts - tree[:, 1], members)]
    depth = tree[node, 0]

    left = _matrix(values, begin + rel - 1, rel, left_width, -1)
    by_left = _order(left[at], rel[at], node)
    node, at, depth = node[by_left], at[by_left], depth[by_left]
    shared_left = _common(left[at], rel[at])
    edge = np.concatenate([[True], node[1:] != node[:-1]])
    shared_left[edge] = -1
    docs, reach = doc[at], np.full(len(at), -1)
    earliest = np.zeros(len(at), np.int64)
    for level in range(length - GRAM, -1, -1):
        heads = np.flatnonzero(shared_left < level)
        least = np.minimum.reduceat(docs, heads)
        least = np.repeat(least, np.diff(np.append(heads, len(docs))))
        new = (reach < 0) & (docs > least) & (depth + level >= length)
        reach[new], earliest[new] = level, least[new]
    hit = reach >= 0
    return at[hit], reach[hit], depth[hit], earliest[hit]


def repeats_of(contexts: DataFrame, length: int, rows_at_once: int = 1 << 16) -> DataFrame:
    """Occurrences of maximal repeats with an earlier document, from ``anchor_contexts`` rows.

    A task reads its grams in order and works on some ten thousand rows of whole
    grams at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            column = {n: table.column(n).chunk(0) for n in table.column_names}
            gkey, doc, start, rel = (column[n].to_numpy() for n in ("gkey", "doc", "start", "rel"))
            at, left, right, first = maximal_repeats(gkey, doc, rel, column["ctx"], length)
            anchor = start[at] + rel[at]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(gkey[at]),
                    pa.array(doc[at]),
                    pa.array(column["tid"].to_numpy()[at]),
                    pa.array(anchor - left),
                    pa.array(anchor + right),
                    pa.array(left + right),
                    pa.array(first),
                ],
                names=["gkey", "doc", "tid", "start", "stop", "length", "first_doc"],
            )

        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count >= rows_at_once:
                keys = batch.column("gkey").to_numpy()
                whole = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
                if whole:
                    yield solve(pa.Table.from_batches([*held[:-1], batch.slice(0, whole)]))
                    held, count = [batch.slice(whole)], batch.num_rows - whole
        if held:
            yield solve(pa.Table.from_batches(held))

    ordered = contexts.repartition("gkey").sortWithinPartitions("gkey")
    return ordered.select("gkey", "doc", "tid", "start", "rel", "ctx").mapInArrow(run, REPEATS)


def _least_of(contexts: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Spans of the contexts that a smaller doc has too, and the contexts of the least docs."""
    keys = ["gkey", "sum", "rel"]
    rows = contexts.withColumn("sum", F.xxhash64("ctx"))
    least = stored(rows.groupBy(*keys).agg(F.min("doc").alias("least")), label)
    rows = rows.join(least, keys)
    covered = rows.filter("doc > least").select(
        F.col("doc").alias("doc_id"), "tid", "start", (F.col("start") + F.octet_length("ctx")).alias("stop")
    )
    return covered, rows.filter("doc = least").select(*contexts.columns)


def repeated_spans(docs: DataFrame, length: int = 50, frequent: int = 4096) -> DataFrame:
    """``doc_id, tid, whole, spans``: what earlier documents have of each text (doc_id, text).

    ``whole`` marks a copy of a smaller doc_id's text; else ``spans`` lists
    [start, stop) byte ranges, unmerged.  Rows without either are left out.
    """
    texts = docs.dropna(subset=["doc_id"]).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    ).filter(F.octet_length("text") >= length)
    texts = texts.withColumn("tid", F.xxhash64("text"))
    same = stored(
        texts.select("doc_id", "tid", F.md5(F.col("text").cast("binary")).alias("sum")), "suffix-texts"
    )
    firsts = stored(same.groupBy("tid", "sum").agg(F.min("doc_id").alias("first")), "suffix-firsts")
    copies = same.join(firsts, ["tid", "sum"]).filter("doc_id > first").select("doc_id", "tid").distinct()

    grams = anchor_grams(texts.select("tid", "text"), length)
    counted = grams.groupBy("h").agg(F.min("tid").alias("low"), F.max("tid").alias("high"), F.count("*").alias("n"))
    shared = stored(
        counted.filter("low <> high").select("h", (F.col("n") > frequent).alias("hot")), "suffix-grams"
    )
    lists = (
        anchor_grams(texts.select("tid", "text"), length)
        .join(shared, "h")
        .groupBy("tid")
        .agg(
            F.collect_set(F.when(~F.col("hot"), F.col("h"))).alias("grams"),
            F.collect_set(F.when(F.col("hot"), F.col("h"))).alias("hot_grams"),
        )
        .withColumn("grams", F.concat("grams", "hot_grams"))
    )
    lists = stored(lists.join(firsts.groupBy("tid").agg(F.min("first").alias("first")), "tid"), "suffix-lists")
    wanted = texts.join(lists, (texts["tid"] == lists["tid"]) & (texts["doc_id"] == lists["first"])).select(
        texts["doc_id"].alias("doc"), texts["tid"], "text", "grams", "hot_grams"
    )
    contexts = stored(anchor_contexts(wanted, length), "suffix-contexts")

    # frequent grams: of equal runs the least doc goes on, the others are covered
    # whole; what is left is cut into contexts and these into blocks, likewise
    covered_runs, unique = _least_of(contexts.filter("hot").drop("hot"), "suffix-runs")
    covered, unique = _least_of(stored(run_contexts(unique, length), "suffix-run-contexts"), "suffix-hot")
    blocks = stored(block_contexts(unique, length), "suffix-blocks")
    covered_blocks, unique = _least_of(blocks, "suffix-hot")
    going_on = contexts.filter("not hot").drop("hot").union(unique)
    covered = covered_runs.union(covered).union(covered_blocks)
    found = repeats_of(going_on, length).select(F.col("doc").alias("doc_id"), "tid", "start", "stop")
    spans = found.union(covered).groupBy("doc_id", "tid").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"), F.lit(False).alias("whole")
    )
    none = F.array().cast("array<struct<start:long,stop:long>>")
    return spans.select("doc_id", "tid", "whole", "spans").union(
        copies.select("doc_id", "tid", F.lit(True).alias("whole"), none.alias("spans"))
    )


def merged(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal ranges of a union; ranges that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    heads = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    tails = np.append(heads[1:], len(starts)) - 1
    return list(zip(starts[heads].tolist(), reach[tails].tolist(), strict=True))


def _with_spans(docs: DataFrame, length: int, keep: list[str]) -> DataFrame:
    """``doc_id, text, starts, stops, whole`` and the columns ``keep`` of every row."""
    spans = stored(repeated_spans(docs.select("doc_id", "text"), length), "suffix-spans")
    spans = spans.withColumnRenamed("doc_id", "of_doc").withColumnRenamed("tid", "of_tid")
    match = (docs["doc_id"] == spans["of_doc"]) & (F.xxhash64(docs["text"]) == spans["of_tid"])
    return docs.join(spans, match, "left").select(
        "doc_id",
        "text",
        F.transform(F.coalesce("spans", F.array()), lambda s: s["start"]).alias("starts"),
        F.transform(F.coalesce("spans", F.array()), lambda s: s["stop"]).alias("stops"),
        F.coalesce("whole", F.lit(False)).alias("whole"),
        *keep,
    )


def _ranges(starts: list[int], stops: list[int], whole: bool, size: int) -> list[tuple[int, int]]:
    if whole:
        return [(0, size)]
    return merged(np.array(starts), np.array(stops)) if len(starts) else []


def suffix_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``.

    Removed is every byte covered by a ``length``-byte string that also starts
    in a document with a smaller id, as judged on the input.

    A null text is empty.  Rows with null ids neither lose bytes nor cost
    others any; rows of the same id are one document to the comparison, so
    repeated rows keep what they have.  Texts shorter than ``length`` stay as
    they are.  An empty table gives no rows; other columns are ignored.  Equal
    texts are told by MD5, grams by 64-bit hashes and everything that is
    removed by its bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, starts, stops, whole in zip(
                _texts(batch.column(1)), *(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True
            ):
                ranges, kept, last = _ranges(starts, stops, whole, len(text)), hashlib.sha256(), 0
                for a, b in ranges:
                    kept.update(text[last:a])
                    last = b
                kept.update(text[last:])
                out.append((len(text), sum(b - a for a, b in ranges), len(ranges), kept.hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return _with_spans(narrow, length, []).mapInArrow(run, MARKS)


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` (doc_id, text and any others) with the repeated bytes taken out of ``text``.

    A character of which a byte stays is kept whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, starts, stops, whole in zip(
                batch.column(1).cast(pa.large_binary()).to_pylist(),
                *(batch.column(i).to_pylist() for i in (2, 3, 4)),
                strict=True,
            ):
                parts, last = [], 0
                for a, b in _ranges(starts, stops, whole, len(text or b"")):
                    while a < b and text[a] & 0xC0 == 0x80:
                        a += 1
                    while a < b < len(text) and text[b] & 0xC0 == 0x80:
                        b -= 1
                    parts.append(text[last:a])
                    last = b
                kept.append(None if text is None else b"".join([*parts, text[last:]]).decode())
            columns = [pa.array(kept, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = docs.columns
    rest = [n for n in names if n not in ("doc_id", "text")]
    return _with_spans(docs, length, rest).mapInArrow(run, docs.schema)
