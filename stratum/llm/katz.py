"""Katz backoff scores of documents.

Word bigrams with Good-Turing discounts back off to discounted unigrams and
those to one unknown word; backoff weights normalise exactly.  Documents are
kept as chunks of token numbers with the chunk's own vocabulary; counts are
exchanged as packed arrays by hash bucket, so the tables are partitioned by
bucket and no task holds more than a bucket or a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import MIX_A, WordHashes, ascii_words, discard, mix, stored

DISCOUNTED = 5  # counts up to this one are discounted
CHUNK_TOKENS = 1_000_000
BUCKET_TOKENS = 1_500_000
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"", b" "))  # no word is empty or a space

CHUNKS = "chunk long, doc_id array<long>, held array<boolean>, size array<long>, tokens binary, words binary, trained binary"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


class GoodTuring(NamedTuple):
    """Discount factors of counts 1..DISCOUNTED from the numbers of types with counts 1..DISCOUNTED+1."""

    factors: np.ndarray

    @classmethod
    def of(cls, types: np.ndarray) -> GoodTuring:
        """Turing's estimate with Katz's renormalisation; where the counts of
        counts allow none (a gap, or a factor outside 0 to 1), 1 - 1 / (2 r)."""
        r = np.arange(1, DISCOUNTED + 1)
        plain = 1 - 0.5 / r
        if (types <= 0).any():
            return cls(plain)
        rest = (DISCOUNTED + 1) * types[DISCOUNTED] / types[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            factors = ((r + 1) * types[1:] / types[:-1] / r - rest) / (1 - rest)
        good = np.isfinite(factors).all() and (factors > 0).all() and (factors < 1).all()
        return cls(factors if good else plain)

    def at(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= DISCOUNTED, self.factors[np.clip(counts, 1, DISCOUNTED) - 1], 1.0)


class Unigrams(NamedTuple):
    """Discounted unigram model: tokens, types, discounts and the unknown word's probability."""

    tokens: int
    types: int
    discount: GoodTuring
    unknown: float
    whole: float  # what counts are divided by

    @classmethod
    def of(cls, tokens: int, types: int, by_count: np.ndarray) -> Unigrams:
        discount = GoodTuring.of(by_count)
        r = np.arange(1, DISCOUNTED + 1)
        freed = float((by_count[:DISCOUNTED] * r * (1 - discount.factors)).sum())
        if freed > 0:
            return cls(tokens, types, discount, freed / tokens, float(tokens))
        return cls(tokens, types, discount, 1 / (tokens + 1), float(tokens + 1))

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discount.at(counts) * counts / self.whole, self.unknown)


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def token_chunks(docs: DataFrame, held_out: Column) -> DataFrame:
    """Documents as chunks of at most about CHUNK_TOKENS tokens (one document at least).

    ``tokens`` numbers the words of all its documents, each followed by the
    end (number 0), by the chunk's vocabulary ``words``; ``trained`` counts the
    learnable tokens of each word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        ids, held, sizes, parts, total, made = [], [], [], [], 0, TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            nonlocal ids, held, sizes, parts, total, made
            every = np.concatenate(parts)
            words, tokens = np.unique(every, return_inverse=True)
            # the end is number 0, then words by frequency: small numbers pack well
            rank = np.argsort(np.argsort(-np.where(words == END, len(every) + 1, np.bincount(tokens)), kind="stable"))
            tokens, words = rank[tokens], words[np.argsort(rank)]
            learned = np.repeat(~np.array(held), sizes)
            row = [
                [made], [ids], [held], [sizes], [pack(tokens.astype(np.int32))], [pack(words)],
                [pack(np.bincount(tokens[learned], minlength=len(words)).astype(np.int64))],
            ]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())] + [pa.binary()] * 3
            ids, held, sizes, parts, total, made = [], [], [], [], 0, made + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, types, strict=True)],
                names=["chunk", "doc_id", "held", "size", "tokens", "words", "trained"],
            )

        for batch in batches:
            for doc, out, text in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                batch.column(2).cast(pa.large_binary()).to_pylist(),
                strict=True,
            ):
                part = np.append(hashes.of(ascii_words(text or b"")), END)
                ids.append(doc)
                held.append(out)
                sizes.append(len(part))
                parts.append(part)
                total += len(part)
                if total >= CHUNK_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), held_out.alias("held"), docs["text"].cast("string").alias("text")
    )
    return rows.mapInArrow(run, CHUNKS)


def _split(bucket: np.ndarray, n: int) -> list[np.ndarray]:
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.cumsum(np.bincount(bucket, minlength=n))[:-1])


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return (mix(h) % np.uint64(n)).astype(np.int64)


def unigram_counts(chunks: DataFrame, buckets: int, frequent: int) -> DataFrame:
    """``chunk, bucket, counts``: training counts of each chunk's words of a bucket, in its order.

    One row per bucket has chunk null, ``stats`` = tokens, types and types with
    counts 1 to DISCOUNTED + 1, and the words with a count over ``frequent``.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, trained in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words, trained = unpack(words, np.uint64), unpack(trained, np.int64)
                dealt = [(b, at) for b, at in enumerate(_split(_bucket(words, buckets), buckets)) if len(at)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b for b, _ in dealt], pa.int64()),
                        pa.array([chunk] * len(dealt), pa.int64()),
                        pa.array([words[at].tobytes() for _, at in dealt], pa.binary()),
                        pa.array([pack(trained[at]) for _, at in dealt], pa.binary()),
                    ],
                    names=["bucket", "chunk", "words", "trained"],
                )

    def count(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
        trained = np.concatenate([unpack(x, np.int64) for x in table.column("trained").to_pylist()])
        known, number = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(number, trained, len(known)).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        counts = [pack(c) for c in np.split(total[number], ends[:-1])]
        by_count = np.bincount(total[(total > 0) & (total <= DISCOUNTED + 1)], minlength=DISCOUNTED + 2)[1:]
        stats = [int(total.sum()), int((total > 0).sum()), *by_count.tolist()]
        many = np.flatnonzero(total > frequent)
        often = [{"word": int(w), "n": int(n)} for w, n in zip(known[many].view(np.int64), total[many], strict=True)]
        rows = len(words)
        return pa.table(
            {
                "chunk": pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (rows + 1), pa.int64()),
                "counts": pa.array([*counts, None], pa.binary()),
                "stats": pa.array([None] * rows + [stats], pa.list_(pa.int64())),
                "often": pa.array([None] * rows + [often], pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))),
            }
        )

    dealt = chunks.select("chunk", "words", "trained").mapInArrow(
        deal, "bucket long, chunk long, words binary, trained binary"
    )
    return dealt.groupBy("bucket").applyInArrow(
        count, "chunk long, bucket long, counts binary, stats array<long>, often array<struct<word:long,n:long>>"
    )


def with_counts(chunks: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """``chunks`` with the training counts ``known`` of their vocabulary, without ``trained``."""

    def join(table: pa.Table, of_words: pa.Table) -> pa.Table:
        words = unpack(table.column("words")[0].as_py(), np.uint64)
        known = chunk_counts(of_words, words, buckets)
        return table.append_column("known", pa.array([pack(known)], pa.binary()))

    return (
        chunks.drop("trained")
        .groupBy("chunk")
        .cogroup(counts.filter("chunk is not null").select("chunk", "bucket", "counts").groupBy("chunk"))
        .applyInArrow(join, CHUNKS.replace("trained", "known"))
    )


class Pairs(NamedTuple):
    """Distinct (context, word) of a chunk, in order, and the pair of each token."""

    context: np.ndarray  # number of the context word; the vocabulary's size is the start
    word: np.ndarray
    of_token: np.ndarray
    parts: list[np.ndarray]  # pairs by bucket


def chunk_pairs(tokens: np.ndarray, size: np.ndarray, words: np.ndarray, buckets: int, spread: dict[int, int]) -> Pairs:
    """``spread`` has the contexts so frequent that their words go to several buckets, and to how many."""
    v = len(words)
    context = np.concatenate([[v], tokens[:-1]]).astype(np.int64)
    context[np.cumsum(size)[:-1]] = v
    code, of_token = np.unique(context * (v + 1) + tokens, return_inverse=True)
    context, word = code // (v + 1), code % (v + 1)
    names = np.append(words, START)
    ways = np.ones(v + 1, np.uint64)
    for name, n in spread.items():
        ways[np.flatnonzero(names == np.uint64(name))] = n
    sub = mix(names[word] ^ MIX_A) % ways[context]
    return Pairs(context, word, of_token, _split(_bucket(names[context] + sub * MIX_A, buckets), buckets))


def _runs(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of one context."""
    heads = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    return heads, np.diff(np.append(heads, len(context)))


def chunk_counts(table: pa.Table, words: np.ndarray, buckets: int) -> np.ndarray:
    """Training counts of a chunk's vocabulary from its rows of ``unigram_counts``."""
    total = np.zeros(len(words), np.int64)
    parts = _split(_bucket(words, buckets), buckets)
    for bucket, counts in zip(table.column("bucket").to_pylist(), table.column("counts").to_pylist(), strict=True):
        total[parts[bucket]] = unpack(counts, np.int64)
    return total


def _opened(table: pa.Table) -> tuple[np.ndarray, ...]:
    row = {n: table.column(n)[0].as_py() for n in table.column_names}
    return (
        unpack(row["tokens"], np.int32).astype(np.int64),
        np.array(row["size"], np.int64),
        unpack(row["words"], np.uint64),
        np.array(row["held"], bool),
        unpack(row["known"], np.int64),
    )


def bigram_counts(chunks: DataFrame, unigrams: Unigrams, buckets: int, spread: dict[int, int]) -> DataFrame:
    """``chunk, bucket, counts, types, seen`` in the order of the chunk's pairs of that bucket.

    ``counts`` are the pairs' training counts; per context ``types`` has the
    numbers of following words with counts 1..DISCOUNTED and ``seen`` the
    unigram probability of all that follow.  One row per bucket has chunk null
    and ``stats`` = pairs with counts 1 to DISCOUNTED + 1, and the sums
    of spread contexts.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from deal_chunk(pa.Table.from_batches([batch.slice(i, 1)]))

    def deal_chunk(table: pa.Table) -> Iterator[pa.RecordBatch]:
        tokens, size, words, held, known = _opened(table)
        pairs = chunk_pairs(tokens, size, words, buckets, spread)
        times = np.bincount(pairs.of_token[np.repeat(~held, size)], minlength=len(pairs.word))
        names = np.append(words, START)
        out: list[list] = [[] for _ in range(7)]
        for bucket, at in enumerate(pairs.parts):
            if len(at):
                heads, length = _runs(pairs.context[at])
                word = np.ascontiguousarray(words[pairs.word[at]]).view(np.uint8).reshape(-1, 8)[:, :6]
                values = [
                    bucket,
                    table.column("chunk")[0].as_py(),
                    names[pairs.context[at][heads]].tobytes(),
                    pack(length.astype(np.int32)),
                    word.tobytes(),
                    pack(known[pairs.word[at]].astype(np.int64)),
                    pack(times[at].astype(np.int32)),
                ]
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        types = [pa.int64(), pa.int64()] + [pa.binary()] * 5
        names_ = ["bucket", "chunk", "context", "length", "word", "known", "times"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names_)

    def count(table: pa.Table) -> pa.Table:
        context = [np.frombuffer(x, np.uint64) for x in table.column("context").to_pylist()]
        length = [unpack(x, np.int32) for x in table.column("length").to_pylist()]
        raw = np.frombuffer(b"".join(table.column("word").to_pylist()), np.uint8).reshape(-1, 6)
        word = np.zeros((len(raw), 8), np.uint8)
        word[:, :6] = raw
        word = word.view(np.uint64).ravel()
        known = np.concatenate([unpack(x, np.int64) for x in table.column("known").to_pylist()])
        times = np.concatenate([unpack(x, np.int32) for x in table.column("times").to_pylist()]).astype(np.int64)
        flat = np.concatenate(context)
        names, of_run = np.unique(flat, return_inverse=True)
        of_pair = np.repeat(of_run, np.concatenate(length))
        order = np.lexsort((word, of_pair))
        changed = (of_pair[order][1:] != of_pair[order][:-1]) | (word[order][1:] != word[order][:-1])
        heads = np.flatnonzero(np.concatenate([[True], changed]))
        total = np.add.reduceat(times[order], heads)
        per_pair = np.empty(len(order), np.int64)
        per_pair[order] = np.repeat(total, np.diff(np.append(heads, len(order))))
        first = order[heads]
        seen = np.bincount(of_pair[first], np.where(total > 0, unigrams.probability(known[first]), 0.0), len(names))
        types = np.zeros((len(names), DISCOUNTED), np.int64)
        few = (total > 0) & (total <= DISCOUNTED)
        np.add.at(types, (of_pair[first][few], total[few] - 1), 1)
        by_count = np.bincount(total[(total > 0) & (total <= DISCOUNTED + 1)], minlength=DISCOUNTED + 2)[1:]
        sums = [
            {"context": int(names[i].view(np.int64)), "types": types[i].tolist(), "seen": float(seen[i])}
            for i in np.flatnonzero(np.isin(names, np.array(list(spread), np.uint64)))
        ]
        out: list[list] = [[], [], []]
        pair_end = run_end = 0
        for runs, lengths in zip(context, length, strict=True):
            mine = of_run[run_end : run_end + len(runs)]
            n = int(lengths.sum())
            out[0].append(pack(per_pair[pair_end : pair_end + n].astype(np.int32)))
            out[1].append(pack(types[mine].astype(np.int32)))
            out[2].append(pack(seen[mine]))
            pair_end, run_end = pair_end + n, run_end + len(runs)
        rows = len(context)
        sum_type = pa.list_(pa.struct([("context", pa.int64()), ("types", pa.list_(pa.int64())), ("seen", pa.float64())]))
        return pa.table(
            {
                "chunk": pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (rows + 1), pa.int64()),
                **{n: pa.array([*c, None], pa.binary()) for n, c in zip(["counts", "types", "seen"], out, strict=True)},
                "stats": pa.array([None] * rows + [by_count.tolist()], pa.list_(pa.int64())),
                "sums": pa.array([None] * rows + [sums], sum_type),
            }
        )

    dealt = chunks.mapInArrow(
        deal, "bucket long, chunk long, context binary, length binary, word binary, known binary, times binary"
    )
    return dealt.groupBy("bucket").applyInArrow(
        count,
        "chunk long, bucket long, counts binary, types binary, seen binary, stats array<long>, "
        "sums array<struct<context:long,types:array<long>,seen:double>>",
    )


def _sums(df: DataFrame) -> np.ndarray:
    """Element-wise sum of ``stats`` over the rows that have it."""
    rows = df.filter("stats is not null").select(F.posexplode("stats").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n"))
    found = {r.i: r.n for r in rows.collect()}
    return np.array([found[i] for i in sorted(found)], np.int64)


def katz_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs`` (doc_id, text).

    Learns from the rows where ``held_out`` is false.  ``score`` is the model's
    log10 probability: the discounted bigram if training has it, else the
    context's backoff weight times the discounted unigram, which for an unknown
    word is the unigrams' freed mass.  A context that frees no mass counts one
    event more and leaves that to the others.  ``base_score`` smooths unigrams
    by one half.

    A null text is empty: the end alone.  Null ids and repeated rows are scored
    (and learned) like others; without learnable rows every token is unknown;
    an empty table gives no rows; other columns are ignored.  Words are told
    apart by 64-bit hashes, the words after one context by 48 bits.
    """
    chunks = stored(token_chunks(docs, held_out), "katz-chunks")
    tokens = chunks.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(1, -(-tokens // BUCKET_TOKENS))
    frequent = max(1, tokens // (4 * buckets))
    counted = stored(unigram_counts(chunks, buckets, frequent), "katz-unigrams")
    stats = _sums(counted)
    if not len(stats):
        stats = np.zeros(DISCOUNTED + 3, np.int64)
    unigrams = Unigrams.of(int(stats[0]), int(stats[1]), stats[2:]) if stats[0] else Unigrams(
        0, 0, GoodTuring.of(np.zeros(DISCOUNTED + 1)), 1.0, 1.0
    )
    # at most 4 * buckets words are that frequent, and START
    often = counted.select(F.inline("often")).collect()
    spread = {r.word & (1 << 64) - 1: -(-r.n // frequent) for r in often}
    train_docs = chunks.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    if train_docs > frequent:
        spread[int(START)] = -(-train_docs // frequent)
    spread.pop(int(END), None)
    known_chunks = stored(with_counts(chunks, counted, buckets), "katz-chunks")
    discard(chunks)
    discard(counted)
    paired = stored(bigram_counts(known_chunks, unigrams, buckets, spread), "katz-bigrams")
    stats = _sums(paired)
    discount = GoodTuring.of(stats if len(stats) else np.zeros(DISCOUNTED + 1))
    sums = (
        paired.select(F.inline("sums"))
        .groupBy("context")
        .agg(F.sum("seen").alias("seen"), *(F.sum(F.get("types", F.lit(i))).alias(f"n{i}") for i in range(DISCOUNTED)))
        .collect()
    )
    whole = {
        r.context & (1 << 64) - 1: (np.array([r[f"n{i}"] for i in range(DISCOUNTED)], np.int64), r.seen) for r in sums
    }

    def score(table: pa.Table, given: pa.Table) -> pa.Table:
        tokens, size, words, held, known = _opened(table)
        v = len(words)
        pairs, names = chunk_pairs(tokens, size, words, buckets, spread), np.append(words, START)
        count, seen = np.zeros(len(pairs.word), np.int64), np.zeros(v + 1)
        types = np.zeros((v + 1, DISCOUNTED), np.int64)
        columns = (given.column(n).to_pylist() for n in ("bucket", "counts", "types", "seen"))
        for bucket, counts, types_, seen_ in zip(*columns, strict=True):
            at = pairs.parts[bucket]
            heads, _ = _runs(pairs.context[at])
            count[at] = unpack(counts, np.int32)
            types[pairs.context[at][heads]] = unpack(types_, np.int32).reshape(-1, DISCOUNTED)
            seen[pairs.context[at][heads]] = unpack(seen_, np.float64)
        for name, (all_types, all_seen) in whole.items():
            i = np.flatnonzero(names == np.uint64(name))
            types[i], seen[i] = all_types, all_seen
        times = np.append(known, train_docs)  # of each context in training
        freed = types @ (np.arange(1, DISCOUNTED + 1) * (1 - discount.factors))
        plain = freed <= 0
        divisor = np.maximum(times + plain, 1)
        backoff = np.where(times > 0, np.where(plain, 1.0, freed) / divisor / np.maximum(1 - seen, 1e-300), 1.0)
        lower = unigrams.probability(known)
        c, p = pairs.context, pairs.word
        higher = discount.at(count) * count / divisor[c]
        log = np.log10(np.where(count > 0, higher, backoff[c] * lower[p]))
        doc = np.repeat(np.arange(len(size)), size)
        base = np.log10((known + 0.5) / (unigrams.tokens + 0.5 * (unigrams.types + 1)))
        return pa.table(
            {
                "doc_id": pa.array(table.column("doc_id")[0].as_py(), pa.int64()),
                "held_out": pa.array(held),
                "n_tokens": pa.array(size),
                "n_known": pa.array(np.bincount(doc, known[tokens] > 0, len(size)).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(size), unigrams.tokens, np.int64)),
                "base_score": pa.array(np.bincount(doc, base[tokens], len(size))),
                "score": pa.array(np.bincount(doc, log[pairs.of_token], len(size))),
            }
        )

    given = paired.filter("chunk is not null").select("chunk", "bucket", "counts", "types", "seen")
    return known_chunks.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(score, SCORES)
