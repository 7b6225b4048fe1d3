"""Exact n-gram Jaccard self-join of documents.

Documents with equal shingle sets form one class.  Classes meet in tiles: a
tile belongs to a band of set sizes and holds the classes that agree on one
part of the shingle space.  With more parts than two linked sets can differ
in, linked sets agree on some part, so no link is missed.  Inside a tile
hashed bitmaps bound the overlap from above; what passes is compared exactly
as sorted arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from stratum.llm.common import MIX_A, MIX_B, MIX_C, WordHashes, ascii_words, discard, mix, stored
from stratum.llm.components import merged_components


class Threshold(NamedTuple):
    """Similarity as a fraction, so that tests are exact in integers."""

    of: int
    out_of: int

    def holds(self, overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether overlap / union reaches the fraction; ``sizes`` is the sum of both."""
        return self.out_of * overlap >= self.of * (sizes - overlap)


class Band(NamedTuple):
    number: int
    low: int
    high: int
    differ: int  # most elements by which a smaller set of this band and a linked one differ
    parts: int
    least: int  # parts with fewer elements are left out where enough others remain


def shingles(text: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; of the whole sequence if shorter."""
    words = ascii_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    if len(h) < n:
        value = np.array([len(h)], np.uint64) * MIX_C
        for w in h:
            value = mix(value ^ w)
        return value
    rolled = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        rolled = mix(rolled) + h[i : len(h) - n + 1 + i] * MIX_B
    return np.unique(mix(rolled))


def _enough(size: int, parts: int, least: int) -> float:
    """Parts with at least ``least`` elements to expect of a set of ``size``."""
    mean = size / parts
    return parts * (1 - sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(least)))


@lru_cache(maxsize=None)
def bands(t: Threshold) -> tuple[Band, ...]:
    """Size bands, up to 2**33, such that a linked partner lies in the same or a neighbouring band."""
    out, low, high = [], 1, 1
    while low <= 1 << 33:
        differ = (high + high * t.out_of // t.of) * (t.out_of - t.of) // (t.out_of + t.of)
        parts, least = differ + 1, 0
        for wanted in (4, 3, 2, 1):
            fits = [p for p in range(differ + 1, 2 * differ + 8, 1 + differ // 32) if _enough(low, p, wanted) >= 1.1 * differ + 3]
            if fits:
                parts, least = fits[0], wanted
                break
        out.append(Band(len(out), low, high, differ, parts, least))
        low, high = high + 1, max(high + 1, high * t.out_of // t.of)
    return tuple(out)


@lru_cache(maxsize=100_000)
def bands_of(size: int, t: Threshold) -> tuple[Band, ...]:
    """The band of a size, and the one below if smaller linked sets can lie there."""
    known = bands(t)
    own = next(i for i, b in enumerate(known) if size <= b.high)
    below = own > 0 and size * t.of <= known[own - 1].high * t.out_of
    return (known[own - 1], known[own]) if below else (known[own],)


def tile_keys(found: np.ndarray, t: Threshold) -> np.ndarray:
    """Keys of the tiles that a set belongs to.

    Linked sets A and B differ in at most ``differ`` elements, so they agree on
    at least ``parts - differ`` parts.  If fewer parts than that are small in
    A, they agree on one that is not; so A then leaves out its small parts.
    """
    keys = []
    for band in bands_of(len(found), t):
        part = ((found >> np.uint64(32)) * np.uint64(band.parts)) >> np.uint64(32)
        size = np.bincount(part.astype(np.int64), minlength=band.parts)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(found ^ MIX_C))])
        ends = np.cumsum(size)
        print_ = sums[ends] - sums[ends - size]
        number = np.arange(band.parts, dtype=np.uint64)
        key = mix(print_ + mix((number << np.uint64(16)) + np.uint64(band.number)))
        big = size >= band.least
        keys.append(key[big] if big.sum() > band.differ else key)
    return np.concatenate(keys)


def bitmap(found: np.ndarray) -> np.ndarray:
    """Bit set of the low hash bits, eight to sixteen bits for each element."""
    bits = max(64, 1 << (8 * len(found) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(found & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little")


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of the same set with ``size`` bytes."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def overlap_bound(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap: a bit of A that B lacks is an element of A that B lacks."""
    only_a = np.bitwise_count(a & ~b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(-1, dtype=np.int64)
    return np.minimum(size_a - only_a, size_b - only_b)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _class_id(found: np.ndarray) -> int | None:
    if not len(found):
        return None
    total = mix(mix(found + MIX_A).sum(keepdims=True) ^ mix(np.array([len(found)], np.uint64)))
    return int(_signed(total)[0])


def _narrow(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    own = docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")
    return docs.select(*own, *(docs[c] for c in carry))


def set_profiles(docs: DataFrame, n: int, t: Threshold) -> DataFrame:
    """``doc_id, n_shingles, class_id, tiles`` per document; class_id is null for empty sets.

    Columns of ``docs`` after doc_id and text follow as they are.
    """
    carried = docs.schema.fields[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                sets = [shingles(x or b"", n, hashes) for x in part.column(1).cast(pa.large_binary()).to_pylist()]
                tiles = [_signed(tile_keys(s, t)) if len(s) else np.empty(0, np.int64) for s in sets]
                cuts = np.concatenate([[0], np.cumsum([len(k) for k in tiles])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_class_id(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(tiles))),
                        *part.columns[2:],
                    ],
                    names=["doc_id", "n_shingles", "class_id", "tiles", *names],
                )

    names = [field.name for field in carried]
    schema = StructType.fromDDL("doc_id long, n_shingles long, class_id long, tiles array<long>")
    return docs.mapInArrow(run, StructType([*schema.fields, *carried]))


def class_sets(docs: DataFrame, n: int) -> DataFrame:
    """``class_id, shingles, bitmap`` (bytes) of documents, one row per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                sets = [shingles(x or b"", n, hashes) for x in part.column(1).cast(pa.large_binary()).to_pylist()]
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_class_id(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                        pa.array([bitmap(s).tobytes() for s in sets], pa.binary()),
                    ],
                    names=["class_id", "shingles", "bitmap"],
                )

    return docs.mapInArrow(run, "class_id long, shingles binary, bitmap binary").dropDuplicates(["class_id"])


def verified(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """The pairs (u, v) that link: the bitmap bound first, then the exact overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b, bits_a, bits_b in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                bits_a, bits_b = np.frombuffer(bits_a, np.uint8), np.frombuffer(bits_b, np.uint8)
                size = min(len(bits_a), len(bits_b))
                bound = overlap_bound(folded(bits_a, size), folded(bits_b, size), len(a), len(b))
                if not t.holds(bound, len(a) + len(b)):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                keep.append(bool(t.holds(int((b[at] == a).sum()), len(a) + len(b))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(
                pa.array(keep, pa.bool_())
            )

    def side(name: str) -> DataFrame:
        return sets.select(F.col("class_id").alias(name), F.struct("shingles", "bitmap").alias(f"of_{name}"))

    both = pairs.join(side("u"), "u").join(side("v"), "v")
    return both.select("u", "v", "of_u.shingles", "of_v.shingles", "of_u.bitmap", "of_v.bitmap").toDF(
        "u", "v", "a", "b", "bits_a", "bits_b"
    ).mapInArrow(run, "u long, v long")


def star_pairs(members: DataFrame, salt: int) -> DataFrame:
    """One candidate per class: the pivot that it shares most tiles with.

    A tile's pivot is its member with the least salted hash, so the pairs of a
    tile are as many as its members.  ``members`` has key, class_id, label;
    classes that already share the pivot's label are left out.
    """
    pivot = F.min(F.struct(F.xxhash64("class_id", F.lit(salt)), "class_id", "label")).over(Window.partitionBy("key"))
    stars = members.withColumn("pivot", pivot).filter("label <> pivot.label")
    shared = stars.groupBy("class_id", F.col("pivot.class_id").alias("pivot")).count()
    best = shared.groupBy("class_id").agg(F.max(F.struct("count", "pivot")).alias("best"))
    return best.select(F.col("class_id").alias("u"), F.col("best.pivot").alias("v"))


PAIRS = "key long, u long, v long, later boolean, score double"
Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # columns of PAIRS


class Tiles(NamedTuple):
    """Members of whole tiles, a tile's in a row."""

    key: np.ndarray
    block: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    size: np.ndarray
    bits: list[np.ndarray]

    @classmethod
    def of(cls, table: pa.Table) -> Tiles:
        numbers = (table.column(n).to_numpy() for n in ("key", "block", "class_id", "label", "size"))
        return cls(*numbers, [np.frombuffer(x, np.uint8) for x in table.column("bitmap").to_pylist()])

    def pairs_of_two(self, first: np.ndarray, t: Threshold, nearest: bool) -> Found:
        """Pairs of the tiles with two members, which start at ``first``; all of them at once."""
        u, v = first, first + 1
        rank_u, rank_v = np.where(self.block[u] != self.block[v], (self.block[u], self.block[v]), (self.ids[u], self.ids[v]))
        u, v = np.where(rank_u < rank_v, (v, u), (u, v))
        small, large = np.minimum(self.size[u], self.size[v]), np.maximum(self.size[u], self.size[v])
        open_ = (self.label[u] != self.label[v]) & (t.out_of * small >= t.of * large)
        u, v = u[open_], v[open_]
        width = np.array([min(len(self.bits[i]), len(self.bits[j])) for i, j in zip(u, v, strict=True)], np.int64)
        bound = np.empty(len(u), np.int64)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            a = np.stack([folded(self.bits[i], w) for i in u[at]])
            b = np.stack([folded(self.bits[i], w) for i in v[at]])
            bound[at] = overlap_bound(a, b, self.size[u[at]], self.size[v[at]])
        sizes = self.size[u] + self.size[v]
        fits = t.holds(bound, sizes)
        u, v, score = u[fits], v[fits], (bound / np.maximum(sizes - bound, 1))[fits]
        key, n = self.key[u], len(u)
        if nearest:
            u, v, key, score = np.append(u, v), np.append(v, u), np.append(key, key), np.append(score, score)
        return key, self.ids[u], self.ids[v], np.arange(len(u)) >= n, score

    def pairs_of_tile(self, start: int, stop: int, t: Threshold, nearest: bool) -> Found:
        """Pairs of one tile of any size."""
        label, ids, size = self.label[start:stop], self.ids[start:stop], self.size[start:stop]
        side, raw = self.block[start:stop], self.bits[start:stop]
        width = min(map(len, raw))
        bits = np.stack([folded(x, width) for x in raw])
        rank = side if side.max() != side.min() else ids
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0))]
        best, partner = np.full(len(ids), -1.0), np.zeros(len(ids), np.int64)
        for i in range(len(ids)):
            small, large = np.minimum(size, size[i]), np.maximum(size, size[i])
            at = np.flatnonzero((rank < rank[i]) & (label != label[i]) & (t.out_of * small >= t.of * large))
            if not len(at):
                continue
            bound, sizes = overlap_bound(bits[i], bits[at], size[i], size[at]), size[i] + size[at]
            fits = t.holds(bound, sizes)
            at, score = at[fits], (bound / np.maximum(sizes - bound, 1))[fits]
            if nearest and len(at):
                better = score > best[at]
                best[at[better]], partner[at[better]] = score[better], ids[i]
                at, score = at[[score.argmax()]], score[[score.argmax()]]
            out.append((np.full(len(at), ids[i]), ids[at], np.zeros(len(at), bool), score))
        if nearest:
            met = best >= 0
            out.append((ids[met], partner[met], np.ones(met.sum(), bool), best[met]))
        u, v, later, score = (np.concatenate(column) for column in zip(*out, strict=True))
        return np.full(len(u), self.key[start]), u, v, later, score


def tile_pairs(members: DataFrame, sets: DataFrame, t: Threshold, block: int, nearest: bool = False) -> DataFrame:
    """``key, u, v, later, score``: pairs of classes of one tile with different labels that the bitmap bound admits.

    All of them, or with ``nearest`` each class's partner of the best bound
    among the earlier ones and among the later ones (``later``), so that a tile
    has at most two pairs a member.  A tile without a row has no link left.  A
    tile with more than ``block`` members is cut into blocks, and each two
    blocks meet on their own.  Tiles stream through a task in order of key;
    what it holds is one batch and the rest of a tile, two blocks at most.
    """
    names = [field.split()[0] for field in PAIRS.split(", ")]

    def pairs(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        tiles, ends = Tiles.of(table), np.append(starts[1:], len(table))
        out = [tiles.pairs_of_two(starts[ends - starts == 2], t, nearest)]
        for start, end in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
            out.append(tiles.pairs_of_tile(start, end, t, nearest))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*out, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            # a batch of one tile only adds to what is held
            tile = [batch.column(n).to_numpy() for n in ("key", "low", "high")]
            last = tuple(held[0].column(n)[0].as_py() for n in ("key", "low", "high"))
            if all(c[0] == c[-1] == k for c, k in zip(tile, last, strict=True)):
                continue
            table = pa.concat_tables(held)
            starts = tile_starts(table)
            yield pairs(table.slice(0, int(starts[-1])), starts[:-1])
            held = [table.slice(int(starts[-1]))]
        if held:
            table = pa.concat_tables(held)
            yield pairs(table, tile_starts(table))

    def tile_starts(table: pa.Table) -> np.ndarray:
        columns = [table.column(n).to_numpy() for n in ("key", "low", "high")]
        changed = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        return np.flatnonzero(np.append(True, changed))

    blocks = F.ceil(F.count("*").over(Window.partitionBy("key")) / block)
    own = F.pmod(F.xxhash64("class_id"), "blocks")
    cut = members.withColumn("blocks", blocks).withColumn("block", own)
    met = cut.select(
        "key", "class_id", "label", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    ).select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    bits = sets.select("class_id", "bitmap", (F.octet_length("shingles") / 8).cast("long").alias("size"))
    tile = ["key", "low", "high"]
    dealt = met.join(bits, "class_id").select(*tile, "block", "class_id", "label", "size", "bitmap")
    return dealt.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(run, PAIRS)


def stored_tile_pairs(members: DataFrame, sets: DataFrame, t: Threshold, block: int, slices: int) -> DataFrame:
    """The nearest ``tile_pairs`` of all tiles, a slice of the tiles after the other.

    Each member takes its class's bitmap to each of its tiles; the shuffle
    files of a slice go before the next slice's are written.
    """
    slice_of = F.pmod(F.xxhash64("key"), F.lit(slices))
    parts = [
        stored(tile_pairs(members.filter(slice_of == i), sets, t, block, nearest=True), "ngram-near") for i in range(slices)
    ]
    return reduce(DataFrame.union, parts)


def nearest_pairs(near: DataFrame) -> DataFrame:
    """(u, v): over all tiles, each class's best earlier and best later partner."""
    best = near.groupBy("u", "later").agg(F.max(F.struct("score", "v")).alias("best"))
    return best.select("u", F.col("best.v").alias("v")).distinct()


def _labelled(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of the tiles that still hold several components."""
    label = components.withColumnRenamed("node", "class_id")
    rows = members.select("key", "class_id").join(label, "class_id", "left").select(
        "key", "class_id", F.coalesce("component", "class_id").alias("label")
    )
    tile = Window.partitionBy("key")
    return (
        rows.withColumns({"least": F.min("label").over(tile), "most": F.max("label").over(tile)})
        .filter("least <> most")
        .select("key", "class_id", "label")
    )


def ngram_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 3,
    threshold: Threshold = Threshold(90, 100),
    star_rounds: int = 1,
    nearest_rounds: int = 2,
    block: int = 2048,
    slices: int = 4,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, group_id`` and ``carry`` per row of ``docs``.

    Two documents link when the Jaccard similarity of their sets of n-word
    shingles reaches ``threshold``; the component is the least id that links
    reach.  Star rounds link most copies with one pair each; in the nearest
    rounds each class tries its best partners, and tiles in which the bitmap
    bound admits none are done; then every pair of a tile that these left in
    different components is examined, so the components are exact for any
    number of rounds.

    Null, empty and wordless texts have no shingles, class null and link with
    nothing.  Repeated rows are rows of one class each; a component without
    any non-null id has a null id.  ``group_id`` tells components apart whatever
    their ids, null for class null.  An empty table gives no rows; other columns
    are ignored.  Shingles are compared by 64-bit hashes.
    """
    t = Threshold(*threshold)
    rows = _narrow(docs, id_col, text_col, list(carry))
    profiles = stored(set_profiles(rows, n, t), "ngram-profiles")
    classes = profiles.dropna(subset=["class_id"]).groupBy("class_id")
    tiles = classes.agg(F.first("tiles").alias("tiles")).select("class_id", F.explode("tiles").alias("key"))
    tile = Window.partitionBy("key")
    members = (
        tiles.withColumns({"least": F.min("class_id").over(tile), "most": F.max("class_id").over(tile)})
        .filter("least <> most")
        .select("key", "class_id")
    )
    members = stored(members, "ngram-tiles")
    # the tiles of all classes are the larger part of the profiles; few of them are needed again
    slim = stored(profiles.drop("tiles"), "ngram-profiles")
    discard(profiles)
    profiles, classes = slim, slim.dropna(subset=["class_id"]).groupBy("class_id")
    reps = stored(classes.agg(F.min("doc_id").alias("rep")), "ngram-classes")
    wanted = reps.join(members.select("class_id").distinct(), "class_id", "left_semi").select("rep").distinct()
    texts = rows.select("doc_id", "text").join(wanted, rows["doc_id"].eqNullSafe(wanted["rep"]), "left_semi")
    sets = stored(class_sets(texts, n), "ngram-sets")

    components, current = None, members.withColumn("label", F.col("class_id"))
    for salt in range(star_rounds):
        found = stored(verified(star_pairs(current, salt), sets, t), "ngram-links")
        components = merged_components(components, found)
        current = stored(_labelled(current, components), "ngram-open")
    for _ in range(nearest_rounds):
        if current.isEmpty():
            break
        near = stored_tile_pairs(current, sets, t, block, slices)
        found = stored(verified(nearest_pairs(near), sets, t), "ngram-links")
        components = merged_components(components, found)
        open_ = current.join(near.select("key").distinct(), "key", "left_semi")
        current = stored(_labelled(open_, components), "ngram-open")
    rest = tile_pairs(current, sets, t, block).select("u", "v").distinct()
    found = stored(verified(rest, sets, t), "ngram-links")
    components = merged_components(components, found)

    label = components.withColumnRenamed("node", "class_id")
    group: Column = F.coalesce("component", "class_id")
    labelled = reps.join(label, "class_id", "left").select("class_id", "rep", group.alias("group"))
    least = labelled.groupBy("group").agg(F.min("rep").alias("component_id"))
    by_class = labelled.join(least, "group").select("class_id", "component_id", F.col("group").alias("group_id"))
    by_class = stored(by_class, "ngram-components")
    discard(sets)
    joined = profiles.select("doc_id", "n_shingles", "class_id", *carry).join(by_class, "class_id", "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        "class_id",
        F.when(F.col("class_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "group_id",
        *carry,
    )
