"""Centroids, BPE and whitening against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, cluster string, x int"
NAN, INF = float("nan"), float("inf")


def vector_rows(size: int, count: int, seed: int = 5) -> list[tuple]:
    """Vectors around a few points, with copies, and rows that must go."""
    pick = np.random.default_rng(seed)
    points = pick.normal(0, 2, (7, size))
    rows = [(i, (points[i % 7] + pick.normal(0, 0.2, size)).tolist(), "c", i) for i in range(count)]
    rows += [(3, rows[3][1], "c", 1), (4, rows[9][1], None, None), (None, rows[5][1], "c", 0), rows[8]]
    good = rows[0][1]
    for i, bad in enumerate([None, [], [None, *good[1:]], [NAN, *good[1:]], [*good[1:], INF], [-INF, *good[1:]]]):
        rows.append((1000 + i, bad, "c", 2))
    return rows


def whole(rows: list[tuple], size: int, shift: int = 0) -> list[tuple]:
    out = []
    for row in rows:
        v = row[1]
        if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v):
            out.append((row[0], [math.floor(64 * float(np.float32(c))) + shift for c in v]))
    return out


# ---------------------------------------------------------------- centroids


def brute_clusters(kept: list[tuple], clusters: int, rounds: int) -> list[tuple]:
    def rank(row):
        digest = "" if row[0] is None else hashlib.sha256(f"1:{row[0]}".encode()).hexdigest()
        return (row[0] is None, digest, row[1])

    centers = [x for _, x in sorted(kept, key=rank)[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centers))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for k, members in groups.items():
            centers[k] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    per = Counter()
    for _, k, d in found:
        per[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(i, k, d, per[k], sum(per.values()), digest[k]) for i, k, d in found]


def rows_of(df) -> Counter:
    return Counter(tuple(int(v) if i in (3, 4) else v for i, v in enumerate(row)) for row in df.collect())


@pytest.mark.parametrize("pivots", [0, 2, 6])
def test_centroids_equal_brute_force(spark, pivots):
    from stratum.llm.centroids import cluster_centroids

    rows = vector_rows(64, 150)
    rows += [(500, rows[0][1][:63], "short", 1), (501, [*rows[0][1], 1.0], "long", 1)]
    table = spark.createDataFrame(rows, VECTORS).repartition(4)
    expected = brute_clusters(whole(rows, 64), 16, 3)
    assert rows_of(cluster_centroids(table, pivots=pivots)) == Counter(expected)


def test_centroids_of_ties_and_few_vectors(spark):
    from stratum.llm.centroids import cluster_centroids

    same = [(i, [0.5, -0.5], "c", 1) for i in range(5)]
    for rows in (same, [(1, [0.0, 0.0], "", 0), (2, [1.0, 0.0], "", 0), (3, [0.5, 0.0], "", 0), (4, [0.5, 0.0], "", 0)]):
        table = spark.createDataFrame(rows, VECTORS)
        got = cluster_centroids(table, dimensions=2, clusters=3, rounds=2)
        assert rows_of(got) == Counter(brute_clusters(whole(rows, 2), 3, 2))
    nothing = spark.createDataFrame([(1, None, "", 0), (2, [NAN, 1.0], "", 0)], VECTORS)
    assert cluster_centroids(nothing, dimensions=2).count() == 0
    with pytest.raises(Exception, match="beyond"):
        cluster_centroids(spark.createDataFrame([(1, [1e30, 0.0], "", 0)], VECTORS), dimensions=2).count()


def test_ptolemaic_bounds_hold_and_prune():
    from stratum.llm.centroids import PtolemaicAssignment, distances_to, spread_out, squared_distances

    pick = np.random.default_rng(1)
    for spread, size in ((3, 2), (2**20, 64), (2**26, 16)):
        points = pick.integers(-spread, spread, (16, size))
        x = points[pick.integers(0, 16, 400)] + pick.integers(-max(spread // 20, 1), max(spread // 20, 1) + 1, (400, size))
        pivots = spread_out(points.tolist(), 6)
        ours = PtolemaicAssignment(points.tolist(), pivots)
        cached = distances_to(x, np.array(pivots))
        exact = np.stack([squared_distances(x, c) for c in points], axis=1)
        low = ours.bounds(cached)
        assert all(int(b) <= d for b, d in zip(low.ravel(), exact.ravel().tolist(), strict=True))
        choice, best = ours.nearest(x, cached)
        assert (choice == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
        assert ours.checked < ours.possible  # some distances were never computed
    assert ours.checked < 0.5 * ours.possible


# ---------------------------------------------------------------------- bpe


@pytest.fixture(scope="module")
def tokenizer_path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return str(public_tokenizers.path("word_bpe_49k.json"))


PIECES = ["the ", "hello", "a", "e", "'s", "'", "'re", " ", "\n", "<|endoftext|>", "<|end", "oftext|>", "é", "é"]
PIECES += ["́", "İ", "ß", "Σ", "中文", "한글", "한", "12", "½"]
PIECES += ["====", "#$%", "\U0001f642", "\U0001f469‍\U0001f4bb", "qu", "ing", "tion", "ABC", "x̨́"]
PIECES += [" ", " ", "ﬁ", "Å", "של", "हिन्"]


def in_parts(coder, text: str, count: int) -> list[int]:
    width = -(-len(text) // count)
    return coder.joined([coder.part(text[i : i + width]) for i in range(0, len(text), width)]).ids.tolist()


def test_joined_parts_equal_whole_texts(tokenizer_path):
    from stratum.llm.bpe import Splitter

    coder, pick = Splitter(tokenizer_path), random.Random(7)
    for windows in ((64, 256, 1024), (2, 8, 30)):
        coder.WINDOWS = windows
        for _ in range(600):
            text = "".join(pick.choice(PIECES) for _ in range(pick.randint(1, 90)))
            assert in_parts(coder, text, pick.choice([2, 3, 5, 8])) == coder.encode([text])[0], text


def test_long_unsplit_text_is_joined_by_tokens(tokenizer_path, monkeypatch):
    from stratum.llm.bpe import Splitter

    coder, pick, joins = Splitter(tokenizer_path), random.Random(8), []
    coder.WINDOWS = (16, 48)
    plain = coder._by_tokens
    monkeypatch.setattr(coder, "_by_tokens", lambda a, b: joins.append(plain(a, b)) or joins[-1])
    for kind in (string.ascii_lowercase, "ab", "a", "=-", "eé", "中文", "thinangre", "aAbB"):
        for _ in range(60):
            text = "".join(pick.choice(kind) for _ in range(pick.randint(100, 600)))
            text = f"well then {text} and's" if pick.random() < 0.3 else text
            assert in_parts(coder, text, pick.choice([2, 3, 4, 8])) == coder.encode([text])[0], text
    assert sum(found is not None for found in joins) > 300
    coder.by_rank = False  # a file whose merges don't tell: larger windows
    text = "thean" * 300
    assert in_parts(coder, text, 7) == coder.encode([text])[0]


class Counting:
    """A tokenizer that keeps the texts it was given in batches."""

    def __init__(self, full):
        self.full, self.texts = full, []

    def __getattr__(self, name):
        return getattr(self.full, name)

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.full.encode_batch_fast(texts, **options)


def test_new_chunks_are_encoded_together(tokenizer_path):
    from stratum.llm.bpe import Splitter

    coder, pick = Splitter(tokenizer_path), random.Random(9)
    coder.full, whole = Counting(coder.full), coder.full
    pieces = [x for x in PIECES if not x.isspace()] + ["\x01", "\x00", "\x1c"]
    chunks = ["".join(pick.choice(pieces) for _ in range(pick.randint(1, 5))) for _ in range(4000)]
    plain = [chunk for chunk in {*chunks} if "\x01" not in chunk]
    texts = [" ".join(plain), "\x01 \x01", "a\x01 b", " ".join(chunks)]
    for text in texts:
        assert coder.encode([text])[0] == whole.encode(text, add_special_tokens=False).ids
    coder = Splitter(tokenizer_path)
    coder.full = counted = Counting(coder.full)
    coder.encode([" ".join(plain)])
    assert len(counted.texts) < len(plain) / 100


def test_chunks_in_use_are_kept(tokenizer_path):
    from stratum.llm.bpe import Splitter

    coder = Splitter(tokenizer_path, limit=40)
    coder.full = counted = Counting(coder.full)
    for i in range(100):
        coder.encode([" ".join(["often", *(f"x{i}y{k}" for k in range(10))])])
    assert sum("often" in text for text in counted.texts) == 1
    assert len(coder.chunks) + len(coder.older) <= 2 * (40 // 2 + 11)


def test_chunk_spans():
    from stratum.llm.bpe import chunk_spans

    pick = random.Random(2)
    for _ in range(200):
        text = "".join(pick.choice("ab \t\n\x0b\x0c\r\x1c\x85\xa0é中\U0001f642") for _ in range(pick.randint(0, 30)))
        spans = zip(*map(np.ndarray.tolist, chunk_spans(text)), strict=True)
        assert [text[a:b].encode() for a, b in spans] == text.encode().split()


@pytest.mark.parametrize("piece", [40, 16384])
def test_bpe_round_trip(spark, tokenizer_path, piece):
    from tokenizers import Tokenizer

    from stratum.llm.bpe import decode_ids, encode_texts, encoding_digests

    pick = random.Random(3)
    texts = ["", None, "one", "a" * 50_000, "Hello, wo" * 4000, "<|endoftext|>" * 20, " \n ", "é́ " * 70]
    texts += ["".join(pick.choice(PIECES) for _ in range(400)) for _ in range(8)]
    rows = [(i, t, "clash", i) for i, t in enumerate(texts)] + [(2, "one", "again", 0), (None, texts[4], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, part int").repartition(3)
    library = Tokenizer.from_file(tokenizer_path)

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    expected, digests, decoded = Counter(), Counter(), Counter()
    for row in rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected[(row[0], len(ids), tuple(ids))] += 1
        digests[(row[0], len(ids), digest(" ".join(map(str, ids))), digest(text))] += 1
        decoded[(row[0], text)] += 1
    encoded = encode_texts(docs, tokenizer_path, piece=piece)
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in encoded.collect()) == expected
    assert Counter(map(tuple, decode_ids(encoded, tokenizer_path).collect())) == decoded
    assert Counter(map(tuple, encoding_digests(docs, tokenizer_path, piece=piece).collect())) == digests
    assert encoding_digests(docs.limit(0), tokenizer_path).count() == 0


# ---------------------------------------------------------------- whitening


def test_refined_eigenvectors_of_clustered_values():
    from stratum.llm.whitening import refined_eigenvectors

    pick = np.random.default_rng(2)
    basis = np.linalg.qr(pick.normal(size=(40, 40)))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        basis = basis @ (3 * np.eye(40, dtype=np.longdouble) - basis.T @ basis) / 2
    for values in (
        np.arange(40, 0, -1),
        np.r_[5 + 1e-9 * np.arange(20, 0, -1), 3 + 1e-12 * np.arange(19, -1, -1)],  # beyond float32
        np.r_[np.full(20, 7.0), np.full(20, 2.0)],  # multiple
        np.r_[np.geomspace(1e6, 1e-6, 40)],
    ):
        values = values.astype(np.longdouble)
        a = (basis * values) @ basis.T
        a = (a + a.T) / 2
        found, axes = refined_eigenvectors(a)
        assert np.abs(found - values).max() <= 1e-16 * values.max()
        assert np.abs(axes.T @ axes - np.eye(40)).max() < 1e-17
        assert np.abs(a @ axes - axes * found).max() <= 1e-16 * values.max()
    separate = np.arange(40, 0, -1).astype(np.longdouble)
    axes = refined_eigenvectors((basis * separate) @ basis.T)[1]
    assert np.abs(np.abs((axes * basis).sum(axis=0)) - 1).max() < 1e-16
    assert (refined_eigenvectors(np.zeros((3, 3)))[0] == 0).all()


def test_exact_products_of_large_entries():
    from stratum.llm.whitening import exact_products

    pick = np.random.default_rng(3)
    for largest in (5, 2**21, 2**41):
        y = pick.integers(-largest, largest, (300, 4))
        expected = y.T.astype(object) @ y.astype(object)
        assert (exact_products(y) == expected).all()


def test_whitening_equals_brute_force(spark):
    from stratum.llm.whitening import whiten

    rows = vector_rows(12, 90)
    rows += [(600, [1.0] * 5, "", 0), (601, [1.0] * 5, "", 0)]
    got = whiten(spark.createDataFrame(rows, VECTORS).repartition(4), components=8).collect()
    kept = whole(rows, 12, 1_000_000)
    x = np.array([v for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    gap = n * x - sums
    exact = gap.T @ gap
    cov = (exact / n**3).astype(np.float64)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    expected = (gap / n).astype(np.float64) @ axes / np.sqrt(values)
    assert Counter(r.vec_id for r in got) == Counter({i: 8 * c for i, c in Counter(i for i, _ in kept).items()})
    deviation = Counter((i, int(d)) for (i, _), d in zip(kept, (gap * gap).sum(axis=1), strict=True))
    assert Counter((r.vec_id, int(r.deviation)) for r in got) == Counter({k: 8 * c for k, c in deviation.items()})
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 9))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    for component in range(1, 9):
        mine = [r for r in got if r.component == component]
        ours = sorted((r.vec_id is None, r.vec_id or 0, abs(r.whitened)) for r in mine)
        theirs = sorted((i is None, i or 0, abs(w)) for (i, _), w in zip(kept, expected[:, component - 1], strict=True))
        assert np.allclose([o[2] for o in ours], [t[2] for t in theirs], rtol=1e-6, atol=1e-8)
        assert np.isclose(mine[0].explained, values[component - 1] / np.trace(cov), rtol=1e-9)


def test_whitening_without_variance(spark):
    from stratum.llm.whitening import whiten

    same = spark.createDataFrame([(i, [0.5, 0.25], "", 0) for i in range(4)], VECTORS)
    assert whiten(same).count() == 0
    assert whiten(same.limit(0)).count() == 0
    assert whiten(spark.createDataFrame([(1, [], "", 0), (2, None, "", 0)], VECTORS)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 1.0, 2.0 * i], "", 0) for i in range(6)], VECTORS)
    rows = whiten(line).collect()
    assert {r.component for r in rows} == {1} and rows[0].explained == pytest.approx(1)
    wide = spark.createDataFrame([(1, [2.0**33, 0.0], "", 0), (2, [0.0, 1.0], "", 0), (3, [-1.0, 5.0], "", 0)], VECTORS)
    x = np.array([[2**39, 0], [0, 64], [-64, 320]], object)
    gap = 3 * x - x.sum(axis=0)
    assert {r.vec_id: int(r.deviation) for r in whiten(wide).collect()} == dict(
        zip((1, 2, 3), (gap * gap).sum(axis=1), strict=True)
    )
    with pytest.raises(Exception, match="beyond"):
        whiten(spark.createDataFrame([(1, [1e30, 0.0], "", 0)], VECTORS)).count()


def test_new_queries_keep_their_columns(spark, tokenizer_path):
    from stratum.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").filter(F.size("embedding") == 64).count()
    clusters = QUERIES["op11_ptolemaic_centroids"](spark, folder)
    assert clusters.dtypes == [
        ("vec_id", "bigint"),
        ("cluster", "int"),
        ("distance", "bigint"),
        ("cluster_inertia", "bigint"),
        ("inertia", "bigint"),
        ("centroid_sha256", "string"),
    ]
    assert clusters.count() == vectors
    whitened = QUERIES["op13_whitening"](spark, folder)
    assert [t for _, t in whitened.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    assert whitened.count() == 32 * vectors
    coded = QUERIES["op12_bpe_round_trip"](spark, folder)
    assert coded.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert coded.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
