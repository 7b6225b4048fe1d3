"""The ten operators against brute force, and on odd rows (nulls, ties, empty tables, clashing columns)."""

from __future__ import annotations

import hashlib
import math
import random
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in ("lo", "mi", "ra", "tu", "ve", "sa", "ko") for b in ("n", "rt", "sk", "la", "ded", "po")]


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(n))


def article(seed: int, n: int) -> str:
    """Prose with some capitals, marks and symbols."""
    pick = random.Random(seed)
    out = []
    for word in prose(seed, n).split():
        word = word.capitalize() if pick.random() < 0.08 else word
        out.append(word + pick.choices(["", ",", ".", "%"], [85, 8, 6, 1])[0])
    return " ".join(out)


def corpus() -> list[tuple]:
    """Texts with exact and near copies, shared passages, long, empty and null texts, repeated rows, a null id."""
    passage = prose(999, 40)
    texts = [prose(i, 30 + 13 * i) for i in range(12)]
    texts += [texts[3], texts[5], texts[7] + " extra", "changed " + texts[8], texts[9].upper()]
    texts += [f"{prose(50 + i, 20)}\n{passage}\n{prose(70 + i, 20)}" for i in range(6)]
    texts += ["", None, "one", "two words", " \n\t ", prose(4, 6000), "aaaa" * 100, "éàü ß" * 40, "same same " * 60]
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[2], rows[19], (None, texts[4], None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    """With a column that only differs in meaning from the operators' own names."""
    return spark.createDataFrame(corpus(), DOCS).withColumn("tid", F.lit("clash")).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


# 1 chat ---------------------------------------------------------------------------------------


def turns() -> list[tuple]:
    odd = ["</s>[INST] ok [/INST]", r"<\s> \\ [\INST] <s><s>", "", None, "[[INST]]</s</s>", "é\n" * 30]
    rows = [(1, 0, "system", "be kind")]
    rows += [(1, i, ("assistant", "user")[i % 2], odd[i % len(odd)] or prose(i, 5)) for i in range(1, 20)]
    rows += [(2, i, ("user", "assistant")[i % 2], odd[i % len(odd)]) for i in range(12)]
    rows += [(3, 0, "system", prose(1, 900)), (4, 0, "assistant", prose(2, 900)), (4, 1, None, "x")]
    return rows + [(5, 0, "user", "twice"), (5, 0, "user", "twice"), (None, None, "assistant", "who")]


@pytest.mark.parametrize("budget", [1, 40, 120, 5000])
def test_chat_round_trip(spark, budget):
    from stratum.llm.chat import format_conversations, parse_window, turn_tokens, window_digests

    table = spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string")
    windows = format_conversations(table, budget=budget, history_turns=2, history_tokens=60)
    got = {r.conv_id: r for r in window_digests(windows).collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text in turns():
        by_conv[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, rows in by_conv.items():
        rows.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        assert got[conv].n_turns == len(rows)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss)
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for w in windows.collect():
        shown = parse_window(w.text)
        assert w.tokens == sum(turn_tokens(*t) for t in shown)
        opening = w.n_repeated == 0 and shown[0][0] == "system"  # the system turn, new here, and one more
        assert w.tokens <= budget or w.n_new <= 1 + opening
        if by_conv[w.conv_id][0][1] == "system":
            assert shown[0] == by_conv[w.conv_id][0][1:]
        assert w.n_repeated <= 3
    assert sum(r.formatted_chars for r in got.values()) == sum(len(w.text) for w in windows.collect())


def test_chat_empty(spark):
    from stratum.llm.chat import escape, format_conversations, unescape, window_digests

    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string, window long")
    assert window_digests(format_conversations(table)).count() == 0
    for text in ("<s>", r"<\s>", r"<\\/s>", "[INST][/INST]", "[\\[INST]", "<<s>>"):
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]"))


# 2 quality ------------------------------------------------------------------------------------


def base_counts(text: str | None) -> tuple:
    w = (text or "").encode().split()
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    count = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, t in enumerate(zip(w, w[1:], w[2:])) if count[t] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(len(x.decode()) for x in w), symbols, dup, len(covered)


def test_quality_counts_and_verdicts(spark, docs, nothing):
    from stratum.llm.quality import COUNTS, quality_verdicts

    junk = [(1000 + i, " ".join(w + "%%$#" for w in prose(i, 80).split()), "en", "s", 1) for i in range(40)]
    good = [(2000 + i, article(300 + i, 80 + i), "en", "s", 1) for i in range(300)]
    rows = docs.select(*nothing.columns).union(spark.createDataFrame(junk + good, DOCS))
    marked = [(r[0], 0) for r in junk[::2]] + [(r[0], 1) for r in good[::2]] + [(None, 1), (2000, None), (1000, 1)]
    labels = spark.createDataFrame(marked, "doc_id long, quality int")
    got = quality_verdicts(rows, labels).collect()
    assert len(got) == rows.count()
    texts = {r.doc_id: r.text for r in rows.collect()}
    for r in got:
        assert tuple(r[c] for c in COUNTS) == base_counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert not (r.base_failed and r.kept)
    assert not any(r.kept for r in got if 1000 <= (r.doc_id or 0) < 2000)
    assert sum(r.kept for r in got if (r.doc_id or 0) >= 2000) >= 297
    unlabelled = quality_verdicts(rows, labels.filter("false")).collect()
    assert all(r.kept != r.base_failed for r in unlabelled)
    assert quality_verdicts(nothing, labels).count() == 0


def test_quality_forest_sees_every_statistic(spark):
    """Junk that only its lines, words, marks or digits give away, half of it labelled."""
    from stratum.llm.quality import quality_verdicts

    def lines(text: str, n: int = 12) -> str:
        w = text.split()
        return "\n".join(" ".join(w[i : i + n]) for i in range(0, len(w), n))

    def junk(i: int) -> dict[str, str]:
        once = article(7000 + i, 8)
        return {
            "lines": lines(article(3000 + i, 240)) + f"\n{once}" * 20,
            "long": lines(" ".join("".join(article(4000 + i, 800).split()[k : k + 8]) for k in range(0, 800, 8))),
            "bare": lines(prose(5000 + i, 300)),
            "digits": lines(" ".join(w if k % 2 else str(k * 977) for k, w in enumerate(article(6000 + i, 200).split()))),
        }

    rows = [(i, lines(article(i, 80 + 2 * i))) for i in range(300)]
    for i in range(20):
        rows += [(1000 + 100 * k + i, text) for k, text in enumerate(junk(i).values())]
    labels = [(i, int(i < 1000)) for i, _ in rows if i % 2]
    got = quality_verdicts(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    ).collect()
    assert not any(r.base_failed for r in got)
    assert sum(r.kept for r in got if r.doc_id < 1000) >= 297
    assert [r.doc_id for r in got if r.doc_id >= 1000 and r.kept] == []


def test_isolation_forest_isolates_beyond_its_rows():
    """In a feature that all grown rows have alike, and farther out than any of them."""
    from stratum.llm.quality import IsolationForest

    rows = np.column_stack([np.random.default_rng(1).normal(size=(500, 2)), np.zeros(500)])
    forest = IsolationForest.grow(rows, trees=100, sample=128)
    inner, outer = forest.score(rows), forest.score(np.array([[0.0, 0.0, 0.3], [0.0, 9.0, 0.0]]))
    assert outer.min() > np.quantile(inner, 0.9)


def test_isolation_forest_prefers_outliers():
    from stratum.llm.quality import IsolationForest

    rng = np.random.default_rng(0)
    rows = rng.normal(size=(500, 2))
    forest = IsolationForest.grow(rows, trees=50, sample=128)
    inner, outer = forest.score(rows), forest.score(np.array([[6.0, 6.0], [-7.0, 0.0]]))
    assert outer.min() > np.quantile(inner, 0.99)


# 3 n-gram join --------------------------------------------------------------------------------


def shingle_set(text: str | None, n: int) -> frozenset:
    w = words(text)
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def components_of(sets: list[frozenset], ids: list, out_of: int, of: int) -> list:
    group = list(range(len(sets)))

    def find(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if o and out_of * o >= of * len(a | sets[j]):
                group[find(i)] = find(j)
    return [
        min((ids[j] for j in range(len(sets)) if find(j) == find(i) and ids[j] is not None), default=None)
        if sets[i]
        else ids[i]
        for i in range(len(sets))
    ]


def near_copies(seed: int) -> list[tuple]:
    """Clusters around the threshold: each copy changes some words of the original."""
    pick, rows = random.Random(seed), []
    for c in range(5):
        original = prose(seed * 100 + c, pick.choice([4, 9, 30, 120, 400])).split()
        for _ in range(12):
            copy = list(original)
            for _ in range(pick.randrange(0, 1 + len(copy) // 40 + 2)):
                copy[pick.randrange(len(copy))] = pick.choice(WORDS)
            rows.append((len(rows), " ".join(copy), "en", "s", 1))
    return rows


@pytest.mark.parametrize(("n", "of"), [(3, 90), (5, 80)])
def test_ngram_components(spark, n, of):
    from stratum.llm.ngram_join import Threshold, ngram_components

    rows = [r for r in corpus()] + [(100 + r[0], *r[1:]) for r in near_copies(n)]
    got = ngram_components(spark.createDataFrame(rows, DOCS), n=n, threshold=Threshold(of, 100), block=8)
    sets, ids = [shingle_set(r[1], n) for r in rows], [r[0] for r in rows]
    expected = Counter(zip(ids, map(len, sets), components_of(sets, ids, 100, of)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == expected


def test_ngram_tiles_guarantee():
    """Linked sets of any size share a tile."""
    from stratum.llm.ngram_join import Threshold, tile_keys

    rng = np.random.default_rng(3)
    for t in (Threshold(90, 100), Threshold(80, 100)):
        for size in [*range(1, 40), 97, 333, 1500]:
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) << np.uint64(1))
            swap = len(a) * (t.out_of - t.of) // (t.out_of + t.of)
            b = np.unique(np.concatenate([a[swap:], rng.integers(0, 1 << 63, swap, dtype=np.uint64)]))
            fewer = np.sort(rng.permutation(a)[: -(-len(a) * t.of // t.out_of)])
            for other in (b, fewer):
                overlap = len(np.intersect1d(a, other))
                if t.holds(overlap, len(a) + len(other)):
                    assert np.intersect1d(tile_keys(a, t), tile_keys(other, t)).size


def test_bitmap_bound_is_one():
    from stratum.llm.ngram_join import bitmap, folded, overlap_bound

    rng = np.random.default_rng(5)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 250))) for _ in range(2))
        size = min(len(bitmap(a)), len(bitmap(b)))
        bound = overlap_bound(folded(bitmap(a), size), folded(bitmap(b), size), len(a), len(b))
        assert len(np.intersect1d(a, b)) <= bound


def test_ngram_empty(nothing):
    from stratum.llm.ngram_join import ngram_components

    assert ngram_components(nothing).count() == 0


def test_components_of_a_path(spark):
    from stratum.llm.components import connected_components

    pairs = [(i, i + 1) for i in range(40)] + [(100, 100), (60, 50), (50, 60), (None, 3), (7, None), (200, 60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 60: 50, 200: 50}


def tables_written(monkeypatch, *modules) -> list[str]:
    """Labels of the tables that the modules store from now on."""
    labels = []
    for module in modules:
        keep = module.stored
        monkeypatch.setattr(module, "stored", lambda df, label, keep=keep: labels.append(label) or keep(df, label))
    return labels


def test_components_of_stars_take_no_round(spark, monkeypatch):
    from stratum.llm import components

    labels = tables_written(monkeypatch, components)
    pairs = [(i, 100 * (i % 3) - 200) for i in range(1, 30)]
    got = components.connected_components(spark.createDataFrame(pairs, "u long, v long"))
    assert {(r.node, r.component) for r in got.collect()} == {*pairs}
    assert labels == ["cc-edges", "cc-least"]


def test_merged_components(spark, monkeypatch):
    from stratum.llm import components

    pick = random.Random(4)
    parts = [[(pick.randrange(60), pick.randrange(60)) for _ in range(18)] for _ in range(3)]
    frames = [spark.createDataFrame(part, "u long, v long") for part in parts]
    known = components.merged_components(components.merged_components(None, frames[0]), frames[1])
    whole = components.connected_components(frames[0].union(frames[1]))
    assert Counter(map(tuple, known.collect())) == Counter(map(tuple, whole.collect()))
    labels = tables_written(monkeypatch, components)
    assert components.merged_components(known, frames[2].filter("u < 0")) is known and not labels
    known = components.merged_components(known, frames[2])
    whole = components.connected_components(frames[0].union(frames[1]).union(frames[2]))
    assert Counter(map(tuple, known.collect())) == Counter(map(tuple, whole.collect()))


def test_ngram_rounds_end_with_the_links(spark, monkeypatch):
    """No component is looked for where no link was found, and no round is for tiles that are done."""
    from stratum.llm import components, ngram_join

    rows = [r for r in corpus()] + [(100 + r[0], *r[1:]) for r in near_copies(3)]
    docs, labels = spark.createDataFrame(rows, DOCS), tables_written(monkeypatch, components, ngram_join)

    def run(**options):
        labels.clear()
        got = Counter(map(tuple, ngram_join.ngram_components(docs, **options).select("doc_id", "component_id").collect()))
        return got, Counter(labels)

    few, written = run(nearest_rounds=5, slices=1)
    assert 0 < written["ngram-near"] < 5
    many, written = run(nearest_rounds=0)
    assert not written["ngram-near"] and many == few


# 4 language -----------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    from stratum.llm.langid import UNDETERMINED, identify_languages

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "12 %", None), (None, "le la", "fr")], "doc_id long, text string, lang string")
    got = identify_languages(docs.union(odd), per_language=60, epochs=2)
    rows = {r.doc_id: r for r in got.collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in truth)
    assert sum(rows[i].lang_pred == truth[i] for i in held) >= 0.97 * len(held)
    assert rows[-1].lang_pred == rows[-2].lang_pred == UNDETERMINED
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_without_labels(nothing, docs):
    from stratum.llm.langid import identify_languages

    assert identify_languages(nothing).count() == 0
    got = identify_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in got.collect()} == {"und"}


# 5 Katz ---------------------------------------------------------------------------------------


def discounts(types: list[int]) -> list[float]:
    if min(types) > 0:
        rest = 6 * types[5] / types[0]
        if rest != 1:
            f = [((r + 1) * types[r] / types[r - 1] / r - rest) / (1 - rest) for r in range(1, 6)]
            if all(0 < x < 1 for x in f):
                return f
    return [1 - 0.5 / r for r in range(1, 6)]


def test_katz_scores(spark, docs, nothing, monkeypatch):
    from stratum.llm import katz
    from stratum.llm.langid import id_remainder

    monkeypatch.setattr(katz, "BUCKET_TOKENS", 900)  # several buckets, and contexts spread over them
    got = {r.doc_id: r for r in katz.katz_scores(docs, id_remainder(docs, 5) == 1).collect()}
    rows = [(r[0], [*words(r[1]), None]) for r in corpus()]
    out = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    uni, bi = Counter(), defaultdict(Counter)
    for (_, tokens), held in zip(rows, out):
        if not held:
            uni.update(tokens)
            for a, b in zip(["start", *tokens], tokens):
                bi[a][b] += 1
    n = sum(uni.values())
    by = Counter(uni.values())
    du = discounts([by[r] for r in range(1, 7)])
    by2 = Counter(c for f in bi.values() for c in f.values())
    db = discounts([by2[r] for r in range(1, 7)])
    cut = lambda d, c: d[c - 1] if c <= 5 else 1.0
    freed = sum(by[r] * r * (1 - du[r - 1]) for r in range(1, 6))
    unknown, whole = (freed / n, n) if freed else (1 / (n + 1), n + 1)
    lower = lambda w: cut(du, uni[w]) * uni[w] / whole if uni[w] else unknown

    def p(a, w):
        if a not in bi:
            return lower(w)
        f = bi[a]
        total, left = sum(f.values()), sum(c * (1 - cut(db, c)) for c in f.values())
        total, left = (total, left) if left else (total + 1, 1)
        if f[w]:
            return cut(db, f[w]) * f[w] / total
        return left / total / (1 - sum(map(lower, (x for x in f if f[x])))) * lower(w)

    for a in list(bi)[:20]:
        assert math.isclose(sum(p(a, w) for w in uni) + p(a, b"\0"), 1, rel_tol=1e-9)
    for (d, tokens), held in zip(rows, out):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held, len(tokens), n)
        assert r.n_known == sum(uni[w] > 0 for w in tokens)
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (len([x for x in uni if uni[x]]) + 1))) for w in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        want = sum(math.log10(p(a, w)) for a, w in zip(["start", *tokens], tokens))
        assert math.isclose(r.score, want, rel_tol=1e-9, abs_tol=1e-9)
    assert katz.katz_scores(nothing, F.lit(False)).count() == 0
    unlearned = katz.katz_scores(docs, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in unlearned} == {(0, 0)}


# 6 decontamination ----------------------------------------------------------------------------


def test_decontamination(spark, docs, nothing):
    from stratum.llm.decontam import contamination_report, without_contaminated

    items = [(i, prose(500 + i, 20 + 4 * i)) for i in range(6)] + [(6, "tiny item"), (7, ""), (8, None), (0, prose(500, 20))]
    leaks = [
        (1000, f"{prose(1, 30)} {items[2][1]} {prose(2, 30)}"),
        (1001, items[3][1].upper().replace(" ", ", ")),
        (1002, items[4][1].rsplit(" ", 2)[0]),
        (1003, f"{prose(3, 9)} tiny item"),
        (1004, f"{prose(5, 9)} {items[5][1][: len(items[5][1]) // 2]}"),
        (1000, f"{prose(1, 30)} {items[2][1]} {prose(2, 30)}"),
    ]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(leaks, "doc_id long, text string"))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in contamination_report(rows, table).collect())
    assert got == Counter({(1000, 2): 2, (1001, 3): 1, (1002, 4): 1, (1003, 6): 1})
    left = without_contaminated(rows, table)
    assert left.count() == rows.count() - 5 and left.columns == rows.columns
    assert contamination_report(nothing, table).count() == 0
    assert without_contaminated(rows, table.filter("false")).count() == rows.count()


def test_fingerprint_blocks_guarantee(spark):
    """Fingerprints within the radius agree on a block."""
    from stratum.llm.decontam import fingerprint_blocks

    pick, radius = random.Random(8), 23
    rows = []
    for _ in range(60):
        a = pick.getrandbits(64)
        b = a
        for bit in pick.sample(range(64), radius):
            b ^= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    blocks = F.size(F.array_intersect(fingerprint_blocks(F.col("a"), radius), fingerprint_blocks(F.col("b"), radius)))
    table = spark.createDataFrame(rows, "a long, b long").select(blocks.alias("n"), F.bit_count(F.expr("a ^ b")).alias("d"))
    assert all(r.n >= 1 and r.d == radius for r in table.collect())


# 7 suffix-array dedup -------------------------------------------------------------------------


def removed(rows: list[tuple], length: int) -> list[tuple]:
    first: dict[bytes, int] = {}
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    for d, b in texts:
        if d is not None:
            for i in range(len(b) - length + 1):
                s = b[i : i + length]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        if d is not None:
            for i in range(len(b) - length + 1):
                if first[b[i : i + length]] < d:
                    gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("frequent", [4096, 3])
def test_suffix_dedup(spark, monkeypatch, frequent):
    from stratum.llm import suffix_dedup as s

    monkeypatch.setattr(s.repeated_spans, "__defaults__", (50, frequent))
    rows = [r for r in corpus() if len(r[1] or "") < 8000] + [(200 + r[0], *r[1:]) for r in near_copies(2)]
    rows += [(300, "x" * 49, None, None, 0), (301, "x" * 49, None, None, 0), (302, "x" * 50, None, None, 0)]
    rows += [(303, "y" + "x" * 60 + "z" * 70, None, None, 0), (304, "\0" * 80, None, None, 0), (305, "\0" * 60, None, None, 0)]
    got = s.suffix_dedup(spark.createDataFrame(rows, DOCS).repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter(removed(rows, 50))


@pytest.mark.parametrize("frequent", [4096, 5, 1])
def test_suffix_runs_of_frequent_anchors(spark, frequent):
    """A long passage, cut and edited differently in each document, loses the same bytes however frequent its grams."""
    from stratum.llm.suffix_dedup import repeated_spans

    pick = random.Random(7)
    passage, rows = "".join(pick.choices("abcdefgh", k=900)), []
    for i in range(30):
        around = ["".join(pick.choices("abcdefgh", k=pick.randrange(150))) for _ in range(2)]
        part = passage[pick.randrange(200) : pick.randrange(500, 900)]
        part = part if i % 3 else part[:150] + "!" + part[151:]
        rows.append((i, around[0] + part + around[1]))
    got = [np.zeros(len(text), bool) for _, text in rows]
    for row in repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), 50, frequent).collect():
        for span in row.spans:
            got[row.doc_id][span.start : span.stop] = True
    earlier: set[str] = set()
    for i, text in rows:
        windows = [text[k : k + 50] for k in range(len(text) - 49)]
        want = np.zeros(len(text), bool)
        for k, window in enumerate(windows):
            want[k : k + 50] |= window in earlier
        assert (got[i] == want).all()
        earlier.update(windows)


def test_suffix_dedup_text(spark, nothing):
    from stratum.llm.suffix_dedup import suffix_dedup, without_repeats

    shared = "é" * 40
    rows = [(1, f"a{shared}b", "en", "s", 1), (2, f"c{shared}d", "en", "s", 1), (3, None, None, None, None)]
    left = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert left[1].text == f"a{shared}b" and left[2].text == "cd" and left[2].lang == "en" and left[3].text is None
    assert suffix_dedup(nothing).count() == 0


def test_long_text_in_pieces(monkeypatch):
    """Anchors do not depend on where a long text is cut."""
    from stratum.llm import suffix_dedup as s

    text = prose(1, 3000).encode()
    whole = [(int(h), int(at + shift)) for _, _, hs, ats, _, _, shifts in s.anchors([text], 50) for h, at, shift in zip(hs, ats, shifts)]
    monkeypatch.setattr(s, "BUFFER", 1 << 10)
    cut = {(int(h), int(at + shift)) for _, _, hs, ats, _, _, shifts in s.anchors([text], 50) for h, at, shift in zip(hs, ats, shifts)}
    assert cut >= set(whole)


# 8 urls ---------------------------------------------------------------------------------------


def test_url_filter_aliases(spark):
    from stratum.llm.url_filter import Rule, filter_urls

    rules = [Rule("bad.com", "/", "block"), Rule("bad.com", "/ok/", "allow"), Rule("good.com", "/", "allow")]
    canonical = '<html><LINK href="{}" rel="canonical"></html>'
    refresh = "<meta http-equiv='refresh' content='0; URL={}'>"
    pages = [
        (1, "http://a.net/x", canonical.format("http://bad.com/y")),  # alias of a blocked url
        (2, "http://b.net/x#top", refresh.format("http://a.net/x")),  # by two steps
        (3, "http://c.net/", canonical.format("/z")),
        (4, "http://c.net/z", canonical.format("https://sub.bad.com/")),
        (5, "http://d.net/", canonical.format("http://bad.com/ok/1")),  # allowed alias
        (6, "http://e.net/", canonical.format("http://bad.com/w")),
        (7, "http://e.net/f", canonical.format("http://e.net/")),
        (8, "http://GOOD.com/q?x", canonical.format("http://e.net/")),  # an allow beats the block of 6 and 7
        (9, "http://notbad.com/y", None),
        (10, None, canonical.format("http://bad.com/y")),
        (11, "no scheme", "x"),
        (12, "http://BAD.com/ok/1?y#z", ""),
        (12, "http://BAD.com/ok/1?y#z", ""),
        (13, "http://g.net/1", "x"),
    ]
    table = spark.createDataFrame([(*p, "r") for p in pages], "page_id long, url string, html string, rule string")
    moved = spark.createDataFrame([("http://g.net/1", "http://b.net/x")], "src string, dst string")
    got = filter_urls(table, rules, redirects=moved).collect()
    verdict = {r.page_id: r.verdict for r in got}
    assert len(got) == len(pages)
    assert {i for i, v in verdict.items() if v == "block"} == {1, 2, 3, 4, 13}
    by_id = {r.page_id: r for r in got}
    assert (by_id[10].host, by_id[10].path, by_id[10].rule) == ("", "", None)
    assert (by_id[12].host, by_id[12].path, by_id[12].rule) == ("bad.com", "/ok/1", "bad.com/ok/")
    assert filter_urls(table.filter("false"), rules).count() == 0
    assert {r.verdict for r in filter_urls(table, []).collect()} == {"allow"}


def test_url_links_of_all_tags(spark):
    from pyspark.sql import functions as F

    from stratum.llm.url_filter import page_links, url_key

    url = "http://A.net/d/p?x=1"
    cases = [
        ("<link rel=canonical href=/one><LINK REL='nofollow Canonical' HREF='two'>", ["http://a.net/one", "http://a.net/d/two"]),
        ('<link data-href="/no" title="href=/no rel=canonical" rel="canonical" href=" /q?a=1&amp;b=2 ">', ["http://a.net/q?a=1&b=2"]),
        ("<link rel=canonical href='/&amp;lt;&#47;&#x2F;&#xe9;&#128512;&#0;&bad;'>", ["http://a.net/&lt;//\u00e9\U0001f600\ufffd&bad;"]),
        ("<link rel=canonical href='../../../g/./h/..'>", ["http://a.net/g/"]),
        ("<link rel=canonical href='?to=http://b.net/'>", ["http://a.net/d/p?to=http://b.net/"]),
        ("<link rel=canonical href='go?to=http://b.net/#f'>", ["http://a.net/d/go?to=http://b.net/"]),
        ("<link rel=canonical href='//B.net'><link rel=canonical href='HTTPS://b.net/x#y'>", ["http://b.net/", "https://b.net/x"]),
        ("<link rel=canonical href='mailto:a@b'><link rel=canonical href='#f'><link rel=canonical href=''>", []),
        ("<base target=x><base href='//c.net/e/f'><link rel=canonical href='g'>", ["http://c.net/e/g"]),
        ("<!-- <link rel=canonical href=/no> --><link rel=alternate href=/no><link rel=canonical>", []),
        ("<meta http-equiv=Refresh content=\"3;URL='/r1'\"><meta http-equiv=refresh content='0, /r2'>", ["http://a.net/r1", "http://a.net/r2"]),
        ("<meta http-equiv=refresh content=30><meta name=refresh content='0;url=/no'>", []),
        ("<!-- <link rel=canonical href=/no>", []),
        ("<link rel=canonical href=/cut", []),
        ("<link rel=canonical href='/" + "a/../" * 3000 + "z'>" + "<meta x" * 20000, ["http://a.net/z"]),
    ]
    rows = [(f"{url}#{i}", html, str(i)) for i, (html, _) in enumerate(cases)] + [(None, cases[0][0], "null"), (url, None, "none")]
    pages = spark.createDataFrame(rows, "url string, html string, base string")
    found = {i: [] for i in range(len(cases))}
    for src, key in page_links(pages).select("src", url_key(F.col("dst"))).collect():
        if src is not None and key is not None:
            found[int(src.rsplit("#", 1)[1])].append(key)
    assert {i: sorted(keys) for i, keys in found.items()} == {i: sorted(want) for i, (_, want) in enumerate(cases)}


def test_url_resolution_like_the_standard(spark):
    from urllib.parse import urljoin

    from pyspark.sql import functions as F

    from stratum.llm.url_filter import resolve, url_key

    base = "http://a/b/c/d;p?q"
    links = "g ./g g/ /g //g ?y g?y ;x g;x g;x?y . ./ .. ../ ../g ../.. ../../ ../../g ../../../g ../../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h g;x=1/./y g;x=1/../y g?y/./x g?y/../x".split()
    table = spark.createDataFrame([(x,) for x in links], "link string")
    got = table.select("link", url_key(resolve(F.col("link"), F.lit(base))).alias("key")).collect()
    want = {x: urljoin(base, x) for x in links} | {"//g": "http://g/"}
    assert {r.link: r.key for r in got} == want


# 9 licenses -----------------------------------------------------------------------------------


def test_license_scan(spark):
    from stratum.llm.licenses import scan_licenses

    rows = [
        (1, "r/LICENSE", "Released under the MIT License."),
        (2, "r/a.py", f"{prose(1, 50)}\nLicensed under the Apache License, Version 2.0.\n{prose(2, 50)}"),
        (3, "r/s/b.py", prose(3, 30)),
        (4, "r/t/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."),
        (5, "r/t/u/c.py", ""),
        (6, "q/d.py", prose(4, 30)),
        (7, None, None),
        (8, "r/s/b.py", prose(3, 30)),
        (9, "r/t/COPYING", "Licensed under CC BY-NC 4.0."),
        (10, "e.py", "They licensed the song under a stage name."),
    ]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    declared = {i: r.declared for i, r in got.items() if r.declared}
    assert declared == {1: "MIT", 2: "Apache-2.0", 4: "GPL-3.0", 9: "CC-BY-NC-4.0"}
    assert {i: (r.license, r.inherited_from) for i, r in got.items() if not r.declared} == {
        3: ("MIT", "r"), 8: ("MIT", "r"), 5: ("CC-BY-NC-4.0", "r/t"), 6: (None, None), 7: (None, None), 10: (None, None),
    }
    empty = spark.createDataFrame([], "doc_id long, path string, text string")
    assert scan_licenses(empty).count() == 0


def boxed(text: str, mark: str, width: int = 50) -> str:
    """A source file that begins with ``text``, wrapped and commented."""
    code = "\n".join(f"{prose(i, 6)} = {prose(90 + i, 4)}" for i in range(40))
    return "\n".join(f"{mark} {line}" for line in ["Copyright (C) 2020 A. Person", "", *textwrap.wrap(text, width)]) + "\n" + code


def test_license_wrapped_notices_and_texts(spark):
    """Notices in the way they stand in files, and license files, for all templates."""
    from stratum.llm.licenses import TEMPLATES, TEXTS, scan_licenses

    want, rows = {}, []
    for named, folder in ((TEMPLATES, "f"), (TEXTS, "t")):
        for name, texts in named.items():
            for text in texts:
                for mark in ("#", " *", "//", "dnl"):
                    want[len(rows)] = name
                    rows.append((len(rows), f"{folder}/{len(rows)}", boxed(text, mark)))
    mit, bsd = TEXTS["MIT"][0], TEXTS["BSD-3-Clause"][0].replace("the copyright holder nor", "Some Company, Inc. nor")
    disclaimer = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.'
    more = [
        ("MIT", "m/LICENSE", "The MIT License (MIT)\n\nCopyright (c) 2020 A. Person\n\n" + textwrap.fill(f"{mit} {disclaimer}", 70)),
        ("BSD-3-Clause", "b/LICENSE", "Copyright (c) 2020\n\n" + textwrap.fill(bsd, 70).replace("1. ", "* ").replace("2. ", "* ")),
        (None, "x", f"{prose(1, 90)} the album was released under the same license as {prose(2, 90)}"),
        (None, "y", boxed(TEMPLATES["GPL-3.0"][1].replace("version 3", "version 1"), "#")),
    ]
    for name, path, text in more:
        want[len(rows)] = name
        rows.append((len(rows), path, text))
    rows += [(len(rows), "m/a.c", prose(3, 40)), (len(rows) + 1, "b/s/a.c", prose(4, 40))]
    table = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: r for r in scan_licenses(table).collect()}
    assert {i: got[i].declared for i in want} == want
    assert [(got[i].license, got[i].inherited_from) for i in range(len(want), len(rows))] == [("MIT", "m"), ("BSD-3-Clause", "b")]


# 10 packing -----------------------------------------------------------------------------------


def test_packing_round_trip(docs, nothing):
    import public_tokenizers
    from stratum.llm.packing import best_fit_decreasing, pack, piece_checksums
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer = Tokenizer.from_file(path)
    pieces = pack(docs, path, size=256, pool=7)
    rows, by_window, by_doc = pieces.collect(), defaultdict(list), defaultdict(list)
    for r in rows:
        by_window[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
        assert r.length == len(r.ids)
    for parts in by_window.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    for doc, text, *_ in corpus():
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        got = sorted(by_doc[doc], key=lambda r: r.start)
        copies = sum(r[0] == doc for r in corpus())
        assert [i for r in got[::copies] for i in r.ids] == want
        assert {r.doc_tokens for r in got} == {len(want)}
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in piece_checksums(pieces).collect()}
    assert all(sums[r.doc_id, r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    direct = pack(docs, path, size=256, pool=7, checksums=True)
    assert Counter(map(tuple, direct.collect())) == Counter(map(tuple, piece_checksums(pieces).select(*direct.columns).collect()))
    assert pack(nothing, path).count() == pack(nothing, path, checksums=True).count() == 0

    pick = random.Random(4)
    lengths = [pick.randrange(1, 65) for _ in range(400)]
    open_: list[int] = []
    for i in sorted(range(400), key=lambda i: (-lengths[i], i)):
        fits = [w for w in range(len(open_)) if open_[w] >= lengths[i]]
        if fits:
            open_[min(fits, key=lambda w: open_[w])] -= lengths[i]
        else:
            open_.append(64 - lengths[i])
    assert 1 + max(w for w, _ in best_fit_decreasing(lengths, 64)) == len(open_)


# pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages(spark, nothing):
    import corpus_pipeline as p

    junk = [(i, " ".join(w + "%%$#" for w in prose(i, 80).split()), "en", "s", 1) for i in range(20)]
    good = [(100 + i, article(300 + i, 80 + i), "en", "s", 1) for i in range(120)]
    item = prose(777, 30)
    passage = prose(888, 30)
    extra = [
        (400, good[4][1] + " more", "en", "s", 1),  # near copy of 104
        (401, f"{prose(41, 60)} {item} {prose(42, 40)}", "en", "s", 1),  # leak
        (402, f"{prose(43, 70)} {passage} {prose(44, 40)}", "en", "s", 1),
        (403, f"{prose(45, 70)} {passage} {prose(46, 40)}", "en", "s", 1),  # passage of 402
        (404, None, "en", "s", 0),
    ]
    folder = __import__("tempfile").mkdtemp()
    spark.createDataFrame([(item,)], "text string").selectExpr("1L AS item_id", "text").write.parquet(f"{folder}/benchmark.parquet")
    marks = [(r[0], int(r in good)) for r in junk + good]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    kept = spark.createDataFrame(junk + good + extra, DOCS)
    ids = []
    for _, stage in p.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == nothing.columns
        ids.append({r.doc_id for r in kept.select("doc_id").collect()})
    assert not ids[0] & {r[0] for r in junk} and 404 not in ids[0] and {401, 402, 403} < ids[0]
    assert len(ids[0] & {r[0] for r in good}) >= 118
    assert ids[0] - ids[1] == {400} & ids[0]
    assert ids[1] == ids[2] and ids[2] - ids[3] == {401}
    text = {r.doc_id: r.text for r in kept.collect()}
    assert passage in text[402] and passage[20:-20] not in text[403]
    packed = p.packing(spark, kept, folder)
    assert {r.doc_id for r in packed.collect()} == ids[3]
    for _, stage in p.STAGES:
        assert stage(spark, nothing, folder).count() == 0


def test_pipeline_keeps_texts_of_null_and_reused_ids(spark, tmp_path):
    """Each stage decides on rows, not on ids."""
    import corpus_pipeline as p

    texts = [article(9000 + i, 90 + i) for i in range(12)]
    item, junk = prose(777, 30), " ".join(w + "%%$#" for w in prose(778, 80).split())
    shared = prose(888, 30)
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:8]] + [(8, texts[8])]
    rows += [(None, junk), (7, junk), (None, "few words"), (7, "few words")]
    copies = [(None, texts[4]), (9, texts[0] + " more"), (9, texts[9]), (8, texts[8] + " more"), (None, None), (7, "")]
    tables = {"benchmark": ([(1, item)], "item_id long, text string"), "labels": ([(7, 1)], "doc_id long, quality int")}
    for name, (given, schema) in tables.items():
        spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    def after(stage, given: list[tuple]) -> Counter:
        docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in given], DOCS)
        return Counter((r.doc_id, r.text) for r in stage(spark, docs, str(tmp_path)).collect())

    # without labels of both classes the base rules alone: 50 words
    got = after(p.quality_rules, rows + copies)
    assert got == Counter((i, t) for i, t in rows + copies if len((t or "").split()) >= 50)
    # of the copies of a text the least id stays, null last; of the wordless rows (7, "")
    got = after(p.near_duplicates, rows[:9] + copies)
    pair = {(8, texts[8]), (8, texts[8] + " more")}
    assert len(got.keys() & pair) == 1 and max(got.values()) == 1
    assert got.keys() - pair == {*rows[1:8], (9, texts[0] + " more"), (9, texts[9]), (7, "")}
    leaks = [(None, f"{texts[10]} {item}"), (7, f"{texts[11]} {item}")]
    assert after(p.benchmark_leaks, rows[:9] + leaks) == Counter(rows[:9])
    passages = [(7, f"{texts[10]}{shared}"), (None, f"{texts[11]}{shared}"), (9, f"{texts[9]}{shared}")]
    got = after(p.repeated_passages, rows[:9] + passages)
    assert got == Counter([*rows[:9], *passages[:2], (9, texts[9])])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows[:9]], DOCS)
    assert Counter(r.doc_id for r in p.packing(spark, docs, "").filter("start = 0").collect()) == {None: 4, 7: 4, 8: 1}
