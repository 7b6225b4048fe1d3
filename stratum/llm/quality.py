"""Quality rules scored by an isolation forest.

Rule statistics of a text (shares of symbols, capitals, marks, digits, repeated
words and lines, word length, words) span the feature space.  The forest is
grown on a bounded sample of documents labelled good; a document that random
splits separate after few steps is unlike them.  The cut-off is read from the scores of all labelled
documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.llm.common import stored

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LONGS = [*COUNTS, "n_lines"]
SHARES = ["symbols", "capitals", "punctuation", "digits"]
STATISTICS = "doc_id long, " + ", ".join(f"{c} long" for c in LONGS) + ", " + ", ".join(f"{c} double" for c in SHARES)
INPUTS = [*SHARES, "n_dup_lines", "n_repeat_words", "word_chars", "n_words", "n_lines"]

_code = np.arange(256)
_white = np.isin(_code, [0x20, *range(0x09, 0x0E)])
_later = (_code & 0xC0) == 0x80  # UTF-8 bytes that don't begin a character
_symbol = np.isin(_code, list(b"#*$%&|<>"))
_capital = (_code >= 0x41) & (_code <= 0x5A)
_digit = (_code >= 0x30) & (_code <= 0x39)
_letter = _capital | ((_code >= 0x61) & (_code <= 0x7A))
_mark = (_code > 0x20) & (_code < 0x7F) & ~_digit & ~_letter


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text has at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered = np.zeros(len(words) + 3, np.int64)
    at = np.array([i for i, w in enumerate(windows) if count[w] > 1])
    np.add.at(covered, at, 1)
    np.add.at(covered, at + 3, -1)
    return int((np.cumsum(covered)[: len(words)] > 0).sum())


def rule_statistics(text: str | None) -> list[float]:
    """The counts and shares of one text; a null text is empty."""
    raw = (text or "").encode()
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    word_chars = int(by_byte[~_later & ~_white].sum())
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    dup_lines = len(lines) - len(set(lines))
    n_repeat = repeated_words(words)
    chars = max(word_chars, 1)
    symbols = int(by_byte[_symbol].sum())
    return [
        len(words),
        word_chars,
        symbols,
        dup_lines,
        n_repeat,
        len(lines),
        symbols / chars,
        by_byte[_capital].sum() / chars,
        by_byte[_mark].sum() / chars,
        by_byte[_digit].sum() / chars,
    ]


def document_statistics(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """One row of rule statistics per document, and ``carry``, in one pass over the texts."""
    n = len(LONGS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([rule_statistics(t.as_py()) for t in batch.column(1)]).reshape(-1, n + len(SHARES))
            columns = [pa.array(rows[:, i].astype(np.int64)) for i in range(n)]
            columns += [pa.array(rows[:, i]) for i in range(n, rows.shape[1])]
            columns = [batch.column(0), *columns, *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *LONGS, *SHARES, *carry])

    own = docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")
    narrow = docs.select(*own, *(docs[c] for c in carry))
    return narrow.mapInArrow(run, StructType([*StructType.fromDDL(STATISTICS).fields, *narrow.schema.fields[2:]]))


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random tree of n rows."""
    n = np.asarray(n, float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def rule_rates(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From ``INPUTS``: the shares, duplicate lines a line, repeated words a word and
    characters a word; and the characters, lines or words that each is out of."""
    dup_lines, n_repeat, word_chars, n_words, n_lines = rows[:, len(SHARES) :].T
    chars, words, lines = (np.maximum(n, 1) for n in (word_chars, n_words, n_lines))
    rates = np.column_stack([rows[:, : len(SHARES)], dup_lines / lines, n_repeat / words, word_chars / words])
    return rates, np.column_stack([chars] * len(SHARES) + [lines, words, words])


# what each rate is pulled by (400 characters, or about as much text), and whether less than usual is unusual too
PULL = np.array([400] * len(SHARES) + [4, 80, 80])
TWO_SIDED = np.array([False, True, True, False, False, False, True])


@dataclass
class RuleFeatures:
    """Forest features: the rates, pulled towards the typical rate as if by ``PULL``
    more text (short texts have noisy rates), and the logarithm of the words.
    Symbols, digits and repeats are never below the typical rate (fewer than
    usual are no fault); capitals, marks and word length can be."""

    typical: np.ndarray

    @classmethod
    def fit(cls, rows: np.ndarray) -> RuleFeatures:
        return cls(np.median(rule_rates(rows)[0], axis=0))

    def of(self, rows: np.ndarray) -> np.ndarray:
        rates, size = rule_rates(rows)
        pulled = (rates * size + PULL * self.typical) / (size + PULL)
        pulled = np.where(TWO_SIDED, pulled, np.maximum(pulled, self.typical))
        return np.column_stack([pulled, np.log1p(rows[:, INPUTS.index("n_words")])])


@dataclass
class IsolationForest:
    """Trees as arrays: feature (-1 in a leaf), split, left child, path length at a leaf.

    Splits are drawn from a node's range and ``margin`` of the whole range (at
    least ``least``) to both sides.  So a row beyond all grown ones falls into
    leaves without any, also in a feature that is the same in all grown rows.
    """

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    path: np.ndarray
    normal: float

    @classmethod
    def grow(
        cls, rows: np.ndarray, trees: int = 200, sample: int = 512, seed: int = 7, margin: float = 0.5, least: float = 0.01
    ) -> IsolationForest:
        rng = np.random.default_rng(seed)
        sample = min(sample, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
        beyond = np.maximum(margin * np.ptp(rows, axis=0), least)
        grown = []
        for _ in range(trees):
            nodes: list[list[float]] = [[-1, 0, 0, 0]]
            todo = [(0, rows[rng.choice(len(rows), sample, replace=False)], 0)]
            while todo:
                at, part, level = todo.pop()
                if level >= depth or len(part) < 2:
                    nodes[at] = [-1, 0, 0, level + float(mean_path(len(part)))]
                    continue
                f = rng.integers(rows.shape[1])
                cut = rng.uniform(part[:, f].min() - beyond[f], part[:, f].max() + beyond[f])
                goes_left = part[:, f] <= cut
                nodes[at] = [f, cut, len(nodes), 0]
                todo += [(len(nodes), part[goes_left], level + 1), (len(nodes) + 1, part[~goes_left], level + 1)]
                nodes += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
            grown.append(nodes)
        width = max(map(len, grown))
        table = np.array([nodes + [[-1, 0, 0, 0]] * (width - len(nodes)) for nodes in grown], float)
        return cls(
            table[..., 0].astype(np.int16), table[..., 1], table[..., 2].astype(np.int32), table[..., 3],
            max(float(mean_path(sample)), 1e-9),
        )

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / normal path): near 1 for rows that split off early."""
        total, each = np.zeros(len(rows)), np.arange(len(rows))
        for feature, split, left, path in zip(self.feature, self.split, self.left, self.path, strict=True):
            node = np.zeros(len(rows), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[each, np.maximum(f, 0)] > split[node]
                node = np.where(inner, left[node] + right, node)
            total += path[node]
        return 2.0 ** -(total / len(self.feature) / self.normal)


def calibrated_cut(scores: DataFrame, max_clean_loss: float, bins: int = 2000) -> float | None:
    """Least score to reject, from (score, quality) of all labelled rows.

    Rows are counted per score bin where they are; the driver sees at most
    ``bins`` rows.  Of the cuts that lose at most ``max_clean_loss`` of the
    good rows, the one that rejects the largest share of bad ones less the
    share of good ones is taken.  None if a class has no rows.
    """
    rows = (
        scores.groupBy(F.floor(F.col("score") * bins).alias("bin"))
        .agg(F.sum((F.col("quality") > 0).cast("long")).alias("good"), F.count("*").alias("n"))
        .collect()
    )
    table = pd.DataFrame([(r.bin, r.good, r.n - r.good) for r in rows], columns=["bin", "good", "bad"])
    table = table.sort_values("bin", ascending=False)
    if not len(table) or not table.good.sum() or not table.bad.sum():
        return None
    good, bad = table.good.cumsum() / table.good.sum(), table.bad.cumsum() / table.bad.sum()
    gain = (bad - good).where(good <= max_clean_loss)
    if gain.isna().all() or gain.max() <= 0:
        return None
    return float(table.bin.loc[gain.idxmax()]) / bins


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = 8192,
    trees: int = 200,
    sample: int = 512,
    max_clean_loss: float = 0.005,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rule statistics and verdict per row of ``docs``, and its ``carry`` columns.

    ``doc_id``, the counts, lines and shares, ``base_failed`` (under 50 words or over
    half of them in repeated windows), ``score`` and ``kept``.  The forest is
    fitted on at most ``fit_rows`` rows labelled good, chosen by a hash of
    their id; the cut-off comes from all labelled rows.

    A null text has no words.  Null ids and null labels are unlabelled.
    Several labels of an id count as good only if all are.  Repeated rows get
    the same verdict each.  Without labelled rows of both classes, or where no
    cut separates them, nothing is rejected beyond the base rules.  An empty
    table gives no rows; other columns are ignored.
    """
    statistics = stored(document_statistics(docs, id_col, text_col, carry), "quality-statistics")
    marks = (
        labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("quality"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    labelled = stored(statistics.join(marks, "doc_id"), "quality-labelled")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # what the base rules reject anyway says nothing about the rest
    labelled = labelled.filter(~base_failed)
    order = [F.xxhash64("doc_id"), "doc_id", *INPUTS]
    fit = labelled.filter("quality > 0").orderBy(*order).limit(fit_rows).select(*INPUTS).toPandas().to_numpy(float)
    if not len(fit):
        return statistics.withColumns({"base_failed": base_failed, "score": F.lit(0.0), "kept": ~base_failed})
    features = RuleFeatures.fit(fit)
    forest = IsolationForest.grow(features.of(fit), trees, sample)

    @F.pandas_udf("double")
    def anomaly(*columns: pd.Series) -> pd.Series:
        rows = np.column_stack([c.to_numpy(float) for c in columns])
        return pd.Series(forest.score(features.of(rows)))

    cut = calibrated_cut(labelled.select(anomaly(*INPUTS).alias("score"), "quality"), max_clean_loss)
    rejected = F.col("score") >= F.lit(2.0 if cut is None else cut)
    scored = statistics.withColumn("score", anomaly(*INPUTS))
    return scored.withColumns({"base_failed": base_failed, "kept": ~base_failed & ~rejected})
