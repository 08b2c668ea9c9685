"""Quality rules: an isolation forest over rule statistics, on top of fixed rules.

Every text gets the statistics that quality rules look at. Trees of random splits, grown on a
bounded sample of different statistics, isolate unusual documents after few splits; the mean path
length gives an anomaly score. The score above which documents go is calibrated on all labelled
rows: the lowest threshold that wrongly rejects no more than a given share of the good ones.

NULL texts count as empty. They and other texts below the fixed rules are rejected whatever the score.
Ties in the sample go by hash; repeated rows are scored alike; a document with several labels counts
as good only if all say so; without labels of both kinds nothing is rejected by the forest; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import add_to_rows, chosen_by_hash, map_rows, stored

TREES = 100
# Different rows of statistics each tree is grown on. TREES * ROWS_PER_TREE bounds what reaches the driver.
ROWS_PER_TREE = 256
# Share of good labelled documents that the threshold may reject.
FALSE_REJECTS = 0.005
# The score lies between 0 and 1; thresholds are multiples of this.
SCORE_STEP = 0.002
SEED = 42

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"!?.,;:"
_DIGITS = b"0123456789"
# Features that good documents vary in: shares of repeated lines, repeated words and digits, and the length.
_VARIED = 4

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, features array<double>"
_STATISTICS = [field.split()[0] for field in FIELDS.split(", ")]


def repeated_words(words: list) -> int:
    """Words in windows of three that occur at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    kinds = len(number)
    # pairs are numbered before the third word joins them, so that no product overflows
    _, pairs = np.unique(codes[:-1] * kinds + codes[1:], return_inverse=True)
    _, window, counts = np.unique(pairs[:-1] * kinds + codes[2:], return_inverse=True, return_counts=True)
    twice = counts[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + n] |= twice
    return int(covered.sum())


def statistics(text: str) -> tuple:
    """The values of ``FIELDS``.

    Features are the mean length of a word, the shares of symbols, capitals and marks, how
    varied the words are, the shares of repeated lines, repeated words and digits, and the length. The last four vary
    much among good documents, so that a forest sees only what goes beyond those (``ordinary``).
    """
    raw = text.encode()
    words = raw.split()
    n, kinds = len(words), len(set(words))
    word_chars = len(b"".join(words).decode())
    lines = [line for line in text.split("\n") if line.encode().split()]
    counts = [len(raw) - len(raw.translate(None, some)) for some in (_SYMBOLS, _UPPER, _MARKS, _DIGITS)]
    dup_lines, repeats = len(lines) - len(set(lines)), repeated_words(words)
    chars = max(1, word_chars)
    features = [
        word_chars / max(1, n),
        *[count / chars for count in counts[:3]],
        float(np.log1p(kinds) / np.log1p(max(1, n))),
        dup_lines / max(1, len(lines)),
        repeats / max(1, n),
        counts[3] / chars,
        float(np.log1p(n)),
    ]
    return n, word_chars, counts[0], dup_lines, repeats, features


def rule_statistics(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the statistics of every whole text."""
    return add_to_rows(df, text, keep, FIELDS, lambda texts: list(zip(*map(statistics, texts))))


def base_failed():
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


class Forest:
    """Isolation trees as arrays; node i of a tree has the children ``left[i]`` and ``left[i] + 1``.

    Of the last features only what exceeds the values ``most`` counts.
    """

    def __init__(
        self, sample: np.ndarray, trees: int = TREES, rows: int = ROWS_PER_TREE, seed: int = SEED, most: Sequence[float] = ()
    ):
        self.most = np.array(most, float)
        sample = self._beyond(sample)
        random = np.random.default_rng(seed)
        self.rows = min(rows, len(sample))
        limit = int(np.ceil(np.log2(max(2, self.rows))))
        grown = [self._grow(sample[random.permutation(len(sample))[: self.rows]], limit, random) for _ in range(trees)]
        most = max(len(tree) for tree in grown)
        filled = [tree + [(0, 0.0, -1, 0.0)] * (most - len(tree)) for tree in grown]
        self.feature, self.split, self.left, self.path = (np.array(a) for a in zip(*[list(zip(*t)) for t in filled]))
        self.limit = limit

    def _beyond(self, features: np.ndarray) -> np.ndarray:
        own = features.shape[1] - len(self.most)
        return np.concatenate([features[:, :own], np.maximum(0.0, features[:, own:] - self.most)], axis=1)

    @staticmethod
    def _expected(n: int) -> float:
        """Mean path length of an unsuccessful search in a binary tree of n rows."""
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, limit: int, random) -> list[tuple]:
        nodes: list = [None]
        todo = [(0, rows, 0)]
        while todo:
            at, some, depth = todo.pop()
            low, high = some.min(axis=0), some.max(axis=0)
            varied = np.nonzero(high > low)[0]
            if depth == limit or len(some) < 2 or not len(varied):
                nodes[at] = (0, 0.0, -1, depth + self._expected(len(some)))
                continue
            feature = int(random.choice(varied))
            split = random.uniform(low[feature], high[feature])
            nodes[at] = (feature, split, len(nodes), 0.0)
            below = some[:, feature] < split
            todo += [(len(nodes), some[below], depth + 1), (len(nodes) + 1, some[~below], depth + 1)]
            nodes += [None, None]
        return nodes

    def scores(self, features: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected path length): near 1 for rows isolated at once."""
        features = self._beyond(features)
        tree = np.arange(len(self.left))[:, None]
        at = np.zeros((len(self.left), len(features)), int)
        for _ in range(self.limit):
            left, feature = self.left[tree, at], self.feature[tree, at]
            right = features[np.arange(len(features)), feature] >= self.split[tree, at]
            at = np.where(left >= 0, left + right, at)
        return 2.0 ** (-self.path[tree, at].mean(axis=0) / max(1e-9, self._expected(self.rows)))


def _marked(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.filter(as_column(label).isNotNull()).groupBy(as_column(key)).agg(F.min(as_column(label)).alias("_good"))


def ordinary(stats: DataFrame, labels: DataFrame, key: str, label: str) -> list[float]:
    """The values of the last features that all but a share FALSE_REJECTS of the good labelled rows stay within; the longest length."""
    good = stats.join(_marked(labels, key, label), key).filter("_good = 1")
    at = [F.col("features")[i - _VARIED + F.size("features")] for i in range(_VARIED)]
    most = [F.percentile_approx(c, 1 - FALSE_REJECTS, 10_000) for c in at[:-1]]
    # without good rows no value says anything
    return [float("inf") if v is None else v for v in good.agg(*most, F.max(at[-1])).first()]


def grow(stats: DataFrame, trees: int = TREES, rows: int = ROWS_PER_TREE, most: Sequence[float] = ()) -> Forest | None:
    """A forest from the different statistics with the smallest hashes; None for an empty table."""
    different = stats.select("features").dropDuplicates()
    sample = chosen_by_hash(different, ["features"], trees * rows).collect()
    return Forest(np.array([r["features"] for r in sample]), trees, rows, most=most) if sample else None


def scored(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` and ``score``; 0 without a forest."""
    if forest is None:
        return stats.withColumn("score", F.lit(0.0))

    def score(part):
        return [forest.scores(np.array(part.column("_0").to_pylist()))]

    return map_rows(stats, ["features"], stats.columns, "score double", score)


def threshold(scores: DataFrame, labels: DataFrame, key: str, label: str, false_rejects: float = FALSE_REJECTS) -> float:
    """The lowest score that at most a share ``false_rejects`` of the good labelled rows reach."""
    known = scores.join(_marked(labels, key, label), key).groupBy(F.floor(F.col("score") / SCORE_STEP).alias("step"))
    counts = known.agg(F.count_if(F.col("_good") == 1).alias("good"), F.count_if(F.col("_good") == 0).alias("bad")).collect()
    good, bad = (sum(r[k] for r in counts) for k in ("good", "bad"))
    step, reached = int(1 / SCORE_STEP) + 1, 0
    if good and bad:
        for row in sorted(counts, key=lambda r: -r["step"]):
            reached += row["good"]
            if reached > false_rejects * good:
                break
            step = row["step"]
    return step * SCORE_STEP


def _below(limit: float) -> Column:
    return F.floor(F.col("score") / SCORE_STEP) * SCORE_STEP < limit


def judge(
    df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """Statistics of every row, ``base_failed``, ``score`` and ``kept``; a forest is grown and its threshold set on them."""
    stats = stored(rule_statistics(df, text, (key,)), "statistics").withColumn("base_failed", base_failed())
    known = stats.select(key, "features", "base_failed")
    forest = grow(known, most=ordinary(known.filter("NOT base_failed"), labels, key, label))
    scores = stored(scored(stats, forest), "scores")
    limit = threshold(scores.select(key, "score", "base_failed").filter("NOT base_failed"), labels, key, label)
    return scores.withColumn("kept", ~F.col("base_failed") & _below(limit))


def keep_good(
    df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, judged row by row, so that keys need not be unique.

    Rows are stored with their statistics; those that the rules keep are scored and dropped as they are read, without a shuffle of texts.
    """
    named = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    names = named.columns
    rows = stored(rule_statistics(named, names[df.columns.index(text)], names), "statistics")
    # what is learned needs no texts, and the threshold only the labelled rows
    stats = rows.select(F.col(names[df.columns.index(key)]).alias(key), *_STATISTICS).withColumn("base_failed", base_failed())
    known = stats.select(key, "features", "base_failed")
    fine = known.filter("NOT base_failed")
    forest = grow(known, most=ordinary(fine, labels, key, label))
    labelled = fine.join(_marked(labels, key, label).select(key), key, "left_semi")
    limit = threshold(scored(labelled, forest), labels, key, label)
    judged = scored(rows.filter(~base_failed()).select(*names, "features"), forest)
    return judged.filter(_below(limit)).select(*names).toDF(*df.columns)
