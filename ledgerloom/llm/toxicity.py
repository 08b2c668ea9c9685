"""Toxicity by maximum-scoring segments: passages in which words of toxic texts are dense.

A word's score is the log ratio of its share among the words of toxic and of other labelled texts,
with a Dirichlet prior that expects no difference; words whose ratio may be chance score nothing. A small
cost per word makes the expected score negative, so that a linear-time scan finds the disjoint passages of maximal
score. The scores of the best passages in texts that are not toxic follow an extreme-value
distribution with the length of the text; its two parameters turn the scores of all passages into one
surprise, and a logistic curve that into the score.

The words are learned from three quarters of a bounded sample of labelled texts and the curves from the other quarter, so
that no text tells how well it was learned itself. Words are runs of letters in lower case; their beginnings
are tokens as well, and a word without a score of its own has that of its longest beginning with one.

NULL and empty texts are scored as texts without a toxic passage; ties in the sample go by hash; copies count once;
a document with several labels is toxic if any says so; without labels of both kinds every
score is 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import chain
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import add_to_rows, below_share, map_rows, pieces, stored, texts_of

# Labelled texts of each kind that are learned from.
LABELLED_TEXTS = 10_000
# Texts that the Dirichlet prior adds for each token, toxic ones in proportion to all.
PRIOR = 1.0
# Words with a smaller log ratio, in standard deviations, score nothing.
LEAST_DEVIATIONS = 2.9
# Words with a smaller log ratio score nothing: many small ones add up in texts of one language.
LEAST_RATIO = 1.0
# Lengths of the beginnings of words that are tokens, too.
BEGINNINGS = (6, 5, 4)
# Words whose tokens one Python process remembers.
REMEMBERED_WORDS = 250_000
# Words with the largest deviations that are kept; bounds the model.
MOST_WORDS = 20_000
# A word that adds to a score does so once in as many words, so that repeating it is no evidence.
REPEATED_WITHIN = 50
# Cost of every word, which ends a passage without toxic words.
COST = 0.1
# A passage counts if chance makes as good a one in less than this number of texts of the same length.
SIGNIFICANT = 0.05

FIELDS = "score double, predicted int, passages array<struct<start:int,stop:int,score:double>>"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def tokens_of(word: str) -> list[str]:
    """The word and its beginnings, longest first."""
    return [word, *[f"{word[:n]}~" for n in BEGINNINGS if len(word) >= n]]


class _Scores(dict):
    """The score of each word: that of its longest token with a score, else None."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float | None:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        found = next((self.weights[t] for t in tokens_of(word) if t in self.weights), None)
        self[word] = found
        return found


def maximal_segments(scores: Sequence[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, stop, score) in linear time.

    ``scores`` lists the places that score and their scores; every place costs ``cost`` besides.
    Each new segment swallows earlier ones as long as that raises its score.
    """
    found: list[list] = []  # start, stop, total before, total after, place in `found` to look at next
    total, seen = 0.0, 0
    for place, score in scores:
        total -= cost * (place - seen)
        seen = place + 1
        if score <= cost:
            total += score - cost
            continue
        start, before = place, total
        total += score - cost
        look = len(found) - 1
        while True:
            # the last segment that starts lower than this one
            while look >= 0 and found[look][2] >= before:
                look = found[look][4]
            if look < 0 or found[look][3] >= total:
                found.append([start, place + 1, before, total, look])
                break
            start, before = found[look][0], found[look][2]
            del found[look:]
            look -= 1
    return [(start, stop, after - before) for start, stop, before, after, _ in found]


@dataclass(frozen=True)
class Model:
    weights: tuple[tuple[str, float], ...]
    # of the extreme-value distribution: P(best >= x) = 1 - exp(-k * n * exp(-decay * x))
    decay: float = 1.0
    k: float = 1.0
    # of the logistic curve
    slope: float = 0.0
    offset: float = -50.0

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        """Maximal passages; every word scores, except where it scored at most REPEATED_WITHIN words before."""
        scored: dict[str, int] = {}
        places, scores = [], _scores(self)
        for i, word in enumerate(words):
            score = scores[word]
            if score is None:
                continue
            if score > 0:
                if i - scored.get(word, -REPEATED_WITHIN - 1) <= REPEATED_WITHIN:
                    continue
                scored[word] = i
            places.append((i, score))
        return maximal_segments(places, COST)

    def significant(self, words: list[str]) -> list[tuple[int, int, float]]:
        """Passages, each with its surprise: minus the log of how often chance makes as good a one."""
        chance = math.log(self.k * max(1, len(words)))
        found = [(start, stop, self.decay * score - chance) for start, stop, score in self.segments(words)]
        return [s for s in found if s[2] > -math.log(SIGNIFICANT)]

    def surprise(self, words: list[str]) -> float:
        return math.log1p(sum(s[2] for s in self.significant(words)))

    def score(self, texts: list[str]) -> tuple[list[float], list[int], list[list]]:
        passages = [self.significant(words_of(t)) for t in texts]
        curve = [self.slope * math.log1p(sum(s[2] for s in found)) + self.offset for found in passages]
        scores = [1 / (1 + math.exp(-max(-50.0, min(50.0, c)))) for c in curve]
        return scores, [int(s >= 0.5) for s in scores], passages


@lru_cache(2)
def _scores(model: Model) -> _Scores:
    return _Scores(dict(model.weights))


def word_scores(counts: dict[str, tuple[int, int]]) -> tuple[tuple[str, float], ...]:
    """Log ratio of each token (texts with it that are toxic, and that are not) where it is no chance."""
    totals = [max(1, sum(c[kind] for c in counts.values())) for kind in (0, 1)]
    found = []
    for word, pair in counts.items():
        toxic, other = (n + PRIOR * total / sum(totals) for n, total in zip(pair, totals))
        ratio = math.log(toxic / totals[0]) - math.log(other / totals[1])
        deviations = ratio / math.sqrt(1 / toxic + 1 / other)
        if abs(deviations) >= LEAST_DEVIATIONS and abs(ratio) >= LEAST_RATIO:
            found.append((abs(deviations), word, ratio))
    return tuple((word, ratio) for _, word, ratio in sorted(found, reverse=True)[:MOST_WORDS] if word)


def extreme_values(best: np.ndarray, lengths: np.ndarray) -> tuple[float, float]:
    """decay and k from the best scores in texts that are not toxic, by their moments."""
    if len(best) < 2:
        return 1.0, 1.0
    spread = max(best.std(), 1e-3)
    decay = min(5.0, math.pi / (spread * math.sqrt(6)))
    centred = decay * best - np.log(np.maximum(1, lengths))
    return decay, float(np.exp(centred.mean() - np.euler_gamma))


def logistic(x: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve by Newton's method, slightly drawn towards zero."""
    design, beta = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        gradient = design.T @ (toxic - p) - 0.01 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def held_out(key: str) -> Column:
    """A fifth of the documents teaches nothing."""
    return F.coalesce(F.crc32(as_column(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_texts(df: DataFrame, labels: DataFrame, text: str, key: str, label: str) -> DataFrame:
    """The bounded sample: columns text, toxic, calibrates."""
    marks = labels.select(as_column(key).alias("_key"), as_column(label).cast("int").alias("toxic"))
    marks = marks.filter("toxic IS NOT NULL AND _key IS NOT NULL").groupBy("_key").agg(F.max("toxic").alias("toxic"))
    marks = stored(marks.withColumn("toxic", (F.col("toxic") > 0).cast("int")), "marks")
    # only about twice as many rows as are wanted leave their tasks to be sorted
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    hashed = F.xxhash64("_key")
    few = [(F.col("toxic") == kind) & below_share(hashed, 2 * LABELLED_TEXTS / size) for kind, size in sizes.items()]
    marks = marks.filter(reduce(or_, few, F.lit(False)))
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.shiftrightunsigned(hashed, 1), "_key"))
    marks = marks.withColumn("place", place).filter(F.col("place") <= LABELLED_TEXTS)
    named = df.select(as_column(key).alias("_key"), as_column(text).cast("string").alias("text"))
    # at most twice LABELLED_TEXTS rows of a key and two numbers
    found = named.filter("text IS NOT NULL").join(F.broadcast(marks), "_key")
    found = found.groupBy(F.xxhash64("text").alias("hash")).agg(F.max(F.struct("toxic", "text")).alias("row"))
    return found.select("row.text", "row.toxic", (F.pmod("hash", F.lit(4)) == 0).alias("calibrates"))


def _counts(sample: DataFrame) -> dict[str, tuple[int, int]]:
    """In how many toxic and other texts a token occurs, for tokens of at least three texts, one of them toxic."""

    def run(batches):
        for part in pieces(batches):
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(texts_of(part.column(0)), part.column(1).to_pylist()):
                seen[int(toxic > 0)].update(set(chain.from_iterable(map(tokens_of, set(words_of(text))))))
            words = list(seen[0].keys() | seen[1].keys())
            columns = [words, [seen[1][w] for w in words], [seen[0][w] for w in words]]
            types = (pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["word", "toxic", "other"])

    parts = sample.select("text", "toxic").mapInArrow(run, "word string, toxic long, other long")
    counts = parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    often = counts.filter("toxic > 0 AND toxic + other > 2").orderBy(F.desc("toxic"), "other", "word").limit(10 * MOST_WORDS)
    rest = counts.agg(F.sum("toxic"), F.sum("other")).first()
    found = {r["word"]: (r["toxic"], r["other"]) for r in often.collect()}
    # the words left out still count in the totals
    found[""] = tuple((total or 0) - sum(c[i] for c in found.values()) for i, total in enumerate(rest))
    return found


def train(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """A model from a bounded sample of labelled texts."""
    sample = stored(labelled_texts(df, labels, text, key, label), "labelled")
    weights = word_scores(_counts(sample.filter("NOT calibrates")))
    first = Model(weights)

    def measured(part):
        read = [words_of(t) for t in texts_of(part.column("_0"))]
        best = [max((s[2] for s in first.segments(words)), default=0.0) for words in read]
        return [best, [len(words) for words in read]]

    rest = stored(sample.filter("calibrates"), "calibration")
    rows = map_rows(rest, ["text"], ["toxic"], "best double, n long", measured).collect()
    toxic, best, n = (np.array([r[k] for r in rows], float) for k in ("toxic", "best", "n"))
    if not weights or not 0 < toxic.sum() < len(toxic):
        return first
    decay, k = extreme_values(best[toxic == 0], n[toxic == 0])
    second = Model(weights, decay, k)

    def surprises(part):
        return [[second.surprise(words_of(t)) for t in texts_of(part.column("_0"))]]

    rows = map_rows(rest, ["text"], ["toxic"], "x double", surprises).collect()
    slope, offset = logistic(np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return Model(weights, decay, k, slope, offset)


def score(df: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, ``score``, ``predicted`` and the significant passages in words (start, stop) with their surprise."""
    return add_to_rows(df, text, keep, FIELDS, model.score)
