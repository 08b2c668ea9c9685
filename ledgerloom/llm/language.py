"""Language identification by cross-parsing: how few phrases of a language's own texts make up a text.

For every language a suffix automaton knows all substrings of passages made of the words that are commonest in
all labelled texts. A text is cut
greedily into the longest phrases that occur there; a letter that does not occur is a phrase. The
number of phrases, times the bits that point to a phrase's place, per letter, is the
cross-entropy of the text to the language; the lowest wins.

Letters are lower-cased and everything else counts as one space, so marks, digits and symbols say
nothing about the language. Long texts are parsed in segments, all segments of some rows and
all languages side by side; phrases end where a segment ends. Every letter of every text is read.

NULL texts and texts without letters are ``und`` with score 0; ties go to the language that
comes first by name; repeated rows get the same answer; without labelled texts everything is
``und``; an empty table gives an empty result; NULL labels teach nothing; other columns are
not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import add_to_rows, keep_rows

# Letters and spaces of the passages that each language's automaton is built from.
TRAINING_CHARACTERS = 16_000
# The commonest words that passages are made of, fewer than 4,096, and the bits where a passage keeps the ranks of those that follow the first.
MOST_WORDS = 4_095
_PLACES = (24, 12, 0)
# Longer runs of letters count in pieces.
WORD_LETTERS = 12
# Counts of words that a task holds before it hands them on.
HELD_WORDS = 200_000
# Letters parsed from a fresh start.
SEGMENT = 512
UNKNOWN = "und"
# A text is in none of the languages if it costs more bits a letter than this share of the winner's own texts, and its lead
# over the second language, as a share of its cross-entropy, is smaller than theirs. Few texts set no limit.
CLEAN_SHARE = 0.99
FEWEST_TEXTS = 20

FIELDS = "lang_pred string, score double"


def _letters(text: str) -> np.ndarray:
    """Code points in lower case; every run of other characters is one space (0)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    points = np.where(_alphabetic()[points], points, 0)
    if not points.any():
        return points[:0]
    return points[(points > 0) | np.append(True, points[:-1] > 0)]


@lru_cache(1)
def _alphabetic() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def suffix_automaton(symbols: Sequence[int]) -> list[dict[int, int]]:
    """The transitions of the smallest automaton that knows every substring."""
    following: list[dict[int, int]] = [{}]
    longest, link, last = [0], [-1], 0
    for symbol in symbols:
        new = len(following)
        following.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at, last = last, new
        while at >= 0 and symbol not in following[at]:
            following[at][symbol] = new
            at = link[at]
        if at < 0:
            continue
        target = following[at][symbol]
        if longest[target] == longest[at] + 1:
            link[new] = target
            continue
        # the target also ends longer substrings: those keep it, the shorter ones get a state of their own
        own = len(following)
        following.append(dict(following[target]))
        longest.append(longest[at] + 1)
        link.append(link[target])
        while at >= 0 and following[at].get(symbol) == target:
            following[at][symbol] = own
            at = link[at]
        link[target] = link[new] = own
    return following


class CrossParser:
    """All languages' automata as one table: (place of the next state) * 4 + phrases that end."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        if not texts:
            return
        read = [_letters(texts[name]) for name in self.languages]
        seen = np.unique(np.concatenate([[0], *read]))
        # symbols: 0 a space, then the known letters, then any other letter, then the end of a text
        self.symbol = np.full(0x110000, len(seen), np.uint16)
        self.symbol[seen] = np.arange(len(seen))
        self.end = len(seen) + 1
        width = self.end + 1
        # an automaton has at most twice as many states as letters
        most = 8 * width * sum(len(letters) + 1 for letters in read)
        kind = np.int32 if most < 1 << 31 else np.int64
        tables, self.roots, base = [], [], 0
        for letters in read:
            states = suffix_automaton(self.symbol[letters].tolist())
            start = [(base + states[0][c]) * width * 4 + 1 if c in states[0] else base * width * 4 + 2 for c in range(width)]
            table = np.tile(np.array(start, kind), (len(states), 1))
            table[0] -= 1  # nothing ends where nothing has begun
            table[:, self.end] = base * width * 4 + 1
            table[0, self.end] -= 1
            for state, following in enumerate(states):
                for c, target in following.items():
                    table[state, c] = (base + target) * width * 4
            self.roots.append(base * width)
            tables.append(table)
            base += len(states)
        self.table = np.concatenate(tables).ravel()
        self.bits = np.log2([max(2, len(letters)) for letters in read])

    def phrases(self, texts: Sequence[np.ndarray]) -> np.ndarray:
        """Number of phrases of every text (letters as from ``_letters``) in every language."""
        sizes = [-(-len(t) // SEGMENT) for t in texts]
        owner = np.repeat(np.arange(len(texts)), sizes)
        # a row per segment, so that a step takes the next symbol of all of them; the last is an end
        symbols = np.full((len(owner), SEGMENT + 1), self.end, self.table.dtype)
        at = 0
        for text, size in zip(texts, sizes):
            block = np.full(size * SEGMENT, self.end, self.table.dtype)
            block[: len(text)] = self.symbol[text]
            symbols[at : at + size, :SEGMENT] = block.reshape(size, SEGMENT)
            at += size
        # full segments first, so that the ones still running are always the first rows
        lengths = np.concatenate([np.minimum(SEGMENT, len(t) - SEGMENT * np.arange(n)) for t, n in zip(texts, sizes)] + [[0]])[:-1]
        order = np.argsort(-lengths, kind="stable")
        running = len(order) - np.searchsorted(lengths[order][::-1], np.arange(SEGMENT + 1) - 1, "right")
        steps = np.ascontiguousarray(symbols[order].T)
        state = np.repeat(np.array(self.roots, self.table.dtype)[:, None], len(owner), axis=1)
        counts = np.zeros(state.shape, np.int64)
        for now, n in zip(steps, running.tolist()):
            found = self.table.take(state[:, :n] + now[:n])
            counts[:, :n] += found & 3
            state[:, :n] = found >> 2
        out = np.zeros((len(self.languages), len(texts)), np.int64)
        np.add.at(out, (slice(None), owner[order]), counts)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        return self.judged(texts)[:2]

    def judged(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        """Language, lead over the second one, and bits per letter of every text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        read = [_letters(t) for t in texts]
        bits = self.phrases(read) * self.bits[:, None]
        best = bits.argmin(axis=0)
        ordered = np.sort(bits, axis=0)
        lead = 1 - ordered[0] / np.maximum(1e-9, ordered[1]) if len(ordered) > 1 else np.ones(len(texts))
        known = [len(t) > 0 for t in read]
        return (
            [self.languages[i] if k else UNKNOWN for i, k in zip(best, known)],
            [float(s) if k else 0.0 for s, k in zip(lead, known)],
            [float(b) / max(1, len(t)) for b, t in zip(ordered[0], read)],
        )


@lru_cache(1)
def _parser(texts: tuple[tuple[str, str], ...]) -> CrossParser:
    """Built once in every Python process, from the training texts that come with a task."""
    return CrossParser(dict(texts))


def held_out(key: str) -> Column:
    """A quarter of the documents teaches nothing."""
    return F.coalesce(F.crc32(as_column(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_texts(df: DataFrame, text: str = "text", language: str = "lang") -> tuple[tuple[str, str], ...]:
    """What each language is learned from: (language, passages), TRAINING_CHARACTERS at most.

    Words are counted in all labelled texts, copies once. The commonest of each language get a passage each, a few words that
    follow each other in some text, rare ones preferred so that few passages have many words; the commonest words go first.
    """
    named = _labelled(df, text, language)
    words = {name: dict(zip(listed, range(1, len(listed) + 1))) for name, listed in _commonest(named).items()}
    found = []
    for name, codes in sorted(_passages(named, words).items()):
        listed, taken, size, covered = list(words[name]), [], 0, set()
        for first, code in sorted(codes):
            ranks = [first, *(rank for shift in _PLACES if (rank := code >> shift & MOST_WORDS))]
            passage = [listed[rank - 1] for rank in ranks]
            length = sum(map(len, passage)) + len(passage)
            if passage[0] not in covered and size + length <= TRAINING_CHARACTERS:
                taken.append(" ".join(passage))
                covered.update(passage)
                size += length
        found.append((name, " ".join(taken)))
    return tuple(found)


def _labelled(df: DataFrame, text: str, language: str) -> DataFrame:
    named = df.select(as_column(text).cast("string").alias("text"), as_column(language).cast("string").alias("lang"))
    return named.filter("text IS NOT NULL AND lang IS NOT NULL").withColumn("hash", F.xxhash64("text"))


def _words(text: str) -> list[str]:
    """The runs of letters of a text, long ones in pieces of WORD_LETTERS."""
    points = _letters(text)
    words = np.where(points > 0, points, 32).astype("<u4").tobytes().decode("utf-32-le", "replace").split()
    if max(map(len, words), default=0) <= WORD_LETTERS:
        return words
    return [w[i : i + WORD_LETTERS] for w in words for i in range(0, len(w), WORD_LETTERS)]


def _commonest(named: DataFrame) -> dict[str, list[str]]:
    """The MOST_WORDS commonest words of each language over all its different texts, ties in order of the words."""

    def count(batches):
        seen, counts = set(), {}

        def flushed():
            rows = [(name, word, n) for name, found in counts.items() for word, n in found.items()]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["lang", "word", "n"])

        types = [pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for body, name, hashed in zip(*(c.to_pylist() for c in batch.columns)):
                if (name, hashed) not in seen:
                    seen.add((name, hashed))
                    counts.setdefault(name, Counter()).update(_words(body))
            if sum(map(len, counts.values())) > HELD_WORDS:
                yield flushed()
        if any(counts.values()):
            yield flushed()

    # copies meet in one task
    apart = named.repartition(int(named.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lang", "hash")
    counted = apart.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), "word"]
    portions = Window.partitionBy("lang", F.pmod(F.xxhash64("word"), F.lit(16))).orderBy(*order)
    few = counted.withColumn("place", F.row_number().over(portions)).filter(F.col("place") <= MOST_WORDS)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = few.withColumn("place", place).filter(F.col("place") <= MOST_WORDS)
    found: dict[str, list[str]] = {}
    for row in best.orderBy("lang", "place").collect():
        found.setdefault(row["lang"], []).append(row["word"])
    return found


def _passages(named: DataFrame, words: dict[str, dict[str, int]]) -> dict[str, list[tuple[int, int]]]:
    """For each language and the rank of a word the best passage that begins with it.

    A passage is a number: how many words follow, the sum of their ranks, and their ranks; the highest is the best.
    It ends in front of a word that is not among ``words``.
    """

    def best_of(batches):
        best = {name: np.full(MOST_WORDS + 1, -1) for name in words}
        for batch in batches:
            for name in set(batch.column(1).to_pylist()) & set(words):
                texts = batch.filter(pc.equal(batch.column(1), name)).column(0).to_pylist()
                get, ranks = words[name].get, []
                for body in texts:
                    ranks += [get(w, 0) for w in _words(body)]
                    ranks += [0] * len(_PLACES)
                at = np.array(ranks, np.int64)
                n = len(at) - len(_PLACES)
                running, follow, total, code = np.ones(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
                for ahead, shift in enumerate(_PLACES, 1):
                    rank = at[ahead : ahead + n]
                    running &= rank > 0
                    rank = rank * running
                    follow, total, code = follow + running, total + rank, code | rank << shift
                np.maximum.at(best[name], at[:n], follow << 50 | total << 36 | code)
        for name, codes in best.items():
            rank = np.nonzero(codes[1:] >= 0)[0] + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(rank), pa.string()), pa.array(rank), pa.array(codes[rank])], names=["lang", "rank", "code"]
            )

    rows = named.select("text", "lang").mapInArrow(best_of, "lang string, rank long, code long")
    found: dict[str, list[tuple[int, int]]] = {}
    for row in rows.groupBy("lang", "rank").agg(F.max("code").alias("code")).collect():
        found.setdefault(row["lang"], []).append((row["rank"], row["code"]))
    return found


def limits(
    df: DataFrame, training: tuple[tuple[str, str], ...], text: str = "text", language: str = "lang"
) -> dict[str, tuple[float, float]]:
    """The most bits per letter and the least lead of all but a share 1 - CLEAN_SHARE of each language's labelled texts.

    All of them are parsed, and copies count once. Languages with fewer than FEWEST_TEXTS have no limits.
    """
    fields = "winner string, lead double, bits double"
    judged = add_to_rows(_labelled(df, text, language), "text", ["lang", "hash"], fields, lambda texts: _parser(training).judged(texts))
    own = judged.filter("lang = winner").dropDuplicates(["lang", "hash"]).groupBy("lang").agg(
        F.percentile_approx("bits", CLEAN_SHARE, 10_000).alias("bits"),
        F.percentile_approx("lead", 1 - CLEAN_SHARE, 10_000).alias("lead"),
        F.count(F.lit(1)).alias("n"),
    )
    return {r["lang"]: (r["bits"], r["lead"]) for r in own.collect() if r["n"] >= FEWEST_TEXTS}


def identify(
    df: DataFrame, training: tuple[tuple[str, str], ...], text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score``, the winner's lead over the second language (0 to 1)."""
    return add_to_rows(df, text, keep, FIELDS, lambda texts: _parser(training).predict(texts))


def keep_identified(
    df: DataFrame,
    training: tuple[tuple[str, str], ...],
    text: str = "text",
    limits: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """The rows of ``df`` whose text is in one of the languages, within the ``limits`` of its own texts."""

    def decide(texts: list[str]) -> list[bool]:
        parser = _parser(training)

        def own(name: str, lead: float, bits: float) -> bool:
            most, least = (limits or {}).get(name, (float("inf"), 0.0))
            # with a single language there is no lead to speak of
            return bits <= most or (len(parser.languages) > 1 and lead >= least)

        return [name != UNKNOWN and own(name, lead, bits) for name, lead, bits in zip(*parser.judged(texts))]

    return keep_rows(df, text, decide)
