"""Phrases whose words occur together more often than alone, mined from a prefix-free parse.

Every text is parsed into chunks that begin where the hash of two neighbouring words hits a trigger and
end two words into the next chunk. Cuts depend on the words around them only, so that a passage is cut alike wherever it
stands, and copies of it become the same chunks. The different chunks of a language, with the
number of times the parse has them, are the dictionary; phrases are counted in the dictionary, each weighted with the
frequency of its chunk. A phrase belongs to the chunk its first word is in, outside the two words that the next chunk
repeats, so that every occurrence counts once, and two repeated words suffice for phrases of three.

Words are counted first, then pairs of frequent words, then triples of which both pairs are frequent: no
other phrase can reach the threshold. The frequent ones travel to the tasks as a sieve of bounded size; what
it lets through by mistake is counted and dropped. Chunks are at most ``MOST_WORDS`` long and are dealt out by
their content, so that long texts, hot sources and copies are even work.

NULL and empty texts have no words; a NULL language is ``und``; punctuation and line breaks end a piece, and phrases
lie within pieces. Ties are in the order of phrases' UTF-8 bytes. Repeated rows count again; an empty table gives an empty result; other
columns are not read. All arithmetic is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import stored
from ledgerloom.llm.numbering import Numbers, Waiting, binary, hashes_of, lengths_of, split
from ledgerloom.llm.sieve import Sieve, hash_of, sieve_of
from ledgerloom.operators.skew import left_join_unique

NO_LANGUAGE = "und"
LONGEST = 3
LEAST_COUNT = 10
RANKS = 2000
# Portions of a language that are ranked before it is.
PORTIONS = 16
# A phrase goes if a longer one has at least this percentage of its count.
COVERED = 50
# One in so many places begins a chunk, and the most words between two cuts.
TRIGGER = 32
MOST_WORDS = 512
# Words that a chunk repeats from the next one.
OVERLAP = LONGEST - 1
# Chunks and words a task holds before it hands them on, and bytes of a language it works on at a time.
HELD_CHUNKS = 100_000
HELD_WORDS = 500_000
AT_ONCE = 8 << 20
# Bytes of a word that its hash looks at, beside its length: a sieve lets words through that agree in these.
HASHED_BYTES = 64

_BREAK = b"\xff"  # a piece's end among the words, a byte that no UTF-8 text has
# A-Z in lower case, the ends of pieces as breaks.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(255 if i in _ENDS else i + 32 if 65 <= i <= 90 else i for i in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (binary) in order, and the number of the text each is from.

    ``_BREAK`` follows each piece, and ``OVERLAP`` more of it every text.
    """
    after = (b" " + _BREAK) * OVERLAP
    return split(binary([raw.translate(_BYTES).replace(_BREAK, b" " + _BREAK + b" ") + after for raw in texts.to_pylist()]))


def cuts(hashes: np.ndarray, text: np.ndarray, trigger: int = TRIGGER, most: int = MOST_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks begin and end, the words after them not included: at the first word of a text, at triggers, and ``most`` words
    after a cut without one. ``hashes`` and ``text`` are of all words, the breaks behind a text included; texts without words have no chunk."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.append(True, text[1:] != text[:-1])
    last = np.flatnonzero(np.append(first[1:], True)) + 1 - OVERLAP  # behind the last word of each text
    near = (hashes[:-1] * _MIX ^ hashes[1:]) * _MIX >> np.uint64(32)
    begins = first | np.append(near % np.uint64(trigger) == 0, False)
    for back in range(OVERLAP):
        begins[last + back] = False
    start = np.flatnonzero(begins)
    ends = np.union1d(start, last)
    stop = ends[np.searchsorted(ends, start, "right")]
    parts = -(-(stop - start) // most)
    place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start, stop = np.repeat(start, parts) + place * most, np.repeat(stop, parts)
    return start, np.minimum(stop, start + most)


def parse(df: DataFrame, text: str = "text", lang: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """The dictionary: (lang, chunk, copies). Words of a chunk are joined by blanks; its last ``OVERLAP`` words only follow it."""

    def run(batches):
        vocabulary, chunks, held, waiting = _Vocabulary(0, None), {}, 0, Waiting(AT_ONCE, 1)
        for one, (texts,) in chain(chain.from_iterable(map(waiting.add, batches)), waiting.rest()):
            found, document = words_of(texts)
            numbers = vocabulary.numbered(found)
            start, stop = cuts(vocabulary.hashes[numbers], document, trigger)
            # all words joined by blanks; a chunk is a stretch of that
            whole = pc.binary_join(pa.ListArray.from_arrays([0, len(found)], found), b" ")[0].as_py()
            at = np.append(0, np.cumsum(lengths_of(found) + 1))
            counted = chunks.setdefault(one, {})
            before = len(counted)
            for i, j in zip(at[start].tolist(), (at[stop + OVERLAP] - 1).tolist()):
                chunk = whole[i:j]
                counted[chunk] = counted.get(chunk, 0) + 1
            held += len(counted) - before
            if held > HELD_CHUNKS:
                yield from handed_on(chunks)
                held = 0
            if len(vocabulary) > HELD_WORDS:
                vocabulary = _Vocabulary(0, None)
        yield from handed_on(chunks)

    def handed_on(chunks: dict[str, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for one, counted in chunks.items():
            arrays = [pa.array([one] * len(counted), pa.string()), binary(list(counted)), pa.array(list(counted.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "chunk", "copies"])
        chunks.clear()

    chosen = df.select(
        F.coalesce(as_column(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(as_column(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    parsed = chosen.mapInArrow(run, "lang string, chunk binary, copies long")
    return stored(parsed.groupBy("lang", "chunk").agg(F.sum("copies").alias("copies")), "dictionary")


class _Vocabulary(Numbers):
    """Numbers of words, 0 for the break, and what the counting asks about each word."""

    def __init__(self, seed: int, frequent: Sieve | None):
        super().__init__()
        self.hashes, self.known = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.seed, self.frequent = seed, frequent
        self.numbered(binary([_BREAK]))

    def numbered(self, words: pa.Array) -> np.ndarray:
        numbers = self.of(words)
        new = self.values[len(self.known) :]
        if len(new):
            hashes = hashes_of(new, self.seed, HASHED_BYTES)
            known = np.ones(len(new), bool) if self.frequent is None else self.frequent.passes(hashes)
            self.hashes, self.known = np.concatenate([self.hashes, hashes]), np.concatenate([self.known, known])
        return numbers


def _seed(lang: str) -> int:
    return hash_of(lang.encode()) >> 1


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first * _MIX ^ second) * _MIX
    return mixed ^ mixed >> np.uint64(31)


def _counted(vocabulary: _Vocabulary, chunks: pa.Array, copies: np.ndarray, n: int, pairs: Sieve | None) -> tuple[pa.Array, np.ndarray]:
    """The phrases of ``n`` words in some chunks of a language and their weighted counts."""
    found, chunk = split(chunks)
    ids = vocabulary.numbered(found)
    weights = copies[chunk]
    ends = np.flatnonzero(np.append(chunk[1:] != chunk[:-1], True)) + 1
    for back in range(1, OVERLAP + 1):
        weights[ends - back] = 0
    known, is_word = vocabulary.known[ids], ids > 0
    at = np.flatnonzero((weights > 0) & is_word)
    for step in range(n if n > 1 else 0):
        at = at[known[at + step] & is_word[at + step]]
    if n == LONGEST and pairs is not None:
        hashed = vocabulary.hashes[ids]
        for step in range(n - 1):
            at = at[pairs.passes(_pair_hash(hashed[at + step], hashed[at + step + 1]))]
    # equal phrases of up to three words: two numbers in one, the pair's number with the third
    code, heads = ids[at], None
    for step in range(1, n):
        if step > 1:
            heads, code = np.unique(code, return_inverse=True)
        code = code << 32 | ids[at + step]
    different, where = np.unique(code, return_inverse=True)
    counts = np.bincount(where, weights[at], len(different)).astype(np.int64)
    last = different & ((1 << 32) - 1)
    numbers = [last] if n == 1 else [different >> 32, last]
    if n == LONGEST:
        numbers = [heads[numbers[0]] >> 32, heads[numbers[0]] & ((1 << 32) - 1), last]
    words = [vocabulary.values.take(pa.array(some)) for some in numbers]
    return (words[0] if n == 1 else pc.binary_join_element_wise(*words, b" ")), counts


def phrases(dictionary: DataFrame, n: int, least: int, words: Sieve | None = None, pairs: Sieve | None = None) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``n`` words with f >= ``least``; for single words also '' with the number of all words.

    ``words`` and ``pairs`` let all words and pairs through that occur ``least`` times.
    """

    def run(batches):
        vocabularies: dict[str, _Vocabulary] = {}
        waiting = Waiting(AT_ONCE, 2)
        for lang, (chunks, copies) in chain(chain.from_iterable(map(waiting.add, batches)), waiting.rest()):
            known = vocabularies.get(lang)
            if known is None or len(known) > HELD_WORDS:
                known = vocabularies[lang] = _Vocabulary(_seed(lang), words)
            names, counts = _counted(known, chunks, np.asarray(copies).astype(np.int64), n, pairs)
            if n == 1:
                names, counts = pa.concat_arrays([names, binary([b""])]), np.append(counts, counts.sum())
            arrays = [pa.array([lang] * len(names), pa.string()), names.cast(pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "f"])

    counted = dictionary.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return stored(counted.filter((F.col("f") >= least) | (F.col("phrase") == "")), f"phrases-{n}")


def _by_word(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the phrases of (lang, phrase) rows, and the number of the row each is from."""
    words, row = split(batch.column(1).cast(pa.binary()))
    found, first = np.zeros(len(words), np.uint64), batch.column(0).dictionary_encode()
    lang = np.asarray(first.indices)[row]
    for number, name in enumerate(first.dictionary.to_pylist()):
        found[lang == number] = hashes_of(words.filter(pa.array(lang == number)), _seed(name), HASHED_BYTES)
    return found, row


def _word_hashes(batch: pa.RecordBatch) -> np.ndarray:
    return _by_word(batch)[0]


def _phrase_hashes(batch: pa.RecordBatch) -> np.ndarray:
    found, _ = _by_word(batch)
    return _pair_hash(found[::2], found[1::2])


def _key(phrase: Column) -> Column:
    # a line break is no part of a phrase
    return F.concat("lang", F.lit("\n"), phrase)


def _with_cuts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """``candidates`` with l1, r1, l2 and r2, the counts of the sides of both cuts; a pair has one.

    All sides are looked up in one join: one word may begin a good share of all phrases, and its rows are dealt out.
    """
    phrase, blank = F.col("phrase"), F.lit(" ")
    first, last = F.split_part(phrase, blank, F.lit(1)), F.split_part(phrase, blank, F.lit(-1))
    head, tail = F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)
    is_pair = head == phrase
    sides = {"l1": first, "r1": F.when(is_pair, last).otherwise(tail), "l2": F.when(~is_pair, head), "r2": F.when(~is_pair, last)}
    listed = F.array(*[F.struct(F.lit(name).alias("side"), part.alias("part")) for name, part in sides.items()])
    parts = candidates.select("lang", "phrase", "a", F.inline(listed)).filter(F.col("part").isNotNull())
    lookup = counts.select(_key(F.col("phrase")).alias("_key"), F.col("f"))
    found = left_join_unique(parts.withColumn("_key", _key(F.col("part"))), [lookup], "_key")
    columns = [F.max(F.when(F.col("side") == name, F.col("f"))).alias(name) for name in sides]
    return found.groupBy("lang", "phrase", "a").agg(*columns)


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)); a is at most l and r."""
    wide = [f"CAST({c} AS DECIMAL(16, 0))" for c in (a, left, right)]
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({wide[0]} * {wide[0]})) DIV ({wide[1]} * {wide[2]})")


def mine(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST_COUNT,
    ranks: int = RANKS,
    covered: int = COVERED,
    trigger: int = TRIGGER,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``ranks`` best phrases of two and three words.

    ``a`` counts the phrase, ``l`` and ``r`` the two sides of the cut where it holds together least, ``n`` all words.
    """
    dictionary = parse(df, text, lang, trigger)
    one = phrases(dictionary, 1, least)
    frequent = sieve_of(one.filter("phrase != ''").select("lang", "phrase"), _word_hashes)
    two = phrases(dictionary, 2, least, frequent)
    three = phrases(dictionary, 3, least, frequent, sieve_of(two.select("lang", "phrase"), _phrase_hashes))

    head, tail = F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)
    # the most frequent longer phrase that a pair lies in
    inside = three.select("lang", F.explode(F.array(head, tail)).alias("phrase"), F.col("f").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    pairs = two.select("lang", "phrase", F.col("f").alias("a")).join(inside, ["lang", "phrase"], "left")
    # 100 * longer >= covered * a, without a product that could pass 64 bits
    hidden = F.expr(f"CAST(100 AS DECIMAL(3, 0)) * longer >= CAST({covered} AS DECIMAL(3, 0)) * a")
    pairs = pairs.filter(F.col("longer").isNull() | ~hidden).drop("longer")
    candidates = pairs.unionByName(three.select("lang", "phrase", F.col("f").alias("a")))

    scored = _with_cuts(candidates, one.filter("phrase != ''").unionByName(two))
    scored = scored.withColumns({"s1": score("a", "l1", "r1"), "s2": score("a", "l2", "r2")})
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    chosen = [F.when(second, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(name) for c, name in (("l", "l"), ("r", "r"), ("s", "score"))]
    scored = scored.select("lang", "phrase", "a", *chosen)

    # in two steps, so that the task of a language sees no more than the best of each portion, however many tasks there are
    by = [F.desc("score"), F.desc("a"), "phrase"]
    portion = F.pmod(F.xxhash64("phrase"), F.lit(PORTIONS)).alias("portion")
    first = F.row_number().over(Window.partitionBy("lang", "portion").orderBy(*by))
    best = scored.select("*", portion).withColumn("rank", first).filter(F.col("rank") <= ranks).drop("portion", "rank")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).filter(F.col("rank") <= ranks)
    best = best.withColumn("rank", F.col("rank").cast("long"))
    sizes = one.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
