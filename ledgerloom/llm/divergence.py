"""How far the sources of a language diverge in the terms they use, over terms that enough documents hold.

The kept terms are found by iceberg refinement of byte prefixes. At every level the distinct documents of
each open prefix are counted; prefixes below the threshold are discarded with all terms that begin with them,
the others are extended to twice their length. Terms that end at a level are complete. Refinement ends when
no open prefix is left, or so few that their terms are counted as they are. Only terms that are complete and kept,
or begin with a prefix still open, are then counted for every source, and the count of their documents decides.

Survivors travel to the tasks as a sieve of bounded size (``sieve.py``); what it lets through by mistake
is counted and dropped. Counts are gathered within each task, in tables of bounded size, before they are shuffled.

Every source of a language is compared with the language (its terms used above their share) and with every
other source (the sum of differences over all kept terms). A term that neither side of a pair uses adds the
same to the sum as any other such term, so that only terms in use are looked at: terms are cut into chunks,
sources into blocks, and each pair of blocks sums a chunk in one task.

NULL texts, languages and sources count as ''. Shares are exact integers. Equal values are in the order of the
items' UTF-8 bytes. Long texts and terms are counted whole; repeated rows are documents of their own; a source without
kept terms has the shares of terms that do not occur; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import groups_of, in_groups, stored
from ledgerloom.llm.numbering import Numbers, Sums, Waiting, binary, distinct_pairs, hashes_of, lengths_of, split
from ledgerloom.llm.sieve import Sieve, hash_of, sieve_of
from ledgerloom.operators.skew import left_join_unique

# Distinct documents of a language that a kept term occurs in.
LEAST_DOCUMENTS = 30
# Bytes of the first prefixes; every level doubles them.
FIRST_LENGTH = 8
# With no more open prefixes, their terms are counted without further levels.
FEW_OPEN = 5_000
# Shares are 1 + floor(SCALE * (count + SMOOTHING) / (N + SMOOTHING * V)).
SCALE = 1_000_000_000
SMOOTHING = 5
TERM_RANKS = 50
# Different terms a task remembers before it hands on what it has counted.
HELD_TERMS = 500_000
# Bytes of texts of a language that are worked on at a time.
AT_ONCE = 4 << 20
# Portions of a source that are ranked before it is.
PORTIONS = 16
# Sources of a block, and kept terms of a chunk.
BLOCK = 256
CHUNK = 4096

# ASCII letters in lower case, bytes of other characters as they are, blanks for the rest.
_BYTES = bytes(i if i > 127 or 97 <= i <= 122 else i + 32 if 65 <= i <= 90 else 32 for i in range(256))
_END = b"\x00"  # no byte of a term


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts (binary) in order, and the number of the text each is from."""
    if not len(texts) or texts.buffers()[2] is None:
        return binary(), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = pa.py_buffer(texts.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]].translate(_BYTES))
    places = pa.py_buffer((offsets - offsets[0]).astype(np.int32).tobytes())
    return split(pa.Array.from_buffers(pa.binary(), len(texts), [None, places, raw]))


def _seed(lang: str) -> int:
    return hash_of(lang.encode()) >> 1


def _inputs(df: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    columns = zip((lang, source, text), ("lang", "source", "text"))
    return df.select(*[F.coalesce(as_column(c).cast("string"), F.lit("")).alias(name) for c, name in columns])


def _by_lang(docs: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` takes an iterator of language, sources and texts (binary arrays) of some documents of one language."""

    def some(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, pa.Array]]:
        waiting = Waiting(AT_ONCE, 2)
        for batch in batches:
            for lang, columns in waiting.add(batch):
                yield lang, *columns
        for lang, columns in waiting.rest():
            yield lang, *columns

    chosen = docs.select("lang", F.col("source").cast("binary").alias("source"), F.col("text").cast("binary").alias("text"))
    return chosen.mapInArrow(lambda batches: run(some(batches)), schema)


class _Terms(Numbers):
    """Terms of a language, and for each the number of the key it is counted under, -1 for none.

    ``key_of`` says which of some terms have a key, and gives the keys of these.
    """

    def __init__(self, key_of: Callable[[pa.Array], tuple[np.ndarray, pa.Array]]):
        super().__init__()
        self.key_of, self.keys, self.key = key_of, Numbers(), np.zeros(0, np.int64)

    def keyed(self, found: pa.Array) -> np.ndarray:
        """The number of the key of every term."""
        numbers = self.of(found)
        new = self.values[len(self.key) :]
        if len(new):
            has_key, keys = self.key_of(new)
            added = np.full(len(new), -1, np.int64)
            added[has_key] = self.keys.of(keys)
            self.key = np.concatenate([self.key, added])
        return self.key[numbers]


def _keys(found: pa.Array, length: int) -> pa.Array:
    """The first ``length`` bytes of terms, with an end mark if that is all."""
    ends = binary([b"", _END]).take(pa.array((lengths_of(found) <= length).astype(np.int32)))
    return pc.binary_join_element_wise(pc.binary_slice(found, 0, length), ends, binary([b""])[0])


def _hashes(batch: pa.RecordBatch) -> np.ndarray:
    """Hashes of (lang, key): those of a term that begins with the key, or is it."""
    found, first = np.zeros(batch.num_rows, np.uint64), batch.column(0).dictionary_encode()
    keys, sizes = batch.column(1), lengths_of(batch.column(1))
    ends = np.asarray(pc.equal(pc.binary_slice(keys, -1), binary([_END])[0])).astype(bool)
    for number, lang in enumerate(first.dictionary.to_pylist()):
        some = np.asarray(first.indices) == number
        for whole in (False, True):
            mine = some & (ends == whole)
            bare = pc.binary_slice(keys.filter(pa.array(mine)), 0, int(sizes[mine].max(initial=0)))
            if whole:
                bare = pc.binary_replace_slice(bare, -1, np.iinfo(np.int32).max, b"")
            found[mine] = hashes_of(bare, _seed(lang), None, np.full(int(mine.sum()), not whole))
    return found


def _level(docs: DataFrame, length: int, last: int, sieve: Sieve | None, least: int) -> DataFrame:
    """(lang, key, documents) of the keys of one level that enough documents hold; ``last`` is the length of the level before."""

    def key_of(lang: str) -> Callable[[pa.Array], tuple[np.ndarray, pa.Array]]:
        seed = _seed(lang)

        def keys(found: pa.Array) -> tuple[np.ndarray, pa.Array]:
            # terms that ended at an earlier level have been counted there
            is_open = np.ones(len(found), bool) if sieve is None else (lengths_of(found) > last) & sieve.passes(hashes_of(found, seed, last))
            return is_open, _keys(found.filter(pa.array(is_open)), length)

        return keys

    def run(rows):
        states: dict[str, list] = {}
        for lang, _, texts in rows:
            state = states.get(lang) or states.setdefault(lang, [_Terms(key_of(lang)), np.zeros(0, np.int64)])
            found, document = terms(texts)
            key = state[0].keyed(found)
            _, held = distinct_pairs(document[key >= 0], key[key >= 0])
            more = np.bincount(held, minlength=len(state[0].keys))
            more[: len(state[1])] += state[1]
            state[1] = more
            if sum(len(known) for known, _ in states.values()) > HELD_TERMS:
                yield from handed_on(states)
        yield from handed_on(states)

    def handed_on(states) -> Iterator[pa.RecordBatch]:
        for lang, (known, counts) in states.items():
            langs = pa.array([lang] * len(known.keys), pa.string())
            yield pa.RecordBatch.from_arrays([langs, known.keys.values, pa.array(counts, pa.int64())], names=["lang", "key", "documents"])
        states.clear()

    counted = _by_lang(docs, run, "lang string, key binary, documents long")
    counted = counted.groupBy("lang", "key").agg(F.sum("documents").alias("documents"))
    return stored(counted.filter(F.col("documents") >= least), "prefixes")


def refined(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, first_length: int = FIRST_LENGTH, few_open: int = FEW_OPEN
) -> tuple[DataFrame, DataFrame, int]:
    """(lang, key) of the kept terms that are complete, of the prefixes that are still open, and the length of these."""
    sieve, length, last, complete = None, first_length, 0, None
    while True:
        level = _level(docs, length, last, sieve, least).select("lang", "key")
        ends = F.substring("key", -1, 1) == F.lit(_END)
        found, opened = level.filter(ends), level.filter(~ends)
        complete = found if complete is None else complete.unionByName(found)
        if opened.count() <= few_open:
            return complete, opened, length
        sieve, length, last = sieve_of(opened, _hashes), 2 * length, length


def kept_counts(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, first_length: int = FIRST_LENGTH, few_open: int = FEW_OPEN
) -> DataFrame:
    """(lang, source, term, n): the occurrences of kept terms; ``docs`` has lang, source and text without NULLs."""
    complete, opened, last = refined(docs, least, first_length, few_open)
    sieve = sieve_of(complete.unionByName(opened), _hashes)

    def key_of(lang: str) -> Callable[[pa.Array], tuple[np.ndarray, pa.Array]]:
        seed = _seed(lang)

        def keys(found: pa.Array) -> tuple[np.ndarray, pa.Array]:
            passes = sieve.passes(hashes_of(found, seed, last))
            return passes, found.filter(pa.array(passes))

        return keys

    def run(rows):
        states: dict[str, tuple[_Terms, Numbers, Sums, Sums]] = {}
        for lang, sources, texts in rows:
            known, named, occurrences, documents = states.get(lang) or states.setdefault(lang, (_Terms(key_of(lang)), Numbers(), Sums(), Sums()))
            found, document = terms(texts)
            key = known.keyed(found)
            source = named.of(sources)
            some = key >= 0
            occurrences.add(source[document[some]], key[some])
            # complete terms are known to be kept; of the others the documents decide
            some[some] = (lengths_of(known.keys.values) > last)[key[some]]
            held_by, held = distinct_pairs(document[some], key[some])
            documents.add(source[held_by], held)
            if sum(len(k) + o.held + d.held for k, _, o, d in states.values()) > 2 * HELD_TERMS:
                yield from handed_on(states)
        yield from handed_on(states)

    def handed_on(states) -> Iterator[pa.RecordBatch]:
        for lang, (known, named, *sums) in states.items():
            names, words = (v.values.cast(pa.string()) for v in (named, known.keys))
            for place, one in enumerate(sums):
                source, key, counts = one.together()
                none = np.zeros(len(counts), np.int64)
                arrays = [pa.array([lang] * len(counts), pa.string()), names.take(pa.array(source)), words.take(pa.array(key))]
                arrays += [pa.array(counts if i == place else none, pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "documents"])
        states.clear()

    counted = _by_lang(docs, run, "lang string, source string, term string, n long, documents long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    counted = stored(counted, "terms")
    whole = complete.select("lang", F.expr("CAST(substr(key, 1, length(key) - 1) AS STRING)").alias("term"))
    longer = counted.filter(F.octet_length("term") > last).groupBy("lang", "term").agg(F.sum("documents").alias("documents"))
    kept = whole.unionByName(longer.filter(F.col("documents") >= least).select("lang", "term"))
    return stored(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "n"), "kept")


def share(count: str, total: str, kept: str) -> Column:
    """The share of a term with ``count`` of ``total`` occurrences among ``kept`` terms; NULL without kept terms."""
    above = f"(CAST({count} AS DECIMAL(20, 0)) + {SMOOTHING}) * CAST({SCALE} AS DECIMAL(18, 0))"
    below = f"(CAST({total} AS DECIMAL(38, 0)) + CAST({SMOOTHING} AS DECIMAL(2, 0)) * CAST({kept} AS DECIMAL(20, 0)))"
    return F.expr(f"1 + ({above}) DIV NULLIF({below}, 0)")


def _pair_sums(used: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the sum of differences of every two sources of a language, a before b.

    ``used`` are the shares p of terms in use (lang, source, term, p); ``groups`` have lang, source, zero (the share of
    a term that does not occur) and kept (the number of kept terms). In a task: one chunk of terms, two blocks of sources.
    """
    sizes = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.max("kept") / CHUNK)).cast("int").alias("chunks"),
    )
    placed = groups.join(sizes, "lang").withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    placed = placed.select("lang", "source", "zero", "own", "blocks", "chunks")
    # a row for the source itself in every chunk, so that sources without terms there are compared as well
    alone = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    alone = alone.select(*placed.columns, "chunk", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"))
    rows = used.join(placed, ["lang", "source"]).withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int"))
    rows = alone.unionByName(rows.select(*alone.columns))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    # numbers instead of texts as group keys, so that they compare as arrays
    rows = rows.select(F.xxhash64("lang").alias("code"), "chunk", "i", "j", "own", "lang", "source", "term", "p", "zero")

    def matrix(sources: list[str], names: np.ndarray, term: np.ndarray, p: np.ndarray, zero: dict, width: int) -> np.ndarray:
        at = {s: k for k, s in enumerate(sources)}
        out = np.repeat(np.array([zero[s] for s in sources], np.int64)[:, None], width, axis=1)
        used = term >= 0
        out[[at[s] for s in names[used]], term[used]] = p[used]
        return out

    def run(batches):
        for group in groups_of(batches, 4):
            i, j = group.column(2)[0].as_py(), group.column(3)[0].as_py()
            own, p = group.column(4).to_numpy(), group.column(8).to_numpy()
            langs = np.array(group.column(5).to_pylist(), object)
            for lang in sorted(set(langs)):  # should two languages share a code
                some = langs == lang
                names = np.array(group.column(6).to_pylist(), object)
                zero = dict(zip(names[some], group.column(9).to_numpy()[some].tolist()))
                codes: dict[str | None, int] = {None: -1}
                term = np.array([codes.setdefault(t, len(codes) - 1) for t in group.column(7).to_pylist()])
                sides = []
                for block in (i, j):
                    mine = some & (own == block)
                    sources = sorted(set(names[mine]))
                    sides.append((sources, matrix(sources, names[mine], term[mine], p[mine], zero, len(codes) - 1)))
                (left, above), (right, below) = sides
                for source, row in zip(left, above):
                    others = [k for k, s in enumerate(right) if i != j or s > source]
                    if not others:
                        continue
                    apart = np.abs(np.array([zero[right[k]] for k in others]) - zero[source])
                    more = np.abs(below[others] - row).sum(axis=1) - apart * row.size
                    ends = [sorted((source, right[k]), key=str.encode) for k in others]
                    arrays = [[lang] * len(others), [a for a, _ in ends], [b for _, b in ends], more, apart]
                    types = [pa.string()] * 3 + [pa.int64()] * 2
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(arrays, types)], names=["lang", "a", "b", "more", "apart"]
                    )

    parts = in_groups(rows, "code", "chunk", "i", "j").mapInArrow(run, "lang string, a string, b string, more long, apart long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("more").alias("more"), F.max("apart").alias("apart"))
    kept = groups.groupBy("lang").agg(F.max("kept").alias("kept"))
    return sums.join(kept, "lang").select("lang", "a", "b", (F.col("more") + F.col("apart") * F.col("kept")).alias("value"))


def audit(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST_DOCUMENTS,
    term_ranks: int = TERM_RANKS,
    first_length: int = FIRST_LENGTH,
    few_open: int = FEW_OPEN,
) -> DataFrame:
    """(lang, source, part, item, value, rank): for every source of a language the other sources by distance
    (part ``pair``) and the terms it uses above their share in the language (part ``term``, the first ``term_ranks``)."""
    docs = _inputs(df, text, lang, source)
    counts = kept_counts(docs, least, first_length, few_open)
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    langs = whole.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("total_lang"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["kept", "total_lang", "total"]).withColumn("n", F.lit(0).cast("long"))
    groups = groups.withColumn("zero", F.coalesce(share("n", "total", "kept"), F.lit(0).cast("long"))).drop("n")
    groups = stored(groups, "groups")
    used = counts.join(groups.select("lang", "source", "total", "total_lang", "kept"), ["lang", "source"])
    used = used.withColumn("p", share("n", "total", "kept"))

    sums = _pair_sums(used.select("lang", "source", "term", "p"), groups)
    both = [sums.select("lang", F.col(a).alias("source"), F.col(b).alias("item"), "value") for a, b in (("a", "b"), ("b", "a"))]
    pairs = both[0].unionByName(both[1]).withColumn("part", F.lit("pair"))

    # a term has a row for each source; one term of a language may be in use by all of them
    named = used.withColumn("_term", F.struct("lang", "term"))
    shares = whole.select(F.struct("lang", "term").alias("_term"), "n_lang")
    above = left_join_unique(named, [shares], "_term").withColumn("q", share("n_lang", "total_lang", "kept"))
    above = above.filter(F.col("p") > F.col("q"))
    above = above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), F.lit("term").alias("part"))

    # terms in two steps: a source may use most terms of a language
    portion = F.pmod(F.xxhash64("item"), F.lit(PORTIONS)).alias("portion")
    first = F.row_number().over(Window.partitionBy("lang", "source", "portion").orderBy(F.desc("value"), "item"))
    above = above.select("*", portion).withColumn("rank", first).filter(F.col("rank") <= term_ranks).drop("portion", "rank")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [part.withColumn("rank", F.row_number().over(order)) for part in (pairs, above)]
    ranked[1] = ranked[1].filter(F.col("rank") <= term_ranks)
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")
