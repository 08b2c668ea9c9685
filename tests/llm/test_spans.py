import random
import re
import time
from itertools import accumulate

import brute
from pyspark.sql import functions as F

from ledgerloom.llm import pii, spans, token_counts
from ledgerloom.llm.bpe import RANKS
from ledgerloom.llm.token_counts import counts_of

SPAN = "array<struct<start:int,kind:int,stop:int>>"


def test_before_each(spark):
    draw = random.Random(2)
    rows = [[draw.randint(-9, 9) for _ in range(n)] for n in (0, 1, 2, 3, 4, 7, 16, 17, 100)]
    df = spark.createDataFrame([(r,) for r in rows], "v array<int>")
    sums, most = spans.before_each(F.col("v"), 0, lambda a, b: a + b), spans.before_each(F.col("v"), -1, F.greatest)
    for r in df.select("v", sums.alias("sums"), most.alias("most")).collect():
        assert r["sums"] == list(accumulate(r["v"], initial=0)) and r["most"] == list(accumulate(r["v"], max, initial=-1))


def test_places_against_plain_search(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choice("1 2ab😀") for _ in range(n)) for n in (0, 1, 5, 50, 500) for _ in range(6)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", spans.placed(*spans.matches(F.col("t"), "[0-9]+")).alias("p")).collect():
        found = [(m.start(), m.end(), m[0], r["t"][: m.start()], r["t"][m.end() : m.end() + 1]) for m in re.finditer("[0-9]+", r["t"])]
        assert [(p["start"], p["stop"], p["value"]) for p in r["p"]] == [f[:3] for f in found]
        assert all(f[3].endswith(p["before"]) or p["before"] == "" for p, f in zip(r["p"], found))


def test_spans_against_plain_loops(spark):
    draw = random.Random(6)

    def some(n):
        return sorted((s := draw.randint(0, 60), draw.randint(0, 3), s + draw.randint(1, 8)) for _ in range(n))

    rows = [("".join(chr(97 + i % 26) for i in range(70)), some(n), some(m)) for n in (0, 1, 3, 12) for m in (0, 1, 2, 6) for _ in range(5)]
    df = spark.createDataFrame(rows, f"t string, a {SPAN}, b {SPAN}")
    tags = F.array(*[F.lit(f"<{i}>") for i in range(4)])
    found = df.select("t", "a", "b", spans.apart(F.col("a"), F.col("b")).alias("apart"), spans.leading(F.col("a")).alias("leading"), spans.replaced(F.col("t"), F.col("a"), lambda k: F.get(tags, k)).alias("out"))
    for r in found.collect():
        a, b = ([tuple(s) for s in r[c]] for c in "ab")
        assert [tuple(s) for s in r["apart"]] == [s for s in a if not any(s[0] < o[2] and o[0] < s[2] for o in b)]
        reached = list(accumulate((s[2] for s in a), max, initial=-1))
        assert [tuple(s) for s in r["leading"]] == [s for s, far in zip(a, reached) if far <= s[0]]
        out, at = "", 0
        for start, kind, stop in a:
            if start >= at:
                out += r["t"][at:start] + f"<{kind}>"
            at = max(at, stop)
        assert r["out"] == out + r["t"][at:]


def test_a_text_of_many_numbers_takes_seconds(spark):
    """One long log: positions, rules, candidates, replacements and edits, none with the square of the matches."""
    text = " ".join(f"{i * 7919 % 100_000_007} at 10.0.{i % 300}.{i % 256}" for i in range(4_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begun = time.monotonic()
    found = pii.find(df).select("doc_id", pii.listed(F.col("base")).alias("base")).first()
    assert found["base"] == brute.personal_data(text)
    assert len(pii.redact(df).first()["text"]) < len(text)
    assert time.monotonic() - begun < 120
    begun = time.monotonic()
    numbers = spans.placed(*spans.matches(F.col("text"), "[0-9]+"))
    edits = F.transform(numbers, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit("0").alias("replacement")))
    after = token_counts.apply_edits(token_counts.build(df), edits).first()
    assert after["text"] == re.sub("[0-9]+", "0", text) and after["n_edits"] == 20_000
    counts = counts_of(RANKS, __import__("public_tokenizers").PATTERN)
    assert after["n_tokens"] == sum(counts.codec.sizes(counts.split(after["text"])))
    assert time.monotonic() - begun < 120
