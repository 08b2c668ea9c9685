import re
from collections import Counter

import brute
import numpy as np
import pytest
from compare import connect, duck_result, spark_result

from ledgerloom.llm import collocations
from ledgerloom.llm.queries import ORACLES, QUERIES

NAME = "op12_prefix_free_collocations"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, most):
    """By definition: (lang, rank, phrase, a, l, r, n, score) of rows (lang, text)."""
    counts = {}
    for lang, text in rows:
        counted = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            counted.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found, n = [], sum(c for p, c in f.items() if len(p) == 1)
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            longer = [c for p, c in f.items() if len(p) > len(phrase) and c >= least and phrase in (p[:2], p[1:])]
            if any(100 * c >= 50 * a for c in longer):
                continue
            cuts = [(10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, r, n, -s) for i, (s, a, p, left, r) in enumerate(sorted(found)[:most])]
    return sorted(out)


@pytest.fixture(scope="module")
def duck():
    return connect("/root/testdata/sf0.01")


def test_query(spark, duck):
    schema, rows = spark_result(QUERIES[NAME](spark, "/root/testdata/sf0.01"))
    expected_schema, expected = duck_result(duck, ORACLES[NAME])
    assert schema == expected_schema and rows == expected


@pytest.mark.parametrize("trigger,most", [(16, 512), (1, 512), (2, 3), (1000, 1), (1000, 7)])
def test_against_definition(spark, monkeypatch, trigger, most):
    """Every parse gives the same counts, however long its chunks are."""
    monkeypatch.setattr(collocations, "MOST_WORDS", most)
    monkeypatch.setattr(collocations, "AT_ONCE", 2000)
    draw = np.random.default_rng(trigger)
    words = "New York Times new york of the, the a. b É\té \x1fodd c! d;e".split(" ")
    rows = [(["en", "de", None, "a\nb"][i % 4], [" ".join(draw.choice(words, i % 40)), None][i % 29 == 0]) for i in range(300)]
    rows += [("en", "same words " * 500), ("en", "x" * 100_000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations.mine(df, least=4, ranks=25, trigger=trigger).collect())) == plain(rows, 4, 25)


def test_copies_are_one_entry(spark):
    """A passage is cut alike in different surroundings."""
    draw = np.random.default_rng(5)
    passage = " ".join(f"w{i}" for i in draw.integers(0, 10**6, 2000))
    rows = [("en", f"{i} {i * i} {passage} {i + 7}") for i in range(50)]
    found = collocations.parse(spark.createDataFrame(rows, "lang string, text string")).collect()
    assert sum(r["copies"] for r in found if r["copies"] == 50) > 40 * 50
    assert len([r for r in found if r["copies"] < 50]) < 4 * 50


def test_cuts():
    def cut(hashes, text, *options):
        return [c.tolist() for c in collocations.cuts(np.array(hashes, np.uint64), np.array(text), *options)]

    # two breaks end each text; all places are triggers, or none
    assert cut([0] * 7, [0, 0, 0, 0, 0, 1, 1], 1) == [[0, 1, 2], [1, 2, 3]]
    assert cut(range(1, 13), [0] * 12, 1 << 40, 4) == [[0, 4, 8], [4, 8, 10]]
    assert cut(range(1, 13), [0] * 5 + [2] * 7, 1 << 40, 100) == [[0, 5], [3, 10]]
    assert cut([], []) == [[], []]


def test_scores_of_large_counts(spark):
    df = spark.range(1).selectExpr("999999999999999 AS a", "1000000000000003 AS l", "1999999999999997 AS r")
    assert df.select(collocations.score("a", "l", "r")).first()[0] == 10**6 * 999999999999999**2 // (1000000000000003 * 1999999999999997)


def test_hard_rows(spark):
    rows = brute.hard_rows(spark)
    texts = [(r["lang"], r["text"]) for r in rows.collect()]
    assert sorted(map(tuple, collocations.mine(rows, least=2).collect())) == plain(texts, 2, 2000)
    none = collocations.mine(brute.no_rows(spark))
    assert none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and none.count() == 0
