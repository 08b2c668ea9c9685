import re
from collections import Counter, defaultdict

import brute
import pytest
from compare import connect, duck_result, spark_result

from ledgerloom.llm import divergence
from ledgerloom.llm.queries import ORACLES, QUERIES

NAME = "op11_iceberg_source_divergence"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least):
    """By definition: (lang, source, part, item, value, rank) of rows (lang, source, text)."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for lang, source, text in rows]
    holding, counts = Counter(), defaultdict(Counter)
    for lang, source, terms in docs:
        holding.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for (one, t), n in holding.items() if one == lang and n >= least]
        sources = [s for one, s in counts if one == lang]
        used = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        used[None] = {t: sum(used[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for t, n in c.items()} for s, c in used.items()}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - p[None][t], t) for t in kept if used[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


@pytest.fixture(scope="module")
def duck():
    return connect("/root/testdata/sf0.01")


def test_query(spark, duck):
    schema, rows = spark_result(QUERIES[NAME](spark, "/root/testdata/sf0.01"))
    expected_schema, expected = duck_result(duck, ORACLES[NAME])
    assert schema == expected_schema and rows == expected


@pytest.mark.parametrize("first_length,few_open,block,chunk", [(4, 0, 256, 4096), (1, 0, 2, 3), (2, 3, 1, 1), (64, 100, 3, 2)])
def test_against_definition(spark, monkeypatch, first_length, few_open, block, chunk):
    """Prefixes of other lengths, cut inside characters too, and sources and terms in several blocks."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    words = "a A ab abc abcd abcde Abcdef ééé éé é üb ünïcödé verylongwordverylongword verylongwordverylongwore x1y İ".split()
    rows = []
    for i in range(120):
        text = " ".join(words[(i * j + j * j) % len(words)] + "," * (j % 2) for j in range(i % 11))
        rows.append((["en", "de", None][i % 3 if i % 5 else 2], [f"s{i % 7}", None][i % 13 == 0], [text, None][i % 17 == 0]))
    rows += [("en", "silent", "123 456"), ("xx", "only", "rare"), ("xx", "other", ""), ("", "", "a" * 100_000)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    found = divergence.audit(df, least=5, first_length=first_length, few_open=few_open)
    assert sorted(map(tuple, found.collect())) == plain(rows, 5)


def test_tables_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    monkeypatch.setattr(divergence, "AT_ONCE", 100)
    rows = [("en", f"s{i % 3}", f"one two three four w{i % 4} w{i % 7}") for i in range(60)]
    found = divergence.audit(spark.createDataFrame(rows, "lang string, source string, text string"), least=5, few_open=0)
    assert sorted(map(tuple, found.collect())) == plain(rows, 5)


def test_shares_of_large_counts(spark):
    df = spark.range(1).selectExpr("999999999999999 AS n", "3999999999999997 AS total", "123456789L AS kept", "0L AS none")
    row = df.select(divergence.share("n", "total", "kept").alias("p"), divergence.share("none", "none", "none").alias("empty")).first()
    assert row["p"] == 1 + 10**9 * (999999999999999 + 5) // (3999999999999997 + 5 * 123456789) and row["empty"] is None


def test_hard_rows(spark):
    rows = brute.hard_rows(spark)
    texts = [(r["lang"], r["source"], r["text"]) for r in rows.collect()]
    assert sorted(map(tuple, divergence.audit(rows, least=2).collect())) == plain(texts, 2)
    none = divergence.audit(brute.no_rows(spark))
    assert none.columns == ["lang", "source", "part", "item", "value", "rank"] and none.count() == 0
