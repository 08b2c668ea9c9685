import random

import brute
import numpy as np

from ledgerloom.llm import language
from ledgerloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain_phrases(text, known):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in known:
            size += 1
        if text[at] not in known:
            size = 1
        at, count = at + size, count + 1
    return count


def test_phrases_against_plain_parsing(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 50)
    draw = random.Random(7)
    for _ in range(40):
        training = {name: "".join(draw.choice(letters) for _ in range(60)) for name, letters in (("x", "ab c"), ("y", "bcd "))}
        parser = language.CrossParser(training)
        texts = ["".join(draw.choice("abcde ") for _ in range(draw.randint(0, 130))) for _ in range(5)]
        read = [language._letters(t) for t in texts]
        for row, name in zip(parser.phrases(read), parser.languages):
            own = "".join(chr(c or 32) for c in language._letters(training[name]))
            known = {own[i:j] for i in range(len(own)) for j in range(i + 1, len(own) + 1)}
            plain = ["".join(chr(c or 32) for c in r) for r in read]
            expected = [sum(plain_phrases(p[i : i + 50], known) for i in range(0, len(p), 50)) for p in plain]
            assert row.tolist() == expected


def test_letters():
    assert "".join(chr(c or 32) for c in language._letters("Ab, 12  Çd\n")) == " ab çd "[1:]
    assert len(language._letters("12 ?!")) == 0 == len(language._letters(""))


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_cross_parsing_language"](spark, FOLDER)
    both = rows.join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    tested = both[both.held_out]
    assert len(both) == 1000 and 150 < len(tested) < 350
    assert (tested.lang == tested.lang_pred).mean() > 0.98
    assert both.score.between(0, 1).all()


def test_hard_rows(spark):
    rows = brute.hard_rows(spark)
    training = language.training_texts(rows)
    assert [name for name, _ in training] == ["en"]
    found = language.identify(rows, training).toPandas()
    assert len(found) == rows.count()
    expected = sum(not t or not any(c.isalpha() for c in t) for t in [*brute.TEXTS, "The end.", "no id", None])
    assert (found.lang_pred == "und").sum() == expected and (found[found.lang_pred == "und"].score == 0).all()
    kept = language.keep_identified(rows, training)
    assert kept.columns == rows.columns and kept.count() == rows.count() - expected
    nothing = language.training_texts(brute.no_rows(spark))
    assert nothing == () and set(language.identify(rows, nothing).toPandas().lang_pred) == {"und"}
    assert language.identify(brute.no_rows(spark), training).count() == 0


def test_ties_go_to_the_first_language():
    parser = language.CrossParser({"b": "same text", "a": "same text"})
    assert parser.predict(["same"]) == (["a"], [0.0])


def test_copies_teach_once(spark):
    df = spark.range(500).selectExpr("if(id < 400, 'copy of one text', concat('text number ', id)) AS text", "'en' AS lang")
    ((_, learned),) = language.training_texts(df)
    assert learned.count("copy of one text") == 1


def test_held_out_is_a_quarter(spark):
    import zlib

    rows = spark.range(1000).select("id", language.held_out("id").alias("out")).collect()
    assert [r["out"] for r in rows] == [zlib.crc32(str(r["id"]).encode()) % 4 == 2 for r in rows]
    assert np.mean([r["out"] for r in rows]) < 0.35


def test_texts_of_an_unlearned_language_go(spark):
    """The language left out, and an unknown script, go; held-out texts of the learned ones stay."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    learned = documents.filter("lang != 'fr'").filter(~language.held_out("doc_id"))
    training = language.training_texts(learned)
    assert [name for name, _ in training] == ["de", "en", "es"]
    greek = spark.createDataFrame([(-1, "Ο γρήγορος καφέ σκύλος πηδά πάνω από τον τεμπέλη σκύλο και φεύγει", "el")], documents.schema)
    tested = documents.filter(language.held_out("doc_id")).unionByName(greek)
    kept = language.keep_identified(tested, training, limits=language.limits(learned, training)).toPandas()
    tested = tested.toPandas()
    assert (kept.lang != "el").all()
    assert (kept.lang == "fr").sum() <= 0.05 * (tested.lang == "fr").sum()
    assert kept.lang.isin(["de", "en", "es"]).sum() >= 0.98 * tested.lang.isin(["de", "en", "es"]).sum()
    print("unlearned kept", (kept.lang == "fr").sum(), "of", (tested.lang == "fr").sum())
    print("learned kept", kept.lang.isin(["de", "en", "es"]).sum(), "of", tested.lang.isin(["de", "en", "es"]).sum())


def test_words_of_all_texts_are_learned(spark):
    """No few texts, and not only their beginnings: a word at the end of every tenth long text is learned."""
    draw = random.Random(3)
    letters = "abcdefghij"
    rows = [
        (" ".join("".join(draw.choice(letters) for _ in range(9)) for _ in range(300)) + (" zyzzyva" if i % 10 == 0 else ""), "en")
        for i in range(200)
    ]
    ((_, learned),) = language.training_texts(spark.createDataFrame(rows, "text string, lang string"))
    assert "zyzzyva" in learned.split() and len(learned) <= language.TRAINING_CHARACTERS


def test_limits_are_those_of_all_texts(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("abcd   ") for _ in range(draw.randint(20, 200))) for _ in range(1000)]
    df = spark.createDataFrame([(t, "en") for t in texts + texts[:300]], "text string, lang string")
    training = language.training_texts(df)
    found = language.limits(df, training)["en"]
    _, leads, bits = language._parser(training).judged(texts)
    assert found == (sorted(bits)[989], sorted(leads)[9])


def test_words_and_copies_are_counted(spark):
    texts = ["one two three", "two three", "three", "three", "three", "donaudampfschifffahrt " * 4]
    df = spark.createDataFrame([(t, "en") for t in texts] + [("x", None), (None, "en")], "text string, lang string")
    assert language._commonest(language._labelled(df, "text", "lang")) == {
        "en": ["donaudampfsc", "hifffahrt", "three", "two", "one"]
    }
