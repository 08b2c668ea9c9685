"""One query for each operator over its whole table, and the pipeline.

Queries with tokenizers, hashes of ids or trained models have no SQL; the tests compare them with brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, collocations, curves, divergence, embeddings, language, packing, pii, quality, simhash, spans, token_counts, token_files, toxicity
from ledgerloom.llm.registry import ORACLES, QUERIES, light_query, query, table
from ledgerloom.session import scratch_folder

__all__ = ["ORACLES", "QUERIES"]


@query
def op1_quality_isolation_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.drop("features")


@light_query
def op2_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every text, decode the ids, and digest both."""
    ids = bpe.encode(table(spark, folder, "documents"))
    both = bpe.decode(ids, keep=("doc_id", "ids"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_edit_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts before and after three kinds of edits: a line with the source is put in front, every
    number becomes a zero, and a line break ends the text."""
    documents = table(spark, folder, "documents")
    state = token_counts.build(documents, keep=("doc_id", "source")).withColumnRenamed("n_tokens", "n_tokens_before")
    state = state.withColumns(dict(zip(("_values", "_gaps"), spans.matches(F.col("text"), "[0-9]+"))))

    def change(start, stop, replacement):
        return F.struct(start.alias("start"), stop.alias("stop"), replacement.alias("replacement"))

    numbers = spans.placed(F.col("_values"), F.col("_gaps"))
    front = change(F.lit(0), F.lit(0), F.concat(F.lit("source: "), F.coalesce("source", F.lit("")), F.lit("\n")))
    end = F.length("text")
    edits = F.concat(
        F.array(front),
        F.transform(numbers, lambda s: change(s["start"], s["stop"], F.lit("0"))),
        F.array(change(end, end, F.lit("\n"))),
    )
    counted = token_counts.apply_edits(state, edits, keep=("doc_id", "n_tokens_before"))
    return counted.select("doc_id", "n_tokens_before", "n_edits", "n_tokens", "n_reencoded", F.length("text").cast("long").alias("n_chars"))


@query
def op4_pii_boosted_candidates(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[pii.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


@query
def op5_cross_parsing_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").withColumn("held_out", language.held_out("doc_id"))
    training = language.training_texts(documents.filter("NOT held_out"))
    return language.identify(documents, training, keep=("doc_id", "held_out"))


@light_query
def op6_hierarchical_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op8_max_segment_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").withColumn("held_out", toxicity.held_out("doc_id"))
    known = table(spark, folder, "labels").filter(~toxicity.held_out("doc_id"))
    model = toxicity.train(documents, known)
    return toxicity.score(documents, model, keep=("doc_id", "held_out"))


ORACLES["op9_embedding_nn_descent"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
    SELECT vec_id AS node, vec_id AS least FROM embeddings
    UNION SELECT l.b, r.least FROM reached r JOIN links l ON l.a = r.node
), named AS (
    SELECT node, min(least) AS component_id FROM reached GROUP BY node
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, n.component_id, e.vec_id = n.component_id AS kept
FROM embeddings e JOIN named n ON n.node = e.vec_id
"""


@query
def op9_embedding_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


@light_query
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Write all ids to shards in order of doc_id, then read every document back by its key."""
    documents = table(spark, folder, "documents")
    back = token_files.read(token_files.write(documents, scratch_folder(spark, "token-files")))
    return back.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query
def op7_simhash_deletion_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", simhash.hexadecimal(F.col("fingerprint")))


@light_query
def op11_iceberg_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


ORACLES["op11_iceberg_source_divergence"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), counted AS (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs
    FROM (SELECT doc, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL
), whole AS (
    SELECT lang, term, sum(n) AS n FROM counted GROUP BY ALL HAVING sum(docs) >= 30
), langs AS (
    SELECT g.lang, coalesce(v, 0) AS v, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang FROM docs) g LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS total FROM whole GROUP BY lang) w USING (lang)
), groups AS (
    SELECT g.lang, g.source, v, coalesce(sum(n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g JOIN langs USING (lang)
    LEFT JOIN (SELECT c.* FROM counted c JOIN whole USING (lang, term)) k ON k.lang = g.lang AND k.source = g.source
    GROUP BY ALL
), shares AS (
    SELECT g.lang, g.source, w.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total::HUGEINT + 5 * g.v) AS p,
        1 + (1000000000::HUGEINT * (w.n::HUGEINT + 5)) // (l.total::HUGEINT + 5 * l.v) AS q
    FROM groups g JOIN langs l USING (lang) JOIN whole w ON w.lang = g.lang
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
    ) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT * FROM (
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM found
) WHERE part = 'pair' OR rank <= 50
"""


@light_query
def op12_prefix_free_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"))


ORACLES["op12_prefix_free_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), counted AS (
    SELECT lang, k, phrase, count(*) AS f
    FROM (
        SELECT lang, 1 AS k, w[i] AS phrase FROM placed
        UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM placed WHERE i + 1 <= len(w)
        UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM placed WHERE i + 2 <= len(w)
    ) GROUP BY ALL
), sizes AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= 10
), longer AS (
    SELECT lang, phrase, max(a) AS most
    FROM (
        SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE k = 3
        UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE k = 3
    ) GROUP BY ALL
), cuts AS (
    SELECT lang, phrase, a, 1 AS cut, w[1] AS head, CASE WHEN k = 2 THEN w[2] ELSE w[2] || ' ' || w[3] END AS tail FROM candidates
    UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE k = 3
), scored AS (
    SELECT c.*, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail
), best AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored) WHERE place = 1
)
SELECT * FROM (
    SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
    FROM best b JOIN sizes s ON s.lang = b.lang LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
    WHERE g.most IS NULL OR 100 * g.most < 50 * a
) WHERE rank <= 2000
"""


@light_query
def op13_shifted_curves(spark: SparkSession, folder: str) -> DataFrame:
    return curves.search(table(spark, folder, "embeddings"), curves.every("vec_id", 100))
