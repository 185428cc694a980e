"""Registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import ann, chat, decontaminate, hard_negatives, line_dedup, packing, paragraphs, phrases, quality, simhash_dedup, suffix_dedup, topk, toxicity
from stationflow.llm.common import table


def op1_binary_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of at most 1024 ids."""
    return packing.pack(table(spark, folder, "documents"), with_ids=False)


def op2_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes that remain of every document without repeated 400-byte strings."""
    return suffix_dedup.deduplicate(table(spark, folder, "documents"), with_text=False)


def op3_simhash_covering(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash_dedup.near_duplicates(table(spark, folder, "documents"))


def op4_nb_ngram_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op5_rule_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


def op6_voronoi_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best partners of every twentieth vector among all vectors."""
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Class of every line of every document, and whether it is kept."""
    return line_dedup.duplicate_lines(table(spark, folder, "documents"))


def op8_perspective_rotation(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as seen by each of its participants."""
    masks = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["begin"], m["end"])), " ")
    rotated = chat.rotate(table(spark, folder, "conversations"))
    return rotated.select("conv_id", "participant", "part", F.col("n_turns").cast("long").alias("n_turns"), "text", masks.alias("masks"))


def op9_simhash_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_paragraph_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs that several documents share, and the one occurrence that is kept."""
    return paragraphs.duplicate_paragraphs(table(spark, folder, "documents"))


def op11_hnsw_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest rows found for every fiftieth vector among all vectors."""
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_bond_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of other labels that every hundredth vector scores almost as high as its own label's best."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_setm_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 strongest collocations of every language."""
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_binary_packing,
        op2_suffix_arrays,
        op3_simhash_covering,
        op4_nb_ngram_toxicity,
        op5_rule_quality,
        op6_voronoi_topk,
        op7_fuzzy_lines,
        op8_perspective_rotation,
        op9_simhash_windows,
        op10_paragraph_minhash,
        op11_hnsw_shards,
        op12_bond_negatives,
        op13_setm_phrases,
    )
}
SQL: dict[str, str] = {
    "op8_perspective_rotation": r"""
        WITH t AS (
          SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name, said) - 1) // 256 AS part
          FROM (SELECT conv_id, turn, coalesce(role, 'unknown') AS name, coalesce(text, '') AS said FROM conversations)),
        p AS (SELECT DISTINCT conv_id, name AS participant FROM t),
        x AS (
          SELECT t.*, participant, name = participant AS own,
            CASE WHEN name = participant THEN '<|assistant|>' ELSE '<|user name=' || replace(name, '<|', '<\|') || '|>' END || chr(10) AS head,
            replace(said, '<|', '<\|') || '<|end|>' || chr(10) AS body
          FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
        y AS (
          SELECT *, sum(length(head) + length(body)) OVER (
            PARTITION BY conv_id, participant, part ORDER BY turn NULLS FIRST, name, said ROWS UNBOUNDED PRECEDING) AS e
          FROM x)
        SELECT conv_id, participant, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY turn NULLS FIRST, name, said) AS text,
          coalesce(string_agg(CASE WHEN own THEN CAST(e - length(body) AS VARCHAR) || ':' || CAST(e AS VARCHAR) END, ' ' ORDER BY turn NULLS FIRST, name, said), '') AS masks
        FROM y GROUP BY conv_id, participant, part
    """,
    "op6_voronoi_topk": """
        WITH v AS (
          SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
          FROM embeddings
          WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op13_setm_phrases": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        split AS (
          SELECT row_number() OVER () AS piece_id, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
        w1 AS (SELECT piece_id, lang, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM split WHERE len(words) > 0),
        w3 AS (SELECT lang, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w1 WINDOW o AS (PARTITION BY piece_id ORDER BY pos)),
        n AS (SELECT lang, CAST(count(*) AS BIGINT) AS n FROM w1 GROUP BY lang),
        f1 AS (SELECT lang, w, count(*) AS f FROM w3 GROUP BY ALL),
        f2 AS (SELECT lang, w, w2, count(*) AS f FROM w3 WHERE w2 IS NOT NULL GROUP BY ALL),
        f3 AS (SELECT lang, w, w2, w3, count(*) AS f FROM w3 WHERE w3 IS NOT NULL GROUP BY ALL),
        cuts AS (
          SELECT f2.lang, f2.w || ' ' || f2.w2 AS phrase, f2.f AS a, 1 AS k, p.f AS l, q.f AS r
          FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.w = f2.w JOIN f1 q ON q.lang = f2.lang AND q.w = f2.w2 WHERE f2.f >= 10
            AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w = f2.w AND f3.w2 = f2.w2 AND f3.f >= 10 AND 100 * f3.f >= 50 * f2.f)
            AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w2 = f2.w AND f3.w3 = f2.w2 AND f3.f >= 10 AND 100 * f3.f >= 50 * f2.f)
          UNION ALL
          SELECT f3.lang, f3.w || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 1, p.f, q.f
          FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.w = f3.w JOIN f2 q ON q.lang = f3.lang AND q.w = f3.w2 AND q.w2 = f3.w3 WHERE f3.f >= 10
          UNION ALL
          SELECT f3.lang, f3.w || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 2, p.f, q.f
          FROM f3 JOIN f2 p ON p.lang = f3.lang AND p.w = f3.w AND p.w2 = f3.w2 JOIN f1 q ON q.lang = f3.lang AND q.w = f3.w3 WHERE f3.f >= 10),
        scored AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank FROM lowest)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
    """,
    "op12_bond_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
          SELECT q.vec_id AS anchor_id, c.vec_id AS vec_id, q.label = c.label AS same,
            CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (
          SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
            CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
          FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
    """,
}
