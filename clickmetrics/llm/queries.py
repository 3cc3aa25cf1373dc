"""The named queries of this subpackage, each from a session and the folder of the tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from clickmetrics.llm import (
    alignment,
    collocations,
    decontaminate,
    exact_topk,
    ngram_join,
    quality,
    secret_scan,
    sentence_pieces,
    sharding,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers of a session that was started elsewhere find this package too.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"), n=3, percent=90)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search_all(table(spark, sf_dir, "embeddings"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.through_files(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def op12_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sentence_pieces, op2_suffix_dedup, op3_decontaminate, op4_ngram_join, op5_secret_scan, op6_toxicity, op7_sharding, op8_exact_topk, op9_token_files, op10_token_counts, op11_token_alignment, op12_quality_votes, op13_collocations)}

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM docs),
strings AS (SELECT r, doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS s FROM starts),
least_ids AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s),
marks AS (SELECT r, i FROM strings JOIN least_ids USING (s) WHERE least < doc_id),
-- A run goes on as long as the next covered string starts inside it or right behind it.
breaks AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 50, true) AS begins FROM marks),
numbered AS (SELECT r, i, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS run FROM breaks),
runs AS (SELECT r, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY r, run),
lists AS (SELECT r, list(a ORDER BY a) AS froms, list(b ORDER BY a) AS tos FROM runs GROUP BY r),
cut AS (
    SELECT doc_id, h, length(h) // 2 AS n, coalesce(froms, []) AS froms, coalesce(tos, []) AS tos
    FROM docs LEFT JOIN lists USING (r))
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes,
       CAST(coalesce(list_sum(tos) - list_sum(froms), 0) AS BIGINT) AS n_removed, CAST(len(froms) AS BIGINT) AS n_spans,
       sha256(unhex(array_to_string(list_transform(range(0, len(froms) + 1), lambda k: substr(
           h, CAST(2 * CASE WHEN k = 0 THEN 0 ELSE tos[k] END + 1 AS BIGINT),
           CAST(2 * (CASE WHEN k = len(froms) THEN n ELSE froms[k + 1] END - CASE WHEN k = 0 THEN 0 ELSE tos[k] END) AS BIGINT))),
           ''))) AS kept_sha256
FROM cut""",
    "op3_decontaminate": """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents),
items AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark),
item_starts AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM item_starts),
lengths AS (SELECT DISTINCT n FROM windows),
doc_starts AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN lengths ON len(w) >= n),
phrases AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM doc_starts),
found AS (SELECT r, n, i, item_id FROM phrases JOIN windows USING (n, phrase)),
hit AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS word FROM found) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op4_ngram_join": """
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT r, doc_id, list_sort(list_distinct(list_transform(range(1, greatest(2, len(w) - 1)),
                                                             lambda i: array_to_string(w[i:i + 2], ' ')))) AS s
    FROM docs WHERE len(w) > 0),
-- Documents of equal sets are one class.
classes AS (SELECT s, row_number() OVER () AS c, len(s) AS n, min(doc_id) AS least FROM sets GROUP BY s),
grams AS (SELECT c, n, unnest(s) AS gram FROM classes),
pairs AS (
    SELECT x.c AS a, y.c AS b, x.n AS m, y.n AS n, count(*) AS common
    FROM grams x JOIN grams y ON x.gram = y.gram AND x.c < y.c AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
    GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 90 * (m + n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT c, c AS d FROM classes
    UNION
    SELECT reach.c, edges.b FROM reach JOIN edges ON reach.d = edges.a),
components AS (SELECT reach.c, min(classes.least) AS component_id FROM reach JOIN classes ON classes.c = reach.d GROUP BY reach.c)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM docs LEFT JOIN (SELECT r, s FROM sets) USING (r) LEFT JOIN classes USING (s) LEFT JOIN components USING (c)""",
    "op8_exact_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op13_collocations": """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM starts),
counts AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM grams GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
inner_starts AS (SELECT lang, a, k, w, unnest(range(1, k + 1)) AS i FROM candidates),
inside AS (
    SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(2, least(k - 1, k - i + 1) + 1)) AS m FROM inner_starts)),
longer AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
kept AS (
    SELECT c.* FROM candidates c LEFT JOIN longer USING (lang, phrase)
    WHERE most IS NULL OR CAST(most AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
           CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
    FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
