"""The contract queries of the subpackage: thin wrappers that derive digest columns from the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, chat, exact, minhash, negatives, pack, pii, pq, repeats, secrets, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_table(spark, sf_dir, "conversations"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_vectors(_table(spark, sf_dir, "embeddings"), 0.9)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False).drop("ids")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), 0)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(_table(spark, sf_dir, "documents"), 35)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = [op1_pii, op2_chat, op3_embedding_dedup, op4_packing, op5_exact_dedup, op6_bpe, op7_minhash, op8_toxicity, op9_warc, op10_secrets, op11_hard_negatives, op12_alignment, op13_repeats]
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


_COMPONENTS = """
walk AS (SELECT a AS node, b AS reached FROM linked UNION SELECT w.node, l.b FROM walk w JOIN linked l ON w.reached = l.a),
low AS (SELECT node, min(reached) AS low FROM walk GROUP BY node)
"""

_EXACT = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{exact.UPPER}', '{exact.LOWER}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256 FROM n JOIN g ON n.norm = g.norm
"""

_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
linked AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.9),
{_COMPONENTS},
n AS (SELECT a, count(*) AS c FROM linked GROUP BY a)
SELECT v.vec_id, coalesce(n.c, 0) AS n_links, least(v.vec_id, coalesce(low.low, v.vec_id)) AS component_id, v.vec_id <= coalesce(low.low, v.vec_id) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN low ON low.node = v.vec_id
"""

_SHINGLES = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{exact.UPPER}', '{exact.LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x : x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i : w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
many AS (SELECT s FROM s GROUP BY s HAVING count(*) > 1),
m AS (SELECT s.* FROM s JOIN many ON s.s = many.s),
half AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM m x JOIN m y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
near AS (SELECT a, b FROM half JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
linked AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
{_COMPONENTS}
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(low.low, w.doc_id)) AS component_id, w.doc_id <= coalesce(low.low, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN low ON low.node = w.doc_id
"""


#: A window of 35 words is one string here: words hold no blank, so equal strings are equal windows.
_REPEATS = """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x : x <> '') AS w FROM documents),
x AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM t WHERE len(w) >= 35),
y AS (SELECT r, i, array_to_string(w[i : i + 34], ' ') AS s FROM x),
many AS (SELECT s FROM y GROUP BY s HAVING count(*) > 1),
hit AS (SELECT DISTINCT y.r, y.i + k.k AS j FROM y JOIN many ON y.s = many.s, (SELECT unnest(range(0, 35)) AS k) k),
gone AS (SELECT r, list(j) AS js FROM hit GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(len(js), 0) AS n_removed,
    sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda j : NOT list_contains(js, j)), lambda j : w[j]) END, ' ')) AS kept_sha256
FROM t LEFT JOIN gone ON t.r = gone.r
"""

_NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x : floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT a, b AS p, score AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.p AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.b) AS INTEGER) AS rank, s.b AS negative_id, p.ps AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 100 * s.score BETWEEN 30 * p.ps AND 90 * p.ps
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": chat.SQL, "op3_embedding_dedup": _VECTORS, "op5_exact_dedup": _EXACT, "op7_minhash": _SHINGLES, "op11_hard_negatives": _NEGATIVES, "op13_repeats": _REPEATS}
