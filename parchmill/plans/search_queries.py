"""Registered queries of the stored indexes: vectors by lists, keywords by posting blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.paths import shared_dir
from ..operators import keywords, vectors
from .answer_queries import bm25_sql
from .base import SQL, register, table


def _vector_index(spark, sf_dir) -> vectors.VectorIndex:
    index, rows = vectors.VectorIndex(spark, shared_dir(spark, "vectors"), "label long"), table(spark, sf_dir, "embeddings")
    index.fit(rows)
    index.put(rows.select("vec_id", "embedding", F.col("label").cast("long").alias("label")))
    return index


def _asked(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@register("""
SELECT count(*) AS n_queries, sum(n)::BIGINT AS n_wanted, TRUE AS recall_reached FROM (
  SELECT q.vec_id, least(10, count(v.vec_id)) AS n FROM embeddings q LEFT JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id)
""")
def ann_recall(spark, sf_dir):
    """The vector index asked for every twentieth vector: how many neighbours an exact search has, and whether 90 of 100 of them are found."""
    asked, index = _asked(spark, sf_dir), _vector_index(spark, sf_dir)
    exact = index.search(asked, exact=True).select("query_id", "vec_id")
    found = index.search(asked).select("query_id", "vec_id", F.lit(1).alias("found"))
    each = asked.select("query_id").join(exact, "query_id", "left").join(found, ["query_id", "vec_id"], "left")
    return each.agg(F.count_distinct("query_id").alias("n_queries"), F.count("vec_id").alias("n_wanted"), (F.sum(F.coalesce("found", F.lit(0))) >= 0.9 * F.count("vec_id")).alias("recall_reached"))


@register("""
WITH v AS (SELECT vec_id, label, CASE WHEN vec_id % 7 = 4 THEN list_transform(embedding, lambda x: -x::DOUBLE) ELSE embedding::DOUBLE[] END AS e FROM embeddings WHERE vec_id % 7 <> 3 AND label % 3 = 1),
s AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.e), 6) AS score FROM embeddings q, v WHERE q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, vec_id, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
""")
def ann_filtered(spark, sf_dir):
    """The index after a commit that deletes some vectors and turns others round, asked under a filter: all lists, so the result is exact."""
    index, rows = _vector_index(spark, sf_dir), table(spark, sf_dir, "embeddings")
    turned = rows.where("vec_id % 7 = 4").select("vec_id", F.transform("embedding", lambda x: -x).alias("embedding"), F.col("label").cast("long").alias("label"))
    index.put(turned, rows.where("vec_id % 7 = 3").select("vec_id"))
    return index.search(_asked(spark, sf_dir), where=F.col("label") % 3 == 1, exact=True)


def _keyword_index(spark, sf_dir, documents=None) -> keywords.KeywordIndex:
    index = keywords.KeywordIndex(spark, shared_dir(spark, "keywords"), extra="lang string")
    index.put((table(spark, sf_dir, "documents") if documents is None else documents).select("doc_id", "text", "lang"))
    return index


@register(SQL["bm25_topk"])
def keyword_index_topk(spark, sf_dir):
    """The benchmark's passages as questions to the stored keyword index."""
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return _keyword_index(spark, sf_dir).search(asked).withColumn("score", F.round("score", 4))


@register(bm25_sql().replace("FROM documents)", "FROM (SELECT doc_id, lang, CASE WHEN doc_id % 5 = 2 THEN 'changed ' || text ELSE text END AS text FROM documents WHERE doc_id % 5 <> 1))").replace(
    "b AS (SELECT *,", "w AS (SELECT s.* FROM s JOIN documents d USING (doc_id) WHERE d.lang <> 'en'), b AS (SELECT *,").replace("DESC, doc_id) AS rank FROM s)", "DESC, doc_id) AS rank FROM w)")
    + "SELECT query_id, doc_id, score, rank::INT AS rank FROM b WHERE rank <= 10")
def keyword_index_changed(spark, sf_dir):
    """The index after a commit that deletes a fifth of the documents and changes another, asked for documents that aren't English."""
    documents = table(spark, sf_dir, "documents")
    index = _keyword_index(spark, sf_dir)
    changed = documents.where("doc_id % 5 = 2").select("doc_id", F.concat(F.lit("changed "), "text").alias("text"), "lang")
    index.put(changed, documents.where("doc_id % 5 = 1").select("doc_id"))
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return index.search(asked, where=F.col("lang") != "en")
