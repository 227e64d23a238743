"""Retrieval queries: every benchmark passage is a query over all ticket chunks."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.registry import cte, query, rnd
from catalog.texts import sql_raw_words, texts
from ticketlake import rules as R
from ticketlake.functions import cleanse as X, vectors as V
from ticketlake.operators import blocks as BL, context as CX, dense as D, evaluation as E, fusion as FU, inverted_vectors as IV, sparse as SP
from ticketlake.operators.ordering import rank_in_buckets, rank_within, top_k
from ticketlake.operators.relational import fetch_by_rank
from ticketlake.plans import corpus as C
from ticketlake.session import checkpoint_dir

K = 10
cte("idx_posts", """
SELECT chunk_id AS doc, dl, term, COUNT(*) AS tf FROM (SELECT chunk_id, len(bm25_tokens) AS dl, unnest(bm25_tokens) AS term FROM corpus_chunks) GROUP BY chunk_id, dl, term
""")
cte("idx_stats", "SELECT COUNT(*) AS n_docs, AVG(len(bm25_tokens)) AS avgdl FROM corpus_chunks")
cte("idx_raw", "SELECT term, COUNT(*) AS df, ln((SELECT n_docs FROM idx_stats) - COUNT(*) + 0.5) - ln(COUNT(*) + 0.5) AS raw_idf FROM idx_posts GROUP BY term")
cte("idx_terms", "SELECT term, df, CASE WHEN raw_idf < 0 THEN (SELECT AVG(raw_idf) * 0.25 FROM idx_raw) ELSE raw_idf END AS idf FROM idx_raw")
cte("idx_asked", f"SELECT query_id, term, COUNT(*) AS qtf FROM (SELECT item_id AS query_id, unnest({sql_raw_words('lower(text)')}) AS term FROM benchmark) GROUP BY ALL")
cte("idx_scores", f"""
SELECT query_id, doc, round(SUM(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / (SELECT avgdl FROM idx_stats)))), 6) AS score
FROM idx_posts JOIN idx_terms USING (term) JOIN idx_asked USING (term) GROUP BY query_id, doc
""")
cte("idx_bm25", f"""
SELECT * FROM (SELECT query_id, doc, score, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM (
  SELECT b.item_id AS query_id, c.chunk_id AS doc, COALESCE(s.score, 0.0) AS score FROM benchmark b CROSS JOIN corpus_chunks c
  LEFT JOIN idx_scores s ON s.query_id = b.item_id AND s.doc = c.chunk_id)) WHERE rank <= {K}
""")
_HASH = "('0x' || substr(md5(term), 1, 4))::INT % 64 AS dim, SUM(CASE WHEN ('0x' || substr(md5(term), 5, 1))::INT % 2 = 0 THEN 1.0 ELSE -1.0 END)::DOUBLE AS x"
cte("idx_dvec", f"SELECT id, dim, x / sqrt(SUM(x * x) OVER (PARTITION BY id)) AS x FROM (SELECT chunk_id AS id, {_HASH} FROM (SELECT chunk_id, unnest(regexp_extract_all(lower(chunk_text), '[\\p{{L}}\\p{{N}}_]+')) AS term FROM corpus_chunks) GROUP BY ALL) WHERE x <> 0")
cte("idx_qvec", f"SELECT id, dim, x / sqrt(SUM(x * x) OVER (PARTITION BY id)) AS x FROM (SELECT item_id AS id, {_HASH} FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS term FROM benchmark) GROUP BY ALL) WHERE x <> 0")
cte("idx_dense", f"""
SELECT * FROM (SELECT query_id, doc, score, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM (
  SELECT CAST(b.item_id AS VARCHAR) AS query_id, c.chunk_id AS doc, COALESCE(s.score, 0.0) AS score FROM benchmark b CROSS JOIN corpus_chunks c
  LEFT JOIN (SELECT q.id AS qid, d.id AS did, round(SUM(q.x * d.x), 6) AS score FROM idx_qvec q JOIN idx_dvec d USING (dim) GROUP BY ALL) s ON s.qid = b.item_id AND s.did = c.chunk_id))
WHERE rank <= {K}
""")
cte("idx_union", "SELECT 'bm25' AS retriever, CAST(query_id AS VARCHAR) AS query_id, doc, rank, score FROM idx_bm25 UNION ALL SELECT 'dense', query_id, doc, rank, score FROM idx_dense")
cte("idx_rrf", "SELECT query_id, doc, round(SUM(1.0::DOUBLE / (60 + rank)), 8) AS rrf_score FROM idx_union GROUP BY query_id, doc")
cte("idx_hybrid", f"SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, doc) AS rank FROM idx_rrf) WHERE rank <= {K}")
cte("idx_candidates", """
SELECT h.query_id, h.doc, h.rank, h.rrf_score, c.chunk_text AS text, b.text AS query_text, c.ticket_pk, c.retrieval_quality_score
FROM idx_hybrid h JOIN corpus_chunks c ON c.chunk_id = h.doc JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = h.query_id
""")
cte("idx_truth", "SELECT CAST(b.item_id AS VARCHAR) AS query_id, c.chunk_id AS doc FROM benchmark b JOIN documents d ON contains(d.text, b.text) JOIN corpus_chunks c ON c.doc_id = d.doc_id")
cte("idx_judged", "SELECT query_id, MIN(h.rank) AS first_rank FROM idx_truth LEFT JOIN idx_bm25s h USING (query_id, doc) GROUP BY query_id")
cte("idx_bm25s", "SELECT CAST(query_id AS VARCHAR) AS query_id, doc, rank, score FROM idx_bm25")


_SIDF = "ln(1 + ((SELECT n_docs FROM idx_stats) - df + 0.5) / (df + 0.5))"
cte("idx_svec", f"SELECT doc, term, tf / total::DOUBLE * {_SIDF} AS value FROM (SELECT doc, term, tf, SUM(tf) OVER (PARTITION BY doc) AS total FROM idx_posts WHERE length(term) >= 2) JOIN idx_terms USING (term)")
cte("idx_squery", f"""
SELECT query_id, term, tf / total::DOUBLE * {_SIDF} AS value FROM (SELECT query_id, len(ts) AS total, term, COUNT(*) AS tf FROM (SELECT *, unnest(ts) AS term FROM (
  SELECT CAST(item_id AS VARCHAR) AS query_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), lambda x: length(x) >= 2) AS ts FROM benchmark)) GROUP BY query_id, len(ts), term) JOIN idx_terms USING (term)
""")
cte("idx_sparse", """
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM (
  SELECT query_id, doc, round(SUM(d.value * q.value), 8) AS score FROM idx_svec d JOIN idx_squery q USING (term) GROUP BY query_id, doc)) WHERE rank <= 60
""")
_DEEP = """
SELECT * FROM (SELECT query_id, doc, score, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM (
  SELECT CAST(b.item_id AS VARCHAR) AS query_id, c.chunk_id AS doc, COALESCE(s.score, 0.0) AS score FROM benchmark b CROSS JOIN (SELECT * FROM corpus_chunks {where}) c
  LEFT JOIN (SELECT q.id AS qid, d.id AS did, round(SUM(q.x * d.x), 6) AS score FROM idx_qvec q JOIN idx_dvec d USING (dim) GROUP BY ALL) s ON s.qid = b.item_id AND s.did = c.chunk_id))
WHERE rank <= 60
"""
_FUSED = "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, doc) AS rank FROM (SELECT query_id, doc, round(SUM(1.0::DOUBLE / (60 + rank)), 8) AS rrf_score FROM (SELECT query_id, doc, rank FROM idx_sparse UNION ALL SELECT query_id, doc, rank FROM {dense}) GROUP BY query_id, doc)) WHERE rank <= 60"
cte("idx_deep", _DEEP.format(where=""))
cte("idx_deep_some", _DEEP.format(where="WHERE priority_encoded = 2"))
cte("idx_v2", _FUSED.format(dense="idx_deep"))
cte("idx_v2_some", _FUSED.format(dense="idx_deep_some"))

cte("idx_wide", """
SELECT h.query_id, h.doc, h.rank, h.rrf_score, c.chunk_text AS text, b.text AS query_text
FROM idx_v2 h JOIN corpus_chunks c ON c.chunk_id = h.doc JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = h.query_id
""")
_SET = "list_distinct(list_filter(regexp_split_to_array(lower({}), '\\s+'), lambda x: x <> ''))"
_OVERLAP = rnd("len(list_intersect(qw, tw)) / len(list_distinct(list_concat(qw, tw)))::DOUBLE", 6)


def _reranked(candidates: str, k: int) -> str:
    words = f"SELECT *, {_SET.format('query_text')} AS qw, {_SET.format('text')} AS tw FROM {candidates}"
    scored = f"SELECT query_id, doc, rank, text, COALESCE({_OVERLAP}, 0) AS rerank_score FROM ({words})"
    return f"SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, doc) AS INT) AS rerank_rank FROM ({scored})) WHERE rerank_rank <= {k}"


cte("idx_reranked", _reranked("idx_wide", R.RERANK_K))


class Search:
    """Shared inputs of the retrieval queries."""

    _saved: dict = {}
    _blocks: dict = {}

    def __init__(self, t):
        """Chunks, index and vectors are written once per session and folder, then only read."""
        self.t = t
        self.queries = t.benchmark.select(F.col("item_id").cast("string").alias("query_id"), "text")
        key = (t.spark.sparkContext.applicationId, t.folder)
        if key not in self._saved:
            self._saved[key] = self._write(t)
        self.folder, self.saved_index = self._saved[key]
        self.chunks = t.spark.read.parquet(f"{self.folder}/chunks")

    @staticmethod
    def _write(t):
        folder = f"{checkpoint_dir(t.spark)}/search-{uuid.uuid4().hex}"
        feats = C.with_features(C.clean(texts(t)), encode=False)
        carry = ("ticket_pk", "doc_id", "retrieval_quality_score", "priority_encoded", "urgency_encoded", "impact_encoded")
        C.chunk_rows(feats, carry=carry).write.parquet(f"{folder}/chunks")
        chunks = t.spark.read.parquet(f"{folder}/chunks")
        index = SP.save_index(SP.build_index(chunks, "chunk_id", "bm25_tokens"), f"{folder}/index")
        D.embed(chunks.select(F.col("chunk_id").alias("doc"), "chunk_text"), "chunk_text", normalize=False).write.parquet(f"{folder}/vectors")
        return folder, index

    def index(self):
        return self.saved_index

    def blocks(self):
        """The postings in blocks, written once more in order of terms."""
        if self.folder not in self._blocks:
            self._blocks[self.folder] = BL.save_blocks(self.index(), f"{self.folder}/index")
        return self._blocks[self.folder]

    def vectors(self):
        return self.t.spark.read.parquet(f"{self.folder}/vectors")

    def query_vectors(self):
        return D.embed(self.queries, "text", normalize=False)

    def bm25(self):
        return SP.bm25_search(self.index(), self.queries, K)

    def dense(self):
        return D.dense_search(self.vectors(), self.query_vectors(), K)

    def hybrid(self):
        return FU.hybrid_search(self.index(), self.vectors(), self.queries, self.query_vectors(), K)

    def candidates(self):
        body = self.chunks.select(F.col("chunk_id").alias("doc"), F.col("chunk_text").alias("text"), "ticket_pk", "retrieval_quality_score")
        return self.hybrid().join(body, "doc").join(self.queries.withColumnRenamed("text", "query_text"), "query_id")

    def wide(self):
        """The fused 60 of both branches with their texts."""
        fused = FU.hybrid_search_v2(self.index(), self.vectors(), self.queries, self.query_vectors())
        body = self.chunks.select(F.col("chunk_id").alias("doc"), F.col("chunk_text").alias("text"))
        return fused.join(body, "doc").join(self.queries.withColumnRenamed("text", "query_text"), "query_id")

    def reranked(self):
        """60 sparse and 60 dense hits, fused to 60, reranked to 10."""
        return FU.rerank_by(self.wide(), R.RERANK_K, FU.overlap_score("query_text", "text"))

    def truth(self):
        """Chunks of the documents that hold the passage verbatim."""
        held = E.holding(self.t.documents, self.queries)
        return held.join(self.chunks.select("doc_id", F.col("chunk_id").alias("doc")), "doc_id").select("query_id", "doc").distinct()


@query("bm1_index_build", f"SELECT (SELECT COUNT(*) FROM corpus_chunks) AS n_docs, COUNT(*) AS n_postings, COUNT(DISTINCT term) AS n_terms, CAST(SUM(tf) AS BIGINT) AS n_tokens FROM idx_posts")
def _(t):
    """The index built from the raw texts within one plan."""
    feats = C.with_features(C.clean(texts(t)), encode=False)
    p = SP.build_index(C.chunk_rows(feats), "chunk_id", "bm25_tokens").postings
    per_doc = p.groupBy("doc").agg(F.count("*").alias("n"), F.sum("tf").alias("tf"))
    terms = p.groupBy("term").agg(F.lit(1).alias("one")).agg(F.count("*")).scalar()
    return per_doc.agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_postings"), F.max(terms).alias("n_terms"), F.sum("tf").alias("n_tokens"))


@query("bm1_index_terms", f"SELECT term, df, {rnd('idf', 6)} AS idf FROM idx_terms")
def _(t):
    return Search(t).index().terms.select("term", "df", X.rounded("idf", 6).alias("idf"))


@query("bm1_index_postings", "SELECT doc, term, tf, CAST(dl AS INT) AS dl FROM idx_posts")
def _(t):
    return Search(t).index().postings.select("doc", "term", "tf", "dl")


@query("bm1_index_stats", f"SELECT n_docs, {rnd('avgdl', 6)} AS avgdl FROM idx_stats")
def _(t):
    return Search(t).index().stats.select("n_docs", X.rounded("avgdl", 6).alias("avgdl"))


@query("bm2_bm25_topk", "SELECT query_id, doc, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM idx_bm25s")
def _(t):
    return Search(t).bm25().select("query_id", "doc", F.round("score", 6).alias("score"), "rank")


@query("bm2_block_search", "SELECT query_id, doc, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM idx_bm25s")
def _(t):
    """The same results from the block index: only ranges that can hold one of the k best documents are scored."""
    s = Search(t)
    return BL.pruned_search(s.blocks(), s.queries, K).select("query_id", "doc", F.round("score", 6).alias("score"), "rank")


@query("t2_topk_with_zero_fill", "SELECT query_id, COUNT(*) AS rows_returned, COUNT(*) FILTER (score = 0) AS zero_rows FROM idx_bm25s GROUP BY query_id")
def _(t):
    return Search(t).bm25().groupBy("query_id").agg(F.count("*").alias("rows_returned"), F.count_if(F.col("score") == 0).alias("zero_rows"))


@query(
    "bm3_sparse_tfidf",
    f"SELECT doc, term, {rnd('tf / total::DOUBLE * ln(1 + ((SELECT n_docs FROM idx_stats) - df + 0.5) / (df + 0.5))', 6)} AS value FROM (SELECT doc, term, tf, SUM(tf) OVER (PARTITION BY doc) AS total FROM idx_posts WHERE length(term) >= 2) JOIN idx_terms USING (term)",
)
def _(t):
    return SP.sparse_vectors(Search(t).index()).select("doc", "term", X.rounded("value", 6).alias("value"))


@query("bm4_hashed_sparse")
def _(t):
    return SP.hashed_vector(Search(t).chunks, "chunk_id", "bm25_tokens")


@query("em1_embedding_job")
def _(t):
    return D.embed(Search(t).chunks.select("chunk_id", "chunk_text"), "chunk_text").select(
        "chunk_id", "encoder_id", F.size("embedding").alias("dims"), F.round(V.norm("embedding"), 4).alias("length")
    )


_LEVEL = lambda c: f"COALESCE({c}, 0)::DOUBLE / 5"
_LEVELS_SQL = "[CAST(label % 5 AS DOUBLE) / 5, CAST(vec_id % 5 AS DOUBLE) / 5, CAST(vec_id % 3 AS DOUBLE) / 5]"


@query(
    "em2_level_fusion",
    f"SELECT vec_id, CAST(pos AS INT) AS pos, round(v[pos + 1] / sqrt(list_dot_product(v, v)), 5) AS x FROM (SELECT vec_id, v, unnest(range(len(v))) AS pos FROM (SELECT vec_id, list_concat(embedding::DOUBLE[], {_LEVELS_SQL}) AS v FROM embeddings))",
)
def _(t):
    fused = V.fuse_levels("embedding", F.col("label") % 5, F.col("vec_id") % 5, F.col("vec_id") % 3)
    return t.embeddings.select("vec_id", F.posexplode(fused).alias("pos", "x")).withColumn("x", F.round("x", 5))


@query("em3_vector_check", "SELECT COUNT(*) AS chunks, COUNT(*) FILTER (TRIM(chunk_text) = '') AS empty_chunks, COUNT(*) AS vectors, TRUE AS matches FROM corpus_chunks")
def _(t):
    s = Search(t)
    made = s.vectors().agg(F.count("*")).scalar()
    return s.chunks.agg(
        F.count("*").alias("chunks"), F.count_if(~X.has_text("chunk_text")).alias("empty_chunks"), F.max(made).alias("vectors"),
        (F.count("*") == F.max(made)).alias("matches"),
    )


cte("idx_cent", "SELECT label, list(m ORDER BY pos) AS c FROM (SELECT label, pos, AVG(x) AS m FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL) GROUP BY label")
_KNN = "SELECT * FROM (SELECT query_id, doc, score, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS INT) AS rank FROM (SELECT CAST(q.label AS VARCHAR) AS query_id, CAST(e.vec_id AS VARCHAR) AS doc, round(list_cosine_similarity(e.embedding::DOUBLE[], q.c), 6) AS score FROM idx_cent q CROSS JOIN embeddings e {where})) WHERE rank <= {k}"


def _centroid_search(t, k, max_broadcast=D.BROADCAST_QUERIES, cond=None):
    vectors = t.embeddings if cond is None else t.embeddings.filter(cond)
    return D.dense_search(vectors, D.label_centroids(t.embeddings), k, key="vec_id", max_broadcast=max_broadcast)


_FUSED_DOCS = f"SELECT CAST(vec_id AS VARCHAR) AS doc, list_concat(embedding::DOUBLE[], {_LEVELS_SQL}) AS v FROM embeddings"
_FUSED_ASKED = "SELECT CAST(label AS VARCHAR) AS query_id, list_concat(list_transform(c, lambda x: x / sqrt(list_dot_product(c, c))), [CAST(label % 5 AS DOUBLE) / 5, 0, 0]) AS q FROM idx_cent"


@query(
    "em2_level_search",
    f"SELECT * FROM (SELECT query_id, doc, score, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS INT) AS rank FROM (SELECT query_id, doc, round(list_cosine_similarity(v, q), 6) AS score FROM ({_FUSED_ASKED}) CROSS JOIN ({_FUSED_DOCS}))) WHERE rank <= 10",
)
def _(t):
    """Search among fused vectors with query vectors that ask for a priority."""
    docs = t.embeddings.select("vec_id", V.fuse_levels("embedding", F.col("label") % 5, F.col("vec_id") % 5, F.col("vec_id") % 3).alias("embedding"))
    asked = D.label_centroids(t.embeddings)
    asked = asked.withColumn("embedding", V.fuse_query("embedding", F.col("query_id").cast("int") % 5))
    return D.dense_search(docs, asked, 10, key="vec_id")


@query("kn1_dense_topk", _KNN.format(where="", k=20))
def _(t):
    return _centroid_search(t, 20)


@query("j13_exhaustive_blocks", _KNN.format(where="", k=20))
def _(t):
    return _centroid_search(t, 20, max_broadcast=1)


@query("kn2_filtered_dense", _KNN.format(where="WHERE e.label = 3", k=10))
def _(t):
    return _centroid_search(t, 10, cond=FU.metadata_filter({"label": 3}))


@query("fl6_dense_branch_filter", _KNN.format(where="WHERE e.label = 5", k=10))
def _(t):
    return _centroid_search(t, 10, cond=FU.metadata_filter({"label": 5}))


@query("kn3_lsh_topk")
def _(t):
    return D.nearest_lsh(t.embeddings, D.label_centroids(t.embeddings), 10, key="vec_id")


@query("kn3_inverted_lists", _KNN.format(where="", k=10))
def _(t):
    """Exact: lists beyond the first probes are met where their bound reaches the k-th score."""
    return IV.search_lists(IV.build_lists(t.embeddings, "vec_id"), D.label_centroids(t.embeddings), 10)


@query("kn3_probe_recall")
def _(t):
    """Share of the exact neighbours that a fixed number of probes finds; every hundredth vector is a query."""
    asked = t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    index = IV.build_lists(t.embeddings, "vec_id")
    return IV.recall(IV.search_lists(index, asked, 10, probes=12, exact=False), D.dense_search(t.embeddings, asked, 10, key="vec_id"))


@query("f10_vector_functions", "SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS length, round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 5) AS self_product FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", F.round(V.norm("embedding"), 5).alias("length"), F.round(V.dot("embedding", "embedding"), 5).alias("self_product"))


@query("s5_retriever_union", "SELECT retriever, query_id, doc, CAST(rank AS INT) AS rank FROM idx_union")
def _(t):
    s = Search(t)
    return FU.rank_union(bm25=s.bm25(), dense=s.dense()).drop("score")


@query("rf1_rrf", "SELECT query_id, doc, round(rrf_score, 7) AS rrf_score FROM idx_rrf")
def _(t):
    s = Search(t)
    return FU.rrf(FU.rank_union(bm25=s.bm25(), dense=s.dense())).withColumn("rrf_score", F.round("rrf_score", 7))


@query("j14_fusion_outer", "SELECT query_id, doc, MAX(CASE WHEN retriever = 'bm25' THEN CAST(rank AS INT) END) AS bm25_rank, MAX(CASE WHEN retriever = 'dense' THEN CAST(rank AS INT) END) AS dense_rank FROM idx_union GROUP BY ALL")
def _(t):
    s = Search(t)
    lists = FU.rank_union(bm25=s.bm25(), dense=s.dense())
    return lists.groupBy("query_id", "doc").agg(*[F.max(F.when(F.col("retriever") == r, F.col("rank"))).alias(f"{r}_rank") for r in ("bm25", "dense")])


@query("bm3_sparse_queries", f"SELECT query_id, term, {rnd('value', 6)} AS value FROM idx_squery WHERE value > 0")
def _(t):
    s = Search(t)
    return SP.sparse_queries(s.index(), s.queries).select("query_id", "term", X.rounded("value", 6).alias("value"))


@query("bm3_sparse_topk", f"SELECT query_id, doc, {rnd('score', 5)} AS score, CAST(rank AS INT) AS rank FROM idx_sparse")
def _(t):
    s = Search(t)
    return SP.sparse_search(s.index(), s.queries, R.BRANCH_K).select("query_id", "doc", X.rounded("score", 5).alias("score"), "rank")


@query("rf2_hybrid_v2", f"SELECT query_id, doc, {rnd('rrf_score', 7)} AS rrf_score, CAST(rank AS INT) AS rank FROM idx_v2")
def _(t):
    s = Search(t)
    return FU.hybrid_search_v2(s.index(), s.vectors(), s.queries, s.query_vectors()).select("query_id", "doc", X.rounded("rrf_score", 7).alias("rrf_score"), "rank")


@query("fl6_hybrid_v2_filter", f"SELECT query_id, doc, {rnd('rrf_score', 7)} AS rrf_score, CAST(rank AS INT) AS rank FROM idx_v2_some")
def _(t):
    """The metadata filter holds for the dense branch only."""
    s = Search(t)
    allowed = s.chunks.filter(FU.metadata_filter({"priority_encoded": 2})).select(F.col("chunk_id").alias("doc"))
    return FU.hybrid_search_v2(s.index(), s.vectors(), s.queries, s.query_vectors(), allowed=allowed).select("query_id", "doc", X.rounded("rrf_score", 7).alias("rrf_score"), "rank")


@query("rf2_hybrid_search", "SELECT query_id, doc, round(rrf_score, 7) AS rrf_score, CAST(rank AS INT) AS rank FROM idx_hybrid")
def _(t):
    return Search(t).hybrid().withColumn("rrf_score", F.round("rrf_score", 7))


@query("rf3_empty_branch", "SELECT query_id, doc, round(1.0::DOUBLE / (60 + rank), 7) AS rrf_score FROM idx_bm25s")
def _(t):
    """One retriever returns nothing: the other one still answers."""
    s = Search(t)
    bm25 = s.bm25()
    return FU.rrf(FU.rank_union(bm25=bm25, dense=bm25.filter(F.lit(False)))).withColumn("rrf_score", F.round("rrf_score", 7))


@query("rr1_rerank", f"SELECT query_id, doc, CAST(rank AS INT) AS rank, rerank_score, rerank_rank FROM ({_reranked('idx_candidates', 5)})")
def _(t):
    return FU.rerank_by(Search(t).candidates(), 5, FU.overlap_score("query_text", "text")).select("query_id", "doc", "rank", "rerank_score", "rerank_rank")


@query("rf2_search_chain", "SELECT query_id, doc, CAST(rank AS INT) AS rank, rerank_score, rerank_rank FROM idx_reranked")
def _(t):
    """The whole chain of the second service: 60 + 60, fused to 60, reranked to 10."""
    return Search(t).reranked().select("query_id", "doc", "rank", "rerank_score", "rerank_rank")


@query("rr2_rerank_fallback", "SELECT query_id, doc, round(rrf_score, 7) AS rerank_score, CAST(rank AS INT) AS rerank_rank FROM idx_hybrid WHERE rank <= 5")
def _(t):
    return FU.rerank(Search(t).candidates(), 5, scorer=None).select("query_id", "doc", F.round("rerank_score", 7).alias("rerank_score"), "rerank_rank")


@query("rr3_parse_score", r"SELECT event_id, least(greatest(COALESCE(TRY_CAST(regexp_extract(props, '(\d+\.?\d*)', 1) AS DOUBLE), 0), 0), 1) AS score FROM events")
def _(t):
    return t.events.select("event_id", FU.parse_score("props").alias("score"))


@query("t3_rerank_cut", f"SELECT * FROM (SELECT query_id, doc, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY q DESC, doc) AS INT) AS rank FROM (SELECT query_id, doc, {rnd('retrieval_quality_score', 6)} AS q FROM idx_candidates)) WHERE rank <= 3")
def _(t):
    c = Search(t).candidates().select("query_id", "doc", X.rounded("retrieval_quality_score", 6).alias("q"))
    return top_k(c, "query_id", [F.col("q").desc(), F.col("doc")], 3).drop("q")


@query("w5_rank_assignment", "SELECT doc_id, lang, CAST(ROW_NUMBER() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS INT) AS final_rank FROM documents")
def _(t):
    d = t.documents.select("doc_id", "lang", "n_chars")
    order = [F.col("n_chars").desc(), F.col("doc_id")]
    return rank_in_buckets(d, "lang", order, -F.floor(F.col("n_chars") / 100), "final_rank").drop("n_chars")


cte("idx_pairhits", """
SELECT query_id, rag_id, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY rag_id) AS INT) AS rank FROM (
  SELECT CAST(conv_id AS VARCHAR) AS query_id, md5(conv_id || '|' || turn) AS rag_id FROM conversations)
""")


def _turn_candidates(t):
    raw = t.conversations.select(
        F.col("conv_id").cast("string").alias("query_id"), F.md5(F.concat(F.col("conv_id").cast("string"), F.lit("|"), F.col("turn").cast("string"))).alias("rag_id")
    )
    return rank_within(raw, "query_id", [F.col("rag_id")])


def _solutions(t):
    return FU.solution_lookup(C.clean_pairs(C.enrich_pairs(C.pairs(t.conversations))))


@query("sl1_solution_lookup", "SELECT rag_id, problem_text_clean AS problem_text, solution_text_clean AS solution_text FROM corpus_pairs_ok")
def _(t):
    return _solutions(t)


@query("sl2_fetch_solutions", "SELECT h.query_id, h.rag_id, h.rank, COALESCE(p.problem_text_clean, '') AS problem_text, COALESCE(p.solution_text_clean, '') AS solution_text, p.rag_id IS NOT NULL AS found FROM idx_pairhits h LEFT JOIN corpus_pairs_ok p USING (rag_id)")
def _(t):
    return FU.fetch_solutions(_turn_candidates(t), _solutions(t))


@query("j10_fetch_by_rank", "SELECT h.query_id, h.rag_id, h.rank, COALESCE(p.solution_text_clean, 'n/a') AS solution_text FROM idx_pairhits h LEFT JOIN corpus_pairs_ok p USING (rag_id)")
def _(t):
    return fetch_by_rank(_turn_candidates(t), _solutions(t).drop("problem_text"), "rag_id", "query_id", "rank", {"solution_text": "n/a"})


@query("j11_semi_by_ids", "SELECT rag_id, problem_text_clean AS problem_text FROM corpus_pairs_ok WHERE rag_id IN (SELECT rag_id FROM idx_pairhits WHERE rank = 1)")
def _(t):
    ids = _turn_candidates(t).filter(F.col("rank") == 1)
    return _solutions(t).join(ids, "rag_id", "left_semi").select("rag_id", "problem_text")


@query("j12_anti_missing", "SELECT COUNT(*) AS missing FROM idx_pairhits h WHERE NOT EXISTS (SELECT 1 FROM corpus_pairs_ok p WHERE p.rag_id = h.rag_id)")
def _(t):
    return _turn_candidates(t).join(_solutions(t), "rag_id", "left_anti").agg(F.count("*").alias("missing"))


# ---- context -------------------------------------------------------------------------------------
_HEADED = "string_agg('[Document] (ID: ' || doc || ')' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)"
cte("idx_packed", f"""
SELECT query_id, doc, rank, text, tokens FROM (SELECT *, SUM(tokens) OVER (PARTITION BY query_id ORDER BY rank) AS running FROM (
  SELECT query_id, doc, rank, text, CAST(length(text) // 4 AS BIGINT) AS tokens FROM idx_wide WHERE TRIM(text) <> '')) WHERE running <= {R.CONTEXT_TOKENS}
""")
cte("idx_packed_ten", f"""
SELECT query_id, doc, rank, text, tokens FROM (SELECT *, SUM(tokens) OVER (PARTITION BY query_id ORDER BY rank) AS running FROM (
  SELECT query_id, doc, rerank_rank AS rank, text, CAST(length(text) // 4 AS BIGINT) AS tokens FROM idx_reranked WHERE TRIM(text) <> '')) WHERE running <= {R.CONTEXT_TOKENS}
""")


@query("cx1_context_packing", f"SELECT query_id, {_HEADED} AS context, COUNT(*) AS n_chunks, CAST(SUM(tokens) AS BIGINT) AS tokens FROM idx_packed GROUP BY query_id")
def _(t):
    """Contexts of 4,096 tokens from the fused 60."""
    return CX.pack_context(Search(t).wide())


def _answer_context(t):
    return CX.pack_context(Search(t).reranked().withColumn("rank", F.col("rerank_rank")))


@query("cx1_context_reranked", f"SELECT query_id, {_HEADED} AS context, COUNT(*) AS n_chunks, CAST(SUM(tokens) AS BIGINT) AS tokens FROM idx_packed_ten GROUP BY query_id")
def _(t):
    """Contexts from the reranked ten."""
    return _answer_context(t)


@query("t4_budget_prefix", "SELECT query_id, doc, CAST(rank AS INT) AS rank, tokens FROM idx_packed")
def _(t):
    return CX.select_within_budget(Search(t).wide()).select("query_id", "doc", "rank", "tokens")


_BLOCK = "'--- Source ' || rank || ' (score: ' || printf('%.2f', rrf_score) || ') ---' || chr(10) || text || chr(10)"


@query("cx1_scored_sources", f"SELECT query_id, string_agg(block, chr(10) ORDER BY rank) AS context, COUNT(*) AS n_sources FROM (SELECT *, SUM(length(block)) OVER (PARTITION BY query_id ORDER BY rank) AS running FROM (SELECT query_id, rank, {_BLOCK} AS block FROM idx_candidates)) WHERE running <= 2867 GROUP BY query_id")
def _(t):
    return CX.pack_scored_sources(Search(t).candidates(), 1024, "rrf_score")


_SYSTEM = R.SYSTEM_PROMPT.replace("'", "''")


@query(
    "cx2_prompts",
    f"SELECT query_id, CAST(to_json([{{'role': 'system', 'content': '{_SYSTEM}'}}, {{'role': 'user', 'content': 'Context:' || chr(10) || context || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'User Question: ' || b.text}}]) AS VARCHAR) AS messages "
    f"FROM (SELECT query_id, {_HEADED} AS context FROM idx_packed_ten GROUP BY query_id) JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = query_id",
)
def _(t):
    return _answer_context(t).join(Search(t).queries, "query_id").select("query_id", CX.prompt("context", "text").alias("messages"))


_ANSWER = "CASE WHEN event_id % 3 = 0 THEN '{\"solution\": \"restart ' || event_type || '\", \"confidence\": ' || (event_id % 15) / 10.0 || '}' WHEN event_id % 3 = 1 THEN '{\"solution\": \"reset\"}' ELSE 'plain ' || event_type END"


@query("cx3_parse_answers", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'restart ' || event_type WHEN 1 THEN 'reset' ELSE 'plain ' || event_type END AS solution, CASE event_id % 3 WHEN 0 THEN least((event_id % 15) / 10.0::DOUBLE, 1) WHEN 1 THEN 0.5 ELSE 0 END::DOUBLE AS confidence FROM events")
def _(t):
    three = F.col("event_id") % 3
    score = ((F.col("event_id") % 15) / F.lit(10.0)).cast("string")
    raw = (
        F.when(three == 0, F.concat(F.lit('{"solution": "restart '), "event_type", F.lit('", "confidence": '), score, F.lit("}")))
        .when(three == 1, F.lit('{"solution": "reset"}'))
        .otherwise(F.concat(F.lit("plain "), "event_type"))
    )
    solution, confidence = CX.parse_answer("raw")
    return t.events.select("event_id", raw.alias("raw")).select("event_id", solution.alias("solution"), confidence.alias("confidence"))


# ---- evaluation ----------------------------------------------------------------------------------
@query("ev1_recall", f"SELECT COUNT(*) AS queries, COUNT(*) FILTER (first_rank <= 5) AS hits, {rnd('COUNT(*) FILTER (first_rank <= 5) / COUNT(*)::DOUBLE', 6)} AS recall FROM idx_judged")
def _(t):
    s = Search(t)
    return E.recall_at(s.bm25(), s.truth(), 5)


@query("ev2_mrr", f"SELECT COUNT(*) AS queries, {rnd('AVG(COALESCE(1.0::DOUBLE / first_rank, 0))', 6)} AS mrr FROM idx_judged")
def _(t):
    s = Search(t)
    return E.mrr(s.bm25(), s.truth())


@query("ev3_top_hits", "SELECT query_id, COUNT(*) AS results, MAX(CASE WHEN rank = 1 THEN doc END) AS top_doc, round(MAX(CASE WHEN rank = 1 THEN rrf_score END), 7) AS top_score FROM idx_hybrid GROUP BY query_id")
def _(t):
    return E.top_hits(Search(t).hybrid(), "rrf_score").withColumn("top_score", F.round("top_score", 7))


@query(
    "ev4_context_validation",
    "SELECT *, concat_ws('; ', CASE WHEN total_tokens > 512 THEN total_tokens || ' tokens exceeds max 512' END) AS issues, total_tokens <= 512 AS valid FROM (SELECT query_id, COUNT(*) AS num_docs, CAST(SUM(len(string_split(text, ' '))) AS BIGINT) AS total_tokens, COUNT(*) - COUNT(DISTINCT doc) AS duplicates, COUNT(*) FILTER (TRIM(text) = '') AS empty_docs, "
    + rnd("SUM(len(string_split(text, ' '))) / COUNT(*)::DOUBLE", 1) + " AS avg_tokens_per_doc FROM idx_candidates GROUP BY query_id)",
)
def _(t):
    return E.validate_context(Search(t).candidates())


_CMP = "SELECT query_id, COUNT(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS overlap, COUNT(*) <> COUNT(*) FILTER (a = b) AS changed FROM (SELECT COALESCE(x.query_id, y.query_id) AS query_id, x.rank AS a, y.rank AS b FROM (SELECT * FROM idx_bm25s WHERE rank <= 5) x FULL JOIN (SELECT * FROM idx_dense WHERE rank <= 5) y ON x.query_id = y.query_id AND x.doc = y.doc) GROUP BY query_id"


@query("ev5_ordering_comparison", _CMP)
def _(t):
    s = Search(t)
    return E.compare_orderings(s.bm25(), s.dense(), 5)


@query("s4_topk_overlap", "SELECT query_id, COUNT(*) AS overlap FROM idx_bm25s b JOIN idx_dense d USING (query_id, doc) GROUP BY query_id")
def _(t):
    s = Search(t)
    return s.bm25().select("query_id", "doc").intersect(s.dense().select("query_id", "doc")).groupBy("query_id").agg(F.count("*").alias("overlap"))


@query("ev6_latency_summary", f"SELECT event_type, COUNT(*) AS runs, {rnd('AVG(value)', 4)} AS avg_ms, MIN(value) AS min_ms, MAX(value) AS max_ms, COUNT(*) FILTER (event_id % 10 = 0) AS failures FROM events GROUP BY event_type")
def _(t):
    log = t.events.withColumn("ok", F.col("event_id") % 10 != 0)
    return E.latency_summary(log, "event_type", "value", "ok")
