"""Retrieval evaluation as aggregations over ranked lists."""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ticketlake.functions import cleanse as X, text as T


def judged(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """Rank of the first relevant document per judged query (NULL where none was retrieved)."""
    hits = ranked.join(truth.select("query_id", "doc").distinct(), ["query_id", "doc"], "left_semi")
    first = hits.groupBy("query_id").agg(F.min("rank").alias("first_rank"))
    return truth.select("query_id").distinct().join(first, "query_id", "left")


#: Bytes of passages that one pass over the texts looks for.
PASSAGE_BYTES = 2 << 20


def holding(texts: DataFrame, passages: DataFrame, text_id: str = "doc_id", round_bytes: int = PASSAGE_BYTES) -> DataFrame:
    """(query_id, `text_id`) of every text that holds a passage verbatim.

    All passages of a round are looked for at once by an automaton in one pass over each text, so texts are neither cut
    into grams nor paired with passages. A larger batch goes in rounds of bounded size, each over all texts. Null and empty
    passages are in no text.
    """
    asked = passages.select(F.col("query_id").cast("string").alias("query_id"), "text").filter("text <> ''").distinct()
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    rounds = 1 + 2 * int(size // round_bytes)
    kind = f"query_id string, `{text_id}` {dict(texts.dtypes)[text_id]}"
    parts = [_found(texts, asked.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k), text_id, kind) for k in range(rounds)]
    return reduce(DataFrame.unionAll, parts)


def _found(texts: DataFrame, asked: DataFrame, text_id: str, kind: str) -> DataFrame:
    owners: dict[str, list[str]] = {}
    for r in asked.collect():  # bounded by the round
        owners.setdefault(r.text, []).append(r.query_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for passage, ids in owners.items():
            automaton.add_word(passage, (passage, ids))
        automaton.make_automaton()
        for batch in batches:
            at, found = [], []
            for k, text in enumerate(batch.column("text")):
                held = {passage: ids for _, (passage, ids) in automaton.iter(text.as_py() or "")} if owners else {}
                for ids in held.values():
                    at += [k] * len(ids)
                    found += ids
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), batch.column(text_id).take(pa.array(at, pa.int64()))], ["query_id", text_id])

    return texts.select(text_id, "text").mapInArrow(run, kind)


def recall_at(ranked: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    hit = X.is_true(F.col("first_rank") <= k)
    return judged(ranked, truth).agg(
        F.count("*").alias("queries"), F.count_if(hit).alias("hits"), X.ratio(F.count_if(hit), F.count("*"), 6).alias("recall")
    )


def mrr(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    rr = F.coalesce(1.0 / F.col("first_rank"), F.lit(0.0))
    return judged(ranked, truth).agg(F.count("*").alias("queries"), X.rounded(F.avg(rr), 6).alias("mrr"))


def top_hits(ranked: DataFrame, score: str = "score") -> DataFrame:
    """Per query: number of results, best document and its score."""
    return ranked.groupBy("query_id").agg(
        F.count("*").alias("results"),
        F.min_by("doc", "rank").alias("top_doc"),
        F.min_by(score, "rank").alias("top_score"),
    )


def validate_context(results: DataFrame, max_tokens: int = 512) -> DataFrame:
    """Duplicates, blank texts and token budget per query, with the list of issues as text."""
    words = T.word_count(F.col("text"))
    counts = results.groupBy("query_id").agg(
        F.count("*").alias("num_docs"),
        F.sum(words).cast("bigint").alias("total_tokens"),
        (F.count("*") - F.count_distinct("doc")).alias("duplicates"),
        F.count_if(~X.has_text("text")).alias("empty_docs"),
    )

    def issue(col: str, label: str, limit: int = 0):
        return F.when(F.col(col) > limit, F.concat(F.col(col).cast("string"), F.lit(label)))

    issues = F.concat_ws(
        "; ",
        issue("duplicates", " duplicate chunk_ids"),
        issue("empty_docs", " empty texts"),
        issue("total_tokens", f" tokens exceeds max {max_tokens}", max_tokens),
    )
    return counts.select(
        "*", X.rounded(F.col("total_tokens") / F.col("num_docs"), 1).alias("avg_tokens_per_doc"),
        issues.alias("issues"), (issues == "").alias("valid"),
    )


def compare_orderings(before: DataFrame, after: DataFrame, k: int) -> DataFrame:
    """Overlap of two top-k lists per query and whether the order changed."""
    a = before.filter(F.col("rank") <= k).select("query_id", "doc", F.col("rank").alias("rank_a"))
    b = after.filter(F.col("rank") <= k).select("query_id", "doc", F.col("rank").alias("rank_b"))
    both = a.join(b, ["query_id", "doc"], "full")
    same = F.count_if(X.is_true(F.col("rank_a") == F.col("rank_b")))
    return both.groupBy("query_id").agg(
        F.count_if(F.col("rank_a").isNotNull() & F.col("rank_b").isNotNull()).alias("overlap"),
        (F.count("*") != same).alias("changed"),
    )


def latency_summary(log: DataFrame, step: str, millis: str, ok: str) -> DataFrame:
    """Average, extremes and failures per step."""
    return log.groupBy(step).agg(
        F.count("*").alias("runs"),
        X.rounded(F.avg(millis), 4).alias("avg_ms"),
        F.min(millis).alias("min_ms"),
        F.max(millis).alias("max_ms"),
        F.count_if(~F.col(ok)).alias("failures"),
    )
