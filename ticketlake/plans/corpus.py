"""Corpus plans: ticket texts and problem/solution pairs from raw text to retrieval chunks."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X, scores as S, text as T
from ticketlake.operators.ordering import label_encode
from ticketlake.operators.relational import drop_duplicates_ordered, evaluate_once
from ticketlake.session import written_once

TEXT = "retrieval_text_clean"
CLEAN_COLUMNS = (
    "similarity_pk ticket_pk source_system text_source_type similarity_method retrieval_text_clean corpus_quality_score "
    "similarity_confidence priority_encoded urgency_encoded impact_encoded text_word_count text_char_count repetition_ratio"
).split()
METADATA_COLUMNS = (
    "ticket_pk source_system priority_encoded urgency_encoded impact_encoded similarity_method corpus_quality_score "
    "similarity_confidence"
).split()


def pick_source(real: str = "text_corpus", synthetic: str = "synthetic_text_corpus") -> Column:
    return F.when(F.col("text_source_type") == "real_text", F.col(real)).otherwise(F.col(synthetic))


def normalise(col, collapse: bool = True) -> Column:
    out = T.remove_boilerplate(T.clean_text(col))
    return T.remove_repeated_phrases(out) if collapse else out


def _long_enough(text: str) -> Column:
    return F.char_length(F.col(text)) >= R.MIN_CHARS


def cleaning_steps(texts: DataFrame, collapse: bool = True) -> DataFrame:
    """Every row with its cleaned text, its counts and one flag per filter of the funnel."""
    raw = F.coalesce("text_corpus", F.lit(""))
    staged = evaluate_once(texts, {TEXT: normalise(raw, collapse)})
    counted = with_word_statistics(staged, {"text": TEXT})
    return counted.withColumnRenamed("text_repetition_ratio", "repetition_ratio").withColumns(
        {
            "keep_real": F.col("text_source_type") == "real_text",
            "keep_filled": X.has_text("text_corpus"),
            "keep_long": F.char_length(raw) >= R.MIN_CHARS,
            "keep_clean_long": _long_enough(TEXT),
            "keep_words": F.col("text_word_count") >= R.MIN_WORDS,
        }
    )


def with_word_statistics(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Word count, character count and repetition ratio of cleaned texts, one split per text."""
    split = evaluate_once(df, {f"_{p}": T.clean_words(c) for p, c in texts.items()})
    stats = {}
    for p, c in texts.items():
        w = F.col(f"_{p}")
        stats |= {f"{p}_word_count": F.size(w), f"{p}_char_count": F.char_length(c), f"{p}_repetition_ratio": T.repetition_ratio(w)}
    return evaluate_once(split, stats).drop(*[f"_{p}" for p in texts])


def clean(texts: DataFrame, order: str = "doc_id", collapse: bool = True) -> DataFrame:
    """Filters, one row per ticket, repetition limit, kept columns."""
    # filters on the raw text first, so dropped rows are never cleaned
    raw = texts.filter(
        (F.col("text_source_type") == "real_text") & X.has_text("text_corpus") & (F.char_length("text_corpus") >= R.MIN_CHARS)
    )
    steps = cleaning_steps(raw, collapse)
    kept = steps.filter(F.col("keep_clean_long") & F.col("keep_words"))
    unique = drop_duplicates_ordered(kept, "ticket_pk", [F.col(order)])
    return unique.filter(F.col("repetition_ratio") <= R.MAX_REPETITION).select(order, *CLEAN_COLUMNS)


def with_features(clean_df: DataFrame, encode: bool = True) -> DataFrame:
    """Text features, quality scores, ids and metadata of a cleaned corpus."""
    w = F.col("_w")
    df = evaluate_once(
        evaluate_once(clean_df, {"_w": T.clean_words(TEXT)}),
        {
            "avg_word_length": T.avg_word_length(w),
            "unique_word_ratio": T.unique_word_ratio(w),
            "uppercase_ratio": T.uppercase_ratio(TEXT),
            "digit_ratio": T.digit_ratio(TEXT),
            "special_char_ratio": T.special_char_ratio(TEXT),
        },
    ).drop("_w")
    df = df.withColumns(
        {
            "text_complexity_score": T.complexity("avg_word_length", "unique_word_ratio", "text_word_count"),
            "retrieval_quality_score": T.row_mean("corpus_quality_score", "similarity_confidence", "unique_word_ratio"),
            "document_id": F.concat(F.lit("doc_"), F.md5("ticket_pk")),
            "metadata_json": T.metadata_json(*METADATA_COLUMNS),
        }
    )
    if encode:
        # the classes of each column are read from the rows first, and cleaning is the costly part
        df = written_once(df, "features")
        for column in ("source_system", "similarity_method"):
            df = label_encode(df, column)
    return df


def chunk_rows(df: DataFrame, text: str = TEXT, carry=(), size: int = R.CHUNK_SIZE, overlap: int = R.CHUNK_OVERLAP) -> DataFrame:
    """One row per sliding word window with ids, counts, tokens and inherited columns; short chunks dropped."""
    exploded = evaluate_once(df.select("document_id", *carry, text), {"_w": T.words(F.col(text))}).select(
        "document_id", *carry, F.posexplode(T.chunks(F.col("_w"), size, overlap)).alias("chunk_index", "chunk_text")
    )
    counted = exploded.withColumn("chunk_word_count", F.size(F.split("chunk_text", " ")))
    return counted.filter(F.col("chunk_word_count") >= R.MIN_CHUNK_WORDS).select(
        F.concat("document_id", F.lit("_chunk_"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        "document_id", *carry, "chunk_index", "chunk_text", "chunk_word_count",
        T.token_estimate("chunk_word_count").alias("chunk_token_estimate"),
        T.bm25_tokens("chunk_text").alias("bm25_tokens"),
    )


CHUNK_CARRY = ("ticket_pk", "metadata_json", "priority_encoded", "urgency_encoded", "impact_encoded", "retrieval_quality_score")


def chunks_v1(texts: DataFrame, collapse: bool = True) -> DataFrame:
    return chunk_rows(with_features(clean(texts, collapse=collapse), encode=False), carry=CHUNK_CARRY)


# ---- problem / solution pairs --------------------------------------------------------------------
def pairs(conversations: DataFrame) -> DataFrame:
    """A user turn and the assistant turn right after it.

    The reply is found with an equi-join on (conversation, next turn): no task has to hold or sort a
    whole conversation, however long one of them is. Turn numbers are consecutive.
    """
    asked = conversations.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("problem_text"), (F.col("turn") + 1).alias("reply_turn")
    )
    reply = conversations.filter(F.col("role") == "assistant").select(
        "conv_id", F.col("turn").alias("reply_turn"), F.col("text").alias("solution_text")
    )
    joined = asked.join(reply, ["conv_id", "reply_turn"])
    key = F.concat(F.col("conv_id").cast("string"), F.lit("|"), F.col("turn").cast("string"))
    return joined.select(F.md5(key).alias("rag_id"), "conv_id", "turn", "problem_text", "solution_text")


def next_turn(conversations: DataFrame, span: int = 1000) -> DataFrame:
    """Each turn with the role and text that follow it, whatever the gaps between turn numbers.

    Turns are paired inside spans of a conversation; the last turn of a span takes the head of the
    next span, so a very long conversation is still spread over many tasks.
    """
    tagged = conversations.withColumn("b", F.floor(F.col("turn") / span))
    inside = Window.partitionBy("conv_id", "b").orderBy("turn")
    heads = tagged.groupBy("conv_id", "b").agg(F.min_by(F.struct("role", "text"), "turn").alias("head"))
    after = heads.select("conv_id", "b", F.lead("head").over(Window.partitionBy("conv_id").orderBy("b")).alias("after"))
    paired = tagged.withColumn("follows", F.lead(F.struct("role", "text")).over(inside)).join(after, ["conv_id", "b"], "left")
    then = F.coalesce("follows", "after")
    return paired.select("conv_id", "turn", "role", then["role"].alias("next_role"), then["text"].alias("next_text"))


def enrich_pairs(raw: DataFrame) -> DataFrame:
    """Context columns of a pair, derived from its keys."""
    return raw.withColumns(
        {
            "category": F.concat(F.lit("category "), (F.col("conv_id") % 5).cast("string")),
            "priority": X.map_codes(F.col("turn") % 4, [("0", "low"), ("1", "medium"), ("2", "high"), ("3", "critical")], "low"),
            "language": F.when(F.col("conv_id") % 3 == 0, "en").when(F.col("conv_id") % 3 == 1, "fr"),
            "product": F.concat(F.lit("product "), (F.col("conv_id") % 7).cast("string")),
            "is_sla_breached": F.col("conv_id") % 4 == 0,
            "issue_complexity_score": (F.col("conv_id") % 10).cast("double"),
            "sla_risk_score": (F.col("turn") % 8).cast("double") / 2,
            "escalation_risk_level": F.when(F.col("conv_id") % 6 == 0, "high").otherwise("low"),
        }
    )


def clean_pairs(raw: DataFrame, collapse: bool = True) -> DataFrame:
    sides = ("problem", "solution")
    df = raw
    for s in sides:
        df = df.filter(X.has_text(f"{s}_text") & (F.char_length(f"{s}_text") >= R.MIN_CHARS))
    df = evaluate_once(df, {f"{s}_text_clean": normalise(F.col(f"{s}_text"), collapse) for s in sides})
    df = with_word_statistics(df, {s: f"{s}_text_clean" for s in sides})
    ok = F.lit(True)
    for s in sides:
        ok = ok & _long_enough(f"{s}_text_clean") & (F.col(f"{s}_word_count") >= R.MIN_WORDS)
    unique = drop_duplicates_ordered(df.filter(ok), "rag_id", [F.col("conv_id"), F.col("turn")])
    return unique.filter(
        (F.col("problem_repetition_ratio") <= R.MAX_REPETITION) & (F.col("solution_repetition_ratio") <= R.MAX_REPETITION)
    )


def pair_features(clean_df: DataFrame) -> DataFrame:
    df = clean_df
    for s in ("problem", "solution"):
        col = f"{s}_text_clean"
        w = F.col("_w")
        df = evaluate_once(evaluate_once(df, {"_w": T.clean_words(col)}),
            {
                f"{s}_avg_word_length": T.avg_word_length(w),
                f"{s}_unique_word_ratio": T.unique_word_ratio(w),
                f"{s}_uppercase_ratio": T.uppercase_ratio(col),
                f"{s}_digit_ratio": T.digit_ratio(col),
                f"{s}_special_char_ratio": T.special_char_ratio(col),
            },
        ).drop("_w")
        df = df.withColumn(f"{s}_complexity_score", T.complexity(f"{s}_avg_word_length", f"{s}_unique_word_ratio", f"{s}_word_count"))
    df = label_encode(written_once(df, "pairs"), "priority")
    return df.withColumns(
        {
            "retrieval_quality_score": T.row_mean(
                "issue_complexity_score", "sla_risk_score", "problem_unique_word_ratio", "solution_unique_word_ratio"
            ),
            "escalation_risk_score": S.pair_escalation(),
            "document_id": F.concat(F.lit("doc_"), F.col("rag_id")),
            "retrieval_text_clean": T.retrieval_document(
                "problem_text_clean", "solution_text_clean", "category", "priority", "product", "language",
                "escalation_risk_level", "is_sla_breached",
            ),
        }
    )
