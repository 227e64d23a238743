"""Gold ML dataset: text features joined with SLA features plus derived columns."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ticketlake import rules as R
from ticketlake.functions import scores as S
from ticketlake.operators.relational import merge_with_coverage

# fixed values: feature name -> (type, origin, purpose, leakage risk)
FEATURE_DICTIONARY = {
    "document_id": ("string", "synthetic", "Unique doc identifier for retrieval", "none"),
    "ticket_pk": ("string", "real", "Primary key from gold_ticket_similarity", "none"),
    "retrieval_text_clean": ("string", "real", "Cleaned text corpus for retrieval/embedding", "none"),
    "source_system_encoded": ("int", "derived", "Label-encoded source system", "none"),
    "similarity_method_encoded": ("int", "derived", "Label-encoded similarity method", "none"),
    "priority_encoded": ("float", "real", "Priority level 2-5 from source", "target"),
    "urgency_encoded": ("float", "real", "Urgency level 2-5 from source", "target"),
    "impact_encoded": ("float", "real", "Impact level 3-5 from source", "target"),
    "was_sla_breached": ("int", "real", "SLA breach label from gold SLA dataset", "target"),
    "priority_score": ("int", "real", "Priority score from gold SLA features", "none (parallel to priority_encoded)"),
    "ticket_age_hours": ("float", "derived", "Ticket age in hours from gold SLA", "none"),
    "resolution_time_hours": ("float", "real", "Resolution time from gold SLA", "none"),
    "followup_count": ("int", "real", "Number of followups from gold SLA", "none"),
    "avg_followup_content_length": ("float", "real", "Average followup length from gold SLA", "none"),
    "issue_complexity_score": ("float", "heuristic", "Issue complexity heuristic from gold SLA", "low"),
    "customer_tenure_months": ("float", "real", "Customer tenure from gold SLA", "none"),
    "previous_tickets": ("float", "real", "Previous ticket count from gold SLA", "none"),
    "text_word_count": ("int", "derived", "Word count of retrieval text", "none"),
    "text_char_count": ("int", "derived", "Character count of retrieval text", "none"),
    "avg_word_length": ("float", "derived", "Mean word length", "none"),
    "unique_word_ratio": ("float", "derived", "Unique/total word ratio", "none"),
    "uppercase_ratio": ("float", "derived", "Uppercase character ratio", "none"),
    "digit_ratio": ("float", "derived", "Digit character ratio", "none"),
    "special_char_ratio": ("float", "derived", "Special character ratio", "none"),
    "repetition_ratio": ("float", "derived", "Text repetition ratio", "none"),
    "text_complexity_score": ("float", "heuristic", "0.4*avg_wl + 0.4*uniq_ratio + 0.2*wc/100", "none"),
    "retrieval_quality_score": ("float", "heuristic", "Mean of corpus_quality, similarity_confidence, unique_word_ratio", "none"),
    "corpus_quality_score": ("float", "real", "Corpus quality score from gold source", "none"),
    "similarity_confidence": ("float", "real", "Similarity confidence from gold source", "none"),
    "escalation_risk_score": ("float", "heuristic", "Weighted composite of text-derived quality scores", "none"),
    "is_predicted_high_risk": ("int", "heuristic", "Binary threshold on escalation_risk_score >= 0.6", "none"),
    "text_content_density": ("float", "derived", "Information density: word_count / char_count", "none"),
    "text_formatting_ratio": ("float", "derived", "Aggregate non-standard char ratio", "none"),
}


def build(features: DataFrame, sla: DataFrame, left_key: str = "ticket_pk", right_key: str = "source_ticket_pk") -> tuple[DataFrame, DataFrame]:
    """(dataset, join coverage report)."""
    merged, report = merge_with_coverage(features, sla, left_key, right_key, list(R.SLA_MERGE_COLUMNS))
    risk, high = S.text_escalation()
    chars = F.col("text_char_count")
    return (
        merged.withColumns(
            {
                "escalation_risk_score": risk,
                "is_predicted_high_risk": high,
                "text_content_density": F.when(chars > 0, F.col("text_word_count") / F.nullif(chars.cast("double"), F.lit(0.0))).otherwise(0.0),
                "text_formatting_ratio": sum(
                    (F.coalesce(c, F.lit(0.0)) for c in ("digit_ratio", "special_char_ratio")), F.coalesce("uppercase_ratio", F.lit(0.0))
                ),
            }
        ),
        report,
    )


def feature_dictionary(df: DataFrame) -> DataFrame:
    """Dictionary rows of the features present in ``df``, with the rows that have and that lack a value."""
    present = [k for k in FEATURE_DICTIONARY if k in df.columns]
    counts = df.agg(F.count("*").alias("_n"), *[F.count(k).alias(k) for k in present])
    filled = counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(k).alias("filled"), (F.col("_n") - F.col(k)).alias("missing")) for k in present])).alias("x")).select("x.*")
    rows = [(k, *FEATURE_DICTIONARY[k]) for k in present]
    return df.sparkSession.createDataFrame(rows, "feature string, type string, origin string, purpose string, leakage_risk string").join(filled, "feature")
