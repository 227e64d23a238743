"""Gold models: SLA features, asset failure risk, user anomalies and the ticket-similarity corpus."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X, scores as S
from ticketlake.operators.relational import best_by_rules, latest_per_key, union_aligned
from ticketlake.plans.silver import software_summary

SLA = [
    ("sla_feature_pk", "string"), ("source_ticket_pk", "string"), ("source_system", "string"), ("ticket_id", "string"),
    ("created_at", "timestamp_ntz"), ("closed_at", "timestamp_ntz"),
    ("priority_score", "int"), ("urgency_score", "int"), ("impact_score", "int"),
    ("ticket_age_hours", "bigint"), ("resolution_time_hours", "double"), ("waiting_duration", "bigint"),
    ("takeintoaccount_delay", "bigint"), ("followup_count", "bigint"), ("private_followup_ratio", "double"),
    ("avg_followup_content_length", "double"), ("issue_complexity_score", "double"),
    ("customer_tenure_months", "int"), ("previous_tickets", "int"), ("is_escalated", "int"), ("was_sla_breached", "int"),
]


def sla_features(desk: DataFrame, external: DataFrame, followups: DataFrame, as_of: datetime, strict_year: bool = False) -> DataFrame:
    """SLA feature rows of both ticket worlds.

    Follow-ups are aggregated before the join. ``strict_year`` also keys them by year.
    """
    now = X.moment(as_of)
    keys = ["ticket_id", "source_year"] if strict_year else ["ticket_id"]
    per_ticket = followups.groupBy(*keys).agg(
        F.count("*").alias("followup_count"),
        X.rounded(F.avg(F.col("content_length").cast("decimal(10,2)")), 2).alias("avg_followup_content_length"),
        X.ratio(F.count_if("is_private"), F.count("*")).alias("private_followup_ratio"),
    )
    first = (
        desk.filter(~F.col("is_deleted"))
        .join(per_ticket, keys, "left")
        .select(
            X.rekey("GLPI_", "ticket_pk").alias("sla_feature_pk"), F.col("ticket_pk").alias("source_ticket_pk"),
            F.lit("GLPI").alias("source_system"), "ticket_id", "created_at", "closed_at",
            *[X.map_codes(f"{c}_tier", R.LEVEL_ORDINAL, 1).alias(f"{c}_score") for c in ("priority", "urgency", "impact")],
            X.elapsed("HOUR", "created_at", F.coalesce("closed_at", now)).alias("ticket_age_hours"),
            "resolution_time_hours", "waiting_duration", F.col("takeintoaccount_delay_stat").alias("takeintoaccount_delay"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("followup_count", "private_followup_ratio", "avg_followup_content_length")],
            F.lit(0).alias("is_escalated"), X.is_true(F.col("close_delay_stat") > 0).cast("int").alias("was_sla_breached"),
        )
    )
    second = external.select(
        X.rekey("KAGGLE_", "unified_ticket_pk").alias("sla_feature_pk"), F.col("unified_ticket_pk").alias("source_ticket_pk"),
        F.col("source_dataset").alias("source_system"), F.coalesce("ticket_id", F.lit("0")).alias("ticket_id"),
        "created_at", F.col("resolved_at").alias("closed_at"),
        X.map_codes(X.map_codes(F.lower("priority"), R.EXTERNAL_PRIORITY, "unknown"), R.LEVEL_ORDINAL, 1).alias("priority_score"),
        X.elapsed("HOUR", F.coalesce("created_at", now), F.coalesce("resolved_at", now)).alias("ticket_age_hours"),
        "resolution_time_hours", "issue_complexity_score", "customer_tenure_months", "previous_tickets",
        F.lit(0).alias("followup_count"), F.lit(0.0).alias("private_followup_ratio"), F.lit(0.0).alias("avg_followup_content_length"),
        F.col("is_escalated").cast("int").alias("is_escalated"), F.col("is_sla_breached").cast("int").alias("was_sla_breached"),
    )
    return union_aligned(SLA, first, second)


def asset_failure_risk(assets: DataFrame) -> DataFrame:
    """Rule score 5-20, tier with overrides, and the explanation of the rules that fired."""
    return (
        assets.filter(F.col("source_domain") == "ocs_glpi")
        .withColumn("rule_based_risk_score", S.rule_score())
        .select(
            "asset_pk", "asset_name", "source_domain", "source_year", "asset_age_years", "bios_risk_encoded",
            "drive_health_encoded", "storage_capacity_gb", "drive_count", "memory_gb", "cpu_cores",
            "high_risk_software_count", "risk_software_ratio", "software_installed_count", "incident_count",
            "hardware_incident_count", "days_since_last_inventory", "has_warranty", "glpi_failure_proxy",
            "system_manufacturer", "system_model", "device_type", "rule_based_risk_score",
            S.risk_tier("rule_based_risk_score").alias("risk_tier"),
            S.risk_explanation().alias("risk_explanation"),
            F.lit(None).cast("double").alias("anomaly_score"),
            F.lit(None).cast("bigint").alias("is_anomaly"),
        )
    )


def user_activity_anomalies(users: DataFrame, followups: DataFrame, logs: DataFrame, hardware: DataFrame, as_of: datetime) -> DataFrame:
    """One row per user; each source is aggregated to its key before it meets the users."""
    today = X.moment(as_of).cast("date")
    per_followup = followups.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("*").alias("f_n"),
        F.count_if("is_private").alias("f_private"),
        F.avg(F.col("content_length").cast("decimal(10,2)")).alias("f_len"),
        F.count_if(F.col("contains_url") & ~F.col("has_meaningful_content")).alias("f_suspicious"),
        F.count_distinct(F.to_date("created_at")).alias("f_days"),
        F.date_diff(F.max("created_at"), F.min("created_at")).cast("bigint").alias("f_span"),
    )
    per_log = logs.filter(F.col("has_user") & F.col("has_change")).groupBy(F.lower(F.trim("user_name")).alias("l_key")).agg(
        F.count("*").alias("l_n"),
        F.count_if(F.col("change_type").isin("created", "updated", "deleted")).alias("l_write"),
        F.count_distinct("entity_id").alias("unique_entities_touched"),
        F.count_distinct("entity_type").alias("unique_entity_types"),
        F.max("updated_at").alias("l_last"),
    )
    per_host = hardware.filter(F.col("has_logged_user") & F.col("logged_user").isNotNull()).groupBy(
        F.lower(F.trim("logged_user")).alias("o_key")
    ).agg(F.count("*").alias("ocs_inventory_count"), F.max("last_seen_date").alias("o_last"))
    base = users.select(
        "user_pk", "user_id", F.coalesce("user_name", F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("user_name"),
        "user_type", X.map_codes("user_type", R.USER_TYPE_CODE, 4).alias("user_type_encoded"),
        F.col("is_ldap_user").cast("int").alias("is_ldap_user"), F.col("suspicious_account").cast("int").alias("is_suspicious_user"),
    )
    name = F.lower(F.trim("user_name"))
    joined = (
        base.join(per_followup, "user_id", "left")
        .join(per_log, name == F.col("l_key"), "left")
        .join(per_host, name == F.col("o_key"), "left")
    )

    def zero(col):
        return F.coalesce(X._c(col), F.lit(0))

    present = [F.when(zero(c) > 0, 1).otherwise(0) for c in ("f_n", "l_n", "ocs_inventory_count")]
    staged = joined.withColumns(
        {
            "followup_count": zero("f_n"),
            "log_action_count": zero("l_n"),
            "ocs_inventory_count": zero("ocs_inventory_count"),
            "total_activity_count": zero("f_n") + zero("l_n") + zero("ocs_inventory_count"),
            "active_data_sources": present[0] + present[1] + present[2],
            "distinct_days_active": F.greatest(
                zero("f_days"), zero("f_span"), F.date_diff(today, F.coalesce(F.to_date("l_last"), today)).cast("bigint")
            ),
            "activity_span_days": F.greatest(
                zero("f_span"), F.date_diff(today, F.coalesce(F.to_date("o_last"), today)).cast("bigint")
            ),
        }
    )
    return staged.select(
        "user_pk", "user_id", "user_name", "user_type", "user_type_encoded", "is_ldap_user", "is_suspicious_user",
        "total_activity_count", "followup_count", "log_action_count", "ocs_inventory_count",
        F.coalesce(X.ratio("f_private", "f_n"), F.lit(0.0)).alias("private_followup_ratio"),
        F.coalesce(X.ratio("f_suspicious", "f_n"), F.lit(0.0)).alias("url_content_ratio"),
        X.rounded(F.coalesce(F.col("f_len").cast("double"), F.lit(0.0)), 2).alias("avg_followup_length"),
        zero("unique_entities_touched").alias("unique_entities_touched"),
        zero("unique_entity_types").alias("unique_entity_types"),
        F.coalesce(X.ratio("l_write", "l_n"), F.lit(0.0)).alias("write_action_ratio"),
        "distinct_days_active", "activity_span_days",
        S.activity_density("total_activity_count", "activity_span_days").alias("activity_density"),
        "active_data_sources",
        *[F.lit(None).cast("double").alias(c) for c in ("isolation_forest_score", "lof_score")],
        *[F.lit(None).cast("int").alias(c) for c in ("is_anomaly_if", "is_anomaly_lof")],
    )


SIMILARITY = [
    ("similarity_pk", "string"), ("ticket_pk", "string"), ("source_system", "string"), ("ticket_id", "string"),
    ("created_at", "timestamp_ntz"), ("closed_at", "timestamp_ntz"), ("text_corpus", "string"),
    ("synthetic_text_corpus", "string"), ("similarity_method", "string"), ("embedding_strategy", "string"),
    ("text_source_type", "string"), ("embedding_model", "string"),
    ("priority_encoded", "int"), ("urgency_encoded", "int"), ("impact_encoded", "int"), ("followup_count_bucket", "int"),
    ("corpus_quality_score", "double"), ("similarity_confidence", "double"), ("followup_count", "bigint"),
    ("avg_followup_content_length", "double"), ("private_followup_ratio", "double"), ("url_content_ratio", "double"),
    ("meaningful_content_ratio", "double"), ("has_os_context", "int"), ("has_hardware_context", "int"),
    ("has_bios_context", "int"), ("has_software_context", "int"),
    ("similar_ticket_ids", "string"), ("similarity_scores", "string"),
]


def followup_behaviour(followups: DataFrame) -> DataFrame:
    """Per-ticket statistics and behaviour tokens."""
    n = F.count("*")
    stats = followups.groupBy("ticket_id").agg(
        n.alias("followup_count"),
        F.avg("content_length").alias("avg_length"),
        (F.count_if("is_private") / n).alias("private_share"),
        (F.count_if("contains_url") / n).alias("url_share"),
        (F.count_if("has_meaningful_content") / n).alias("meaningful_share"),
    )
    return stats.withColumn("followup_behavior_tokens", S.behaviour_tokens())


def computer_infrastructure(computers: DataFrame, hardware: DataFrame, bios: DataFrame, software: DataFrame) -> DataFrame:
    """Best inventory context per computer row.

    The rank among several matching hosts depends on the computer only, so it is settled here, on
    the small side, before any ticket is joined.
    """
    known = F.when(F.col("computer_uuid") != "unknown", F.lower("computer_uuid"))
    host = hardware.select(
        "hardware_pk", "hardware_id", F.col("source_year").alias("host_year"), "uuid", "normalized_hostname",
        "os_family", "memory_gb", "cpu_cores", "memory_tier", "last_seen_date",
    )
    best = best_by_rules(
        computers.select("unique_id", "computer_id", "computer_uuid", "computer_name", F.col("source_year").alias("computer_year")),
        host,
        [
            ([known], [F.lower("uuid")]),
            ([F.lower("computer_name"), F.col("computer_year")], [F.col("normalized_hostname"), F.col("host_year")]),
        ],
        [F.col("last_seen_date").isNull(), -F.unix_micros(F.col("last_seen_date").cast("timestamp")), F.col("hardware_pk")],
        ["hardware_pk", "hardware_id", "host_year", "os_family", "memory_gb", "cpu_cores", "memory_tier", "last_seen_date"],
    )
    firmware = bios.select("hardware_id", F.col("source_year").alias("host_year"), "bios_age_years", "bios_risk_level")
    risk = software_summary(software).select(
        "hardware_id", F.col("source_year").alias("host_year"),
        F.col("software_installed_count").alias("total_software_count"), "high_risk_software_count",
    )
    context = (
        best.join(firmware, ["hardware_id", "host_year"], "left")
        .join(risk, ["hardware_id", "host_year"], "left")
        .select(
            "computer_id", "unique_id", F.coalesce(F.col("computer_uuid") != "unknown", F.lit(False)).alias("has_identity"),
            "hardware_pk", "last_seen_date", "os_family", "memory_gb", "bios_risk_level", "high_risk_software_count",
            S.infrastructure_tokens().alias("infra_tokens"),
        )
    )
    # a ticket's year is the same for all contexts of its computer, so only the best of them can be picked
    return latest_per_key(
        context, "computer_id",
        [F.when(F.col("has_identity"), 0).otherwise(1), F.col("last_seen_date").desc_nulls_last(), F.col("unique_id").asc_nulls_last()],
    )


def ticket_infrastructure(bronze_tickets: DataFrame, context: DataFrame) -> DataFrame:
    """One infrastructure context per ticket id: known identity first, then the latest inventory."""
    joined = bronze_tickets.select(
        F.col("id").alias("infra_ticket_id"), F.col("source_year").alias("infra_year"), F.col("items_id").alias("computer_id")
    ).join(context, "computer_id", "left")
    return latest_per_key(
        joined, "infra_ticket_id",
        [
            F.when(F.col("has_identity"), 0).otherwise(1), F.col("last_seen_date").desc_nulls_last(),
            F.col("infra_year"), F.col("unique_id").asc_nulls_last(),
        ],
    )


def ticket_similarity(desk, followups, bronze_tickets, computers, hardware, bios, software, external) -> DataFrame:
    infra = ticket_infrastructure(bronze_tickets, computer_infrastructure(computers, hardware, bios, software)).withColumn(
        "infra_tokens", F.coalesce("infra_tokens", F.lit(""))
    )
    tokens = desk.filter(~F.col("is_deleted")).select(
        "ticket_pk", "ticket_id", "created_at", "closed_at", S.ticket_tokens().alias("tokens")
    )
    joined = tokens.join(followup_behaviour(followups), "ticket_id", "left").join(
        infra,
        (F.col("ticket_id") == F.col("infra_ticket_id")) & F.year("created_at").eqNullSafe(F.col("infra_year")),
        "left",
    )

    def share(col: str, digits: int):
        return F.coalesce(X.rounded(col, digits), F.lit(0.0))

    def seen(col: str):
        return F.col(col).isNotNull().cast("int")

    synthetic = joined.select(
        X.rekey("GLPI_SIM_", "ticket_pk").alias("similarity_pk"), "ticket_pk", F.lit("GLPI").alias("source_system"), "ticket_id",
        "created_at", "closed_at",
        F.concat_ws(" ", "tokens", F.coalesce("followup_behavior_tokens", F.lit("")), F.coalesce("infra_tokens", F.lit(""))).alias(
            "synthetic_text_corpus"
        ),
        S.level_from_tokens("prio", "tokens").alias("priority_encoded"),
        S.level_from_tokens("urg", "tokens").alias("urgency_encoded"),
        S.level_from_tokens("impact", "tokens").alias("impact_encoded"),
        X.tier(F.coalesce("followup_count", F.lit(0)), R.FOLLOWUP_BUCKET_CUTS, 5).alias("followup_count_bucket"),
        F.lit("synthetic_context").alias("text_source_type"), F.lit("synthetic_context").alias("similarity_method"),
        F.lit("structured_metadata").alias("embedding_strategy"),
        S.richness("infra_tokens", "followup_behavior_tokens", (0.30, 0.50, 0.70)).alias("corpus_quality_score"),
        S.richness("infra_tokens", "followup_behavior_tokens", (0.25, 0.45, 0.65)).alias("similarity_confidence"),
        F.coalesce("followup_count", F.lit(0)).alias("followup_count"),
        share("avg_length", 2).alias("avg_followup_content_length"), share("private_share", 4).alias("private_followup_ratio"),
        share("url_share", 4).alias("url_content_ratio"), share("meaningful_share", 4).alias("meaningful_content_ratio"),
        seen("os_family").alias("has_os_context"), seen("memory_gb").alias("has_hardware_context"),
        seen("bios_risk_level").alias("has_bios_context"),
        (F.coalesce("high_risk_software_count", F.lit(0)) > 0).cast("int").alias("has_software_context"),
    )
    zero_cols = (
        "followup_count avg_followup_content_length private_followup_ratio url_content_ratio meaningful_content_ratio "
        "has_os_context has_hardware_context has_bios_context has_software_context"
    ).split()
    real = external.select(
        X.rekey("KAGGLE_SIM_", "unified_ticket_pk").alias("similarity_pk"), F.col("unified_ticket_pk").alias("ticket_pk"),
        F.col("source_dataset").alias("source_system"), F.coalesce("ticket_id", F.lit("0")).alias("ticket_id"),
        "created_at", F.col("resolved_at").alias("closed_at"),
        F.concat(
            F.coalesce(X.null_if_blank("ticket_subject"), F.lit("")), F.lit(" "), F.coalesce(X.null_if_blank("ticket_body"), F.lit(""))
        ).alias("text_corpus"),
        F.lit("real_text").alias("text_source_type"), F.lit("nlp_embedding").alias("similarity_method"),
        F.lit(R.EMBEDDING_MODEL).alias("embedding_model"), F.lit("nlp_semantic").alias("embedding_strategy"),
        F.lit(1.0).alias("corpus_quality_score"), F.lit(0.90).alias("similarity_confidence"),
        *[F.lit(0).alias(c) for c in zero_cols],
    )
    return union_aligned(SIMILARITY, synthetic, real)
