"""Staging models of the external data sets. All are de-duplicated on whole rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X

#: target schema of the unified external tickets (44 columns)
EXTERNAL_TICKET = [
    ("unified_ticket_pk", "string"), ("source_dataset", "string"), ("ticket_id", "string"),
    ("customer_name", "string"), ("customer_email", "string"), ("customer_segment", "string"),
    ("customer_age", "int"), ("customer_gender", "string"), ("subscription_type", "string"),
    ("customer_tenure_months", "int"), ("previous_tickets", "int"), ("customer_satisfaction_score", "double"),
    ("product", "string"), ("category", "string"), ("ticket_subject", "string"), ("ticket_body", "string"),
    ("resolution_notes", "string"), ("priority", "string"), ("ticket_status", "string"),
    ("communication_channel", "string"), ("region", "string"), ("language", "string"),
    ("payment_method", "string"), ("preferred_contact_time", "string"), ("operating_system", "string"),
    ("browser", "string"), ("first_response_time_hours", "double"), ("resolution_time_hours", "double"),
    ("issue_complexity_score", "double"), ("is_escalated", "boolean"), ("is_sla_breached", "boolean"),
    ("created_at", "timestamp_ntz"), ("resolved_at", "timestamp_ntz"), ("answer", "string"),
    ("queue", "string"), ("software_version", "string"),
    *[(f"tag_{i}", "string") for i in range(1, 9)],
]


def cve(bronze: DataFrame) -> DataFrame:
    lowered = (
        "access_authentication", "access_complexity", "access_vector",
        "impact_availability", "impact_confidentiality", "impact_integrity",
    )
    return bronze.select(
        X.md5_key("unnamed_0", "pub_date").alias("cve_pk"),
        F.col("unnamed_0").alias("original_index"),
        F.col("cwe_code").cast("bigint").alias("cwe_code"),
        X.null_if_blank("cwe_name").alias("cwe_name"),
        X.null_if_blank("summary").alias("cve_summary"),
        X.clean_ts("pub_date").alias("published_at"),
        X.clean_ts("mod_date").alias("modified_at"),
        F.round(X.within("cvss", 0, 10), 1).alias("cvss_score"),
        X.tier("cvss", R.CVSS_CUTS, "unknown").alias("severity_level"),
        *[X.lower_or_null(c).alias(c) for c in lowered],
        X.is_true(F.lower("access_vector") == "network").alias("is_remote_exploitable"),
        X.is_true(F.col("cvss") >= 9).alias("is_critical"),
        X.is_true(F.lower("access_complexity") == "low").alias("easy_to_exploit"),
    ).distinct()


def harddrive(bronze: DataFrame) -> DataFrame:
    pending = X.is_true(F.col("smart_197_raw") > 0) | X.is_true(F.col("smart_198_raw") > 0)
    failed = X.is_one("failure")
    renamed = [
        ("smart_5_raw", "reallocated_sectors"), ("smart_9_raw", "power_on_hours"),
        ("smart_187_raw", "reported_uncorrectable_errors"), ("smart_188_raw", "command_timeout"),
        ("smart_197_raw", "current_pending_sector_count"), ("smart_198_raw", "offline_uncorrectable"),
        ("smart_199_raw", "udma_crc_errors"), ("smart_194_raw", "temperature_celsius"),
    ]
    flags = [
        ("smart_5_raw", "has_reallocated_sectors"), ("smart_197_raw", "has_pending_sectors"),
        ("smart_198_raw", "has_uncorrectable_sectors"), ("smart_199_raw", "has_crc_errors"),
    ]
    return bronze.select(
        X.md5_key("serial_number", "date").alias("harddrive_pk"),
        X.null_if_blank("serial_number").alias("serial_number"),
        X.null_if_blank("model").alias("model_name"),
        X.clean_date("date").alias("snapshot_date"),
        X.scaled(X.positive("capacity_bytes"), 1024**3).alias("capacity_gb"),
        failed.alias("has_failed"),
        *[F.col(a).alias(b) for a, b in renamed],
        *[X.is_true(F.col(a) > 0).alias(b) for a, b in flags],
        F.when(failed, "failed").when(pending, "critical")
        .when(F.col("smart_5_raw") > 0, "warning").otherwise("healthy").alias("health_status"),
        F.when(failed, 100.0).otherwise(
            sum((F.coalesce(c, F.lit(0.0)) for c in ("smart_197_raw", "smart_198_raw")), F.coalesce("smart_5_raw", F.lit(0.0)))
        ).alias("disk_risk_score"),
    ).distinct()


def laptop_price(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        X.md5_key("laptop_ID", "Product").alias("laptop_pk"),
        F.col("laptop_ID").alias("laptop_id"),
        X.null_if_blank("Company").alias("company"),
        X.null_if_blank("Product").alias("product_name"),
        X.lower_or_null("TypeName").alias("laptop_type"),
        F.col("Inches").alias("screen_size_inches"),
        X.null_if_blank("ScreenResolution").alias("screen_resolution"),
        X.is_true(X.contains_any("ScreenResolution", "ips")).alias("has_ips_panel"),
        X.is_true(X.contains_any("ScreenResolution", "touch")).alias("has_touchscreen"),
        X.null_if_blank("Cpu").alias("cpu_name"),
        X.classify("Cpu", R.LAPTOP_CPU, "other").alias("cpu_family"),
        X.null_if_blank("Ram").alias("ram_raw"),
        X.without_suffix("Ram", "gb", "bigint").alias("ram_gb"),
        X.null_if_blank("Memory").alias("storage_configuration"),
        X.is_true(X.contains_any("Memory", "ssd")).alias("has_ssd"),
        X.is_true(X.contains_any("Memory", "hdd")).alias("has_hdd"),
        X.null_if_blank("Gpu").alias("gpu_name"),
        X.classify("Gpu", R.LAPTOP_GPU, "Other").alias("gpu_brand"),
        X.lower_or_null("OpSys").alias("operating_system"),
        X.null_if_blank("Weight").alias("weight_raw"),
        X.without_suffix("Weight", "kg", "decimal(5,2)").cast("double").alias("weight_kg"),
        F.round(X.within("Price_euros", low=0), 2).alias("price_euros"),
        X.tier("Price_euros", R.PRICE_CUTS, "unknown").alias("price_segment"),
    ).distinct()


def windows_eventlog(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        X.md5_key("unnamed_0", "MachineName", "TimeGenerated").alias("eventlog_pk"),
        F.col("unnamed_0").alias("original_index"),
        X.null_if_blank("MachineName").alias("machine_name"),
        X.lower_or_null("Category").alias("event_category"),
        X.lower_or_null("EntryType").alias("entry_type"),
        X.null_if_blank("Message").alias("event_message"),
        X.lower_or_null("Source").alias("event_source"),
        X.clean_ts("TimeGenerated").alias("generated_at"),
        *[X.lower_or_null(a).alias(b) for a, b in (("country", "country"), ("regionName", "region_name"), ("city", "city"))],
        F.col("zip").alias("zip_code"),
        X.null_if_blank("timezone").alias("timezone"),
        X.null_if_blank("isp").alias("isp"),
        X.classify("EntryType", R.EVENT_SEVERITY, "informational").alias("severity_level"),
        X.is_true(X.contains_any("Message", R.EVENT_SUSPICION)).alias("suspicious_activity"),
        X.is_true(X.contains_any("EntryType", "error")).alias("is_error_event"),
        X.is_true(X.contains_any("EntryType", "warning")).alias("is_warning_event"),
        X.classify("Source", R.EVENT_DOMAIN, "other").alias("event_domain"),
    ).distinct()


def external_tickets(support: DataFrame, multilang: DataFrame) -> DataFrame:
    """Two ticket data sets on one schema; the distinct runs on the union."""
    lowered = (
        "customer_email customer_gender subscription_type category priority region language payment_method "
        "preferred_contact_time operating_system browser"
    ).split()
    trimmed = "customer_name customer_segment product resolution_notes".split()
    first = support.withColumns(
        {
            **{c: X.lower_or_null(c) for c in lowered},
            **{c: X.null_if_blank(c) for c in trimmed},
            "unified_ticket_pk": X.rekey("support_", "ticket_id"),
            "ticket_subject": X.null_if_blank("issue_description"),
            "ticket_body": X.null_if_blank("issue_description"),
            "ticket_status": X.lower_or_null("status"),
            "communication_channel": X.lower_or_null("channel"),
            "is_escalated": X.text_bool("escalated"),
            "is_sla_breached": X.text_bool("sla_breached"),
            "created_at": X.clean_ts("ticket_created_date"),
            "resolved_at": X.clean_ts("ticket_resolved_date"),
        }
    )
    second = multilang.withColumns(
        {
            "unified_ticket_pk": X.md5_key("subject", "body", prefix="multi_"),
            "category": X.lower_or_null("type"),
            "ticket_subject": X.null_if_blank("subject"),
            "ticket_body": X.null_if_blank("body"),
            "priority": X.lower_or_null("priority"),
            "ticket_status": F.lit("resolved"),
            "language": X.lower_or_null("language"),
            "is_escalated": F.lit(False),
            "is_sla_breached": F.lit(False),
            "answer": X.null_if_blank("answer"),
            "queue": X.lower_or_null("queue"),
            "software_version": F.col("version"),
            **{f"tag_{i}": X.null_if_blank(f"tag_{i}") for i in range(1, 9)},
        }
    )
    return X.align(first, EXTERNAL_TICKET).unionByName(X.align(second, EXTERNAL_TICKET)).distinct()
