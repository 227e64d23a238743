"""Silver models: unified tickets, triage scores, security events, assets and user activity."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X, scores as S
from ticketlake.operators.relational import best_by_rules, latest_per_key, union_aligned

TICKET = [
    ("event_pk", "string"), ("source_system", "string"), ("source_id", "string"), ("source_year", "int"),
    ("created_at", "timestamp_ntz"), ("solved_at", "timestamp_ntz"), ("closed_at", "timestamp_ntz"),
    ("priority", "string"), ("ticket_status", "string"), ("resolution_time_hours", "double"),
    ("is_escalated", "boolean"), ("is_sla_breached", "boolean"), ("language", "string"), ("region", "string"),
    ("category", "string"), ("ticket_subject", "string"), ("ticket_body", "string"),
    ("waiting_duration", "bigint"), ("first_response_time_hours", "double"),
    ("customer_satisfaction_score", "double"), ("issue_complexity_score", "double"),
    ("customer_tenure_months", "int"), ("previous_tickets", "int"),
]


def external_status(col="ticket_status"):
    text = F.lower(col)
    return (
        F.when(text.isin("closed", "resolved", "open", "escalated"), text)
        .when(text.contains("progress"), "in_progress")
        .otherwise("unknown")
    )


def tickets(desk: DataFrame, external: DataFrame) -> DataFrame:
    first = desk.filter(~F.col("is_deleted")).select(
        X.rekey("GLPI_", "ticket_pk").alias("event_pk"),
        F.lit("GLPI").alias("source_system"),
        F.col("ticket_id").alias("source_id"),
        "source_year", "created_at", "solved_at", "closed_at",
        F.col("priority_tier").alias("priority"),
        X.map_codes("status", R.DESK_STATUS, "unknown").alias("ticket_status"),
        "resolution_time_hours", "waiting_duration",
        F.lit(False).alias("is_escalated"), F.lit(False).alias("is_sla_breached"),
    )
    second = external.withColumns(
        {
            "event_pk": X.rekey("KAGGLE_", "unified_ticket_pk"),
            "source_system": F.col("source_dataset"),
            "source_id": F.coalesce("ticket_id", F.lit("0")),
            "closed_at": F.col("resolved_at"),
            "priority": X.map_codes(F.lower("priority"), R.EXTERNAL_PRIORITY, "unknown"),
            "ticket_status": external_status(),
        }
    )
    closed = F.col("ticket_status") == "closed"
    both = closed & F.col("closed_at").isNotNull() & F.col("created_at").isNotNull()
    return union_aligned(TICKET, first, second).withColumns(
        {
            "resolution_time_hours": F.when(both, X.elapsed("HOUR", "created_at", "closed_at").cast("double")).otherwise(
                F.col("resolution_time_hours")
            ),
            "is_closed": closed,
            "priority_score": X.map_codes("priority", R.LEVEL_ORDINAL, 1),
            "complexity_level": X.tier("issue_complexity_score", R.COMPLEXITY_CUTS, "unknown"),
        }
    )


def triage_features(unified: DataFrame, as_of: datetime) -> DataFrame:
    def zero(col: str, dtype: str):
        return F.coalesce(F.col(col), F.lit(0)).cast(dtype)

    features = unified.select(
        F.col("event_pk").alias("ticket_fk"), "source_system", "source_id", "created_at", "closed_at",
        X.elapsed("HOUR", "created_at", F.coalesce("closed_at", X.moment(as_of))).alias("ticket_age_hours"),
        zero("resolution_time_hours", "double").alias("resolution_time_hours"),
        "priority_score",
        F.col("is_escalated").cast("int").alias("was_escalated"),
        F.col("is_sla_breached").cast("int").alias("was_sla_breached"),
        zero("customer_satisfaction_score", "double").alias("satisfaction_score"),
        zero("issue_complexity_score", "double").alias("complexity_score"),
        zero("customer_tenure_months", "int").alias("tenure_months"),
        zero("previous_tickets", "int").alias("previous_tickets"),
    )
    scored = features.withColumns(
        {
            "sla_risk_score": S.sla_risk("priority_score", "complexity_score", "ticket_age_hours", "previous_tickets", "satisfaction_score"),
            "escalation_probability": S.escalation_probability(
                "priority_score", "was_escalated", "ticket_age_hours", "complexity_score", "satisfaction_score"
            ),
        }
    )
    return scored.withColumns(
        {
            "age_severity": X.tier("ticket_age_hours", R.AGE_SEVERITY_CUTS, "unknown"),
            "customer_type": X.tier("previous_tickets", R.CUSTOMER_TYPE_CUTS, "new"),
            "triage_priority": X.tier("sla_risk_score", R.TRIAGE_CUTS, "low"),
            "escalation_risk_level": X.tier("escalation_probability", R.ESCALATION_CUTS, "low"),
        }
    )


SECURITY = [
    ("security_event_pk", "string"), ("event_type", "string"), ("event_date", "timestamp_ntz"),
    ("updated_at", "timestamp_ntz"), ("severity_level", "string"), ("event_description", "string"),
    ("cwe_code", "bigint"), ("cwe_name", "string"), ("cvss_score", "double"),
    ("is_remote_exploitable", "boolean"), ("is_critical", "boolean"), ("easy_to_exploit", "boolean"),
    ("access_vector", "string"), ("access_complexity", "string"), ("access_authentication", "string"),
    ("impact_confidentiality", "string"), ("impact_integrity", "string"), ("impact_availability", "string"),
    ("machine_name", "string"), ("event_source", "string"), ("country", "string"),
]


def security_events(cve: DataFrame, eventlog: DataFrame, desk: DataFrame) -> DataFrame:
    never = {"is_remote_exploitable": F.lit(False), "easy_to_exploit": F.lit(False)}
    severe = F.col("severity_level").isin("critical", "high")
    a = cve.withColumns(
        {
            "security_event_pk": X.rekey("CVE_", "cve_pk"), "event_type": F.lit("CVE"),
            "event_date": F.col("published_at"), "updated_at": F.col("modified_at"),
            "event_description": F.col("cve_summary"),
        }
    )
    b = eventlog.withColumns(
        {
            "security_event_pk": X.rekey("WINLOG_", "eventlog_pk"), "event_type": F.lit("WINDOWS_EVENT"),
            "event_date": F.col("generated_at"), "is_critical": severe, **never,
            "event_description": F.coalesce("event_message", F.concat("event_source", F.lit(": "), "event_category")),
        }
    )
    c = desk.filter(F.col("priority_tier").isin("critical", "high")).select(
        X.rekey("TICKET_SEC_", "ticket_pk").alias("security_event_pk"), F.lit("TICKET").alias("event_type"),
        F.col("created_at").alias("event_date"), F.col("closed_at").alias("updated_at"),
        F.col("priority_tier").alias("severity_level"), F.lit(True).alias("is_critical"),
        F.lit("GLPI").alias("event_source"), *[v.alias(k) for k, v in never.items()],
    )
    return (
        union_aligned(SECURITY, a, b, c)
        .withColumn("last_updated", F.coalesce("updated_at", "event_date"))
        .withColumn("severity_score", X.map_codes("severity_level", R.LEVEL_ORDINAL, 1))
        .drop("updated_at")
    )


def computer_incidents(desk: DataFrame) -> DataFrame:
    """Distinct ticket counts per computer in two partial aggregations, no Expand and no hot group."""
    critical = F.col("is_incident") & (F.col("priority") >= 4)
    per_ticket = (
        desk.filter((F.lower("item_type") == "computer") & F.col("items_id").isNotNull())
        .groupBy("items_id", "ticket_id")
        .agg(F.max("is_incident").alias("hw"), F.max(critical).alias("crit"))
    )
    return per_ticket.groupBy(F.col("items_id").alias("computer_id")).agg(
        F.count("*").alias("incident_count"),
        F.count_if("hw").alias("hardware_incident_count"),
        F.count_if("crit").alias("critical_hardware_incidents"),
    )


def drive_summary(drives: DataFrame) -> DataFrame:
    return (
        drives.filter(F.col("drive_type") == "fixed")
        .groupBy("source_year", "hardware_id")
        .agg(
            F.count_distinct("drive_pk").alias("drive_count"),
            F.round(F.sum(F.coalesce("total_size_gb", F.lit(0.0))), 2).alias("storage_capacity_gb"),
            F.max(X.map_codes("storage_health", R.DRIVE_HEALTH_ORDINAL, None)).alias("drive_health_encoded"),
        )
    )


def software_summary(software: DataFrame) -> DataFrame:
    risky = F.count_if(F.col("software_risk_level").isin("critical", "high"))
    return software.groupBy("source_year", "hardware_id").agg(
        F.count("*").alias("software_installed_count"),
        risky.alias("high_risk_software_count"),
        X.ratio(risky, F.count("*")).alias("risk_software_ratio"),
    )


def assets(hardware, bios, computers, infocoms, desk, drives, software, as_of: datetime) -> DataFrame:
    """One row per asset: inventory, firmware, finance, incidents, drives and software."""
    now = X.moment(as_of)
    base = hardware.select(
        F.col("hardware_pk").alias("asset_pk"), "hardware_id",
        F.coalesce("normalized_hostname", F.concat(F.lit("unknown-"), F.col("hardware_id").cast("string"))).alias("asset_name"),
        "uuid", "cpu_cores", "memory_gb", "last_inventory_date", "last_seen_date", "source_year",
    )
    machines = computers.filter(~F.col("is_template") & ~F.col("is_deleted")).select(
        F.col("unique_id").alias("machine_pk"), "computer_id", "computer_uuid", "computer_name",
        F.col("source_year").alias("machine_year"),
    )
    # of several matching machines the smallest computer counts
    matched = best_by_rules(
        base, machines,
        [
            ([F.lower("uuid")], [F.lower("computer_uuid")]),
            ([F.lower("asset_name"), F.col("source_year")], [F.lower("computer_name"), F.col("machine_year")]),
        ],
        [F.col("computer_id").isNull(), F.col("computer_id"), F.col("machine_pk")], ["computer_id"],
    )
    finance = infocoms.filter(F.col("item_type") == "Computer").select(
        F.col("item_id").alias("computer_id"), "has_warranty", "buy_date"
    )
    firmware = bios.select(
        "source_year", "hardware_id", "system_manufacturer", "system_model", "serial_number", "device_type",
        "bios_age_years", X.map_codes("bios_risk_level", R.RISK_ORDINAL, None).alias("bios_risk_encoded"),
    )
    joined = (
        matched.join(firmware, ["source_year", "hardware_id"], "left")
        .join(finance, "computer_id", "left")
        .join(computer_incidents(desk), "computer_id", "left")
        .join(drive_summary(drives), ["source_year", "hardware_id"], "left")
        .join(software_summary(software), ["source_year", "hardware_id"], "left")
    )
    zeros = {
        "drive_health_encoded": 0, "storage_capacity_gb": 0.0, "drive_count": 0, "memory_gb": 0.0, "cpu_cores": 0,
        "high_risk_software_count": 0, "risk_software_ratio": 0.0, "software_installed_count": 0,
        "incident_count": 0, "hardware_incident_count": 0,
    }
    picked = latest_per_key(
        joined,
        F.coalesce("uuid", "asset_name"),
        [F.col("last_inventory_date").desc_nulls_last(), F.col("asset_pk"), F.col("computer_id").asc_nulls_last()],
    )
    return picked.select(
        "asset_pk", "asset_name", F.lit("ocs_glpi").alias("source_domain"),
        "system_manufacturer", "system_model", "serial_number", "device_type", "uuid", "source_year",
        "last_inventory_date", "last_seen_date",
        F.coalesce(X.elapsed("YEAR", "buy_date", now), "bios_age_years", F.lit(0)).cast("bigint").alias("asset_age_years"),
        "bios_risk_encoded",
        *[F.coalesce(c, F.lit(v)).alias(c) for c, v in zeros.items()],
        F.coalesce(
            X.elapsed("DAY", "last_seen_date", now), X.elapsed("DAY", "last_inventory_date", now), F.lit(-1)
        ).cast("bigint").alias("days_since_last_inventory"),
        F.coalesce("has_warranty", F.lit(False)).alias("has_warranty"),
        S.failure_proxy("hardware_incident_count", "critical_hardware_incidents").alias("glpi_failure_proxy"),
    )


ACTIVITY = [
    ("activity_pk", "string"), ("user_id", "bigint"), ("activity_date", "timestamp_ntz"), ("activity_type", "string"),
    ("entity_id", "bigint"), ("entity_type", "string"), ("visibility", "string"),
    ("has_meaningful_content", "boolean"), ("contains_url", "boolean"), ("details", "string"),
]


def distinct_accounts(users: DataFrame) -> DataFrame:
    """First account per case-insensitive name."""
    return latest_per_key(users, F.lower(F.coalesce("user_name", F.lit(""))), [F.col("user_id")]).select(
        "user_id", "user_name",
        F.coalesce("user_name", F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("username"),
        F.coalesce("full_name", "user_name").alias("display_name"),
        "user_type", "is_ldap_user", F.col("suspicious_account").alias("is_suspicious_user"),
    )


def user_activity(users: DataFrame, followups: DataFrame, logs: DataFrame, hardware: DataFrame) -> DataFrame:
    accounts = distinct_accounts(users)
    names = accounts.select(F.col("user_id").alias("account_id"), F.lower(F.coalesce("user_name", F.lit(""))).alias("account_key"))

    def blank(col: str):
        return F.coalesce(F.col(col), F.lit(""))

    def key(kind: str, *cols):
        return F.md5(X.composite_key(F.lit(kind), *cols, sep="|"))

    a = followups.filter(F.col("user_id").isNotNull()).select(
        key("TICKET", "ticket_followup_pk", "user_id").alias("activity_pk"), "user_id",
        F.col("created_at").alias("activity_date"), F.lit("ticket_followup").alias("activity_type"),
        F.col("ticket_id").alias("entity_id"), F.lit("ticket").alias("entity_type"),
        F.when(F.col("is_private"), "private").otherwise("public").alias("visibility"),
        "has_meaningful_content", "contains_url",
    )
    b = logs.filter(F.col("has_user") & F.col("has_change")).join(names, F.lower(blank("user_name")) == F.col("account_key")).select(
        key("LOG", "unique_id", "account_id").alias("activity_pk"), F.col("account_id").alias("user_id"),
        F.col("updated_at").alias("activity_date"), F.concat(F.lit("entity_"), "change_type").alias("activity_type"),
        "entity_id", "entity_type",
        F.concat(blank("linked_action"), F.lit(": "), blank("old_value"), F.lit(" -> "), blank("new_value")).alias("details"),
    )
    seen = hardware.filter(F.col("has_logged_user") & F.col("last_seen_date").isNotNull())
    c = seen.join(names, F.lower(blank("logged_user")) == F.col("account_key")).select(
        key("OCS", "hardware_pk", "account_id", "last_seen_date").alias("activity_pk"), F.col("account_id").alias("user_id"),
        F.col("last_seen_date").alias("activity_date"), F.lit("inventory_seen").alias("activity_type"),
        F.col("hardware_id").alias("entity_id"), F.lit("computer").alias("entity_type"),
        F.concat(
            F.lit("hostname: "), F.coalesce("hostname", F.lit("unknown")), F.lit(" | os: "), F.coalesce("os_family", F.lit("unknown"))
        ).alias("details"),
    )
    # one row per activity before the accounts are joined; ties go to the smallest user, entity and details
    latest = latest_per_key(
        union_aligned(ACTIVITY, a, b, c), "activity_pk", [F.col("activity_date").desc_nulls_last(), F.col("user_id"), F.col("entity_id"), F.col("details")]
    )
    enriched = latest.join(accounts.drop("user_name"), "user_id")
    flagged = enriched.withColumns(
        {
            "is_suspicious_activity": S.suspicious_activity("is_suspicious_user", "user_type", "contains_url", "has_meaningful_content"),
            "activity_category": S.activity_category("activity_type"),
        }
    )
    return flagged.select(
        "activity_pk", "user_id", "username", "display_name", "user_type", "is_ldap_user", "is_suspicious_user",
        "activity_date", "activity_type", "activity_category", "entity_id", "entity_type", "visibility",
        "is_suspicious_activity", "details",
    )
