"""Scores, tiers, explanations and metadata tokens."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X


def _num(col) -> Column:
    return F.coalesce(X._c(col).cast("double"), F.lit(0.0))


def _step(col, cuts, default) -> Column:
    return X.tier(col, cuts, default)


def sla_risk(priority, complexity, age_hours, previous, satisfaction) -> Column:
    age = _step(age_hours, [(">", 72, 3), (">", 24, 1)], 0)
    prev = _step(previous, [(">", 5, 5), (">", 2, 3)], 1)
    sat = _step(satisfaction, [("<", 3, 3), ("<", 5, 1)], 0)
    return X.rounded(_num(priority) * 0.35 + _num(complexity) * 0.20 + age * 0.15 + prev * 0.15 + sat * 0.15, 2)


def escalation_probability(priority, escalated, age_hours, complexity, satisfaction) -> Column:
    raw = (
        _num(priority) * 0.25
        + F.when(X._c(escalated) == 1, 3).otherwise(0) * 0.25
        + _step(age_hours, [(">", 48, 3)], 0) * 0.20
        + _num(complexity) * 0.20
        + _step(satisfaction, [("<", 3, 2)], 0) * 0.10
    )
    return X.rounded(F.least(raw, F.lit(10.0)), 2)


def rule_score(components=R.RISK_COMPONENTS) -> Column:
    """Sum of one 1-4 grade per component."""
    return reduce(lambda a, b: a + b, [X.tier(c, cuts, 1) for c, cuts in components])


def risk_tier(score) -> Column:
    """Overrides first (failure evidence, many incidents), then score cuts."""
    return (
        F.when(F.col("glpi_failure_proxy") == 1, "high")
        .when(F.col("incident_count") >= 5, "high")
        .otherwise(X.tier(score, R.RISK_TIER_CUTS, "info"))
    )


def explain(rules: list[tuple[Column, Column]], sep: str = "; ") -> Column:
    """Join the texts of the rules that fire, in rule order."""
    return F.concat_ws(sep, *[F.when(cond, text) for cond, text in rules])


def risk_explanation() -> Column:
    def count(label: str, col: str, unit: str = "") -> Column:
        return F.concat(F.lit(label), F.col(col).cast("string"), F.lit(unit))

    hw = F.col("hardware_incident_count")
    return explain(
        [
            (F.col("asset_age_years") >= 10, count("old_asset:", "asset_age_years", "yrs")),
            (F.col("drive_health_encoded") >= 3, F.lit("drive_health_critical")),
            (F.col("drive_health_encoded") == 2, F.lit("drive_health_degraded")),
            (F.col("high_risk_software_count") > 2, count("risky_software:", "high_risk_software_count")),
            (F.col("bios_risk_encoded") >= 3, F.lit("bios_outdated")),
            (F.col("days_since_last_inventory") >= 180, count("stale_inventory:", "days_since_last_inventory", "days")),
            (F.col("glpi_failure_proxy") == 1, F.lit("hardware_failure_evidence")),
            (hw >= 3, count("repeat_hw_incidents:", "hardware_incident_count")),
            ((hw >= 1) & (hw < 3), count("hw_incidents:", "hardware_incident_count")),
        ]
    )


def failure_proxy(incidents, critical) -> Column:
    return F.when((X._c(incidents) >= 2) | (X._c(critical) >= 1), 1).otherwise(0)


def triage_escalation(priority, urgency, impact, threshold: float = R.ESCALATION_THRESHOLD, strict: bool = True):
    """Level-weighted risk in 0..1 and the escalate flag (``strict``: above, else at or above)."""
    w = R.ESCALATION_WEIGHTS
    raw = (
        (X._c(priority) - 2) / 3.0 * w["priority"]
        + (X._c(urgency) - 2) / 3.0 * w["urgency"]
        + (X._c(impact) - 3) / 2.0 * w["impact"]
    )
    risk = X.rounded(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)), 4)
    return risk, (risk > threshold if strict else risk >= threshold)


def text_escalation():
    """Text-only heuristic risk, clipped to 0..1, and its high-risk flag."""
    w = R.TEXT_RISK_WEIGHTS
    raw = (
        _num("retrieval_quality_score") * w["retrieval_quality_score"]
        + _num("text_complexity_score") / 10.0 * w["text_complexity_score"]
        + _num("special_char_ratio") * w["special_char_ratio"]
        + _num("digit_ratio") * w["digit_ratio"]
    )
    risk = F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))
    return risk, (risk >= R.ESCALATION_THRESHOLD).cast("int")


def pair_escalation() -> Column:
    """Composite of level, issue complexity, SLA risk and the two text complexities."""
    return (
        F.col("priority_encoded") * 0.25
        + F.col("issue_complexity_score") * 0.25
        + F.col("sla_risk_score") * 0.20
        + F.col("problem_complexity_score") * 0.15
        + F.col("solution_complexity_score") * 0.15
    )


# ---- tokens ---------------------------------------------------------------------------------------
_LEVELS = ("critical", "high", "medium", "low")


def level_token(prefix: str, col) -> Column:
    return X.map_codes(col, [(v, f"{prefix}_{v}") for v in _LEVELS], f"{prefix}_unknown")


def level_from_tokens(prefix: str, tokens) -> Column:
    """Recover the ordinal of a level from a token string."""
    return X.classify(tokens, [(f"{prefix}_{v}", n) for v, n in R.LEVEL_ORDINAL], 1)


def ticket_tokens() -> Column:
    """Metadata token string of a staged ticket."""
    status = F.col("status").cast("string")
    closed = status.isin("5", "6")
    waiting = F.coalesce("waiting_duration", F.lit(0))
    hours = F.coalesce("resolution_time_hours", F.lit(0))
    return F.concat_ws(
        " ",
        level_token("prio", "priority_tier"),
        level_token("urg", "urgency_tier"),
        level_token("impact", "impact_tier"),
        X.map_codes("status", R.STATUS_TOKEN, "ticket_unknown_status"),
        F.when(closed & (F.coalesce("close_delay_stat", F.lit(0)) > 0), "sla_breached").when(closed, "sla_met"),
        F.when(F.coalesce("solve_delay_stat", F.lit(0)) > 0, "resolution_overdue"),
        X.tier(hours, R.RESOLUTION_TOKEN_CUTS, "unresolved_ticket"),
        F.when(waiting > 86400, "long_waiting_time").when(waiting > 3600, "moderate_waiting_time"),
    )


def behaviour_tokens() -> Column:
    """Token string over the per-ticket follow-up statistics."""
    return F.concat_ws(
        " ",
        F.when(F.col("followup_count") > 10, "multiple_followups"),
        F.when(F.col("private_share") > 0.5, "private_heavy_ticket"),
        F.when(F.col("avg_length") > 500, "detailed_interactions"),
        F.when(F.col("url_share") > 0.3, "url_heavy_activity"),
        F.when(F.col("meaningful_share") < 0.3, "low_information_ticket"),
    )


def infrastructure_tokens() -> Column:
    return F.concat_ws(
        " ",
        X.map_codes("os_family", R.OS_TOKEN, None),
        F.when(F.col("memory_tier") == "critical", "low_memory_device"),
        F.when(F.coalesce("cpu_cores", F.lit(0)) >= 8, "high_core_server"),
        F.when(F.col("bios_risk_level") == "critical", "critical_bios_risk").when(
            F.coalesce("bios_age_years", F.lit(0)) >= 10, "legacy_bios"
        ),
        F.when(F.coalesce("high_risk_software_count", F.lit(0)) > 0, "high_risk_software_present"),
        F.when(F.coalesce("total_software_count", F.lit(0)) > 20, "multiple_software_components"),
    )


def richness(infra, behaviour, rungs) -> Column:
    """Confidence ladder by which token groups are present: ``rungs = (bare, behaviour, infra)``."""
    bare, some, rich = rungs
    return F.when(X.is_true(X._c(infra) != ""), rich).when(X.is_true(X._c(behaviour) != ""), some).otherwise(bare)


def suspicious_activity(user_suspicious, user_type, contains_url, meaningful) -> Column:
    return X.is_true(
        F.coalesce(X._c(user_suspicious), F.lit(False))
        | X._c(user_type).isin("SYSTEM", "TEST")
        | (F.coalesce(X._c(contains_url), F.lit(False)) & ~F.coalesce(X._c(meaningful), F.lit(True)))
    )


def activity_category(activity_type) -> Column:
    return X.classify(activity_type, [(("created", "deleted", "updated"), "write")], "read")


def activity_density(total, span_days) -> Column:
    t = X._c(total).cast("double")
    return X.rounded(F.when(X._c(span_days) > 0, t / F.nullif(X._c(span_days).cast("double"), F.lit(0.0))).otherwise(t), 4)
