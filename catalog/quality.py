"""Quality, profiling and ML queries."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.registry import cte, query, rnd
from catalog.texts import texts
from ticketlake import rules as R
from ticketlake.functions import cleanse as X, scores as S
from ticketlake.operators import boosting as B, learning as L, profiling as P, quality as Q, relational as J
from ticketlake.plans import corpus as C, ml_dataset
from ticketlake.plans.warehouse import Warehouse
from ticketlake.session import AS_OF, checkpoint_dir, written_once
from ticketlake.sources.sinks import export_gold

LEVELS = ("critical", "high", "medium", "low", "unknown")


def _rows(model, checks):
    parts = [f"SELECT '{c}' AS column_name, '{k}' AS check_name, COUNT(*) FILTER ({bad}) AS bad_rows FROM {model}" for c, k, bad in checks]
    return "SELECT *, CASE WHEN bad_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(parts) + ")"


@query("qa1_not_null", _rows("stg_tickets", [(c, "not_null", f"{c} IS NULL") for c in ("ticket_pk", "ticket_id", "created_at", "solved_at", "content", "items_id")]))
def _(t):
    return Q.check_columns(Warehouse(t).stg_tickets, not_null=("ticket_pk", "ticket_id", "created_at", "solved_at", "content", "items_id"))


@query("qa2_unique", "SELECT 'similarity_pk' AS column_name, 'unique' AS check_name, COUNT(*) AS bad_rows, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT similarity_pk FROM gold_similarity GROUP BY 1 HAVING COUNT(*) > 1) UNION ALL SELECT 'ticket_pk', 'unique', COUNT(*), CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM (SELECT ticket_pk FROM bronze_ticket_texts GROUP BY 1 HAVING COUNT(*) > 1)")
def _(t):
    return Q.check_unique(Warehouse(t).gold_similarity.select("similarity_pk"), "similarity_pk").unionByName(Q.check_unique(t.bronze("ticket_texts"), "ticket_pk"))


@query("qa3_accepted_values", _rows("stg_tickets", [(c, "accepted_values", f"{c} NOT IN {v}") for c, v in (("priority_tier", LEVELS[:4]), ("ticket_type", ("incident", "request", "unknown")))]))
def _(t):
    return Q.check_columns(Warehouse(t).stg_tickets, accepted={"priority_tier": LEVELS[:4], "ticket_type": ("incident", "request", "unknown")})


@query("qa4_row_rules", "SELECT ticket_pk, source_year FROM stg_tickets WHERE ticket_pk IS NULL OR priority_tier NOT IN ('critical','high','medium','low','unknown') OR source_year NOT IN (1992, 1993, 1994, 1995, 1996) OR source_system <> 'GLPI'")
def _(t):
    rules = [
        F.col("ticket_pk").isNull(), ~F.col("priority_tier").isin(*LEVELS), ~F.col("source_year").isin(1992, 1993, 1994, 1995, 1996),
        F.col("source_system") != "GLPI",
    ]
    return Q.failing_rows(Warehouse(t).stg_tickets, rules).select("ticket_pk", "source_year")


@query("qa4_row_rules_hardware", "SELECT hardware_pk FROM stg_hardware WHERE os_family NOT IN ('Windows','Linux','MacOS') OR architecture_family NOT IN ('64bit','32bit','unknown') OR inventory_quality_tier NOT IN ('excellent','good','medium','poor')")
def _(t):
    rules = [
        ~F.col("os_family").isin("Windows", "Linux", "MacOS"), ~F.col("architecture_family").isin("64bit", "32bit", "unknown"),
        ~F.col("inventory_quality_tier").isin("excellent", "good", "medium", "poor"),
    ]
    return Q.failing_rows(Warehouse(t).stg_hardware, rules).select("hardware_pk")


@query("qa5_level_consistency", "SELECT COUNT(*) FILTER (priority_score <> CASE priority WHEN 'critical' THEN 5 WHEN 'high' THEN 4 WHEN 'medium' THEN 3 WHEN 'low' THEN 2 ELSE 1 END) AS mismatches FROM silver_tickets")
def _(t):
    return Q.level_mismatch(Warehouse(t).silver_tickets, "priority", "priority_score").agg(F.count("*").alias("mismatches"))


@query("qa6_plausibility", "SELECT COUNT(*) AS implausible FROM silver_assets WHERE asset_age_years < 0 OR (drive_health_encoded >= 3 AND bios_risk_encoded IS NULL) OR (bios_risk_encoded >= 3 AND drive_health_encoded = 0 AND asset_age_years < 2)")
def _(t):
    return Q.implausible_assets(Warehouse(t).silver_assets).agg(F.count("*").alias("implausible"))


@query("qa7_score_range", "SELECT ticket_fk, sla_risk_score FROM silver_triage WHERE sla_risk_score < 0.5 OR sla_risk_score > 3.5")
def _(t):
    return Q.out_of_range(Warehouse(t).silver_triage, "sla_risk_score", 0.5, 3.5).select("ticket_fk", "sla_risk_score")


@query("qa8_no_future", "SELECT (SELECT COUNT(*) FROM silver_tickets WHERE created_at > TIMESTAMP '2024-02-02 00:00:00') AS future_tickets, (SELECT COUNT(*) FROM silver_activity WHERE activity_date > TIMESTAMP '2024-02-01 00:00:00') AS future_activity")
def _(t):
    w = Warehouse(t)
    late = Q.in_future(w.silver_activity, "activity_date", AS_OF).agg(F.count("*")).scalar()
    return Q.in_future(w.silver_tickets, "created_at", AS_OF, 1).agg(F.count("*").alias("future_tickets"), F.coalesce(F.max(late), late).alias("future_activity"))


_NUM = ("waiting_duration", "followup_count", "priority_score", "is_escalated", "customer_tenure_months")
_COLS = _NUM + ("urgency_score", "created_at")


def _val(model, cols, nums):
    pct = lambda c: rnd(f"COUNT(*) FILTER ({c} IS NULL) * 100.0 / COUNT(*)", 4)
    parts = [f"SELECT '{c}' AS column_name, 'null_pct' AS check_name, {pct(c)} AS value, CASE WHEN {pct(c)} > 99 THEN 'FAIL' WHEN {pct(c)} = 0 THEN 'PASS' ELSE 'WARN' END AS status FROM {model}" for c in cols]
    parts += [f"SELECT '{c}', 'variance', {rnd(f'var_samp({c}::DOUBLE)', 4)}, CASE WHEN COALESCE(var_samp({c}::DOUBLE) < 1e-8, TRUE) THEN 'FAIL' ELSE 'PASS' END FROM {model}" for c in nums]
    return " UNION ALL ".join(parts)


@query("qa9_feature_validation", _val("gold_sla", _COLS, _NUM[1:4]))
def _(t):
    return Q.validate_features(Warehouse(t).gold_sla, list(_COLS), list(_NUM[1:4]))


@query("qa10_join_coverage", f"SELECT COUNT(*) AS row_count, COUNT(*) FILTER (f.ticket_id IS NULL) AS unmatched_rows, {rnd('COUNT(*) FILTER (f.ticket_id IS NULL) * 100.0 / COUNT(*)', 4)} AS unmatched_pct FROM stg_tickets t LEFT JOIN (SELECT DISTINCT ticket_id FROM stg_followups) f USING (ticket_id)")
def _(t):
    w = Warehouse(t)
    return J.merge_with_coverage(w.stg_tickets, w.stg_followups, "ticket_id", "ticket_id", ["content_length"])[1]


_LAB = " UNION ALL ".join(f"SELECT '{c}' AS column_name, 'label:' || COALESCE(CAST({c} AS VARCHAR), 'null') AS check_name, COUNT(*)::DOUBLE AS value, 'INFO' AS status FROM gold_sla GROUP BY {c}" for c in ("priority_score", "was_sla_breached"))


@query("qa11_quality_report", _val("gold_sla", _COLS, _NUM[1:4]) + " UNION ALL " + _LAB)
def _(t):
    return Q.quality_report(Warehouse(t).gold_sla, list(_COLS), list(_NUM[1:4]), ("priority_score", "was_sla_breached"))


_STEPS = [("real_text", "text_source_type = 'real_text'"), ("filled", "TRIM(text_corpus) <> ''"), ("min_chars", "length(text_corpus) >= 20"), ("clean_chars", "length(retrieval_text_clean) >= 20"), ("min_words", "text_word_count >= 5"), ("repetition", "repetition_ratio <= 0.6")]


def _funnel_sql():
    def upto(i):
        return " AND ".join(c for _, c in _STEPS[:i]) or "TRUE"

    rows = [f"SELECT {i} AS step_no, '{n}' AS step, COUNT(*) FILTER ({upto(i - 1)}) AS before, COUNT(*) FILTER ({upto(i)}) AS after FROM corpus_steps" for i, (n, _) in enumerate(_STEPS, 1)]
    return "SELECT *, before - after AS removed FROM (" + " UNION ALL ".join(rows) + ")"


@query("qa12_filter_funnel", _funnel_sql())
def _(t):
    steps = C.cleaning_steps(texts(t))
    flags = ("keep_real", "keep_filled", "keep_long", "keep_clean_long", "keep_words")
    conds = [(n, F.col(f)) for (n, _), f in zip(_STEPS, flags)] + [("repetition", F.col("repetition_ratio") <= R.MAX_REPETITION)]
    return Q.funnel(steps, conds)


# ---- profiling -----------------------------------------------------------------------------------
@query("pr1_shape")
def _(t):
    return P.shape(t.lineitem)


@query("pr2_null_counts", " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS nulls, {rnd(f'COUNT(*) FILTER ({c} IS NULL) * 100.0 / COUNT(*)', 4)} AS null_pct FROM stg_tickets" for c in ("created_at", "solved_at", "closed_at", "content", "items_id", "itilcategories_id")))
def _(t):
    return P.null_counts(Warehouse(t).stg_tickets.select("created_at", "solved_at", "closed_at", "content", "items_id", "itilcategories_id"))


@query("pr3_duplicate_keys", "SELECT COUNT(*) AS row_count, COUNT(*) - COUNT(DISTINCT ticket_pk) AS duplicates FROM bronze_ticket_texts")
def _(t):
    return P.duplicate_keys(t.bronze("ticket_texts").select("ticket_pk"), "ticket_pk")


@query("pr4_distribution", f"SELECT lang AS value, COUNT(*) AS n, {rnd('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM documents)', 4)} AS pct FROM documents GROUP BY 1")
def _(t):
    return J.value_counts(t.documents, "lang")


def _describe(model, cols):
    qs = ", ".join(f"{rnd(f'quantile_cont({{c}}::DOUBLE, {q})', 4)} AS p{int(q * 100)}" for q in P.QUANTILES)
    one = "SELECT '{c}' AS column_name, COUNT({c}) AS count, " + rnd("AVG({c})", 4) + " AS mean, " + rnd("stddev_samp({c})", 4) + " AS std, MIN({c})::DOUBLE AS min, MAX({c})::DOUBLE AS max, " + qs + " FROM " + model
    return " UNION ALL ".join(one.format(c=c) for c in cols)


@query("pr5_describe", _describe("lineitem", ("l_quantity", "l_extendedprice", "l_linenumber")))
def _(t):
    return P.describe(t.lineitem, ("l_quantity", "l_extendedprice", "l_linenumber"))


@query("pr6_histogram", "SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 50)) AS BIGINT), 49) AS bin, COUNT(*) AS n FROM lineitem, (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem) GROUP BY 1")
def _(t):
    return P.histogram(t.lineitem, "l_extendedprice")


_CC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("pr7_correlations", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for i, a in enumerate(_CC) for b in _CC[i + 1:]))
def _(t):
    return P.correlations(t.lineitem, _CC)


@query("pr8_populated", "SELECT COUNT(*) FILTER (COALESCE(TRIM(firstname) <> '', FALSE) AND COALESCE(TRIM(realname) <> '', FALSE)) AS both, COUNT(*) FILTER (COALESCE(TRIM(firstname) <> '', FALSE) OR COALESCE(TRIM(realname) <> '', FALSE)) AS either, COUNT(*) AS row_count FROM bronze_glpi_users")
def _(t):
    return P.populated(t.bronze("glpi_users"), "firstname", "realname")


_FEATS = ("avg_word_length", "unique_word_ratio", "special_char_ratio", "text_complexity_score")


@query("pr9_feature_statistics", _describe("corpus_features", _FEATS))
def _(t):
    # the report reads its input several times, so the features are written once
    feats = C.with_features(C.clean(texts(t)), encode=False).select(*_FEATS)
    return P.describe(export_gold(feats, f"{checkpoint_dir(t.spark)}/features-{uuid.uuid4().hex}"), _FEATS)


@query("pr10_eda_summary", f"SELECT COUNT(*) AS total_documents, {rnd('AVG(text_word_count)', 2)} AS avg_word_count, quantile_cont(text_word_count::DOUBLE, 0.5) AS median_word_count, CAST(MAX(text_word_count) AS INT) AS max_word_count, {rnd('AVG(text_char_count)', 2)} AS avg_character_count, COUNT(*) - COUNT(DISTINCT retrieval_text_clean) AS duplicate_documents, {rnd('(COUNT(*) - COUNT(DISTINCT retrieval_text_clean)) * 100.0 / COUNT(*)', 2)} AS duplicate_ratio_pct, {rnd('AVG(corpus_quality_score)', 4)} AS avg_quality_score FROM corpus_clean")
def _(t):
    d = C.clean(texts(t)).groupBy(F.sha2(C.TEXT, 256).alias("k")).agg(
        F.count("*").alias("n"), F.max("text_word_count").alias("w"), F.max("text_char_count").alias("c"), F.sum("corpus_quality_score").alias("q")
    )
    n = F.sum("n")
    return d.agg(
        n.alias("total_documents"), X.rounded(F.sum(F.col("n") * F.col("w")) / n, 2).alias("avg_word_count"),
        F.percentile("w", F.lit(0.5), F.col("n")).alias("median_word_count"), F.max("w").alias("max_word_count"),
        X.rounded(F.sum(F.col("n") * F.col("c")) / n, 2).alias("avg_character_count"), (n - F.count("*")).alias("duplicate_documents"),
        X.rounded((n - F.count("*")) * 100 / n, 2).alias("duplicate_ratio_pct"), X.rounded(F.sum("q") / n, 4).alias("avg_quality_score"),
    )


# ---- ML ------------------------------------------------------------------------------------------
cte("corpus_sla", "SELECT 'T' || ticket_id AS ticket_pk, was_sla_breached, priority_score, ticket_age_hours, followup_count FROM gold_sla WHERE source_system = 'GLPI'")
_RISK = "least(greatest(retrieval_quality_score * 0.4::DOUBLE + text_complexity_score / 10.0::DOUBLE * 0.3::DOUBLE + special_char_ratio * 0.2::DOUBLE + digit_ratio * 0.1::DOUBLE, 0), 1)"


def _ml(t):
    """Ticket texts meet the SLA rows of the ticket with the same number."""
    feats = C.with_features(C.clean(texts(t)), encode=False)
    sla = Warehouse(t).gold_sla.filter(F.col("source_system") == "GLPI").withColumn("source_ticket_pk", F.concat(F.lit("T"), "ticket_id"))
    return ml_dataset.build(feats, sla)


@query("ml1_gold_dataset", f"SELECT ticket_pk, was_sla_breached, priority_score, followup_count, {rnd(_RISK, 5)} AS escalation_risk_score, CAST({_RISK} >= 0.6 AS INT) AS is_predicted_high_risk, {rnd('text_word_count / text_char_count::DOUBLE', 6)} AS text_content_density FROM corpus_features LEFT JOIN corpus_sla USING (ticket_pk)")
def _(t):
    return _ml(t)[0].select(
        "ticket_pk", "was_sla_breached", "priority_score", "followup_count", X.rounded("escalation_risk_score", 5).alias("escalation_risk_score"),
        "is_predicted_high_risk", X.rounded("text_content_density", 6).alias("text_content_density"),
    )


@query("sc9_text_escalation", f"SELECT ticket_pk, {rnd(_RISK, 5)} AS risk, CAST({_RISK} >= 0.6 AS INT) AS high_risk FROM corpus_features")
def _(t):
    risk, high = S.text_escalation()
    return C.with_features(C.clean(texts(t)), encode=False).select("ticket_pk", X.rounded(risk, 5).alias("risk"), high.alias("high_risk"))


@query("ml2_feature_selection")
def _(t):
    return L.select_features(C.with_features(C.clean(texts(t)), encode=False), list(R.TRIAGE_FEATURES))


@query("ml3_stratified_split", "SELECT doc_id, quality, rn <= round(total * 0.25) AS is_test FROM (SELECT doc_id, quality, ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5('42|' || doc_id), doc_id) AS rn, COUNT(*) OVER (PARTITION BY quality) AS total FROM labels)")
def _(t):
    return L.stratified_split(t.labels.select("doc_id", "quality"), "quality", "doc_id")


def _labelled(t):
    return C.with_features(C.clean(texts(t)), encode=False)


class Triage:
    """Splits, models and scores of the three targets, trained once per session and folder and stored."""

    _saved: dict = {}

    def __init__(self, t):
        self.t = t
        key = (t.spark.sparkContext.applicationId, t.folder)
        if key not in self._saved:
            self._saved[key] = self._train(t)
        self.model, self.folder = self._saved[key]
        self.scores = t.spark.read.parquet(f"{self.folder}/scores")

    @staticmethod
    def data(t):
        """Rows with all targets, each target with its own stratified quarter for testing."""
        rows = _labelled(t).select("ticket_pk", *R.TRIAGE_FEATURES, *R.TRIAGE_TARGETS).dropna(subset=list(R.TRIAGE_TARGETS))
        rows = written_once(rows, "triage")  # every split reads the rows twice, and cleaning is the costly part
        for target in R.TRIAGE_TARGETS:
            rows = L.stratified_split(rows, target, "ticket_pk").withColumn(f"train_{target}", ~F.col("is_test")).drop("is_test")
        return rows

    @classmethod
    def _train(cls, t):
        folder = f"{checkpoint_dir(t.spark)}/triage-{uuid.uuid4().hex}"
        cls.data(t).write.parquet(f"{folder}/data")
        data = t.spark.read.parquet(f"{folder}/data")
        model = B.fit(data, "ticket_pk", R.TRIAGE_FEATURES, R.TRIAGE_TARGETS, {x: f"train_{x}" for x in R.TRIAGE_TARGETS})
        each = F.array(*[
            F.struct(
                F.lit(x).alias("target"), F.col(x).cast("int").alias("actual"), F.col(f"{x}_pred").alias("predicted"),
                F.col(f"{x}_share").alias("share"), (~F.col(f"train_{x}")).alias("is_test"),
            ) for x in R.TRIAGE_TARGETS
        ])
        B.predict(data, model).select("ticket_pk", F.inline(each)).write.parquet(f"{folder}/scores")
        return model, folder


_TRIAGE_ROWS = " UNION ALL ".join(
    f"SELECT ticket_pk, '{x}' AS target, CAST({x} AS INT) AS actual, ROW_NUMBER() OVER (PARTITION BY {x} ORDER BY md5('42|' || ticket_pk), ticket_pk) <= round(COUNT(*) OVER (PARTITION BY {x}) * 0.25) AS is_test "
    f"FROM corpus_features WHERE {' AND '.join(f'{y} IS NOT NULL' for y in R.TRIAGE_TARGETS)}" for x in R.TRIAGE_TARGETS
)


@query("ml3_triage_splits", f"SELECT ticket_pk, target, actual, is_test FROM ({_TRIAGE_ROWS})")
def _(t):
    """Split and encoding of every row for every target, from the stored score table."""
    return Triage(t).scores.select("ticket_pk", "target", "actual", "is_test")


@query("ml4_triage_supports", f"SELECT target, actual, COUNT(*) FILTER (NOT is_test) AS n_train, COUNT(*) FILTER (is_test) AS n_test FROM ({_TRIAGE_ROWS}) GROUP BY target, actual")
def _(t):
    return Triage(t).scores.groupBy("target", "actual").agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"))


@query("ml4_triage_training")
def _(t):
    """Held-out metrics of the three boosted models (200 rounds of depth 6)."""
    scores = Triage(t).scores.filter("is_test")
    parts = [L.summary_metrics(L.confusion(scores.filter(F.col("target") == x), "actual", "predicted")).select(F.lit(x).alias("target"), "*") for x in R.TRIAGE_TARGETS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ml5_triage_prediction")
def _(t):
    names = [x.replace("_encoded", "") for x in R.TRIAGE_TARGETS]
    level = F.map_from_entries(F.collect_list(F.struct("target", "predicted")))
    wide = Triage(t).scores.groupBy("ticket_pk").agg(level.alias("m")).select("ticket_pk", *[F.col("m")[x].alias(f"{n}_pred") for x, n in zip(R.TRIAGE_TARGETS, names)])
    risk, escalate = S.triage_escalation(*[f"{n}_pred" for n in names])
    return wide.withColumns({**{f"{n}_label": X.map_codes(f"{n}_pred", R.TRIAGE_NAMES, None) for n in names}, "escalation_risk": risk, "should_escalate": escalate})


_CM = "SELECT quality AS actual, toxic AS predicted, COUNT(*) AS n FROM labels GROUP BY ALL"
_PER = f"""SELECT class, support, guessed, hit, COALESCE(hit / NULLIF(guessed, 0)::DOUBLE, 0) AS p, COALESCE(hit / NULLIF(support, 0)::DOUBLE, 0) AS r FROM (
  SELECT class, SUM(s)::BIGINT AS support, SUM(g)::BIGINT AS guessed, SUM(h)::BIGINT AS hit FROM (SELECT actual AS class, n AS s, 0 AS g, CASE WHEN actual = predicted THEN n ELSE 0 END AS h FROM ({_CM})
  UNION ALL SELECT predicted, 0, n, 0 FROM ({_CM})) GROUP BY class)"""
_F1 = "CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END"


@query("ml6_class_metrics", f"SELECT class, support, guessed, hit, {rnd('p', 6)} AS precision, {rnd('r', 6)} AS recall, {rnd(_F1, 6)} AS f1 FROM ({_PER})")
def _(t):
    m = L.class_metrics(L.confusion(t.labels, "quality", "toxic"))
    return m.select("class", "support", "guessed", "hit", *[X.rounded(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("ml6_summary_metrics", f"SELECT {rnd('SUM(hit) / SUM(support)::DOUBLE', 4)} AS accuracy, {rnd(f'AVG({_F1})', 4)} AS macro_f1, {rnd(f'SUM({_F1} * support) / SUM(support)', 4)} AS weighted_f1, {rnd('AVG(r)', 4)} AS recall_macro, COUNT(*) AS n_classes, SUM(support)::BIGINT AS n_test FROM ({_PER})")
def _(t):
    return L.summary_metrics(L.confusion(t.labels, "quality", "toxic"))


@query("ml6_confusion", _CM)
def _(t):
    return L.confusion(t.labels, "quality", "toxic")


@query("ml7_feature_importance")
def _(t):
    return B.importance(Triage(t).model, t.spark)


_IF = ("followup_count", "log_action_count", "ocs_inventory_count", "private_followup_ratio", "avg_followup_length", "write_action_ratio", "activity_density")
#: What the asset forest sees: every number of the risk rows but ids, years and the scores it is validated against.
_ASSET = (
    "asset_age_years", "bios_risk_encoded", "drive_health_encoded", "storage_capacity_gb", "drive_count", "memory_gb", "cpu_cores",
    "high_risk_software_count", "risk_software_ratio", "software_installed_count", "incident_count", "hardware_incident_count",
    "days_since_last_inventory", "has_warranty", "glpi_failure_proxy",
)


class Assets:
    """Risk rows with the forest's score in `anomaly_score` and `is_anomaly`, written once per session and folder."""

    _saved: dict = {}

    def __init__(self, t):
        key = (t.spark.sparkContext.applicationId, t.folder)
        if key not in self._saved:
            folder = f"{checkpoint_dir(t.spark)}/assets-{uuid.uuid4().hex}"
            Warehouse(t).gold_risk.drop("anomaly_score", "is_anomaly").write.parquet(f"{folder}/risk")
            risk = t.spark.read.parquet(f"{folder}/risk")
            scored = L.isolation_forest(risk.dropDuplicates(["asset_pk"]), "asset_pk", _ASSET)
            risk.join(scored, "asset_pk", "left").write.parquet(f"{folder}/scored")
            self._saved[key] = folder
        self.rows = t.spark.read.parquet(f"{self._saved[key]}/scored")


@query("ml8_isolation_forest")
def _(t):
    """Asset risk rows, with 200 trees; anomaly_score and is_anomaly are filled."""
    return Assets(t).rows.select("asset_pk", "rule_based_risk_score", "risk_tier", "anomaly_score", "is_anomaly")


@query("ml8_user_forest")
def _(t):
    return L.isolation_forest(Warehouse(t).gold_anomalies, "user_pk", _IF)


@query("ml9_anomaly_validation")
def _(t):
    """The forest's score against the rule score, and the share of flagged assets."""
    return Assets(t).rows.agg(
        F.round(F.corr("rule_based_risk_score", "anomaly_score"), 4).alias("corr"), F.count("*").alias("assets"), F.sum("is_anomaly").alias("flagged"),
        F.round(F.avg("anomaly_score"), 4).alias("avg_score"),
    )


@query("ml9_activity_correlation", f"SELECT round(corr(total_activity_count, activity_density), 5) AS corr FROM gold_anomalies")
def _(t):
    return Warehouse(t).gold_anomalies.agg(F.round(F.corr("total_activity_count", "activity_density"), 5).alias("corr"))


@query("ml9_anomaly_contrast")
def _(t):
    return J.group_contrast(Assets(t).rows.withColumnRenamed("is_anomaly", "flag"), "flag", list(_ASSET))


@query("ml10_local_outliers")
def _(t):
    return L.local_outlier_factor(Warehouse(t).gold_anomalies, "user_pk", _IF)


_BREACH = ("priority_score", "urgency_score", "impact_score", "waiting_duration", "followup_count", "ticket_age_hours", "resolution_time_hours")


def _breach_rows(t):
    sla = Warehouse(t).gold_sla.filter(F.col("source_system") == "GLPI").select("sla_feature_pk", "was_sla_breached", *_BREACH)
    return L.stratified_split(sla, "was_sla_breached", "sla_feature_pk")


@query(
    "ml11_breach_split",
    "SELECT was_sla_breached, COUNT(*) FILTER (NOT is_test) AS n_train, COUNT(*) FILTER (is_test) AS n_test FROM (SELECT was_sla_breached, ROW_NUMBER() OVER (PARTITION BY was_sla_breached ORDER BY md5('42|' || sla_feature_pk), sla_feature_pk) <= round(COUNT(*) OVER (PARTITION BY was_sla_breached) * 0.25) AS is_test FROM gold_sla WHERE source_system = 'GLPI') GROUP BY 1",
)
def _(t):
    return _breach_rows(t).groupBy("was_sla_breached").agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"))


@query("ml11_breach_classifier")
def _(t):
    """Metrics on the held-out quarter."""
    folder = f"{checkpoint_dir(t.spark)}/breach-{uuid.uuid4().hex}"
    _breach_rows(t).write.parquet(folder)
    rows = t.spark.read.parquet(folder)
    model = L.train_breach(rows.filter(~F.col("is_test")), _BREACH)
    test = L.as_doubles(rows.filter("is_test"), _BREACH).withColumn("actual", F.col("was_sla_breached").cast("double"))
    return L.summary_metrics(L.confusion(model.transform(test), "actual", "prediction"))


@query("ml12_imputation", "SELECT id, COALESCE(solve_delay_stat, 0) AS z FROM (SELECT ticket_id AS id, solve_delay_stat FROM stg_tickets)")
def _(t):
    d = Warehouse(t).stg_tickets.select(F.col("ticket_id").alias("id"), F.col("solve_delay_stat").alias("z"))
    return L.impute(d, ["z"], "zero")


_MEDIAN = "COALESCE({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM stg_tickets)) AS {c}"


@query("ml12_median_imputation", f"SELECT ticket_id, {_MEDIAN.format(c='resolution_time_hours')}, {_MEDIAN.format(c='waiting_duration')} FROM stg_tickets")
def _(t):
    d = Warehouse(t).stg_tickets.select("ticket_id", "resolution_time_hours", "waiting_duration")
    return L.impute(d, ["resolution_time_hours", "waiting_duration"])
