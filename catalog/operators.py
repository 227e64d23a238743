"""One query per cleansing, filter, join, aggregate, window, set, scalar, score and token operator."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.models import NOW
from catalog.registry import blank, classify, codes, has, leading_int, null_in, one, query, rnd, tier
from ticketlake import rules as R
from ticketlake.functions import cleanse as X, scores as S
from ticketlake.operators import ordering as O, relational as J
from ticketlake.plans import gold, silver
from ticketlake.plans.warehouse import Warehouse
from ticketlake.session import AS_OF

def F_ID():
    return F.col("ID").alias("id")


# ---- cleansing -----------------------------------------------------------------------------------


def q(name, sql, table, *cols):
    """Register a projection of a bronze shape or a raw table."""

    @query(name, sql)
    def _(t):
        src = t.bronze(table[7:]) if table.startswith("bronze_") else getattr(t, table)
        return src.select(*[c() if callable(c) else c for c in cols])


q("cl1_composite_key", "SELECT id, CAST(source_year AS VARCHAR) || '_' || CAST(id AS VARCHAR) AS k FROM bronze_glpi_users", "bronze_glpi_users", "id", lambda: X.composite_key("source_year", "id").alias("k"))
q("cl2_md5_key", "SELECT ID AS id, md5(COALESCE(NAME, '') || '_' || COALESCE(VERSION, '')) AS k FROM bronze_ocs_software", "bronze_ocs_software", F_ID, lambda: X.md5_key("NAME", "VERSION").alias("k"))
q("cl3_rekey", "SELECT event_id, md5('WINLOG_' || event_type) AS a, md5('CVE_' || CAST(event_id AS VARCHAR)) AS b FROM events", "events", "event_id", lambda: X.rekey("WINLOG_", "event_type").alias("a"), lambda: X.rekey("CVE_", "event_id").alias("b"))
q("cl4_null_if_blank", f"SELECT id, {blank('name')} AS n, lower({blank('user_dn')}) AS l, upper({blank('personal_token')}) AS u FROM bronze_glpi_users", "bronze_glpi_users", "id", lambda: X.null_if_blank("name").alias("n"), lambda: X.lower_or_null("user_dn").alias("l"), lambda: X.upper_or_null("personal_token").alias("u"))
q("cl5_null_if_in", f"SELECT HARDWARE_ID AS h, {null_in('SSN', R.BIOS_SERIAL_BLANKS)} AS s, {null_in('ASSETTAG', (), R.ASSET_TAG_PARTS)} AS a FROM bronze_ocs_bios", "bronze_ocs_bios", lambda: F.col("HARDWARE_ID").alias("h"), lambda: X.null_if_in("SSN", R.BIOS_SERIAL_BLANKS).alias("s"), lambda: X.null_if_in("ASSETTAG", (), contains=R.ASSET_TAG_PARTS).alias("a"))
q("cl6_clean_ts", "SELECT id, TRY_CAST(date AS TIMESTAMP) AS d FROM bronze_glpi_tickets", "bronze_glpi_tickets", "id", lambda: X.clean_ts("date").alias("d"))
q("cl7_chronology_guard", "SELECT id, CASE WHEN TRY_CAST(solvedate AS TIMESTAMP) < TRY_CAST(date AS TIMESTAMP) THEN NULL ELSE TRY_CAST(solvedate AS TIMESTAMP) END AS s FROM bronze_glpi_tickets", "bronze_glpi_tickets", "id", lambda: X.not_before(X.clean_ts("solvedate"), X.clean_ts("date")).alias("s"))
q("cl8_range_guard", "SELECT unnamed_0 AS id, CASE WHEN cvss BETWEEN 0 AND 10 THEN cvss END AS c FROM bronze_cve_data", "bronze_cve_data", lambda: F.col("unnamed_0").alias("id"), lambda: X.within("cvss", 0, 10).alias("c"))
q("cl9_floor_at_one", "SELECT id, CASE WHEN priority IS NULL OR priority < 1 THEN 1 ELSE priority END AS p, CASE WHEN impact IS NULL OR impact < 1 THEN 1 ELSE impact END AS i FROM bronze_glpi_tickets", "bronze_glpi_tickets", "id", lambda: X.floor_at_one("priority").alias("p"), lambda: X.floor_at_one("impact").alias("i"))
q("cl10_positive_id", "SELECT id, CASE WHEN items_id > 0 THEN items_id END AS i FROM bronze_glpi_tickets", "bronze_glpi_tickets", "id", lambda: X.positive("items_id").alias("i"))
q("cl11_default_fill", "SELECT ticket_id, COALESCE(customer_satisfaction_score, 0) AS s, COALESCE(customer_tenure_months, 0) AS m FROM bronze_support_tickets", "bronze_support_tickets", "ticket_id", lambda: F.coalesce("customer_satisfaction_score", F.lit(0.0)).alias("s"), lambda: F.coalesce("customer_tenure_months", F.lit(0)).alias("m"))
q("cl12_synthetic_name", f"SELECT id, COALESCE({blank('name')}, 'user-' || CAST(id AS VARCHAR)) AS n FROM bronze_glpi_users", "bronze_glpi_users", "id", lambda: F.coalesce(X.null_if_blank("name"), F.concat(F.lit("user-"), F.col("id").cast("string"))).alias("n"))
q("cl13_flags", f"SELECT id, {one('is_template')} AS a, COALESCE(uuid <> '', FALSE) AS b, {has('name')} AS c FROM bronze_glpi_computers", "bronze_glpi_computers", "id", lambda: X.is_one("is_template").alias("a"), lambda: X.is_true(F.col("uuid") != "").alias("b"), lambda: X.has_text("name").alias("c"))
q("cl14_text_bool", "SELECT ticket_id, COALESCE(lower(TRIM(escalated)) IN ('true','yes','1'), FALSE) AS e, COALESCE(lower(TRIM(sla_breached)) IN ('true','yes','1'), FALSE) AS b FROM bronze_support_tickets", "bronze_support_tickets", "ticket_id", lambda: X.text_bool("escalated").alias("e"), lambda: X.text_bool("sla_breached").alias("b"))
q("cl15_code_map", "SELECT id, CASE type WHEN 1 THEN 'incident' WHEN 2 THEN 'request' ELSE 'unknown' END AS t FROM bronze_glpi_tickets", "bronze_glpi_tickets", "id", lambda: X.map_codes("type", R.TICKET_TYPE, "unknown").alias("t"))
q("cl16_classify", f"SELECT id, {classify('name', R.CATEGORY_TYPE, 'OTHER')} AS c, {classify('completename', R.SOFTWARE_CATEGORY, 'other')} AS s FROM bronze_glpi_itilcategories", "bronze_glpi_itilcategories", "id", lambda: X.classify("name", R.CATEGORY_TYPE, "OTHER").alias("c"), lambda: X.classify("completename", R.SOFTWARE_CATEGORY, "other").alias("s"))
q("cl17_tier", f"SELECT unnamed_0 AS id, {tier('cvss', R.CVSS_CUTS, 'unknown')} AS s FROM bronze_cve_data", "bronze_cve_data", lambda: F.col("unnamed_0").alias("id"), lambda: X.tier("cvss", R.CVSS_CUTS, "unknown").alias("s"))
q("cl18_ordinal", "SELECT ticket_id, CASE lower(priority) WHEN 'critical' THEN 5 WHEN 'high' THEN 4 WHEN 'medium' THEN 3 WHEN 'low' THEN 2 ELSE 1 END AS o FROM bronze_support_tickets", "bronze_support_tickets", "ticket_id", lambda: X.map_codes(F.lower("priority"), R.LEVEL_ORDINAL, 1).alias("o"))
q("cl19_status", f"SELECT id, {codes('status', R.DESK_STATUS, 'unknown')} AS s FROM bronze_glpi_tickets", "bronze_glpi_tickets", "id", lambda: X.map_codes("status", R.DESK_STATUS, "unknown").alias("s"))
q("cl19_status_external", "SELECT ticket_id, CASE WHEN lower(status) IN ('closed','resolved','open','escalated') THEN lower(status) WHEN lower(status) LIKE '%progress%' THEN 'in_progress' ELSE 'unknown' END AS s FROM bronze_support_tickets", "bronze_support_tickets", "ticket_id", lambda: silver.external_status("status").alias("s"))
q("cl20_units", f"SELECT ID AS id, CASE WHEN TOTAL > 0 THEN {rnd('TOTAL::DOUBLE / 1024', 2)} END AS gb FROM bronze_ocs_drives", "bronze_ocs_drives", F_ID, lambda: X.scaled(X.positive("TOTAL"), 1024).alias("gb"))
q("cl21_magnitude", f"SELECT ID AS id, CASE WHEN {leading_int('CAPACITY')} > 1000000000 THEN round(({leading_int('CAPACITY')}) / 1073741824.0, 2)::DOUBLE WHEN {leading_int('CAPACITY')} > 256 THEN round(({leading_int('CAPACITY')}) / 1024.0, 2)::DOUBLE END AS gb FROM bronze_ocs_memories", "bronze_ocs_memories", F_ID, lambda: X.bytes_or_megabytes_gb("CAPACITY").alias("gb"))
q("cl22_unit_suffix", "SELECT laptop_ID AS id, TRY_CAST(replace(lower(Ram), 'gb', '') AS BIGINT) AS ram, CAST(TRY_CAST(replace(lower(Weight), 'kg', '') AS DECIMAL(5,2)) AS DOUBLE) AS kg FROM bronze_laptop_price_data", "bronze_laptop_price_data", lambda: F.col("laptop_ID").alias("id"), lambda: X.without_suffix("Ram", "gb", "bigint").alias("ram"), lambda: X.without_suffix("Weight", "kg", "decimal(5,2)").cast("double").alias("kg"))
q("cl23_day_month_date", "SELECT hardware_id AS id, bios_date AS d FROM stg_bios", "bronze_ocs_bios", lambda: F.col("HARDWARE_ID").alias("id"), lambda: X.day_month_date("BDATE").alias("d"))
q("cl24_ipv4", "SELECT ID AS id, COALESCE(regexp_matches(IPADDRESS, '^[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+$'), FALSE) AS ok FROM bronze_ocs_networks", "bronze_ocs_networks", F_ID, lambda: X.ipv4_shape("IPADDRESS").alias("ok"))
q("cl25_first_token", f"SELECT HARDWARE_ID AS id, {blank("split_part(BVERSION, ';', 1)")} AS v FROM bronze_ocs_bios", "bronze_ocs_bios", lambda: F.col("HARDWARE_ID").alias("id"), lambda: X.first_token("BVERSION", ";").alias("v"))
q("cl26_entities", "SELECT followup_id AS id, content FROM stg_followups", "bronze_glpi_ticketfollowups", "id", lambda: X.strip_entities("content", R.FOLLOWUP_LITERALS).alias("content"))
q("cl27_content_flags", "SELECT id, COALESCE(strlen(TRIM(content)) >= 5, FALSE) AS meaningful, COALESCE(contains(content, 'http'), FALSE) AS url, CAST(COALESCE(strlen(content), 0) AS BIGINT) AS bytes FROM bronze_glpi_ticketfollowups", "bronze_glpi_ticketfollowups", "id", lambda: X.is_true(F.octet_length(F.trim("content")) >= 5).alias("meaningful"), lambda: X.is_true(X.contains_any("content", "http")).alias("url"), lambda: F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("bytes"))
q("cl28_full_name", f"SELECT id, NULLIF(TRIM(COALESCE(firstname, '') || ' ' || COALESCE(realname, '')), '') AS n FROM bronze_glpi_users", "bronze_glpi_users", "id", lambda: X.full_name("firstname", "realname").alias("n"))


@query("cl29_account_type", "SELECT user_id, user_type, suspicious_account FROM stg_users")
def _(t):
    return Warehouse(t).stg_users.select("user_id", "user_type", "suspicious_account")


@query("cl30_change_type", "SELECT log_id, change_type, has_change FROM stg_logs")
def _(t):
    return Warehouse(t).stg_logs.select("log_id", "change_type", "has_change")


@query("cl31_used_percent", "SELECT drive_id, used_percent, storage_health FROM stg_drives")
def _(t):
    return Warehouse(t).stg_drives.select("drive_id", "used_percent", "storage_health")


@query("cl32_smart_risk", "SELECT health_status, COUNT(*) AS n, SUM(disk_risk_score)::DOUBLE AS risk FROM stg_harddrive GROUP BY 1")
def _(t):
    return Warehouse(t).stg_harddrive.groupBy("health_status").agg(F.count("*").alias("n"), F.sum("disk_risk_score").alias("risk"))


q("cl33_counter_flags", "SELECT serial_number AS s, date AS d, COALESCE(smart_5_raw > 0, FALSE) AS a, COALESCE(smart_199_raw > 0, FALSE) AS b FROM bronze_harddrive_data", "bronze_harddrive_data", lambda: F.col("serial_number").alias("s"), lambda: F.col("date").alias("d"), lambda: X.is_true(F.col("smart_5_raw") > 0).alias("a"), lambda: X.is_true(F.col("smart_199_raw") > 0).alias("b"))


@query("cl34_align", "SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS size FROM customer UNION ALL SELECT p_partkey, p_name, CAST(p_size AS DOUBLE) FROM part")
def _(t):
    schema = [("id", "bigint"), ("name", "string"), ("size", "double")]
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return J.union_aligned(schema, a, b)


@query("cl35_tolerant_projection", "SELECT c_custkey, c_name, 'absent' AS missing FROM customer")
def _(t):
    df, missing = X.project_existing(t.customer, ["c_custkey", "c_name", "absent"])
    return df.withColumn("missing", F.lit(",".join(missing)))


# ---- filters -------------------------------------------------------------------------------------
@query("fl1_flag_filter", "SELECT ticket_pk FROM stg_tickets WHERE NOT is_deleted AND items_id IS NOT NULL")
def _(t):
    return Warehouse(t).stg_tickets.filter(~F.col("is_deleted") & F.col("items_id").isNotNull()).select("ticket_pk")


@query("fl2_in_lists", "SELECT ticket_pk, priority_tier FROM stg_tickets WHERE priority_tier IN ('critical','high') AND impact_tier NOT IN ('unknown')")
def _(t):
    d = Warehouse(t).stg_tickets.filter(F.col("priority_tier").isin("critical", "high") & ~F.col("impact_tier").isin("unknown"))
    return d.select("ticket_pk", "priority_tier")


@query("fl3_exclude_class", "SELECT memory_pk, memory_type FROM stg_ram")
def _(t):
    return Warehouse(t).stg_ram.select("memory_pk", "memory_type")


@query("fl4_domain_filter", "SELECT asset_pk FROM silver_assets WHERE source_domain = 'ocs_glpi'")
def _(t):
    return Warehouse(t).silver_assets.filter(F.col("source_domain") == "ocs_glpi").select("asset_pk")


@query("fl7_all_targets", "SELECT doc_id FROM bronze_ticket_texts WHERE priority_encoded IS NOT NULL AND urgency_encoded IS NOT NULL AND impact_encoded IS NOT NULL")
def _(t):
    return t.bronze("ticket_texts").dropna(how="any", subset=list(R.TRIAGE_TARGETS)).select("doc_id")


# ---- joins ---------------------------------------------------------------------------------------
_HW = "SELECT hardware_pk, uuid, lower(hostname) AS host, source_year FROM stg_hardware"


@query("j1_left_equi", "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_mktsegment")


@query("j2_composite_key", "SELECT hardware_pk, serial_number FROM stg_hardware h LEFT JOIN stg_bios b ON h.source_year = b.source_year AND h.hardware_id = b.hardware_id")
def _(t):
    w = Warehouse(t)
    return w.stg_hardware.join(w.stg_bios.select("source_year", "hardware_id", "serial_number"), ["source_year", "hardware_id"], "left").select("hardware_pk", "serial_number")


@query("j3_preaggregated", "SELECT hardware_pk, COALESCE(n, 0) AS software FROM stg_hardware h LEFT JOIN (SELECT source_year, hardware_id, COUNT(*) AS n FROM stg_software GROUP BY ALL) s ON s.source_year = h.source_year AND s.hardware_id = h.hardware_id")
def _(t):
    w = Warehouse(t)
    s = silver.software_summary(w.stg_software)
    return w.stg_hardware.join(s, ["source_year", "hardware_id"], "left").select("hardware_pk", F.coalesce("software_installed_count", F.lit(0)).alias("software"))


@query("j4_name_join", "SELECT l.log_id, u.user_id FROM stg_logs l JOIN tmp_accounts u ON lower(TRIM(l.user_name)) = lower(TRIM(u.user_name))")
def _(t):
    w = Warehouse(t)
    u = silver.distinct_accounts(w.stg_users).select("user_id", F.lower(F.trim("user_name")).alias("k"))
    return w.stg_logs.select("log_id", F.lower(F.trim("user_name")).alias("k")).join(u, "k").select("log_id", "user_id")


@query("j5_match_any", "SELECT h.hardware_pk, c.unique_id FROM stg_hardware h LEFT JOIN stg_computers c ON h.uuid = c.computer_uuid OR (lower(h.hostname) = lower(c.computer_name) AND h.source_year = c.source_year)")
def _(t):
    return _matched(t).select("hardware_pk", "unique_id")


def _matched(t):
    w = Warehouse(t)
    right = w.stg_computers.select("unique_id", "computer_id", "computer_uuid", "computer_name", F.col("source_year").alias("cy"))
    rules = [([F.col("uuid")], [F.col("computer_uuid")]), ([F.lower("hostname"), F.col("source_year")], [F.lower("computer_name"), F.col("cy")])]
    return J.match_any(w.stg_hardware.select("hardware_pk", "uuid", "hostname", "source_year", "last_seen_date"), right, rules, "hardware_pk", "unique_id")


@query("j6_best_match", "SELECT hardware_pk, unique_id FROM (SELECT h.hardware_pk, c.unique_id, ROW_NUMBER() OVER (PARTITION BY h.hardware_pk ORDER BY CASE WHEN h.uuid = c.computer_uuid THEN 0 ELSE 1 END, c.computer_id NULLS LAST) AS rn FROM stg_hardware h LEFT JOIN stg_computers c ON h.uuid = c.computer_uuid OR (lower(h.hostname) = lower(c.computer_name) AND h.source_year = c.source_year)) WHERE rn = 1")
def _(t):
    order = [F.when(F.col("uuid") == F.col("computer_uuid"), 0).otherwise(1), F.col("computer_id").asc_nulls_last()]
    return J.latest_per_key(_matched(t), "hardware_pk", order).select("hardware_pk", "unique_id")


@query("j7_null_safe_year", "SELECT t.ticket_pk, b.id AS bronze_id FROM stg_tickets t LEFT JOIN bronze_glpi_tickets b ON b.id = t.ticket_id AND year(t.created_at) IS NOT DISTINCT FROM b.source_year")
def _(t):
    b = t.bronze("glpi_tickets").select(F.col("id").alias("bronze_id"), F.col("source_year").alias("by"))
    cond = (F.col("ticket_id") == F.col("bronze_id")) & F.year("created_at").eqNullSafe(F.col("by"))
    return Warehouse(t).stg_tickets.join(b, cond, "left").select("ticket_pk", "bronze_id")


@query("j8_enrich_dimension", "SELECT f.followup_id, u.username, u.user_type FROM stg_followups f JOIN tmp_accounts u ON u.user_id = f.user_id")
def _(t):
    w = Warehouse(t)
    return w.stg_followups.join(silver.distinct_accounts(w.stg_users), "user_id").select("followup_id", "username", "user_type")


@query("j9_merge_coverage", f"SELECT COUNT(*) AS row_count, COUNT(*) FILTER (c.c_custkey IS NULL) AS unmatched_rows, {rnd('COUNT(*) FILTER (c.c_custkey IS NULL) * 100.0 / COUNT(*)', 4)} AS unmatched_pct FROM events e LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = e.user_id")
def _(t):
    return J.merge_with_coverage(t.events, t.customer.filter("c_acctbal > 0"), "user_id", "c_custkey", ["c_acctbal"])[1]


# ---- aggregations --------------------------------------------------------------------------------
@query("a1_grouped", f"SELECT l_returnflag, COUNT(*) AS n, {rnd('SUM(l_quantity)', 2)} AS total, {rnd('AVG(l_quantity)', 4)} AS mean, MIN(l_shipdate) AS lo, MAX(l_shipdate) AS hi FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"), X.rounded(F.sum("l_quantity"), 2).alias("total"), X.rounded(F.avg("l_quantity"), 4).alias("mean"), F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))


@query("a2_conditional", "SELECT l_suppkey, COUNT(*) FILTER (l_returnflag = 'R') AS returned, SUM(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END)::BIGINT AS discounted FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("discounted"))


@query("a3_distinct_counts", "SELECT user_id, COUNT(DISTINCT event_type) AS types, COUNT(DISTINCT CAST(ts AS DATE)) AS days, COUNT(DISTINCT CASE WHEN value > 10 THEN event_type END) AS big_types FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.count_distinct("event_type").alias("types"), F.count_distinct(F.to_date("ts")).alias("days"), F.count_distinct(F.when(F.col("value") > 10, F.col("event_type"))).alias("big_types"))


@query("a4_guarded_ratio", f"SELECT l_suppkey, {rnd("COUNT(*) FILTER (l_returnflag = 'R') / NULLIF(COUNT(*), 0)::DOUBLE", 4)} AS returned_ratio FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(X.ratio(F.count_if(F.col("l_returnflag") == "R"), F.count("*")).alias("returned_ratio"))


@query("a5_worst_ordinal", f"SELECT hardware_id, MAX({codes('storage_health', R.DRIVE_HEALTH_ORDINAL, None)}) AS worst FROM stg_drives GROUP BY 1")
def _(t):
    return Warehouse(t).stg_drives.groupBy("hardware_id").agg(F.max(X.map_codes("storage_health", R.DRIVE_HEALTH_ORDINAL, None)).alias("worst"))


@query("a6_activity_span", "SELECT user_id, date_diff('day', CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE)) AS span_days, COUNT(DISTINCT CAST(ts AS DATE)) AS active_days FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.date_diff(F.max("ts"), F.min("ts")).cast("bigint").alias("span_days"), F.count_distinct(F.to_date("ts")).alias("active_days"))


@query("a7_decimal_average", f"SELECT user_id, {rnd('AVG(CAST(content_length AS DECIMAL(10,2)))', 2)} AS avg_length FROM stg_followups GROUP BY 1")
def _(t):
    return Warehouse(t).stg_followups.groupBy("user_id").agg(X.rounded(F.avg(F.col("content_length").cast("decimal(10,2)")), 2).alias("avg_length"))


@query("a8_token_rollup", "SELECT ticket_id, n AS followup_count, behaviour AS followup_behavior_tokens FROM tmp_behaviour")
def _(t):
    return gold.followup_behaviour(Warehouse(t).stg_followups).select("ticket_id", "followup_count", "followup_behavior_tokens")


@query("a9_value_counts", f"SELECT event_type AS value, COUNT(*) AS n, {rnd('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM events)', 4)} AS pct FROM events GROUP BY 1")
def _(t):
    return J.value_counts(t.events, "event_type")


def _contrast(c):
    m0, m1 = f"AVG(CASE WHEN l_returnflag <> 'R' THEN {c} END)", f"AVG(CASE WHEN l_returnflag = 'R' THEN {c} END)"
    return f"SELECT '{c}' AS feature, {rnd(m0, 4)} AS normal_mean, {rnd(m1, 4)} AS anomaly_mean, {rnd(f'{m1} - {m0}', 4)} AS delta, {rnd(f'({m1} - {m0}) / (abs({m0}) + 1e-6) * 100', 1)} AS pct_diff FROM lineitem"


@query("a10_group_contrast", " UNION ALL ".join(_contrast(c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def _(t):
    df = t.lineitem.withColumn("flag", (F.col("l_returnflag") == "R").cast("int"))
    return J.group_contrast(df, "flag", ["l_quantity", "l_extendedprice", "l_tax"])


@query("a11_global_summary", f"SELECT COUNT(*) AS documents, {rnd('AVG(n_chars)', 2)} AS avg_chars, quantile_cont(n_chars::DOUBLE, 0.5) AS median_chars, MAX(n_chars) AS max_chars, {rnd('(COUNT(*) - COUNT(DISTINCT text)) * 100.0 / COUNT(*)', 2)} AS duplicate_pct FROM documents")
def _(t):
    d = t.documents.groupBy(F.sha2("text", 256).alias("k"), "n_chars").agg(F.count("*").alias("n"))
    total = F.sum("n")
    return d.agg(
        total.alias("documents"), X.rounded(F.sum(F.col("n") * F.col("n_chars")) / total, 2).alias("avg_chars"),
        F.percentile("n_chars", F.lit(0.5), F.col("n")).alias("median_chars"), F.max("n_chars").alias("max_chars"),
        X.rounded((total - F.count("*")) * 100 / total, 2).alias("duplicate_pct"),
    )


# ---- windows, top-k, sets ------------------------------------------------------------------------
@query("w1_latest_per_key", "SELECT user_id, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1")
def _(t):
    return J.latest_per_key(t.events.select("user_id", "event_id", "ts"), "user_id", [F.col("ts").desc(), F.col("event_id")]).drop("ts")


@query("w2_first_per_name", "SELECT user_id, username FROM tmp_accounts")
def _(t):
    return silver.distinct_accounts(Warehouse(t).stg_users).select("user_id", "username")


@query("w3_multi_criteria", "SELECT l_orderkey, l_linenumber FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1")
def _(t):
    order = [F.when(F.col("l_returnflag") == "R", 0).otherwise(1), F.col("l_shipdate").desc(), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    return J.latest_per_key(t.lineitem, "l_orderkey", order).select("l_orderkey", "l_linenumber")


@query("w4_key_expression", "SELECT hardware_pk FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY COALESCE(uuid, hostname) ORDER BY last_seen_date DESC NULLS LAST, hardware_pk) AS rn FROM stg_hardware) WHERE rn = 1")
def _(t):
    d = J.latest_per_key(Warehouse(t).stg_hardware, F.coalesce("uuid", "hostname"), [F.col("last_seen_date").desc_nulls_last(), F.col("hardware_pk")])
    return d.select("hardware_pk")


@query("t1_head", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def _(t):
    return O.head(t.documents.select("doc_id", "n_chars"), [F.col("n_chars").desc(), F.col("doc_id")], 10)


@query("t5_random_sample", "SELECT * FROM events ORDER BY md5('42|' || event_id), event_id LIMIT 500")
def _(t):
    """A report sample of 500 rows: those with the smallest keyed hashes, wherever they are stored."""
    return t.events.orderBy(F.md5(F.concat(F.lit("42|"), F.col("event_id").cast("string"))), "event_id").limit(500)


@query("s1_union_all", "SELECT source_system, COUNT(*) AS n FROM silver_tickets GROUP BY 1")
def _(t):
    return Warehouse(t).silver_tickets.groupBy("source_system").agg(F.count("*").alias("n"))


@query("s2_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("s3_drop_duplicates", "SELECT ticket_pk, doc_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticket_pk ORDER BY doc_id) AS rn FROM bronze_ticket_texts) WHERE rn = 1")
def _(t):
    return J.drop_duplicates_ordered(t.bronze("ticket_texts").select("ticket_pk", "doc_id"), "ticket_pk", [F.col("doc_id")])


# ---- scalar families -----------------------------------------------------------------------------
q(
    "f1_string_functions",
    "SELECT p_partkey, p_brand || '_' || p_type AS c, concat_ws(' ', p_name, NULL, p_brand) AS w, upper(TRIM(p_name)) AS u, replace(p_brand, 'Brand#', '') AS r, substr(p_name, 2, 3) AS s, split_part(p_name, ' ', 1) AS f, strlen(p_name) AS b, p_name LIKE '%ring%' AS l, md5(p_name) AS h FROM part",
    "part", "p_partkey", lambda: F.concat("p_brand", F.lit("_"), "p_type").alias("c"), lambda: F.concat_ws(" ", "p_name", F.lit(None), "p_brand").alias("w"),
    lambda: F.upper(F.trim("p_name")).alias("u"), lambda: F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("r"), lambda: F.substring("p_name", 2, 3).alias("s"),
    lambda: F.substring_index("p_name", " ", 1).alias("f"), lambda: F.octet_length("p_name").cast("bigint").alias("b"), lambda: F.col("p_name").like("%ring%").alias("l"), lambda: F.md5("p_name").alias("h"),
)
q(
    "f2_date_functions",
    f"SELECT event_id, date_sub('hour', ts, {NOW}) AS h, date_sub('day', ts, {NOW}) AS d, date_sub('year', ts, {NOW}) AS y, date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS dd, CAST(ts AS DATE) AS dt, year(ts) AS yr, CAST(ts AS DATE) + 1 AS nxt FROM events",
    "events", "event_id", *[lambda u=u, a=a: X.elapsed(u, "ts", X.moment(AS_OF)).alias(a) for u, a in (("HOUR", "h"), ("DAY", "d"), ("YEAR", "y"))],
    lambda: F.date_diff(F.lit("2024-02-01").cast("date"), F.to_date("ts")).cast("bigint").alias("dd"), lambda: F.to_date("ts").alias("dt"), lambda: F.year("ts").cast("bigint").alias("yr"), lambda: F.date_add(F.to_date("ts"), 1).alias("nxt"),
)
q(
    "f3_math_functions",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('l_extendedprice * (1 - l_discount)', 2)} AS net, least(l_quantity, 10) AS lo, greatest(l_quantity, 10) AS hi, least(greatest(l_quantity / 25, 0.2), 1)::DOUBLE AS clip, round(ln(1 + l_quantity), 6) AS lg FROM lineitem",
    "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", lambda: X.rounded(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net"), lambda: F.least("l_quantity", F.lit(10.0)).alias("lo"), lambda: F.greatest("l_quantity", F.lit(10.0)).alias("hi"),
    lambda: F.least(F.greatest(F.col("l_quantity") / 25, F.lit(0.2)), F.lit(1.0)).alias("clip"), lambda: F.round(F.log(1 + F.col("l_quantity")), 6).alias("lg"),
)
q("f4_conditionals", "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS a, COALESCE(NULLIF(p_type, 'ECONOMY'), 'none') AS b FROM part", "part", "p_partkey", lambda: F.when(F.col("p_size") > 25, "big").otherwise("small").alias("a"), lambda: F.coalesce(F.nullif("p_type", F.lit("ECONOMY")), F.lit("none")).alias("b"))
q("f5_casts", f"SELECT ID AS id, {leading_int('CAPACITY')} AS n, TRY_CAST(CAPACITY AS BIGINT) AS t, CAST(NUMSLOTS AS VARCHAR) AS s, CAST(NUMSLOTS AS DOUBLE) AS d FROM bronze_ocs_memories", "bronze_ocs_memories", F_ID, lambda: X.leading_int("CAPACITY").alias("n"), lambda: F.trim("CAPACITY").try_cast("bigint").alias("t"), lambda: F.col("NUMSLOTS").cast("string").alias("s"), lambda: F.col("NUMSLOTS").cast("double").alias("d"))
q("f6_regex_functions", r"SELECT event_id, regexp_replace(props, '[^0-9]+', '', 'g') AS digits, len(regexp_extract_all(props, '[a-z]')) AS letters, regexp_extract(props, '([a-z]+)', 1) AS k FROM events", "events", "event_id", lambda: F.regexp_replace("props", "[^0-9]+", "").alias("digits"), lambda: F.size(F.regexp_extract_all("props", F.lit("([a-z])"), F.lit(1))).cast("bigint").alias("letters"), lambda: F.regexp_extract("props", "([a-z]+)", 1).alias("k"))
q("f7_json_functions", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, '{\"event_type\":\"' || event_type || '\",\"none\":null}' AS j FROM events", "events", "event_id", lambda: F.coalesce(F.from_json("props", "k int")["k"], F.get_json_object("props", "$.k").try_cast("int")).alias("k"), lambda: F.to_json(F.struct("event_type", F.lit(None).cast("string").alias("none")), {"ignoreNullFields": "false"}).alias("j"))
q("f8_array_functions", "SELECT p_partkey, len(string_split(p_name, ' ')) AS n, len(list_distinct(string_split(p_name || ' ' || p_name, ' '))) AS d, array_to_string(list_slice(string_split(p_name, ' '), 1, 1), ' ') AS f, list_contains(string_split(p_name, ' '), 'ring') AS has_ring FROM part", "part", "p_partkey", lambda: F.size(F.split("p_name", " ")).cast("bigint").alias("n"), lambda: F.size(F.array_distinct(F.split(F.concat_ws(" ", "p_name", "p_name"), " "))).cast("bigint").alias("d"), lambda: F.array_join(F.slice(F.split("p_name", " "), 1, 1), " ").alias("f"), lambda: F.array_contains(F.split("p_name", " "), "ring").alias("has_ring"))


@query("f9_map_lookup", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS label FROM orders")
def _(t):
    table = F.create_map(F.lit("F"), F.lit("finished"), F.lit("O"), F.lit("open"))
    return t.orders.select("o_orderkey", F.try_element_at(table, F.col("o_orderstatus")).alias("label"))


# ---- scores and tokens ---------------------------------------------------------------------------
@query("sc1_sla_risk", "SELECT ticket_fk, sla_risk_score FROM silver_triage")
def _(t):
    return Warehouse(t).silver_triage.select("ticket_fk", "sla_risk_score")


@query("sc2_escalation_probability", "SELECT ticket_fk, escalation_probability FROM silver_triage")
def _(t):
    return Warehouse(t).silver_triage.select("ticket_fk", "escalation_probability")


@query("sc3_rule_score", "SELECT asset_pk, rule_based_risk_score FROM gold_risk")
def _(t):
    return Warehouse(t).gold_risk.select("asset_pk", "rule_based_risk_score")


@query("sc4_risk_tier", "SELECT asset_pk, risk_tier FROM gold_risk")
def _(t):
    return Warehouse(t).gold_risk.select("asset_pk", "risk_tier")


@query("sc5_explanation", "SELECT asset_pk, risk_explanation FROM gold_risk")
def _(t):
    return Warehouse(t).gold_risk.select("asset_pk", "risk_explanation")


@query("sc6_activity_density", "SELECT user_pk, activity_density, active_data_sources, distinct_days_active FROM gold_anomalies")
def _(t):
    return Warehouse(t).gold_anomalies.select("user_pk", "activity_density", "active_data_sources", "distinct_days_active")


@query("sc7_failure_proxy", "SELECT items_id AS computer_id, COUNT(DISTINCT ticket_id) AS incident_count, CASE WHEN COUNT(DISTINCT CASE WHEN is_incident THEN ticket_id END) >= 2 OR COUNT(DISTINCT CASE WHEN is_incident AND priority >= 4 THEN ticket_id END) >= 1 THEN 1 ELSE 0 END AS proxy FROM stg_tickets WHERE item_type = 'Computer' AND items_id IS NOT NULL GROUP BY 1")
def _(t):
    d = silver.computer_incidents(Warehouse(t).stg_tickets)
    return d.select("computer_id", "incident_count", S.failure_proxy("hardware_incident_count", "critical_hardware_incidents").alias("proxy"))


_RISK = rnd("least(greatest((priority_encoded - 2) / 3.0::DOUBLE * 0.5::DOUBLE + (urgency_encoded - 2) / 3.0::DOUBLE * 0.3::DOUBLE + (impact_encoded - 3) / 2.0::DOUBLE * 0.2::DOUBLE, 0), 1)", 4)


@query("sc8_triage_escalation", f"SELECT doc_id, risk, risk > 0.6::DOUBLE AS escalate, risk >= 0.6::DOUBLE AS escalate_at FROM (SELECT doc_id, {_RISK} AS risk FROM bronze_ticket_texts WHERE priority_encoded IS NOT NULL AND urgency_encoded IS NOT NULL AND impact_encoded IS NOT NULL)")
def _(t):
    d = t.bronze("ticket_texts").dropna(subset=list(R.TRIAGE_TARGETS))
    risk, strict = S.triage_escalation(*R.TRIAGE_TARGETS)
    _, loose = S.triage_escalation(*R.TRIAGE_TARGETS, strict=False)
    return d.select("doc_id", risk.alias("risk"), strict.alias("escalate"), loose.alias("escalate_at"))


@query("sc11_suspicious_activity", "SELECT activity_pk, is_suspicious_activity, activity_category FROM silver_activity")
def _(t):
    return Warehouse(t).silver_activity.select("activity_pk", "is_suspicious_activity", "activity_category")


@query("sc12_richness", "SELECT similarity_pk, corpus_quality_score, similarity_confidence FROM gold_similarity")
def _(t):
    return Warehouse(t).gold_similarity.select("similarity_pk", "corpus_quality_score", "similarity_confidence")


@query("tk1_metadata_tokens", "SELECT ticket_pk, tokens FROM tmp_tokens")
def _(t):
    return Warehouse(t).stg_tickets.filter(~F.col("is_deleted")).select("ticket_pk", S.ticket_tokens().alias("tokens"))


@query("tk2_behaviour_tokens", "SELECT ticket_id, behaviour AS tokens, private_ratio FROM tmp_behaviour")
def _(t):
    d = gold.followup_behaviour(Warehouse(t).stg_followups)
    return d.select("ticket_id", F.col("followup_behavior_tokens").alias("tokens"), X.rounded("private_share", 4).alias("private_ratio"))


@query("tk3_infrastructure_tokens", "SELECT ticket_id, infra AS tokens, os_family FROM tmp_infra")
def _(t):
    w = Warehouse(t)
    context = gold.computer_infrastructure(w.stg_computers, w.stg_hardware, w.stg_bios, w.stg_software)
    d = gold.ticket_infrastructure(t.bronze("glpi_tickets"), context)
    return d.select(F.col("infra_ticket_id").alias("ticket_id"), F.coalesce("infra_tokens", F.lit("")).alias("tokens"), "os_family")


@query("tk4_token_ordinal", "SELECT ticket_pk, CASE WHEN tokens LIKE '%urg_critical%' THEN 5 WHEN tokens LIKE '%urg_high%' THEN 4 WHEN tokens LIKE '%urg_medium%' THEN 3 WHEN tokens LIKE '%urg_low%' THEN 2 ELSE 1 END AS level FROM tmp_tokens")
def _(t):
    d = Warehouse(t).stg_tickets.filter(~F.col("is_deleted")).select("ticket_pk", S.ticket_tokens().alias("tokens"))
    return d.select("ticket_pk", S.level_from_tokens("urg", "tokens").alias("level"))
