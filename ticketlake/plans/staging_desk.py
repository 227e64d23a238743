"""Service-desk staging models: one bronze table in, one typed and cleansed table out."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X

LINEAGE = ("source_year", "source_system")


def tickets(bronze: DataFrame) -> DataFrame:
    status = F.col("status").cast("string")
    timed = bronze.select(
        "*",
        X.clean_ts("date").alias("created_at"),
        X.clean_ts("solvedate").alias("_solved"),
        X.clean_ts("closedate").alias("_closed"),
    )
    return timed.select(
        X.composite_key("source_year", "id").alias("ticket_pk"),
        F.col("id").alias("ticket_id"),
        "created_at",
        X.not_before("_solved", "created_at").alias("solved_at"),
        X.not_before("_closed", "created_at").alias("closed_at"),
        "status",
        X.is_true(status.isin(*R.CLOSED_STATUS)).alias("is_closed"),
        X.is_true(status.isin(*R.RESOLVED_STATUS)).alias("is_resolved"),
        X.is_true(status.isin(*R.WAITING_STATUS)).alias("is_waiting"),
        X.is_one("is_deleted").alias("is_deleted"),
        *[
            X.within(c, low=0).alias(c)
            for c in ("waiting_duration", "close_delay_stat", "solve_delay_stat", "takeintoaccount_delay_stat")
        ],
        X.elapsed("HOUR", "created_at", X.not_before("_solved", "created_at")).alias("resolution_time_hours"),
        X.elapsed("HOUR", "created_at", X.not_before("_closed", "created_at")).alias("closure_time_hours"),
        X.map_codes("type", R.TICKET_TYPE, "unknown").alias("ticket_type"),
        X.is_one("type").alias("is_incident"),
        X.null_if_blank("itemtype").alias("item_type"),
        X.positive("items_id").alias("items_id"),
        X.positive("itilcategories_id").alias("itilcategories_id"),
        X.null_if_in("content", R.CONTENT_BLANKS).alias("content"),
        *[X.floor_at_one(c).alias(c) for c in ("priority", "urgency", "impact")],
        *[X.tier(c, R.LEVEL_CUTS, "unknown").alias(f"{c}_tier") for c in ("priority", "urgency", "impact")],
        *LINEAGE,
    )


def users(bronze: DataFrame) -> DataFrame:
    name = F.lower("name")
    anonymous = F.col("firstname").isNull() & F.col("realname").isNull()
    return bronze.select(
        X.composite_key("source_year", "id").alias("user_pk"),
        F.col("id").alias("user_id"),
        X.null_if_blank("name").alias("user_name"),
        F.lower(F.trim("name")).alias("normalized_username"),
        X.null_if_blank("firstname").alias("first_name"),
        X.null_if_blank("realname").alias("last_name"),
        X.full_name("firstname", "realname").alias("full_name"),
        X.null_if_blank("user_dn").alias("user_dn"),
        X.has_text("user_dn").alias("has_directory_account"),
        X.is_true(X.contains_any("user_dn", "dc=")).alias("is_ldap_user"),
        X.null_if_blank("personal_token").alias("personal_token"),
        X.has_text("personal_token").alias("has_personal_token"),
        X.clean_ts("personal_token_date").alias("personal_token_date"),
        F.when(F.col("name").contains("$") | name.isin(*R.SYSTEM_ACCOUNTS), "SYSTEM")
        .when(name.isin(*R.SERVICE_ACCOUNTS), "SERVICE")
        .when(name.contains("test"), "TEST")
        .when(~anonymous, "HUMAN")
        .otherwise("UNKNOWN")
        .alias("user_type"),
        X.has_text("name").alias("has_username"),
        (X.has_text("firstname") | X.has_text("realname")).alias("has_real_identity"),
        X.is_true(
            (F.octet_length(F.trim("name")) <= 3) | (~F.col("name").contains(".") & anonymous)
        ).alias("suspicious_account"),
        *LINEAGE,
    )


def followups(bronze: DataFrame) -> DataFrame:
    long_enough = F.octet_length(F.trim("content")) >= 5
    return bronze.select(
        X.composite_key("source_year", "id").alias("ticket_followup_pk"),
        F.col("id").alias("followup_id"),
        F.col("tickets_id").alias("ticket_id"),
        X.clean_ts("date").alias("created_at"),
        F.col("users_id").alias("user_id"),
        F.col("requesttypes_id").alias("request_type_id"),
        X.strip_entities("content", R.FOLLOWUP_LITERALS).alias("content"),
        X.is_true(long_enough).alias("has_meaningful_content"),
        X.is_true(X.contains_any("content", "http")).alias("contains_url"),
        (~X.is_true(long_enough)).alias("is_system_generated"),
        X.is_one("is_private").alias("is_private"),
        F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("content_length"),
        *LINEAGE,
    )


def logs(bronze: DataFrame) -> DataFrame:
    normal = bronze.select(
        X.composite_key("source_year", "id").alias("unique_id"),
        F.col("id").alias("log_id"),
        F.col("items_id").alias("entity_id"),
        X.null_if_blank("itemtype").alias("entity_type"),
        X.null_if_blank("itemtype_link").alias("linked_entity_type"),
        X.null_if_blank("linked_action").alias("linked_action"),
        X.null_if_blank("user_name").alias("user_name"),
        X.has_text("user_name").alias("has_user"),
        X.clean_ts("date_mod").alias("updated_at"),
        F.col("id_search_option").alias("field_id"),
        X.null_if_in("old_value", R.LOG_BLANKS).alias("old_value"),
        X.null_if_in("new_value", R.LOG_BLANKS).alias("new_value"),
        *LINEAGE,
    )
    changed = X.change_type("old_value", "new_value")
    return normal.withColumns({"change_type": changed, "has_change": changed != "no_change"})


def computers(bronze: DataFrame) -> DataFrame:
    known = F.coalesce(F.col("uuid") != "", F.lit(False))
    return bronze.select(
        X.composite_key("source_year", "id").alias("unique_id"),
        F.col("id").alias("computer_id"),
        F.when(known, F.col("uuid")).otherwise("unknown").alias("computer_uuid"),
        known.alias("has_uuid"),
        F.col("name").alias("computer_name"),
        *[X.is_one(c).alias(c) for c in ("is_template", "is_deleted", "is_ocs_import")],
        "manufacturers_id",
        "users_id",
        "groups_id",
        *LINEAGE,
        X.map_codes("is_template", [("1", "template")], "real_machine").alias("computer_type"),
    )


def infocoms(bronze: DataFrame) -> DataFrame:
    buy, warranty = X.clean_date("buy_date"), X.clean_date("warranty_date")
    return bronze.select(
        X.composite_key("source_year", "id").alias("infocom_pk"),
        F.col("id").alias("infocom_id"),
        F.col("items_id").alias("item_id"),
        X.classify("itemtype", R.ITEM_TYPE, "Other").alias("item_type"),
        F.col("entities_id").alias("entity_id"),
        F.round(F.nullif(F.col("value"), F.lit(0.0)), 2).alias("asset_value"),
        F.round(F.nullif(F.col("warranty_value"), F.lit(0.0)), 2).alias("warranty_value"),
        buy.alias("buy_date"),
        warranty.alias("warranty_date"),
        warranty.isNotNull().alias("has_warranty"),
        F.when(F.coalesce(F.col("value"), F.lit(0.0)) == 0, "unknown")
        .otherwise(X.tier("value", R.ASSET_VALUE_CUTS, "low"))
        .alias("asset_value_tier"),
        buy.isNotNull().alias("has_buy_date"),
        *LINEAGE,
    )


def itil_categories(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        X.composite_key("source_year", "id").alias("itil_category_pk"),
        F.col("id").alias("category_id"),
        F.col("completename").alias("full_category_name"),
        X.null_if_blank("name").alias("category_name"),
        F.lower(F.trim("name")).alias("normalized_category_name"),
        F.col("itilcategories_id").alias("parent_category_id"),
        "level",
        (F.coalesce("itilcategories_id", F.lit(0)) == 0).alias("is_root_category"),
        X.classify("name", R.CATEGORY_TYPE, "OTHER").alias("category_type"),
        X.is_one("is_helpdeskvisible").alias("is_visible_helpdesk"),
        X.tier("level", R.CATEGORY_DEPTH, "unknown").alias("category_complexity"),
        X.has_text("name").alias("has_valid_name"),
        *LINEAGE,
    )


def device_processors(bronze: DataFrame) -> DataFrame:
    family = X.classify("designation", R.CPU_FAMILY, "Other")
    return bronze.select(
        X.composite_key("source_year", "id").alias("processor_pk"),
        F.col("id").alias("processor_id"),
        "designation",
        family.alias("cpu_family"),
        X.classify("designation", R.CPU_ARCH, "unknown").alias("architecture"),
        X.classify("designation", R.CPU_CORES, None).alias("core_count"),
        F.when(F.col("specif_default") != 0, X.within("specif_default", high=10000)).alias("frequency_mhz"),
        X.is_true(F.col("specif_default") != 0).alias("has_frequency_data"),
        *LINEAGE,
        X.map_codes(family, R.CPU_PERFORMANCE, "unknown").alias("performance_tier"),
        (family == "Xeon").alias("is_server_cpu"),
    )


def device_memories(bronze: DataFrame) -> DataFrame:
    designation = X.fold("designation")
    mhz = X.leading_int("frequence")
    named = F.coalesce(F.col("frequence") != "0", F.lit(False))
    base = bronze.select(
        X.composite_key("source_year", "id").alias("memory_pk"),
        F.col("id").alias("memory_id"),
        "designation",
        X.classify("designation", R.RAM_TYPE, "Other").alias("memory_type"),
        X.is_true(designation.contains("ecc") & ~designation.contains("no ecc")).alias("is_ecc"),
        F.when(named, X.within(mhz, high=5000)).alias("frequency_mhz"),
        named.alias("has_frequency_data"),
        X.scaled(F.nullif("specif_default", F.lit(0)), 1024).alias("memory_size_gb"),
        *LINEAGE,
    ).filter(F.col("memory_type") != "FLASH")
    kind = F.col("memory_type")
    return base.withColumns(
        {
            "memory_capacity_tier": X.tier("memory_size_gb", R.RAM_CAPACITY_CUTS, "legacy"),
            "performance_tier": F.when(kind.isin("DDR5", "DDR4"), "high")
            .when((kind == "DDR3") & (F.col("frequency_mhz") >= 1333), "high")
            .when((kind == "DDR3") & F.col("frequency_mhz").isNotNull(), "medium")
            .when(kind.isin("DDR2", "DDR", "SDRAM", "RDRAM"), "low")
            .otherwise("unknown"),
            "is_server_memory": F.col("is_ecc"),
        }
    )


def device_graphic_cards(bronze: DataFrame) -> DataFrame:
    named = bronze.select(
        X.composite_key("source_year", "id").alias("gpu_pk"),
        F.col("id").alias("gpu_id"),
        X.null_if_in("designation", R.GPU_JUNK, contains=R.GPU_JUNK_PARTS).alias("gpu_name"),
        X.scaled(F.nullif("specif_default", F.lit(0)), 1024).alias("vram_gb"),
        *LINEAGE,
    ).filter(F.col("gpu_name").isNotNull())
    kind = X.classify("gpu_name", R.GPU_TYPE, "dedicated")
    vram = F.col("vram_gb")
    return named.select(
        "gpu_pk",
        "gpu_id",
        "gpu_name",
        X.classify("gpu_name", R.GPU_BRAND, "Other").alias("gpu_brand"),
        kind.alias("gpu_type"),
        "vram_gb",
        *LINEAGE,
        F.when(kind == "virtual", "virtual")
        .when((kind == "integrated") & (vram >= 1), "medium")
        .when(kind == "integrated", "low")
        .when(vram >= 4, "high")
        .when(vram >= 1, "medium")
        .when(vram.isNull(), "unknown")
        .otherwise("low")
        .alias("performance_tier"),
    )
