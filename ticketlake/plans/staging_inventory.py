"""Inventory staging models."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ticketlake import rules as R
from ticketlake.functions import cleanse as X
from ticketlake.plans.staging_desk import LINEAGE


def _blanks(*pairs):
    return [X.null_if_blank(src).alias(dst) for src, dst in pairs]


def bios(bronze: DataFrame, as_of: datetime) -> DataFrame:
    base = bronze.select(
        X.composite_key("source_year", "HARDWARE_ID").alias("bios_pk"),
        F.col("HARDWARE_ID").alias("hardware_id"),
        *_blanks(("SMANUFACTURER", "system_manufacturer"), ("SMODEL", "system_model")),
        X.null_if_in("SSN", R.BIOS_SERIAL_BLANKS).alias("serial_number"),
        X.classify("TYPE", R.DEVICE_TYPE, "other").alias("device_type"),
        X.null_if_blank("BMANUFACTURER").alias("bios_manufacturer"),
        X.first_token("BVERSION", ";").alias("bios_version"),
        X.day_month_date("BDATE").alias("bios_date"),
        X.null_if_in("ASSETTAG", (), contains=R.ASSET_TAG_PARTS).alias("asset_tag"),
        X.classify("SMANUFACTURER", R.VENDOR_GROUP, "Other").alias("manufacturer_group"),
        F.col("SSN").isNotNull().alias("has_serial_number"),
        F.col("BVERSION").isNotNull().alias("has_bios_version"),
        *LINEAGE,
    )
    age = X.elapsed("YEAR", "bios_date", X.moment(as_of))
    return base.withColumns({"bios_age_years": age, "bios_risk_level": X.tier(age, R.BIOS_RISK_CUTS, "unknown")})


def drives(bronze: DataFrame) -> DataFrame:
    total, free = F.col("TOTAL"), F.col("FREE")
    used = F.when(total > 0, (total - free) / F.nullif(total.cast("double"), F.lit(0.0)))
    return bronze.select(
        X.composite_key("source_year", "ID").alias("drive_pk"),
        F.col("ID").alias("drive_id"),
        F.col("HARDWARE_ID").alias("hardware_id"),
        X.upper_or_null("LETTER").alias("drive_letter"),
        X.classify("TYPE", R.DRIVE_TYPE, "other").alias("drive_type"),
        X.upper_or_null("FILESYSTEM").alias("filesystem"),
        X.scaled(X.positive("TOTAL"), 1024).alias("total_size_gb"),
        X.scaled(X.within("FREE", low=0), 1024).alias("free_size_gb"),
        X.within("NUMFILES", low=0).alias("num_files"),
        X.null_if_blank("VOLUMN").alias("volume_label"),
        F.col("CREATEDATE").alias("created_date"),
        X.rounded(used * 100, 2).alias("used_percent"),
        X.tier(used, R.DRIVE_USAGE_CUTS, "unknown").alias("storage_health"),
        X.is_true(total >= R.LARGE_DRIVE).alias("is_large_drive"),
        *LINEAGE,
    )


def hardware(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        X.composite_key("source_year", "ID").alias("hardware_pk"),
        F.col("ID").alias("hardware_id"),
        *_blanks(("DEVICEID", "device_id"), ("NAME", "hostname")),
        F.lower(F.trim("NAME")).alias("normalized_hostname"),
        *_blanks(
            ("WORKGROUP", "workgroup"),
            ("USERDOMAIN", "user_domain"),
            ("USERID", "logged_user"),
            ("OSNAME", "os_name"),
            ("OSVERSION", "os_version"),
            ("OSCOMMENTS", "os_comments"),
        ),
        X.classify("OSNAME", R.OS_FAMILY, "Other").alias("os_family"),
        X.null_if_blank("PROCESSORT").alias("processor_type"),
        F.col("PROCESSORS").alias("cpu_packages"),
        F.col("PROCESSORN").alias("cpu_cores"),
        X.scaled(X.positive("MEMORY"), 1024).alias("memory_gb"),
        X.scaled(X.positive("SWAP"), 1024).alias("swap_gb"),
        X.tier("MEMORY", R.MEMORY_TIER_CUTS, "critical").alias("memory_tier"),
        *_blanks(("IPADDR", "ip_address"), ("DNS", "dns_name"), ("DEFAULTGATEWAY", "default_gateway"), ("IPSRC", "ip_source")),
        X.ipv4_shape("IPADDR").alias("has_valid_ipv4"),
        F.col("ETIME").alias("inventory_time"),
        F.col("LASTDATE").alias("last_inventory_date"),
        F.col("LASTCOME").alias("last_seen_date"),
        F.col("QUALITY").alias("inventory_quality"),
        F.col("FIDELITY").alias("inventory_fidelity"),
        X.tier("QUALITY", R.QUALITY_CUTS, "poor").alias("inventory_quality_tier"),
        *_blanks(("WINCOMPANY", "windows_company"), ("WINOWNER", "windows_owner"), ("WINPRODID", "windows_product_id")),
        X.has_text("WINPRODKEY").alias("has_windows_key"),
        X.null_if_blank("USERAGENT").alias("user_agent"),
        F.col("CHECKSUM").alias("inventory_checksum"),
        F.col("SSTATE").alias("system_state"),
        X.null_if_blank("UUID").alias("uuid"),
        F.upper(F.trim("ARCH")).alias("architecture"),
        X.map_codes(F.lower("ARCH"), R.ARCH_FAMILY, "unknown").alias("architecture_family"),
        X.has_text("UUID").alias("has_uuid"),
        X.has_text("USERID").alias("has_logged_user"),
        *LINEAGE,
    )


def memories(bronze: DataFrame) -> DataFrame:
    speed = X.leading_int("SPEED")
    base = bronze.select(
        X.composite_key("source_year", "ID").alias("memory_pk"),
        F.col("ID").alias("memory_id"),
        F.col("HARDWARE_ID").alias("hardware_id"),
        *_blanks(("CAPTION", "memory_caption"), ("DESCRIPTION", "memory_description")),
        X.bytes_or_megabytes_gb("CAPACITY").alias("capacity_gb"),
        X.null_if_blank("PURPOSE").alias("memory_purpose"),
        X.classify("TYPE", R.MODULE_TYPE, "Other").alias("memory_type"),
        F.nullif(speed, F.lit(0).cast("bigint")).alias("speed_mhz"),
        X.tier(speed, R.MODULE_SPEED_CUTS, "unknown").alias("performance_tier"),
        X.positive("NUMSLOTS").alias("num_slots"),
        X.null_if_in("SERIALNUMBER", R.MODULE_SERIAL_BLANKS).alias("serial_number"),
        X.has_text("SERIALNUMBER").alias("has_serial_number"),
        F.col("CAPACITY").isNotNull().alias("has_capacity"),
        *LINEAGE,
    )
    return base.withColumn("memory_size_tier", X.tier("capacity_gb", R.MODULE_SIZE_CUTS, "unknown"))


def networks(bronze: DataFrame) -> DataFrame:
    speed = X.leading_int("SPEED")
    return bronze.select(
        X.composite_key("source_year", "ID").alias("network_pk"),
        F.col("ID").alias("network_id"),
        F.col("HARDWARE_ID").alias("hardware_id"),
        X.null_if_blank("DESCRIPTION").alias("network_description"),
        X.classify("TYPE", R.NETWORK_TYPE, "other").alias("network_type"),
        X.null_if_blank("TYPEMIB").alias("network_mib"),
        X.scaled(X.positive(speed), 1_000_000).alias("speed_mbps"),
        X.tier(speed, R.NETWORK_SPEED_CUTS, "unknown").alias("speed_tier"),
        X.upper_or_null("MACADDR").alias("mac_address"),
        X.map_codes(F.lower("STATUS"), R.CONNECTION_STATUS, "unknown").alias("connection_status"),
        *_blanks(
            ("IPADDRESS", "ip_address"),
            ("IPMASK", "ip_mask"),
            ("IPGATEWAY", "ip_gateway"),
            ("IPSUBNET", "ip_subnet"),
            ("IPDHCP", "dhcp_server"),
        ),
        X.ipv4_shape("IPADDRESS").alias("has_valid_ipv4"),
        X.has_text("IPDHCP").alias("uses_dhcp"),
        X.is_one("VIRTUALDEV").alias("is_virtual_device"),
        X.has_text("MACADDR").alias("has_mac_address"),
        *LINEAGE,
    )


def software(bronze: DataFrame) -> DataFrame:
    """One row per distinct installation; hot and worth materialising (``sinks.materialize``).

    Few rows repeat, so the raw columns move once, by installation, and equal rows are told where they meet; the derived
    ones, several times as wide, are neither hashed before a shuffle nor shuffled.
    """
    key = F.md5(
        F.concat(
            X.composite_key("source_year", "HARDWARE_ID", "ID"),
            F.lit("_"),
            F.coalesce("NAME", F.lit("")),
            F.lit("_"),
            F.coalesce("VERSION", F.lit("")),
        )
    )
    return bronze.repartition("source_year", "HARDWARE_ID", "ID").select(
        key.alias("software_pk"),
        F.col("ID").alias("software_id"),
        F.col("HARDWARE_ID").alias("hardware_id"),
        *_blanks(("PUBLISHER", "publisher"), ("NAME", "software_name")),
        F.lower(F.trim("NAME")).alias("normalized_software_name"),
        *_blanks(("VERSION", "software_version"), ("FOLDER", "install_folder"), ("COMMENTS", "comments"), ("FILENAME", "executable_name")),
        X.scaled(X.positive("FILESIZE"), 1024).alias("filesize_mb"),
        F.col("SOURCE").alias("software_source"),
        *_blanks(("GUID", "software_guid"), ("LANGUAGE", "software_language")),
        F.col("INSTALLDATE").alias("install_date"),
        X.map_codes("BITSWIDTH", R.BITS_WIDTH, "unknown").alias("architecture"),
        X.classify("NAME", R.SOFTWARE_CATEGORY, "other").alias("software_category"),
        X.has_text("GUID").alias("has_guid"),
        X.has_text("VERSION").alias("has_version"),
        F.col("INSTALLDATE").isNotNull().alias("has_install_date"),
        X.classify("NAME", R.SOFTWARE_RISK, "normal").alias("software_risk_level"),
        *LINEAGE,
    ).distinct()


def storages(bronze: DataFrame) -> DataFrame:
    everything = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("NAME", "MODEL", "DESCRIPTION", "TYPE")])
    return bronze.select(
        X.composite_key("source_year", "ID").alias("storage_pk"),
        F.col("ID").alias("storage_id"),
        F.col("HARDWARE_ID").alias("hardware_id"),
        X.null_if_blank("MANUFACTURER").alias("manufacturer"),
        X.classify("MANUFACTURER", R.STORAGE_VENDOR, "Other").alias("manufacturer_group"),
        *_blanks(("NAME", "storage_name"), ("MODEL", "storage_model"), ("DESCRIPTION", "storage_description")),
        F.coalesce(
            X.classify(everything, R.STORAGE_TYPE_ANY, None), X.classify("TYPE", R.STORAGE_TYPE_BUS, "Other")
        ).alias("storage_type"),
        X.scaled(X.positive("DISKSIZE"), 1024).alias("disk_size_gb"),
        X.tier("DISKSIZE", R.STORAGE_SIZE_CUTS, "unknown").alias("storage_size_tier"),
        X.null_if_in("SERIALNUMBER", R.STORAGE_SERIAL_BLANKS).alias("serial_number"),
        X.null_if_blank("FIRMWARE").alias("firmware_version"),
        X.has_text("SERIALNUMBER").alias("has_serial_number"),
        X.has_text("FIRMWARE").alias("has_firmware"),
        X.classify("TYPE", R.STORAGE_PERFORMANCE, "unknown").alias("performance_tier"),
        *LINEAGE,
    )
