"""Domain models and their oracles."""
from __future__ import annotations

from catalog.registry import blank, classify, codes, cte, has, is_in, leading_int, null_in, one, query, rnd, tier
from ticketlake import rules as R
from ticketlake.plans.warehouse import Warehouse

NOW = "TIMESTAMP '2024-02-01 00:00:00'"
KEY = "CAST(source_year AS VARCHAR) || '_' || CAST({} AS VARCHAR)"


def _blanks(*pairs):
    return ", ".join(f"{blank(a)} AS {b}" for a, b in pairs)


def _ts(x):
    return f"TRY_CAST({x} AS TIMESTAMP)"


def _guard(end):
    return f"CASE WHEN {_ts(end)} < {_ts('date')} THEN NULL ELSE {_ts(end)} END"


cte("stg_tickets", f"""
SELECT {KEY.format('id')} AS ticket_pk, id AS ticket_id, {_ts('date')} AS created_at,
  {_guard('solvedate')} AS solved_at, {_guard('closedate')} AS closed_at, status,
  COALESCE({is_in('status', R.CLOSED_STATUS)}, FALSE) AS is_closed, COALESCE({is_in('status', R.RESOLVED_STATUS)}, FALSE) AS is_resolved,
  COALESCE({is_in('status', R.WAITING_STATUS)}, FALSE) AS is_waiting, {one('is_deleted')} AS is_deleted,
  {', '.join(f'CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}' for c in ('waiting_duration', 'close_delay_stat', 'solve_delay_stat', 'takeintoaccount_delay_stat'))},
  date_sub('hour', {_ts('date')}, {_guard('solvedate')}) AS resolution_time_hours,
  date_sub('hour', {_ts('date')}, {_guard('closedate')}) AS closure_time_hours,
  CASE type WHEN 1 THEN 'incident' WHEN 2 THEN 'request' ELSE 'unknown' END AS ticket_type, {one('type')} AS is_incident,
  {blank('itemtype')} AS item_type, CASE WHEN items_id <= 0 THEN NULL ELSE items_id END AS items_id,
  CASE WHEN itilcategories_id <= 0 THEN NULL ELSE itilcategories_id END AS itilcategories_id,
  CASE WHEN lower(TRIM(content)) IN ('', '-', 'null') THEN NULL ELSE TRIM(content) END AS content,
  {', '.join(f'CASE WHEN {c} IS NULL OR {c} < 1 THEN 1 ELSE {c} END AS {c}' for c in ('priority', 'urgency', 'impact'))},
  {', '.join(f"{tier(c, R.LEVEL_CUTS, 'unknown')} AS {c}_tier" for c in ('priority', 'urgency', 'impact'))},
  CAST(source_year AS INT) AS source_year, source_system
FROM bronze_glpi_tickets
""")
cte("stg_users", f"""
SELECT {KEY.format('id')} AS user_pk, id AS user_id, {blank('name')} AS user_name, lower(TRIM(name)) AS normalized_username,
  {_blanks(('firstname', 'first_name'), ('realname', 'last_name'))},
  {blank("COALESCE(firstname, '') || ' ' || COALESCE(realname, '')")} AS full_name, {blank('user_dn')} AS user_dn,
  {has('user_dn')} AS has_directory_account, COALESCE(user_dn LIKE '%DC=%', FALSE) AS is_ldap_user,
  {blank('personal_token')} AS personal_token, {has('personal_token')} AS has_personal_token, {_ts('personal_token_date')} AS personal_token_date,
  CASE WHEN name LIKE '%$%' OR lower(name) IN ('glpi','post-only','tech','normal','administrateur') THEN 'SYSTEM'
    WHEN lower(name) IN ('hotlinedsic','standard','contact','centre.documentation','sgagadir','waliagadir') THEN 'SERVICE'
    WHEN lower(name) LIKE '%test%' THEN 'TEST' WHEN firstname IS NOT NULL OR realname IS NOT NULL THEN 'HUMAN' ELSE 'UNKNOWN' END AS user_type,
  {has('name')} AS has_username, {has('firstname')} OR {has('realname')} AS has_real_identity,
  CASE WHEN strlen(TRIM(name)) <= 3 THEN TRUE WHEN name NOT LIKE '%.%' AND firstname IS NULL AND realname IS NULL THEN TRUE ELSE FALSE END AS suspicious_account,
  source_year, source_system
FROM bronze_glpi_users
""")
_STRIPPED = "replace(replace(replace(replace(content, '&gt;', ''), '--', ''), '&nbsp;', ''), '<br />', '')"
cte("stg_followups", f"""
SELECT {KEY.format('id')} AS ticket_followup_pk, id AS followup_id, tickets_id AS ticket_id, {_ts('date')} AS created_at,
  users_id AS user_id, requesttypes_id AS request_type_id, {blank(_STRIPPED)} AS content,
  CASE WHEN content IS NULL OR strlen(TRIM(content)) < 5 THEN FALSE ELSE TRUE END AS has_meaningful_content,
  COALESCE(content LIKE '%http%', FALSE) AS contains_url,
  CASE WHEN content IS NULL OR strlen(TRIM(content)) < 5 THEN TRUE ELSE FALSE END AS is_system_generated,
  {one('is_private')} AS is_private, CAST(COALESCE(strlen(content), 0) AS BIGINT) AS content_length, source_year, source_system
FROM bronze_glpi_ticketfollowups
""")
cte("stg_logs", f"""
SELECT *, CASE WHEN old_value IS NULL AND new_value IS NOT NULL THEN 'created' WHEN old_value IS NOT NULL AND new_value IS NULL THEN 'deleted'
    WHEN lower(old_value) <> lower(new_value) THEN 'updated' ELSE 'no_change' END AS change_type,
  CASE WHEN lower(old_value) <> lower(new_value) THEN TRUE WHEN (old_value IS NULL) <> (new_value IS NULL) THEN TRUE ELSE FALSE END AS has_change
FROM (SELECT {KEY.format('id')} AS unique_id, id AS log_id, items_id AS entity_id,
  {_blanks(('itemtype', 'entity_type'), ('itemtype_link', 'linked_entity_type'), ('linked_action', 'linked_action'), ('user_name', 'user_name'))},
  {has('user_name')} AS has_user, CAST(date_mod AS TIMESTAMP) AS updated_at, id_search_option AS field_id,
  CASE WHEN TRIM(old_value) IN ('', '-') THEN NULL ELSE TRIM(old_value) END AS old_value,
  CASE WHEN TRIM(new_value) IN ('', '-') THEN NULL ELSE TRIM(new_value) END AS new_value, source_year, source_system FROM bronze_glpi_logs)
""")
cte("stg_computers", f"""
SELECT {KEY.format('id')} AS unique_id, id AS computer_id, COALESCE(NULLIF(uuid, ''), 'unknown') AS computer_uuid,
  COALESCE(uuid <> '', FALSE) AS has_uuid, name AS computer_name, {one('is_template')} AS is_template, {one('is_deleted')} AS is_deleted,
  {one('is_ocs_import')} AS is_ocs_import, manufacturers_id, users_id, groups_id, source_year, source_system,
  CASE WHEN is_template = 1 THEN 'template' ELSE 'real_machine' END AS computer_type FROM bronze_glpi_computers
""")
cte("stg_infocoms", f"""
SELECT {KEY.format('id')} AS infocom_pk, id AS infocom_id, items_id AS item_id, {classify('itemtype', R.ITEM_TYPE, 'Other')} AS item_type,
  entities_id AS entity_id, CASE WHEN value = 0 THEN NULL ELSE round(value, 2) END AS asset_value,
  CASE WHEN warranty_value = 0 THEN NULL ELSE round(warranty_value, 2) END AS warranty_value,
  TRY_CAST(buy_date AS DATE) AS buy_date, TRY_CAST(warranty_date AS DATE) AS warranty_date,
  TRY_CAST(warranty_date AS DATE) IS NOT NULL AS has_warranty,
  CASE WHEN value >= 5000 THEN 'critical' WHEN value >= 2000 THEN 'high' WHEN value >= 1000 THEN 'medium'
    WHEN value IS NULL OR value = 0 THEN 'unknown' ELSE 'low' END AS asset_value_tier,
  TRY_CAST(buy_date AS DATE) IS NOT NULL AS has_buy_date, source_year, source_system FROM bronze_glpi_infocoms
""")
cte("stg_categories", f"""
SELECT {KEY.format('id')} AS itil_category_pk, id AS category_id, completename AS full_category_name, {blank('name')} AS category_name,
  lower(TRIM(name)) AS normalized_category_name, itilcategories_id AS parent_category_id, level,
  itilcategories_id IS NULL OR itilcategories_id = 0 AS is_root_category, {classify('name', R.CATEGORY_TYPE, 'OTHER')} AS category_type,
  {one('is_helpdeskvisible')} AS is_visible_helpdesk, {tier('level', R.CATEGORY_DEPTH, 'unknown')} AS category_complexity,
  {has('name')} AS has_valid_name, source_year, source_system FROM bronze_glpi_itilcategories
""")
cte("stg_processors", f"""
SELECT *, {codes('cpu_family', R.CPU_PERFORMANCE, 'unknown')} AS performance_tier, cpu_family = 'Xeon' AS is_server_cpu
FROM (SELECT {KEY.format('id')} AS processor_pk, id AS processor_id, designation, {classify('designation', R.CPU_FAMILY, 'Other')} AS cpu_family,
  {classify('designation', R.CPU_ARCH, 'unknown')} AS architecture, {classify('designation', R.CPU_CORES, None)} AS core_count,
  CASE WHEN specif_default = 0 OR specif_default > 10000 THEN NULL ELSE specif_default END AS frequency_mhz,
  COALESCE(specif_default <> 0, FALSE) AS has_frequency_data, source_year, source_system FROM bronze_glpi_deviceprocessors)
""")
cte("stg_ram", f"""
SELECT *, {tier('memory_size_gb', R.RAM_CAPACITY_CUTS, 'legacy')} AS memory_capacity_tier,
  CASE WHEN memory_type IN ('DDR5','DDR4') THEN 'high' WHEN memory_type = 'DDR3' AND frequency_mhz >= 1333 THEN 'high'
    WHEN memory_type = 'DDR3' AND frequency_mhz IS NOT NULL THEN 'medium' WHEN memory_type IN ('DDR2','DDR','SDRAM','RDRAM') THEN 'low'
    ELSE 'unknown' END AS performance_tier, is_ecc AS is_server_memory
FROM (SELECT {KEY.format('id')} AS memory_pk, id AS memory_id, designation, {classify('designation', R.RAM_TYPE, 'Other')} AS memory_type,
  CASE WHEN lower(designation) LIKE '%no ecc%' THEN FALSE WHEN lower(designation) LIKE '%ecc%' THEN TRUE ELSE FALSE END AS is_ecc,
  CASE WHEN frequence = '0' OR {leading_int('frequence')} > 5000 THEN NULL ELSE {leading_int('frequence')} END AS frequency_mhz,
  COALESCE(frequence <> '0', FALSE) AS has_frequency_data,
  round(NULLIF(specif_default, 0) / 1024.0, 2)::DOUBLE AS memory_size_gb, source_year, source_system FROM bronze_glpi_devicememories)
WHERE memory_type <> 'FLASH'
""")
cte("stg_gpus", f"""
SELECT gpu_pk, gpu_id, gpu_name, gpu_brand, gpu_type, vram_gb, source_year, source_system,
  CASE WHEN gpu_type = 'virtual' THEN 'virtual' WHEN gpu_type = 'integrated' AND vram_gb >= 1 THEN 'medium' WHEN gpu_type = 'integrated' THEN 'low'
    WHEN vram_gb >= 4 THEN 'high' WHEN vram_gb >= 1 THEN 'medium' WHEN vram_gb IS NULL THEN 'unknown' ELSE 'low' END AS performance_tier
FROM (SELECT *, {classify('gpu_name', R.GPU_BRAND, 'Other')} AS gpu_brand, {classify('gpu_name', R.GPU_TYPE, 'dedicated')} AS gpu_type
  FROM (SELECT {KEY.format('id')} AS gpu_pk, id AS gpu_id, {null_in('designation', R.GPU_JUNK, R.GPU_JUNK_PARTS)} AS gpu_name,
    round(NULLIF(specif_default, 0) / 1024.0, 2)::DOUBLE AS vram_gb, source_year, source_system FROM bronze_glpi_devicegraphiccards))
WHERE gpu_name IS NOT NULL
""")
cte("stg_bios", f"""
SELECT *, date_sub('year', bios_date, DATE '2024-02-01') AS bios_age_years,
  {tier("date_sub('year', bios_date, DATE '2024-02-01')", R.BIOS_RISK_CUTS, 'unknown')} AS bios_risk_level
FROM (SELECT {KEY.format('HARDWARE_ID')} AS bios_pk, HARDWARE_ID AS hardware_id, {_blanks(('SMANUFACTURER', 'system_manufacturer'), ('SMODEL', 'system_model'))},
  {null_in('SSN', R.BIOS_SERIAL_BLANKS)} AS serial_number, {classify('TYPE', R.DEVICE_TYPE, 'other')} AS device_type,
  {blank('BMANUFACTURER')} AS bios_manufacturer, {blank("split_part(BVERSION, ';', 1)")} AS bios_version,
  CASE WHEN NOT regexp_matches(BDATE, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') THEN NULL
    WHEN CAST(substr(BDATE, 4, 2) AS INT) BETWEEN 1 AND 12 THEN CAST(try_strptime(BDATE, '%d/%m/%Y') AS DATE)
    WHEN CAST(substr(BDATE, 1, 2) AS INT) BETWEEN 1 AND 12 THEN CAST(try_strptime(BDATE, '%m/%d/%Y') AS DATE) END AS bios_date,
  {null_in('ASSETTAG', (), R.ASSET_TAG_PARTS)} AS asset_tag, {classify('SMANUFACTURER', R.VENDOR_GROUP, 'Other')} AS manufacturer_group,
  SSN IS NOT NULL AS has_serial_number, BVERSION IS NOT NULL AS has_bios_version, source_year, source_system FROM bronze_ocs_bios)
""")
_USED = "((TOTAL - FREE) / CAST(NULLIF(TOTAL, 0) AS DOUBLE))"
cte("stg_drives", f"""
SELECT {KEY.format('ID')} AS drive_pk, ID AS drive_id, HARDWARE_ID AS hardware_id, upper({blank('LETTER')}) AS drive_letter,
  {classify('TYPE', R.DRIVE_TYPE, 'other')} AS drive_type, upper({blank('FILESYSTEM')}) AS filesystem,
  CASE WHEN TOTAL > 0 THEN round(TOTAL::DOUBLE / 1024, 2) END AS total_size_gb, CASE WHEN FREE >= 0 THEN round(FREE::DOUBLE / 1024, 2) END AS free_size_gb,
  CASE WHEN NUMFILES < 0 THEN NULL ELSE NUMFILES END AS num_files, {blank('VOLUMN')} AS volume_label, CREATEDATE AS created_date,
  CASE WHEN TOTAL > 0 THEN {rnd(_USED + " * 100", 2)} END AS used_percent,
  CASE WHEN TOTAL IS NULL OR TOTAL <= 0 OR FREE IS NULL THEN 'unknown' WHEN {_USED} >= 0.9 THEN 'critical' WHEN {_USED} >= 0.75 THEN 'high'
    WHEN {_USED} >= 0.5 THEN 'medium' ELSE 'healthy' END AS storage_health,
  COALESCE(TOTAL >= 500000, FALSE) AS is_large_drive, source_year, source_system FROM bronze_ocs_drives
""")
cte("stg_hardware", f"""
SELECT {KEY.format('ID')} AS hardware_pk, ID AS hardware_id, {_blanks(('DEVICEID', 'device_id'), ('NAME', 'hostname'))}, lower(TRIM(NAME)) AS normalized_hostname,
  {_blanks(('WORKGROUP', 'workgroup'), ('USERDOMAIN', 'user_domain'), ('USERID', 'logged_user'), ('OSNAME', 'os_name'), ('OSVERSION', 'os_version'), ('OSCOMMENTS', 'os_comments'))},
  {classify('OSNAME', R.OS_FAMILY, 'Other')} AS os_family, {blank('PROCESSORT')} AS processor_type, PROCESSORS AS cpu_packages, PROCESSORN AS cpu_cores,
  CASE WHEN MEMORY > 0 THEN round(MEMORY::DOUBLE / 1024, 2) END AS memory_gb, CASE WHEN SWAP > 0 THEN round(SWAP::DOUBLE / 1024, 2) END AS swap_gb,
  {tier('MEMORY', R.MEMORY_TIER_CUTS, 'critical')} AS memory_tier,
  {_blanks(('IPADDR', 'ip_address'), ('DNS', 'dns_name'), ('DEFAULTGATEWAY', 'default_gateway'), ('IPSRC', 'ip_source'))},
  COALESCE(regexp_matches(IPADDR, '^[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+$'), FALSE) AS has_valid_ipv4, ETIME AS inventory_time,
  LASTDATE AS last_inventory_date, LASTCOME AS last_seen_date, QUALITY AS inventory_quality, FIDELITY AS inventory_fidelity,
  {tier('QUALITY', R.QUALITY_CUTS, 'poor')} AS inventory_quality_tier,
  {_blanks(('WINCOMPANY', 'windows_company'), ('WINOWNER', 'windows_owner'), ('WINPRODID', 'windows_product_id'))}, {has('WINPRODKEY')} AS has_windows_key,
  {blank('USERAGENT')} AS user_agent, CHECKSUM AS inventory_checksum, SSTATE AS system_state, {blank('UUID')} AS uuid, upper(TRIM(ARCH)) AS architecture,
  {codes('lower(ARCH)', R.ARCH_FAMILY, 'unknown')} AS architecture_family, {has('UUID')} AS has_uuid, {has('USERID')} AS has_logged_user,
  source_year, source_system FROM bronze_ocs_hardware
""")
cte("stg_memories", f"""
SELECT *, {tier('capacity_gb', R.MODULE_SIZE_CUTS, 'unknown')} AS memory_size_tier
FROM (SELECT {KEY.format('ID')} AS memory_pk, ID AS memory_id, HARDWARE_ID AS hardware_id,
  {_blanks(('CAPTION', 'memory_caption'), ('DESCRIPTION', 'memory_description'))},
  CASE WHEN {leading_int('CAPACITY')} > 1000000000 THEN round(({leading_int('CAPACITY')})::DOUBLE / 1073741824, 2)
    WHEN {leading_int('CAPACITY')} > 256 THEN round(({leading_int('CAPACITY')})::DOUBLE / 1024, 2) END AS capacity_gb,
  {blank('PURPOSE')} AS memory_purpose, {classify('TYPE', R.MODULE_TYPE, 'Other')} AS memory_type,
  NULLIF({leading_int('SPEED')}, 0) AS speed_mhz, {tier('(' + leading_int('SPEED') + ')', R.MODULE_SPEED_CUTS, 'unknown')} AS performance_tier,
  CASE WHEN NUMSLOTS <= 0 THEN NULL ELSE NUMSLOTS END AS num_slots, {null_in('SERIALNUMBER', R.MODULE_SERIAL_BLANKS)} AS serial_number,
  {has('SERIALNUMBER')} AS has_serial_number, CAPACITY IS NOT NULL AS has_capacity, source_year, source_system FROM bronze_ocs_memories)
""")
cte("stg_networks", f"""
SELECT {KEY.format('ID')} AS network_pk, ID AS network_id, HARDWARE_ID AS hardware_id, {blank('DESCRIPTION')} AS network_description,
  {classify('TYPE', R.NETWORK_TYPE, 'other')} AS network_type, {blank('TYPEMIB')} AS network_mib,
  CASE WHEN {leading_int('SPEED')} > 0 THEN round(({leading_int('SPEED')})::DOUBLE / 1000000, 2) END AS speed_mbps,
  {tier('(' + leading_int('SPEED') + ')', R.NETWORK_SPEED_CUTS, 'unknown')} AS speed_tier, upper({blank('MACADDR')}) AS mac_address,
  {codes('lower(STATUS)', R.CONNECTION_STATUS, 'unknown')} AS connection_status,
  {_blanks(('IPADDRESS', 'ip_address'), ('IPMASK', 'ip_mask'), ('IPGATEWAY', 'ip_gateway'), ('IPSUBNET', 'ip_subnet'), ('IPDHCP', 'dhcp_server'))},
  COALESCE(regexp_matches(IPADDRESS, '^[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+$'), FALSE) AS has_valid_ipv4, {has('IPDHCP')} AS uses_dhcp,
  {one('VIRTUALDEV')} AS is_virtual_device, {has('MACADDR')} AS has_mac_address, source_year, source_system FROM bronze_ocs_networks
""")
cte("stg_software", f"""
SELECT DISTINCT md5({KEY.format('HARDWARE_ID')} || '_' || CAST(ID AS VARCHAR) || '_' || COALESCE(NAME, '') || '_' || COALESCE(VERSION, '')) AS software_pk,
  ID AS software_id, HARDWARE_ID AS hardware_id, {_blanks(('PUBLISHER', 'publisher'), ('NAME', 'software_name'))}, lower(TRIM(NAME)) AS normalized_software_name,
  {_blanks(('VERSION', 'software_version'), ('FOLDER', 'install_folder'), ('COMMENTS', 'comments'), ('FILENAME', 'executable_name'))},
  CASE WHEN FILESIZE > 0 THEN round(FILESIZE::DOUBLE / 1024, 2) END AS filesize_mb, SOURCE AS software_source,
  {_blanks(('GUID', 'software_guid'), ('LANGUAGE', 'software_language'))}, INSTALLDATE AS install_date,
  CASE BITSWIDTH WHEN 64 THEN '64bit' WHEN 32 THEN '32bit' ELSE 'unknown' END AS architecture,
  {classify('NAME', R.SOFTWARE_CATEGORY, 'other')} AS software_category, {has('GUID')} AS has_guid, {has('VERSION')} AS has_version,
  INSTALLDATE IS NOT NULL AS has_install_date, {classify('NAME', R.SOFTWARE_RISK, 'normal')} AS software_risk_level, source_year, source_system
FROM bronze_ocs_software
""")
_ALL = "COALESCE(NAME, '') || ' ' || COALESCE(MODEL, '') || ' ' || COALESCE(DESCRIPTION, '') || ' ' || COALESCE(TYPE, '')"
cte("stg_storages", f"""
SELECT {KEY.format('ID')} AS storage_pk, ID AS storage_id, HARDWARE_ID AS hardware_id, {blank('MANUFACTURER')} AS manufacturer,
  {classify('MANUFACTURER', R.STORAGE_VENDOR, 'Other')} AS manufacturer_group,
  {_blanks(('NAME', 'storage_name'), ('MODEL', 'storage_model'), ('DESCRIPTION', 'storage_description'))},
  COALESCE({classify(_ALL, R.STORAGE_TYPE_ANY, None)}, {classify('TYPE', R.STORAGE_TYPE_BUS, 'Other')}) AS storage_type,
  CASE WHEN DISKSIZE > 0 THEN round(DISKSIZE::DOUBLE / 1024, 2) END AS disk_size_gb, {tier('DISKSIZE', R.STORAGE_SIZE_CUTS, 'unknown')} AS storage_size_tier,
  {null_in('SERIALNUMBER', R.STORAGE_SERIAL_BLANKS)} AS serial_number, {blank('FIRMWARE')} AS firmware_version, {has('SERIALNUMBER')} AS has_serial_number,
  {has('FIRMWARE')} AS has_firmware, {classify('TYPE', R.STORAGE_PERFORMANCE, 'unknown')} AS performance_tier, source_year, source_system FROM bronze_ocs_storages
""")
_CVE_TEXT = ("access_authentication", "access_complexity", "access_vector", "impact_availability", "impact_confidentiality", "impact_integrity")
cte("stg_cve", f"""
SELECT DISTINCT md5(CAST(unnamed_0 AS VARCHAR) || '_' || COALESCE(pub_date, '')) AS cve_pk, unnamed_0 AS original_index, CAST(cwe_code AS BIGINT) AS cwe_code,
  {_blanks(('cwe_name', 'cwe_name'), ('summary', 'cve_summary'))}, {_ts('pub_date')} AS published_at, {_ts('mod_date')} AS modified_at,
  CASE WHEN cvss < 0 OR cvss > 10 THEN NULL ELSE round(cvss, 1) END AS cvss_score, {tier('cvss', R.CVSS_CUTS, 'unknown')} AS severity_level,
  {', '.join(f'lower({blank(c)}) AS {c}' for c in _CVE_TEXT)}, COALESCE(lower(access_vector) = 'network', FALSE) AS is_remote_exploitable,
  COALESCE(cvss >= 9, FALSE) AS is_critical, COALESCE(lower(access_complexity) = 'low', FALSE) AS easy_to_exploit FROM bronze_cve_data
""")
cte("stg_harddrive", f"""
SELECT DISTINCT md5(COALESCE(serial_number, '') || '_' || COALESCE(date, '')) AS harddrive_pk, {_blanks(('serial_number', 'serial_number'), ('model', 'model_name'))},
  TRY_CAST(date AS DATE) AS snapshot_date, CASE WHEN capacity_bytes > 0 THEN round(capacity_bytes::DOUBLE / 1073741824, 2) END AS capacity_gb,
  {one('failure')} AS has_failed, smart_5_raw AS reallocated_sectors, smart_9_raw AS power_on_hours, smart_187_raw AS reported_uncorrectable_errors,
  smart_188_raw AS command_timeout, smart_197_raw AS current_pending_sector_count, smart_198_raw AS offline_uncorrectable,
  smart_199_raw AS udma_crc_errors, smart_194_raw AS temperature_celsius, COALESCE(smart_5_raw > 0, FALSE) AS has_reallocated_sectors,
  COALESCE(smart_197_raw > 0, FALSE) AS has_pending_sectors, COALESCE(smart_198_raw > 0, FALSE) AS has_uncorrectable_sectors,
  COALESCE(smart_199_raw > 0, FALSE) AS has_crc_errors,
  CASE WHEN failure = 1 THEN 'failed' WHEN smart_197_raw > 0 OR smart_198_raw > 0 THEN 'critical' WHEN smart_5_raw > 0 THEN 'warning' ELSE 'healthy' END AS health_status,
  CASE WHEN failure = 1 THEN 100 ELSE COALESCE(smart_5_raw, 0) + COALESCE(smart_197_raw, 0) + COALESCE(smart_198_raw, 0) END AS disk_risk_score
FROM bronze_harddrive_data
""")
cte("stg_laptops", f"""
SELECT DISTINCT md5(CAST(laptop_ID AS VARCHAR) || '_' || COALESCE(Product, '')) AS laptop_pk, laptop_ID AS laptop_id,
  {_blanks(('Company', 'company'), ('Product', 'product_name'))}, lower({blank('TypeName')}) AS laptop_type, CAST(Inches AS DOUBLE) AS screen_size_inches,
  {blank('ScreenResolution')} AS screen_resolution, COALESCE(lower(ScreenResolution) LIKE '%ips%', FALSE) AS has_ips_panel,
  COALESCE(lower(ScreenResolution) LIKE '%touch%', FALSE) AS has_touchscreen, {blank('Cpu')} AS cpu_name, {classify('Cpu', R.LAPTOP_CPU, 'other')} AS cpu_family,
  {blank('Ram')} AS ram_raw, TRY_CAST(replace(lower(Ram), 'gb', '') AS BIGINT) AS ram_gb, {blank('Memory')} AS storage_configuration,
  COALESCE(lower(Memory) LIKE '%ssd%', FALSE) AS has_ssd, COALESCE(lower(Memory) LIKE '%hdd%', FALSE) AS has_hdd, {blank('Gpu')} AS gpu_name,
  {classify('Gpu', R.LAPTOP_GPU, 'Other')} AS gpu_brand, lower({blank('OpSys')}) AS operating_system, {blank('Weight')} AS weight_raw,
  CAST(TRY_CAST(replace(lower(Weight), 'kg', '') AS DECIMAL(5,2)) AS DOUBLE) AS weight_kg,
  CASE WHEN Price_euros < 0 THEN NULL ELSE round(Price_euros, 2) END AS price_euros, {tier('Price_euros', R.PRICE_CUTS, 'unknown')} AS price_segment
FROM bronze_laptop_price_data
""")
cte("stg_eventlog", f"""
SELECT DISTINCT md5(CAST(unnamed_0 AS VARCHAR) || '_' || COALESCE(MachineName, '') || '_' || COALESCE(TimeGenerated, '')) AS eventlog_pk, unnamed_0 AS original_index,
  {blank('MachineName')} AS machine_name, lower({blank('Category')}) AS event_category, lower({blank('EntryType')}) AS entry_type, {blank('Message')} AS event_message,
  lower({blank('Source')}) AS event_source, {_ts('TimeGenerated')} AS generated_at, lower({blank('country')}) AS country, lower({blank('regionName')}) AS region_name,
  lower({blank('city')}) AS city, zip AS zip_code, {_blanks(('timezone', 'timezone'), ('isp', 'isp'))},
  {classify('EntryType', R.EVENT_SEVERITY, 'informational')} AS severity_level,
  COALESCE(regexp_matches(lower(Message), 'failed|unauthorized|denied'), FALSE) AS suspicious_activity,
  COALESCE(lower(EntryType) LIKE '%error%', FALSE) AS is_error_event, COALESCE(lower(EntryType) LIKE '%warning%', FALSE) AS is_warning_event,
  {classify('Source', R.EVENT_DOMAIN, 'other')} AS event_domain FROM bronze_windows_eventlog_data
""")


def _lowered(*cols):
    return ", ".join(f"lower({blank(c)}) AS {c}" for c in cols)


_NO = "CAST(NULL AS {t}) AS {c}"
cte("stg_external", f"""
SELECT DISTINCT * FROM (
SELECT md5('support_' || ticket_id) AS unified_ticket_pk, source_dataset, ticket_id, {blank('customer_name')} AS customer_name, {_lowered('customer_email')},
  {blank('customer_segment')} AS customer_segment, customer_age, {_lowered('customer_gender', 'subscription_type')}, customer_tenure_months, previous_tickets,
  customer_satisfaction_score, {blank('product')} AS product, {_lowered('category')}, {blank('issue_description')} AS ticket_subject,
  {blank('issue_description')} AS ticket_body, {blank('resolution_notes')} AS resolution_notes, {_lowered('priority')}, lower({blank('status')}) AS ticket_status,
  lower({blank('channel')}) AS communication_channel, {_lowered('region', 'language', 'payment_method', 'preferred_contact_time', 'operating_system', 'browser')},
  first_response_time_hours, resolution_time_hours, issue_complexity_score, COALESCE(lower(TRIM(escalated)) IN ('true','yes','1'), FALSE) AS is_escalated,
  COALESCE(lower(TRIM(sla_breached)) IN ('true','yes','1'), FALSE) AS is_sla_breached, {_ts('ticket_created_date')} AS created_at, {_ts('ticket_resolved_date')} AS resolved_at,
  {', '.join(_NO.format(t='VARCHAR', c=c) for c in ['answer', 'queue', 'software_version'] + [f'tag_{i}' for i in range(1, 9)])}
FROM bronze_support_tickets
UNION ALL BY NAME
SELECT md5('multi_' || COALESCE(subject, '') || '_' || COALESCE(body, '')) AS unified_ticket_pk, source_dataset, lower({blank('type')}) AS category,
  {_blanks(('subject', 'ticket_subject'), ('body', 'ticket_body'))}, {_lowered('priority', 'language', 'queue')}, 'resolved' AS ticket_status, FALSE AS is_escalated,
  FALSE AS is_sla_breached, {blank('answer')} AS answer, version AS software_version, {', '.join(f"{blank(f'tag_{i}')} AS tag_{i}" for i in range(1, 9))}
FROM bronze_multilang_tickets)
""")

cte("silver_tickets", f"""
SELECT * REPLACE (CASE WHEN ticket_status = 'closed' AND closed_at IS NOT NULL AND created_at IS NOT NULL
    THEN date_sub('hour', created_at, closed_at)::DOUBLE ELSE resolution_time_hours END AS resolution_time_hours),
  ticket_status = 'closed' AS is_closed, {codes('priority', R.LEVEL_ORDINAL, 1)} AS priority_score,
  CASE WHEN issue_complexity_score >= 7 THEN 'complex' WHEN issue_complexity_score >= 4 THEN 'moderate'
    WHEN issue_complexity_score IS NOT NULL THEN 'simple' ELSE 'unknown' END AS complexity_level
FROM (
SELECT md5('GLPI_' || ticket_pk) AS event_pk, 'GLPI' AS source_system, CAST(ticket_id AS VARCHAR) AS source_id, source_year, created_at, solved_at, closed_at,
  priority_tier AS priority, {codes('status', R.DESK_STATUS, 'unknown')} AS ticket_status, CAST(resolution_time_hours AS DOUBLE) AS resolution_time_hours,
  FALSE AS is_escalated, FALSE AS is_sla_breached, CAST(NULL AS VARCHAR) AS language, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS category,
  CAST(NULL AS VARCHAR) AS ticket_subject, CAST(NULL AS VARCHAR) AS ticket_body, waiting_duration, CAST(NULL AS DOUBLE) AS first_response_time_hours,
  CAST(NULL AS DOUBLE) AS customer_satisfaction_score, CAST(NULL AS DOUBLE) AS issue_complexity_score, CAST(NULL AS INT) AS customer_tenure_months,
  CAST(NULL AS INT) AS previous_tickets FROM stg_tickets WHERE NOT is_deleted
UNION ALL
SELECT md5('KAGGLE_' || unified_ticket_pk), source_dataset, COALESCE(ticket_id, '0'), NULL, created_at, NULL, resolved_at,
  {codes('lower(priority)', R.EXTERNAL_PRIORITY, 'unknown')},
  CASE WHEN ticket_status IN ('closed','resolved','open','escalated') THEN ticket_status WHEN ticket_status LIKE '%progress%' THEN 'in_progress' ELSE 'unknown' END,
  resolution_time_hours, is_escalated, is_sla_breached, language, region, category, ticket_subject, ticket_body, NULL, first_response_time_hours,
  customer_satisfaction_score, issue_complexity_score, customer_tenure_months, previous_tickets FROM stg_external)
""")
_AGE = "CASE WHEN ticket_age_hours > 72 THEN 3 WHEN ticket_age_hours > 24 THEN 1 ELSE 0 END"
_PREV = "CASE WHEN previous_tickets > 5 THEN 5 WHEN previous_tickets > 2 THEN 3 ELSE 1 END"
_SAT = "CASE WHEN satisfaction_score < 3 THEN 3 WHEN satisfaction_score < 5 THEN 1 ELSE 0 END"
cte("silver_triage", f"""
SELECT *, {tier('ticket_age_hours', R.AGE_SEVERITY_CUTS, 'unknown')} AS age_severity, {tier('previous_tickets', R.CUSTOMER_TYPE_CUTS, 'new')} AS customer_type,
  {tier('sla_risk_score', R.TRIAGE_CUTS, 'low')} AS triage_priority, {tier('escalation_probability', R.ESCALATION_CUTS, 'low')} AS escalation_risk_level
FROM (SELECT *,
  {rnd(f'priority_score * 0.35::DOUBLE + complexity_score * 0.20::DOUBLE + {_AGE} * 0.15::DOUBLE + {_PREV} * 0.15::DOUBLE + {_SAT} * 0.15::DOUBLE', 2)} AS sla_risk_score,
  round(least(priority_score * 0.25::DOUBLE + was_escalated * 3 * 0.25::DOUBLE + CASE WHEN ticket_age_hours > 48 THEN 3 ELSE 0 END * 0.20::DOUBLE
    + complexity_score * 0.20::DOUBLE + CASE WHEN satisfaction_score < 3 THEN 2 ELSE 0 END * 0.10::DOUBLE, 10), 2) AS escalation_probability
FROM (SELECT event_pk AS ticket_fk, source_system, source_id, created_at, closed_at, date_sub('hour', created_at, COALESCE(closed_at, {NOW})) AS ticket_age_hours,
  COALESCE(resolution_time_hours, 0) AS resolution_time_hours, priority_score, CAST(is_escalated AS INT) AS was_escalated, CAST(is_sla_breached AS INT) AS was_sla_breached,
  COALESCE(customer_satisfaction_score, 0) AS satisfaction_score, COALESCE(issue_complexity_score, 0) AS complexity_score,
  COALESCE(customer_tenure_months, 0) AS tenure_months, COALESCE(previous_tickets, 0) AS previous_tickets FROM silver_tickets))
""")
cte("silver_security", f"""
SELECT * EXCLUDE (updated_at), COALESCE(updated_at, event_date) AS last_updated, {codes('severity_level', R.LEVEL_ORDINAL, 1)} AS severity_score FROM (
SELECT md5('CVE_' || cve_pk) AS security_event_pk, 'CVE' AS event_type, published_at AS event_date, modified_at AS updated_at, severity_level,
  cve_summary AS event_description, cwe_code, cwe_name, cvss_score, is_remote_exploitable, is_critical, easy_to_exploit, access_vector, access_complexity,
  access_authentication, impact_confidentiality, impact_integrity, impact_availability, CAST(NULL AS VARCHAR) AS machine_name,
  CAST(NULL AS VARCHAR) AS event_source, CAST(NULL AS VARCHAR) AS country FROM stg_cve
UNION ALL BY NAME
SELECT md5('WINLOG_' || eventlog_pk) AS security_event_pk, 'WINDOWS_EVENT' AS event_type, generated_at AS event_date, severity_level,
  COALESCE(event_message, event_source || ': ' || event_category) AS event_description, FALSE AS is_remote_exploitable,
  severity_level IN ('critical','high') AS is_critical, FALSE AS easy_to_exploit, machine_name, event_source, country FROM stg_eventlog
UNION ALL BY NAME
SELECT md5('TICKET_SEC_' || ticket_pk) AS security_event_pk, 'TICKET' AS event_type, created_at AS event_date, closed_at AS updated_at, priority_tier AS severity_level,
  FALSE AS is_remote_exploitable, TRUE AS is_critical, FALSE AS easy_to_exploit, 'GLPI' AS event_source FROM stg_tickets WHERE priority_tier IN ('critical','high'))
""")
cte("silver_assets", f"""
SELECT * EXCLUDE (rn) FROM (
SELECT o.hardware_pk AS asset_pk, COALESCE(o.normalized_hostname, 'unknown-' || CAST(o.hardware_id AS VARCHAR)) AS asset_name, 'ocs_glpi' AS source_domain,
  b.system_manufacturer, b.system_model, b.serial_number, b.device_type, o.uuid, o.source_year, o.last_inventory_date, o.last_seen_date,
  COALESCE(date_sub('year', i.buy_date, DATE '2024-02-01'), b.bios_age_years, 0) AS asset_age_years,
  {codes('b.bios_risk_level', R.RISK_ORDINAL, None)} AS bios_risk_encoded, COALESCE(d.drive_health_encoded, 0) AS drive_health_encoded,
  COALESCE(d.storage_capacity_gb, 0) AS storage_capacity_gb, COALESCE(d.drive_count, 0) AS drive_count, COALESCE(o.memory_gb, 0) AS memory_gb,
  COALESCE(o.cpu_cores, 0) AS cpu_cores, COALESCE(sw.risky, 0) AS high_risk_software_count, COALESCE(sw.risk_ratio, 0) AS risk_software_ratio,
  COALESCE(sw.n, 0) AS software_installed_count, COALESCE(ic.n, 0) AS incident_count, COALESCE(hi.n, 0) AS hardware_incident_count,
  COALESCE(date_sub('day', o.last_seen_date, {NOW}), date_sub('day', o.last_inventory_date, {NOW}), -1) AS days_since_last_inventory,
  COALESCE(i.has_warranty, FALSE) AS has_warranty, CASE WHEN hi.n >= 2 OR hi.crit >= 1 THEN 1 ELSE 0 END AS glpi_failure_proxy,
  ROW_NUMBER() OVER (PARTITION BY COALESCE(o.uuid, COALESCE(o.normalized_hostname, 'unknown-' || CAST(o.hardware_id AS VARCHAR)))
    ORDER BY o.last_inventory_date DESC NULLS LAST, o.hardware_pk, g.computer_id NULLS LAST) AS rn
FROM stg_hardware o
LEFT JOIN stg_bios b ON o.source_year = b.source_year AND o.hardware_id = b.hardware_id
LEFT JOIN (SELECT * FROM stg_computers WHERE NOT is_template AND NOT is_deleted) g
  ON lower(o.uuid) = lower(g.computer_uuid) OR (lower(COALESCE(o.normalized_hostname, 'unknown-' || CAST(o.hardware_id AS VARCHAR))) = lower(g.computer_name) AND o.source_year = g.source_year)
LEFT JOIN (SELECT * FROM stg_infocoms WHERE item_type = 'Computer') i ON g.computer_id = i.item_id
LEFT JOIN (SELECT items_id, COUNT(DISTINCT ticket_id) AS n, COUNT(DISTINCT CASE WHEN priority >= 4 THEN ticket_id END) AS crit
  FROM stg_tickets WHERE is_incident AND item_type = 'Computer' AND items_id IS NOT NULL GROUP BY items_id) hi ON g.computer_id = hi.items_id
LEFT JOIN (SELECT items_id, COUNT(DISTINCT ticket_id) AS n FROM stg_tickets WHERE item_type = 'Computer' AND items_id IS NOT NULL GROUP BY items_id) ic ON g.computer_id = ic.items_id
LEFT JOIN (SELECT source_year, hardware_id, COUNT(DISTINCT drive_pk) AS drive_count, round(SUM(COALESCE(total_size_gb, 0)), 2) AS storage_capacity_gb,
  MAX({codes('storage_health', R.DRIVE_HEALTH_ORDINAL, None)}) AS drive_health_encoded FROM stg_drives WHERE drive_type = 'fixed' GROUP BY ALL) d
  ON o.source_year = d.source_year AND o.hardware_id = d.hardware_id
LEFT JOIN (SELECT source_year, hardware_id, COUNT(*) AS n, COUNT(*) FILTER (software_risk_level IN ('critical','high')) AS risky,
  {rnd("COUNT(*) FILTER (software_risk_level IN ('critical','high')) / COUNT(*)::DOUBLE", 4)} AS risk_ratio FROM stg_software GROUP BY ALL) sw
  ON o.source_year = sw.source_year AND o.hardware_id = sw.hardware_id)
WHERE rn = 1
""")
cte("tmp_accounts", """
SELECT * FROM (SELECT *, COALESCE(user_name, 'user-' || CAST(user_id AS VARCHAR)) AS username, COALESCE(full_name, user_name) AS display_name,
  ROW_NUMBER() OVER (PARTITION BY lower(COALESCE(user_name, '')) ORDER BY user_id) AS rn FROM stg_users) WHERE rn = 1
""")
cte("tmp_activity", """
SELECT md5('TICKET|' || ticket_followup_pk || '|' || CAST(user_id AS VARCHAR)) AS activity_pk, user_id, created_at AS activity_date, 'ticket_followup' AS activity_type,
  ticket_id AS entity_id, 'ticket' AS entity_type, CASE WHEN is_private THEN 'private' ELSE 'public' END AS visibility, has_meaningful_content, contains_url,
  CAST(NULL AS VARCHAR) AS details FROM stg_followups WHERE user_id IS NOT NULL
UNION ALL
SELECT md5('LOG|' || unique_id || '|' || CAST(u.user_id AS VARCHAR)), u.user_id, updated_at, 'entity_' || change_type, entity_id, entity_type, NULL, NULL, NULL,
  COALESCE(linked_action, '') || ': ' || COALESCE(old_value, '') || ' -> ' || COALESCE(new_value, '')
FROM stg_logs l JOIN tmp_accounts u ON lower(COALESCE(l.user_name, '')) = lower(COALESCE(u.user_name, '')) WHERE has_user AND has_change
UNION ALL
SELECT md5('OCS|' || hardware_pk || '|' || CAST(u.user_id AS VARCHAR) || '|' || CAST(last_seen_date AS VARCHAR)), u.user_id, last_seen_date, 'inventory_seen', hardware_id, 'computer',
  NULL, NULL, NULL, 'hostname: ' || COALESCE(hostname, 'unknown') || ' | os: ' || COALESCE(os_family, 'unknown')
FROM stg_hardware h JOIN tmp_accounts u ON lower(COALESCE(h.logged_user, '')) = lower(COALESCE(u.user_name, '')) WHERE has_logged_user AND last_seen_date IS NOT NULL
""")
cte("silver_activity", """
SELECT * EXCLUDE (rn) FROM (SELECT activity_pk, a.user_id, username, display_name, user_type, is_ldap_user, suspicious_account AS is_suspicious_user, activity_date,
  activity_type, CASE WHEN regexp_matches(activity_type, 'created|deleted|updated') THEN 'write' ELSE 'read' END AS activity_category, entity_id, entity_type, visibility,
  CASE WHEN suspicious_account OR user_type IN ('SYSTEM','TEST') OR (contains_url AND NOT has_meaningful_content) THEN TRUE ELSE FALSE END AS is_suspicious_activity, details,
  ROW_NUMBER() OVER (PARTITION BY activity_pk ORDER BY activity_date DESC NULLS LAST) AS rn FROM tmp_activity a JOIN tmp_accounts u ON u.user_id = a.user_id) WHERE rn = 1
""")
_SCORE = lambda c: f"CASE {c}_tier WHEN 'critical' THEN 5 WHEN 'high' THEN 4 WHEN 'medium' THEN 3 WHEN 'low' THEN 2 ELSE 1 END AS {c}_score"
cte("gold_sla", f"""
SELECT md5('GLPI_' || ticket_pk) AS sla_feature_pk, ticket_pk AS source_ticket_pk, 'GLPI' AS source_system, CAST(t.ticket_id AS VARCHAR) AS ticket_id, created_at, closed_at,
  {_SCORE('priority')}, {_SCORE('urgency')}, {_SCORE('impact')}, date_sub('hour', created_at, COALESCE(closed_at, {NOW})) AS ticket_age_hours,
  CAST(resolution_time_hours AS DOUBLE) AS resolution_time_hours, waiting_duration, takeintoaccount_delay_stat AS takeintoaccount_delay,
  COALESCE(f.n, 0) AS followup_count, COALESCE(f.pr, 0) AS private_followup_ratio, COALESCE(f.len, 0) AS avg_followup_content_length,
  CAST(NULL AS DOUBLE) AS issue_complexity_score, CAST(NULL AS INT) AS customer_tenure_months, CAST(NULL AS INT) AS previous_tickets, 0 AS is_escalated,
  CASE WHEN close_delay_stat > 0 THEN 1 ELSE 0 END AS was_sla_breached
FROM stg_tickets t LEFT JOIN (SELECT ticket_id, COUNT(*) AS n, {rnd('AVG(content_length)', 2)} AS len,
  {rnd('COUNT(*) FILTER (is_private) / COUNT(*)::DOUBLE', 4)} AS pr FROM stg_followups GROUP BY ticket_id) f ON f.ticket_id = t.ticket_id WHERE NOT is_deleted
UNION ALL
SELECT md5('KAGGLE_' || unified_ticket_pk), unified_ticket_pk, source_dataset, COALESCE(ticket_id, '0'), created_at, resolved_at,
  CASE lower(priority) WHEN 'critical' THEN 5 WHEN 'urgent' THEN 5 WHEN 'high' THEN 4 WHEN 'medium' THEN 3 WHEN 'low' THEN 2 ELSE 1 END, NULL, NULL,
  date_sub('hour', COALESCE(created_at, {NOW}), COALESCE(resolved_at, {NOW})), resolution_time_hours, NULL, NULL, 0, 0, 0,
  issue_complexity_score, customer_tenure_months, previous_tickets, CAST(is_escalated AS INT), CAST(is_sla_breached AS INT) FROM stg_external
""")
_GRADES = " + ".join("CASE " + " ".join(f"WHEN {c} {op} {v} THEN {g}" for op, v, g in cuts) + " ELSE 1 END" for c, cuts in R.RISK_COMPONENTS)
cte("gold_risk", f"""
SELECT * EXCLUDE (uuid, last_inventory_date, last_seen_date, serial_number),
  CASE WHEN glpi_failure_proxy = 1 OR incident_count >= 5 OR rule_based_risk_score >= 18 THEN 'high' WHEN rule_based_risk_score >= 13 THEN 'medium'
    WHEN rule_based_risk_score >= 9 THEN 'low' ELSE 'info' END AS risk_tier,
  concat_ws('; ', CASE WHEN asset_age_years >= 10 THEN 'old_asset:' || asset_age_years || 'yrs' END,
    CASE WHEN drive_health_encoded >= 3 THEN 'drive_health_critical' WHEN drive_health_encoded = 2 THEN 'drive_health_degraded' END,
    CASE WHEN high_risk_software_count > 2 THEN 'risky_software:' || high_risk_software_count END, CASE WHEN bios_risk_encoded >= 3 THEN 'bios_outdated' END,
    CASE WHEN days_since_last_inventory >= 180 THEN 'stale_inventory:' || days_since_last_inventory || 'days' END,
    CASE WHEN glpi_failure_proxy = 1 THEN 'hardware_failure_evidence' END,
    CASE WHEN hardware_incident_count >= 3 THEN 'repeat_hw_incidents:' || hardware_incident_count WHEN hardware_incident_count >= 1 THEN 'hw_incidents:' || hardware_incident_count END) AS risk_explanation,
  CAST(NULL AS DOUBLE) AS anomaly_score, CAST(NULL AS BIGINT) AS is_anomaly
FROM (SELECT *, {_GRADES} AS rule_based_risk_score FROM silver_assets)
""")
cte("gold_anomalies", f"""
SELECT u.user_pk, u.user_id, u.user_name, u.user_type, CASE u.user_type WHEN 'HUMAN' THEN 0 WHEN 'SERVICE' THEN 1 WHEN 'SYSTEM' THEN 2 WHEN 'TEST' THEN 3 ELSE 4 END AS user_type_encoded,
  CAST(is_ldap_user AS INT) AS is_ldap_user, CAST(suspicious_account AS INT) AS is_suspicious_user,
  COALESCE(f.n, 0) + COALESCE(l.n, 0) + COALESCE(o.n, 0) AS total_activity_count, COALESCE(f.n, 0) AS followup_count, COALESCE(l.n, 0) AS log_action_count,
  COALESCE(o.n, 0) AS ocs_inventory_count, COALESCE({rnd('f.priv / f.n::DOUBLE', 4)}, 0) AS private_followup_ratio, COALESCE({rnd('f.susp / f.n::DOUBLE', 4)}, 0) AS url_content_ratio,
  {rnd('COALESCE(f.len, 0)', 2)} AS avg_followup_length, COALESCE(l.ents, 0) AS unique_entities_touched, COALESCE(l.types, 0) AS unique_entity_types,
  COALESCE({rnd('l.wr / l.n::DOUBLE', 4)}, 0) AS write_action_ratio,
  greatest(COALESCE(f.days, 0), COALESCE(f.span, 0), date_diff('day', COALESCE(CAST(l.last AS DATE), DATE '2024-02-01'), DATE '2024-02-01')) AS distinct_days_active,
  greatest(COALESCE(f.span, 0), date_diff('day', COALESCE(CAST(o.last AS DATE), DATE '2024-02-01'), DATE '2024-02-01')) AS activity_span_days,
  CAST(round(CAST(CASE WHEN greatest(COALESCE(f.span, 0), date_diff('day', COALESCE(CAST(o.last AS DATE), DATE '2024-02-01'), DATE '2024-02-01')) > 0
    THEN (COALESCE(f.n, 0) + COALESCE(l.n, 0) + COALESCE(o.n, 0)) / greatest(COALESCE(f.span, 0), date_diff('day', COALESCE(CAST(o.last AS DATE), DATE '2024-02-01'), DATE '2024-02-01'))::DOUBLE
    ELSE COALESCE(f.n, 0) + COALESCE(l.n, 0) + COALESCE(o.n, 0) END AS DECIMAL(18,6)), 4) AS DOUBLE) AS activity_density,
  CAST(COALESCE(f.n > 0, FALSE) AS INT) + CAST(COALESCE(l.n > 0, FALSE) AS INT) + CAST(COALESCE(o.n > 0, FALSE) AS INT) AS active_data_sources,
  CAST(NULL AS DOUBLE) AS isolation_forest_score, CAST(NULL AS DOUBLE) AS lof_score, CAST(NULL AS INT) AS is_anomaly_if, CAST(NULL AS INT) AS is_anomaly_lof
FROM (SELECT * REPLACE (COALESCE(user_name, 'user-' || CAST(user_id AS VARCHAR)) AS user_name) FROM stg_users) u
LEFT JOIN (SELECT user_id, COUNT(*) AS n, COUNT(*) FILTER (is_private) AS priv, AVG(content_length) AS len, COUNT(*) FILTER (contains_url AND NOT has_meaningful_content) AS susp,
  COUNT(DISTINCT CAST(created_at AS DATE)) AS days, date_diff('day', CAST(MIN(created_at) AS DATE), CAST(MAX(created_at) AS DATE)) AS span
  FROM stg_followups WHERE user_id IS NOT NULL GROUP BY user_id) f ON f.user_id = u.user_id
LEFT JOIN (SELECT lower(TRIM(user_name)) AS k, COUNT(*) AS n, COUNT(*) FILTER (change_type IN ('created','updated','deleted')) AS wr, COUNT(DISTINCT entity_id) AS ents,
  COUNT(DISTINCT entity_type) AS types, MAX(updated_at) AS last FROM stg_logs WHERE has_user AND has_change GROUP BY 1) l ON l.k = lower(TRIM(u.user_name))
LEFT JOIN (SELECT lower(TRIM(logged_user)) AS k, COUNT(*) AS n, MAX(last_seen_date) AS last FROM stg_hardware WHERE has_logged_user GROUP BY 1) o ON o.k = lower(TRIM(u.user_name))
""")
_TOK = lambda c, p: f"CASE {c}_tier WHEN 'critical' THEN '{p}_critical' WHEN 'high' THEN '{p}_high' WHEN 'medium' THEN '{p}_medium' WHEN 'low' THEN '{p}_low' ELSE '{p}_unknown' END"
cte("tmp_tokens", f"""
SELECT ticket_pk, ticket_id, created_at, closed_at, concat_ws(' ', {_TOK('priority', 'prio')}, {_TOK('urgency', 'urg')}, {_TOK('impact', 'impact')},
  CASE WHEN status IN (5, 6) THEN 'ticket_closed' WHEN status = 4 THEN 'ticket_pending' WHEN status = 3 THEN 'ticket_in_progress' WHEN status = 2 THEN 'ticket_assigned'
    WHEN status = 1 THEN 'ticket_new' ELSE 'ticket_unknown_status' END,
  CASE WHEN status IN (5, 6) AND COALESCE(close_delay_stat, 0) > 0 THEN 'sla_breached' WHEN status IN (5, 6) THEN 'sla_met' END,
  CASE WHEN solve_delay_stat > 0 THEN 'resolution_overdue' END,
  CASE WHEN resolution_time_hours > 168 THEN 'very_long_resolution' WHEN resolution_time_hours > 72 THEN 'long_resolution' WHEN resolution_time_hours > 24 THEN 'moderate_resolution'
    WHEN resolution_time_hours > 0 THEN 'fast_resolution' ELSE 'unresolved_ticket' END,
  CASE WHEN waiting_duration > 86400 THEN 'long_waiting_time' WHEN waiting_duration > 3600 THEN 'moderate_waiting_time' END) AS tokens
FROM stg_tickets WHERE NOT is_deleted
""")
cte("tmp_behaviour", f"""
SELECT ticket_id, n, {rnd('priv / n::DOUBLE', 4)} AS private_ratio, {rnd('len', 2)} AS len, {rnd('url / n::DOUBLE', 4)} AS url_ratio, {rnd('good / n::DOUBLE', 4)} AS good_ratio,
  concat_ws(' ', CASE WHEN n > 10 THEN 'multiple_followups' END, CASE WHEN priv / n::DOUBLE > 0.5 THEN 'private_heavy_ticket' END, CASE WHEN len > 500 THEN 'detailed_interactions' END,
    CASE WHEN url / n::DOUBLE > 0.3 THEN 'url_heavy_activity' END, CASE WHEN good / n::DOUBLE < 0.3 THEN 'low_information_ticket' END) AS behaviour
FROM (SELECT ticket_id, COUNT(*) AS n, COUNT(*) FILTER (is_private) AS priv, AVG(content_length) AS len, COUNT(*) FILTER (contains_url) AS url,
  COUNT(*) FILTER (has_meaningful_content) AS good FROM stg_followups GROUP BY ticket_id)
""")
cte("tmp_infra", """
SELECT * FROM (SELECT bt.id AS ticket_id, bt.source_year, h.os_family, h.memory_gb, b.bios_risk_level, sw.risky,
  concat_ws(' ', CASE h.os_family WHEN 'Windows' THEN 'windows_environment' WHEN 'Linux' THEN 'linux_environment' WHEN 'MacOS' THEN 'mac_environment' END,
    CASE WHEN h.memory_tier = 'critical' THEN 'low_memory_device' END, CASE WHEN h.cpu_cores >= 8 THEN 'high_core_server' END,
    CASE WHEN b.bios_risk_level = 'critical' THEN 'critical_bios_risk' WHEN b.bios_age_years >= 10 THEN 'legacy_bios' END,
    CASE WHEN sw.risky > 0 THEN 'high_risk_software_present' END, CASE WHEN sw.n > 20 THEN 'multiple_software_components' END) AS infra,
  ROW_NUMBER() OVER (PARTITION BY bt.id ORDER BY CASE WHEN c.computer_uuid <> 'unknown' THEN 0 ELSE 1 END, h.last_seen_date DESC NULLS LAST, h.hardware_pk NULLS LAST) AS rn
FROM bronze_glpi_tickets bt LEFT JOIN stg_computers c ON bt.items_id = c.computer_id
LEFT JOIN stg_hardware h ON (c.computer_uuid <> 'unknown' AND lower(c.computer_uuid) = lower(h.uuid)) OR (lower(c.computer_name) = h.normalized_hostname AND c.source_year = h.source_year)
LEFT JOIN stg_bios b ON b.hardware_id = h.hardware_id AND b.source_year = h.source_year
LEFT JOIN (SELECT hardware_id, source_year, COUNT(*) AS n, COUNT(*) FILTER (software_risk_level IN ('critical','high')) AS risky FROM stg_software GROUP BY ALL) sw
  ON sw.hardware_id = h.hardware_id AND sw.source_year = h.source_year) WHERE rn = 1
""")
_LV = lambda p: f"CASE WHEN tokens LIKE '%{p}_critical%' THEN 5 WHEN tokens LIKE '%{p}_high%' THEN 4 WHEN tokens LIKE '%{p}_medium%' THEN 3 WHEN tokens LIKE '%{p}_low%' THEN 2 ELSE 1 END"
cte("gold_similarity", f"""
SELECT md5('GLPI_SIM_' || ticket_pk) AS similarity_pk, ticket_pk, 'GLPI' AS source_system, CAST(t.ticket_id AS VARCHAR) AS ticket_id, created_at, closed_at,
  CAST(NULL AS VARCHAR) AS text_corpus, tokens || ' ' || COALESCE(behaviour, '') || ' ' || COALESCE(infra, '') AS synthetic_text_corpus, 'synthetic_context' AS similarity_method,
  'structured_metadata' AS embedding_strategy, 'synthetic_context' AS text_source_type, CAST(NULL AS VARCHAR) AS embedding_model,
  {_LV('prio')} AS priority_encoded, {_LV('urg')} AS urgency_encoded, {_LV('impact')} AS impact_encoded,
  CASE WHEN COALESCE(f.n, 0) = 0 THEN 1 WHEN f.n <= 3 THEN 2 WHEN f.n <= 10 THEN 3 WHEN f.n <= 30 THEN 4 ELSE 5 END AS followup_count_bucket,
  CASE WHEN infra <> '' THEN 0.70 WHEN behaviour <> '' THEN 0.50 ELSE 0.30 END::DOUBLE AS corpus_quality_score,
  CASE WHEN infra <> '' THEN 0.65 WHEN behaviour <> '' THEN 0.45 ELSE 0.25 END::DOUBLE AS similarity_confidence, COALESCE(f.n, 0) AS followup_count,
  COALESCE(f.len, 0) AS avg_followup_content_length, COALESCE(f.private_ratio, 0) AS private_followup_ratio, COALESCE(f.url_ratio, 0) AS url_content_ratio,
  COALESCE(f.good_ratio, 0) AS meaningful_content_ratio, CAST(os_family IS NOT NULL AS INT) AS has_os_context, CAST(memory_gb IS NOT NULL AS INT) AS has_hardware_context,
  CAST(bios_risk_level IS NOT NULL AS INT) AS has_bios_context, CAST(COALESCE(risky, 0) > 0 AS INT) AS has_software_context,
  CAST(NULL AS VARCHAR) AS similar_ticket_ids, CAST(NULL AS VARCHAR) AS similarity_scores
FROM tmp_tokens t LEFT JOIN tmp_behaviour f ON f.ticket_id = t.ticket_id
LEFT JOIN tmp_infra i ON i.ticket_id = t.ticket_id AND year(t.created_at) IS NOT DISTINCT FROM i.source_year
UNION ALL
SELECT md5('KAGGLE_SIM_' || unified_ticket_pk), unified_ticket_pk, source_dataset, COALESCE(ticket_id, '0'), created_at, resolved_at,
  COALESCE({blank('ticket_subject')}, '') || ' ' || COALESCE({blank('ticket_body')}, ''), NULL, 'nlp_embedding', 'nlp_semantic', 'real_text', '{R.EMBEDDING_MODEL}',
  NULL, NULL, NULL, NULL, 1.0, 0.9, 0, 0, 0, 0, 0, 0, 0, 0, 0, NULL, NULL FROM stg_external
""")

_MODELS = [
    ("dm1_computers", "stg_computers"), ("dm2_graphic_cards", "stg_gpus"), ("dm3_device_memories", "stg_ram"),
    ("dm4_processors", "stg_processors"), ("dm5_infocoms", "stg_infocoms"), ("dm6_categories", "stg_categories"),
    ("dm7_logs", "stg_logs"), ("dm8_followups", "stg_followups"), ("dm9_tickets", "stg_tickets"), ("dm10_users", "stg_users"),
    ("dm11_bios", "stg_bios"), ("dm12_drives", "stg_drives"), ("dm13_hardware", "stg_hardware"), ("dm14_memories", "stg_memories"),
    ("dm15_networks", "stg_networks"), ("dm16_software", "stg_software"), ("dm17_storages", "stg_storages"), ("dm18_cve", "stg_cve"),
    ("dm19_harddrive", "stg_harddrive"), ("dm20_external_tickets", "stg_external"), ("dm21_laptops", "stg_laptops"),
    ("dm22_eventlog", "stg_eventlog"), ("dm23_silver_tickets", "silver_tickets"), ("dm24_silver_assets", "silver_assets"),
    ("dm25_silver_security", "silver_security"), ("dm26_silver_triage", "silver_triage"), ("dm27_silver_activity", "silver_activity"),
    ("dm28_gold_sla", "gold_sla"), ("dm29_gold_risk", "gold_risk"), ("dm30_gold_anomalies", "gold_anomalies"),
    ("dm31_gold_similarity", "gold_similarity"),
]
for _name, _model in _MODELS:
    query(_name, f"SELECT * FROM {_model}")(lambda t, m=_model: getattr(Warehouse(t), m))
