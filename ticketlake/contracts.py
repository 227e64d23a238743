"""Column contracts of every model: fixed values, and the rules that complete them.

A contract names a model's key, its required columns, the classes a column may hold, and what a row may not be.
"""
from __future__ import annotations

from dataclasses import dataclass, field

#: Inventory years and the source systems of the models that carry them.
YEARS = ("2013", "2014", "2015")
DESK, INVENTORY = "GLPI", "OCS"

#: Model, key, further ids, further required columns, and classes by column; a column with classes is required
#: too, unless it has a leading ?.
_MODELS = """
stg_computers | unique_id | computer_id computer_name | has_uuid is_template is_deleted is_ocs_import | ?computer_type: template, real_machine
stg_gpus | gpu_pk | gpu_id gpu_name | | gpu_brand: NVIDIA, Intel, AMD, Matrox, Other; gpu_type: integrated, dedicated, virtual; performance_tier: low, medium, high, unknown, virtual
stg_ram | memory_pk | memory_id | is_ecc has_frequency_data is_server_memory | memory_type: DDR5, DDR4, DDR3, DDR2, DDR, SDRAM, RDRAM, Other; memory_capacity_tier: enterprise, high, medium, low, legacy; performance_tier: high, medium, low, unknown
stg_processors | processor_pk | processor_id | has_frequency_data is_server_cpu | cpu_family: i9, i7, i5, i3, Xeon, Ryzen9, Ryzen7, Ryzen5, Ryzen3, Pentium, Atom, Core2Duo, Other; architecture: x64, x86, unknown; performance_tier: high, medium, low, unknown
stg_infocoms | infocom_pk | infocom_id item_id | has_warranty | asset_value_tier: critical, high, medium, low, unknown
stg_logs | unique_id | log_id | has_user has_change | change_type: created, deleted, updated, no_change
stg_followups | ticket_followup_pk | followup_id ticket_id | has_meaningful_content contains_url is_private content_length |
stg_tickets | ticket_pk | ticket_id | is_closed is_resolved is_waiting is_deleted is_incident | priority_tier: critical, high, medium, low, unknown; urgency_tier: critical, high, medium, low, unknown; impact_tier: critical, high, medium, low, unknown; ticket_type: incident, request, unknown
stg_users | user_pk | user_id | has_directory_account is_ldap_user has_personal_token has_username has_real_identity suspicious_account | user_type: SYSTEM, SERVICE, TEST, HUMAN, UNKNOWN
stg_categories | itil_category_pk | category_id | is_root_category is_visible_helpdesk has_valid_name | category_type: NETWORK, HARDWARE, SOFTWARE, SECURITY, PRINTER, MAIL, VPN, OTHER; category_complexity: high, medium, low, unknown
stg_bios | bios_pk | hardware_id | has_serial_number has_bios_version | device_type: desktop, laptop, server, other; manufacturer_group: HP, Dell, Lenovo, Foxconn, MSI, Other; bios_risk_level: critical, high, medium, low, unknown
stg_drives | drive_pk | drive_id hardware_id | is_large_drive | drive_type: fixed, removable, usb, network, cdrom, other; storage_health: critical, high, medium, healthy, unknown
stg_hardware | hardware_pk | hardware_id | has_valid_ipv4 has_windows_key has_uuid has_logged_user | os_family: Windows, Linux, MacOS, Other; memory_tier: high, medium, low, critical; inventory_quality_tier: excellent, good, medium, poor; architecture_family: 64bit, 32bit, unknown
stg_memories | memory_pk | memory_id hardware_id | has_serial_number has_capacity | memory_type: DDR5, DDR4, DDR3, DDR2, DDR, SDRAM, Other; performance_tier: high, medium, low, unknown; memory_size_tier: high, medium, low, unknown
stg_networks | network_pk | network_id hardware_id | has_valid_ipv4 uses_dhcp is_virtual_device has_mac_address | network_type: ethernet, wifi, bluetooth, loopback, vpn, other; speed_tier: high, medium, low, unknown; connection_status: active, inactive, unknown
stg_storages | storage_pk | storage_id hardware_id | has_serial_number has_firmware | manufacturer_group: Seagate, Western Digital, Samsung, Toshiba, Kingston, Intel, Other; storage_type: SSD, NVMe, HDD, SATA, SAS, Other; storage_size_tier: high, medium, low, unknown; performance_tier: ultra, high, medium, low, unknown
stg_software | software_pk | software_id hardware_id | has_guid has_version has_install_date | architecture: 64bit, 32bit, unknown; software_category: office, browser, security, database, development, virtualization, other; software_risk_level: critical, high, normal
stg_external | unified_ticket_pk | is_escalated is_sla_breached | | source_dataset: customer_support_tickets_200k, dataset_tickets_multi_lang; ?priority: low, medium, high, critical, urgent
stg_cve | cve_pk | | is_remote_exploitable is_critical easy_to_exploit | ?severity_level: critical, high, medium, low, unknown
stg_harddrive | harddrive_pk | | has_failed has_reallocated_sectors has_pending_sectors has_uncorrectable_sectors has_crc_errors | ?health_status: healthy, warning, critical, failed
stg_laptops | laptop_pk | | has_ips_panel has_touchscreen has_ssd has_hdd | ?cpu_family: i7, i5, i3, ryzen7, ryzen5, celeron, other; ?gpu_brand: NVIDIA, AMD, Intel, Other; ?price_segment: premium, mid_range, budget, unknown
stg_eventlog | eventlog_pk | suspicious_activity | is_error_event is_warning_event | ?severity_level: critical, warning, high, audit, informational; ?event_domain: security, system, application, network, other
silver_tickets | event_pk | source_id is_closed priority_score | | source_system: GLPI, customer_support_tickets_200k, dataset_tickets_multi_lang; priority: critical, high, medium, low, unknown; ticket_status: open, in_progress, resolved, closed, escalated, unknown; complexity_level: complex, moderate, simple, unknown
silver_assets | asset_pk | asset_name asset_age_years drive_health_encoded storage_capacity_gb drive_count high_risk_software_count risk_software_ratio software_installed_count incident_count days_since_last_inventory has_warranty | | source_domain: ocs_glpi, kaggle_harddrive; ?device_type: desktop, laptop, server, storage, other
silver_security | security_event_pk | event_type severity_level severity_score | |
silver_triage | ticket_fk | |  | triage_priority: critical, high, medium, low; escalation_risk_level: high, medium, low; customer_type: new, returning, repeat, frequent
silver_activity | activity_pk | user_id username activity_type is_suspicious_activity | | user_type: SYSTEM, SERVICE, TEST, HUMAN, UNKNOWN; activity_category: read, write
gold_sla | sla_feature_pk | source_ticket_pk ticket_id priority_score ticket_age_hours followup_count | | source_system: GLPI, customer_support_tickets_200k, dataset_tickets_multi_lang; was_sla_breached: 0, 1; ?is_escalated: 0, 1
gold_similarity | similarity_pk | ticket_pk corpus_quality_score | | source_system: GLPI, customer_support_tickets_200k, dataset_tickets_multi_lang; similarity_method: synthetic_context, nlp_embedding; embedding_strategy: structured_metadata, nlp_semantic; text_source_type: synthetic_context, real_text
gold_risk | asset_pk | asset_name asset_age_years drive_health_encoded storage_capacity_gb drive_count high_risk_software_count risk_software_ratio software_installed_count incident_count days_since_last_inventory has_warranty rule_based_risk_score | | source_domain: ocs_glpi; risk_tier: high, medium, low, info
gold_anomalies | user_pk | user_name user_type_encoded total_activity_count unique_entities_touched | | user_type: HUMAN, SERVICE, SYSTEM, TEST, UNKNOWN; ?is_ldap_user: 0, 1; ?is_suspicious_user: 0, 1
"""
#: What a row may not be besides, as a condition that fails it, by model and name of the rule.
_ROWS = {
    "stg_cve": {"row": "cvss_score < 0 OR cvss_score > 10"},
    "stg_harddrive": {"row": "capacity_gb < 0"},
    "stg_laptops": {"row": "price_euros < 0"},
    "silver_tickets": {
        "priority_consistency": "priority_score <> CASE priority WHEN 'critical' THEN 5 WHEN 'high' THEN 4 WHEN 'medium' THEN 3 WHEN 'low' THEN 2 WHEN 'unknown' THEN 1 END",
        "future_date": "created_at > {as_of} + INTERVAL 1 DAY",
    },
    "silver_assets": {
        "os_family_consistency": "source_domain = 'ocs_glpi' AND asset_age_years < 0",
        "risk_consistency": "source_domain = 'ocs_glpi' AND ((drive_health_encoded >= 3 AND bios_risk_encoded IS NULL) OR (bios_risk_encoded >= 3 AND drive_health_encoded = 0 AND asset_age_years < 2))",
    },
    "silver_security": {
        "severity_consistency": "severity_score <> CASE severity_level WHEN 'critical' THEN 5 WHEN 'high' THEN 4 WHEN 'medium' THEN 3 WHEN 'low' THEN 2 ELSE 1 END",
    },
    "silver_triage": {
        "escalation_range": "escalation_probability < 0 OR escalation_probability > 10",
        "sla_range": "sla_risk_score < 0 OR sla_risk_score > 10",
    },
    "silver_activity": {"valid_dates": "activity_date > {as_of}"},
}
#: Columns that the row rules of computers and tickets leave out.
_UNRULED = {"stg_computers": {"computer_type", "source_year", "source_system"}, "stg_tickets": {"ticket_type"}}
_FROM_DESK = {"computers", "gpus", "ram", "processors", "infocoms", "logs", "followups", "tickets", "users", "categories"}
_FROM_INVENTORY = {"bios", "drives", "hardware", "memories", "networks", "storages", "software"}


@dataclass
class Contract:
    model: str
    key: str
    required: list[str]
    accepted: dict[str, tuple[str, ...]]
    rows: dict[str, str] = field(default_factory=dict)  # name of the rule, condition of a failing row


def _parse(line: str) -> Contract:
    model, key, ids, others, classes = (x.strip() for x in line.split("|"))
    ids, others = [key, *ids.split()], others.split()
    required, accepted = ids + others, {}
    for part in filter(None, (x.strip() for x in classes.split(";"))):
        name, values = part.split(":")
        accepted[name.lstrip("?")] = tuple(v.strip() for v in values.split(","))
        required += [] if name.startswith("?") else [name]
    layer, short = model.split("_", 1)
    system = DESK if short in _FROM_DESK else INVENTORY if short in _FROM_INVENTORY else None
    rules = dict(_ROWS.get(model, {}))
    if layer == "stg":
        if system:
            accepted |= {"source_year": YEARS, "source_system": (system,)}
            required += ["source_year", "source_system"]
        # one rule for each staging model: its ids, its classes and what else is stated; tables from outside also have all their flags
        bad = [f"{c} IS NULL" for c in (ids if system else ids + others)]
        bad += [f"CAST({c} AS STRING) NOT IN ({', '.join(repr(v) for v in values)})" for c, values in accepted.items() if c not in _UNRULED.get(model, ())]
        rules = {"row": " OR ".join(bad + [f"({x})" for x in rules.values()])}
    return Contract(model, key, required, accepted, rules)


def contracts() -> list[Contract]:
    """Contracts of all models."""
    return [_parse(x) for x in _MODELS.strip().split("\n")]
