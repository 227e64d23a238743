"""Named models over a folder of tables; every attribute is a lazy DataFrame."""
from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame

from ticketlake.plans import gold, silver, staging_desk, staging_external, staging_inventory
from ticketlake.session import AS_OF
from ticketlake.sources.tables import Tables

_STAGING = {
    "stg_tickets": (staging_desk.tickets, "glpi_tickets"),
    "stg_users": (staging_desk.users, "glpi_users"),
    "stg_followups": (staging_desk.followups, "glpi_ticketfollowups"),
    "stg_logs": (staging_desk.logs, "glpi_logs"),
    "stg_computers": (staging_desk.computers, "glpi_computers"),
    "stg_infocoms": (staging_desk.infocoms, "glpi_infocoms"),
    "stg_categories": (staging_desk.itil_categories, "glpi_itilcategories"),
    "stg_processors": (staging_desk.device_processors, "glpi_deviceprocessors"),
    "stg_ram": (staging_desk.device_memories, "glpi_devicememories"),
    "stg_gpus": (staging_desk.device_graphic_cards, "glpi_devicegraphiccards"),
    "stg_drives": (staging_inventory.drives, "ocs_drives"),
    "stg_hardware": (staging_inventory.hardware, "ocs_hardware"),
    "stg_memories": (staging_inventory.memories, "ocs_memories"),
    "stg_networks": (staging_inventory.networks, "ocs_networks"),
    "stg_software": (staging_inventory.software, "ocs_software"),
    "stg_storages": (staging_inventory.storages, "ocs_storages"),
    "stg_cve": (staging_external.cve, "cve_data"),
    "stg_harddrive": (staging_external.harddrive, "harddrive_data"),
    "stg_laptops": (staging_external.laptop_price, "laptop_price_data"),
    "stg_eventlog": (staging_external.windows_eventlog, "windows_eventlog_data"),
}


class Warehouse:
    def __init__(self, tables: Tables, as_of: datetime = AS_OF):
        self.t = tables
        self.as_of = as_of

    def __getattr__(self, name: str) -> DataFrame:
        if name not in _STAGING:
            raise AttributeError(name)
        fn, bronze = _STAGING[name]
        return fn(self.t.bronze(bronze))

    @cached_property
    def stg_bios(self) -> DataFrame:
        return staging_inventory.bios(self.t.bronze("ocs_bios"), self.as_of)

    @cached_property
    def stg_external(self) -> DataFrame:
        return staging_external.external_tickets(self.t.bronze("support_tickets"), self.t.bronze("multilang_tickets"))

    @cached_property
    def silver_tickets(self) -> DataFrame:
        return silver.tickets(self.stg_tickets, self.stg_external)

    @cached_property
    def silver_triage(self) -> DataFrame:
        return silver.triage_features(self.silver_tickets, self.as_of)

    @cached_property
    def silver_security(self) -> DataFrame:
        return silver.security_events(self.stg_cve, self.stg_eventlog, self.stg_tickets)

    @cached_property
    def silver_assets(self) -> DataFrame:
        return silver.assets(
            self.stg_hardware, self.stg_bios, self.stg_computers, self.stg_infocoms,
            self.stg_tickets, self.stg_drives, self.stg_software, self.as_of,
        )

    @cached_property
    def silver_activity(self) -> DataFrame:
        return silver.user_activity(self.stg_users, self.stg_followups, self.stg_logs, self.stg_hardware)

    @cached_property
    def gold_sla(self) -> DataFrame:
        return gold.sla_features(self.stg_tickets, self.stg_external, self.stg_followups, self.as_of)

    @cached_property
    def gold_risk(self) -> DataFrame:
        return gold.asset_failure_risk(self.silver_assets)

    @cached_property
    def gold_anomalies(self) -> DataFrame:
        return gold.user_activity_anomalies(
            self.stg_users, self.stg_followups, self.stg_logs, self.stg_hardware, self.as_of
        )

    @cached_property
    def gold_similarity(self) -> DataFrame:
        return gold.ticket_similarity(
            self.stg_tickets, self.stg_followups, self.t.bronze("glpi_tickets"), self.stg_computers,
            self.stg_hardware, self.stg_bios, self.stg_software, self.stg_external,
        )
