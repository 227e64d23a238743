"""Registered queries against their oracles at the smallest scale, and package rules."""
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from ticketlake.sources.tables import NAMES
from tools.check import compare

FAST = [
    "dm1_computers", "dm8_followups", "dm9_tickets", "dm11_bios", "dm13_hardware", "dm20_external_tickets", "dm24_silver_assets",
    "dm27_silver_activity", "dm28_gold_sla", "dm30_gold_anomalies", "dm31_gold_similarity", "j5_match_any", "a10_group_contrast",
    "tx2_clean_text", "tx19_chunk_rows", "bm2_bm25_topk", "rf2_hybrid_search", "kn1_dense_topk", "ev2_mrr", "cx1_context_packing",
    "qa9_feature_validation", "pr5_describe", "ml3_stratified_split", "ml6_summary_metrics", "src2_src3_ingestion_report",
    "st1_incremental_ingest", "st2_rate_detector", "st2_rate_detector_stream",
]


@pytest.fixture(scope="module")
def oracle(folder):
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"create view {n} as select * from '{folder}/{n}.parquet'")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, folder, oracle, name):
    df = entry.queries()[name](spark, folder)
    cur = oracle.execute(entry.oracle_sql()[name])
    assert compare(df.collect(), df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).limit(5).count() == 5


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_local_checkpoints_or_row_udfs():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for base, _, files in os.walk(os.path.join(root, "ticketlake")):
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(base, f), encoding="utf8").read()
                assert not re.search(r"localCheckpoint|crossJoin|F\.udf\(", text), f
