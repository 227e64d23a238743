"""Access to the tables."""
import os

from ticketlake.sources import tables


def test_partitions_of_a_text_table_follow_its_size(spark, folder, monkeypatch):
    size = os.path.getsize(f"{folder}/documents.parquet")
    monkeypatch.setattr(tables, "PART_BYTES", size // 40)
    documents = tables.Tables(spark, folder).documents
    assert documents.rdd.getNumPartitions() >= 40 and documents.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
