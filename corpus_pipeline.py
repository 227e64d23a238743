"""The corpus pipeline: five stages over `documents`, each one of the operators of `ticketlake.llm`.

A stage takes (spark, docs, sf_dir) and works on all that the one before kept. What it returns is written as Parquet and
read again as the next one's documents. All but the last return the columns of `documents`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm.common import by_key, table, written
from ticketlake.llm.decontamination import matches, report
from ticketlake.llm.line_dedup import drop_repeated_lines
from ticketlake.llm.near_duplicates import near_duplicates
from ticketlake.llm.queries import tokenizer_file
from ticketlake.llm.sentencepiece_codec import round_trip
from ticketlake.llm.toxicity import fit, tag


#: Percent of the union that the shingle sets of near-duplicates share, and values in a band of the signature for it.
SIMILAR, BAND_ROWS = 80, 5


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`docs` under names that clash with nothing an operator adds, and the new name of each column."""
    names = {c: c if c in ("doc_id", "text") else f"column {k}" for k, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def _restored(rows: DataFrame, names: dict[str, str], **new) -> DataFrame:
    return rows.select(*(new.get(c, F.col(f"`{n}`")).alias(c) for c, n in names.items()))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id is not in `rejected`; rows without doc_id stay."""
    rows, names = _renamed(docs)
    gone = rejected.select(F.col("doc_id").alias("gone")).distinct()
    return _restored(rows.join(by_key(gone), F.col("doc_id") == F.col("gone"), "left_anti"), names)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger rejects go.

    A null text is scored as an empty one. Repeated rows and copies are judged alike; further columns stay as they are.
    """
    rows, names = _renamed(docs)
    return _restored(tag(rows, fit(rows, table(spark, sf_dir, "labels"))).filter("predicted = 0"), names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of fifty words or more are cut; documents of which nothing is left go.

    The copy in the smallest doc_id stays. Repeated rows are one document and are cut alike; null texts and rows without
    doc_id lose nothing. `n_chars` follows a text that was cut; further columns stay as they are.
    """
    rows, names = _renamed(docs)
    removed = F.col("n_removed") > 0
    emptied = removed & (F.trim(F.translate("text", "\n\r\t", "   ")) == "")
    size = F.when(removed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(f"`{names['n_chars']}`"))
    return _restored(drop_repeated_lines(rows).filter(~F.coalesce(emptied, F.lit(False))), names, n_chars=size)


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more) stays: the smallest doc_id.

    Repeated rows are one document, and all of them stay or go. Documents without words, null texts and rows without doc_id
    are linked with nothing and stay.
    """
    return _without(docs, near_duplicates(docs, SIMILAR, BAND_ROWS).filter("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go.

    Null texts have no words and stay, and so do rows without doc_id; repeated rows stay or go together.
    """
    return _without(docs, report(matches(docs, table(spark, sf_dir, "benchmark"))).filter("contaminated"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    coded = round_trip(docs.select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))
    return coded.select("doc_id", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"), "piece_ids", "exact")


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: A trained tagger decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
