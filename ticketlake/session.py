"""Session helpers: defaults for tests/benches and the durable checkpoint folder."""
from __future__ import annotations

import os
import tempfile
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

#: Every model that depends on "now" takes ``as_of``; this is the default used by the registered queries.
AS_OF = datetime(2024, 2, 1)


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ticketlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Temporary folders of local sessions without the setting, by application.
_LOCAL: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only where the setting is absent (local tests) a temporary folder is used, one for each application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="ticketlake-")
    return _LOCAL[application]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(os.path.join(checkpoint_dir(spark), "lineage"))
    return df.checkpoint(eager=True)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the checkpoint folder, for plans that read it several times and are costly to repeat."""
    path = os.path.join(checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
