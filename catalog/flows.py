"""Ingestion, sink and streaming queries; files go to a fresh folder in the shared checkpoint folder."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.registry import query, rnd
from catalog.retrieval import Search
from catalog.texts import texts
from ticketlake.operators import learning as L, sparse as SP
from ticketlake.plans import corpus as C, ml_dataset
from ticketlake.plans.warehouse import Warehouse
from ticketlake.session import AS_OF, checkpoint_dir
from ticketlake.sources import ingest as I, sinks as K
from ticketlake.sources.keyed_table import KeyedTable
from ticketlake.streaming import incremental as INC, ratelimit as RL

YEARS = (2013, 2014, 2015)


def fresh(t, name):
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def _year_reader(t):
    """The yearly source databases: each year holds its part of the users and logs."""

    def read(table, year):
        if table == "broken":
            raise RuntimeError("table does not exist")
        df = t.bronze(table).filter(F.col("source_year") == year).drop("source_year", "source_system")
        return df if table != "glpi_logs" or year != 2015 else df.filter(F.lit(False))

    return read


@query("src1_ingest_years", "SELECT id, name, CAST(source_year AS INT) AS source_year, source_system FROM bronze_glpi_users")
def _(t):
    return I.read_years(_year_reader(t), "glpi_users", YEARS, "GLPI").select("id", "name", "source_year", "source_system")


@query("src2_src3_ingestion_report", "SELECT 'glpi_users' AS table_name, CAST(source_year AS INT) AS source_year, 'ok' AS status, COUNT(*) AS row_count, FALSE AS has_error FROM bronze_glpi_users GROUP BY source_year UNION ALL SELECT 'glpi_logs', CAST(source_year AS INT), CASE WHEN source_year = 2015 THEN 'empty' ELSE 'ok' END, CASE WHEN source_year = 2015 THEN 0 ELSE COUNT(*) END, FALSE FROM bronze_glpi_logs GROUP BY source_year UNION ALL SELECT 'broken', y, 'failed', 0, TRUE FROM (SELECT unnest([2013, 2014, 2015]) AS y)")
def _(t):
    report = I.ingest_years(t.spark, _year_reader(t), ("broken", "glpi_users", "glpi_logs"), YEARS, "GLPI", fresh(t, "bronze"))
    return report.select("table_name", "source_year", "status", "row_count", F.col("error").isNotNull().alias("has_error"))


@query("src4_single_table", "SELECT ID AS id, HARDWARE_ID AS hardware_id, NAME AS name, CAST(source_year AS INT) AS source_year, source_system FROM bronze_ocs_software")
def _(t):
    df = I.read_years(_year_reader(t), "ocs_software", YEARS, "OCS")
    return df.select(F.col("ID").alias("id"), F.col("HARDWARE_ID").alias("hardware_id"), F.col("NAME").alias("name"), "source_year", "source_system")


def _csv(t, df, encoding="UTF-8"):
    path = fresh(t, "csv")
    (
        df.write.option("header", True).option("encoding", encoding).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


@query("src5_csv_ingest", "SELECT (SELECT COUNT(*) FROM customer) AS written, (SELECT COUNT(*) FROM customer WHERE c_acctbal > 0) AS dry_run_rows")
def _(t):
    path = _csv(t, t.customer)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    written = I.ingest_csv(t.spark, path, fresh(t, "table"), schema)
    dry = I.ingest_csv(t.spark, path, schema=schema, transform=lambda d: d.filter("c_acctbal > 0"), dry_run=True)
    return t.customer.agg(F.max(F.lit(written)).cast("bigint").alias("written"), F.max(F.lit(dry)).cast("bigint").alias("dry_run_rows"))


@query("src6_csv_overwrite", "SELECT COUNT(*) AS n, CAST(SUM(l_linenumber) AS BIGINT) AS lines FROM lineitem")
def _(t):
    path, target = _csv(t, t.lineitem.select("l_orderkey", "l_linenumber")), fresh(t, "table")
    for _ in range(2):
        I.ingest_csv(t.spark, path, target, "l_orderkey bigint, l_linenumber int")
    return t.spark.read.parquet(target).agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


@query("src7_csv_latin1", "SELECT id, designation FROM bronze_glpi_devicegraphiccards")
def _(t):
    target = fresh(t, "table")
    src = t.bronze("glpi_devicegraphiccards").select("id", "designation")
    I.ingest_csv(t.spark, _csv(t, src, "ISO-8859-1"), target, "id bigint, designation string", encoding="ISO-8859-1")
    return t.spark.read.parquet(target)


@query("src8_duplicate_columns", "SELECT s_suppkey, s_name FROM supplier")
def _(t):
    doubled = t.supplier.select("s_suppkey", "s_name", F.upper("s_name").alias("s_name"))
    return I.drop_duplicate_columns(doubled)


@query("src9_column_names", "SELECT p_partkey AS part_key, p_name AS part_name FROM part")
def _(t):
    return I.normalise_names(t.part.select(F.col("p_partkey").alias(" Part Key"), F.col("p_name").alias("PART NAME ")))


@query("src10_stringify", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS kind, CAST(user_id AS VARCHAR) AS user_id FROM events")
def _(t):
    df = t.events.select("event_id", F.when(F.col("event_id") % 5 == 0, "nan").otherwise(F.col("event_type")).alias("kind"), "user_id")
    return I.stringify(df, ["kind", "user_id"])


@query("src11_missing_file", "SELECT COUNT(*) AS customers, 0 AS missing_rows, TRUE AS raised FROM customer")
def _(t):
    absent = f"{t.folder}/absent.csv"
    rows = I.ingest_csv(t.spark, absent, missing_ok=True)
    try:
        I.ingest_csv(t.spark, absent)
        raised = False
    except FileNotFoundError:
        raised = True
    return t.customer.agg(F.count("*").alias("customers")).select("customers", F.lit(rows).alias("missing_rows"), F.lit(raised).alias("raised"))


@query("src12_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'")
def _(t):
    return t.orders.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_totalprice")


@query("src13_vector_table", "SELECT vec_id, CAST(len(embedding) AS INT) AS dims, label, vec_id % 2 = 0 AS refreshed FROM embeddings")
def _(t):
    base = t.embeddings.select("vec_id", F.size("embedding").alias("dims"), "label")
    old = base.withColumn("refreshed", F.lit(False))
    new = base.filter(F.col("vec_id") % 2 == 0).withColumn("refreshed", F.lit(True))
    table = KeyedTable(t.spark, fresh(t, "vectors"))
    table.create(old, "vec_id")
    table.upsert(new)
    return table.read()


@query("src13_dense_sparse_payload", "SELECT chunk_id, TRUE AS has_dense, COALESCE(n, 0) AS n_terms FROM corpus_chunks LEFT JOIN (SELECT doc AS chunk_id, COUNT(*) AS n FROM idx_svec WHERE value > 0 GROUP BY 1) USING (chunk_id)")
def _(t):
    """Payload, dense vector and TF-IDF vector of every chunk, stored by key."""
    s = Search(t)
    sparse = SP.sparse_vectors(s.index()).withColumnRenamed("doc", "chunk_id")
    dense = s.vectors().select(F.col("doc").alias("chunk_id"), "embedding")
    table = K.build_vector_table(s.chunks.select("chunk_id", "ticket_pk"), dense, sparse)
    stored = KeyedTable(t.spark, fresh(t, "payload"))
    stored.create(table, "chunk_id")
    return stored.read().select("chunk_id", (F.size("embedding") > 0).alias("has_dense"), F.coalesce(F.size("sparse"), F.lit(0)).cast("long").alias("n_terms"))


@query("snk1_gold_export", "SELECT risk_tier, COUNT(*) AS n FROM gold_risk GROUP BY 1")
def _(t):
    return K.export_gold(Warehouse(t).gold_risk, fresh(t, "gold")).groupBy("risk_tier").agg(F.count("*").alias("n"))


@query("snk2_append_replace", "SELECT 2 * COUNT(*) AS appended, COUNT(*) AS replaced FROM supplier")
def _(t):
    a, b = fresh(t, "append"), fresh(t, "replace")
    for _ in range(2):
        K.append(t.supplier, a)
        K.save_table(t.supplier, "snk2_" + b[-32:], "overwrite", b)
    n = t.spark.read.parquet(b).agg(F.count("*")).scalar()
    return t.spark.read.parquet(a).agg(F.count("*").alias("appended")).select("appended", n.alias("replaced"))


@query("snk3_sample_export", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer ORDER BY customer.c_custkey LIMIT 100")
def _(t):
    path = fresh(t, "sample")
    K.export_sample(t.customer.select("c_custkey", "c_name"), path, ["c_custkey"])
    return t.spark.read.option("header", True).csv(path)


@query("snk4_stage_handoff", "SELECT COUNT(*) AS documents, CAST(SUM(text_word_count) AS BIGINT) AS words FROM corpus_clean")
def _(t):
    clean = K.export_gold(C.clean(texts(t)), fresh(t, "clean"))
    feats = K.export_gold(C.with_features(clean, encode=False), fresh(t, "features"))
    return feats.agg(F.count("*").alias("documents"), F.sum("text_word_count").alias("words"))


@query("snk5_token_export", "SELECT COUNT(*) AS postings, CAST(SUM(tf) AS BIGINT) AS tokens FROM idx_posts")
def _(t):
    return Search(t).index().postings.agg(F.count("*").alias("postings"), F.sum("tf").alias("tokens"))


@query("snk6_embedding_export", "SELECT COUNT(*) AS vectors, 1 AS encoders FROM corpus_chunks")
def _(t):
    return Search(t).vectors().agg(F.count("*").alias("vectors"), F.count_distinct("encoder_id").alias("encoders"))


@query("snk7_summary_export")
def _(t):
    path = fresh(t, "summary")
    K.export_summary(L.summary_metrics(L.confusion(t.labels, "quality", "toxic")), path)
    return t.spark.read.option("header", True).csv(path)


_DICTIONARY = [
    k for k in ml_dataset.FEATURE_DICTIONARY
    if k in C.CLEAN_COLUMNS or k in ("document_id", "avg_word_length", "unique_word_ratio", "uppercase_ratio", "digit_ratio", "special_char_ratio", "text_complexity_score", "retrieval_quality_score")
]


@query("snk8_feature_dictionary", " UNION ALL ".join(
    "SELECT {} AS feature, {} AS type, {} AS origin, {} AS purpose, {} AS leakage_risk, ".format(*[f"'{x}'" for x in (k, *ml_dataset.FEATURE_DICTIONARY[k])])
    + f"COUNT({k}) AS filled, COUNT(*) - COUNT({k}) AS missing FROM corpus_features" for k in _DICTIONARY
))
def _(t):
    path = fresh(t, "dictionary")
    feats = C.with_features(C.clean(texts(t)), encode=False)
    K.export_json(ml_dataset.feature_dictionary(feats), path)
    return t.spark.read.schema("feature string, type string, origin string, purpose string, leakage_risk string, filled bigint, missing bigint").json(path)


@query("snk9_model_persistence")
def _(t):
    from pyspark.ml import PipelineModel

    data = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    model, path = L.train_classifier(data, "quality", ("n_chars",), trees=20, depth=5), fresh(t, "model")
    K.save_model(model, path)
    known = data.withColumn("n_chars", F.col("n_chars").cast("double"))
    return PipelineModel.load(path).transform(known).select("doc_id", "prediction")


@query("snk10_retrieval_log", "SELECT query_id, CAST(COUNT(*) AS INT) AS n_ids, string_agg(doc, ' ' ORDER BY rank) AS ids FROM idx_bm25s GROUP BY query_id")
def _(t):
    s = Search(t)
    log = K.log_retrieval(t.spark, s.bm25(), s.queries, fresh(t, "log"), "run", 12.5, AS_OF)
    return log.select("query_id", F.size("ids").alias("n_ids"), F.array_join("ids", " ").alias("ids"))


@query("snk11_materialize", "SELECT software_risk_level, COUNT(*) AS n FROM stg_software GROUP BY 1")
def _(t):
    table = K.materialize(Warehouse(t).stg_software, "software", "table", fresh(t, "tables"))
    return K.materialize(table, "software_view", "view", "").groupBy("software_risk_level").agg(F.count("*").alias("n"))


# ---- streaming -----------------------------------------------------------------------------------
@query("st1_incremental_ingest", "SELECT event_id, event_type, user_id FROM events")
def _(t):
    """Two deliveries of all events, the second one a full repeat; every event arrives once."""
    src, dst, chk = fresh(t, "landing"), fresh(t, "bronze"), fresh(t, "offsets")
    for _ in range(2):
        t.events.write.mode("append").parquet(src)
        INC.ingest_incremental(t.spark, src, t.events.schema, dst, chk, "event_id", "ts", "40 days", {"source_system": "GLPI"})
    return t.spark.read.parquet(dst).select("event_id", "event_type", "user_id")


_RATE = """WITH RECURSIVE ev AS (SELECT CAST(user_id AS VARCHAR) AS key, event_id, epoch_us(ts) / 1e6 AS sec, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
w AS (SELECT key, event_id, sec, n, sec AS opened, 1 AS used, TRUE AS allowed, 0 AS retry_after FROM ev WHERE n = 1
UNION ALL SELECT e.key, e.event_id, e.sec, e.n, CASE WHEN e.sec - w.opened > {s} THEN e.sec ELSE w.opened END,
  CASE WHEN e.sec - w.opened > {s} THEN 1 WHEN w.used >= {l} THEN w.used ELSE w.used + 1 END, e.sec - w.opened > {s} OR w.used < {l},
  CASE WHEN e.sec - w.opened > {s} OR w.used < {l} THEN 0 ELSE greatest(CAST(trunc({s} - (e.sec - w.opened)) AS INT), 1) END
  FROM w JOIN ev e ON e.key = w.key AND e.n = w.n + 1)
SELECT key, event_id AS id, allowed, retry_after FROM w"""


@query("st2_rate_detector", _RATE.format(s=172800, l=5))
def _(t):
    return RL.detect(t.events, "user_id", "event_id", "ts", 5, 172_800).drop("at")


@query("st2_rate_detector_stream", _RATE.format(s=172800, l=5))
def _(t):
    src, dst, chk = fresh(t, "landing"), fresh(t, "decisions"), fresh(t, "offsets")
    t.events.write.parquet(src)
    stream = RL.detect_stream(t.spark.readStream.schema(t.events.schema).parquet(src), "user_id", "event_id", "ts", 5, 172_800)
    stream.writeStream.format("parquet").option("path", dst).option("checkpointLocation", chk).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(dst).select("key", "id", "allowed", "retry_after")


@query("st2_rate_rules", "SELECT page_id, CASE WHEN starts_with(p, '/search') THEN 20 WHEN starts_with(p, '/auth/login') THEN 5 WHEN starts_with(p, '/register') THEN 3 ELSE 100 END AS max_requests, CASE WHEN starts_with(p, '/register') THEN 300 ELSE 60 END AS seconds FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/search' WHEN 1 THEN '/auth/login' WHEN 2 THEN '/register' ELSE '' END || url AS p FROM pages)")
def _(t):
    prefix = F.element_at(F.array(*[F.lit(x) for x in ("/search", "/auth/login", "/register", "")]), (F.col("page_id") % 4 + 1).cast("int"))
    limit, seconds = RL.rule_for(F.concat(prefix, "url"))
    return t.pages.select("page_id", limit.alias("max_requests"), seconds.alias("seconds"))


_ERRORS = "COUNT(*) FILTER (CAST(json_extract_string(props, '$.k') AS INT) >= 90) / COUNT(*)::DOUBLE"


@query("st3_step_metrics", f"SELECT date_trunc('day', ts) AS window_start, event_type AS step, COUNT(*) AS requests, {rnd('AVG(value)', 4)} AS avg_value, {rnd(_ERRORS, 4)} AS error_rate FROM events GROUP BY ALL")
def _(t):
    return INC.step_metrics(t.events, "ts", "event_type", "value").drop("p95_value")


@query("st3_step_metrics_stream", f"SELECT date_trunc('day', ts) AS window_start, event_type AS step, COUNT(*) AS requests, {rnd('AVG(value)', 4)} AS avg_value, {rnd(_ERRORS, 4)} AS error_rate FROM events GROUP BY ALL")
def _(t):
    src, dst, chk = fresh(t, "landing"), fresh(t, "metrics"), fresh(t, "offsets")
    INC.closed(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type").write.parquet(src)
    schema = t.spark.read.parquet(src).schema
    stream = INC.step_metrics(t.spark.readStream.schema(schema).parquet(src), "ts", "event_type", "value", lateness="1 hour")
    stream.writeStream.format("parquet").option("path", dst).option("checkpointLocation", chk).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(dst).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "step", "requests", "avg_value", "error_rate")
