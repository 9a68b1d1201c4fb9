"""Driver-table queries for scans, schema handling, incremental refresh and the catalogue
(SRC1, SRC4, SRC6-SRC9, SRC13-SRC15, SRC18, SCH1, SCH2, SCH4, FIL9, AG21)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.functions.scalars import array_text
from homesense.operators import lookups as lk
from homesense.operators.sequences import transitions
from homesense.plans.registry import register, round_doubles, table
from homesense.sources import catalog as cat
from homesense.sources import readers as rd


@register("scan_project", "SELECT l_orderkey, round(l_quantity, 6) AS l_quantity FROM lineitem", "SRC1")
def q_scan_project(spark, sf):
    return round_doubles(rd.read_table(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_quantity"]))


@register("manifest_latest", """
SELECT domain, dataset, arg_max(since, (written_at, v)) AS since, arg_max(until, (written_at, v)) AS until,
       max(written_at) AS written_at, arg_max(v, (written_at, v)) AS v
FROM (SELECT o_orderpriority AS domain, CAST(o_custkey AS VARCHAR) AS dataset, o_orderdate AS since,
             o_orderdate + INTERVAL 30 day AS until, o_orderdate AS written_at, o_orderkey AS v FROM orders)
GROUP BY domain, dataset
""", "SRC4")
def q_manifest_latest(spark, sf):
    o = table(spark, sf, "orders")
    m = o.select(F.col("o_orderpriority").alias("domain"), F.col("o_custkey").cast("string").alias("dataset"),
                 F.col("o_orderdate").alias("since"),
                 (F.col("o_orderdate") + F.make_dt_interval(F.lit(30))).alias("until"),
                 F.struct(F.col("o_orderdate").alias("t"), F.col("o_orderkey").alias("v")).alias("written_at"))
    out = cat.manifest_latest(m)
    return out.select("domain", "dataset", "since", "until", F.col("written_at.t").alias("written_at"),
                      F.col("written_at.v").alias("v"))


@register("snapshot_scan", """
SELECT CAST(event_id AS BIGINT) AS id, ts AS start_date, 'events' AS source FROM events
WHERE ts >= TIMESTAMP '1995-01-01' AND ts < TIMESTAMP '2024-01-15'
UNION ALL SELECT o_orderkey, o_orderdate, 'orders' FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2024-01-15'
UNION ALL SELECT c_custkey, NULL, 'customer' FROM customer
""", "SRC6")
def q_snapshot_scan(spark, sf):
    cols = {"events": [F.col("event_id").alias("id"), F.col("ts").alias("start_date")],
            "orders": [F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("start_date")],
            "customer": [F.col("c_custkey").alias("id")]}
    paths = {n: f"{sf}/{n}.parquet" for n in cols}
    return rd.snapshot_scan(spark, paths, cols, since="1995-01-01", until="2024-01-15")


@register("header_row_filter", """
SELECT doc_id, lang, source FROM (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN n_chars > 3000 THEN 'lang' ELSE lang END AS lang, source
  FROM documents)
WHERE doc_id <> 'doc_id' AND lang <> 'lang' AND source <> 'source'
""", "SRC7")
def q_header_rows(spark, sf):
    d = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("n_chars") > 3000, "lang").otherwise(F.col("lang")).alias("lang"), "source")
    return rd.drop_header_rows(d)


@register("incremental_append", """
SELECT event_id, ts, user_id, event_type, CAST(value AS VARCHAR) AS value FROM events
WHERE ts < TIMESTAMP '2024-02-20'
""", "SRC8", "SCH2")
def q_incremental_append(spark, sf):
    """Two fetches with a look-back of thirty days: sign-ups before the first one's bound arrive late, with the second."""
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    bound = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    on_time = (F.col("ts") < bound) & ~F.coalesce(F.col("event_type") == "signup", F.lit(False))
    stored = cat.incremental_append(ev.limit(0), ev.where(on_time), "ts", until="2024-01-15")
    fresh = ev.withColumn("value", F.col("value").cast("string"))  # schema drift: text in the new batch
    return cat.incremental_append(stored, fresh, "ts", since="2023-12-16", until="2024-02-20")


@register("extract_window", """
SELECT event_id, user_id, ts, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20' AND event_type IN ('click', 'purchase')
""", "SRC9")
def q_extract_window(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return rd.extract_window(ev, "ts", "2024-01-03", "2024-01-20", "event_type", ["click", "purchase"])


_TRANSITIONS_SQL = """
SELECT user_id, start_date, end_date, source, sink, source || '>' || sink AS transition, round(dur, 6) AS dur
FROM (SELECT user_id, ts AS start_date, lead(ts) OVER w AS end_date,
             coalesce(event_type, 'nan') AS source, lead(coalesce(event_type, 'nan')) OVER w AS sink,
             (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6 AS dur
      FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE end_date IS NOT NULL
"""


@register("incremental_derive", _TRANSITIONS_SQL, "SRC13", "FIL7")
def q_incremental_derive(spark, sf):
    """Stored transitions of the events before 2024-01-15 without the purchases, which arrive late with the
    others: refreshed at the fresh rows' places, they equal the full run."""
    ev = table(spark, sf, "events")

    def recipe(events):
        return transitions(events, ["user_id"], "ts", "event_type", tiebreak="event_id")

    first = (F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")) & \
        ~F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    out = cat.incremental_derive(recipe(ev.where(first)), {"events": ev}, recipe, ["user_id"], "start_date",
                                 parent_ts="ts", fresh=ev.where(~first))
    return round_doubles(out)


@register("catalog_upsert", """
WITH old AS (SELECT c_mktsegment AS domain, CAST(c_nationkey AS VARCHAR) AS dataset, min(c_name) AS spec, 1 AS p
             FROM customer GROUP BY ALL),
new AS (SELECT c_mktsegment AS domain, CAST(c_nationkey AS VARCHAR) AS dataset, max(c_name) AS spec, 0 AS p
        FROM customer WHERE c_acctbal > 5000 GROUP BY ALL)
SELECT domain, dataset, arg_min(spec, p) AS spec FROM (SELECT * FROM old UNION ALL SELECT * FROM new)
GROUP BY domain, dataset
""", "SRC14")
def q_catalog_upsert(spark, sf):
    c = table(spark, sf, "customer")
    old = c.groupBy(F.col("c_mktsegment").alias("domain"), F.col("c_nationkey").cast("string").alias("dataset")) \
        .agg(F.min("c_name").alias("spec"))
    new = c.where(F.col("c_acctbal") > 5000).groupBy(F.col("c_mktsegment").alias("domain"),
                                                     F.col("c_nationkey").cast("string").alias("dataset")) \
        .agg(F.max("c_name").alias("spec"))
    return cat.catalog_upsert(old, new)


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("catalog_domains", f"""
WITH d AS (SELECT DISTINCT upper(c_mktsegment) AS dom,
                  upper(substr(c_name, 1, 1)) || lower(substr(c_name, 2)) AS title FROM customer),
r AS (SELECT dom, title, row_number() OVER (PARTITION BY dom ORDER BY title) - 1 AS "row" FROM d)
SELECT "row", {", ".join(f"coalesce(max(title) FILTER (WHERE dom = '{s}'), '') AS {s}" for s in _SEGMENTS)}
FROM r GROUP BY "row"
""", "SRC15", "SO4")
def q_catalog_domains(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("domain"), F.col("c_name").alias("dataset"))
    return cat.catalog_wide(c, domains=_SEGMENTS).withColumn("row", F.col("row").cast("long"))


@register("catalog_delete_anti", """
SELECT DISTINCT c_mktsegment AS domain, CAST(c_nationkey AS VARCHAR) AS dataset FROM customer
WHERE c_mktsegment <> 'AUTOMOBILE'
  AND NOT (c_mktsegment = 'BUILDING' AND c_nationkey = 3)
""", "SRC18")
def q_catalog_delete(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("domain"),
                                            F.col("c_nationkey").cast("string").alias("dataset")).distinct()
    c = cat.catalog_delete(c, "AUTOMOBILE")
    gone = spark.createDataFrame([("BUILDING", "3")], "domain string, dataset string")
    return lk.anti_by(c, gone, ["domain", "dataset"])


@register("latest_ts", "SELECT user_id, max(ts) AS latest FROM events GROUP BY user_id", "AG21")
def q_latest_ts(spark, sf):
    return cat.latest_ts(table(spark, sf, "events"), "ts", ["user_id"])


@register("cast_declared", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INTEGER) AS user_id, event_type,
       CASE WHEN event_type = 'click' THEN 1.0 WHEN event_type = 'view' THEN 0.0 END AS flag
FROM events
""", "SCH1", "SCH3")
def q_cast_declared(spark, sf):
    ev = table(spark, sf, "events")
    d = ev.select("event_id", "user_id", "event_type",
                  F.when(F.col("event_type") == "click", "true").when(F.col("event_type") == "view", "false")
                  .otherwise("n/a").alias("flag"))
    declared = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("user_id", T.IntegerType()),
                             T.StructField("flag", T.DoubleType())])
    return rd.cast_declared(d, declared)


@register("align_union", """
SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity, l_returnflag FROM lineitem WHERE l_linenumber <= 3
UNION ALL
SELECT l_orderkey, l_linenumber, round(l_quantity, 6), l_returnflag FROM lineitem WHERE l_linenumber > 3
""", "SCH2")
def q_align_union(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    old = li.where(F.col("l_linenumber") <= 3).withColumn("l_quantity", F.col("l_quantity").cast("string"))
    new = li.where(F.col("l_linenumber") > 3)
    return round_doubles(rd.align_union(old, new))


@register("array_to_string", """
SELECT vec_id, label, array_to_string(list_transform(embedding, lambda x: printf('%.6f', x)), ' ') AS embedding_text
FROM embeddings
""", "SCH4")
def q_array_to_string(spark, sf):
    emb = table(spark, sf, "embeddings")
    cells = F.transform("embedding", lambda x: F.format_string("%.6f", x))      # fixed digits, as engines print floats apart
    return emb.select("vec_id", "label", array_text(cells).alias("embedding_text"))
