"""Driver-table queries for joins, reshaping, ordering and set operations (JN1-JN11, AG14, AG15,
AG22-AG24, SO2-SO3, ST1-ST2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from homesense.functions.scalars import device_type_text
from homesense.operators import lookups as lk
from homesense.operators import stats as st
from homesense.plans.driver_tables import sleep_mat
from homesense.plans.recipes.sleep import process_sleep
from homesense.plans.registry import register, round_doubles, table


@register("lookup_replace", r"""
WITH dim AS (SELECT p_partkey AS k, replace(regexp_replace(max(p_type), '"|\[|\]', '', 'g'), ' ', '_') AS v
             FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey)
SELECT l_orderkey, l_linenumber, coalesce(dim.v, CAST(l_partkey AS VARCHAR)) AS l_partkey
FROM lineitem LEFT JOIN dim ON lineitem.l_partkey = dim.k
""", "JN1")
def q_lookup_replace(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lk.lookup_replace(li, "l_partkey", table(spark, sf, "part"), "p_partkey", "p_type", device_type_text)


@register("join_left_two_keys", """
WITH m AS (SELECT user_id AS patient_id, time_bucket(INTERVAL 1 minute, ts) AS start_date,
                  sum(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0 AS snoring,
                  avg(value) AS heart_rate, avg(value / 4.0) AS respiratory_rate
           FROM events WHERE user_id IS NOT NULL GROUP BY ALL
           HAVING avg(value) IS NOT NULL AND avg(value / 4.0) IS NOT NULL),
raw AS (SELECT user_id AS patient_id, time_bucket(INTERVAL 1 minute, ts) AS start_date,
               CASE event_type WHEN 'view' THEN 'AWAKE' WHEN 'click' THEN 'LIGHT' WHEN 'purchase' THEN 'DEEP'
                               WHEN 'signup' THEN 'REM' WHEN 'error' THEN 'AWAKE' END AS state FROM events)
SELECT m.patient_id, m.start_date, round(m.heart_rate, 6) AS heart_rate,
       round(m.respiratory_rate, 6) AS respiratory_rate, raw.state, m.snoring
FROM m LEFT JOIN raw ON m.patient_id = raw.patient_id AND m.start_date = raw.start_date
""", "JN2", "D5", "SCH7")
def q_join_left_two_keys(spark, sf):
    return round_doubles(process_sleep(sleep_mat(spark, sf), ["patient_id"], dedupe_state=False, tz=None))


@register("join_full_outer", """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.flag, l.quality, l.toxic, l.source AS source_val
FROM (SELECT doc_id, lang, source, n_chars FROM documents) d
FULL OUTER JOIN (SELECT doc_id AS flag, quality, toxic, 'label' AS source FROM labels) l ON d.doc_id = l.flag
""", "JN3")
def q_join_full_outer(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("flag"), "quality", "toxic",
                                                F.lit("label").alias("source"))
    return lk.full_outer_suffixed(docs, labels, "doc_id", "flag")


@register("join_left_fill0", """
WITH r AS (SELECT l_orderkey AS o_orderkey, count(*) AS returned_items, sum(l_quantity) AS returned_qty
           FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT o.o_orderkey, o.o_custkey, coalesce(r.returned_items, 0) AS returned_items,
       round(coalesce(r.returned_qty, 0.0), 6) AS returned_qty
FROM orders o LEFT JOIN r USING (o_orderkey)
""", "JN5")
def q_join_left_fill0(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    r = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("returned_items"),
                                                               F.sum("l_quantity").alias("returned_qty"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return round_doubles(lk.left_fill0(o, r, ["o_orderkey"], ["returned_items", "returned_qty"]))


# Display overrides keyed by code (the reference's flag-type overrides).
TYPE_OVERRIDES = [(8, "Blood Oxygen Saturation"), (24, "Shingles")]


@register("lookup_override", """
WITH dim AS (SELECT k, arg_min(v, p) AS v FROM (
               SELECT n_nationkey AS k, n_name AS v, 1 AS p FROM nation
               UNION ALL SELECT * FROM (VALUES (8, 'Blood Oxygen Saturation', 0), (24, 'Shingles', 0)) t(k, v, p))
             WHERE k IS NOT NULL GROUP BY k)
SELECT c.c_custkey, c.c_nationkey, dim.v AS nation FROM customer c LEFT JOIN dim ON c.c_nationkey = dim.k
""", "JN9")
def q_lookup_override(spark, sf):
    over = spark.createDataFrame(TYPE_OVERRIDES, "n_nationkey int, n_name string")
    dim = lk.lookup_override(table(spark, sf, "nation"), over, "n_nationkey", "n_name")
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return cust.join(dim.withColumnRenamed("n_nationkey", "c_nationkey").withColumnRenamed("n_name", "nation"),
                     on="c_nationkey", how="left")


@register("cohort_semi", """
SELECT event_id, user_id, ts FROM events
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""", "JN11", "SRC10")
def q_cohort_semi(spark, sf):
    cohort = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return lk.semi_by_list(ev, "user_id", cohort, "c_custkey")


@register("orphans_anti", """
SELECT DISTINCT c_mktsegment AS domain, CAST(c_nationkey AS VARCHAR) AS dataset FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                  WHERE CAST(s.s_nationkey AS VARCHAR) = CAST(c.c_nationkey AS VARCHAR)
                    AND c.c_mktsegment = CASE WHEN n.n_regionkey IN (0, 1) THEN 'BUILDING' ELSE 'MACHINERY' END)
""", "JN10", "SRC19")
def q_orphans(spark, sf):
    from homesense.sources.catalog import orphans
    listing = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("domain"),
                                                   F.col("c_nationkey").cast("string").alias("dataset")).distinct()
    sup = table(spark, sf, "supplier").join(table(spark, sf, "nation"),
                                            F.col("s_nationkey") == F.col("n_nationkey"))
    catalog = sup.select(F.when(F.col("n_regionkey").isin(0, 1), "BUILDING").otherwise("MACHINERY").alias("domain"),
                         F.col("s_nationkey").cast("string").alias("dataset"))
    return orphans(listing, catalog)


@register("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events", "AG14")
def q_distinct(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").dropDuplicates()


@register("value_counts", """
SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""", "AG15")
def q_value_counts(spark, sf):
    return st.value_counts(table(spark, sf, "events"), "event_type")


@register("value_share", """
SELECT event_type, round(count(*) / (SELECT count(*) FROM events WHERE event_type IS NOT NULL), 6) AS proportion
FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""", "AG15")
def q_value_share(spark, sf):
    return round_doubles(st.value_counts(table(spark, sf, "events"), "event_type", normalize=True))


_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("one_hot", f"""
SELECT event_id, event_type, {", ".join(f"CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END AS {v}" for v in _TYPES)}
FROM events
""", "AG22")
def q_one_hot(spark, sf):
    return lk.one_hot(table(spark, sf, "events").select("event_id", "event_type"), "event_type", _TYPES)


@register("pivot_answers", """
SELECT conv_id, max(text) FILTER (WHERE role = 'user') AS "user",
       max(text) FILTER (WHERE role = 'assistant') AS assistant,
       max(text) FILTER (WHERE role = 'system') AS system
FROM (SELECT DISTINCT conv_id, role, text FROM conversations) GROUP BY conv_id
""", "AG23")
def q_pivot_answers(spark, sf):
    conv = table(spark, sf, "conversations")
    return lk.pivot_answers(conv, ["conv_id"], "role", "text", ["user", "assistant", "system"])


# Unpivoted columns and their source labels.
BP_COLUMNS = {"l_discount": "discount_rate", "l_tax": "tax_rate"}


@register("unpivot_union", """
SELECT l_orderkey, l_linenumber, 'discount_rate' AS source, round(l_discount, 6) AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax_rate', round(l_tax, 6) FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'price', round(l_extendedprice, 6) FROM lineitem
""", "AG24", "ST1")
def q_unpivot_union(spark, sf):
    li = table(spark, sf, "lineitem")
    bp = lk.unpivot_pairs(li.select("l_orderkey", "l_linenumber", "l_discount", "l_tax"),
                          ["l_orderkey", "l_linenumber"], BP_COLUMNS)
    vitals = li.select("l_orderkey", "l_linenumber", F.lit("price").alias("source"),
                       F.col("l_extendedprice").alias("value"))
    return round_doubles(lk.union_all([vitals, bp], ["l_orderkey", "l_linenumber", "source", "value"]))


@register("pin_row", """
SELECT c_custkey, c_mktsegment, c_mktsegment = 'BUILDING' AS pinned FROM customer
""", "SO2")
def q_pin_row(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return lk.pin_rows(cust, "c_mktsegment", "BUILDING", ["c_custkey"])


@register("first_per_group", """
SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts,
       arg_min(event_type, (ts, event_id)) AS event_type
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
""", "SO3")
def q_first_per_group(spark, sf):
    ev = table(spark, sf, "events").where(F.col("user_id").isNotNull()).select("user_id", "event_id", "ts", "event_type")
    return lk.first_per_group(ev, ["user_id"], ["ts", "event_id"])


@register("union_events", """
SELECT CAST(user_id AS BIGINT) AS patient_id, ts AS start_date, event_type AS location_name FROM events
UNION ALL SELECT o_custkey, o_orderdate, 'order' FROM orders
UNION ALL SELECT l_orderkey, l_shipdate, 'shipment' FROM lineitem
""", "ST1")
def q_union_events(spark, sf):
    ev = table(spark, sf, "events").select(F.col("user_id").alias("patient_id"), F.col("ts").alias("start_date"),
                                           F.col("event_type").alias("location_name"))
    od = table(spark, sf, "orders").select(F.col("o_custkey").alias("patient_id"), F.col("o_orderdate").alias("start_date"),
                                           F.lit("order").alias("location_name"))
    sh = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("patient_id"),
                                             F.col("l_shipdate").alias("start_date"), F.lit("shipment").alias("location_name"))
    return lk.union_all([ev, od, sh])


@register("union_distinct", """
SELECT o_custkey AS patient_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day FROM orders
UNION SELECT l_suppkey, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) FROM lineitem
""", "ST2")
def q_union_distinct(spark, sf):
    od = table(spark, sf, "orders").select(F.col("o_custkey").alias("patient_id"), F.to_date("o_orderdate").alias("day"))
    sh = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("patient_id"), F.to_date("l_shipdate").alias("day"))
    return lk.union_distinct([od, sh]).withColumn("day", F.col("day").cast("timestamp_ntz"))
