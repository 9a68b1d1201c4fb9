"""Readers, sinks, schema alignment and the catalogue."""

import io
import os
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.sources import catalog as cat
from homesense.sources import readers as rd
from homesense.sources.schemas import RAW, schema_of


def test_export_csv_bom_and_repeated_headers(spark, scratch):
    p = os.path.join(scratch, "raw_door.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("﻿home_id,patient_id,start_date,location_name,location_id,value\n")
        f.write("h1,p1,2021-06-09 08:10:00,front door,l1,opened\n")
        f.write("home_id,patient_id,start_date,location_name,location_id,value\n")
        f.write("h1,p1,2021-06-09 08:11:00,front door,l1,closed\n")
    df = rd.read_export_csv(spark, [p], schema_of("raw", "door"))
    rows = df.orderBy("start_date").collect()
    assert [r.value for r in rows] == ["opened", "closed"]
    assert rows[0].source == "raw_door"
    assert df.schema["start_date"].dataType == T.TimestampType()


def test_cast_declared_bool_words(spark):
    df = spark.createDataFrame([("true", "1.5"), ("false", "x")], "snoring string, heart_rate string")
    sch = T.StructType([T.StructField("snoring", T.DoubleType()), T.StructField("heart_rate", T.DoubleType())])
    out = rd.cast_declared(df, sch).collect()
    assert [(r.snoring, r.heart_rate) for r in out] == [(1.0, 1.5), (0.0, None)]


def test_zip_csv(spark, scratch):
    path = os.path.join(scratch, "legacy.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("Observations.csv", "subject,type,valueQuantity\ns1,8310-5,36.6\ns2,8462-4,80\n")
        z.writestr("Other.csv", "a\n1\n")
    df = rd.read_zip_csv(spark, path, "Observations.csv")
    assert df.columns == ["subject", "type", "valueQuantity"]
    assert sorted(r.subject for r in df.collect()) == ["s1", "s2"]


def test_write_table_dedupes_columns(spark, scratch):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    path = rd.write_table(df, os.path.join(scratch, "t"))
    back = spark.read.parquet(path)
    assert back.columns == ["a", "b"] and back.collect()[0].a == 1


def test_align_union(spark):
    old = spark.createDataFrame([("1.5", "x")], "v string, w string")
    new = spark.createDataFrame([(2.5, "y")], "v double, w string")
    out = rd.align_union(old, new)
    assert out.schema["v"].dataType == T.DoubleType()
    assert sorted(r.v for r in out.collect()) == [1.5, 2.5]


def test_snapshot_scan_pushdown(spark, scratch):
    import datetime as dt
    p = os.path.join(scratch, "vit")
    spark.createDataFrame([(dt.datetime(2024, 1, d), float(d)) for d in range(1, 10)],
                          "start_date timestamp_ntz, value double").write.parquet(p)
    out = rd.snapshot_scan(spark, {"raw_heart_rate": p}, {"raw_heart_rate": ["start_date", "value"]},
                           "2024-01-03", "2024-01-05")
    assert sorted(r.value for r in out.collect()) == [3.0, 4.0]
    assert "PushedFilters: [IsNotNull(start_date), GreaterThanOrEqual" in out._jdf.queryExecution().executedPlan().toString()


def test_catalog_load_materialise_delete(spark, scratch):
    c = cat.Catalog(spark, os.path.join(scratch, "data"))

    @c.source("raw", "activity")
    def activity(s):
        import datetime as dt
        return s.createDataFrame([("p1", dt.datetime(2024, 1, 1, 10, m), "kitchen") for m in range(5)],
                                 "patient_id string, start_date timestamp_ntz, location_name string")

    @c.recipe("base", "counts", parents=[("activity", "raw")])
    def counts(activity):
        return activity.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"))

    assert c.load("counts", "base").collect()[0].n == 5
    path = c.materialise("counts", "base")
    assert os.path.isdir(path)
    assert c.manifest().count() == 3  # the source and the first build, then this version
    assert c.load("counts", "base").collect()[0].n == 5  # read back from the stored version
    wide = cat.catalog_wide(c.catalog())
    assert set(wide.columns) == {"row", "RAW", "BASE"}
    c.delete("counts", "base", confirm=True)
    assert not os.path.exists(c.path("base", "counts"))
    assert ("base", "counts") not in c.recipes


def test_orphans_and_upsert(spark):
    listing = spark.createDataFrame([("raw", "a"), ("raw", "b"), ("base", "c")], "domain string, dataset string")
    catalog = spark.createDataFrame([("raw", "a", "old"), ("base", "c", "old")], "domain string, dataset string, spec string")
    assert [tuple(r) for r in cat.orphans(listing, catalog).collect()] == [("raw", "b")]
    new = spark.createDataFrame([("raw", "a", "new"), ("care", "z", "new")], "domain string, dataset string, spec string")
    got = {(r.domain, r.dataset): r.spec for r in cat.catalog_upsert(catalog, new).collect()}
    assert got == {("raw", "a"): "new", ("base", "c"): "old", ("care", "z"): "new"}


def test_declared_schemas_complete():
    assert len(RAW) == 11 and all(f.name == "source" for f in [s.fields[-1] for s in RAW.values()])


def test_refresh_domain_and_tz_check(spark, scratch):
    import datetime as dt
    from homesense.functions.time import is_instant
    c = cat.Catalog(spark, os.path.join(scratch, "data2"))

    @c.source("raw", "events")
    def events(s):
        return s.createDataFrame([("p1", dt.datetime(2024, 1, 1, 10, m)) for m in range(3)],
                                 "patient_id string, start_date timestamp_ntz")

    @c.recipe("base", "first", parents=[("events", "raw")])
    def first(events):
        return events.groupBy("patient_id").agg(F.min("start_date").alias("start_date"))

    @c.recipe("base", "count_of_first", parents=[("first", "base")])
    def count_of_first(first):
        return first.groupBy().count()

    paths = c.refresh_domain("base")
    assert len(paths) == 2 and paths[0].split("/")[-2] == "first"  # parents before children
    assert cat.manifest_latest(c.manifest()).count() == 3  # with the source that the first build stored
    assert not is_instant(c.load("first", "base"), "start_date")
    assert is_instant(spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp"), "t")


def test_csv_columns_bind_by_name(spark, scratch):
    head = "home_id,patient_id,start_date,location_name,location_id,value"
    for name, lines in {"a": [head, "h1,p1,2021-06-09 08:10:00,door,l1,opened"],
                        "b": ["patient_id,home_id,value,start_date,location_name", 'p2,h2,"closed, then",2021-06-09 08:11:00,door']}.items():
        with open(os.path.join(scratch, f"{name}.csv"), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    rows = {r.source: r for r in rd.read_export_csv(spark, [os.path.join(scratch, f"{n}.csv") for n in "ab"],
                                                    schema_of("raw", "door")).collect()}
    assert (rows["a"].patient_id, rows["a"].home_id) == ("p1", "h1")
    assert (rows["b"].patient_id, rows["b"].home_id, rows["b"].value, rows["b"].location_id) == ("p2", "h2", "closed, then", None)
    assert {r.source for r in rd.read_export_csv(spark, scratch + "/*.csv", schema_of("raw", "door")).collect()} == {"a", "b"}


def test_uneven_archives_and_quoted_breaks(spark, scratch):
    members = {"x.zip": 'subject,type,note\ns1,t1,"two\nlines"\ns1,t2,\n', "y.zip": "type,subject,extra\nt3,s2,7\ntype,subject,extra\n"}
    for name, text in members.items():
        with zipfile.ZipFile(os.path.join(scratch, name), "w") as z:
            z.writestr("Observations.csv", text)
    df = rd.read_zip_csv(spark, [os.path.join(scratch, n) for n in members], "Observations.csv")
    assert df.columns == ["subject", "type", "note", "extra"]
    got = sorted(tuple(r) for r in df.na.fill("-").na.fill(-1).collect())
    assert got == [("s1", "t1", "two\nlines", -1), ("s1", "t2", "-", -1), ("s2", "t3", "-", 7)]
    assert rd.read_zip_csv(spark, os.path.join(scratch, "x.zip"), "None.csv").columns == []


def test_align_union_keeps_values_that_do_not_convert(spark):
    old = spark.createDataFrame([("1.5", "1"), ("high", "2")], "v string, n string")
    new = spark.createDataFrame([(2.5, 3, "z")], "v double, n int, extra string")
    out = rd.align_union(old, new)
    assert sorted((r.v, r.n, r.extra or "") for r in out.collect()) == [("1.5", 1, ""), ("2.5", 3, "z"), ("high", 2, "")]


def test_union_all_keeps_every_column(spark):
    from homesense.operators.lookups import union_all
    a, b = spark.createDataFrame([(1, "x")], "k int, a string"), spark.createDataFrame([(2, "y")], "k int, b string")
    assert sorted((r.k, r.a, r.b) for r in union_all([a, b]).collect()) == [(1, "x", None), (2, None, "y")]


def test_load_update_delete_flow(spark, scratch):
    import datetime as dt
    t = [dt.datetime(2024, 1, d) for d in range(1, 20)]
    grown = {"rows": [("p1", t[0]), ("p1", t[9])]}
    built = []
    c = cat.Catalog(spark, os.path.join(scratch, "flow"))

    @c.source("Raw", "Motion", ts="start_date")
    def motion(s):
        return s.createDataFrame(grown["rows"], "patient_id string, start_date timestamp_ntz")

    @c.recipe("Base", "Counts", parents=[("Motion", "Raw")])
    def counts(motion):
        built.append("counts")
        return motion.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"))

    @c.recipe("Base", "Total", parents=[("Counts", "Base")])
    def total(counts):
        built.append("total")
        return counts.agg(F.sum("n").alias("n"))

    n = lambda **kw: c.load("total", "base", **kw).first().n
    assert n(until=t[10]) == 2 and n() == 2 and built == ["counts", "total"]      # stored on first load
    grown["rows"] += [("p1", t[9]), ("p2", t[10]), ("p1", t[14])]                # a tie and rows of the next window
    assert n() == 2                                                             # the stored version
    assert n(update=True, until=t[10] + dt.timedelta(minutes=30)) == 2          # still fresh within the delay
    assert n(update=True, until=t[13]) == 3                                     # window [01-11, 01-14): one row
    assert n(update=True, until=t[18]) == 4
    assert n(reload=True, until=t[18]) == 5 and built.count("counts") == 4
    assert c.load("Counts", "BASE").count() == 2
    assert len(c.refresh_domain("raw")) == 1 and built.count("counts") == 4
    assert len(c.refresh_domain("base")) == 2 and built.count("counts") == 5    # each once
    c.delete("Counts", "base", confirm=True)
    c.recipe("base", "counts", parents=[("motion", "raw")])(counts)
    assert c.load("counts", "base").count() == 2                                # built anew, no dangling path
