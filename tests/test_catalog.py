"""Catalogue: updates by windows and buckets, stored registry, domains in threads, sweep."""

import datetime as dt
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from homesense.plans.compare import rows_of
from homesense.plans.registry import round_doubles
from homesense.sources import catalog as cat

DAY = [dt.datetime(2024, 1, 1) + dt.timedelta(days=k) for k in range(40)]
SCHEMA = "patient_id string, start_date timestamp_ntz, id int"


def files(path):
    """Data file -> (time of last change, size) below a folder."""
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                st = os.stat(os.path.join(folder, n))
                out[os.path.join(folder, n)] = (st.st_mtime_ns, st.st_size)
    return out


def ids(df):
    return sorted(r.id for r in df.collect())


def counting(spark, scratch, rows, **kw):
    c = cat.Catalog(spark, os.path.join(scratch, "c"), buckets=8)
    c.source("raw", "events", ts="start_date", **kw)(lambda s: s.createDataFrame(rows, SCHEMA))
    return c


def test_update_neither_doubles_nor_loses_rows(spark, scratch):
    rows = [("a", DAY[0], 1), ("b", DAY[2], 3), ("a", DAY[5], 6), ("b", DAY[8], 9), ("c", None, 0)]
    c = counting(spark, scratch, rows, lookback=dt.timedelta(days=4))
    assert ids(c.load("events", "raw", until=DAY[4])) == [0, 1, 3]           # rows beyond the bound wait
    path = c._latest("raw", "events")["path"]
    before = files(path)
    rows.append(("a", DAY[1], 2))                                             # late, within the look-back
    assert ids(c.load("events", "raw", update=True, until=DAY[11])) == [0, 1, 2, 3, 6, 9]
    assert ids(c.load("events", "raw", update=True, until=DAY[13])) == [0, 1, 2, 3, 6, 9]
    assert ids(c.load("events", "raw", update=True, until=DAY[14])) == [0, 1, 2, 3, 6, 9]
    after = files(path)
    assert c._latest("raw", "events")["path"] == path and before.items() <= after.items()  # earlier files unchanged
    assert c.changes().where("dataset = 'events'").count() == 2              # the build and the one update with news


def test_an_update_that_broke_off_is_repeated(spark, scratch, monkeypatch):
    rows = [("a", DAY[0], 1), ("b", DAY[2], 2), ("a", DAY[6], 3)]
    c = counting(spark, scratch, rows, keys=["patient_id"])
    built = []

    @c.recipe("base", "n", parents=[("events", "raw")], keys=["patient_id"])
    def n(events):
        built.append(1)
        return events.groupBy("patient_id").agg(F.count("*").alias("n"))

    assert {(r.patient_id, r.n) for r in c.load("n", "base", until=DAY[4]).collect()} == {("a", 1), ("b", 1)}
    record = cat.Catalog._record
    monkeypatch.setattr(cat.Catalog, "_record", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        c.load("n", "base", update=True, until=DAY[9])      # windows are written, the manifest is not
    monkeypatch.setattr(cat.Catalog, "_record", record)
    assert {(r.patient_id, r.n) for r in c.load("n", "base", update=True, until=DAY[9]).collect()} == {("a", 2), ("b", 1)}
    assert ids(c.load("events", "raw")) == [1, 2, 3] and len(built) == 2


def test_windows_and_buckets_that_lose_their_rows(spark, scratch):
    rows = [("a", DAY[0], 1), ("b", DAY[5], 2), ("c", DAY[5], 3), ("b", None, 4)]
    c = counting(spark, scratch, rows, keys=["patient_id"], lookback=dt.timedelta(days=9))
    c.recipe("base", "last", parents=[("events", "raw")], keys=["patient_id"])(
        lambda events: events.groupBy("patient_id").agg(F.max("id").alias("id")))
    assert ids(c.load("last", "base", until=DAY[7])) == [1, 3, 4]
    rows[1:] = [("d", DAY[6], 7)]
    assert ids(c.load("last", "base", update=True, until=DAY[9])) == [1, 7]
    assert ids(c.load("events", "raw")) == [1, 7]


def test_changed_columns_and_types(spark, scratch):
    c = cat.Catalog(spark, os.path.join(scratch, "c"))
    now = {"df": spark.createDataFrame([("a", DAY[0], 1), ("a", DAY[3], 2)], SCHEMA)}
    c.source("raw", "events", ts="start_date", lookback=dt.timedelta(days=2))(lambda s: now["df"])
    assert c.load("events", "raw", until=DAY[4]).count() == 2
    now["df"] = spark.createDataFrame([("a", DAY[3], 2.5, "x"), ("b", DAY[6], 3.5, "y")],
                                      "patient_id string, start_date timestamp_ntz, id double, note string")
    got = c.load("events", "raw", update=True, until=DAY[9]).orderBy("start_date").collect()
    assert [(r.id, r.note) for r in got] == [(1.0, None), (2.5, "x"), (3.5, "y")]
    assert c.load("events", "raw", update=True, until=DAY[20]).count() == 3


def test_keyed_recipes_derive_touched_buckets_only(spark, scratch):
    rows = [(f"p{k}", DAY[k % 5], k) for k in range(40)]
    c = counting(spark, scratch, rows, keys=["patient_id"])
    read, names = [], [("p1", "one")]

    @c.recipe("base", "steps", parents=[("events", "raw"), ("names", "lookup")], keys=["patient_id"])
    def steps(events, names):
        read.append({r.patient_id for r in events.select("patient_id").distinct().collect()})
        return events.join(names, "patient_id", "left").groupBy("patient_id", "name").agg(F.count("*").alias("n"))

    c.source("lookup", "names")(lambda s: s.createDataFrame(names, "patient_id string, name string"))
    c.recipe("profile", "total", parents=[("steps", "base")])(lambda steps: steps.agg(F.sum("n").alias("n")))
    assert c.load("total", "profile", until=DAY[5]).first().n == 40
    before = files(c._latest("base", "steps")["path"])
    rows.append(("p1", DAY[6], 99))
    assert c.load("total", "profile", update=True, until=DAY[8]).first().n == 41
    assert len(read) == 2 and "p1" in read[1] and len(read[1]) < 20           # its bucket, not all forty
    after = files(c._latest("base", "steps")["path"])
    assert 0 < len(before.items() & after.items()) == len(before) - 1
    assert {(r.patient_id, r.name, r.n) for r in c.load("steps", "base").collect()} >= {("p1", "one", 2), ("p2", None, 1)}
    c.load("total", "profile", update=True, until=DAY[12])                   # nothing new: nothing is derived
    assert len(read) == 2
    names.append(("p2", "two"))                                               # context changed: all of it
    c.load("steps", "base", update=True, until=DAY[15])
    assert len(read) == 3 and len(read[2]) == 40


def test_update_through_the_sleep_and_motion_levels_equals_a_recompute(spark, scratch):
    from homesense.plans import driver_tables as views
    from homesense.plans.recipes.domains import register_base, register_profile
    sf, cut = "/root/testdata/sf0.001", dt.datetime(2024, 1, 20)
    few = {r.patient_id for r in views.sleep_mat(spark, sf).select("patient_id").distinct().orderBy("patient_id").limit(6).collect()}

    def catalog(name, everything):
        c = cat.Catalog(spark, os.path.join(scratch, name), buckets=16)
        for source, view in {"door": views.door_view, "activity": views.activity_view, "sleep_mat": views.sleep_mat}.items():
            def read(s, view=view):
                df = view(s, sf)
                return df if everything[0] else df.where((F.col("start_date") < F.lit(cut)) | F.col("patient_id").isin(sorted(few)))
            c.source("raw", source, ts="start_date", keys=["patient_id"])(read)
        register_base(c, sleep_tiebreak="event_id", door_tiebreak="event_id")
        register_profile(c, gap_hours=6)
        return c

    late = dt.datetime(2030, 1, 1)
    c, whole = catalog("steps", [False]), catalog("whole", [False])
    for name, domain in (("sleep_model", "profile"), ("transitions", "base")):
        c.load(name, domain, until=cut)
        stored = files(c._latest(domain, name)["path"])
        got = c.load(name, domain, update=True, until=late)
        kept = stored.items() & files(c._latest(domain, name)["path"]).items()
        assert kept and len(kept) >= len(stored) - len(few)
        want = whole.load(name, domain, until=late)
        assert rows_of(round_doubles(got).toPandas()) == rows_of(round_doubles(want).toPandas())


def specs(folder, rows):
    os.makedirs(folder, exist_ok=True)
    for k, r in enumerate(rows):
        with open(os.path.join(folder, f"{k}.json"), "w") as f:
            f.write(json.dumps(r))


def first_events(events):
    return events.groupBy("patient_id").agg(F.min("start_date").alias("start_date"))


def test_registry_from_specs(spark, scratch):
    data, folder, root = (os.path.join(scratch, x) for x in ("in", "specs", "root"))
    spark.createDataFrame([("a", DAY[0], 1), ("a", DAY[3], 2)], SCHEMA).write.parquet(data)
    specs(folder, [{"domain": "Raw", "dataset": "Events", "format": "parquet", "path": data, "ts": "start_date",
                    "keys": ["patient_id"], "schema": SCHEMA},
                   {"domain": "base", "dataset": "first", "parents": ["Raw.Events"], "keys": ["patient_id"],
                    "function": "tests.test_catalog:first_events"}])
    c = cat.Catalog(spark, root)
    assert c.rebuild_registry(folder) == 2
    assert c.load("first", "base").first().start_date == DAY[0]
    again = cat.Catalog(spark, root)                                          # read on start
    assert again.load("First", "Base").count() == 1 and again.recipes[("base", "first")].keys == ("patient_id",)
    again.register(spark.createDataFrame([("raw", "events", "parquet", data + "2")], "domain string, dataset string, format string, path string"))
    assert {r.dataset: r.path for r in again.registry().collect()}["events"] == data + "2"    # the latest row wins
    again.delete("first", "base", confirm=True)
    assert set(cat.Catalog(spark, root).recipes) == set()
    import shutil
    shutil.rmtree(os.path.join(root, "_registry"))
    lost = cat.Catalog(spark, root)
    assert not lost.sources
    assert lost.rebuild_registry(folder) == 2 and lost.load("first", "base").count() == 1
    specs(os.path.join(scratch, "fewer"), [{"domain": "raw", "dataset": "events", "path": data}])
    assert lost.rebuild_registry(os.path.join(scratch, "fewer")) == 1
    assert set(cat.Catalog(spark, root).sources) == {("raw", "events")} and not cat.Catalog(spark, root).recipes


def test_update_domain_in_threads(spark, scratch):
    rows = [("a", DAY[0], 1), ("b", DAY[6], 2)]
    c = counting(spark, scratch, rows)
    busy, most, lock = [0], [0], threading.Lock()

    def slow(name):
        def fn(events):
            with lock:
                busy[0] += 1
                most[0] = max(most[0], busy[0])
            time.sleep(0.5)
            with lock:
                busy[0] -= 1
            if name == "broken" and events.count() > 1:
                raise ValueError("no such thing")
            return events.groupBy("patient_id").agg(F.count("*").alias("n"))
        return fn

    for name in ("one", "two", "broken"):
        c.recipe("base", name, parents=[("events", "raw")])(slow(name))
    c.recipe("base", "after_one", parents=[("one", "base")])(lambda one: one.agg(F.sum("n").alias("n")))
    c.recipe("base", "after_broken", parents=[("broken", "base")])(lambda broken: broken)
    c.recipe("base", "never_loaded", parents=[("one", "base")])(lambda one: one)
    for name in ("after_one", "after_broken", "two"):
        c.load(name, "base", until=DAY[3])
    assert c.levels([("base", "after_one")]) == [[("raw", "events")], [("base", "one")], [("base", "after_one")]]
    most[0] = 0
    state = c.update_domain("base", workers=3, until=DAY[9])
    assert most[0] > 1                                                        # siblings ran at the same time
    assert {k[1] for k, e in state.items() if e is None} == {"events", "one", "two", "after_one"}
    assert isinstance(state[("base", "broken")], ValueError) and "broken failed" in str(state[("base", "after_broken")])
    assert c.load("after_one", "base").first().n == 2 and c.load("after_broken", "base").count() == 1
    c.recipe("base", "loop", parents=[("loop", "base")])(lambda loop: loop)
    with pytest.raises(ValueError):
        c.levels([("base", "loop")])


def test_sweep(spark, scratch):
    rows = [("a", DAY[0], 1)]
    c = counting(spark, scratch, rows)
    c.recipe("base", "copy", parents=[("events", "raw")])(lambda events: events)
    c.load("copy", "base")
    old = c._latest("base", "copy")["path"]
    live = c.materialise("copy", "base")
    broken = os.path.join(c.root, "base", "copy", "v=20200101T000000000000")
    orphan = os.path.join(c.root, "care", "gone", "v=20200101T000000000000")
    other = os.path.join(c.root, "base", "copy", "notes")
    stages = os.path.join(scratch, "stages")
    table, strange = os.path.join(stages, "op-rows-" + "0" * 32), os.path.join(stages, "mine")
    for path in (broken, orphan, other, table, strange):
        os.makedirs(path)
    found = dict(c.sweep(min_age_hours=0, stages=stages))
    assert found == {old: "replaced", broken: "broken off", orphan: "not registered", table: "intermediate"}
    assert all(os.path.isdir(p) for p in found)                               # a dry run removes nothing
    assert set(dict(c.sweep(stages=stages))) == {old, orphan}                 # young folders may still be written
    c.sweep(dry_run=False, min_age_hours=0, stages=stages)
    assert not any(os.path.isdir(p) for p in found)
    assert all(os.path.isdir(p) for p in (live, other, strange)) and ids(c.load("copy", "base")) == [1]
    assert c.sweep(min_age_hours=0, stages=stages) == []


@pytest.mark.parametrize("name,domain", [("", "raw"), ("..", "raw"), ("events", ""), ("events", ".."), (None, ""), ("a/b", "raw")])
def test_delete_refuses_paths(spark, scratch, name, domain):
    c = counting(spark, scratch, [("a", DAY[0], 1)])
    c.load("events", "raw")
    with pytest.raises(ValueError):
        c.delete(name, domain, confirm=True)
    assert ids(c.load("events", "raw")) == [1]
