"""Export CSV in many files and in splits, archives."""

import csv
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import types as T

from homesense.sources import readers as rd
from homesense.sources.schemas import schema_of

HEAD = ["home_id", "patient_id", "start_date", "location_name", "location_id", "value"]
TEXT = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "note", "b")] + [T.StructField("source", T.StringType())])


def write(path, rows, end="\n", bom=False):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows(rows)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(("﻿" if bom else "") + out.getvalue())


def expected(path, names):
    with open(path, encoding="utf-8-sig", newline="") as f:
        rows = [r for r in csv.reader(f) if r]
    at = {h: k for k, h in reversed(list(enumerate(rows[0])))}
    return [tuple((r[at[n]] or None) if n in at and at[n] < len(r) else None for n in names) for r in rows[1:] if r != rows[0]]


def read(spark, paths, names=("id", "note", "b")):
    return sorted((tuple(r[n] for n in names) for r in rd.read_export_csv(spark, paths, TEXT).collect()), key=str)


def cell(rng):
    return rng.choice(["plain", "", 'say ""x"" or "y"', "two\nlines", "a,b", "many\n\n\nbreaks\n", "crlf\r\nin", "é" * rng.randint(1, 40),
                       '"', "x" * rng.randint(1, 300)])


def test_other_compressions_and_large_members(spark, scratch):
    text = "k,v\n" + "".join(f'{k},"{"y" * 50}\nz"\n' for k in range(30_000))
    for name, method in (("s", zipfile.ZIP_STORED), ("d", zipfile.ZIP_DEFLATED), ("b", zipfile.ZIP_BZIP2)):
        with zipfile.ZipFile(os.path.join(scratch, f"{name}.zip"), "w", method) as z:
            z.writestr("m.csv", text)
    df = rd.read_zip_csv(spark, scratch, "m.csv")
    assert df.dtypes == [("k", "bigint"), ("v", "string")]
    assert df.count() == 90_000 and df.where(f"v = '{'y' * 50}\\nz'").select("k").distinct().count() == 30_000


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_breaks_in_splits(spark, scratch, end):
    rng = random.Random(len(end))
    path = os.path.join(scratch, "large.csv")
    rows = [["id", "note", "b"]]
    for k in range(4000):
        rows.append([str(k), cell(rng), cell(rng)])
        if k % 900 == 0:
            rows.append(rows[0])
    rows.insert(2000, ["long", "line\n" * 6000, "one cell over several splits"])
    write(path, rows, end, bom=True)
    before = {c: spark.conf.get(c, None) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in before:
            spark.conf.set(c, "9000")
        assert rd._csv_lines(spark, path).rdd.getNumPartitions() > 20
        assert read(spark, path) == sorted(expected(path, ("id", "note", "b")), key=str)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)


def test_many_small_files_in_a_few_jobs(spark, scratch):
    rng = random.Random(1)
    want = []
    for k in range(2000):
        names = [["id", "note", "b"], ["b", "id", "extra"], ["note", "id"]][k % 3]
        rows = [names] + [[cell(rng) if k % 50 == 0 else f"{n}{k}" for n in names] for _ in range(2)]
        path = os.path.join(scratch, f"part {k}.csv")
        write(path, rows)
        want += expected(path, ("id", "note", "b"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("csv", "csv")
    try:
        df = rd.read_export_csv(spark, os.path.join(scratch, "*.csv"), TEXT)
        assert len(tracker.getJobIdsForGroup("csv")) < 40       # not one job per file
        got = sorted((tuple(r)[:3] for r in df.collect()), key=str)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == sorted(want, key=str)


def test_unended_quote_empty_files_and_short_rows(spark, scratch):
    texts = {"open": 'id,note,b\n1,x,y\n2,"never\nended\n', "none": "", "head": "id,note,b\n", "short": 'id,note,b\n1\n2,"a\nb"\n\n3,"",z,more\n'}
    for name, t in texts.items():
        with open(os.path.join(scratch, f"{name}.csv"), "w") as f:
            f.write(t)
    got = {(r.source, r.id): (r.note, r.b) for r in rd.read_export_csv(spark, scratch, TEXT).collect()}
    assert got == {("open", "1"): ("x", "y"), ("open", "2"): ("never\nended", None), ("short", "1"): (None, None),
                   ("short", "2"): ("a\nb", None), ("short", "3"): (None, "z")}


def test_types_after_breaks(spark, scratch):
    write(os.path.join(scratch, "raw_door.csv"), [HEAD, ["h", "p", "2021-06-09 08:10:00", "front\ndoor", "l", "opened"], HEAD])
    row, = rd.read_export_csv(spark, scratch, schema_of("raw", "door")).collect()
    assert (row.location_name, row.value, row.source, row.start_date.minute) == ("front\ndoor", "opened", "raw_door", 10)


def archive(scratch, name, members):
    path = os.path.join(scratch, name)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for member, text in members.items():
            z.writestr(member, text)
    return path


def test_repeated_names_are_kept_by_position(spark, scratch):
    archive(scratch, "a.zip", {"m.csv": "a,a,b\n1,2,3\na,a,b\n4,,6\n"})
    archive(scratch, "b.zip", {"m.csv": "b,a\n7,8\n"})
    df = rd.read_zip_csv(spark, scratch, "m.csv")
    assert df.columns == ["a", "a.1", "b"]
    assert sorted([tuple(r) for r in df.collect()], key=str) == [(1, 2, 3), (4, None, 6), (8, None, 7)]


def test_members_types_and_one_parse(spark, scratch):
    files = {f"x/m{k}.csv": f"id,v,t,s,flag,none\n{k},{k}.5,2024-01-0{k + 1} 00:00:00,w{k},true,\n{k},2,2024-02-01,7,FALSE,\n" for k in range(5)}
    path = archive(scratch, "five.zip", files)
    df = rd.read_zip_csv(spark, path, "x/m*.csv")
    rows = df.collect()
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "timestamp", "string", "boolean", "string"]
    assert len(rows) == 10 and {r.id for r in rows} == set(range(5)) and {r.s for r in rows} == {"7", *(f"w{k}" for k in range(5))}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "binaryFile" not in plan                  # the stored rows: nothing is parsed again
    one = rd.read_zip_csv(spark, path, "x/m3.csv", infer=False)
    assert one.count() == 2 and set(one.dtypes) == {(n, "string") for n in one.columns}
    assert rd.read_zip_csv(spark, path, "no.csv").columns == []


def test_values_that_a_wide_type_does_not_fit(spark, scratch):
    path = archive(scratch, "odd.zip", {"m.csv": "a,b,c\n1,9223372036854775808,1e400\n2,3,nan\n, ,x\n"})
    df = rd.read_zip_csv(spark, path, "m.csv")
    assert dict(df.dtypes)["a"] == "bigint" and dict(df.dtypes)["c"] == "string"
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(None, " ", "x"), (1, "9223372036854775808", "1e400"), (2, "3", "nan")]
    assert [c for c in df.columns] == ["a", "b", "c"]
