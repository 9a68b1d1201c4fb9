"""Readers and sinks (SRC1-SRC3, SRC5-SRC7, SRC9, SCH1-SCH2, SCH5).

All readers return lazy DataFrames with explicit schemas; filters on time ranges are written as column
predicates so Catalyst pushes them into the Parquet scan.
"""

from __future__ import annotations

import csv
import io
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from fnmatch import fnmatchcase
from functools import reduce
from itertools import count, islice
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.functions.scalars import bool_words
from homesense.functions.time import epoch_micros


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan with an optional column list (SRC1); only those columns are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Drop repeated column names, first occurrence wins (SCH5)."""
    seen, keep = set(), []
    for i, name in enumerate(df.columns):
        if name not in seen:
            seen.add(name)
            keep.append(i)
    if len(keep) == len(df.columns):
        return df
    tmp = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    return tmp.select(*[F.col(f"__c{i}").alias(df.columns[i]) for i in keep])


def write_table(df: DataFrame, path: str, compression: str = "gzip", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> str:
    """Parquet sink (SRC2/SRC3): duplicate column names dropped, compressed, whole-dataset replace.

    Returns the path written. Dataset metadata (since / until) goes to the catalogue manifest instead of
    the file footer (see :mod:`homesense.sources.catalog`).
    """
    w = dedupe_columns(df).write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def cast_declared(df: DataFrame, schema: T.StructType, safe: bool = True) -> DataFrame:
    """Cast every declared column to its type (SCH1); ``safe`` turns bad values into null.

    Text columns holding 'true'/'false' in a numeric declaration become 1.0 / 0.0 (SCH3). Undeclared
    columns are kept as they are.
    """
    out = []
    for f in df.schema.fields:
        decl = next((d for d in schema.fields if d.name == f.name), None)
        x = F.col(f"`{f.name}`")
        if decl is None or decl.dataType == f.dataType:
            out.append(x)
        elif isinstance(decl.dataType, (T.DoubleType, T.FloatType)) and isinstance(f.dataType, T.StringType):
            out.append(bool_words(x).cast(decl.dataType).alias(f.name))
        else:
            out.append((x.try_cast(decl.dataType) if safe else x.cast(decl.dataType)).alias(f.name))
    return df.select(*out)


def align_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Cast the old frame's columns to the new frame's types, then union by name (SCH2).

    A naive old timestamp next to an instant new one is read as UTC wall time. A column with an old value
    that does not convert keeps its old values: it becomes text on both sides, so nothing is lost. Whether
    that happens is found by one aggregate over the columns in question; the rest follows from the schemas.
    """
    types = {f.name: f.dataType for f in old.schema.fields}
    casts, doubtful = {}, []
    for name, t in types.items():
        target = new.schema[name].dataType if name in new.columns else t
        x = F.col(f"`{name}`")
        if target == t:
            casts[name] = x
        elif isinstance(target, T.TimestampType) and isinstance(t, T.TimestampNTZType):
            casts[name] = F.timestamp_micros(epoch_micros(x)).alias(name)  # independent of the session zone
        else:
            casts[name] = x.try_cast(target).alias(name)
            if not isinstance(target, T.StringType):
                doubtful.append(name)
    if doubtful:
        lost = old.agg(*[F.max(F.col(f"`{n}`").isNotNull() & casts[n].isNull()).alias(f"c{k}")
                         for k, n in enumerate(doubtful)]).first()
        as_text = [n for k, n in enumerate(doubtful) if lost[k]]
        for name in as_text:
            casts[name] = F.col(f"`{name}`").cast("string").alias(name)
        new = new.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in as_text else F.col(f"`{c}`")
                           for c in new.columns])
    return old.select(*casts.values()).unionByName(new, allowMissingColumns=True)


def snapshot_scan(spark: SparkSession, tables: Mapping[str, str], columns: Mapping[str, Sequence[str]],
                  since: str | None = None, until: str | None = None, ts: str = "start_date") -> DataFrame:
    """Per upstream table: read the chosen columns, keep ``since <= ts < until`` where the table has
    ``ts``, tag ``source`` with the table name, union by name (SRC6). The range filter is pushed into
    each Parquet scan."""
    frames = []
    for name, path in tables.items():
        d = spark.read.parquet(path).select(*columns[name])
        if ts in d.columns:
            if since is not None:
                d = d.where(F.col(ts) >= F.lit(since).cast(d.schema[ts].dataType))
            if until is not None:
                d = d.where(F.col(ts) < F.lit(until).cast(d.schema[ts].dataType))
        frames.append(d.withColumn("source", F.lit(name)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def drop_header_rows(df: DataFrame) -> DataFrame:
    """Drop rows where any cell equals its own column name (repeated CSV headers, SRC7)."""
    cond = None
    for name in df.columns:
        hit = F.coalesce(F.col(f"`{name}`").cast("string") == F.lit(name), F.lit(False))
        cond = hit if cond is None else cond | hit
    return df.where(~cond) if cond is not None else df


def _csv_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Physical lines with the file and the start of the split that they were read from."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _cells(record: str) -> list[str | None]:
    return [x if x != "" else None for x in next(csv.reader(io.StringIO(record, newline="")), [])]


def _csv_headers(lines: DataFrame) -> list[tuple[str, tuple[str, ...], bool]]:
    """(file, names in its header, whether a cell has a line break) of every file, from one job."""
    first = F.min_by("value", F.when(F.col("block") == 0, F.col("at")))
    rows = (lines.withColumn("at", F.monotonically_increasing_id()).groupBy("file")
            .agg(first.alias("header"), F.max(_quotes(F.col("value")) % 2).alias("breaks")).orderBy("file").collect())
    out = []
    for r in rows:      # one row per file
        header = (r.header or "").lstrip("\ufeff").rstrip("\r")
        if header.count('"') % 2:
            raise ValueError(f"the header of {r.file} has a line break in a name")
        out.append((r.file, tuple(n or "" for n in _cells(header)), bool(r.breaks)))
    return out


def _records(names: Sequence[str], headers: dict[str, tuple[str, ...]], inside: dict[tuple[str, int], bool]):
    """The records that begin in each split, as (file, cells of ``names``); for a record that ends in another split, and
    for the lines before the first one of a split, a row with ``block`` and ``part`` instead (``open``: not ended)."""
    def read(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        out: list[tuple] = []
        split, held, leading, quoted, where = None, [], False, False, []

        def end() -> None:
            if held:
                out.append((split[0], None, split[1], "\n".join(held), True))
                held.clear()

        def frame() -> pd.DataFrame:
            df = pd.DataFrame(out, columns=["file", "cells", "block", "part", "open"]).astype({"block": "Int64"})
            out.clear()
            return df

        for pdf in batches:
            for line, file, block in zip(pdf["value"], pdf["file"], pdf["block"]):
                if (file, block) != split:
                    end()
                    split = (file, block)
                    if split not in inside:
                        raise RuntimeError(f"{file} was split in another way than before; read it again")
                    leading = quoted = inside[split]
                    at = {n: k for k, n in reversed(list(enumerate(headers[file])))}
                    where = [at.get(n) for n in names]
                    if block == 0:
                        continue        # the header
                held.append(line)
                quoted ^= line.count('"') % 2 == 1
                if quoted:
                    continue
                record = "\n".join(held)
                held.clear()
                if leading:
                    out.append((file, None, block, record, False))
                    leading = False
                elif record.rstrip("\r"):
                    cells = _cells(record.rstrip("\r"))
                    out.append((file, [cells[k] if k is not None and k < len(cells) else None for k in where], None, None, False))
                if len(out) >= ROWS:
                    yield frame()
        end()
        if out:
            yield frame()
    return read


def _joined(names: Sequence[str], headers: dict[str, tuple[str, ...]]):
    """The records of which the splits of a file hold parts, put together in order."""
    def read(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in batches:
            out = []
            for file, parts in zip(pdf["file"], pdf["parts"]):
                at = {n: k for k, n in reversed(list(enumerate(headers[file])))}
                held: list[str] = []
                for k, p in enumerate(parts):
                    held.append(p["part"])
                    if not p["open"] or k == len(parts) - 1:
                        cells = _cells("\n".join(held).rstrip("\r"))
                        held = []
                        out.append((file, [cells[at[n]] if n in at and at[n] < len(cells) else None for n in names]))
            yield pd.DataFrame(out, columns=["file", "cells"])
    return read


def _read_broken_csv(spark: SparkSession, files: Sequence[str], headers: dict[str, tuple[str, ...]], names: Sequence[str]) -> DataFrame:
    """file, cells of CSV files with line breaks in quoted cells, without giving a file to one task.

    Whether a split begins inside a quoted cell is the parity of the quotes before it: one aggregate per split, then a prefix
    over a file's splits. Each task then reads its splits from the first true start of a record on; only
    the parts of records that lie across a border meet (at most two per split). Quotes are doubled inside quoted cells."""
    lines = _csv_lines(spark, files)
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("file", "block").agg(F.sum(_quotes(F.col("value"))).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)) % 2).collect())      # one row per split
    inside = {(r.file, r.block): r.before == 1 for r in splits}
    read = lines.mapInPandas(_records(names, headers, inside),
                             "file string, cells array<string>, block long, part string, open boolean")
    out = read.where("part IS NULL").select("file", "cells")
    # a record is left open only where the next split begins inside it, or where the file ends in a quoted cell
    parts = read.where("part IS NOT NULL").groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "open", "part"))).alias("parts"))
    return out.unionByName(parts.mapInPandas(_joined(names, headers), "file string, cells array<string>"))


def read_export_csv(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType,
                    source_from_path: bool = True) -> DataFrame:
    """Exported CSV ingest (SRC7): columns bound by the names in each file's own header (files with the same
    header are read together; one job reads all headers), a UTF-8 BOM before the first name dropped, every column
    read as text, repeated header rows dropped, 'true'/'false' -> 1.0/0.0, cast to the declared schema, ``source`` =
    file name stem. Declared columns that a file lacks are null, undeclared ones are left out. Line breaks in quoted
    cells are kept; files that have any are read by ``_read_broken_csv``, in splits like all others. Empty cells and cells
    that a short row lacks are null."""
    names = [f.name for f in schema.fields if f.name != "source"]
    found = _csv_headers(_csv_lines(spark, paths))
    if not found:
        return spark.createDataFrame([], schema)
    frames, by_header = [], {}
    for file, header, breaks in found:
        if not breaks:
            by_header.setdefault(header, []).append(unquote(file))
    for header, files in by_header.items():
        reader = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')
        d = reader.schema(T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(max(1, len(header)))])).csv(files)
        at = {h: k for k, h in reversed(list(enumerate(header)))}
        frames.append(d.select(*[(F.nullif(F.col(f"c{at[n]}"), F.lit("")) if n in at else F.lit(None).cast("string")).alias(n)
                                 for n in names], F.input_file_name().alias("source")))
    broken = {file: header for file, header, breaks in found if breaks}
    if broken:
        d = _read_broken_csv(spark, [unquote(f) for f in broken], broken, names)
        frames.append(d.select(*[F.col("cells")[k].alias(n) for k, n in enumerate(names)], F.col("file").alias("source")))
    out = reduce(DataFrame.unionByName, frames)
    out = drop_header_rows(out.withColumnRenamed("source", "__file")).withColumnRenamed("__file", "source")
    if source_from_path:
        out = out.withColumn("source", F.regexp_extract("source", r"([^/]+?)(\.csv)?$", 1))
    else:
        out = out.drop("source")
    return cast_declared(out, schema)


ROWS = 5000                 # rows that a Python reader hands over at a time
_DEFLATED = 8


class _Member(io.RawIOBase):
    """A deflated or stored archive member as a stream."""

    def __init__(self, data: bytes, method: int):
        self.data, self.at, self.left = data, 0, b""
        self.inflate = zlib.decompressobj(-15) if method == _DEFLATED else None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.left and self.at < len(self.data):
            part = self.data[self.at:self.at + 65_536]
            self.at += len(part)
            if self.inflate is None:
                self.left = part
            else:       # bounded output: what does not fit stays compressed
                self.left = self.inflate.decompress(part, 1 << 20)
                self.at -= len(self.inflate.unconsumed_tail)
        n = min(len(buffer), len(self.left))
        buffer[:n], self.left = self.left[:n], self.left[n:]
        return n


def _zip_reader(data: bytes, method: int) -> Iterator[list[str]]:
    return csv.reader(io.TextIOWrapper(io.BufferedReader(_Member(data, method)), encoding="unicode_escape", newline=""))


def _unique_names(names: Iterable[str]) -> list[str]:
    """Header names, repeated ones told apart by their position: a, a.1, a.2."""
    out: dict[str, None] = {}
    for name in names:
        name = name.lstrip("\ufeff")
        free = (f"{name}.{k}" if k else name for k in count())
        out[next(n for n in free if n not in out)] = None
    return list(out)


def _zip_members(pattern: str):
    """The members of an archive that match, still compressed, as its central directory places them, with their header."""
    def read(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        if info.is_dir() or not fnmatchcase(info.filename, pattern):
                            continue
                        if info.compress_type in (zipfile.ZIP_STORED, _DEFLATED) and not info.flag_bits & 1:
                            name, extra = struct.unpack_from("<HH", content, info.header_offset + 26)
                            start = info.header_offset + 30 + name + extra
                            data, method = content[start:start + info.compress_size], info.compress_type
                        else:
                            data, method = z.read(info), zipfile.ZIP_STORED
                        names = _unique_names(next(_zip_reader(data, method), []))
                        yield pd.DataFrame({"archive": [path], "member": [info.filename], "method": [method],
                                            "data": [data], "names": [names]})
    return read


def _zip_cells(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    """Rows as (names, cells), parsed as a stream: quoted line breaks stay in their cell and the inflated member is never
    held whole."""
    for pdf in batches:
        for data, method, names in zip(pdf["data"], pdf["method"], pdf["names"]):
            rows = _zip_reader(data, method)
            header = next(rows, None)
            body = (r for r in rows if r and r != header)
            names = list(names)
            while held := list(islice(body, ROWS)):
                yield pd.DataFrame({"names": [names[:len(r)] for r in held],
                                    "cells": [[x if x != "" else None for x in r[:len(names)]] for r in held]})


def read_zip_csv(spark: SparkSession, zip_paths: Sequence[str] | str, member: str,
                 schema: T.StructType | None = None, infer: bool = True) -> DataFrame:
    """``load_zip_csv`` (SRC5): the CSV members of each archive whose name is or matches ``member``, decoded with
    ``unicode_escape`` as the reference does.

    Columns are bound by the names in each member's own header, repeated names by their position (a, a.1); members without
    a column give null there, and no column is left out. Archives are read once; each (archive, member) is parsed once, by
    a task of its own. Columns get the declared types of ``schema``, else the narrowest of long, double, boolean, timestamp
    that every value fits (``infer``; found while the parsed rows are stored), else text."""
    from homesense.session import staged
    raw = spark.read.format("binaryFile").load(zip_paths).select("path", "content")
    pattern = member.replace("[", "[[]")
    members = staged(raw.mapInPandas(_zip_members(pattern), "archive string, member string, method int, data binary, names array<string>"),
                     "archive-members")
    heads = members.groupBy("names").agg(F.min(F.struct("archive", "member")).alias("first")).orderBy("first").collect()
    names = list(dict.fromkeys(n for r in heads for n in r["names"]))       # distinct headers only
    if not names:
        return spark.createDataFrame([], schema or T.StructType([]))
    spread = members.select("method", "data", "names", F.xxhash64("archive", "member").alias("task")).repartition("task")
    cells = spread.mapInPandas(_zip_cells, "names array<string>, cells array<string>").select(
        F.map_from_arrays("names", "cells").alias("m"))
    df = cells.select(*[F.element_at("m", F.lit(n)).alias(n) for n in names])
    if schema is not None:
        return cast_declared(df, schema)
    if not infer:
        return df
    seen = Observation()
    stored = staged(df.toDF(*[f"c{i}" for i in range(len(names))]).observe(seen, *_fits(len(names))), "archive-rows").toDF(*names)
    return _narrowed(stored, seen.get)


_KINDS = ("bigint", "double", "boolean", "timestamp")


def _fits(n: int) -> list[Column]:
    """For the text columns c0, c1 ...: whether every value fits a type, and how many there are."""
    cols = [F.col(f"c{i}") for i in range(n)]
    return [*[F.coalesce(F.min(x.isNull() | x.try_cast(k).isNotNull()), F.lit(False)).alias(f"f{i}_{k}")
              for i, x in enumerate(cols) for k in _KINDS], *[F.count(x).alias(f"n{i}") for i, x in enumerate(cols)]]


def _narrowed(df: DataFrame, fits) -> DataFrame:
    kinds = [next((k for k in _KINDS if fits[f"n{i}"] and fits[f"f{i}_{k}"]), "string") for i in range(len(df.columns))]
    return df.select(*[F.col(f"`{name}`").cast(k).alias(name) for name, k in zip(df.columns, kinds)])


def extract_window(df: DataFrame, ts: str, since: str | None = None, until: str | None = None,
                   org_col: str | None = None, orgs: Sequence[str] | None = None) -> Column | DataFrame:
    """Extraction window ``since <= ts < until`` plus an organisation filter (SRC9)."""
    d = df
    if since is not None:
        d = d.where(F.col(ts) >= F.lit(since).cast(df.schema[ts].dataType))
    if until is not None:
        d = d.where(F.col(ts) < F.lit(until).cast(df.schema[ts].dataType))
    if org_col and orgs is not None:
        d = d.where(F.col(org_col).isin(list(orgs)))
    return d
