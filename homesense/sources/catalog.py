"""Dataset catalogue: registry of recipes, manifest of materialised versions, load / refresh / delete
(SRC4, SRC8, SRC11-SRC20, UD1, AG21).

The catalogue and the manifest are small tables (one row per dataset / per written version). Recipes are
Python functions of parent DataFrames; ``Catalog.load`` reads stored versions and builds, updates or rebuilds
them through the dependency DAG on request.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
import re
import threading
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homesense.session import staged

MANIFEST_SCHEMA = T.StructType([
    T.StructField("domain", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("since", T.TimestampNTZType()), T.StructField("until", T.TimestampNTZType()),
    T.StructField("written_at", T.TimestampNTZType()), T.StructField("path", T.StringType()),
    T.StructField("schema", T.StringType())])
CATALOG_SCHEMA = T.StructType([T.StructField("domain", T.StringType()), T.StructField("dataset", T.StringType())])


# ---------------------------------------------------------------- table-level operators


def manifest_latest(manifest: DataFrame, keys: Sequence[str] = ("domain", "dataset"),
                    written_at: str = "written_at") -> DataFrame:
    """Latest manifest row per dataset (SRC4): ``max_by`` of the row on the write time."""
    others = [c for c in manifest.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.col(written_at))
    return manifest.groupBy(*keys).agg(best.alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others])


def catalog_upsert(catalog: DataFrame, rows: DataFrame, keys: Sequence[str] = ("domain", "dataset")) -> DataFrame:
    """Register / replace datasets (SRC14): new rows win over catalogue rows with the same key."""
    new = rows.select(*catalog.columns).withColumn("__p", F.lit(0))
    old = catalog.withColumn("__p", F.lit(1))
    u = new.unionByName(old)
    others = [c for c in catalog.columns if c not in keys]
    if not others:
        return u.select(*keys).dropDuplicates()
    best = F.min_by(F.struct(*others), F.col("__p"))
    return u.groupBy(*keys).agg(best.alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others])


def catalog_wide(catalog: DataFrame, domain: str = "domain", dataset: str = "dataset",
                 domains: Sequence[str] | None = None) -> DataFrame:
    """One column per domain (upper-case names), its sorted distinct dataset titles (initcap) from the
    top, blank cells padding the shorter columns; domains ordered by size, largest first (SRC15).

    Returns (row, <DOMAIN columns>): the row index is explicit since the table is a listing. The domains are the
    registry's own short list; pass them to spare the look for them.
    """
    if domains is None:
        domains = [r["domain"] for r in domain_order(catalog, domain, dataset).collect()]
    d = catalog.select(F.upper(F.col(domain)).alias("__d"), F.initcap(F.col(dataset)).alias("__t")).distinct()
    d = d.withColumn("__row", F.row_number().over(Window.partitionBy("__d").orderBy("__t")) - 1)
    return d.groupBy("__row").pivot("__d", [x.upper() for x in domains]).agg(F.first("__t")).na.fill("").withColumnRenamed("__row", "row")


def domain_order(catalog: DataFrame, domain: str = "domain", dataset: str = "dataset") -> DataFrame:
    """Domains with their number of distinct datasets, largest first (SO4)."""
    return (catalog.groupBy(F.upper(F.col(domain)).alias("domain"))
            .agg(F.countDistinct(dataset).alias("n")).orderBy(F.desc("n"), "domain"))


def catalog_delete(catalog: DataFrame, domain: str, dataset: str | None = None) -> DataFrame:
    """Catalogue without a dataset (or a whole domain) (SRC18); a domain disappears with its last row."""
    gone = F.col("domain") == domain
    if dataset is not None:
        gone = gone & (F.col("dataset") == dataset)
    return catalog.where(~gone)


def orphans(listing: DataFrame, catalog: DataFrame, keys: Sequence[str] = ("domain", "dataset")) -> DataFrame:
    """Stored datasets whose (domain, dataset) is not in the catalogue (SRC19)."""
    return listing.join(catalog.select(*keys).distinct(), on=list(keys), how="left_anti")


def latest_ts(df: DataFrame, ts: str = "start_date", keys: Sequence[str] = ()) -> DataFrame:
    """Latest timestamp of a dataset, optionally per key (AG21)."""
    return df.groupBy(*keys).agg(F.max(ts).alias("latest"))


def incremental_append(stored: DataFrame, fresh: DataFrame, ts: str = "start_date", since=None, until=None) -> DataFrame:
    """Raw append (SRC8): the fetched window ``since <= ts < until`` takes the place of the stored rows in it, old
    columns aligned to the new types. With a ``since`` some way before the last fetch's bound, rows that came late are
    found and those fetched before are not doubled. Without ``since``, fresh rows are added and none is replaced."""
    from homesense.sources.readers import align_union, extract_window
    if since is not None:
        kind = stored.schema[ts].dataType
        inside = F.col(ts) >= F.lit(since).cast(kind)
        if until is not None:
            inside = inside & (F.col(ts) < F.lit(until).cast(kind))
        stored = stored.where(~F.coalesce(inside, F.lit(False)))
    return align_union(stored, extract_window(fresh, ts, since, until))


def incremental_derive(stored: DataFrame, parents: dict[str, DataFrame], recipe: Callable[..., DataFrame],
                       keys: Sequence[str], ts: str = "start_date", parent_ts: str | None = None,
                       lookback: str | None = None, fresh: DataFrame | None = None) -> DataFrame:
    """Derived update (SRC13, fixing [Q-20]): per key, stored rows before a cut are kept and the rest is derived
    anew from the parents' rows from the cut on.

    The cut is the last stored start. With ``fresh``, the parent rows that arrived since, it is the last
    stored start at or before the key's earliest fresh row, so late rows are derived in their place; keys
    without fresh rows are kept whole and not read again. With a look-back at least as long as the recipe's
    context before a row, the result equals a full recompute. The cut table has one row per key.
    """
    pts = parent_ts or ts
    keys = list(keys)
    newest = F.max(ts)
    if fresh is not None:
        first = fresh.groupBy(*keys).agg(F.min(pts).alias("__first"))
        known = stored.join(first, on=keys, how="inner").groupBy(*keys, "__first").agg(
            F.max(F.when(F.col(ts) <= F.col("__first"), F.col(ts))).alias("__last"))
        cut = first.join(known.drop("__first"), on=keys, how="left").select(
            *keys, F.coalesce("__last", "__first").alias("__cut"))
    else:
        cut = stored.groupBy(*keys).agg(newest.alias("__cut"))
    start = F.col("__cut") - F.expr(f"INTERVAL {lookback}") if lookback else F.col("__cut")
    sliced = {}
    for name, p in parents.items():
        if pts in p.columns and all(k in p.columns for k in keys):
            j = p.join(cut, on=keys, how="left" if fresh is None else "inner")
            sliced[name] = j.where(F.col("__cut").isNull() | (F.col(pts) >= start)).drop("__cut")
        else:
            sliced[name] = p
    redo = recipe(**sliced).select(*stored.columns).join(cut, on=keys, how="left") \
        .where(F.col("__cut").isNull() | (F.col(ts) >= F.col("__cut"))).select(*stored.columns)
    keep = stored.join(cut, on=keys, how="left")
    untouched = F.lit(fresh is not None) & F.col("__cut").isNull()
    return keep.where(untouched | (F.col(ts) < F.col("__cut"))).select(*stored.columns).unionByName(redo)


# ---------------------------------------------------------------- registry and load (UD1, SRC8, SRC11-SRC20)

WINDOW, BUCKET = "__window", "__bucket"
REGISTRY_SCHEMA = T.StructType([
    T.StructField("domain", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("function", T.StringType()),
    T.StructField("parents", T.ArrayType(T.StringType())), T.StructField("keys", T.ArrayType(T.StringType())),
    T.StructField("ts", T.StringType()), T.StructField("lookback_hours", T.DoubleType()),
    T.StructField("format", T.StringType()), T.StructField("path", T.StringType()), T.StructField("schema", T.StringType())])
_REGISTERED = T.StructType([*REGISTRY_SCHEMA.fields, T.StructField("registered_at", T.TimestampNTZType()),
                            T.StructField("dropped", T.BooleanType())])
CHANGES_SCHEMA = T.StructType([
    T.StructField("domain", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("written_at", T.TimestampNTZType()), T.StructField("buckets", T.ArrayType(T.IntegerType()))])


@dataclass
class Recipe:
    """``fn(**parents)``. With ``keys``, the rows of a key value depend on no parent rows of other key values (parents
    without these keys are context and read in whole), so an update derives only the touched key buckets anew."""
    domain: str
    name: str
    parents: tuple[tuple[str, str], ...]
    fn: Callable[..., DataFrame]
    keys: tuple[str, ...] = ()


@dataclass
class Source:
    """``fn(spark)``. With ``ts``, its time column, the dataset is stored by windows of ``window`` and an update fetches
    from ``lookback`` before the last fetch's bound on."""
    fn: Callable[..., DataFrame]
    ts: str | None = None
    keys: tuple[str, ...] = ()
    lookback: dt.timedelta = dt.timedelta(0)
    window: dt.timedelta = dt.timedelta(days=1)


@dataclass
class Catalog:
    """Datasets under ``root/{domain}/{dataset}``, a manifest of written versions and a registry of recipes and sources.

    ``load`` reads the latest stored version; a dataset without one is built and stored first. Names are
    case-insensitive. A build writes a new folder. An update of a source with a time column replaces the windows that
    changed, an update of a keyed recipe the key buckets that changed; all other files stay as they are. The manifest, the
    log of changes and the stored registry only grow by small files of their own folder each, so threads and sessions
    do not disturb one another: a delete appends a row without path. A catalogue reads the stored registry on start.
    """

    spark: SparkSession
    root: str
    recipes: dict[tuple[str, str], Recipe] = field(default_factory=dict)
    sources: dict[tuple[str, str], Source] = field(default_factory=dict)
    buckets: int = 64

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        for row in self.registry().collect():      # one row per dataset
            self._adopt(row)

    def recipe(self, domain: str, name: str, parents: Sequence[tuple[str, str]] = (), keys: Sequence[str] = ()):
        """Decorator registering ``fn(**parents) -> DataFrame`` as ``domain.name`` (UD1)."""
        def deco(fn):
            key = _key(domain, name)
            self.recipes[key] = Recipe(*key, tuple((p.lower(), d.lower()) for p, d in parents), fn, tuple(keys))
            return fn
        return deco

    def source(self, domain: str, name: str, ts: str | None = None, keys: Sequence[str] = (),
               lookback: dt.timedelta = dt.timedelta(0), window: dt.timedelta = dt.timedelta(days=1)):
        """Decorator registering ``fn(spark)`` as a source; with ``ts``, its time column, updates fetch only the time
        from ``lookback`` before the last fetch's bound on (to the start of its window)."""
        def deco(fn):
            self.sources[_key(domain, name)] = Source(fn, ts, tuple(keys), lookback, window)
            return fn
        return deco

    # -- stored registry (SRC14, SRC20)
    def registry(self) -> DataFrame:
        """The stored registry: the latest specification of every dataset that was not dropped since."""
        rows = self._small_table("_registry", _REGISTERED)
        return manifest_latest(rows, written_at="registered_at").where("NOT dropped").select(*REGISTRY_SCHEMA.names)

    def register(self, specs: DataFrame) -> int:
        """Stores specifications (rows of ``REGISTRY_SCHEMA``; absent columns are null); they replace earlier ones of the
        same dataset. ``function`` is ``module:name``; parents are written ``domain.dataset``. A source has a function of
        the session or a ``format`` and ``path`` (and a ``schema`` as DDL). Returns the number of datasets."""
        given = set(specs.columns)
        rows = specs.select(*[(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
                              for f in REGISTRY_SCHEMA.fields])
        rows = rows.withColumn("domain", F.lower("domain")).withColumn("dataset", F.lower("dataset")).where(
            "domain IS NOT NULL AND dataset IS NOT NULL").dropDuplicates(["domain", "dataset"])
        rows = rows.withColumn("kind", F.coalesce("kind", F.when(F.size(F.coalesce("parents", F.array())) > 0, "recipe")
                                                  .otherwise("source"))).collect()
        if rows:
            now = _now()
            self._append("_registry", [(*r, now, False) for r in rows], _REGISTERED)
        for r in rows:
            self._adopt(r)
        return len(rows)

    def rebuild_registry(self, spec_files: Sequence[str] | str) -> int:
        """The registry anew from files of specifications, one JSON object each line (SRC20). Stored datasets that no
        specification names are dropped from the registry; their data stays until it is swept."""
        specs = self.spark.read.schema(REGISTRY_SCHEMA).json(spec_files)
        old = {(r.domain, r.dataset) for r in self.registry().collect()}
        n = self.register(specs)
        named = {(r.domain, r.dataset) for r in specs.select(F.lower("domain").alias("domain"), F.lower("dataset").alias("dataset"))
                 .distinct().collect()}
        self._drop(old - named)
        return n

    def _drop(self, keys) -> None:
        if keys:
            now = _now()
            rows = [(d, n, *[None] * (len(REGISTRY_SCHEMA) - 2), now, True) for d, n in sorted(keys)]
            self._append("_registry", rows, _REGISTERED)
        for k in keys:
            self.recipes.pop(k, None)
            self.sources.pop(k, None)

    def _adopt(self, r) -> None:
        key, keys = _key(r["domain"], r["dataset"]), tuple(r["keys"] or ())
        self.recipes.pop(key, None)
        self.sources.pop(key, None)
        if r["kind"] == "recipe":
            parents = tuple(tuple(reversed(p.lower().split(".", 1))) for p in r["parents"] or ())
            self.recipes[key] = Recipe(*key, parents, _Named(r["function"]), keys)
        else:
            fn = _Named(r["function"]) if r["function"] else _FileSource(r["format"] or "parquet", r["path"], r["schema"])
            self.sources[key] = Source(fn, r["ts"], keys, dt.timedelta(hours=r["lookback_hours"] or 0))

    # -- small tables of the catalogue
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _folders(self, path: str) -> list[tuple[str, int]]:
        """(path, time of last change in ms) of the folders in a folder."""
        fs, p = self._fs(path)
        return [(f"{path}/{s.getPath().getName()}", s.getModificationTime()) for s in fs.listStatus(p) if s.isDirectory()] \
            if fs.exists(p) else []

    def _small_table(self, name: str, schema: T.StructType) -> DataFrame:
        fs, p = self._fs(f"{self.root}/{name}")
        if not fs.exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.root}/{name}")

    def _append(self, name: str, rows: list[tuple], schema: T.StructType) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{self.root}/{name}/{uuid.uuid4().hex}")

    def manifest(self) -> DataFrame:
        return self._small_table("_manifest", MANIFEST_SCHEMA)

    def changes(self) -> DataFrame:
        """What updates touched: per write the key buckets, null for all of them."""
        return self._small_table("_changes", CHANGES_SCHEMA)

    def catalog(self) -> DataFrame:
        rows = [(d, n) for (d, n) in list(self.recipes) + list(self.sources)]
        return self.spark.createDataFrame(rows, CATALOG_SCHEMA)

    def path(self, domain: str, name: str) -> str:
        return f"{self.root}/{domain.lower()}/{name.lower()}"

    def _latest(self, domain: str, name: str):
        m = self.manifest().where((F.col("domain") == domain) & (F.col("dataset") == name))
        rows = manifest_latest(m).collect()  # at most one row per dataset
        return rows[0] if rows and rows[0]["path"] is not None else None

    def _record(self, key: tuple[str, str], since, until, path: str | None, schema: str | None = None, at=None) -> None:
        self._append("_manifest", [(*key, since, until, at or _now(), path, schema)], MANIFEST_SCHEMA)

    def _log(self, key: tuple[str, str], buckets) -> None:
        """Written before the data, so a write that breaks off still counts as a change for those that read it."""
        self._append("_changes", [(*key, _now(), sorted(buckets) if buckets is not None else None)], CHANGES_SCHEMA)

    # -- stored form
    def _keys(self, key: tuple[str, str]) -> tuple[str, ...]:
        return (self.sources[key] if key in self.sources else self.recipes[key]).keys

    def _laid_out(self, key: tuple[str, str], df: DataFrame) -> tuple[DataFrame, list[str]]:
        """``df`` with its window and bucket columns, and the columns that its files are partitioned by."""
        from homesense.functions.time import epoch_micros
        from homesense.sources.readers import dedupe_columns
        df, keys, by = dedupe_columns(df), self._keys(key), []
        source = self.sources.get(key)
        if source and source.ts:
            width = int(source.window.total_seconds() * 1_000_000)
            df, by = df.withColumn(WINDOW, F.floor(epoch_micros(source.ts) / F.lit(width)).cast("long")), [WINDOW]
        if keys:
            named = F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys])
            df = df.withColumn(BUCKET, F.pmod(named, F.lit(self.buckets)).cast("int"))
            by = by or [BUCKET]
        return df, by

    def _write(self, df: DataFrame, by: list[str], path: str, mode: str, compression: str = "gzip") -> None:
        if by:      # files of a sensible size: small windows together in a task, large ones over several
            df = df.hint("rebalance", *by)
            df = df.sortWithinPartitions(*by, *[c for c in (BUCKET,) if c in df.columns and c not in by])
        w = df.write.mode(mode).option("compression", compression).option("partitionOverwriteMode", "dynamic")
        (w.partitionBy(*by) if by else w).parquet(path)

    def _read(self, row, internal: bool = False) -> DataFrame:
        r = self.spark.read
        df = (r.schema(T.StructType.fromJson(json.loads(row["schema"]))) if row["schema"] else r).parquet(row["path"])
        return df if internal else df.drop(WINDOW, BUCKET)

    def _store(self, key: tuple[str, str], df: DataFrame, since, until, compression: str = "gzip", at=None, touched=None) -> str:
        """A new version of the whole dataset; ``touched`` are the buckets in which it differs, if that is known."""
        at = at or _now()
        df, by = self._laid_out(key, df)
        path = f"{self.path(*key)}/v={_now().strftime('%Y%m%dT%H%M%S%f')}"
        self._log(key, touched)
        self._write(df, by, path, "overwrite", compression)
        self._record(key, since, until, path, df.schema.json(), at)
        return path

    # -- load and update (SRC8, SRC11, SRC13)
    def load(self, name: str, domain: str, update: bool = False, reload: bool = False, reapply: bool = False,
             since: dt.datetime | None = None, until: dt.datetime | None = None, delay_hours: float = 1,
             _done: set | None = None) -> DataFrame:
        """The dataset ``domain.name`` (SRC11), read from its stored version.

        Without a stored version, with ``reload`` or with ``reapply`` it is built and stored: a source is read (with a
        time column: ``since <= ts < until`` and rows without a time), a recipe applied to its loaded parents (which
        ``reload`` builds anew, too). With ``update`` a version whose fetch bound plus the delay lies before ``until``
        (default now) is brought up to date: sources by their windows (see ``_update_source``), recipes by the buckets
        that their updated parents touched (see ``_update_recipe``). Each dataset is treated once per call.
        """
        key = _key(domain, name)
        if key not in self.recipes and key not in self.sources:
            raise KeyError(f"unknown dataset {domain}.{name}")
        done = set() if _done is None else _done
        until = until or _now()
        latest = self._latest(*key)
        fresh = latest is not None and latest["until"] is not None \
            and latest["until"] + dt.timedelta(hours=delay_hours) >= until
        keep = latest is not None and not (reload or reapply) and (not update or fresh)
        if key in done or keep:
            return self._read(latest)
        done.add(key)
        build = latest is None or reload or reapply
        if key in self.sources:
            if build or latest["until"] is None:
                self._build_source(key, since or (latest["since"] if latest else None), until)
            elif not self.sources[key].ts:
                self._reread_source(key, latest, until)
            else:
                self._update_source(key, latest, until)
        else:
            for (p, d) in self.recipes[key].parents:
                self.load(p, d, update, reload, False, since, until, delay_hours, done)
            at = _now()
            if build:
                self._build_recipe(key, since or (latest["since"] if latest else None), until, at)
            else:
                self._update_recipe(key, latest, until)
        return self._read(self._latest(*key))

    def _build_source(self, key: tuple[str, str], since, until, compression: str = "gzip") -> str:
        source = self.sources[key]
        data = source.fn(self.spark)
        if source.ts:
            data = data.where(_within(data, source.ts, since, until))
        return self._store(key, data, since, until, compression)

    def _build_recipe(self, key: tuple[str, str], since, until, at, compression: str = "gzip") -> str:
        r = self.recipes[key]
        parents = {p: self._read(self._latest(d, p)) for (p, d) in r.parents}
        return self._store(key, r.fn(**parents), since, until, compression, at)

    def _reread_source(self, key: tuple[str, str], latest, until) -> None:
        """Reads a source without a time column again; the stored version stays if it has the same rows."""
        data = staged(self._laid_out(key, self.sources[key].fn(self.spark))[0], "catalog-fetch")
        stored, touched = self._read(latest, internal=True), None
        if sorted(stored.dtypes) == sorted(data.dtypes):
            was, now = (_digest(x, data.columns) for x in (stored, data))
            touched = {b for k in was.keys() | now.keys() if was.get(k) != now.get(k) for b in k[1:]}
            if not touched:
                self._record(key, latest["since"], until, latest["path"], latest["schema"])
                return
        self._store(key, data.drop(BUCKET), latest["since"], until, touched=touched if self.sources[key].keys else None)

    def _update_source(self, key: tuple[str, str], latest, until) -> None:
        """Fetches from the start of the window that holds the last bound less the look-back, and every row without a
        time. Per window and bucket, number and checksum of the fetched rows are compared with the stored ones; windows
        that differ are replaced as a whole, all others keep their files. So a late row within the look-back comes in, none
        is doubled, and an update that is repeated finds nothing to do. A window that lost all its rows goes. If the
        columns or types have changed, a new version with the stored rows aligned to them is written."""
        source = self.sources[key]
        width = source.window.total_seconds()
        first = int(((latest["until"] - source.lookback) - _EPOCH).total_seconds() // width)
        since = _EPOCH + dt.timedelta(seconds=first * width)
        data = source.fn(self.spark)
        fresh, by = self._laid_out(key, data.where(_within(data, source.ts, since, until)))
        stored = self._read(latest, internal=True)
        again = F.coalesce(F.col(WINDOW) >= first, F.lit(True)) if WINDOW in stored.columns else None
        fresh = staged(fresh, "catalog-fetch")
        if again is None or sorted(stored.dtypes) != sorted(fresh.dtypes):
            from homesense.sources.readers import align_union
            old = stored.where(~again).drop(WINDOW, BUCKET) if again is not None \
                else stored.where(~_within(stored, source.ts, since, None)).drop(BUCKET)
            self._store(key, align_union(old, fresh.drop(WINDOW, BUCKET)), latest["since"], until)
            return
        was, now = (_digest(x, fresh.columns) for x in (stored.where(again), fresh))
        differ = {k for k in was.keys() | now.keys() if was.get(k) != now.get(k)}
        if differ:
            windows = {w for w, _ in differ}
            self._log(key, {b for _, b in differ} if source.keys else None)
            chosen = F.col(WINDOW).isin([w for w in windows if w is not None])
            chosen = F.coalesce(chosen, F.lit(None in windows))
            self._write(fresh.where(chosen), by, latest["path"], "overwrite")
            for w in windows - {w for w, _ in now}:
                self._remove(f"{latest['path']}/{WINDOW}={'__HIVE_DEFAULT_PARTITION__' if w is None else w}")
        self._record(key, latest["since"], until, latest["path"], latest["schema"])

    def _touched(self, r: Recipe, since) -> set[int] | None:
        """The buckets of ``r`` whose parent rows changed after ``since``; None for all."""
        named = F.struct("dataset", "domain").isin([F.struct(F.lit(p).alias("dataset"), F.lit(d).alias("domain")) for p, d in r.parents])
        rows = self.changes().where(named & (F.col("written_at") > F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))) \
            .select("domain", "dataset", F.explode_outer("buckets").alias("bucket")).distinct().collect()  # parents x buckets
        out = set()
        for row in rows:
            if row["bucket"] is None or not r.keys or self._keys((row["domain"], row["dataset"])) != r.keys:
                return None
            out.add(row["bucket"])
        return out

    def _update_recipe(self, key: tuple[str, str], latest, until) -> None:
        """Derives the touched key buckets anew from the parents' rows in them and replaces their files (SRC13). Equal to
        a full recompute; a change that no key limits rebuilds the dataset."""
        r, at = self.recipes[key], _now()
        touched = self._touched(r, latest["written_at"]) if r.parents else None
        bucketed = bool(r.keys) and latest["schema"] is not None and f'"{BUCKET}"' in latest["schema"]
        if touched is None or (touched and not bucketed):
            self._build_recipe(key, latest["since"], until, at)
            return
        if touched:
            chosen, parents = F.col(BUCKET).isin(sorted(touched)), {}
            for (p, d) in r.parents:
                df = self._read(self._latest(d, p), internal=True)
                parents[p] = (df.where(chosen) if BUCKET in df.columns and self._keys((d, p)) == r.keys else df).drop(WINDOW, BUCKET)
            out, by = self._laid_out(key, r.fn(**parents))
            out = out.where(chosen)
            if sorted(out.dtypes) != sorted(self._read(latest, internal=True).dtypes):
                self._build_recipe(key, latest["since"], until, at)
                return
            seen = Observation()
            out = out.observe(seen, *[F.count_if(F.col(BUCKET) == b).alias(f"b{b}") for b in sorted(touched)])
            self._log(key, touched)
            self._write(out, by, latest["path"], "overwrite")
            found = seen.get
            for b in touched:
                if not found[f"b{b}"]:
                    self._remove(f"{latest['path']}/{BUCKET}={b}")
        self._record(key, latest["since"], until, latest["path"], latest["schema"], at)

    def _remove(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def materialise(self, name: str, domain: str, since=None, until=None, compression: str = "gzip") -> str:
        """Builds the dataset from its stored parents (built first where they are missing) and writes a new
        version (SRC12, SRC4)."""
        key = _key(domain, name)
        if key in self.sources:
            return self._build_source(key, since, until or _now(), compression)
        if key not in self.recipes:
            raise KeyError(f"unknown dataset {domain}.{name}")
        for (p, d) in self.recipes[key].parents:
            self.load(p, d)
        at = _now()
        return self._build_recipe(key, since, until or at, at, compression)

    # -- whole domains (SRC16, SRC17)
    def refresh_domain(self, domain: str) -> list[str]:
        """New versions of every dataset of a domain in dependency order, sources included (SRC17); each is built
        once, from its parents' latest versions."""
        domain = domain.lower()
        order = [k for level in self.levels([k for k in [*self.sources, *self.recipes] if k[0] == domain]) for k in level]
        return [self.materialise(n, d) for (d, n) in order if d == domain]

    def levels(self, keys: Sequence[tuple[str, str]]) -> list[list[tuple[str, str]]]:
        """The datasets and all they derive from, by depth: no dataset derives from one of its own level."""
        depth: dict[tuple[str, str], int] = {}

        def visit(k, path=()) -> int:
            if k in path:
                raise ValueError(f"{k} derives from itself")
            if k not in depth:
                parents = [(d, p) for p, d in self.recipes[k].parents] if k in self.recipes else []
                depth[k] = 1 + max((visit(p, (*path, k)) for p in parents), default=-1)
            return depth[k]

        for k in keys:
            visit(k)
        return [[k for k, n in depth.items() if n == level] for level in range(max(depth.values(), default=-1) + 1)]

    def update_domain(self, domain: str, workers: int = 4, until: dt.datetime | None = None, delay_hours: float = 1) -> dict:
        """Brings every stored dataset of a domain, and all it derives from, up to date (SRC16): level by level, the
        datasets of a level at the same time from up to ``workers`` threads, each in a scheduler pool of its own (with
        ``spark.scheduler.mode`` FAIR they share the cluster). A dataset that fails stops those that derive from it
        and no other. Returns per (domain, dataset) None, or what went wrong."""
        domain, until, done = domain.lower(), until or _now(), set()
        keys = [k for k in [*self.sources, *self.recipes] if k[0] == domain and self._latest(*k) is not None]
        state: dict[tuple[str, str], Exception | None] = {}
        for level in self.levels(keys):
            todo = []
            for k in level:
                bad = [p for p in (self.recipes[k].parents if k in self.recipes else ()) if state.get((p[1], p[0]))]
                if bad:
                    state[k] = RuntimeError(f"not updated: {bad[0][1]}.{bad[0][0]} failed")
                else:
                    todo.append(k)
            waiting = iter(todo)
            lock = threading.Lock()

            def work(pool: str) -> None:
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
                while True:
                    with lock:
                        k = next(waiting, None)
                    if k is None:
                        return
                    try:
                        self.load(k[1], k[0], update=True, until=until, delay_hours=delay_hours, _done=done)
                        state[k] = None
                    except Exception as e:      # kept for the caller; siblings go on
                        state[k] = e

            threads = [InheritableThread(target=work, args=(f"catalog-{n}",)) for n in range(min(workers, len(todo)))]
            for t in threads:
                t.start()
            for t in threads:
                t.join()
        return state

    # -- removal (SRC18, SRC19)
    def delete(self, name: str | None, domain: str, confirm: bool = False) -> None:
        """Delete a dataset's stored versions (or with ``name`` None a whole domain's) and its registration (SRC18)."""
        if not confirm:
            raise ValueError("pass confirm=True to delete")
        if not _plain(domain) or not (name is None or _plain(name)):
            raise ValueError(f"not a dataset: {domain!r}, {name!r}")
        domain = domain.lower()
        gone = [k for k in [*self.recipes, *self.sources] if k[0] == domain and (name is None or k[1] == name.lower())]
        self._remove(self.path(domain, name) if name else f"{self.root}/{domain}")
        stored = {(r.domain, r.dataset) for r in self.registry().collect()}
        for k in gone:
            if self._latest(*k) is not None:
                self._record(k, None, None, None)
            self.recipes.pop(k, None)
            self.sources.pop(k, None)
        self._drop(stored & set(gone))

    def sweep(self, dry_run: bool = True, min_age_hours: float = 24.0, stages: str | None = None) -> list[tuple[str, str]]:
        """Removes what no latest manifest row reaches (SRC19): versions of datasets that are not registered, versions
        that a later one replaced, and folders without a manifest row (broken-off writes) older than ``min_age_hours``. With
        ``stages``, the shared folder of intermediate tables, those older than that go, too. Only folders of the form
        that this library writes are looked at. Returns (path, reason); nothing is removed in a dry run."""
        live, known = {}, set()
        for r in manifest_latest(self.manifest()).collect():       # one row per dataset
            live[(r["domain"], r["dataset"])] = r["path"]
        known = {r.path for r in self.manifest().select("path").distinct().collect()}
        limit = (_now() - _EPOCH - dt.timedelta(hours=min_age_hours)).total_seconds() * 1000
        out = []
        for d, _ in self._folders(self.root):
            domain = d.rsplit("/", 1)[1]
            for n, _ in self._folders(d) if _plain(domain) else []:
                dataset = n.rsplit("/", 1)[1]
                for v, changed in self._folders(n) if _plain(dataset) else []:
                    if not re.fullmatch(r"v=\d{8}T\d{12}", v.rsplit("/", 1)[1]):
                        continue
                    if (domain, dataset) not in self.recipes and (domain, dataset) not in self.sources:
                        out.append((v, "not registered"))
                    elif v not in known:
                        out += [(v, "broken off")] if changed < limit else []
                    elif live.get((domain, dataset)) != v:
                        out.append((v, "replaced"))
        for f, changed in self._folders(stages.rstrip("/")) if stages else []:
            if re.fullmatch(r"[A-Za-z_-]+-[0-9a-f]{32}", f.rsplit("/", 1)[1]) and changed < limit:
                out.append((f, "intermediate"))
        if not dry_run:
            for path, _ in out:
                self._remove(path)
        return out


_EPOCH = dt.datetime(1970, 1, 1)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _key(domain: str, name: str) -> tuple[str, str]:
    return domain.lower(), name.lower()


def _plain(name: str | None) -> bool:
    """A name that is one folder: not empty, hidden, or a way up."""
    return bool(name) and re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9 ._-]*", name) is not None


def _within(df: DataFrame, ts: str, since: dt.datetime | None, until: dt.datetime | None) -> Column:
    """``since <= ts < until`` or no time; the bounds are UTC wall times, whatever the session's zone."""
    kind = df.schema[ts].dataType

    def bound(t: dt.datetime) -> Column:
        if isinstance(kind, T.TimestampType):
            return F.timestamp_micros(F.lit((t - _EPOCH) // dt.timedelta(microseconds=1)))
        return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz").cast(kind)

    inside = F.lit(True)
    if since is not None:
        inside = inside & (F.col(ts) >= bound(since))
    if until is not None:
        inside = inside & (F.col(ts) < bound(until))
    return F.col(ts).isNull() | inside


def _digest(df: DataFrame, columns: Sequence[str]) -> dict[tuple, tuple]:
    """(window, bucket) -> number of rows and sum of their 64-bit hashes: one row per window and bucket."""
    row = F.xxhash64(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in sorted(columns)])
    by = [(F.col(WINDOW) if WINDOW in columns else F.lit(0)).alias("w"), (F.col(BUCKET) if BUCKET in columns else F.lit(0)).alias("b")]
    return {(r.w, r.b): (r.n, r.h) for r in
            df.groupBy(*by).agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("h")).collect()}


@dataclass(frozen=True)
class _Named:
    """A function named ``module:name``, imported when it is called."""
    name: str

    def __call__(self, *args, **kwargs):
        module, _, path = self.name.partition(":")
        found = importlib.import_module(module)
        for part in path.split("."):
            found = getattr(found, part)
        return found(*args, **kwargs)


@dataclass(frozen=True)
class _FileSource:
    format: str
    path: str
    ddl: str | None

    def __call__(self, spark: SparkSession) -> DataFrame:
        if self.format == "export_csv":
            from homesense.sources.readers import read_export_csv
            return read_export_csv(spark, self.path, T.StructType.fromDDL(self.ddl))
        r = spark.read.format(self.format)
        return (r.schema(self.ddl) if self.ddl else r).load(self.path)
