"""Benchmark decontamination by winnowing, in DataFrame functions only.

The hash of every K-word gram of a text is taken, and of every W consecutive hashes the smallest is kept
(leftmost on ties). Two texts that share a span of ``SPAN = K + W - 1`` words keep the same gram within it, so
joining the kept fingerprints of documents and benchmark items misses no shared span. Each hit is extended to
the windows of SPAN words around it, which are compared word by word with the items' windows. Items shorter
than SPAN words are one window each; for each such length that occurs, documents keep all grams of it.

A text becomes one array of gram hashes; one row per window then picks the smallest in generated code. ``let``
binds a value to a lambda variable, as the optimiser would otherwise copy the expression into the loop that
uses it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homesense.llm.common import row_key, small, stage

SPAN = 13
K = 7
W = SPAN - K + 1
SHARE = 20          # contaminated: at least one word in SHARE is hit

_UPPER = "".join(map(chr, range(65, 91)))
_OTHER = "".join(chr(c) for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c == 32))


def words(text: str = "text") -> Column:
    """Lower-cased (A-Z) runs of digits, ASCII letters and non-ASCII characters; none for null."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER + _OTHER, _UPPER.lower() + " " * len(_OTHER))
    return F.array_remove(F.split(plain, " "), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _grams(ws: Column, size: int) -> Column:
    """Hashes of all grams of ``size`` words, in order."""
    none = F.array().cast("array<bigint>")
    return let(F.transform(ws, lambda x: F.xxhash64(x)), lambda hs: F.when(F.size(hs) >= size, F.transform(
        F.sequence(F.lit(1), F.size(hs) - (size - 1)), lambda i: F.xxhash64(F.slice(hs, i, size)))).otherwise(none))


def _all_grams(rows: DataFrame, size: int) -> DataFrame:
    """(row_id, h, pos, size) of all grams of ``size`` words; ``rows`` has row_id and ws; pos starts at 0."""
    return rows.select("row_id", F.posexplode(_grams(F.col("ws"), size)).alias("pos", "h")).select(
        "row_id", "h", "pos", F.lit(size).alias("size"))


def winnowed(rows: DataFrame) -> DataFrame:
    """(row_id, h, pos, size) of the kept grams; ``rows`` has row_id and ws.

    A window's pick is new if the window is the first one, if its last gram is smaller than the others, or if
    the gram that left was the pick before.
    """
    grams = rows.select("row_id", _grams(F.col("ws"), K).alias("gs")).filter(F.size("gs") >= W)
    at = grams.select("row_id", "gs", F.explode(F.sequence(F.lit(0), F.size("gs") - W)).alias("i"))
    new, low, place = _pick()
    return at.filter(new).select("row_id", low.alias("h"), (F.col("i") + place).alias("pos"), F.lit(SPAN).alias("size"))


def _pick() -> tuple[Column, Column, Column]:
    """Of the window of ``W`` grams that begins at ``i`` in ``gs``: whether its pick is new, the pick, and its place."""
    g = [F.get("gs", F.col("i") + j) for j in range(W)]
    left, inner = F.get("gs", F.col("i") - 1), F.least(*g[:-1])
    low = F.least(*g)
    place = F.lit(W - 1)
    for j in range(W - 2, -1, -1):
        place = F.when(g[j] == low, F.lit(j)).otherwise(place)
    return (F.col("i") == 0) | (g[-1] < inner) | (left <= inner), low, place


def fingerprints(rows: DataFrame, short: list[int]) -> DataFrame:
    """Kept grams of the rows' texts, with all grams of the given short sizes besides: one pass over the texts, one row per
    word, from which the window's pick (if it is new) and the grams that start there are taken."""
    if not short:
        return winnowed(rows)
    hashed = rows.select("row_id", F.transform("ws", lambda x: F.xxhash64(x)).alias("hs"), _grams(F.col("ws"), K).alias("gs"))
    at = hashed.filter(F.size("hs") > 0).select("row_id", "hs", "gs", F.explode(F.sequence(F.lit(0), F.size("hs") - 1)).alias("i"))

    def kept(when: Column, h: Column, pos: Column, size: int) -> Column:
        return F.when(when, F.struct(h.alias("h"), pos.alias("pos"), F.lit(size).alias("size")))

    new, low, place = _pick()
    inside = F.col("i") + W <= F.size("gs")
    found = [kept(inside & new, low, F.col("i") + place, SPAN)]
    found += [kept(F.col("i") + n <= F.size("hs"), F.xxhash64(F.slice("hs", F.col("i") + 1, n)), F.col("i"), n) for n in short]
    return at.select("row_id", F.explode(F.array_compact(F.array(*found))).alias("x")).select("row_id", "x.*")


def _window_text(ws: Column, start: Column, size: Column) -> Column:
    return F.concat_ws(" ", F.slice(ws, start, size))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row_id, n_words, n_hit, n_items, item_ids, contaminated for every row of ``docs``.

    Null or empty texts have no words and are not contaminated; items without words match nothing. ``item_ids``
    are the distinct ids, as text and sorted, of items of which a window occurs (null ids hit words but are not
    listed). A document is contaminated if it has hits and they are at least one in ``SHARE`` of its words.
    Repeated rows give repeated results; an empty table gives an empty one, an empty benchmark no hits.
    """
    items = stage(benchmark.select(F.col("item_id").cast("string").alias("item_id"), words().alias("ws"), "text")
                  .filter(F.size("ws") > 0), "bench-items")
    n = F.size("ws")
    short = sorted(r.n for r in items.filter(n < SPAN).select(n.alias("n")).distinct().collect())
    named = items.select(F.xxhash64("item_id", "text").alias("row_id"), "ws")
    own = winnowed(named)
    for size in short:
        own = own.union(_all_grams(named.filter(F.size("ws") == size), size))
    prints = stage(own.select("h", "size").distinct(), "bench-prints")
    size = F.least(n, F.lit(SPAN))
    windows = stage(items.select("item_id", size.alias("size"), F.explode(F.transform(
        F.sequence(F.lit(1), n - size + 1), lambda i: _window_text(F.col("ws"), i, size))).alias("window"))
        .groupBy("size", "window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .withColumn("set_id", F.xxhash64("items")), "bench-windows")

    rows = docs.select("doc_id", "text", row_key().alias("row_id"))
    kept = fingerprints(rows.select("row_id", words().alias("ws")), short)
    hits = kept.join(small(prints), ["h", "size"], "left_semi")
    first = F.col("pos") + 1    # array positions start at 1
    reach = F.when(F.col("size") == SPAN, F.sequence(first - (W - 1), first)).otherwise(F.array(first))
    starts = stage(hits.select("row_id", "size", F.explode(reach).alias("start")).filter("start > 0")
                   .groupBy("row_id").agg(F.collect_set(F.struct("start", "size")).alias("starts")), "bench-hits")
    near = rows.dropDuplicates(["row_id"]) if not _unique(rows, starts) else rows
    seen = near.join(small(starts), "row_id").select("row_id", F.explode(let(words(), lambda ws: F.transform(
        F.filter("starts", lambda s: s["start"] + s["size"] - 1 <= F.size(ws)),
        lambda s: F.struct(s["start"].alias("start"), s["size"].alias("size"),
                           _window_text(ws, s["start"], s["size"]).alias("window"))))).alias("w")).select("row_id", "w.*")
    found = stage(seen.join(small(windows.select("size", "window", "set_id")), ["size", "window"])
                  .select("row_id", "start", "size", "set_id"), "bench-found")
    spans = found.groupBy("row_id").agg(F.array_sort(F.collect_set(
        F.struct("start", (F.col("start") + F.col("size")).alias("stop")))).alias("spans"))
    n_hit = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], a["end"]))).alias("n"),
        F.greatest(a["end"], x["stop"]).alias("end")), lambda a: a["n"])
    sets = windows.select("set_id", "items").distinct()
    listed = (found.select("row_id", "set_id").distinct().join(sets, "set_id")
              .select("row_id", F.explode("items").alias("item")).groupBy("row_id")
              .agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    result = spans.select("row_id", n_hit.alias("n_hit")).join(listed, "row_id", "left")
    counted = docs.select("doc_id", row_key().alias("row_id"), F.size(words()).cast("long").alias("n_words"))
    no_items = F.array().cast("array<string>")
    return counted.join(result, "row_id", "left").select(
        "doc_id", "row_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", no_items).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) * SHARE >= F.greatest(F.col("n_words"), F.lit(1))).alias("contaminated"))


def _unique(rows: DataFrame, starts: DataFrame) -> bool:
    """Whether no hit row occurs twice; only then can the texts be joined without removing repeats."""
    return rows.select("row_id").join(small(starts.select("row_id")), "row_id", "left_semi") \
        .groupBy("row_id").count().filter("count > 1").isEmpty()
