"""Language identification with a string kernel.

Two texts are compared by the blended-spectrum presence kernel: the number of distinct byte n-grams
(n = 1..3, blended) that both hold, divided by the geometric mean of their own numbers. Landmark texts span
the Nyström feature space, one-versus-rest kernel ridge regression is solved in it, and new texts are scored
by batched products of their n-gram presence matrix with the dual weights folded over the landmarks. N-grams
are those of the landmarks; letters are lower-cased and ASCII non-letters count as spaces.

The model is fitted on the driver from a sample bounded by ``SAMPLE`` texts of at most ``SAMPLE_CHARS``
characters each (of a language that has none so short, its shortest ones), drawn with equal expected shares per
language; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homesense.llm.common import row_key, small, stage, text_bytes

SAMPLE = 1200
SAMPLE_CHARS = 20_000
LONG_CHARS = 10_000_000     # of a label that has longer texts only
LANDMARKS = 240
RIDGE = 1.0
BATCH_BYTES = 400_000
PIECE = 250_000
UNKNOWN = "und"

_CLEAN = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


class GramIndex:
    """Columns of the known n-grams. Two tables, of which one holds a gram (cuckoo hashing), take some hundred kB in
    place of an array over all 2**24 grams of three bytes, and a look-up is two reads."""

    def __init__(self, grams: np.ndarray):
        self.shift = np.uint32(32 - max(4, (4 * len(grams)).bit_length()))
        size = 1 << (32 - int(self.shift))
        for seed in range(1000):
            self.mult = np.random.default_rng(seed).integers(1 << 31, 1 << 32, 2, dtype=np.uint32) | np.uint32(1)
            self.column = np.full((2, size), -1, np.int32)
            self.gram = np.zeros((2, size), np.uint32)
            if self._placed(grams.astype(np.uint32)):
                return
        raise RuntimeError("no pair of hash functions found")

    def _placed(self, grams: np.ndarray) -> bool:
        slots = [((grams * m) >> self.shift).tolist() for m in self.mult]
        for k in range(len(grams)):
            side = 0
            for _ in range(100):
                at = slots[side][k]
                k, self.column[side, at] = int(self.column[side, at]), k
                if k < 0:
                    break
                side = 1 - side
            else:
                return False
        for side in (0, 1):
            full = self.column[side] >= 0
            self.gram[side][full] = grams[self.column[side][full]]
        return True

    def __getitem__(self, grams: np.ndarray) -> np.ndarray:
        """The column of every gram, -1 if it is not known."""
        out = np.full(len(grams), -1, np.int32)
        for mult, column, gram in zip(self.mult, self.column, self.gram):
            at = (grams * mult) >> self.shift
            np.copyto(out, column[at], where=(gram[at] == grams) & (column[at] >= 0))
        return out


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray      # sorted n-gram numbers
    weights: np.ndarray    # one column per label

    def table(self) -> GramIndex:
        return GramIndex(self.grams)


def _clean(raw: bytes | None) -> bytes:
    text = (raw or b"").decode("utf-8", "replace").lower().encode()
    return b" " + text.translate(_CLEAN)


def _grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, n-gram number) of all n-grams that start in the first ``PIECE`` bytes of a text, repeats
    included, n by n; three spaces follow each text."""
    joined = np.frombuffer(b"".join(t + b"   " for t in texts), np.uint8).astype(np.uint32)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    row = np.repeat(np.arange(len(texts)), lens + 3)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(lens + 3) - (lens + 3), lens + 3)
    at = np.flatnonzero(pos < np.repeat(np.minimum(lens, PIECE), lens + 3))
    row, value = row[at], np.zeros(len(at), np.uint32)
    for n in range(3):
        value = (value << np.uint32(8)) | joined[at + n]
        yield row, value


def _presence(texts: list[bytes], at: GramIndex, n: int) -> np.ndarray:
    return _presence_and_share(texts, at, n)[0]


def _presence_and_share(texts: list[bytes], at: GramIndex, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which n-grams each text holds, and the known ones' share of its n-grams (repeats counted)."""
    out = np.zeros((len(texts), n), np.float32)
    known, total = np.zeros(len(texts)), np.zeros(len(texts))
    for lo in range(0, max(map(len, texts), default=0), PIECE):  # pieces overlap by two bytes; presence is a union
        for row, value in _grams([t[lo:lo + PIECE + 2] for t in texts]):
            col = at[value]
            hit = col >= 0
            out[row[hit], col[hit]] = 1
            known += np.bincount(row[hit], minlength=len(texts))
            total += np.bincount(row, minlength=len(texts))
    return out, known / np.maximum(total, 1)


def fit(texts: list[bytes], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression, one label against the rest, in the Nyström space of the first texts."""
    names = sorted(set(labels))
    if not names:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32))
    clean = [_clean(t) for t in texts]
    marks = clean[:landmarks]
    grams = np.unique(np.concatenate([np.unique(v) for t in marks for _, v in _grams([t])]))
    model = Model(names, grams, np.zeros((len(grams), len(names)), np.float32))
    at = model.table()

    def unit(batch: list[bytes]) -> np.ndarray:
        x = _presence(batch, at, len(grams))
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    marks_x = unit(marks)
    values, vectors = np.linalg.eigh((marks_x @ marks_x.T).astype(np.float64))
    keep = values > 1e-8 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = np.concatenate([unit(clean[k:k + 100]) @ marks_x.T for k in range(0, len(clean), 100)]).astype(np.float64) @ root
    y = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    solved = np.linalg.solve(z.T @ z + ridge * np.eye(z.shape[1]), z.T @ y)
    model.weights = (marks_x.T.astype(np.float64) @ (root @ solved)).astype(np.float32)
    return model


def score(texts: list[bytes], model: Model, at: GramIndex) -> np.ndarray:
    """One row per text: the regression value of every label (0 where no n-gram is known)."""
    return _values(_presence(texts, at, len(model.grams)), model)


def _values(x: np.ndarray, model: Model) -> np.ndarray:
    return (x @ model.weights) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def _predicted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = model.table()
        for b in batches:
            letters = b.column("letters").to_pylist()
            raw = b.column("raw")
            lang, value, share = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows)
            held, size = [], 0
            for k in range(b.num_rows + 1):
                if k < b.num_rows and letters[k] and model.labels:
                    held.append((k, _clean(raw[k].as_py())))
                    size += len(held[-1][1])
                if held and (k == b.num_rows or size > BATCH_BYTES or len(held) == 64):
                    x, known = _presence_and_share([t for _, t in held], at, len(model.grams))
                    s = _values(x, model)
                    best = s.argmax(axis=1)
                    for (i, _), j, v, f in zip(held, best.tolist(), s.max(axis=1).tolist(), known.tolist()):
                        share[i], lang[i], value[i] = f, model.labels[j], min(1.0, max(0.0, (v + 1) / 2))
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([*[c for c, n in zip(b.columns, b.schema.names) if n not in ("raw", "letters")],
                                              pa.array(lang, pa.string()), pa.array(value), pa.array(share)],
                                             names=[*[n for n in b.schema.names if n not in ("raw", "letters")],
                                                    "lang_pred", "score", "known"])
    return run


def has_letter() -> Column:
    """Whether the text has a letter; false for null."""
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fits on rows with a text that has a letter and a non-null ``lang``. Copies of a text in one language count
    once; a text's chance to be drawn is inverse to its language's number of distinct texts. A hash of the text
    decides, so the sample does not depend on partitioning."""
    lettered = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & has_letter())
    u = F.pmod(F.col("h"), F.lit(1 << 30)) + 1
    rows = stage(lettered.select(row_key().alias("row_id"), "lang", F.xxhash64("text", F.lit(7)).alias("h"), F.length("text").alias("n"))
                 .groupBy("lang", "h").agg(F.min("row_id").alias("row_id"), F.min("n").alias("n"))
                 .select("row_id", "lang", u.alias("u"), "n"), "language-rows")
    drawn = stage(drawable(rows, "lang", sample, sample_chars).withColumn("draw", F.col("u") * F.col("of"))
                  .orderBy("draw", "lang", "row_id").limit(sample).select("row_id", "lang", "draw").distinct(),
                  "language-drawn")     # at most ``sample`` rows: only their texts leave the executors
    drawn = (lettered.select(row_key().alias("row_id"), "lang", text_bytes().alias("raw"))
             .join(F.broadcast(drawn), ["row_id", "lang"]).dropDuplicates(["row_id", "lang"]).collect())
    drawn.sort(key=lambda r: (r.draw, r.lang, r.row_id))
    return fit([r.raw for r in drawn], [r.lang for r in drawn])


def drawable(rows: DataFrame, label: str, sample: int, sample_chars: int) -> DataFrame:
    """The rows (row_id, the label, n: length, h) that may be drawn, with their number per label (``of``): those of at most
    ``sample_chars`` characters. A label that has none is not left out: of its texts the shortest, up to ``sample`` of
    them and ``LONG_CHARS`` characters, one at least, may be drawn."""
    sizes = small(stage(rows.groupBy(label).agg(F.count_if(F.col("n") <= sample_chars).alias("few")), "label-sizes"))
    rows = rows.join(sizes, label)
    short = rows.filter("few > 0").filter(F.col("n") <= sample_chars).withColumn("of", F.col("few"))
    order = Window.partitionBy(label).orderBy("n", "row_id")
    long = rows.filter("few = 0").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample)
    long = long.withColumn("chars", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    long = long.filter((F.col("place") == 1) | (F.col("chars") <= LONG_CHARS)).withColumn(
        "of", F.count("*").over(Window.partitionBy(label))).drop("place", "chars")
    return short.unionByName(long)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, row_id, lang_pred, score, known for every row of ``docs``, from its whole text alone.

    ``lang_pred`` is a learned label, or ``und`` with score 0 if the text is null or has no letter (or nothing
    was learned). ``score`` maps the winning regression value from [-1, 1] to [0, 1], clipped; ties go to the
    label that sorts first. ``known`` is the share of the text's n-grams that the model knows. Very long texts are read in overlapping pieces. Repeated rows give repeated results;
    an empty table gives an empty one.
    """
    return docs.select("doc_id", row_key().alias("row_id"), text_bytes().alias("raw"),
                       has_letter().alias("letters")).mapInArrow(
        _predicted(model), "doc_id long, row_id long, lang_pred string, score double, known double")

