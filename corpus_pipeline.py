"""A training-corpus pipeline: language ID, SimHash near-dedup, substring dedup, decontamination, packing.

``STAGES`` lists the stages in order. A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents`` (with any extra columns they came with), so each stage works on what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homesense.llm import language
from homesense.llm.common import id_crc, row_key, small, stage, table
from homesense.llm.decontaminate import contamination
from homesense.llm.packing import digests, pack_documents
from homesense.llm.simhash import simhash_components
from homesense.llm.substring import cut_repeats

_KEY = "__row_id"
MIN_KNOWN = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not recognised: null text, no letter, or less than ``MIN_KNOWN`` of the text's
    n-grams known to the classifier (a script or language that it has not learned, or noise). Learns as the query does; if
    there is nothing to learn from, only texts without letters go."""
    model = language.train(docs.filter(F.pmod(id_crc(), F.lit(5)) != 0))
    found = language.identify(docs, model).filter((F.col("lang_pred") == language.UNKNOWN) | (F.col("known") < MIN_KNOWN))
    rejected = found if model.labels else docs.filter(~language.has_letter()).select(row_key().alias("row_id"))
    return _without(docs, rejected, "language")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component: the smallest doc_id (null ids last, then the smallest row
    key). A row that is repeated as a whole is one document."""
    rows = stage(simhash_components(docs, shingle=4, max_bits=4).select("doc_id", "row_id", "root"), "pipeline-roots")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")
    first = stage(rows.groupBy("root").agg(F.min(order).alias("first"))
                  .select("root", F.col("first.row_id").alias("kept")), "pipeline-first")
    out = _without(docs, rows.join(first, "root").filter("row_id != kept"), "neardup")
    repeats = rows.groupBy("row_id").count().filter("count > 1")
    return out if repeats.isEmpty() else out.dropDuplicates(["doc_id", "text"])


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 13 words or more that an earlier document holds. Documents without any keep their text
    byte for byte; the others keep their remaining words joined by one space, and ``n_chars`` follows."""
    cut = cut_repeats(docs, window=13)
    changed = F.col("__n_removed") > 0
    text = F.when(changed, F.col("__kept")).otherwise(F.col("text"))
    out = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which at least a twentieth of the words lies in benchmark passages."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.filter("contaminated"), "contaminated")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return digests(pack_documents(docs))


STAGES = [
    ("language_id", language_stage),
    ("simhash_neardup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Substring kernels, SimHash components and tokenised packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; every stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def _without(docs: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows whose key is among the rejected ``row_id``."""
    gone = stage(rejected.select(F.col("row_id").alias(_KEY)).distinct(), f"pipeline-{name}-out")
    return docs.withColumn(_KEY, row_key()).join(small(gone), _KEY, "left_anti").drop(_KEY)
