"""The registered queries of the training-data operators: name -> (query, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homesense.llm import language, quality, toxicity
from homesense.llm.caps import near_vectors
from homesense.llm.common import id_crc, table
from homesense.llm.decontaminate import contamination
from homesense.llm.licenses import scan_licenses
from homesense.llm.ngram_lm import lm_scores
from homesense.llm.packing import digests, pack_documents
from homesense.llm.search import search
from homesense.llm.sharding import shard_documents
from homesense.llm.simhash import hex16, simhash_components
from homesense.llm.substring import cut_repeats
from homesense.llm.trie import ends_digest, prefix_trie, shared_heads

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


@register("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4).select(
        "doc_id", hex16().alias("fingerprint"), "component_id")


@register("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.pmod(id_crc(), F.lit(5)) == 0
    model = language.train(docs.filter(~held))
    return language.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@register("op3_embedding_neardup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), min_cosine=0.9)


@register("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    top = F.array_max(F.transform("matches", lambda m: F.struct(m["dice"].alias("dice"), m["license"].alias("license"))))
    return found.select("doc_id", F.size("matches").alias("n_matches"), F.round(top["dice"], 6).alias("best_dice"),
                        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"))


@register("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.pmod(id_crc(), F.lit(3)) == 1
    model = toxicity.train(docs.filter(~held), table(spark, sf_dir, "labels"))
    return toxicity.tag(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op6_substring_dedup", """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM words, unnest(range(1, len(w) - 11)) AS u(i)),
least_doc AS (SELECT t, min(doc_id) AS low FROM starts GROUP BY t),
gone AS (
  SELECT DISTINCT s.doc_id, p FROM starts s JOIN least_doc USING (t), unnest(range(s.i, s.i + 13)) AS u(p)
  WHERE low < s.doc_id),
tokens AS (SELECT doc_id, p, w[p] AS word FROM words, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM tokens ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return cut.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"),
                      F.sha2("__kept", 256).alias("kept_sha256"))


@register("op7_lm_score")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = F.pmod(id_crc(), F.lit(7))
    scored = lm_scores(table(spark, sf_dir, "documents"), train=left != 2, held_out_fold=left == 3)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


@register("op8_decontamination", """
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS k FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
            FROM sized, unnest(range(1, len(w) - k + 2)) AS u(i)),
starts AS (SELECT doc_id, w, k, i FROM low, (SELECT DISTINCT k FROM sized), unnest(range(1, len(w) - k + 2)) AS u(i)),
found AS (SELECT s.doc_id, s.i, s.k, x.item_id FROM starts s JOIN windows x
          ON s.k = x.k AND array_to_string(s.w[s.i:s.i + s.k - 1], ' ') = x.t),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + k)) AS u(p) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM low LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated")


@register("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack_documents(table(spark, sf_dir, "documents")))


@register("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@register("op11_prefix_trie", """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
sized AS (  -- crc32 of the decimal id, byte by byte and bit by bit
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT)),
             lambda crc, byte: list_reduce([xor(crc, byte)] || [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0],
                 lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)),
             CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM ids),
seqs AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS s
         FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (SELECT z.conv_id, coalesce(b.s[1:h], []) || coalesce(o.s[h + 1:], []) AS s
            FROM sized z JOIN seqs o ON o.conv_id = z.conv_id LEFT JOIN seqs b ON b.conv_id = z.base),
members AS (SELECT conv_id, s[1:d] AS p, d, len(s) = d AS ends FROM rebuilt, unnest(range(0, len(s) + 1)) AS u(d)),
nodes AS (SELECT p, CAST(d AS BIGINT) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
          FROM members GROUP BY p, d),
kids AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children,
                      CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.p[n.depth].t) END AS own
               FROM nodes n LEFT JOIN kids k ON k.p = n.p AND k.depth = n.depth),
totals AS (SELECT p[1:d] AS p, d AS depth, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
                  CAST(sum(own) AS BIGINT) AS saved_tokens
           FROM full_nodes, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN totals t ON t.p = n.p AND t.depth = n.depth
LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.p = n.p[1:n.depth - 1]
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie(table(spark, sf_dir, "conversations"), heads=shared_heads)
    return nodes.join(ends_digest(ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


@register("op12_quality")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


@register("op13_search", """
WITH t AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
sizes AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM t),
tf AS (SELECT d, doc_id, len(w) AS n, term, count(*) AS tf FROM t, unnest(w) AS u(term) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS wt
       FROM tf, sizes GROUP BY term),
asked AS (
  SELECT DISTINCT q, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)),
gains AS (SELECT d, doc_id, term, wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))) AS gain
          FROM tf JOIN wt USING (term), sizes),
scores AS (SELECT q, item_id, d, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM asked JOIN gains USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS r FROM scores WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 50
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
