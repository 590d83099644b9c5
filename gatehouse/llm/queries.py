"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatehouse.llm import (damage, entropy_mix, exact_topk, extendible, html_crf, pack, periodic_runs,
                           prefix_bpe, rp_forest, rule_quality, secrets_battery, simhash_bk, toxicity_cnn,
                           turn_repair)
from gatehouse.llm.common import table

SHARD_BYTES = 1 << 20
RANKS = "byte_bpe_multi_50k.tiktoken"


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op2_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = extendible.shards(table(spark, sf_dir, "documents"), "doc_id", F.octet_length("text"), limit=SHARD_BYTES)
    return dealt.select(F.col("key").alias("doc_id"), F.col("bytes").alias("n_bytes"), "shard", "depth", "shard_bytes")


def op4_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op3_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = entropy_mix.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_cnn.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity_cnn.score(docs, model, carry=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "language")


def op6_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = html_crf.extract(table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return main.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_simhash_bk_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_bk.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_bk.hex16("fp").alias("fingerprint"), "component_id")


def op8_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = rule_quality.train(docs, table(spark, sf_dir, "labels"))
    scored = rule_quality.score(docs, model, carry=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_battery.find_secrets(table(spark, sf_dir, "documents"), carry=["doc_id"])
    kinds = [secrets_battery.count_of("base", k).alias(f"n_{name}")
             for k, name in enumerate(secrets_battery.KINDS[:3])]
    base = secrets_battery.joined(F.col("base"))
    return found.select("doc_id", *kinds, F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        secrets_battery.joined(F.col("spans")).alias("spans"))


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    both = prefix_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN,
                             carry=["doc_id"], decoded="decoded")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       prefix_bpe.ids_digest("ids").alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damage.damaged_turns(table(spark, sf_dir, "conversations"))
    return turn_repair.repair(turns, absent="absent").withColumnRenamed("conv", "conv_id")


def op12_maximal_pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    damaged = docs.select("doc_id", damage.periodic_text(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(damaged, carry=["doc_id"]).withColumn("best", periodic_runs.best_run("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    pieces = pack.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.PATTERN, carry=["doc_id"])
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


QUERIES = {
    "op1_exact_topk": op1_exact_topk,
    "op2_extendible_shards": op2_extendible_shards,
    "op3_entropy_mix": op3_entropy_mix,
    "op4_rp_forest": op4_rp_forest,
    "op5_toxicity_cnn": op5_toxicity_cnn,
    "op6_html_crf": op6_html_crf,
    "op7_simhash_bk_tree": op7_simhash_bk_tree,
    "op8_rule_quality": op8_rule_quality,
    "op9_secret_battery": op9_secret_battery,
    "op10_prefix_bpe": op10_prefix_bpe,
    "op11_turn_alignment": op11_turn_alignment,
    "op12_maximal_pair_runs": op12_maximal_pair_runs,
    "op13_concat_cut": op13_concat_cut,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND q.vec_id % 100 = 0),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
         vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
""",
    "op2_extendible_shards": f"""
WITH r AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS h FROM documents),
d AS (SELECT *, unnest(range(0, 41))::INTEGER AS depth FROM r),
s AS (SELECT *, sum(n_bytes) OVER (PARTITION BY depth, h >> (60 - depth))::BIGINT AS shard_bytes FROM d),
m AS (SELECT * FROM s WHERE shard_bytes <= {SHARD_BYTES}
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1)
SELECT doc_id, n_bytes, substr(lpad(bin(h), 60, '0'), 1, depth) AS shard, depth, shard_bytes FROM m
""",
}
