"""One query per corpus operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import ann, bpe, conversation_repair, decontamination, embedding_dedup, packing, sharding, simhash, suffix_dedup, token_store, toxicity, whitening
from pulsekit.llm.common import table, text_bytes
from pulsekit.llm.token_counts import count_tokens
from pulsekit.session import scratch_path


OLD_SHARDS, SHARDS = 12, 8


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from twelve shards (files dealt by name) to eight of near equal bytes."""
    path, out = f"{sf_dir}/documents.parquet", scratch_path(spark, "shards")
    old = F.pmod(F.crc32(F.col("_metadata.file_name").cast("binary")), F.lit(OLD_SHARDS))
    manifest = sharding.reshard(spark, path, out, SHARDS, old_shard=old)
    rows = sharding.read_shards(
        spark, path, out, manifest, F.col("doc_id"), (text_bytes("text") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.95."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), min_cosine=0.95)


SIMHASH = {"distance": 4, "shingle": 4}


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, at most 4 bits."""
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), **SIMHASH)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    both = docs.select("doc_id", bpe.round_trip(F.col("text"), ranks, public_tokenizers.PATTERN).alias("t"))
    return both.select(
        "doc_id", F.size("t.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("t.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("t.decoded", 256).alias("decoded_sha256"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, against all vectors."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


REPEAT_BYTES, REPEAT_WORDS = 400, 51


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses with the 400-byte strings that occur elsewhere too, and its passages of over 50 words that do."""
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"), length=REPEAT_BYTES, words=REPEAT_WORDS)


CAPACITY = 4096


def packed_documents(docs: DataFrame) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4,096 tokens."""
    ids = packing.document_ids(F.col("text"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    pieces = packing.cut_pieces(docs.select("doc_id", ids.alias("ids")), "ids", CAPACITY)
    light = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(light, CAPACITY, order=("doc_id", "piece", "ids_crc32"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences."""
    return packed_documents(table(spark, sf_dir, "documents"))


def held_out(doc_id) -> F.Column:
    """Rows that no label is learnt from; null ids are not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_scores(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """``docs`` with a score column, learnt from the labels that are not held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    return docs.withColumn("score", toxicity.score(F.col("text"), model))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_scores(docs, spark, sf_dir).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return (rows.select("doc_id", text_bytes("text").alias("n_bytes"), "n_tokens")
            .withColumn("over_limit", F.col("n_tokens") > 512))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written in blocks of planes and read back."""
    path = scratch_path(spark, "token-store")
    token_store.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_store.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark: ten words in a row, or a whole shorter item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"), span=10)
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the four leading components of the distinct ones."""
    rows, found, error = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=4)
    explained = [float(e / found.trace) for e in found.values] if found else []
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(found.n if found else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of ``conv_id:turn``; ``copies`` is 0 for rows that are lost, 2 for repeated ones."""
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")))
    kind = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with every damaged conversation, and its cheapest repair."""
    return conversation_repair.repaired(damaged(table(spark, sf_dir, "conversations")), copies=F.col("copies"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op4_byte_bpe": op4_byte_bpe,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_simhash": op3_simhash,
    "op5_nearest": op5_nearest,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_token_store": op10_token_store,
    "op11_decontamination": op11_decontamination,
    "op12_whitening": op12_whitening,
    "op13_conversation_repair": op13_conversation_repair,
}

_VALID = "embedding IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0 AND isfinite(list_sum(embedding::DOUBLE[]))"

ORACLES: dict[str, str] = {
    "op2_embedding_dedup": f"""
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_VALID}),
        near AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id
                 AND list_cosine_similarity(a.e, b.e) >= 0.95),
        reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, n.v FROM reach r JOIN near n ON r.v = n.u),
        part AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
        many AS (SELECT u, count(*) AS n_links FROM near GROUP BY u)
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN part ON part.u = vec_id LEFT JOIN many ON many.u = vec_id""",
}
