"""Registered queries of the llm operators and their SQL twins.

Each query applies one operator, with its production parameters, to the whole
table.  ``ORACLE`` holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe_codec, chat, periodic_runs, sentencepiece_codec, toxicity, url_filter, vector_codes, warc
from tillroll.llm.common import pick, table
from tillroll.llm.exact_dedup import exact_dedup
from tillroll.llm.packing import pack
from tillroll.llm.simhash import simhash_components
from tillroll.llm.sharding import shard_documents
from tillroll.llm.topk import search
from tillroll.session import materialize, scratch_path


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rules("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    texts = sentencepiece_codec.decode(sentencepiece_codec.encode(table(spark, sf_dir, "documents"), model), model)
    return texts.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = pick(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search(vectors.filter(F.col("vec_id") % 20 == 0), vectors, k=20)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(pick(docs, "doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "toxicity.score",
                         (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"), "toxicity.spans")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(extra)
    formatted = materialize(chat.windows(turns, public_tokenizers.path("byte_bpe_50k.json")), "chat_windows")
    return chat.digests(formatted)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    length, book = vector_codes.codebooks(vectors) or (0, [])
    numbers = ",".join(str(x) for entries in book for x in entries.ravel().tolist())
    coded = materialize(vector_codes.encode(vectors, length, book), "vector_codes")
    totals = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    hexed = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", F.array_join(hexed, "").alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    texts = bpe_codec.decode(bpe_codec.encode(table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    return texts.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


def planted(tokenised: DataFrame) -> DataFrame:
    """The words with the contract's periods: of a tenth of the ids, from word a on word i is word a + (i - a) % p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n = F.size("words")
    a = F.when((h % 10 == 0) & (n > 0), F.floor(h / 10) % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.floor(h / 10) % 8))).cast("int")
    repeated = F.concat(F.slice("words", 1, F.col("a")),
                        F.transform(F.sequence(F.col("a"), n - 1), lambda i: F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return (tokenised.withColumn("a", a).withColumn("p", p)
            .select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("words")).alias("words")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse(planted(periodic_runs.words(table(spark, sf_dir, "documents"))))
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_packing": op3_packing,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_sharding": op5_sharding,
    "op6_warc": op6_warc,
    "op7_simhash": op7_simhash,
    "op8_topk": op8_topk,
    "op9_toxicity": op9_toxicity,
    "op10_chat": op10_chat,
    "op11_vector_codes": op11_vector_codes,
    "op12_bpe": op12_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE = {
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
        hexed AS (
            SELECT page_id, octet_length(encode(t)) AS payload_bytes, sha1(t) AS h,
                   row_number() OVER same AS n, first(page_id) OVER same AS target
            FROM p WINDOW same AS (PARTITION BY t ORDER BY page_id NULLS LAST))
        SELECT page_id, payload_bytes,
               list_reduce(list_prepend('', [
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          (((instr('0123456789abcdef', h[(5 * i) // 4 + 1]) - 1) * 16
                            + (CASE WHEN (5 * i) // 4 + 2 <= 40 THEN instr('0123456789abcdef', h[(5 * i) // 4 + 2]) - 1 ELSE 0 END))
                           >> (3 - (5 * i) % 4)) % 32 + 1, 1)
                   FOR i IN range(0, 32)]), lambda a, b: a || b) AS payload_digest,
               CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN n = 1 THEN NULL ELSE target END AS refers_to
        FROM hexed""",
    "op8_topk": """
        WITH usable AS (
            SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM usable q JOIN usable c ON len(q.v) = len(c.v) AND q.vec_id IS DISTINCT FROM c.vec_id
            WHERE q.vec_id % 20 = 0),
        ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST))::INT AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op2_exact_dedup": """
        SELECT doc_id,
               first(doc_id) OVER same AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               row_number() OVER same = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST)""",
}
