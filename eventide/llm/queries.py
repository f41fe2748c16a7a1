"""The registered query of each operator, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, context_mixing, exact_dedup, hnsw, language_id, licenses, mixing, near_dedup, periodic, pii, reverse_search, sharding, toxicity
from .common import documents

OP7_SHARD_BYTES = 1 << 20


def tokenizer() -> tuple[str, str]:
    """(rank file, pre-split pattern) of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def token_digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode and decode ``docs``; counts and digests of the ids and of the decoded bytes."""
    rows = bpe.round_trip(docs, ranks_path, pattern)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(documents(spark, sf_dir, ["doc_id", "source", "text"])).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir, ["doc_id", "text"]), words=4)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find(documents(spark, sf_dir, ["doc_id", "text"]))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *map(count, pii.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, ["doc_id", "text", "lang"])
    return language_id.identify(docs, ~language_id.fold(4, 2)).select(
        "doc_id", language_id.fold(4, 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language_id.fold(5, 0)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    return toxicity.score(documents(spark, sf_dir, ["doc_id", "text"]), labels, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(documents(spark, sf_dir, ["doc_id", "text"]), *tokenizer())


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir, ["doc_id", "text"]), OP7_SHARD_BYTES)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir, ["doc_id", "text"])).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet").select("vec_id", "embedding")
    return hnsw.search(vectors, F.col("vec_id") % 20 == 0)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir, ["doc_id", "text"]))


def op11_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language_id.fold(10, 0)
    return context_mixing.score(documents(spark, sf_dir, ["doc_id", "text"]), ~held_out).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").select("item_id", "text")
    return reverse_search.search(documents(spark, sf_dir, ["doc_id", "text"]), items)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic.repetitions(periodic.planted(documents(spark, sf_dir, ["doc_id", "text"])))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    longest = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("order"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), 1)
    rows = rows.withColumn("_best", F.when(F.size("runs") > 0, longest))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_near_dedup": op2_near_dedup,
    "op3_pii": op3_pii,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_bpe": op6_bpe,
    "op7_sharding": op7_sharding,
    "op8_ann": op8_ann,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_licenses": op10_licenses,
    "op11_lm": op11_lm,
    "op12_search": op12_search,
    "op13_runs": op13_runs,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"unnest(regexp_extract_all({lower}, '{_TERM}'))"


ORACLE = {
    "op7_sharding": f"""
        WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes,
                          ('0x' || left(md5(coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, ''))), 15))::BIGINT AS k
                   FROM documents),
             p AS (SELECT depth, k >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes
                   FROM d, (SELECT unnest(range(0, 61))::INT AS depth) GROUP BY ALL),
             f AS (SELECT * FROM p WHERE shard_bytes <= {OP7_SHARD_BYTES} OR depth = 60),
             m AS (SELECT d.*, min(f.depth) AS depth FROM d JOIN f ON (d.k >> (60 - f.depth)) = f.prefix
                   GROUP BY ALL)
        SELECT doc_id, bytes, CASE WHEN m.depth = 0 THEN '' ELSE lpad(bin(f.prefix), m.depth, '0') END AS shard,
               m.depth, shard_bytes, shard_bytes > {OP7_SHARD_BYTES} AS oversize
        FROM m JOIN f ON m.depth = f.depth AND (m.k >> (60 - m.depth)) = f.prefix""",
    "op9_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               sha256(t) AS text_sha256
        FROM d JOIN g USING (t)""",
    "op12_search": f"""
        WITH t AS (SELECT doc_id, {_terms("text")} AS term FROM documents),
             n AS (SELECT doc_id, count(*)::BIGINT AS n FROM t GROUP BY doc_id),
             c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
             q AS (SELECT DISTINCT item_id, {_terms("text")} AS term FROM benchmark),
             tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM t SEMI JOIN q USING (term) GROUP BY ALL),
             w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
                   FROM tf, c GROUP BY term, docs),
             s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
                   FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), c GROUP BY ALL),
             r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
}
