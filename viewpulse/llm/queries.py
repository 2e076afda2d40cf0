"""The registered queries of this subpackage: each derives its contract's columns from one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.llm import chat_format, chunk_dedup, exact_dedup, graph_index, maxent, packing, resampling, secrets, simhash, target_sampling
from viewpulse.llm import toxicity, whitening, word_bpe
from viewpulse.llm.common import crc_remainder, documents


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.sample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return graph_index.search(graph_index.build_index(vectors, copies=6), vectors.where(F.col("vec_id") % 50 == 0), k=5)


def packing_parameters() -> dict:
    import public_tokenizers

    return {"tokenizer_path": tokenizer_path("byte_bpe_50k.json"), "pattern": public_tokenizers.PATTERN, "size": 2048, "end_id": 0}


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), **packing_parameters())


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.find(docs, secrets.fit(docs))
    kinds = secrets.KINDS[:3]
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(F.filter("spans", _is_kind(k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(F.encode(written(base), "UTF-8"), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def op5_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_passages(documents(spark, sf_dir))


def op6_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = maxent.score(documents(spark, sf_dir), learn=crc_remainder("doc_id", 7) != 2)
    held_out = F.coalesce(crc_remainder("doc_id", 7) == 2, F.lit(True))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


OP7_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM d
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = word_bpe.encode(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), decoded=True)
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(documents(spark, sf_dir), labels, learn=crc_remainder("doc_id", 5) != 0)
    held_out = F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(True))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=16)


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_sampling.sample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=10)


OP12_SQL = r"""
WITH crc_table AS (
    SELECT list(v ORDER BY i) AS tbl
    FROM (SELECT i, list_reduce([CAST(i AS BIGINT)] || range(8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
          FROM range(256) t(i))
),
words AS (
    SELECT origin, place, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM (SELECT 'raw' AS origin, row_number() OVER () AS place, text FROM documents
          UNION ALL SELECT 'target', row_number() OVER (), text FROM benchmark)
),
per_word AS (SELECT origin, place, word, count(*) AS n FROM words GROUP BY ALL),
vocabulary AS (
    SELECT word, xor(list_reduce([4294967295] || list_transform(range(CAST(strlen(word) AS BIGINT)), lambda k: CAST('0x' || substr(hex(encode(word)), 2 * k + 1, 2) AS BIGINT)),
                                 lambda c, b: xor(c >> 8, tbl[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT word FROM per_word), crc_table
),
counts AS (
    SELECT bucket, coalesce(sum(n) FILTER (WHERE origin = 'raw'), 0) AS s, coalesce(sum(n) FILTER (WHERE origin = 'target'), 0) AS t
    FROM per_word JOIN vocabulary USING (word) GROUP BY bucket
),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (total_s + 10000) AS DOUBLE) / CAST((s + 1) * (total_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
    FROM counts, (SELECT sum(s) AS total_s, sum(t) AS total_t FROM counts)
),
weights AS (
    SELECT place, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
    FROM per_word JOIN vocabulary USING (word) JOIN gains USING (bucket) WHERE origin = 'raw' GROUP BY place
),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM (SELECT doc_id, row_number() OVER () AS place FROM documents) LEFT JOIN weights USING (place)
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS r,
           count(*) FILTER (WHERE n_features >= 20) OVER () AS long_enough
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * long_enough // 100 THEN r END AS rank
FROM ranked
"""


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    rows = [F.struct(*[F.lit(v).cast(chats.schema[c].dataType).alias(c) for c, v in zip(chats.columns, row)])
            for row in ((-1, 0, "user", text), (-1, 1, "assistant", text))]
    own = spark.range(1).select(F.inline(F.array(*rows)))
    return chat_format.read_back(chat_format.format_conversations(chats.unionByName(own)), arranged=True)


OP13_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
escaped AS (
    SELECT *, length(regexp_replace(regexp_replace(text, '<(\\*)(s>|/s>)', '<\\\1\2', 'g'),
                                    '\[(\\*)(INST\]|/INST\]|OUT\]|SYS\]|/SYS\]|ROLE\]|TEXT\]|/ROLE\])', '[\\\1\2', 'g')) AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(length('<s>') + sum(chars + CASE role WHEN 'assistant' THEN length('[OUT]</s>') WHEN 'user' THEN length('[INST][/INST]')
                                             WHEN 'system' THEN length('[SYS][/SYS]') ELSE length('[ROLE][TEXT][/ROLE]') + length(role) END) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_importance_resampling": op1_importance_resampling,
        "op2_graph_neighbours": op2_graph_neighbours,
        "op3_packing": op3_packing,
        "op4_secrets": op4_secrets,
        "op5_chunk_dedup": op5_chunk_dedup,
        "op6_maxent": op6_maxent,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_simhash": op8_simhash,
        "op9_bpe": op9_bpe,
        "op10_toxicity": op10_toxicity,
        "op11_whitening": op11_whitening,
        "op12_target_resampling": op12_target_resampling,
        "op13_chat_format": op13_chat_format,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_exact_dedup": OP7_SQL, "op12_target_resampling": OP12_SQL, "op13_chat_format": OP13_SQL}
