"""The registered queries of the subpackage: one per operator, and the pipeline.

Each builds its result from the given tables through its operator, with the
operator's production parameters, and derives the digest columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import bfd_shards, containment, conversation_repair, entropy_mix, hard_negatives, hilbert_ann, language_id, ppm, repair_sql, simhash_trie, token_orc, url_filter, warc, weak_quality
from .shipping import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages and all documents, one row each (the id of the other table is null)."""
    docs = _table(spark, sf_dir, "documents")
    languages = language_id.label_languages(docs)
    model = language_id.fit_text(docs.select("doc_id", "text", "lang"), languages)
    no_id = F.lit(None).cast("long")
    pages = language_id.page_rows(_table(spark, sf_dir, "pages")).withColumn("doc_id", no_id)
    rows = language_id.document_rows(docs).withColumn("page_id", no_id).unionByName(pages)
    found = language_id.identify(rows, model, languages)
    return found.select("doc_id", "page_id", "declared", "text_lang", "lang", "posterior")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents"), ppm.held_out_fold())


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    captures = warc.transactions(warc.read_archives(spark, folder, with_payload=False))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to"))


def op5_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return weak_quality.judge(docs, weak_quality.fit(docs))


def op6_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = entropy_mix.copies(entropy_mix.sizes(_table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long"), "source", "rate", "copies")


def op10_bfd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = bfd_shards.text_columns(_table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32", "text_md5")
    placed = bfd_shards.pack(materialize(sized, "sized"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "text_md5"
    )


def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_trie.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_trie.hex_fingerprint().alias("fingerprint"), "component_id")


def op11_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_orc.token_folder(spark)
    token_orc.write_tokens(_table(spark, sf_dir, "documents"), folder)
    checked = token_orc.checksums(token_orc.read_tokens(spark, folder))
    return token_orc.with_start(checked, token_orc.file_table(spark, folder)).select("doc_id", "start", "n_tokens", "ids_crc32", "file_no")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations")
    return conversation_repair.every_conversation(given, conversation_repair.summarize(conversation_repair.damage(given)))


def op13_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "embeddings")
    used = given.filter(hard_negatives.usable(F.col("label"), F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return used.select("vec_id", label.alias("label"), hard_negatives.whole_components(F.col("embedding"), 256.0).alias("vec"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(op13_rows(spark, sf_dir), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (op1_language_id, op2_url_filter, op3_ppm, op4_warc, op5_weak_quality, op6_hilbert_ann, op7_containment, op8_entropy_mix, op9_simhash_trie, op10_bfd_shards, op11_token_orc, op12_conversation_repair, op13_hard_negatives)}

    def wrap(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(ship(spark), sf_dir)

    return {name: wrap(build) for name, build in found.items()}


_ORACLES = {
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, cast(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 10""",
    "op12_conversation_repair": repair_sql.SQL,
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS s FROM p),
m AS (SELECT s, max(page_id) AS first_id FROM d GROUP BY s)
SELECT d.page_id, cast(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         cast(1 + ((cast('0x' || substr(d.s, cast(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> cast(35 - 5 * (i % 8) AS BIGINT)) & 31) AS BIGINT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN m ON d.s = m.s""",
    "op7_containment": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
dp AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS k, len(w) AS n FROM dw),
dr AS (SELECT doc_id, k, n, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS s
       FROM dp WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
ds AS (SELECT DISTINCT doc_id, s FROM dr WHERE k <= greatest(n - 4, 1)),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
ip AS (SELECT item_id, unnest(w) AS x, generate_subscripts(w, 1) AS k, len(w) AS n FROM iw),
ir AS (SELECT item_id, k, n, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS s
       FROM ip WINDOW o AS (PARTITION BY item_id ORDER BY k)),
"is" AS (SELECT DISTINCT item_id, s FROM ir WHERE k <= greatest(n - 4, 1)),
n AS (SELECT item_id, count(*) AS n FROM "is" GROUP BY item_id)
SELECT doc_id, item_id, cast(any_value(n) AS INTEGER) AS n_shingles, cast(count(*) AS INTEGER) AS n_found, count(*) / any_value(n) AS containment
FROM ds JOIN "is" USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n) - 1e-9""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the operators that SQL expresses on whole tables; the others are held
    against brute force in ``tests/llm``."""
    return dict(_ORACLES)
