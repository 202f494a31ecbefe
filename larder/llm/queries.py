"""The operators bound to the benchmark tables, with their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    conversation_repair,
    curve_pack,
    html_template,
    importance_resample,
    language_id,
    quality_forest,
    quality_network,
    shard_shuffle,
    simhash_links,
    token_store,
    topk_search,
    warc_fixity,
    weight_mix,
)
from larder.llm.common import stored
from larder.sources.workspace import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function: Query, sql: str | None = None) -> Query:
    QUERIES[function.__name__] = function
    if sql:
        ORACLE_SQL[function.__name__] = sql
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the box keeps a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_html_template(spark: SparkSession, folder: str) -> DataFrame:
    return html_template.main_text(table(spark, folder, "pages"))


@query
def op2_simhash_links(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_links.near_duplicates(table(spark, folder, "documents"), words=3, bits=2)


@query
def op3_quality_forest(spark: SparkSession, folder: str) -> DataFrame:
    return quality_forest.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_shard_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    made = shard_shuffle.shuffled(table(spark, folder, "documents"), 16)
    text = F.coalesce("text", F.lit(""))
    return made.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_token_store(spark: SparkSession, folder: str) -> DataFrame:
    store = fresh_folder(spark, "store")
    path = tokenizer_path("word_bpe_49k.json")
    token_store.write_store(table(spark, folder, "documents"), store, path, end=1)
    return token_store.read_digests(spark, store)


#: Pages whose record is damaged or lost in the second replica of the audit.
DAMAGED, LOST = 97, 307


def worn_record(key: int | None, record: bytes) -> bytes:
    """The record's bytes in the second replica: as they are, damaged, or lost to zeros."""
    if key is None or key < 0:  # the rest of a negative number is negative in SQL
        return record
    if key % LOST == 11:
        return bytes(len(record))
    if key % DAMAGED == 3:
        head, _, payload = record.partition(warc_fixity.GAP.encode())
        payload = ("#" + payload.decode()[1:]).encode()
        head = head[: head.rindex(b" ") + 1] + str(len(payload)).encode()
        return head + warc_fixity.GAP.encode() + payload
    return record


def op6_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    one, two = fresh_folder(spark, "replica-one"), fresh_folder(spark, "replica-two")
    warc_fixity.write_warc(table(spark, folder, "pages"), one, compression="gzip")
    warc_fixity.copy_warc(spark, one, two, worn_record, compression="gzip")
    leaves = [warc_fixity.read_warc(spark, replica) for replica in (one, two)]
    return warc_fixity.audit(*leaves).withColumnRenamed("key", "page_id")


def _record(html: str) -> str:
    """A WARC record in SQL, as the fixed form of the records gives it."""
    line = "chr(13) || chr(10)"
    return (
        f"'WARC/1.0' || {line} || 'WARC-Type: response' || {line} || 'WARC-Record-ID: <urn:record:' || "
        f"coalesce(page_id::varchar, '') || '>' || {line} || 'WARC-Target-URI: ' || coalesce(url, '') || {line} || "
        f"'WARC-Date: {warc_fixity.STAMP}' || {line} || 'Content-Type: text/html' || {line} || "
        f"'Content-Length: ' || strlen(coalesce({html}, ''))::varchar || {line} || {line} || coalesce({html}, '')"
    )


def _leaves(name: str, html: str) -> str:
    per = warc_fixity.PER_ARCHIVE
    return f"""
{name}_records AS (SELECT page_id, url, {_record(html)} AS record FROM pages),
{name}_line AS (
  SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, url) - 1 AS place FROM {name}_records
),
{name}_leaves AS (
  SELECT place // {per} AS archive, place % {per} AS ordinal, page_id, sha256(record) AS digest,
    strlen(record) + 4 AS length,
    sum(strlen(record) + 4) OVER (PARTITION BY place // {per} ORDER BY place) - strlen(record) - 4 AS "offset"
  FROM {name}_line
)"""


WORN = f"CASE WHEN page_id % {DAMAGED} = 3 THEN '#' || substr(coalesce(html, ''), 2) ELSE html END"
query(
    op6_warc_fixity,
    f"""
WITH {_leaves("one", "html")}, {_leaves("two", WORN)},
second AS (SELECT * FROM two_leaves WHERE page_id IS NULL OR page_id % {LOST} <> 11)
SELECT a.archive::bigint AS archive, a.ordinal::int AS ordinal, a.page_id, a."offset"::bigint AS "offset",
  a.length::bigint AS length, a.digest,
  CASE WHEN b.digest IS NULL THEN 'lost' WHEN a.digest <> b.digest THEN 'damaged'
    WHEN a."offset" <> b."offset" THEN 'moved' ELSE 'ok' END AS state,
  CASE WHEN b.digest = a.digest AND b."offset" = a."offset" THEN NULL ELSE b.digest END AS replica_digest
FROM one_leaves a LEFT JOIN second b ON a.archive = b.archive AND a.ordinal = b.ordinal
""",
)

#: Sources count with this power of their rows, so that small ones gain.
SOURCE_POWER = 0.8
#: Bytes of text in a block of the mix.
MIX_BLOCK = 1 << 16


@query
def op7_weight_mix(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    weights = weight_mix.tempered_weights(documents, "source", SOURCE_POWER)
    made = weight_mix.interleaved(documents, weights, F.octet_length("text"), block=MIX_BLOCK)
    return made.select("doc_id", "source", F.octet_length("text").cast("long").alias("n_bytes"), *weight_mix.ADDED)


def held_out() -> Column:
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(number.cast("binary")) % 4 == 2


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = language_id.identify(documents, ~held_out())
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), k=5, every=50, factor=256)


query(
    op9_topk_search,
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::int AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
""",
)


@query
def op10_curve_pack(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    return curve_pack.packed(table(spark, folder, "documents"), path, with_ids=False)


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    blocks = stored(conversation_repair.repair(conversation_repair.damaged(conversations)), "repaired")
    found = conversation_repair.summary(blocks).withColumnRenamed("conv_id", "found_id")
    # A conversation that lost all its rows is still named, and its columns say nothing.
    names = conversations.select("conv_id").distinct()
    made = names.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in conversation_repair.SUMMARY[:-2]]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return made.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


@query
def op12_importance_resample(spark: SparkSession, folder: str) -> DataFrame:
    documents, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return importance_resample.resample(documents, target)


def unlearned() -> Column:
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(number.cast("binary")) % 5 == 0


@query
def op13_quality_network(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality_network.score(documents, labels, ~unlearned())
    return scored.select("doc_id", unlearned().alias("held_out"), "score", "predicted")
