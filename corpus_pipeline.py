"""A corpus from raw documents to packed token sequences, stage by stage.

Each stage takes the documents that its predecessor kept and is written as Parquet
before the next one reads it. Rows may have NULLs in any column: a NULL or empty text
fails the quality rules, and a document without an id, source or language is one like
others. Equal rows are told apart by nothing and count as copies. Tables without rows
give tables without rows, and columns that documents do not have are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import curve_pack, language_id, quality_forest, queries, simhash_links, weight_mix
from larder.llm.common import row_identity, stored
from larder.sources.workspace import fresh_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language with less than an even chance is no decision.
LEAST_SCORE = 0.5


#: Numbers of rejected documents that are sent to every executor at most; 32 bytes each.
SENT_KEYS = 500_000


#: Rows that a Python worker gets at once. Documents are long, and the batches of a session's
#: default would take tens of megabytes on both sides of each worker's socket.
BATCH_ROWS = 500


#: Pieces of text that a worker's encoder remembers here: by this stage an executor has grown to
#: what the stages before it took, so the encoder gets a quarter of its usual memory.
CACHED_PIECES = 200_000


def short_batches(spark: SparkSession) -> None:
    """From here on this session hands Python workers few rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number of 128 bits of their content; equal rows have equal numbers."""
    return docs.select(*COLUMNS, row_identity(COLUMNS).alias("content"))


def beside(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The numbered documents that have a number among the keys, or have none.

    The keys are counted first: few of them go to all executors, so that no text
    moves, and many are joined by a shuffle.
    """
    keys = stored(keys.select("content").distinct(), "keys")
    few = keys.count() <= SENT_KEYS
    return docs.join(F.broadcast(keys) if few else keys, "content", how)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality limit or that the isolation forest sets apart go."""
    short_batches(spark)
    rows = numbered(docs)
    labels = queries.table(spark, sf_dir, "labels")
    labels = rows.select("doc_id", "content").join(labels, "doc_id").select("content", "quality")
    verdicts = quality_forest.assess(rows, labels, key="content")
    return beside(rows, verdicts.where("not kept"), "left_anti").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    short_batches(spark)
    rows = numbered(docs)
    found = language_id.identify(rows, ~queries.held_out(), key="content")
    unsure = (F.col("lang_pred") == language_id.UNKNOWN) | (F.col("score") < LEAST_SCORE)
    return beside(rows, found.where(unsure), "left_anti").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays, the one with the smallest number.

    A number that occurs several times is that of equal rows, of which one stays.
    """
    short_batches(spark)
    rows = numbered(docs)
    found = stored(simhash_links.near_duplicates(rows, key="content", words=3, bits=2), "links")
    first = F.col("content") == F.col("component_id")
    twice = found.where(first).groupBy("content").count().where("count > 1")
    gone = found.where(~first).select("content").union(twice.select("content"))
    alone = beside(rows, gone, "left_anti").select(*COLUMNS)
    one_of = beside(rows, twice, "left_semi").dropDuplicates(["content"]).select(*COLUMNS)
    return alone.union(one_of)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: every document once, those of small sources again.

    Only numbers, sources and sizes are scheduled; texts join the schedule and are
    written in its order.
    """
    weights = weight_mix.tempered_weights(docs, "source", queries.SOURCE_POWER)
    size = F.octet_length("text")
    return weight_mix.interleaved(docs.select(*COLUMNS), weights, size, block=queries.MIX_BLOCK).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all token sequences with their ids; the checksum is that of the ids given out."""
    short_batches(spark)
    path = queries.tokenizer_path("byte_bpe_50k.json")
    made = curve_pack.packed(docs, path, cached=CACHED_PIECES)
    return made.withColumn("ids_crc32", F.crc32("ids"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: The forest, the language model and the tokenizer have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
