"""Token ids as documents compressed one by one with a shared zstandard dictionary.

A store is a Parquet folder of blocks. A block holds consecutive documents in
ascending key order: their zstandard frames in a row, the offset index of the frames,
and for each document its key, its number of ids and the ids before it in its part.
A dictionary trained on serialized id arrays lets frames of short documents stay
small on their own, so one document is read by one frame. Every block names the
dictionary by its hash, and a reader refuses another one.

Ids are serialized as little-endian 16-bit numbers if the vocabulary allows it, and
as 32-bit numbers otherwise; the width is kept with every block.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import col, part_starts
from larder.llm.tokens import CACHED_PIECES, chunks, encoder

BLOCK_BYTES = 1 << 20
#: Ids hardly compress further at higher levels: level 3 saves a twentieth and takes 1.6 times as long.
LEVEL = 1
BLOCKS = (
    "part int, block int, dictionary string, width int, least long, greatest long, "
    "keys array<long>, offsets array<long>, starts array<long>, counts array<long>, frames binary"
)


def encoded(
    batches: Iterator[pa.RecordBatch], path: str, end: int, blank_joins: bool = False, cached: int = CACHED_PIECES
) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Keys and id arrays, the end id last, of Arrow batches of key and text."""
    coder = encoder(path, blank_joins, cached)
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            piece = batch.slice(start, 512)
            keys, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
            for a, b in chunks(texts):
                ids, counts = coder.encode(texts[a:b])
                edges = np.concatenate([[0], np.cumsum(counts)])
                spans = zip(edges[:-1], edges[1:], strict=True)
                yield keys[a:b], [np.append(ids[x:y], end) for x, y in spans]


def width_of(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary, or nothing where the samples are too few to train one."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL, threads=0).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_store(
    df: DataFrame,
    folder: str,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = 1,
    sample_rows: int = 2000,
    sample_bytes: int = 1 << 18,
    dictionary_size: int = 1 << 16,
) -> None:
    """Encode every whole text and write the store ``folder/blocks`` and ``folder/dictionary``.

    The dictionary is trained on ``sample_rows`` documents at most, those whose keys
    have the smallest hashes, without texts of over ``sample_bytes``; every document is
    encoded and written whatever its length. Texts are shuffled once, into key ranges.

    A NULL text has only the end id. NULL keys come first; equal keys are in the order
    of the texts' hashes. Repeated rows are documents of their own. An empty table gives
    a store without blocks. Other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    width = width_of(path)
    kind = f"<u{width}"
    slim = df.select(col(key).cast("long").alias("key"), col(text).cast("string").alias("text"))
    hashed = F.xxhash64("key")
    last = slim.select(hashed.alias("hash")).orderBy("hash").limit(sample_rows).agg(F.max("hash")).first()[0]
    small = F.coalesce(F.octet_length("text"), F.lit(0)) <= sample_bytes
    drawn = slim.where((hashed <= F.lit(last)) & small).limit(sample_rows)
    encode = _serializer(path, end, kind)
    samples = [bytes(row["ids"]) for row in drawn.select("key", "text").mapInArrow(encode, "ids binary").collect()]
    dictionary = train_dictionary(samples, dictionary_size)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, bytearray(dictionary))], "dictionary string, content binary").coalesce(
        1
    ).write.parquet(f"{folder}/dictionary")
    by = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    ordered = slim.repartitionByRange(*by).sortWithinPartitions(*by)
    blocks = ordered.mapInArrow(_block_writer(path, end, kind, dictionary, name), BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")


def _serializer(path: str, end: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, arrays in encoded(batches, path, end):
            made = [a.astype(kind).tobytes() for a in arrays]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["ids"])

    return run


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)


def _block_writer(path: str, end: int, kind: str, dictionary: bytes, name: str):
    width = int(kind[2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = _compressor(dictionary)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        keys, starts, counts, frames, held = [], [], [], [], 0

        def made() -> pa.RecordBatch:
            known = [k for k in keys if k is not None]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            row = {
                "part": part,
                "block": block,
                "dictionary": name,
                "width": width,
                "least": min(known, default=None),
                "greatest": max(known, default=None),
                "keys": keys,
                "offsets": offsets,
                "starts": starts,
                "counts": counts,
                "frames": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], BLOCK_SCHEMA)

        for got, arrays in encoded(batches, path, end):
            for key, ids in zip(got, arrays, strict=True):
                frame = compressor.compress(ids.astype(kind).tobytes())
                keys.append(key)
                starts.append(before)
                counts.append(len(ids))
                frames.append(frame)
                before += len(ids)
                held += len(frame)
                if held >= BLOCK_BYTES:
                    yield made()
                    keys, starts, counts, frames, held = [], [], [], [], 0
                    block += 1
        if keys:
            yield made()

    return run


BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("dictionary", pa.string()),
        ("width", pa.int32()),
        ("least", pa.int64()),
        ("greatest", pa.int64()),
        ("keys", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("starts", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("frames", pa.binary()),
    ]
)


def read_dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    """The store's dictionary, checked against its hash."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    content = bytes(row["content"])
    if hashlib.sha256(content).hexdigest() != row["dictionary"]:
        raise ValueError("the dictionary does not have the hash that the store names")
    return row["dictionary"], content


def frame_ids(frame: bytes, dictionary: bytes, width: int) -> np.ndarray:
    """The ids of one document's frame."""
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    data = zstandard.ZstdDecompressor(dict_data=shared).decompress(frame)
    return np.frombuffer(data, f"<u{width}").astype("<u4")


def read_digests(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from its frame."""
    name, dictionary = read_dictionary(spark, folder)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    starts = part_starts(blocks, F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        reader = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                part, found, width, keys, offsets, before, frames = (
                    row.column(n)[0].as_py()
                    for n in ("part", "dictionary", "width", "keys", "offsets", "starts", "frames")
                )
                if found != name:
                    raise ValueError(f"a block was written with dictionary {found}, not {name}")
                counts, sums = [], []
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    ids = np.frombuffer(reader.decompress(frames[a:b]), f"<u{width}").astype("<u4")
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(keys), pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.array(before, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["part", "key", "before", "n_tokens", "ids_crc32"],
                )

    read = blocks.mapInArrow(run, "part int, key long, before long, n_tokens long, ids_crc32 long")
    return read.join(F.broadcast(starts), "part").select(
        F.col("key").alias(key), (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_document(spark: SparkSession, folder: str, key: int) -> list[list[int]]:
    """The ids of the documents with a key; only their blocks and frames are read.

    Blocks are found by the least and greatest key, which Parquet keeps as statistics,
    and the frame is cut out by the offset index before it leaves the executors.
    """
    name, dictionary = read_dictionary(spark, folder)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    hit = blocks.where((F.col("least") <= key) & (F.col("greatest") >= key))
    each = hit.select(
        "dictionary", "width", "offsets", "frames", F.posexplode("keys").alias("at", "key")
    ).where(F.col("key") == key)
    first, last = F.col("offsets")[F.col("at")], F.col("offsets")[F.col("at") + 1]
    cut = F.substring("frames", first.cast("int") + 1, (last - first).cast("int"))
    rows = each.select("dictionary", "width", cut.alias("frame")).collect()
    if any(row["dictionary"] != name for row in rows):
        raise ValueError("a block was written with another dictionary")
    return [frame_ids(bytes(row["frame"]), dictionary, row["width"]).tolist() for row in rows]
