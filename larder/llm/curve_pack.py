"""Packing documents into token sequences along a space-filling curve.

A document's token ids are hashed into a signed vector and projected to a few
dimensions; both maps are linear, so one table gives each token's share. Documents
are sorted by the Hilbert key of their point, and sequences are cut from the curve's
stream of ids, so a sequence holds documents that lie near each other. Only the last
sequence can be short.

Ids are written once. What is sorted and numbered is a narrow table of keys and
counts, and pieces meet their ids again by the row number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batches, col, part_starts, placed, stored
from larder.llm.token_store import encoded, width_of
from larder.llm.tokens import CACHED_PIECES

LENGTH = 2048
DIMENSIONS = 4
BUCKETS = 1 << 12
LEVEL_BITS = 12


def token_points(vocabulary: int, seed: int = 5) -> np.ndarray:
    """Each token's share of a document's point: its hashed bucket and sign, projected."""
    ids = np.arange(vocabulary, dtype=np.uint64)
    mixed = (ids + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    bucket = (mixed % np.uint64(BUCKETS)).astype(np.int64)
    sign = np.where(mixed >> np.uint64(63), 1.0, -1.0)
    projection = np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))
    return (projection[bucket] * sign[:, None]).astype(np.float32)


def hilbert_keys(levels: np.ndarray, bits: int = LEVEL_BITS) -> np.ndarray:
    """The place on the Hilbert curve of points with integer coordinates below 2 ** bits."""
    x = levels.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) > 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def packed(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = 1,
    length: int = LENGTH,
    seed: int = 5,
    with_ids: bool = True,
    cached: int = CACHED_PIECES,
) -> DataFrame:
    """One row for each piece of a document in a sequence, with the piece's ids.

    ``key``, ``start`` (the document's ids before the piece), ``length``, ``ids_crc32``
    (the checksum of the piece's ids as little-endian unsigned 32-bit numbers),
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence and, unless only the
    digest is wanted, ``ids``, those numbers themselves. Each id, the end id included, lies in one piece.

    A NULL or empty text has the end id alone and lies at the origin of the space.
    Copies share a key of the curve and lie side by side; ties are ordered by document
    key and then by row. ``cached`` is how many different pieces of text a worker remembers.
    Repeated rows and NULL keys are documents of their own. An
    empty table gives an empty result, and other columns are not read.
    """
    width = width_of(path)
    kind = f"<u{width}"

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
        points = token_points(max(size, end + 1), seed)
        for keys, arrays in encoded(batches, path, end, blank_joins=True, cached=cached):
            counts = np.array([len(a) for a in arrays], np.int64)
            starts = np.cumsum(counts) - counts
            sums = np.add.reduceat(points[np.concatenate(arrays)], starts, axis=0)
            norm = np.sqrt(counts)[:, None]
            place = np.where((counts > 1)[:, None], sums / norm, 0.0)
            ids = pa.array([a.astype(kind).tobytes() for a in arrays], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    ids,
                    pa.array(counts),
                    pa.array(list(place.astype(np.float64)), pa.list_(pa.float64())),
                ],
                ["key", "ids", "n", "point"],
            )

    slim = df.select(col(key).cast("long").alias("key"), col(text).cast("string").alias("text"))
    made = slim.mapInArrow(tokenized, "key long, ids binary, n long, point array<double>")
    table = stored(made.withColumn("number", F.monotonically_increasing_id()), "tokens")
    spread = table.agg(
        *[F.avg(F.col("point")[i]).alias(f"mean{i}") for i in range(DIMENSIONS)],
        *[F.stddev_pop(F.col("point")[i]).alias(f"deviation{i}") for i in range(DIMENSIONS)],
    ).first()
    mean = np.array([spread[f"mean{i}"] or 0.0 for i in range(DIMENSIONS)])
    deviation = np.array([spread[f"deviation{i}"] or 1.0 for i in range(DIMENSIONS)])

    def on_curve(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = batch.column("point").flatten().to_numpy().reshape(-1, DIMENSIONS)
        # Equal steps of a curve that is close to the share of documents below.
        share = 1 / (1 + np.exp(-np.clip((points - mean) / deviation * 1.7, -30, 30)))
        levels = np.minimum((share * (1 << LEVEL_BITS)).astype(np.int64), (1 << LEVEL_BITS) - 1)
        arrays = [batch.column("key"), batch.column("number"), batch.column("n")]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(hilbert_keys(levels))], ["key", "number", "n", "curve"])

    narrow = table.select("key", "number", "n", "point").mapInArrow(
        by_batches(on_curve, 10_000), "key long, number long, n long, curve long"
    )
    line = placed(narrow, F.col("curve"), F.col("key"), F.col("number"))
    starts = F.broadcast(part_starts(line, F.col("n")))

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Within a part, which is a contiguous stretch in order, the ids before each row."""
        before: dict[int, int] = {}
        for batch in batches:
            parts, n = batch.column("part").to_numpy(), batch.column("n").to_numpy()
            out = np.zeros(len(n), np.int64)
            for part in np.unique(parts):
                own = parts == part
                ends = np.cumsum(n[own])
                out[own] = before.get(part, 0) + ends - n[own]
                before[part] = before.get(part, 0) + int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("number"), batch.column("n"), batch.column("part"), pa.array(out)],
                ["number", "n", "part", "inner"],
            )

    sums = line.select("number", "n", "part", "seq").repartitionByRange("part").sortWithinPartitions("part", "seq")
    inner = sums.select("number", "n", "part").mapInArrow(running, "number long, n long, part int, inner long")
    places = inner.join(starts, "part").select("number", (F.col("start") + F.col("inner")).alias("place"))
    both = table.select("key", "ids", "number").join(places, "number").select("key", "ids", "place")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                piece = batch.slice(first, 256)
                out: list[list] = [[] for _ in PIECE]
                for name, raw, place in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    ids = np.frombuffer(raw, kind).astype("<u4")
                    n, at = len(ids), 0
                    while at < n:
                        sequence, offset = divmod(place + at, length)
                        size = min(length - offset, n - at)
                        own = ids[at : at + size].tobytes()
                        row = (name, at, size, zlib.crc32(own), n, sequence, offset, own)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                        at += size
                shown = out if with_ids else out[:-1]
                arrays = [
                    pa.array(c, pa.binary() if f == "ids" else pa.int64())
                    for c, f in zip(shown, PIECE, strict=False)
                ]
                yield pa.RecordBatch.from_arrays(arrays, PIECE[: len(shown)])

    shape = ", ".join(f"{f} binary" if f == "ids" else f"{f} long" for f in PIECE if with_ids or f != "ids")
    return both.mapInArrow(cut, shape).withColumnRenamed("key", key)


PIECE = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
