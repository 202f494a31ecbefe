"""Target-distribution importance resampling over hashed word runs.

Every run of neighbouring words is a feature and falls into a bucket by the checksum of
its bytes. An Aho-Corasick automaton over the distinct words of a block of texts, each
between delimiters, finds the words; what it emits is a payload of checksum and length.
The checksum of a run is composed of those of its words, so its bytes are never put
together. Buckets are counted in the corpus and in the target; a document's weight is
the mean gain of its features, and a draw without replacement takes the documents with
the greatest sum of weight and Gumbel noise, which comes from a digest of their key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from math import floor, log
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batches, col, placed, positions, raw_texts, stored

BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 2024, 10, 20
#: Bytes of text that share an automaton, at least one text.
BLOCK = 4 << 20
#: What is no word becomes a blank: everything in ASCII but digits and letters.
_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_LOWER = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
WORD_BYTES = bytes(b if b in _WORD else 0x20 for b in _LOWER)
#: Between the texts of a block; no word and no blank holds it.
BORDER = "\n"


@cache
def _zero_byte_tables() -> list[np.ndarray]:
    """For 1, 2, 4 … zero bytes behind a text: its checksum after them, by byte of the one before.

    The checksum is linear, so four tables of 256 values, one for each of its bytes, are
    summed; those for twice the bytes come from applying them to themselves.
    """
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    values = np.arange(256, dtype=np.uint32)
    one = np.stack([step, *(values << np.uint32(8 * (i - 1)) for i in (1, 2, 3))])
    tables = [one]
    for _ in range(31):
        tables.append(_mapped(tables[-1], tables[-1]))
    return tables


def _mapped(table: np.ndarray, sums: np.ndarray) -> np.ndarray:
    out = table[0][sums & 255]
    for i in (1, 2, 3):
        out = out ^ table[i][(sums >> np.uint32(8 * i)) & 255]
    return out


def composed(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The checksums of texts put together, from those of both parts and the right ones' lengths."""
    out = left.copy()
    for bit, table in enumerate(_zero_byte_tables()):
        if not (length >> bit).any():
            break
        at = np.flatnonzero(length >> bit & 1)
        out[at] = _mapped(table, out[at])
    return out ^ right


class WordAutomaton:
    """The distinct words of a block of texts, with checksum and length as payload."""

    def __init__(self, block: str) -> None:
        words = sorted(set(block.replace(BORDER, " ").split(" ")) - {""})
        raw = [word.encode("latin-1") for word in words]
        self.crc = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw))
        self.spaced = np.fromiter((zlib.crc32(b" " + word) for word in raw), np.uint32, len(raw))
        self.length = np.fromiter(map(len, raw), np.int64, len(raw))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.automaton.add_word(BORDER, -1)
        for i, word in enumerate(words):
            self.automaton.add_word(f" {word} ", i)
        self.automaton.make_automaton()

    def scan(self, block: str) -> tuple[np.ndarray, np.ndarray]:
        """The payload numbers of all words in order, and the number of words of each text."""
        found = np.fromiter(map(itemgetter(1), self.automaton.iter(block)), np.int64)
        borders = np.flatnonzero(found < 0)
        counts = np.diff(borders, prepend=-1) - 1
        return found[found >= 0], counts


def features(texts: list[bytes | None], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of the features of all texts, and the words and features of each text.

    A text's features stand together: all single words first, then runs of two, and so on.
    """
    plain = [(text or b"").translate(WORD_BYTES).decode("latin-1") for text in texts]
    block = "".join(f" {text} {BORDER}" for text in plain)
    words = WordAutomaton(block)
    found, n_words = words.scan(block)
    sums = words.crc[found]
    if longest == 1:
        return sums % np.uint32(buckets), n_words, n_words
    owner = np.repeat(np.arange(len(texts)), n_words)
    made, of = [sums], [owner]
    for size in range(2, longest + 1):
        last = found[size - 1 :]
        if not len(last):
            break
        # Each run takes in the word behind it; runs that leave their text are left out below.
        sums = composed(sums[: len(last)], words.spaced[last], words.length[last] + 1)
        inside = owner[: len(last)] == owner[size - 1 :]
        made.append(sums[inside])
        of.append(owner[: len(last)][inside])
    owners = np.concatenate(of)
    order = np.argsort(owners, kind="stable")
    found = np.concatenate(made)[order] % np.uint32(buckets)
    return found, n_words, np.bincount(owners, minlength=len(texts))


def blocks(texts: list[bytes | None], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes, at least one text each."""
    start = held = 0
    for at, text in enumerate(texts):
        held += len(text or b"")
        if held >= size:
            yield start, at + 1
            start, held = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def scanned(df: DataFrame, longest: int, buckets: int, key: str | None, text: str) -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and the features' buckets, as bytes, of every row."""
    small = np.uint16 if buckets <= 1 << 16 else np.uint32

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw_texts(batch.column(1))
        words, counts, held = [], [], []
        for a, b in blocks(texts):
            found, n_words, n_features = features(texts[a:b], longest, buckets)
            found, ends = found.astype(small), np.cumsum(n_features)
            words.append(n_words)
            counts.append(n_features)
            held.extend(part.tobytes() for part in np.split(found, ends[:-1]))
        arrays = [
            batch.column(0),
            pa.array(np.concatenate(words), pa.int64()),
            pa.array(np.concatenate(counts), pa.int64()),
            pa.array(held, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["key", "n_words", "n_features", "held"])

    number = F.lit(None).cast("long") if key is None else col(key)
    slim = df.select(number.alias("key"), col(text).cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    shape = f"key {kind}, n_words long, n_features long, held binary"
    return slim.mapInArrow(by_batches(work, 1024), shape)


def counted(table: DataFrame, buckets: int) -> np.ndarray:
    """How many features of the whole table fall into each bucket; a task sends its sums once."""
    small = np.uint16 if buckets <= 1 << 16 else np.uint32

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch.column(0).to_pylist():
                sums += np.bincount(np.frombuffer(held, small), minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    sums = table.select("held").mapInArrow(work, "bucket long, n long")
    for row in sums.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of a bucket's smoothed shares in target and corpus, floored."""
    n, held, wanted = len(corpus), float(corpus.sum()), float(target.sum())
    ratios = [
        (float(t) + 1.0) * (held + n) / ((float(s) + 1.0) * (wanted + n))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array([floor(1000 * log(ratio)) for ratio in ratios], np.int64)


def resample(
    df: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row.

    Of the rows with ``least_words`` words the given percentage, rounded down, is drawn:
    those with the greatest scores, ties by the smaller key, ranked from 1. The others
    have no rank. Features are runs of up to ``longest`` words, counted over all rows of
    both tables.

    A NULL or empty text has no words, no features and weight 0. A NULL key takes the
    noise of an empty key and comes last among ties; repeated rows are rows of their own,
    with equal scores and successive ranks. Without a corpus the result is empty, without
    a target every bucket's target count is 0. Other columns are not read.
    """
    spark = df.sparkSession
    small = np.uint16 if buckets <= 1 << 16 else np.uint32
    table = stored(scanned(df, longest, buckets, key, text), "features")
    wanted = counted(scanned(target, longest, buckets, None, text), buckets)
    sent = spark.sparkContext.broadcast(gains(counted(table, buckets), wanted))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights = []
        for held in batch.column("held").to_pylist():
            at = np.frombuffer(held, small)
            weights.append(int(sent.value[at].sum()) // len(at) if len(at) else 0)
        arrays = [*batch.columns[:3], pa.array(weights, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["key", "n_words", "n_features", "weight"])

    kind = table.schema["key"].dataType.simpleString()
    shape = f"key {kind}, n_words long, n_features long, weight long"
    weighed = table.mapInArrow(by_batches(work, 4096), shape)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    drawn = F.conv(F.left(F.sha2(name.cast("binary"), 256), F.lit(8)), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296)))
    scored = weighed.withColumn("score", F.col("weight") + noise.cast("long"))
    scored = scored.withColumn("fit", F.col("n_words") >= least_words)
    ordered = placed(scored, F.desc("fit"), F.desc("score"), F.asc_nulls_last("key"), F.col("n_features"))
    quota = ordered.where("fit").count() * percent // 100
    place = F.col("position") + 1
    rank = F.when(place <= quota, place).cast("long")
    made = positions(ordered).withColumn("rank", rank)
    return made.select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
