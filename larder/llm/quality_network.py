"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every word bucket has a fixed sparse index vector of a few random signs. The vector of a
bucket is the sum of its neighbours' index vectors over all documents, so words used
alike point alike, and its own. A document is the mean of its words' unit vectors.
A network of two layers, fitted in numpy on labelled documents, turns it into a margin,
and a temperature fitted on documents the network has not seen turns that into a
probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batches, col, raw_texts, stored

BITS = 15
WORDS, SIZE, SIGNS, REACH = 1 << BITS, 64, 2, 2
#: Words whose sums travel together.
GROUP = 512
THRESHOLD = 0.3
#: Bytes of text handled at once, and the longest piece of a text: a longer one is cut at a blank.
PIECE = 1 << 20
#: Blanks part words; runs of letters and digits are words, and so are runs of other marks.
KINDS = np.full(256, 2, np.uint8)
KINDS[[0x20, *range(0x09, 0x0E)]] = 0
KINDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
POWERS = np.cumprod(np.full(64, 0x01000193, np.uint32), dtype=np.uint32)


def index_vectors(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The places and signs of every bucket's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, SIZE, (WORDS, SIGNS)), rng.choice([-1, 1], (WORDS, SIGNS)).astype(np.int64)


def pieces(texts: list[bytes | None], most: int = PIECE) -> Iterator[list[tuple[int, bytes]]]:
    """Groups of (number of the text, piece of it) of about so many bytes; all bytes, once."""
    held, size = [], 0
    for number, text in enumerate(texts):
        at = 0
        while text is not None and at < len(text):
            end = min(at + most, len(text))
            if end < len(text):
                blank = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
                end = blank + 1 if blank > at else end
            held.append((number, text[at:end]))
            size += end - at
            at = end
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def buckets(held: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word in order, and the place in the list of the piece it is in."""
    raw = np.frombuffer(b"\n".join(text for _, text in held) + b"\n", np.uint8)
    kind = KINDS[raw]
    starts = np.append(0, np.flatnonzero(kind[1:] != kind[:-1]) + 1)
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
    sums = np.add.reduceat((raw.astype(np.uint32) + 1) * POWERS[place & 63], starts, dtype=np.uint32)
    use = kind[starts] > 0
    sums, starts = sums[use], starts[use]
    sums ^= sums >> np.uint32(15)
    sums *= np.uint32(0x2C1B3C6D)
    sums ^= sums >> np.uint32(12)
    begins = np.cumsum([0, *(len(text) + 1 for _, text in held)])
    owner = np.searchsorted(begins, starts, side="right") - 1
    return (sums >> np.uint32(32 - BITS)).astype(np.int64), owner


def word_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """The unit vector of every bucket from the neighbours within REACH words, over all rows.

    A task adds its documents up in one table of fixed size and sends the parts of it
    that are not zero, compressed; the parts are added one at a time.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros(WORDS * SIZE, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                for held in pieces(raw_texts(batch.column(0).slice(start, 1024))):
                    found, owner = buckets(held)
                    for reach in range(1, REACH + 1):
                        near = owner[reach:] == owner[:-reach]
                        left, right = found[:-reach][near], found[reach:][near]
                        for one, other in ((left, right), (right, left)):
                            for i in range(SIGNS):
                                np.add.at(sums, one * SIZE + places[other, i], signs[other, i])
        table = sums.reshape(-1, GROUP * SIZE)
        full = np.flatnonzero(table.any(1))
        packed = [pa.compress(table[i].tobytes(), "zstd", asbytes=True) for i in full]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(packed, pa.binary())], ["part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums = np.frombuffer(pa.decompress(packed, GROUP * SIZE * 8, "zstd"), np.int64)
                total[part] = total[part] + sums if part in total else sums
        if total:
            held = [pa.compress(sums.tobytes(), "zstd", asbytes=True) for sums in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(held, pa.binary())], ["part", "sums"])

    shape = "part int, sums binary"
    slim = df.select(col(text).cast("string").alias("text"))
    made = slim.mapInArrow(work, shape).repartition("part").mapInArrow(add, shape)
    table = np.zeros((WORDS // GROUP, GROUP * SIZE))
    for row in made.collect():  # one row for each part of the table, whatever the input
        table[row["part"]] = np.frombuffer(pa.decompress(row["sums"], GROUP * SIZE * 8, "zstd"), np.int64)
    table = table.reshape(WORDS, SIZE)
    places, signs = index_vectors()
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1)
    np.add.at(table, (np.arange(WORDS)[:, None], places), signs)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[bytes | None], table: np.ndarray) -> np.ndarray:
    """The mean of the words' vectors of every text; zeros for a text without words."""
    sums, n = np.zeros((len(texts), SIZE)), np.zeros(len(texts))
    for held in pieces(texts):
        found, owner = buckets(held)
        if not len(found):
            continue
        starts = np.append(0, np.flatnonzero(owner[1:] != owner[:-1]) + 1)
        numbers = np.array([number for number, _ in held])[owner[starts]]
        np.add.at(sums, numbers, np.add.reduceat(table[found], starts, axis=0))
        np.add.at(n, numbers, np.diff(starts, append=len(found)))
    return (sums / np.maximum(n, 1)[:, None]).astype(np.float32)


@dataclass
class Network:
    """Two layers over standardised vectors, and the temperature of their margin."""

    mean: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float = 1.0

    def margins(self, rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh(_wide((rows - self.mean) / self.spread) @ self.first)
        return _wide(hidden) @ self.second

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _chance(self.margins(rows) / self.temperature)

    @classmethod
    def fit(
        cls,
        rows: np.ndarray,
        labels: np.ndarray,
        weights: np.ndarray,
        hidden: int = 32,
        epochs: int = 60,
        batch: int = 64,
        rate: float = 0.01,
        decay: float = 1e-4,
        seed: int = 3,
    ) -> Network:
        """By Adam on the weighted log loss; every fifth row is left to the temperature."""
        rng = np.random.default_rng(seed)
        kept = np.arange(len(rows)) % 5 == 0 if len(rows) >= 50 else np.zeros(len(rows), bool)
        x, y, w = rows[~kept].astype(np.float64), labels[~kept], weights[~kept] / weights[~kept].mean()
        model = cls(
            x.mean(0),
            x.std(0) + 1e-6,
            rng.normal(0, 1 / np.sqrt(SIZE), (SIZE + 1, hidden)),
            rng.normal(0, 1 / np.sqrt(hidden), hidden + 1),
        )
        x = _wide((x - model.mean) / model.spread)
        values = [model.first, model.second]
        means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        step = 0
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                inner = np.tanh(x[at] @ model.first)
                wide = _wide(inner)
                error = (_chance(wide @ model.second) - y[at]) * w[at] / len(at)
                back = error[:, None] * model.second[:-1] * (1 - inner**2)
                step += 1
                for i, slope in enumerate((x[at].T @ back, wide.T @ error)):
                    slope = slope + decay * values[i]
                    means[i] = 0.9 * means[i] + 0.1 * slope
                    squares[i] = 0.999 * squares[i] + 0.001 * slope**2
                    lean = np.sqrt(squares[i] / (1 - 0.999**step)) + 1e-8
                    values[i] -= rate * (1 - epoch / epochs) * means[i] / (1 - 0.9**step) / lean
        model.temperature = calibrated(model.margins(rows[kept]), labels[kept], weights[kept])
        return model


def _wide(rows: np.ndarray) -> np.ndarray:
    """The rows with a one at the end, for the bias."""
    return np.concatenate([rows, np.ones((len(rows), 1))], axis=1)


def _chance(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins, -40, 40)))


def calibrated(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The temperature from 1/20 to 20 under which the labels are likeliest; 1 without any."""
    if not len(labels):
        return 1.0
    tried = np.exp(np.linspace(-3, 3, 601))
    sides = np.where(labels > 0, margins, -margins)
    loss = [float((weights * np.logaddexp(0, -sides / t)).sum()) for t in tried]
    return float(tried[int(np.argmin(loss))])


def score(
    df: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fit_rows: int = 20_000,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``key``, ``score`` (the probability of label 1) and ``predicted`` of every row.

    Word vectors come from all texts. The network is fitted on labelled rows where
    ``learn_from``, a condition on the key, holds: on about ``fit_rows`` distinct vectors at
    most, those with the smallest hashes, each weighted by its number of rows.
    A score depends on nothing but the text. NULL and empty texts score like a
    document without words; NULL keys have no label; labels of one key each count,
    NULL ones do not. Without any label every score is 0.5, and without
    documents the result is empty. Other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(word_vectors(df, text))

    def pool(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = pooled(raw_texts(batch.column(1)), sent.value)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["key", "vector"])

    slim = df.select(col(key).alias("key"), col(text).cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    vectors = stored(slim.mapInArrow(by_batches(pool, 512), f"key {kind}, vector binary"), "vectors")
    marks = labels.where(learn_from & col(key).isNotNull() & col(label).isNotNull())
    marks = marks.select(col(key).alias("key"), (col(label) > 0).cast("int").alias("label"))
    marked = vectors.join(marks, "key").groupBy("vector", "label").agg(F.count("*").alias("n"))
    marked = stored(marked.withColumn("pick", F.shiftrightunsigned(F.xxhash64("vector"), 11)), "marked")
    share = min(1.0, fit_rows / max(marked.count(), 1))
    drawn = marked.where(F.col("pick") < int(share * (1 << 53))).collect()
    drawn.sort(key=lambda row: (row["pick"], row["vector"], row["label"]))
    if not drawn:
        return vectors.select(F.col("key").alias(key), F.lit(0.5).alias("score"), F.lit(int(threshold <= 0.5)).alias("predicted"))
    rows = np.array([np.frombuffer(row["vector"], np.float32) for row in drawn])
    said, often = (np.array([float(row[name]) for row in drawn]) for name in ("label", "n"))
    model = spark.sparkContext.broadcast(Network.fit(rows, said, often))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([np.frombuffer(v, np.float32) for v in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.scores(rows))], ["key", "score"])

    judged = vectors.mapInArrow(by_batches(judge, 8192), f"key {kind}, score double")
    return judged.select(F.col("key").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
