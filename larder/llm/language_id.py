"""Language identification: sparse multinomial logistic regression on character n-grams.

Letters become classes (a hash beyond ASCII), everything else is a word border, and
each run of one, two and three classes is a feature with a TF-IDF weight: its share
of the text's n-grams times the logarithm of the inverse document frequency over all
training documents. Weights are learnt online by follow-the-regularised-leader with
elastic-net penalties, which leaves most of them at zero. A temperature fitted on
documents the learner has not seen turns the margins into calibrated probabilities.

As tf is linear in the text, one table over the three-letter runs holds everything
a prediction needs, and predicting is one look-up for each letter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batches, col
from larder.llm.tokens import chunks

BITS = 6
CLASSES = 1 << BITS
THREE = CLASSES**3
TWO = CLASSES**2
FEATURES = THREE + TWO + CLASSES
UNKNOWN = "und"
#: Characters handled at once; they take some forty bytes each on the way.
CHUNK = 400_000

_TABLE: np.ndarray | None = None


def letter_classes() -> np.ndarray:
    """The class of every code point: 1 to 26 for a-z, a hash for other letters, else 0."""
    global _TABLE
    if _TABLE is None:
        table = np.zeros(0x110000, np.uint8)
        for point in range(0x110000):
            letter = chr(point)
            if letter.isalpha():
                low = ord(letter.lower()[0])
                plain = 97 <= low <= 122
                table[point] = low - 96 if plain else 27 + low * 0x9E3779B1 % 0xFFFFFFFF % (CLASSES - 27)
        _TABLE = table
    return _TABLE


def runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three-class runs of all texts in a row, where each text's begin, and letters per text.

    A text's letters stand between word borders, and the run at each place is that of
    the place and its two followers; runs that begin with two borders are left out.
    """
    joined = "".join(f" {text or ''}  " for text in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = letter_classes()[points].astype(np.int32)
    sizes = np.fromiter((len(text or "") + 3 for text in texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    first, second = codes[:-2], codes[1:-1]
    grams = (first << 2 * BITS) | (second << BITS) | codes[2:]
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(grams)]
    use = (first > 0) | (second > 0)
    # A run that starts in the last two places of a text is that of two borders.
    grams, owner = grams[use], owner[use]
    letters = np.add.reduceat(np.append(codes > 0, False), ends - sizes) if len(texts) else ends
    starts = np.searchsorted(owner, np.arange(len(texts)))
    return grams, starts, letters.astype(np.int64)


def features_of(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of one text and how often each occurs."""
    three, n3 = np.unique(grams, return_counts=True)
    two = np.bincount(three >> BITS, weights=n3, minlength=TWO)
    one = np.bincount(three >> 2 * BITS, weights=n3, minlength=CLASSES)
    at2, at1 = np.flatnonzero(two), np.flatnonzero(one)
    return (
        np.concatenate([three, THREE + at2, THREE + TWO + at1]),
        np.concatenate([n3, two[at2], one[at1]]),
    )


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The margins of every text, and whether it has a letter."""
        grams, starts, letters = runs(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        sizes = np.diff(np.append(starts, len(grams)))
        full = np.flatnonzero(sizes)
        if len(full):
            gathered = self.table[grams]
            sums[full] = np.add.reduceat(gathered, starts[full], axis=0, dtype=np.float64)
        return sums / np.maximum(sizes, 1)[:, None] + self.bias, letters > 0


def softmax(margins: np.ndarray) -> np.ndarray:
    shifted = np.exp(margins - margins.max(-1, keepdims=True))
    return shifted / shifted.sum(-1, keepdims=True)


def learn(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    l1: float,
    l2: float,
    alpha: float = 0.3,
    beta: float = 1.0,
    epochs: int = 3,
    seed: int = 11,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader, one document at a time.

    A document comes as its features, their TF-IDF values and its class. Each weight
    has a gradient sum and a step size of its own; it stays zero until the sum
    exceeds ``l1``, and ``l2`` shrinks it.
    """
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        sums = z[at]
        free = np.abs(sums) - l1 * (at < FEATURES)[:, None]
        return np.where(free > 0, -np.sign(sums) * free / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, values, label = rows[i]
            at, values = np.append(at, FEATURES), np.append(values, 1.0)
            w = weights(at)
            error = softmax(values @ w)
            error[label] -= 1.0
            step = values[:, None] * error
            more = n[at] + step**2
            z[at] += step - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    all_weights = weights(np.arange(FEATURES + 1))
    return all_weights[:-1], all_weights[-1]


def calibrated(margins: np.ndarray, labels: np.ndarray) -> float:
    """The temperature under which the labels are likeliest, between 1/20 and 20."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(margins / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high = -3.0, 3.0
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all training texts each feature occurs, and the number of texts.

    Every task sends its features once; the sums have one row for each feature.
    """

    def work(batches):
        counts, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                texts = batch.column(0).slice(start, 256).to_pylist()
                for a, b in chunks(texts, CHUNK):
                    grams, starts, _ = runs(texts[a:b])
                    for own in np.split(grams, starts[1:]):
                        counts[features_of(own)[0]] += 1
                n += len(texts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(counts[at], n))], ["feature", "n"]
        )

    sums = training.select("text").mapInArrow(work, "feature long, n long")
    out, total = np.zeros(FEATURES, np.int64), 0
    for row in sums.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        if row["feature"] < 0:
            total = row["n"]
        else:
            out[row["feature"]] = row["n"]
    return out, total


def fit(
    training: DataFrame,
    rows_per_language: int = 1500,
    most_languages: int = 500,
    l1: float = 0.02,
    l2: float = 0.01,
    scale: float = 30.0,
) -> LanguageModel | None:
    """A model from the columns ``text``, ``lang`` and ``pick``, a hash of the row.

    Document frequencies count every row. The weights are learnt from a sample of
    about ``rows_per_language`` rows of each language, those with the smallest hashes,
    of which every fifth is left to the temperature. NULL without a labelled row.
    """
    counts = training.groupBy("lang").count().orderBy("lang").limit(most_languages + 1).collect()
    if not counts:
        return None
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = [row["lang"] for row in counts]
    frequency, total = document_frequencies(training)
    idf = scale * np.log((1 + total) / (1 + frequency))
    span = 1 << 53
    limit = F.lit(0).cast("long")
    for row in counts:
        share = min(1.0, rows_per_language / row["count"])
        limit = F.when(F.col("lang") == row["lang"], F.lit(int(share * span))).otherwise(limit)
    place = F.shiftrightunsigned(F.col("pick"), 11)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, made = batch.column(0).to_pylist(), []
        for a, b in chunks(texts, CHUNK):
            grams, starts, _ = runs(texts[a:b])
            made.extend(features_of(own) for own in np.split(grams, starts[1:]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([at.astype(np.int32).tobytes() for at, _ in made], pa.binary()),
                pa.array([n.astype(np.float32).tobytes() for _, n in made], pa.binary()),
                *batch.columns[1:],
            ],
            ["at", "n", "lang", "pick"],
        )

    sample = training.where(place < limit).select("text", "lang", "pick")
    drawn = sample.mapInArrow(by_batches(work, 256), "at binary, n binary, lang string, pick long")
    number = {name: i for i, name in enumerate(languages)}
    learn_rows, test_rows = [], []
    for row in sorted(drawn.collect(), key=lambda r: (r["pick"], r["lang"], r["at"])):
        at, n = np.frombuffer(row["at"], np.int32), np.frombuffer(row["n"], np.float32)
        grams = max(float(n[at < THREE].sum()), 1.0)
        one = (at, n / grams * idf[at], number[row["lang"]])
        (test_rows if row["pick"] % 5 == 0 else learn_rows).append(one)
    weights, bias = learn(learn_rows, len(languages), l1, l2)
    margins = np.array([values @ weights[at] + bias for at, values, _ in test_rows])
    temperature = calibrated(margins, np.array([label for *_, label in test_rows], int))
    weights = weights * idf[:, None]
    every = np.arange(THREE)
    table = weights[:THREE] + weights[THREE + (every >> BITS)] + weights[THREE + TWO + (every >> 2 * BITS)]
    return LanguageModel(languages, table.astype(np.float32), bias, temperature)


def identify(
    df: DataFrame,
    learn_from: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = 1500,
) -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (its probability) of every row.

    The model learns from rows where ``learn_from`` holds and text and language are
    not NULL; a prediction sees nothing but the text. Texts that are NULL or have no
    letter are ``und`` with score zero, and so is every text if nothing can be learnt.
    Ties go to the language first in the alphabet. Repeated rows stay repeated, NULL
    keys stay NULL, and other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    training = df.where(learn_from & col(text).isNotNull() & col(lang).isNotNull()).select(
        col(text).cast("string").alias("text"),
        col(lang).cast("string").alias("lang"),
        F.xxhash64(col(key).cast("string"), col(text).cast("string")).alias("pick"),
    )
    model = fit(training, rows_per_language)
    sent = spark.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        model = sent.value
        if model is None:
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        else:
            parts = [model.margins(texts[a:b]) for a, b in chunks(texts, CHUNK)]
            margins = np.concatenate([m for m, _ in parts])
            lettered = np.concatenate([has for _, has in parts])
            p = softmax(margins / model.temperature)
            best = p.argmax(1)
            names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
            scores = np.where(lettered, p.max(1), 0.0)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names), pa.array(scores)], ["key", "lang_pred", "score"]
        )

    slim = df.select(col(key).alias("key"), col(text).cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    out = slim.mapInArrow(by_batches(work, 128), f"key {kind}, lang_pred string, score double")
    return out.select(F.col("key").alias(key), "lang_pred", "score")
