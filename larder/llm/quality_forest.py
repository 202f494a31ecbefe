"""Quality rules: fixed limits first, then an isolation forest on rule statistics.

Every text is reduced to a few rates that quality rules usually test one by one
(symbols, word length, repeated lines and words, variety). An isolation forest cuts
these rates at random; a document that random cuts set apart early is anomalous. The
cut-off on its score comes from all labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batches, col, raw_texts, stored

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Words without a finding that every text is given on top of its own.
LEAN = 30
SPACES = b" \t\n\x0b\x0c\r"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Repeats have a fixed limit of their own and occur in good texts, so the forest has no rate of them.
RATES = ["symbols", "word_length", "top_word", "doubled", "bare_marks"]


def repeated_words(codes: np.ndarray) -> int:
    """How many words lie in a window of eight that is found twice or more."""
    n = len(codes) - WINDOW + 1
    if n < 2:
        return 0
    keys = codes[:n].copy()
    for i in range(1, WINDOW):
        keys *= np.uint64(0x9E3779B97F4A7C15)
        keys += codes[i : i + n]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def statistics(raw: bytes | None) -> tuple[list[int], list[float]]:
    """The base counts of a text, and the rates that the forest cuts."""
    raw = raw or b""
    words = raw.split()
    n = len(words)
    spaces = len(raw) - len(raw.translate(None, SPACES))
    code_points = int((np.frombuffer(raw, np.uint8) & 0xC0 != 0x80).sum())
    chars = code_points - spaces
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    # A line counts if it has a word; equal lines are equal to the last character.
    lines = [line for line in raw.split(b"\n") if line.split()] if b"\n" in raw else []
    dup_lines = len(lines) - len(set(lines))
    if not n:
        return [0, 0, symbols, 0, 0], [0.0] * len(RATES)
    codes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    repeats = repeated_words(codes)
    _, counts = np.unique(codes, return_counts=True)
    doubled = int((codes[1:] == codes[:-1]).sum())
    bare = sum(map(words.count, (b"|", b"-", b"*", b"#")))
    # In a short text one word more is a large share, so counts of words lean to zero there.
    rates = [symbols / n, chars / n, int(counts.max()) / (n + LEAN), doubled / (n + LEAN), bare / n]
    return [n, chars, symbols, dup_lines, repeats], rates


def measured(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the base counts, ``base_failed`` and the array ``rates`` of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [statistics(raw) for raw in raw_texts(batch.column(1))]
        counts = np.array([m[0] for m in made], np.int64).reshape(-1, len(BASE))
        rates = pa.array([m[1] for m in made], pa.list_(pa.float64()))
        arrays = [batch.column(0), *(pa.array(counts[:, i]) for i in range(len(BASE))), rates]
        return pa.RecordBatch.from_arrays(arrays, ["key", *BASE, "rates"])

    slim = df.select(col(key).alias("key"), col(text).cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    shape = f"key {kind}, " + ", ".join(f"{b} long" for b in BASE) + ", rates array<double>"
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return slim.mapInArrow(by_batches(work, 512), shape).withColumn("base_failed", failed)


@dataclass
class IsolationForest:
    """Trees of random cuts; each tree sees a sample of the fitting rows without repeats."""

    features: np.ndarray
    cuts: np.ndarray
    lengths: np.ndarray
    sample: int

    @classmethod
    def fit(cls, rows: np.ndarray, trees: int = 200, sample: int = 256, seed: int = 7):
        rng = np.random.default_rng(seed)
        sample = min(sample, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
        size = (1 << (depth + 1)) - 1
        features = np.full((trees, size), -1, np.int64)
        cuts = np.zeros((trees, size))
        lengths = np.zeros((trees, size))
        for t in range(trees):
            todo = [(0, 0, rows[rng.choice(len(rows), sample, replace=False)])]
            while todo:
                node, at, held = todo.pop()
                low, high = held.min(0), held.max(0)
                open_ = np.flatnonzero(high > low)
                if at == depth or len(held) < 2 or not len(open_):
                    lengths[t, node] = at + expected_length(len(held))
                    continue
                feature = rng.choice(open_)
                cut = rng.uniform(low[feature], high[feature])
                features[t, node], cuts[t, node] = feature, cut
                left = held[:, feature] < cut
                todo.append((2 * node + 1, at + 1, held[left]))
                todo.append((2 * node + 2, at + 1, held[~left]))
        return cls(features, cuts, lengths, sample)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the shorter the mean path, the higher."""
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for features, cuts, lengths in zip(self.features, self.cuts, self.lengths, strict=True):
            node = np.zeros(len(rows), np.int64)
            while True:
                feature = features[node]
                inner = feature >= 0
                if not inner.any():
                    break
                right = rows[each, np.maximum(feature, 0)] >= cuts[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += lengths[node]
        return np.exp2(-total / len(self.features) / max(expected_length(self.sample), 1e-9))


def expected_length(n: int) -> float:
    """The mean path length of an unsuccessful search in a tree of n rows."""
    if n < 2:
        return 0.0
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def cut_off(counts: dict[tuple[int, int], int], steps: int, spare: float, default: float) -> float:
    """The score from which documents go.

    ``counts`` has the labelled rows by score step and label. Of the cut-offs that
    reject no more than the share ``spare`` of good rows, the one with the largest
    share of bad rows rejected less that of good rows; among equals the highest.
    Without rows of both labels the default holds.
    """
    bad, good = np.zeros(steps + 2), np.zeros(steps + 2)
    for (step, label), n in counts.items():
        (good if label else bad)[step] += n
    if not bad.sum() or not good.sum():
        return default
    gone_bad = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gone_good = np.cumsum(good[::-1])[::-1] / good.sum()
    gain = np.where(gone_good <= spare, gone_bad - gone_good, -1.0)
    return float(np.flatnonzero(gain == gain.max()).max() / steps)


def assess(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fit_rows: int = 4096,
    trees: int = 200,
    sample: int = 256,
    spare: float = 0.002,
    default: float = 0.62,
    steps: int = 2000,
) -> DataFrame:
    """``key``, the base counts, ``base_failed``, ``score`` and ``kept`` of every row.

    The forest is fitted on about ``fit_rows`` different combinations of statistics of
    documents that pass the base limits, those with the smallest hashes, so any
    partitioning and any key gives the same ones. The cut-off uses every labelled row
    that passes the base limits, as counts by score step.

    NULL and empty texts have no words and fail the base limits. Rows with a NULL
    key are judged like others; they have no label. Repeated rows and repeated labels
    each count; NULL labels do not. Without documents the result is empty, without
    labels the default cut-off holds. Other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    table = stored(measured(df, key, text), "statistics")
    # Drawn by what the forest sees and nothing else, each combination of statistics once: the
    # key, its name and the number of copies have no say in which forest grows.
    kinds = table.where(~F.col("base_failed")).select(*BASE, "rates").distinct()
    kinds = stored(kinds.withColumn("pick", F.shiftrightunsigned(F.xxhash64(*BASE, "rates"), 11)), "kinds")
    share = min(1.0, fit_rows / max(kinds.count(), 1))
    chosen = kinds.where(F.col("pick") < int(share * (1 << 53))).collect()
    chosen.sort(key=lambda row: (row["pick"], [row[name] for name in BASE], row["rates"]))
    if not chosen:
        none = F.lit(None).cast("double")
        return table.select(
            F.col("key").alias(key), *BASE, "base_failed", none.alias("score"), F.lit(False).alias("kept")
        )
    forest = IsolationForest.fit(np.array([row.rates for row in chosen]), trees, sample)
    sent = spark.sparkContext.broadcast(forest)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rates = batch.column("rates").flatten().to_numpy().reshape(-1, len(RATES))
        columns = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "rates"]
        names = [n for n in batch.schema.names if n != "rates"]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sent.value.score(rates))], [*names, "score"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema if f.name != "rates")
    scored = stored(table.mapInArrow(by_batches(work, 10_000), f"{shape}, score double"), "scores")
    step = F.floor(F.col("score") * steps).cast("int")
    marks = labels.select(col(key).alias("key"), col(label).alias("label"))
    counted = (
        scored.where(~F.col("base_failed"))
        .select("key", step.alias("step"))
        .join(marks.where("key is not null and label is not null"), "key")
        .groupBy("step", (F.col("label") > 0).cast("int").alias("label"))
        .count()
        .collect()
    )
    limit = cut_off({(r["step"], r["label"]): r["count"] for r in counted}, steps, spare, default)
    kept = ~F.col("base_failed") & (step < F.lit(round(limit * steps)))
    return scored.select(F.col("key").alias(key), *BASE, "base_failed", "score", kept.alias("kept"))
