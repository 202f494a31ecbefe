"""SimHash near-duplicates by an inverted index over byte positions.

Two fingerprints of 64 bits that differ in at most two bits share at least six of
their eight positional bytes. The index therefore has one posting list for each
choice of six positions and the bytes found there; a pair on a common list has
reached the guaranteed count of shared bytes by construction, and is verified by
counting the bits that differ. Lists of single positions would hold a 256th of the
corpus each and give all its pairs; on lists of six, 48 of 64 bits agree, so no
list can be longer than 65,536 fingerprints however many documents there are.

Equal fingerprints are one entry of the index. From each list only a spanning set
of verified links leaves the task, and links become components by rounds of star
contraction, each round a written table.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batches, col, raw_texts, stored

SEED = 42
BYTES = 8
#: Lists up to this size are compared as a matrix; longer ones by looking neighbours up.
MATRIX = 256


def simhash(raw: bytes | None, words: int = 3) -> int:
    """The fingerprint of a text: each bit set in over half of its shingles' hashes.

    Words are runs without ASCII white space after A-Z became a-z. A text of fewer
    words than a shingle is one shingle; one without words has fingerprint zero.
    """
    found = raw.lower().split() if raw else []
    if not found:
        return 0
    if len(found) < words:
        grams = iter([b" ".join(found)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
        n = len(found) - words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3):
    """``key`` and ``fp`` (the fingerprint as a signed long) of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [simhash(raw, words) for raw in raw_texts(batch.column(1))]
        signed = np.array(values, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["key", "fp"])

    slim = df.select(col(key).alias("key"), col(text).cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    return slim.mapInArrow(by_batches(work, 256), f"key {kind}, fp long")


def positional_masks(bits: int) -> list[tuple[int, list[int]]]:
    """The masks of every choice of byte positions that a pair must share, and the free bits."""
    shared = BYTES - bits
    if shared < 6:
        raise ValueError("the index takes a distance of two bits at most")
    masks = []
    for chosen in combinations(range(BYTES), shared):
        mask = sum(0xFF << (8 * i) for i in chosen)
        masks.append((mask, [b for b in range(64) if not mask >> b & 1]))
    return masks


def spanning_links(list_: np.ndarray, free: list[int], bits: int) -> np.ndarray:
    """Links (a, b) that join exactly what the verified pairs of one list join."""
    values = np.unique(list_)
    n = len(values)
    if n < 2:
        return np.zeros((0, 2), np.uint64)
    label = np.arange(n)
    if n <= MATRIX:
        close = np.bitwise_count(values[:, None] ^ values[None, :]) <= bits

        def spread(label: np.ndarray) -> np.ndarray:
            return np.where(close, label[None, :], n).min(1)

    else:
        flips = [sum(1 << b for b in some) for k in range(1, bits + 1) for some in combinations(free, k)]
        neighbours = []
        for flip in flips:
            other = values ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(values, other), n - 1)
            hit = np.flatnonzero(values[at] == other)
            if len(hit):
                neighbours.append((hit, at[hit]))

        def spread(label: np.ndarray) -> np.ndarray:
            out = label.copy()
            for hit, at in neighbours:
                out[hit] = np.minimum(out[hit], out[at])
            return out

    while True:
        new = spread(label)
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(n))
    return np.stack([values[member], values[label[member]]], 1)


def links(prints: DataFrame, bits: int = 2) -> DataFrame:
    """Spanning links ``u``, ``v`` between the distinct fingerprints of column ``fp``."""
    masks = positional_masks(bits)
    free = [f for _, f in masks]

    def signed(mask: int) -> int:
        return mask - (1 << 64) if mask >> 63 else mask

    entries = prints.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m, _ in masks])).alias(
            "choice", "shared"
        ),
    )
    lists = (
        entries.groupBy("choice", "shared")
        .agg(F.collect_list("fp").alias("list"))
        .where(F.size("list") > 1)
        .select("choice", "list")
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        column = batch.column(1)
        values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        edges = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
        for i, choice in enumerate(batch.column(0).to_pylist()):
            found.append(spanning_links(values[edges[i] : edges[i + 1]], free[choice], bits))
        both = np.concatenate(found or [np.zeros((0, 2), np.uint64)]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])

    return lists.mapInArrow(by_batches(work, 1000), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node that has an edge ``u``, ``v``.

    Alternating star contraction: every node hands the least of its neighbours to the
    greater ones, then to the smaller ones, until each component is one star. A round
    is a few shuffles of the edges, and hot centres are met by least-value aggregates
    and by joins that adaptive execution may split, never by a group in one task.
    """
    edges = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")),
        "edges",
    )

    def state(table: DataFrame) -> tuple:
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        return tuple(table.agg(F.count(F.lit(1)), mark).first())

    before = state(edges)
    if not before[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        least = stored(least.select("u", F.least("u", "least").alias("least")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("least")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.where("u <> v").union(least.select("u", F.col("least").alias("v")))
        edges = stored(small.distinct(), "edges")
        after = state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, bits: int = 2
) -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id`` of every row of a table.

    Rows are linked when their fingerprints differ in ``bits`` bits at most, and the
    component is named by the smallest key that links lead to, the row's own included.

    NULL and empty texts have fingerprint zero and are linked like any other. Repeated
    rows stay repeated. A NULL key gets the component of its fingerprint, which is
    NULL only where no member has a key. An empty table gives an empty result, and
    other columns are not read, whatever their names.
    """
    prints = stored(fingerprints(df, key, text, words), "prints")
    groups = stored(prints.groupBy("fp").agg(F.min("key").alias("least")), "groups")
    roots = components(links(groups, bits))
    known = groups.join(roots, F.col("fp") == F.col("node"), "left")
    known = stored(known.select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    names = stored(known.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    named = stored(known.join(names, "root").select("fp", "component_id"), "named")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select(
        F.col("key").alias(key), shown.alias("fingerprint"), "component_id"
    )
