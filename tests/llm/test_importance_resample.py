"""The draw against a plain count of words, and the composed checksums against zlib."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import importance_resample as resample
from larder.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text, longest):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]


def plain_draw(docs, target, longest=1):
    held = [(key, *plain_features(text, longest)) for key, text in docs]
    s, t = Counter(), Counter()
    for _, _, found in held:
        s.update(found)
    for text in target:
        t.update(plain_features(text, longest)[1])
    n, m = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    out = []
    for key, words, found in held:
        gain = [math.floor(1000 * math.log((t[b] + 1) * n / ((s[b] + 1) * m))) for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        name = f"2024:{'' if key is None else key}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(found), weight, score, None, words])
    fit = [row for row in out if row[5] >= 20]
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for rank, row in enumerate(fit[: 10 * len(fit) // 100], 1):
        row[4] = rank
    return Counter(tuple(row[:5]) for row in out)


def texts_of(spark, name, *columns):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet").select(*columns)


def test_query_equals_the_plain_draw(spark):
    docs = [tuple(row) for row in texts_of(spark, "documents", "doc_id", "text").collect()]
    target = [row[0] for row in texts_of(spark, "benchmark", "text").collect()]
    got = Counter(map(tuple, QUERIES["op12_importance_resample"](spark, FOLDER).collect()))
    assert got == plain_draw(docs, target)


def test_runs_of_three_words(spark):
    docs, target = texts_of(spark, "documents", "doc_id", "text"), texts_of(spark, "benchmark", "text")
    got = Counter(map(tuple, resample.resample(docs.limit(200), target, longest=3).collect()))
    assert got == plain_draw([tuple(r) for r in docs.limit(200).collect()], [r[0] for r in target.collect()], 3)


def test_odd_rows(spark, odd_documents, no_documents):
    target = spark.createDataFrame([("the first text",), (None,), ("",)], "text string")
    for documents in (odd_documents, odd_documents.unionByName(odd_documents)):
        got = Counter(map(tuple, resample.resample(documents, target).collect()))
        docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
        assert got == plain_draw(docs, ["the first text"])
    assert resample.resample(no_documents, target).collect() == []
    without = resample.resample(odd_documents, target.where("1 = 0")).collect()
    assert len(without) == odd_documents.count()


@settings(max_examples=80, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text("aB1 .é\n\t-_", max_size=40)), min_size=1, max_size=5), longest=st.integers(1, 4))
def test_features_are_checksums_of_runs(texts, longest):
    raw = [None if text is None else text.encode() for text in texts]
    found, words, counts = resample.features(raw, longest, 10_000)
    ends = np.cumsum(counts)
    for i, text in enumerate(texts):
        n, expected = plain_features(text, longest)
        assert words[i] == n and found[ends[i] - counts[i] : ends[i]].tolist() == expected


@pytest.mark.parametrize("length", [0, 1, 7, 256, 100_000])
def test_composed_checksums(length):
    left, right = b"any left part", b"x" * length
    sums = [np.array([zlib.crc32(part)], np.uint32) for part in (left, right)]
    assert resample.composed(*sums, np.array([length]))[0] == zlib.crc32(left + right)


def test_blocks_hold_every_text():
    texts = [None, b"a" * 10, b"", b"b" * 3, b"c" * 50, None]
    spans = list(resample.blocks(texts, 12))
    assert [i for a, b in spans for i in range(a, b)] == list(range(len(texts)))
