"""Held-out accuracy of the classifier, and its parts against plain forms."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import quality_network as network
from larder.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_unseen_labels_are_predicted(spark):
    got = QUERIES["op13_quality_network"](spark, FOLDER).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for row in got:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3)
    unseen = [(r["predicted"], labels[r["doc_id"]], r["score"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == q for p, q, _ in unseen]) >= 0.95
    good, bad = ([s for _, q, s in unseen if q == wanted] for wanted in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) >= 0.98


def test_scores_do_not_depend_on_keys_or_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    flipped = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    one = {r["doc_id"]: r["score"] for r in network.score(docs, labels, learn).collect()}
    assert one == {r["doc_id"]: r["score"] for r in network.score(docs.repartition(5), flipped, learn).collect()}
    texts = docs.select(F.concat(F.lit("n"), F.col("doc_id").cast("string")).alias("name"), "text")
    names = labels.where(learn).select(F.concat(F.lit("n"), F.col("doc_id").cast("string")).alias("name"), "quality")
    named = network.score(texts, names, F.lit(True), key="name").collect()
    assert {int(r["name"][1:]): r["score"] for r in named} == one


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(0, 1), (7, 0), (None, 1), (1, None), (0, 1), (3, 0)], "doc_id long, quality int")
    got = network.score(odd_documents, labels, F.lit(True)).collect()
    assert len(got) == odd_documents.count()
    empty = [r["score"] for r, d in ((r, r["doc_id"]) for r in got) if d in (2,)]
    assert len(empty) == 1 and 0 <= empty[0] <= 1
    none = network.score(odd_documents, labels.where("1 = 0"), F.lit(True)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)}
    assert network.score(no_documents, labels, F.lit(True)).collect() == []


def plain_words(text):
    kinds = ["" if not network.KINDS[b] else "w" if network.KINDS[b] == 1 else "m" for b in text]
    words = []
    for i, (byte, kind) in enumerate(zip(text, kinds, strict=True)):
        if kind and i and kinds[i - 1] == kind:
            words[-1] += bytes([byte])
        elif kind:
            words.append(bytes([byte]))
    return words


@pytest.mark.parametrize("text", [b"one", b"It's 3x $$$ ok!! \xc3\xa9t\xc3\xa9", b" \n ", b"a b a b"])
def test_words_have_one_bucket_each(text):
    found, _ = network.buckets([(0, text)])
    words = plain_words(text)
    assert len(found) == len(words)
    single = [network.buckets([(0, word)])[0][0] for word in words]
    assert found.tolist() == single


def test_pieces_hold_all_bytes():
    texts = [None, b"", b"word " * 50, b"x" * 70, b"short"]
    held = [piece for group in network.pieces(texts, 32) for piece in group]
    for i, text in enumerate(texts):
        assert b"".join(part for number, part in held if number == i) == (text or b"")
    assert all(part.endswith(b" ") for number, part in held if number == 2)


def test_pooling_a_long_text_in_pieces(monkeypatch):
    table = np.random.default_rng(0).normal(size=(network.WORDS, network.SIZE)).astype(np.float32)
    text = b"some words and $$$ marks, " * 40
    whole = network.pooled([text, b"", None], table)
    found, _ = network.buckets([(0, text)])
    assert np.allclose(whole[0], table[found].mean(0), atol=1e-5) and not whole[1:].any()


def test_neighbours_make_the_vectors(spark):
    df = spark.createDataFrame([("one two three",), (None,), ("one two",)], "text string")
    table = network.word_vectors(df)
    places, signs = network.index_vectors()
    number = {w: network.buckets([(0, w.encode())])[0][0] for w in ("one", "two", "three")}
    own = np.zeros((network.WORDS, network.SIZE))
    np.add.at(own, (np.arange(network.WORDS)[:, None], places), signs)
    near = 2 * own[number["two"]] + own[number["three"]]
    expected = near / max(np.linalg.norm(near), 1) + own[number["one"]]
    assert np.allclose(table[number["one"]], expected / np.linalg.norm(expected), atol=1e-6)


def test_network_learns_what_no_line_parts():
    rng = np.random.default_rng(1)
    rows = np.zeros((2000, network.SIZE))
    rows[:, :2] = rng.normal(size=(2000, 2))
    labels = (rows[:, 0] * rows[:, 1] > 0).astype(float)
    model = network.Network.fit(rows[:1500], labels[:1500], np.ones(1500), epochs=80)
    assert ((model.scores(rows[1500:]) >= 0.5) == labels[1500:]).mean() > 0.8


def test_temperature_follows_the_labels():
    rng = np.random.default_rng(2)
    chance = rng.uniform(size=20_000)
    labels = (rng.uniform(size=20_000) < chance).astype(float)
    margins = 3 * np.log(chance / (1 - chance))
    assert network.calibrated(margins, labels, np.ones(len(labels))) == pytest.approx(3, rel=0.1)
