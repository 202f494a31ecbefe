"""The registered queries against their SQL, or against brute force, on a small table."""

import re
import zlib
from html import unescape
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from larder.llm import shard_shuffle
from larder.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


def rows_of(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = connection.execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    expected = sorted(map(repr, cursor.fetchall()))
    got = sorted(repr(tuple(r[n] for n in names)) for r in rows_of(spark, name))
    assert expected and got == expected


def test_html_is_the_article(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = rows_of(spark, "op1_html_template")
    assert len(got) == len(pages)
    for row in got:
        article = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(b for b in blocks if b)
        assert row["n_chars"] == len(row["text"])


def plain_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, documents):
    keys = sorted(documents)
    prints = np.array([plain_simhash(documents[k]["text"]) for k in keys], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    label = np.array(keys)
    while True:
        new = np.where(near, label[None, :], label.max() + 1).min(1)
        if (new == label).all():
            break
        label = new
    expected = {k: (f"{p:016x}", c) for k, p, c in zip(keys, prints.tolist(), label.tolist(), strict=True)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows_of(spark, "op2_simhash_links")}
    assert got == expected


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts_and_verdicts(spark, documents):
    got = {r["doc_id"]: r for r in rows_of(spark, "op3_quality_forest")}
    assert set(got) == set(documents)
    for key, row in got.items():
        n, *rest = plain_statistics(documents[key]["text"])
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n, *rest)
        assert row["base_failed"] == (n < 20 or 100 * rest[-1] > 30 * n)
        assert not (row["base_failed"] and row["kept"])
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    passed = [(r["quality"], got[r["doc_id"]]["kept"]) for r in labels if not got[r["doc_id"]]["base_failed"]]
    good = [kept for quality, kept in passed if quality]
    bad = [kept for quality, kept in passed if not quality]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.2 * len(bad)


def test_shards(spark, documents):
    got = rows_of(spark, "op4_shard_shuffle")
    assert sorted(r["doc_id"] for r in got) == sorted(documents)
    counts = np.bincount([r["shard"] for r in got], minlength=16)
    assert counts.max() - counts.min() <= 1
    assert sorted((r["shard"], r["slot"]) for r in got) == [(s, i) for s in range(16) for i in range(counts[s])]
    for r in got:
        raw = (documents[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_shard_digests_come_from_the_shards(spark, monkeypatch):
    real = shard_shuffle.shuffled
    monkeypatch.setattr(shard_shuffle, "shuffled", lambda *a: real(*a).withColumn("text", F.lit("x")))
    assert {(r["size"], r["text_crc32"]) for r in rows_of(spark, "op4_shard_shuffle")} == {(2, zlib.crc32(b"x"))}


def test_token_store(spark, documents, words_file):
    coder, start = Tokenizer.from_file(words_file), 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows_of(spark, "op5_token_store")}
    for key in sorted(documents):
        ids = [*coder.encode(documents[key]["text"] or "", add_special_tokens=False).ids, 1]
        assert got[key] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_language_on_rows_held_out(spark, documents):
    got = rows_of(spark, "op8_language_id")
    assert len(got) == len(documents)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    unseen = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in unseen) >= 0.97 * len(unseen)


def test_packing(spark, documents, bytes_file):
    coder = Tokenizer.from_file(bytes_file)
    ids = {
        k: np.array([*coder.encode(d["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for k, d in documents.items()
    }
    check_pieces(rows_of(spark, "op10_curve_pack"), ids)


def check_pieces(got, ids):
    ends, places = dict.fromkeys(ids, 0), {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == ends[r["doc_id"]] and r["doc_tokens"] == len(own)
        ends[r["doc_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert ends == {k: len(v) for k, v in ids.items()}
    sizes = []
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        sizes.append(at)
    assert sorted(sizes)[1:] == [2048] * (len(sizes) - 1)


def test_pipeline_gives_out_the_ids(spark, documents, bytes_file):
    coder = Tokenizer.from_file(bytes_file)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(50)
    got, ids = corpus_pipeline.packing(spark, docs, FOLDER).collect(), {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
        ids.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert len(ids) == 50
    for key, own in ids.items():
        assert own == [*coder.encode(documents[key]["text"] or "", add_special_tokens=False).ids, 1]


def test_mix_keeps_every_row(spark, documents):
    got = rows_of(spark, "op7_weight_mix")
    first = [r["doc_id"] for r in got if r["mix_epoch"] == 0]
    assert sorted(first) == sorted(documents)


def test_mix_has_the_texts_in_order(spark, documents):
    got = rows_of(spark, "op7_weight_mix")
    places = [(r["mix_slot"], r["mix_place"]) for r in got]
    assert places == sorted(places)
    assert all(r["n_bytes"] == len((documents[r["doc_id"]]["text"] or "").encode()) for r in got)


def test_pipeline_stages_take_effect(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    ids = {r["doc_id"] for r in rows_of(spark, "op3_quality_forest") if r["kept"]}
    assert {r["doc_id"] for r in kept.collect()} == ids
    assert kept.columns == docs.columns
    alone = corpus_pipeline.near_duplicates(spark, docs.union(docs.limit(5)), FOLDER)
    groups = {r["doc_id"]: r["component_id"] for r in rows_of(spark, "op2_simhash_links")}
    stay = [groups[r["doc_id"]] for r in alone.collect()]
    assert sorted(stay) == sorted(set(groups.values()))
    mixed = corpus_pipeline.mixing(spark, docs, FOLDER).select("doc_id", "source").collect()
    assert {r["doc_id"] for r in mixed} == set(documents) and len(mixed) > len(documents)
    languages = corpus_pipeline.language(spark, docs, FOLDER)
    assert languages.count() >= 0.98 * len(documents)
