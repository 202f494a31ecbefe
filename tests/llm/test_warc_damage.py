"""Archives whose stored bytes are damaged, and records that are no text."""

import gzip
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from larder.llm import queries, warc_fixity
from larder.sources.workspace import fresh_folder


def record(n, payload):
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:{n}>\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def ids(data):
    return [key for *_, key in warc_fixity.split_records(data)]


def test_one_damaged_byte_costs_the_member_it_is_in():
    rng = random.Random(1)
    members = [gzip.compress(record(n, rng.randbytes(5000))) for n in range(12)]
    starts = [sum(map(len, members[:n])) for n in range(12)]
    for hit in (0, 5, 11):
        for place in (12, len(members[hit]) // 2, len(members[hit]) - 6):
            data = bytearray(b"".join(members))
            data[starts[hit] + place] ^= 0x55
            got = ids(warc_fixity.plain(bytes(data)))
            assert set(range(12)) - {hit} <= set(got), (hit, place)


def test_a_damaged_stream_is_read_up_to_the_damage():
    rng = random.Random(2)
    whole = b"".join(record(n, rng.randbytes(3000)) for n in range(40))
    data = bytearray(gzip.compress(whole))
    data[len(data) // 2] ^= 0xFF
    got = warc_fixity.plain(bytes(data))
    same = next((i for i, (a, b) in enumerate(zip(got, whole, strict=False)) if a != b), len(got))
    assert same >= len(whole) * 0.4
    assert warc_fixity.plain(bytes(data[:100]))[:100] == whole[: len(warc_fixity.plain(bytes(data[:100])))][:100]
    # Only the checksum at the end is wrong: everything is there.
    data = bytearray(gzip.compress(whole))
    data[-6] ^= 1
    assert warc_fixity.plain(bytes(data)) == whole
    assert warc_fixity.plain(whole) == whole and warc_fixity.plain(b"") == b""
    with pytest.raises(zlib.error):
        gzip.decompress(bytes(data[:20]) + b"\xff" * 400)


def test_the_audit_goes_on(spark):
    pages = spark.range(64).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html")
    )
    one, two = fresh_folder(spark, "warc"), fresh_folder(spark, "warc")
    for folder in (one, two):
        warc_fixity.write_warc(pages, folder, per_archive=16, compression="gzip")
    from pathlib import Path

    file = next(Path(two.removeprefix("file:")).glob("archive=2/part-*"))
    data = bytearray(file.read_bytes())
    data[len(data) * 3 // 4] ^= 0xFF
    file.write_bytes(bytes(data))
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()
    found = warc_fixity.audit(warc_fixity.read_warc(spark, one), warc_fixity.read_warc(spark, two), 16, 4).collect()
    bad = {r["archive"] for r in found if r["state"] != "ok"}
    assert len(found) >= 64 and bad == {2}
    assert sum(r["state"] == "ok" for r in found if r["archive"] == 2) >= 4


def test_records_that_are_no_text_are_copied(spark):
    pages = spark.createDataFrame([(n, "u", "x" * 9) for n in range(6)], "page_id long, url string, html string")
    one, two = fresh_folder(spark, "warc"), fresh_folder(spark, "warc")
    warc_fixity.write_warc(pages, one, per_archive=4)

    def change(key, data):
        return data[:-9] + b"\xff\xfe\x00\r\n\x80abc" if key == 3 else data

    warc_fixity.copy_warc(spark, one, two, change, compression="gzip")
    found = warc_fixity.audit(warc_fixity.read_warc(spark, one), warc_fixity.read_warc(spark, two), 4, 2).collect()
    assert {r["key"]: r["state"] for r in found} == {n: "damaged" if n == 3 else "ok" for n in range(6)}
    again = fresh_folder(spark, "warc")
    warc_fixity.copy_warc(spark, two, again, lambda key, data: data)
    found = warc_fixity.audit(warc_fixity.read_warc(spark, two), warc_fixity.read_warc(spark, again), 4, 2).collect()
    assert {r["state"] for r in found} == {"ok"}


def test_the_query_on_null_pages(spark, tmp_path):
    rows = [(3, "u", None), (100, None, ""), (11, "u", "lost"), (None, None, None), (4, "u", "fine"), (-94, "u", None)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    got = queries.op6_warc_fixity(spark, folder)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    cursor = connection.execute(queries.ORACLE_SQL["op6_warc_fixity"])
    names = [c[0] for c in cursor.description]
    assert sorted(repr(tuple(r[n] for n in names)) for r in got.collect()) == sorted(map(repr, cursor.fetchall()))
