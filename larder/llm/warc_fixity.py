"""Fixity audit of WARC archives with Merkle trees over their offset ranges.

Pages become WARC response records in a fixed order; an archive holds a fixed number
of them, and a record's offset is the length of those before it. A leaf is the hash
of a record's bytes with its offset range; an inner node hashes the ranges and hashes
of its children in order, up to one root for each archive.

Two replicas are compared root by root, and only below nodes that differ are the
children looked up, level by level, so intact archives cost one comparison. What is
left at the leaves are the damaged, lost and added records.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import col, placed, positions, stored

FAN = 16
PER_ARCHIVE = 4096
GAP = "\r\n\r\n"
STAMP = "2000-01-01T00:00:00Z"


def record_text(number: Column, url: Column, payload: Column) -> Column:
    """A WARC/1.0 response record without the gap that ends it."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(number.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " "),
        F.lit(f"\r\nWARC-Date: {STAMP}\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(GAP),
    )
    return F.concat(head, body)


def records(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """``key``, ``url``, ``record`` (the record's text) of every page."""
    text = record_text(col(key), col(url).cast("string"), col(payload).cast("string"))
    return pages.select(col(key).cast("long").alias("key"), col(url).cast("string").alias("url"), text.alias("record"))


def leaves(table: DataFrame, per_archive: int = PER_ARCHIVE) -> DataFrame:
    """One leaf for each record: archive, ordinal, offset, length and hash.

    Records are ordered by key, URL and hash. The texts are hashed where they are
    read, and only their hashes and lengths are sorted.
    """
    slim = table.select(
        "key",
        F.xxhash64("url").alias("url"),
        (F.octet_length("record") + len(GAP)).cast("long").alias("length"),
        F.sha2(F.col("record").cast("binary"), 256).alias("digest"),
    )
    order = [F.col("key").asc_nulls_first(), F.col("url"), F.col("digest")]
    line = positions(placed(slim, *order))
    line = line.withColumn("archive", F.floor(F.col("position") / per_archive).cast("long"))
    line = line.withColumn("ordinal", (F.col("position") % per_archive).cast("int"))
    before = Window.partitionBy("archive").orderBy("ordinal")
    return line.select(
        "archive",
        "ordinal",
        "key",
        (F.sum("length").over(before) - F.col("length")).alias("offset"),
        "length",
        "digest",
    )


def leaf_hash() -> Column:
    """The hash of a leaf covers its offset range as well as its bytes."""
    parts = [F.col("offset").cast("string"), F.col("length").cast("string"), F.col("digest")]
    return F.sha2(F.concat_ws(":", *parts), 256)


def tree(leaf_table: DataFrame, per_archive: int = PER_ARCHIVE, fan: int = FAN) -> list[DataFrame]:
    """The levels of all archives' trees from the leaves to the roots.

    A node has its archive, level place ``node`` and ``hash``. Each level is an aggregate of
    at most ``fan`` children for each node, so no group grows with the archive.
    """
    level = leaf_table.select("archive", F.col("ordinal").cast("long").alias("node"), leaf_hash().alias("hash"))
    levels, width = [level], per_archive
    while width > 1:
        children = F.sort_array(F.collect_list(F.struct("node", "hash")))
        joined = F.concat_ws("|", F.transform(children, lambda c: F.concat_ws(":", c["node"].cast("string"), c["hash"])))
        level = level.groupBy("archive", F.floor(F.col("node") / fan).cast("long").alias("node")).agg(
            F.sha2(joined, 256).alias("hash")
        )
        levels.append(level)
        width = -(-width // fan)
    return levels


def differing(
    first: list[DataFrame], second: list[DataFrame], fan: int = FAN
) -> DataFrame:
    """``archive`` and ``node`` of the leaves below nodes that differ, from the roots down."""

    def unlike(a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.withColumnRenamed("hash", "a").join(b.withColumnRenamed("hash", "b"), ["archive", "node"], "full")
        return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("archive", "node")

    found = unlike(first[-1], second[-1])
    for a, b in zip(reversed(first[:-1]), reversed(second[:-1]), strict=True):
        parents = found.withColumnRenamed("node", "parent")

        def below(level: DataFrame, parents: DataFrame = parents) -> DataFrame:
            own = level.withColumn("parent", F.floor(F.col("node") / fan).cast("long"))
            return own.join(parents, ["archive", "parent"], "left_semi").drop("parent")

        found = unlike(below(a), below(b))
    return found


def audit(
    first: DataFrame, second: DataFrame, per_archive: int = PER_ARCHIVE, fan: int = FAN
) -> DataFrame:
    """Every record of the first replica with its state in the second, and added ones.

    Both are leaf tables: ``archive``, ``ordinal``, ``key``, ``offset``, ``length`` and ``digest``.
    ``state`` is ``ok``, ``moved`` (same bytes at another offset), ``damaged`` (other bytes),
    ``lost`` (no record in the second) or ``added`` (none in the first). Only records in
    differing branches are compared; the others are ``ok`` by their node's hash.

    A lost or inserted record gives all records behind it other ordinals, so the leaves
    of differing branches are paired archive by archive: by bytes and offset, by bytes
    in order, by record id in order, and those without a readable id by offset.

    NULL keys, URLs and payloads are records with empty fields; repeated rows are
    records of their own; empty replicas have no roots and differ in nothing.
    """
    first, second = stored(first, "first"), stored(second, "second")
    one = [stored(level, "tree") for level in tree(first, per_archive, fan)]
    two = [stored(level, "tree") for level in tree(second, per_archive, fan)]
    suspects = stored(differing(one, two, fan), "suspects").withColumnRenamed("node", "ordinal")
    suspects = suspects.select("archive", F.col("ordinal").cast("int").alias("ordinal"))
    place = ["archive", "ordinal"]
    sound = first.join(suspects, place, "left_anti").select(
        *LEAF.names, F.lit("ok").alias("state"), F.lit(None).cast("string").alias("replica_digest")
    )
    sides = [
        side.join(suspects, place, "left_semi").select(*LEAF.names, F.lit(n).alias("side"))
        for n, side in enumerate((first, second))
    ]
    shape = "archive long, ordinal int, key long, offset long, length long, digest string, state string, "
    paired = sides[0].union(sides[1]).groupBy("archive").applyInArrow(paired_leaves, shape + "replica_digest string")
    return sound.union(paired)


def paired_leaves(table: pa.Table) -> pa.Table:
    """The suspect leaves of one archive in both replicas with their states."""
    rows = sorted(table.to_pylist(), key=lambda r: r["ordinal"])
    left, right = ([r for r in rows if r["side"] == side] for side in (0, 1))
    out = []

    def pair(name: Callable[[dict], tuple | None], same: bool) -> None:
        """Pair what has one name in both, in order, and take it from the leaves left."""
        nonlocal left, right
        known: dict[tuple, deque] = {}
        for r in right:
            if name(r) is not None:
                known.setdefault(name(r), deque()).append(r)
        rest, used = [], set()
        for r in left:
            found = known.get(name(r)) if name(r) is not None else None
            if not found:
                rest.append(r)
                continue
            other = found.popleft()
            used.add(other["ordinal"])
            still = same and other["offset"] == r["offset"]
            state = ("ok" if still else "moved") if same else "damaged"
            out.append(r | {"state": state, "replica_digest": None if still else other["digest"]})
        left, right = rest, [r for r in right if r["ordinal"] not in used]

    pair(lambda r: (r["digest"], r["offset"]), True)
    pair(lambda r: (r["digest"],), True)
    pair(lambda r: None if r["key"] is None else (r["key"],), False)
    pair(lambda r: (r["offset"],), False)
    out += [r | {"state": "lost", "replica_digest": None} for r in left]
    out += [r | {"state": "added", "replica_digest": r["digest"]} for r in right]
    return pa.Table.from_pylist(out, STATES)


def write_warc(
    pages: DataFrame, folder: str, per_archive: int = PER_ARCHIVE, compression: str = "none", **names: str
) -> None:
    """Write pages as WARC files, one folder ``archive=N`` for each archive.

    A record ends with two line ends, which is the writer's line separator, so the
    files are plain WARC files with the offsets of ``leaves``; ``compression`` may be gzip.
    NULL keys, URLs and payloads are empty in their records, repeated pages are records
    of their own, and without pages there are no files.
    """
    table = records(pages, **names).withColumn("digest", F.sha2(F.col("record").cast("binary"), 256))
    order = [F.col("key").asc_nulls_first(), F.col("url"), F.col("digest")]
    # Only hashes are sorted; the texts join their places, and equal records share a text.
    line = placed(table.select("key", F.xxhash64("url").alias("url"), "digest"), *order)
    texts = table.select("digest", "record")
    if line.groupBy("digest").count().where("count > 1").limit(1).count():
        texts = texts.dropDuplicates(["digest"])
    line = positions(line).join(texts, "digest")
    line = line.withColumn("archive", F.floor(F.col("position") / per_archive).cast("long"))
    # One task for each archive, which has a bounded number of records.
    write_records(line.repartition("archive"), folder, compression)


def write_records(table: DataFrame, folder: str, compression: str) -> None:
    """Write ``record`` by ``archive`` and ``position``; an archive's records are in one partition.

    Records may be text or any bytes: the writer gives bytes out as they are.
    """
    spread = table.sortWithinPartitions("archive", "position")
    spread.select("archive", F.col("record").cast("string").alias("value")).write.partitionBy("archive").option(
        "lineSep", GAP
    ).option("compression", compression).text(folder)


HEAD = re.compile(rb"WARC/1\.0\r\n(?:[^\r\n]+\r\n)*?Content-Length: (\d+)\r\n(?:[^\r\n]+\r\n)*?\r\n")
KEY = re.compile(rb"WARC-Record-ID: <urn:record:(-?\d+)>")


def split_records(data: bytes) -> Iterator[tuple[int, int, int, int | None]]:
    """Start, end, end with gap, and id of every record of a WARC file, by content lengths.

    After a header that cannot be read, or a length that does not lead to a record's end,
    the next line ``WARC/1.0`` begins a record. Zero bytes, as a bad extent reads, are
    no record.
    """
    at, gap = 0, GAP.encode()
    while at < len(data):
        found = HEAD.match(data, at)
        end = found.end() + int(found[1]) if found else -1
        if not found or data[end : end + 4] != gap:
            end = data.find(b"WARC/1.0\r\n", at + 1)
            end = len(data) if end < 0 else end
            end -= 4 if data[at:end].endswith(gap) else 0
        stop = end + 4 if data[end : end + 4] == gap else end
        border = data.find(gap, at, end)
        name = KEY.search(data, at, end if border < 0 else border)
        if data[at:end].strip(b"\0"):
            yield at, end, stop, int(name[1]) if name else None
        at = max(stop, at + 1)


def warc_files(spark: SparkSession, folder: str) -> DataFrame:
    """``archive`` and ``content``, as it is stored, of the files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option(
        "recursiveFileLookup", "true"
    ).load(folder)
    return files.select(F.regexp_extract("path", r"archive=(\d+)", 1).cast("long").alias("archive"), "content")


MEMBER = b"\x1f\x8b\x08"


def plain(data: bytes) -> bytes:
    """A file's bytes without its gzip compression, if it has one.

    Damaged streams give what can be read of them: all up to the damage, and what follows
    from the next gzip member on. A member's bytes that cannot be read are left out, so
    the records in them are lost and the ones behind them are not.
    """
    if not data.startswith(MEMBER[:2]):
        return data
    try:
        return gzip.decompress(data)
    except (zlib.error, EOFError, OSError):
        return b"".join(readable(data))


def readable(data: bytes) -> Iterator[bytes]:
    """What can be read of gzip members one after the other, damaged ones among them."""
    at = data.find(MEMBER)
    while at >= 0:
        stream, made, fed = zlib.decompressobj(31), [], at
        try:
            while fed < len(data) and not stream.eof:
                before = stream.copy()
                made.append(stream.decompress(data[fed : fed + 1024]))
                fed = min(fed + 1024, len(data))
        except zlib.error:
            # The last kilobyte byte by byte, up to the one that does not fit.
            with suppress(zlib.error):
                for i in range(fed, min(fed + 1024, len(data))):
                    made.append(before.decompress(data[i : i + 1]))
            next_from = at + 1  # broken bytes may have led past members that are sound
        else:
            next_from = max(fed - len(stream.unused_data), at + 1) if stream.eof else len(data)
        # What looks like a member's head by chance, within one, does not begin a record.
        got = b"".join(made)
        sound = got.startswith(b"WARC/") or at == 0
        if sound:
            yield got
        at = data.find(MEMBER, next_from if sound else at + 1)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The leaves of WARC files, from their bytes.

    Offsets are those of the records without compression. See ``split_records`` for broken
    records and ``plain`` for damaged compression: neither ends the audit, and what is
    not readable shows as lost records of its archive. A record without a readable id has
    a NULL key, and an empty file has no leaves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive, data = batch.column(0)[i].as_py(), plain(batch.column(1)[i].as_py())
                rows = [
                    (archive, n, key, at, stop - at, hashlib.sha256(data[at:end]).hexdigest())
                    for n, (at, end, stop, key) in enumerate(split_records(data))
                ]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(LEAF.names, row, strict=True)) for row in rows], LEAF
                )

    shape = "archive long, ordinal int, key long, offset long, length long, digest string"
    return warc_files(spark, folder).mapInArrow(run, shape)


def copy_warc(
    spark: SparkSession,
    folder: str,
    target: str,
    change: Callable[[int | None, bytes], bytes | None],
    compression: str = "none",
) -> None:
    """Write a replica from the bytes of WARC files, each record changed, or left out if None.

    Records need not be text. What cannot be read of a damaged file is not copied.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive, data = batch.column(0)[i].as_py(), plain(batch.column(1)[i].as_py())
                made = [change(key, data[at:end]) for at, end, _, key in split_records(data)]
                made = [record for record in made if record is not None]
                yield pa.RecordBatch.from_pydict(
                    {
                        "archive": pa.array([archive] * len(made), pa.int64()),
                        "position": pa.array(range(len(made)), pa.int64()),
                        "record": pa.array(made, pa.binary()),
                    }
                )

    table = warc_files(spark, folder).mapInArrow(run, "archive long, position long, record binary")
    write_records(table, target, compression)


LEAF = pa.schema(
    [
        ("archive", pa.int64()),
        ("ordinal", pa.int32()),
        ("key", pa.int64()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("digest", pa.string()),
    ]
)
STATES = pa.schema([*LEAF, ("state", pa.string()), ("replica_digest", pa.string())])
