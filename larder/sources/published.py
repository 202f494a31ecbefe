"""Tables that change in one step: folders of parquet files, and editions that name them.

An edition is one small file that lists the folders of a table's parts (a hash bucket,
a day). A load writes folders of its own and then its edition, so a reader meets the
table before the load or after it and never between. Parts that a load does not touch
keep their folders: the next edition names them again.

    root/editions/00000007~2024-01-10   the list
    root/data/2024-01-10-<run>/part=3   files of one part

Editions are in the order of their numbers, and each has a label, a day or a batch.
Labels compare as text. One load at a time may write to a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources import store
from larder.sources.landing import rebalanced
from larder.sources.settings import small_slices

PART = "part"


@dataclass(frozen=True)
class Edition:
    """What a table consists of: folders by part, and small facts that hold with them.

    ``parts`` are grouped by the kind of their rows, as an edition may hold several
    tables that change together; ``schemas`` has the schema of each kind.
    """

    label: str
    parts: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)

    def of(self, kind: str) -> dict[str, str]:
        return self.parts.get(kind, {})


def _numbered(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    found = [name.partition("~") for name in store.names(spark, f"{root}/editions")]
    return sorted((int(number), label) for number, _, label in found if number.isdigit())


def labels(spark: SparkSession, root: str) -> list[str]:
    """The labels that have an edition, in order."""
    return sorted({label for _, label in _numbered(spark, root)})


def edition(
    spark: SparkSession, root: str, before: str | None = None, until: str | None = None
) -> Edition | None:
    """The newest edition of the greatest label: of all, of those before one, or of those up to one."""
    found = [
        (number, label)
        for number, label in _numbered(spark, root)
        if (before is None or label < before) and (until is None or label <= until)
    ]
    label = max((label for _, label in found), default=None)
    number = max((n for n, one in found if one == label), default=None)
    if number is None:
        return None
    return Edition(**json.loads(store.read_text(spark, f"{root}/editions/{number:08d}~{label}")))


def write_parts(df: DataFrame, root: str, label: str, part: Column) -> dict[str, str]:
    """Write rows into folders by part that no edition names yet; part to folder.

    Folders carry the number of the run, so a run that failed, or one of the same label,
    is never mixed with this one.
    """
    folder = f"data/{label}-{uuid.uuid4().hex}"
    if PART in (name.lower() for name in df.columns):
        raise ValueError(f"rename the column {PART!r} first")
    marked = df.withColumn(PART, part.cast("string"))
    with small_slices(df.sparkSession):
        rebalanced(marked, [PART]).write.partitionBy(PART).parquet(f"{root}/{folder}")
    made = [name for name in store.names(df.sparkSession, f"{root}/{folder}") if name.startswith(f"{PART}=")]
    return {name.removeprefix(f"{PART}="): f"{folder}/{name}" for name in made}


def publish(spark: SparkSession, root: str, new: Edition) -> None:
    """Make an edition the newest of its label: from here on readers see it."""
    number = max((n for n, _ in _numbered(spark, root)), default=-1) + 1
    text = json.dumps(
        {"label": new.label, "parts": new.parts, "schemas": new.schemas, "facts": new.facts}
    )
    store.write_new(spark, f"{root}/editions/{number:08d}~{new.label}", text)


def replaced(
    base: Edition | None,
    label: str,
    kind: str,
    made: dict[str, str],
    schema: T.StructType,
    touched: Iterable[str] = (),
    facts: dict | None = None,
) -> Edition:
    """The edition after a load that rewrote some parts of a kind.

    ``touched`` names all parts that the load replaced: those for which it wrote no rows
    are gone.
    """
    base = base or Edition(label)
    gone = set(touched)
    kept = {part: folder for part, folder in base.of(kind).items() if part not in gone}
    return Edition(
        label,
        {**base.parts, kind: {**kept, **made}},
        {**base.schemas, kind: schema.json()},
        base.facts if facts is None else facts,
    )


def read_parts(
    spark: SparkSession, root: str, found: Edition, kind: str, parts: Sequence[str] | None = None
) -> DataFrame:
    """The rows of a kind, of all its parts or of some; parts without a folder have none."""
    schema = T.StructType.fromJson(json.loads(found.schemas[kind]))
    folders = found.of(kind)
    chosen = sorted(folders[part] for part in (folders if parts is None else parts) if part in folders)
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{folder}" for folder in chosen])


def drop_editions(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Forget all but the editions of the last labels, and delete the folders no other names.

    Run it while nothing is loading: folders of a load that has not published yet are
    named by no edition either. Readers that still use a dropped edition fail.
    """
    if keep < 1:
        raise ValueError("keep at least one edition")
    found = _numbered(spark, root)
    stay = set(labels(spark, root)[-keep:])
    newest = {label: number for number, label in found}
    named = set()
    for label in stay:
        held = edition(spark, root, until=label)
        named |= {folder for parts in held.parts.values() for folder in parts.values()}
    for number, label in found:
        if newest[label] != number or label not in stay:
            store.delete(spark, f"{root}/editions/{number:08d}~{label}")
    dropped = []
    for run in store.names(spark, f"{root}/data"):
        kept = {folder.split("/")[2] for folder in named if folder.startswith(f"data/{run}/")}
        held = [name for name in store.names(spark, f"{root}/data/{run}") if name.startswith(f"{PART}=")]
        if not kept:
            store.delete(spark, f"{root}/data/{run}")
            dropped.append(f"data/{run}")
            continue
        for name in set(held) - kept:
            store.delete(spark, f"{root}/data/{run}/{name}")
            dropped.append(f"data/{run}/{name}")
    return sorted(dropped)


def hash_bucket(key: Column, buckets: int) -> Column:
    """The bucket of a key, as the name of a part; a NULL key has one as well."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")
