"""Conversation structure repair: the cheapest edits that make the roles take turns.

The rows of a conversation, in order, are kept, given another role or deleted, and rows
without text are inserted, so that the roles read ``(s?(ua)+)?``. A dynamic programme
over the four states of that pattern finds the cheapest edits and, of equally cheap ones,
those whose initials (its audit) come first in ASCII order. Edit strings are persistent:
each is a node that adds one letter to another one, with its ancestors at distances of
powers of two and a rolling hash, so that a prefix is stored once and two strings are
compared by searching the length of their common prefix.

A long conversation is solved in blocks of bounded size: each block gives the best edits
from every state to every state, and the blocks are joined in order afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import col, placed, stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST_REROLE, COST_DELETE, COST_INSERT, COST_TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after a system row, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The state that a row with this role leads to, from the states that allow it.
KEEPS = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: The state after a row whose role can be chosen, user or assistant.
CHOSEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
#: Rows and bytes of text of a block; a conversation beyond either has several blocks.
BLOCK_ROWS, BLOCK_BYTES = 4096, 8 << 20
SPACES = " \t\n\x0b\f\r"
LEGAL = {"su", "ua", "au"}


class Trails:
    """Strings that share prefixes: a node is its parent's string and one letter more."""

    def __init__(self, base: int = 1_000_003, modulus: int = (1 << 61) - 1) -> None:
        self.base, self.modulus = base, modulus
        self.letter, self.depth, self.hash = [""], [0], [0]
        #: For each node its ancestors at distance 1, 2, 4 and so on, as far as there are any.
        self.up: list[list[int]] = [[]]
        self._equal: set[tuple[int, int]] = set()

    def add(self, at: int, letter: str) -> int:
        node = len(self.letter)
        ups, step, held = [at], 0, self.up[at]
        while step < len(held):
            above = held[step]
            ups.append(above)
            held = self.up[above]
            step += 1
        self.letter.append(letter)
        self.depth.append(self.depth[at] + 1)
        self.hash.append((self.hash[at] * self.base + ord(letter)) % self.modulus)
        self.up.append(ups)
        return node

    def text(self, at: int) -> str:
        letters = []
        while at:
            letters.append(self.letter[at])
            at = self.up[at][0]
        return "".join(reversed(letters))

    def raised(self, at: int, depth: int) -> int:
        """The ancestor that holds the first ``depth`` letters."""
        while (more := self.depth[at] - depth) > 0:
            at = self.up[at][more.bit_length() - 1]
        return at

    def equal(self, a: int, b: int) -> bool:
        """Whether two strings of one length are equal, letter by letter up to a shared node."""
        pair, x, y = (a, b), a, b
        while x != y and (x, y) not in self._equal:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        self._equal.add(pair)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the first string comes before the second one.

        Hashes lead to the longest common prefix. What they call equal is verified, and
        where they were wrong the strings themselves are compared.
        """
        depth = min(self.depth[a], self.depth[b])
        x, y = self.raised(a, depth), self.raised(b, depth)
        if self.hash[x] == self.hash[y]:
            if self.equal(x, y):
                return self.depth[a] < self.depth[b]
            return self.text(a) < self.text(b)
        for step in reversed(range(max(len(self.up[x]), 1))):
            # Only ancestors that differ are taken, so both stay behind the common prefix.
            if step < len(self.up[x]) and self.hash[self.up[x][step]] != self.hash[self.up[y][step]]:
                x, y = self.up[x][step], self.up[y][step]
        if self.equal(self.up[x][0], self.up[y][0]):
            return self.letter[x] < self.letter[y]
        return self.text(a) < self.text(b)


#: What a state holds: the least cost and the node of the first string of that cost.
Layer = dict[int, tuple[int, int]]


def _best(trails: Trails, offers: Iterable[tuple[int, int, str, int]], into: Layer) -> None:
    """Put offers (state, cost, letter, parent) into a layer where they are better.

    Nodes are made for the winners only, and for equally cheap strings to compare.
    """
    rest: dict[int, list[tuple[int, str, int]]] = {}
    for state, cost, letter, parent in offers:
        held = rest.setdefault(state, [])
        if held and cost < held[0][0]:
            held.clear()
        if not held or cost == held[0][0]:
            held.append((cost, letter, parent))
    for state, held in rest.items():
        cost = held[0][0]
        if state in into and into[state][0] < cost:
            continue
        nodes = [trails.add(parent, letter) for _, letter, parent in held]
        if state in into and into[state][0] == cost:
            nodes.append(into[state][1])
        first = nodes[0]
        for node in nodes[1:]:
            if trails.less(node, first):
                first = node
        into[state] = (cost, first)


def _inserted(trails: Trails, layer: Layer) -> Layer:
    """The layer after any inserts; each costs something, so a few rounds settle it."""
    fresh = dict(layer)
    while fresh:
        before = dict(layer)
        offers = [(CHOSEN[s], cost + COST_INSERT, INSERT, node) for s, (cost, node) in fresh.items()]
        _best(trails, [o for o in offers if o[0] not in layer or o[1] <= layer[o[0]][0]], layer)
        fresh = {s: held for s, held in layer.items() if before.get(s) != held}
    return layer


def cheapest(
    rows: list[tuple[str, str | None]], starts: Iterable[int] = (START,), trails: Trails | None = None
) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and audit of the best edits of rows (role initial, fault), by start and end state."""
    trails = trails or Trails()
    found = {}
    for start in starts:
        layer = _inserted(trails, {start: (0, 0)})
        for initial, fault in rows:
            offers = [(state, cost + COST_DELETE, DELETE, node) for state, (cost, node) in layer.items()]
            if fault not in (BLANK, DUPLICATE):
                more = COST_TRUNCATED if fault == TRUNCATED else 0
                keeps = KEEPS.get(initial, {})
                for state, (cost, node) in layer.items():
                    if state in keeps:
                        offers.append((keeps[state], cost + more, KEEP, node))
                    offers.append((CHOSEN[state], cost + more + COST_REROLE, REROLE, node))
            layer = {}
            _best(trails, offers, layer)
            layer = _inserted(trails, layer)
        for end, (cost, node) in layer.items():
            found[start, end] = (cost, trails.text(node))
    return found


@dataclass
class Joined:
    """The blocks of one conversation joined in order, in memory that no block's length adds to.

    For every state it keeps the cost, and the place of its edit string among those of
    all states: a rank, equal for strings that differ by inserts at their ends only, and
    those inserts. Two cheapest strings are never one the other's prefix, so ranks stay
    in order whatever follows.
    """

    front: dict[int, tuple[int, int, str]] = field(default_factory=lambda: {START: (0, 0, "")})
    came_from: list[dict[int, int]] = field(default_factory=list)

    def add(self, moves: dict[tuple[int, int], tuple[int, str]]) -> None:
        best: dict[int, tuple[tuple[int, int, str], int]] = {}
        for (start, end), (cost, audit) in moves.items():
            if start in self.front:
                so_far, rank, tail = self.front[start]
                offer = ((so_far + cost, rank, tail + audit), start)
                best[end] = min(best.get(end, offer), offer)
        self.came_from.append({end: start for end, (_, start) in best.items()})
        front, rank, base = {}, -1, None
        for (of, text), end, cost in sorted(((o[1], o[2]), end, o[0]) for end, (o, _) in best.items()):
            if base is None or of != base[0] or not text.startswith(base[1]):
                base, rank = (of, text), rank + 1
            front[end] = (cost, rank, text[len(base[1]) :])
        self.front = front

    def chosen(self) -> list[tuple[int, int]]:
        """The start and end state of every block on the best way through all of them."""
        end = min((self.front[s], s) for s in ENDS if s in self.front)[1]
        way = []
        for back in reversed(self.came_from):
            way.append((back[end], end))
            end = back[end]
        return way[::-1]


EDIT = "edit string, fault string, role string, text string"
BLOCK_FIELDS = (
    "block long, n_rows long, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, first_turn {turn}, last_turn {turn}, turns long"
)


def applied(
    rows: list[tuple[str, str, str | None]], audit: str, state: int = START
) -> list[tuple[str, str | None, str, str]]:
    """The edits of rows (role, text, fault): edit, fault of the row, role and text after it."""
    made, rest = [], iter(rows)
    for edit in audit:
        role, text, fault = ("", "", None) if edit == INSERT else next(rest)
        if edit == KEEP:
            state = KEEPS[role[:1]][state]
        elif edit != DELETE:
            state = CHOSEN[state]
            role = ROLES[state]
        made.append((edit, fault, role, text))
    return made


def _counts(rows: list[tuple], block: int) -> list:
    """What a block says of its rows (turn, role, text, fault), in the order of BLOCK_FIELDS."""
    initials = [role[:1] for _, role, _, _ in rows]
    turns = [turn for turn, *_ in rows if turn is not None]
    faults = [fault for *_, fault in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return [
        block,
        len(rows),
        *(faults.count(name) for name in (BLANK, DUPLICATE, TRUNCATED)),
        illegal,
        initials[0],
        initials[-1],
        turns[0] if turns else None,
        turns[-1] if turns else None,
        len(set(turns)),
    ]


def _faults(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether its last character that is no space ends no sentence."""
    bare = F.rtrim(text, F.lit(SPACES))
    return bare == "", ~F.right(bare, F.lit(1)).isin(".", "!", "?")


def prepared(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text`` and the faults that a row shows by itself; nulls as one space."""
    words = [F.coalesce(col(name).cast("string"), F.lit(" ")).alias(kind) for name, kind in ((role, "role"), (text, "text"))]
    rows = df.select(col(conv).alias("conv"), col(turn).alias("turn"), *words)
    blank, open_end = _faults(F.col("text"))
    return rows.withColumn("fault", F.when(blank, BLANK).when(open_end, TRUNCATED))


def _record(schema: pa.Schema, rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(schema)], schema=schema
    )


def _short(schema: pa.Schema):
    """Sorted rows of short conversations to one solved block each, a conversation at a time."""

    def solved(conv, rows: list[tuple]) -> list:
        seen, judged = set(), []
        for turn, role, text, fault in rows:
            if fault != BLANK and (role, text) in seen:
                fault = DUPLICATE
            seen.add((role, text))
            judged.append((turn, role, text, fault))
        found = cheapest([(role[:1], fault) for _, role, _, fault in judged])
        cost, audit = min(found[START, end] for end in ENDS if (START, end) in found)
        edits = applied([row[1:] for row in judged], audit)
        names = ("edit", "fault", "role", "text")
        return [conv, *_counts(judged, 0), cost, [dict(zip(names, e, strict=True)) for e in edits], True]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, made, held = None, [], [], 0
        for batch in batches:
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and conv != now:
                    made.append(solved(now, rows))
                    rows = []
                    if len(made) >= 256 or held > BLOCK_BYTES:
                        yield _record(schema, made)
                        made, held = [], 0
                now = conv
                held += len(row[2])
                rows.append(tuple(row))
        if rows:
            made.append(solved(now, rows))
        if made:
            yield _record(schema, made)

    return work


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations, in blocks of at most BLOCK_ROWS rows.

    A row holds ``conv``, ``block`` (their order within it, from 0 but with gaps), what the
    block's rows were (``n_rows``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    the first and last role initials and turns, and the number of ``turns``), its ``cost``,
    the array ``edits`` of ``edit, fault, role, text``, and ``whole``: whether the
    block is all of the conversation. Leaving deleted rows out, edits read in order of
    blocks are the repaired conversation.

    Rows are taken by turn, nulls first; rows of one turn by role and then by text, both as
    UTF-8 bytes, so any order of the input gives the same result. NULL roles and texts count
    as one space, and a NULL conversation is one like others. A role is known by its first
    letter ``s``, ``u`` or ``a``; any other one, and an empty one, has to be changed or
    deleted. Repeated rows are duplicates of the first one. An empty table gives no rows,
    and other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    rows = prepared(df, conv, turn, role, text)
    size = F.sum(F.octet_length("text") + F.octet_length("role"))
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"), size.alias("bytes"))
    long = sizes.where(f"n > {BLOCK_ROWS} or bytes > {BLOCK_BYTES}").select(F.col("conv").alias("long_conv"))
    long = stored(long, "long-conversations")
    same = F.col("conv").eqNullSafe(F.col("long_conv"))
    some = long.limit(1).count() > 0
    short = rows.join(long, same, "left_anti") if some else rows
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    counts = BLOCK_FIELDS.format(turn=kinds["turn"])
    shape = f"conv {kinds['conv']}, {counts}, cost long, edits array<struct<{_fields(EDIT)}>>, whole boolean"
    schema = _arrow(spark, shape)
    ordered = short.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    made = ordered.mapInArrow(_short(schema), shape)
    if some:
        made = made.unionByName(_long(rows.join(long, same, "left_semi"), shape, counts))
    return made.withColumnRenamed("conv", conv)


def _fields(shape: str) -> str:
    return ", ".join(part.strip().replace(" ", ": ", 1) for part in shape.split(","))


def _arrow(spark, shape: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(shape))


MOVES = "moves array<struct<first: int, last: int, cost: long, audit: string>>"


def _long(rows: DataFrame, shape: str, counts: str) -> DataFrame:
    """The blocks of long conversations.

    Rows are placed by range, so a conversation may lie in many partitions, and cut into
    blocks there. Duplicates are found by grouping, not by looking back. A block is solved
    from every state; only costs, audits and states meet in one place, a block at a time.
    """
    spark = rows.sparkSession
    start = F.left("text", F.lit(200))
    number = F.monotonically_increasing_id()
    lined = placed(rows.withColumn("n", number), F.col("conv"), F.col("turn"), F.col("role"), start, F.col("text"), F.col("n"))
    in_part = Window.partitionBy("part", "conv").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    full_rows = F.floor(F.count("*").over(in_part) / BLOCK_ROWS)
    full_bytes = F.floor(F.coalesce(F.sum(F.octet_length("text")).over(in_part), F.lit(0)) / BLOCK_BYTES)
    block = F.shiftleft(F.col("part").cast("long"), 40) + full_rows + full_bytes
    lined = lined.withColumn("block", block.cast("long"))
    said = F.sha2(F.concat_ws("\0", F.octet_length("role").cast("string"), "role", "text"), 256)
    lined = stored(lined.withColumn("said", said), "blocks")
    place = F.struct("part", "seq")
    again = lined.where(f"fault is null or fault <> '{BLANK}'").groupBy("conv", "said")
    again = again.agg(F.min(place).alias("first_place"), F.count("*").alias("times")).where("times > 1")
    again = again.select(F.col("conv").alias("c"), F.col("said").alias("s"), "first_place")
    found = (F.col("conv").eqNullSafe(F.col("c"))) & (F.col("said") == F.col("s"))
    later = F.col("first_place").isNotNull() & (place > F.col("first_place"))
    fault = F.when(later, F.lit(DUPLICATE)).otherwise(F.col("fault"))
    blank = F.col("fault").eqNullSafe(F.lit(BLANK))
    judged = lined.join(again, found, "left").withColumn("fault", F.when(blank, F.lit(BLANK)).otherwise(fault))
    judged = stored(judged.select("conv", "block", "seq", "turn", "role", "text", "fault"), "judged")

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    solved_shape = f"conv {kinds['conv']}, {counts}, {MOVES}"
    solved_schema = _arrow(spark, solved_shape)

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        held = list(zip(*(table[c].to_pylist() for c in ("turn", "role", "text", "fault")), strict=True))
        found = cheapest([(role, fault) for _, role, _, fault in held], range(4))
        moves = [{"first": a, "last": b, "cost": c, "audit": t} for (a, b), (c, t) in found.items()]
        row = [table["conv"][0].as_py(), *_counts(held, table["block"][0].as_py()), moves]
        return pa.Table.from_batches([_record(solved_schema, [row])])

    # Texts have been judged; a block's solution needs the first letter of its roles only.
    slim = judged.select("conv", "block", "seq", "turn", F.left("role", F.lit(1)).alias("role"), F.lit("").alias("text"), "fault")
    blocks = stored(slim.groupBy("conv", "block").applyInArrow(solve, solved_shape), "solved")

    way_shape = f"conv {kinds['conv']}, block long, first int, last int"
    way_schema = _arrow(spark, way_shape)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, joined, ids = None, Joined(), []

        def way() -> pa.RecordBatch:
            return _record(way_schema, [[now, i, a, b] for i, (a, b) in zip(ids, joined.chosen(), strict=True)])

        for batch in batches:
            for conv, block, moves in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and conv != now:
                    yield way()
                    joined, ids = Joined(), []
                now = conv
                ids.append(block)
                joined.add({(m["first"], m["last"]): (m["cost"], m["audit"]) for m in moves})
        if ids:
            yield way()

    ordered = blocks.select("conv", "block", "moves").repartition("conv").sortWithinPartitions("conv", "block")
    ways = ordered.mapInArrow(join, way_shape)
    ways = ways.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.col("first").alias("f"), F.col("last").alias("l"))
    one = F.filter("moves", lambda m: (m["first"] == F.col("f")) & (m["last"] == F.col("l")))[0]
    on = F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    best = blocks.join(ways, on).withColumn("one", one).drop("moves", "c", "b")
    best = stored(best.select("*", F.col("one.cost").alias("cost"), F.col("one.audit").alias("audit")).drop("one", "l"), "best")

    edits_shape = f"conv {kinds['conv']}, block long, edits array<struct<{_fields(EDIT)}>>"
    edits_schema = _arrow(spark, edits_shape)

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("seq")
        held = list(zip(*(left[c].to_pylist() for c in ("role", "text", "fault")), strict=True))
        made = applied(held, right["audit"][0].as_py(), right["f"][0].as_py())
        edits = [dict(zip(("edit", "fault", "role", "text"), e, strict=True)) for e in made]
        return pa.Table.from_batches([_record(edits_schema, [[left["conv"][0].as_py(), left["block"][0].as_py(), edits]])])

    done = (
        judged.groupBy("conv", "block")
        .cogroup(best.select("conv", "block", "f", "audit").groupBy("conv", "block"))
        .applyInArrow(apply, edits_shape)
        .select(F.col("conv").alias("c"), F.col("block").alias("b"), "edits")
    )
    names = [field.name for field in T.StructType.fromDDL(shape)]
    return best.join(done, on).withColumn("whole", F.lit(False)).select(*names)


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def summary(blocks: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row for each conversation of repaired blocks: SUMMARY.

    ``gaps`` are the turns missing between the least and the greatest, ``illegal`` counts
    neighbours that may not follow each other, both before the repair; ``audit`` are the
    edits' initials, and the digest is that of the repaired lines ``role:text``. Blocks
    that are a whole conversation stay where they are; of others one task reads all blocks
    of a conversation in order, one at a time.
    """
    kept = F.filter("edits", lambda e: e["edit"] != DELETE)
    lines = F.transform(kept, lambda e: F.concat(e["role"], F.lit(":"), e["text"]))
    missing = F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")
    whole = blocks.where("whole").select(
        col(conv).alias(conv),
        F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"),
        *("blank", "duplicate", "truncated", "illegal", "cost"),
        F.array_join(F.col("edits.edit"), "").alias("audit"),
        F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"),
    )
    parts = blocks.where("not whole").withColumnRenamed(conv, "conv")
    kind = parts.schema["conv"].dataType.simpleString()
    shape = f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    schema = _arrow(blocks.sparkSession, shape)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = total = None
        for batch in batches:
            for row in batch.to_pylist():
                if total is not None and row["conv"] != now:
                    yield _record(schema, [[now, *total.row()]])
                    total = None
                now, total = row["conv"], total or _Total()
                total.add(row)
        if total is not None:
            yield _record(schema, [[now, *total.row()]])

    used = ["conv", "first_turn", "last_turn", "turns", "first_initial", "last_initial", "blank", "duplicate", "truncated", "illegal", "cost", "edits"]
    ordered = parts.repartition("conv").sortWithinPartitions("conv", "block").select(*used)
    return whole.unionByName(ordered.mapInArrow(work, shape).withColumnRenamed("conv", conv))


class _Total:
    """The summary of a conversation while its blocks go by."""

    def __init__(self) -> None:
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
        self.first = self.last = self.initial = None
        self.audit: list[str] = []
        self.digest, self.lines = hashlib.sha256(), 0

    def add(self, row: dict) -> None:
        for name in self.sums:
            self.sums[name] += row[name]
        if self.initial is not None and self.initial + row["first_initial"] not in LEGAL:
            self.sums["illegal"] += 1
        self.initial = row["last_initial"]
        if row["first_turn"] is not None:
            self.sums["turns"] -= row["first_turn"] == self.last  # a turn that two blocks share
            self.first = row["first_turn"] if self.first is None else self.first
            self.last = row["last_turn"]
        for edit in row["edits"]:
            self.audit.append(edit["edit"])
            if edit["edit"] != DELETE:
                self.digest.update(("\n" if self.lines else "").encode())
                self.digest.update(f"{edit['role']}:{edit['text']}".encode())
                self.lines += 1

    def row(self) -> list:
        s = self.sums
        gaps = 0 if self.first is None else self.last - self.first + 1 - s["turns"]
        counts = [gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"]]
        return [*counts, "".join(self.audit), self.digest.hexdigest()]


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with planted faults, chosen by a checksum of conversation and turn.

    Of twenty checksums the first drops a row, the second empties its text, the third
    removes its sentence ends, the fourth repeats it and the fifth makes it a user's.
    NULLs count as one space.
    """
    spoken = [F.coalesce(col(name).cast("string"), F.lit(" ")) for name in (conv, turn, role, text)]
    kind = F.crc32(F.concat(spoken[0], F.lit(":"), spoken[1]).cast("binary")) % 20
    rows = df.select(col(conv).alias(conv), col(turn).alias(turn), spoken[2].alias(role), spoken[3].alias(text), kind.alias("kind"))
    said, done = col(text), F.col("kind")
    return rows.where("kind <> 0").select(
        col(conv),
        col(turn),
        F.when(done == 4, F.lit("user")).otherwise(col(role)).alias(role),
        F.when(done == 1, F.lit("")).when(done == 2, F.translate(said, ".!?", "")).otherwise(said).alias(text),
        F.explode(F.when(done == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
