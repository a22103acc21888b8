"""The cheapest edits that make a conversation's turns a legal sequence, and the audit that spells them.

A legal sequence of roles is nothing, or an optional system turn and then pairs of user and assistant. Rows are kept (0),
get another role (3), are deleted (4; blank and repeated ones must be), or turns are inserted (3); a truncated row that stays
costs 3 more. Of the cheapest edits those count whose initials are least in ASCII.

Edits so far are nodes of a tree that share their beginnings: a node has its edit, its depth, a rolling hash of all edits
up to it, and its ancestors 1, 2, 4, ... steps up. For each row and each state of the grammar only the best node goes on. Two
nodes of equal cost are compared by a search for their longest common beginning: steps of binary lifting as long as the
hashes differ. Beginnings found equal by hash are verified edit by edit until they meet in one node, and remembered as
one; where hashes lied the first difference is looked for edit by edit. Equal cost rules out that one audit begins the other.

Rows are range-partitioned by conversation, turn, role and text and read in that order, so memory is bounded whatever a
conversation's length. A conversation that lies within a partition is settled there, at most `piece_rows` rows at a time.
Of one that does not, each piece gives, for each state it may be entered in, the best edits to each state it may be left in;
pieces are composed like matrices, and the pieces' rows are read once more to hash the repaired text. That a row
repeats an earlier one is found by an aggregate of hashes, so it doesn't matter how far apart they are.

Edge cases: NULL roles and texts are one space. Rows with NULL turns come first; rows of one turn go by role, then by a hash of
the text. NULL conversation ids are one conversation. Roles other than those that begin with s, u or a can't be kept. Exactly
repeated rows are duplicates of one another. Very long texts pass through row by row. Empty tables give no conversations. Only
the named columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.ranges import known_key, real_key
from lakeops.session import materialize

GAP = " \t\n\x0b\x0c\r"
PIECE_ROWS, PIECE_CHARS = 2000, 4_000_000
BATCH_CHARS = 4_000_000
LEGAL = ("su", "ua", "au")
#: States of the grammar: nothing yet, a system turn, a user's turn last, an assistant's turn last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: (state, initial of the next role) -> state
STEPS = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
MODULUS, BASE = (1 << 61) - 1, 911_382_323


class Edits:
    """A node: the last edit of a sequence, and where the sequence comes from."""

    __slots__ = ("edit", "depth", "hash", "up", "twin")

    def __init__(self, edit: str, before: Edits | None):
        self.edit, self.twin = edit, self
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth, self.hash = before.depth + 1, (before.hash * BASE + ord(edit)) % MODULUS
        up, at = [before], before
        while len(at.up) >= len(up):
            at = at.up[len(up) - 1]
            up.append(at)
        self.up = up

    def ancestor(self, depth: int) -> Edits:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node

    def one(self) -> Edits:
        """The node that stands for all verified to spell the same edits."""
        node = self
        while node.twin is not node:
            node.twin = node.twin.twin
            node = node.twin
        return node

    def spelled(self) -> str:
        out, node = [], self
        while node.depth:
            out.append(node.edit)
            node = node.up[0]
        return "".join(reversed(out))


def verified(a: Edits, b: Edits) -> bool:
    """Whether two nodes of equal depth and hash spell the same edits; if so they are one from now on."""
    walked = []
    while a.one() is not b.one():
        if a.edit != b.edit:
            return False
        walked.append((a, b))
        a, b = a.up[0], b.up[0]
    for a, b in walked:
        a.one().twin = b.one()
    return True


def less(a: Edits, b: Edits) -> bool:
    """Whether a's edits come before b's in ASCII order."""
    depth = min(a.depth, b.depth)
    x, y = a.ancestor(depth), b.ancestor(depth)
    if x.hash == y.hash and verified(x, y):
        return a.depth < b.depth
    while x.depth:
        k = len(x.up) - 1
        while k and x.up[k].hash == y.up[k].hash:
            k -= 1
        if x.up[k].hash == y.up[k].hash:  # the nodes above are one, it is said
            if verified(x.up[0], y.up[0]):
                return x.edit < y.edit
            x, y = x.up[0], y.up[0]
        else:
            x, y = x.up[k], y.up[k]
    raise AssertionError("equal audits of one cost")


Best = tuple[int, Edits]


def better(a: Best | None, b: Best | None) -> Best | None:
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if a[1] is b[1] or less(a[1], b[1]) else b


def edited(at: Best, edit: str, more: int = 0) -> Best:
    return at[0] + COST[edit] + more, Edits(edit, at[1])


def with_inserts(best: list[Best | None]) -> list[Best | None]:
    """After any inserts that are worth while; an inserted turn follows the others of its place."""
    best = list(best)
    for state, role, to in ((EMPTY, "u", USER), (SYSTEM, "u", USER), (ASSISTANT, "u", USER), (USER, "a", ASSISTANT)):
        at = best[state]
        if at is not None and (best[to] is None or at[0] + COST["I"] <= best[to][0]):
            best[to] = better(best[to], edited(at, "I"))
    return best


def after_row(best: list[Best | None], initial: str, fault: str) -> list[Best | None]:
    """The best edits to each state behind a row, inserts after it included."""
    gone = fault in ("blank", "duplicate")
    more = TRUNCATED if fault == "truncated" else 0
    options: list[list[tuple[int, int, str]]] = [[], [], [], []]
    for state, at in enumerate(best):
        if at is None:
            continue
        options[state].append((at[0] + COST["D"], state, "D"))
        if not gone:
            kept = STEPS.get((state, initial))
            if kept is not None:
                options[kept].append((at[0] + more, state, "K"))
            for role in "ua":
                to = STEPS.get((state, role))
                if to is not None:
                    options[to].append((at[0] + COST["R"] + more, state, "R"))
    out: list[Best | None] = [None] * 4
    for to, ways in enumerate(options):
        if ways:
            least = min(ways)[0]
            for cost, state, edit in ways:
                if cost == least:
                    out[to] = better(out[to], (cost, Edits(edit, best[state][1])))
    return with_inserts(out)


def entered(state: int) -> list[Best | None]:
    best: list[Best | None] = [None] * 4
    best[state] = (0, Edits("", None))
    return with_inserts(best)


def turns(rows: list[tuple], audit: str, state: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit leaves of rows (role, text, ...), which are entered in `state`."""
    at, last = iter(rows), "" if state == EMPTY else "sua"[state - 1]
    for edit in audit:
        role, text = next(at)[:2] if edit != "I" else ("", "")
        if edit in "RI":
            role = "assistant" if last == "u" else "user"
        if edit != "D":
            yield edit, role, text
            last = role[:1]


class Piece:
    """Rows of one conversation in order, and what they add up to."""

    def __init__(self, conv: int):
        self.conv, self.rows, self.turn_rows, self.chars = conv, [], [], 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        self.rows.append((role, text, fault))
        self.turn_rows.append(turn)
        self.chars += len(text)
        if fault:
            self.counts[fault] += 1

    def numbers(self) -> dict:
        initials = [r[0][:1] for r in self.rows]
        known = [t for t in self.turn_rows if t is not None]
        pairs = zip(initials[:-1], initials[1:], strict=True)
        return {
            "least": known[0] if known else None, "most": known[-1] if known else None, "distinct": len(set(known)),
            **self.counts, "illegal": sum(a + b not in LEGAL for a, b in pairs),
            "first_role": initials[0] if initials else None, "last_role": initials[-1] if initials else None,
        }

    def ways(self, state: int) -> list[Best | None]:
        best = entered(state)
        for role, _, fault in self.rows:
            best = after_row(best, role[:1], fault)
        return best


NUMBERS = "least bigint, most bigint, distinct bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_role string, last_role string"
#: Rows of three kinds: a settled conversation (no piece), a way through a piece (no place), a row of a piece.
OUT = f"conv bigint, piece bigint, place bigint, {NUMBERS}, entered int, left_in int, cost bigint, audit string, repaired_sha256 string, role string, text string, fault string"
NO_NUMBERS = [None] * len(NUMBERS.split(", "))
TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [pa.field(name, TYPES[kind]) for name, kind in (x.split() for x in schema.split(", "))]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def in_batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += 100 + sum(len(c) for c in row if isinstance(c, str))
        if size > BATCH_CHARS:
            yield batch_of(out, schema)
            out, size = [], 0
    yield batch_of(out, schema)


def hash_of(parts: Iterator[tuple[str, str, str]], into=None, first: bool = True):
    """SHA-256 of turns as `role:text` lines, on top of `into`."""
    into = into or hashlib.sha256()
    for _, role, text in parts:
        into.update(f"{'' if first else chr(10)}{role}:{text}".encode())
        first = False
    return into, first


def settled(piece: Piece) -> tuple:
    """The row of a conversation that is one piece."""
    ways = piece.ways(EMPTY)
    cost, edits = better(ways[EMPTY], ways[ASSISTANT])
    audit = edits.spelled()
    repaired = hash_of(turns(piece.rows, audit, EMPTY))[0].hexdigest()
    return (piece.conv, None, None, *piece.numbers().values(), None, None, cost, audit, repaired, None, None, None)


def parted(piece: Piece, number: int) -> Iterator[tuple]:
    """The rows of a piece of a longer conversation: one for each way through it, and its own rows."""
    for state in range(4):
        for left, best in enumerate(piece.ways(state)):
            if best is not None:
                yield (piece.conv, number, None, *piece.numbers().values(), state, left, best[0], best[1].spelled(), None, None, None, None)
    for place, row in enumerate(piece.rows):
        yield (piece.conv, number, place, *NO_NUMBERS, None, None, None, None, None, *row)


def pieces(rows: Iterator[tuple], piece_rows: int) -> Iterator[tuple[Piece, bool]]:
    """Pieces of a partition's rows, and whether the conversation may go on beyond the piece on either side."""
    piece, cut, before = None, True, None
    for conv, turn, role, text, fault, there in rows:
        if piece is None:
            piece = Piece(conv)
        elif conv != piece.conv:
            yield piece, cut
            piece, cut = Piece(conv), False
        elif len(piece.rows) >= piece_rows or piece.chars > PIECE_CHARS:
            yield piece, True
            piece, cut = Piece(conv), True
        if there:
            again = before == (conv, turn, role, text) and fault != "blank"
            piece.add(turn, role, text, "duplicate" if again else fault)
            before = conv, turn, role, text
    if piece is not None:
        yield piece, True


def settled_or_parted(batches: Iterator[pa.RecordBatch], piece_rows: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        first = TaskContext.get().partitionId() << 32  # partitions are in the order of their rows
        for number, (piece, cut) in enumerate(pieces(rows_of(batches), piece_rows)):
            if cut:
                yield from parted(piece, first + number)
            else:
                yield settled(piece)

    return in_batches(rows(), OUT)


#: A composed conversation (no piece), or the way chosen through one of its pieces.
COMPOSED = f"conv bigint, piece bigint, {NUMBERS}, entered int, cost bigint, audit string"


def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from the ways through their pieces, which come in order."""

    def rows() -> Iterator[tuple]:
        for conv, of_conv in groupby(rows_of(batches), itemgetter(0)):
            best = {EMPTY: (0, "", ())}  # cost, audit, and the ways that lead there
            total: list | None = None
            for number, ways in groupby(of_conv, itemgetter(1)):
                after: dict[int, tuple] = {}
                for _, _, *numbers, state, left, cost, audit in ways:
                    if state in best:
                        way = (best[state][0] + cost, best[state][1] + audit, (best[state][2], number, state, audit))
                        if left not in after or way[:2] < after[left][:2]:
                            after[left] = way
                best, total = after, numbers if total is None else added(total, numbers)
            cost, audit, path = min(best[s] for s in (EMPTY, ASSISTANT) if s in best)
            yield (conv, None, *total, None, cost, audit)
            while path:
                path, number, state, part = path
                yield (conv, number, *NO_NUMBERS, state, None, part)

    return in_batches(rows(), COMPOSED)


def added(a: list, b: list) -> list:
    """Numbers of two neighbouring pieces together."""
    if b[-1] is None:  # no rows
        return a
    if a[-1] is None:
        return b
    least = b[0] if a[0] is None else a[0]
    most = a[1] if b[1] is None else b[1]
    same_turn = a[1] is not None and a[1] == b[0]
    illegal = a[6] + b[6] + (a[8] + b[7] not in LEGAL)
    return [least, most, a[2] + b[2] - same_turn, *(a[k] + b[k] for k in (3, 4, 5)), illegal, a[7], b[8]]


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of repaired conversations from the chosen ways, each followed by its piece's rows."""

    def rows() -> Iterator[tuple]:
        for conv, of_conv in groupby(rows_of(batches), itemgetter(0)):
            total, first = hashlib.sha256(), True
            for _, of_piece in groupby(of_conv, itemgetter(1)):
                way = next(of_piece)
                total, first = hash_of(turns([r[5:7] for r in of_piece], way[4], way[3]), total, first)
            yield conv, total.hexdigest()

    return in_batches(rows(), "conv bigint, repaired_sha256 string")


def faults(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, there) with their first fault: blank, duplicate, truncated, or ''."""
    bare = F.rtrim(F.col("text"), F.lit(GAP))
    marked = rows.withColumn("h", F.md5("text")).withColumn("at", F.coalesce("turn", F.lit(-(1 << 63))))
    seen = marked.where("there").groupBy("conv", "role", "h").agg(F.min("at").alias("first_at"), F.count("*").alias("n")).where("n > 1")
    # most rows are said once: what is left is small, and its size is known before it is joined
    seen = materialize(seen.drop("n"), "conversation-repeats")
    known = marked.join(seen, ["conv", "role", "h"], "left")
    fault = (
        F.when(bare == "", "blank")
        .when(F.col("at") > F.col("first_at"), "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return known.select("conv", "turn", "at", "role", "h", "text", fault.alias("fault"), "there")


def repairs(conversations: DataFrame, there: Column | None = None, piece_rows: int = PIECE_ROWS, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows for which `there` is false are not part of their conversation, which is named in the result all the same.
    """
    here = F.lit(True) if there is None else there
    rows = conversations.select(
        known_key(F.col(conv)).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"), here.alias("there"),
    )
    dealt = faults(rows).repartitionByRange("conv", "at", "role", "h").sortWithinPartitions("conv", "at", "role", "h")
    sent = dealt.select("conv", "turn", "role", "text", "fault", "there")
    found = materialize(sent.mapInArrow(lambda batches: settled_or_parted(batches, piece_rows), OUT), "conversation-pieces")
    names = [x.split()[0] for x in COMPOSED.split(", ")]
    ways = found.where("piece is not null and place is null").select(*names[:-2], "left_in", "cost", "audit")
    chosen = materialize(ways.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(composed, COMPOSED), "conversation-ways")
    marks = chosen.where("piece is not null").select("conv", "piece", F.lit(-1).cast("long").alias("place"), "entered", "audit", F.lit("").alias("role"), F.lit("").alias("text"))
    lines = found.where("place is not null").select(marks.columns)
    hashes = marks.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "piece", "place").mapInArrow(hashed, "conv bigint, repaired_sha256 string")
    joined = chosen.where("piece is null").join(hashes, "conv")
    one = found.where("piece is null").select(joined.columns).unionByName(joined)
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("distinct"), F.lit(0))
    return one.select(real_key(F.col("conv")).alias("conv_id"), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired_turns(conversations: DataFrame, repaired: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns that the audits of `repairs` leave: conv_id, place, edit, role, text."""
    rows = conversations.select(
        known_key(F.col(conv)).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("old"), F.coalesce(F.col(text), F.lit(" ")).alias("text")
    )
    by_turn = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "old", F.md5("text"))
    rows = rows.withColumn("row", F.row_number().over(by_turn))
    edits = repaired.where("audit != ''").select(known_key(F.col("conv_id")).alias("conv"), F.posexplode(F.split("audit", "")).alias("at", "edit"))
    so_far = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    count = lambda skip: F.sum((F.col("edit") != skip).cast("long")).over(so_far)
    edits = edits.select("conv", "edit", count("I").alias("row"), count("D").alias("place")).where("edit != 'D'")
    joined = edits.join(rows, (edits.conv == rows.conv) & (edits.row == rows.row) & (edits.edit != "I"), "left").select(edits.conv, "edit", "place", "old", "text")
    # users stand at odd places, or at even ones behind a system turn
    system = joined.where("place = 1 and edit = 'K' and startswith(old, 's')").select(F.col("conv").alias("with_system"))
    joined = joined.join(system, joined.conv == system.with_system, "left")
    user = (F.col("place") % 2 == 1) == F.col("with_system").isNull()
    new = F.when(F.col("edit") == "K", F.col("old")).when(user, "user").otherwise("assistant")
    return joined.select(real_key(F.col("conv")).alias("conv_id"), "place", "edit", new.alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `there`: by a hash of conversation and turn, of twenty rows about one is dropped, emptied,
    without its end marks, repeated, or a user's. A NULL anywhere is a space, but NULL turns stay unknown."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    what = F.crc32(F.concat_ws(":", *told)) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.explode(F.when(what == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(what != 0)))
    return conversations.select("conv_id", "turn", F.when(what == 4, "user").otherwise(role).alias("role"), text.alias("text"), times.alias("there"))
