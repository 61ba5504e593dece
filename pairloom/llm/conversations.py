"""Repair of conversations whose turns do not alternate: the cheapest edits, of equal ones the ASCII-least.

A conversation is right when the initials of its roles match ``(s?(ua)+)?``.  Each row is kept, given another
role or deleted, and turns without text are inserted where a role is missing.  The cheapest edits are a shortest
path through an automaton of four states, one step a row.

*Square-root checkpoints.*  The cost of the best ending from each state (four numbers, "vector") is computed
backwards over the rows, but kept only at checkpoints; a walk forwards recomputes the vectors between two
checkpoints and takes, letter by letter, the smallest edit that is tight against them.  The same is done twice:

* a conversation is dealt to tasks in blocks of about the square root of the longest conversation.  Each block
  gives a (min, +) matrix; a chain over the matrices, one short row a block, gives the vector at each block's end;
* inside a block vectors are kept at every ``sqrt(rows)``-th row only.

A block is walked from each of the four states it may be entered in, and a second chain over the four exits picks the
walk that holds.  So no task sees all rows of a long conversation, whatever its share of the table.

Defined cases:

* null role or text: one space, so such a role is no role that can be kept and such a text is blank;
* a role whose first character is none of ``s``, ``u``, ``a`` (an empty one too) cannot be kept;
* rows of one turn follow each other by role and text; null turns come first and do not count for gaps;
* null conversations form one conversation of their own; a conversation without rows costs nothing;
* an empty table gives an empty result, and other columns than the four named ones are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pairloom.llm.common import map_batches
from pairloom.session import settle

DELETE, INSERT, REROLE, CUT_SHORT = 3, 2, 2, 1  # costs; the last is for a truncated row that stays
SHORTEST_BLOCK = 1024
REMEMBERED, LONGEST_REMEMBERED = 50_000, 24  # code strings whose answers a task keeps, and their length
FAR = 1 << 50

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NEXT = (USER, USER, ASSISTANT, USER)  # where a user or assistant turn that fits leads to
ROLE = ("user", "user", "assistant", "user")  # the role of that turn
#: Without more rows: a conversation may end at the start or behind an assistant turn; inserted turns lead there.
ENDING = (0, 2 * INSERT, INSERT, 0)
#: A row's code: its role's initial, in upper case where it has to go, or with "!" behind where it is truncated.
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

Vector = tuple[int, int, int, int]


def back(after: Vector, initial: str, goes: bool, short: bool) -> Vector:
    """The vector before a row from that behind it; turns may be inserted before the row."""
    row = []
    for state in STATES:
        best = DELETE + after[state]
        if not goes:
            extra = CUT_SHORT if short else 0
            best = min(best, REROLE + extra + after[NEXT[state]])
            if initial in KEPT[state]:
                best = min(best, extra + after[KEPT[state][initial]])
        row.append(best)
    user, assistant = min(row[USER], INSERT + row[ASSISTANT]), min(row[ASSISTANT], INSERT + row[USER])
    return min(row[START], INSERT + user), min(row[SYSTEM], INSERT + user), user, assistant


def rows_of(codes: str) -> list[tuple[str, bool, bool]]:
    """(initial, has to go, truncated) from two characters a row."""
    return [(codes[i], codes[i + 1] == "-", codes[i + 1] == "!") for i in range(0, len(codes), 2)]


def matrix(codes: str) -> list[int]:
    """Least cost from each state before the rows to each state behind them."""
    rows = rows_of(codes)
    columns = []
    for end in STATES:
        vector: Vector = tuple(0 if s == end else FAR for s in STATES)
        for row in reversed(rows):
            vector = back(vector, *row)
        columns.append(vector)
    return [min(columns[t][s], FAR) for s in STATES for t in STATES]


def walk(codes: str, end: Vector, state: int, last: bool) -> tuple[str, int]:
    """Tight edits from a state through the rows, smallest letter first, and the state behind them.

    Vectors are kept at every ``step``-th row; a stretch between two of them is computed again when the walk
    comes to it, so ``2 * sqrt(rows)`` vectors are in memory.
    """
    rows = rows_of(codes)
    step = isqrt(len(rows)) + 1
    kept, vector = {}, end
    for at in range(len(rows), 0, -1):
        if at % step == 0 or at == len(rows):
            kept[at] = vector
        vector = back(vector, *rows[at - 1])
    letters: list[str] = []
    for begin in range(0, len(rows), step):
        until = min(begin + step, len(rows))
        stretch = [kept[until]]
        for at in range(until, begin, -1):
            stretch.append(back(stretch[-1], *rows[at - 1]))
        for at in range(begin, until):
            before, behind = stretch[until - at], stretch[until - at - 1]
            initial, goes, short = rows[at]
            while True:
                left = before[state]
                if left == DELETE + behind[state]:
                    letters.append("D")
                    break
                if left == INSERT + before[NEXT[state]]:
                    letters.append("I")
                    state = NEXT[state]
                    continue
                extra = CUT_SHORT if short else 0
                if initial in KEPT[state] and left == extra + behind[KEPT[state][initial]]:
                    letters.append("K")
                    state = KEPT[state][initial]
                else:
                    letters.append("R")
                    state = NEXT[state]
                break
    if last:
        while ENDING[state]:
            letters.append("I")
            state = NEXT[state]
    return "".join(letters), state


def place_turns(turns: DataFrame, shortest: int = SHORTEST_BLOCK) -> DataFrame:
    """Rows in order, ``(conv_id, turn, role, text, at, block)``, written.

    ``at`` grows with the order of a conversation.  The table is range-partitioned by the whole row, so a long
    conversation fills many tasks; a block is a stretch of ``at`` within one of them.
    """
    filled = turns.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    longest = turns.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    size = max(shortest, isqrt(longest) + 1)
    keys = ("conv_id", "turn", "role", "text")
    ranged = filled.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    return settle(ranged.withColumn("block", F.expr(f"at div {size}")), "turns")[0]


def block_codes(placed: DataFrame) -> DataFrame:
    """``(conv_id, block, rows)``: the codes of a block's rows and its first occurrences of (role, text), by place.

    Occurrences are found by an aggregate over digests that adds up inside each task, so a line that fills a
    third of all rows costs one row a task.
    """
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    fault = F.when(trimmed == "", 1).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    letter = F.when(initial.isin("s", "u", "a"), F.ascii(initial)).otherwise(F.ascii(F.lit("x")))
    coded = placed.select("conv_id", "block", "at", "turn", (letter * 4 + fault).cast("int").alias("code"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    firsts = (
        placed.groupBy("conv_id", F.unhex(digest).alias("digest"))
        .agg(F.min(F.struct("at", "block")).alias("first"))
        .select("conv_id", "first.block", "first.at", F.lit(None).cast("long").alias("turn"), F.lit(-1).alias("code"))
    )
    every = coded.unionByName(firsts)
    return every.groupBy("conv_id", "block").agg(F.collect_list(F.struct("at", "code", "turn")).alias("rows"))


SUMMARY = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
BLOCKS = "conv_id {key}, block long, at long, codes string, matrix array<long>, ends array<long>, sums array<long>, edits string, cost long"


def _summed(rows: list[dict]) -> tuple[str, list, list]:
    """Codes, (first and last initial, first and last turn) and sums of the rows of a block."""
    rows.sort(key=lambda r: (r["at"], r["code"]))
    firsts, kept = set(), []
    for r in rows:
        if r["code"] < 0:
            firsts.add(r["at"])
        else:
            kept.append(r)
    codes, initials, sums = [], [], [0] * 4
    turns = [r["turn"] for r in kept if r["turn"] is not None]
    for r in kept:
        initial, fault = chr(r["code"] >> 2), r["code"] & 3
        fault = 2 if fault != 1 and r["at"] not in firsts else fault
        if fault:
            sums[fault - 1] += 1
        codes.append(initial + ("-" if fault in (1, 2) else "!" if fault == 3 else "."))
        initials.append(initial)
    sums[3] = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    low, high = (turns[0], turns[-1]) if turns else (None, None)
    distinct = sum(a != b for a, b in zip(turns, turns[1:])) + bool(turns)
    return "".join(codes), [ord(initials[0]), ord(initials[-1])], [low, high, distinct, *sums]


def solve_blocks(coded: DataFrame) -> DataFrame:
    """Each block's matrix, sums, and edits as if it were the whole conversation."""

    def make():
        known: dict[str, tuple] = {}

        def solve(codes: str) -> tuple:
            found = known.get(codes)
            if found is None:
                moves = matrix(codes)
                cost = min(moves[t] + ENDING[t] for t in STATES)
                found = moves, walk(codes, ENDING, START, True)[0], cost
                if len(codes) <= 2 * LONGEST_REMEMBERED and len(known) < REMEMBERED:
                    known[codes] = found
            return found

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("at", "codes", "matrix", "ends", "sums", "edits", "cost")}
            for rows in batch.column("rows").to_pylist():
                out["at"].append(min(r["at"] for r in rows))
                codes, ends, sums = _summed(rows)
                moves, edits, cost = solve(codes)
                for name, value in (("codes", codes), ("matrix", moves), ("ends", ends), ("sums", sums), ("edits", edits), ("cost", cost)):
                    out[name].append(value)
            return {"conv_id": batch.column("conv_id"), "block": batch.column("block"), **out}

        return work

    return map_batches(coded, make, BLOCKS.format(key=coded.schema["conv_id"].dataType.simpleString()))


def join_sums(parts: list[tuple[list, list]]) -> list:
    """Sums of a conversation from those of its blocks in order, each with its first and last initial."""
    total: list = [None, None, 0, 0, 0, 0, 0]
    last_initial = None
    for (first, last), (low, high, distinct, *counts) in parts:
        if low is not None:
            total[2] += distinct - (total[1] == low)
            total[0], total[1] = low if total[0] is None else total[0], high
        total[3:] = [a + b for a, b in zip(total[3:], counts)]
        total[6] += last_initial is not None and chr(last_initial) + chr(first) not in LEGAL
        last_initial = last
    return total


def _long_conversations(blocks: DataFrame, long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edits of the blocks and sums of the conversations that have more than one block.

    ``long``: one narrow row a block, gathered per conversation, so a task holds as many rows of a conversation
    as it has blocks: about the square root of its length.
    """
    key = blocks.schema["conv_id"].dataType.simpleString()
    narrow = long.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "matrix", "ends", "sums"))).alias("parts"))

    def ends_of_blocks():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("conv_id", "at", "vector", "last", "sums", "cost")}
            for conv, parts in zip(batch.column("conv_id").to_pylist(), batch.column("parts").to_pylist()):
                vector, rows = ENDING, []
                for i, p in enumerate(reversed(parts)):
                    rows.append((conv, p["at"], list(vector), i == 0, None, None))
                    vector = tuple(min(p["matrix"][4 * s + t] + vector[t] for t in STATES) for s in STATES)
                rows[-1] = (*rows[-1][:4], join_sums([(p["ends"], p["sums"]) for p in parts]), vector[START])
                for row in rows:
                    for name, value in zip(out, row):
                        out[name].append(value)
            return out

        return work

    ends, _ = settle(map_batches(narrow, ends_of_blocks, f"conv_id {key}, at long, vector array<long>, last boolean, sums array<long>, cost long"), "ends")

    def walks():
        def work(batch: pa.RecordBatch) -> dict:
            exits, edits = [], []
            for codes, vector, last in zip(*(batch.column(c).to_pylist() for c in ("codes", "vector", "last"))):
                found = [walk(codes, tuple(vector), s, last) for s in STATES]
                exits.append([s for _, s in found])
                edits.append([e for e, _ in found])
            return {"conv_id": batch.column("conv_id"), "block": batch.column("block"), "at": batch.column("at"), "exits": exits, "edits": edits}

        return work

    todo = blocks.select("conv_id", "block", "at", "codes").join(ends.select("at", "vector", "last"), "at")
    walked, _ = settle(map_batches(todo, walks, f"conv_id {key}, block long, at long, exits array<int>, edits array<string>"), "walks")

    def entries():
        def work(batch: pa.RecordBatch) -> dict:
            at, entered = [], []
            for parts in batch.column("parts").to_pylist():
                state = START
                for p in parts:
                    at.append(p["at"])
                    entered.append(state)
                    state = p["exits"][state]
            return {"at": at, "state": entered}

        return work

    exits = walked.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "exits"))).alias("parts"))
    states = map_batches(exits, entries, "at long, state int")
    edits = walked.join(states, "at").select("conv_id", "block", "at", F.get("edits", F.col("state")).alias("edits"), "state")
    return edits, ends.filter("sums is not null").select("conv_id", "sums", "cost")


class Repair:
    """The cheapest repair of every conversation of ``(conv_id, turn, role, text)``."""

    def __init__(self, turns: DataFrame, conversations: DataFrame | None = None, shortest_block: int = SHORTEST_BLOCK) -> None:
        """``conversations (conv_id)`` names those that may be without turns as well."""
        self.convs = (turns if conversations is None else conversations).select("conv_id")
        self.placed = place_turns(turns, shortest_block)
        blocks, _ = settle(solve_blocks(block_codes(self.placed)), "blocks")
        of_conv = F.count(F.lit(1)).over(Window.partitionBy("conv_id"))
        narrow = blocks.select("conv_id", "at", "matrix", "ends", "sums", of_conv.alias("n_blocks"))
        long, _ = settle(narrow.filter("n_blocks > 1"), "long")
        edits, sums = _long_conversations(blocks, long)
        whole = blocks.join(long.select("at"), "at", "left_anti")
        self.edits = whole.select("conv_id", "block", "at", "edits", F.lit(START).alias("state")).unionByName(edits)
        self.sums = whole.select("conv_id", "sums", "cost").unionByName(sums)

    def _script(self) -> DataFrame:
        """Rows and, before each block's first row, the block's edits and the state they begin in."""
        none, nothing = F.lit(None).cast("string"), F.lit(None).cast("array<long>")
        entry = F.array(F.col("state").cast("long")).alias("sums")
        edits = self.edits.select("conv_id", "block", "at", F.lit(2).alias("kind"), none.alias("role"), F.col("edits").alias("text"), entry)
        rows = self.placed.select("conv_id", "block", "at", F.lit(3).alias("kind"), "role", "text", nothing.alias("sums"))
        return edits.unionByName(rows)

    def rows(self) -> DataFrame:
        """``(conv_id, at, step, edit, role, text)`` of every edit; deleted rows are there with ``edit = 'D'``.

        ``(at, step)`` is the order within a conversation.  Blocks are replayed on their own, so rows of a long
        conversation stay spread over tasks.
        """
        dealt = self._script().repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at", "kind")
        schema = f"conv_id {self._key()}, at long, step int, edit string, role string, text string"
        return dealt.mapInArrow(_replay_rows(schema), schema)

    def digests(self) -> DataFrame:
        """One row a conversation: sums, cost, all its edits and the SHA-256 of its repaired lines.

        A SHA-256 of a whole conversation can only be computed in order: a task streams the sorted rows of its
        conversations through it and holds one batch of them.
        """
        head = self.convs.distinct().select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("array<long>").alias("sums"))
        sums = self.sums.select("conv_id", F.lit(1).alias("kind"), F.concat("sums", F.array("cost")).alias("sums"))
        heads = head.unionByName(sums).withColumn("at", F.lit(-1).cast("long"))
        script = self._script().drop("block").unionByName(heads, allowMissingColumns=True)
        dealt = script.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
        schema = (
            f"conv_id {self._key()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string"
        )
        return dealt.mapInArrow(_replay_digests(schema), schema)

    def _key(self) -> str:
        return self.placed.schema["conv_id"].dataType.simpleString()


class _Player:
    """Applies the edits of a script to its rows, in order."""

    def __init__(self) -> None:
        self.begin()

    def begin(self) -> None:
        self.state, self.edits, self.place = START, "", 0

    def load(self, edits: str) -> Iterator[tuple[str, str, str | None]]:
        yield from self.rest()
        self.edits, self.place = edits, 0

    def _inserted(self) -> Iterator[tuple[str, str, str | None]]:
        while self.place < len(self.edits) and self.edits[self.place] == "I":
            self.place += 1
            role, self.state = ROLE[self.state], NEXT[self.state]
            yield "I", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str | None]]:
        yield from self._inserted()
        edit = self.edits[self.place]
        self.place += 1
        if edit == "R":
            role, self.state = ROLE[self.state], NEXT[self.state]
        elif edit == "K":
            self.state = KEPT[self.state][role[:1]]
        yield edit, role, text

    def rest(self) -> Iterator[tuple[str, str, str | None]]:
        yield from self._inserted()


def _replay_digests(schema: str):
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        player = _Player()
        current: dict | None = None

        def take(steps) -> None:
            for edit, role, text in steps:
                current["audit"].append(edit)
                if edit != "D":
                    current["hash"].update(f"{'' if current['first'] else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                    current["first"] = False

        def close() -> None:
            if current is None:
                return
            take(player.rest())
            low, high, distinct, *counts = current["sums"] or [None, None, 0, 0, 0, 0, 0, 0]
            row = {"conv_id": current["conv"], "gaps": 0 if low is None else high - low + 1 - distinct}
            row |= dict(zip(("blank", "duplicate", "truncated", "illegal", "cost"), counts))
            out.append({**row, "audit": "".join(current["audit"]), "repaired_sha256": current["hash"].hexdigest()})

        for batch in batches:
            for conv, kind, role, text, sums in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "sums"))):
                if kind == 0:
                    close()
                    player.begin()
                    current = {"conv": conv, "audit": [], "hash": hashlib.sha256(), "first": True, "sums": None}
                elif kind == 1:
                    current["sums"] = sums
                elif kind == 2:
                    take(player.load(text))
                else:
                    take(player.row(role, text))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return run


def _replay_rows(schema: str):
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        player, here, step = _Player(), (None, 0), 0
        for batch in batches:
            out: list[dict] = []

            def give(conv, at, steps) -> None:
                nonlocal here, step
                for edit, role, text in steps:
                    step = step + 1 if here == (conv, at) else 0
                    here = (conv, at)
                    out.append({"conv_id": conv, "at": at, "step": step, "edit": edit, "role": role, "text": text})

            for conv, at, kind, role, text, entry in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "at", "kind", "role", "text", "sums"))):
                if kind == 2:
                    give(*here, player.rest())
                    player.begin()
                    player.state = entry[0]
                    player.edits = text
                else:
                    give(conv, at, player.row(role, text))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        out = []
        for edit, role, text in player.rest():
            step += 1
            out.append({"conv_id": here[0], "at": here[1], "step": step, "edit": edit, "role": role, "text": text})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return run
