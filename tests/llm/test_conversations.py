"""Conversation repair against an exhaustive search over edit scripts."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from conftest import SMALL
from pairloom.llm import conversations, queries

FORM = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def brute(rows):
    """Dijkstra over (rows done, role initials so far): all scripts in order of cost, then of letters."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if at == len(rows) and FORM.fullmatch(roles):
            break
        key = (at, roles[-2:], len(roles) > 2)
        if (key, audit) in done:
            continue
        done.add((key, audit))
        can = [r for r in "ua" if re.fullmatch(r"(s?(ua)*u?)?", roles + r)]
        for r in can:
            heapq.heappush(heap, (cost + 2, audit + "I", at, roles + r, (*lines, {"u": "user", "a": "assistant"}[r] + ":")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles, lines))
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                for r in can:
                    heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, roles + r, (*lines, {"u": "user", "a": "assistant"}[r] + ":" + text)))
                if role and re.fullmatch(r"(s?(ua)*u?)?", roles + role[0]):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + role[0], (*lines, f"{role}:{text}")))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return {conv: brute(damaged(group)) for conv, group in groups.items()}


def shown(frame):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = frame.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def made_up(seed, convs, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "agent"]
    texts = ["Yes.", "No!", "And so", " ", None, "", "Why?", "x ", "Ends. \t\n", "<|x|>."]
    rows = []
    for conv in range(convs):
        rows += [
            (None if conv == 3 else conv, rng.choice([None, t, t, t, t + 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Turn {t} of {rng.randrange(9)}.")
            for t in range(rng.randrange(longest))
        ]
    return rows


def test_query_equals_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert shown(queries.op13_checkpointed_repair(spark, SMALL)) == expected(rows)


@pytest.mark.parametrize("block", [1, 2, 3, 1024])
def test_odd_rows_in_blocks_of_any_size(spark, block):
    rows = made_up(block, 60, 9)
    turns = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", at string")
    frame = conversations.Repair(queries.damaged(turns), turns, shortest_block=block).digests()
    assert shown(frame) == expected(rows)


def test_rows_are_the_repaired_conversation(spark):
    rows = made_up(7, 40, 12)
    turns = spark.createDataFrame(rows, SCHEMA)
    repair = conversations.Repair(queries.damaged(turns), turns, shortest_block=2)
    lines, audits = {}, {}
    for r in sorted(repair.rows().collect(), key=lambda r: (r["at"], r["step"])):
        audits.setdefault(r["conv_id"], []).append(r["edit"])
        if r["edit"] != "D":
            lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, row in shown(repair.digests()).items():
        assert "".join(audits.get(conv, [])) == row[-2]
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[-1]


def test_one_long_conversation_is_dealt_to_many_blocks(spark):
    """A conversation of 6,000 rows, half of them one repeated line, and a walk that equals a plain table of vectors."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), "Again." if t % 2 else f"Turn {t}{rng.choice('.!?,')}") for t in range(6000)]
    rows += [(2, 0, "user", "Hello."), (2, 1, "assistant", "Hello.")]
    repair = conversations.Repair(spark.createDataFrame(rows, SCHEMA), shortest_block=16)
    assert repair.edits.filter("conv_id = 1").count() > 60
    found = shown(repair.digests())
    seen, codes = set(), ""
    for _, _, role, text in rows[:6000]:
        codes += role[0] + ("-" if (role, text) in seen else "." if text[-1] in ".!?" else "!")
        seen.add((role, text))
    vectors = [conversations.ENDING]
    for row in reversed(conversations.rows_of(codes)):
        vectors.append(conversations.back(vectors[-1], *row))
    assert found[1][5] == vectors[-1][0]
    assert found[1][6] == conversations.walk(codes, conversations.ENDING, 0, True)[0]
    assert found[2][6] == "KK"


def test_empty_table_and_lost_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.Repair(empty).digests().count() == 0
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    some = spark.createDataFrame([(5,), (None,)], "conv_id long")
    assert shown(conversations.Repair(empty, some).digests()) == {5: nothing, None: nothing}
    assert conversations.Repair(empty, some).rows().count() == 0
