"""Audits against a search over all edits, damage against plain Python, and pieces against whole conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from lakeops.llm import conversation_repair
from lakeops.llm.queries import QUERIES

GAP = " \t\n\x0b\x0c\r"


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(GAP)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, turns), by a search in order of cost and audit over edits of rows and what is left."""
    faults = faults_of(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, initials, turns = heapq.heappop(heap)
        if at == len(rows) and legal(initials):
            return cost, audit, list(turns)
        if (at, initials[-1:], bool(initials)) in done or not re.fullmatch("(s|s?(ua)*u?)", initials):
            continue
        done.add((at, initials[-1:], bool(initials)))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", at, initials + role[0], (*turns, (role, ""))))
        if at < len(rows):
            (role, text), fault = rows[at], faults[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, initials, turns))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, initials + (role[:1] or "?"), (*turns, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, initials + new[0], (*turns, (new, text))))
    raise AssertionError


def expected(conv, rows):
    """Of rows (turn, role, text) in order."""
    known = [t for t, _, _ in rows if t is not None]
    pairs = [(r, t) for _, r, t in rows]
    faults = faults_of(pairs)
    cost, audit, turns = cheapest(pairs)
    initials = [r[:1] for r, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True)) if rows else 0
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    body = "\n".join(f"{r}:{t}" for r, t in turns)
    return (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def conversations(n, longest, seed):
    rng = random.Random(seed)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", "u"], ["Yes.", "No!", "cut", " ", "", "why?\n", "and", "Done. ", "ok,", "A.", "B.", "C.", "D."]
    out = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            out.append((None if conv == 3 else conv, rng.choice([turn, turn, turn, turn * 2, None, 5]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}" + rng.choice([".", ""])))
    return out


def grouped(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return by


SHAPE = "conv_id bigint, turn bigint, role string, text string, conv string, h string, at string, fault string, there string"


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SHAPE).repartition(5)


@pytest.mark.parametrize(("longest", "piece_rows"), [(9, 2000), (9, 1), (40, 3), (40, 2000)])
def test_all_edits(spark, rows, longest, piece_rows):
    given = conversations(60, longest, longest)
    got = conversation_repair.repairs(frame_of(spark, given), piece_rows=piece_rows)
    want = sorted((expected(k, in_order(v)) for k, v in grouped(given).items()), key=repr)
    assert rows(got) == want
    turns = {}
    for r in conversation_repair.repaired_turns(frame_of(spark, given), got).orderBy("place").collect():
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert all(hashlib.sha256("\n".join(turns.get(w[0], [])).encode()).hexdigest() == w[-1] for w in want)


def test_colliding_hashes_do_not_matter(monkeypatch):
    monkeypatch.setattr(conversation_repair, "MODULUS", 2)
    for conv, rows in grouped(conversations(80, 14, 5)).items():
        piece = conversation_repair.Piece(conv)
        ordered = in_order(rows)
        for (turn, role, text), fault in zip(ordered, faults_of([r[1:] for r in ordered]), strict=True):
            piece.add(turn, role, text, fault)
        assert conversation_repair.settled(piece)[14:17] == expected(conv, ordered)[6:]


def test_odd_tables(spark, rows):
    assert conversation_repair.repairs(frame_of(spark, [])).count() == 0
    given = [(1, None, None, None), (None, None, "user", None), (2, 1, "user", "x" * 300_000 + "."), (2, 2, "assistant", "y."), (2, 2, "assistant", "y."), (-7, 9, "system", "s.")]
    assert rows(conversation_repair.repairs(frame_of(spark, given))) == sorted((expected(k, in_order(v)) for k, v in grouped(given).items()), key=repr)


def test_one_long_conversation_over_many_partitions(spark, rows):
    rng = random.Random(8)
    given = [(k // 4 if k % 3 else 77, k, rng.choice(["user", "assistant"]), f"{k}" + rng.choice([".", ".", ""])) for k in range(900)]
    frame = frame_of(spark, given)
    assert rows(conversation_repair.repairs(frame, piece_rows=50)) == sorted((expected(k, in_order(v)) for k, v in grouped(given).items()), key=repr)


def test_query(spark, rows):
    sf, by, ids = "/root/testdata/sf0.01", {}, set()
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        conv, turn, role, text = r["conv_id"], r["turn"], r["role"], r["text"]
        ids.add(conv)
        what = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        by.setdefault(conv, []).extend([(turn, "user" if what == 4 else role, text)] * {0: 0, 3: 2}.get(what, 1))
    want = sorted((expected(k, in_order(by[k])) for k in ids), key=repr)
    assert rows(QUERIES["op11_conversation_repair"](spark, sf)) == want
