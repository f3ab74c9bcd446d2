"""Repair of conversations against a search over all edits with plain strings."""

import hashlib
import itertools
import random
import re
import zlib

from decisionlake.llm import conversation_repair as repair
from tests.llm.helpers import with_clashes

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows, faults):
    """By Dijkstra's order over all edit strings of a state: (cost, audit, repaired rows), least first."""
    import heapq

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, kept = heapq.heappop(heap)
        place = initials[-1:] if initials else ""
        if (i, place) in done:
            continue
        done.add((i, place))
        if i == len(rows) and PATTERN.fullmatch(initials):
            return cost, audit, kept
        moves = [(repair.INSERT, "I", 0, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            moves.append((2, "D", 1, None))
            if faults[i] in ("", "truncated"):
                more = 5 if faults[i] else 0
                moves += [(more, "K", 1, (role, text))] + [(more + 1, "R", 1, (r, text)) for r in ("user", "assistant")]
        for more, letter, step, row in moves:
            now = initials if row is None else initials + (row[0][:1] or "?")
            if re.fullmatch("(s?(ua)*u?)?", now):
                heapq.heappush(heap, (cost + more, audit + letter, i + step, now[-1:] if len(now) < 2 else now[:1] * (now[0] == "s") + "ua" * (now[-1] == "a") + "u" * (now[-1] == "u"), kept + ((row,) if row else ())))
    raise AssertionError


def brute(rows, after=None):
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in (damage(rows) if after is None else after) if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            bare = text.strip(" \t\n\x0b\f\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, kept = cheapest([r[2:] for r in own], faults)
        text = "\n".join(f"{a}:{b}" for a, b in kept)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def invented(seed, conversations=60, most=9):
    r, rows = random.Random(seed), []
    for conv in range(conversations):
        for turn in range(r.randrange(most)):
            role = r.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None, "unknown", "User"][: r.choice([2, 5, 10])])
            text = r.choice([f"Say {turn}.", "Again!", f"cut {turn}", "", " \n", None, "ok?\t", "So it goes. ", "énd."])
            rows.append((None if conv == 3 else conv, None if r.random() < 0.05 else turn + r.randrange(3) * (r.random() < 0.1), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_equals_search_over_edits(spark):
    rows = invented(1)
    docs = with_clashes(frame(spark, rows), "copies", "digest", "fault", "audit", "place", "_kind")
    found = repair.repair(repair.damaged(docs))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_short_stretches_and_one_hot_conversation(spark):
    rows = invented(2, 12) + [(77, t, *r[2:]) for t, r in enumerate(invented(5, 60))] + [(77, 4, "user", "Again!")] * 30
    plain = frame(spark, rows)
    expected = brute(rows, [(c, t, *(" " if x is None else x for x in more)) for c, t, *more in rows])
    for stretch in (1, 3, 4096):
        found = repair.repair(repair.plain_rows(plain), stretch)
        assert sorted(map(tuple, found.collect()), key=str) == expected


def test_repaired_rows_have_the_digest(spark):
    rows = repair.damaged(frame(spark, invented(3)))
    audited = repair.audits(rows)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.repaired_digests(rows, audited).collect()}
    texts: dict = {}
    for r in sorted(repair.repaired_rows(rows, audited).collect(), key=lambda r: (str(r.conv_id), r.place)):
        texts.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv, digest in digests.items():
        own = texts.get(conv, [])
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == digest
        assert PATTERN.fullmatch("".join(a[:1] for a, _ in own))


def test_order_of_audits_and_collisions(monkeypatch):
    def pairs(n):
        r = random.Random(n)
        for _ in range(300):
            tree, nodes = repair.Audits(), [(0, "")]
            for _ in range(40):
                node, text = r.choice(nodes[-6:])
                letters = r.choice(["D", "I", "K", "R"]) + r.choice(["", "", "I", "DD"])
                if any(t == text + letters for _, t in nodes):
                    continue
                nodes.append((tree.add(node, letters), text + letters))
            (a, x), (b, y) = r.sample(nodes, 2)
            assert tree.less(a, b) == (x < y) and tree.text(a) == x
            yield tree.collisions

    assert sum(pairs(1)) == 0
    monkeypatch.setattr(repair, "_MODULUS", 3)
    assert sum(pairs(2)) > 0


def test_empty_table_and_lost_conversation(spark):
    assert repair.repair(repair.damaged(frame(spark, []))).collect() == []
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = repair.repair(repair.damaged(frame(spark, [(conv, 0, "user", "Hi.")]))).collect()
    assert [tuple(r) for r in found] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
