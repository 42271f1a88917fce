import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            out += [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def faults(turns):
    """[(role, text, fault)] of one conversation's turns in order."""
    seen, out = set(), []
    for role, text in turns:
        bare = text.strip(cr.BLANKS)
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                 else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def best(turns):
    """(cost, initials, lines) by trying all edits, from the last turn on."""
    after = {"": (0, "", ()), "s": (4, "II", ("user:", "assistant:")), "u": (2, "I", ("assistant:",)),
             "a": (0, "", ())}
    for role, text, fault in reversed(turns):
        own = {}
        for state in after:
            ways = [(3 + after[state][0], "D" + after[state][1], after[state][2])]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                to = role[:1]
                if to and (to == NEXT[state] or to == "s" and state == ""):
                    c, a, t = after[to]
                    ways.append((more + c, "K" + a, (f"{role}:{text}", *t)))
                c, a, t = after[NEXT[state]]
                ways.append((2 + more + c, "R" + a, (f"{NAMES[NEXT[state]]}:{text}", *t)))
            own[state] = min(ways)
        for _ in range(3):  # insertions before this turn
            own = {q: min(own[q], (2 + own[NEXT[q]][0], "I" + own[NEXT[q]][1],
                                   (NAMES[NEXT[q]] + ":", *own[NEXT[q]][2]))) for q in own}
        after = own
    return after[""]


def plain_repair(rows):
    """{conv_id: (blank, duplicate, truncated, illegal, cost, audit, sha256)}"""
    groups = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        groups.setdefault(conv, []).append((turn is not None, turn, role, text))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0], r[1] or 0, r[2], r[3][:64], hashlib.md5(r[3].encode()).hexdigest()))
        turns = faults([r[2:] for r in own])
        cost, audit, lines = best(turns)
        pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(turns)]
        out[conv] = (
            *(sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(spark, rows, parts=6):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", edit string, seq int")
    done = cr.repair(df.repartition(parts))
    hashes = {r.conv_id: r.sha256 for r in cr.digests(done.turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                       hashes.get(r.conv_id, empty)) for r in done.report.collect()}
    return got, done


def conversation(rng, conv, n, strange=0.2):
    out = []
    for turn in range(n):
        role = ["user", "assistant"][turn % 2] if rng.random() > strange else rng.choice(
            ["system", "user", "assistant", "tool", None, "", "Assistant"])
        text = rng.choice([f"t{turn}.", f"t{turn}", "yes.", "", None, " \n", "ok? ", "é" * 70 + rng.choice("ab.")])
        out.append((conv, rng.choice([turn, turn, turn, None, turn - 1]), role, text))
    return out


@pytest.mark.parametrize("chunk", [4096, 3])
def test_repair_equals_plain(spark, monkeypatch, chunk):
    monkeypatch.setattr(cr, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = [r for c in range(60) for r in conversation(rng, c, rng.randrange(1, 12), rng.random())]
    rows += conversation(rng, 100, 150) + conversation(rng, None, 40) + [(2**63 - 1, 5, "user", "hi.")]
    rows += [(101, i, "user", "same text again.") for i in range(60)]
    rows += [(102, 0, "system", "only.")] * 3 + [(103, i, "ua"[i % 2] * 3, f"{i}.") for i in range(40)]
    rng.shuffle(rows)
    got, done = repaired(spark, rows)
    assert got == plain_repair(rows)
    roles = {}
    for r in done.turns.orderBy("conv_id", "_at", "_k").collect():
        roles.setdefault(r.conv_id, []).append(r.role[0])
        assert (r.edit == "I") <= (r.text == "" and r.turn is None)
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in roles.values())


def test_chunks_of_slowly_converging_conversations(spark, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK", 4)
    rows = []
    for conv, (end, n) in enumerate([("user", 90), ("assistant", 91), ("system", 60)]):
        # What comes last decides about all before: no chunk's own vectors meet.
        rows += [(conv, i, "user", "never mind") if i else (conv, 0, "user", "start.") for i in range(n)]
        rows.append((conv, n, end, "end."))
    got, _ = repaired(spark, rows)
    assert got == plain_repair(rows)


def test_passes_end_and_their_number_is_logarithmic(spark, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK", 2)
    passes = []
    fix = cr._mapped
    monkeypatch.setattr(cr, "_mapped", lambda rows, f, schema: (
        passes.append(f.__name__), fix(rows, f, schema))[1])
    rng = random.Random(5)
    rows = [r for c in range(3) for r in conversation(rng, c, 200, 0.0)]
    got, _ = repaired(spark, rows)
    assert got == plain_repair(rows) and passes.count("_fix") <= 8


def test_nothing(spark):
    done = cr.repair(spark.createDataFrame([], SCHEMA))
    assert done.report.count() == 0 and done.turns.count() == 0
    assert cr.digests(done.turns).count() == 0


def test_damage_equals_plain(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, *range(9)]), rng.choice(["user", None]),
             rng.choice(["a. b! c?", None, "", "x"])) for _ in range(300)]
    got = [tuple(r) for r in cr.damage(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_damage(rows)))
    assert {zlib.crc32(f"{c}:{t}".encode()) % 20 for c in range(30) for t in range(9)} >= set(range(5))


def test_gaps(spark):
    rows = [(1, 0), (1, 4), (1, 4), (1, None), (2, None), (3, 7), (None, 2), (None, 9),
            (4, -(2**63)), (4, 2**62 - 2**63)]
    df = spark.createDataFrame(rows, "conv_id long, turn long")
    assert {r.conv_id: r.gaps for r in cr.gaps(df).collect()} == {
        1: 3, 2: 0, 3: 0, None: 6, 4: 2**62 - 1}


def test_machine_finds_the_cheapest_by_brute_force():
    """All edits of up to four turns, against the traced ones."""
    kinds = [("s", 0), ("u", 0), ("a", 0), ("", 0), ("u", 1), ("a", 2)]
    machine, texts = cr.Machine(), {0: "", 1: "truncated", 2: "blank"}
    for n in range(1, 5):
        for turns in itertools.product(kinds, repeat=n):
            codes = "".join(chr(65 + 3 * cr.CLASSES.index(r) + f) for r, f in turns)
            _, audit, cost = machine.edits(codes, cr.END, 0, True)
            want = best([(r, "t", texts[f]) for r, f in turns])
            assert (cost, audit) == want[:2]
            assert audit in everything(turns, cost)
    assert len(machine.steps) < 300


def everything(turns, most):
    """The initials of all edits that cost ``most``; fails if any is cheaper."""
    found = set()

    def go(i, state, audit, cost):
        if cost > most:
            return
        if i == len(turns) and state in ("", "a"):
            assert cost == most
            found.add(audit)
        go(i, NEXT[state], audit + "I", cost + 2)
        if i < len(turns):
            role, fault = turns[i]
            go(i + 1, state, audit + "D", cost + 3)
            if fault != 2:
                if role and (role == NEXT[state] or role == "s" and state == ""):
                    go(i + 1, role, audit + "K", cost + (fault == 1))
                go(i + 1, NEXT[state], audit + "R", cost + 2 + (fault == 1))

    go(0, "", "", 0)
    return found
