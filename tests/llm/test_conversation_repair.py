"""Conversation repair against brute force, on generated conversations with every fault."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tallybook.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, conv string, copies int"
SHAPE = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip("\t\n\v\f\r ")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_repair(rows, bad):
    """The least (cost, audit, repaired) by plain strings: insertions anywhere, any number up to two in a place."""
    best = {"": (0, "", [])}  # by the role initials so far, cut to what the pattern still looks at

    def put(to, initials, cost, audit, rows):
        if re.fullmatch(r"(s?((ua)*u?))?", initials) is None:
            return
        key = "s" if initials == "s" else "" if not initials else "U" if initials[-1] == "u" else "A"
        if key not in to or (cost, audit) < to[key][:2]:
            to[key] = (cost, audit, rows)

    canon = {"": "", "s": "s", "U": "u", "A": "ua"}

    def inserted(frm):
        for _ in range(2):
            new = dict(frm)
            for key, (cost, audit, out) in frm.items():
                for role in ("user", "assistant"):
                    put(new, canon[key] + role[0], cost + 5, audit + "I", out + [(role, "")])
            frm = new
        return frm

    for (_, _, role, text), fault in zip(rows, bad):
        new = {}
        for key, (cost, audit, out) in inserted(best).items():
            put(new, canon[key], cost + 2, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                put(new, canon[key] + role[:1], cost + more, audit + "K", out + [(role, text)]) if role[:1] else None
                for other in ("user", "assistant"):
                    put(new, canon[key] + other[0], cost + more + 1, audit + "R", out + [(other, text)])
        best = new
    best = inserted(best)
    return min(best[k] for k in ("", "A") if k in best)


def brute(rows, everyone):
    out = {}
    for conv in {r[0] for r in everyone}:
        own = in_order([r for r in rows if r[0] == conv])
        bad = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        cost, audit, fixed = every_repair(own, bad)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        assert SHAPE.fullmatch("".join(r[:1] for r, _ in fixed))
        out[conv] = (gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def conversations(seed, n, roles=("user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "a")):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(0, 9)):
            text = r.choice(["Yes.", "no", "Why?", "", "  ", None, "long text, " * r.randrange(1, 5), "Fine! ", "Ok.\n", f"{turn} done."])
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, None]), r.choice(roles), text))
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (None, 2, None, None)]
    hot = 900  # one conversation with a third of all rows, and one row repeated very often
    for turn in range(300):
        rows.append((hot, turn if turn % 50 else None, r.choice(["user", "assistant", "system"]), r.choice([f"{turn}.", f"{turn}", "Same."])))
    rows += [(901, 0, "user", "Again.")] * 120 + [(901, 1, "assistant", "Again.")] * 3
    return rows


@pytest.fixture(scope="module")
def rows():
    return conversations(4, 120)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_audits_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK_ROWS", 7)  # the hot conversation is many stretches even in one task
    turns = cr.counted(frame(spark, rows))
    assert got(cr.audits(spark, cr.damage(turns), turns)) == brute(damaged(rows), rows)


def test_without_damage_and_repaired_turns(spark, rows):
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    turns = cr.counted(frame(spark, rows))
    want = brute(plain, rows)
    assert got(cr.audits(spark, turns)) == want
    fixed = {}
    for r in cr.repaired_turns(spark, turns).orderBy("conv_id", "position").collect():
        fixed.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(fixed.get(c, [])).encode()).hexdigest() for c in want} == {c: v[-1] for c, v in want.items()}


def test_no_rows_and_a_very_long_text(spark):
    assert cr.audits(spark, cr.counted(frame(spark, []))).collect() == []
    rows = [(1, 0, "user", "a" * 3_000_000), (1, 1, "assistant", "b " * 1_000_000 + "."), (1, 2, "user", "c.")]
    assert got(cr.audits(spark, cr.counted(frame(spark, rows)))) == brute(rows, rows)


def test_stretches_chain_like_one(monkeypatch):
    r = random.Random(9)
    for _ in range(150):
        rows = [(r.random() < 0.2, r.random() < 0.3, r.choice("uuaas "), 1) for _ in range(r.randrange(1, 14))]
        whole, parts = cr.Chain(), cr.Chain()
        whole.add(*cr.stretch(rows, range(4))[:2])
        cut = sorted(r.sample(range(1, len(rows)), min(2, len(rows) - 1))) if len(rows) > 1 else []
        pieces = [rows[a:b] for a, b in zip([0, *cut], [*cut, len(rows)])]
        done = [cr.stretch(p, range(4)) for p in pieces]
        for c, k, _ in done:
            parts.add(c, k)
        one, many = whole.close(), parts.close()
        audit = "".join(done[i][2][4 * a + b] for i, (a, b) in enumerate(itertools.pairwise(many[2])))
        assert one[:2] == many[:2] and cr.stretch(rows, range(4))[2][4 * one[2][0] + one[2][1]] == audit


def test_collisions_are_verified(monkeypatch):
    monkeypatch.setattr(cr, "_MOD", 3)  # nearly all prefixes collide
    trail, r = cr.Trail(), random.Random(1)
    nodes = [0]
    for _ in range(200):
        nodes.append(trail.add(r.choice(nodes), r.choice("DIKR")))
    for _ in range(500):
        a, b = r.choice(nodes), r.choice(nodes)
        s, t = trail.text(a), trail.text(b)
        assert trail.compare(a, b) == (s > t) - (s < t)
