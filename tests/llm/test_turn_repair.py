from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest import SF_DIR
from loomframe.llm import turn_repair as tr

SCHEMA = "conv_id long, turn long, role string, text string, n int, edit string, first string, conv string"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return out


def plain_faults(turns):
    seen, out = set(), []
    for role, text in turns:
        visible = VISIBLE.findall(text)
        out.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(turns):
    """Cheapest cost, least audit and repaired lines by keeping every audit as a string."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def insertions(best):
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                for r in "ua":
                    if (state, r) in step:
                        way = (cost + 2, audit + "I", lines + (f"{names[r]}:",))
                        after = step[state, r]
                        best[after] = min(best.get(after, way), way)
        return best

    best = {"": (0, "", ())}
    for (role, text), fault in zip(turns, plain_faults(turns)):
        ways = {}
        for state, (cost, audit, lines) in insertions(best).items():
            found = [(state, (cost + 3, audit + "D", lines))]
            if fault in ("", "truncated"):
                more = fault == "truncated"
                if (state, role[:1]) in step:
                    found.append((step[state, role[:1]], (cost + more, audit + "K", lines + (f"{role}:{text}",))))
                found += [
                    (step[state, r], (cost + 2 + more, audit + "R", lines + (f"{names[r]}:{text}",)))
                    for r in "ua" if (state, r) in step
                ]
            for after, way in found:
                ways[after] = min(ways.get(after, way), way)
        best = ways
    return min(way for state, way in insertions(best).items() if state in ("", "a"))


def plain_report(ids, damaged):
    out = {}
    for conv in set(ids):
        rows = [r for r in damaged if r[0] == conv]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[2:] for r in rows]
        kinds = plain_faults(turns)
        cost, audit, lines = plain_repair(turns)
        numbers = [r[1] for r in rows if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        bad = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out[conv] = (
            gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), bad, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def reported(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_plain_repair_against_all_edits():
    """The string version itself, against every combination of edits of up to three turns."""
    gaps = ["", "u", "a", "uu", "ua", "au", "aa"]
    for initials in itertools.chain.from_iterable(itertools.product("suat", repeat=n) for n in range(4)):
        turns = [(r, f"{i}." if i % 2 else f"{i}") for i, r in enumerate(initials)]
        best = None
        for edits in itertools.product("DKua", repeat=len(turns)):
            for put in itertools.product(gaps, repeat=len(turns) + 1) if len(turns) < 3 else itertools.product(gaps[:5:2] + ["u"], repeat=4):
                roles, audit, cost = put[0], "I" * len(put[0]), 2 * len(put[0])
                for edit, (role, text), more in zip(edits, turns, put[1:]):
                    audit += ("R" if edit in "ua" else edit) + "I" * len(more)
                    roles += ("" if edit == "D" else role if edit == "K" else edit) + more
                    cost += 2 * len(more) + (3 if edit == "D" else (0 if edit == "K" else 2) + (text[-1] not in ".!?"))
                if re.fullmatch("(s?(ua)+)?", roles):
                    best = min(best or (cost, audit), (cost, audit))
        assert plain_repair(turns)[:2] == best


@pytest.mark.parametrize("chunk", [1, 2, 7, 1024])
def test_long_conversations_in_chunks(monkeypatch, chunk):
    monkeypatch.setattr(tr, "CHUNK", chunk)
    draw = random.Random(chunk)
    for _ in range(60):
        turns = [(draw.choice("suat"), draw.choice(["x.", "y", "", f"{i}!", f"{i}"])) for i in range(draw.randrange(1, 40))]
        number = {"blank": 1, "duplicate": 2, "truncated": 3, "": 0}
        codes = bytes(4 * "suat".index(r) + number[f] for (r, _), f in zip(turns, plain_faults(turns)))
        cost, steps = tr.solve(codes, 0, None)
        found = list(tr.edits(steps, True))
        audit = "".join("I" * len(b) + e + "I" * len(a) for e, b, _, a in found)
        assert (cost, audit) == plain_repair(turns)[:2]
        # and as one table of states
        assert min(c + tr._ENDS[p][1] for q, p, c, _ in tr.total(codes) if q == 0) == cost


def test_collisions_are_verified(monkeypatch):
    monkeypatch.setattr(tr.Trails, "MOD", 3)
    draw = random.Random(5)
    for _ in range(30):
        trails, nodes = tr.Trails(), [(0, ())]
        for _ in range(120):
            node, labels = draw.choice(nodes)
            label = draw.randrange(3)
            nodes.append((trails.add(node, label), (*labels, label)))
        for (a, one), (b, other) in itertools.combinations(nodes, 2):
            if len(one) == len(other):
                assert trails.compare(a, b) == (one > other) - (one < other)


def odd_rows():
    draw = random.Random(3)
    roles = ["system", "user", "assistant", "tool", "", None, "usurper"]
    texts = ["Fine.", "What?", "cut off", "", " \t\n", None, "é!", "no end…", "a.b", "Fine. \n"]
    rows = [(c, t, draw.choice(roles), draw.choice(texts)) for c in range(60) for t in range(draw.randrange(1, 9))]
    rows += [(c, draw.choice([None, 3, 9, 10**6]), draw.choice(roles), draw.choice(texts)) for c in range(50, 80) for _ in range(5)]
    rows += [(None, draw.choice([None, 1, 2]), draw.choice(roles), draw.choice(texts)) for _ in range(9)]
    rows += [(7, 2, "user", "again."), (7, 2, "user", "again.")] * 3
    rows += [(1000, t, draw.choice(roles[:3]), f"{t % 50}{draw.choice('.! ')}") for t in range(700)]  # a hot conversation
    rows += [(1001, 0, "user", "y" * 200_000), (1001, 1, "assistant", "z" * 200_000 + ".")]
    return rows


def test_odd_rows_against_the_plain_version(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA).repartition(6)
    want = plain_report([r[0] for r in rows], plain_damage(rows))
    assert reported(tr.report(df, tr.damaged(df))) == want
    untouched = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert reported(tr.report(df, df)) == plain_report([r[0] for r in rows], untouched)


def test_edits_rebuild_the_conversation(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA)
    edited, _ = tr.repair(df)
    lines: dict = {}
    for r in edited.orderBy("n").collect():
        lines.setdefault(r.conv_id, []).extend(
            [*r.before, *([] if r.edit == "D" else [r.role if r.edit == "K" else r.given]), *r.after]
        )
    assert edited.count() == len(rows)
    for roles in lines.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in roles))


def test_query_against_the_plain_version(spark):
    from loomframe.llm.queries import QUERIES

    talks = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in talks.collect()]
    got = reported(QUERIES["op12_conversation_repair"](spark, SF_DIR))
    assert got == plain_report([r[0] for r in rows], plain_damage(rows))


def test_no_rows_after_damage_and_empty_table(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.", 1, "", "", "")], SCHEMA)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert reported(tr.report(df, tr.damaged(df))) == {dropped: nothing}
    none = spark.createDataFrame([], SCHEMA)
    assert tr.report(none, tr.damaged(none)).count() == 0
