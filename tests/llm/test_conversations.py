"""Conversation repair against all edits tried out, and against a plain dynamic program over strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from slipstream.llm import conversation
from slipstream.llm.conversation import Audits, as_they_are, damaged, finish, repair, repaired_turns, segment
from slipstream.llm.queries import prepare
from tests.llm.conftest import rows_of

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
WHITE = " \t\n\v\f\r"


def fault(role, text, seen):
    bare = text.strip(WHITE)
    return "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""


def cheapest(rows):
    """(cost, audit, repaired rows) of rows (role, text): best strings for each state, inserted rows by relaxation."""
    seen, best = set(), {0: (0, "", ())}

    def offer(into, state, found):
        if state not in into or found < into[state]:
            into[state] = found

    def insert(best):
        best = dict(best)
        for _ in range(4):
            for s, (c, a, r) in list(best.items()):
                for i, t in STEPS[s].items():
                    if i != "s":
                        offer(best, t, (c + 3, a + "I", (*r, ({"u": "user", "a": "assistant"}[i], ""))))
        return best

    for role, text in rows:
        f = fault(role, text, seen)
        seen.add((role, text))
        now = {}
        for s, (c, a, r) in insert(best).items():
            offer(now, s, (c + 4, a + "D", r))
            if f not in ("blank", "duplicate"):
                extra = 3 if f else 0
                if role[:1] in STEPS[s]:
                    offer(now, STEPS[s][role[:1]], (c + extra, a + "K", (*r, (role, text))))
                for i, name in (("u", "user"), ("a", "assistant")):
                    if i in STEPS[s]:
                        offer(now, STEPS[s][i], (c + 3 + extra, a + "R", (*r, (name, text))))
        best = now
    best = insert(best)
    return min(best[s] for s in (0, 3) if s in best)


def expected(rows, damage=True):
    """Result rows for (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 19
        own = convs.setdefault(conv, [])
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        own += [] if fate == 0 else [(turn, role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, counts = set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            f = fault(role, text, seen)
            seen.add((role, text))
            if f:
                counts[f] += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        turns = {r[0] for r in own if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, left = cheapest([r[1:] for r in own])
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, sha))
    return sorted(out, key=repr)


def invented(n, longest, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "What?", "", " \t", "So it is! ", "No", "é", "Yes."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), rng.choice(["user", "assistant", "system", "tool", "user", "assistant", None, ""]), rng.choice([*texts, f"Text {rng.random()}.", None])))
    return rows + rows[:5] + rows[:1] * 30


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def test_plain_program_against_all_edits():
    rng = random.Random(5)
    legal = re.compile(r"(s?(ua)+)?")
    for _ in range(150):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", f"{rng.random()}."])) for _ in range(rng.randint(0, 3))]
        seen, options = set(), []
        for role, text in rows:
            f = fault(role, text, seen)
            seen.add((role, text))
            own = [("D", 4, "")]
            if f not in ("blank", "duplicate"):
                extra = 3 if f else 0
                own += [("K", extra, role[0]), ("R", 3 + extra, "u"), ("R", 3 + extra, "a")]
            options.append([(i + o[0], 3 * len(i) + o[1], j + o[2]) for o in own for k in range(3) for i, j in (("I" * k, "".join(x)) for x in itertools.product("ua", repeat=k))])
        options.append([("I" * k, 3 * k, "".join(x)) for k in range(3) for x in itertools.product("ua", repeat=k)])
        found = [(sum(o[1] for o in way), "".join(o[0] for o in way)) for way in itertools.product(*options) if legal.fullmatch("".join(o[2] for o in way))]
        assert cheapest(rows)[:2] == min(found)


@pytest.mark.parametrize("size", [1, 2, 5, 2048])
def test_segments_join_to_the_same_audit(monkeypatch, size):
    monkeypatch.setattr(conversation, "SEGMENT", size)
    for seed in range(30):
        rows = [(t, r or " ", x or " ") for _, t, r, x in invented(1, 25, seed)]
        cost, audit, left = cheapest([r[1:] for r in rows])
        found = finish([[*r, 1] for r in rows])
        assert found[5:7] == (cost, audit)
        assert found[7] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()


@pytest.mark.parametrize("size", [3, 2048])
def test_conversations(spark, monkeypatch, size):
    monkeypatch.setattr(conversation, "SEGMENT", size)
    prepare(spark)
    rows = invented(40, 12, 1) + [(None, None, None, None)] * 7 + [(None, k % 5, "user", f"{k}.") for k in range(60)] + [(None, 2, "user", "x")] * 20
    rows += [(900 + k, 0, "user", "Only this.") for k in range(60)]  # some are left without any row
    docs = frame(spark, rows)
    want = expected(rows)
    assert any(w[-2] == "" and w[-3] == 0 for w in want)
    found = repair(damaged(docs))
    assert set(found.columns) == set(COLUMNS) and rows_of(found, *COLUMNS) == want
    whole = repair(as_they_are(docs))
    assert rows_of(whole, *COLUMNS) == expected(rows, False)
    # all of it by segments, as if every conversation crossed a border
    monkeypatch.setattr(conversation, "_inside", lambda d: d.selectExpr("conv_id", "true AS open", "turn", "role", "text", "n", *[f"CAST(NULL AS {'STRING' if c in ('audit', 'repaired_sha256') else 'BIGINT'}) AS {c}" for c in COLUMNS[1:]]))
    assert rows_of(repair(damaged(docs)), *COLUMNS) == want


def test_turns_that_are_left(spark):
    prepare(spark)
    rows = invented(15, 9, 8)
    docs = damaged(frame(spark, rows))
    found = repair(docs)
    lines = {}
    for conv, _, role, text in sorted(map(tuple, repaired_turns(docs, found).collect()), key=lambda r: (r[0], r[1])):
        lines.setdefault(conv, []).append(f"{role}:{text}")
    for r in found.collect():
        assert hashlib.sha256("\n".join(lines.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_given_conversations(spark):
    prepare(spark)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = repair(damaged(frame(spark, rows)))
    assert rows_of(found, *COLUMNS) == expected(rows)


def test_no_conversations(spark):
    assert repair(damaged(frame(prepare(spark), [(1, 1, "user", "x")]).limit(0))).count() == 0


def test_audit_nodes(monkeypatch):
    """Comparison of audits is that of strings, also where every hash collides."""
    rng = random.Random(2)
    for modulus in (conversation._MOD, 1, 7):
        monkeypatch.setattr(conversation, "_MOD", modulus)
        audits, texts = Audits(), [""]
        for _ in range(400):
            parent = rng.choice([len(texts) - 1, rng.randrange(len(texts))])
            initial = rng.choice("DIK")
            audits.add(parent, initial)
            texts.append(texts[parent] + initial)
        for _ in range(3000):
            a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
            assert audits.text(a) == texts[a]
            assert audits.before(a, b) == (texts[a] < texts[b])
    assert segment([]) == [[(0, 0, "") if s == e else None for s in range(4)] for e in range(4)]
