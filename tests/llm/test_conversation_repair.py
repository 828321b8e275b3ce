import hashlib
import itertools
import random
import zlib

import pytest

from rowferry.llm.conversation_repair import combined, damaged, parsed, repair_damaged, repaired, repairs

SF_DIR = "/root/testdata/sf0.001"
STEPS = {"B": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
SPACES = " \t\n\x0b\f\r"


def plain(kinds):
    """The least cost and audit from the last row to the first, as the rest of a text decides among equal beginnings."""
    after = {s: (0, "") if s in "BA" else (10**9, "") for s in "BSUA"}

    def inserted(best):
        for _ in range(2):
            for s in "BSUA":
                for x, t in STEPS[s].items():
                    if x != "s":
                        best[s] = min(best[s], (best[t][0] + 2, "I" + best[t][1]))
        return best

    after = inserted(after)
    for kind in reversed(kinds):
        now = {}
        for s in "BSUA":
            ways = [(after[s][0] + 3, "D" + after[s][1])]
            if kind != "D":
                for x, t in STEPS[s].items():
                    if x == kind.lower():
                        ways.append((after[t][0] + kind.isupper(), "K" + after[t][1]))
                    if x != "s":
                        ways.append((after[t][0] + kind.isupper() + 2, "R" + after[t][1]))
            now[s] = min(ways)
        after = inserted(now)
    return after["B"]


def every(kinds):
    """The same over all edits of a few rows, as whole texts."""
    found = []

    def go(i, state, cost, audit, inserted):
        if i == len(kinds) and state in "BA":
            found.append((cost, audit))
        if inserted < 2:
            for x, t in STEPS[state].items():
                if x != "s":
                    go(i, t, cost + 2, audit + "I", inserted + 1)
        if i < len(kinds):
            go(i + 1, state, cost + 3, audit + "D", 0)
            if kinds[i] != "D":
                for x, t in STEPS[state].items():
                    if x == kinds[i].lower():
                        go(i + 1, t, cost + kinds[i].isupper(), audit + "K", 0)
                    if x != "s":
                        go(i + 1, t, cost + kinds[i].isupper() + 2, audit + "R", 0)

    go(0, "B", 0, "", 0)
    return min(found)


def least(cells):
    return min((cells[at][0], cells[at][1][0]) for at in ("BB", "BA") if at in cells)


def test_cells_against_all_edits():
    for n in (1, 2, 3):
        for kinds in itertools.product("suaoAD", repeat=n):
            assert least(parsed("".join(kinds), {})) == every(kinds) == plain(kinds), kinds


def test_long_intervals_against_plain_search():
    draw, chart = random.Random(3), {}
    for _ in range(150):
        kinds = "".join(draw.choice("sSuuuUaaaAoOD") for _ in range(draw.randint(4, 14)))
        assert least(parsed(kinds, chart)) == plain(kinds), kinds
        cut = sorted(draw.sample(range(1, len(kinds)), 2))
        parts = [kinds[a:b] for a, b in zip([0, *cut], [*cut, len(kinds)], strict=True)]
        assert least(combined([parsed(p, chart) for p in parts])) == plain(kinds), kinds


def expected(rows):
    """The contract, row by row."""
    out = {}
    by_conv = {}
    for conv, turn, role, text in rows:
        out[conv] = by_conv.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out[conv] += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    result = {}
    for conv, kept in by_conv.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, kinds, faults = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in kept:
            kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
            body = text.strip(SPACES)
            if not body:
                kind, fault = "D", "b"
            elif (role, text) in seen:
                kind, fault = "D", "d"
            elif body[-1] not in ".!?":
                kind, fault = kind.upper(), "t"
            else:
                fault = None
            seen.add((role, text))
            kinds += kind
            if fault:
                faults[fault] += 1
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit = plain(kinds) if kept else (0, "")
        lines, i, system = [], 0, False
        for edit in audit:
            due = "user" if (len(lines) - system) % 2 == 0 else "assistant"
            if edit == "I":
                lines.append(f"{due}:")
                continue
            _, role, text = kept[i]
            i += 1
            if edit == "K":
                system = system or role[:1] == "s"
                lines.append(f"{role}:{text}")
            elif edit == "R":
                lines.append(f"{due}:{text}")
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result[conv] = (gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit, sha)
    return result


def check(df):
    found = [tuple(r) for r in repair_damaged(df).collect()]
    want = expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert {r[0]: r[1:] for r in found} == want and len(found) == len(want)


def test_given_conversations(spark):
    check(spark.read.parquet(f"{SF_DIR}/conversations.parquet"))


def test_awkward_conversations(spark):
    draw = random.Random(11)
    texts = ["Yes.", "no", "", " \t", None, "Why?", "é!\n", "ok. ", "Ab.", "x" * 100_000 + "!"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sys"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(draw.randint(1, 9)):
            at = draw.choice([turn, turn, turn + 3, None, turn - 1])
            rows.append((conv, at, draw.choice(roles[:3] * 3 + roles), draw.choice(texts), 1, "x"))
    rows += rows[:40]
    schema = "conv_id long, turn long, role string, text string, cost int, kind string"
    check(spark.createDataFrame(rows, schema))
    assert repair_damaged(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("key", ["long", "string"])
def test_long_conversation_over_many_tasks(spark, key):
    draw = random.Random(2)
    rows = [(1, t, draw.choice(["user", "assistant", "system"]), draw.choice(["Same.", f"T {t}.", f"cut {t}"])) for t in range(900)]
    rows += [(c, t, "user", "Hello.") for c in range(2, 30) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(df.withColumn("conv_id", df["conv_id"].cast(key)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_repaired_turns(spark):
    rows = [(7, 0, "assistant", "Late."), (7, 1, "user", "Q?"), (7, 2, "user", "Q?"), (7, 3, "assistant", "A."), (8, 0, "tool", "T.")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, copies int")
    found = sorted(tuple(r) for r in repaired(df, repairs(df)).select("conv_id", "place", "edit", "role", "text").collect())
    assert [r for r in found if r[0] == 7] == [
        (7, 0, "I", "user", ""), (7, 1, "K", "assistant", "Late."), (7, 2, "K", "user", "Q?"), (7, 3, "K", "assistant", "A.")
    ]
    assert [r[2:4] for r in found if r[0] == 8] == []
    assert damaged(df).columns == ["conv_id", "turn", "role", "text", "copies"]
