import hashlib
import itertools
import random
import zlib

import pytest

from flowframe.llm import repair as r
from flowframe.llm.queries import QUERIES

STATE = {"": 0, "s": 1, "u": 2, "a": 3}
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def faults_of(rows):
    """First fault per (role, text), the plain way."""
    out, seen = [], set()
    for role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain(rows):
    """Cost, audit and lines by a search forward over all states, whole strings carried along."""
    best = {0: (0, "", ())}

    def offer(held, state, entry):
        if state not in held or entry[:2] < held[state][:2]:
            held[state] = entry

    def inserts(held):
        for _ in range(3):
            for q, (cost, audit, lines) in list(held.items()):
                role = "assistant" if q == 2 else "user"
                offer(held, NEXT[q, role[0]], (cost + 5, audit + "I", (*lines, f"{role}:")))

    for (role, text), fault in zip(rows, faults_of(rows), strict=True):
        inserts(best)
        after = {}
        for q, (cost, audit, lines) in best.items():
            offer(after, q, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if (q, role[:1]) in NEXT:
                offer(after, NEXT[q, role[:1]], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            new = "assistant" if q == 2 else "user"
            offer(after, NEXT[q, new[0]], (cost + 1 + extra, audit + "R", (*lines, f"{new}:{text}")))
        best = after
    inserts(best)
    return min(best[q][:2] + (best[q][2],) for q in (0, 3) if q in best)


def sha(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def by_blocks(kinds, size):
    """One conversation's cost and audit through blocks of ``size`` rows, without Spark."""
    costs = r.Costs()
    parts = [kinds[i:i + size] for i in range(0, len(kinds), size)]
    ends, after = [], r.closed(r.EMPTY_END)
    for k in range(len(parts) - 1, -1, -1):
        ends.append(r.EMPTY_END if k == len(parts) - 1 else tuple(after))
        table = costs.table(parts[k])
        after = [min(table[4 * q + e] + after[e] for e in range(4)) for q in range(4)]
    ends.reverse()
    solved = r.solve(costs, [(p, e, k == len(parts) - 1, 4 if k else 1) for k, (p, e) in enumerate(zip(parts, ends, strict=True))])
    state, audit = 0, ""
    for exits, marks in solved:
        audit += marks[state]
        state = exits[state]
    return after[0], audit.translate(str.maketrans("uaUA", "RRII"))


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "tool", "", "user", "assistant"]
    return [(rng.choice(roles), rng.choice(["Yes.", "No!", "cut", " ", "", "Why?", f"t{rng.random()}.", f"u{rng.random()}"])) for _ in range(n)]


def kinds_of(rows):
    sound = {None: 0, "truncated": 1}
    return bytes(3 * ("sua".find(role[:1]) if role[:1] and role[0] in "sua" else 3) + sound.get(fault, 2)
                 for (role, _), fault in zip(rows, faults_of(rows), strict=True))


@pytest.mark.parametrize("seed", range(60))
def test_blocks_against_plain_search(seed):
    rng = random.Random(seed)
    rows = random_rows(rng, rng.randint(1, 24))
    cost, audit, _ = plain(rows)
    for size in (1, 3, 7, 100):
        assert by_blocks(kinds_of(rows), size) == (cost, audit)


def test_every_short_conversation():
    for n in (1, 2, 3):
        for combo in itertools.product([("system", "x."), ("user", "cut"), ("user", "y."), ("assistant", "z."), ("tool", "")], repeat=n):
            cost, audit, _ = plain(combo)
            assert by_blocks(kinds_of(combo), 2) == (cost, audit)


def test_long_conversation_in_one_block():
    rng = random.Random(5)
    rows = random_rows(rng, 3000)
    cost, audit, _ = plain(rows)
    assert by_blocks(kinds_of(rows), 10_000) == by_blocks(kinds_of(rows), 64) == (cost, audit)


def ordered(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], sha([x[2]])))


def expected(conversations):
    """The whole query, the plain way; rows are (conv_id, turn, role, text)."""
    space = lambda x: " " if x is None else str(x)
    kept = {conv: [] for conv, *_ in conversations}
    for conv, turn, role, text in conversations:
        lot = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if lot == 1 else "".join(c for c in text if c not in ".!?") if lot == 2 else text
        kept[conv] += [] if lot == 0 else [(turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    out = {}
    for conv, rows in kept.items():
        rows = ordered(rows)
        said = [x[1:] for x in rows]
        found = faults_of(said)
        turns = [x[0] for x in rows if x[0] is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, lines = plain(said)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha(lines))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, copy int, fault string"


def query(spark, folder, rows):
    spark.createDataFrame([(*x, 1, "clash") for x in rows], SCHEMA).write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    out = QUERIES["op13_prefix_doubling_repair"](spark, str(folder)).collect()
    assert len({x.conv_id for x in out}) == len(out)
    return {x.conv_id: tuple(x[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for x in out}


def test_query_against_plain_version(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            (role, text), = random_rows(rng, 1)
            rows.append((conv, rng.choice([turn, turn, turn, None, 2 * turn]), rng.choice([role, role, None]), rng.choice([text, text, None])))
    rows += rows[:20]
    assert query(spark, tmp_path, rows) == expected(rows)


def test_query_on_test_table(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert query(spark, tmp_path, [tuple(x) for x in table.collect()]) == expected([tuple(x) for x in table.collect()])


def test_empty_table_and_conversations_that_lose_all_rows(spark, tmp_path):
    assert query(spark, tmp_path / "none", []) == {}
    turns = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert turns and set(query(spark, tmp_path / "dropped", turns).values()) == {(0, 0, 0, 0, 0, 0, "", sha([]))}


def test_blocks_of_a_large_conversation_and_long_text(spark):
    rng = random.Random(8)
    said = random_rows(rng, 700) + [("user", "a" * 2_000_000 + "."), ("assistant", "b.")]
    frame = spark.createDataFrame([(1, k, *x) for k, x in enumerate(said)], "conv_id long, turn long, role string, text string")
    edits, costs = r.repair(r.judged_rows(frame), r.texts_of(frame), block_rows=64)
    done, = r.digests(edits).collect()
    cost, audit, lines = plain(said)
    assert (costs.first().cost, done.audit, done.repaired_sha256) == (cost, audit, sha(lines))
    steps = [x.step for x in edits.select("step").collect()]
    assert sorted(steps) == list(range(len(audit)))
