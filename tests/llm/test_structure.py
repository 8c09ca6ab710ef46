import hashlib
import random
import zlib

import duckdb
import pyarrow as pa
from pyspark.sql import types as T

from cosecha.llm import structure as S

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                     T.StructField("cost", T.StringType()), T.StructField("dropped", T.BooleanType())])


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", True) for r in rows], ROWS)


def cheapest(rows):
    """All edit sequences, with up to two rows inserted at every place."""
    best = None

    def go(i, state, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        here = [(state, cost, audit, out)]
        for _ in range(2):
            s, c, a, o = here[-1]
            here.append((S.NEXT[s], c + 3, a + "I", o + [(S.ROLE[S.NEXT[s]], "")]))
        for s, c, a, o in here:
            if i == len(rows):
                if s in (S.START, S.ASSISTANT) and (best is None or (c, a) < best[:2]):
                    best = (c, a, o)
                continue
            role, text, must_go, open_end = rows[i]
            go(i + 1, s, c + 4, a + "D", o)
            if must_go:
                continue
            if role[:1] in S.KEEP[s]:
                go(i + 1, S.KEEP[s][role[:1]], c + 3 * open_end, a + "K", o + [(role, text)])
            go(i + 1, S.NEXT[s], c + 3 + 3 * open_end, a + "R", o + [(S.ROLE[S.NEXT[s]], text)])

    go(0, S.START, 0, "", [])
    return best


def run(rows):
    audit, out = [], []

    def emit(letter, role, text):
        audit.append(letter)
        if role is not None:
            out.append((role, text))

    r = S.Repair(emit, with_text=True)
    for row in rows:
        r.add(*row)
    cost, digest = r.finish()
    assert not r.rows and digest == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
    return cost, "".join(audit), out


def test_equal_to_all_edit_sequences():
    rnd = random.Random(3)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", " "]
    for _ in range(1200):
        rows = [(rnd.choice(roles), str(i), rnd.random() < 0.25, rnd.random() < 0.25) for i in range(rnd.randrange(0, 7))]
        assert run(rows) == tuple(cheapest(rows))


def _open_edits(rows):
    r = S.Repair(lambda *x: None)
    most = 0
    for row in rows:
        r.add(*row)
        most = max(most, len(r.rows))
    r.finish()
    return most


def test_survivors_meet_so_little_stays_open():
    rnd = random.Random(4)
    plain = [(("user", "assistant")[i % 2], "x", False, False) for i in range(20_000)]
    wild = [(rnd.choice(["system", "user", "assistant", "tool"]), "x", rnd.random() < 0.2, rnd.random() < 0.3)
            for _ in range(20_000)]
    blank = [("user", "", True, False)] * 20_000
    system = [("system", "x", False, True)] * 20_000
    assert max(map(_open_edits, (plain, blank, system))) <= 4 and _open_edits(wild) < 60


def test_a_tie_that_stays_open_is_compared_whole():
    # whether the first or a later user turn gets an answer depends on the end
    for n in (4, 5, 7, 8):
        rows = [("user", str(i), False, False) for i in range(n)]
        assert run(rows) == tuple(cheapest(rows))
    rows = [("user", "x", False, False)] * 20_001
    cost, audit, _ = run(rows)
    assert cost == 3 * 10_001 and audit.startswith("KI") and len(audit) > 20_001


def edges(sample):
    rnd = random.Random(9)
    rows = [(c, t, rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]),
             rnd.choice(["Same text.", "Open end", "", None, " \t\n", "Mr. X!  ", f"own {c} {t}.", " ."]))
            for c in range(120) for t in rnd.sample(range(12), rnd.randrange(1, 8))]
    rows += [(None, t, "user", "in a null conversation.") for t in (0, 1, None)] + [(500, None, "user", "Who?"),
             (500, None, "assistant", "No turn."), (501, 3, "user", "Twice."), (501, 3, "user", "Twice."),
             (502, 1, "assistant", "b."), (502, 1, "assistant", "a."), (503, 0, "user", "y" * 300_000 + ".")]
    return rows + [(900, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(400)]


def same_as_sql(rows, out):
    con = duckdb.connect()
    con.register("conversations", pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])}))
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(map(tuple, out), key=key) == sorted(con.sql(S.ORACLE).fetchall(), key=key)


def test_damaged_conversations_equal_to_the_sql(spark, sample):
    rows = edges(sample)
    out = S.repair_conversations(table(spark, rows)).collect()
    assert len(out) == len({r[0] for r in rows}) and same_as_sql(rows, out)
    code = {(c, t): zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, *_ in rows}
    gone = {c for c in {r[0] for r in rows} if all(v == 0 for (k, _), v in code.items() if k == c)}
    assert all((r.cost, r.audit) == (0, "") and r.repaired_sha256 == hashlib.sha256(b"").hexdigest()
               for r in out if r.conv_id in gone)


def test_repaired_rows_and_columns_that_clash(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hm"), (2, 0, "assistant", "First.")]
    out = {r.conv_id: r for r in S.repair(table(spark, rows), with_rows=True).collect()}
    assert (out[1].audit, out[1].cost, out[1].repaired) == ("KK", 3, ["user:Hi.", "assistant:Hm"])
    assert (out[2].audit, out[2].repaired) == ("IK", ["user:", "assistant:First."])
    assert S.repair_conversations(table(spark, [])).count() == 0
