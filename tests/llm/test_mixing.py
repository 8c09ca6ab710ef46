import random
import re
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cosecha.llm import mixing as M

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("size", T.StringType()),
                     T.StructField("rank", T.StringType())])


def goals_by_rounds(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    """The targets as the rule says them: cut, reshare, again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        each = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest} if rest else {}
        above = [s for s in rest if each[s] > most * sizes[s]]
        if not above:
            return {**full, **each}
        for s in above:
            full[s] = most * sizes[s]
            left -= full[s]


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], DOCS)


def corpus(seed, n, sources):
    rnd = random.Random(seed)
    rows = [(i, " ".join(rnd.choice(["a", "bb", "é"]) for _ in range(rnd.randrange(0, 60))), rnd.choice(sources))
            for i in range(n)]
    return rows + [(None, "null id", "b"), (1007, None, "a"), (1008, "", None), (1005, " \t\x0b\r\n", "b"),
                   (1009, "twice w", "a"), (1009, "twice w", "a"), (1010, "z " * 30_000, "long"), (1011, " one", ""),
                   (1012, "only", "tiny")]


def same_as_sql(rows, out):
    con = duckdb.connect()
    con.register("documents", pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(
        [("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())])}))
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(map(tuple, out), key=key) == sorted(con.sql(M.ORACLE).fetchall(), key=key)


@pytest.mark.parametrize("block_words", [64, 4096])
def test_equal_to_the_sql_and_to_the_rule(spark, block_words):
    rows = corpus(1, 300, ["a", "b", "c", "é", "Z", None])
    out = M.mix_documents(table(spark, rows), block_words).collect()
    assert same_as_sql(rows, out)
    sizes, took = defaultdict(int), defaultdict(int)
    source = {i: s for i, _, s in rows}
    for r in out:
        sizes[source[r.doc_id]] += r["size"]
        took[source[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    goals = goals_by_rounds(sizes)
    for r in out:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(goals[source[r.doc_id]])
    assert all(abs(took[s] - goals[s]) <= 0.5 + 1e-6 for s in goals)


def test_slots_hold_equal_blocks_in_a_balanced_order(spark):
    rows = corpus(2, 400, ["a", "b", "c"])
    sizes = M.sized(table(spark, rows))
    goals = M.targets(sizes)
    n = 64
    slots = [r.asDict() for r in M.schedule(goals, n).collect()]
    order = [s["source"] for s in sorted(slots, key=lambda s: s["position"])]
    assert len({s["position"] for s in slots}) == len(slots)
    total = defaultdict(int)
    for s in order:
        total[s] += 1
    for s, k in total.items():  # every stretch of the mix is near the shares
        assert sorted(r["rank"] for r in slots if r["source"] == s) == list(range(k))
        seen = 0
        for i, x in enumerate(order, 1):
            seen += x == s
            assert abs(seen - i * k / len(order)) <= 6
    mixed = M.mix(sizes, goals, n)
    words = {r.position: r.w for r in mixed.groupBy("position").agg(F.sum("words").alias("w")).collect()}
    partial = [p for p, w in words.items() if w != n]
    assert set(words) == {s["position"] for s in slots} and all(w <= n for w in words.values())
    assert len(partial) <= 3 * len(total)  # the ends of two passes, the cut at the target
    # spans of a document: those of one pass meet end to end
    spans = defaultdict(list)
    for r in mixed.collect():
        spans[r.row].append((r["first"], r.words))
    size = {r.row: r["size"] for r in sizes.collect()}
    assert all(f + w <= size[d] for d, s in spans.items() for f, w in s)


def test_reruns_agree_whatever_the_partitions(spark):
    rows = corpus(3, 200, ["a", "b"])
    one = sorted(map(tuple, M.mix_documents(table(spark, rows)).where("doc_id is not null").collect()))
    rows.reverse()
    two = sorted(map(tuple, M.mix_documents(table(spark, rows).repartition(7)).where("doc_id is not null").collect()))
    assert one == two


def test_one_hot_source_of_repeated_rows_and_no_words(spark):
    rows = [(1, "same words here", "hot")] * 500 + [(i, "x", f"s{i}") for i in range(5)]
    assert same_as_sql(rows, M.mix_documents(table(spark, rows), 16).collect())
    none = [(1, None, "a"), (2, " ", None)]
    assert sorted(map(tuple, M.mix_documents(table(spark, none)).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert M.mix_documents(table(spark, [])).count() == 0


def test_passage_and_native_plan(spark):
    df = spark.createDataFrame([("  one two\tthree\nfour ",)], "t string")
    assert df.select(M.passage(F.col("t"), F.lit(1), F.lit(2)).alias("p")).first().p == "two three"
    docs = table(spark, corpus(4, 20, ["a"]))
    assert not re.search("Python|Arrow|Pandas", M.mix_documents(docs)._jdf.queryExecution().toString())
