import json

from cosecha.llm.chat import calls_of, levels, link_tools

SCHEMAS = [("add", "a", "integer", True), ("add", "b", "number", True), ("add", "note", "string", False),
           ("find", "where", "object", True), ("find", "names", "array", False), ("find", "all", "boolean", False)]
CALL = "conv_id long, turn long, call_id string, parent_id string, name string, arguments string, result string"


def run(spark, calls, results, schemas=SCHEMAS):
    c = spark.createDataFrame([(*x, "clash") for x in calls], CALL)
    r = spark.createDataFrame(results, "call_id string, turn long, content string")
    s = spark.createDataFrame(schemas, "name string, field string, type string, required boolean")
    return link_tools(c, r, s).collect()


def test_links_levels_and_errors(spark):
    calls = [(1, 0, "a", None, "add", '{"b": 2.5, "a": 1}'), (1, 2, "b", "a", "add", '{"a": "1", "c": 0}'),
             (1, 4, "c", "b", "find", '{"where": {"y": [1, {"q": 1, "p": 2}], "x": null}, "all": true, "names": []}'),
             (1, 6, "d", "gone", "add", "no json"), (1, 8, "e", "e2", "what", None), (1, 9, "e2", "e", "add", "[1]"),
             (2, 0, None, "a", "add", None), (1, 1, "a", "c", "add", "{}"), (2, 3, "f", "e", "add", '{"a":1,"b":1}')]
    results = [("a", 2, "second"), ("a", 1, "first \"quoted\""), ("zzz", 5, None), (None, 6, "lost")]
    out = {r.call_id: r for r in run(spark, calls, results)}
    assert {k: r.level for k, r in out.items()} == {"a": 0, "b": 1, "c": 2, "d": 0, "e": None, "e2": None, None: 0,
                                                    "zzz": None, "f": None}
    assert {k: r.errors for k, r in out.items()} == {
        "a": "", "b": "missing:b,type:a,unknown:c", "c": "", "d": "bad_json", "e": "no_schema", "e2": "bad_json",
        None: "missing:a,missing:b", "zzz": "no_call", "f": ""}
    assert out["a"].n_calls == 2 and out["a"].n_results == 2 and out["a"].valid and not out["b"].valid
    assert out["a"].json == '{"arguments":{"a":1,"b":2.5},"call_id":"a","level":0,"name":"add",' \
                            '"result":"first \\"quoted\\""}'
    assert '"arguments":{"all":true,"names":[],"where":{"x":null,"y":[1,{"p":2,"q":1}]}}' in out["c"].json
    assert json.loads(out["d"].json)["arguments"] == "no json"
    assert out["zzz"].json == '{"call_id":"zzz","result":null}'


def test_long_chain_in_few_rounds(spark):
    c = spark.createDataFrame([(f"c{i}", f"c{i - 1}" if i else None) for i in range(300)],
                              "call_id string, parent_id string")
    assert {r.call_id: r.level for r in levels(c).collect()} == {f"c{i}": i for i in range(300)}


def test_messages_with_tool_calls(spark):
    text = json.dumps({"tool_calls": [{"id": "x", "name": "add", "after": None, "arguments": {"b": 1, "a": 2}}]})
    m = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", text), (1, 3, "assistant", "plain"),
                               (1, 2, "tool", '{"tool_call_id": "x", "content": "3"}'), (1, 4, "tool", None)],
                              "conv_id long, turn long, role string, text string")
    calls, results = calls_of(m)
    s = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    row, = link_tools(calls, results, s).collect()
    assert row.json == '{"arguments":{"a":2,"b":1},"call_id":"x","level":0,"name":"add","result":"3"}' and row.valid


def test_empty_tables(spark):
    assert run(spark, [], []) == [] and run(spark, [], [], []) == []


def test_identifiers_count_inside_their_conversation(spark):
    call = lambda a: json.dumps({"tool_calls": [
        {"id": "call_1", "name": "add", "after": None, "arguments": {"a": a, "b": 1}},
        {"id": "call_2", "name": "add", "after": "call_1", "arguments": {"a": a, "b": 2}}]})
    answer = lambda n, text: json.dumps({"tool_call_id": f"call_{n}", "content": text})
    rows = []
    for conv in (1, 2, 3, None):
        rows += [(conv, 1, "assistant", call(conv or 0)), (conv, 2, "tool", answer(1, f"one of {conv}")),
                 (conv, 3, "tool", answer(2, f"two of {conv}"))]
    rows += [(4, 1, "assistant", call(4)), (4, 5, "assistant", call(44)), (4, 2, "tool", answer(1, "first")),
             (4, 6, "tool", answer(1, "second")), (4, 7, "tool", answer(1, "third")), (5, 1, "tool", answer(1, "lost"))]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    s = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    out = link_tools(*calls_of(m), s).collect()
    got = sorted(((r.conv_id or 0, r.turn, r.call_id, r.level, json.loads(r.json)["result"], r.n_calls, r.n_results, r.errors)
                  for r in out), key=str)
    expected = [(conv or 0, 1, f"call_{n}", n - 1, f"{w} of {conv}", 1, 1, "") for conv in (1, 2, 3, None)
                for n, w in ((1, "one"), (2, "two"))]
    expected += [(4, 1, "call_1", 0, "first", 2, 3, ""), (4, 5, "call_1", 0, "second", 2, 3, ""),
                 (4, 1, "call_2", 1, None, 2, 0, ""), (4, 5, "call_2", 1, None, 2, 0, ""),
                 (4, 7, "call_1", None, "third", 2, 3, "no_call"), (5, 1, "call_1", None, "lost", 0, 1, "no_call")]
    assert got == sorted(expected, key=str)


def test_every_copy_of_a_hot_identifier_is_a_row(spark):
    c = spark.range(3000).selectExpr("cast(null as long) AS conv_id", "id % 7 AS turn", "'0' AS call_id",
                                     "cast(null as string) AS parent_id", "'add' AS name", "'{}' AS arguments")
    r = spark.range(2000).selectExpr("cast(null as long) AS conv_id", "id % 5 AS turn", "'0' AS call_id",
                                     "cast(id as string) AS content")
    s = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    out = link_tools(c, r, s).collect()
    results = [json.loads(x.json)["result"] for x in out]
    assert len(out) == 3000 and {x.n_calls for x in out} == {3000} and {x.n_results for x in out} == {2000}
    assert sorted(int(x) for x in results if x) == list(range(2000))


SPELT = {"1": "1", "1.0": "1", "1e0": "1", "1E+0": "1", "10e-1": "1", "100": "100", "1e2": "100", "100.00": "100", "0.1": "0.1",
         "1e-1": "0.1", "0.10": "0.1", "-0": "0", "-0.0": "0", "0": "0", "-1.50": "-1.5", "12345678901234567890": "12345678901234567890",
         "1234567.25": "1234567.25", "0.0000012": "0.0000012", "1.2e-6": "0.0000012", "1.2e-7": "1.2e-7", "0.00000012": "1.2e-7",
         "1e40": "1e+40", "15e39": "1.5e+40", "-2.5e-9": "-2.5e-9", "1" * 38: "1" * 38}


def test_equal_numbers_have_equal_bytes(spark):
    from pyspark.sql import functions as F

    from cosecha.llm.chat import plain_numbers
    for wrap in ('{"b":%s}', '{"a":[%s,"x 1.0 \\\\",{"c":%s}]}', '{"q":"1.0 \\"2.0\\" ","z":%s,"t":true}'):
        rows = [(wrap.replace("%s", k), wrap.replace("%s", v)) for k, v in SPELT.items()]
        df = spark.createDataFrame(rows, "given string, want string")
        for r in df.select("*", plain_numbers(F.col("given")).alias("got")).collect():
            assert r.got == r.want
    long = '{"q":"' + 'a \\"1.0\\" \\n' * 60_000 + '","n":1.50}'
    df = spark.createDataFrame([(long,)], "j string").select(plain_numbers(F.col("j")).alias("j"))
    assert df.first().j == long.replace("1.50", "1.5")


def test_integers_by_value_and_canonical_calls(spark):
    values = ["1", "1.0", "1e2", "12345678901234567890", "-0", "1.5", "1e-1", '"1"', "true"]
    calls = [(1, i, f"c{i}", None, "add", '{"b": 100.0, "a": %s}' % v) for i, v in enumerate(values)]
    out = {r.turn: r for r in run(spark, calls, [])}
    assert [out[i].errors for i in range(9)] == [""] * 5 + ["type:a"] * 4
    assert [json.loads(out[i].json)["arguments"]["a"] for i in range(7)] == [1, 1, 100, 12345678901234567890, 0, 1.5, 0.1]
    assert all('"b":100}' in r.json for r in out.values())


def test_the_query_keeps_the_conversation_of_a_lost_result(spark):
    import duckdb
    import pyarrow as pa

    from cosecha.llm import chat
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c" * 300), (2, 3, "assistant", "lost \"x\" 1.0"),
            (None, 0, "user", "n"), (None, 1, "assistant", None), (None, 5, "assistant", "gone"), (3, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    s = spark.createDataFrame(chat.SCHEMAS, "name string, field string, type string, required boolean")
    out = chat.link_tools(*chat.turns_as_calls(df), s)
    con = duckdb.connect()
    con.register("conversations", pa.table({"conv_id": [r[0] for r in rows], "turn": [r[1] for r in rows],
                                            "role": [r[2] for r in rows], "text": [r[3] for r in rows]}))
    cur = con.sql(chat.ORACLE)
    assert {(r.conv_id, r.errors) for r in out.where("errors = 'no_call'").collect()} == {(2, "no_call"), (None, "no_call")}
    assert sorted(map(str, (tuple(r[c] for c in cur.columns) for r in out.collect()))) == sorted(map(str, cur.fetchall()))
