"""Chat formatting (operator 2): tool-call linking.

Calls and results are joined by identifier; calls are put in topological order
over the call each one follows; arguments are checked against schemas; a call
with its result is written as canonical JSON: keys sorted at every depth, no white
space, one spelling for equal numbers (``1``, ``1.0`` and ``1e0`` are ``1``; see
``plain_numbers``). DataFrame and SQL functions only.

Every call and every result is a row of its own. An identifier counts inside its
conversation (a null ``conv_id`` is a conversation like any other); copies of an
identifier are numbered, and the n-th call has the n-th result, so every join is
on a unique key and a repeated identifier never multiplies rows. The numbers come
from a range sort (``numbered``), so a hot identifier is spread over the tasks.
The order comes from pointer jumping: each round doubles the distance to the
ancestor a call points at, so a chain of n calls takes about log2(n) joins and
no conversation is gathered in a task.

Defined cases: a call without identifier has no result and level 0; a parent
that doesn't exist is no parent; calls in or behind a cycle have a null level;
several calls with one identifier are numbered by (turn, name, arguments), several
results by (turn, content); ``n_calls`` and ``n_results`` say how many there are; a
parent with copies is the first of them; a result without call of its number is a
row with a null name and the error ``no_call``; results without a column
``conv_id``: identifiers count in the whole table; arguments that are no JSON
object: error ``bad_json`` and the raw string stays in the JSON; null arguments
count as ``{}``; a tool without schema: error ``no_schema``; empty tables give no
rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cosecha.llm.common import prepare, store

#: JSON type names -> pattern of the type that Spark reports for a value; an integer is
#: a number without a fraction, however it is written
NUMBER = "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"
TYPES = {"string": "^STRING$", "integer": NUMBER, "number": NUMBER,
         "boolean": "^BOOLEAN$", "object": "^OBJECT<.*", "array": "^ARRAY<.*", "null": "^VOID$"}
_MESSAGE = "struct<tool_calls:array<struct<id:string,name:string,after:string,arguments:variant>>," \
           "tool_call_id:string,content:string>"


def calls_of(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of a table conv_id, turn, role, text whose assistant
    texts may be ``{"tool_calls": [{"id", "name", "after", "arguments"}]}`` and
    whose tool texts ``{"tool_call_id", "content"}``."""
    m = messages.select("conv_id", "turn", "role", F.try_parse_json("text").alias("v"))
    m = m.select("conv_id", "turn", "role", F.try_variant_get("v", "$", _MESSAGE).alias("m"))
    calls = m.where(F.col("role") == "assistant").select("conv_id", "turn", F.explode("m.tool_calls").alias("c")) \
        .select("conv_id", "turn", F.col("c.id").alias("call_id"), F.col("c.after").alias("parent_id"),
                F.col("c.name").alias("name"), F.to_json("c.arguments").alias("arguments"))
    results = m.where((F.col("role") == "tool") & F.col("m.tool_call_id").isNotNull()) \
        .select("conv_id", "turn", F.col("m.tool_call_id").alias("call_id"), F.col("m.content").alias("content"))
    return calls, results


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` (a stored table) with ``copy`` (1, 2, ... among the rows with equal
    ``keys``, nulls being equal, by ``order``) and ``copies`` (their number). Counted
    inside the parts of a range sort first, so no task holds all copies of a key."""
    sort = [*keys, *order, "__row"]
    rows = store(rows.withColumn("__row", F.monotonically_increasing_id()), name)
    parts = store(rows.repartitionByRange(*sort).withColumn("__part", F.spark_partition_id()), name)
    here = Window.partitionBy("__part", *keys)
    parts = parts.withColumn("copy", F.row_number().over(here.orderBy(*order, "__row")))
    sizes = parts.groupBy(*keys, "__part").agg(F.count("*").alias("n"))
    every = Window.partitionBy(*keys)
    sizes = sizes.select(
        F.col("__part").alias("__p"), *[F.col(k).alias(f"__{k}") for k in keys], F.sum("n").over(every).alias("copies"),
        (F.sum("n").over(every.orderBy("__part")) - F.col("n")).alias("__before"))
    same = parts["__part"] == sizes["__p"]
    for k in keys:
        same &= parts[k].eqNullSafe(sizes[f"__{k}"])
    return parts.join(sizes, same).withColumn("copy", F.col("copy") + F.col("__before")).drop(
        "__p", "__part", "__before", "__row", *[f"__{k}" for k in keys])


def levels(calls: DataFrame) -> DataFrame:
    """call_id, level: number of calls before each one on its chain of parents.
    ``calls``: unique call_id, parent_id."""
    ids = calls.select(F.col("call_id").alias("known"))
    now = store(calls.join(ids, calls["parent_id"] == ids["known"], "left")
                .select("call_id", F.col("known").alias("up"), F.when(F.col("known").isNull(), 0).otherwise(1)
                        .cast("long").alias("level")), "levels")
    rounds = math.ceil(math.log2(now.count() + 2)) + 1
    for _ in range(rounds):
        if not now.where(F.col("up").isNotNull()).limit(1).count():
            break
        far = now.select(F.col("call_id").alias("at"), F.col("up").alias("next"), F.col("level").alias("more"))
        now = store(now.join(far, now["up"] == far["at"], "left").select(
            "call_id", F.col("next").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "levels")
    return now.select("call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def _errors(args, spec) -> F.Column:
    """Sorted errors of an argument map against a map field -> (type, required)."""
    keys = F.coalesce(F.map_keys(args), F.array().cast("array<string>"))
    fields = F.map_keys(spec)
    missing = F.filter(fields, lambda f: F.element_at(spec, f)["required"] & ~F.array_contains(keys, f))
    unknown = F.array_except(keys, fields)
    def mistyped(k):
        value, rule = F.element_at(args, k), F.element_at(spec, k)
        return ~F.regexp_like(F.schema_of_variant(value), rule["pattern"]) | (
            rule["whole"] & ~F.regexp_like(plain_numbers(F.to_json(value)), F.lit(r"^-?[0-9]+$|e\+")))

    wrong = F.filter(F.array_intersect(keys, fields), mistyped)
    tag = lambda name, xs: F.transform(xs, lambda x: F.concat(F.lit(name + ":"), x))
    return F.array_sort(F.concat(tag("missing", missing), tag("type", wrong), tag("unknown", unknown)))


def link_tools(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, turn, call_id, level, name, valid, errors, n_calls, n_results,
    json.

    ``calls``: conv_id, turn, call_id, parent_id, name, arguments (JSON text);
    ``results``: [conv_id,] call_id, turn, content; ``schemas``: name, field, type (a
    key of TYPES), required. (level, turn) orders a conversation topologically."""
    prepare(calls.sparkSession)
    c = calls.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.col("call_id").cast("string").alias("call_id"),
                     F.col("parent_id").cast("string").alias("parent_id"), "name", "arguments")
    keys = ["conv_id", "call_id"] if "conv_id" in results.columns else ["call_id"]
    known_conv = F.col("conv_id").cast("long") if "conv_id" in keys else F.lit(None).cast("long")
    named = numbered(c.where(F.col("call_id").isNotNull()), keys,
                     [x for x in ("turn", "name", "arguments", "conv_id", "parent_id") if x not in keys], "calls")
    named = store(named.withColumn("node", F.monotonically_increasing_id()), "calls")
    r = results.where(F.col("call_id").isNotNull()).select(
        known_conv.alias("conv_id"), F.col("call_id").cast("string").alias("call_id"),
        F.col("turn").cast("long").alias("turn"), F.col("content").alias("result"))
    r = store(numbered(r, keys, ["turn", "result"], "results"), "results").select(
        F.col("conv_id").alias("result_conv"), F.col("call_id").alias("result_of"), F.col("turn").alias("result_turn"),
        "result", F.col("copy").alias("result_copy"), F.col("copies").alias("n_results"))
    # the first call of an identifier is the parent of those that follow it
    first = named.where(F.col("copy") == 1).select(F.col("conv_id").alias("first_conv"), F.col("call_id").alias("first_id"),
                                                   F.col("node").alias("up"), F.col("copies").alias("all_calls"))
    of = lambda left, right: left.eqNullSafe(right) if "conv_id" in keys else F.lit(True)
    up = named.join(first, (named["parent_id"] == first["first_id"]) & of(named["conv_id"], first["first_conv"]), "left")
    at = levels(up.select(F.col("node").alias("call_id"), F.col("up").alias("parent_id"))) \
        .withColumnRenamed("call_id", "level_of")
    # the number of all results, and the result of the same number
    answered = r.where(F.col("result_copy") == 1).select(
        F.col("result_conv").alias("any_conv"), F.col("result_of").alias("any_of"), F.col("n_results").alias("any_results"))
    mine = (named["call_id"] == r["result_of"]) & (named["copy"] == r["result_copy"]) & of(named["conv_id"], r["result_conv"])
    linked = named.join(at, named["node"] == at["level_of"]).join(r.drop("n_results"), mine, "left").join(
        answered, (named["call_id"] == answered["any_of"]) & of(named["conv_id"], answered["any_conv"]), "left")
    out = ["conv_id", "turn", "call_id", "name", "arguments", "level", "n_calls", "result", "n_results"]
    linked = linked.withColumnsRenamed({"copies": "n_calls", "any_results": "n_results"})
    alone = c.where(F.col("call_id").isNull()).select(
        "conv_id", "turn", "call_id", "name", "arguments", F.lit(0).cast("long").alias("level"),
        F.lit(1).cast("long").alias("n_calls"), F.lit(None).cast("string").alias("result"),
        F.lit(None).cast("long").alias("n_results"))
    every = linked.select(*out).unionByName(alone)

    known = [F.when(F.col("type") == t, F.lit(p)) for t, p in TYPES.items()]
    spec = schemas.groupBy(F.col("name").alias("tool")).agg(F.map_from_entries(F.collect_list(F.struct(
        "field", F.struct(F.coalesce(*known, F.lit("^.*$")).alias("pattern"),
                          F.coalesce(F.col("type") == "integer", F.lit(False)).alias("whole"),
                          F.coalesce("required", F.lit(False)).alias("required"))))).alias("spec"))
    value = F.try_parse_json(F.coalesce("arguments", F.lit("{}")))
    args = F.try_variant_get("value", "$", "map<string,variant>")
    errors = F.when(F.col("args").isNull(), F.array(F.lit("bad_json"))) \
        .when(F.col("spec").isNull(), F.array(F.lit("no_schema"))).otherwise(_errors(F.col("args"), F.col("spec")))
    checked = every.join(spec, every["name"] == spec["tool"], "left").withColumn("value", value) \
        .withColumn("args", args).withColumn("errors", errors) \
        .withColumn("shown", F.coalesce("value", F.expr("cast(arguments as variant)")))
    done = checked.select("conv_id", "turn", "call_id", "level", "name", (F.size("errors") == 0).alias("valid"),
                          F.array_join("errors", ",").alias("errors"), "n_calls",
                          F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"),
                          canonical(arguments="shown", call_id="call_id", level="level", name="name",
                                    result="result").alias("json"))
    gone = r.join(first, (r["result_of"] == first["first_id"]) & of(r["result_conv"], first["first_conv"]), "left") \
        .where(F.col("result_copy") > F.coalesce("all_calls", F.lit(0))).select(
        F.col("result_conv").alias("conv_id"), F.col("result_turn").alias("turn"), F.col("result_of").alias("call_id"),
        F.lit(None).cast("long").alias("level"), F.lit(None).cast("string").alias("name"), F.lit(False).alias("valid"),
        F.lit("no_call").alias("errors"), F.coalesce("all_calls", F.lit(0).cast("long")).alias("n_calls"), "n_results",
        canonical(call_id="result_of", result="result").alias("json"))
    return done.unionByName(gone)


def canonical(**columns: str) -> F.Column:
    """One JSON object: keys sorted at every depth, no white space, nulls kept, equal
    numbers spelt alike."""
    return plain_numbers(F.to_json(F.struct(*[F.col(c).alias(k) for k, c in sorted(columns.items())]),
                                   {"ignoreNullFields": "false"}))


#: digits of the longest number written without an exponent
PLAIN_DIGITS = 38


def plain_numbers(json: F.Column) -> F.Column:
    """``json`` (without white space) with every number in one spelling: no sign on
    zero, no needless zeros, no exponent while the number has at most PLAIN_DIGITS
    digits before its point or starts within six zeros behind it, else one digit
    before the point. What it means is taken from its digits, so nothing is rounded."""
    # an even number of quotes before a piece: it's outside strings. Escaped quotes and
    # backslashes are set aside; a raw control character can't be in JSON
    aside = F.replace(F.replace(json, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    pieces = F.transform(F.split(aside, '"'), lambda p, i: F.when((i % 2 == 0) & p.rlike("[0-9]"), F.array_join(
        F.transform(F.regexp_extract_all(p, F.lit("-?[0-9][0-9.eE+-]*|[^-0-9]+"), F.lit(0)), _number), "")).otherwise(p))
    return F.replace(F.replace(F.array_join(pieces, '"'), F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


def _number(token: F.Column) -> F.Column:
    """A number token in its one spelling; another token as it is."""
    mantissa = F.regexp_extract(token, "^-?([0-9.]+)", 1)
    fraction = F.regexp_extract(mantissa, "[.]([0-9]*)$", 1)
    power = F.coalesce(F.regexp_extract(token, "[eE]([+-]?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    parts = F.struct(F.ltrim(F.replace(mantissa, F.lit(".")), F.lit("0")).alias("d"), (power - F.length(fraction)).alias("e"),
                     F.when(token.startswith("-"), "-").otherwise("").alias("sign"))
    # digits without zeros at either end, and how many stand before the point
    parts = F.transform(F.array(parts), lambda x: F.struct(
        F.rtrim(x["d"], F.lit("0")).alias("d"), (x["e"] + F.length(x["d"])).alias("n"), x["sign"].alias("sign")))
    some = lambda d, a, k: F.substring(d, a, k)

    def spell(x):
        d, n = x["d"], x["n"]
        size = F.length(d)
        rest = F.when(size > 1, F.concat(F.lit("."), some(d, F.lit(2), size))).otherwise("")
        return F.when(size == 0, "0").otherwise(F.concat(x["sign"], F.when(
            (n >= size) & (n <= PLAIN_DIGITS), F.concat(d, F.repeat(F.lit("0"), n - size)))
            .when((n > 0) & (n < size), F.concat(some(d, F.lit(1), n), F.lit("."), some(d, n + 1, size)))
            .when((n <= 0) & (n > -6), F.concat(F.lit("0."), F.repeat(F.lit("0"), -n), d))
            .otherwise(F.concat(some(d, F.lit(1), F.lit(1)), rest, F.lit("e"), F.when(n > 0, "+").otherwise(""),
                                (n - 1).cast("string")))))

    return F.when(token.rlike("^-?[0-9]"), F.transform(parts, spell)[0]).otherwise(token)


# the given conversations hold no tool calls: every user turn is read as a call
# that the next assistant turn answers, and that follows the user turn before
SCHEMAS = [("ask", "query", "string", True), ("ask", "n_chars", "integer", True),
           ("report", "query", "string", True), ("report", "n_chars", "integer", True),
           ("report", "max_words", "integer", True)]
LONG = 200


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    key = lambda shift: F.concat_ws(":", F.col("conv_id").cast("string"),
                                    (F.col("turn") - shift).cast("string"))
    n = F.length(F.coalesce("text", F.lit("")))
    args = F.to_json(F.struct(F.col("text").alias("query"), n.alias("n_chars"),
                              F.when(n % 2 == 0, F.lit(100)).alias("max_words")))
    plain = F.to_json(F.struct(F.col("text").alias("query"), n.alias("n_chars")))
    calls = conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", key(0).alias("call_id"), key(2).alias("parent_id"),
        F.when(n < LONG, "ask").otherwise("report").alias("name"),
        F.when(n < LONG, plain).otherwise(args).alias("arguments"))
    results = conversations.where(F.col("role") == "assistant").select(
        "conv_id", key(1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


ORACLE = """
WITH RECURSIVE c AS (SELECT conv_id, turn, concat_ws(':', conv_id, turn) AS call_id, text, length(text) AS n FROM conversations
  WHERE role = 'user'),
r AS (SELECT turn, concat_ws(':', conv_id, turn - 1) AS call_id, conv_id, text AS content FROM conversations
  WHERE role = 'assistant'),
lv AS (SELECT conv_id, turn, 0 AS level FROM c WHERE NOT EXISTS
         (SELECT 1 FROM c p WHERE p.conv_id IS NOT DISTINCT FROM c.conv_id
         AND p.turn = c.turn - 2)
       UNION ALL SELECT c.conv_id, c.turn, lv.level + 1 FROM lv JOIN c ON c.conv_id IS NOT DISTINCT FROM lv.conv_id
         AND c.turn = lv.turn + 2)
SELECT c.conv_id, c.turn, c.call_id, CAST(lv.level AS BIGINT) AS level,
  CASE WHEN n < 200 THEN 'ask' ELSE 'report' END AS name, n < 200 OR n % 2 = 0 AS valid,
  CASE WHEN n < 200 OR n % 2 = 0 THEN '' ELSE 'missing:max_words' END AS errors, CAST(1 AS BIGINT) AS n_calls,
  CASE WHEN r.call_id IS NULL THEN CAST(0 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS n_results,
  '{"arguments":{' || CASE WHEN n >= 200 AND n % 2 = 0 THEN '"max_words":100,' ELSE '' END || '"n_chars":' || n ||
  ',"query":' || CAST(to_json(text) AS VARCHAR) || '},"call_id":"' || c.call_id || '","level":' || lv.level || ',"name":"' ||
  CASE WHEN n < 200 THEN 'ask' ELSE 'report' END || '","result":' ||
  CASE WHEN r.content IS NULL THEN 'null' ELSE CAST(to_json(r.content) AS VARCHAR) END || '}' AS json
FROM c JOIN lv ON c.conv_id IS NOT DISTINCT FROM lv.conv_id AND c.turn = lv.turn LEFT JOIN r USING (call_id)
UNION ALL
SELECT r.conv_id, r.turn, r.call_id, NULL, NULL, FALSE, 'no_call', 0, 1,
  '{"call_id":"' || r.call_id || '","result":' || coalesce(CAST(to_json(r.content) AS VARCHAR), 'null') || '}'
FROM r WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.call_id = r.call_id)
"""
