"""Mixing sources to target weights (operator 12): a low-discrepancy schedule.

1. ``targets``: the words each source gives. The weights share ``share`` times all
   words; a source gives at most ``most`` times its own, and what is above is
   shared again by weight. In closed form: the sources are ordered by the level
   at which they are full, and the level that uses up the rest is found by
   running sums.
2. ``schedule``: slot n of the mix is the point n * golden ratio of the unit
   interval, on which every source has a piece as long as its share of the
   slots. The slots of a source are ranked. A source that has a slot or two too
   many gives none for the last of them; one that has too few gets them behind
   the schedule's end (the points' discrepancy is logarithmic), so every source
   has exactly its slots.
3. ``mix``: the documents of a source, shuffled by a hash, form one stream of
   words that is cut into blocks of ``block_words``; the slot of rank r takes
   block r, a second pass over the stream begins after its last block, and the
   last slot is cut where the target is reached.

Nothing is gathered: sums before a row come from the parts of a range sort
(``running``), points meet sources by an equi-join on pieces of the unit
interval, slots meet documents by (source, block). DataFrame functions only.

Defined cases: a null text has no words; documents without words are returned
with ``taken`` 0 and never scheduled; a null source is a source of its own, the
last one; a null ``doc_id`` is kept; repeated rows are documents of their own;
rows equal in id and text are interchangeable, so the result doesn't depend on
their order; a very long document spans many blocks; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cosecha.llm.common import prepare, store

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BLOCK_WORDS = 4096
WORD = r"[^\x20\x09-\x0D]+"
#: the points lie on a grid of 2^31; the step is the grid over the golden ratio, odd
GRID, STEP = 1 << 31, 1327217885
#: points and sources meet in pieces of the unit interval of this many grid points
PIECE = 1 << 15
#: slots ranked in one task
CHUNK_SLOTS = 1 << 16


def running(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, str], name: str) -> DataFrame:
    """``rows`` with columns out -> sum of a column over the rows before, by
    ``order``, among equal ``keys`` (not null). Summed inside the parts of a range
    sort, then over the parts, so no task holds all rows of a key."""
    parts = store(rows.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), name)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    here, ahead = before(Window.partitionBy("__part", *keys).orderBy(*order)), before(
        Window.partitionBy(*keys).orderBy("__part"))
    totals = parts.groupBy("__part", *keys).agg(*[F.sum(c).alias(o) for o, c in sums.items()])
    totals = totals.select("__part", *keys, *[F.sum(o).over(ahead).alias(f"__{o}") for o in sums])
    zero = {o: F.lit(0).cast(rows.schema[c].dataType) for o, c in sums.items()}
    inside = parts.withColumns({o: F.coalesce(F.sum(c).over(here), zero[o]) for o, c in sums.items()})
    return inside.join(totals, ["__part", *keys]).withColumns(
        {o: F.col(o) + F.coalesce(f"__{o}", zero[o]) for o in sums}).drop("__part", *[f"__{o}" for o in sums])


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source (its name behind an ``s``, a null one ``t``: in order, and
    never null), size, key (the place in the shuffle), row. Stored."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t"))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text))
    return store(docs.select(F.col(id_col).alias("doc_id"), name.alias("source"),
                             F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key"),
                             F.monotonically_increasing_id().alias("row")), "sizes")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: the words each source gives. ``most`` must be
    above ``share``."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = running(sums.withColumn("one", F.lit(1).cast("long")), [], ["source"], {"nth": "one"}, "sources")
    by_name = F.array(*[F.lit(float(w)) for w in weights])
    named = named.select("source", "source_size", F.element_at(by_name, (F.col("nth") % len(weights) + 1).cast("int"))
                         .alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("full"))
    levelled = store(running(named.withColumn("level", F.col("full") / F.col("weight")), [], ["level", "source"],
                             {"given": "full", "used": "weight"}, "sources"), "sources")
    every = levelled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")) \
        .select(F.struct("words", "weights").alias("e")).scalar()
    # the level grows while sources are full below it, and shrinks from then on
    level = levelled.agg(F.max((every["words"] * F.lit(float(share)) - F.col("given")) / (every["weights"] - F.col("used")))
                         .alias("level")).scalar()
    return store(levelled.select("source", "source_size", F.least("full", F.col("weight") * level).alias("target")),
                 "targets")


def _quotas(goals: DataFrame, block_words: int) -> DataFrame:
    """goals with words (the rounded target), blocks of the source, slots."""
    div = lambda a, b: F.expr(f"({a}) div ({b})")
    g = goals.where(F.col("source_size") > 0).withColumn("words", F.round("target").cast("long"))
    return g.withColumn("blocks", div(f"source_size + {block_words - 1}", block_words)).withColumn(
        "slots", div("words", "source_size") * F.col("blocks") + div(f"words % source_size + {block_words - 1}", block_words))


def schedule(goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """position, source, rank: the slots of the mix in their order (positions
    have gaps). ``goals``: what ``targets`` gives."""
    spark = goals.sparkSession
    sources = store(running(_quotas(goals, block_words), [], ["source"], {"below": "slots"}, "sources"), "sources")
    n = sources.agg(F.sum("slots")).first()[0] or 0
    edge = lambda c: F.floor(c / F.lit(float(max(n, 1))) * F.lit(float(GRID)))
    held = sources.select("source", "slots", edge(F.col("below")).alias("lo"),
                          edge(F.col("below") + F.col("slots")).alias("hi")).where(F.col("hi") > F.col("lo"))
    spans = held.select("source", "slots", "lo", "hi", F.explode(F.sequence(
        F.expr(f"lo div {PIECE}"), F.expr(f"(hi - 1) div {PIECE}"))).alias("piece"))
    points = spark.range(n).select(F.col("id").alias("position"), (F.col("id") % GRID * STEP % GRID).alias("x")) \
        .withColumn("at", F.expr(f"x div {PIECE}"))
    inside = (points["at"] == spans["piece"]) & (points["x"] >= spans["lo"]) & (points["x"] < spans["hi"])
    dealt = points.join(spans, inside).select("position", "source", "slots", F.expr(f"position div {CHUNK_SLOTS}").alias("chunk"))
    dealt = store(dealt, "slots")
    counts = dealt.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("source", "chunk", F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long")).alias("before"))
    here = Window.partitionBy("source", "chunk").orderBy("position")
    ranked = dealt.withColumn("nth", F.row_number().over(here) - 1).join(counts, ["source", "chunk"]) \
        .withColumn("rank", F.col("before") + F.col("nth")).where(F.col("rank") < F.col("slots"))
    have = dealt.groupBy("source").agg(F.count("*").alias("have"))
    short = sources.select("source", "slots").join(have, "source", "left") \
        .withColumn("have", F.coalesce("have", F.lit(0).cast("long"))).where(F.col("have") < F.col("slots")) \
        .withColumn("lack", F.col("slots") - F.col("have"))
    short = running(short, [], ["source"], {"behind": "lack"}, "short").select(
        "source", "behind", "have", F.explode(F.sequence(F.col("have"), F.col("slots") - 1)).alias("rank"))
    return ranked.select("position", "source", "rank").unionByName(short.select(
        (F.lit(n) + F.col("behind") + F.col("rank") - F.col("have")).alias("position"), "source", "rank"))


def mix(sizes: DataFrame, goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """position, source, doc_id, row, first, words: slot ``position`` holds
    ``words`` words of the document from its word ``first`` (from 0) on."""
    sources = _quotas(goals, block_words).select("source", "source_size", F.col("words").alias("goal"), "blocks")
    slots = schedule(goals, block_words).join(sources, "source") \
        .withColumn("block", F.col("rank") % F.col("blocks")).withColumn("at", F.col("block") * block_words) \
        .withColumn("taken_before", F.expr("rank div blocks") * F.col("source_size") + F.col("at")) \
        .withColumn("upto", F.least(F.lit(block_words).cast("long"), F.col("source_size") - F.col("at"),
                                    F.col("goal") - F.col("taken_before"))) \
        .select("position", "source", "block", "upto")
    stream = running(sizes.where(F.col("size") > 0), ["source"], ["key", "doc_id", "row"], {"start": "size"}, "stream")
    pieces = stream.select("source", "doc_id", "row", "size", "start", F.explode(F.sequence(
        F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("block"))
    low, high = F.col("start") - F.col("block") * block_words, F.col("start") + F.col("size") - F.col("block") * block_words
    pieces = pieces.select("source", "block", "doc_id", "row", F.greatest(low, F.lit(0).cast("long")).alias("lo"),
                           high.alias("hi"), F.greatest(-low, F.lit(0).cast("long")).alias("first"))
    return slots.join(pieces, ["source", "block"]).where(F.col("lo") < F.col("upto")).select(
        "position", "source", "doc_id", "row", "first", (F.least("hi", "upto") - F.col("lo")).alias("words"))


def passage(text: Column, first: Column, words: Column) -> Column:
    """The text of a row of the mix: ``words`` words of ``text`` from ``first`` on."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), (first + 1).cast("int"),
                                words.cast("int")), " ")


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, weights: tuple = WEIGHTS, share: float = SHARE,
                  most: int = MOST, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    prepare(docs.sparkSession)
    sizes = sized(docs, id_col, text_col, source_col)
    goals = targets(sizes, weights, share, most)
    taken = mix(sizes, goals, block_words).groupBy("row").agg(F.sum("words").alias("taken"))
    return sizes.join(goals, "source").join(taken, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 't') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key FROM documents),
w AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([3, 1, 2][(row_number() OVER (ORDER BY source) - 1) % 3 + 1] AS DOUBLE) AS weight FROM d GROUP BY source),
levels AS (
  SELECT (sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - (sum(2 * source_size) OVER upto - 2 * source_size)) /
    (sum(weight) OVER () - (sum(weight) OVER upto - weight)) AS level FROM w
  WINDOW upto AS (ORDER BY 2 * source_size / weight, source ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * (SELECT max(level) FROM levels)) AS target
  FROM w),
p AS (
  SELECT d.*, source_size, target, CAST(round(target) AS BIGINT) AS goal,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d JOIN t USING (source))
SELECT doc_id, size, source_size, target, CAST(greatest(least(start + size, goal) - start, 0) +
  greatest(least(start + size, goal - source_size) - start, 0) AS BIGINT) AS taken FROM p
"""
