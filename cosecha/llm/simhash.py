"""SimHash near-duplicates (operator 3): multi-index hashing.

1. ``fingerprints``: a 64-bit SimHash of each whole text over word shingles,
   hashed with XXH64.
2. Equal fingerprints are one class (pre-aggregated before anything is
   compared), so a group of copies of any size is one row.
3. ``links``: each fingerprint is cut into ``segments``. Two fingerprints
   within ``max_bits`` agree up to ``max_bits // segments`` bits in at least one
   segment, so the small Hamming ball around each segment is enumerated and
   looked up in the table of segments; complete distances are verified in the
   join itself, only links leave it. The joins are shuffled joins whose hot
   buckets the planner can split.
4. ``components``: smallest reachable ``doc_id`` over the links, by
   alternating large-star and small-star steps on written tables; nothing is
   collected.

Defined cases: a null or empty text, and one without words, has fingerprint
zero and links like any other; fewer words than a shingle: the whole sequence
is one shingle; equal and repeated rows share a fingerprint; rows with a null
``doc_id`` are kept and take part, and a component without any ``doc_id`` has a
null ``component_id``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.llm.common import batches, prepare, store

SHINGLE = 4
MAX_BITS = 4
#: three segments: balls of radius 1 in segments of 21 or 22 bits
SEGMENTS = 3
_BLOCK = 1 << 15


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """The fingerprint of one text (unsigned)."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    k = min(shingle, len(words))
    spans = list(zip(start[:len(words) - k + 1].tolist(), end[k - 1:].tolist()))
    ones = np.zeros(64, np.int64)
    for a in range(0, len(spans), _BLOCK):
        h = np.array([xxh64_intdigest(line[s:e], seed) for s, e in spans[a:a + _BLOCK]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                 with_key: bool = False) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)[, key (hash of the text)]."""
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())] + ([("key", pa.int64())] if with_key else []))

    def run(it):
        for b in it:
            fp = np.array([simhash(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], schema=schema)

    key = [F.xxhash64(text_col).alias("key")] if with_key else []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *key) \
        .mapInArrow(run, "doc_id long, fp long" + (", key long" if with_key else ""))


def segment_masks(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """(shift, width) of each segment of a 64-bit fingerprint."""
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """a, b (a < b as signed longs): every pair of the distinct fingerprints
    ``fps.fp`` that differ in at most ``max_bits`` bits, each pair once."""
    from itertools import combinations
    radius = max_bits // segments
    parts = segment_masks(segments)
    seg = lambda c, s: F.shiftrightunsigned(c, parts[s][0]).bitwiseAND(F.lit((1 << parts[s][1]) - 1))
    table = fps.select(F.col("fp").alias("b"),
                       F.explode(F.array(*[F.struct(F.lit(s).alias("s"), seg(F.col("fp"), s).alias("k"))
                                           for s in range(segments)])).alias("e")).select("b", "e.s", "e.k")
    # masks over the segment's bits: the ball of the radius around it
    ball = [(s, sum(1 << i for i in bits)) for s, (_, w) in enumerate(parts) for r in range(radius + 1)
            for bits in combinations(range(w), r)]
    probe = fps.select(F.col("fp").alias("a"), F.explode(F.array(*[
        F.struct(F.lit(s).alias("s"), seg(F.col("fp"), s).bitwiseXOR(F.lit(m)).alias("k")) for s, m in ball])).alias("e")
    ).select("a", "e.s", "e.k")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    cond = (F.col("a") < F.col("b")) & (F.bit_count(diff) <= max_bits)
    for s, (shift, width) in enumerate(parts[:-1]):  # a pair counts in the first segment that finds it
        near = F.bit_count(diff.bitwiseAND(F.lit(_signed(((1 << width) - 1) << shift)))) <= radius
        cond &= (F.col("t.s") <= s) | ~near
    return (probe.alias("p").join(table.alias("t"), (F.col("p.s") == F.col("t.s")) & (F.col("p.k") == F.col("t.k")) & cond)
            .select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of ``edges`` (a, b) can
    reach, by alternating large-star and small-star steps. Every step is a
    written table; the driver sees one checksum row a round."""
    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.union(e.select("b", "a"))
        # small: only from the larger end; large: from both ends, to larger neighbours
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        j = both.join(low, both["a"] == low["n"])
        if small:
            out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                low.select(F.col("n").alias("a"), F.col("m").alias("b")))
        else:
            out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    now = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = mark(now)
    while seen[0]:
        now = store(star(store(star(now, False), "edges"), True), "edges")
        last, seen = seen, mark(now)
        if last == seen:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _linked(f: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """fp, rep (smallest doc_id), root (of the component): a row per fingerprint."""
    reps = store(f.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    roots = store(components(links(reps, max_bits, segments)), "roots")
    named = reps.join(roots, reps["fp"] == roots["node"], "left") \
        .select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    return store(named, "linked")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: a row per document."""
    f = store(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    linked = _linked(f, max_bits, segments)
    least = store(linked.groupBy("root").agg(F.min("rep").alias("component_id")), "least")
    classes = store(linked.join(least, "root").select(F.col("fp").alias("class"), "component_id"), "classes")
    return f.join(classes, f["fp"] == classes["class"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest ``doc_id``
    (nulls last), then text hash, then hash of all its columns. Components are of ids
    and texts; rows equal in both are one document."""
    f = store(fingerprints(docs, id_col=id_col, text_col=text_col, with_key=True), "fingerprints")
    roots = _linked(f).select(F.col("fp").alias("class"), "root")
    named = f.join(roots, f["fp"] == roots["class"]).select("root", F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "key").alias("row"))
    first = named.groupBy("root").agg(F.min("row").alias("first")).withColumnRenamed("root", "of")
    gone = named.join(first, named["root"] == first["of"]).where(F.col("row") != F.col("first")) \
        .select(F.col("row.doc_id").alias("__gone"), F.col("row.key").alias("__gone_key")).distinct()
    keyed = docs.withColumn("__key", F.xxhash64(text_col))
    same = (F.col("__key") == gone["__gone_key"]) & F.col(id_col).cast("long").eqNullSafe(gone["__gone"])
    kept = keyed.join(gone, same, "left_anti")
    row = F.struct(*docs.columns)
    return kept.groupBy(id_col, "__key").agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("__row")).select("__row.*")
