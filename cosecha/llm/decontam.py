"""Benchmark decontamination (operator 5): a distributed positional inverted
index.

1. ``build_index``: the training texts are cut into segments of whole
   documents; each segment stores, for every token, the list of its positions (a
   document-partitioned index: a phrase never leaves its segment, so nothing is
   shuffled and a hot word or source stays spread). It knows nothing of the tests
   and is written once, whatever is asked of it.
2. ``search``: per segment the lists of a window are intersected from its
   rarest term on, each list moved by the term's place in the window. What is
   left are exact phrases; with ``slop`` also the places where every term is
   within that many words of its own (proximity matches).

The test terms go to the tasks in blocks of about ``block_words`` words of the
benchmark, whatever its size (a longer item is cut into overlapping pieces): one
pass over the stored index a block, none over the texts.

Defined cases: a null or empty text has no words and is clean; an item without
words never occurs; an item of fewer than ``window`` words is one window; equal
items are found separately; repeated rows and equal ``doc_id`` are judged one
by one; null ``doc_id`` and ``item_id`` are kept (a null ``item_id`` is left out
of the list of items); an empty table gives no rows, an empty benchmark only
clean rows; other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.llm.common import null_safe_anti, prepare, store

WINDOW = 13
#: words and gaps of one segment of the index; a position has 32 bits, so a document may
#: have up to 2^31 words
SEGMENT_WORDS = 500_000
#: benchmark words whose terms and windows one pass holds in every task
BLOCK_WORDS = 1_000_000
#: an item is searched in pieces of at most so many windows
PIECE_WORDS = 50_000
#: free positions between the documents of a segment
_GAP = 1 << 10

# a-z, 0-9 and bytes of other scripts are word characters, A-Z are lower-cased
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
              for c in range(256))

INDEX = ("segment string, doc_id array<bigint>, text_key array<bigint>, n_words array<bigint>, terms array<binary>, "
         "list_len array<bigint>, positions binary")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class _Numbers(dict):
    """token -> its number in order of appearance."""

    def __missing__(self, token: bytes) -> int:
        self[token] = n = len(self)
        return n


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored index over all tokens of all documents."""
    prepare(docs.sparkSession)
    schema = pa.schema([("segment", pa.string()), ("doc_id", pa.list_(pa.int64())), ("text_key", pa.list_(pa.int64())),
                        ("n_words", pa.list_(pa.int64())), ("terms", pa.list_(pa.binary())),
                        ("list_len", pa.list_(pa.int64())), ("positions", pa.binary())])

    def index(it):
        serial, part = count(), TaskContext.get().partitionId()
        ids, keys, sizes, found, number = [], [], [], [], _Numbers()
        at = 0

        def flush():
            base = np.cumsum([0, *(n + _GAP for n in sizes[:-1])])
            t = np.concatenate(found)
            p = np.arange(len(t)) + np.repeat(base - (np.cumsum(sizes) - sizes), sizes)
            order = np.argsort(t, kind="stable")
            row = [f"{part}-{next(serial)}", ids, keys, sizes, list(number), np.bincount(t, minlength=len(number)),
                   p[order].astype("<i4").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for b in it:
            for doc, text, key in zip(*(c.to_pylist() for c in b.columns)):
                ws = words(text)
                found.append(np.fromiter(map(number.__getitem__, ws), np.int32, len(ws)))
                ids.append(doc)
                keys.append(key)
                sizes.append(len(ws))
                at += len(ws) + _GAP
                if at >= segment_words:
                    yield flush()
                    ids, keys, sizes, found, number = [], [], [], [], _Numbers()
                    at = 0
        if ids:
            yield flush()

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                    F.xxhash64(text_col).alias("text_key"))
    return store(d.mapInArrow(index, INDEX), "postings", compression="zstd")


def intersect(lists: dict[int, np.ndarray], terms: list[int], slop: int = 0) -> tuple[np.ndarray, int]:
    """Starts of a phrase, and the place of its rarest term: the rarest list first,
    every further one (moved by its place in the phrase) thins it out. With ``slop``
    each other term may be that many words off its place, so a start may lie before
    its document's first word, but the rarest term never does."""
    order = sorted(range(len(terms)), key=lambda i: len(lists[terms[i]]))
    first = order[0]
    cur = lists[terms[first]] - first
    for i in order[1:]:
        if not len(cur):
            break
        have = lists[terms[i]]
        want = cur + i
        j = np.searchsorted(have, want - slop)
        cur = cur[(j < len(have)) & (have[np.minimum(j, len(have) - 1)] <= want + slop)]
    return cur, first


def search(index: DataFrame, items: list[tuple[int | None, str]], window: int = WINDOW, slop: int = 0) -> DataFrame:
    """segment, ord, doc_id, text_key, n_words, spans, near for every indexed
    document: ``spans`` are the occurrences of windows (item_id, start, stop),
    ``near`` the proximity matches (item_id, start) that are no exact ones."""
    if window + slop >= _GAP:
        raise ValueError(f"window + slop must be under {_GAP}")
    phrases: dict[tuple, dict] = {}
    for item, text in items:
        ws = words(text)
        for w in {tuple(ws[a:a + window]) for a in range(max(1, len(ws) - window + 1))} if ws else ():
            phrases.setdefault(w, {})[item] = None
    vocabulary = sorted({t for w in phrases for t in w})
    number = {t: i for i, t in enumerate(vocabulary)}
    shapes = [[number[t] for t in w] for w in phrases]
    owners = list(map(list, phrases.values()))
    matrix = np.array([s + [s[0]] * (window - len(s)) for s in shapes], np.int64).reshape(len(shapes), window)
    span = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))
    near_t = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64())]))
    schema = pa.schema([("segment", pa.string()), ("ord", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
                        ("n_words", pa.int64()), ("spans", span), ("near", near_t)])

    def run(it):
        import pyarrow.compute as pc
        known = pa.array(vocabulary, pa.binary())
        for b in it:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in ("segment", "doc_id", "text_key", "n_words")}
                # a segment has many terms, the tests few: matched and cut in Arrow and numpy
                mine = pc.fill_null(pc.index_in(b.column("terms").slice(r, 1).flatten(), value_set=known), -1).to_numpy()
                ends = np.cumsum(b.column("list_len").slice(r, 1).flatten().to_numpy())
                flat = np.frombuffer(b.column("positions")[r].as_buffer(), "<i4")
                at = np.flatnonzero(mine >= 0)
                starts = np.where(at > 0, ends[at - 1], 0)
                lists = {k: flat[s:e].astype(np.int64) for k, s, e in zip(mine[at].tolist(), starts.tolist(), ends[at].tolist())}
                present = np.zeros(len(vocabulary) + 1, bool)
                present[list(lists)] = True
                base = np.cumsum([0, *(n + _GAP for n in row["n_words"][:-1])])
                spans = [[] for _ in row["doc_id"]]
                near = [[] for _ in row["doc_id"]]
                for k in np.flatnonzero(present[matrix].all(axis=1)) if len(shapes) else ():
                    shape = shapes[k]
                    exact, rarest = intersect(lists, shape)
                    loose = np.setdiff1d(intersect(lists, shape, slop)[0], exact) if slop else exact[:0]
                    for starts, out in ((exact, spans), (loose, near)):
                        for d, p in zip((np.searchsorted(base, starts + rarest, "right") - 1).tolist(), starts.tolist()):
                            p -= int(base[d])
                            out[d] += [{"item_id": o, "start": p, "stop": p + len(shape)} if out is spans else
                                       {"item_id": o, "start": p} for o in owners[k]]
                n = len(spans)
                cols = [[row["segment"]] * n, list(range(n)), row["doc_id"], row["text_key"], row["n_words"], spans, near]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return index.mapInArrow(run, "segment string, ord long, doc_id long, text_key long, n_words long, "
                                 "spans array<struct<item_id:bigint,start:bigint,stop:bigint>>, "
                                 "near array<struct<item_id:bigint,start:bigint>>")


def covered(spans) -> F.Column:
    """Words inside any of the spans, each counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("stop"))
    return F.aggregate(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))), zero,
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["stop"])))
                                .alias("n"), F.greatest(acc["stop"], s["stop"]).alias("stop")), lambda acc: acc["n"])


def pieces(benchmark: DataFrame, window: int, piece_words: int) -> DataFrame:
    """item_id, text, n: the words of every item that has some, space-joined, in
    pieces of at most ``piece_words`` windows that overlap by a window less a word."""
    low = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ws = F.regexp_extract_all(low, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), ws.alias("ws")).where(F.size("ws") > 0)
    cut = items.withColumn("a", F.explode(F.sequence(F.lit(0), F.greatest(F.size("ws") - window, F.lit(0)), F.lit(piece_words))))
    cut = cut.select("item_id", F.slice("ws", F.col("a") + 1, F.lit(piece_words + window - 1)).alias("ws"))
    return cut.select("item_id", F.array_join("ws", " ").alias("text"), F.size("ws").alias("n"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0,
                  block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, text_key (hash of the text), n_words,
    n_hit, items (ids with occurring windows, sorted as strings), spans, near,
    contaminated (a twentieth of its words or more are hit)."""
    prepare(docs.sparkSession)
    items = store(pieces(benchmark, window, min(PIECE_WORDS, block_words)), "items")
    size = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(size / block_words))
    index = build_index(docs, id_col, text_col)
    found = None
    for k in range(blocks):
        # to the driver: a block's words at a time
        block = [(r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]
        hits = search(index, block, window, slop)
        found = hits if found is None else found.union(hits)
    if blocks > 1:
        # a segment is the same documents in every block
        found = found.groupBy("segment", "ord").agg(
            *[F.first(c).alias(c) for c in ("doc_id", "text_key", "n_words")],
            *[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "near")])
    ids = F.filter(F.array_distinct(F.transform("spans", lambda s: s["item_id"])), lambda x: x.isNotNull())
    return (found.select("doc_id", "text_key", "n_words", covered(F.col("spans")).alias("n_hit"),
                         F.array_sort(F.transform(ids, lambda x: x.cast("string"))).alias("items"), "spans", "near")
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    found = decontaminate(docs, benchmark, id_col=id_col, text_col=text_col)
    bad = found.where("contaminated").select("doc_id", "text_key").distinct()
    keyed = docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__key", F.xxhash64(text_col))
    bad = bad.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    return null_safe_anti(keyed, bad, ["__id", "__key"]).select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH fold AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
shape AS (SELECT item_id, w, least(13, len(w)) AS k FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
        FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM shape)),
sizes AS (SELECT DISTINCT k FROM win),
place AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
          FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM fold, sizes WHERE len(w) >= k)),
hit AS (SELECT place.r, place.i, place.k, win.item_id FROM place JOIN win ON place.k = win.k AND place.t = win.t),
word AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS l
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.l, '')) AS items_sha256,
       coalesce(word.n, 0) > 0 AND 20 * coalesce(word.n, 0) >= len(w) AS contaminated
FROM fold LEFT JOIN word USING (r) LEFT JOIN its USING (r)
"""
