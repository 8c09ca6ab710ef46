"""Token-ID / binary output (operator 10): Re-Pair grammar compression.

Per block, repeated pairs of neighbouring ids are replaced by nonterminals, round
after round, until no pair occurs twice. A round replaces all repeated pairs that
are more frequent than the pairs they overlap. The rules and the length of every
expansion are stored, so any document (or a part of one) is decoded from the rules
below its symbols, without the rest.

File format: a Parquet table, one row per block of whole documents, in
ascending ``doc_id`` order over (``part``, ``block``):

    part, block      place of the block
    n_ids            token ids in the block
    base             ids from here on are rules: base + i is rule i
    doc_ids          the documents
    doc_ids_n        token ids of each document, with the end id
    doc_symbols      symbols of each document (rules never cross documents)
    rule_left, rule_right, rule_len
                     rule i expands to left then right, rule_len[i] ids in all
    symbols          the sequence, little-endian unsigned 32-bit integers

Written by Spark's file writer (a lost or repeated task leaves no half file).

Defined cases: null text is empty; an empty document is its end id alone; a
null ``doc_id`` comes first; repeated rows and equal ids are kept, in the order
of their text hash; an empty table gives an empty file and no rows; other
columns are ignored. A block holds whole documents: about ``block_ids`` ids, or
one longer document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cosecha.llm.common import batches, prepare
from cosecha.llm.tokens import encoder, public_path
from cosecha.session import scratch_path

END_ID = 2
BLOCK_IDS = 1 << 20

FORMAT = ("part int, block int, n_ids long, base long, doc_ids array<bigint>, doc_ids_n array<bigint>, "
          "doc_symbols array<bigint>, rule_left array<bigint>, rule_right array<bigint>, rule_len array<bigint>, "
          "symbols binary")
_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("base", pa.int64()),
                    *[(c, pa.list_(pa.int64())) for c in ("doc_ids", "doc_ids_n", "doc_symbols", "rule_left",
                                                         "rule_right", "rule_len")], ("symbols", pa.binary())])


def _overlapping(after: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the pairs of equal ids at ``at`` (ascending) are every second one of a
    run: in x x x x the pairs at 0 and 2 can be replaced, those at 1 and 3 can't."""
    begins = np.append(True, after[at[:-1]] != at[1:])
    return (np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]) % 2 == 1


def _by_pair(a: np.ndarray, b: np.ndarray, look: np.ndarray, skip: np.ndarray, symbol_bits: int, place_bits: int):
    """The pairs (a, b) at ``look``, without those at the indexes ``skip``, as one code
    each, in order of the code; and their places. Code and place are sorted as one
    integer where they fit."""
    if 2 * symbol_bits + place_bits < 63:
        code = a.astype(np.int64)
        code <<= symbol_bits
        code |= b
        code <<= place_bits
        code |= look
        if len(skip):
            code = np.delete(code, skip)
        code.sort()
        return code >> place_bits, code & ((1 << place_bits) - 1)
    code, at = np.delete((a.astype(np.int64) << 32) | b, skip), np.delete(look, skip)
    order = np.argsort(code)  # equal ones in any order
    return code[order], at[order]


def _ranks(count: np.ndarray) -> np.ndarray:
    """0 for the largest count, then 1, ...; of equal counts the first goes first."""
    bits = len(count).bit_length()
    order = ((count.max() - count) << bits) | np.arange(len(count))
    order.sort()
    ranks = np.empty(len(count), np.int32 if len(count) < 1 << 31 else np.int64)
    ranks[order & ((1 << bits) - 1)] = np.arange(len(count))
    return ranks


def compress(ids: np.ndarray, ends: np.ndarray):
    """``grammar`` with lists of its rules."""
    sym, per_doc, base, *rules = grammar(ids, ends)
    return sym, per_doc, base, *[r.tolist() for r in rules]


def grammar(ids: np.ndarray, ends: np.ndarray):
    """Re-Pair over one block, until no pair occurs twice (without overlap, inside
    documents). ``ends``: positions after each document's last id. Returns
    (symbols, symbols per document, base, left, right, length).

    The symbols form a linked list. A pair that occurs once never occurs again (a
    new pair holds a new symbol), so a round looks at the pairs that were repeated
    and at those beside a replaced one only."""
    n = len(ids)
    base = int(ids.max()) + 1 if n else 0
    # half as wide where all symbols fit: a round's time is reading and writing these
    small = np.int32 if base + n < 1 << 31 else np.int64
    seq = np.append(ids.astype(small), small(-1))
    left, right, length, rules = [], [], np.zeros(0, np.int64), 0
    # neighbours inside the document; n stands for none
    after, before = np.arange(1, n + 2, dtype=small), np.arange(-1, n, dtype=small)
    stops = np.unique(ends[ends > 0]) if n else np.zeros(0, np.int64)
    after[stops - 1] = n
    before[np.append(0, stops[:-1])] = n
    lives = np.ones(n + 1, bool)
    lives[n] = False
    none = n + 1  # a rank behind all others
    rank = np.full(n + 1, none, small)
    look = np.flatnonzero(after[:n] < n)
    while len(look) > 1:
        a, b = seq.take(look), seq.take(after.take(look))
        equal = np.flatnonzero(a == b)
        odd = equal[_overlapping(after, look.take(equal))] if len(equal) else equal
        late = look.take(odd)
        code, at = _by_pair(a, b, look, odd, (base + rules).bit_length(), n.bit_length())
        again = np.zeros(len(code) + 1, bool)  # whether the same pair as the one before
        np.equal(code[1:], code[:-1], out=again[1:-1])
        often = np.flatnonzero(again[1:] | again[:-1])
        if not len(often):
            break
        count = np.diff(np.flatnonzero(~again.take(often)), append=len(often))
        # the most frequent pair has rank 0; of two that overlap the better one goes first
        at = at.take(often)
        rank[at] = np.repeat(_ranks(count), count)
        look = np.sort(at) if len(at) < n >> 5 else np.flatnonzero(rank[:n] < none)
        mine = rank.take(look)
        best = np.flatnonzero(mine < rank.take(after.take(look)))
        best = best[mine.take(best) < rank.take(before.take(look.take(best)))]
        at, used = look.take(best), mine.take(best)
        rank[look] = none
        # a pair whose other places were taken waits; rank 0 has all of its places
        twice = np.bincount(used, minlength=len(count)) >= 2
        number = np.cumsum(twice) - 1
        stays = np.flatnonzero(twice.take(used))
        at, new = at.take(stays), number.take(used.take(stays))
        firsts = np.empty(int(number[-1]) + 1, np.int64)
        firsts[new] = at
        l_sym, r_sym = seq[firsts], seq[after[firsts]]
        size = lambda s: np.where(s >= base, length[np.maximum(s - base, 0)] if len(length) else 1, 1)  # noqa: E731, B023
        gone = after.take(at)
        seq[at] = base + rules + new
        left.append(l_sym)
        right.append(r_sym)
        length = np.append(length, size(l_sym) + size(r_sym))
        rules += len(firsts)
        lives[gone] = False
        after[at] = after.take(gone)
        before[after.take(at)] = at  # at n too, which is never read as a place
        before[n] = n
        places = (look, late, at, before.take(at))
        if sum(map(len, places)) < n >> 5:
            look = np.unique(np.concatenate(places))
            look = look[lives.take(look) & (after.take(look) < n)]
        else:
            mark = np.zeros(n + 1, bool)
            for some in places:
                mark[some] = True
            mark &= lives
            mark &= after < n
            look = np.flatnonzero(mark)
    symbols = np.flatnonzero(lives)
    per_doc = np.diff(np.searchsorted(symbols, ends), prepend=0) if len(ends) else np.zeros(0, np.int64)
    left, right = (np.concatenate([length[:0], *x]) for x in (left, right))
    return seq[symbols].astype("<u4"), per_doc, base, left, right, length


def expand(symbols: np.ndarray, base: int, left, right, length) -> np.ndarray:
    """The ids that ``symbols`` stand for. All rules of one depth are replaced at once;
    the lengths say where their two halves go."""
    left, right = (np.asarray(x, np.int64) for x in (left, right))
    sizes = np.append(1, np.asarray(length, np.int64))  # 0 stands for an id, i + 1 for rule i
    s = symbols.astype(np.int64)
    rule = np.maximum(s - (base - 1), 0)
    n = sizes.take(rule)
    at = np.cumsum(n) - n
    ids = np.empty(int(n.sum()), "<u4")
    while len(s):
        plain, deep = np.flatnonzero(rule == 0), np.flatnonzero(rule)
        ids[at.take(plain)] = s.take(plain)
        rule, at = rule.take(deep) - 1, at.take(deep)
        one, two = left.take(rule), right.take(rule)
        s, first = np.concatenate([one, two]), np.maximum(one - (base - 1), 0)
        at = np.concatenate([at, at + sizes.take(first)])
        rule = np.concatenate([first, np.maximum(two - (base - 1), 0)])
    return ids


def decode_range(row, doc: int, start: int = 0, stop: int | None = None, visit=None) -> np.ndarray:
    """Ids ``start:stop`` of the ``doc``-th document of a block. The stored lengths
    say which symbols, and which rules below them, cover the range; no others are
    looked at (``visit`` is told each rule that is)."""
    s0 = int(sum(row["doc_symbols"][:doc]))
    syms = np.frombuffer(row["symbols"], "<u4")[s0:s0 + row["doc_symbols"][doc]].astype(np.int64)
    n = row["doc_ids_n"][doc]
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, "<u4")
    base, left, right, length = row["base"], row["rule_left"], row["rule_right"], row["rule_len"]
    size = lambda s: length[s - base] if s >= base else 1
    after = np.cumsum([size(s) for s in syms.tolist()])
    i, j = np.searchsorted(after, start, "right"), np.searchsorted(after, stop, "left") + 1
    at = int(after[i - 1]) if i else 0
    out, stack = [], syms[i:j][::-1].tolist()
    while stack and at < stop:
        s = stack.pop()
        if at + size(s) <= start:
            at += size(s)
        elif s < base:
            out.append(s)
            at += 1
        else:
            if visit:
                visit(s - base)
            stack += (right[s - base], left[s - base])
    return np.array(out, "<u4")


def _joined(it, size: int = 8 << 20):
    """Arrow batches, small ones joined to about ``size`` bytes."""
    held = []
    for b in it:
        held.append(b)
        if sum(h.nbytes for h in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
              block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode all documents and write them to ``path`` in the file format."""
    prepare(docs.sparkSession)
    tok = tokenizer or public_path("byte_bpe_50k.json")

    def encode(it):
        enc = encoder(tok)
        part, block = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        names: list[int | None] = []
        size = 0

        def flush():
            ids = np.concatenate(held)
            ns = np.array(list(map(len, held)), np.int64)
            sym, per_doc, base, left, right, length = grammar(ids, np.cumsum(ns))
            row = [part, block, len(ids), base, names, ns, per_doc, left, right, length, sym.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        for b in _joined(it):
            ids, ns = enc.encode_all(b.column(1))
            ends = np.cumsum(ns)
            ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
            for doc, some in zip(b.column(0).to_pylist(), np.split(ids, ends[:-1])):
                held.append(some)
                names.append(doc)
                size += len(some)
                if size >= block_ids:
                    yield flush()
                    held, names, size, block = [], [], 0, block + 1
        if held:
            yield flush()

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    (d.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, FORMAT)
     .write.option("compression", "zstd").parquet(path))
    return path


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Decode the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32[, ids]."""
    prepare(spark)
    blocks = spark.read.schema(FORMAT).parquet(path)
    fields = [("part", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()),
              ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + \
             ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    schema = pa.schema(fields)

    def decode(it):
        for b in it:
            rules = [b.column(c) for c in ("rule_left", "rule_right", "rule_len")]
            for i, row in enumerate(b.drop_columns(["rule_left", "rule_right", "rule_len"]).to_pylist()):
                ids = expand(np.frombuffer(row["symbols"], "<u4"), row["base"],
                             *[c[i].values.to_numpy(zero_copy_only=False) for c in rules])
                ends = np.cumsum(row["doc_ids_n"])
                starts = ends - row["doc_ids_n"]
                parts = [ids[s:e] for s, e in zip(starts, ends)]
                out = {"part": [row["part"]] * len(parts), "block": [row["block"]] * len(parts),
                       "doc_id": row["doc_ids"], "before": starts.tolist(), "n_tokens": row["doc_ids_n"],
                       "ids_crc32": list(map(zlib.crc32, parts))}
                if with_ids:
                    out["ids"] = [p.astype(np.int32) for p in parts]
                yield from batches(it, out, schema)

    ddl = "part int, block int, doc_id long, before long, n_tokens long, ids_crc32 long" + \
          (", ids array<int>" if with_ids else "")
    # ids before each block: inside its part, plus all parts before (a row per
    # part meets in the one-task window, not a row per block or document)
    sizes = blocks.select("part", "block", "n_ids")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("part_start")))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("block_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
              .select("part", "block", (F.col("part_start") + F.col("block_start")).alias("at")))
    docs = blocks.select(*[c for c in blocks.columns if c != "n_ids"]).mapInArrow(decode, ddl)
    cols = ["doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"]
    return docs.join(starts, ["part", "block"]).select(*cols, *(["ids"] if with_ids else []))


def repair_round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write all documents to fresh files in the shared folder and return what
    the files hold."""
    spark = docs.sparkSession
    prepare(spark)
    path = write_ids(docs, scratch_path(spark, "token-ids"), tokenizer, end_id)
    return read_ids(spark, path, with_ids=False)
