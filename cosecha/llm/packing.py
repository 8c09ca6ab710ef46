"""Packing (operator 1): first-fit decreasing with a tournament tree of bin
capacities, run independently in randomised groups of documents.

1. ``token_pieces``: every document becomes its token ids plus an end id, cut
   every ``capacity`` ids. One pass, no shuffle.
2. ``pack``: a piece of ``capacity`` ids is a sequence of its own, so a document
   has at most one piece to pack, its last. These are stored, counted and dealt at
   random into groups of about ``group_pieces`` documents; each group is packed by
   first-fit decreasing. A group's size does not depend on any key or length, so a
   hot key, a hot source or a long document cannot swell one; padding is a part of a
   bin per group.

Defined cases: a null text is empty; an empty document is its end id alone;
a very long text becomes many pieces, of which the full ones are sequences of
their own; equal documents and repeated rows are packed one by one; a null
``doc_id`` is kept; an empty table gives no rows; ties in length are broken by
``doc_id`` and ``start``; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.llm.common import batches, prepare, store
from cosecha.llm.tokens import encoder, public_path

END_ID = 2
CAPACITY = 4096
#: pieces of one group: what one task packs at once
GROUP_PIECES = 4096


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens[, ids]: the pieces of every
    document. ``ids`` are the piece's token ids (left out when only the
    placement is wanted)."""
    prepare(docs.sparkSession)
    path = tokenizer or public_path("word_bpe_49k.json")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    schema = pa.schema(fields)
    end = end_id.to_bytes(4, "little")
    width = 4 * capacity

    def cut(it):
        import numpy as np
        enc = encoder(path)
        for b in it:
            out = {f: [] for f, _ in fields}
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.encode(text) + end
                for a in range(0, len(ids), width):
                    piece = ids[a:a + width]
                    out["doc_id"].append(doc)
                    out["start"].append(a // 4)
                    out["length"].append(len(piece) // 4)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    out["doc_tokens"].append(len(ids) // 4)
                    if with_ids:
                        out["ids"].append(np.frombuffer(piece, "<i4"))
            yield from batches(it, out, schema)

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + \
          (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, ddl)


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of every item, given in decreasing length. A tournament
    tree over the bins holds the largest free space below each node, so the
    first bin that fits is found in a walk from the root."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    free = [capacity] * (2 * leaves)
    placed = []
    for n in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < n:
                node += 1
        placed.append((node - leaves, capacity - free[node]))
        free[node] -= n
        while node > 1:
            node //= 2
            best = free[2 * node] if free[2 * node] >= free[2 * node + 1] else free[2 * node + 1]
            if free[node] == best:
                break
            free[node] = best
    return placed


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``pieces`` needs
    ``doc_id, start, length`` (length at most ``capacity``); its other columns
    travel along."""
    prepare(pieces.sparkSession)
    kept = store(pieces, "pieces")
    whole = F.col("length") == capacity
    groups = max(1, math.ceil(kept.where(~whole).count() / group_pieces))
    dealt = kept.where(~whole).withColumn("__group", F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()),
                                                            F.lit(groups)))
    schema = pieces.schema

    def place(rows: pa.Table) -> pa.Table:
        # in Arrow, so that every column keeps its type and its nulls
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("length", "descending"), ("doc_id", "ascending"),
                                                          ("start", "ascending")]))
        group = rows.column("__group")[0].as_py()
        spots = first_fit_decreasing(rows.column("length").to_pylist(), capacity)
        return rows.drop_columns(["__group"]).append_column("sequence_id", pa.array([(group << 32) + s for s, _ in spots], pa.int64())) \
            .append_column("offset", pa.array([o for _, o in spots], pa.int64()))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", sequence_id long, offset long"
    packed = dealt.groupBy("__group").applyInArrow(place, ddl)
    # numbers from ``groups`` << 32 on belong to no group
    alone = kept.where(whole).withColumn("sequence_id", F.monotonically_increasing_id() + (groups << 32)) \
        .withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   with_ids: bool = True, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Tokenise, cut and pack whole documents."""
    return pack(token_pieces(docs, tokenizer, capacity, end_id, with_ids=with_ids), capacity, group_pieces)
