import random
import zlib

import numpy as np

from cosecha.llm.repair import compress, decode_range, expand, read_ids, repair_round_trip, write_ids
from cosecha.llm.tokens import encoder, public_path
from cosecha.session import scratch_path


def test_grammar_round_trip_and_random_access():
    rng = random.Random(3)
    docs = [np.array([rng.choice([5, 6, 7, 8, 900]) for _ in range(rng.randint(0, 300))] + [2], "<u4") for _ in range(80)]
    ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    sym, per_doc, base, left, right, length = compress(ids, ends)
    assert left and len(sym) < len(ids)
    assert (expand(sym, base, left, right, length) == ids).all()
    row = {"doc_symbols": per_doc.tolist(), "doc_ids_n": [len(d) for d in docs], "base": base, "rule_left": left,
           "rule_right": right, "rule_len": length, "symbols": sym.tobytes()}
    for _ in range(200):
        d = rng.randrange(len(docs))
        a, b = rng.randint(0, len(docs[d])), rng.randint(0, len(docs[d]) + 2)
        assert (decode_range(row, d, a, b) == docs[d][a:b]).all()


def test_overlapping_equal_pairs():
    ids = np.array([5] * 41 + [2], "<u4")
    sym, _, base, left, right, length = compress(ids, np.array([42]))
    assert (expand(sym, base, left, right, length) == ids).all()


def test_expanding_writes_out_only_the_rules_below_the_symbols():
    # rule i stands for 2^(i+1) times the id 1: all of them written out would be 2^51 ids
    left = right = [1] + [10 + i for i in range(49)]
    length = [2 << i for i in range(50)]
    assert expand(np.array([12, 3, 10], "<u4"), 10, left, right, length).tolist() == [1] * 8 + [3] + [1] * 2
    assert expand(np.zeros(0, "<u4"), 0, [], [], []).tolist() == []


def pairs_left(sym, per_doc):
    """The most often a pair occurs, without overlap, inside documents."""
    seen, at = {}, 0
    for n in per_doc:
        last = {}
        for i in range(at, at + n - 1):
            p = (sym[i], sym[i + 1])
            if last.get(p) != i - 1 or p[0] != p[1]:
                seen[p] = seen.get(p, 0) + 1
                last[p] = i
        at += n
    return max(seen.values(), default=0)


def test_no_pair_occurs_twice_afterwards(sample):
    enc, rng = encoder(public_path("byte_bpe_50k.json")), random.Random(8)
    texts = [np.frombuffer(enc.encode(t) + (2).to_bytes(4, "little"), "<u4") for _, t in sample]
    wild = [np.array([rng.choice([5, 5, 5, 6, 7]) for _ in range(rng.randint(1, 400))], "<u4") for _ in range(60)]
    for docs in (texts, wild, [np.array([1, 1, 1, 2, 1, 1, 1], "<u4")], [np.array([], "<u4")]):
        ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
        sym, per_doc, base, left, right, length = compress(ids, ends)
        assert pairs_left(sym.tolist(), per_doc.tolist()) <= 1
        assert (expand(sym, base, left, right, length) == ids).all()
        for i, (a, b) in enumerate(zip(left, right)):  # rules lean on earlier ones, lengths add up
            assert max(a, b) < base + i and length[i] == sum(length[s - base] if s >= base else 1 for s in (a, b))


def test_a_run_of_one_id_takes_a_logarithm_of_rules():
    for n in (2, 64, 10_000):
        ids = np.array([7] * n + [2], "<u4")
        sym, _, base, left, right, length = compress(ids, np.array([n + 1]))
        assert (expand(sym, base, left, right, length) == ids).all()
        assert len(left) <= 14 and len(sym) <= 16 and (n > 2) <= len(left)


def test_random_access_touches_only_rules_below_its_symbols(sample):
    enc = encoder(public_path("byte_bpe_50k.json"))
    docs = [np.frombuffer(enc.encode(t) + (2).to_bytes(4, "little"), "<u4") for _, t in sample]
    ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    sym, per_doc, base, left, right, length = compress(ids, ends)
    row = {"doc_symbols": per_doc.tolist(), "doc_ids_n": [len(d) for d in docs], "base": base, "rule_left": left,
           "rule_right": right, "rule_len": length, "symbols": sym.tobytes()}
    depth = []
    for a, b in zip(left, right):
        depth.append(1 + max(depth[s - base] if s >= base else 0 for s in (a, b)))
    rng = random.Random(5)
    for _ in range(100):
        d = rng.randrange(len(docs))
        a = rng.randrange(len(docs[d]))
        seen = []
        assert (decode_range(row, d, a, a + 10, seen.append) == docs[d][a:a + 10]).all()
        assert len(seen) <= 10 * (max(depth) + 1) < len(left)


def test_a_document_longer_than_a_block_and_repeated_rows(spark, documents):
    rows = [(1, "a b c " * 9000), (2, "x"), (2, "x"), (None, None)]
    path = write_ids(documents(rows), scratch_path(spark, "ids"), block_ids=1000)
    out = sorted(read_ids(spark, path, with_ids=False).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == [None, 1, 2, 2] and out[1].n_tokens > 1000
    assert [r.start for r in out] == [0, 1, 1 + out[1].n_tokens, 1 + out[1].n_tokens + out[2].n_tokens]


def test_files_give_back_all_ids(spark, documents, sample):
    rows = sample[:60] + [(1000, None), (1001, ""), (None, "no id"), (1002, "twice"), (1002, "twice")]
    path = write_ids(documents(rows), scratch_path(spark, "ids"), block_ids=5000)
    assert spark.read.parquet(path).count() > 3
    out = sorted(read_ids(spark, path).collect(), key=lambda r: r.start)
    enc = encoder(public_path("byte_bpe_50k.json"))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for r, (doc, text) in zip(out, order, strict=True):
        ids = enc.encode(text) + (2).to_bytes(4, "little")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, at, len(ids) // 4, zlib.crc32(ids))
        assert np.array(r.ids, "<u4").tobytes() == ids
        at += len(ids) // 4


def test_no_documents(spark, documents):
    assert repair_round_trip(documents([])).count() == 0
