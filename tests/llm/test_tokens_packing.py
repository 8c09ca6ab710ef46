import random
import zlib

import numpy as np
import pytest

from cosecha.llm.packing import first_fit_decreasing, pack_documents
from cosecha.llm.tokens import encoder, public_path

PARTS = ["a", "the", " ", " ", "\n", "\t", "\xa0", "'s", "!", "1", "é", "\x1c", "Σ", "ΑΣ", "é", "  ", "\n\n",
         "\r\n", "<|endoftext|>", "　", "..", "don't", "Word,", "x" * 80]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_ids_of_the_whole_text(name, sample):
    enc, rng = encoder(public_path(name)), random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for text in texts + [t for _, t in sample[:60]]:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == enc._ids(text)
    assert enc.encode(None) == b""


def test_first_fit_decreasing_equals_a_plain_scan():
    rng = random.Random(2)
    for _ in range(30):
        sizes = sorted((rng.randint(1, 50) for _ in range(rng.randint(0, 60))), reverse=True)
        bins, expected = [], []
        for n in sizes:
            k = next((i for i, used in enumerate(bins) if used + n <= 50), len(bins))
            bins += [0] * (k == len(bins))
            expected.append((k, bins[k]))
            bins[k] += n
        assert first_fit_decreasing(sizes, 50) == expected


def test_pieces_cover_documents_and_sequences_are_gapless(spark, documents, sample):
    rows = sample[:80] + [(900, None), (901, ""), (None, "a b"), (902, "same"), (902, "same"), (903, "word " * 9000)]
    out = pack_documents(documents(rows), group_pieces=32).collect()
    enc = encoder(public_path("word_bpe_49k.json"))
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for doc, text in dict(rows).items():
        ids = enc.encode(text) + (2).to_bytes(4, "little")
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        if doc == 902:
            assert len(pieces) == 2
            pieces = pieces[:1]
        assert np.array(sum((p.ids for p in pieces), []), "<u4").tobytes() == ids
        assert all(p.doc_tokens == len(ids) // 4 for p in pieces)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    assert sum(r.length for r in out) / (4096 * len(by_seq)) > 0.9


def test_no_documents(spark, documents):
    assert pack_documents(documents([])).count() == 0


@pytest.mark.parametrize("name, expected", [("byte_bpe_50k.json", [27773, 2420, 220, 50256, 517, 2420]),
                                            ("word_bpe_49k.json", [3772, 4160, 49407, 750, 4160])])
def test_marks_have_the_ids_of_the_untouched_tokenizer(name, expected):
    from tokenizers import Tokenizer
    enc, tok, rng = encoder(public_path(name)), Tokenizer.from_file(public_path(name)), random.Random(4)
    assert np.frombuffer(enc.encode("clean text <|endoftext|> more text"), "<u4").tolist() == expected
    parts = [*PARTS, "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext|", "<", "\u0338", "<|"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_letter_has_the_ids_of_the_untouched_tokenizer(name):
    from tokenizers import Tokenizer
    enc, tok = encoder(public_path(name)), Tokenizer.from_file(public_path(name))
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 37 == 0)]
    texts = [t for c in map(chr, points) for t in (f"\u044f{c}", f"{c}b", f"a {c}c.", c)]
    want = tok.encode_batch(texts, add_special_tokens=False)
    bad = [t for t, w in zip(texts, want) if np.frombuffer(enc.encode(t), "<u4").tolist() != w.ids]
    assert not bad


def test_long_ids_beside_a_null_one_and_clashing_columns(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, "a", 1, big), (None, "b", 2, None), (big + 2, None, None, big)],
                               "doc_id long, text string, length int, sequence_id long")
    out = pack_documents(df).collect()
    assert {r.doc_id for r in out} == {big, None, big + 2} and len(out) == 3


def test_whole_pieces_are_sequences_of_their_own(spark, documents):
    rows = [(i, "word " * n) for i, n in enumerate([4095, 8191, 9000, 3, 3, 20_000])]
    out = pack_documents(documents(rows), with_ids=False, group_pieces=2).collect()
    full = [r for r in out if r.length == 4096]
    assert len(full) == 1 + 2 + 2 + 4 and len({r.sequence_id for r in full}) == len(full)
    rest = {r.sequence_id for r in out if r.length < 4096}
    assert not rest & {r.sequence_id for r in full} and all(r.offset == 0 for r in full)
