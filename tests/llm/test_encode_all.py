import random

import numpy as np
import pyarrow as pa
import pytest

from cosecha.llm import tokens
from cosecha.llm.repair import compress, expand
from cosecha.llm.tokens import ChunkEncoder, public_path

BITS = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\v", "\x1c", "\x85", "\xa0", " ", "　", "a", "Foo", "foo,", "foo...",
        "l'eau", "don't", "été", "é", "́", "ß", "İ", "中文", "🙂", "12", "x" * 80, "...", ".", "%,", "<|endoftext|>",
        "<|endof", "\x00"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_column_has_the_ids_of_its_whole_texts(name):
    enc, rng = ChunkEncoder(public_path(name)), random.Random(1)
    for _ in range(60):
        texts = ["".join(rng.choice(BITS) + " " * (rng.random() < .6) for _ in range(rng.randint(0, 12))) for _ in range(20)]
        texts += [None, ""]
        ids, size = enc.encode_all(pa.array(texts))
        for text, got in zip(texts, np.split(ids, np.cumsum(size)[:-1]), strict=True):
            assert got.tolist() == enc.tok.encode(text or "", add_special_tokens=False).ids
    ids, size = enc.encode_all(pa.array([], pa.string()))
    assert len(ids) == len(size) == 0


def test_new_words_share_calls_of_the_model(sample):
    enc = ChunkEncoder(public_path("byte_bpe_50k.json"))
    one_by_one = []
    enc.words.encode, enc.spaced.encode = (lambda f: (lambda c: one_by_one.append(c) or f(c)))(enc.words.encode), \
        (lambda f: (lambda c: one_by_one.append(c) or f(c)))(enc.spaced.encode)
    texts = [t for _, t in sample if t]
    ids, _ = enc.encode_all(pa.array(texts))
    assert ids.tobytes() == b"".join(map(ChunkEncoder(public_path("byte_bpe_50k.json")).encode, texts))
    assert len(one_by_one) < len(enc.spaced) / 5


def test_a_full_table_is_emptied(monkeypatch, sample):
    monkeypatch.setattr(tokens, "MAX_CACHED", 50)
    enc, texts = ChunkEncoder(public_path("byte_bpe_50k.json")), [t for _, t in sample if t][:40]
    got = [enc.encode_all(pa.array(texts[a:a + 10]))[0].tobytes() for a in range(0, len(texts), 10)]
    assert b"".join(got) == b"".join(ChunkEncoder(public_path("byte_bpe_50k.json")).encode(t) for t in texts)


def test_the_grammar_is_the_same_for_ids_that_do_not_fit_one_integer_with_their_place():
    rng = random.Random(4)
    for _ in range(40):
        docs = [[rng.choice([5, 5, 6, 7]) for _ in range(rng.randint(0, 60))] for _ in range(9)]
        ids, ends = np.array(sum(docs, []), "<u4"), np.cumsum([len(d) for d in docs])
        far = 2**32 - 10_000
        sym, per_doc, base, *rules = compress(ids, ends)
        sym2, per_doc2, base2, *rules2 = compress(ids + np.uint32(far), ends)
        assert (sym2 - sym == far).all() and (per_doc == per_doc2).all() and base2 - base == far
        assert [len(r) for r in rules] == [len(r) for r in rules2] and rules[2] == rules2[2]
        assert (expand(sym2, base2, *rules2) == ids + np.uint32(far)).all()
