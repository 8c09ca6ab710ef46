"""Token ids of whole texts by the ``tokenizers`` library, chunk by chunk.

A text is cut where a pre-token always ends: before a run of white space that
follows another character. The ids of the chunks, one after another, are the
ids of the text, so a chunk that was seen before is looked up instead of being
encoded again. The look-up table of a worker is bounded: it is emptied when it
is full. The marks that the tokenizer's file adds (``<|endoftext|>``) are cut out
first and have their own ids, as in the library's encoding of the whole text.
``encode_all`` does the same for a column of texts: Arrow cuts them and finds the
distinct chunks, so Python sees each of these once a column.
"""

from __future__ import annotations

import os
import re
import struct
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode White_Space (what the tokenizers' patterns call white space).
_WS = "\t-\r \x85\xa0  -     　"
_RUNS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_IRREGULAR = re.compile(f"[ \n][{_WS}]|[{_WS}][ \n]")

#: White space that stays in a chunk when a text is cut at spaces and before line ends
_INNER = _WS.replace("\t-\r ", "\t\v-\r")

#: marks that end a word and are a pre-token of their own there
_MARKS = ".,;:!?#$%&*"
#: the letters that stand for bytes in byte-level models: printable Latin-1 for
#: itself, the other bytes from U+0100 on
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}

MAX_CACHED = 1_200_000
MAX_CHUNK = 64
#: words in a call of the library
WORDS_A_CALL = 4096

_ENCODERS: dict = {}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _flat(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed ids one after another, and each one's number of ids."""
    return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def _gather(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``which`` of ``flat``, one after another, and their sizes."""
    start, size = (np.cumsum(size) - size).take(which), size.take(which)
    end = np.cumsum(size)
    n = int(end[-1])
    small = np.int32 if max(n, len(flat)) < 1 << 31 else np.int64
    return flat.take(np.repeat((start - end + size).astype(small), size) + np.arange(n, dtype=small)), size


class _Chunks(dict):
    """chunk -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(chunk)
        if len(chunk) <= MAX_CHUNK:
            if len(self) >= MAX_CACHED:
                self.clear()
            self[chunk] = ids
        return ids


class ChunkEncoder:
    """``encode(text)`` gives the text's ids as ``<u4`` bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder()
        self.marks = {t.content: _packed([i]) for i, t in added.items()}
        #: literal marks can be cut out here; others only by the library
        self.plain_marks = not any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values())
        longest_first = sorted(self.marks, key=len, reverse=True)
        self.at_marks = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.marks else None
        #: white space never reaches the model when the pre-tokenizer drops it
        self.drops_space = self._ids(" \n a") == self._ids("a")
        self.exact = _Chunks(lambda c: _packed(self._ids(c)))
        self.words = _Chunks(lambda w: _packed(self._word(w)))
        self.spaced = _Chunks(self._chunk)
        #: the model alone, for words that are spelt in its letters already
        self.model = Tokenizer(self.tok.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        space = _BYTE_LETTERS[32]
        self.begins = np.array([(self.tok.id_to_token(i) or "").startswith(space)
                                for i in range(max(self.tok.get_vocab().values(), default=-1) + 1)])
        #: a column is cut by Arrow if spaces are ids' first letters and marks lie in one chunk
        self.by_column = (not self.drops_space and self.plain_marks and self.tok.token_to_id(space) is not None and
                          not any(re.search(f"[{_WS}]", m) for m in self.marks))
        #: chunks whose texts are encoded one at a time: irregular white space, marks
        self.odd = "|".join(["^$", f"^[{_INNER}]", f"[\n{_INNER}]$", *map(re.escape, longest_first)])

    def _ids(self, chunk: str) -> list[int]:
        return self.tok.encode(chunk, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        """A pre-token of letters (behind a space or not), by the model alone."""
        if self.drops_space:
            word = word.lower() if word.isascii() else "".join(map(str.lower, word))
        if word.isascii():  # letters stand for themselves
            word = word.replace(" ", _BYTE_LETTERS[32])
        else:
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return [t.id for t in self.tok.model.tokenize(word)]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk without inner white space (behind a space, unless it
        begins with a line end). Letters followed by common marks are two
        pre-tokens, each looked up by itself."""
        word = chunk.rstrip(_MARKS)
        line = word[:1] == "\n"
        letters = word[1:] if line else word
        plain = letters.isascii() or (max(letters) < "\u0530" and is_normalized("NFC", letters) and
                                      # lower-casing may add a mark, which is a pre-token of its own
                                      (not self.drops_space or all(len(c.lower()) == 1 for c in letters)))
        if not (letters.isalpha() and plain):
            return _packed(self._ids(chunk if line or self.drops_space or chunk[:1] == "\n" else " " + chunk))
        if len(word) < len(chunk):
            return self.spaced[word] + self.exact[chunk[len(word):]]
        if line:
            return self.exact["\n"] + self.words[letters]
        return _packed(self._word(letters if self.drops_space else " " + letters))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.marks and not self.plain_marks:
            return _packed(self._ids(text))
        if any(m in text for m in self.marks):
            return b"".join(self.marks.get(piece) or self._pieces(piece) for piece in self.at_marks.split(text) if piece)
        return self._pieces(text)

    @staticmethod
    def _spelt(words: list[str]) -> str:
        """Words, each behind a space, in the letters of a byte-level model."""
        if all(map(str.isascii, words)):
            return _BYTE_LETTERS[32] + f" {_BYTE_LETTERS[32]}".join(words)
        return " ".join(["", *words]).encode().decode("latin-1").translate(_BYTE_LETTERS | {32: " " + _BYTE_LETTERS[32]})

    def _learn(self, words: list[str]) -> None:
        """Put new words of letters in the look-up table, many in a call of the model."""
        words.sort(key=str.isascii)
        calls = [words[a:a + WORDS_A_CALL] for a in range(0, len(words), WORDS_A_CALL)]
        got = self.model.encode_batch_fast([self._spelt(some) for some in calls], add_special_tokens=False)
        for some, ids in zip(calls, (np.array(g.ids, "<u4") for g in got)):
            first = np.flatnonzero(self.begins[ids])
            if len(first) == len(some):  # else this model gives a space other ids: each word by itself
                at, ids = [*(first * 4).tolist(), 4 * len(ids)], ids.tobytes()
                self.spaced.update(zip(some, map(ids.__getitem__, map(slice, at, at[1:]))))

    def _ids_of(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks behind a space, and each one's number of ids. Of a word
        with common marks behind it the word alone is kept in the look-up table."""
        if len(self.spaced) >= MAX_CACHED:
            self.spaced.clear()
        letters = pc.utf8_rtrim(chunks, _MARKS)
        words = letters.dictionary_encode()
        which, words = words.indices.to_numpy().astype(np.int64), words.dictionary
        plain = pc.and_(pc.utf8_is_alpha(words), pc.less_equal(pc.utf8_length(words), MAX_CHUNK))
        plain, ascii_ = (x.to_numpy(zero_copy_only=False).copy() for x in (plain, pc.string_is_ascii(words)))
        words = words.to_numpy(zero_copy_only=False).tolist()
        for i in np.flatnonzero(plain & ~ascii_).tolist():
            plain[i] = max(words[i]) < "\u0530" and is_normalized("NFC", words[i])
        ids = list(map(self.spaced.get, words))
        new = [i for i in np.flatnonzero(plain).tolist() if ids[i] is None]
        self._learn([words[i] for i in new])
        for i in new:
            ids[i] = self.spaced[words[i]]
        for i in np.flatnonzero(~plain).tolist():
            ids[i] = b""
        # a chunk is a word and the marks behind it, or is looked up whole
        none = len(ids)
        ids += [b"", *(self.exact[m] for m in _MARKS)]
        behind = np.full(len(chunks), none)
        for i, mark in enumerate(_MARKS):
            behind[pc.ends_with(chunks, mark).to_numpy(zero_copy_only=False)] = none + 1 + i
        marks = pc.subtract(pc.binary_length(chunks), pc.binary_length(letters)).to_numpy()
        rest = np.flatnonzero((marks > 1) | ~plain[which])
        whole, some = ~plain[which[rest]], chunks.take(pa.array(rest)).to_numpy(zero_copy_only=False).tolist()
        behind[rest] = len(ids) + np.arange(len(rest))
        ids += [self.spaced[chunk] if alone else self.exact[chunk[-n:]]
                for chunk, alone, n in zip(some, whole.tolist(), marks[rest].tolist())]
        ids, size = _gather(*_flat(ids), np.stack([which, behind], 1).ravel())
        return ids, size.reshape(-1, 2).sum(1)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` (null: none), one text after another, and each
        text's number of ids."""
        if not self.by_column or not len(texts):
            got = list(map(self.encode, texts.to_pylist()))
            return np.frombuffer(b"".join(got), "<u4"), np.array([len(g) // 4 for g in got], np.int64)
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " \n"), " ")
        heads = cut.offsets.to_numpy()[:-1].astype(np.int64)
        chunks = cut.values.dictionary_encode()
        which, distinct = chunks.indices.to_numpy().astype(np.int64), chunks.dictionary
        first = distinct.take(pa.array(which[heads])).to_pylist()
        odd = pc.match_substring_regex(distinct, self.odd).to_numpy(zero_copy_only=False)[which]
        odd[heads] &= np.array(list(map(bool, first)))  # a text may begin with a space or a line end
        odd = np.logical_or.reduceat(odd, heads)
        ids, size = self._ids_of(distinct)
        # a text's first chunk has no space before it; an odd text's stands for all of its ids
        more, sizes = _flat([self.encode(texts[i].as_py()) if odd[i] else self.exact[head] if head else b""
                             for i, head in enumerate(first)] + [b""])
        which[np.repeat(odd, np.diff(heads, append=len(which)))] = len(size) + len(heads)
        which[heads] = len(size) + np.arange(len(heads))
        ids, size = _gather(np.concatenate([ids, more]), np.concatenate([size, sizes]), which)
        return ids, np.add.reduceat(size, heads)

    def _pieces(self, text: str) -> bytes:
        """Ids of a text without marks."""
        if self.drops_space:
            return b"".join(map(self.spaced.__getitem__, text.replace("\n", " ").split(" ")))
        if _IRREGULAR.search(text):
            return b"".join(map(self.exact.__getitem__, _RUNS.findall(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return (self.exact[first] if first else b"") + b"".join(map(self.spaced.__getitem__, rest))


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file (kept between tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
