"""Token counts (operator 7): trie-shared dynamic programming.

A unigram model gives every vocabulary token a cost; the best segmentation of
a pre-token is the one with the least total cost. The best cost of a prefix
does not depend on what follows, so the distinct pre-tokens of a task are put
into a trie and the forward score is computed once per trie node - once per
shared prefix - and the number of tokens of the best segmentation is kept where
a pre-token ends. Counting a text is then a look-up per pre-token.

Nothing is shuffled; a task's trie and look-up table are bounded: each is
emptied when it is full (``MAX_NODES``, ``MAX_WORDS``).

The vocabulary is a file of byte tokens in rank order; by Zipf's law a token
of rank r costs ln(r + 2) (in millionths, so sums are exact). Equal costs go to
the segmentation with fewer tokens.

Defined cases: a null or empty text has no tokens; a very long pre-token is
walked once without entering the trie; a byte that is no token costs as much as
the rarest one; repeated rows are counted one by one; a null ``doc_id`` is kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.llm.common import prepare
from cosecha.llm.tokens import public_path

MAX_NODES = 800_000
MAX_WORDS = 800_000
#: pre-tokens of more bytes are not worth a place in the trie
MAX_BYTES = 64


#: a score is a cost and a number of tokens in one integer: it is less when the
#: cost is less, or the cost is equal and the tokens are fewer
_SHIFT = 40
_TOKENS = (1 << _SHIFT) - 1


def load_costs(path: str) -> dict[bytes, int]:
    """Token -> cost, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(t): round(1e6 * math.log(int(r) + 2)) for t, r in pairs}


class TrieCounter(dict):
    """pre-token -> number of tokens of its best segmentation."""

    def __init__(self, costs: dict[bytes, int], max_nodes: int = MAX_NODES):
        super().__init__()
        self.max_nodes = max_nodes
        self.unknown = (max(costs.values(), default=0) << _SHIFT) + 1
        # every beginning of a token: its score as a token, or None
        self.begins = {t[:i]: None for t in costs for i in range(1, len(t))}
        self.begins.update({t: (c << _SHIFT) + 1 for t, c in costs.items()})
        self._empty()

    def _empty(self):
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        #: of each node: score of the best way to it; where tokens that may go on began
        self.score, self.open = [0], [()]

    def _forward(self, word: bytes, d: int, scores: list[int], began: tuple) -> tuple[int, tuple]:
        """The best score of ``word[:d]`` from those of its prefixes, and the
        places from which a token may go on."""
        get = self.begins.get
        best, still = scores[d - 1] + self.unknown, []
        for a in (*began, d - 1):
            score = get(word[a:d], -1)
            if score != -1:
                still.append(a)
                if score is not None and scores[a] + score < best:
                    best = scores[a] + score
        return best, tuple(still)

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8", "surrogatepass")
        scores, child = [0], self.child
        if len(raw) > MAX_BYTES:
            began: tuple = ()
            for d in range(1, len(raw) + 1):
                best, began = self._forward(raw, d, scores, began)
                scores.append(best)
            return scores[-1] & _TOKENS
        if len(self.score) >= self.max_nodes:
            self._empty()
            child = self.child
        node = 0
        for d, byte in enumerate(raw, 1):
            key = node << 8 | byte
            nxt = child.get(key)
            if nxt is None:
                nxt = child[key] = len(self.score)
                best, began = self._forward(raw, d, scores, self.open[node])
                self.score.append(best)
                self.open.append(began)
            scores.append(self.score[nxt])
            node = nxt
        if len(self) >= MAX_WORDS:
            self.clear()
        self[word] = n = scores[-1] & _TOKENS
        return n


_COUNTERS: dict = {}


def count_tokens(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens of whole texts."""
    prepare(docs.sparkSession)
    import public_tokenizers
    path = vocabulary or public_path("byte_bpe_50k.tiktoken")
    split = pattern or public_tokenizers.PATTERN
    schema = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])

    def run(it):
        import regex
        if path not in _COUNTERS:
            _COUNTERS[path] = TrieCounter(load_costs(path))
        count, find = _COUNTERS[path], regex.compile(split).findall
        for b in it:
            pre, tokens = [], []
            for text in b.column(1).to_pylist():
                words = find(text or "")
                pre.append(len(words))
                tokens.append(sum(map(count.__getitem__, words)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pre, pa.int64()), pa.array(tokens, pa.int64())],
                                             schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
