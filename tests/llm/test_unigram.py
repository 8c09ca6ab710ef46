import math
import random

import public_tokenizers
import regex

from cosecha.llm.unigram import TrieCounter, count_tokens, load_costs
from cosecha.llm.tokens import public_path


def brute(costs, unknown, word):
    b = word.encode()
    best = [(0, 0)]
    for d in range(1, len(b) + 1):
        ways = [(best[a][0] + costs[b[a:d]], best[a][1] + 1) for a in range(d) if b[a:d] in costs]
        ways.append((best[d - 1][0] + unknown, best[d - 1][1] + 1))
        best.append(min(ways))
    return best[-1][1]


def test_small_vocabularies_with_unknown_bytes():
    rng = random.Random(1)
    for _ in range(40):
        costs = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))).encode(): rng.randint(1, 9) for _ in range(8)}
        counter = TrieCounter(costs, max_nodes=rng.choice([4, 1000]))
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90 if rng.random() < 0.1 else 9)))
            assert counter[word] == brute(costs, max(costs.values()), word)


def test_shared_prefixes_are_scored_once():
    counter = TrieCounter(load_costs(public_path("byte_bpe_50k.tiktoken")))
    counter["undoing"]
    nodes = len(counter.score)
    counter["undo"]
    assert len(counter.score) == nodes
    counter["undone"]
    assert len(counter.score) == nodes + 2


def test_counts_of_documents(spark, documents, sample):
    rows = sample[:25] + [(300, None), (301, ""), (None, "two words"), (302, "q" * 500), (302, "q" * 500)]
    costs = load_costs(public_path("byte_bpe_50k.tiktoken"))
    rarest = max(costs.values())
    assert costs[b"!"] == round(1e6 * math.log(2))
    split = regex.compile(public_tokenizers.PATTERN).findall
    exp = sorted(((d, len(split(t or "")), sum(brute(costs, rarest, w) for w in split(t or ""))) for d, t in rows), key=str)
    assert sorted((tuple(r) for r in count_tokens(documents(rows)).collect()), key=str) == exp
    assert count_tokens(documents([])).count() == 0
