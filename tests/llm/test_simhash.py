import re

import xxhash

from cosecha.llm.simhash import drop_near_duplicates, near_duplicates, simhash


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64(" ".join(words[i:i + 4]).encode(), 42).intdigest() for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fp = [plain(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{fp[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_fingerprint(sample):
    for _, t in sample[:40] + [(0, None), (0, ""), (0, " \t"), (0, "One"), (0, "a\x0bB c\xa0d e")]:
        assert simhash(t) == plain(t)


def test_components_equal_brute_force(spark, documents, sample):
    near = [(500 + i, sample[3][1] + " w" * i) for i in range(12)]
    rows = sample[:120] + near + [(700, None), (701, ""), (702, "x"), (702, "x"), (None, sample[3][1]), (None, "alone")]
    out = near_duplicates(documents(rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out), key=str) == brute(rows)


def test_one_of_each_component_stays(spark, documents, sample):
    text = sample[5][1]
    rows = [(4, text), (2, text), (2, text), (9, sample[8][1]), (None, "no id")]
    kept = drop_near_duplicates(documents(rows))
    assert kept.columns == ["doc_id", "text", "length", "score", "segment"]
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 9]


def test_no_documents(spark, documents):
    assert near_duplicates(documents([])).count() == 0


def test_one_row_of_each_component_whatever_the_ids(spark, documents):
    one, two = (" ".join(f"{w}{i}" for i in range(60)) for w in ("red", "stone"))
    rows = [(1, one), (5, one), (5, two), (None, two), *[(None, "lost " * 30)] * 5]
    kept = drop_near_duplicates(documents(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
        [(1, one), (5, two), (None, "lost " * 30)], key=str)
