import hashlib
import re

from cosecha.llm.decontam import decontaminate, digest, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, bench):
    out = []
    for doc, text in rows:
        ws, hit, items = words(text), set(), set()
        for item, b in bench:
            bw = words(b)
            for w in {tuple(bw[i:i + 13]) for i in range(max(1, len(bw) - 12))} if bw else ():
                for p in range(len(ws) - len(w) + 1):
                    if tuple(ws[p:p + len(w)]) == w:
                        hit.update(range(p, p + len(w)))
                        items.add(str(item))
        out.append((doc, len(ws), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


def cases(sample):
    a = " ".join(f"w{i}" for i in range(20))
    bench = [(1, a), (2, "Short ITEM here"), (10, a), (3, ""), (4, None), (5, "the the the the")]
    rows = sample[:40] + [(600, "x " + a + " y"), (601, "short, item. HERE short item here"), (602, None), (603, ""),
                          (604, " ".join(a.split()[3:16])), (605, " ".join(a.split()[3:15])), (606, "the " * 9),
                          (607, "z " * 500 + "short item here"), (None, "short item here"), (601, "clean now"),
                          (608, "short item"), (609, "here")]
    return rows, bench


def test_equals_brute_force(spark, documents, sample):
    rows, bench = cases(sample)
    b = spark.createDataFrame(bench, "item_id long, text string")
    for block in (1_000_000, 15):
        out = digest(decontaminate(documents(rows), b, block_words=block))
        assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, bench)


def test_proximity(spark, documents):
    b = spark.createDataFrame([(7, "alpha beta gamma delta")], "item_id long, text string")
    docs = documents([(1, "alpha beta gamma delta"), (2, "alpha beta so gamma delta"), (3, "alpha x x x beta gamma delta")])
    out = {r.doc_id: r for r in decontaminate(docs, b, slop=1).collect()}
    assert out[1].spans and not out[1].near
    assert not out[2].spans and [x.item_id for x in out[2].near] == [7]
    assert not out[3].spans and not out[3].near


def test_drop_and_empty_tables(spark, documents, sample):
    rows, bench = cases(sample)
    b = spark.createDataFrame(bench, "item_id long, text string")
    kept = drop_contaminated(documents(rows), b)
    bad = [(d, n) for d, n, _, _, _, c in brute(rows, bench) if c]
    assert kept.count() == len(rows) - len(bad) and kept.columns == ["doc_id", "text", "length", "score", "segment"]
    assert decontaminate(documents([]), b).count() == 0
    none = decontaminate(documents(rows), b.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)


def test_one_index_whatever_the_blocks_and_items_cut_in_pieces(spark, documents, sample, monkeypatch):
    import cosecha.llm.decontam as D
    long = " ".join(f"q{i}" for i in range(400))
    rows = sample[:20] + [(700, "x " + " ".join(f"q{i}" for i in range(95, 115)) + " y"), (701, long), (702, "a.b.c.d " * 30),
                          (703, " ".join(f"q{i}" for i in range(388, 400)) + " q0")]
    bench = [(1, long.upper()), (2, ".".join("abcd") * 20), (3, "a-b c_d " * 7)]
    b = spark.createDataFrame(bench, "item_id long, text string")
    written = []
    keep = D.store
    monkeypatch.setattr(D, "store", lambda df, name, **o: written.append(name) or keep(df, name, **o))
    monkeypatch.setattr(D, "PIECE_WORDS", 37)
    out = digest(decontaminate(documents(rows), b, block_words=50))
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, bench)
    assert written == ["items", "postings"]
    assert max(r.n for r in D.pieces(b, 13, 37).collect()) <= 49


def test_a_proximity_match_at_the_start_of_a_document(spark, documents):
    b = spark.createDataFrame([(7, "alpha beta gamma delta")], "item_id long, text string")
    docs = documents([(1, "zeta eta"), (2, "alpha beta delta gamma"), (3, "no delta delta delta delta")])
    out = {r.doc_id: r for r in decontaminate(docs, b, slop=2).collect()}
    assert [x.item_id for x in out[2].near] and not out[1].near and not out[3].near
