import random
import zlib

from cosecha.llm.toxicity import features, fit, held_out

WORDS = "river stone cloud garden window paper silver morning yellow travel music letter".split()


def corpus(n=900):
    rng, rows = random.Random(4), []
    for i in range(n):
        w = [rng.choice(WORDS) for _ in range(40)]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(4):
                w[rng.randrange(40)] = rng.choice(["grobian", "scumful", "grobianic"])
        rows.append((i, " ".join(w), int(bad)))
    return rows


def test_features():
    lex = {"scum": 3.0, "grob*": 2.0}
    names = ("lexicon_density", "lexicon_hits", "lexicon_distinct")
    f = dict(zip(names, features("You SCUM, grobian grob", lex)))
    assert f["lexicon_density"] == 0.5 and f["lexicon_distinct"] == 2.0
    assert features("s.c.u.m and $cum s c u m", lex)[14] >= 2
    assert features(None, lex) == features("", lex) and not any(features("", lex))


def test_held_out_accuracy_and_cases(spark, documents):
    rows = corpus()
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    extra = [(5000, None), (5001, ""), (None, "river"), (5002, "scumful " * 3000), (5002, "scumful " * 3000)]
    docs = documents([(i, t) for i, t, _ in rows] + extra)
    out = fit(docs, labels).score(docs).collect()
    assert len(out) == len(rows) + 5
    truth = {i: t for i, _, t in rows}
    out_ids = [r for r in out if r.doc_id in truth]
    for r in out_ids:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    kept = [r for r in out_ids if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in kept) / len(kept) > 0.95
    assert {r.score for r in out if r.doc_id == 5000} == {r.score for r in out if r.doc_id == 5001}
    assert len({r.score for r in out if r.doc_id == 5002}) == 1


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents([(1, "a"), (2, None)])
    assert [r.score for r in fit(docs, none).score(docs).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(r.score == 1.0 for r in fit(docs, one).score(docs).collect())
    assert fit(documents([]), none).score(documents([])).count() == 0


def test_held_out_is_not_learnt_from(spark):
    ids = spark.range(50)
    got = {r[0] for r in ids.where(held_out(ids["id"])).collect()}
    assert got == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0}
