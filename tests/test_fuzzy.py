"""The top-1 similarity join: scorer, signatures, falling cutoffs."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cosecha.operators import fuzzy as fz


def _text(rnd, letters, most):
    return "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, most)))


def test_block_ratio_is_difflibs():
    rnd = random.Random(1)
    for n in range(6000):
        letters = rnd.choice(["ab", "abc ", "abcdefgh é", "xyz"])
        a, b = _text(rnd, letters, 30), _text(rnd, letters, 30)
        if n % 5 == 0:
            b = a[:len(a) // 2] + b
        assert fz.block_ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio(), (a, b)


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz " * 3 + "é0123456789", "aaaab"])
def test_block_ratio_of_long_texts_leaves_frequent_characters_out_as_difflib_does(letters):
    rnd = random.Random(2)
    for n in range(60):
        a, b = _text(rnd, letters, 400), _text(rnd, letters, 500)
        b = (b[:50] + a[20:90] + b[50:] + a[:30]) if n % 2 else b
        assert fz.block_ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio(), (a, b)


def _fixture(spark, sf):
    left, right = E._fuzzy_inputs(spark, sf)
    return fz._sides(left.select(F.col("producto_normalizado").alias("_l")), right.select(F.col("descripcion").alias("_r")))


@pytest.mark.parametrize("method", ["difflib", "levenshtein"])
def test_fixture_candidates_are_under_a_tenth_of_all_pairs(spark, sf001, method):
    left, right = _fixture(spark, sf001)
    every = left.rows.count() * right.rows.count()
    seen, rest = 0, left.rows
    for share in (*fz.ROUNDS[method], 0.0):
        c = 0.5 + share * 0.5
        pairs = fz.signature_matches(fz.Texts(rest, left.lengths), right, method, c)
        seen += pairs.count()
        done = pairs.distinct().withColumn("s", fz._score(method, c)).where("s is not null").select("_l").distinct()
        rest = rest.join(done, rest["t"] == done["_l"], "left_anti")
    assert 0 < seen < every / 10


@pytest.mark.parametrize("method", ["difflib", "levenshtein"])
@pytest.mark.parametrize("cutoff", [-1.0, 0.0, 0.4, 0.75, 1.0])
def test_best_match_equals_brute_force(spark, method, cutoff):
    rnd = random.Random(7)
    words = sorted({_text(rnd, "abcd é", 12) for _ in range(120)} | {"", "a", "aa", "x" * 60, "x" * 59 + "y"})
    lefts, rights = words[::2] + ["only left", "😀😀 b"], words[1::2] + ["", "😀 b"]
    out = fz.fuzzy_best_match(spark.createDataFrame([(w,) for w in lefts + lefts[:5] + [None]], "l string"), "l",
                              spark.createDataFrame([(w, i) for i, w in enumerate(rights)] + [(None, 0), (rights[0], 999)],
                                                    "r string, id long"), "r", "id", cutoff=cutoff, method=method)

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return 1 - row[-1] / max(len(a), len(b)) if a or b else 1.0
    score = lev if method == "levenshtein" else lambda a, b: difflib.SequenceMatcher(None, b, a).ratio()
    want = {}
    for a in lefts:
        s, b = max((score(a, b), b.encode()) for b in rights)
        if s >= cutoff:
            want[a] = (b.decode(), rights.index(b.decode()), s * 100.0)
    got = {r.l: (r.match_text, r.id, r.match_score) for r in out.collect()}
    assert set(got) == set(want)
    for a, (b, i, s) in want.items():
        assert got[a][:2] == (b, i) and got[a][2] == pytest.approx(s, abs=1e-9), a


def test_empty_sides_and_left_join(spark):
    none, one = spark.createDataFrame([], "l string"), spark.createDataFrame([("a",)], "l string")
    rights = spark.createDataFrame([("b", 1)], "r string, id long")
    for method in fz.ROUNDS:
        assert fz.fuzzy_best_match(none, "l", rights, "r", "id", method=method).count() == 0
        assert fz.fuzzy_best_match(one, "l", rights.limit(0), "r", "id", method=method).count() == 0
        kept = fz.fuzzy_best_match(one, "l", rights, "r", "id", method=method, how="left").collect()
        assert [tuple(r) for r in kept] == [("a", None, None, None)]
    with pytest.raises(ValueError):
        fz.fuzzy_best_match(one, "l", rights, "r", "id", method="other")


def test_subset_size_bounds_the_signatures(spark):
    row = spark.range(1).selectExpr(*[f"{fz._subset_size(str(m), str(top))} AS s{m}_{top}"
                                      for m, top in ((0, 5), (1, 1), (3, 3), (5, 9), (10, 40), (200, 2000))]).first()
    assert row.s0_5 == 0 and row.s1_1 == 1 and row.s3_3 == 3 and row.s5_9 == 5 and row.s10_40 == 2 and row.s200_2000 == 1
