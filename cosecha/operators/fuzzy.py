"""Fuzzy best-match join.

For every left text (a normalised product name) find the right text (a
lower-cased food description) with the highest similarity at or above a
cutoff, and the id of the first right row carrying that text.

Plan
----
1. Both sides are reduced to distinct texts (the right side keeps the first id
   per text, J4). Dictionaries of names do not grow with the fact tables.
2. A text is the set of its tokens (character, how often it came before), in one
   order for both sides: rare tokens first. Both scores are bounded by the tokens
   two texts share: difflib's ratio is at most ``2 * shared / (la + lb)``,
   Levenshtein's similarity at most ``shared / max(la, lb)``. So a pair that
   reaches a cutoff shares a minimum of m tokens. Of any s <= m of them, the first
   s in order lie within the first ``length - m + s`` tokens of either text: a
   text's signatures are the s-subsets of that many tokens, and an equi-join on
   (the lengths, the signature) finds every pair. s is as large as keeps the
   subsets of a text below a bound, so a signature is rare; it changes the number
   of candidates, never the result.
3. It is a top-1 join, so cutoffs fall: left texts whose best match reaches a high
   cutoff are done (every pair above it has been seen) and only the others go on
   to the next, where texts have more signatures. The last cutoff is the caller's.
4. Scoring, once per candidate pair: difflib's ratio in an Arrow UDF that indexes
   nothing and searches blocks by growing them (``block_ratio``), or Spark's native
   ``levenshtein`` with its early-exit threshold.
5. Best per left text: ``max_by`` over (score, right text) - ties go to the
   larger text as ``get_close_matches`` does - a partial+final aggregate; pairs
   below the cutoff have a NULL order and are skipped by it.

No caps, no salts, no size switches: which side to broadcast and which hot
signature to split is the planner's (AQE's) choice. With a cutoff of zero or less
every pair qualifies and is scored in the last round.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cosecha.session import materialize

#: tokens whose frequency orders them; the rest counts as rare. Any order is right
COMMON_TOKENS = 64
#: the largest subsets, and how many of them a text may have at one pair of lengths
SUBSET, SUBSETS = 5, 1024
#: cutoffs of the rounds before the last: the caller's plus these shares of the rest.
#: difflib's bound is the weaker one, so more of its texts must be done early
ROUNDS = {"levenshtein": (0.3, 0.1), "difflib": (0.5, 0.3, 0.1)}
_EPS = 1e-9


# ------------------------------------------------------------------ difflib

_MARK_A, _MARK_B = "\ue000", "\ue001"


def _popular(b: str) -> set:
    """The characters of a long second text that difflib doesn't start blocks with."""
    if len(b) < 200:
        return set()
    return {c for c in set(b) if b.count(c) > len(b) // 100 + 1}


def matched(a: str, b: str, popular: set | None = None) -> int:
    """Characters in the matching blocks that ``SequenceMatcher(None, a, b)`` finds:
    the longest common block first (the earliest in ``a``, then in ``b``), then the
    same before and behind it. A block is found by growing the best one yet at
    every start of ``a``, by substring searches in ``b``."""
    popular = _popular(b) if popular is None else popular
    # blocks hold no popular characters: two marks that meet nothing stand for them
    core_a, core_b = a, b
    if popular:
        if _MARK_A in b or _MARK_B in a:  # texts that use the marks themselves
            return _matched_by_pairs(a, b, popular)
        core_a = "".join(_MARK_A if c in popular else c for c in a)
        core_b = "".join(_MARK_B if c in popular else c for c in b)
    total, ranges = 0, [(0, len(a), 0, len(b))]
    while ranges:
        alo, ahi, blo, bhi = ranges.pop()
        at, to, size = alo, blo, 0
        i = alo
        while i + size < ahi:
            j = core_b.find(core_a[i:i + size + 1], blo, bhi)
            if j < 0:
                i += 1
                continue
            at, to, size = i, j, size + 1
        if popular:
            at, to, size = _extend(a, b, at, to, size, alo, ahi, blo, bhi)
        if size:
            total += size
            if alo < at and blo < to:
                ranges.append((alo, at, blo, to))
            if at + size < ahi and to + size < bhi:
                ranges.append((at + size, ahi, to + size, bhi))
    return total


def _extend(a, b, at, to, size, alo, ahi, blo, bhi):
    """The block with the popular characters next to it."""
    while at > alo and to > blo and a[at - 1] == b[to - 1]:
        at, to, size = at - 1, to - 1, size + 1
    while at + size < ahi and to + size < bhi and a[at + size] == b[to + size]:
        size += 1
    return at, to, size


def _matched_by_pairs(a: str, b: str, popular: set) -> int:
    """``matched`` by the lengths of all common runs."""
    total, ranges = 0, [(0, len(a), 0, len(b))]
    while ranges:
        alo, ahi, blo, bhi = ranges.pop()
        at, to, size, row = alo, blo, 0, {}
        for i in range(alo, ahi):
            new = {}
            for j in range(blo, bhi):
                if a[i] == b[j] and b[j] not in popular:
                    k = new[j] = row.get(j - 1, 0) + 1
                    if k > size:
                        at, to, size = i - k + 1, j - k + 1, k
            row = new
        at, to, size = _extend(a, b, at, to, size, alo, ahi, blo, bhi)
        if size:
            total += size
            ranges += [(alo, at, blo, to), (at + size, ahi, to + size, bhi)]
    return total


def block_ratio(a: str, b: str, popular: set | None = None) -> float:
    """``SequenceMatcher(None, a, b).ratio()``, bit for bit."""
    n = len(a) + len(b)
    return 2.0 * matched(a, b, popular) / n if n else 1.0


@F.pandas_udf(T.DoubleType())
def difflib_ratio(right: pd.Series, left: pd.Series, cutoff: pd.Series) -> pd.Series:
    """difflib's ratio (``left`` is its second sequence) or NULL when below the
    cutoff."""
    popular: dict[str, set] = {}  # of the long left texts of this batch
    out = []
    for a, b, c in zip(right.tolist(), left.tolist(), cutoff.tolist()):
        if len(b) >= 200 and b not in popular:
            popular[b] = _popular(b)
        r = block_ratio(a, b, popular.get(b, set()))
        out.append(r if r >= c else None)
    return pd.Series(out, dtype="float64")


# ----------------------------------------------------------------- signatures

# the expressions are SQL text: nested lambdas are slow to build call by call

def _tokens(text: str) -> str:
    """The tokens of a text: each character with its number among equal ones."""
    chars = f"array_sort(regexp_extract_all({text}, '(?s).', 0))"
    return f"transform({chars}, (c, i) -> concat(c, cast(i - array_position({chars}, c) + 2 AS string)))"


@dataclass
class Texts:
    """Distinct texts ``t`` of one side with their length ``n`` and tokens ``a``,
    rare tokens first; ``lengths``: the different lengths."""

    rows: DataFrame
    lengths: list[int]


def _sides(left: DataFrame, right: DataFrame) -> tuple[Texts, Texts]:
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = left.select(F.lit("l").alias("side"), F.col("_l").alias("t")).union(right.select(F.lit("r"), "_r"))
    # dealt evenly: a text has up to SUBSETS signatures at every pair of lengths
    both = materialize(both.where(F.col("t").isNotNull()).distinct().repartition(parts, "t")
                       .select("side", "t", F.length("t").alias("n"), F.expr(_tokens("t")).alias("a")), "fuzzy-texts")
    one, two = (both.where(F.col("side") == k).drop("side") for k in "lr")
    # to the driver: as many numbers as texts have lengths, and COMMON_TOKENS tokens
    found = both.select("side", "n").distinct().collect()
    lengths = [sorted(r.n for r in found if r.side == k) for k in "lr"]
    common = two.select(F.explode("a").alias("k")).groupBy("k").count().orderBy(F.desc("count"), "k").limit(COMMON_TOKENS)
    by_rank = "\0".join(r.k for r in reversed(common.collect()))
    rank = F.split(F.lit(by_rank), "\0").alias("r")  # no position: rare
    in_order = F.expr("transform(array_sort(transform(a, k -> struct(array_position(r, k) AS r, k AS k))), x -> x.k)")
    return tuple(Texts(d.select("*", rank).withColumn("a", in_order).drop("r"), n) for d, n in zip((one, two), lengths))


def _shapes(lengths: list[int], method: str, cutoff: float, side: str) -> str:
    """The pairs of lengths (left, right) at which a text of length ``n`` can meet
    one of the other side: (la, lb, m tokens to share, top, the longer length). For
    Levenshtein only the longer length counts; the shorter one is -1."""
    la, lb = ("n", "o") if side == "l" else ("o", "n")
    if method == "difflib":
        m, key = f"({la} + {lb}) * {cutoff / 2!r}D", f"{la} AS la, {lb} AS lb"
    else:
        m = f"greatest(n, o) * {cutoff!r}D"
        key = f"if({la} >= {lb}, {la}, -1) AS la, if({la} >= {lb}, -1, {lb}) AS lb"
    m = f"cast(greatest(ceil({m} - {_EPS!r}D), 0) AS int)"
    met = f"filter(array({', '.join(map(str, lengths))}), o -> least(n, o) >= {m})"
    # by Levenshtein a longer text has one shape for all shorter ones
    return f"array_distinct(transform({met}, o -> struct({key}, {m} AS m, greatest(n, o) AS top)))"


def _subset_size(m: str, top: str) -> str:
    """The largest s such that the longer text has at most SUBSETS s-subsets."""
    size, many = f"least({m}, 1)", f"cast({top} - {m} + 1 AS double)"
    for s in range(2, SUBSET + 1):
        many = f"{many} * ({top} - {m} + {s}) / {s}"
        size = f"if({m} >= {s} AND {many} <= {SUBSETS}, {s}, {size})"
    return size


def _subsets(tokens: str, size: str) -> str:
    """Hashes of the subsets of ``size`` tokens; one for the empty subset. Walks
    over the tokens; ``k`` numbers hold the subsets of k tokens up to here."""
    none = "cast(array() AS array<bigint>)"
    ks = range(1, SUBSET + 1)
    grown = ["concat(acc.k1, array(xxhash64(token))) AS k1"] + [
        f"if({size} >= {k}, concat(acc.k{k}, transform(acc.k{k - 1}, h -> xxhash64(h, token))), {none}) AS k{k}"
        for k in ks[1:]]
    start = ", ".join(f"{none} AS k{k}" for k in ks)
    chosen = " ".join(f"WHEN {k} THEN acc.k{k}" for k in ks)
    return (f"aggregate({tokens}, struct({start}), (acc, token) -> struct({', '.join(grown)}), "
            f"acc -> CASE {size} {chosen} ELSE array(0L) END)")


def _signatures(texts: DataFrame, lengths: list[int], method: str, cutoff: float, side: str) -> DataFrame:
    """t, la, lb, signature, for texts that meet ones of these lengths."""
    met = texts.select("t", "n", "a", F.expr(f"explode({_shapes(lengths, method, cutoff, side)}) AS s"))
    sized = met.selectExpr("t", "n", "a", "s", f"{_subset_size('s.m', 's.top')} AS k")
    first = "slice(a, 1, greatest(n - s.m + k, 0))"  # the tokens one of which must be shared
    return sized.selectExpr(f"t AS _{side}", "s.la", "s.lb", f"explode({_subsets(first, 'k')}) AS signature")


def signature_matches(left: Texts, right: Texts, method: str, cutoff: float) -> DataFrame:
    """(_l, _r) of every pair of texts that share a signature, as often as they do: a
    superset of all pairs that reach the cutoff."""
    if not left.lengths or not right.lengths:
        return left.rows.limit(0).select(F.col("t").alias("_l"), F.col("t").alias("_r"))
    one = _signatures(left.rows, right.lengths, method, cutoff, "l")
    two = _signatures(right.rows, left.lengths, method, cutoff, "r")
    return one.join(two, ["la", "lb", "signature"]).select("_l", "_r")


def candidate_pairs(left: DataFrame, right: DataFrame, method: str, cutoff: float) -> DataFrame:
    """Every pair of ``left._l`` and ``right._r`` whose shared tokens allow the
    cutoff, once, with all columns of both sides."""
    pairs = signature_matches(*_sides(left, right), method, cutoff).distinct()
    return left.join(pairs, "_l").join(right, "_r").select(*left.columns, *right.columns)


def _score(method: str, cutoff: float) -> Column:
    """The score of (_l, _r), NULL below the cutoff."""
    if method == "difflib":
        return difflib_ratio(F.col("_r"), F.col("_l"), F.lit(float(cutoff)))
    mx = F.greatest(F.length("_l"), F.length("_r"))
    # early-exit budget: distances above (1 - cutoff) * max length cannot pass
    d = F.expr(f"levenshtein(_l, _r, CAST(floor((1.0D - {float(cutoff)!r}D) * "
               f"greatest(length(_l), length(_r)) + 1e-9D) AS INT))")
    s = F.when(mx == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.try_divide(d, mx))
    return F.when((d >= 0) & (s >= F.lit(cutoff)), s)


def fuzzy_best_match(left: DataFrame, left_col: str, right: DataFrame, right_col: str, right_id: str,
                     cutoff: float = 0.5, method: str = "difflib", order: str | None = None,
                     how: str = "inner") -> DataFrame:
    """One row per distinct non-null left text with its best right match:
    ``left_col``, ``match_text``, ``right_id``, ``match_score`` (0-100).

    ``order`` picks the "first" id per right text (default: smallest id).
    ``how="left"`` keeps unmatched left texts with NULL match columns."""
    if method not in ROUNDS:
        raise ValueError(f"unknown method {method!r}")
    okey = F.col(order or right_id)
    ids = (right.where(F.col(right_col).isNotNull())
                .groupBy(F.col(right_col).alias("_r"))
                .agg(F.min_by(F.col(right_id), okey).alias("_id")))
    L, R = _sides(left.select(F.col(left_col).alias("_l")), right.select(F.col(right_col).alias("_r")))

    def round_at(texts: DataFrame, c: float) -> DataFrame:
        scored = signature_matches(Texts(texts, L.lengths), R, method, c).distinct().withColumn("_s", _score(method, c))
        passed = F.when(F.col("_s").isNotNull(), F.struct("_s", "_r"))
        return (scored.groupBy("_l").agg(F.max_by(F.struct("_r", "_s"), passed).alias("_b"))
                .where(F.col("_b").isNotNull()).select("_l", "_b._r", "_b._s"))

    found, rest = [], L.rows
    for share in ROUNDS[method] if cutoff < 1 else ():
        found.append(materialize(round_at(rest, cutoff + share * (1 - cutoff)), "fuzzy-round"))
        rest = rest.join(found[-1], rest["t"] == found[-1]["_l"], "left_anti")
    found.append(round_at(rest, cutoff))
    best = reduce(DataFrame.unionByName, found).join(ids, "_r").select(
        F.col("_l").alias(left_col), F.col("_r").alias("match_text"), F.col("_id").alias(right_id),
        (F.col("_s") * F.lit(100.0)).alias("match_score"))
    if how == "left":
        best = L.rows.select(F.col("t").alias(left_col)).join(best, left_col, "left")
    return best
