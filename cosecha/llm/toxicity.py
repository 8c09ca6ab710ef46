"""Toxicity (operator 8): gradient-boosted trees over dense features with
isotonic calibration.

1. A bounded sample of the labelled rows (``sample_rows``, by a hash of the id)
   whose ``crc32(doc_id)`` modulo ``folds`` is not 0 is split by hash into three
   parts: one for the lexicon, one for the trees, one for the calibration.
2. Lexicon: words and word beginnings that documents labelled toxic hold far
   more often (log odds with smoothing), at most ``lexicon_size`` of them.
3. Dense features of a whole text: lexicon densities, distance of second-person
   words to lexicon words, capitals, punctuation, obfuscation (symbols or
   digits inside words, letters set apart) and what such words read as.
4. MLlib gradient-boosted trees, then isotonic regression of the label on their
   probability. Only the fit sees the sample; every document is scored, in
   place, without a shuffle.

Defined cases: a null text counts as empty; an empty text gets the score of
all-zero features; ties and repeated rows get equal scores; without labels of
both kinds all scores are the share of toxic labels (0 without labels); a null
``doc_id`` is scored and counts as not held out; an empty table gives no rows;
all columns of the input are kept, those named like an output are replaced.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.llm.common import prepare, store

#: labelled rows used for fitting (all when there are fewer)
SAMPLE_ROWS = 20_000
LEXICON_SIZE = 1000
FOLDS = 5
TREES, DEPTH = 30, 4
#: lengths of the word beginnings that may enter the lexicon
BEGINNINGS = (4, 5, 6)
SECOND_PERSON = {"you", "your", "yours", "yourself", "u", "ur", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre",
                 "vos", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "euer", "ti", "usted", "ustedes", "tus",
                 "eres", "vosotros"}
#: symbols and digits that stand for letters
READS_AS = str.maketrans("013457@$!|", "oieastasii", "*_.-'")

_KEEP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_MIXED = re.compile(r"[^\W\d_]+(?:[\d@$!|*_.'-]+[^\W\d_]+)+")
_APART = re.compile(r"\b(?:[^\W\d_][ .*_-]){3,}[^\W\d_]\b")
_CAPS = bytes(range(0x41, 0x5B))
_PUNCT = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
_DIGITS = b"0123456789"

FEATURES = ("lexicon_density", "lexicon_hits", "lexicon_distinct", "lexicon_weight", "lexicon_strongest",
            "person_density", "person_near", "capitals", "capital_words", "exclamations", "punctuation", "digits",
            "mixed_rate", "apart_rate", "obfuscated_hits", "words")


def held_out(doc_id: F.Column, folds: int = FOLDS) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The dense features of one text."""
    text = text or ""
    low = text.lower()
    raw = text.encode("utf-8", "surrogatepass")
    words = low.encode("utf-8", "surrogatepass").translate(_KEEP).decode("utf-8", "surrogatepass").split()
    n, chars = len(words), max(1, len(raw))

    def weight(w: str) -> float:
        best = lexicon.get(w, 0.0)
        for k in BEGINNINGS:
            if len(w) > k:
                best = max(best, lexicon.get(w[:k] + "*", 0.0))
        return best

    distinct = set(words)
    bad = {w: s for w in distinct if (s := weight(w))}
    hits = [i for i, w in enumerate(words) if w in bad] if bad else []
    person = [i for i, w in enumerate(words) if w in SECOND_PERSON] if distinct & SECOND_PERSON else []
    near = 0.0
    if hits and person:
        p = np.array(person)
        j = np.searchsorted(p, hits)
        gap = np.minimum(np.abs(p[np.minimum(j, len(p) - 1)] - hits), np.abs(p[np.maximum(j - 1, 0)] - hits))
        near = float((1.0 / gap).sum())
    count = lambda drop: len(raw) - len(raw.translate(None, drop))
    mixed = _MIXED.findall(low)
    apart = _APART.findall(low)
    hidden = sum(1 for m in mixed if weight(m.translate(READS_AS))) + \
        sum(1 for m in apart if weight(re.sub(r"[ .*_-]", "", m)))
    per = 1.0 / max(1, n)
    return [len(hits) * per, math.log1p(len(hits)), float(len(bad)), sum(bad[words[i]] for i in hits) * per,
            max(bad.values(), default=0.0), len(person) * per, near, count(_CAPS) / chars,
            sum(1 for w in text.split() if len(w) > 2 and w.isupper()) * per, raw.count(b"!") / chars,
            count(_PUNCT) / chars, count(_DIGITS) / chars, len(mixed) * per, len(apart) * per, float(hidden),
            math.log1p(n)]


def learn_lexicon(train: DataFrame, size: int = LEXICON_SIZE, least_odds: float = 1.5) -> dict[str, float]:
    """Key -> log odds. ``train``: text, toxic. Keys are words and beginnings
    (``abcd*``); each counts once a document."""
    word = F.filter(F.split(F.lower("text"), r"[\x00-/:-`{-\x7F]+"), lambda w: F.length(w) > 2)
    keys = F.array_distinct(F.concat(word, *[
        F.transform(F.filter(word, lambda w, k=k: F.length(w) > k), lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("*")))
        for k in BEGINNINGS]))
    n = train.agg(F.sum("toxic"), F.count("*")).first()
    toxic, clean = int(n[0] or 0), int(n[1] - (n[0] or 0))
    if not toxic or not clean:
        return {}
    odds = F.log((F.col("p") + 0.5) / (F.col("a") - F.col("p") + 2.0)) - math.log(toxic / clean)
    top = (train.select("toxic", F.explode(keys).alias("key")).groupBy("key")
           .agg(F.sum("toxic").alias("p"), F.count("*").alias("a"))
           .where(F.col("p") >= max(3, math.ceil(toxic / 200)))
           .select("key", "p", odds.alias("odds")).where(F.col("odds") >= least_odds)
           .orderBy(F.desc(F.col("odds") * F.sqrt("p")), "key").limit(size))
    return {r["key"]: float(r["odds"]) for r in top.collect()}


class ToxicityModel:
    """``score(docs)`` adds held_out, score and predicted."""

    def __init__(self, lexicon, trees, isotonic, constant=0.0):
        self.lexicon, self.trees, self.isotonic, self.constant = lexicon, trees, isotonic, constant

    def _vectors(self, docs: DataFrame, text_col: str) -> DataFrame:
        lexicon = self.lexicon

        @F.pandas_udf("array<double>")
        def dense(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: features(t if isinstance(t, str) else None, lexicon))

        # not deterministic: never computed twice for a filter and its output
        return docs.withColumn("__tox_x", array_to_vector(dense.asNondeterministic()(F.col(text_col))))

    def _raw(self, docs: DataFrame, text_col: str) -> DataFrame:
        out = self.trees.transform(self._vectors(docs, text_col))
        return out.withColumn("__tox_p", vector_to_array("__tox_probability")[1])

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS) -> DataFrame:
        prepare(docs.sparkSession)
        if self.trees is None:
            out = docs.withColumn("score", F.lit(float(self.constant)))
        else:
            # the calibrated score; inside one of its steps the trees' order stays
            out = self.isotonic.transform(self._raw(docs, text_col)).withColumn(
                "score", F.col("__tox_iso") * 0.999 + F.col("__tox_p") * 0.001)
            out = out.drop(*[c for c in out.columns if c.startswith("__tox_")])
        return out.withColumn("held_out", held_out(F.col(id_col), folds)) \
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, lexicon_size: int = LEXICON_SIZE,
        folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learn from the labelled rows outside the held-out fold."""
    spark = prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic")) \
        .where(F.col("toxic").isin(0, 1) & F.col("__id").isNotNull() & ~held_out(F.col("__id"), folds))
    share = min(1.0, sample_rows / max(1, known.count()))
    pick = F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000)
    known = known.where(pick)
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text")).join(known, "__id")
    rows = store(rows.select("text", "toxic", F.pmod(F.xxhash64("__id", F.lit("part")), F.lit(10)).alias("part")),
                 "labelled")
    n = rows.agg(F.count("*"), F.sum("toxic")).first()
    rate = float(n[1] or 0) / max(1, n[0])
    lexicon = learn_lexicon(rows.where(F.col("part") < 5), lexicon_size)
    model = ToxicityModel(lexicon, None, None, rate)
    if not 0 < rate < 1:
        return model
    x = store(model._vectors(rows.where(F.col("part") >= 5), "text").select(
        "__tox_x", F.col("toxic").cast("double").alias("__tox_y"), "part"), "features")
    grow, check = x.where(F.col("part") < 8), x.where(F.col("part") >= 8)
    if grow.select("__tox_y").distinct().count() < 2 or check.limit(1).count() == 0:
        return model
    gbt = GBTClassifier(featuresCol="__tox_x", labelCol="__tox_y", predictionCol="__tox_c", maxIter=TREES,
                        maxDepth=DEPTH, seed=7, stepSize=0.2)
    model.trees = gbt.fit(grow.drop("part").coalesce(spark.sparkContext.defaultParallelism)) \
        .setRawPredictionCol("__tox_r").setProbabilityCol("__tox_probability")
    scored = model.trees.transform(check).withColumn("__tox_p", vector_to_array("__tox_probability")[1])
    model.isotonic = IsotonicRegression(featuresCol="__tox_p", labelCol="__tox_y", predictionCol="__tox_iso") \
        .fit(scored.select("__tox_p", "__tox_y"))
    return model
