"""Fuzzy best-match scaling: 1x / 4x / 16x distinct product names (derived
from ``part``: type + name + a size-derived variant token) against the food
descriptions, difflib scorer, median of 3 warm runs.

usage: python tools/fuzzy_scaling.py [sf_dir]
"""
import json
import statistics
import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from cosecha import adapters as A, get_session  # noqa: E402
from cosecha.functions.text import normalize_text  # noqa: E402
from cosecha.operators.fuzzy import fuzzy_best_match  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    part = A.table(spark, sf, "part")
    foods = A.food(spark, sf).select("fdc_id", F.lower("description").alias("d"))
    out = {}
    for k in (1, 4, 16):
        variant = F.lit("") if k == 1 else F.concat(F.lit(" v"), (F.col("p_size") % k).cast("string"))
        prods = part.select(normalize_text(F.concat(F.lower("p_type"), F.lit(" "), F.col("p_name"), variant))
                            .alias("p")).distinct()
        n = prods.count()
        q = fuzzy_best_match(prods, "p", foods, "d", "fdc_id")
        q.write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(3):
            t = time.perf_counter()
            q.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        out[f"{k}x"] = {"products": n, "sec": round(statistics.median(runs), 3)}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
