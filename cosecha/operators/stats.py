"""Distributed statistics (A17-A22): correlation, one-predictor OLS with a
what-if prediction, Welch's t-test, box-plot summaries and Gaussian kernel
densities.

The data pass is always a Spark aggregate (partial + final); fitted models
are one-row DataFrames applied to rows through scalar subqueries, never a
join or a driver round trip. The Welch p-value is an expression over the one-row
summary. No Python runs in tasks."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cosecha.operators.quantile import exact_quantiles


def _complete(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        x = F.col(c).isNotNull() & ~F.isnan(F.col(c))
        cond = x if cond is None else cond & x
    return df.where(cond)


def pearson(df: DataFrame, x: str, y: str, name: str = "corr") -> DataFrame:
    """A17 ``Series.corr``: pairwise-complete rows; NULL (pandas: NaN) when a
    side has zero variance, instead of the ANSI divide-by-zero error."""
    d = _complete(df, x, y)
    return d.agg(F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(name))


def ols_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """A18 least squares ``y = intercept + slope * x`` on complete rows:
    one row (slope, intercept, r2, n). Zero variance in x gives NULL slope."""
    d = _complete(df, x, y)
    return d.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                 F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def _model_col(model: DataFrame) -> Column:
    """The fitted model as a struct-valued scalar subquery (run once)."""
    return model.select(F.struct("slope", "intercept").alias("m")).scalar()


def whatif_predict(df: DataFrame, x: str, y: str, factor: float = 1.2,
                   scaled: str = "x_simulado", pred: str = "y_esperado") -> DataFrame:
    """A19 fit on (x, y), then predict at ``x * factor`` for every complete row."""
    d = _complete(df, x, y)
    m = _model_col(ols_fit(d, x, y))
    xs = F.col(x) * F.lit(factor)
    return d.withColumn(scaled, xs).withColumn(pred, m["intercept"] + m["slope"] * xs)


def whatif_delta(df: DataFrame, x: str, y: str, factor: float = 1.2, name: str = "delta") -> DataFrame:
    """A19 ``mean(prediction at x*factor) - mean(y)``, one row."""
    p = whatif_predict(df, x, y, factor, "_xs", "_pred")
    return p.agg((F.avg("_pred") - F.avg(y)).alias(name))


def welch_summary(df: DataFrame, value: str, in_a: Column, in_b: Column, min_n: int = 0) -> DataFrame:
    """A20 data pass of Welch's unequal-variance t-test between the rows where
    ``in_a`` holds and the rows where ``in_b`` holds (NULL values omitted): n,
    mean and variance per side, t and the Welch-Satterthwaite degrees of
    freedom, in one conditional aggregate. With ``n <= min_n`` on either side
    t/dof are NULL (the ``len > 2`` guard)."""
    v = F.col(value)
    d = df.where(v.isNotNull() & ~F.isnan(v))
    ina, inb = F.coalesce(in_a, F.lit(False)), F.coalesce(in_b, F.lit(False))
    s = d.agg(F.count_if(ina).alias("n_a"), F.count_if(inb).alias("n_b"),
              F.avg(F.when(ina, v)).alias("mean_a"), F.avg(F.when(inb, v)).alias("mean_b"),
              F.var_samp(F.when(ina, v)).alias("var_a"), F.var_samp(F.when(inb, v)).alias("var_b"))
    se_a = F.col("var_a") / F.col("n_a")
    se_b = F.col("var_b") / F.col("n_b")
    ok = (F.col("n_a") > F.lit(min_n)) & (F.col("n_b") > F.lit(min_n))
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(se_a + se_b))
    dof = F.try_divide((se_a + se_b) * (se_a + se_b),
                       se_a * se_a / (F.col("n_a") - 1) + se_b * se_b / (F.col("n_b") - 1))
    return s.withColumn("t", F.when(ok, t)).withColumn("dof", F.when(ok, dof))


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularised incomplete beta (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    """I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    """Two-sided p of Student's t: I_{dof/(dof+t^2)}(dof/2, 1/2)."""
    if t is None or dof is None or not math.isfinite(dof) or dof <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc_reg(dof / 2.0, 0.5, dof / (dof + t * t))


def t_pvalue(t: Column, dof: Column) -> Column:
    """Two-sided p of Student's t as one expression (no Python at run time):
    I_x(a, b) with x = dof / (dof + t^2), a = dof / 2, b = 1/2, by the continued
    fraction of ``_betacf``, a fold of fixed length over its terms, on the side where
    it converges. NULL without t or with dof not above 0."""
    a, b = dof / 2.0, F.lit(0.5)
    tt = t * t
    x, y = F.try_divide(dof, dof + tt), F.try_divide(tt, dof + tt)
    # ln Gamma(a + 1/2) - ln Gamma(a): moved up by 20 steps, where the series has full precision
    up = a + 20.0
    rise = reduce(lambda acc, k: acc + F.log((a + k) / (a + (k + 0.5))), map(float, range(20)), F.lit(0.0))
    far = (0.5 * F.log(up) - 1 / (8.0 * up) + 1 / (192.0 * F.pow(up, F.lit(3.0))) - 1 / (640.0 * F.pow(up, F.lit(5.0)))
           + 17 / (14336.0 * F.pow(up, F.lit(7.0))))
    front = F.exp(rise + far - 0.5 * math.log(math.pi) - a * F.log1p(tt / dof) + b * F.log(y))
    direct = x < (a + 1.0) / (a + b + 2.0)
    pick = F.struct(*[F.when(direct, u).otherwise(v).alias(n) for n, u, v in (("a", a, b), ("b", b, a), ("x", x, y))])

    def tiny(v):
        return F.when(F.abs(v) > 1e-300, v).otherwise(F.lit(1e-300))

    def fraction(q):
        qa, qb, qx = q["a"], q["b"], q["x"]
        d0 = 1 / tiny(1 - (qa + qb) * qx / (qa + 1))

        def half(s, aa):
            # a struct in an array, so that each value is worked out once
            return F.transform(F.array(F.struct((1 / tiny(1 + aa * s["d"])).alias("d"), tiny(1 + aa / s["c"]).alias("c"),
                                                s["h"].alias("h"))),
                               lambda n: F.struct(n["c"].alias("c"), n["d"].alias("d"), (n["h"] * n["c"] * n["d"]).alias("h")))[0]

        def step(s, m):
            even = m * (qb - m) * qx / ((qa - 1 + 2 * m) * (qa + 2 * m))
            odd = -(qa + m) * (qa + qb + m) * qx / ((qa + 2 * m) * (qa + 1 + 2 * m))
            return F.transform(F.array(half(s, even)), lambda n: half(n, odd))[0]

        start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))
        return F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(399)), lambda m: m.cast("double")), start, step,
                           lambda s: s["h"] / qa)

    value = front * F.transform(F.array(pick), fraction)[0]
    p = F.when(direct, value).otherwise(1 - value)
    inside = F.when(t == 0, F.lit(1.0)).when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(p)
    return F.when(t.isNotNull() & ~F.isnan(t) & (dof > 0) & (dof < float("inf")), inside)


def welch_ttest(df: DataFrame, value: str, in_a: Column, in_b: Column, min_n: int = 0) -> DataFrame:
    """A20 Welch t-test, one row: the summary plus the two-sided ``p``."""
    s = welch_summary(df, value, in_a, in_b, min_n)
    return s.withColumn("p", t_pvalue(F.col("t"), F.col("dof")))


def box_stats(df: DataFrame, group: str, value: str, whis: float = 1.5) -> DataFrame:
    """A21 box-plot numbers per group: quartiles (linear), IQR, whiskers at
    the furthest data point inside ``whis * IQR`` of the box, outlier count.

    Quartiles come from the distributed exact quantile operator; they are
    joined back to the rows by group key (one row per group) and a second
    aggregate finds the whiskers."""
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    q = exact_quantiles(d, value, [0.25, 0.5, 0.75], by=[group], out="_q")
    q = q.select(group, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - F.lit(whis) * F.col("iqr")
    hi = F.col("q3") + F.lit(whis) * F.col("iqr")
    v = F.col(value)
    j = d.select(group, value).join(q, group)
    return (j.groupBy(group, "q1", "median", "q3", "iqr")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.min(F.when(v >= lo, v)).alias("whisker_low"),
                  F.max(F.when(v <= hi, v)).alias("whisker_high"),
                  F.count_if((v < lo) | (v > hi)).alias("n_outliers")))


#: width of a box in units of sqrt(2) h, Hermite terms, and reach in the same units.
#: With a value at most BOX / 2 from its box's centre, the terms from TERMS on sum to
#: less than 1.09 * sum((BOX / 2 * sqrt 2)^k / sqrt k!) < 1e-18 of a value's share
#: (Cramer's bound of the Hermite functions), and a box beyond REACH adds less than
#: exp(-REACH^2 / 2) < 1e-21 of it
BOX, TERMS, REACH = 0.5, 20, 10.0


def density_by_group(df: DataFrame, group: str, value: str, grid: int = 100, cut: float = 2.0,
                     bw_factor: float | None = None) -> DataFrame:
    """A22 Gaussian kernel density per group on an even grid (what a violin
    draws). Bandwidth ``h = std * n^(-1/5)`` (Scott) unless ``bw_factor``
    replaces ``n^(-1/5)``; grid of ``grid`` points from ``min - cut*h`` to
    ``max + cut*h``.

    A fast Gauss transform: a second scan folds each value into the moments of
    its box (BOX * sqrt(2) h wide), the first TERMS coefficients of the Hermite
    series of its kernel around the box's centre; the series of the boxes within
    reach of a grid point are summed there. What is shuffled is boxes (as many as
    the range holds bandwidths) and their pairs with grid points, whatever the
    number of values; the error is bounded above. Groups with fewer than two points
    or zero spread have no bandwidth and are left out."""
    d = df.where(F.col(group).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value))).select(group, value)
    stats = d.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(value).alias("_sd"),
                                 F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    fac = F.lit(bw_factor) if bw_factor is not None else F.pow(F.col("n").cast("double"), F.lit(-0.2))
    stats = stats.withColumn("h", F.col("_sd") * fac).where(F.col("h") > 0)
    stats = stats.select(group, "n", "h", "_mn", (F.col("_mn") - F.lit(cut) * F.col("h")).alias("_lo"),
                         ((F.col("_mx") - F.col("_mn") + F.lit(2 * cut) * F.col("h")) / F.lit(grid - 1)).alias("_step"))

    width = F.col("h") * F.lit(BOX * math.sqrt(2))
    boxed = d.join(stats.select(group, "h", "_mn"), group).withColumn("_b", F.floor((F.col(value) - F.col("_mn")) / width))
    off = (F.col(value) - F.col("_mn")) / width - F.col("_b") - F.lit(0.5)
    power, moments = F.lit(1.0), []
    u = F.col("_u")
    for k in range(TERMS):
        moments.append(F.sum(power).alias(f"_m{k}"))
        power = power * u / F.lit(float(k + 1))
    boxes = boxed.withColumn("_u", off * F.lit(BOX)).groupBy(group, "_b").agg(*moments)

    # grid points within reach of a box
    j = boxes.join(stats, group)
    centre = F.col("_mn") + (F.col("_b") + F.lit(0.5)) * width
    far = F.col("h") * F.lit(REACH * math.sqrt(2))
    lo = F.greatest(F.ceil((centre - far - F.col("_lo")) / F.col("_step")), F.lit(0))
    hi = F.least(F.floor((centre + far - F.col("_lo")) / F.col("_step")), F.lit(grid - 1))
    coefs = F.array(*[F.col(f"_m{k}") for k in reversed(range(TERMS))])
    j = j.select(group, "n", "h", "_lo", "_step", centre.alias("_x0"), coefs.alias("_m"), lo.alias("_i0"), hi.alias("_i1"))
    j = j.where(F.col("_i0") <= F.col("_i1")).select(
        group, "n", "h", "_lo", "_step", "_x0", "_m", F.explode(F.sequence("_i0", "_i1")).alias("i"))
    x = F.col("_lo") + F.col("i") * F.col("_step")
    j = j.withColumn("_t", (x - F.col("_x0")) / (F.col("h") * F.lit(math.sqrt(2))))
    # the series by its recurrence, from the last coefficient down
    start = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit(float(TERMS)).alias("k"))
    series = F.aggregate("_m", start, lambda s, m: F.struct(
        (m + F.lit(2.0) * F.col("_t") * s["a"] - F.lit(2.0) * s["k"] * s["b"]).alias("a"), s["a"].alias("b"),
        (s["k"] - F.lit(1.0)).alias("k")), lambda s: s["a"])
    share = series * F.exp(-F.col("_t") * F.col("_t"))
    sums = j.groupBy(group, "i").agg(F.sum(share).alias("_s"))
    # points that no box reaches have density zero
    points = stats.select(group, "n", "h", "_lo", "_step", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return points.join(sums, [group, "i"], "left").select(
        group, F.col("i").cast("int").alias("i"), x.alias("x"),
        (F.greatest(F.coalesce("_s", F.lit(0.0)), F.lit(0.0)) / norm).alias("density"))
