"""Survival analysis as Spark aggregates.

Data reduction first: every estimator here only needs per-(group, duration)
counts or per-duration sums, which are partial aggregates (a duration that
holds a third of all rows is one row per map task).  Running sums over the
duration order use ``global_running_sum`` or, in the Cox fit, slices of the order
that are fixed once.  Only the p×p Newton system is solved on the driver.

Published definitions are followed where the reference relied on a library
whose source is not in the reference (SURVEY §7.4):
* Kaplan–Meier with Greenwood variance and the log(−log) ("exponential
  Greenwood") 95% band;
* log-rank χ² with one degree of freedom, p = erfc(√(χ²/2));
* Cox PH with Efron (default) or Breslow ties, covariates standardised (mean, sample std),
  objective ℓ(β)/n − (λ/2)‖β‖² on the standardised scale, coefficients and
  standard errors reported on the original scale;
* Harrell's C with the comparable-pair rule of the usual concordance index
  (a death before a later exit, or a death and a censoring at the same time;
  prediction ties count ½).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stable
from .ranking import global_running_sum

Z95 = 1.959963984540054


@F.pandas_udf(T.DoubleType())
def erfc_udf(x):
    """Complementary error function over a (small) result column."""
    return x.map(lambda v: math.erfc(v) if v == v else float("nan"))


# ------------------------------------------------------------------ E5


def kaplan_meier(df: DataFrame, duration: str, event: str, group: str | None = None) -> DataFrame:
    """E5: S(t) per group at every distinct observed duration, with the
    number at risk, events, censorings, Greenwood sum and the 95% band."""
    keys = [group] if group else []
    t = F.col(duration).cast("double")
    e = F.col(event).cast("int")
    counts = stable(df.groupBy(*[F.col(k) for k in keys], t.alias("t")).agg(
        F.count(F.lit(1)).alias("removed"), F.sum(e).cast("bigint").alias("events")))
    safe = F.col("events") < F.col("at_risk")
    # at risk at t = group size − removed strictly before t
    r = global_running_sum(counts, [F.asc("t")], {"removed_before": F.col("removed")},
                           partition_by=keys or None, exclusive=True)
    sizes = counts.groupBy(*keys).agg(F.sum("removed").alias("__size"))
    r = (r.join(sizes, keys) if keys else r.withColumn("__size", counts.select(F.sum("removed")).scalar()))
    r = r.withColumn("at_risk", F.col("__size") - F.col("removed_before"))
    r = r.withColumns({
        "__nlog": F.when(safe, -F.log1p(-F.col("events") / F.col("at_risk"))).otherwise(F.lit(0.0)),
        "__zero": F.when(safe, F.lit(0)).otherwise(F.lit(1)),
        "__gw": F.when(safe, F.col("events") / (F.col("at_risk") * (F.col("at_risk") - F.col("events"))))
                 .otherwise(F.lit(0.0)),
    })
    r = global_running_sum(r, [F.asc("t")],
                           {"__cl": F.col("__nlog"), "__cz": F.col("__zero"), "greenwood": F.col("__gw")},
                           partition_by=keys or None)
    s = F.when(F.col("__cz") > 0, F.lit(0.0)).otherwise(F.exp(-F.col("__cl")))
    r = r.withColumn("survival", s)
    lv = F.log(F.col("survival"))
    ok = (F.col("survival") > 0) & (F.col("survival") < 1)
    half = F.lit(Z95) * F.sqrt(F.col("greenwood")) / lv
    return r.select(*keys, "t", "at_risk", "events", (F.col("removed") - F.col("events")).alias("censored"),
                    "survival", "greenwood",
                    F.when(ok, F.exp(-F.exp(F.log(-lv) - half))).alias("ci_lower"),
                    F.when(ok, F.exp(-F.exp(F.log(-lv) + half))).alias("ci_upper"))


# ------------------------------------------------------------------ E6


def logrank(df: DataFrame, duration: str, event: str, group: str, a, b) -> DataFrame:
    """Two-group log-rank test (groups ``a`` and ``b`` of ``group``)."""
    t = F.col(duration).cast("double")
    e = F.col(event).cast("int")
    sub = df.where(F.col(group).isin(a, b)).select(
        t.alias("t"), e.alias("e"), (F.col(group) == F.lit(a)).cast("int").alias("in_a"))
    per = stable(sub.groupBy("t").agg(
        F.count(F.lit(1)).alias("rem"), F.sum("in_a").alias("rem_a"),
        F.sum("e").alias("d"), F.sum(F.col("e") * F.col("in_a")).alias("d_a")))
    per = global_running_sum(per, [F.asc("t")], {"before": F.col("rem"), "before_a": F.col("rem_a")},
                             exclusive=True)
    n_tot = per.select(F.sum("rem")).scalar()
    na_tot = per.select(F.sum("rem_a")).scalar()
    n = n_tot - F.col("before")
    na = na_tot - F.col("before_a")
    per = per.withColumns({"__n": n, "__na": na})
    exp_a = F.col("d") * F.col("__na") / F.col("__n")
    var = F.when(F.col("__n") > 1, F.col("d") * (F.col("__na") / F.col("__n"))
                 * (1 - F.col("__na") / F.col("__n")) * (F.col("__n") - F.col("d"))
                 / (F.col("__n") - 1)).otherwise(F.lit(0.0))
    out = per.agg(F.sum("d_a").cast("double").alias("observed_a"), F.sum(exp_a).alias("expected_a"),
                  F.sum(var).alias("variance"))
    out = out.withColumn("chi2", F.pow(F.col("observed_a") - F.col("expected_a"), 2) / F.col("variance"))
    return out.select(F.lit(str(a)).alias("group_a"), F.lit(str(b)).alias("group_b"), "observed_a",
                      "expected_a", "variance", "chi2",
                      erfc_udf(F.sqrt(F.col("chi2") / 2)).alias("p_value"))


# ------------------------------------------------------------------ E7


EFRON_CHUNK = 65536


def _efron_series(times: DataFrame) -> DataFrame:
    """For every row (t, c, d): Σ_{l<d} log(c−l), Σ 1/(c−l), Σ 1/(c−l)².
    The l-ranges are exploded in chunks that are spread over tasks, so a
    time with very many tied events is not one task's work."""
    last_chunk = F.expr(f"(d - 1) div {EFRON_CHUNK}")
    ch = times.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    ch = ch.repartition("t", "k")
    lo = F.col("k") * F.lit(EFRON_CHUNK)
    hi = F.least(F.col("d"), lo + F.lit(EFRON_CHUNK)) - F.lit(1)
    terms = (ch.select("t", "c", F.explode(F.sequence(lo, hi)).alias("l"))
             .select("t", (F.col("c") - F.col("l").cast("double")).alias("x")))
    return terms.groupBy("t").agg(F.sum(F.log("x")).alias("l0"), F.sum(1.0 / F.col("x")).alias("h1"),
                                  F.sum(1.0 / (F.col("x") * F.col("x"))).alias("h2"))


def _summed_from(per: DataFrame, names: list) -> DataFrame:
    """``names`` of ``per`` (a row per time ``t``, in slices ``p`` of the time
    order) replaced by their sums over all times from ``t`` on.  A window sums
    inside each slice, one row of totals per slice adds the later slices."""
    later = Window.orderBy(F.desc("q")).rowsBetween(Window.unboundedPreceding, -1)
    totals = per.groupBy(F.col("p").alias("q")).agg(*[F.sum(c).alias(f"o_{c}") for c in names])
    offsets = totals.select("q", *[F.coalesce(F.sum(f"o_{c}").over(later), F.lit(0.0)).alias(f"o_{c}")
                                   for c in names])  # as many rows as slices
    here = Window.partitionBy("p").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = per.withColumns({c: F.sum(c).over(here) for c in names})
    return local.join(F.broadcast(offsets), F.col("p") == F.col("q")).select(
        *[c for c in per.columns if c not in names], *[(F.col(c) + F.col(f"o_{c}")).alias(c) for c in names])


def cox_fit(df: DataFrame, duration: str, event: str, covariates, penalizer: float = 0.1,
            max_iter: int = 50, tol: float = 1e-9, ties: str = "efron", strict: bool = True):
    """Penalised Cox proportional-hazards fit, Efron (default) or
    Breslow handling of tied event times.

    The distinct durations are put into contiguous slices of their order once.
    Each evaluation of the likelihood first reduces the rows to one row per
    duration, partly on the map side: Σe^{xβ}, Σx·e^{xβ}, Σxxᵀ·e^{xβ} over all
    rows and over the events.  Risk-set sums are prefix sums of these vectors
    over the slices (``_summed_from``).  One aggregate then adds up what the
    event times give to the log-likelihood, gradient and Hessian, so that one
    row of p×p size reaches the driver, whatever the number of durations.
    Efron's per-event-time sums over l = 0..d−1 reduce to three scalar series in
    c = d·S0/D0 (see ``_efron_series``); Breslow's form is the same expression
    with D0 = 1, D1 = D2 = 0 and d equal terms.

    Rows with a null or NaN in the duration, event or a covariate take no part.
    Returns a dict with the coefficient table (DataFrame), the fitted
    arrays needed by ``baseline_hazard`` / scoring and ``converged``.  A fit
    that is not done after ``max_iter`` steps, or finds no step that keeps the
    objective, raises; with ``strict=False`` it is returned with
    ``converged`` False."""
    spark = df.sparkSession
    cov = list(covariates)
    p = len(cov)
    base = df.select(F.col(duration).cast("double").alias("t"), F.col(event).cast("int").alias("e"),
                     *[F.col(c).cast("double").alias(c) for c in cov]).na.drop()
    base = stable(base)
    one = range(p)
    two = [(i, j) for i in one for j in range(i, p)]
    mom = base.agg(F.count(F.lit(1)).alias("n"),
                   *[F.avg(c).alias(f"m_{c}") for c in cov],
                   *[F.stddev_samp(c).alias(f"s_{c}") for c in cov]).first()
    n = mom["n"]
    mean = np.array([mom[f"m_{c}"] for c in cov])
    std = np.array([mom[f"s_{c}"] or 1.0 for c in cov])
    std[std == 0] = 1.0
    z = [((F.col(c) - float(mean[i])) / float(std[i])) for i, c in enumerate(cov)]
    zdf = stable(base.select("t", "e", *[z[i].alias(f"z{i}") for i in one]))
    times = stable(zdf.select("t").distinct().repartitionByRange("t").withColumn("p", F.spark_partition_id()))
    of_events = zdf.agg(*[F.sum(F.col("e") * F.col(f"z{i}")).alias(f"x{i}") for i in one]).first()
    dx = np.array([of_events[f"x{i}"] or 0.0 for i in one])
    beta = np.zeros(p)
    lam = penalizer
    efron = ties == "efron"

    def newton_terms(b):
        w = F.exp(sum((F.lit(float(b[i])) * F.col(f"z{i}") for i in one), F.lit(0.0)))
        moments = {"0": w, **{f"1_{i}": w * F.col(f"z{i}") for i in one},
                   **{f"2_{i}_{j}": w * F.col(f"z{i}") * F.col(f"z{j}") for i, j in two}}
        aggs = [F.sum(v).alias(f"s{k}") for k, v in moments.items()]
        if efron:
            aggs += [F.sum(F.col("e") * v).alias(f"d{k}") for k, v in moments.items()]
        per = zdf.groupBy("t").agg(F.sum("e").alias("d"), *aggs)
        risk = _summed_from(stable(per.join(times, "t")), [f"s{k}" for k in moments]).where("d > 0")
        c = F.col("d") * F.col("s0") / (F.col("d0") if efron else F.lit(1.0))
        risk = risk.withColumn("c", c)
        if efron:
            risk = risk.join(_efron_series(risk.select("t", "c", "d")), "t")
        else:
            risk = risk.withColumns({"l0": F.col("d") * F.log("c"), "h1": F.col("d") / F.col("c"),
                                     "h2": F.col("d") / (F.col("c") * F.col("c"))})
        tied = (lambda k: F.col(f"d{k}")) if efron else (lambda k: F.lit(1.0 if k == "0" else 0.0))
        risk = risk.withColumns({"r": F.col("s0") / tied("0"), "f": F.col("d") / tied("0")})
        risk = risk.withColumns({f"a{i}": F.col(f"s1_{i}") - F.col("r") * tied(f"1_{i}") for i in one})
        d, f, h1, h2 = (F.col(k) for k in ("d", "f", "h1", "h2"))

        def hess_term(i, j):
            ai, aj, ti, tj = F.col(f"a{i}"), F.col(f"a{j}"), tied(f"1_{i}"), tied(f"1_{j}")
            spread = F.col(f"s2_{i}_{j}") - F.col("r") * tied(f"2_{i}_{j}")
            outer = ai * aj * h2 + (ai * tj + ti * aj) * h1 / d + ti * tj / d
            return F.sum(f * f * outer - f * (spread * h1 + tied(f"2_{i}_{j}"))).alias(f"h{i}_{j}")

        out = risk.agg(F.sum(F.col("l0") - d * F.log(f)).alias("ll"),
                       *[F.sum(f * (F.col(f"a{i}") * h1 + tied(f"1_{i}"))).alias(f"g{i}") for i in one],
                       *[hess_term(i, j) for i, j in two]).first()
        h = np.zeros((p, p))
        for i, j in two:
            h[i, j] = h[j, i] = out[f"h{i}_{j}"] or 0.0
        return b @ dx - (out["ll"] or 0.0), dx - np.array([out[f"g{i}"] or 0.0 for i in one]), h

    ll_prev, converged = None, False
    ll, g, h = newton_terms(beta)
    for _ in range(max_iter):
        obj = ll / n - 0.5 * lam * beta @ beta
        grad = g / n - lam * beta
        hess = h / n - lam * np.eye(p)
        step = np.linalg.solve(hess, grad)
        new = beta - step
        # step halving keeps the objective from decreasing
        for _h in range(20):
            tried = newton_terms(new)
            if tried[0] / n - 0.5 * lam * new @ new >= obj - 1e-12:
                break
            new = beta - step / (2 ** (_h + 1))
        else:
            # no step gains: done if the full one promises less than the tolerance
            converged = bool(abs(grad @ step) / 2 < tol)
            break
        beta, (ll, g, h) = new, tried  # the accepted step's evaluation serves the next one
        if ll_prev is not None and abs(obj - ll_prev) < tol:
            converged = True
            break
        ll_prev = obj
    if strict and not converged:
        raise RuntimeError(f"Cox fit has not converged (at most {max_iter} steps, tolerance {tol})")
    info = -(h - n * lam * np.eye(p))
    cov_m = np.linalg.inv(info)
    se_std = np.sqrt(np.diag(cov_m))
    coef = beta / std
    se = se_std / std
    zval = coef / se
    pv = [math.erfc(abs(v) / math.sqrt(2)) for v in zval]
    table = spark.createDataFrame(
        [(c, float(coef[i]), float(math.exp(coef[i])), float(se[i]), float(zval[i]), float(pv[i]))
         for i, c in enumerate(cov)],
        "covariate string, coef double, hazard_ratio double, se double, z double, p double")
    return {"summary": table, "beta_std": beta, "mean": mean, "std": std, "coef": coef,
            "covariates": cov, "log_likelihood": ll, "zdf": zdf, "converged": converged}


def hazard_report(summary: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Significant covariates with the direction of their effect."""
    return summary.where(F.col("p") < alpha).withColumn(
        "direction", F.when(F.col("hazard_ratio") > 1, F.lit("increases risk"))
        .otherwise(F.lit("decreases risk")))


def baseline_hazard(fit: dict) -> DataFrame:
    """Breslow baseline cumulative hazard H0(t) at the mean covariate
    vector, one row per distinct duration (≤ distinct durations rows)."""
    zdf, b, p = fit["zdf"], fit["beta_std"], len(fit["covariates"])
    eta = sum((F.lit(float(b[i])) * F.col(f"z{i}") for i in range(p)), F.lit(0.0))
    per = zdf.groupBy("t").agg(F.sum(F.exp(eta)).alias("w"), F.sum("e").alias("d"))
    per = global_running_sum(per, [F.desc("t")], {"risk": F.col("w")})
    per = per.withColumn("dh", F.when(F.col("d") > 0, F.col("d") / F.col("risk")).otherwise(0.0))
    per = global_running_sum(per, [F.asc("t")], {"H0": F.col("dh")})
    return per.select("t", "H0")


def _log_hazard(fit: dict) -> Column:
    """(x − mean)·β on the original covariates."""
    cov, coef, mean = fit["covariates"], fit["coef"], fit["mean"]
    return sum((F.lit(float(coef[i])) * (F.col(c).cast("double") - float(mean[i]))
                for i, c in enumerate(cov)), F.lit(0.0))


def partial_hazard(fit: dict) -> Column:
    """exp((x − mean)·β) on the original covariates."""
    return F.exp(_log_hazard(fit))


def survival_at(df: DataFrame, fit: dict, horizons=(7, 30, 90)) -> DataFrame:
    """S(h | x) = exp(−H0(h)·partial hazard), H0 a right-continuous step
    function of the baseline timeline, looked up by one aggregate."""
    # H0 rises with t, so its value at a horizon is the greatest one up to there
    at = stable(baseline_hazard(fit).agg(*[
        F.coalesce(F.max(F.when(F.col("t") <= float(h), F.col("H0"))), F.lit(0.0)).alias(f"h{i}") for i, h in enumerate(horizons)]))
    return df.withColumns({f"p_active_{h}": F.exp(-at.select(f"h{i}").scalar() * partial_hazard(fit)) for i, h in enumerate(horizons)})


#: Width of a cell of the log hazard and interpolation nodes in it.  exp(−a·eˣ) is
#: at most 1 in modulus on the ellipse of radius 8 around a cell, so 14 nodes are
#: within 4·8⁻¹⁴/7 ≈ 1.3e-13 of it for every a ≥ 0.
CELL, NODES = 0.5, 14


def _integrals(points: DataFrame, cells: list) -> DataFrame:
    """For every point (k, t, H0, next point t1, h1) of the timeline and every
    cell g of the log hazard x: Chebyshev coefficients ``c`` over the cell of the
    trapezoid ∫ S(u|x) du from the point to the timeline's end, divided by S(t|x)."""
    angles = [math.pi * (2 * m + 1) / (2 * NODES) for m in range(NODES)]
    hazard = [F.exp(F.lit(CELL) * (F.col("g") + F.lit((1 + math.cos(a)) / 2))) for a in angles]
    per = points.withColumn("g", F.explode(F.array(*[F.lit(g) for g in cells])))
    segment = {f"n{m}": F.coalesce((F.col("t1") - F.col("t")) / 2.0 * (F.exp(-F.col("H0") * w) + F.exp(-F.col("h1") * w)), F.lit(0.0))
               for m, w in enumerate(hazard)}
    tails = global_running_sum(per, [F.desc("k")], segment, partition_by=["g"])
    tails = tails.withColumns({f"n{m}": F.col(f"n{m}") * F.exp(F.least(F.col("H0") * w, F.lit(700.0))) for m, w in enumerate(hazard)})
    coefficient = [sum((F.lit((1 if i == 0 else 2) / NODES * math.cos(i * a)) * F.col(f"n{m}") for m, a in enumerate(angles)), F.lit(0.0))
                   for i in range(NODES)]
    return tails.select("g", "k", "t", "H0", "h1", F.array(*coefficient).alias("c"))


def expected_remaining(df: DataFrame, fit: dict, tenure: str = "tenure") -> DataFrame:
    """Expected lifetime = trapezoid ∫S(t|x)dt over the baseline
    timeline, minus current tenure, floored at 0, 1 decimal (numpy rounding).
    Also ``expected_residual`` – the conditional version ∫_{tenure}^∞ S dt / S(tenure)
    (SURVEY D12 keeps the unconditional form as the reproduced one), S a
    right-continuous step at the tenure; before the timeline's first point it is
    the whole integral.

    Every tenure finds its last point of the timeline by a running count over
    both in time order.  Integrals from each point to the end are prefix sums,
    taken at the nodes of the cells of the log hazard that occur; a row
    interpolates in its cell, within 1.3e-13 of the timeline's length.  Rows are
    joined once by (tenure, cell), each of which is one row of the other side.
    The driver gets the cells that occur, fewer than 3,000 in all doubles.

    A null covariate gives a null lifetime and a residual of 0, a null tenure
    0 remaining; where S(tenure) is below about 1e-184 the residual is 0."""
    x = F.greatest(F.least(_log_hazard(fit), F.lit(700.0)), F.lit(-700.0))
    x = F.when(_log_hazard(fit).isNotNull(), x)
    rows = df.withColumns({"__x": x, "__t0": F.col(tenure).cast("double")})
    rows = rows.withColumn("__g", F.floor(F.col("__x") / CELL).cast("int"))
    places = stable(rows.select("__t0", "__g").where("__g IS NOT NULL").distinct())
    cells = sorted(r[0] for r in places.select("__g").distinct().collect())
    asked = places.where("__t0 IS NOT NULL").select(F.col("__t0").alias("t")).distinct()
    marks = baseline_hazard(fit).select("t", "H0", F.lit(1).alias("on")).unionByName(
        asked.select("t", F.lit(None).cast("double").alias("H0"), F.lit(0).alias("on")))
    marks = stable(global_running_sum(marks, [F.asc("t"), F.desc("on")], {"k": F.col("on")}))
    points = marks.where("on = 1").select("k", "t", "H0")
    after = points.select((F.col("k") - 1).alias("k"), F.col("t").alias("t1"), F.col("H0").alias("h1"))
    table = stable(_integrals(points.join(after, "k", "left"), cells or [0]))

    whole = table.where("k = 1").select(F.col("g").alias("__g"), F.col("c").alias("__whole"), F.col("H0").alias("__first"))
    found = marks.where("on = 0").select(F.col("t").alias("__t0"), F.greatest("k", F.lit(1)).alias("k"), (F.col("k") < 1).alias("__early"))
    found = places.join(found, "__t0").join(table.withColumnRenamed("g", "__g"), ["__g", "k"]).select(
        "__t0", "__g", "__early", F.col("t").alias("__t"), F.col("H0").alias("__h"), F.col("h1").alias("__h1"), F.col("c").alias("__c"))
    # a row per cell is broadcast; a hot (tenure, cell) lies on the left side only, where adaptive execution may split it
    out = rows.join(F.broadcast(whole), "__g", "left").join(found, ["__t0", "__g"], "left")
    at = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("__x") * (2 / CELL) - F.col("__g") * 2 - 1)))
    value = lambda c: sum((F.col(c)[i] * F.cos(at * i) for i in range(NODES)), F.lit(0.0))
    ph = F.exp("__x")
    expect = value("__whole") * F.exp(-F.col("__first") * ph)
    rem = F.greatest(F.lit(0.0), F.rint((F.col("expected_lifetime") - F.col(tenure)) * 10.0) / 10.0)
    gone = F.coalesce((F.col("__t0") - F.col("__t")) / 2.0 * (1 + F.exp(-(F.col("__h1") - F.col("__h")) * ph)), F.lit(0.0))
    resid = F.when(F.col("__early"), F.col("expected_lifetime")).when(
        F.col("__h") * F.exp(F.lit(CELL) * (F.col("__g") + 1)) <= 700, F.greatest(F.lit(0.0), value("__c") - gone))
    out = out.withColumn("expected_lifetime", expect)
    out = out.withColumns({"expected_tenure_remaining": rem, "expected_residual": F.coalesce(resid, F.lit(0.0))})
    return out.select(*df.columns, "expected_lifetime", "expected_tenure_remaining", "expected_residual")


# ------------------------------------------------------------------ E8


def concordance_index(df: DataFrame, duration: str, event: str, score: str) -> DataFrame:
    """Harrell's C where a higher ``score`` means a longer expected
    survival.  Comparable pairs: i died and j left later, or i died and j was
    censored at the same time.  Concordant when score_j > score_i; equal
    scores count ½.

    Exits are numbered in the order (duration, deaths first), so i and j are
    comparable if i died and has the smaller number.  Concordant pairs are counted by
    dominance: two numbers differ first in one bit, so on every bit level rows with
    the same higher bits form a group in which those with a 0 come before those
    with a 1, and a running sum of the deaths with a 0 in score order counts the
    pairs.  All levels are one running sum over (level, group, score), after rows
    of equal score, duration and event were reduced to a count.  Nothing but the
    greatest number goes to the driver."""
    rows = df.select(F.col(duration).cast("double").alias("t"), (1 - F.col(event).cast("int")).alias("c"),
                     F.col(score).cast("double").alias("s")).na.drop()
    rows = stable(rows.groupBy("s", "t", "c").agg(F.count(F.lit(1)).alias("k")))
    died = F.when(F.col("c") == 0, F.col("k")).otherwise(0)
    exits = rows.groupBy("t", "c").agg(F.sum("k").alias("k"))
    exits = stable(global_running_sum(exits, [F.asc("t"), F.asc("c")], {"no": F.lit(1), "deaths": died}))
    pairs = exits.select(F.sum(F.col("k") * (F.col("deaths") - died))).scalar()
    levels = int(exits.agg(F.max("no")).first()[0] or 0).bit_length()
    placed = stable(rows.join(exits.select("t", "c", "no"), ["t", "c"]).select("s", "c", "k", "no"))

    one = F.expr("shiftright(no, b) & 1") == 1
    cells = placed.select("s", "c", "k", "no", F.explode(F.array(*[F.lit(b) for b in range(max(levels, 1))])).alias("b"))
    cells = cells.groupBy("b", F.expr("shiftright(no, b + 1)").alias("g"), "s").agg(
        F.sum(F.when(~one, died).otherwise(0)).alias("low"), F.sum(F.when(one, F.col("k")).otherwise(0)).alias("high"))
    ranked = global_running_sum(cells, [F.asc("s")], {"below": F.col("low")}, partition_by=["b", "g"], exclusive=True)
    tied = global_running_sum(placed, [F.asc("no")], {"before": died}, partition_by=["s"], exclusive=True)
    out = ranked.agg(F.coalesce(F.sum(F.col("high") * F.col("below")), F.lit(0)).alias("correct")).select(
        "correct", F.coalesce(tied.select(F.sum(F.col("k") * F.col("before"))).scalar(), F.lit(0)).alias("tied"),
        F.coalesce(pairs, F.lit(0)).alias("pairs"))
    return out.withColumn("c_index", F.try_divide(F.col("correct") + F.col("tied") / 2.0, F.col("pairs")))
