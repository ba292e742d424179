"""Report tables over the long prediction frame and the feature matrix.

Every table is a grouped aggregate (partial aggregation before one shuffle
on a small key) or a narrow projection; rankings run only on aggregated
per-model rows. Exact percentiles (``percentile``) are used on groups
bounded by the panel (entities x periods); ``approx=True`` switches to
``percentile_approx`` for raw-volume inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.scalars import banded_direction, pearson
from panelcast.operators.evaluation import compare_models, inside, metric_exprs

def resid() -> Column:
    return F.col("y") - F.col("pred")


def split_sizes(df: DataFrame, split: str = "split", period: str = "period") -> DataFrame:
    """A4: rows and period range per split plus a ``total`` row (ROLLUP)."""
    out = df.rollup(split).agg(
        F.count(F.lit(1)).alias("n"), F.min(period).alias("min_period"), F.max(period).alias("max_period"),
    )
    return out.select(F.coalesce(F.col(split), F.lit("total")).alias("split"), "n", "min_period", "max_period")


def leaderboard(pf: DataFrame, split: str = "test") -> DataFrame:
    """A5: test metrics and interval coverage per model, ranked by MAE.
    Coverage is NULL for a model whose bounds equal its points everywhere."""
    per_model = pf.where(F.col("split") == split).groupBy("model").agg(
        *metric_exprs(names=("mae", "rmse", "r2", "directional_accuracy")),
        F.when(F.max(F.abs(F.col("hi") - F.col("lo"))) > 0, F.avg(inside())).alias("coverage"),
    )
    # the window sorts one row per model (already aggregated)
    rank = F.row_number().over(Window.orderBy(F.col("mae").asc_nulls_last(), "model"))
    return per_model.withColumn("rank", rank)


def metrics_by_split(pf: DataFrame) -> DataFrame:
    """A6 / A1 per (model, split)."""
    return pf.groupBy("model", "split").agg(*metric_exprs())


def model_comparison(pf: DataFrame) -> DataFrame:
    """A2: model rows, ``<split>_<metric>`` columns."""
    return compare_models(pf)


def period_means(pf: DataFrame, split: str = "test") -> DataFrame:
    """Mean actual and predicted change per (model, period)."""
    return pf.where(F.col("split") == split).groupBy("model", "period").agg(
        F.avg("y").alias("mean_actual"), F.avg("pred").alias("mean_pred"), F.count(F.lit(1)).alias("n"),
    )


def interval_series(pf: DataFrame, entity_value: str, split: str = "val") -> DataFrame:
    """One entity's interval series with an inside flag; all entities if
    the entity has no row in the split."""
    rows = pf.where(F.col("split") == split)
    one = rows.where(F.col("entity") == entity_value)
    # one row at most: whether the entity occurs is part of the plan, not a job of its own
    found = one.agg((F.count(F.lit(1)) > 0).alias("found"))
    chosen = rows.withColumn("found", found.scalar()).where(~F.col("found") | (F.col("entity") == entity_value))
    return chosen.select("model", "entity", "period", "y", "pred", "lo", "hi", inside().cast("int").alias("inside"))


def interval_coverage(pf: DataFrame, split: str = "val") -> DataFrame:
    """A3 per model."""
    return pf.where(F.col("split") == split).groupBy("model").agg(
        F.avg(inside()).alias("coverage"), F.count(F.lit(1)).alias("n"),
    )


def entity_model_mae(pf: DataFrame, models: Sequence[str], split: str = "test") -> DataFrame:
    """Entity x model MAE (explicit pivot values)."""
    return (
        pf.where(F.col("split") == split)
        .groupBy("entity").pivot("model", list(models)).agg(F.avg(F.abs(resid())))
    )


#: parts that the rows of one group are spread over in a join with per-group rows
GROUP_PARTS = 64


def with_group_rows(rows: DataFrame, groups: DataFrame, by: Sequence[str], value: str = "v") -> DataFrame:
    """``rows`` joined with per-group rows, without meeting in a task per group:
    each group's rows are spread over ``GROUP_PARTS`` parts by their value's
    hash, and the per-group rows are repeated for each part."""
    parts = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(GROUP_PARTS - 1))))
    spread = rows.withColumn("_part", F.pmod(F.xxhash64(value), F.lit(GROUP_PARTS)).cast("int"))
    return spread.join(parts, [*by, "_part"]).drop("_part")


def histogram(df: DataFrame, value: str, by: Sequence[str], bins: int | str) -> DataFrame:
    """Equal-width histogram on [min, max] per group with density.

    ``bins`` is a number or a column holding each group's bin count. ``bin``
    is 0-based; the maximum falls in the last bin. Empty bins are kept (a
    per-group ``sequence`` of bin ids left-joined to the counts); both sides
    of that join are aggregates of size groups x bins.
    """
    if not by:
        return histogram(df.withColumn("_all", F.lit(0)), value, ["_all"], bins).drop("_all")
    v = F.col(value)
    nb = F.lit(bins) if isinstance(bins, int) else F.col(bins)
    data = df.where(v.isNotNull()).select(*by, v.alias("v"), nb.cast("int").alias("nb"))
    stats = data.groupBy(*by).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("total"), F.max("nb").alias("nb"),
    )
    span = F.col("hi") - F.col("lo")
    width = span / F.col("nb")
    idx = F.when(
        span > 0, F.least(F.floor((F.col("v") - F.col("lo")) / span * F.col("nb")), F.col("nb") - 1),
    ).otherwise(F.lit(0)).cast("int")
    binned = with_group_rows(data.drop("nb"), stats, by)
    counts = binned.groupBy(*by, idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = stats.select(*by, "lo", "hi", "total", "nb", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("bin"))
    out = grid.join(counts, [*by, "bin"], "left").fillna(0, subset=["count"])
    return out.select(
        *by, "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        F.when(F.col("bin") == F.col("nb") - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.col("count").cast("long").alias("count"),
        (F.col("count") / (F.col("total") * F.when(span > 0, width))).alias("density"),
    )


def residual_summary(pf: DataFrame, split: str = "test") -> DataFrame:
    """A10: mean and population std of residuals per model."""
    return pf.where(F.col("split") == split).groupBy("model").agg(
        F.avg(resid()).alias("mu"), F.stddev_pop(resid()).alias("sigma"), F.count(F.lit(1)).alias("n"),
    )


def residual_histogram(pf: DataFrame, split: str = "test", bins: int = 25) -> DataFrame:
    rows = pf.where(F.col("split") == split).withColumn("residual", resid())
    return histogram(rows, "residual", ["model"], bins)


def _quantiles(x: Column, qs: Sequence[float], approx: bool) -> Column:
    if approx:
        return F.percentile_approx(x, list(qs), 100000)
    return F.percentile(x, F.array(*[F.lit(q) for q in qs]))


def describe(df: DataFrame, value: str, by: Sequence[str] = (), *, digits: int = 3, approx: bool = False) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear), max; rounded.

    Quartiles are exact (:func:`exact_quantiles`, no whole-group buffer) or,
    with ``approx=True``, ``percentile_approx``."""
    x = F.col(value)
    keys = list(by) or ["_all"]
    src = df if by else df.withColumn("_all", F.lit(0))
    base = src.groupBy(*keys).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"),
    )
    if approx:
        quart = src.groupBy(*keys).agg(F.percentile_approx(x, [0.25, 0.5, 0.75], 100000).alias("q"))
    else:
        quart = exact_quantiles(src, value, (0.25, 0.5, 0.75), keys)
    agg = base.join(quart, keys, "left")
    r = lambda c: F.round(c, digits)
    return agg.select(
        *by, "count", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"), r(F.col("min")).alias("min"),
        r(F.col("q")[0]).alias("q25"), r(F.col("q")[1]).alias("q50"), r(F.col("q")[2]).alias("q75"),
        r(F.col("max")).alias("max"),
    )


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope and intercept of y on x, and Pearson r."""
    return df.groupBy(*by).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        pearson(x, y).alias("r"),
        F.regr_count(F.col(y), F.col(x)).alias("n"),
    )


def seasonal_profile(df: DataFrame, value: str = "target", quarter: str = "quarter") -> DataFrame:
    """Mean and sample std by quarter of the current period."""
    return df.groupBy(quarter).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("n"),
    )


def feature_target_corr(df: DataFrame, features: Sequence[str], target: str = "target") -> DataFrame:
    """Pearson r of every feature with the target, ordered by |r|.
    One aggregate computes all correlations; ``stack`` turns it into rows."""
    wide = df.agg(*[pearson(f, target).alias(f) for f in features])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("corr")) for f in features
    ])))
    return long.withColumn("abs_corr", F.abs("corr"))


def correlation_matrix(df: DataFrame, features: Sequence[str], method: str = "gram") -> DataFrame:
    """Long (feature_a, feature_b, corr) for all ordered pairs.

    ``gram`` (default, for complete-row inputs such as the training matrix):
    rows with a null feature are dropped, column means come from one
    aggregate, and the centred d x d cross-product matrix from built-in sums of
    products (no Python on the rows); only d x d numbers reach the driver. ``pairwise``: one aggregate of pairwise-complete Pearson terms
    (upper triangle, mirrored) - exact NULL handling, but 3 d^2/2 aggregates.
    Constant columns give NULL correlations.
    """
    cols = list(features)
    spark = df.sparkSession
    if method == "gram":
        from panelcast.ml.moments import gram_by_group

        complete = df.select(*cols).dropna()
        # means as one scalar subquery (it reuses the input's exchanges), so
        # centring and the Gram pass are a single job
        means = complete.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)])
        centred = complete.withColumn("_m", means.select(F.struct(*means.columns)).scalar()).select(
            *[(F.col(c) - F.col("_m")[f"m{i}"]).alias(f"x{i}") for i, c in enumerate(cols)], F.lit(0.0).alias("_y"))
        grams = gram_by_group(centred, [f"x{i}" for i in range(len(cols))], "_y")
        if 0 not in grams:
            rows = [(a, b, None) for a in cols for b in cols]
        else:
            g = grams[0]
            d = len(cols)
            n = g[0, 0]
            s = g[0, 1:d + 1]
            cov = g[1:d + 1, 1:d + 1] - np.outer(s, s) / n
            sd = np.sqrt(np.clip(np.diag(cov), 0, None))
            rows = []
            for i, a in enumerate(cols):
                for j, b in enumerate(cols):
                    den = sd[i] * sd[j]
                    val = None if den == 0 or n < 2 else (1.0 if i == j else float(cov[i, j] / den))
                    rows.append((a, b, val))
        return spark.createDataFrame(rows, "feature_a STRING, feature_b STRING, corr DOUBLE")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[pearson(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    items = []
    for i, (a, b) in enumerate(pairs):
        c = F.col(f"c{i}") if a != b else F.when(F.col(f"c{i}").isNotNull(), F.lit(1.0))
        items.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), c.alias("corr")))
        if a != b:
            items.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), c.alias("corr")))
    return wide.select(F.inline(F.array(*items)))


def driver_ranges(df: DataFrame, drivers: Sequence[str], split: str = "split") -> DataFrame:
    """Min and max of each driver per split."""
    aggs = []
    for d in drivers:
        aggs += [F.min(d).alias(f"{d}_min"), F.max(d).alias(f"{d}_max")]
    return df.groupBy(split).agg(*aggs)


def target_by_entity(df: DataFrame, target: str = "target", entity: str = "entity") -> DataFrame:
    """Min, max and mean of the target per entity."""
    return df.groupBy(entity).agg(
        F.min(target).alias("target_min"), F.max(target).alias("target_max"), F.avg(target).alias("target_mean"),
    )


def residual_spread(pf: DataFrame, split: str = "val", approx: bool = False) -> DataFrame:
    """Per (model, entity): sample std, quartiles, 1.5 IQR whiskers
    (extreme residuals inside the fences). Two aggregates joined on the key."""
    rows = pf.where(F.col("split") == split).select("model", "entity", resid().alias("r"))
    # a (model, entity) group holds one entity's quarters in the split (bounded
    # by the calendar), so the exact percentile aggregate is safe here
    box = rows.groupBy("model", "entity").agg(
        F.stddev_samp("r").alias("std"), _quantiles(F.col("r"), (0.25, 0.5, 0.75), approx).alias("q"),
    ).select(
        "model", "entity", "std", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    fenced = rows.join(box, ["model", "entity"]).where(
        (F.col("r") >= F.col("q1") - 1.5 * iqr) & (F.col("r") <= F.col("q3") + 1.5 * iqr)
    ).groupBy("model", "entity").agg(F.min("r").alias("whisker_lo"), F.max("r").alias("whisker_hi"))
    return box.join(fenced, ["model", "entity"], "left")


def direction_confusion(pf: DataFrame, split: str = "val", band: float = 0.1) -> DataFrame:
    """Banded-direction confusion counts (actual rows, predicted columns)."""
    labeled = pf.where(F.col("split") == split).select(
        "model", banded_direction("y", band).alias("actual"), banded_direction("pred", band).alias("predicted"),
    )
    return labeled.groupBy("model", "actual").pivot("predicted", ["down", "flat", "up"]).count().fillna(0)


def direction_accuracy(pf: DataFrame, split: str = "val", band: float = 0.1) -> DataFrame:
    """Share of rows whose banded labels agree, per model."""
    eq = (banded_direction("y", band) == banded_direction("pred", band)).cast("double")
    return pf.where(F.col("split") == split).groupBy("model").agg(F.avg(eq).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def direction_by_entity(pf: DataFrame, models: Sequence[str], split: str = "val") -> DataFrame:
    """Sign-agreement share, entity x model."""
    eq = (F.signum("pred") == F.signum("y")).cast("double")
    return pf.where(F.col("split") == split).groupBy("entity").pivot("model", list(models)).agg(F.avg(eq))


def cv_summary(fold_metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population std across folds of mae, r2, direction."""
    aggs = []
    for m in ("mae", "r2", "directional_accuracy"):
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return fold_metrics.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n_folds"))


def residual_series(pf: DataFrame, splits: Sequence[str] = ("val", "test")) -> DataFrame:
    """Residual per row of the later splits."""
    return pf.where(F.col("split").isin(list(splits))).select("model", "split", "entity", "period", resid().alias("residual"))


def pred_actual_bounds(pf: DataFrame, split: str = "test", exclude: Sequence[str] = ("ensemble",), pad: float = 1.1) -> DataFrame:
    """Symmetric axis bound per model: pad * max(|y|, |pred|)."""
    rows = pf.where((F.col("split") == split) & ~F.col("model").isin(list(exclude)))
    return rows.groupBy("model").agg(
        (F.lit(pad) * F.greatest(F.max(F.abs("y")), F.max(F.abs("pred")))).alias("bound"),
        F.count(F.lit(1)).alias("n"),
    )


def kde(df: DataFrame, value: str, by: Sequence[str], grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per group on ``grid`` points spanning
    [min - cut*h, max + cut*h], bandwidth h = sample std * n^(-1/5) (Scott).

    Each distinct value is expanded against the fixed grid (a bounded multiplier) and
    kernel terms are summed per (group, grid point) with partial aggregation;
    the per-group statistics are an equi-join on the group key. Groups with
    a single value or no spread get NULL densities."""
    if not by:
        return kde(df.withColumn("_all", F.lit(0)), value, ["_all"], grid, cut).drop("_all")
    v = F.col(value)
    data = df.where(v.isNotNull()).select(*by, v.alias("v"))
    stats = data.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"),
    ).withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = stats.withColumns({"a": F.col("lo") - F.lit(cut) * F.col("h"), "b": F.col("hi") + F.lit(cut) * F.col("h")})
    step = (F.col("b") - F.col("a")) / F.lit(grid - 1)
    counted = data.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c"))
    pts = with_group_rows(counted, stats, by).select(
        *by, "n", "h", "a", "b", "v", "c", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"))
    x = F.col("a") + F.col("g") * step
    u = (x - F.col("v")) / F.col("h")
    k = F.when(F.col("h") > 0, F.exp(F.lit(-0.5) * u * u) / (F.col("h") * F.lit(math.sqrt(2 * math.pi))))
    summed = pts.groupBy(*by, "g", "n", "a", "b").agg(F.sum(k * F.col("c")).alias("k"))
    return summed.select(*by, F.col("g").alias("point"), (F.col("a") + F.col("g") * step).alias("x"),
                         (F.col("k") / F.col("n")).alias("density"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    accuracy: int = 1_000_000) -> DataFrame:
    """Exact linear-interpolation quantiles ((n-1)p rule) without buffering a
    whole group in one task.

    ``percentile_approx`` brackets each target rank (rank error <= n/accuracy);
    the rows below the bracket are counted, the nearest values just outside
    it are kept, and the rows inside it are counted per distinct value before
    the shuffle, so ties of any number are one row. Only the distinct values
    (about 4n/accuracy per group and quantile) are ranked, by a running sum. Result: (by..., q ARRAY<DOUBLE>) in
    the order of ``probs``. A rank outside the widened bracket (it would break
    the approximation's guarantee) raises an error instead of a wrong value.
    """
    v = F.col(value)
    user_keys = list(by)
    by = user_keys or ["_all"]
    keys = [F.col(c) for c in user_keys] or [F.lit(0).alias("_all")]
    data = df.where(v.isNotNull()).select(*keys, v.cast("double").alias("v"))
    eps = 2.0 / accuracy
    lows = [max(0.0, p - eps) for p in probs]
    highs = [min(1.0, p + eps) for p in probs]
    stats = data.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("v", lows + highs, accuracy).alias("br"))
    k = len(probs)
    items = F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(float(p)).alias("p"),
        F.col("br")[i].alias("lo"), F.col("br")[k + i].alias("hi")) for i, p in enumerate(probs)])
    brackets = stats.select(*by, "n", F.inline(items))
    h = (F.col("n") - 1) * F.col("p")
    brackets = brackets.withColumns({"h": h, "k": F.floor(h)})
    joined = with_group_rows(data, brackets, by)
    lo, hi = F.col("lo"), F.col("hi")
    edges = joined.groupBy(*by, "i").agg(
        F.count_if(F.col("v") < lo).alias("below"),
        F.count_if((F.col("v") >= lo) & (F.col("v") <= hi)).alias("band_n"),
        F.max(F.when(F.col("v") < lo, F.col("v"))).alias("prev"),
        F.min(F.when(F.col("v") > hi, F.col("v"))).alias("next"),
    )
    inside_band = joined.where((F.col("v") >= lo) & (F.col("v") <= hi))
    distinct = inside_band.groupBy(*by, "i", "k", "v").agg(F.count(F.lit(1)).alias("c"))
    band = distinct.join(edges.select(*by, "i", "below"), [*by, "i"])
    # ranks first .. last of a value, over the distinct values of the band
    last = F.sum("c").over(Window.partitionBy(*by, "i").orderBy("v")) - 1 + F.col("below")
    ranked = band.withColumn("last", last).withColumn("first", F.col("last") - F.col("c") + 1)

    def at_rank(r: Column) -> Column:
        return F.max(F.when((F.col("first") <= r) & (r <= F.col("last")), F.col("v")))

    picked = ranked.groupBy(*by, "i").agg(at_rank(F.col("k")).alias("bk"), at_rank(F.col("k") + 1).alias("bk1"))
    full = brackets.select(*by, "i", "n", "h", "k").join(edges, [*by, "i"]).join(picked, [*by, "i"], "left")

    def at(rank_col: Column, from_band: Column) -> Column:
        return F.coalesce(from_band,
                          F.when(rank_col == F.col("below") - 1, F.col("prev")),
                          F.when(rank_col == F.col("below") + F.col("band_n"), F.col("next")))

    vk, vk1 = at(F.col("k"), F.col("bk")), at(F.col("k") + 1, F.col("bk1"))
    exact_hit = F.col("h") == F.col("k")
    q = F.when(exact_hit, vk).otherwise(vk + (F.col("h") - F.col("k")) * (vk1 - vk))
    ok = vk.isNotNull() & (exact_hit | vk1.isNotNull())
    checked = F.when(ok, q).otherwise(F.raise_error(F.lit("exact_quantiles: rank outside the bracket")).cast("double"))
    per_q = full.select(*by, "i", checked.alias("q"))
    out = per_q.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("i", "q"))).alias("qs")).select(
        *by, F.transform("qs", lambda s_: s_["q"]).alias("q"))
    return out if user_keys else out.drop("_all")
