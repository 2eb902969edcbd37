"""A seasonal demand model, (1,1,1)(1,1,0,12), for every product, and a fair comparison of forecasts.

With ``w`` the series differenced by a month and by a season, the model is

    w[t] = phi w[t-1] + Phi w[t-12] - phi Phi w[t-13] + theta e[t-1] + e[t].

It is fitted by two least squares. A long autoregression (``LONG_LAGS``) gives residuals in place of the
unknown shocks e; a second regression, on w[t-1], w[t-12], w[t-13] and the residual before, gives phi, Phi and theta.
Coefficients are held within ``BOUND`` of zero, so forecasts stay stationary and invertible. Shocks
then follow from one pass over the series.

A product is one row with its series as an array, one number a month, so it is bounded by the calendar; only
that grouping shuffles. Sums, the normal equations and the recursions are array expressions over the row, and
neither rows nor a solver reach the driver. Defined results: a series too short for more rows than
coefficients, or one whose equations are singular (a flat series), has NULL coefficients and forecasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.forecast import AVERAGED_MONTHS, HORIZON, SEASON, Split, moving_avg_forecast
from ledgerloom.session import materialize

# Lags of the long autoregression: three months, and the same around the season.
LONG_LAGS = (1, 2, 3, SEASON, SEASON + 1, SEASON + 2)
LAGS = (1, SEASON, SEASON + 1)
BOUND = 0.99
# A pivot this small beside its diagonal means that the equations are singular.
SINGULAR = 1e-9


def _sequence(low: str, high: str) -> str:
    """Whole numbers from ``low`` to ``high``, none where that is smaller."""
    return f"if({high} >= {low}, sequence({low}, {high}), cast(array() AS array<int>))"


def _least_squares(rows: str, size: int) -> str:
    """The normal equations of ``rows``, arrays of ``size`` regressors and the target: one line a regressor."""
    line = f"transform(sequence(0, {size}), j -> aggregate({rows}, 0D, (s, r) -> s + r[i] * r[j]))"
    return f"transform(sequence(0, {size - 1}), i -> {line})"


def _solution(equations: str, size: int) -> str:
    """The coefficients, by elimination; NULLs where a pivot vanishes."""
    pivot = f"if(m[k][k] > {SINGULAR}D * {equations}[k][k], m[k][k], cast(NULL AS DOUBLE))"
    reduced = f"zip_with(line, m[k], (a, b) -> a - b * line[k] / {pivot})"
    step = f"transform(m, (line, i) -> if(i = k, transform(line, a -> a / {pivot}), {reduced}))"
    return f"transform(aggregate(sequence(0, {size - 1}), {equations}, (m, k) -> {step}), line -> line[{size}])"


def _held(value: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN greatest(-{BOUND}D, least({BOUND}D, {value})) END"


def series(demand: DataFrame, split: Split = Split()) -> DataFrame:
    """One row a product: its months and quantities up to the end of the test range, and how many are training."""
    known = demand.filter(F.col("month") <= F.lit(split.test_end))
    collected = known.groupBy("product_id").agg(
        F.sort_array(F.collect_list(F.struct("month", "quantity"))).alias("all"),
        F.count_if(split.is_train()).cast("int").alias("n_train"),
    )
    y = F.transform("all", lambda x: x["quantity"]).alias("y")
    return collected.select("product_id", "n_train", F.transform("all", lambda x: x["month"]).alias("months"), y)


def seasonal_arma_fit(demand: DataFrame, split: Split = Split()) -> DataFrame:
    """The series with phi, theta, seasonal_phi, the differenced series ``w`` and its shocks ``e``.

    Only training months enter the coefficients; w and e go on through the test range, each shock from the
    months before it.
    """
    longest, first = max(LONG_LAGS), SEASON + 1
    change = f"transform({_sequence(str(first), 'size(y) - 1')}, t -> y[t] - y[t-1] - y[t-{SEASON}] + y[t-{first}])"
    lagged = lambda lags: ", ".join(f"w[t-{lag}]" for lag in lags)
    n, p, q = f"(n_train - {first})", len(LONG_LAGS), len(LAGS) + 1
    # Each stage reads the columns of the one before by name.
    stages = [
        ("w", change),
        ("rows1", f"transform({_sequence(str(longest), n + ' - 1')}, t -> array({lagged(LONG_LAGS)}, w[t]))"),
        ("equations1", _least_squares("rows1", p)),
        ("long", f"if(size(rows1) > {p}, {_solution('equations1', p)}, NULL)"),
        ("left", "transform(rows1, r -> r[%d] - %s)" % (p, " - ".join(f"long[{i}] * r[{i}]" for i in range(p)))),
        # left[i] is the residual of w[longest + i].
        ("rows2", f"transform({_sequence(str(longest + 1), n + ' - 1')}, t -> array({lagged(LAGS)}, left[t-{longest + 1}], w[t]))"),
        ("equations2", _least_squares("rows2", q)),
        ("c", f"if(size(rows2) > {q}, {_solution('equations2', q)}, NULL)"),
        ("phi", _held("c[0]")),
        ("seasonal_phi", _held("c[1]")),
        ("theta", _held(f"c[{q - 1}]")),
    ]
    fitted = series(demand, split)
    for name, text in stages:
        fitted = fitted.withColumn(name, F.expr(text))
    # No shock is known before the first month that has all its lags: they start from zero.
    shock = f"w[t] - ({_prediction('w', 't')} + theta * s[t-1])"
    start = f"array_repeat(0D, least(size(w), {first}))"
    passed = f"aggregate({_sequence(str(first), 'size(w) - 1')}, {start}, (s, t) -> array_append(s, {shock}))"
    whole = fitted.withColumn("e", F.expr(passed)).select("product_id", "n_train", "months", "y", "w", "e", "phi", "theta", "seasonal_phi")
    # Written, so that no later filter is pushed into the fit, which would then be worked out anew in it.
    return materialize(whole, "seasonal")[0]


def _prediction(w: str, t: str) -> str:
    """What the model expects of w at ``t`` from the months before, the shock's part aside."""
    return f"phi * {w}[{t}-1] + seasonal_phi * {w}[{t}-{SEASON}] - phi * seasonal_phi * {w}[{t}-{SEASON + 1}]"


def seasonal_arma_coefficients(demand: DataFrame, split: Split = Split()) -> DataFrame:
    return seasonal_arma_fit(demand, split).select("product_id", "n_train", "phi", "theta", "seasonal_phi")


def _undone(w: str, y: str, at: str) -> str:
    """A value of the series from its expected difference and the months before ``at``."""
    return f"{w} + {y}[{at}-1] + {y}[{at}-{SEASON}] - {y}[{at}-{SEASON + 1}]"


def _ahead(fitted: DataFrame, horizon: int) -> DataFrame:
    """Adds ``ahead``: the forecasts of the months after training, each from the forecasts before it."""
    first = SEASON + 1
    past = f"named_struct('w', slice(w, 1, n_train - {first}), 'y', slice(y, 1, n_train))"
    # The last training shock counts in the first step; later ones are expected to be zero.
    expected = f"{_prediction('s.w', 'size(s.w)')} + if(h = 1, theta * e[n_train - {first + 1}], 0D)"
    # The new w is appended first, so that the undoing reads it from there.
    step = f"transform(array({expected}), f -> named_struct('w', array_append(s.w, f), 'y', array_append(s.y, {_undone('f', 's.y', 'size(s.y)')})))[0]"
    grown = f"aggregate(sequence(1, {horizon}), {past}, (s, h) -> {step}).y"
    known = f"phi IS NOT NULL AND theta IS NOT NULL AND seasonal_phi IS NOT NULL AND n_train >= {2 * first}"
    return fitted.withColumn("ahead", F.expr(f"CASE WHEN {known} THEN slice({grown}, n_train + 1, {horizon}) END"))


def seasonal_arma_forecast(demand: DataFrame, split: Split = Split(), horizon: int = HORIZON) -> DataFrame:
    """``horizon`` months from the last training month, all at once; products without a model have no rows."""
    steps = _ahead(seasonal_arma_fit(demand, split), horizon).filter(F.col("ahead").isNotNull())
    out = steps.select("product_id", F.expr("months[n_train - 1]").alias("last_month"), F.posexplode("ahead").alias("at", "forecast"))
    month = F.to_date(F.add_months("last_month", F.col("at") + 1)).alias("month")
    return out.select("product_id", (F.col("at") + 1).alias("step"), month, "forecast")


def _average_ahead(horizon: int, months: int) -> Column:
    """Moving averages of the months after training, each taking the forecasts before it for actuals."""
    known = f"slice(y, greatest(1, n_train - {months - 1}), least({months}, n_train))"
    mean = "aggregate(s.last, 0D, (a, x) -> a + x) / size(s.last)"
    kept = f"slice(array_append(s.last, m), greatest(1, size(s.last) + 2 - {months}), {months})"
    step = f"transform(array({mean}), m -> named_struct('last', {kept}, 'made', array_append(s.made, m)))[0]"
    begin = f"named_struct('last', {known}, 'made', cast(array() AS array<double>))"
    return F.expr(f"CASE WHEN n_train > 0 THEN aggregate(sequence(1, {horizon}), {begin}, (s, h) -> {step}).made END")


def forecast_protocols(demand: DataFrame, split: Split = Split(), months: int = AVERAGED_MONTHS) -> DataFrame:
    """Both methods under both protocols, over the same test months of each product.

    ``rolling`` forecasts one month from the actuals so far; ``ahead`` forecasts all months from the end
    of training. ``moving_average`` and ``seasonal`` under the same protocol are alike; total_forecast and mae are NULL
    where a method has no forecast.
    """
    horizon = max(1, split.months_ahead())
    first = SEASON + 1
    fitted = _ahead(seasonal_arma_fit(demand, split), horizon).withColumn("average_ahead", _average_ahead(horizon, months))
    # A series is without gaps, so place i >= n_train is step i - n_train + 1 ahead.
    rolling = _undone(f"({_prediction('w', f'(i-{first})')} + theta * e[i-{first + 1}])", "y", "i")
    usable = f"n_train >= {2 * first} AND phi IS NOT NULL AND theta IS NOT NULL AND seasonal_phi IS NOT NULL"
    place = f"""transform({_sequence('n_train', 'size(y) - 1')}, i -> named_struct(
        'month', months[i], 'average_ahead', average_ahead[i - n_train], 'seasonal_ahead', ahead[i - n_train],
        'seasonal_rolling', CASE WHEN {usable} THEN {rolling} END))"""
    own = fitted.select("product_id", F.inline(F.expr(place))).filter(split.is_test())
    both = moving_avg_forecast(demand, split, months).withColumnRenamed("forecast", "average_rolling").join(own, ["product_id", "month"], "left")
    cases = [("moving_average", "rolling", "average_rolling"), ("moving_average", "ahead", "average_ahead"),
             ("seasonal", "rolling", "seasonal_rolling"), ("seasonal", "ahead", "seasonal_ahead")]
    each = F.array(*[F.struct(F.lit(m).alias("method"), F.lit(p).alias("protocol"), F.col(c).alias("forecast")) for m, p, c in cases])
    return both.select("product_id", "actual", F.inline(each)).groupBy("product_id", "method", "protocol").agg(
        F.count(F.lit(1)).alias("n_months"),
        F.bround(F.sum("forecast"), 0).cast("bigint").alias("total_forecast"),
        F.avg(F.abs(F.col("actual") - F.col("forecast"))).alias("mae"),
    )
