import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import forecast as fc
from ledgerloom.operators import seasonal
from ledgerloom.operators.sales import sold_lines

SPLIT = fc.Split(dt.date(2025, 12, 31), dt.date(2026, 1, 1), dt.date(2026, 3, 31))


def month(i):
    """Month number i, counted from January 2023."""
    return dt.date(2023 + i // 12, i % 12 + 1, 1)


def demand(spark, series):
    rows = [(p, month(start + i), float(q)) for p, (start, values) in series.items() for i, q in enumerate(values)]
    return spark.createDataFrame(rows, "product_id bigint, month date, quantity double")


def walk_forward(values, start, n=3):
    """The baseline as an explicit loop: forecast, then append the actual."""
    at = [month(start + i) for i in range(len(values))]
    history = [v for v, m in zip(values, at) if m <= SPLIT.train_end]
    out = []
    for v, m in zip(values, at):
        if SPLIT.test_start <= m <= SPLIT.test_end:
            out.append((m, sum(history[-n:]) / len(history[-n:]) if history else None))
            history.append(v)
    return out


def seasonal_loop(values, horizon=3):
    """The seasonal forecast as an explicit recursion on the differenced series."""
    y = list(map(float, values))
    w = {t: y[t] - y[t - 1] - y[t - 12] + y[t - 13] for t in range(13, len(y))}
    pairs = [(w[t], w[t - 1]) for t in w if t - 1 in w]
    if not pairs:
        return []
    den = sum(b * b for _, b in pairs)
    if den == 0:
        return [None] * horizon
    phi = sum(a * b for a, b in pairs) / den
    change = w[len(y) - 1]
    n = len(y)
    for _ in range(horizon):
        change *= phi
        t = len(y)
        y.append(y[t - 1] + y[t - 12] - y[t - 13] + change)
    return y[n:]


@pytest.fixture(scope="module")
def series():
    rnd = random.Random(7)
    made = {p: (rnd.randrange(0, 20), [rnd.randrange(0, 30) for _ in range(rnd.randrange(16, 39))]) for p in range(25)}
    made[100] = (36, [4, 5])  # no training month
    made[101] = (35, [4, 5, 6])  # one training month
    made[102] = (34, [1, 4, 5])  # two
    made[103] = (0, [3] * 10)  # ends long before the test months
    made[104] = (0, [2] * 39)  # flat
    return {p: (start, values[: 39 - start]) for p, (start, values) in made.items()}


def test_baseline_equals_loop(spark, series):
    got = {}
    for r in fc.moving_avg_forecast(demand(spark, series), SPLIT).orderBy("product_id", "month").collect():
        got.setdefault(r.product_id, []).append((r.month, r.forecast))
    for p, (start, values) in series.items():
        want = walk_forward(values, start)
        assert [m for m, _ in got.get(p, [])] == [m for m, _ in want]
        assert [f for _, f in got.get(p, [])] == pytest.approx([f for _, f in want])


def test_no_leakage(spark):
    base = {1: (24, [5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 1, 2, 3])}
    before = fc.moving_avg_forecast(demand(spark, base), SPLIT).orderBy("month").collect()
    changed = {1: (24, [*base[1][1][:13], 500, 3])}
    after = fc.moving_avg_forecast(demand(spark, changed), SPLIT).orderBy("month").collect()
    assert [r.forecast for r in before][:2] == [r.forecast for r in after][:2]
    assert before[2].forecast != after[2].forecast


def test_months_between_train_and_test_are_left_out(spark):
    split = fc.Split(dt.date(2025, 10, 31), SPLIT.test_start, SPLIT.test_end)
    df = demand(spark, {1: (31, [1, 2, 3, 900, 900, 6, 7])})  # Aug 2025 .. Feb 2026
    got = [r.forecast for r in fc.moving_avg_forecast(df, split).orderBy("month").collect()]
    assert got == pytest.approx([2.0, 11 / 3])


def test_seasonal_equals_loop(spark, series):
    got = {}
    for r in fc.seasonal_ar_forecast(demand(spark, series), SPLIT).orderBy("product_id", "step").collect():
        got.setdefault(r.product_id, []).append((r.month, r.forecast))
    for p, (start, values) in series.items():
        train = [v for i, v in enumerate(values) if month(start + i) <= SPLIT.train_end]
        want = seasonal_loop(train)
        assert [f for _, f in got.get(p, [])] == pytest.approx(want), p
        assert [m for m, _ in got.get(p, [])] == [month(start + len(train) + j) for j in range(len(want))]


def test_totals_round_half_even(spark):
    rows = [(1, 1.0, 2.5), (2, 1.0, 3.5), (3, 4.0, None), (4, 1.0, 1.25), (4, 3.0, 1.25)]
    df = spark.createDataFrame(rows, "product_id bigint, actual double, forecast double")
    assert {r.product_id: r.total_forecast for r in fc.forecast_total(df).collect()} == {1: 2, 2: 4, 3: 0, 4: 2}
    assert {r.product_id: r.mae for r in fc.mean_absolute_error(df).collect()} == {1: 1.5, 2: 2.5, 3: None, 4: 1.0}


def test_months_fill_within_each_product_only(spark):
    rows = [(1, dt.date(2023, 11, 1), 5.0), (1, dt.date(2024, 2, 1), 7.0), (2, dt.date(2024, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "product_id bigint, month date, quantity double")
    got = [(r.product_id, str(r.month), r.quantity) for r in fc.fill_months(df).orderBy("product_id", "month").collect()]
    assert got == [
        (1, "2023-11-01", 5.0), (1, "2023-12-01", 0.0), (1, "2024-01-01", 0.0), (1, "2024-02-01", 7.0),
        (2, "2024-01-01", 1.0),
    ]


def test_demand_ignores_missing_dates_and_quantities(spark):
    orders = spark.createDataFrame(
        [(1, 1, dt.datetime(2024, 1, 31, 23)), (2, 1, None), (3, 1, dt.datetime(2024, 3, 1))],
        "id bigint, customer_id bigint, placed_at timestamp",
    )
    items = spark.createDataFrame(
        [(1, 1, 2.0), (1, 1, 3.0), (2, 1, 50.0), (3, 1, None), (None, 1, 9.0)],
        "order_id bigint, product_variant_id bigint, quantity double",
    )
    variants = spark.createDataFrame([(1, 7)], "id bigint, product_id bigint")
    got = fc.monthly_demand(sold_lines(orders, items, variants)).orderBy("month").collect()
    assert [(r.product_id, str(r.month), r.quantity) for r in got] == [
        (7, "2024-01-01", 5.0), (7, "2024-02-01", 0.0), (7, "2024-03-01", 0.0),
    ]


def test_find_product(spark):
    df = spark.createDataFrame(
        [(5, "Âncora 702"), (3, "kit ÂNCORA 702 pro"), (1, None), (2, "a.c"), (4, "abc")], "id bigint, name string"
    )
    assert fc.find_product(df, "âncora 702").first().id == 3
    assert fc.find_product(df, "a.c").first().id == 2
    assert fc.find_product(df, "none such").count() == 0


def test_product_sales_lines(spark):
    orders = spark.createDataFrame([(1, 9, dt.datetime(2024, 1, 1))], "id bigint, customer_id bigint, placed_at timestamp")
    items = spark.createDataFrame(
        [(1, 1, 2.0), (1, 1, 2.0), (1, 2, 4.0), (1, 3, 8.0)], "order_id bigint, product_variant_id bigint, quantity double"
    )
    variants = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "id bigint, product_id bigint")
    product = spark.createDataFrame([(7, "x")], "id bigint, name string")
    assert fc.product_sales_lines(orders, items, variants, product).agg(F.sum("quantity")).first()[0] == 8.0


def test_comparison_covers_long_ranges_short_histories_and_flat_products(spark):
    """Six test months, a product with half a year of training, and one whose changes are all alike."""
    split = fc.Split(dt.date(2025, 12, 31), dt.date(2026, 1, 1), dt.date(2026, 6, 30))
    rnd = random.Random(2)
    series = {1: (0, [rnd.randrange(30) for _ in range(42)]), 2: (30, [3, 4, 5, 6, 7, 8, 1, 2, 3, 4, 5, 6]), 3: (0, [5] * 42)}
    found = {r.product_id: r for r in fc.forecast_comparison(demand(spark, series), split).collect()}
    assert {p: r.n_months for p, r in found.items()} == {1: 6, 2: 6, 3: 6}
    for product, (start, values) in series.items():
        at = 36 - start
        steps = [sum(values[at + i - 3 : at + i]) / 3 for i in range(6)]
        assert found[product].baseline_total == pytest.approx(sum(steps), abs=0.5)
        assert found[product].baseline_mae == pytest.approx(sum(abs(a - b) for a, b in zip(values[at:], steps)) / 6)
    ahead = seasonal_loop(series[1][1][:36], 6)
    assert found[1].seasonal_total == round(sum(ahead))
    assert found[1].seasonal_mae == pytest.approx(sum(abs(a - b) for a, b in zip(series[1][1][36:], ahead)) / 6)
    assert [found[p].seasonal_total for p in (2, 3)] == [found[p].seasonal_mae for p in (2, 3)] == [None, None]


def least_squares(rows):
    """Coefficients of the regressors in rows of (regressors..., target), by elimination; None if singular."""
    p = len(rows[0]) - 1
    m = [[sum(r[i] * r[j] for r in rows) for j in range(p + 1)] for i in range(p)]
    size = [m[k][k] for k in range(p)]
    for k in range(p):
        if not m[k][k] > 1e-9 * size[k]:
            return None
        m[k] = [x / m[k][k] for x in m[k]]
        m = [m[k] if i == k else [x - line[k] * y for x, y in zip(line, m[k])] for i, line in enumerate(m)]
    return [line[p] for line in m]


def arma_loop(y, n_train, horizon):
    """phi, seasonal phi and theta, one-step forecasts by place, and forecasts from the end of training."""
    w = [y[t] - y[t - 1] - y[t - 12] + y[t - 13] for t in range(13, len(y))]
    n = n_train - 13
    rows = [[*(w[t - k] for k in (1, 2, 3, 12, 13, 14)), w[t]] for t in range(14, n)]
    long = least_squares(rows) if len(rows) > 6 else None
    if long is None:
        return None
    left = {t: r[6] - sum(a * x for a, x in zip(long, r)) for t, r in enumerate(rows, 14)}
    rows = [[w[t - 1], w[t - 12], w[t - 13], left[t - 1], w[t]] for t in range(15, n)]
    found = least_squares(rows) if len(rows) > 4 else None
    if found is None:
        return None
    phi, seasonal, theta = (max(-0.99, min(0.99, found[i])) for i in (0, 1, 3))
    e, ahead_w = [0.0] * min(13, len(w)), w[:n]
    expected = lambda w, t: phi * w[t - 1] + seasonal * w[t - 12] - phi * seasonal * w[t - 13]
    rolling = {}
    for t in range(13, len(w)):
        told = expected(w, t) + theta * e[t - 1]
        rolling[t + 13] = told + y[t + 12] + y[t + 1] - y[t]
        e.append(w[t] - told)
    grown = y[:n_train]
    for h in range(horizon):
        ahead_w = [*ahead_w, expected(ahead_w, len(ahead_w)) + (theta * e[n - 1] if h == 0 else 0)]
        grown = [*grown, ahead_w[-1] + grown[-1] + grown[-12] - grown[-13]]
    return (phi, seasonal, theta), rolling, grown[n_train:]


@pytest.fixture(scope="module")
def long_series():
    """Up to six training years from January 2020 and the three test months."""
    rnd = random.Random(11)
    made = {p: (0, [20 + 10 * (i % 12) + rnd.gauss(0, 6) for i in range(75)]) for p in range(12)}
    made |= {20 + p: (30 + 5 * p, [rnd.randrange(0, 30) for _ in range(45 - 5 * p)]) for p in range(6)}
    made[100] = (0, [5.0] * 75)  # flat
    made[101] = (72, [1.0, 2.0, 3.0])  # no training
    made[102] = (0, [float(i % 7) for i in range(60)])  # ends before the test months
    made[103] = (71, [4.0, 5.0, 6.0, 7.0])
    return made


def long_demand(spark, made):
    at = lambda i: dt.date(2020 + i // 12, i % 12 + 1, 1)
    rows = [(p, at(start + i), float(q)) for p, (start, values) in made.items() for i, q in enumerate(values)]
    return spark.createDataFrame(rows, "product_id bigint, month date, quantity double").repartition(5)


def test_seasonal_model_equals_loop(spark, long_series):
    found = {r.product_id: r for r in seasonal.seasonal_arma_coefficients(long_demand(spark, long_series), SPLIT).collect()}
    ahead = {}
    for r in seasonal.seasonal_arma_forecast(long_demand(spark, long_series), SPLIT).collect():
        ahead.setdefault(r.product_id, {})[r.step] = r.forecast
    assert set(found) == set(long_series)
    for p, (start, values) in long_series.items():
        n_train = max(0, min(len(values), 72 - start))
        want = arma_loop(list(map(float, values)), n_train, 3)
        assert found[p].n_train == n_train
        if want is None:
            assert found[p].phi is None and p not in ahead
            continue
        (phi, s_phi, theta), _, steps = want
        assert (found[p].phi, found[p].seasonal_phi, found[p].theta) == pytest.approx((phi, s_phi, theta), rel=1e-6, abs=1e-9)
        assert [ahead[p][h] for h in (1, 2, 3)] == pytest.approx(steps, rel=1e-6)


def test_known_coefficients_are_recovered(spark):
    """Simulated series of the model itself: the estimates come near, nearer with more years."""
    phi, s_phi, theta = 0.5, -0.4, 0.3
    rnd = random.Random(3)
    months = 2400
    e = [rnd.gauss(0, 1) for _ in range(months)]
    w = [0.0] * 13
    for t in range(13, months):
        w.append(phi * w[t - 1] + s_phi * w[t - 12] - phi * s_phi * w[t - 13] + e[t] + theta * e[t - 1])
    y = [0.0] * 13
    for t in range(13, months):
        y.append(w[t] + y[t - 1] + y[t - 12] - y[t - 13])
    rows = [(1, dt.date(1800 + i // 12, i % 12 + 1, 1), v) for i, v in enumerate(y)]
    demand = spark.createDataFrame(rows, "product_id bigint, month date, quantity double")
    split = fc.Split(dt.date(1999, 12, 1), dt.date(2000, 1, 1), dt.date(2000, 3, 31))
    one = seasonal.seasonal_arma_coefficients(demand, split).first()
    assert abs(one.phi - phi) < 0.1 and abs(one.seasonal_phi - s_phi) < 0.1 and abs(one.theta - theta) < 0.1


def test_protocols_equal_loops(spark, long_series):
    found = {(r.product_id, r.method, r.protocol): r for r in seasonal.forecast_protocols(long_demand(spark, long_series), SPLIT).collect()}
    for p, (start, values) in long_series.items():
        values = list(map(float, values))
        n_train = max(0, min(len(values), 72 - start))
        actual = values[n_train:]
        if not actual:
            assert not any(key[0] == p for key in found)
            continue
        model = arma_loop(values, n_train, 3)
        history, average_ahead = values[:n_train], []
        for _ in range(3 if n_train else 0):
            average_ahead.append(sum(history[-3:]) / len(history[-3:]))
            history.append(average_ahead[-1])
        rolling = [sum(values[max(0, i - 3) : i]) / len(values[max(0, i - 3) : i]) if i else None for i in range(n_train, len(values))]
        want = {
            ("moving_average", "rolling"): rolling,
            ("moving_average", "ahead"): average_ahead or [None] * 3,
            ("seasonal", "rolling"): [model[1][i] for i in range(n_train, len(values))] if model else [None] * 3,
            ("seasonal", "ahead"): model[2] if model else [None] * 3,
        }
        for (method, protocol), forecasts in want.items():
            errors = [abs(a - f) for a, f in zip(actual, forecasts) if f is not None]
            row = found[p, method, protocol]
            assert row.n_months == len(actual)
            assert row.mae == (pytest.approx(sum(errors) / len(errors), rel=1e-6) if errors else None)
