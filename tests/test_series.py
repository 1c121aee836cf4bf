"""Series models against direct, one-process computations on small inputs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fluxwatch.operators.timeseries import compare, linear, regimes, volatility
from fluxwatch.operators.timeseries.anomaly import above_forecast, variance_shock
from fluxwatch.operators.timeseries.frame import fill_gaps, lagged, series_frame


def arma(n, phi, theta, seed, mean=0.0, seasonal=0.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 50)
    w = np.zeros(n + 50)
    for t in range(12, n + 50):
        w[t] = phi * w[t - 1] + seasonal * w[t - 10] - phi * seasonal * w[t - 11] + e[t] + theta * e[t - 1]
    return mean + w[50:]


def garch(n, mu, omega, alpha, beta, seed):
    rng = np.random.default_rng(seed)
    y, h, r = np.empty(n), omega / (1 - alpha - beta), 0.0
    for t in range(n):
        h = omega + alpha * r * r + beta * h
        r = np.sqrt(h) * rng.normal()
        y[t] = mu + r
    return y


def regime_series(n, seed):
    rng = np.random.default_rng(seed)
    y, s, before = np.empty(n), 0, 0.0
    means, slopes = (0.0, 6.0), (0.2, 0.6)
    for t in range(n):
        was, s = s, s if rng.random() < 0.95 else 1 - s
        before = means[s] + slopes[s] * (before - means[was]) + rng.normal()
        y[t] = before
    return y


def frame_of(spark, named: dict[str, np.ndarray]):
    rows = []
    for k, y in named.items():
        sent = y / 3 + np.sin(np.arange(len(y)) ** 2)
        rows += [(k, i, float(v), float(a), float(v - a)) for i, (v, a) in enumerate(zip(y, sent))]
    return series_frame(spark.createDataFrame(rows, "series_id string, time_bucket long, total double, tx double, rx double"))


def collected(df):
    return {r["series_id"]: r for r in df.collect()}


# ---- order, lags, gaps ----


def test_positions_and_split(spark, small_blocks):
    rng = np.random.default_rng(1)
    rows = [(k, int(t)) for k in "ab" for t in sorted(rng.choice(3000, 700, replace=False))]
    rows += [("c", -5), ("c", 0), ("c", 70)]
    df = spark.createDataFrame(rows, "series_id string, time_bucket long")
    got = series_frame(df).toPandas().sort_values(["series_id", "time_bucket"])
    expected = pd.DataFrame(rows, columns=["s", "t"]).sort_values(["s", "t"])
    assert list(got.idx) == list(expected.groupby("s").cumcount())
    sizes = got.groupby("series_id").first()
    assert sizes.n.tolist() == [700, 700, 3] and sizes.n_train.tolist() == [560, 560, 2]
    assert got[got.is_train].groupby("series_id").size().tolist() == [560, 560, 2]
    assert got[got.step == 1].idx.tolist() == [560, 560, 2]


def test_lags_cross_blocks(spark, small_blocks):
    y = np.arange(1000.0)
    got = lagged(frame_of(spark, {"a": y, "b": -y}), {"total": 3}).toPandas()
    assert len(got) == 2000
    for name, sign in (("a", 1), ("b", -1)):
        part = got[got.series_id == name].sort_values("idx")
        for d in (1, 2, 3):
            np.testing.assert_array_equal(part[f"total_{d}"][d:], sign * y[:-d])
            assert part[f"total_{d}"][:d].isna().all()


def test_gaps(spark, small_blocks):
    rows = [("a", t, 1.0) for t in (3, 200, 201, 500)] + [("b", 9, 1.0)]
    df = spark.createDataFrame(rows, "series_id string, time_bucket long, total double")
    got = fill_gaps(df, ["total"]).toPandas()
    assert sorted(got[got.series_id == "a"].time_bucket) == list(range(3, 501))
    assert got.total.sum() == 5.0 and len(got) == 499


# ---- ARMA family ----


def conditional_squares(w, phi, theta, seasonal=0.0):
    """Sum of squares by the plain recursion with zeros before the start."""
    e = np.zeros(len(w))
    at = lambda x, i: x[i] if i >= 0 else 0.0
    for t in range(len(w)):
        e[t] = (
            w[t] - phi * at(w, t - 1) - seasonal * at(w, t - 10) + phi * seasonal * at(w, t - 11) - theta * at(e, t - 1)
        )
    return float(e @ e)


@pytest.mark.parametrize("blocks", ["whole", "cut"])
def test_arma_family_minimises_the_conditional_squares(spark, request, blocks):
    if blocks == "cut":
        request.getfixturevalue("small_blocks")
    series = {
        "level": arma(500, 0.6, 0.3, 1, mean=20.0),
        "walk": 50 + np.cumsum(arma(500, 0.5, -0.3, 2)),
        "season": 50 + np.cumsum(arma(500, 0.4, 0.3, 3, seasonal=0.5)),
        "short": arma(30, 0.5, 0.2, 4, mean=5.0),
    }
    frame = frame_of(spark, series)
    for fit, difference, free in ((linear.fit_arma, False, 2), (linear.fit_arima, True, 2), (linear.fit_sarima, True, 3)):
        found = collected(fit(frame))
        for name, y in series.items():
            train = y[: int(len(y) * 0.8)]
            w = np.diff(train) if difference else train - train.mean()
            row = found[name]
            c = list(row["params"][:free])
            best = conditional_squares(w, *c)
            assert row["nobs"] == len(w)
            assert row["params"][-1] * len(w) == pytest.approx(best, rel=1e-9)
            llf = -0.5 * len(w) * (np.log(2 * np.pi * best / len(w)) + 1)
            assert row["llf"] == pytest.approx(llf, rel=1e-9)
            for i in range(free):
                for d in (-0.01, 0.01):
                    other = c.copy()
                    other[i] += d
                    if all(abs(x) < 0.99 for x in other):
                        assert conditional_squares(w, *other) > best, (name, fit.__name__)
            assert row["aic"] == pytest.approx(2 * row["k"] - 2 * row["llf"])
            assert row["bic"] == pytest.approx(row["k"] * np.log(len(w)) - 2 * row["llf"])
    phi, theta = collected(linear.fit_arma(frame))["level"]["params"][:2]
    w = series["level"][:400] - series["level"][:400].mean()
    grid = [conditional_squares(w, a, b) for a in np.arange(-0.9, 0.95, 0.1) for b in np.arange(-0.9, 0.95, 0.1)]
    assert conditional_squares(w, phi, theta) <= min(grid)
    season = collected(linear.fit_sarima(frame))["season"]["params"]
    assert season[2] == pytest.approx(0.5, abs=0.12)


@pytest.mark.parametrize("n, theta, difference", [(288, None, True), (5000, -0.95, False), (9000, -0.98, False)])
def test_strong_moving_averages_need_the_whole_past(spark, n, theta, difference):
    """Differenced white noise, and shocks that fade slowly; the longer series go over several blocks."""
    noise = np.random.default_rng(n).normal(size=n)
    y = noise if theta is None else noise + np.r_[0.0, theta * noise[:-1]]
    frame = frame_of(spark, {"a": y})
    row = collected((linear.fit_arima if difference else linear.fit_arma)(frame))["a"]
    train = y[: int(n * 0.8)]
    w = np.diff(train) if difference else train - train.mean()
    best = conditional_squares(w, *row["params"][:2])
    assert row["params"][-1] * len(w) == pytest.approx(best, rel=1e-6)
    for i, d in ((0, 1e-3), (0, -1e-3), (1, 1e-3), (1, -1e-3)):
        other = list(row["params"][:2])
        other[i] = float(np.clip(other[i] + d, -0.999, 0.999))
        assert conditional_squares(w, *other) >= best * (1 - 1e-9)


@pytest.mark.parametrize("fit", sorted(set(compare.FITS) - {"VAR"}))
def test_a_gap_fails_the_series_alone(spark, fit):
    y = arma(120, 0.5, 0.2, 3, mean=30.0)
    frame = frame_of(spark, {"sound": y, "gap": y})
    columns = [c for c in ("y", "total", "tx", "rx") if c in frame.columns]
    broken = frame.withColumns({c: F.when((F.col("series_id") == "gap") & (F.col("idx") == 40), F.lit(None)).otherwise(F.col(c)) for c in columns})
    found = collected(compare.FITS[fit](broken))
    assert found["gap"]["llf"] is None and found["sound"]["llf"] is not None


def test_parameter_counts_of_the_published_table(spark):
    """k and n of each model for a series of 55 rows (44 for training)."""
    frame = frame_of(spark, {"a": 1000 + 300 * arma(55, 0.5, 0.2, 9)})
    expected = {
        "ARMA(1,1)": (4, 44), "ARIMA(1,1,1)": (3, 43), "SARIMA": (4, 43), "ARCH(1)": (3, 44),
        "GARCH(1,1)": (4, 44), "TAR": (7, 43),
    }
    for name, counts in expected.items():
        row = compare.FITS[name](frame).first()
        assert (row["k"], row["nobs"]) == counts, name
        assert row["aic"] == pytest.approx(2 * row["k"] - 2 * row["llf"])
        assert row["bic"] == pytest.approx(row["k"] * np.log(row["nobs"]) - 2 * row["llf"])


def test_forecasts_follow_the_recursion(spark, small_blocks):
    """More steps than a block, so that later parts start from a matrix power."""
    series = {"a": 50 + np.cumsum(arma(800, 0.4, 0.3, 3, seasonal=0.5)), "b": arma(800, 0.9, 0.2, 8, mean=9.0)}
    frame = frame_of(spark, series)
    for fit, difference in ((linear.fit_arma, False), (linear.fit_arima, True), (linear.fit_sarima, True)):
        models = fit(frame)
        params = collected(models)
        ahead = linear.forecast(models, frame).toPandas()
        for name, y in series.items():
            train = y[:640]
            p = params[name]["params"]
            phi, theta, seasonal = p[0], p[1], p[2] if fit is linear.fit_sarima else 0.0
            mean = 0.0 if difference else train.mean()
            w = list(np.diff(train) if difference else train - mean)
            e = []
            for t in range(len(w)):
                lag = lambda d: w[t - d] if t >= d else 0.0
                e.append(w[t] - phi * lag(1) - seasonal * lag(10) + phi * seasonal * lag(11) - theta * (e[-1] if e else 0.0))
            for h in range(160):
                shock = theta * e[-1] if h == 0 else 0.0
                w.append(phi * w[-1] + seasonal * w[-10] - phi * seasonal * w[-11] + shock)
            tail = np.array(w[-160:])
            expected = train[-1] + np.cumsum(tail) if difference else mean + tail
            got = ahead[ahead.series_id == name].sort_values("step")
            assert got.step.tolist() == list(range(1, 161))
            np.testing.assert_allclose(got.yhat, expected, rtol=1e-6, atol=1e-4)


def test_constant_series_fails_alone(spark):
    frame = frame_of(spark, {"flat": np.ones(60), "fine": arma(60, 0.5, 0.1, 1)})
    for fit in compare.FITS.values():
        rows = collected(fit(frame))
        assert set(rows) == {"flat", "fine"}
        assert rows["flat"]["llf"] is None and rows["fine"]["llf"] is not None


# ---- VAR ----


def var_by_hand(x, p, skip):
    """(coefficients, residual covariance) by least squares on rows from ``skip`` on."""
    rows = range(skip, len(x))
    z = np.array([np.r_[1.0, *[x[t - j] for j in range(1, p + 1)]] for t in rows])
    beta, *_ = np.linalg.lstsq(z, x[skip:], rcond=None)
    e = x[skip:] - z @ beta
    return beta, e.T @ e / len(e), len(e)


@pytest.mark.parametrize("seed, kind", [(1, "two"), (2, "one"), (3, "none")])
def test_var(spark, seed, kind):
    rng = np.random.default_rng(seed)
    a1 = {"two": [[0.4, 0.2], [0.1, 0.3]], "one": [[0.5, -0.2], [0.3, 0.2]], "none": [[0, 0], [0, 0]]}[kind]
    a2 = [[0.3, 0.0], [0.0, 0.4]] if kind == "two" else [[0, 0], [0, 0]]
    x = np.zeros((400, 2))
    for t in range(2, 400):
        x[t] = [1.0, 2.0] + np.array(a1) @ x[t - 1] + np.array(a2) @ x[t - 2] + rng.normal(size=2)
    rows = [("a", t, float(v[0]), float(v[1]), float(v.sum())) for t, v in enumerate(x)]
    frame = series_frame(spark.createDataFrame(rows, "series_id string, time_bucket long, tx double, rx double, total double"))
    train = x[:320]

    def aic(p):
        _, cov, n = var_by_hand(train, p, 2)
        return np.linalg.slogdet(cov)[1] + 2 / n * (4 * p + 2)

    order = min(range(3), key=aic)
    beta, cov, n = var_by_hand(train, order, order)
    models = linear.fit_var(frame)
    row = models.first()
    assert (row["nobs"], row["k"]) == (n, 4 * order + 2)
    np.testing.assert_allclose(np.array(row["params"]).reshape(-1, 2), beta, rtol=1e-7, atol=1e-9)
    logdet = np.linalg.slogdet(cov)[1]
    assert row["aic"] == pytest.approx(logdet + 2 / n * (4 * order + 2))
    assert row["llf"] == pytest.approx(-n * np.log(2 * np.pi) - n / 2 * (logdet + 2))
    path = list(train)
    for _ in range(80):
        path.append(beta[0] + sum(beta[1 + 2 * j : 3 + 2 * j].T @ path[-1 - j] for j in range(order)))
    got = linear.forecast(models, frame).orderBy("step").toPandas()
    np.testing.assert_allclose(got.yhat, np.array(path[320:]).sum(1), rtol=1e-7)


# ---- volatility ----


def backcast_of(y):
    r = y[:75] - y.mean()
    w = 0.94 ** np.arange(len(r))
    return float((w * r * r).sum() / w.sum())


def variance_by_hand(y, mu, omega, alpha, beta, start):
    h, before, out = start, start, []
    for v in y:
        h = omega + alpha * before + beta * h
        before = (v - mu) ** 2
        out.append(h)
    return np.array(out)


def garch_llf(y, p, start):
    h = variance_by_hand(y, *p, start)
    return float(-0.5 * (np.log(2 * np.pi * h) + (y - p[0]) ** 2 / h).sum())


def test_garch_reaches_the_likelihood_maximum(spark):
    series = {"a": garch(500, 5.0, 0.3, 0.2, 0.6, 1), "b": garch(700, 1.0, 0.1, 0.1, 0.8, 3), "c": garch(60, 1.0, 0.5, 0.3, 0.2, 5)}
    frame = frame_of(spark, series)
    rounds = 200  # fits that have not settled by then have no likelihood
    series["noise"] = np.random.default_rng(8).normal(size=300)
    frame = frame_of(spark, series)
    arch, full = (collected(f(frame, rounds=rounds)) for f in (volatility.fit_arch, volatility.fit_garch))
    assert all(full[name]["llf"] >= arch[name]["llf"] - 1e-5 for name in series)
    for fit, k in ((volatility.fit_arch, 3), (volatility.fit_garch, 4)):
        found = collected(fit(frame, rounds=rounds))
        for name, y in series.items():
            train = y[: int(len(y) * 0.8)]
            start = backcast_of(train)
            row = found[name]
            p = [*row["params"], 0.0][:4]
            assert len(row["params"]) == k
            assert row["llf"] == pytest.approx(garch_llf(train, p, start), rel=1e-9)
            # no better point nearby
            rng = np.random.default_rng(0)
            scale = np.array([0.05 * train.std(), 0.1 * p[1], 0.05, 0.05])
            for _ in range(200):
                q = np.array(p) + rng.normal(size=4) * scale * rng.choice([0.1, 1.0])
                if k == 3:
                    q[3] = 0.0
                if q[1] > 0 and q[2] >= 0 and q[3] >= 0 and q[2] + q[3] < 0.9999:
                    assert garch_llf(train, q, start) <= row["llf"] + 2e-3, (name, k)


def test_cut_series_give_the_same_variance(spark, small_blocks):
    y = garch(1000, 5.0, 0.3, 0.2, 0.6, 7)
    frame = frame_of(spark, {"a": y, "b": y[:50]})
    given = spark.createDataFrame([("a", [5.0, 0.3, 0.2, 0.6]), ("b", [5.0, 0.3, 0.2])], "series_id string, params array<double>")
    got = volatility.variance_path(frame, given).toPandas()
    for name, n, p in (("a", 1000, (5.0, 0.3, 0.2, 0.6)), ("b", 50, (5.0, 0.3, 0.2, 0.0))):
        part = got[got.series_id == name].sort_values("idx")
        train = y[: int(n * 0.8)]
        assert part.idx.tolist() == list(range(n))
        np.testing.assert_allclose(part.variance, variance_by_hand(y[:n], *p, backcast_of(train)), rtol=1e-9)


# ---- switching regimes ----


def switching_llf(y, p):
    p00, p10, m0, m1, f0, f1, v = p
    m, f = (m0, m1), (f0, f1)
    chain = np.array([[p00, p10], [1 - p00, 1 - p10]])
    share = p10 / (1 - p00 + p10)
    state, total = np.array([share, 1 - share]), 0.0
    for t in range(1, len(y)):
        dense = np.array(
            [[np.exp(-0.5 * (y[t] - m[i] - f[i] * (y[t - 1] - m[j])) ** 2 / v) / np.sqrt(2 * np.pi * v) for j in range(2)] for i in range(2)]
        )
        state = (chain * dense) @ state
        total += np.log(state.sum())
        state /= state.sum()
    return total


def test_switching_reaches_the_likelihood_maximum(spark):
    series = {"a": regime_series(400, 1), "b": regime_series(300, 4), "c": regime_series(70, 6)}
    frame = frame_of(spark, series)
    found = collected(regimes.fit_switching(frame, rounds=150))
    for name, y in series.items():
        train = y[: int(len(y) * 0.8)]
        row = found[name]
        assert row["nobs"] == len(train) - 1
        best = switching_llf(train, row["params"])
        assert best >= row["llf"] - 1e-6
        assert row["llf"] == pytest.approx(best, abs=0.02)
        rng = np.random.default_rng(0)
        for _ in range(60):
            q = np.array(row["params"]) + rng.normal(size=7) * [0.02, 0.02, 0.1, 0.1, 0.05, 0.05, 0.05]
            if 0 < q[0] < 1 and 0 < q[1] < 1 and q[6] > 0:
                # the start of the chain is not part of the update
                assert switching_llf(train, q) <= best + 0.1, name


def test_cut_and_whole_rounds_agree(spark, monkeypatch):
    """The same rounds over one block and over many linked blocks."""
    y = {"a": regime_series(330, 2)}
    g = {"a": garch(330, 5.0, 0.3, 0.2, 0.6, 1)}
    whole = regimes.fit_switching(frame_of(spark, y), rounds=2).first()["params"]
    whole_g = volatility.fit_garch(frame_of(spark, g), rounds=2).first()["params"]
    from fluxwatch.operators.timeseries import blocks, frame

    for module in (blocks, frame, linear, volatility):
        monkeypatch.setattr(module, "BLOCK", 32)
    monkeypatch.setattr(blocks, "FAN", 3)
    cut = regimes.fit_switching(frame_of(spark, y), rounds=2).first()["params"]
    cut_g = volatility.fit_garch(frame_of(spark, g), rounds=2).first()["params"]
    np.testing.assert_allclose(cut, whole, rtol=1e-8)
    np.testing.assert_allclose(cut_g, whole_g, rtol=1e-8)


# ---- comparison ----


def test_forecast_error_skips_missing(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", 3.0, float("nan")), ("a", None, 1.0), ("a", 5.0, 2.0), ("b", float("nan"), 1.0)],
        "k string, y double, yhat double",
    )
    got = {r["k"]: r for r in compare.forecast_error(rows, "y", "yhat", ["k"]).collect()}
    assert got["a"]["rmse"] == pytest.approx(np.sqrt(5.0)) and got["a"]["mae"] == 2.0
    assert got["b"]["rmse"] is None and got["b"]["mae"] is None


def test_table_and_rank(spark):
    frame = frame_of(spark, {"a": 50 + np.cumsum(arma(200, 0.4, 0.1, 1)), "b": 20 + arma(200, 0.5, 0.1, 2)})
    models = compare.fit_models(frame, ["ARMA(1,1)", "ARIMA(1,1,1)", "ARCH(1)", "VAR"])
    compared = compare.actual_and_forecast(models, frame)
    ranked = compare.rank_models(compare.model_table(models, compared)).toPandas()
    assert len(ranked) == 8 and (ranked.groupby("series_id").winner.sum() == 1).all()
    for _, part in ranked.groupby("series_id"):
        known = part[part.rmse.notna()].sort_values("rmse_rank")
        assert known.rmse.is_monotonic_increasing and known.rmse_rank.tolist() == [1, 2, 3]
        assert part[part.model == "ARCH(1)"].rmse_rank.isna().all()
        assert part[part.model == "VAR"].aic_rank.isna().all()
        assert known.iloc[0].winner
    assert (ranked.fit_seconds > 0).all()
    plot = compare.plot_rows(compared, frame).toPandas()
    assert set(plot.model) == {"Actual", "ARMA(1,1)", "ARIMA(1,1,1)", "VAR"} and len(plot) == 4 * 2 * 40


def test_flags(spark):
    rows = spark.createDataFrame([(10.0, 1.0, 3.0, 1.0), (2.0, 1.0, 1.0, 1.0), (None, 1.0, None, 1.0)], "y double, yhat double, r double, variance double")
    flagged = variance_shock(above_forecast(rows, "y", "yhat", F.lit(2.0), 3.0), k=4.0).collect()
    assert [(r["is_anomaly"], r["is_shock"]) for r in flagged] == [(True, True), (False, False), (False, False)]


def test_fits_that_do_not_settle_are_reported(spark):
    """At the cap of rounds there are no criteria and no forecast errors, and the table says so."""
    for fit, y in ((volatility.fit_garch, garch(500, 5.0, 0.3, 0.2, 0.6, 1)), (regimes.fit_switching, regime_series(400, 1))):
        frame = frame_of(spark, {"a": y})
        early, full = fit(frame, rounds=1).first(), fit(frame).first()
        assert not early["converged"] and early["llf"] is early["aic"] is early["nobs"] is None
        assert full["converged"] and full["llf"] is not None
    models = compare.fit_models(frame_of(spark, {"a": np.ones(50)}), ["GARCH(1,1)", "TAR", "ARMA(1,1)"])
    assert [r["converged"] for r in models.collect()] == [False] * 3


def test_one_pass_equals_fits_one_by_one(spark):
    """Packed series and the fits over blocks give the same rows, unusable series included."""
    named = {
        "long": 50 + np.cumsum(arma(400, 0.4, 0.2, 1)), "season": 20 + arma(300, 0.5, 0.1, 2, seasonal=0.4), "calm": garch(350, 5.0, 0.3, 0.2, 0.6, 3),
        "modes": regime_series(300, 4), "flat": np.ones(50), "short": np.arange(5.0) ** 2, "hole": np.r_[arma(40, 0.3, 0.1, 5), np.nan, np.ones(30)],
    }
    frame = frame_of(spark, named).cache()
    packed = compare.fit_models(frame).drop("fit_seconds").toPandas().set_index(["model", "series_id"])
    assert len(packed) == len(named) * len(compare.FITS)
    for name, fit in compare.FITS.items():
        for row in fit(frame).collect():
            got = packed.loc[(name, row["series_id"])]
            assert bool(got["converged"]) == bool(row["converged"]), (name, row["series_id"])
            if not row["converged"]:
                assert pd.isna(got["aic"])
                continue
            assert (got["k"], got["nobs"]) == (row["k"], row["nobs"])
            for c in ("llf", "aic", "bic"):
                assert got[c] == pytest.approx(row[c], rel=1e-7), (name, row["series_id"], c)
            np.testing.assert_allclose(got["params"], row["params"], rtol=2e-4, atol=2e-4, err_msg=f"{name} {row['series_id']}")
            if row["state"] is not None:
                np.testing.assert_allclose(got["state"], row["state"], rtol=1e-3, atol=1e-3)


def test_table_of_long_and_short_series(spark, request):
    """Series beyond a block take the chain of jobs, the others one pass; the table has both."""
    named = {"brief": 50 + arma(60, 0.4, 0.2, 1), "long": 50 + arma(400, 0.4, 0.2, 2)}
    whole = {r["series_id"]: r for r in compare.fit_models(frame_of(spark, named), ["ARMA(1,1)"]).collect()}
    request.getfixturevalue("small_blocks")
    cut = {r["series_id"]: r for r in compare.fit_models(frame_of(spark, named), ["ARMA(1,1)"]).collect()}
    assert cut.keys() == whole.keys() == named.keys()
    for k in named:
        np.testing.assert_allclose(cut[k]["params"], whole[k]["params"], rtol=1e-5)
