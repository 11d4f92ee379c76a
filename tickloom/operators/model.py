"""Ridge regression of price on row index and hour, for all entities at once.

With two features the penalised least-squares fit has a closed form in the
means, variances and correlations of the training rows. Those are ordinary
aggregates, so one grouping fits every entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numbers import r2_band
from tickloom.session import stored

# Wording of the model summary.
QUALITY_TEXT = {
    "good": "baik - model mampu menjelaskan tren dengan andal",
    "medium": "sedang - ada pola linier namun noise cukup tinggi",
    "low": "rendah - harga sangat fluktuatif dan sulit diprediksi secara linier",
}
ADVICE_TEXT = {
    "NAIK": "Pantau potensi kenaikan; pertimbangkan pembelian stok lebih awal.",
    "TURUN": "Harga cenderung turun; peluang pembelian stok dengan harga lebih murah.",
}


def fit(split: DataFrame, reg: float = 0.01, penalty: str = "mllib") -> DataFrame:
    """Coefficients per entity from its training rows.

    ``mllib`` penalises like Spark ML's LinearRegression behind a
    StandardScaler: label standardised, coefficients per sample standard
    deviation. ``ridge_sum`` adds ``reg`` to the plain sum of squares of
    features scaled by their population deviation. A feature without variance
    gets 0. The same grouping notes the row count and the hour of the last
    tick, where a forecast starts.
    """
    if penalty not in ("mllib", "ridge_sum"):
        raise ValueError(f"unknown penalty {penalty!r}")

    def train(name: str) -> Column:
        return F.when(F.col("is_train"), F.col(name).cast("double"))

    t, h, y = train("time_idx"), train("hour"), train("price")
    stats = split.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.max_by("hour", "time_idx").cast("int").alias("start_hour"),
        F.count(y).alias("n"),
        F.avg(t).alias("mean_time"),
        F.avg(h).alias("mean_hour"),
        F.avg(y).alias("mean_y"),
        F.sqrt(F.var_pop(t)).alias("sd_t"),
        F.sqrt(F.var_pop(h)).alias("sd_h"),
        F.sqrt(F.var_pop(y)).alias("sd_y"),
        F.covar_pop(t, h).alias("c_th"),
        F.covar_pop(t, y).alias("c_ty"),
        F.covar_pop(h, y).alias("c_hy"),
    )

    def corr(cov: str, a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(cov), F.col(a) * F.col(b)), F.lit(0.0))

    n = F.col("n").cast("double")
    if penalty == "mllib":
        lam, widen = F.try_divide(F.lit(reg), F.col("sd_y")), F.sqrt(n / (n - 1))
    else:
        lam, widen = F.lit(reg) / n, F.lit(1.0)
    solved = stats.withColumns(
        {
            "r_th": corr("c_th", "sd_t", "sd_h"),
            "r_ty": corr("c_ty", "sd_t", "sd_y"),
            "r_hy": corr("c_hy", "sd_h", "sd_y"),
            "a": 1 + F.coalesce(lam, F.lit(0.0)),
            "widen": widen,
        }
    )
    det = F.col("a") * F.col("a") - F.col("r_th") * F.col("r_th")

    def weight(own: str, other: str, sd: str) -> Column:
        cramer = F.try_divide(F.col("a") * F.col(own) - F.col("r_th") * F.col(other), det)
        scaled = cramer * F.col("sd_y") * F.col("widen")
        return F.when((F.col(sd) > 0) & (F.col("sd_y") > 0), scaled).otherwise(0.0)

    return solved.select(
        "entity",
        weight("r_ty", "r_hy", "sd_t").alias("coef_time"),
        weight("r_hy", "r_ty", "sd_h").alias("coef_hour"),
        F.col("mean_y").alias("intercept"),
        "mean_time",
        "mean_hour",
        (F.col("sd_t") * F.col("widen")).alias("scale_time"),
        (F.col("sd_h") * F.col("widen")).alias("scale_hour"),
        "n_total",
        "start_hour",
    )


def fit_once(
    split: DataFrame, reg: float = 0.01, penalty: str = "mllib"
) -> tuple[DataFrame, DataFrame]:
    """The rows and their fit, both written to the scratch space.

    Scores and forecasts read them from there, so the ticks are sorted once only.
    """
    rows = stored(
        split.select("entity", "time_idx", "hour", "price", "n_total", "is_train"), "features"
    )
    return rows, stored(fit(rows, reg, penalty), "coefficients")


def predicted(time_idx: Column, hour: Column) -> Column:
    """Model value; the frame holds the columns of ``fit``."""

    def term(x: Column, which: str) -> Column:
        z = F.try_divide(x - F.col(f"mean_{which}"), F.col(f"scale_{which}"))
        return F.col(f"coef_{which}") * F.coalesce(z, F.lit(0.0))

    return F.col("intercept") + term(time_idx, "time") + term(hour, "hour")


def metrics(split: DataFrame, model: DataFrame) -> DataFrame:
    """R², RMSE and MAE on training and test rows; R² is null without variance."""
    scored = (
        split.select("entity", "time_idx", "hour", "price", "is_train")
        .join(model, "entity")
        .withColumn("_e", F.col("price") - predicted(F.col("time_idx"), F.col("hour")))
    )
    per_set = {}
    for name, rows in (("train", F.col("is_train")), ("test", ~F.col("is_train"))):
        error, price = F.when(rows, F.col("_e")), F.when(rows, F.col("price"))
        per_set |= {
            f"n_{name}": F.count(error),
            f"_mse_{name}": F.avg(error * error),
            f"mae_{name}": F.avg(F.abs(error)),
            f"_var_{name}": F.var_pop(price),
        }
    stats = scored.groupBy("entity").agg(*[c.alias(k) for k, c in per_set.items()])
    out = ["entity", (F.col("n_train") + F.col("n_test")).alias("n_total"), "n_train", "n_test"]
    for name in ("train", "test"):
        mse = F.col(f"_mse_{name}")
        out += [
            (1 - F.try_divide(mse, F.col(f"_var_{name}"))).alias(f"r2_{name}"),
            F.sqrt(mse).alias(f"rmse_{name}"),
            f"mae_{name}",
        ]
    return stats.select(*out)


def forecast(model: DataFrame, steps: int = 5, start_hour: Column | None = None) -> DataFrame:
    """Model values for the next steps; the hour advances by one per step.

    The first hour follows the one of the last tick unless ``start_hour`` is given.
    """
    if start_hour is not None:
        model = model.withColumn("start_hour", start_hour)
    step = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    future = model.select("*", step).withColumns(
        {
            "time_idx": F.col("n_total") - 1 + F.col("step"),
            "hour": (F.col("start_hour") + F.col("step")) % 24,
        }
    )
    price = predicted(F.col("time_idx"), F.col("hour"))
    return future.select("entity", "step", "time_idx", "hour", price.alias("price_pred"))


def summary_text() -> Column:
    """One sentence on direction and fit; needs the report columns."""

    def pick(key: Column, texts: dict[str, str]) -> Column:
        out = F.lit(None).cast("string")
        for name, text in texts.items():
            out = F.when(key == name, text).otherwise(out)
        return out

    r2 = F.coalesce(F.format_string("%.4f", F.col("r2_test")), F.lit("-"))
    # The wording of the sentence.
    return F.concat(
        F.lit("Harga "),
        F.col("entity"),
        F.lit(" cenderung "),
        F.col("direction"),
        F.format_string(" (koef_waktu=%.4f). Akurasi model ", F.col("coef_time")),
        pick(F.col("quality"), QUALITY_TEXT),
        F.lit(": R2_test="),
        r2,
        F.lit(", RMSE_test=Rp"),
        F.format_number("rmse_test", 0),
        F.lit(". "),
        pick(F.col("direction"), ADVICE_TEXT),
    )


def scored_models(split: DataFrame, model: DataFrame) -> DataFrame:
    """Fit and scores per entity with the direction and a quality band."""
    coefficients = model.select("entity", "coef_time", "coef_hour", "intercept")
    return (
        metrics(split, model.drop("n_total", "start_hour"))
        .join(coefficients, "entity")
        .withColumns(
            {
                "direction": F.when(F.col("coef_time") > 0, "NAIK").otherwise("TURUN"),
                "quality": r2_band("r2_test"),
            }
        )
    )


def model_report(
    split: DataFrame,
    reg: float = 0.01,
    penalty: str = "mllib",
    steps: int = 5,
    start_hour: Column | None = None,
) -> DataFrame:
    """One record per entity: fit, scores, forecast array, direction and text."""
    split, model = fit_once(split, reg, penalty)
    ahead = forecast(model, steps, start_hour)
    points = F.array_sort(F.collect_list(F.struct("step", "time_idx", "hour", "price_pred")))
    ahead = ahead.groupBy("entity").agg(points.alias("forecast"))
    return scored_models(split, model).join(ahead, "entity").withColumn("text", summary_text())


def leaderboard(report: DataFrame) -> DataFrame:
    """Best and worst entity by test R², and how many entities rise and fall."""
    by_r2 = F.when(F.col("r2_test").isNotNull(), F.struct("r2_test", "entity"))
    return report.agg(
        F.max(by_r2).alias("_best"),
        F.min(by_r2).alias("_worst"),
        F.count_if(F.col("direction") == "NAIK").alias("n_up"),
        F.count_if(F.col("direction") == "TURUN").alias("n_down"),
    ).select(
        F.col("_best.entity").alias("best"),
        F.col("_best.r2_test").alias("best_r2"),
        F.col("_worst.entity").alias("worst"),
        F.col("_worst.r2_test").alias("worst_r2"),
        "n_up",
        "n_down",
    )


def direction_lists(report: DataFrame, first: Sequence[str] = ()) -> DataFrame:
    """All entities that rise and that fall, comma-separated, '-' if none.

    Those of ``first`` come first and in that order, the others by name.
    """
    place = F.array_position(F.lit(list(first)).cast("array<string>"), F.col("entity").cast("string"))
    named = report.select(
        F.col("entity").cast("string").alias("_name"),
        F.when(place > 0, place).otherwise(len(first) + 1).alias("_place"),
        "direction",
    )

    def names(direction: str) -> Column:
        listed = F.expr(
            f"listagg(CASE WHEN direction = '{direction}' THEN _name END, ', ') "
            "WITHIN GROUP (ORDER BY _place, _name)"
        )
        return F.coalesce(F.nullif(listed, F.lit("")), F.lit("-"))

    return named.agg(names("NAIK").alias("up"), names("TURUN").alias("down"))
