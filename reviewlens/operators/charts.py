"""The tables under the charts; drawing them is left to any plotting tool."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions import dates
from reviewlens.session import settle

QUARTILES = {0.0: "lowest", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "highest"}


def rating_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("Score").agg(F.count("*").alias("n_reviews"))


def sentiment_pivot(df: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Mean sentiment with one row per month and one column per year, of all years by default."""
    if years is None:
        found = df.select(F.year("Time").alias("y")).distinct().orderBy("y").collect()
        years = [r["y"] for r in found if r["y"] is not None]
    dated = df.select(
        dates.month_start(F.col("Time")).alias("month"), F.year("Time").alias("year"), "sentiment_score"
    )
    table = dated.groupBy("month").pivot("year", list(years)).agg(F.avg("sentiment_score"))
    return table.withColumnsRenamed({str(y): f"y{y}" for y in years})


def daily_timeline(df: DataFrame) -> DataFrame:
    """Per day: mean rating and mean sentiment."""
    return df.groupBy(F.to_date("Time").alias("day")).agg(
        F.avg("Score").alias("score_mean"), F.avg("sentiment_score").alias("sentiment_mean")
    )


def length_helpfulness_bins(
    df: DataFrame, length_width: int = 500, ratio_width: float = 0.1
) -> DataFrame:
    """Reviews per cell of length and helpfulness: the scatter chart at any size."""
    return df.groupBy(
        F.floor(F.col("text_length") / length_width).cast("bigint").alias("length_bin"),
        F.floor(F.round(F.col("helpfulness_ratio") / ratio_width, 9)).cast("bigint").alias("ratio_bin"),
    ).agg(F.count("*").alias("n_reviews"))


def sentiment_boxplot(products: DataFrame, digits: int = 1, cells: int = 1024) -> DataFrame:
    """Quartiles of product sentiment per rounded mean rating, from ``product_sentiment``.

    Exact, by counting: values are counted in cells of width ``1 / cells``, running counts over
    the cells find those in which a quartile's two neighbours lie, and only the values of these
    cells are put in order. No task holds a rating's values.
    """
    rated = products.select(
        F.round("score_mean", digits).alias("rating"),
        F.col("sentiment_mean").alias("value"),
        F.floor(F.col("sentiment_mean") * cells).alias("cell"),
    ).where(F.col("value").isNotNull())
    counts = settle(rated.groupBy("rating", "cell").agg(F.count("*").alias("n")), "box-cells")
    upto = F.sum("n").over(Window.partitionBy("rating").orderBy("cell"))
    placed = counts.select("rating", "cell", (upto - F.col("n")).alias("start"), upto.alias("end"))
    sizes = counts.groupBy("rating").agg(F.sum("n").alias("n_products"))
    at = (F.col("n_products") - 1) * F.col("share")
    shares = F.array(*[F.struct(F.lit(q).alias("share"), F.lit(n).alias("name")) for q, n in QUARTILES.items()])
    wanted = sizes.select("rating", "n_products", F.inline(shares)).select(
        "rating", "n_products", "name", at.alias("at"),
        F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("index"),
    )
    spots = wanted.join(placed, "rating").where("index >= start AND index < end")
    spots = settle(spots, "box-spots")
    cellmates = rated.join(spots.select("rating", "cell").distinct(), ["rating", "cell"])
    values = cellmates.groupBy("rating", "cell", "value").agg(F.count("*").alias("n"))
    last = F.sum("n").over(Window.partitionBy("rating", "cell").orderBy("value"))
    ranked = values.select("rating", "cell", "value", (last - F.col("n")).alias("low"), last.alias("high"))
    inside = F.col("index") - F.col("start")
    found = spots.join(ranked, ["rating", "cell"]).where((inside >= F.col("low")) & (inside < F.col("high")))
    near = F.when(F.floor("at") == F.ceil("at"), 1.0).otherwise(F.lit(1.0) - F.abs(F.col("at") - F.col("index")))
    part = F.col("value") * near
    return found.groupBy("rating").agg(
        F.first("n_products").alias("n_products"),
        *[F.sum(F.when(F.col("name") == n, part)).alias(n) for n in QUARTILES.values()],
    )


def top_rows(df: DataFrame, value: str, name: str, n: int = 10) -> DataFrame:
    """The ``n`` rows of largest ``value``, ties by ``name``."""
    return df.orderBy(F.desc(value), name).limit(n)


def coherence_chart(scores: DataFrame) -> DataFrame:
    """Mean coherence per number of topics."""
    return scores.groupBy(F.col("k").alias("n_topics")).agg(
        F.avg("coherence").alias("coherence_score")
    )
