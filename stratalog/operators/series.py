"""Latest values of market series and their freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.config import SeriesConfig, SkewConfig
from stratalog.functions.times import micros
from stratalog.operators.lifetimes import lifetime_starts
from stratalog.operators.skew import last_known, mark_blocks, scan_marked


def latest(df: DataFrame) -> DataFrame:
    """Newest row per series, complete or not, with ``error`` null when it is usable."""
    newest = df.groupBy("series").agg(
        F.max_by(F.struct("period", "value"), F.struct("period")).alias("r")
    )
    return newest.select(
        "series",
        F.col("r.period").alias("period"),
        F.col("r.value").alias("value"),
        F.when(
            F.col("r.value").isNull() | F.col("r.period").isNull(),
            F.concat(F.lit("incomplete row for series "), F.col("series")),
        ).alias("error"),
    )


def latest_checked(df: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable latest values of the wanted series, and ``(series, error)`` for the others."""
    all_ = wanted.join(latest(df).withColumn("_have", F.lit(True)), "series", "left").withColumn(
        "error",
        F.when(
            F.col("_have").isNull(), F.concat(F.lit("no data for series "), F.col("series"))
        ).otherwise(F.col("error")),
    )
    good = all_.where("error is null").select("series", "period", "value")
    return good, all_.where("error is not null").select("series", "error")


def quote(good: DataFrame, cfg: SeriesConfig = SeriesConfig()) -> DataFrame:
    """One row with both series; no row unless both are usable."""
    wide = good.groupBy().pivot("series", [cfg.wti, cfg.brent]).agg(
        F.first("value").alias("usd"), F.first("period").alias("date")
    )
    return wide.select(
        F.col(f"{cfg.wti}_usd").alias("wti_usd"),
        F.col(f"{cfg.wti}_date").alias("wti_date"),
        F.col(f"{cfg.brent}_usd").alias("brent_usd"),
        F.col(f"{cfg.brent}_date").alias("brent_date"),
    ).where("wti_usd is not null and brent_usd is not null")


def quote_line(quotes: DataFrame) -> DataFrame:
    return quotes.select(
        F.format_string(
            "WTI: $%.2f/bbl (as of %s), Brent: $%.2f/bbl (as of %s)",
            "wti_usd",
            F.col("wti_date").cast("string"),
            "brent_usd",
            F.col("brent_date").cast("string"),
        ).alias("line")
    )


def served(
    requests: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    cfg: SeriesConfig = SeriesConfig(),
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """What each request gets: ``requests(keys, fetched_at, ok, value)``.

    A request refreshes when nothing is held or what is held is older than the lifetime. A refresh
    that fails serves the held value and leaves its age as it is; without a held value it fails. So
    refreshes are the fixed lifetimes over the successful rows; of several rows at the very same
    time only the first is fetched.
    """
    order = order or ["fetched_at"]
    rest = order[1:]
    good = requests.where("ok")
    starts = lifetime_starts(good, keys, "fetched_at", cfg.ttl_seconds, skew)
    first = good.groupBy(*keys, micros("fetched_at").alias("t")).agg(
        F.min_by(F.struct("value", *rest), F.struct(*order)).alias("_got")
    )
    refreshes = first.join(starts, [*keys, "t"], "left_semi")
    marks = refreshes.select(
        *keys, F.timestamp_micros("t").alias("fetched_at"), F.lit(0).alias("_mark"),
        F.struct(F.col("t").alias("at"), F.col("_got")).alias("_refresh"),
        *[F.col(f"_got.{c}").alias(c) for c in rest],
    )
    rows = requests.withColumns({"_mark": F.lit(1), "_time": F.col("fetched_at").cast("timestamp")})
    both = rows.unionByName(marks.withColumnRenamed("fetched_at", "_time"), allowMissingColumns=True)
    # a refresh comes just before the row that made it, after earlier rows of the same time
    seen = scan_marked(
        mark_blocks(both, keys, ["_time", *rest, "_mark"], skew, rows.select(*keys, "_time")),
        keys,
        ["_time", *rest, "_mark"],
        _now=last_known(F.col("_refresh")),
    ).where("_mark = 1")
    now = F.col("_now.at")
    age = micros("_time") - now
    made = (age == 0) & F.col("ok")
    for c in rest:
        made = made & (F.col(c) == F.col(f"_now._got.{c}"))
    state = (
        F.when(now.isNull(), "failed")
        .when(age > cfg.ttl_seconds * 1_000_000, "stale")
        .when(made, "refreshed")
        .otherwise("cached")
    )
    return seen.select(
        *requests.columns,
        F.col("_now._got.value").alias("served_value"),
        F.timestamp_micros(now).alias("served_at"),
        state.alias("state"),
    )
