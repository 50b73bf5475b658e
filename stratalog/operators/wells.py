"""Well-log checks, zones and summaries; many wells at once, keyed by ``well``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T
from pyspark.sql import Window as W

from stratalog import config as C
from stratalog.config import (
    NULL_SENTINELS,
    SAMPLE_WELLS,
    DriftConfig,
    SkewConfig,
    WellConfig,
)
from stratalog.operators.skew import lag, mark_blocks, position, running_sum, scan, scan_marked, top_per_group

_NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.DecimalType)


def strip_sentinels(df: DataFrame, sentinels: tuple[float, ...] = NULL_SENTINELS) -> DataFrame:
    """Null markers become null in every numeric column, in one projection."""
    def cleaned(f: T.StructField) -> Column:
        if not isinstance(f.dataType, _NUMERIC):
            return F.col(f.name)
        marked = F.col(f.name).cast("double").isin(*sentinels)
        return F.when(~marked, F.col(f.name)).alias(f.name)

    return df.select(*[cleaned(f) for f in df.schema.fields])


def _names(flags: list[tuple[str, Column]]) -> Column:
    """Array of the names whose flag holds, in the given order."""
    return F.array_compact(F.array(*[F.when(f, F.lit(n)) for n, f in flags])).cast("array<string>")


def curve_report(df: DataFrame, cfg: WellConfig = WellConfig()) -> DataFrame:
    """Per well: columns detected, required present and missing, optional present.

    A curve that is null all through a well counts as missing there.
    """
    have = set(df.columns)
    curves = [c for c in (*cfg.required, *cfg.optional) if c in have]
    counts = df.groupBy("well").agg(
        F.count(F.lit(1)).alias("n_samples"), *[F.count(c).alias(f"_{c}") for c in curves]
    )

    def present(c: str) -> Column:
        return F.col(f"_{c}") > 0 if c in have else F.lit(False)

    return counts.select(
        "well",
        "n_samples",
        F.array(*[F.lit(c) for c in sorted(have - {"well"})]).alias("detected"),
        _names([(c, present(c)) for c in cfg.required]).alias("required_present"),
        _names([(c, ~present(c)) for c in cfg.required]).alias("required_missing"),
        _names([(c, present(c)) for c in cfg.optional]).alias("optional_present"),
    )


def contract_rejects(report: DataFrame, cfg: WellConfig = WellConfig()) -> DataFrame:
    """``(well, reason)`` of wells that lack a required curve."""
    return report.where(F.size("required_missing") > 0).select(
        "well",
        F.concat(
            F.lit("missing required curve(s): "),
            F.array_join("required_missing", ", "),
            F.lit(f". Required: {', '.join(cfg.required)}."),
        ).alias("reason"),
    )


def only_wells(df: DataFrame, wells: DataFrame) -> DataFrame:
    return df.join(wells.select("well").distinct(), "well", "left_semi")


def without_wells(df: DataFrame, wells: DataFrame) -> DataFrame:
    """Rows of wells that are not refused or rejected."""
    return df.join(wells.select("well").distinct(), "well", "left_anti")


def depth_column(df: DataFrame) -> str:
    """``DEPT`` wins whenever the column exists, even where it is empty."""
    return "DEPT" if "DEPT" in df.columns else "DEPTH_MD"


def depth_range(df: DataFrame) -> DataFrame:
    depth = depth_column(df)
    return df.groupBy("well").agg(
        F.coalesce(F.min(depth), F.lit(0.0)).alias("depth_min"),
        F.coalesce(F.max(depth), F.lit(0.0)).alias("depth_max"),
        F.count(depth).alias("n_depths"),
    )


def well_names(df: DataFrame, file: str = "file", order: str = "row") -> DataFrame:
    """``(file, well)``: the first non-null name in the rows, else the file name without suffix."""
    stem = F.regexp_replace(F.regexp_replace(F.col(file), r"^.*/", ""), r"(?<=.)\.[^.]*$", "")
    if "WELL" not in df.columns:
        return df.select(file).distinct().withColumn("well", stem)
    named = F.when(F.col("WELL").isNotNull(), F.col(order))
    return (
        df.groupBy(file)
        .agg(F.min_by(F.col("WELL").cast("string"), named).alias("_w"))
        .select(file, F.coalesce("_w", stem).alias("well"))
    )


def drift_profile(train: DataFrame, curves: list[str], cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """One row: low and high percentile of every curve over the training wells.

    The sketch is merged from partial ones, so no task sees a whole curve.
    """
    return train.agg(
        *[
            F.percentile_approx(c, [cfg.low, cfg.high], cfg.accuracy).alias(c) for c in curves
        ]
    )


def curve_sketches(
    train: DataFrame, curves: list[str], by: list[str] | None = None, cfg: DriftConfig = DriftConfig()
) -> DataFrame:
    """``(*by, curve, n, sketch)``: a mergeable KLL sketch of each curve, per group.

    Nulls and NaN are no samples; a group without any has ``n`` 0 and still a row. Tasks send one sketch
    per group and curve, whatever their rows.
    """
    by = by or []
    values = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(curves)]
    made = train.select(*by, *values).groupBy(*by).agg(
        *[F.kll_sketch_agg_double(f"_{i}", cfg.sketch_k).alias(f"_{i}") for i in range(len(curves))]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("curve"), F.col(f"_{i}").alias("sketch")) for i, c in enumerate(curves)]
    )
    return made.select(*by, F.inline(pairs)).select(
        *by, "curve", F.kll_sketch_get_n_double("sketch").alias("n"), "sketch"
    )


def merged_sketches(sketches: DataFrame, by: list[str] | None = None, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """One sketch per group and curve from many; rows that a sketch once read are not read again."""
    by = by or []
    return (
        sketches.groupBy(*by, "curve")
        .agg(F.kll_merge_agg_double("sketch", cfg.sketch_k).alias("sketch"))
        .select(*by, "curve", F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")
    )


def sketch_bounds(sketches: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """Add ``bounds``, the low and high percentile of each sketch; null where it holds no sample."""
    ranks = F.array(F.lit(cfg.low), F.lit(cfg.high))
    return sketches.withColumn(
        "bounds", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", ranks))
    )


def sketch_profile(sketches: DataFrame, curves: list[str], cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """The sketches of one version in the one-row shape of ``drift_profile``."""
    bounds = sketch_bounds(sketches, cfg)
    return bounds.agg(*[F.max(F.when(F.col("curve") == c, F.col("bounds"))).alias(c) for c in curves])


def store_sketches(sketches: DataFrame, path: str, batch: str) -> None:
    """Keep the sketches of one delivery of wells; the same delivery again replaces its own.

    A delivery is one folder, so one that was interrupted can run again.
    """
    sketches.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def drift_report(
    df: DataFrame, profile: DataFrame, curves: list[str], cfg: DriftConfig = DriftConfig()
) -> DataFrame:
    """Per well: status, flagged curves and a message."""
    bounds = profile.select(F.struct(*curves)).scalar()

    def outside(c: str) -> Column:
        low, high = bounds[c][0], bounds[c][1]
        return F.when(
            F.col(c).isNotNull() & low.isNotNull(),
            ((F.col(c) < low) | (F.col(c) > high)).cast("double"),
        )

    shares = df.groupBy("well").agg(*[F.avg(outside(c)).alias(c) for c in curves])
    known = F.coalesce(*curves).isNotNull()
    flagged = _names([(c, F.coalesce(F.col(c) > cfg.max_outside, F.lit(False))) for c in curves])
    listed = shares.select("well", flagged.alias("flagged_curves"), known.alias("_known"))
    n = F.size("flagged_curves")
    status = (
        F.when(~F.col("_known"), "unknown")
        .when(n >= cfg.refuse_at, "out_of_distribution")
        .when(n > 0, "warning")
        .otherwise("ok")
    )
    names = F.array_join("flagged_curves", ", ")
    message = (
        F.when(F.col("status") == "unknown", F.lit("No training profile to compare with."))
        .when(
            F.col("status") == "ok", F.lit("Well is within the range of the training data.")
        )
        .otherwise(F.concat(F.lit("Outside the range of the training data: "), names, F.lit(".")))
    )
    return listed.withColumn("status", status).withColumn("message", message).drop("_known")


def refused(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") == "out_of_distribution")


def zones(
    samples: DataFrame, tie: list[str] | None = None, skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """Consecutive depths of one class to one zone.

    ``top`` is the first depth of the run and ``base`` the top of the next run (the last run ends at
    its last depth), so thicknesses add up to the logged range. Each row that starts a run also
    tells the run before it where it ends, so one aggregation gives both ends; it is keyed by
    ``(well, run)`` and pre-aggregated.
    """
    order = ["depth", *(tie or [])]
    marked = mark_blocks(samples, ["well"], order, skew)
    cls = F.struct("lithology", F.col("lithology_code").alias("code"))
    seen = scan_marked(marked, ["well"], order, _prev=lag(cls))
    opens = F.col("_prev").isNull() | ~F.col("_prev.lithology").eqNullSafe(F.col("lithology"))
    runs = scan_marked(
        seen.withColumn("_start", opens.cast("bigint")), ["well"], order,
        run=running_sum(F.col("_start")),
    )
    none = F.lit(None).cast("double")
    own = F.struct(
        F.col("run"), F.col("lithology"), F.col("lithology_code").alias("code"), F.col("depth"),
        F.col("confidence"), none.alias("next_top"),
    )
    end_of_previous = F.struct(
        (F.col("run") - 1).alias("run"), F.col("_prev.lithology").alias("lithology"),
        F.col("_prev.code").alias("code"), none.alias("depth"), none.alias("confidence"),
        F.col("depth").alias("next_top"),
    )
    both = (F.col("_start") == 1) & (F.col("run") > 1)
    facts = runs.select(
        "well", F.inline(F.when(both, F.array(own, end_of_previous)).otherwise(F.array(own)))
    )
    # the class is one per run: as part of the key it leaves only numbers to aggregate
    return (
        facts.groupBy("well", "run", F.col("code").alias("lithology_code"), "lithology")
        .agg(
            F.min("depth").alias("top"),
            F.coalesce(F.min("next_top"), F.max("depth")).alias("base"),
            F.avg("confidence").alias("confidence"),
            F.count("depth").alias("n_samples"),
        )
        .withColumn("thickness", F.col("base") - F.col("top"))
    )


def thick_zones(z: DataFrame, min_thickness: float = WellConfig.min_thickness) -> DataFrame:
    """Drop zones thinner than the minimum; their neighbours are not merged."""
    return z.where(F.col("thickness") >= min_thickness)


def _shares(z: DataFrame) -> DataFrame:
    """Unrounded thickness per class with the well's total; a well has one row per class."""
    t = F.col("thickness")
    per_class = z.groupBy("well", "lithology").agg(
        F.sum(t).alias("thickness"),
        F.sum(F.col("confidence") * t).alias("_ct"),
        F.sum(F.when(F.col("confidence") < WellConfig.low_confidence, t).otherwise(0.0)).alias("_low"),
        F.min_by("lithology_code", "top").alias("lithology_code"),
    )
    w = W.partitionBy("well")
    total = F.sum("thickness").over(w)
    return per_class.withColumn("_total", F.when(total == 0, 1.0).otherwise(total))


def lithology_shares(z: DataFrame) -> DataFrame:
    """Thickness, fraction and thickness-weighted confidence per class."""
    return _shares(z).select(
        "well",
        "lithology",
        "lithology_code",
        F.round("thickness", 2).alias("thickness"),
        F.round(F.col("thickness") / F.col("_total"), 4).alias("fraction"),
        F.when(F.col("thickness") != 0, F.round(F.col("_ct") / F.col("thickness"), 3))
        .otherwise(0.0)
        .alias("mean_confidence"),
    )


def dominant(z: DataFrame) -> DataFrame:
    """Class with most thickness (equal ones by name) and the weighted mean confidence per well."""
    return _shares(z).groupBy("well").agg(
        F.min_by("lithology", F.struct(-F.col("thickness"), "lithology")).alias("dominant_lithology"),
        F.round(F.sum("_ct") / F.max("_total"), 3).alias("mean_confidence"),
    )


def thickest(z: DataFrame, k: int = WellConfig.max_zones) -> DataFrame:
    """The ``k`` thickest zones of each well; equal ones by depth."""
    return top_per_group(z, ["well"], [F.col("thickness").desc(), F.col("run")], k, ["well", "run"])


def low_confidence(z: DataFrame, cfg: WellConfig = WellConfig()) -> DataFrame:
    """Share of each well's thickness that lies below the confidence threshold."""
    t = F.col("thickness")
    low = F.sum(F.when(F.col("confidence") < cfg.low_confidence, t).otherwise(0.0))
    return z.groupBy("well").agg(low.alias("low_thickness"), F.sum(t).alias("total")).select(
        "well",
        "low_thickness",
        (F.col("low_thickness") / F.when(F.col("total") == 0, 1.0).otherwise(F.col("total")))
        .alias("low_share"),
    )


def _percent(x: Column, digits: int) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", x * 100), F.lit("%"))


def summary_text(
    wells: DataFrame, z: DataFrame, cfg: WellConfig = WellConfig()
) -> DataFrame:
    """One readable summary per well.

    ``wells(well, depth_min, depth_max, n_samples, status, message)``. Per well at most one line per
    class and ``max_zones`` zone lines are gathered; everything else is aggregated.
    """
    shares = _shares(z)
    total_lines = shares.select(
        "well",
        F.struct(
            (-F.col("thickness")).alias("o"),
            "lithology",
            F.format_string(
                C.SUMMARY_TOTAL,
                F.col("lithology"),
                F.col("thickness"),
                _percent(F.col("thickness") / F.col("_total"), 1),
            ).alias("line"),
        ).alias("e"),
        "_ct", "_low", "_total",
    ).groupBy("well").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("e")), lambda e: e.line), "\n")
        .alias("_totals"),
        (F.sum("_ct") / F.max("_total")).alias("_conf"),
        (F.sum("_low") / F.max("_total")).alias("_lowshare"),
    )
    zone_lines = thickest(z, cfg.max_zones).select(
        "well",
        F.struct(
            F.col("top").alias("o"),
            F.col("run"),
            F.format_string(
                C.SUMMARY_ZONE,
                "top", "base", "thickness", "lithology", "confidence",
            ).alias("line"),
        ).alias("e"),
    ).groupBy("well").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("e")), lambda e: e.line), "\n")
        .alias("_zones"),
        F.count(F.lit(1)).alias("_k"),
    )
    n_zones = z.groupBy("well").agg(F.count(F.lit(1)).alias("_nz"))
    all_ = (
        wells.join(n_zones, "well", "left")
        .join(total_lines, "well", "left")
        .join(zone_lines, "well", "left")
        .withColumn("_nz", F.coalesce("_nz", F.lit(0)))
    )
    header = F.format_string(
        C.SUMMARY_HEADER,
        F.col("well").cast("string"), "depth_min", "depth_max", "n_samples", "_nz",
    )
    caution = F.when(
        F.col("status") == "warning", F.concat(F.lit(C.SUMMARY_CAUTION), F.col("message"))
    )
    body = F.when(F.col("_nz") == 0, F.lit(C.SUMMARY_NO_ZONES)).otherwise(
        F.concat(
            F.lit(C.SUMMARY_TOTALS_TITLE),
            F.col("_totals"),
            F.format_string(C.SUMMARY_ZONES_TITLE, "_k"),
            F.col("_zones"),
            F.format_string(C.SUMMARY_CONFIDENCE, "_conf"),
            _percent(F.col("_lowshare"), 0),
            F.lit(C.SUMMARY_UNCERTAIN.format(cfg.low_confidence)),
            F.lit(C.SUMMARY_BLIND_SPOTS.format(", ".join(cfg.unreliable))),
        )
    )
    text = F.when(
        F.col("status") == "out_of_distribution",
        F.concat(
            F.lit(C.SUMMARY_REFUSED[0]), F.col("well").cast("string"), F.lit(C.SUMMARY_REFUSED[1]),
            F.col("message"),
        ),
    ).otherwise(F.concat_ws("\n", header, caution, body))
    return all_.select("well", text.alias("summary"))


def downsample(
    df: DataFrame,
    order: list[str],
    cfg: WellConfig = WellConfig(),
    skew: SkewConfig = SkewConfig(),
) -> DataFrame:
    """Every ``max(1, n div plot_points)``-th row with a depth, in row order, per well."""
    depth = depth_column(df)
    curves = [c for c in cfg.plot_curves if c in df.columns]
    tie = [c for c in order if c not in (depth, *curves)]
    rows = df.where(F.col(depth).isNotNull()).select("well", depth, *tie, *curves)
    sizes = rows.groupBy("well").agg(
        F.greatest(F.floor(F.count(F.lit(1)) / cfg.plot_points), F.lit(1)).alias("_step")
    )
    placed = scan(rows, ["well"], order, skew, _n=position())
    return (
        placed.join(sizes, "well")
        .where((F.col("_n") - 1) % F.col("_step") == 0)
        .select(
            "well",
            F.round(depth, 2).alias("depth"),
            *[F.round(c, 3).alias(c) for c in curves],
        )
    )


def plot_header(df: DataFrame, cfg: WellConfig = WellConfig()) -> DataFrame:
    """Depth range, number of source samples and curves with data, per well."""
    depth = depth_column(df)
    curves = [c for c in cfg.plot_curves if c in df.columns]
    return df.groupBy("well").agg(
        F.min(depth).alias("depth_min"),
        F.max(depth).alias("depth_max"),
        F.count(F.lit(1)).alias("n_source_samples"),
        *[F.count(c).alias(f"_{c}") for c in curves],
    ).select(
        "well", "depth_min", "depth_max", "n_source_samples",
        _names([(c, F.col(f"_{c}") > 0) for c in curves]).alias("available_curves"),
    )


def sample_catalogue(spark) -> DataFrame:
    """The sample wells as a small dimension table."""
    return spark.createDataFrame(
        list(SAMPLE_WELLS),
        "id string, well_name string, label string, description string, top double, base double",
    )


def lookup(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Catalogue row per requested id; an unknown id keeps its row with an error."""
    found = catalogue.withColumn("_found", F.lit(True))
    return requests.join(found, "id", "left").withColumn(
        "error",
        F.when(F.col("_found").isNull(), F.concat(F.lit("unknown sample well: "), F.col("id"))),
    ).drop("_found")


def outcomes(
    listed: DataFrame, contract: DataFrame, drift: DataFrame, zone_counts: DataFrame
) -> DataFrame:
    """One status row per input: predicted, warned, refused, rejected, or unchecked if the drift
    report doesn't know it, with a text.

    ``listed(well, error)`` are the inputs with their file-level error or null,
    ``contract(well, reason)``, ``drift(well, status, message)``, ``zone_counts(well, n_zones)``.
    """
    all_ = (
        listed.join(contract, "well", "left")
        .join(drift.select("well", "status", "message"), "well", "left")
        .join(zone_counts, "well", "left")
    )
    reject = F.coalesce("error", "reason")
    outcome = (
        F.when(reject.isNotNull(), "rejected")
        .when(F.col("status").isNull(), "unchecked")
        .when(F.col("status") == "out_of_distribution", "refused")
        .when(F.col("status") != "ok", "warned")
        .otherwise("predicted")
    )
    text = F.when(reject.isNotNull(), F.concat(F.lit("Cannot predict: "), reject)).when(
        F.col("status") != "ok", F.col("message")
    )
    return all_.select(
        "well",
        outcome.alias("outcome"),
        text.alias("warning"),
        F.when(outcome.isin("predicted", "warned"), F.coalesce("n_zones", F.lit(0)))
        .otherwise(0).cast("bigint").alias("n_zones"),
    )
