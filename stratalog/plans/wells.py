"""From curve rows of many wells to zones, shares, summaries and one outcome per well."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.config import DriftConfig, WellConfig
from stratalog.operators import scoring, wells
from stratalog.session import scratch_path
from stratalog.sources.chat_files import staged


@dataclass(frozen=True)
class Prediction:
    curves: DataFrame
    drift: DataFrame
    samples: DataFrame
    zones: DataFrame
    shares: DataFrame
    summaries: DataFrame
    outcomes: DataFrame


def predict(
    samples: DataFrame,
    model: PipelineModel,
    names: DataFrame,
    profile: DataFrame,
    features: list[str],
    well_cfg: WellConfig = WellConfig(),
    drift_cfg: DriftConfig = DriftConfig(),
    file_errors: DataFrame | None = None,
    tie: list[str] | None = None,
) -> Prediction:
    """``samples(well, DEPT, curves…)`` with ``names(lithology_code, lithology)``.

    Wells that miss a curve or lie too far from the training data leave before the scoring, so
    nothing costly runs on them. Scored samples are written once and read by what follows. A code
    without a name keeps its samples, under a null name.
    """
    curves = wells.curve_report(samples, well_cfg)
    contract = wells.contract_rejects(curves, well_cfg)
    usable = wells.without_wells(samples, contract)
    drift = wells.drift_report(usable, profile, features, drift_cfg)
    accepted = wells.without_wells(usable, wells.refused(drift))

    depth = wells.depth_column(samples)
    scored = scoring.score(accepted, model).join(names, "lithology_code", "left").select(
        "well", F.col(depth).alias("depth"), *(tie or []), "lithology_code", "lithology",
        "confidence",
    ).where("depth is not null")
    scored = staged(scored, scratch_path(samples.sparkSession, "scored"))
    zones = wells.thick_zones(wells.zones(scored, tie), well_cfg.min_thickness)

    ranges = wells.depth_range(samples).join(
        curves.select("well", "n_samples"), "well"
    ).join(drift.select("well", "status", "message"), "well")
    listed = curves.select("well", F.lit(None).cast("string").alias("error"))
    if file_errors is not None:
        listed = listed.unionByName(file_errors.select("well", "error"))
    counts = zones.groupBy("well").agg(F.count(F.lit(1)).alias("n_zones"))
    return Prediction(
        curves=curves,
        drift=drift,
        samples=scored,
        zones=zones,
        shares=wells.lithology_shares(zones),
        summaries=wells.summary_text(ranges, zones, well_cfg),
        outcomes=wells.outcomes(listed, contract, drift, counts),
    )
