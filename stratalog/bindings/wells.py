"""Well-log, evaluation and scoring queries.

Two bindings. Curve checks: ``lineitem`` with well = l_suppkey, depth = l_orderkey, row order =
(l_orderkey, l_linenumber), and GR, RDEP, RHOB, NPHI from quantity, price, discount and tax. Zones:
``events`` with well = user_id, depth = whole seconds, class = event_type, order (depth, event_id)
and a confidence in 128ths from value, so that sums are exact on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.bindings import SMALL_BLOCKS, query, table, utc
from stratalog.config import EvalConfig, WellConfig
from stratalog.operators import evals, mix, scoring, wells
from stratalog.plans import wells as plan
from stratalog.session import scratch_path
from stratalog.sources.chat_files import staged

CURVES = ("GR", "RDEP", "RHOB", "NPHI")
CONTRACT = WellConfig(required=("GR", "RDEP", "RHOB", "DTC"), optional=("NPHI", "CALI"))


def samples(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("well"),
        F.col("l_orderkey").cast("double").alias("DEPT"),
        "l_linenumber",
        F.col("l_quantity").alias("GR"),
        F.col("l_extendedprice").alias("RDEP"),
        F.col("l_discount").alias("RHOB"),
        F.col("l_tax").alias("NPHI"),
        # present in wells with an even number only
        F.when(F.col("l_suppkey") % 2 == 0, F.col("l_quantity")).alias("DTC"),
    )


def class_samples(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.col("user_id").alias("well"),
        F.unix_seconds(utc("ts")).cast("double").alias("depth"),
        "event_id",
        F.col("event_type").alias("lithology"),
        F.ascii("event_type").alias("lithology_code"),
        (F.floor(F.least("value", F.lit(127.0))) / 128).alias("confidence"),
    )


SQL_ZONES = """s AS (SELECT user_id AS well, CAST(epoch_us(ts) // 1000000 AS DOUBLE) AS depth, event_id,
    event_type AS lithology, ascii(event_type) AS code, floor(least(value, 127.0)) / 128 AS confidence
  FROM events),
p AS (SELECT *, lag(lithology) OVER w IS DISTINCT FROM lithology AS st FROM s
  WINDOW w AS (PARTITION BY well ORDER BY depth, event_id)),
r AS (SELECT *, CAST(sum(CASE WHEN st THEN 1 ELSE 0 END) OVER (PARTITION BY well ORDER BY depth,
  event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM p),
z0 AS (SELECT well, run, min(depth) AS top, max(depth) AS bottom, min(code) AS lithology_code,
  min(lithology) AS lithology, sum(confidence) / count(*) AS confidence, count(*) AS n_samples
  FROM r GROUP BY well, run),
z AS (SELECT well, run, top, coalesce(lead(top) OVER (PARTITION BY well ORDER BY run), bottom) AS base,
  lithology_code, lithology, confidence, n_samples,
  coalesce(lead(top) OVER (PARTITION BY well ORDER BY run), bottom) - top AS thickness FROM z0)"""


def all_zones(spark: SparkSession, sf: str) -> DataFrame:
    return wells.zones(class_samples(spark, sf), ["event_id"])


@query(
    "null_sentinels",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS gr,
    CASE WHEN l_linenumber <> 4 THEN l_discount END AS nphi FROM lineitem""",
)
def null_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    """Null markers are planted by line number."""
    n = F.col("l_linenumber")
    planted = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(n == 3, -999.25).otherwise(F.col("l_quantity")).alias("gr"),
        F.when(n == 4, -999.9).otherwise(F.col("l_discount")).alias("nphi"),
    )
    return wells.strip_sentinels(planted)


_SQL_REPORT = """SELECT l_suppkey AS well, count(*) AS n_samples,
    'DEPT,DTC,GR,NPHI,RDEP,RHOB,l_linenumber' AS detected,
    CASE WHEN l_suppkey % 2 = 0 THEN 'GR,RDEP,RHOB,DTC' ELSE 'GR,RDEP,RHOB' END AS required_present,
    CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE 'DTC' END AS required_missing,
    'NPHI' AS optional_present FROM lineitem GROUP BY l_suppkey"""


@query("curve_contract", _SQL_REPORT)
def curve_contract(spark: SparkSession, sf: str) -> DataFrame:
    report = wells.curve_report(samples(spark, sf), CONTRACT)
    lists = ("detected", "required_present", "required_missing", "optional_present")
    return report.select(
        "well", "n_samples", *[F.array_join(c, ",").alias(c) for c in lists]
    )


@query(
    "missing_curve_rejects",
    """SELECT DISTINCT l_suppkey AS well,
    'missing required curve(s): DTC. Required: GR, RDEP, RHOB, DTC.' AS reason
    FROM lineitem WHERE l_suppkey % 2 <> 0""",
)
def missing_curve_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return wells.contract_rejects(wells.curve_report(samples(spark, sf), CONTRACT), CONTRACT)


@query(
    "accepted_samples",
    """SELECT l_suppkey AS well, count(*) AS n FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1""",
)
def accepted_samples(spark: SparkSession, sf: str) -> DataFrame:
    df = samples(spark, sf)
    rejects = wells.contract_rejects(wells.curve_report(df, CONTRACT), CONTRACT)
    kept = wells.without_wells(df, rejects)
    return kept.groupBy("well").agg(F.count(F.lit(1)).alias("n"))


@query(
    "depth_range",
    """SELECT l_suppkey AS well, coalesce(min(CASE WHEN l_suppkey % 7 <> 0 THEN l_orderkey END), 0)::DOUBLE
      AS depth_min, coalesce(max(CASE WHEN l_suppkey % 7 <> 0 THEN l_orderkey END), 0)::DOUBLE AS depth_max,
      count(CASE WHEN l_suppkey % 7 <> 0 THEN 1 END) AS n_depths FROM lineitem GROUP BY 1""",
)
def depth_range(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh well has no depth at all."""
    df = samples(spark, sf).withColumn("DEPT", F.when(F.col("well") % 7 != 0, F.col("DEPT")))
    return wells.depth_range(df)


@query(
    "well_names",
    """SELECT 'logs/w' || l_suppkey || '.las' AS file, coalesce(arg_min(
        CASE WHEN l_suppkey % 3 <> 0 AND l_linenumber > 1 THEN l_returnflag || l_suppkey END,
        l_orderkey * 10 + l_linenumber)
        FILTER (WHERE l_suppkey % 3 <> 0 AND l_linenumber > 1), 'w' || l_suppkey) AS well
    FROM (SELECT l_suppkey, l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem
      GROUP BY 1, 2, 3) GROUP BY l_suppkey""",
)
def well_names(spark: SparkSession, sf: str) -> DataFrame:
    """Name from the first row that has one; every third file has none."""
    k, n = F.col("l_suppkey"), F.col("l_linenumber")
    li = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(
        F.min("l_returnflag").alias("flag")
    )
    df = li.select(
        F.concat(F.lit("logs/w"), k, F.lit(".las")).alias("file"),
        (F.col("l_orderkey") * 10 + n).alias("row"),
        F.when((k % 3 != 0) & (n > 1), F.concat("flag", k)).alias("WELL"),
    )
    return wells.well_names(df)


def _shifted(spark: SparkSession, sf: str) -> DataFrame:
    """Curves shifted per well so that all states occur."""
    k = F.col("well")
    return samples(spark, sf).withColumns(
        {
            "GR": F.col("GR") + F.when(k % 5 == 0, 100.0).otherwise(0.0),
            "RDEP": F.col("RDEP") + F.when(k % 10 == 0, 1e6).otherwise(0.0),
            "RHOB": F.col("RHOB") + F.when(k % 20 == 0, 1.0).otherwise(0.0),
        }
    )


def _drift(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The shifted curves and their report; the profile is that of the training wells."""
    df = _shifted(spark, sf)
    train = mix.group_holdout(samples(spark, sf), "well", 0.25, 42).where("split = 'train'")
    profile = wells.drift_profile(train, list(CURVES))
    return df, wells.drift_report(df, profile, list(CURVES))


_SQL_TRAINING = (
    "CAST('0x' || substr(sha256(l_suppkey || '|42'), 1, 8) AS BIGINT) >= 0.25 * 4294967296"
)
_SQL_DRIFT = f"""c AS (SELECT l_suppkey AS well,
    l_quantity + CASE WHEN l_suppkey % 5 = 0 THEN 100 ELSE 0 END AS gr,
    l_extendedprice + CASE WHEN l_suppkey % 10 = 0 THEN 1000000 ELSE 0 END AS rdep,
    l_discount + CASE WHEN l_suppkey % 20 = 0 THEN 1 ELSE 0 END AS rhob, l_tax AS nphi FROM lineitem),
  b AS (SELECT quantile_disc(l_quantity, [0.01, 0.99]) AS gr,
    quantile_disc(l_extendedprice, [0.01, 0.99]) AS rdep,
    quantile_disc(l_discount, [0.01, 0.99]) AS rhob, quantile_disc(l_tax, [0.01, 0.99]) AS nphi
    FROM lineitem WHERE {_SQL_TRAINING}),
  o AS (SELECT well, avg(CAST(c.gr < b.gr[1] OR c.gr > b.gr[2] AS INT)) > 0.25 AS f1,
    avg(CAST(c.rdep < b.rdep[1] OR c.rdep > b.rdep[2] AS INT)) > 0.25 AS f2,
    avg(CAST(c.rhob < b.rhob[1] OR c.rhob > b.rhob[2] AS INT)) > 0.25 AS f3,
    avg(CAST(c.nphi < b.nphi[1] OR c.nphi > b.nphi[2] AS INT)) > 0.25 AS f4 FROM c, b GROUP BY well),
  d AS (SELECT well, concat_ws(',', CASE WHEN f1 THEN 'GR' END, CASE WHEN f2 THEN 'RDEP' END,
    CASE WHEN f3 THEN 'RHOB' END, CASE WHEN f4 THEN 'NPHI' END) AS flagged_curves,
    CAST(f1 AS INT) + CAST(f2 AS INT) + CAST(f3 AS INT) + CAST(f4 AS INT) AS n FROM o),
  drift AS (SELECT well, flagged_curves,
    CASE WHEN n >= 3 THEN 'out_of_distribution' WHEN n > 0 THEN 'warning' ELSE 'ok' END AS status,
    CASE WHEN n = 0 THEN 'Well is within the range of the training data.'
      ELSE 'Outside the range of the training data: ' || replace(flagged_curves, ',', ', ') || '.' END
      AS message FROM d)"""


@query("drift_check", f"WITH {_SQL_DRIFT} SELECT well, flagged_curves, status, message FROM drift")
def drift_check(spark: SparkSession, sf: str) -> DataFrame:
    _, report = _drift(spark, sf)
    return report.withColumn("flagged_curves", F.array_join("flagged_curves", ","))


def _stored_sketches(spark: SparkSession, train: DataFrame) -> DataFrame:
    """Four deliveries of wells, each read once, sketched per version and stored."""
    path = scratch_path(spark, "profiles")
    for batch in range(4):
        part = train.where(F.col("well") % 4 == batch)
        wells.store_sketches(wells.curve_sketches(part, list(CURVES), ["version"]), path, str(batch))
    return spark.read.parquet(path).select("version", "curve", "n", "sketch")


_GRID = {"GR": "l_quantity", "RDEP": "floor(l_extendedprice / 20000)", "RHOB": "l_discount", "NPHI": "l_tax"}
_SQL_PROFILE = " UNION ALL ".join(
    f"""SELECT l_suppkey % 2 AS version, '{curve}' AS curve, count({x})::BIGINT AS n,
      quantile_disc({x}, 0.01)::DOUBLE AS low, quantile_disc({x}, 0.99)::DOUBLE AS high
    FROM lineitem WHERE {_SQL_TRAINING} GROUP BY ALL"""
    for curve, x in _GRID.items()
)


@query("drift_profile_merge", _SQL_PROFILE)
def drift_profile_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds per version from merged sketches. Prices are put on a coarse grid, so that, as for the other
    curves, the rank error of a sketch moves no bound to another value."""
    train = mix.group_holdout(samples(spark, sf), "well", 0.25, 42).where("split = 'train'")
    train = train.withColumns({"version": F.col("well") % 2, "RDEP": F.floor(F.col("RDEP") / 20000)})
    merged = wells.merged_sketches(_stored_sketches(spark, train), ["version"])
    return wells.sketch_bounds(merged).select(
        "version", "curve", "n", F.col("bounds")[0].alias("low"), F.col("bounds")[1].alias("high")
    )


@query("drift_check_merged", f"WITH {_SQL_DRIFT} SELECT well, flagged_curves, status, message FROM drift")
def drift_check_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The drift check against a profile that grew by four deliveries."""
    train = mix.group_holdout(samples(spark, sf), "well", 0.25, 42).where("split = 'train'")
    merged = wells.merged_sketches(_stored_sketches(spark, train.withColumn("version", F.lit(1))))
    report = wells.drift_report(_shifted(spark, sf), wells.sketch_profile(merged, list(CURVES)), list(CURVES))
    return report.withColumn("flagged_curves", F.array_join("flagged_curves", ","))


@query(
    "refusal_gate",
    f"""WITH {_SQL_DRIFT} SELECT well, count(*) AS n FROM c
    WHERE well NOT IN (SELECT well FROM drift WHERE status = 'out_of_distribution') GROUP BY well""",
)
def refusal_gate(spark: SparkSession, sf: str) -> DataFrame:
    df, report = _drift(spark, sf)
    kept = wells.without_wells(df, wells.refused(report))
    return kept.groupBy("well").agg(F.count(F.lit(1)).alias("n"))


SQL_ALL_ZONES = f"""WITH {SQL_ZONES} SELECT well, run, top, base, thickness, lithology, lithology_code,
      confidence, n_samples FROM z"""


@query("lithology_zones", SQL_ALL_ZONES)
def lithology_zones(spark: SparkSession, sf: str) -> DataFrame:
    return all_zones(spark, sf)


@query("lithology_zones_blocks", SQL_ALL_ZONES)
def lithology_zones_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same, every well cut into blocks as a hot one would be."""
    return wells.zones(class_samples(spark, sf), ["event_id"], SMALL_BLOCKS)


@query(
    "minimum_thickness",
    f"WITH {SQL_ZONES} SELECT well, run, thickness FROM z WHERE thickness >= 3600",
)
def minimum_thickness(spark: SparkSession, sf: str) -> DataFrame:
    """An hour in the place of half a metre."""
    return wells.thick_zones(all_zones(spark, sf), 3600.0).select("well", "run", "thickness")


SQL_SHARES = """sh AS (SELECT well, lithology, sum(thickness) AS t, sum(confidence * thickness) AS ct,
    arg_min(lithology_code, top) AS lithology_code,
    CASE WHEN sum(sum(thickness)) OVER (PARTITION BY well) = 0 THEN 1
      ELSE sum(sum(thickness)) OVER (PARTITION BY well) END AS total
  FROM z GROUP BY well, lithology)"""


@query(
    "lithology_shares",
    f"""WITH {SQL_ZONES}, {SQL_SHARES} SELECT well, lithology, lithology_code,
      round(t, 2) AS thickness, round(t / total, 4) AS fraction,
      CASE WHEN t <> 0 THEN round(ct / t, 3) ELSE 0 END AS mean_confidence FROM sh""",
)
def lithology_shares(spark: SparkSession, sf: str) -> DataFrame:
    return wells.lithology_shares(all_zones(spark, sf))


@query(
    "dominant_class",
    f"""WITH {SQL_ZONES}, {SQL_SHARES}, o AS (SELECT *, row_number() OVER (PARTITION BY well
      ORDER BY t DESC, lithology) AS rn FROM sh)
    SELECT well, max(lithology) FILTER (WHERE rn = 1) AS dominant_lithology,
      round(sum(ct) / max(total), 3) AS mean_confidence FROM o GROUP BY well""",
)
def dominant_class(spark: SparkSession, sf: str) -> DataFrame:
    return wells.dominant(all_zones(spark, sf))


@query(
    "thickest_zones",
    f"""WITH {SQL_ZONES}, o AS (SELECT *, row_number() OVER (PARTITION BY well
      ORDER BY thickness DESC, run) AS rank FROM z)
    SELECT well, run, top, thickness, lithology, CAST(rank AS INTEGER) AS rank FROM o WHERE rank <= 8""",
)
def thickest_zones(spark: SparkSession, sf: str) -> DataFrame:
    top = wells.thickest(all_zones(spark, sf))
    return top.select("well", "run", "top", "thickness", "lithology", "rank")


@query(
    "low_confidence_share",
    f"""WITH {SQL_ZONES} SELECT well, sum(CASE WHEN confidence < 0.65 THEN thickness ELSE 0 END)
      AS low_thickness, sum(CASE WHEN confidence < 0.65 THEN thickness ELSE 0 END) /
      CASE WHEN sum(thickness) = 0 THEN 1 ELSE sum(thickness) END AS low_share FROM z GROUP BY well""",
)
def low_confidence_share(spark: SparkSession, sf: str) -> DataFrame:
    return wells.low_confidence(all_zones(spark, sf))


@query(
    "well_summary",
    f"""WITH {SQL_ZONES}, z2 AS (SELECT * FROM z),
    sh AS (SELECT well, lithology, sum(thickness) AS t,
      sum(sum(thickness)) OVER (PARTITION BY well) AS total FROM z2 GROUP BY well, lithology),
    tl AS (SELECT well, string_agg('  ' || rpad(lithology, 17, ' ') || ' ' ||
        lpad(printf('%.1f', t), CAST(greatest(8, length(printf('%.1f', t))) AS INTEGER), ' ') || ' m (' || lpad(printf('%.1f', round(t / total * 1000) / 10), 4, ' ') ||
        '%)', chr(10) ORDER BY t DESC, lithology) AS lines FROM sh GROUP BY well),
    o AS (SELECT *, row_number() OVER (PARTITION BY well ORDER BY thickness DESC, run) AS rank FROM z2),
    zl AS (SELECT well, count(*) AS k, string_agg('  ' || printf('%.1f', top) || '–' ||
        printf('%.1f', base) || ' m ' || lpad(printf('%.1f', thickness),
        CAST(greatest(7, length(printf('%.1f', thickness))) AS INTEGER), ' ') || ' m ' || rpad(lithology, 17, ' ') ||
        ' conf ' || printf('%.2f', round(confidence, 2)), chr(10) ORDER BY top, run) AS lines FROM o WHERE rank <= 8 GROUP BY well),
    w AS (SELECT well, min(depth) AS lo, max(depth) AS hi, count(*) AS n FROM s GROUP BY well),
    nz AS (SELECT well, count(*) AS nz, sum(confidence * thickness) / sum(thickness) AS conf,
      sum(CASE WHEN confidence < 0.65 THEN thickness ELSE 0 END) / sum(thickness) AS low
      FROM z2 GROUP BY well)
    SELECT well, CASE WHEN well % 3 = 2 THEN 'Well ' || well || ': prediction REFUSED. Too far out.'
      ELSE 'Well ' || well || ' — logged ' || printf('%.1f', lo) || '–' || printf('%.1f', hi) ||
      ' m MD (' || n || ' samples, ' || nz || ' zones).' ||
      CASE WHEN well % 3 = 1 THEN chr(10) || 'CAUTION: Too far out.' ELSE '' END ||
      chr(10) || chr(10) || 'Lithology totals:' || chr(10) || tl.lines || chr(10) || chr(10) ||
      'Thickest zones (top ' || k || '):' || chr(10) || zl.lines || chr(10) || chr(10) ||
      'Confidence ' || printf('%.2f', round(conf, 2)) || ' mean (thickness-weighted); ' ||
      printf('%.0f', round(low * 100)) || '% of the column is below 0.65 and should be ' ||
      'treated as uncertain.' || chr(10) || 'Model blind spots — NOT reliably detected, so do not ' ||
      'state their absence as fact: Chalk, Tuff, Marl, Dolomite.' END AS summary
    FROM w JOIN nz USING (well) JOIN tl USING (well) JOIN zl USING (well)""",
)
def well_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Confidences are in 128ths, so their sums are the same on both sides."""
    z = all_zones(spark, sf)
    k = F.col("well") % 3
    w = class_samples(spark, sf).groupBy("well").agg(
        F.min("depth").alias("depth_min"),
        F.max("depth").alias("depth_max"),
        F.count(F.lit(1)).alias("n_samples"),
    ).withColumns(
        {
            "status": F.when(k == 0, "ok").when(k == 1, "warning").otherwise("out_of_distribution"),
            "message": F.lit("Too far out."),
        }
    )
    return wells.summary_text(w, z)


SQL_DOWNSAMPLE = """WITH n AS (SELECT l_suppkey AS well, greatest(count(*) // 100, 1) AS step FROM lineitem
      GROUP BY 1),
    r AS (SELECT l_suppkey AS well, l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax,
      row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax) AS rn FROM lineitem)
    SELECT well, round(l_orderkey::DOUBLE, 2) AS depth, round(l_quantity, 3) AS "GR",
      round(l_extendedprice, 3) AS "RDEP", round(l_discount, 3) AS "RHOB", round(l_tax, 3) AS "NPHI"
    FROM r JOIN n USING (well) WHERE (rn - 1) % step = 0"""


@query("curve_downsample", SQL_DOWNSAMPLE)
def curve_downsample(spark: SparkSession, sf: str) -> DataFrame:
    """A hundred points instead of six hundred, so that wells are thinned at every scale."""
    cfg = WellConfig(plot_points=100, plot_curves=CURVES)
    df = samples(spark, sf).drop("DTC")
    return wells.downsample(df, ["DEPT", "l_linenumber", *CURVES], cfg)


@query("curve_downsample_blocks", SQL_DOWNSAMPLE)
def curve_downsample_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same, every well cut into blocks as a hot one would be."""
    cfg = WellConfig(plot_points=100, plot_curves=CURVES)
    df = samples(spark, sf).drop("DTC")
    return wells.downsample(df, ["DEPT", "l_linenumber", *CURVES], cfg, SMALL_BLOCKS)


@query(
    "plot_header",
    """SELECT l_suppkey AS well, min(l_orderkey)::DOUBLE AS depth_min, max(l_orderkey)::DOUBLE AS depth_max,
      count(*) AS n_source_samples,
      CASE WHEN l_suppkey % 2 = 0 THEN 'GR,RDEP,RHOB,NPHI,DTC' ELSE 'GR,RDEP,RHOB,NPHI' END
      AS available_curves FROM lineitem GROUP BY 1""",
)
def plot_header(spark: SparkSession, sf: str) -> DataFrame:
    head = wells.plot_header(samples(spark, sf))
    return head.withColumn("available_curves", F.array_join("available_curves", ","))


@query(
    "well_lookup",
    """SELECT 'well-' || k AS id, s_name AS well_name,
      CASE WHEN s_suppkey IS NULL THEN 'unknown sample well: well-' || k END AS error
    FROM (SELECT DISTINCT l_suppkey * unnest([1, -1]) AS k FROM lineitem) LEFT JOIN supplier ON k = s_suppkey""",
)
def well_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue = all suppliers; negative ids are in none."""
    key = F.col("l_suppkey")
    asked = table(spark, sf, "lineitem").select(F.explode(F.array(key, -key)).alias("k")).distinct()
    asked = asked.select(F.concat(F.lit("well-"), "k").alias("id"))
    catalogue = table(spark, sf, "supplier").select(
        F.concat(F.lit("well-"), F.col("s_suppkey")).alias("id"), F.col("s_name").alias("well_name")
    )
    return wells.lookup(asked, catalogue).select("id", "well_name", "error")


# --- scoring and the whole chain: wells whose class follows a rule that a forest learns exactly --

LEARNED = ("DRHO", "CALI")
NAMES = "CASE code WHEN 0 THEN 'Shale' WHEN 1 THEN 'Sandstone' ELSE 'Chalk' END"


def rule_wells(spark: SparkSession, sf: str) -> DataFrame:
    """Class by line number: 1 and 2, 3 and 4, the rest. Two curves tell it; others are as above,
    shifted for drift in every fifth well."""
    df, _ = _drift(spark, sf)
    n = F.col("l_linenumber")
    return df.withColumns(
        {
            "DRHO": n.cast("double"),
            "CALI": (8 - n).cast("double"),
            "label": F.when(n <= 2, 0).when(n <= 4, 1).otherwise(2),
        }
    )


_SQL_RULE = """k AS (SELECT l_suppkey AS well, l_orderkey::DOUBLE AS depth, l_linenumber,
    CASE WHEN l_linenumber <= 2 THEN 0 WHEN l_linenumber <= 4 THEN 1 ELSE 2 END AS code FROM lineitem)"""


def _model(data: DataFrame):
    train = mix.group_holdout(data, "well", 0.25, 42).where("split = 'train'")
    return scoring.train(train, list(LEARNED), trees=5)


@query(
    "score_depths",
    f"WITH {_SQL_RULE} SELECT well, depth, l_linenumber, code AS lithology_code, 1.0::DOUBLE AS confidence FROM k",
)
def score_depths(spark: SparkSession, sf: str) -> DataFrame:
    """Train on the wells of one side of the hold-out, score all rows: class code and confidence."""
    data = rule_wells(spark, sf)
    scored = scoring.score(data, _model(data))
    return scored.select(
        "well", F.col("DEPT").alias("depth"), "l_linenumber", "lithology_code",
        F.round("confidence", 9).alias("confidence"),
    )


@query(
    "classifier_metrics",
    f"""SELECT count(*) AS n_test, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS weighted_f1 FROM lineitem
    WHERE NOT ({_SQL_TRAINING})""",
)
def classifier_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy and weighted F1 on the wells that were held out."""
    data = mix.group_holdout(rule_wells(spark, sf), "well", 0.25, 42)
    return scoring.held_out_table(scoring.score(data.where("split = 'test'"), _model(data.drop("split"))))


_SQL_SAID = f"""k AS (SELECT l_linenumber AS n, CASE WHEN l_linenumber <= 2 THEN 0 WHEN l_linenumber <= 4 THEN 1 ELSE 2
      END AS rule, (l_orderkey * 7 + l_linenumber * 3 + l_suppkey) % 10 = 0 AS wrong FROM lineitem WHERE NOT ({_SQL_TRAINING})),
  said AS (SELECT version, CASE WHEN wrong THEN (rule + 1) % 3 ELSE rule END AS label,
    CASE WHEN version = '2024-two-curves' THEN rule WHEN n <= 2 THEN 0 ELSE 2 END AS code
    FROM k, (VALUES ('2024-two-curves'), ('2023-one-curve')) AS v(version))"""


def _said_by_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out wells scored by two saved versions and stored.

    A tenth of the labels is wrong, so no forest finds them all. One version sees the curve that tells the
    classes; the other sees only whether the line number is above 2, where class 2 is the most frequent.
    """
    n = F.col("l_linenumber")
    wrong = (F.col("DEPT").cast("bigint") * 7 + n * 3 + F.col("well")) % 10 == 0
    data = rule_wells(spark, sf).withColumns(
        {"label": F.when(wrong, (F.col("label") + 1) % 3).otherwise(F.col("label")), "PEF": (n > 2).cast("double")}
    )
    data = mix.group_holdout(data, "well", 0.25, 42)
    root = scratch_path(spark, "models")
    train = data.where("split = 'train'").drop("split")
    for version, curves in (("2024-two-curves", list(LEARNED)), ("2023-one-curve", ["PEF"])):
        scoring.save_version(scoring.train(train, curves, trees=5), root, version, spark)
    scored = scoring.score_versions(data.where("split = 'test'"), scoring.load_versions(spark, root))
    return staged(scored.select("version", "label", "lithology_code", "confidence"), scratch_path(spark, "said"))


@query(
    "classifier_metrics_versions",
    f"""WITH {_SQL_SAID}, c AS (SELECT c FROM range(3) AS r(c)),
    per AS (SELECT version, c, count(*) FILTER (WHERE label = c) AS support, count(*) FILTER (WHERE code = c) AS said,
      count(*) FILTER (WHERE label = c AND code = c) AS hit FROM said, c GROUP BY version, c)
    SELECT version, sum(support)::BIGINT AS n_test, round(sum(hit) / sum(support), 9) AS accuracy,
      round(sum(support * CASE WHEN hit = 0 THEN 0.0::DOUBLE ELSE 2 * (hit / said) * (hit / support)
        / (hit / said + hit / support) END) / sum(support), 9) AS weighted_f1
    FROM per GROUP BY version""",
)
def classifier_metrics_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy and weighted F1 of each saved version on the wells that were held out."""
    rated = scoring.held_out_table(_said_by_versions(spark, sf), by=["version"])
    return rated.withColumns({c: F.round(c, 9) for c in ("accuracy", "weighted_f1")})


@query(
    "confusion_by_version",
    f"WITH {_SQL_SAID} SELECT version, label, code AS lithology_code, count(*) AS n FROM said GROUP BY ALL",
)
def confusion_by_version(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.confusion(_said_by_versions(spark, sf), by=["version"])


_SQL_CHAIN = f"""{_SQL_DRIFT}, {_SQL_RULE},
  kp AS (SELECT *, lag(code) OVER w IS DISTINCT FROM code AS st FROM k
    WHERE well % 2 = 0 AND well NOT IN (SELECT well FROM drift WHERE status = 'out_of_distribution')
    WINDOW w AS (PARTITION BY well ORDER BY depth, l_linenumber)),
  kr AS (SELECT *, sum(CAST(st AS INT)) OVER (PARTITION BY well ORDER BY depth, l_linenumber
    ROWS UNBOUNDED PRECEDING) AS run FROM kp),
  kz AS (SELECT well, run, min(depth) AS top, max(depth) AS bottom, min(code) AS code, count(*) AS n
    FROM kr GROUP BY well, run),
  kt AS (SELECT *, coalesce(lead(top) OVER (PARTITION BY well ORDER BY run), bottom) - top AS thickness FROM kz),
  thick AS (SELECT well, {NAMES} AS lithology, count(*) AS n, sum(thickness) AS thickness FROM kt
    WHERE thickness >= 0.5 GROUP BY well, lithology)"""


def _predicted(spark: SparkSession, sf: str) -> plan.Prediction:
    data = rule_wells(spark, sf)
    code = F.col("id").cast("int")
    names = spark.range(3).select(code.alias("lithology_code"), F.expr(NAMES.replace("code", "id")).alias("lithology"))
    train = mix.group_holdout(samples(spark, sf), "well", 0.25, 42).where("split = 'train'")
    profile = wells.drift_profile(train, list(CURVES))
    files = data.select((-F.col("well")).alias("well")).distinct().withColumn("error", F.lit("unreadable"))
    return plan.predict(
        data.drop("label"), _model(data), names, profile, list(CURVES), CONTRACT,
        file_errors=files, tie=["l_linenumber"],
    )


@query(
    "well_predict",
    f"""WITH {_SQL_CHAIN} SELECT well, lithology, n AS n_zones, thickness,
      round(thickness / sum(thickness) OVER (PARTITION BY well), 4) AS fraction FROM thick""",
)
def well_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Contract, drift, scoring, zones and shares in one chain: share of each class in each well."""
    got = _predicted(spark, sf)
    counts = got.zones.groupBy("well", "lithology").agg(F.count(F.lit(1)).alias("n_zones"))
    shares = got.shares.select("well", "lithology", "thickness", "fraction")
    return shares.join(counts, ["well", "lithology"])


@query(
    "well_outcomes",
    f"""WITH {_SQL_CHAIN}, n AS (SELECT well, sum(n) AS n FROM thick GROUP BY well)
    SELECT well, CASE WHEN well % 2 <> 0 THEN 'rejected' WHEN status = 'out_of_distribution'
        THEN 'refused' WHEN status <> 'ok' THEN 'warned' ELSE 'predicted' END AS outcome,
      CASE WHEN well % 2 <> 0 THEN
          'Cannot predict: missing required curve(s): DTC. Required: GR, RDEP, RHOB, DTC.'
        WHEN status <> 'ok' THEN message END AS warning, coalesce(n, 0)::BIGINT AS n_zones
    FROM drift LEFT JOIN n USING (well)
    UNION ALL SELECT DISTINCT -l_suppkey, 'rejected', 'Cannot predict: unreadable', 0 FROM lineitem""",
)
def well_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """One outcome per input of the chain; a file with negative number could not be read."""
    return _predicted(spark, sf).outcomes


# --- evaluation -----------------------------------------------------------------------------


def _rule_based(spark: SparkSession, sf: str) -> DataFrame:
    """Quality label against a rule: long texts are good; confidence from the length."""
    d = table(spark, sf, "documents").select(
        "doc_id",
        (F.col("n_chars") > 300).cast("int").alias("prediction"),
        (F.least(F.col("n_chars"), F.lit(1000)) / 1000).alias("confidence"),
    )
    return table(spark, sf, "labels").select(
        "doc_id", F.col("quality").alias("label")
    ).join(d, "doc_id")


_SQL_SCORED = """p AS (SELECT quality AS label, CAST(n_chars > 300 AS INTEGER) AS prediction,
    least(n_chars, 1000) / 1000 AS confidence FROM labels JOIN documents USING (doc_id))"""


@query(
    "calibration",
    f"""WITH {_SQL_SCORED} SELECT CASE WHEN confidence >= 0.9 THEN '>=0.9'
      WHEN confidence >= 0.7 THEN '0.7-0.9' ELSE '<0.7' END AS band, count(*) AS n,
      sum(CAST(label = prediction AS INT))::DOUBLE / count(*) AS accuracy FROM p GROUP BY 1""",
)
def calibration(spark: SparkSession, sf: str) -> DataFrame:
    return evals.calibration(_rule_based(spark, sf))


@query(
    "class_recall",
    f"""WITH {_SQL_SCORED} SELECT label, count(*) AS n,
      sum(CAST(label = prediction AS INT))::DOUBLE / count(*) AS recall FROM p GROUP BY 1""",
)
def class_recall(spark: SparkSession, sf: str) -> DataFrame:
    return evals.recall_per_class(_rule_based(spark, sf))


@query(
    "blind_spots",
    f"""WITH {_SQL_SCORED} SELECT label, count(*) AS n,
      sum(CAST(label = prediction AS INT))::DOUBLE / count(*) AS recall FROM p GROUP BY 1
      HAVING recall < 0.9""",
)
def blind_spots(spark: SparkSession, sf: str) -> DataFrame:
    """With 0.9 as the bar, since the rule finds most of either class."""
    return evals.blind_spots(_rule_based(spark, sf), WellConfig(blind_recall=0.9))


@query(
    "loss_perplexity",
    """SELECT event_type, count(*) FILTER (WHERE event_id % 4 <> 0) AS n_scored,
      CAST(round(1e6 * avg(value / 100) FILTER (WHERE event_id % 4 <> 0)) AS BIGINT) AS loss_e6,
      CAST(round(1e6 * exp(avg(value / 100) FILTER (WHERE event_id % 4 <> 0))) AS BIGINT) AS ppl_e6
    FROM events GROUP BY 1""",
)
def loss_perplexity(spark: SparkSession, sf: str) -> DataFrame:
    """Loss = value / 100; every fourth loss is NaN and does not count."""
    e = table(spark, sf, "events").select(
        "event_type",
        F.when(F.col("event_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("value") / 100)
        .alias("loss"),
    )
    return evals.perplexity(e, by=["event_type"]).select(
        "event_type", "n_scored",
        F.round(F.col("avg_loss") * 1e6).cast("bigint").alias("loss_e6"),
        F.round(F.col("perplexity") * 1e6).cast("bigint").alias("ppl_e6"),
    )


_WORDS = ("reth", "ouen", "stich", "tion ", "ändig")


@query(
    "domain_slice",
    "SELECT doc_id FROM documents WHERE "
    + " OR ".join(f"contains(lower(text), '{w}')" for w in _WORDS),
)
def domain_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Word parts that occur in the generated texts in the place of the domain's."""
    return evals.domain_slice(table(spark, sf, "documents"), "text", _WORDS).select("doc_id")


def _train_log(spark: SparkSession, sf: str) -> DataFrame:
    """One run per user, a step per event; ``view`` rows are evaluations."""
    e = table(spark, sf, "events")
    is_eval = F.col("event_type") == "view"
    return e.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.when(~is_eval, F.col("value")).alias("loss"),
        F.when(is_eval, F.col("value")).alias("eval_loss"),
        utc("ts").alias("ts"),
    )


@query(
    "loss_curves",
    """SELECT user_id AS run, event_id AS step,
      CASE WHEN event_type = 'view' THEN 'eval_loss' ELSE 'train_loss' END AS metric, value FROM events""",
)
def loss_curves(spark: SparkSession, sf: str) -> DataFrame:
    return evals.loss_curves(_train_log(spark, sf))


@query(
    "best_eval",
    """SELECT user_id AS run, min(value) AS best_eval_loss, arg_min(event_id, (value, event_id))
      AS best_step FROM events WHERE event_type = 'view' GROUP BY 1""",
)
def best_eval(spark: SparkSession, sf: str) -> DataFrame:
    return evals.best_eval(_train_log(spark, sf))


@query(
    "early_stop",
    """WITH e AS (SELECT user_id AS run, event_id AS step, value AS v, row_number() OVER w AS n,
        min(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING) AS prior
      FROM events WHERE event_type = 'view' WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    s AS (SELECT run, step, n - max(CASE WHEN prior IS NULL OR v < prior THEN n END) OVER
      (PARTITION BY run ORDER BY step ROWS UNBOUNDED PRECEDING) AS waited FROM e)
    SELECT run, count(*) AS n_evals, min(CASE WHEN waited >= 3 THEN step END) AS stop_step
    FROM s GROUP BY run""",
)
def early_stop(spark: SparkSession, sf: str) -> DataFrame:
    return evals.early_stop(_train_log(spark, sf))


@query(
    "run_metrics",
    """SELECT (SELECT count(*) FROM documents WHERE source NOT IN ('src0', 'src1')) AS n_train,
      (SELECT count(*) FROM documents WHERE source = 'src0') AS n_val,
      (SELECT count(*) FROM documents WHERE source = 'src1') AS n_test,
      (max(epoch_us(ts)) - min(epoch_us(ts))) // 60000000 AS minutes,
      CAST(round(9e6 * ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 / 3600)) AS BIGINT) AS credits_e6,
      CAST(round(1e6 * avg(value) FILTER (WHERE event_type <> 'view')) AS BIGINT) AS train_loss_e6,
      min(value) FILTER (WHERE event_type = 'view') AS best_eval_loss,
      CAST(round(1e6 * avg(value / 100)) AS BIGINT) AS test_loss_e6,
      CAST(round(1e6 * exp(avg(value / 100))) AS BIGINT) AS perplexity_e6 FROM events""",
)
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as corpus rows, all events as one run, value / 100 as the test loss."""
    corpus = table(spark, sf, "documents").select(
        F.when(F.col("source") == "src0", "val").when(F.col("source") == "src1", "test")
        .otherwise("train").alias("split")
    )
    results = table(spark, sf, "events").select((F.col("value") / 100).alias("loss"))
    m = evals.run_metrics(corpus, _train_log(spark, sf), results, EvalConfig())

    def e6(c: str):
        return F.round(F.col(c) * 1e6).cast("bigint")

    return m.select(
        "n_train", "n_val", "n_test",
        F.floor("train_runtime_min").cast("bigint").alias("minutes"),
        e6("estimated_credits").alias("credits_e6"),
        e6("final_train_loss").alias("train_loss_e6"),
        "best_eval_loss",
        e6("test_avg_loss").alias("test_loss_e6"),
        e6("test_perplexity").alias("perplexity_e6"),
    )


@query(
    "review_table",
    """SELECT doc_id, substr(text, 1, 150) AS question, substr(text, 1, 200) AS reference,
      substr(lang, 1, 200) AS generated FROM documents""",
)
def review_table(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("question"), F.col("text").alias("reference"),
        F.col("lang").alias("generated"),
    )
    return evals.review_table(d)
