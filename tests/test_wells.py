from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratalog.config import DriftConfig, SkewConfig, WellConfig
from stratalog.operators import scoring, wells
from stratalog.session import scratch_path

HOT = SkewConfig(max_rows=5)
SAMPLES = "well string, depth double, lithology_code int, lithology string, confidence double"


def test_sentinels(spark):
    df = spark.createDataFrame(
        [(-999.25, -999, "-999.25"), (-999.9, 5, "x"), (-999.0, None, "y"), (1.5, 7, "z")],
        "a double, b int, c string",
    )
    got = [tuple(r) for r in wells.strip_sentinels(df).collect()]
    assert got == [(None, None, "-999.25"), (None, 5, "x"), (None, None, "y"), (1.5, 7, "z")]


def test_curve_contract(spark):
    cfg = WellConfig(required=("GR", "RDEP", "DTC"), optional=("NPHI", "SP"))
    df = spark.createDataFrame(
        [("a", 1.0, 1.0, None, 2.0), ("a", 2.0, None, None, None), ("b", None, 1.0, 1.0, None)],
        "well string, GR double, RDEP double, NPHI double, X double",
    )
    got = {r["well"]: r for r in wells.curve_report(df, cfg).collect()}
    assert got["a"]["required_present"] == ["GR", "RDEP"]
    assert got["a"]["required_missing"] == ["DTC"]
    assert got["b"]["required_missing"] == ["GR", "DTC"]
    assert got["b"]["optional_present"] == ["NPHI"]
    assert got["a"]["detected"] == ["GR", "NPHI", "RDEP", "X"]
    reasons = {r["well"]: r["reason"] for r in wells.contract_rejects(wells.curve_report(df, cfg), cfg).collect()}
    assert reasons["b"] == "missing required curve(s): GR, DTC. Required: GR, RDEP, DTC."


def test_merged_sketches_equal_one_pass(spark):
    """Below the size of a sketch it is exact; nulls and NaN are no samples."""
    df = spark.range(4000).selectExpr(
        "id % 2 as version", "id % 7 as delivery", "double(id) as A", "if(id % 5 = 0, null, double(-id)) as B",
        "cast(null as double) as C", "if(id < 10, double('nan'), double(id % 3)) as D",
    )
    curves = ["A", "B", "C", "D"]
    parts = wells.curve_sketches(df, curves, ["delivery", "version"]).drop("delivery")
    got = {(r["version"], r["curve"]): (r["n"], r["bounds"]) for r in wells.sketch_bounds(wells.merged_sketches(parts, ["version"])).collect()}
    clean = df.withColumn("D", F.when(~F.isnan("D"), F.col("D")))
    for v in (0, 1):
        one = wells.drift_profile(clean.where(F.col("version") == v), curves).first()
        counts = clean.where(F.col("version") == v).agg(*[F.count(c).alias(c) for c in curves]).first()
        for c in curves:
            assert got[v, c] == (counts[c], one[c]), (v, c)


def test_rank_error_of_merged_sketches(spark):
    """Beyond its size a sketch keeps within its rank error, whatever the order of the deliveries."""
    cfg = DriftConfig(sketch_k=1024)
    df = spark.range(200_000).selectExpr("id div 20000 as delivery", "double(id) / 200000 as A")
    merged = wells.merged_sketches(wells.curve_sketches(df, ["A"], ["delivery"], cfg), cfg=cfg)
    row = wells.sketch_bounds(merged, cfg).first()
    assert row["n"] == 200_000
    assert abs(row["bounds"][0] - 0.01) < 0.006 and abs(row["bounds"][1] - 0.99) < 0.006


def test_delivery_again_replaces_its_own(spark):
    path = scratch_path(spark, "profiles")
    df = spark.createDataFrame([(1.0,), (2.0,)], "A double")
    for batch in ("a", "b", "a"):
        wells.store_sketches(wells.curve_sketches(df, ["A"]), path, batch)
    merged = wells.merged_sketches(spark.read.parquet(path))
    assert merged.first()["n"] == 4
    none = wells.sketch_profile(wells.curve_sketches(df.limit(0), ["A"]), ["A"])
    assert none.first()["A"] is None
    report = wells.drift_report(df.withColumn("well", F.lit("w")), none, ["A"])
    assert report.first()["status"] == "unknown"


def test_depth_range_prefers_dept(spark, values):
    df = spark.createDataFrame(
        [("a", None, 1.0), ("a", None, 9.0), ("b", 5.0, None)], "well string, DEPT double, DEPTH_MD double"
    )
    assert values(wells.depth_range(df), "well", "depth_min", "depth_max") == [
        ("a", 0.0, 0.0), ("b", 5.0, 5.0),
    ]
    assert values(wells.depth_range(df.drop("DEPT")), "well", "depth_min", "depth_max") == [
        ("a", 1.0, 9.0), ("b", 0.0, 0.0),
    ]


def test_well_names(spark, values):
    df = spark.createDataFrame(
        [("d/a.las", 2, "W2"), ("d/a.las", 1, None), ("d/a.las", 3, "W3"), ("d/b.x.csv", 1, None),
         (".las", 1, None)],
        "file string, row long, WELL string",
    )
    assert values(wells.well_names(df), "file", "well") == [
        (".las", ".las"), ("d/a.las", "W2"), ("d/b.x.csv", "b.x"),
    ]
    assert values(wells.well_names(df.drop("WELL")), "file", "well")[1] == ("d/a.las", "a")


def test_drift(spark):
    train = spark.range(1000).select(*[F.col("id").cast("double").alias(c) for c in "ABC"])
    profile = wells.drift_profile(train, list("ABC"))
    rows = [("ok", 500.0, 500.0, 500.0), ("one", 5000.0, 500.0, 500.0), ("all", -1.0, -1.0, -1.0),
            ("null", None, None, None)]
    rows += [("edge", 5000.0 if i == 0 else 500.0, 500.0, 500.0) for i in range(4)]
    df = spark.createDataFrame(rows, "well string, A double, B double, C double")
    got = {r["well"]: r for r in wells.drift_report(df, profile, list("ABC")).collect()}
    assert {w: r["status"] for w, r in got.items()} == {
        "ok": "ok", "one": "warning", "all": "out_of_distribution", "null": "unknown", "edge": "ok",
    }
    assert got["one"]["flagged_curves"] == ["A"] and got["all"]["flagged_curves"] == list("ABC")
    assert {r["well"] for r in wells.refused(wells.drift_report(df, profile, list("ABC"))).collect()} == {"all"}
    nothing = wells.drift_profile(train.where("A < 0"), list("ABC"))
    unknown = wells.drift_report(df, nothing, list("ABC"), DriftConfig())
    assert {r["status"] for r in unknown.collect()} == {"unknown"}


def brute_zones(rows):
    out = []
    for well in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == well), key=lambda r: r[1])
        runs = []
        for r in mine:
            if runs and runs[-1][0][3] == r[3]:
                runs[-1].append(r)
            else:
                runs.append([r])
        for i, run in enumerate(runs):
            base = runs[i + 1][0][1] if i + 1 < len(runs) else run[-1][1]
            out.append((well, i + 1, run[0][1], base, run[0][3], len(run), base - run[0][1]))
    return out


def samples(spark):
    rows = [("one", float(d), 1, "Shale", 0.9) for d in range(5)]
    rows += [("alt", float(d), d % 2, "ab"[d % 2], 0.5) for d in range(9)]
    rows += [("mix", d / 2, 3, c, 0.65 if c == "x" else 0.25) for d, c in enumerate("xxxyxxzzzzzzzzzzzzzzzzzyyyx")]
    rows += [("single", 7.0, 2, "s", 1.0)]
    return rows, spark.createDataFrame(rows, SAMPLES)


@pytest.mark.parametrize("skew", [SkewConfig(), HOT])
def test_zones(spark, values, skew):
    rows, df = samples(spark)
    got = values(
        wells.zones(df, skew=skew), "well", "run", "top", "base", "lithology", "n_samples", "thickness"
    )
    assert got == sorted(brute_zones(rows))


def zone_rows(spark):
    data = [
        ("w", 1, 0.0, 10.0, 1, "Shale", 0.5, 10.0), ("w", 2, 10.0, 10.4, 2, "Sand", 0.9, 0.4),
        ("w", 3, 10.4, 15.4, 1, "Shale", 0.8, 5.0), ("w", 4, 15.4, 30.4, 3, "Lime", 0.65, 15.0),
        ("flat", 1, 5.0, 5.0, 1, "Shale", 0.5, 0.0),
    ] + [("many", i, float(i), i + 1.0, 1, "Shale", 0.7, 1.0) for i in range(1, 13)]
    return spark.createDataFrame(
        data, "well string, run long, top double, base double, lithology_code int, lithology string, "
        "confidence double, thickness double",
    )


def test_shares_and_dominant(spark):
    z = zone_rows(spark)
    got = {(r["well"], r["lithology"]): r for r in wells.lithology_shares(z).collect()}
    shale = got[("w", "Shale")]
    assert (shale["thickness"], shale["fraction"], shale["mean_confidence"]) == (15.0, 0.4934, 0.6)
    assert got[("flat", "Shale")]["fraction"] == 0.0 and got[("flat", "Shale")]["mean_confidence"] == 0.0
    top = {r["well"]: r for r in wells.dominant(z).collect()}
    # Shale and Lime are equally thick: the name decides
    assert top["w"]["dominant_lithology"] == "Lime"
    assert top["w"]["mean_confidence"] == pytest.approx(round((5 + 0.36 + 4 + 9.75) / 30.4, 3))


def test_thin_zones_thickest_and_low_confidence(spark):
    z = zone_rows(spark)
    assert wells.thick_zones(z).where("well = 'w'").count() == 3
    assert wells.thick_zones(z, 0.0).count() == z.count()
    top = wells.thickest(z).where("well = 'many'").collect()
    assert sorted(r["run"] for r in top) == list(range(1, 9))
    low = {r["well"]: r["low_share"] for r in wells.low_confidence(z).collect()}
    assert low["w"] == pytest.approx(10.0 / 30.4) and low["flat"] == 0.0


def test_summary_text(spark):
    info = spark.createDataFrame(
        [("w", 0.0, 30.4, 40, "warning", "Odd GR."), ("flat", 0.0, 1.0, 2, "out_of_distribution", "Too far."),
         ("none", 0.0, 1.0, 2, "ok", "fine")],
        "well string, depth_min double, depth_max double, n_samples long, status string, message string",
    )
    got = {r["well"]: r["summary"] for r in wells.summary_text(info, zone_rows(spark)).collect()}
    assert got["flat"] == "Well flat: prediction REFUSED. Too far."
    assert got["none"].endswith("0 zones).\nNo lithology zones were resolved.")
    lines = got["w"].split("\n")
    assert lines[0] == "Well w — logged 0.0–30.4 m MD (40 samples, 4 zones)."
    assert lines[1] == "CAUTION: Odd GR."
    assert lines[3] == "Lithology totals:"
    assert lines[4] == f"  {'Lime':<17} {15.0:8.1f} m ({15 / 30.4:5.1%})"
    assert lines[5] == f"  {'Shale':<17} {15.0:8.1f} m ({15 / 30.4:5.1%})"
    assert lines[8] == "Thickest zones (top 4):"
    assert lines[9] == f"  {0.0:7.1f}–{10.0:7.1f} m {10.0:7.1f} m {'Shale':<17} conf 0.50"
    assert "Confidence 0.63 mean (thickness-weighted); 33% of the column is below 0.65" in got["w"]
    assert lines[-1].endswith("Chalk, Tuff, Marl, Dolomite.")


@pytest.mark.parametrize("n,points", [(1, 1), (599, 599), (600, 600), (1199, 1199), (1200, 600)])
def test_downsample(spark, n, points):
    df = spark.range(n + 3).select(
        F.lit("w").alias("well"), F.col("id").alias("row"),
        F.when(F.col("id") < n, F.col("id") * 0.123456).alias("DEPT"), (F.col("id") / 3).alias("GR"),
        F.lit(None).cast("double").alias("DTC"),
    )
    out = wells.downsample(df, ["row"], skew=HOT)
    assert out.count() == points
    assert wells.plot_header(df).first()["available_curves"] == ["GR"]
    assert wells.plot_header(df).first()["n_source_samples"] == n + 3
    if n > 1000:
        assert {r["depth"] for r in out.collect()} >= {0.0}


def test_lookup_and_outcomes(spark):
    ids = spark.createDataFrame([("25_5-1",), ("nope",)], "id string")
    got = {r["id"]: r for r in wells.lookup(ids, wells.sample_catalogue(spark)).collect()}
    assert got["25_5-1"]["well_name"] == "25/5-1" and got["25_5-1"]["error"] is None
    assert got["nope"]["error"] == "unknown sample well: nope"
    listed = spark.createDataFrame(
        [("a", None), ("b", "bad file"), ("c", None), ("d", None), ("e", None)], "well string, error string"
    )
    contract = spark.createDataFrame([("c", "no GR")], "well string, reason string")
    drift = spark.createDataFrame(
        [("a", "ok", "m"), ("d", "out_of_distribution", "far"), ("e", "warning", "odd")],
        "well string, status string, message string",
    )
    counts = spark.createDataFrame([("a", 3), ("e", 2)], "well string, n_zones long")
    got = {r["well"]: tuple(r)[1:] for r in wells.outcomes(listed, contract, drift, counts).collect()}
    assert got == {
        "a": ("predicted", None, 3), "b": ("rejected", "Cannot predict: bad file", 0),
        "c": ("rejected", "Cannot predict: no GR", 0), "d": ("refused", "far", 0),
        "e": ("warned", "odd", 2),
    }


def test_prediction_plan(spark):
    from stratalog.plans import wells as plan

    cfg = WellConfig(required=("GR", "RHOB"))
    rows = []
    for w in range(6):
        for d in range(40):
            kind = (d // 10) % 2
            rows.append((f"w{w}", float(d), kind * 50.0 + w, 2.0 + kind, kind))
    logs = spark.createDataFrame(rows, "well string, DEPT double, GR double, RHOB double, label int")
    model = scoring.train(logs, ["GR", "RHOB"], trees=3, depth=2)
    profile = wells.drift_profile(logs, ["GR", "RHOB"])
    far = logs.where("well = 'w0'").withColumns({"well": F.lit("far"), "GR": F.lit(9e9), "RHOB": F.lit(9e9)})
    bare = logs.where("well = 'w1'").withColumns({"well": F.lit("bare"), "GR": F.lit(None).cast("double")})
    names = spark.createDataFrame([(0, "Shale"), (1, "Sand")], "lithology_code int, lithology string")
    got = plan.predict(
        logs.unionByName(far).unionByName(bare).drop("label"), model, names, profile, ["GR", "RHOB"],
        cfg, DriftConfig(refuse_at=2),
    )
    zones = {r["well"]: r["n"] for r in got.zones.groupBy("well").agg(F.count("*").alias("n")).collect()}
    assert zones == {f"w{w}": 4 for w in range(6)}
    outcome = {r["well"]: r["outcome"] for r in got.outcomes.collect()}
    assert outcome == {**{f"w{w}": "predicted" for w in range(6)}, "far": "refused", "bare": "rejected"}
    texts = {r["well"]: r["summary"] for r in got.summaries.collect()}
    assert "REFUSED" in texts["far"] and "4 zones" in texts["w2"] and "bare" not in texts
    scored = scoring.score(logs, model)
    assert scoring.held_out_metrics(scored)["accuracy"] == 1.0
    table = scoring.held_out_table(scored).first()
    assert (table["n_test"], table["accuracy"], table["weighted_f1"]) == (240, 1.0, 1.0)


def test_held_out_table_agrees_with_the_evaluator(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (0, 3)], "label int, lithology_code int")
    want = scoring.held_out_metrics(df)
    got = scoring.held_out_table(df).first()
    assert got["accuracy"] == pytest.approx(want["accuracy"])
    assert got["weighted_f1"] == pytest.approx(want["f1"])


def test_versions_saved_and_scored(spark):
    """Each version scores as it does alone, the input is read once, and the metrics are those by hand."""
    df = spark.range(400).selectExpr(
        "id", "double(id % 4) as A", "double(id % 2) as B", "int(if(id % 10 = 0, 1, 0) + id % 4) % 4 as label"
    )
    root = scratch_path(spark, "models")
    models = {"fine": scoring.train(df, ["A"], trees=3), "rough": scoring.train(df, ["B"], trees=3)}
    for name, model in models.items():
        scoring.save_version(model, root, name, spark, "trial")
    scoring.save_version(models["rough"], root, "rough", spark, "again")
    table = {r["version"]: r for r in scoring.versions(spark, root).collect()}
    assert {v: (r["features"], r["n_classes"], r["note"]) for v, r in table.items()} == {
        "fine": (["A"], 4, "trial"), "rough": (["B"], 4, "again"),
    }
    loaded = scoring.load_versions(spark, root)
    both = scoring.score_versions(df, loaded)
    assert both.columns == ["id", "A", "B", "label", "version", "lithology_code", "confidence"]
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Exchange" not in plan
    rows = both.collect()
    assert len(rows) == 800
    for name, model in models.items():
        alone = {r["id"]: r["lithology_code"] for r in scoring.score(df, model).collect()}
        assert {r["id"]: r["lithology_code"] for r in rows if r["version"] == name} == alone
    for r in scoring.held_out_table(both, by=["version"]).collect():
        pairs = [(x["label"], x["lithology_code"]) for x in rows if x["version"] == r["version"]]
        f1 = 0.0
        for c in range(4):
            hit = sum(a == b == c for a, b in pairs)
            support, said = sum(a == c for a, _ in pairs), sum(b == c for _, b in pairs)
            f1 += support * (2 * hit / (support + said) if hit else 0.0)
        assert r["n_test"] == 400 and 0.3 < r["accuracy"] < 1
        assert r["accuracy"] == pytest.approx(sum(a == b for a, b in pairs) / 400)
        assert r["weighted_f1"] == pytest.approx(f1 / 400)
        one = scoring.held_out_metrics(both.where(F.col("version") == r["version"]))
        assert (r["accuracy"], r["weighted_f1"]) == (pytest.approx(one["accuracy"]), pytest.approx(one["f1"]))


def test_unknown_and_no_versions(spark):
    df = spark.range(8).selectExpr("double(id) as A", "int(id % 2) as label")
    root = scratch_path(spark, "models")
    scoring.save_version(scoring.train(df, ["A"], trees=1), root, "one", spark)
    with pytest.raises(ValueError, match="unknown model version"):
        scoring.load_versions(spark, root, ["one", "two"])
    assert scoring.score_versions(df, {}).count() == 0
    assert scoring.score_versions(df.limit(0), scoring.load_versions(spark, root)).count() == 0
