import json

import pytest
from pyspark.sql import functions as F

from gridloom.cli import main
from gridloom.plans.process import Registry, derived, execute, holds, load, substitute, template_names, variable_summary
from gridloom.plans.steps import register_steps
from gridloom.streaming.seasons import windowed

STEPS = [
    {"id": "sum", "type": "total", "inputs": {"df": "twice"}},
    {"id": "twice", "type": "scale", "inputs": {"df": "numbers"}, "hyperparameters": {"by": "{factor}"}},
    {"id": "numbers", "type": "range", "hyperparameters": {"n": 5}},
]


def known():
    r = Registry()
    r.register("range", "source", aliases=("numbers",))(lambda spark, n: spark.range(n))
    r.register("scale", "math")(lambda spark, df, by: df.select((F.col("id") * by).alias("id")))
    r.register("total", "math")(lambda spark, df: df.agg(F.sum("id").alias("s")))

    @r.register("broken")
    def broken(spark, **_):
        raise RuntimeError("no")

    return r


def process(steps, **variables):
    return load(json.dumps({"process_info": {"name": "p"}, "steps": steps}), variables)


def test_runs_in_dependency_order(spark):
    context = execute(process(STEPS, factor=2), spark, known=known())
    assert context.results["sum"].first()["s"] == 20
    assert context.summary() == {"status": "success", "steps": 3, "success": 3}
    assert context.report().count() == 3


def test_failures_skip_what_needs_them(spark):
    steps = [{"id": "a", "type": "broken"}, {"id": "b", "type": "total", "inputs": {"df": "a"}}, {"id": "c", "type": "range", "hyperparameters": {"n": 1}}]
    context = execute(process(steps), spark, known=known())
    assert {h["step_id"]: h["status"] for h in context.history} == {"a": "failed", "b": "skipped", "c": "success"}
    assert context.summary()["status"] == "completed_with_errors"


def test_conditions(spark):
    steps = [{"id": "c", "type": "range", "hyperparameters": {"n": 1}, "condition": "season in ['wet'] and year >= 2020"}]
    assert execute(process(steps), spark, {"season": "wet", "year": 2021}, known()).results
    assert not execute(process(steps), spark, {"season": "dry", "year": 2021}, known()).results
    with pytest.raises(ValueError):
        holds("__import__('os')", {})


@pytest.mark.parametrize("steps", [
    [], [{"id": "a"}], [{"id": "a", "type": "x"}, {"id": "a", "type": "x"}],
])
def test_structure_is_checked(steps):
    with pytest.raises(ValueError):
        process(steps)


def test_cycles_and_unknown_dependencies_are_errors():
    with pytest.raises(ValueError):
        process([{"id": "a", "type": "x", "dependencies": ["b"]}, {"id": "b", "type": "x", "dependencies": ["a"]}]).order()
    with pytest.raises(ValueError):
        process([{"id": "a", "type": "x", "dependencies": ["z"]}]).order()


def test_diamond_order_is_fixed():
    steps = [{"id": k, "type": "x", "dependencies": d} for k, d in (("d", ["b", "c"]), ("c", ["a"]), ("b", ["a"]), ("a", []))]
    assert [s.id for s in process(steps).order()] == ["a", "b", "c", "d"]


def test_templates():
    v = derived({"bbox": [85.0, 27.0, 85.5, 27.25], "start_date": "2023-01-01", "end_date": "2024-02-01"})
    assert substitute({"a": ["{bbox}", "{start_year}-{end_year} {gone}"]}, v) == {"a": [[85.0, 27.0, 85.5, 27.25], "2023-2024 {gone}"]}
    assert v["bbox_width"] == 0.5 and template_names({"x": "{a} {b}"}) == {"a", "b"}


def test_registry():
    r = known()
    assert r.get("numbers") is r.get("range") and r.find(category="math") == ["scale", "total"]
    with pytest.raises(ValueError):
        r.register("range")(lambda spark: None)


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"2024-01-01 {h:02d}:10:00", "a" if h % 2 else "b", float(h)) for h in range(24)]
    df = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = windowed(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("seasons").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("seasons").collect())) == sorted(map(tuple, windowed(df).collect()))


def test_dynamic_variables():
    from datetime import datetime

    now = datetime(2024, 3, 5, 6, 7, 8)
    v = derived({"bbox": [85, 27, 86.5, 27.5], "start_date": "2023-06-01", "end_date": "2024-06-07", "area_name": "a", "output_dir": "out/"}, now)
    assert (v["bbox_str"], v["date_range"], v["start_year"], v["end_year"]) == ("85_27_86.5_27.5", "2023-06-01_to_2024-06-07", "2023", "2024")
    assert (v["timestamp"], v["date"], v["year"], v["area_output_dir"], v["area_temp_dir"]) == ("20240305_060708", "2024-03-05", 2024, "out/a", "./temp/a")
    assert derived({}, now, defaults=True)["area_cache_dir"] == "./data/cache/default_area" and "bbox_str" not in derived({}, now)
    assert variable_summary({"a": "{x} {y}", "b": ["{x}"]}) == {"x": 2, "y": 1}


def test_inputs_of_many_steps(spark):
    r = known()
    r.register("join")(lambda spark, parts: parts[0].unionByName(parts[1]))
    steps = [{"id": "j", "type": "join", "inputs": {"parts": {"sources": ["a", "b"], "aggregate": True}}}, {"id": "a", "type": "range", "hyperparameters": {"n": 2}}, {"id": "b", "type": "range", "hyperparameters": {"n": 3}}, {"id": "s", "type": "total", "inputs": {"df": {"source": "j", "key": "x"}}}]
    assert execute(process(steps), spark, known=r).results["s"].first()["s"] == 4


def test_sinks_tell_what_fails_at_run_time(spark):
    r = known()
    r.register("late")(lambda spark: spark.range(1).select(F.raise_error(F.lit("late"))))
    steps = [{"id": "a", "type": "late"}, {"id": "b", "type": "total", "inputs": {"df": "a"}}]
    assert execute(process(steps), spark, known=r).history[0]["status"] == "success"
    run = execute(process(steps), spark, known=r, sink=lambda name, df: df.write.format("noop").mode("overwrite").save())
    assert [h["status"] for h in run.history] == ["failed", "skipped"]


def test_unknown_names_keep_no_step_from_running(spark):
    steps = [{"id": "a", "type": "range", "hyperparameters": {"n": 1}, "condition": "{include_it} == true"}]
    assert "a" in execute(process(steps), spark, known=known()).results
    assert "a" not in execute(process(steps, include_it=False), spark, known=known()).results


ACQUISITION = {
    "process_info": {"name": "Multi-Source Data Acquisition", "version": "1.0.0", "application_type": "data_acquisition"},
    "global_config": {"default_values": {"bbox": [85.30, 27.60, 85.32, 27.62], "start_date": "2023-06-01", "end_date": "2023-06-07", "area_name": "area"}},
    "steps": [
        {"id": "imagery", "type": "sentinel_hub_acquisition", "hyperparameters": {"bbox": "{bbox}", "resolution": 60, "bands": ["B02", "B03", "B04", "B08"], "use_mock_data": True}},
        {"id": "dem", "type": "dem_acquisition", "hyperparameters": {"bbox": "{bbox}", "source": "SRTM", "resolution": 90, "use_mock_data": True}},
        {"id": "aster", "type": "dem_acquisition", "condition": "{include_aster} == true", "hyperparameters": {"bbox": "{bbox}"}},
        {"id": "files", "type": "local_files_discovery", "hyperparameters": {"base_path": "{local_data_path}", "file_patterns": ["*.tif", "*.csv"]}},
        {"id": "stack", "type": "data_harmonization", "dependencies": ["imagery", "dem", "files"], "inputs": {"sentinel": {"source": "imagery", "required": True}, "srtm": {"source": "dem"}}},
        {"id": "indices", "type": "spectral_indices_calculation", "dependencies": ["imagery"], "inputs": {"optical": {"source": "imagery"}}, "hyperparameters": {"indices": ["NDVI", "NDWI", "EVI", "NDBI"]}},
        {"id": "inventory", "type": "inventory_generation", "inputs": {"all": {"sources": ["imagery", "dem", "files", "stack", "indices"], "aggregate": True}}},
        {"id": "checks", "type": "data_validation", "dependencies": ["inventory"], "inputs": {"stack": {"source": "stack"}, "indices": {"source": "indices"}}},
    ],
}


def test_eight_steps(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    r = register_steps(Registry())
    run = execute(load(ACQUISITION, {"local_data_path": str(tmp_path), "include_aster": False}, defaults=True), spark, known=r)
    assert run.summary() == {"status": "success", "steps": 8, "success": 7, "skipped": 1}
    assert run.results["indices"].columns == ["row", "col", "ndvi", "ndwi", "evi"] and run.results["files"].count() == 1
    assert {x["passed"] for x in run.results["checks"].collect()} == {True} and run.results["inventory"].count() == 5
    assert run.results["stack"].count() == 24 * 24 and run.results["imagery"].agg(F.max("b08")).first()[0] <= 4000


@pytest.mark.parametrize("kind", ["classification_prediction", "multi_class_prediction", "susceptibility_prediction", "prospectivity_prediction", "probability_mapping", "risk_mapping", "susceptibility_mapping", "prospectivity_mapping", "uncertainty_quantification", "confidence_analysis", "prediction_uncertainty"])
def test_prediction_names(kind):
    assert register_steps(Registry()).get(kind)


def test_modelling_steps(spark):
    r = register_steps(Registry())
    steps = [
        {"id": "scene", "type": "pixel_grid", "hyperparameters": {"path": "/root/testdata/sf0.001"}},
        {"id": "labels", "type": "band_math", "inputs": {"df": "scene"}, "hyperparameters": {"operations": {"y": "where(b08 > 0.45, 1, 0)"}}},
        {"id": "forest", "type": "random_forest", "inputs": {"df": "labels"}, "hyperparameters": {"feature_columns": ["b02", "b08"], "target": "y", "n_estimators": 5}},
        {"id": "classes", "type": "classification_prediction", "inputs": {"df": "forest"}},
        {"id": "zones", "type": "risk_mapping", "inputs": {"df": "forest"}, "hyperparameters": {"application_type": "landslide_susceptibility"}},
        {"id": "mask", "type": "cloud_masking", "inputs": {"df": "scene"}, "hyperparameters": {"method": "scl"}},
        {"id": "texture", "type": "texture_analysis", "inputs": {"df": "scene"}, "hyperparameters": {"window_size": 3}},
        {"id": "slope", "type": "topographic_derivatives", "inputs": {"df": "scene"}, "hyperparameters": {"derivatives": ["curvature"]}},
        {"id": "fixed", "type": "atmospheric_correction", "inputs": {"df": "scene"}, "hyperparameters": {"bands": ["b04"], "method": "flaash"}},
    ]
    run = execute(process(steps), spark, known=r)
    assert run.summary()["status"] == "success", run.history
    assert {x["class"] for x in run.results["classes"].collect()} <= {0, 1} and run.results["zones"].agg(F.max("zone")).first()[0] <= 4
    assert run.results["texture"].count() == run.results["slope"].count() == run.results["fixed"].count() == 200


def test_command_line(spark, tmp_path, capsys):
    path = tmp_path / "p.json"
    path.write_text(json.dumps(ACQUISITION))
    assert main(["--list-steps"]) == 0 and "cloud_masking" in capsys.readouterr().out
    assert main([str(path), "--validate"]) == 0 and main([str(path), "--dry-run"]) == 0 and "imagery (sentinel_hub_acquisition)" in capsys.readouterr().out
    assert main([str(path), "--info"]) == 0 and json.loads(capsys.readouterr().out)["variables"]["bbox"] == 3
    assert main(["--list-processes", str(tmp_path)]) == 0 and "Multi-Source" in capsys.readouterr().out
    (tmp_path / "bad.json").write_text(json.dumps({"process_info": {"name": "b"}, "steps": [{"id": "a", "type": "nothing"}]}))
    assert main([str(tmp_path / "bad.json"), "--validate"]) == 2
    (tmp_path / "c.toml").write_text('area_name = "${AREA:x}"\n')
    out = tmp_path / "out"
    assert main([str(path), "--output-dir", str(out), "--config", str(tmp_path / "c.toml"), "--var", "include_aster=false", "--local-data-path", str(tmp_path / "none")]) == 0
    assert spark.read.parquet(str(out / "indices")).count() > 0 and spark.read.json(str(out / "report")).count() == 8
