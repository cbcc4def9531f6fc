import duckdb
import pytest

import __spark_entry__ as entry
from gridloom import catalogue, catalogue_more  # noqa: F401 - the second registers its queries
from gridloom.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
#: One query of each operator of the first catalogue, and all of the second.
SAMPLE = [
    "ndvi_zonal_stats", "band_math_evi", "custom_expression", "dos_correction", "sen2cor_sim", "threshold_mask", "spectral_mask", "cluster_mask", "mask_coverage", "slope_aspect",
    "curvatures", "dem_curvatures", "tri_dem", "tpi_r9", "multiscale_terrain", "mask_cleaned", "mask_buffer", "statistical_texture", "texture_variance", "glcm_windowed", "multiscale_texture",
    "gabor_response", "glcm_d1_a45", "resample_mode", "mosaic_first", "impute_median", "scale_robust", "feature_quality", "correlation_pairs", "stratified_split", "stratified_folds", "prf1_mcc_kappa",
    "roc_auc", "pr_curve", "calibration_bins", "regression_metrics", "idw_surface", "nearest_training_distance", "zone_stats", "surface_stats", "season_composite", "event_windows", "continuum_removal",
]
#: Their windows are wider than the smallest grid, whose mirror image the SQL doesn't repeat.
WIDE = {"multiscale_terrain", "gabor_response"}
MORE = sorted(k for k in ORACLE_SQL if k not in catalogue.FIRST)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [*SAMPLE, *MORE])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    sf = SF.replace("0.001", "0.01") if name in WIDE else SF
    for t in ("lineitem", "part", "events", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLE_SQL[name])
    order = [x[0] for x in want.description]
    assert sorted(order) == sorted(got.columns)
    key = lambda r: tuple((x is None, round(x, 5) if isinstance(x, float) else x) for x in r)
    assert sorted(map(key, want.fetchall())) == sorted(map(key, got.select(*order).collect()))


@pytest.mark.parametrize("name", ["band_math_evi", "evi_clipped"])
def test_index_without_bound(spark, tmp_path, name):
    """A denominator of zero, one of some units in the last place, and an ordinary one."""
    sums = [(32, 654, 139, 168), (27, 533, 110, 129), (20, 400, 80, 100)]  # line items, quantity, tax and discount in percent
    items = [(k, float(q), 100.0, d / 100, t / 100) if i == 0 else (k, 0.0, 100.0, 0.0, 0.0) for k, (n, q, t, d) in enumerate(sums) for i in range(n)]
    spark.createDataFrame(items, "l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 1) for k in range(3)], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(f"SELECT * FROM ({ORACLE_SQL[name]}) ORDER BY col").fetchall()
    assert [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).orderBy("col").collect()] == want
    assert name == "evi_clipped" or want[0][2] is None and abs(want[1][2]) > 1e13
