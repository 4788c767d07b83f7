"""Semantic traps on tiny hand-made frames."""

from pyspark.sql import functions as F

from agroframe.functions import columns as C
from agroframe.operators import baseline as B
from agroframe.operators import catalogue as CA
from agroframe.operators import panel as P
from agroframe.operators import sensor as SE


def test_dirty_numbers_become_null_never_nan(spark):
    rows = [("1d",), ("1f",), ("NaN",), ("9..9",), ("56.o",), ("-",), ("",), ("1_0",), ("0x10",), ("1,000",),
            (" 12 ",), ("3.5",), ("1e2",), (None,)]
    df = spark.createDataFrame(rows, "v string").select(C.clean_number("v", ("9..9", "56.o")).alias("x"))
    got = [r.x for r in df.collect()]
    assert got == [None] * 10 + [12.0, 3.5, 100.0, None]


def test_rolling_mean_needs_all_four_weeks(spark):
    # weeks 0..10 at one location, week 2 missing entirely, week 4 present but NULL
    rows = [("A", 0, 1.0), ("A", 1, 2.0), ("A", 3, 4.0), ("A", 4, None), ("A", 5, 6.0), ("A", 6, 7.0),
            ("A", 7, 8.0), ("A", 8, 9.0), ("A", 9, 10.0), ("A", 10, 11.0)]
    wx = spark.createDataFrame(rows, "location string, week_id long, maxt_c double")
    f = {r.week_id: r for r in P.weather_features(wx, cols=["maxt_c"]).collect()}
    assert f[4].maxt_c_lag1 == 4.0 and f[3].maxt_c_lag1 is None       # week 2 missing -> lag of week 3 is NULL
    assert f[5].maxt_c_roll4 is None                                   # NULL inside the 4-week window
    assert f[10].maxt_c_roll4 == (7.0 + 8.0 + 9.0 + 10.0) / 4           # weeks 6..9
    assert f[10].maxt_c_trend == 10.0 - 7.0                            # week 9 minus week 6
    # same answer on the densified calendar
    dense = P.weather_features(P.dense_weeks(wx), cols=["maxt_c"])
    d = {r.week_id: r for r in dense.collect()}
    for w, r in f.items():
        assert d[w].maxt_c_roll4 == r.maxt_c_roll4 and d[w].maxt_c_lag1 == r.maxt_c_lag1
    assert 2 in d and d[2].maxt_c_lag1 == 2.0


def test_null_comparisons_are_false_not_true(spark):
    df = spark.createDataFrame([("L", "p", 5.0, None, None)], "location string, pest string, v double, q1 double, q2 double")
    assert df.select(B.band_of("v").alias("b")).first().b == 2      # missing cut-offs -> High


def test_greatest_skips_null_but_humidity_stays_missing(spark):
    from agroframe.operators.forecast import apply_scenarios, scenarios
    feats = spark.createDataFrame([(None, None, 10.0)], "rf_mm_lag1 double, rh1_pct_lag1 double, maxt_c_lag1 double")
    out = apply_scenarios(feats, scenarios(spark, [(0, 1.0, 2.0, 5.0)])).first()
    assert out.rf_mm_lag1 == 0.0 and out.rh1_pct_lag1 is None and out.maxt_c_lag1 == 11.0


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(30,), (70,), (110,)], "n int").select(F.bround(F.col("n") * 0.15, 0).alias("r"))
    assert [r.r for r in df.collect()] == [4.0, 10.0, 16.0]


def test_majority_tie_first_seen_wins(spark):
    lines = spark.createDataFrame([(1, 1, "7 0 0 0 0"), (1, 2, "3 0 0 0 0"), (1, 3, "3 0 0 0 0"),
                                   (1, 4, "7 0 0 0 0"), (2, 1, "x 1 1 1 1"), (2, 2, "4 1 1 1 1"),
                                   (3, 1, "bad")], "image_id long, line_no int, line string")
    m = {r.image_id: r for r in CA.majority_class(lines).collect()}
    assert m[1].class_id == 7 and m[1].mixed
    assert m[2].class_id == 4 and not m[2].mixed      # bad line skipped on its own
    assert 3 not in m                                 # no valid line -> no label
    bal = {r.class_id: r.n_images for r in CA.class_balance(lines).collect()}
    assert bal == {7: 1, 3: 1}                        # image 2 dropped whole (one bad line)


def test_drop_first_one_hot_drops_alphabetical_first(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "c")], "id int, g string")
    out = SE.one_hot_drop_first(df, "g", ["a", "b", "c"])
    assert sorted(c for c in out.columns if c.startswith("g_")) == ["g_b", "g_c"]


def test_week_53_folds_into_next_year(spark):
    df = spark.createDataFrame([(2000, 53), (2001, 1)], "year int, standard_week int").select(
        C.week_id().alias("w"))
    a, b = [r.w for r in df.collect()]
    assert a == b


def test_range_rule_missing_is_out_of_range(spark):
    df = spark.createDataFrame([(1, 25.0, 60.0, 100.0, 50.0, 100.0), (2, None, 60.0, 100.0, 50.0, 100.0),
                                (3, 30.0, 85.0, 250.0, 120.0, 250.0)],
                               "row_id int, temperature_c double, humidity_pct double, nitrogen double, "
                               "phosphorus double, potassium double")
    lab = {r.row_id: (r.stress_score, r.health_label) for r in SE.health_label(df).collect()}
    assert lab == {1: (0, 1), 2: (1, 0), 3: (0, 1)}   # bounds inclusive


def test_null_group_keys_are_kept_by_spark(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, v double")
    assert df.groupBy("k").count().count() == 2       # callers filter keys first where pandas drops them


def test_pretty_label(spark):
    df = spark.createDataFrame([("banana_leaf_spot  x",), ("chilli_healthy",), ("radish",)], "c string")
    crop, dis = C.pretty_label("c")
    got = [tuple(r) for r in df.select(crop, dis).collect()]
    assert got == [("Banana", "leaf spot x"), ("Chilli", "Healthy"), ("Radish", "Healthy")]


def test_folder_keys(spark):
    df = spark.createDataFrame([("a/b/c/d.jpg",), ("a/x.jpg",), ("y.jpg",)], "path string")
    parent = [r[0] for r in df.select(C.folder_key("path", 2, "parent")).collect()]
    drop = [r[0] for r in df.select(C.folder_key("path", 2, "drop")).collect()]
    assert parent == ["a/b", "a", ""] and drop == ["a/b", None, None]


def test_null_keys_do_not_form_series(spark):
    rows = [("R", "L", "p", 2000, 1, "5"), (None, "L", "p", 2000, 1, "7"), ("R", None, "p", 2000, 1, "9"),
            ("R", "L", None, 2000, 1, "11"), ("R", "L", "p", None, 2, "13")]
    raw = spark.createDataFrame(rows, "crop string, location string, pest string, year int, standard_week int, "
                                      "pest_value string")
    for c in P.WEATHER:
        raw = raw.withColumn(c, F.lit("1"))
    clean = P.clean_panel(raw)
    counts = {tuple(r[:3]): r.n_obs for r in P.series_counts(clean).collect()}
    assert counts == {("R", "L", "p"): 1}
    tgt = {(r.location, r.pest, r.week_id): r.pest_value for r in P.weekly_target(clean).collect()}
    assert tgt == {("L", "p", 2000 * 52): 6.0}        # crop is pooled (trap 9), NULL pest / location dropped
    wx = P.weekly_weather(clean).collect()
    assert [(r.location, r.week_id) for r in wx] == [("L", 2000 * 52)]


def test_cluster_conf_is_accepted_at_runtime(spark):
    from agroframe.session import CLUSTER_CONF
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)
            assert spark.conf.get(k) == v
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_scenario_inputs_are_validated(spark):
    import pytest
    from agroframe.operators.forecast import apply_scenarios, scenarios
    with pytest.raises(ValueError):
        scenarios(spark, [(0, 6.0, 1.0, 0.0)])             # temperature offset outside -5..5
    with pytest.raises(ValueError):
        scenarios(spark, [(0, 0.0, 3.5, 0.0)])             # rain multiplier outside 0..3
    many = scenarios(spark, [(i, 0.0, 1.0, 0.0) for i in range(3000)])  # any number of scenarios
    assert apply_scenarios(spark.createDataFrame([(1.0,)] * 2, "maxt_c_lag1 double"), many).count() == 6000
    assert scenarios(spark, [(0, -5.0, 0.0, 20.0)]).count() == 1
