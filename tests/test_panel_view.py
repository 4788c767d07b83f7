import numpy as np
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from agroframe.operators import panel as P
from agroframe.operators.forecast import checked_scenarios, feature_cols, scenarios
from agroframe.operators.panel_view import PanelView
from agroframe.plans import pest as PP


def same(a, b):
    key = lambda r: (r.crop, r.location, r.pest, r.week_id)
    a, b = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert list(map(key, a)) == list(map(key, b)) and len(a) > 0
    for x, y in zip(a, b):
        for u, v in zip(list(x)[3:], list(y)[3:]):
            assert (u is None) == (v is None) and (u is None or abs(u - v) < 1e-9)


def test_batches_equal_the_full_panel(spark, tmpdir_path):
    c = PP.clean(spark, SF_CHECK).where("location IN ('NATION_0', 'NATION_1', 'NATION_2')").cache()
    # newest weeks first, then the rest, then one late week again
    late = c.where("week_id % 97 = 5 AND location = 'NATION_1'")
    first = c.where("week_id % 97 <> 5 OR location <> 'NATION_1'")
    view = PanelView().apply(first.where("week_id > 1300")).apply(first.where("week_id <= 1300"))
    same(view.panel(min_obs=20), P.feature_panel(first, min_obs=20))
    view.save(f"{tmpdir_path}/view")
    view = PanelView.load(spark, f"{tmpdir_path}/view").apply(late)
    same(view.panel(min_obs=20), P.feature_panel(c, min_obs=20))
    weeks = late.select("week_id").distinct().count()
    assert 0 < view.recomputed <= weeks * 5 < view.features.count() / 2


def test_null_keys_and_empty_batches(spark):
    c = PP.clean(spark, SF_CHECK).where("location = 'NATION_3'")
    odd = c.limit(30).withColumn("pest", F.lit(None).cast("string")).unionByName(c.limit(10).withColumn("location", F.lit(None).cast("string")))
    view = PanelView().apply(c).apply(odd).apply(c.limit(0))
    same(view.panel(min_obs=10), P.feature_panel(c.unionByName(odd), min_obs=10))


def test_scenario_tables_and_feature_columns(spark):
    good = scenarios(spark, [(0, 0.0, 1.0, 0.0), (1, -5.0, 3.0, 20.0)])
    assert checked_scenarios(good).count() == 2
    for bad in ((2, 9.0, 1.0, 0.0), (3, 0.0, None, 0.0)):
        with pytest.raises(ValueError):
            checked_scenarios(good.unionByName(spark.createDataFrame([bad], good.schema)))
    panel = spark.createDataFrame([("b", "y", "p"), ("a", "x", "p"), ("a", "y", "q")], "crop string, location string, pest string")
    got = [r.column for r in feature_cols(panel, ["f1"]).orderBy("position").collect()]
    assert got == ["f1", "standard_week", "crop_a", "crop_b", "location_x", "location_y", "pest_p", "pest_q"]
    assert np.array_equal([r.position for r in feature_cols(panel, ["f1"]).orderBy("position").collect()], range(8))
