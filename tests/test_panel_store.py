"""The panel from stored weekly tables: same rows, no row moved."""

import pytest

from agroframe.operators import panel as P
from agroframe.plans import pest
from agroframe.plans import pest_sql as S
from agroframe.session import materialize
from agroframe.sources import panel_store as PS
from conftest import SF_CHECK, SF_SMALL


@pytest.fixture()
def co_partitioned(spark):
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    kept = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_the_plan_moves_no_row(spark, tmpdir_path, co_partitioned):
    PS.write(materialize(pest.clean(spark, SF_CHECK)), "plan_test", f"{tmpdir_path}/t", buckets=8)
    got = PS.feature_panel(spark, "plan_test", S.MIN_OBS_Q)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 3
    assert got.count() == pest.panel(spark, SF_CHECK).count() > 0
    PS.drop(spark, "plan_test")


def test_written_again_and_empty(spark, tmpdir_path):
    clean = materialize(pest.clean(spark, SF_SMALL, level="region"))
    for rows in (clean.limit(0), clean):
        PS.write(rows, "again_test", f"{tmpdir_path}/t", buckets=4)
        want = P.feature_panel(rows, 10)
        got = PS.feature_panel(spark, "again_test", 10)
        assert sorted(map(tuple, got.select("crop", "location", "pest", "week_id", "pest_value").collect())) == \
            sorted(map(tuple, want.select("crop", "location", "pest", "week_id", "pest_value").collect()))
    PS.drop(spark, "again_test")
