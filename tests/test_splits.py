"""Split and catalogue properties on the sf0.01 fixtures."""

from pyspark.sql import functions as F

from conftest import SF_CHECK

from agroframe.operators import catalogue as C
from agroframe.plans import catalogue as PC
from agroframe.plans import sensor as PS


def test_group_split_properties(spark):
    cs = PC.clean_split_df(spark, SF_CHECK).cache()
    # groups never cross splits
    assert C.leaks(cs, ["class_name", "source"]).count() == 0
    # classes with >= 3 groups have >= 1 group in every split
    g = cs.groupBy("class_name").agg(F.countDistinct("source").alias("n_groups"),
                                     F.countDistinct("split").alias("n_splits"))
    assert g.filter((F.col("n_groups") >= 3) & (F.col("n_splits") < 3)).count() == 0
    # valid / test keep one representative per group; train keeps all rows
    man = PC.manifest(spark, SF_CHECK)
    tr_groups = cs.filter("split = 'train'").select("class_name", "source").distinct()
    assert (cs.filter("split = 'train'").count()
            == man.join(tr_groups, ["class_name", "source"], "left_semi").count())
    one = cs.filter("split != 'train'").groupBy("class_name", "source").count()
    assert one.filter("count > 1").count() == 0


def test_class_weights_average_out(spark):
    w = PC.class_weights(spark, SF_CHECK).collect()
    N = sum(r.freq for r in w)
    if all(r.freq >= 1 for r in w):
        assert abs(sum(r.freq * r.weight for r in w) - N) < 1e-3 * N


def test_stratified_split_sizes(spark):
    s = PS.stratified_split(spark, SF_CHECK)
    counts = {(r.health_label, r.split): r["count"] for r in s.groupBy("health_label", "split").count().collect()}
    for lab in (0, 1):
        n = counts.get((lab, "test"), 0) + counts.get((lab, "train"), 0)
        assert counts[(lab, "test")] == round(0.2 * n)


def _ranked(rows, group, seed=42):
    """Rows of every group in md5 order, in plain Python."""
    import hashlib
    out = {}
    for r in rows:
        out.setdefault(group(r), []).append(r)
    return {g: sorted(v, key=lambda r: hashlib.md5(f"{seed}|{r[0]}".encode()).hexdigest()) for g, v in out.items()}


def test_radix_selection_equals_a_sort(spark):
    from agroframe.operators import splits as SP
    rows = [(i, ("hot", "b", None)[0 if i % 3 else i % 7 % 3]) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, label string").repartition(9)
    want = {r[0] for v in _ranked(rows, lambda r: r[1]).values() for r in v[:round(0.2 * len(v))]}
    out = SP.stratified_split(df, "label", "id", 0.2)
    assert {r.id for r in out.where("split = 'test'").collect()} == want and out.count() == len(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan  # bounds are broadcast, rows only filtered
    for n in (0, 1, 777, 20_000, 50_000):
        want = {r[0] for r in _ranked(rows, lambda r: 0)[0][:n]}
        assert {r.id for r in SP.sample_n(df, "id", n).collect()} == want


def test_selection_refines_only_the_bucket_of_the_cut(spark, monkeypatch):
    from agroframe.operators import selection
    written = []
    keep = selection.materialize
    monkeypatch.setattr(selection, "materialize", lambda d, name="stage": written.append((name, keep(d, name))) or written[-1][1])
    df = spark.range(50_000).select(F.md5(F.col("id").cast("string")).alias("d"))
    bound = selection.bounds(df, [], "d", {"cut": lambda n: F.lit(12_345)}).first().cut
    assert df.where(F.col("d") < bound).count() == 12_345
    counted = [t.agg(F.sum("_c")).first()[0] for name, t in written if name == "digits"]
    assert counted[0] == 50_000 and all(c < 100 for c in counted[1:]) and len(counted) <= 4


def test_selection_with_repeated_keys_and_empty_tables(spark):
    from agroframe.operators import splits as SP
    df = spark.createDataFrame([(1, "a")] * 8 + [(2, "a"), (3, "a")], "id long, label string")
    out = {(r.id, r.split): r["count"] for r in SP.stratified_split(df, "label", "id", 0.5).groupBy("id", "split").count().collect()}
    assert all(n in (1, 8) for n in out.values()) and len(out) == 3  # copies of one key are never parted
    assert SP.sample_n(df, "id", 5).count() <= 5
    assert SP.stratified_split(df.limit(0), "label", "id").count() == 0 and SP.sample_n(df.limit(0), "id", 5).count() == 0


def test_null_classes_and_groups_are_kept(spark):
    from agroframe.operators import splits as SP
    from agroframe.operators.ranking import exact_quantiles, rank_within
    rows = [(i, (None, "c")[i % 2], (None, "s", "t", "u")[i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, cls string, src string")
    out = SP.group_split(df, "cls", "src", row_order="id")
    assert out.select("cls", "src").distinct().count() == 4
    assert rank_within(df, ["cls"], ["id"], out="r").count() == 40
    assert {r.cls for r in exact_quantiles(df, "id", [0.5], keys=["cls"]).collect()} == {None, "c"}
