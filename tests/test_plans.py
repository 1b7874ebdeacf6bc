"""Plan-shape checks for the skew-sensitive operators: partial work before
every shuffle, pushed-down scans, no nested-loop joins."""

import contextlib
import io

from pyspark.sql import functions as F

from noema.operators.rows import first_per_key, top_k_per_key


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def hot_frame(spark):
    # key 0 holds a third of all rows
    return spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("pos"), (F.col("id") * 7 % 101).alias("v"))


def test_first_per_key_aggregates_before_the_shuffle(spark):
    df = first_per_key(hot_frame(spark), ["k"], ["pos"])
    p = plan(df)
    head = p.split("\n\n")[0]
    assert head.index("Exchange") < head.rindex("Aggregate")     # a partial aggregate sits below the exchange
    assert dict(df.where("k = 0").first().asDict())["pos"] == 0


def test_top_k_limits_before_the_shuffle(spark):
    df = top_k_per_key(hot_frame(spark), ["k"], [F.desc("v"), F.asc("pos")], 3)
    p = plan(df)
    assert "Partial" in p and "WindowGroupLimit" in p
    assert df.where("k = 0").count() == 3


def test_catalog_scans_are_pruned_and_join_free_of_nested_loops(spark):
    import __spark_entry__ as e
    for name in ("topk_refs", "describe", "kc_finalize", "id_to_name_twice"):
        p = plan(e.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, name
        if name != "describe":          # describe reads its materialised, ranked column
            assert "ReadSchema" in p, name
    p = plan(e.queries()["topk_refs"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_retailprice:double>" in p
