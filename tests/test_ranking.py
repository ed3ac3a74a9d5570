from tidemark.operators import ranking
from tests.conftest import rows


def skewed(spark):
    """One group holds most rows and many ties; one is null."""
    return spark.range(0, 5000).selectExpr(
        "case when id % 10 < 8 then 'hot' when id % 10 = 8 then 'cold' end as g",
        "case when id % 3 = 0 then null else id % 7 end as v", "id",
    )


def test_rank_equals_window(spark):
    for order in (["v desc", "id asc"], ["v asc", "id desc"]):
        window = f"row_number() over (partition by g order by {', '.join(order)}) as r"
        ranged = ranking.rank_rows(skewed(spark), ["g"], order, "r", partitions=6)
        assert rows(ranged) == rows(skewed(spark).selectExpr("*", window))


def test_rank_splits_a_group(spark):
    ranged = ranking.rank_rows(skewed(spark), ["g"], ["v desc", "id asc"], "r", partitions=6)
    assert sorted(r.r for r in ranged.filter("g = 'hot'").collect()) == list(range(1, 4001))


def test_rank_of_nothing(spark):
    assert ranking.rank_rows(skewed(spark).filter("false"), ["g"], ["id"], "r").count() == 0


def test_nulls_sort_as_in_the_warehouse(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 7.0)], "id int, v double")
    desc = ranking.rank_rows(df.selectExpr("*", "1 as g"), ["g"], ["v desc", "id"], "r")
    assert [r.id for r in desc.orderBy("r").collect()] == [3, 2, 1]
    asc = ranking.rank_rows(df.selectExpr("*", "1 as g"), ["g"], ["v asc", "id"], "r")
    assert [r.id for r in asc.orderBy("r").collect()] == [1, 2, 3]


def test_top_one(spark):
    top = ranking.top_one(skewed(spark), ["g"], ["v desc", "id asc"])
    want = ranking.rank_rows(skewed(spark), ["g"], ["v desc", "id asc"], "r").filter("r = 1").drop("r")
    assert rows(top) == rows(want)


def test_top_one_prunes_before_the_shuffle(spark):
    plan = ranking.top_one(skewed(spark), ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
