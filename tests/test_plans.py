from newstide.checks import bindings as b
from newstide.checks.registry import CHECKS
from newstide.operators import mentions as m
from newstide.operators.keys import new_articles
from newstide.operators.prices import monthly_price_change
from newstide.operators.scoring import add_sentiment
from newstide.workspace import spread

FOLDER = "/root/testdata/sf0.001"
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    lines = plan.split("\n")
    return [line for line in lines if "Exchange hashpartitioning" in line]


def test_mention_search_shuffles_counts_only(spark):
    plan = plan_of(CHECKS["stock_mentions"].run(spark, FOLDER))
    # the search itself is a broadcast join, the counts are combined before they move
    assert "BroadcastNestedLoopJoin BuildRight, Inner" in plan or "BroadcastHashJoin" in plan
    assert all("text#" not in line and "_lower" not in line for line in exchanges(plan))


def test_price_change_is_one_shuffle_of_partial_results(spark):
    ticks, companies = b.ticks(spark, FOLDER), b.companies(spark, FOLDER)
    plan = plan_of(monthly_price_change(ticks, companies))
    above_ticks = plan[: plan.index("lineitem.parquet")]
    assert "partial_min(struct" in above_ticks
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,0.0)]" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp" in plan


def test_stored_articles_move_as_digests(spark):
    stored, batch = b.first_batch(spark, FOLDER), b.full_delivery(spark, FOLDER)
    plan = plan_of(new_articles(batch, stored))
    assert "LeftAnti" in plan and "_digest" in plan


def test_large_inputs_stay_where_they_are(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(0, 1000, 1, 1), spark.range(0, 100, 1, cores)
    assert f"Repartition {cores}, true" in spread(few)._jdf.queryExecution().optimizedPlan().toString()
    assert spread(many) is many


def test_operators_do_not_deal_rows_out(spark):
    articles = b.news(spark, FOLDER)
    given = plan_of(articles).count("RoundRobin")
    for found in (add_sentiment(articles), m.sector_mentions(articles, b.sectors(spark, FOLDER))):
        assert plan_of(found).count("RoundRobin") <= given
