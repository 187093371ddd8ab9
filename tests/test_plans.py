"""What the plans must look like: shuffles, pruning, pushdown, and no unbounded window groups."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


SINGLE_PASS = ["t1_sma", "t14_volume", "w3_returns",
               "f1_lag_features", "f2_history_features", "f4_return_targets", "w12_sequences", "w4_rolling_ticks", "w6_sliding_year", "w5_sliding_ticks"]


@pytest.mark.parametrize("name", SINGLE_PASS)
def test_one_shuffle_by_block(spark, name):
    found = exchanges(plan_of(spark, name))
    assert len(found) == 1 and re.match(r"ticker#\d+L?, __blk#\d+L?", found[0])


@pytest.mark.parametrize("name", ["t2_ema", "t6_macd", "t8_adx", "t9_atr", "t24_configured_set", "w9_ewm"])
def test_exponential_means_by_block(spark, name):
    """Rows are shuffled by block only; segments and keys are small tables with one row per run of blocks."""
    for found in exchanges(plan_of(spark, name)):
        assert re.match(r"ticker#\d+L?, (__blk|__group|_groupingexpression)#\d+L?", found) or re.fullmatch(r"ticker#\d+L?, \d+", found), found


@pytest.mark.parametrize("name,passes,levels", [("t2_ema", 0, 1), ("w9_ewm", 0, 1), ("t6_macd", 0, 2), ("t8_adx", 1, 2)])
def test_shuffles_of_exponential_means(spark, name, passes, levels):
    """A level of means costs three shuffles, two of them with a row per segment; what two readers ask for runs once."""
    df = QUERIES[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    run = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len(run) <= passes + 3 * levels


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "wtpfaqjx"))
def test_windows_and_joins(spark, name):
    plan = plan_of(spark, name)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    # A row-level window is per block, bucket or bin; per ticker alone only where a rank limit prunes it,
    # or over the small tables with one row per block or bucket.
    for line in plan.splitlines():
        keys = re.search(r"\bWindow \[.*\], \[([^\]]*)\], \[([^\]]*)\]", line)
        if keys and re.fullmatch(r"ticker#\d+L?", keys.group(1)):
            assert "WindowGroupLimit" in plan or re.match(r"__(blk|bucket|bin|group)#", keys.group(2)), line


def test_scan_reads_only_what_is_used(spark):
    plan = plan_of(spark, "t6_macd")
    assert re.search(r"ReadSchema: struct<ticker:string,date:date,close:double,pos:bigint>", plan)


@pytest.mark.parametrize("name,column", [("p3_date_range", "date"), ("q2_price_trends", "date"), ("q6_price_breakouts", "date"),
                                         ("s11_find_documents", "n_chars")])
def test_filters_reach_the_scan(spark, name, column):
    assert re.search(rf"PushedFilters: \[[^\]]*GreaterThan(OrEqual)?\({column}", plan_of(spark, name))


@pytest.mark.parametrize("name", ["a1_daily_sentiment", "a14_first_last_price", "q7_reconciliation", "a4_resample_week", "r7_tick_bars_batch"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "partial_" in plan and "SortAggregate" not in plan


def test_top_k_and_latest(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "l2_top_k")
    assert "WindowGroupLimit" in plan_of(spark, "w11_latest_rows")
