from pyspark.sql import functions as F

from sievework.functions import learning as L

TEXT = "我的做法：TSLA第一档300，第二档280.5，目标区350到400，不主动加\n巴菲特持有AAPL\n这次认错，不追高\n开户链接送NVDA\nMSFT is a company"


def read(spark, form, text=TEXT):
    return spark.createDataFrame([(text,)], "t string").select(form(F.col("t")).alias("r")).first()["r"]


def test_operations(spark):
    got = read(spark, L.operations)
    assert [(o["symbols"], o["attribution"], o["attribution_confidence"]) for o in got] == [(["TSLA"], "author_plan", "high"), (["AAPL"], "author_plan", "high")]
    assert (got[0]["entry_1"], got[0]["entry_2"], got[0]["target_range"], got[0]["conditions"]) == (300.0, 280.5, [350.0, 400.0], ["no_active_add"])
    assert got[1]["actions"] == ["hold"]
    other = read(spark, L.operations, "巴菲特持有AAPL")
    assert other[0]["attribution"] == "third_party_example"
    assert read(spark, L.operations, None) == []


def test_rules_lessons_and_promotion(spark):
    assert read(spark, L.portfolio_rules) == ["do_not_chase"] and read(spark, L.lessons) == ["admit_wrong"]
    p = read(spark, L.without_promotion)
    assert (p["units"], p["removed"], p["ratio"]) == (5, 1, 0.2)
    assert read(spark, L.themes, "nothing") == ["其他研究"] and "失败复盘" in read(spark, L.themes)


def test_signals(spark):
    got = read(spark, L.signals, "PPO 上穿\nSignal 线。突破确认\n股价站上 MA50，趋势确认")
    assert [(s["condition_id"], s["machine_ready"], s["state_hint"]) for s in got] == [("ppo_above_signal", False, "CONFIRMATION"), ("price_above_ma50", True, "CONFIRMATION")]
    assert read(spark, L.signals, "") == []


def test_signals_and_symbols_look_for_words_before_patterns(spark):
    """Long lines with parts of what a pattern needs: the search may not start there, nor a text be folded for each word."""
    from sievework.functions import extract, learning
    from sievework.functions import rules as R

    assert set(learning.NEEDED) == {name for name, *_ in R.SIGNALS} and ("50",) in learning.NEEDED["price_above_ma50"]
    texts = ["AMAT " + "=" * 700, "AMAT 50 " + "=" * 700, "价格站上 ma 50", "PRICE ABOVE MA50", "连续两天站上MA50", "ma50 连续 2 天", "跌破ma  50", "MA above", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [[x["condition_id"] for x in r.s] for r in df.select("i", learning.signals(F.col("t")).alias("s")).orderBy("i").collect()]
    assert [sorted(x) for x in got] == [[], [], ["price_above_ma50"], ["price_above_ma50"], ["ma50_hold_two_sessions", "price_above_ma50"], ["ma50_hold_two_sessions"], ["price_below_ma50"], [], []]
    plan = df.select(extract.themes(F.col("t"), R.THEMES, "x"), extract.detect(F.col("t"), R.ALIASES, list(R.TICKERS)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(t#") == 2
