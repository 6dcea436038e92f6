"""Rules over rows that state their outcome: each function gives a table and the SQL beside it the expected one."""

from __future__ import annotations

from pyspark.sql import functions as F
from sievework.functions import claims as C
from sievework.functions import learning as L
from sievework.functions import text as T
from sievework.operators import intake
from sievework.plans.registry import values

CASES = {}


def query(sql):
    def add(f):
        CASES[f.__name__] = f, sql
        return f

    return add


#: (case, text, symbol:stance of each claim of version 4)
V4 = [
    (1, "没有减仓，VGT的比例肯定增加了。", "VGT:hold"), (2, "No, LITE 没有那么speculative，不卖", "LITE:hold"), (3, "Taking some profit on AMAT", "AMAT:trim"), (4, "今天卖出了部分VGT在117.57", "VGT:sell"),
    (5, "I am bearish on QQQ for the next few months.", "QQQ:bearish"), (6, "S&P 我卖出了一部分，LRS 策略也卖出。", ""), (7, "今天天气不错，提到AAPL而已。", ""), (8, "他说已经清仓INTC了。", ""), (9, None, ""), (10, "", ""),
    (11, "sell puts on QQQ this week", "QQQ:bullish"), (12, "今天我买入NVDA，长期看好。", "NVDA:buy"),
]


#: (case, text, horizon, conditional, question, price of the first claim)
FIELDS = [(1, "我准备长期持有VGT，跌到110会继续加仓。", "long", True, False, 110.0), (2, "TSLA可以买入了吗？", None, False, True, None), (3, "今天我买入NVDA，长期看好。", "long", False, False, None)]


V6 = [(1, "Look at META. 跌到500是好事。", "META:bullish"), (2, "今天我买入NVDA，长期看好。", "NVDA:buy"), (3, "AMD is here. Nothing else said.", "")]


V7 = [(1, "加仓了", "Talk about NVDA", "NVDA:add:context"), (2, "加仓了", "NVDA or TSLA", ""), (3, "如果你在300卖掉MSFT就好。", None, "")]


HP = [(1, "今天我买入NVDA，长期看好。", "NVDA:buy:executed"), (2, "Will you sell AAPL?", ""), (3, "sell puts on QQQ this week", "QQQ:bullish:opinion"), (4, "他说已经清仓INTC了。", "")]


def _pairs(found, *fields):
    return F.array_join(F.transform(found, lambda c: F.concat_ws(":", *(c[k] for k in fields))), ",")


@query(f"with r(case_id, t, claims) as (values {values(V4)}) select case_id, claims from r")
def claims_v4(spark, sf):
    r = spark.createDataFrame(V4, "case_id int, t string, want string")
    return r.select("case_id", _pairs(C.claims(F.col("t")), "symbol", "stance").alias("claims"))


@query(f"with r(case_id, t, horizon, conditional, question, price) as (values {values(FIELDS)}) select case_id, horizon, conditional, question, cast(price as double) as price from r")
def claim_fields(spark, sf):
    r = spark.createDataFrame([x[:2] for x in FIELDS], "case_id int, t string").select("case_id", F.get(C.claims(F.col("t")), F.lit(0)).alias("c"))
    return r.select("case_id", "c.horizon", "c.conditional", "c.question", "c.price")


@query(f"with r(case_id, t, claims) as (values {values(V6)}) select case_id, claims from r")
def claims_v6(spark, sf):
    r = spark.createDataFrame(V6, "case_id int, t string, want string")
    return r.select("case_id", _pairs(C.claims(F.col("t"), C.V6), "symbol", "stance").alias("claims"))


@query(f"with r(case_id, t, context, claims) as (values {values(V7)}) select case_id, claims from r")
def claims_v7(spark, sf):
    """Replies, with the text that they answer."""
    r = spark.createDataFrame(V7, "case_id int, t string, context string, want string")
    return r.select("case_id", _pairs(C.claims(F.col("t"), C.V7, F.col("context")), "symbol", "stance", "ticker_source").alias("claims"))


@query(f"with r(case_id, t, claims) as (values {values(HP)}) select case_id, claims from r")
def claims_hp(spark, sf):
    r = spark.createDataFrame(HP, "case_id int, t string, want string")
    return r.select("case_id", _pairs(C.high_precision(F.col("t")), "symbol", "stance", "status").alias("claims"))


#: (case, text, symbol:type:size:price of each action)
ACTIONS = [
    (1, "继续持有87% VGT、13% SGOV。设117.57止盈，卖出VGT总仓位4%。", "VGT:HOLD,SGOV:HOLD,VGT:SELL_PLANNED:4.0:117.57"), (2, "如果下个星期没有触发止盈点，那就继续保持90%仓位在VGT", "VGT:HOLD"),
    (3, "今天卖出了部分VGT在117.57，大约占VGT总仓位的4%", "VGT:SELL_EXECUTED:4.0:117.57"), (4, "把一部分VGT转到SGOV，调仓了。", "VGT:REBALANCE,SGOV:REBALANCE"), (5, "VGT 是科技指数", "VGT:COMMENTARY"), (6, None, ""),
]


@query(f"with r(case_id, t, actions) as (values {values(ACTIONS)}) select case_id, actions from r")
def author_actions(spark, sf):
    r = spark.createDataFrame(ACTIONS, "case_id int, t string, want string")
    return r.select("case_id", _pairs(C.actions(F.col("t"), ["VGT", "SGOV"]), "symbol", "action_type", "size_pct", "price").alias("actions"))


#: (case, text, portfolio rules hold cash_floor, symbols of operations)
LEARN = [
    (1, "我的做法：TSLA第一档300，第二档280.5，目标区350到400，不主动加", "TSLA:author_plan:high"), (2, "巴菲特持有AAPL", "AAPL:third_party_example:high"), (3, "MSFT 加仓", "MSFT:unconfirmed_author_context:needs_review"), (4, "nothing here", ""), (5, None, ""),
]


@query(f"with r(case_id, t, operations) as (values {values(LEARN)}) select case_id, operations from r")
def learned_operations(spark, sf):
    r = spark.createDataFrame(LEARN, "case_id int, t string, want string")
    made = F.transform(L.operations(F.col("t")), lambda o: F.concat_ws(":", F.get(o["symbols"], F.lit(0)), o["attribution"], o["attribution_confidence"]))
    return r.select("case_id", F.array_join(made, ",").alias("operations"))


RULES = [(1, "这次认错，不追高", "do_not_chase", "admit_wrong"), (2, "plain words", "", ""), (3, None, "", "")]


@query(f"with r(case_id, t, rules, lessons) as (values {values(RULES)}) select case_id, rules, lessons from r")
def learned_rules(spark, sf):
    r = spark.createDataFrame(RULES, "case_id int, t string, a string, b string")
    return r.select("case_id", F.array_join(L.portfolio_rules(F.col("t")), ",").alias("rules"), F.array_join(L.lessons(F.col("t")), ",").alias("lessons"))


SIGNALS = [(1, "PPO 上穿\nSignal 线。突破确认\n股价站上 MA50，趋势确认", "ppo_above_signal:false:CONFIRMATION,price_above_ma50:true:CONFIRMATION"), (2, "", ""), (3, None, "")]


@query(f"with r(case_id, t, signals) as (values {values(SIGNALS)}) select case_id, signals from r")
def method_signals(spark, sf):
    r = spark.createDataFrame(SIGNALS, "case_id int, t string, want string")
    made = F.transform(L.signals(F.col("t")), lambda x: F.concat_ws(":", x["condition_id"], x["machine_ready"].cast("string"), x["state_hint"]))
    return r.select("case_id", F.array_join(made, ",").alias("signals"))


#: (case, text, a theme, whether it is found)
THEMES = [(1, "Intel INTC thesis", "INTC", True), (2, "sell put on QQQ", "Sell Put", True), (3, "这次看错了，割肉复盘", "失败复盘", True), (4, "nothing", "其他研究", True), (5, "nothing", "INTC", False)]


@query(f"with r(case_id, t, theme, found) as (values {values(THEMES)}) select case_id, found from r")
def theme_rules(spark, sf):
    r = spark.createDataFrame(THEMES, "case_id int, t string, theme string, want boolean")
    return r.select("case_id", F.array_contains(L.themes(F.col("t")), F.col("theme")).alias("found"))


#: (case, text, symbol, whether it is found)
SYMBOLS = [(1, "SMH also flying, 620 now!", "NOW", False), (2, 'RSP "must" hold above it or dead :)', "MU", False), (3, "ServiceNow looks extended", "NOW", True), (4, "NOW is breaking out", "NOW", True), (5, "MU up 30, told u guys don't panic", "MU", True)]


@query(f"with r(case_id, t, symbol, found) as (values {values(SYMBOLS)}) select case_id, found from r")
def symbol_rules(spark, sf):
    r = spark.createDataFrame(SYMBOLS, "case_id int, t string, symbol string, want boolean")
    return r.select("case_id", F.array_contains(C.symbols(F.col("t")), F.col("symbol")).alias("found"))


VIDEOS = [(1, "https://www.youtube.com/watch?v=abcdefghijk&t=3", "abcdefghijk"), (2, "https://youtu.be/ABCDEFGHI_-?x", "ABCDEFGHI_-"), (3, "https://youtube.com/shorts/12345678901", "12345678901"), (4, "https://example.com/", None), (5, None, None)]


@query(f"with r(case_id, u, id) as (values {values(VIDEOS)}) select case_id, id from r")
def video_ids(spark, sf):
    return spark.createDataFrame(VIDEOS, "case_id int, u string, want string").select("case_id", T.video_id(F.col("u")).alias("id"))


FREE = [(1, "发表于 2026年1月2日 上午", "2026-01-02"), (2, "on 2026-10-3.", "2026-10-03"), (3, "1/2/2026 08:00", "2026-01-02"), (4, "no date", None), (5, None, None)]


@query(f"with r(case_id, t, day) as (values {values(FREE)}) select case_id, cast(day as date) as day from r")
def free_dates(spark, sf):
    return spark.createDataFrame(FREE, "case_id int, t string, want string").select("case_id", T.free_date(F.col("t")).alias("day"))


#: (case, post id, author, time, title, body, outcome); cases 1 and 2 are in the index
POSTS = [
    (3, "p1", "Jo", "2026-01-02 03:04:05", "again by id", "b", "duplicate"), (4, None, "JO", "2026-01-02 03:04:59", "T", "b", "duplicate"), (5, "p5", "Jo", "2026-01-02 03:05:00", "T", "b", "new"), (6, "p5", "Al", "2026-01-03", "other", "b", "duplicate"),
    (7, "p7", "Al", "2026-01-04", "title", " ", "title_only"), (8, "p8", "Al", "2026-01-05", "", None, "body_missing"),
]


INDEX = [("p1", "Jo", "2026-01-02 01:00:00", "first"), ("p2", "jo", "2026-01-02 03:04:30", "T")]


@query(f"with r(case_id, post_id, author, time, title, body, outcome) as (values {values(POSTS)}) select case_id, outcome from r")
def utterance_outcomes(spark, sf):
    batch = spark.createDataFrame([x[:6] for x in POSTS], "seq int, post_id string, author string, time string, title string, body string")
    return intake.new_utterances(batch, spark.createDataFrame(INDEX, "post_id string, author string, time string, title string")).select(F.col("seq").alias("case_id"), "outcome")


#: (case, url, text, outcome); http://x/a with "stored" is in the store
ARTICLES = [(1, "HTTP://X/a#f", "new text", "duplicate"), (2, "http://x/b", "stored", "duplicate"), (3, "http://x/c", "text c", "stored"), (4, "http://x/c", "text d", "duplicate"), (5, "http://x/e", "text c", "duplicate"), (6, None, "x", "no_link"), (7, "http://x/g", " ", "no_text")]


@query(f"with r(case_id, url, t, outcome) as (values {values(ARTICLES)}) select case_id, outcome from r")
def article_outcomes(spark, sf):
    batch = spark.createDataFrame([x[:3] for x in ARTICLES], "seq int, url string, text string")
    stored = spark.createDataFrame([("http://x/a",)], "url string").withColumn("sha256", F.sha2(F.lit("stored"), 256))
    return intake.article_outcomes(batch, stored).select(F.col("seq").alias("case_id"), "outcome")
