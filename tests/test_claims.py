from pyspark.sql import functions as F

from sievework.functions import claims as C

#: Sentences of our own and the claims that they hold by each version.
CASES = [
    ("今天我买入NVDA，长期看好。", {"4": [("NVDA", "buy")], "6": [("NVDA", "buy")], "hp": [("NVDA", "buy")]}),
    ("我没有卖出TSLA，继续持有。", {"4": [("TSLA", "hold")]}),
    ("他说已经清仓INTC了。", {"4": []}),
    ("Will you sell AAPL?", {"4": [("AAPL", "sell")], "hp": []}),
    ("如果你在300卖掉MSFT就好。", {"7": []}),
    ("sell puts on QQQ this week", {"4": [("QQQ", "bullish")], "hp": [("QQQ", "bullish")]}),
    ("AMD is here. Nothing else said.", {"4": []}),
    ("Look at META. 跌到500是好事。", {"6": [("META", "bullish")], "4": []}),
]


def test_versions(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, text string")
    forms = {"4": C.claims(F.col("text")), "6": C.claims(F.col("text"), C.V6), "7": C.claims(F.col("text"), C.V7), "hp": C.high_precision(F.col("text"))}
    for name, form in forms.items():
        got = {r["i"]: [(c["symbol"], c["stance"]) for c in r["c"]] for r in df.select("i", form.alias("c")).collect()}
        for i, (text, want) in enumerate(CASES):
            if name in want:
                assert got[i] == want[name], (name, text, got[i])


def test_reply_takes_the_only_symbol_of_its_parent(spark):
    df = spark.createDataFrame([("加仓了", "Talk about NVDA"), ("加仓了", "NVDA or TSLA")], "text string, title string")
    got = [r["c"] for r in df.select(C.without_text(C.claims(F.col("text"), C.V7, F.col("title"))).alias("c")).collect()]
    assert [[(c["symbol"], c["stance"], c["ticker_source"]) for c in x] for x in got] == [[("NVDA", "add", "context")], []]
    assert "_s" not in got[0][0].asDict()


def test_long_text_is_cut_into_local_pieces(spark):
    got = spark.createDataFrame([("字" * 400,), ("word, " * 100,)], "text string").select(C.sentences(F.col("text")).alias("s")).collect()
    assert [len(x) for x in got[0]["s"]] == [160, 160, 80]
    assert all(6 <= len(x) <= 160 for x in got[1]["s"])


def test_actions(spark):
    text = "准备设120止盈卖出ABC 30%。ABC已经卖出了20%\n继续保持90%仓位在ABC。从ABC转到XYZ"
    got = spark.createDataFrame([(text,)], "text string").select(C.actions(F.col("text"), ["ABC", "XYZ"]).alias("a")).first()["a"]
    assert [(a["symbol"], a["action_type"], a["confidence"]) for a in got] == [
        ("ABC", "SELL_PLANNED", "high"), ("ABC", "SELL_EXECUTED", "high"), ("ABC", "HOLD", "high"), ("ABC", "REBALANCE", "medium"), ("XYZ", "REBALANCE", "medium")]
    assert got[0]["price"] == 120 and got[1]["size_pct"] == 20 and got[2]["allocation_pct"] == '{"ABC":90.0}'
    df = spark.createDataFrame([(text,)], "text string").select(C.headline(C.actions(F.col("text"), ["ABC", "XYZ"])).alias("h"))
    assert df.first()["h"] == "ABC SELL_EXECUTED"
