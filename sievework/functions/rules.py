"""Fixed values of the claim and action rules: patterns, labels and word lists, in the order in which they count."""

#: Stance cues of version 4: label and pattern; the first that matches a sentence is its stance.
STANCE = (
    ("bullish", r"sell\s*puts?|卖\s*put|卖出看跌|short\s*puts?"),
    ("hold", r"covered\s*calls?|卖\s*call|备兑"),
    ("hold", r"(?:没有|没|不|未|不会)(?:减仓|卖出?|卖掉|清仓|止盈)|not selling|won'?t sell|继续保持|保持\s*\d+%|长期持有|满仓长期|我没动|拿了.{0,10}没动|半股也不会卖"),
    ("trim", r"减仓|减了仓|卖掉一半|卖出一部分|卖了一点|止盈|取利|获利卖|trim|tak(?:e|ing) (?:some )?profits?|took the profit"),
    ("sell", r"清仓|卖出|卖掉|卖了|sell\b|exit"),
    ("add", r"加仓|补仓|继续买|加了|加大|add to|adding|buy more"),
    ("buy", r"买入|建仓|建的仓|逢低买|抄底|上车|必买|值得买|买进|买了|少买了|\d\s*(?:左右)?接(?!受|近|着|下来)|(?<![直承对迎])接(?:的|了)?(?=\s*\d)|(?<![不别])买\s*\$?[A-Z]{2,5}(?![A-Za-z])|buy\b|bought|accumulat|is a buy"),
    ("hold", r"继续持有|拿住|一股也不卖|持有不动|hold\b|holding"),
    ("avoid", r"不碰|远离|回避|不建议买|avoid|stay away"),
    ("bearish", r"看空|看跌|见顶|泡沫|下跌空间|bearish|overvalued"),
    ("bullish", r"看好|看涨|上涨空间|低估|牛股|bullish|undervalued|upside"),
)
STANCE_6 = (
    ("bullish", r"目标价?\s*(?:依然|仍然|还是)?\s*(?:是|在)?\s*\$?\d|目标是\s*\$?\d|是好事|还可以的价格|可以的价格|价格不错|look for .{0,20}to reach|don'?t see anything wrong|最靓仔|会有个?\s*hard bounce"),
    ("bearish", r"local top|near the top|接近.{0,4}顶|向下的?概率比向上的?高|跌的机率更大|跌的概率更大|涨幅有限|不是\s*buy"),
)
STANCE_7 = (
    ("bullish", r"sold\s.{0,30}?puts?\b|sell\s.{0,30}?puts?\b|卖(?:出)?的?.{0,10}(?:葡萄|put)|接(?:正)?股"),
    ("hold", r"long hold|not selling|no way i am going to (?:close|sell)|长仓|长持|不会动|不动(?:它|他)|握着不卖|拿着|不打算卖|还不打算卖|找不到卖的理由|卖(?:出)?的?\s*cc\b|covered calls?|我的\s*\$?[A-Za-z]{2,5}(?:股票)?|最大仓|i still have"),
    ("sell", r"被止损|止损了|退出来|sold\b|sell (?:another|all|my|half)|全卖了|卖掉|应该去掉|去掉的"),
    ("buy", r"(?:又|再|我|先)进(?!行|步|一步|展|度|化|口|来)|进的|\d\s*(?:又)?进(?!行|步|展|度)|买回|买着|买进|新买|buying|buy buy|it'?s a buy|good entry|准备进去|进去搞|可以加|盘前会加|买入小股"),
    ("add", r"又加|也加|再加|加了|今天也加仓|加\s*\$?[A-Z]{2,5}"),
    ("bearish", r"short target|最后需要考虑|回到.{0,8}以下都不是不可能|调整到.{0,8}才合理|破\s*\d+.{0,10}机率大"),
    ("bullish", r"合理估值|合理的?价位|非常合理|bottom is in|肯定涨|只是需要时间|没那么悲观|priced in|long term\b|更安全|安全一点|假摔|park money|值那么多|could be a meaningful"),
)
HORIZON = (
    ("long", r"长期|长线|几年|多年|long[- ]term|years"),
    ("short", r"短期|短线|这周|下周|本周|近期|short[- ]term|this week|next week"),
    ("medium", r"中期|几个月|今年|年底|medium[- ]term|months|this year"),
)
CONDITIONAL = r"如果|要是|跌到|涨到|一旦|除非|假如|if\b|once\b|unless"
CONDITIONAL_6 = CONDITIONAL + r"|到时候|到时"
PRICE = r"(?:\$|美元|价位|跌到|涨到|目标价?|target)\s*([0-9]{1,5}(?:\.[0-9]{1,2})?)"
THIRD_PARTY = r"(?:^|[，,。；;：:\s“\"])(?:他|她|他们|有人|别人|巴菲特|段永平|Asness|作者拿)|举例|据报道|13F"
OWN_VOICE_4 = r"我|俺|\bI\b|\bmy\b"
OWN_VOICE = r"我|俺|本人|(?<![A-Za-z])I(?![A-Za-z])|(?<![A-Za-z])my(?![A-Za-z])"
OTHERS = r"你|您|他|她|有人|别人|大家|网友|网红|楼主"
HISTORICAL = r"(?<!\d)(?:19\d{2}|20(?:0\d|1\d|2[0-4]))\s*年|如果是.{0,12}(?:买进|买入|买的)|假设|打个比方|举个例子|比如说"
IF_YOU = r"如果你|你如果|要是你|假如你|if you\b"
#: Gates of the high-precision version.
EXECUTED = r"\btaking\b|\bselling\b|\bbuying\b|\badding\b|了|已经?|今天|昨天|昨晚|刚刚|刚才|盘前|盘后|上周|这周|本周|周[一二三四五]|月底|\d+月\d+[号日]|took|sold|bought|exited|added"
FORECAST = r"下一站|估计|猜|应该会|可能会|也许|大概率|看图|目标价|会到|会回到|会有|hard bounce|pt\b|target"
HOLD_POSITION = r"(?:保持|维持)\s*\d+(?:\.\d+)?\s*%|\d+(?:\.\d+)?\s*%\s*(?:的)?仓位|重仓|最大仓|满仓|全仓|拿了.{0,10}没动|我没动|半股也不会卖|一股也不卖|不卖"
CONDITIONAL_PLAN = r"(?:如果|若|一旦|跌到|跌下|涨到|到了?)[^。；;]{0,24}(?:就|再|会|才)?\s*(?:买|加仓|加|卖|减仓|止盈|取利)"
SELL_PUT = r"sell\s*puts?|卖\s*put|卖出看跌"

#: Names of companies, in either case; tickers; tickers that are words and count in capitals only.
ALIASES = {
    "英特尔": "INTC", "intel": "INTC", "iren": "IREN", "特斯拉": "TSLA", "tesla": "TSLA", "nebius": "NBIS", "coreweave": "CRWV", "marvell": "MRVL",
    "英伟达": "NVDA", "美光": "MU", "servicenow": "NOW", "paypal": "PYPL",
}
TICKERS = (
    "INTC", "IREN", "TSLA", "NBIS", "CRWV", "META", "QCOM", "MRVL", "NVDA", "MU", "NOW", "PYPL", "COIN", "AAPL", "AMZN", "GOOG", "GOOGL", "QQQ",
    "TQQQ", "SMH", "SPY", "VOO", "QLD", "VGT", "LITE", "AMD", "MSFT", "TSM", "AVGO", "SOFI", "BE", "AMAT", "AAOI", "CIEN", "SGOV", "ORCL", "HOOD",
    "QQQM", "SPCX", "NFLX", "PLTR", "GLD",
)
CAPITALS_ONLY = ("NOW", "MU", "META", "COIN")
#: Further names and tickers of claims, written exactly so.
CLAIM_ALIASES = {
    "亚麻": "AMZN", "古狗": "GOOGL", "Marvell": "MRVL", "CoreWeave": "CRWV", "英伟达": "NVDA", "特斯拉": "TSLA", "苹果": "AAPL", "微软": "MSFT", "谷歌": "GOOGL", "亚马逊": "AMZN",
    "美光": "MU", "台积电": "TSM", "超微": "AMD", "纳指": "QQQ", "标普": "VOO", "博通": "AVGO", "甲骨文": "ORCL", "脸书": "META", "奈飞": "NFLX", "黄金": "GLD",
}
CLAIM_TICKERS = ("ARM", "IBIT", "AEHR", "CRDO", "RKLB", "VSH", "SOXL", "AVL", "COHR", "TSEM", "UPRO", "SNDK", "DIA")
CLAIM_TICKERS_6 = ("SPX",)
CLAIM_TICKERS_7 = ("TMF", "TLT", "SKHY", "LRCX", "GEV", "VRT", "STX", "WDC", "SITM")

#: Actions of position holders.
ACT_EXECUTED = r"已经?买入|已经?买了|买了|已建仓|成交了?|已成交|已经?卖出|卖出了|已卖|卖掉了|已减仓|减仓了|已加仓|加仓了|止盈了|已止盈|filled|bought|sold"
ACT_PLANNED = r"准备|计划|打算|将会?|设(?:定|了)?\s*[0-9.]+\s*(?:止盈|卖|挂)|挂单|止盈单|下(?:个)?(?:星期|周|礼拜)|明天|如果|到了?\s*[0-9.]+\s*(?:就|再)"
ACT_HOLD = r"继续保持|继续持有|保持|不动|拿着|持有不变|仓位不变|hold"
ACT_REBALANCE = r"调仓|换成|转到|转入|移到|再平衡|rebalanc"
ACT_SELL = r"卖出|卖掉|减仓|止盈|清仓|sell|trim"
ACT_BUY = r"买入|买了|加仓|建仓|补仓|buy|add"
ACT_NOT_TRIGGERED = r"没有触发|未触发|不触发|没触发"
ACT_PRICE = r"(?:设|在|到|价格?|@)\s*\$?([0-9]{2,4}\.[0-9]{1,2}|[0-9]{2,4})\s*(?:美元|元)?\s*(?:止盈|卖|挂|买|成交)?"
ACT_SIZE = (r"(?:卖出|卖掉|减仓|买入|加仓|止盈)[^0-9%]{0,12}?([0-9]{1,3}(?:\.[0-9]+)?)\s*%", r"占[^0-9%]{0,10}?总仓位的?\s*([0-9]{1,3}(?:\.[0-9]+)?)\s*%")
ACT_ORDER = ("SELL_EXECUTED", "BUY_EXECUTED", "REBALANCE", "SELL_PLANNED", "BUY_PLANNED", "HOLD", "UNCLEAR", "COMMENTARY")

#: Structured learning: fields with one number, labels of actions, conditions, portfolio rules and lessons.
OP_FIELDS = {
    "entry_1": r"第一档\s*([0-9]+(?:\.[0-9]+)?)", "entry_2": r"第二档\s*([0-9]+(?:\.[0-9]+)?)", "exit_line": r"卖出线\s*(?:暂时不定|([0-9]+(?:\.[0-9]+)?))",
    "sell_put_strike": r"(?:卖|sell)\s*([0-9]+(?:\.[0-9]+)?)\s*行权价.*?(?:put)", "entry_below": r"跌到\s*([0-9]+(?:\.[0-9]+)?)\s*以下.*?第一档",
}
OP_TARGET = r"目标区\s*([0-9]+(?:\.[0-9]+)?)\s*(?:到|[-–~至])\s*([0-9]+(?:\.[0-9]+)?)"
OP_ACTIONS = (
    ("clear", r"清仓"), ("trim_half", r"卖掉一半"), ("trim", r"减仓|卖掉不小的一部分|开始卖"), ("add", r"加仓|补仓|继续买"), ("buy", r"买入|建仓|逢低买"), ("sell", r"卖出"),
    ("sell_put", r"卖\s*\d*(?:\.\d+)?\s*行权价.*?put|sell put"), ("hold", r"持有|一股也不卖"), ("no_add", r"不主动加"), ("no_direct_stock_buy", r"不直接买股票"),
)
OP_CONDITIONS = (("no_active_add", r"不主动加"), ("only_below_threshold", r"(?=.*只有跌到).*才考虑"), ("accept_assignment_then_reassess", r"接到货再说"))
PORTFOLIO_RULES = (
    ("cash_floor", r"现金底线不破|现金比例不跌破底线"), ("no_core_leverage", r"核心仓位不上杠杆"), ("predefined_levels", r"预设点位|把点位写下来|跌到就买，不跌就不买"),
    ("one_tranche_at_a_time", r"每次只用一档|不允许一次打完"), ("do_not_chase", r"不追高|不追涨"), ("speculation_stop_10", r"投机股一旦回撤\s*10%.*?止损"),
    ("sell_put_only_willing_to_own", r"只卖\s*put\s*给自己愿意长期持有"), ("dca_core", r"核心长期股采用\s*DCA|逢低逐步买入"), ("keep_cash_30", r"保留约\s*30%\s*现金"),
    ("avoid_extreme_emotion", r"避免在极端情绪日做重大决策"),
)
LESSONS = (
    ("cash_too_early", r"加得太快.*太猛|子弹在半山腰就打光"), ("process_wrong", r"过程是错的"), ("luck_not_skill", r"不是我预判精准.*运气|把运气当能力"),
    ("thesis_vs_timing", r"方向正确.*不代表|判断没错.*过程"), ("admit_wrong", r"认错|看错了|割肉"),
)
THIRD_NAMES = ("段永平", "巴菲特", "德鲁肯米勒", "斯坦利", "芒格", "Burry", "伯里")
#: The class holds a backslash and an "s", as the rule has them, and no white space.
FIRST_PERSON = r"(^|[，。；：\\s])(我|我的|我在|我已经|我现在|我会|我不|我只|我买|我卖|我加|我减|我持有|我清仓|我重仓|我准备)"
PLAN = r"预设点位|现在的做法|第一档|第二档|目标区|卖出线|才考虑|接到货再说"
#: Method signals: condition, pattern over a unit and its neighbours, whether a machine may act on it.
SIGNALS = (
    ("tcds_cross_zero", r"tcds.{0,48}(?:回到\s*(?:0|零)|=\s*0|转正|由负(?:值)?(?:持续)?回升)", False),
    ("ppo_above_signal", r"ppo.{0,96}(?:上穿|向上交叉|向上超过|高于|超过|金叉|cross(?:es|ed)?\s+above).{0,48}(?:signal|信号线)", False),
    ("ppo_hist_positive", r"(?:ppo.{0,40})?(?:histogram|柱状图|柱线).{0,40}(?:负转正|转正|positive)", False),
    ("price_above_ma50", r"(?:价格|股价|price)?.{0,36}(?:站上|突破|高于|above).{0,18}ma\s*50", True),
    ("price_below_ma50", r"(?:价格|股价|price)?.{0,36}(?:跌破|低于|below).{0,18}ma\s*50", True),
    ("ma50_hold_two_sessions", r"(?:连续\s*(?:两|2)\s*(?:个)?(?:交易日|天).{0,36}(?:站上|守住|高于).{0,18}ma\s*50|ma\s*50.{0,64}连续\s*(?:两|2)\s*(?:个)?(?:交易日|天).{0,24}(?:站上|守住|高于)?)", True),
    ("supertrend_bullish", r"supertrend.{0,40}(?:翻多|转多|bull)", True),
    ("macd_hist_positive", r"macd.{0,80}(?:柱状图|柱线|histogram).{0,40}(?:负转正|转正|positive)", True),
)
STATES = (("EARLY_ENTRY", r"early entry|早期介入|早期阶段"), ("CONFIRMATION", r"confirmed entry|确认突破|趋势确认"), ("RISK", r"false break|假突破"))
#: Themes of a feed and words of advertising.
THEMES = {
    "Sell Put": ["sell put", "sp ", "卖put", "卖 put", "put"], "LEAPS": ["leap", "leaps", "长期期权"],
    "风险管理": ["风险", "回撤", "现金", "保险", "对冲", "止损", "爆仓", "stop loss", "mental stop", "risk management"], "失败复盘": ["认错", "失败", "亏", "割肉", "复盘", "看错", "wrong", "mistake"],
    "长期持有纪律": ["长期", "长持", "定投", "time in the market", "纪律"], "趋势确认": ["突破", "breakout", "strong close", "hold above", "technical analysis", " ta "],
    "逆向交易": ["恐慌时买", "恐慌买入", "buy when they are panic", "buy when they panic", "panic"], "止损纪律": ["止损", "stop loss", "mental stop"],
    "INTC": ["intc", "intel", "英特尔"], "IREN": ["iren"], "TSLA": ["tsla", "tesla", "特斯拉"],
}
OTHER_THEME = "其他研究"
PROMOTION = (
    "开户链接", "开户福利", "开户奖励", "入金", "转仓", "免费股票", "免费股", "现金券", "碎股礼包", "免佣", "moomoo", "webull", "tradeup", "老虎证券", "邀请链接", "粉丝专属", "新用户", "开户即享", "存入",
)
