"""Default parameters of the pipelines. All fixed values, changed only through arguments."""

from __future__ import annotations

TOP_N = 50
EXCLUDED_INDUSTRIES = ("建材營造", "金融業", "金融保險業", "存託憑證")
LISTED_BEFORE = "2017-01-03"
LISTED_MARKET = "sii"
BENCHMARK_INDEX_IDS = ("^TWII",)
TICKER_SUFFIX = ".TW"
QUANTILES = 5
PERIODS = (1, 5, 10)
MAX_LOSS = 0.35
COMBO_SIZE = 5
COMPONENTS = (2, 4)
BUY_N = 20
SELL_N = 20
INITIAL_CASH = 20_000_000.0
INVESTED_SHARE = 0.9
COMMISSION = 0.001
NO_SIGNAL_RANK = 999999.0
FACTOR_TYPE = "fundamental_features"

# Names of the fundamental factors evaluated when none are given, in catalogue order.
FACTOR_CATALOGUE = (
    "營業利益",
    "EBITDA",
    "營運現金流",
    "歸屬母公司淨利",
    "折舊",
    "流動資產",
    "流動負債",
    "取得不動產廠房及設備",
    "經常稅後淨利",
    "ROA稅後息前",
    "ROA綜合損益",
    "ROE稅後",
    "ROE綜合損益",
    "稅前息前折舊前淨利率",
    "營業毛利率",
    "營業利益率",
    "稅前淨利率",
    "稅後淨利率",
    "業外收支營收率",
    "貝里比率",
    "營業費用率",
    "推銷費用率",
    "管理費用率",
    "研究發展費用率",
    "現金流量比率",
    "稅率",
    "每股營業額",
    "每股營業利益",
    "每股現金流量",
    "每股稅前淨利",
    "每股綜合損益",
    "每股稅後淨利",
    "總負債除總淨值",
    "負債比率",
    "淨值除資產",
    "營收成長率",
    "營業毛利成長率",
    "營業利益成長率",
    "稅前淨利成長率",
    "稅後淨利成長率",
    "經常利益成長率",
    "資產總額成長率",
    "淨值成長率",
    "流動比率",
    "速動比率",
    "利息支出率",
    "營運資金",
    "總資產週轉次數",
    "應收帳款週轉率",
    "存貨週轉率",
    "固定資產週轉次數",
    "淨值週轉率次數",
    "自由現金流量",
)
