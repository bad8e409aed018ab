"""Business constants of the trade and price contracts.

Fixed values: limits, thresholds, word lists and levels that results depend on.
"""

# Hard price range (EUR/MWh, inclusive) and the plausible band used for flags only.
PRICE_MIN = -500.0
PRICE_MAX = 4000.0
PRICE_PLAUSIBLE_MIN = -50.0
PRICE_PLAUSIBLE_MAX = 1000.0

# Volume of one trade: 0 < v <= 10 000 MW.
VOLUME_MIN = 0.0
VOLUME_MAX = 10_000.0

# Epoch milliseconds of 2000-01-01 and 2100-01-01 (both exclusive).
EPOCH_MS_MIN = 946_684_800_000
EPOCH_MS_MAX = 4_102_444_800_000

COMMODITIES = ("POWER", "NATURAL_GAS")
DIRECTIONS = ("BUY", "SELL")
TRADE_ID_PATTERN = r"^TRD-\d{5}$"
COUNTERPARTY_LENGTH = (2, 50)

# Batch verdict.
MAX_FAILURE_RATIO = 0.20

# Robust outliers.
OUTLIER_Z = 5.0
MAD_TO_SIGMA = 1.4826
OUTLIER_MIN_ROWS = 10

# Valuation benchmarks: used when no market price exists for a commodity.
GAS_BENCHMARK = 42.50
POWER_BENCHMARK = 85.00

# Reference price levels of last resort for the surveillance features.
DEFAULT_MARKET_LEVEL = {"POWER": 85.0, "NATURAL_GAS": 42.5}
OFF_MARKET_PCT = 30.0

FEATURES = (
    "volume_mw",
    "price_eur_mwh",
    "notional_value_eur",
    "price_deviation_pct",
    "abs_price_deviation_pct",
    "delivery_hours",
    "counterparty_trade_share",
    "trader_trade_share",
    "is_off_market",
)

# Surveillance model.
TREES = 200
TREE_SAMPLE = 256
SEED = 42
CONTAMINATION = 0.02
MIN_TRAINING_ROWS = 20

# Drift and explanations.
DRIFT_SIGMA = 2.0
STD_FLOOR_FRACTION = 0.05
STD_FLOOR = 1e-6
SIGMA_CAP = 99.0
RISK_BANDS = ((0.75, "CRITICAL"), (0.55, "HIGH"), (0.35, "MEDIUM"))
LOWEST_BAND = "LOW"

# Content scans.
SCAN_MAX_DEPTH = 20
IDENTIFIER_COLUMNS = ("trade_id", "trader_id", "counterparty", "commodity", "buy_sell")

# Serving.
GOLD_DATASETS = ("trades_pnl", "counterparty_risk", "portfolio_summary", "trade_surveillance")
MAX_ROWS = 500
MAX_EXPOSURE_ROWS = 100
MAX_SUSPICIOUS_ROWS = 200

# Fixed texts: the sentences in which gates report their findings.
FINDING_CHECK = "check '%s' failed %dx (examples: %s)"
FINDING_RATIO = "failure ratio %.1f%% exceeds the %.0f%% limit -> batch rejected (possible compromised source)"
FINDING_OUTLIERS = ("%d statistical outlier(s) in '%s' (robust z > %s; worst value %,.2f, median %,.2f)"
                    " - possible data poisoning, review before trusting")
FINDING_BAND = ("%d price(s) outside the plausible band [%s, %s] EUR/MWh"
                " - check the source unit (a x1000 unit error looks exactly like this)")
FINDING_REPLAY = "%d duplicate %s(s) - possible replay injection"
