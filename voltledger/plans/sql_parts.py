"""Common table expressions shared by the comparison SQL."""

RAW = """raw AS (
  SELECT 'TRD-' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), greatest(8, length(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)))::INT, '0') AS trade_id,
         'TRADER-' || CAST(101 + l_suppkey % 10 AS VARCHAR) AS trader_id,
         replace(c_name, '#', '_') AS counterparty,
         CASE WHEN l_partkey % 2 = 0 THEN 'POWER' ELSE 'NATURAL_GAS' END AS commodity,
         CASE WHEN l_linestatus = 'O' THEN 'BUY' ELSE 'SELL' END AS buy_sell,
         CAST(l_quantity AS DECIMAL(18,2)) AS volume_mw,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / 1000 AS DECIMAL(18,5)) AS price_eur_mwh,
         l_shipdate AS delivery_start,
         l_shipdate + to_hours(CAST([1, 4, 12, 24][l_linenumber % 4 + 1] AS INTEGER)) AS delivery_end,
         o_orderdate AS created_at,
         l_partkey, l_suppkey, l_discount, l_tax, l_returnflag, o_orderstatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

SURVIVOR = ("created_at, delivery_start, l_partkey, l_suppkey, price_eur_mwh, volume_mw, buy_sell, "
            "l_discount, l_tax, l_returnflag")

SILVER = f"""{RAW},
silver AS (
  SELECT trade_id, trader_id, counterparty, commodity, buy_sell, volume_mw, price_eur_mwh,
         delivery_start, delivery_end, created_at
  FROM raw QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY {SURVIVOR}) = 1)"""

LATEST = """latest AS (
  SELECT 'POWER' AS commodity, CAST(value AS DECIMAL(18,2)) AS latest_market_price, ts AS market_price_as_of
  FROM events ORDER BY ts DESC, value LIMIT 1)"""

PNL = f"""{SILVER},
{LATEST},
priced AS (
  SELECT s.*, CAST(coalesce(l.latest_market_price,
           CASE WHEN s.commodity = 'NATURAL_GAS' THEN 42.50 ELSE 85.00 END) AS DECIMAL(18,5)) AS market
  FROM silver s LEFT JOIN latest l ON s.commodity = l.commodity),
pnl AS (
  SELECT trade_id, trader_id, counterparty, commodity, buy_sell, volume_mw, price_eur_mwh, created_at, market,
         CAST(round(volume_mw * price_eur_mwh, 2) AS DECIMAL(18,2)) AS notional,
         CAST(round(volume_mw * market, 2) AS DECIMAL(18,2)) AS mtm,
         CAST(round(CASE buy_sell WHEN 'BUY' THEN volume_mw * (market - price_eur_mwh)
                                  WHEN 'SELL' THEN volume_mw * (price_eur_mwh - market)
                                  ELSE 0 END, 2) AS DECIMAL(18,2)) AS pnl
  FROM priced)"""

RISK = f"""{PNL},
risk AS (
  SELECT counterparty, commodity, count(trade_id) AS trade_count,
         CAST(sum(volume_mw) AS DOUBLE) AS total_volume_mw,
         CAST(sum(notional) AS DOUBLE) AS total_notional_eur,
         CAST(sum(mtm) AS DOUBLE) AS total_mtm_eur,
         CAST(sum(pnl) AS DOUBLE) AS net_unrealized_pnl_eur
  FROM pnl GROUP BY counterparty, commodity)"""

PORTFOLIO = f"""{PNL},
portfolio AS (
  SELECT commodity, count(trade_id) AS total_trades,
         CAST(sum(volume_mw) AS DOUBLE) AS net_volume_mw,
         CAST(sum(notional) AS DOUBLE) AS portfolio_notional_eur,
         CAST(sum(pnl) AS DOUBLE) AS total_portfolio_pnl_eur
  FROM pnl GROUP BY commodity)"""

FEATURE_NAMES = (
    "volume_mw", "price_eur_mwh", "notional_value_eur", "price_deviation_pct", "abs_price_deviation_pct",
    "delivery_hours", "counterparty_trade_share", "trader_trade_share", "is_off_market",
)


def features(base: str = SILVER, source: str = "silver", name: str = "feats", reference: str | None = None) -> str:
    """CTEs ending in the nine features (double) plus the trade's own columns prefixed with t_."""
    reference = reference or "coalesce(nullif(m.median_price, 0), CASE b.commodity WHEN 'NATURAL_GAS' THEN 42.5 ELSE 85.0 END)"
    return f"""{base},
{name}_base AS (SELECT *, CAST(volume_mw AS DOUBLE) AS v, CAST(price_eur_mwh AS DOUBLE) AS p FROM {source}),
{name}_med AS (SELECT commodity, median(p) AS median_price FROM {name}_base GROUP BY commodity),
{name}_cp AS (SELECT counterparty, count(*) AS n, (SELECT count(DISTINCT counterparty) FROM {name}_base) AS k FROM {name}_base GROUP BY counterparty),
{name}_tr AS (SELECT trader_id, count(*) AS n, (SELECT count(DISTINCT trader_id) FROM {name}_base) AS k FROM {name}_base GROUP BY trader_id),
{name}_ref AS (
  SELECT b.*, {reference} AS ref, (cp.n / t.total) / (1.0 / cp.k) AS cp_share, (tr.n / t.total) / (1.0 / tr.k) AS tr_share
  FROM {name}_base b LEFT JOIN {name}_med m ON b.commodity = m.commodity
  LEFT JOIN {name}_cp cp ON b.counterparty = cp.counterparty LEFT JOIN {name}_tr tr ON b.trader_id = tr.trader_id
  CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS total FROM {name}_base) t),
{name} AS (
  SELECT trade_id, counterparty AS t_counterparty, commodity AS t_commodity, buy_sell AS t_buy_sell,
         v AS volume_mw, p AS price_eur_mwh, v * p AS notional_value_eur,
         (p - ref) / abs(ref) * 100.0 AS price_deviation_pct,
         abs((p - ref) / abs(ref) * 100.0) AS abs_price_deviation_pct,
         (epoch_us(delivery_end) - epoch_us(delivery_start)) / 3.6e9 AS delivery_hours,
         cp_share AS counterparty_trade_share, tr_share AS trader_trade_share,
         CASE WHEN abs((p - ref) / abs(ref) * 100.0) > 30.0 THEN 1.0 ELSE 0.0 END AS is_off_market
  FROM {name}_ref)"""


def baseline(source: str = "feats", name: str = "base") -> str:
    """CTE (feature, mean, std, median)."""
    parts = "\n  UNION ALL ".join(
        f"SELECT '{f}' AS feature, {i} AS ord, avg(CAST({f} AS DOUBLE)) AS mean, coalesce(stddev_samp(CAST({f} AS DOUBLE)), 0.0) AS std, "
        f"CAST(median({f}) AS DOUBLE) AS median FROM {source}" for i, f in enumerate(FEATURE_NAMES)
    )
    return f"{name} AS (\n  {parts})"


EFFECTIVE_STD = "greatest(std, abs(mean) * 0.05, 0.000001)"


def sigma(value: str, mean: str = "mean", std: str = "std") -> str:
    return f"least(abs({value} - {mean}) / greatest({std}, abs({mean}) * 0.05, 0.000001), 99.0)"


def reasons(source: str = "feats", base: str = "base", name: str = "reasons") -> str:
    """CTE (trade_id, top_reason)."""
    long = "\n  UNION ALL ".join(
        f"SELECT trade_id, {i} AS ord, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source}"
        for i, f in enumerate(FEATURE_NAMES)
    )
    return f"""{name}_long AS (
  {long}),
{name}_shift AS (
  SELECT l.trade_id, l.ord, l.feature, l.value, b.mean, b.std, {sigma('l.value', 'b.mean', 'b.std')} AS shift
  FROM {name}_long l JOIN {base} b ON l.feature = b.feature),
{name} AS (
  SELECT trade_id,
         CASE WHEN shift <= 0 THEN 'n/a'
              WHEN std <= 0.000001 THEN printf('%s = %s, a value never seen in normal trading (constant %s during training)',
                   feature, printf('%g', value), printf('%g', mean))
              ELSE printf('%s is %.1f sigma from normal', feature, shift) END AS top_reason
  FROM {name}_shift QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY shift DESC, ord) = 1)"""


SCORED = f"""{features()},
{baseline()},
{reasons()},
sig AS (SELECT f.*, {sigma('f.price_deviation_pct', 'b.mean', 'b.std')} AS s
        FROM feats f CROSS JOIN (SELECT * FROM base WHERE feature = 'price_deviation_pct') b),
ends AS (SELECT min(s) AS lo, max(s) AS hi FROM sig),
risked AS (SELECT sig.*, CASE WHEN hi > lo THEN (s - lo) / (hi - lo) ELSE 0.0 END AS risk FROM sig CROSS JOIN ends),
scored AS (
  SELECT r.trade_id, t_counterparty AS counterparty, t_commodity AS commodity, t_buy_sell AS buy_sell,
         volume_mw, price_eur_mwh, round(risk, 4) AS anomaly_score, s > 1.6 AS is_anomaly,
         CASE WHEN risk >= 0.75 THEN 'CRITICAL' WHEN risk >= 0.55 THEN 'HIGH' WHEN risk >= 0.35 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band,
         q.top_reason
  FROM risked r JOIN reasons q ON r.trade_id = q.trade_id)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
