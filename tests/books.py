"""Trade books for the surveillance tests: regular trading by rule, and trades that break it.

Prices swing by a sine around each commodity's level, sizes follow a triangular draw, deals run 2, 6 or 10 hours.
"""

import datetime as dt
import math
import random

SCHEMA = ("trade_id string, trader_id string, counterparty string, commodity string, buy_sell string, "
          "volume_mw double, price_eur_mwh double, delivery_start timestamp, delivery_end timestamp, created_at timestamp")
OPENED = dt.datetime(2025, 3, 3, 8)
LEVELS = {"POWER": 61.0, "NATURAL_GAS": 29.0}


def rows(n, seed, first=10_000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        commodity = rnd.choice(sorted(LEVELS))
        price = LEVELS[commodity] * (1 + 0.09 * math.sin(rnd.uniform(0, 2 * math.pi)))
        begin = OPENED + dt.timedelta(hours=12 * rnd.randrange(40))
        out.append((f"TRD-{first + i}", f"desk{rnd.randrange(8)}", f"Utility {rnd.choice('ABCDE')}", commodity, rnd.choice(("SELL", "BUY")),
                    round(rnd.triangular(4, 60, 18), 1), round(price, 3), begin, begin + dt.timedelta(hours=rnd.choice((2, 6, 10))), OPENED))
    return out


def odd(kind, number):
    """One trade that departs from the book in one respect."""
    base = rows(1, 0, number)[0]
    change = {
        "price up": {"price_eur_mwh": 17 * LEVELS[base[3]]},
        "price down": {"price_eur_mwh": LEVELS[base[3]] / 40},
        "size": {"volume_mw": 3300.0},
        "length": {"delivery_end": base[7] + dt.timedelta(hours=700)},
        "party": {"counterparty": "Unheard of", "trader_id": "desk99"},
    }[kind]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return tuple(change.get(name, value) for name, value in zip(names, base, strict=True))


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)
