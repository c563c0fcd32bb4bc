"""Vocabularies, codes, patterns and formats that results depend on."""

from __future__ import annotations

# Outcome ladder and the rate move, in basis points, that each rung stands for.
OUTCOMES = ["CUT50P", "CUT25", "HOLD", "HIKE25", "HIKE50P"]
MOVE_BP = {"CUT50P": -50, "CUT25": -25, "HOLD": 0, "HIKE25": 25, "HIKE50P": 50}
OTHER = "OTHER"

# Leg code of a contract -> outcome.
LEG_OUTCOME = {"C26": "CUT50P", "C25": "CUT25", "H0": "HOLD", "H25": "HIKE25", "H26": "HIKE50P"}

# Delivery month letters, January to December, and month names in event tickers.
MONTH_CODES = "FGHJKMNQUVXZ"
MONTH_NAMES = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

# Daily rate series and the column each one becomes.
RATE_SERIES = {
    "EFFR": "effr",
    "SOFR": "sofr",
    "IORB": "iorb",
    "DFEDTARU": "tgt_upper",
    "DFEDTARL": "tgt_lower",
    "DFF": "dff",
}

# Patterns of event tickers, titles, outright symbols and continuous symbols.
EVENT_TICKER = r"^(?:KX)?FEDDECISION-(\d{2})([A-Z]{3})(\d{2})?$"
EVENT_PREFIX = "KXFEDDECISION-"
DECISION_TITLE = r"^Fed [Dd]ecision in [A-Za-z]+\??$|^Fed Interest Rates:? [A-Za-z]+ \d{4}$"
OUTRIGHT_SYMBOL = r"^ZQ([FGHJKMNQUVXZ])(\d)$"
CONTINUOUS_SUFFIX = "=F"
PRODUCT = "ZQ"

# Market time zone, bar lengths in minutes, and the shift that labels a bar with the day it covers.
MARKET_ZONE = "America/New_York"
DAY_BAR, HOUR_BAR, MINUTE_BAR = 1440, 60, 1
BAR_END_SHIFT_S = 43200

# Defaults for the first decision of the calendar.
FIRST_PREV_DECISION = "2021-12-15"
FIRST_PREV_EFFECTIVE = "2021-12-16"

# Bands of the quality screens.
LADDER_BAND = (0.95, 1.10)
FAIR_PRICE_BAND = (0.90, 1.10)
SETTLEMENT_TOLERANCE_BP = 0.30

# Contract economics: dollars per basis point, contracts hedged per spread, taker fee factor.
DOLLARS_PER_BP = 41.67
DIGITALS_PER_SPREAD = 1041.75
TAKER_FEE_RATE = 0.07
TICK_NEAR, TICK_FAR = 0.0025, 0.0050

# Decision dates of the calendar.
DECISION_DATES = """
2022-01-26 2022-03-16 2022-05-04 2022-06-15 2022-07-27 2022-09-21 2022-11-02 2022-12-14
2023-02-01 2023-03-22 2023-05-03 2023-06-14 2023-07-26 2023-09-20 2023-11-01 2023-12-13
2024-01-31 2024-03-20 2024-05-01 2024-06-12 2024-07-31 2024-09-18 2024-11-07 2024-12-18
2025-01-29 2025-03-19 2025-05-07 2025-06-18 2025-07-30 2025-09-17 2025-10-29 2025-12-10
2026-01-28 2026-03-18 2026-04-29 2026-06-17 2026-07-29 2026-09-16 2026-10-28 2026-12-09
2027-01-27 2027-03-17 2027-04-28 2027-06-09 2027-07-28 2027-09-15 2027-10-27 2027-12-08
2028-01-26
""".split()
