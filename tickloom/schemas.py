"""Column types of the tables that the engine reads and writes. Optional columns are null where a source lacks them."""

from __future__ import annotations

BARS = "ticker string, date date, open double, low double, high double, close double, waprice double, value_rub double, volume double"
INDEX_BARS = "ticker string, date date, close double, volume double"
BOND_BARS = "secid string, tradedate date, close double, waprice double"
BOND_PARAMS = "secid string, facevalue double, couponpercent double, matdate date"
SHARES = "ticker string, date date, shares double"
SPLITS = "ticker string, date date, ratio double, kind string"
RENAMES = "old string, new string, date date"
KEY_RATE = "date date, rate double"
SECTORS = "ticker string, sector string"
DIVIDENDS = "ticker string, closing_date date, dividend_value double"

#: Prices that a split divides; volumes that it multiplies.
PRICES = ("close", "open", "high", "low", "waprice")
#: Trading days and months of a year; days of a calendar year.
DAYS, MONTHS, YEAR_DAYS = 252, 12, 365.25
