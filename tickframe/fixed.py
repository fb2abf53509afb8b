"""Labels, codes and limits that results must carry unchanged."""

from __future__ import annotations

# Filing section codes and section ids, in consolidation order (rank 0 to 19).
TEN_K_SECTIONS = [
    ("1", "Item_1_Business"),
    ("1A", "Item_1A_Risk_Factors"),
    ("1B", "Item_1B_Unresolved_Staff_Comments"),
    ("2", "Item_2_Properties"),
    ("3", "Item_3_Legal_Proceedings"),
    ("7", "Item_7_MDandA"),
    ("7A", "Item_7A_Market_Risk"),
    ("8", "Item_8_Financial_Statements"),
]
TEN_Q_SECTIONS = [
    ("part1item1", "P1_Item_1_Financial_Statements"),
    ("part1item2", "P1_Item_2_MDandA"),
    ("part1item3", "P1_Item_3_Market_Risk"),
    ("part1item4", "P1_Item_4_Controls_and_Procedures"),
    ("part2item1", "P2_Item_1_Legal_Proceedings"),
    ("part2item1a", "P2_Item_1A_Risk_Factors"),
]
EIGHT_K_SECTIONS = [
    ("1.01", "Item_1_01_Material_Agreement"),
    ("2.01", "Item_2_01_Acquisition_or_Disposition"),
    ("2.02", "Item_2_02_Results_of_Operations"),
    ("5.02", "Item_5_02_Departure_of_Directors_Officers"),
    ("7.01", "Item_7_01_Reg_FD_Disclosure"),
    ("8.01", "Item_8_01_Other_Events"),
]
UNKNOWN_SECTION_RANK = 9999
MIN_SECTION_CHARS = 50

# Filing forms.
FORM_FAMILIES = ["10-K", "10-Q", "8-K"]
FILING_FORMS = ["10-K", "10-Q", "8-K", "10-K/A", "10-Q/A", "8-K/A"]
MIN_HEADINGS = {"10-K": 4, "10-Q": 3, "8-K": 1}
CONTENTS_DISTANCE = 5000
FULL_DOCUMENT = "Full_Document_Text"
CONTINUED = "\n\n[SECTION CONTINUED]\n\n"
FILING_YEARS = 10

# CIK resolution.
NOT_FOUND = "NOT_FOUND"
CIK_DIGITS = 10

# Liquidity tiers: (tier, minimum ADDV, minimum ADNT, maximum MTBT seconds, label).
LIQUIDITY_TIERS = [
    (1, 25_000_000.0, 5000.0, 30.0, "Keep (High)"),
    (2, 5_000_000.0, 1000.0, 300.0, "Keep (Moderate)"),
]
ILLIQUID = (3, "Remove (Illiquid)")
INSUFFICIENT = (99, "Error/Insufficient Data")
NO_DATA = "No data in lookback period"
LOOKBACK_DAYS = 730

# Integrity report.
MARKET_ZONE = "America/New_York"
SESSION_OPEN = "09:30:00"
SESSION_CLOSE = "16:00:00"
SIGNIFICANT_GAP_SECONDS = 900
HEALTHY = "Healthy"
ANOMALIES = "Anomalies Detected"
NO_RTH = "No RTH Data Found"
STATUS_RANK = {"Error": 1, "Anomalies Detected": 2, "No RTH Data Found": 3, "Healthy": 4}
UNKNOWN_STATUS_RANK = 99

# Fidelity words that stand alone.
HISTORICAL_WORDS = ["tick", "second", "minute", "hour", "day"]
TECHNICAL_WORDS = ["minute", "hour", "day", "week", "month"]

# Fan-out lists.
CORPORATE_ACTIONS = ["ipo", "splits", "dividends", "ticker_events"]
FUNDAMENTALS = ["financials", "short_interest", "short_volume"]
INDICATORS = ["sma", "ema", "macd", "rsi"]

# History files: ticker, fidelity, start, end, extension.
HISTORY_FILE = r"^(.+?)_(.+?)_(\d{4}-\d{2}-\d{2})_to_(\d{4}-\d{2}-\d{2})\.(parquet|csv)"
NEIGHBOUR_THRESHOLD_PERCENT = 20.0
DEBUG_SAMPLE_ROWS = 1000
