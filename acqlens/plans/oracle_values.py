"""Lists, weights, dates and edges of the oracle, written out on purpose: the
oracle shares no value with the code that it checks."""

from __future__ import annotations

import datetime as _dt

# Base lines in chart order, and those shown with flipped sign.
BASE_LINES = [
    "STORAGE INCOME", "SALES", "COST OF SALES", "MISCELLANEOUS INCOME", "U-BOX STORAGE INCOME",
    "U-BOX OTHER INCOME", "U-BOX DELIVERY INCOME", "U-MOVE NET COMMISSION", "INTERCOMPANY RENT",
    "THIRD PARTY LEASE", "PERSONNEL", "REPAIRS AND MAINTENANCE/GENERAL", "UTILITIES", "TELEPHONE",
    "ADVERTISING", "SUPPLIES", "RENT-EQUIPMENT/LAND AND BLDGS", "LIABILITY INSURANCE", "PROPERTY TAX",
    "BAD DEBT EXPENSE", "OTHER OPERATING EXPENSE",
]
INCOME_LINES = [
    "STORAGE INCOME", "SALES", "MISCELLANEOUS INCOME", "U-BOX STORAGE INCOME", "U-BOX OTHER INCOME",
    "U-BOX DELIVERY INCOME", "U-MOVE NET COMMISSION", "INTERCOMPANY RENT", "THIRD PARTY LEASE",
]
INCOME_SLOTS = [0, 1, 3, 4, 5, 6, 7, 8, 9]
NOT_REPORTED = "NOT USED FOR LENDER REPORTING"
# Presentation lines in order, and the parts of the totals.
STATEMENT_LINES = [
    "STORAGE INCOME", "SALES", "COST OF SALES", "NET SALES", "MISCELLANEOUS INCOME", "U-BOX INCOME",
    "U-BOX DELIVERY INCOME", "U-MOVE NET COMMISSION", "INTERCOMPANY RENT", "THIRD PARTY LEASE",
    "TOTAL REVENUE", "PERSONNEL", "REPAIRS AND MAINTENANCE/GENERAL", "UTILITIES", "TELEPHONE",
    "ADVERTISING", "SUPPLIES", "RENT-EQUIPMENT/LAND AND BLDGS", "LIABILITY INSURANCE", "PROPERTY TAX",
    "BAD DEBT EXPENSE", "OTHER OPERATING EXPENSE", "TOTAL OPERATING EXPENSE", "NET OPERATING INCOME",
]
UBOX_PARTS = ["U-BOX STORAGE INCOME", "U-BOX OTHER INCOME", "U-BOX DELIVERY INCOME"]
REVENUE_PARTS = [
    "STORAGE INCOME", "NET SALES", "MISCELLANEOUS INCOME", "U-BOX INCOME", "U-MOVE NET COMMISSION",
    "INTERCOMPANY RENT", "THIRD PARTY LEASE",
]
EXPENSE_PARTS = [
    "PERSONNEL", "REPAIRS AND MAINTENANCE/GENERAL", "UTILITIES", "TELEPHONE", "ADVERTISING", "SUPPLIES",
    "RENT-EQUIPMENT/LAND AND BLDGS", "LIABILITY INSURANCE", "PROPERTY TAX", "BAD DEBT EXPENSE",
    "OTHER OPERATING EXPENSE",
]
# Lower edges of the occupancy buckets, upper edges as the report has them.
BUCKET_LOWER = ["0.775", "0.80", "0.825", "0.85", "0.875", "0.90", "0.925", "0.95", "0.975"]
LITERAL_UPPER = ["0.7749", "0.7999", "0.8249", "0.8499", "0.8749", "0.8999", "0.9249", "0.9499", "0.9749", "1.0"]
CAPPED = ["month", "month_ly", "ttm_ly"]
# First and last month of each period, for the anchor 2000-09-01.
PERIODS = [
    ("month", "2000-09-01", "2000-09-01"), ("quarter", "2000-07-01", "2000-09-01"),
    ("ttm", "1999-10-01", "2000-09-01"), ("month_ly", "1999-09-01", "1999-09-01"),
    ("quarter_ly", "1999-07-01", "1999-09-01"), ("ttm_ly", "1998-10-01", "1999-09-01"),
]
SAMESTORE_EXCLUDE = ["7000000003", "7000000005", "7000000007"]

# The bindings' constants and the dates of the registered queries.
AS_OF = _dt.date(2000, 10, 15)
LAST_MONTH = "2000-09-01"
FY_LAST, FY_CUR = 2000, 2001
OLD_AS_OF = _dt.date(1999, 10, 15)
OLD_FY_LAST = 1999
BASE_FY, BASE_Q = 1995, 4
CENTRE_BASE, ACCOUNT_BASE = 7000000000, 40000
ACCOUNT_SLOTS, LENDER_ACCOUNTS, ENTITY_PER_CUSTOMER = 25, 50, 15
MIN_ACTUAL = "1995-01-01"
EXTRA_LINE = "MANAGEMENT FEE"  # required by a check, on no account
LENDER_WATERMARK = "2000-03-01"
LENDER_STORED_UNTIL = "2000-06-01"
LIST_AS_OF = "1999-06-30"
MOVEIN_CY = ("1998-03-08", "1998-03-17")
MOVEIN_LY = ("1997-03-08", "1997-03-19")
