"""Business constants of the report.  All are fixed values."""

# LEI of the reporting party; it stands for "us" in every party field.
OWN_LEI = "BSGEFEIOM18Y80CKCV46"

# Lender whose swaps with a positive rate are sold.
LENDING_DESK = "LE_NBCGFLTD"

# Notional list: separator, truncation mark, size limit in bytes.
LIST_SEPARATOR = ","
LIST_ELLIPSIS = "..."
LIST_CAP = 4000

# Schedule flows that carry a reportable notional.
NOTIONAL_FLOW = {"FIXVAR": "F1", "FIXVAR1": "F", "AMORTFLAG": "Y", "EQDSIDE": "N"}
NOTIONAL_HORIZON_MONTHS = 60

# Schedule steps that decide the payment frequency.
FIRST_STEP = 1
LAST_STEP = 17
DAILY_GAP_DAYS = 3

# Width of an amount field: 26 integer digits, the point, 12 decimals.
AMOUNT_INTEGER_DIGITS = 26
AMOUNT_DECIMALS = 12
AMOUNT_WIDTH = 39

# Longest tenor, in years, of a clearable overnight swap.
CLEARABLE_YEARS = 10
