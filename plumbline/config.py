"""Vocabularies and thresholds shared by every check and fix."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Results depend on these exact words and patterns.
# ---------------------------------------------------------------------------

# Whole cells that mean "missing". Case matters.
PLACEHOLDERS = (
    "n.d.", "NULL", "unknown", "?", "//", "-", "null", "N/A", "undefined", "ND", "", " ", "nan",
)

# Markers that should no longer be in a cleaned categorical column. Case matters.
INVALID_MARKERS = ("Unknown", "n.d.", "N/A", "?", "//", "-", "ND")

# Placeholder words compared after lower-casing and trimming.
PLACEHOLDER_WORDS = (
    "unknown", "n.d.", "nd", "tbd", "n/a", "na", "null", "none",
    "da verificare", "da definire", "imposta x", "altro",
)

BOOLEAN_WORDS = ("true", "false", "yes", "no", "1", "0", "t", "f", "y", "n")

# Currency and unit marks removed literally before a numeric parse.
CURRENCY_MARKS = ("€", "EUR", "\ufffd", "$", "£", "¥", "%")

# A negative value in a column whose name holds one of these is a HIGH priority finding.
AMOUNT_KEYWORDS = (
    "amount", "total", "count", "qty", "quantity", "price", "cost",
    "revenue", "value", "salary", "wage", "payment", "fee", "tax",
    "income", "expense", "balance", "sum", "rate",
    "montant", "cout", "revenu", "prix", "salaire",
    "betrag", "kosten", "preis", "gehalt",
    "cantidad", "costo", "ingreso", "precio",
)

# Words in a column name that suggest a calendar year.
YEAR_WORDS = ("anno", "year", "yr", "jahr", "année")

# Name parts that mark a key column (documented variant of near-duplicate detection).
KEY_NAME_PARTS = ("id", "cod", "code", "key", "codice")

# Cells a CSV reader turns into null (the pandas default list).
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Ordered: the first matching picture names the format of a cell. In a picture 9 is any digit, A any capital,
# every other character itself; a final * lets anything follow.
DATE_SHAPES = (
    ("ISO-8601 datetime", "9999-99-99T*"),
    ("YYYY-MM-DD", "9999-99-99"),
    ("YYYY/MM/DD", "9999/99/99"),
    ("DD/MM/YYYY", "99/99/9999"),
    ("DD.MM.YYYY", "99.99.9999"),
    ("DD-MM-YY", "99-99-99"),
    ("YYYYMM", "999999"),
    ("YYYY-MM", "9999-99"),
    ("MM/YYYY", "99/9999"),
    ("MON-YYYY", "AAA-9999"),
)

# Alternate, shorter format list. The first picture lets anything follow, so it also takes datetimes.
DATE_SHAPES_ALTERNATE = (
    ("ISO-8601 (YYYY-MM-DD)", "9999-99-99*"),
    ("ISO-8601 datetime", "9999-99-99T99*"),
    ("DD/MM/YYYY", "99/99/9999"),
    ("DD-MM-YY", "99-99-99"),
    ("YYYY/MM/DD", "9999/99/99"),
    ("DD.MM.YYYY", "99.99.9999"),
)

# Month abbreviations, Italian and English, in calendar order.
ITALIAN_MONTHS = ("GEN", "FEB", "MAR", "APR", "MAG", "GIU", "LUG", "AGO", "SET", "OTT", "NOV", "DIC")
ENGLISH_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

ITALIAN_MONTH_NAMES = (
    "GENNAIO", "FEBBRAIO", "MARZO", "APRILE", "MAGGIO", "GIUGNO", "LUGLIO", "AGOSTO", "SETTEMBRE", "OTTOBRE", "NOVEMBRE", "DICEMBRE",
)
ENGLISH_MONTH_NAMES = (
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
)

# Fix actions an enrichment row may ask for; anything else is discarded.
ENRICHMENT_ACTIONS = ("round_Ndp", "coerce_int", "coerce_year")


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of every check. Variants of a check differ by these values only."""

    numeric_ratio: float = 0.9
    date_ratio: float = 0.7
    date_policy: str = "dominant"  # "dominant": share of the commonest format; "any": any known format
    identifier_ratio: float = 0.95
    identifier_min_distinct: int = 10
    boolean_max_distinct: int = 3
    categorical_ratio: float = 0.05
    high_missing_pct: float = 20.0
    ultra_sparse: float = 0.95
    sparse: float = 0.5
    duplicate_jaccard: float = 0.8
    duplicate_correlation: float = 0.85
    redundant_overlap: float = 0.85
    variant_max_distinct: int = 30
    code_min_distinct: int = 2
    code_max_distinct: int = 15
    label_max_distinct: int = 20
    label_numeric_ratio: float = 0.5
    pair_min_rows: int = 5
    negative_min_values: int = 5
    outlier_min_values: int = 10
    iqr_factor: float = 1.5
    z_limit: float = 3.0
    rare_share: float = 0.005
    rare_max_distinct: int = 50
    key_min_ratio: float = 0.05
    key_max_ratio: float = 0.95
    key_max_length: float = 30.0
    key_columns: int = 4
    examples: int = 5
    # Bounds that steer the physical strategy, never the result.
    quantile_buckets: int = 4096  # ranges a quantile pass cuts a column's values into
    quantile_rows: int = 20_000  # a range of at most this many rows is cut into its distinct values
    text_values: int = 10_000  # columns of about more distinct values are counted by digests, not as text
    counted_values: int = 100_000  # columns of about at most so many values are read value by value
    domain_slack: int = 10  # a column whose estimated distinct count exceeds cap*slack leaves domain checks


DEFAULTS = Thresholds()
