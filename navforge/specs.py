"""Declarative dataset specifications.

One ``DatasetSpec`` per raw dataset describes everything the silver layer needs:
the bronze column list (all text), how each column is renamed after trimming,
which columns are parsed into dates or decimals, the uniqueness key, the
references to other datasets and the ordered list of data-quality rules.  The
generic operators in :mod:`navforge.operators.quality` turn a spec into a Spark
plan; nothing here touches Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Allowed category values and rule codes.  These must equal the
# values of the pipeline whose results we reproduce; they are listed plainly.
# ---------------------------------------------------------------------------
CURRENCIES = ("EUR", "USD", "SEK")
FUND_TYPES = ("Equity", "Bond", "Mixed")
FUND_STATUSES = ("Active", "Closed")
DOMICILES = ("LU", "IE")
RISK_LEVELS = ("Low", "Medium", "High")
COUNTRIES = ("LU", "DE", "FR", "NL", "BE", "CH", "AT", "SE", "DK", "FI", "IE", "ES", "IT", "PL")
INVESTOR_STATUSES = ("Active", "Inactive")
INVESTOR_TYPES = ("Institutional", "Pension Fund", "Asset Manager", "Insurance", "Family Office")
TRANSACTION_TYPES = ("Subscription", "Redemption", "Switch", "Dividend")
ASSET_CLASSES = ("Equity", "Bond", "Cash", "ETF", "Alternative")

DATE_FORMAT = "yyyy-MM-dd"
# Own addition: raw lines with too many or too few cells, and the column of their text.
MALFORMED_LINE = "MALFORMED_LINE"
RAW_LINE = "raw_line"
API_VERSION = "v1"

# Health thresholds on dq_score (inclusive lower bounds), best first.
HEALTH_THRESHOLDS = ((99, "Healthy"), (95, "Warning"))
HEALTH_FALLBACK = "Critical"


# ---------------------------------------------------------------------------
# Dimensions of the reporting tables
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Dimension:
    """Attributes that a dataset adds to facts which carry its id as ``fact_key``."""

    fact_key: str
    attributes: dict[str, str]  # dataset column -> published column


DIMENSIONS = {
    "funds": Dimension("fund_id", {"name": "fund_name", "type": "fund_type",
                                   "manager": "manager"}),
    "investors": Dimension("investor_id", {
        "name": "investor_name", "country": "country", "risk_profile": "risk_profile",
        "investor_type": "investor_type"}),
}


# ---------------------------------------------------------------------------
# Rule kinds
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Allowed:
    """Value must be in ``values``; NULL passes (three-valued NOT IN)."""

    column: str
    values: tuple[str, ...]
    code: str


@dataclass(frozen=True)
class Required:
    """Value must be neither NULL nor the empty string."""

    column: str
    code: str


@dataclass(frozen=True)
class Parsed:
    """The parsed form of a raw column must not be NULL."""

    column: str
    code: str


@dataclass(frozen=True)
class Bound:
    """Fires when ``column <op> value`` holds (``op`` is ``'<='`` or ``'<'``)."""

    column: str
    op: str
    value: int
    code: str


@dataclass(frozen=True)
class Unique:
    """Fires when the key's occurrence count (``count_column``) exceeds 1."""

    count_column: str
    code: str


@dataclass(frozen=True)
class Known:
    """Fires when the reference lookup column is NULL (no valid match)."""

    ref_column: str
    code: str


Rule = Allowed | Required | Parsed | Bound | Unique | Known


@dataclass(frozen=True)
class DateField:
    raw: str  # trimmed text column
    parsed: str  # timestamp from try_to_timestamp
    out: str  # published date column


@dataclass(frozen=True)
class DecimalField:
    raw: str
    out: str
    precision: int
    scale: int
    decimal_comma: bool = False  # accept ',' as the decimal separator


@dataclass(frozen=True)
class Reference:
    column: str  # column of this dataset
    dataset: str  # referenced dataset (its silver ``id`` column)
    out: str  # lookup column name published in quarantine


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    bronze_columns: tuple[str, ...]
    rename: dict[str, str]
    dates: tuple[DateField, ...]
    decimals: tuple[DecimalField, ...] = ()
    key: tuple[str, ...] = ()
    count_column: str | None = None
    references: tuple[Reference, ...] = ()
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    @property
    def trimmed_columns(self) -> list[str]:
        return [self.rename.get(c, c) for c in self.bronze_columns]

    @property
    def helper_columns(self) -> list[str]:
        cols = [d.raw for d in self.dates] + [d.parsed for d in self.dates]
        cols += [d.raw for d in self.decimals]
        if self.count_column:
            cols.append(self.count_column)
        cols += [r.out for r in self.references]
        return cols


FUNDS = DatasetSpec(
    name="funds",
    bronze_columns=("fund_id", "fund_name", "fund_type", "base_currency", "inception_date",
                    "status", "domicile", "fund_manager", "risk_level"),
    rename={"fund_id": "id", "fund_name": "name", "fund_type": "type", "base_currency": "currency",
            "inception_date": "inception_date_raw", "fund_manager": "manager"},
    dates=(DateField("inception_date_raw", "parsed_inception_date", "inception_date"),),
    rules=(
        Allowed("type", FUND_TYPES, "INVALID_FUND_TYPE"),
        Allowed("currency", CURRENCIES, "INVALID_CURRENCY"),
        Parsed("parsed_inception_date", "INVALID_INCEPTION_DATE"),
        Allowed("status", FUND_STATUSES, "INVALID_STATUS"),
        Allowed("domicile", DOMICILES, "INVALID_DOMICILE"),
        Allowed("risk_level", RISK_LEVELS, "INVALID_RISK_LEVEL"),
    ),
)

INVESTORS = DatasetSpec(
    name="investors",
    bronze_columns=("investor_id", "investor_name", "country", "risk_profile", "onboarding_date",
                    "status", "investor_type"),
    rename={"investor_id": "id", "investor_name": "name", "onboarding_date": "onboarding_date_raw"},
    dates=(DateField("onboarding_date_raw", "parsed_onboarding_date", "onboarding_date"),),
    key=("id",),
    count_column="id_count",
    rules=(
        Required("id", "MISSING_INVESTOR_ID"),
        Required("name", "MISSING_INVESTOR_NAME"),
        Allowed("country", COUNTRIES, "INVALID_COUNTRY"),
        Allowed("risk_profile", RISK_LEVELS, "INVALID_RISK_PROFILE"),
        Parsed("parsed_onboarding_date", "INVALID_ONBOARDING_DATE"),
        Allowed("status", INVESTOR_STATUSES, "INVALID_STATUS"),
        Allowed("investor_type", INVESTOR_TYPES, "INVALID_INVESTOR_TYPE"),
        Unique("id_count", "DUPLICATE_INVESTOR_ID"),
    ),
)

TRANSACTIONS = DatasetSpec(
    name="transactions",
    bronze_columns=("transaction_id", "fund_id", "investor_id", "transaction_date",
                    "transaction_type", "amount", "currency"),
    rename={"transaction_id": "id", "transaction_date": "transaction_date_raw", "amount": "amount_raw"},
    dates=(DateField("transaction_date_raw", "parsed_transaction_date", "transaction_date"),),
    decimals=(DecimalField("amount_raw", "amount", 18, 2),),
    key=("id",),
    count_column="id_count",
    references=(Reference("fund_id", "funds", "valid_fund_id"),
                Reference("investor_id", "investors", "valid_investor_id")),
    rules=(
        Required("id", "MISSING_TRANSACTION_ID"),
        Unique("id_count", "DUPLICATE_TRANSACTION_ID"),
        Required("fund_id", "MISSING_FUND_ID"),
        Required("investor_id", "MISSING_INVESTOR_ID"),
        Known("valid_fund_id", "UNKNOWN_FUND_ID"),
        Known("valid_investor_id", "UNKNOWN_INVESTOR_ID"),
        Parsed("parsed_transaction_date", "INVALID_TRANSACTION_DATE"),
        Allowed("transaction_type", TRANSACTION_TYPES, "INVALID_TRANSACTION_TYPE"),
        Parsed("amount", "INVALID_AMOUNT"),
        Bound("amount", "<=", 0, "NON_POSITIVE_AMOUNT"),
        Allowed("currency", CURRENCIES, "INVALID_CURRENCY"),
    ),
)

POSITIONS = DatasetSpec(
    name="positions",
    bronze_columns=("position_id", "fund_id", "investor_id", "valuation_date", "asset_class",
                    "units", "market_value", "currency"),
    rename={"position_id": "id", "valuation_date": "valuation_date_raw", "units": "units_raw",
            "market_value": "market_value_raw"},
    dates=(DateField("valuation_date_raw", "parsed_valuation_date", "valuation_date"),),
    decimals=(DecimalField("units_raw", "units", 18, 4, decimal_comma=True),
              DecimalField("market_value_raw", "market_value", 18, 2, decimal_comma=True)),
    key=("id",),
    count_column="id_count",
    references=(Reference("fund_id", "funds", "valid_fund_id"),
                Reference("investor_id", "investors", "valid_investor_id")),
    rules=(
        Required("id", "MISSING_POSITION_ID"),
        Unique("id_count", "DUPLICATE_POSITION_ID"),
        Required("fund_id", "MISSING_FUND_ID"),
        Required("investor_id", "MISSING_INVESTOR_ID"),
        Known("valid_fund_id", "UNKNOWN_FUND_ID"),
        Known("valid_investor_id", "UNKNOWN_INVESTOR_ID"),
        Parsed("parsed_valuation_date", "INVALID_VALUATION_DATE"),
        Allowed("asset_class", ASSET_CLASSES, "INVALID_ASSET_CLASS"),
        Parsed("units", "INVALID_UNITS"),
        Bound("units", "<=", 0, "NON_POSITIVE_UNITS"),
        Parsed("market_value", "INVALID_MARKET_VALUE"),
        Bound("market_value", "<", 0, "NEGATIVE_MARKET_VALUE"),
        Allowed("currency", CURRENCIES, "INVALID_CURRENCY"),
    ),
)

MARKET_PRICES = DatasetSpec(
    name="market_prices",
    bronze_columns=("asset_id", "fund_id", "price_date", "close_price", "currency"),
    rename={"price_date": "price_date_raw", "close_price": "close_price_raw"},
    dates=(DateField("price_date_raw", "parsed_price_date", "price_date"),),
    decimals=(DecimalField("close_price_raw", "close_price", 18, 4),),
    key=("asset_id", "fund_id", "price_date_raw"),
    count_column="key_count",
    references=(Reference("fund_id", "funds", "valid_fund_id"),),
    rules=(
        Required("asset_id", "MISSING_ASSET_ID"),
        Required("fund_id", "MISSING_FUND_ID"),
        Known("valid_fund_id", "UNKNOWN_FUND_ID"),
        Parsed("parsed_price_date", "INVALID_PRICE_DATE"),
        Parsed("close_price", "INVALID_CLOSE_PRICE"),
        Bound("close_price", "<=", 0, "NON_POSITIVE_CLOSE_PRICE"),
        Allowed("currency", CURRENCIES, "INVALID_CURRENCY"),
        Unique("key_count", "DUPLICATE_MARKET_PRICE_KEY"),
    ),
)

# Build order matters: funds and investors are references of the others.
DATASETS: dict[str, DatasetSpec] = {
    s.name: s for s in (FUNDS, INVESTORS, TRANSACTIONS, POSITIONS, MARKET_PRICES)
}
