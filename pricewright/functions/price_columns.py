"""Wide price lists carry the price model and the quantity bucket in the column name.

Column names are known when the plan is built, so they are parsed once on the driver
and the result enters the plan as literals. ``bucket_*`` and ``price_model`` are the
same rules as expressions, for tables that already hold the name in a column.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

OPEN_END = 99999999

# Columns of the wide list that are not prices.
ID_COLUMNS = [
    "src_updt_dt",
    "Model No",
    "Description",
    "Class",
    "Industry",
    "Supply Chain Level",
    "Product Level",
    "EN-cost",
    "Competitor Pricing/Model Number",
]
PALLET_QUANTITY = "Pallet Quantity"

# Which columns hold prices.
PRICE_PREFIXES = ("Out-of-state ", "SoCal Project ")
PRICE_NAMES = (
    "Electrical Marketplace Price",
    "National SPA Price",
    "Sun Valley Pricing",
    "South CA SPA",
    "Standard Price",
    "CED Price",
    "GraybaR Price",
    "REXEL SPA Price",
    "Wesco Pricing - no rebates",
    "Platt Standard",
    "CES Price",
    "National Price",
)
NOT_A_PRICE = ("Out-of-state Pallet price",)

# Price models stored under another name.
PRICE_RENAMES = {
    "Sun Valley Pricing": "Sun Valley Price",
    "South CA SPA": "SPA South CA Price",
    "CED Price": "CED",
    "Wesco Pricing - no rebates": "Wesco",
}

# Patterns of the names.
MODEL_PATTERN = r"^([a-zA-Z\- ]+)\d+"
RANGE_PATTERN = r"^[a-zA-Z\- ]+\d+\s?\(\s?(\d+)-(\d+)\)"
FLOOR_PATTERN = r"^[a-zA-Z\- ]+\d+\s?(\d+)"
LOOSE_RANGE = r"\(\s?(\d+)\s?-\s?(\d+)\s?\)"
OUT_OF_STATE = (
    r"^Out-of-state Project\s?\d+\s?(\(\s?\d+\s?-\s?\d+\s?\)|\d+)|^Out-of-state Pallet price$"
)
SOCAL = r"^SoCal Project\s?\d+\s?(\(\s?\d+-\s?\d+\s?\)|\d+)|^SoCal Pallet price$"
LOOSE_FLOOR = r"^(?:Out-of-state Project|SoCal Project)\s?\d+\s?(\d+)"


@dataclass(frozen=True)
class PriceColumn:
    column: str
    model: str
    lower: int
    upper: int


def is_price_column(name: str) -> bool:
    return (name.startswith(PRICE_PREFIXES) or name in PRICE_NAMES) and name not in NOT_A_PRICE


def parse_price_column(name: str) -> PriceColumn:
    """Price model and quantity bucket of one column name."""
    label = PRICE_RENAMES.get(name.strip(), name).strip()
    model = re.match(MODEL_PATTERN, label)
    bucket = re.match(RANGE_PATTERN, label)
    floor = re.match(FLOOR_PATTERN, label)
    if bucket:
        lower, upper = int(bucket[1]), int(bucket[2])
    else:
        lower, upper = (int(floor[1]) if floor else 0), OPEN_END
    return PriceColumn(name, model[1].strip() if model else label, lower, upper)


@dataclass(frozen=True)
class PalletColumn:
    column: str
    region: str
    lower: float
    upper: float


def parse_pallet_column(name: str) -> PalletColumn | None:
    """Region and quantity range of a column that takes part in the pallet cascade."""
    if re.match(OUT_OF_STATE, name):
        region = "out-of-state"
    elif re.match(SOCAL, name):
        region = "socal"
    else:
        return None
    between = re.search(LOOSE_RANGE, name)
    if between:
        return PalletColumn(name, region, float(between[1]), float(between[2]))
    floor = re.match(LOOSE_FLOOR, name)
    return PalletColumn(name, region, float(floor[1]) if floor else 0.0, float(OPEN_END))
