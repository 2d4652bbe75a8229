"""Landing tables: declared schemas, keys, tracked columns and what an update sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    """A stored table; its last column is the load timestamp, which input files lack.

    ``dated``: a date or time column that no update sets, by whose month the stored files are
    parted. ``parted``: a key column by whose hash they are, in ``parts`` parts, so that a batch of few keys
    touches few of them.
    """

    ddl: str
    keys: tuple[str, ...] = ()
    tracked: str | None = None
    guard: str | None = None
    set_columns: tuple[str, ...] = ()
    dated: str | None = None
    parted: str | None = None
    parts: int = 256

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [part.strip().rsplit(" ", 1)[0].strip("`") for part in self.ddl.split(",")]

    @property
    def load_column(self) -> str:
        return self.columns[-1]

    @property
    def input_columns(self) -> list[str]:
        return self.columns[:-1]

    @property
    def input_schema(self) -> StructType:
        """What a file holds: dates and times are still text."""
        fields = []
        for f in self.schema.fields[:-1]:
            kind = f.dataType.simpleString()
            kind = {"date": "string", "timestamp_ntz": "string", "bigint": "double"}.get(kind, kind)
            fields.append(f"`{f.name}` {kind}")
        return StructType.fromDDL(", ".join(fields))


# Column names and keys of the stored tables.
SALES = Table(
    """customer string, bill_num string, quote_num string, sys_dt timestamp_ntz, sku string,
    quantity bigint, amt double, price_model string, prod_cd string, sku_cat string,
    state_cd string, proj_type string, onboard_dt timestamp_ntz, cust_cat string,
    discount double, data_dt timestamp""",
    keys=("bill_num", "sys_dt", "sku"),
    dated="sys_dt",
)
QUOTES = Table(
    """model_no string, quantity bigint, distr_typ string, quote_num string, quote_dt date,
    trans_stat string, customer string, amt double, price_model string, row_stat string,
    state_cd string, data_dt timestamp""",
    keys=("quote_num", "model_no", "price_model"),
    tracked="row_stat",
    guard="target",
    set_columns=("quantity", "distr_typ", "trans_stat", "row_stat"),
    dated="quote_dt",
)
COMPETITOR = Table(
    """release_dt date, state_cd string, mnf_stk_price double, en_sku string, comp_sku string,
    quantity bigint, mnf string, distr string, mnf_desc string, distr_typ string,
    rep_name string, sys_dt timestamp""",
    keys=("release_dt", "state_cd", "en_sku", "comp_sku", "distr_typ"),
    tracked="mnf_stk_price",
    guard="source",
    set_columns=("mnf_stk_price", "mnf", "quantity", "mnf_desc", "rep_name"),
    dated="release_dt",
)
PRICE_MASTER = Table(
    """src_updt_dt date, model_no string, descript string, cat string, prod_cd string,
    supply_chain_lvl string, prod_lvl string, unit_cost double, comp_pricing_model_num string,
    unit_price double, price_model string, lower_bucket int, upper_bucket int,
    data_dt timestamp""",
    keys=("model_no", "price_model", "lower_bucket", "upper_bucket"),
    tracked="src_updt_dt",
    guard="target",
    set_columns=("src_updt_dt", "descript", "prod_cd", "unit_cost", "unit_price"),
    parted="model_no",
)
PROMO_HISTORY = Table(
    """month_st date, month_ed date, sku string, promo_reason string, category string,
    descrip string, color string, moq bigint, socal double, ofs double, free_sku string,
    `Qty On Hand (monthly)` double, `Qty sold (last 3 month)` double, `Months To Sell` double,
    `Actual Monthly Qty Sold (Netsuite)` double, photo_url string, sys_dt timestamp""",
    keys=("month_st", "month_ed", "sku"),
)
PROMO_BASE = Table(
    """sku string, color string, category string, promo_reason string, descrip string, moq bigint,
    socal double, ofs double, free_sku string, feb_sales double, inv_quantity bigint,
    inv_level string, photo_url string, sys_dt timestamp""",
)
INVENTORY = Table(
    """inv_eval_dt date, co_cd string, inv_level string, sku string, asin_num string,
    sku_cat string, en_last_120_outbound bigint, en_last_90_outbound bigint,
    en_last_60_outbound bigint, en_last_30_outbound bigint, tg_last_120_outbound bigint,
    tg_last_90_outbound bigint, tg_last_60_outbound bigint, tg_last_30_outbound bigint,
    ca_instock_quantity bigint, il_instock_quantity bigint, lda_instock_quantity bigint,
    tg_instock_quantity double, sys_dt timestamp""",
)
