"""Column rules for landing tables.

Every rule is a plain ``Column -> Column`` expression on built-in functions, so a
cleaning pass stays one projection inside whole-stage codegen. Text rules use
``replace`` / ``btrim`` / ``instr`` rather than regular expressions where the
semantics allow: those run on the UTF-8 bytes without a regex engine per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters deleted from key text.
KEY_JUNK = "\u00a0\u200b\ufeff\t\n\r"

# What counts as white space when text is stripped.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# State names spelled out in landing files.
STATE_CODES = {"Florida": "FL", "Oregon": "OR", "Utah": "UT", "Costa Rica": "CR"}

# State spellings in sales files, matched as a case-blind prefix.
STATE_PREFIXES = {"n.y.": "NY", "fl": "FL", "ca": "CA"}

# Raw product categories grouped into reporting categories.
CATEGORY_GROUPS = {
    "Electrical Device": ["Wiring Devices", "GFCI", "NEMA", "Combination Devices", "USB"],
    "Smart Home": ["Automation", "Room Control", "EV", "Data-Com Devices"],
    "Switch": ["Switches", "Dimmers", "Fan Speed Control"],
    "Sensors": ["Sensors", "In Wall Sensors", "Humidity Sensors"],
    "Energy Mangement": ["Plug Load", "Timers"],
    "Specialty Accessories": ["Locking Devices", "Weatherproof Covers", "Floor Box", "Wall Plates", "RV"],
}
CATEGORY_OTHER = "Other"

# Misspelt or long labels, per column.
LABEL_FIXES = {
    "category": {"Discontinued item": "Discontinued"},
    "promo_reason": {"Disontinued": "Discontinued"},
}


def _unless_plain(c: Column, cleaned: Column) -> Column:
    """Text of visible ASCII only has nothing to trim or delete; one scan spares it the rest."""
    return F.when(c.rlike(r"[^\x21-\x7e]"), cleaned).otherwise(c)


def strip(c: Column) -> Column:
    """Trim every kind of white space from both ends."""
    return _unless_plain(c, F.btrim(c, F.lit(WHITE_SPACE)))


def clean_key(c: Column) -> Column:
    """Delete invisible characters anywhere in a key, then strip it."""
    bare = c
    for junk in KEY_JUNK:
        bare = F.replace(bare, F.lit(junk), F.lit(""))
    return _unless_plain(c, F.btrim(bare, F.lit(WHITE_SPACE)))


def after_colon(c: Column) -> Column:
    """Text behind the first colon up to the end of its line; text without a colon is kept."""
    tail = F.ltrim(F.substr(c, F.instr(c, ":") + 1), F.lit(WHITE_SPACE))
    return F.when(F.instr(c, ":") > 0, F.substring_index(tail, "\n", 1)).otherwise(c)


def state_code(c: Column) -> Column:
    out = None
    for name, code in STATE_CODES.items():
        out = F.when(c == name, code) if out is None else out.when(c == name, code)
    return out.otherwise(F.upper(c))


def state_prefix(c: Column) -> Column:
    low = F.lower(c)
    out = None
    for prefix, code in STATE_PREFIXES.items():
        hit = F.startswith(low, F.lit(prefix))
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise(c)


def date_text(c: Column) -> Column:
    """Text of a date without its time of day."""
    text = strip(c.cast("string"))
    return F.when(F.instr(text, ":") > 0, F.regexp_replace(text, r"[T ]+\d{1,2}:.*$", "")).otherwise(text)


# Month names as they may be written.
MONTHS = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)


def date_order(c: Column) -> Column:
    """Text of a date in one of three shapes: ``yyyy-M-d``, ``yyyyMMdd`` or ``d Mmm yyyy``; other text stays no date.

    Numbers may stand between dashes, slashes or dots; the month comes first unless the first
    number is above 12. Month names may come before or after the day, with or without a comma.
    """
    flat = F.replace(F.replace(c, F.lit("/"), F.lit("-")), F.lit("."), F.lit("-"))
    full = F.regexp_replace(flat, r"^([0-9]{1,2}-[0-9]{1,2}-)([0-9]{2})\z", "$120$2")
    turned = F.regexp_replace(full, r"^(1[3-9]|[2-9][0-9])-([0-9]{1,2})-([0-9]{4})\z", "$3-$2-$1")
    numbers = F.regexp_replace(turned, r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})\z", "$3-$1-$2")
    parts = F.regexp_replace(F.trim(F.regexp_replace(c, r"[\s,./-]+", " ")), r"(\d)(?:st|nd|rd|th)\b", "$1")
    day_first = F.regexp_replace(parts, rf"(?i)^({MONTHS}) (\d{{1,2}}) (\d{{4}})$", "$2 $1 $3")
    named = F.regexp_replace(day_first, rf"(?i)^(\d{{1,2}}) (?=(?:{MONTHS}) )([a-z]{{3}})[a-z]* (\d{{4}})$", "$1 $2 $3")
    return F.when(c.rlike("[A-Za-z]"), F.when(c.rlike("[0-9]"), F.initcap(named))).otherwise(numbers)


def date_from_order(c: Column) -> Column:
    """Date from text in one of the shapes of ``date_order``, null when none fits."""
    return (
        F.when(c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), c.try_cast("date"))
        .when(c.rlike(r"^[0-9]{8}\z"), F.try_to_date(c, "yyyyMMdd"))
        .when(c.rlike(r"^[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}\z"), F.try_to_date(c, "d MMM yyyy"))
    )


def date_from_text(c: Column) -> Column:
    """Date from text in mixed layouts, null when none fits; ``DATE_RULES`` do it in steps, each with its own projection,
    whose code stays small enough to be compiled."""
    return date_from_order(date_order(c))


def to_date_lenient(c: Column) -> Column:
    return date_from_text(date_text(c))


def capitalize(c: Column) -> Column:
    """First letter upper, everything else lower (not per word)."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def title_words(c: Column) -> Column:
    """Capitalize each blank-delimited word."""
    return F.initcap(c)


def to_text(c: Column) -> Column:
    return c.cast("string")


def label_fix(column: str, c: Column) -> Column:
    out = c
    for wrong, right in LABEL_FIXES[column].items():
        out = F.when(c == wrong, right).otherwise(out)
    return out


def round_quantity(c: Column) -> Column:
    """Nearest integer, halves to the even neighbour, null kept."""
    return F.rint(c.cast("double")).cast("long")


def customer_name(c: Column) -> Column:
    """Drop the leading id token, then the parent name in front of the first ' : '."""
    cut = F.instr(c, " ")
    name = F.when(cut > 0, F.substr(c, cut + 1)).otherwise(F.when(c.isNotNull(), F.lit("")))
    sub = F.instr(name, " : ")
    return F.when(sub > 0, F.substr(name, sub + 3)).otherwise(name)


def parse_erp_ts(c: Column, meridiem: bool = False) -> Column:
    """Minute timestamp from ``M/d/yyyy H:mm am|pm`` text; bad text is an error.

    By default the marker is deleted without adding twelve hours, which is what
    keys already stored were built with. ``meridiem=True`` reads the clock time.
    """
    if meridiem:
        return F.to_timestamp_ntz(F.upper(c), F.lit("M/d/yyyy h:mm a"))
    bare = F.replace(F.replace(c, F.lit(" am"), F.lit("")), F.lit(" pm"), F.lit(""))
    return F.to_timestamp_ntz(bare, F.lit("M/d/yyyy H:mm"))


def strip_prefix(c: Column, text: str = "Sales Order #") -> Column:
    return F.replace(c, F.lit(text), F.lit(""))


def discount(c: Column) -> Column:
    return F.abs(F.coalesce(c, F.lit(0.0)))


def combo_sku(c: Column) -> Column:
    """Lower the first letter of SKUs that mention 'Combo'."""
    lowered = F.concat(F.lower(F.left(c, F.lit(1))), F.substr(c, F.lit(2)))
    return F.when(F.contains(c, F.lit("Combo")), lowered).otherwise(c)


def category_rollup(c: Column) -> Column:
    out = None
    for group, raw in CATEGORY_GROUPS.items():
        out = F.when(c.isin(raw), group) if out is None else out.when(c.isin(raw), group)
    return out.otherwise(CATEGORY_OTHER)


DATE_RULES = (date_text, date_order, date_from_order)

# Rules applied by column name, in this order, after the key columns are cleaned.
COLUMN_RULES = [
    ("comp_sku", after_colon),
    ("state_cd", state_code),
    *[("release_dt", rule) for rule in DATE_RULES],
    ("mnf", capitalize),
    ("distr_typ", capitalize),
    ("distr", title_words),
    ("en_sku", to_text),
    ("comp_sku", to_text),
    ("model_no", lambda c: strip(to_text(c))),
    *[("src_updt_dt", rule) for rule in DATE_RULES],
    ("category", lambda c: label_fix("category", c)),
    ("promo_reason", lambda c: label_fix("promo_reason", c)),
    *[("quote_dt", rule) for rule in DATE_RULES],
    ("quantity", round_quantity),
    ("customer", customer_name),
]

SALES_RULES = [
    ("sys_dt", parse_erp_ts),
    ("onboard_dt", parse_erp_ts),
    ("quote_num", strip_prefix),
    ("state_cd", state_prefix),
    ("discount", discount),
    ("sku", combo_sku),
    ("sku_cat", category_rollup),
]


def apply_rules(df: DataFrame, rules) -> DataFrame:
    """Apply every rule whose column exists; later rules see the result of earlier ones.

    A column's second rule starts a new projection instead of nesting the first one into
    it: rules mention their input several times, and nested they would compute it as often.
    What is a date already is not written as text to be parsed again.
    """
    layer = {}
    dates = {f.name for f in df.schema.fields if f.dataType.simpleString() == "date"}
    for name, rule in rules:
        if name not in df.columns or (name in dates and rule in DATE_RULES):
            continue
        if name in layer:
            df, layer = df.withColumns(layer), {}
        layer[name] = rule(F.col(f"`{name}`"))
    return df.withColumns(layer) if layer else df


def clean_landing(df: DataFrame, keys: list[str], rules=COLUMN_RULES) -> DataFrame:
    """Rows with every key present, keys cleaned, and the column rules applied: all of them unless told otherwise."""
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    present = df
    for k in keys:
        present = present.where(F.col(k).isNotNull())
    key_rules = [(k, clean_key) for k in keys if k in text]
    return apply_rules(present, [*key_rules, *rules])
