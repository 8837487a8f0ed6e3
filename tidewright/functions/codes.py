"""Code decoding, signs and banding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Station category codes and their printed names.
STATION_TYPES = {
    "SUPPLIER": "供应商",
    "BOOKSTORE": "书店",
    "CAFE": "咖啡馆",
    "LOGISTICS": "物流",
    "STAPLE": "大宗客户",
    "WHOLESALE": "批发事业部",
    "USER": "用户",
}
# Document types that move goods between stations.
CIRCULATION_TYPES = {
    "DELIVERY": "配送",
    "ADJUST": "调剂",
    "RESTOCK": "退库",
    "MISTAKE": "流转误差",
}
# Direction names of a give-away and of a supplier document.
GIVE_DIRECTIONS = {-1: "出库", 1: "入库"}
SUPPLIER_DIRECTIONS = {"OUT_STORAGE": "退货", "IN_STORAGE": "进货"}
# Sale channel by memo prefix.
SALE_TYPES = {"签售": "CHECK_SALES", "商场内书展": "SHOP_INSIDE", "商场外书展": "SHOP_OUTER"}
SALE_TYPE_NAMES = {"签售": "签售", "商场内书展": "商场内书展", "商场外书展": "商场外书展"}
DEFAULT_SALE_TYPE, DEFAULT_SALE_TYPE_NAME = "BOOK_SALES", "正常零售"
# Lower bounds of the card money bands.
MONEY_BOUNDS = (0, 200, 300, 600, 1000, 2000, 3000, 5000)
# Lower bounds of the trading-hour bands.
HOUR_BOUNDS = (0, 10, 12, 14, 16, 18, 20, 22, 24)


def decode(code: Column, names: Mapping, default: Column | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    found = F.try_element_at(table, code)
    return found if default is None else F.coalesce(found, default)


def signed(code: Column, plus: Sequence, minus: Sequence, other=0) -> Column:
    """+1, -1 or ``other`` by membership; ``other=None`` leaves unknown codes null."""
    return (
        F.when(code.isin(*plus), F.lit(1))
        .when(code.isin(*minus), F.lit(-1))
        .otherwise(F.lit(other).cast("int"))
    )


def storage_sign(purpose: Column) -> Column:
    """Stock direction of a document: in is +1, out is -1."""
    return signed(purpose, ["IN_STORAGE"], ["OUT_STORAGE"])


def order_sign(order_type: Column) -> Column:
    return signed(order_type, ["ORDER"], ["BACK_ORDER"])


def _bands(bounds: Sequence[int]) -> list[tuple[int, int | None, str]]:
    pairs = list(zip(bounds, list(bounds[1:]) + [None]))
    return [(lo, hi, f"{lo}-{hi}" if hi is not None else f"{lo}+") for lo, hi in pairs]


def money_band(amount: Column, below: Column | None = None) -> Column:
    """Band label of an amount; ``below`` is the value for amounts under the first bound."""
    label = F.lit(None).cast("string")
    for lo, hi, name in reversed(_bands(MONEY_BOUNDS)):
        inside = amount >= lo if hi is None else (amount >= lo) & (amount < hi)
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label if below is None else F.coalesce(label, below)


def hour_band(ts: Column) -> Column:
    hour = F.hour(ts)
    label = F.lit(None).cast("string")
    for lo, hi, name in reversed(_bands(HOUR_BOUNDS)[:-1]):
        label = F.when((hour >= lo) & (hour < hi), F.lit(name)).otherwise(label)
    return label


def by_prefix(text: Column, names: Mapping[str, str], default: str) -> Column:
    """First matching prefix decides; no match, or no text, gives the default."""
    out = F.lit(default)
    for prefix, name in reversed(list(names.items())):
        out = F.when(F.startswith(text, F.lit(prefix)), F.lit(name)).otherwise(out)
    return out
