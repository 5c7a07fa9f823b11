"""Declared tables: schema, business key, columns that may be null by design."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DISCOUNTS = [f"type_{i}_discount" for i in range(7)]

_LONG, _INT, _DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
_TEXT, _DATE = T.StringType(), T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    nullable_by_design: frozenset[str] = frozenset()

    @property
    def columns(self) -> list[str]:
        return self.schema.names


_DISCOUNT_TYPES = {name: _DOUBLE for name in DISCOUNTS}

SALES = TableSpec(
    "sales_train",
    _schema(
        unique_id=_LONG, date=_DATE, warehouse=_TEXT, total_orders=_DOUBLE, sales=_DOUBLE,
        sell_price_main=_DOUBLE, availability=_DOUBLE, **_DISCOUNT_TYPES,
    ),
    key=("unique_id", "date"),
)
SALES_AHEAD = TableSpec(
    "sales_test",
    _schema(
        unique_id=_LONG, date=_DATE, warehouse=_TEXT, total_orders=_DOUBLE,
        sell_price_main=_DOUBLE, **_DISCOUNT_TYPES,
    ),
    key=("unique_id", "date"),
)
INVENTORY = TableSpec(
    "inventory",
    _schema(
        unique_id=_LONG, product_unique_id=_LONG, name=_TEXT,
        l1_category_name_en=_TEXT, l2_category_name_en=_TEXT,
        l3_category_name_en=_TEXT, l4_category_name_en=_TEXT, warehouse=_TEXT,
    ),
    key=("unique_id",),
)
CALENDAR = TableSpec(
    "calendar",
    _schema(
        date=_DATE, holiday_name=_TEXT, holiday=_INT, shops_closed=_INT,
        winter_school_holidays=_INT, school_holidays=_INT, warehouse=_TEXT,
    ),
    key=("warehouse", "date"),
    nullable_by_design=frozenset({"holiday_name"}),
)
WEIGHTS = TableSpec("test_weights", _schema(unique_id=_LONG, weight=_DOUBLE), key=("unique_id",))

TABLES: dict[str, TableSpec] = {
    spec.name: spec for spec in (SALES, SALES_AHEAD, INVENTORY, CALENDAR, WEIGHTS)
}

# The order-line tables the panel is derived from.
_STAMP = T.TimestampNTZType()
ORDER_TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec("region", _schema(r_regionkey=_INT, r_name=_TEXT), key=("r_regionkey",)),
        TableSpec("nation", _schema(n_nationkey=_INT, n_name=_TEXT, n_regionkey=_INT), key=("n_nationkey",)),
        TableSpec(
            "supplier",
            _schema(s_suppkey=_LONG, s_name=_TEXT, s_nationkey=_INT, s_acctbal=_DOUBLE),
            key=("s_suppkey",),
        ),
        TableSpec(
            "customer",
            _schema(c_custkey=_LONG, c_name=_TEXT, c_nationkey=_INT, c_acctbal=_DOUBLE, c_mktsegment=_TEXT),
            key=("c_custkey",),
        ),
        TableSpec(
            "part",
            _schema(
                p_partkey=_LONG, p_name=_TEXT, p_brand=_TEXT, p_type=_TEXT, p_size=_INT, p_retailprice=_DOUBLE
            ),
            key=("p_partkey",),
        ),
        TableSpec(
            "orders",
            _schema(
                o_orderkey=_LONG, o_custkey=_LONG, o_orderstatus=_TEXT, o_totalprice=_DOUBLE,
                o_orderdate=_STAMP, o_orderpriority=_TEXT,
            ),
            key=("o_orderkey",),
        ),
        TableSpec(
            "lineitem",
            _schema(
                l_orderkey=_LONG, l_partkey=_LONG, l_suppkey=_LONG, l_linenumber=_INT, l_quantity=_DOUBLE,
                l_extendedprice=_DOUBLE, l_discount=_DOUBLE, l_tax=_DOUBLE, l_returnflag=_TEXT,
                l_linestatus=_TEXT, l_shipdate=_STAMP,
            ),
            key=("l_orderkey", "l_linenumber"),
        ),
    )
}
