"""How stored results lie in their files, so that a lookup reads little of them.

Rows are divided among files by ranges of their order and sorted inside, which
gives every row group narrow bounds; the columns that single values are looked
up by have Bloom filters besides, for results in another order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter

#: Bytes of a row group: what a lookup reads at least.
GROUP_BYTES = 16 << 20


@dataclass(frozen=True)
class Layout:
    """Order of the rows, and the columns with Bloom filters."""

    order: tuple[str, ...]
    keys: tuple[str, ...] = ()
    group_bytes: int = GROUP_BYTES

    def arranged(self, df: DataFrame) -> DataFrame:
        """``df`` in ranges of its order; it is computed twice, once to draw their bounds."""
        return df.repartitionByRange(*self.order).sortWithinPartitions(*self.order)

    def options(self, writer: DataFrameWriter) -> DataFrameWriter:
        writer = writer.option("parquet.block.size", self.group_bytes).option("parquet.bloom.filter.adaptive.enabled", True)
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True)
        return writer


# What is looked up: the forecasts of a series, the series of a tier, the recommendations of an action; and one series in each.
FORECASTS = Layout(("unique_id", "date"), ("unique_id",))
RISK = Layout(("risk_tier", "unique_id"), ("unique_id",))
RECOMMENDATIONS = Layout(("action", "unique_id"), ("unique_id",))
