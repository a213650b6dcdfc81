"""The shared BI filter set."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from faremill.functions.trip import WEEKEND, month_label
from faremill.schema import MONTH


@dataclass(frozen=True)
class Filters:
    """Optional scalars, combined with AND. Empty text counts as absent; area 0 does not."""

    start: str | None = None
    end: str | None = None
    company: str | None = None
    payment_type: str | None = None
    pickup_area: int | None = None
    day_type: str | None = None

    def conditions(self) -> list[Column]:
        found = []
        if self.start:
            found.append(F.col("trip_date") >= F.lit(self.start).cast("date"))
        if self.end:
            found.append(F.col("trip_date") <= F.lit(self.end).cast("date"))
        if self.company:
            found.append(F.col("company") == self.company)
        if self.payment_type:
            found.append(F.col("payment_type") == self.payment_type)
        if self.pickup_area is not None:
            found.append(F.col("pickup_community_area") == self.pickup_area)
        if self.day_type == "weekend":
            found.append(F.col("dow_num").isin(*WEEKEND))
        elif self.day_type == "weekday":
            found.append(~F.col("dow_num").isin(*WEEKEND))
        return found

    def columns(self) -> set[str]:
        """Columns the conditions read."""
        read = {"trip_date": self.start or self.end, "company": self.company,
                "payment_type": self.payment_type, "dow_num": self.day_type}
        return ({name for name, given in read.items() if given}
                | ({"pickup_community_area"} if self.pickup_area is not None else set()))

    def pruning(self) -> list[Column]:
        """The date bounds as bounds on the partition column; they fold to constants."""
        found = []
        if self.start:
            found.append(F.col(MONTH) >= month_label(F.lit(self.start)))
        if self.end:
            found.append(F.col(MONTH) <= month_label(F.lit(self.end)))
        return found

    def apply(self, silver: DataFrame) -> DataFrame:
        conditions = self.conditions()
        if MONTH in silver.columns:
            conditions = self.pruning() + conditions
        return silver.filter(reduce(operator.and_, conditions)) if conditions else silver
