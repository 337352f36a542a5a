"""What a fix did: the repaired table and a log of its steps."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.cells import small_frame

LOG_SCHEMA = "stage string, action string, `column` string, affected bigint"


@dataclass
class Fixed:
    df: DataFrame
    stage: str
    log: list[tuple[str, str, str, int]] = field(default_factory=list)
    types_changed: int = 0
    rows_removed: int = 0
    stored: bool = False  # ``df`` is read from a table that the fix has written

    def note(self, action: str, column: str, affected: int) -> None:
        if affected:
            self.log.append((self.stage, action, column, int(affected)))


def change_log(df: DataFrame, entries: Iterable[tuple[str, str, str, int]]) -> DataFrame:
    return small_frame(df, list(entries), LOG_SCHEMA)


def changes_per_stage(log: DataFrame) -> DataFrame:
    return log.groupBy("stage").agg(
        F.count(F.lit(1)).alias("changes"), F.coalesce(F.sum("affected"), F.lit(0)).alias("affected")
    )
