"""Ordered threshold rules that turn measurements into labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ladder:
    """First rule that holds gives the label; a NULL condition does not hold.

    Conditions are SQL text over the columns of the frame, so one ladder serves
    the DataFrame plan and the SQL that checks it.
    """

    rules: tuple[tuple[str, str], ...]
    default: str

    def column(self) -> Column:
        out = None
        for cond, label in self.rules:
            out = F.when(F.expr(cond), label) if out is None else out.when(F.expr(cond), label)
        return F.lit(self.default) if out is None else out.otherwise(self.default)

    def sql(self) -> str:
        whens = " ".join(f"WHEN {cond} THEN '{label}'" for cond, label in self.rules)
        return f"CASE {whens} ELSE '{self.default}' END"

    @property
    def labels(self) -> list[str]:
        return list(dict.fromkeys([label for _, label in self.rules] + [self.default]))


def steps(measure: str, op: str, bounds: list[tuple], default: str) -> Ladder:
    """Ladder over one measure: ``measure op bound`` for each (bound, label)."""
    return Ladder(tuple((f"{measure} {op} {b}", label) for b, label in bounds), default)


def rules(*pairs: tuple[str, str], default: str) -> Ladder:
    return Ladder(tuple(pairs), default)
