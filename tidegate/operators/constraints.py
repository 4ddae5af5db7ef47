"""What the warehouse tables must hold before a commit, and which of it is switched on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.tsql import holds, quoted
from tidegate.operators import checks
from tidegate.sources.entities import DETAIL, HEADER, Entity

#: TRUE for a row that breaks the constraint; a null makes it unknown, which passes.
ROW_CHECKS = {
    HEADER.name: {
        "CK_Amounts": "SubTotal < 0 OR TaxAmt < 0 OR Freight < 0 OR TotalDue < 0",
        "CK_DueDate": "DueDate < OrderDate",
        "CK_ShipDate": "ShipDate < OrderDate",
    },
    DETAIL.name: {
        "CK_OrderQty": "OrderQty <= 0",
        "CK_UnitPrice": "UnitPrice < 0",
        "CK_Discount": "UnitPriceDiscount < 0 OR UnitPriceDiscount > 1",
    },
}


class Violation(ValueError):
    """A table would break a constraint."""


@dataclass
class Constraints:
    off: set[str] = field(default_factory=set)

    def toggle(self, name: str, on: bool) -> None:
        """Switch one off, or on again (``validate`` then says whether what was loaded meanwhile holds)."""
        (self.off.discard if on else self.off.add)(name)

    def tallies(self, entity: Entity) -> dict[str, Column]:
        """Aggregates by name: rows that break each constraint that is on (not null, checks, repeated keys)."""
        bad = {f"NN_{c}": F.col(quoted(c)).isNull() for c in entity.columns if c not in entity.nullable}
        bad |= {n: holds(F.expr(p)) for n, p in ROW_CHECKS[entity.name].items()}
        out = {n: F.coalesce(F.sum(p.cast("long")), F.lit(0)) for n, p in bad.items()}
        out[f"PK_{entity.name}"] = F.count(entity.key) - F.countDistinct(entity.key)
        return {n: c.alias(n) for n, c in out.items() if n not in self.off}

    def require(self, found: dict[str, int], rows: DataFrame, entity: Entity, parents: DataFrame | None = None) -> None:
        """Raise if any count in ``found`` (by constraint) is not 0, or a line has no header among ``parents``."""
        broken = {n: k for n, k in found.items() if k}
        if parents is not None and "FK_Header" not in self.off and (n := checks.orphans(rows, parents).count()):
            broken["FK_Header"] = n
        if broken:
            raise Violation(f"{entity.name}: " + ", ".join(f"{n} ({k} rows)" for n, k in sorted(broken.items())))

    def validate(self, rows: DataFrame, entity: Entity, parents: DataFrame | None = None) -> None:
        asked = self.tallies(entity)
        self.require(rows.agg(*asked.values()).first().asDict() if asked else {}, rows, entity, parents)
