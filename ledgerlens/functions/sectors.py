"""Macro-sector label of a two-character activity-code prefix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# NAF division ranges (inclusive, compared as strings) and the
# macro-sector label each maps to, in order; anything else is DEFAULT_SECTOR.
SECTOR_RANGES: list[tuple[str, str, str]] = [
    ("01", "03", "A — Agriculture"),
    ("05", "09", "B — Industries extractives"),
    ("10", "33", "C — Industrie manufacturière"),
    ("35", "35", "D — Énergie"),
    ("36", "39", "E — Eau, déchets"),
    ("41", "43", "F — Construction"),
    ("45", "47", "G — Commerce"),
    ("49", "53", "H — Transport"),
    ("55", "56", "I — Hôtellerie/Restauration"),
    ("58", "63", "J — Information/Communication"),
    ("64", "66", "K — Finance/Assurance"),
    ("68", "68", "L — Immobilier"),
    ("69", "75", "M — Services professionnels"),
    ("77", "82", "N — Services admin"),
    ("84", "84", "O — Administration publique"),
    ("85", "85", "P — Enseignement"),
    ("86", "88", "Q — Santé/Action sociale"),
]
DEFAULT_SECTOR = "Z — Autres"


def sector_label(prefix: Column) -> Column:
    """First matching range wins; a null or unmatched prefix is the default."""
    branches = [(prefix.between(F.lit(lo), F.lit(hi)), label) for lo, hi, label in SECTOR_RANGES]
    first_cond, first_label = branches[0]
    expr = reduce(lambda acc, b: acc.when(b[0], F.lit(b[1])),
                  branches[1:], F.when(first_cond, F.lit(first_label)))
    return expr.otherwise(F.lit(DEFAULT_SECTOR))
