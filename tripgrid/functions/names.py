"""Spanish weekday and month names used by the seasonal command lines."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names (Monday = 0) and month names (January = 1),
# as the original command lines accept them.
WEEKDAYS = ("lunes", "martes", "miercoles", "jueves", "viernes", "sabado", "domingo")
MONTHS = (
    "enero",
    "febrero",
    "marzo",
    "abril",
    "mayo",
    "junio",
    "julio",
    "agosto",
    "septiembre",
    "octubre",
    "noviembre",
    "diciembre",
)


def _fold(name: str) -> str:
    """Lower case without accents, so 'Miércoles' and 'miercoles' match."""
    decomposed = unicodedata.normalize("NFKD", name.strip().lower())
    return "".join(ch for ch in decomposed if not unicodedata.combining(ch))


def weekday_number(name: str | int, compat: bool = False) -> int:
    """Weekday name -> 0..6 (Monday = 0). Integers 0..6 pass through.

    Unknown names raise ``ValueError``; with ``compat`` they become Monday,
    as in the original.
    """
    if isinstance(name, int):
        if 0 <= name <= 6:
            return name
        raise ValueError(f"weekday number must be 0..6, got {name}")
    folded = _fold(name)
    if folded in WEEKDAYS:
        return WEEKDAYS.index(folded)
    if compat:
        return 0
    raise ValueError(f"unknown weekday name {name!r}")


def month_number(name: str | int, compat: bool = False) -> int:
    """Month name -> 1..12. Integers 1..12 pass through.

    Unknown names raise ``ValueError``; with ``compat`` they become January.
    """
    if isinstance(name, int):
        if 1 <= name <= 12:
            return name
        raise ValueError(f"month number must be 1..12, got {name}")
    folded = _fold(name)
    if folded in MONTHS:
        return MONTHS.index(folded) + 1
    if compat:
        return 1
    raise ValueError(f"unknown month name {name!r}")


def weekday_number_col(name: Column | str) -> Column:
    """Column form of :func:`weekday_number` (NULL for unknown names)."""
    c = F.col(name) if isinstance(name, str) else name
    folded = F.translate(F.lower(F.trim(c)), "áéíóú", "aeiou")
    mapping = F.create_map(*[x for i, d in enumerate(WEEKDAYS) for x in (F.lit(d), F.lit(i))])
    return mapping[folded]


def month_number_col(name: Column | str) -> Column:
    """Column form of :func:`month_number` (NULL for unknown names)."""
    c = F.col(name) if isinstance(name, str) else name
    folded = F.lower(F.trim(c))
    mapping = F.create_map(*[x for i, m in enumerate(MONTHS) for x in (F.lit(m), F.lit(i + 1))])
    return mapping[folded]
