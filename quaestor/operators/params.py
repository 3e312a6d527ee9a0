"""Parameters of a search, checked on the driver before a plan is made: what isn't understood is an error, never ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .querylang import fold

# Spellings of the courts' regions and of document types.
COURTS = {"trf1": "TRF1", "1": "TRF1", "1a regiao": "TRF1", "trf2": "TRF2", "2": "TRF2", "trf4": "TRF4", "4": "TRF4", "trf5": "TRF5", "5": "TRF5", "tnu": "TNU", "stj": "STJ"}
KINDS = {"cc": "CC", "sentenca": "CC", "oc": "OC", "parecer": "OC", "ss": "SS", "supervisao": "SS"}
#: Kinds of which only metadata is indexed.
NO_TEXT = {"SS"}


def normalise(values: str, names: dict[str, str]) -> list[str]:
    """Comma-separated spellings as canonical names, in order, each once. ValueError for one that isn't known."""
    out: list[str] = []
    for v in filter(None, (fold(x).strip() for x in (values or "").split(","))):
        if v not in names:
            raise ValueError(f"not understood: {v!r}; known are {sorted(set(names.values()))}")
        if names[v] not in out:
            out.append(names[v])
    return out


def with_text(kinds: list[str]) -> list[str]:
    """The kinds, if all of them have text to search. ValueError otherwise: an empty result would read as none found."""
    bare = [k for k in kinds if k in NO_TEXT]
    if bare:
        raise ValueError(f"only metadata is indexed for {bare}; search by number or date")
    return kinds


def date_range(first: str | None, last: str | None) -> tuple[str | None, str | None]:
    """ISO dates in order. ValueError for a reversed range."""
    if first and last and first > last:
        raise ValueError(f"{first} is after {last}")
    return first, last


def understood(rows: DataFrame, asked: str, names: dict[str, str], out: str) -> DataFrame:
    """Rows with the canonical name of what is asked, as ``out``, and whether it is refused: a request that isn't known has no answer, not an empty one."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return rows.withColumn(out, F.try_element_at(known, F.trim(T.fold(F.col(asked))))).withColumn("refused", F.col(out).isNull())
