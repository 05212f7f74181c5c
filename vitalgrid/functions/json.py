"""JSON cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOOKS_LIKE_JSON = r"^\s*[\[{]"


def normalized_json(text: Column) -> Column:
    """JSON text in compact form; text that is not JSON is null."""
    return F.to_json(F.try_parse_json(text))


def inline_json(cell: Column) -> Column:
    """The cell's own JSON; null if the cell is blank, a file name, or not valid JSON."""
    return F.when(cell.rlike(LOOKS_LIKE_JSON), normalized_json(cell))
