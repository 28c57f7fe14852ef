"""Ordinal maps."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.common import col_

# The hot-sauce answer order of the survey (a clear order,
# except the "with my hot sauce" answer, which is sent to -1).
HOT_SAUCE_ORDER = {
    "A little (mild)": 1,
    "A moderate amount (medium)": 2,
    "I will have some of this food item with my hot sauce": -1,
    "A lot (hot)": 3,
}

# The same four-level ordinal on the order-priority column of the `survey`
# view (FIXTURES 2.1); every other value maps to 0.
PRIORITY_ORDER = {"5-LOW": 1, "3-MEDIUM": 2, "2-HIGH": -1, "1-URGENT": 3}


def ordinal_map(c, mapping: dict, default: int = 0) -> Column:
    """Map answers to integers; unseen and NULL answers -> ``default``."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(m, col_(c)), F.lit(default)).cast("int")
