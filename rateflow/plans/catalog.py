"""The re-aimed series catalog: ids, conversions and metric columns for the driver tables.

Daily and monthly priority series play the role of the three daily and three monthly
exchange-rate series; two of each are quoted the other way round and are converted.
"""

from __future__ import annotations

from rateflow.sources.tables import priority_ids

DAILY_IDS = priority_ids("DAILY")
MONTHLY_IDS = priority_ids("MONTHLY")

# The series quoted per USD, converted by the reciprocal (two of each frequency).
DAILY_CONVERT = ["DP2", "DP3"]
MONTHLY_CONVERT = ["MP2", "MP3"]


def rate_columns(ids: list[str], convert: list[str]) -> list[str]:
    """The rate column used for each series: the converted one where there is one."""
    return [f"{i}_CONVERTED" if i in convert else i for i in ids]


DAILY_RATES = rate_columns(DAILY_IDS, DAILY_CONVERT)
MONTHLY_RATES = rate_columns(MONTHLY_IDS, MONTHLY_CONVERT)

# Output columns of the combined table: one per priority, fed by its daily and monthly series.
COMBINED = {f"P{d[-1]}": [d, m] for d, m in zip(DAILY_IDS, MONTHLY_IDS)}

# The sparse series that the example of a partial list harmonizes.
LISTED = ["DP1_N00", "DP2_N07"]

# Arrival split used by the stream examples: rows dated before it arrive first.
ARRIVAL_CUTOFF = "1998-01-01"
# Lower bound of the date-range filter example.
RANGE_START = "1996-01-01"
