"""Clock times (TIMESTAMP_NTZ) as instants and back, the clock read as UTC.

Watermarks need instants; the conversions do not depend on the session's time
zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def as_instant(col: str) -> Column:
    return F.expr(f"""timestamp_micros(
        datediff(CAST({col} AS DATE), DATE '1970-01-01') * 86400000000L + hour({col}) * 3600000000L
        + minute({col}) * 60000000L + CAST(extract(SECOND FROM {col}) * 1000000 AS BIGINT))""")


def as_clock(micros: str) -> Column:
    return F.expr(f"""{_EPOCH} + make_dt_interval(
        0, 0, 0, CAST(CAST({micros} AS DECIMAL(18,0)) / 1000000 AS DECIMAL(18,6)))""")
