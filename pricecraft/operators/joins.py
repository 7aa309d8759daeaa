"""Joining fitted parameter tables back onto the big table.

Fitted tables (one row per key) are small only when the key has few
values.  ``checked_broadcast`` fetches at most a limited number of rows, in
one job.  If that is the whole table and its bytes are under a limit too, the
table becomes a local one: its size is known to the planner, it is broadcast,
and later joins do not run the fit again.  Beyond the limits the fit stays
lazy and the join a shuffle join, where adaptive execution splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bounds for a broadcast parameter table.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32 << 20
_CONF_KEY = "pricecraft.broadcast.maxRows"


def max_broadcast_rows(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(_CONF_KEY, None)
    return int(v) if v else BROADCAST_MAX_ROWS


def checked_broadcast(params: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``params`` as a broadcast local table if it is small, else as it is."""
    limit = max_rows if max_rows is not None else max_broadcast_rows(params)
    got = params.limit(limit + 1).toArrow()
    if got.num_rows > limit or got.nbytes > BROADCAST_MAX_BYTES:
        return params
    return F.broadcast(params.sparkSession.createDataFrame(got, params.schema))


def left_join_params(df: DataFrame, params: DataFrame, keys: Sequence[str] | str,
                     max_rows: int | None = None) -> DataFrame:
    """``df LEFT JOIN params USING (keys)`` with a size-checked broadcast."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(checked_broadcast(params, max_rows), keys, "left")


class ScalarRow:
    """Fields of a one-row DataFrame as scalar-subquery columns.

    The row is packed into one struct subquery, so however many fields are
    used, Spark runs (and reuses) a single subquery job.  With ``fetch`` the row
    is read at once and its fields are literals: for long chains of fits, whose
    plans would otherwise nest.
    """

    def __init__(self, one_row: DataFrame, fetch: bool = False):
        self._cols = one_row.columns
        self._types = {f.name: f.dataType for f in one_row.schema.fields}
        self._row = one_row.first() if fetch else None
        self._s = None if fetch else one_row.select(F.struct(*[F.col(f"`{c}`") for c in self._cols]).alias("s")).scalar()

    def __getitem__(self, name: str):
        if self._s is not None:
            return self._s.getField(name)
        return F.lit(self._row[name] if self._row is not None else None).cast(self._types[name])

    @property
    def columns(self) -> list[str]:
        return list(self._cols)
