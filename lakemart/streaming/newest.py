"""Newest version of every key in a stream, kept in the state store.

The state of a key is its newest change time and the hash of that content, so late
and repeated deliveries are dropped before any target table is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def newer_versions(rows: DataFrame, key: str, time: str) -> DataFrame:
    """Rows of a stream that are newer than all their key has had before; of one
    batch the newest row of a key.

    Equal times are decided by the content's hash, so the same rows in any order leave
    the same state.  A row without a time is older than any other.  The state holds
    two numbers for each key and does not expire; rows without a key are dropped.
    """
    columns = [f.name for f in rows.schema]
    stamped = rows.filter(F.col(key).isNotNull()).withColumns(
        {
            "_at": F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(-(1 << 62))),
            "_hash": F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})),
        }
    )

    def newest(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, chosen = tuple(state.get) if state.exists else None, None
        for pdf in batches:
            times = pdf["_at"].to_numpy()
            # of the rows with the newest time the one with the largest hash
            at = int(times.max())
            if best is not None and at < best[0]:
                continue
            places = (times == at).nonzero()[0]
            place = int(places[pdf["_hash"].to_numpy()[places].argmax()])
            found = (at, int(pdf["_hash"].iat[place]))
            if best is None or found > best:
                best, chosen = found, (pdf, place)
        if chosen is not None:
            state.update(best)
            pdf, place = chosen
            yield pdf.iloc[[place]][columns]

    schema = rows.schema
    return stamped.groupBy(key).applyInPandasWithState(newest, schema, "at long, hash long", "append", GroupStateTimeout.NoTimeout)
