"""Deposits as a stream: a reading is deposited when it differs from the one before it under its key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def accumulate(readings: DataFrame) -> DataFrame:
    """(key long, stamp timestamp, content string) stream -> the readings with verdict.

    A reading after the last stamp seen is deposited or unchanged; one at that stamp with the same content is
    unchanged and with another content a conflict; an earlier one is late. Readings of a batch are taken in the
    order of their stamps, then contents. The state of a key is its last stamp and content.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stamp, content = state.get if state.exists else (None, None)
        for row in pd.concat(list(frames)).sort_values(["stamp", "content"]).itertuples():
            at = int(row.stamp.value // 1000)
            if stamp is not None and at < stamp:
                verdict = "late"
            elif stamp == at:
                verdict = "unchanged" if row.content == content else "conflict"
            else:
                verdict = "unchanged" if stamp is not None and row.content == content else "deposited"
                stamp, content = at, row.content
            yield pd.DataFrame({"key": [key[0]], "stamp": [row.stamp], "content": [row.content], "verdict": [verdict]})
        state.update((stamp, content))

    schema = "key long, stamp timestamp, content string, verdict string"
    return readings.groupBy("key").applyInPandasWithState(step, schema, "stamp long, content string", "append", GroupStateTimeout.NoTimeout)
