"""Deposits as a stream in which readings may come late: each is judged by its own predecessor, and what it changes is told again."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "key long, stamp long, arrival long, content string, verdict string, version long"


class Placing(StatefulProcessor):
    """State of a key: the readings at each stamp (in microseconds) as a map, and the last stamp with what counts there, so readings on time read no map."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getMapState("at", "stamp long", "arrivals array<long>, contents array<string>")
        self.last = handle.getValueState("last", "stamp long, content string, version long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.last.get() if self.last.exists() else None
        end, end_content, version = (held[0], held[1], held[2]) if held else (None, None, 0)
        stamps = None
        known: dict = {}

        def readings(stamp) -> list[tuple[int, str | None]]:
            if stamp not in known:
                found = self.at.getValue((stamp,)) if self.at.containsKey((stamp,)) else None
                known[stamp] = sorted(zip(found[0], found[1], strict=True), key=lambda x: x[0]) if found else []
            return known[stamp]

        def told(stamp, which=None) -> Iterator[Row]:
            nonlocal version
            k = bisect_left(stamps, stamp) if stamps is not None else 0
            before = readings(stamps[k - 1])[0][1] if k else None
            news = not k or before != readings(stamp)[0][1]
            first = readings(stamp)[0]
            for i, (arrival, content) in enumerate(readings(stamp)):
                if which is None or arrival in which:
                    verdict = "deposited" if i == 0 and news else "unchanged" if content == first[1] else "conflict"
                    version += 1
                    yield Row(key=key[0], stamp=stamp, arrival=arrival, content=content, verdict=verdict, version=version)

        for row in sorted(rows, key=lambda r: (r.stamp, r.arrival)):
            stamp, arrival, content = row.stamp, row.arrival, row.content
            if end is None or stamp > end:
                if stamps is not None:
                    stamps.append(stamp)
                known[stamp] = [(arrival, content)]
                version += 1
                yield Row(key=key[0], stamp=stamp, arrival=arrival, content=content, verdict="unchanged" if end is not None and content == end_content else "deposited", version=version)
                end, end_content = stamp, content
            else:
                if stamps is None:
                    # the key's stamps, once a batch that has a late reading
                    stamps = sorted({*(k[0] for k in self.at.keys()), *known})
                there = list(readings(stamp))
                if not there:
                    insort(stamps, stamp)
                known[stamp] = sorted([*there, (arrival, content)], key=lambda x: x[0])
                counts = known[stamp][0] == (arrival, content)
                yield from told(stamp, None if counts else {arrival})
                k = bisect_left(stamps, stamp) + 1
                if counts and k < len(stamps):
                    yield from told(stamps[k], {readings(stamps[k])[0][0]})
                if stamp == end:
                    end_content = known[stamp][0][1]
            now = known[stamp]
            self.at.updateValue((stamp,), ([a for a, _ in now], [c for _, c in now]))
        self.last.update((end, end_content, version))

    def close(self) -> None:
        pass


def accumulate(readings: DataFrame) -> DataFrame:
    """(key long, stamp timestamp, arrival long, content string) stream -> the readings with verdict and version.

    Of several rows for one (key, stamp, arrival) that of the greatest version counts; these are the verdicts of
    ``trajectory.accumulated`` over all that has come so far, in whatever order it came. A late reading is judged by the one before its
    stamp; if it counts there, the first reading of the next stamp is told again. Arrivals of a key are unlike; stamps and
    arrivals are not null. It needs the RocksDB state store.
    """
    told = readings.select("key", F.unix_micros("stamp").alias("stamp"), "arrival", "content").groupBy("key").transformWithState(Placing(), OUTPUT, "update", "None")
    return told.withColumn("stamp", F.timestamp_micros("stamp"))
