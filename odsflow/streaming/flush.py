"""Rows held back per key and handed on together: as soon as there are enough of them, or the first one has waited long enough.

A flush begins with a key's first held row and ends with its `rows`-th, or before the first row whose time is `seconds` or more behind it,
or, if no further row comes, once it has been held for `seconds` by the clock. So for rows in the order of their time the flushes that
a later row ends are the same however the stream is cut into batches. What is held is state: a restart goes on with it.

The clock is a stream of its own, a row a second, whose newest arrival is the watermark that ends waits. So a query that takes what is there
and stops (`availableNow`) does stop: with a processing-time timeout Spark would ask for one more batch without end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: The reference flow's limits.
ROWS, SECONDS = 100, 3
#: Seconds by which the clock may be set back; beyond that Spark would take new rows for late ones. Waits are not longer for it.
CLOCK_BACK = 7 * 24 * 3600
FLUSHES = "key string, flush_no long, reason string, n int, first_at timestamp, payloads array<string>"
HELD = "flush_no long, first_at timestamp, payloads array<string>"
NAMES = [field.split()[0] for field in FLUSHES.split(", ")]


def flusher(rows: int, seconds: float):
    """The function that serves one key: new rows (payload, at, came) and what is held, to flushes. The rows of the clock make none."""
    wait = pd.Timedelta(seconds=seconds)

    def flush(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ours, name = key
        if not ours:
            yield pd.DataFrame([], columns=NAMES)
            return
        number, first, held = state.get if state.exists else (0, None, [])
        held, first, out = list(held), None if first is None else pd.Timestamp(first), []

        def close(reason: str) -> None:
            nonlocal number, held, first
            out.append((name, number, reason, len(held), first, held))
            number, held, first = number + 1, [], None

        if state.hasTimedOut:
            if held:
                close("time")
        else:
            new = pd.concat([b for b in batches], ignore_index=True).sort_values(["at", "payload"], kind="stable")
            for payload, at in zip(new["payload"], new["at"]):
                if held and at >= first + wait:
                    close("time")
                first = at if not held else first
                held.append(payload)
                if len(held) >= rows:
                    close("count")
        state.update((number, first if held else None, held))
        if held:
            until = int(new["came"].max()) - 1000 * CLOCK_BACK + max(1, int(seconds * 1000))
            state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=NAMES)

    return flush


def count_or_time_flush(
    stream: DataFrame, key: Column, payload: Column, at: str, rows: int = ROWS, seconds: float = SECONDS
) -> DataFrame:
    """A stream of flushes (key, flush_no, reason, n, first_at, payloads) out of a stream of rows.

    `payload` is what is handed on, as text (JSON, say); `at` the column of the rows' time. Within a batch a key's rows are taken in the
    order of their time; one that comes in a later batch than its time says joins what is held then, so none is dropped. A key's
    state holds fewer than `rows` payloads, and a batch's rows of one key are in one task: give `key` a salt where one key is too hot for that.
    """
    timed = stream.select(
        F.lit(True).alias("ours"), key.cast("string").alias("key"), payload.cast("string").alias("payload"), F.col(at).cast("timestamp").alias("at")
    )
    clock = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    nothing = [F.lit(None).cast(timed.schema[name].dataType).alias(name) for name in ("key", "payload", "at")]
    both = timed.unionByName(clock.select(F.lit(False).alias("ours"), *nothing))
    both = both.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", f"{CLOCK_BACK} seconds").withColumn("came", F.unix_millis("arrived"))
    return both.groupBy("ours", "key").applyInPandasWithState(flusher(rows, seconds), FLUSHES, HELD, "append", GroupStateTimeout.EventTimeTimeout)
