"""Sums of a metric's last seconds, as a table and as a stream.

Windows are made of whole seconds: that of second s are the seconds from s - n + 1 to s. Both forms have a row for each second in which a
series (service, metric, stream) has a value."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SERIES = ["service", "metric", "stream"]
#: Windows to a stretch of time: a series of any length is dealt out by stretches, each with one window of the one before.
STRETCH = 64
#: Totals of a series that leave the stream at once.
ROWS = 1 << 16


def sliding_sums(metrics: DataFrame, seconds: int, time: str = "ts") -> DataFrame:
    """service, metric, stream, second, total: of each second with values what the last `seconds` seconds add up to. A null value is 0; rows
    without a time don't count."""
    second = F.floor(F.unix_millis(time) / 1000).cast("long")
    sums = metrics.where(F.col(time).isNotNull()).groupBy(*SERIES, second.alias("second")).agg(F.sum(F.coalesce("value", F.lit(0))).alias("value"))
    size = STRETCH * seconds
    own = F.floor(F.col("second") / size).cast("long")
    leads = F.col("second") > (own + 1) * size - seconds  # the next stretch begins with these
    dealt = sums.withColumn("own", own).withColumn("stretch", F.explode(F.when(leads, F.array("own", F.col("own") + 1)).otherwise(F.array("own"))))
    window = Window.partitionBy(*SERIES, "stretch").orderBy("second").rangeBetween(-(seconds - 1), 0)
    return dealt.withColumn("total", F.sum("value").over(window)).where("own = stretch").select(*SERIES, "second", "total")


def stream_sliding_sums(metrics: DataFrame, seconds: int, delay: int = 10, time: str = "ts") -> DataFrame:
    """sliding_sums as a stream, with a ring of sums by second in each series' state.

    A trigger gives the totals that its values have changed, the latest of which counts: of their seconds, and of later ones whose windows
    hold them. Values that come more than `delay` seconds late don't count. The ring holds the sums of 2 * seconds + delay seconds at most,
    and goes when the watermark is that far beyond its last value. A trigger takes time in proportion to its rows."""
    length = 2 * seconds + delay
    known = metrics.withWatermark(time, f"{delay} seconds").select(*SERIES, time, F.floor(F.unix_millis(time) / 1000).cast("long").alias("second"), F.coalesce("value", F.lit(0)).cast("double").alias("value"))

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        ring = pd.Series({int(s): v for s, v in json.loads(state.get[0]).items()} if state.exists else {}, dtype=float)
        sums = [frame.groupby("second")["value"].sum() for frame in frames]
        fresh = pd.concat([ring.iloc[:0], *sums]).groupby(level=0).sum()
        if len(ring):
            fresh = fresh[fresh.index > ring.index.max() - seconds - delay]
        if not len(fresh):
            return
        ring = pd.concat([ring, fresh]).groupby(level=0).sum()  # in order
        at, touched = ring.index.to_numpy(np.int64), fresh.index.to_numpy(np.int64)
        upto = np.concatenate([[0.0], ring.to_numpy().cumsum()])
        total = upto[1:] - upto[np.searchsorted(at, at - seconds, "right")]
        newest = int(at[-1])
        changed = np.flatnonzero(np.searchsorted(touched, at, "right") > np.searchsorted(touched, at - seconds, "right"))  # their windows hold one
        kept = ring[at > newest - length]
        state.update((json.dumps(dict(zip(kept.index.tolist(), kept.tolist(), strict=True))),))
        state.setTimeoutTimestamp(max((newest + length) * 1000, state.getCurrentWatermarkMs() + 1))
        for k in range(0, len(changed), ROWS):
            some = changed[k : k + ROWS]
            yield pd.DataFrame(dict(zip(SERIES, key, strict=True)) | {"second": at[some], "total": total[some]})

    schema = ", ".join(f"{c} string" for c in SERIES) + ", second bigint, total double"
    return known.groupBy(*SERIES).applyInPandasWithState(run, schema, "ring string", "update", GroupStateTimeout.EventTimeTimeout)
