"""Snapshot maintenance over streams.

maintain() runs the batch operators in foreachBatch: each micro-batch of (key, sha256, ord) is reduced to its last row for
each key and appended to a versioned snapshot as a delta; the batch's number is kept with the snapshot, so that a batch that
is delivered again after a failure changes nothing. changes() keeps one hash for each key as state and emits transitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import relational as R
from ..plans.store import SnapshotStore

SNAPSHOT = "key string, sha256 string, ord long, batch long"


def merge_batch(store: SnapshotStore, batch: DataFrame, number: int) -> None:
    """The last row of each key of a batch into the snapshot, once for each batch number.

    A batch is appended as a delta, so it writes its own keys and no others; the store's note has the last batch's number.
    """
    if store.note() is not None and int(store.note()) >= number:
        return
    new = R.last_wins(batch.select("key", "sha256", "ord"), ["key"], ["ord"])
    store.append(new.withColumn("batch", F.lit(number).cast("bigint")), note=str(number))


def maintain(stream: DataFrame, store: SnapshotStore, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """A stream of (key, sha256, ord) into store."""
    writer = stream.writeStream.foreachBatch(lambda df, n: merge_batch(store, df, n)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _transitions(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    old = state.get[0] if state.exists else None
    rows = pd.concat(list(frames)).sort_values("ord") if frames else pd.DataFrame()
    out = []
    for sha in rows["sha256"]:
        if sha != old:
            out.append((key[0], "added" if old is None else "updated", sha))
            old = sha
    if old is not None:
        state.update((old,))
    yield pd.DataFrame(out, columns=["key", "status", "sha256"])


def changes(stream: DataFrame) -> DataFrame:
    """(key, status, sha256): a row whenever a key's hash is new or another."""
    return stream.groupBy("key").applyInPandasWithState(_transitions, "key string, status string, sha256 string", "sha256 string", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(stream: DataFrame, ts: str = "ts", kind: str = "event_type", late: str = "10 minutes", width: str = "5 minutes", step: str | None = None) -> DataFrame:
    """(start, kind, n): events by window, with a watermark for late ones."""
    window = F.window(ts, width, step) if step else F.window(ts, width)
    return stream.withWatermark(ts, late).groupBy(window.alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
