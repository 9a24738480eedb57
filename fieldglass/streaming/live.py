"""Live events with Structured Streaming: dedup, last events by game, topics, incremental runs."""

from __future__ import annotations

import logging
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

log = logging.getLogger(__name__)


def event_key(key: str, inning: str, seq: str, description: str) -> Column:
    """The provider's id; where it is missing or empty, 16 hex digits of a hash of inning, number and description."""
    own = F.col(key).cast("string")
    made = F.substring(F.sha2(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (inning, seq, description)]), 256), 1, 16)
    return F.when(own != "", own).otherwise(made)


def new_events(events: DataFrame, key: str, at: str, within: str = "1 hour") -> DataFrame:
    """Events whose key did not come before within that time; state is bounded by the watermark."""
    return events.withWatermark(at, within).dropDuplicatesWithinWatermark([key])


def exact_new(events: DataFrame, group: str, key: str, last: int = 200, final: str | None = None) -> DataFrame:
    """(group, key) of events whose key is not among the last ``last`` new ones of its group.

    Where the boolean column ``final`` is true the group has ended: its state is
    dropped with that batch, so finished groups leave nothing behind.
    """
    types = dict(events.dtypes)

    def step(name, batches, state: GroupState):
        seen = list(state.get[0]) if state.exists else []
        have, ended = set(seen), False
        for b in batches:
            fresh = []
            ended = ended or (final is not None and bool(b[final].fillna(False).any()))
            for k in b[key]:
                if k is not None and k not in have:
                    fresh.append(k)
                    seen.append(k)
                    have.add(k)
                    if len(seen) > last:
                        have.discard(seen.pop(0))
            yield pd.DataFrame({group: [name[0]] * len(fresh), key: fresh})
        if not ended:
            state.update((seen,))
        elif state.exists:
            state.remove()

    schema = f"{group} {types[group]}, {key} {types[key]}"
    return events.groupBy(group).applyInPandasWithState(step, schema, f"seen array<{types[key]}>", "append", GroupStateTimeout.NoTimeout)


def replay(events: DataFrame, group: str, order: str, payload: str, last: int = 500) -> DataFrame:
    """(group, buffer): the last ``last`` payloads of each group in order, oldest first.

    Batch frames; a group keeps ``last`` rows in a task at most, as ranks are cut
    before rows are gathered.
    """
    from pyspark.sql import Window as W

    ranked = events.withColumn("_rn", F.row_number().over(W.partitionBy(group).orderBy(F.col(order).desc()))).where(F.col("_rn") <= last)
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(payload).alias("p"))))
    return ranked.groupBy(group).agg(F.transform(pairs, lambda x: x["p"]).alias("buffer"))


def purged(events: DataFrame, finished: DataFrame, group: str) -> DataFrame:
    """What a replay buffer still needs: events of groups that are not among the finished ones."""
    return events.join(finished.select(group).distinct(), group, "left_anti")


def changed_only(polls: DataFrame, source: str, order: str, payload: str) -> DataFrame:
    """Polls whose payload differs from the one before of the same source; the first always counts."""
    from pyspark.sql import Window as W

    digest = F.sha2(F.coalesce(F.col(payload).cast("string"), F.lit("")), 256)
    rows = polls.withColumn("_d", digest)
    return rows.withColumn("_b", F.lag("_d").over(W.partitionBy(source).orderBy(order))).where(~F.col("_d").eqNullSafe(F.col("_b"))).drop("_d", "_b")


class Broker:
    """Hands each micro-batch to the subscribers of a topic; one that fails does not disturb the others."""

    def __init__(self, topic: str):
        self.topic = topic
        self.subscribers: list[tuple[str | None, Callable[[DataFrame], None]]] = []

    def subscribe(self, handler: Callable[[DataFrame], None], topic: str | None = None) -> None:
        """``topic`` None takes all events."""
        self.subscribers.append((topic, handler))

    def publish(self, batch: DataFrame, batch_id: int = 0) -> int:
        """The number of handlers that took the batch; meant for ``foreachBatch``."""
        done = 0
        batch.persist()
        for topic, handler in self.subscribers:
            try:
                handler(batch if topic is None else batch.where(F.col(self.topic) == topic))
                done += 1
            except Exception:
                log.exception("a subscriber of batch %s failed", batch_id)
        batch.unpersist()
        return done


def run_incremental(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """All that is new since the checkpoint, appended to parquet; ends when that is done."""
    return stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
