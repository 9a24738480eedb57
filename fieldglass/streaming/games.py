"""The replay buffer of live games as a stateful stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Replay(StatefulProcessor):
    """State of a game: its last events in order, or only that it is over."""

    def __init__(self, last: int, idle_ms: int, kinds: dict[str, str]):
        self.last, self.idle, self.kinds = last, idle_ms, kinds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", f"o {self.kinds['order']}, p {self.kinds['payload']}")
        self.over = handle.getValueState("over", "yes boolean")

    def _wake_at(self, ms: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows, timerValues):
        parts = list(rows)
        latest = max(int(p["ms"].max()) for p in parts)
        if self.over.exists():
            return
        held = list(self.events.get()) if self.events.exists() else []
        for p in parts:
            held += [(o, x) for o, x in zip(p["order"].tolist(), p["payload"].tolist())]
        held = sorted(held, key=lambda e: e[0])[-self.last :]
        ended = any(bool(p["final"].fillna(False).any()) for p in parts)
        if ended:
            self.events.clear()
            self.over.update((True,))
        else:
            self.events.put(held)
        self._wake_at(max(latest, timerValues.getCurrentWatermarkInMs()) + self.idle)
        yield pd.DataFrame({"game": [key[0]], "n": [len(held)], "buffer": [[p for _, p in held]], "over": [ended]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """A game that is over or silent for long enough is forgotten."""
        self.events.clear()
        self.over.clear()
        return iter(())


def live_replay(events: DataFrame, game: str, order: str, payload: str, at: str, final: str, last: int = 500, late: str = "10 minutes", idle_ms: int = 3 * 3600 * 1000) -> DataFrame:
    """(game, n, buffer, over): after each micro-batch, the last ``last`` payloads of each game that had events, oldest first.

    Late events take their place by ``order`` as long as the watermark lets them in.
    With the event where ``final`` is true a game's buffer goes out a last time and is
    dropped; what comes later is ignored until, ``idle_ms`` of event time after it,
    even the mark that the game is over goes.  A silent game goes likewise.  Write
    the result in update mode.  Needs the state store of ``use_state_store``.
    """
    kinds = dict(events.dtypes)
    own = events.selectExpr(f"`{game}` AS game", f"`{order}` AS order", f"`{payload}` AS payload", f"`{at}` AS _at", f"unix_millis(`{at}`) AS ms", f"`{final}` AS final").where("game IS NOT NULL AND order IS NOT NULL AND ms IS NOT NULL")
    return own.withWatermark("_at", late).groupBy("game").transformWithStateInPandas(
        Replay(last, idle_ms, {"order": kinds[order], "payload": kinds[payload]}),
        f"game {kinds[game]}, n long, buffer array<{kinds[payload]}>, over boolean",
        "Update",
        "EventTime",
    )


def use_state_store(spark: SparkSession) -> None:
    """Sets the state store that list state and timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
