"""Per-user recent-ratings state kept by Spark (``applyInPandasWithState``).

The state is each user's list of its k newest ratings by (event time,
event id). Users are dealt to a fixed number of groups by hash, and one call merges
the rows of a group's users, so that calls do not grow with the users. Rows come in Arrow batches and are merged
chunk by chunk: memory is O(k x users of the group + chunk) however many rows a user sends. A micro-batch emits
the new lists of its users, which are upserted per user. Event order across batches does not
matter: a late, older event only enters the list if it is among the k newest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.scalar import epoch_micros_ntz
from ..operators.realtime import RECENT_K
from ..sources.sinks import UpsertLog
from . import realtime_stream

LISTS_SCHEMA = "uid long, mids array<int>, scores array<double>"
STATE_SCHEMA = "uid array<long>, ts_us array<long>, event_id array<long>, mid array<int>, score array<double>"
#: Groups that users are dealt to; a group's state is rewritten when one of its users sends a row.
GROUPS = 4096
#: Stands for a null user; and for null times, ids and items.
NO_USER = -(1 << 40)
NO_LONG, NO_INT = -(1 << 63), -(1 << 31)


def with_time_key(events: DataFrame) -> DataFrame:
    """Add ``ts_us``: microseconds since 1970 of the wall-clock event time."""
    return events.withColumn("ts_us", epoch_micros_ntz("ts"))


def recent_lists_sink(path: str) -> UpsertLog:
    return UpsertLog(path, "uid", [])


def _merge(k: int):
    import numpy as np
    import pandas as pd

    kinds = {"uid": "int64", "ts_us": "int64", "event_id": "int64", "mid": "int32", "score": "float64"}

    def fn(key, pdfs, state):
        held = [np.asarray(x, dtype=t) for x, t in zip(state.get if state.exists else [[]] * len(kinds), kinds.values())]
        sent = []
        for pdf in pdfs:  # merge chunk by chunk: at most k a user + chunk rows held at once
            new = [pdf[c].to_numpy(t) for c, t in kinds.items()]
            sent.append(np.unique(new[0]))
            held = [np.concatenate(x) for x in zip(held, new)]
            order = np.lexsort((-held[2], -held[1], held[0]))  # by user, newest first: ts desc, then event_id desc
            uid = held[0][order]
            begin = np.flatnonzero(np.diff(uid, prepend=uid[:1] - 1))
            place = np.arange(len(uid)) - np.repeat(begin, np.diff(np.append(begin, len(uid))))
            order = order[place < k]
            held = [x[order] for x in held]
        state.update(tuple(x.tolist() for x in held))
        uid, _, _, mid, sc = held
        users, begin = np.unique(uid, return_index=True)
        new = np.isin(users, np.concatenate(sent)) if sent else np.zeros(len(users), bool)
        cut = lambda x: [part for part, n in zip(np.split(x, begin[1:]), new) if n]
        yield pd.DataFrame({"uid": users[new], "mids": cut(mid), "scores": cut(sc)})

    return fn


def start(events: DataFrame, sink: UpsertLog, checkpoint: str, k: int = RECENT_K, trigger: dict | None = None,
          compact_every: int | None = realtime_stream.COMPACT_EVERY, groups: int = GROUPS) -> StreamingQuery:
    """``events``: streaming (uid, mid, score, ts, event_id)."""
    or_else = lambda c, t, n: F.coalesce(F.col(c).cast(t), F.lit(n).cast(t)).alias(c)
    keyed = with_time_key(events).select(
        F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int").alias("grp"), or_else("uid", "long", NO_USER), or_else("ts_us", "long", NO_LONG),
        or_else("event_id", "long", NO_LONG), or_else("mid", "int", NO_INT), "score")
    merged = keyed.groupBy("grp").applyInPandasWithState(_merge(k), LISTS_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)
    item = lambda m, i: F.struct(i.cast("int").alias("pos"), m.alias("mid"), F.get("scores", i).alias("score"))
    lists = merged.select(F.when(F.col("uid") != NO_USER, F.col("uid").cast("int")).alias("uid"), F.transform("mids", item).alias("items"))
    return realtime_stream.upsert_batches(lists, lambda b: b, sink, checkpoint, trigger, compact_every, mode="update")


def latest_flat(spark, sink: UpsertLog) -> DataFrame:
    latest = sink.read_latest(spark)
    ex = latest.select("uid", F.explode("items").alias("it"))
    return ex.select("uid", F.col("it.pos").alias("pos"), F.col("it.mid").alias("mid"),
                     F.col("it.score").alias("score"))
