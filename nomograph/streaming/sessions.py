"""Sessions of users from event streams, the same plan for a table and for a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: A session ends after so long without an event; a stream waits so long for late ones.
GAP, LATE = "8 hours", "1 day"


def sessions(events: DataFrame, gap: str = GAP, late: str = LATE) -> DataFrame:
    """events: event_id, ts, user_id, event_type, value. Each user's sessions: session_start, session_end (the last event's time), user_id, n, total, kinds.

    An event that comes twice counts once. On a stream, state is kept by event until the watermark passes it, and by open
    session; a session is given out once the watermark is past its end, and later rows are dropped and counted (late_rows)."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need an instant
    timed = timed.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else timed.dropDuplicates(["event_id"])
    found = timed.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max("ts").alias("session_end"), F.array_sort(F.collect_set("event_type")).alias("kinds"))
    return found.select(F.col("w.start").alias("session_start"), "session_end", "user_id", "n", "total", F.array_join("kinds", ",").alias("kinds"))


def late_rows(query: StreamingQuery) -> int:
    """How many rows a running or ended query has dropped for coming too late, as far back as its progress is kept."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p.get("stateOperators", []))
