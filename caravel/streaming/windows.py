"""Windows over event time, the same for batches and streams; a stream gets a watermark first."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.triggers import Hook, apply_hooks


def _marked(df: DataFrame, ts: str, late: str) -> DataFrame:
    # a watermark needs an instant; naive times are taken as UTC
    typed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return typed.withWatermark(ts, late) if df.isStreaming else typed


def tumbling(df: DataFrame, ts: str, size: str, keys: Iterable[str], *aggs, late: str = "10 minutes") -> DataFrame:
    return _windowed(_marked(df, ts, late), F.window(ts, size), keys, aggs)


def sliding(df: DataFrame, ts: str, size: str, step: str, keys: Iterable[str], *aggs, late: str = "10 minutes") -> DataFrame:
    return _windowed(_marked(df, ts, late), F.window(ts, size, step), keys, aggs)


def sessions(df: DataFrame, ts: str, gap: str, keys: Iterable[str], *aggs, late: str = "10 minutes") -> DataFrame:
    return _windowed(_marked(df, ts, late), F.session_window(ts, gap), keys, aggs)


def _windowed(df: DataFrame, window, keys: Iterable[str], aggs) -> DataFrame:
    keys = list(keys)
    return df.groupBy(window.alias("w"), *keys).agg(*aggs).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *[F.col(x) for x in _names(aggs)])


def _names(aggs) -> list[str]:
    import re

    return [re.search(r"AS `?(\w+)`?", str(a._jc.toString() if hasattr(a, "_jc") else a))[1] if " AS " in str(a) else str(a) for a in aggs]


def deduplicated(df: DataFrame, ts: str, keys: Iterable[str], late: str = "10 minutes") -> DataFrame:
    marked = _marked(df, ts, late)
    return marked.dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else marked.dropDuplicates(list(keys))


def with_hooks(stream: DataFrame, hooks: Iterable[Hook], event: str, write: Callable[[str, DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Row hooks on every micro-batch: NEW rows are the batch's; ``write`` gets (table, rows), side outputs after the table."""
    hooks = list(hooks)

    def batch(df: DataFrame, _: int) -> None:
        rows = df.select(F.struct(*df.columns).alias("new"))
        for phase in ("BEFORE", "AFTER"):
            rows, side = apply_hooks(rows, hooks, event, phase)
            if phase == "BEFORE":
                write(hooks[0].table, rows.select("new.*"))
            for table, parts in side.items():
                for part in parts:
                    write(table, part)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()
