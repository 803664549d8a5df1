"""Arrivals per clock tick of the two feeds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TICKS_PER_BLOCK = 4096


def _tick(ts: str, seconds: int) -> Column:
    return F.window(ts, f"{seconds} seconds").start


def tick_counts(df: DataFrame, ts: str, seconds: int, name: str = "arrivals") -> DataFrame:
    """Rows per tick that has any, of a table; :func:`closed_ticks` is the streaming form."""
    return df.groupBy(_tick(ts, seconds).alias("tick")).agg(F.count("*").alias(name))


def _all_ticks(counts: DataFrame, seconds: int) -> DataFrame:
    """Every tick from the first to the last in ``counts``.

    Spelled out in two steps, blocks and then the ticks of a block, with the
    blocks spread over the cluster in between, so that no row or task ever
    holds the whole range.
    """
    step = F.make_dt_interval(secs=F.lit(seconds))
    block = F.make_dt_interval(secs=F.lit(seconds * TICKS_PER_BLOCK))
    bounds = counts.agg(F.min("tick").alias("lo"), F.max("tick").alias("hi"))
    # A given number of partitions, since adaptive execution would merge these few small rows into one.
    spread = counts.sparkSession.sparkContext.defaultParallelism
    blocks = bounds.select("hi", F.explode(F.sequence("lo", "hi", block)).alias("at")).repartition(spread, "at")
    last = F.least(F.col("hi"), F.col("at") + F.make_dt_interval(secs=F.lit(seconds * (TICKS_PER_BLOCK - 1))))
    return blocks.select(F.explode(F.sequence(F.col("at"), last, step)).alias("tick"))


def arrival_rate(transactions: DataFrame, master: DataFrame, ts: str, seconds: int) -> DataFrame:
    """(tick, transaction_rate, master_rate) for every tick in range, zero where a feed was quiet."""
    tagged = transactions.select(ts, F.lit(1).alias("t"), F.lit(0).alias("m")).unionByName(
        master.select(ts, F.lit(0).alias("t"), F.lit(1).alias("m"))
    )
    counts = tagged.groupBy(_tick(ts, seconds).alias("tick")).agg(
        F.sum("t").alias("transaction_rate"), F.sum("m").alias("master_rate")
    )
    return (
        _all_ticks(counts, seconds)
        .join(counts, "tick", "left")
        .select("tick", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("transaction_rate", "master_rate")])
    )


def gated_ticks(transactions: DataFrame, master: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Ticks in which both feeds advanced, with the rows of each."""
    return tick_counts(transactions, ts, seconds, "transaction_rate").join(
        tick_counts(master, ts, seconds, "master_rate"), "tick"
    )


def clock(spark: SparkSession, ts: str = "ts") -> DataFrame:
    """A stream of the present instant, once a second, for live feeds."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("timestamp").alias(ts))


def past_clock(feeds: DataFrame, ts: str, seconds: int, late: int, every: bool = True) -> DataFrame:
    """The instants a clock would have shown while these rows arrived, to be landed and streamed beside them.

    ``every`` tick from the first to the last, and an instant far enough after the
    end for the last tick to close; without ``every`` that instant alone.
    """
    counts = tick_counts(feeds, ts, seconds)
    after = F.make_dt_interval(secs=F.lit(seconds + late))
    end = counts.agg(F.max("tick").alias("hi")).filter(F.col("hi").isNotNull()).select((F.col("hi") + after).alias(ts))
    return _all_ticks(counts, seconds).select(F.col("tick").alias(ts)).unionByName(end) if every else end


def closed_ticks(feeds: Mapping[str, DataFrame], clock: DataFrame, ts: str, seconds: int, late: int) -> DataFrame:
    """``window`` and the arrivals of every feed in it, for ticks that are over: a streaming append.

    ``feeds`` names the counts and gives streams, ``clock`` is a stream of instants;
    all have ``ts``. The clock's rows count for no feed but belong to their tick,
    so that a tick in which nothing arrived comes out with zeros. A tick is over,
    comes out once, and leaves the state when the newest instant is ``late``
    seconds past its end; rows that come after that are dropped, and counted by the
    query's progress. The state holds a row per open tick.
    """

    def counted(df: DataFrame, own: str | None) -> DataFrame:
        return df.select(F.col(ts).cast("timestamp").alias(ts), *[F.lit(int(name == own)).alias(name) for name in feeds])

    rows = counted(clock, None)
    for name, feed in feeds.items():
        rows = rows.unionByName(counted(feed, name))
    ticks = rows.withWatermark(ts, f"{late} seconds").groupBy(F.window(ts, f"{seconds} seconds").alias("window"))
    return ticks.agg(*[F.sum(name).cast("bigint").alias(name) for name in feeds])


def _tick_first(ticks: DataFrame) -> DataFrame:
    return ticks.select(F.col("window.start").cast("timestamp_ntz").alias("tick"), *[c for c in ticks.columns if c != "window"])


def arrival_rate_stream(feeds: Mapping[str, DataFrame], clock: DataFrame, ts: str, seconds: int, late: int) -> DataFrame:
    """(tick, a rate per feed) as ticks close, quiet ones included: :func:`arrival_rate` of running feeds."""
    return _tick_first(closed_ticks(feeds, clock, ts, seconds, late))


def gated_tick_stream(
    transactions: DataFrame, master: DataFrame, clock: DataFrame, ts: str, seconds: int, late: int
) -> DataFrame:
    """:func:`gated_ticks` of running feeds: the counts of both, joined as streams by their window.

    A count waits in the join's state for its counterpart until the window is over
    for both feeds. The clock closes the ticks of each feed.
    """
    advanced = [
        closed_ticks({name: feed}, clock, ts, seconds, late).filter(F.col(name) > 0)
        for name, feed in (("transaction_rate", transactions), ("master_rate", master))
    ]
    return _tick_first(advanced[0].join(advanced[1], "window"))
