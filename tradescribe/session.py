"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings; results do not depend on them.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits the trades of one counterparty, or the flows of one trade, over
    # several join tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The just-in-time compiler skips methods above 8,000 bytes of bytecode.  The
    # report's projections fuse into larger ones; without fusion they are split
    # into small methods and run twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The one aggregate on objects, the notional list, finds its input sorted by
    # trade.  A streaming aggregate uses that; the hash-based one sorts again.
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    # Plans are made before sizes are known; only sizes that adaptive execution
    # has measured decide on a broadcast.
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Where the unique side of a join came out small enough in every partition,
    # the other side, all versions or all trades, is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}

# A rank filter on more rows than this runs only after the shuffle.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


# Rows that lie by trade number also lie by trade number and date; Spark then joins on both without a shuffle.
BY_TRADE_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def tune(spark: SparkSession, *, by_trade: bool = False) -> SparkSession:
    """Apply the runtime settings to an existing session, and so to all its later queries.

    ``by_trade`` adds the one for tables in buckets of trade numbers.  No result
    depends on them.  They stay until the caller sets them back.
    """
    for key, value in (RUNTIME_CONF | (BY_TRADE_CONF if by_trade else {})).items():
        spark.conf.set(key, value)
    return spark


def bounded_groups(spark: SparkSession, most: int) -> None:
    """Let rank filters that keep up to ``most`` rows of a group work inside the map tasks."""
    if int(spark.conf.get(GROUP_LIMIT)) <= most:
        spark.conf.set(GROUP_LIMIT, str(most + 1))


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tradescribe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites for error messages double the time to build a large plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
