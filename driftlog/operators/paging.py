"""Deep pages: distributed selection instead of a top-k that holds all rows before the page.

A histogram of the sort key tells which part of its range holds the offset; only the rows of that part are
sorted. Each level is one aggregation with at most ``BINS`` groups, over the event time and then the arrival
time; rows that tie on both are few, or are ranked in range partitions. So no task holds offset + size rows,
however deep the page is, and offsets are not bound to 32 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups of a histogram; rows that are sorted at once (the page's own part of the key range).
BINS, SORTED_ROWS = 4_096, 100_000


def _narrow(rows: DataFrame, key: Column, offset: int, size: int, most: int) -> tuple[DataFrame, int, int, bool]:
    """(rows of the key range that holds the page, offset in it, how many there are, do all have one key value).

    ``key`` is a whole number, largest first; nulls come last.
    """
    while True:
        stats = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(key).alias("known"), F.count("*").alias("n")).first()
        single = stats["known"] == 0 or (stats["lo"] == stats["hi"] and stats["known"] == stats["n"])
        if stats["n"] <= most or single:
            return rows, offset, stats["n"], single
        width = (stats["hi"] - stats["lo"]) // BINS + 1
        bin_of = F.coalesce(F.floor((key - stats["lo"]) / F.lit(width)), F.lit(-1))
        counts = sorted(rows.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["bin"])
        held, before, skipped = [], 0, 0
        for r in counts:
            if before + r["n"] > offset and before < offset + size:
                skipped = skipped if held else before
                held.append(r["bin"])
            before += r["n"]
        if not held:  # past the end
            return rows.limit(0), 0, 0, True
        if len(held) == len(counts):
            return rows, offset, stats["n"], False
        rows, offset = rows.where(bin_of.between(held[-1], held[0])), offset - skipped


def page_at(rows: DataFrame, keys: list[Column], order: list[Column], offset: int, size: int, most: int = SORTED_ROWS) -> DataFrame:
    """Rows ``offset`` to ``offset + size`` of ``rows`` in ``order``, which begins with ``keys`` descending (whole
    numbers, nulls last)."""
    for key in keys:
        rows, offset, left, single = _narrow(rows, key, offset, size, most)
        if offset >= left:  # past the end
            return rows.limit(0)
        if left <= most:
            return rows.orderBy(*order).offset(offset).limit(size)
        if not single:
            break
    return _ranked(rows, order, offset, size)


def _ranked(rows: DataFrame, order: list[Column], offset: int, size: int) -> DataFrame:
    """The page among rows that the keys do not tell apart: places in range partitions, counts of the ones before."""
    from driftlog.session import ensure_checkpoint_dir, range_partitions  # noqa: PLC0415

    ensure_checkpoint_dir(rows.sparkSession)
    columns = rows.columns
    spread = [*order, F.col("__row")]  # rows that tie throughout are equal, and are dealt like others
    x = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(range_partitions(rows), *spread).sortWithinPartitions(*spread)
    x = x.drop("__row").checkpoint(eager=True).withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()})
    before, total = {}, 0
    for r in sorted(x.groupBy("__part").agg(F.count("*").alias("n")).collect()):
        if total < offset + size and total + r["n"] > offset:
            before[r["__part"]] = total
        total += r["n"]
    if not before:
        return rows.limit(0)
    shift = F.lit(0)
    for part, n in before.items():  # the few partitions that the page touches
        shift = F.when(F.col("__part") == part, F.lit(n)).otherwise(shift)
    rank = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + shift
    page = x.where(F.col("__part").isin(list(before))).where(rank.between(offset, offset + size - 1))
    return page.orderBy(*order).select(*columns)
