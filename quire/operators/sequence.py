"""Per-key sequence operators that never place a whole key in one task.

``lag`` or a running sum over a window partitioned by a key sends every row
of the key to one task; a key holding a third of the rows becomes a third
of the job on one core. Here the key's sequence is cut into buckets (time
buckets for events, page ranges for documents): the window runs per
``(key, bucket)``, and the only thing that crosses bucket borders is one row
per bucket (its last row, or its count), handled on the small per-bucket
table. Results are identical to the single-window form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DEFAULT_BUCKET_S = 3600
DEFAULT_PAGE_BUCKET = 256
#: Keys are counted in this many slots by hash; those of a slot with more rows
#: (or four times a slot's mean) may hold too many rows for a task.
SLOTS, HOT_ROWS = 1 << 16, 1 << 17


def time_bucket(ts: str, bucket_s: int = DEFAULT_BUCKET_S, ntz: bool = True) -> Column:
    """Monotonic bucket of a timestamp, independent of the session time zone:
    ``timestamp_ntz`` is bucketed on its wall-clock value (days since epoch
    and seconds of day), ``timestamp`` on its instant."""
    c = F.col(ts)
    if ntz:
        secs = (F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
                + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
        return F.floor(secs / F.lit(bucket_s)).cast("bigint")
    return F.floor(F.unix_micros(c) / F.lit(bucket_s * 1_000_000)).cast("bigint")


def by_hot_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``df`` whose keys are small enough to have their rows in one
    task each, and the others with those of a null key (``None`` where there is
    no such row). Rows are counted by slot, so the counts do not grow with the
    keys; a key that shares a hot one's slot goes with it."""
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")
    per = df.groupBy(slot.alias("slot"), F.col(key).isNull().alias("none")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a slot
    bar = max(HOT_ROWS, 4 * sum(r["n"] for r in per) // SLOTS)
    hot = [r["slot"] for r in per if r["n"] > bar]
    if not hot and not any(r["none"] for r in per):
        return df, None
    apart = F.col(key).isNull() | slot.isin(hot)
    return df.where(~apart), df.where(apart)


def _is_ntz(df: DataFrame, ts: str) -> bool:
    return dict(df.dtypes).get(ts) == "timestamp_ntz"


def range_bucket(col: str, width: int = DEFAULT_PAGE_BUCKET) -> Column:
    return F.floor(F.col(col) / F.lit(width)).cast("bigint")


def _order(ts: str, tie: str | None):
    return [ts, tie] if tie else [ts]


def prev_values(df: DataFrame, key: str, order: list[str], bucket: Column | None, cols: list[str]) -> DataFrame:
    """Adds ``prev_<c>``: value of ``c`` on the previous row of the same key
    in ``order`` (NULL on the key's first row). ``bucket`` must be
    non-decreasing along ``order``; ``None`` reuses an existing ``_b``
    column. The output keeps ``_b`` and stays partitioned by ``(key, _b)``,
    so a following :func:`running_count` adds no shuffle of the rows."""
    x = df if bucket is None else df.withColumn("_b", bucket)
    w = W.partitionBy(key, "_b").orderBy(*order)
    x = x.withColumn("_rn", F.row_number().over(w))
    for c in cols:
        x = x.withColumn(f"_lag_{c}", F.lag(c).over(w))
    last = x.groupBy(key, "_b").agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    carry = last.withColumn("_carry", F.lag("_last").over(W.partitionBy(key).orderBy("_b"))) \
        .select(key, "_b", "_carry")
    x = x.join(carry, [key, "_b"], "left")
    for c in cols:
        x = x.withColumn(f"prev_{c}", F.when(F.col("_rn") == 1, F.col("_carry")[c])
                         .otherwise(F.col(f"_lag_{c}")))
    return x.drop("_carry", "_rn", *[f"_lag_{c}" for c in cols])


def running_count(df: DataFrame, key: str, order: list[str], bucket: Column | None, flag: str,
                  out: str) -> DataFrame:
    """Adds ``out`` = number of rows with ``flag`` = 1 up to and including
    this one in the key's ``order``: a running sum per bucket plus the sum
    of earlier buckets (from the per-bucket table). ``bucket=None`` reuses
    ``_b``."""
    x = df if bucket is None else df.withColumn("_b", bucket)
    w = W.partitionBy(key, "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    x = x.withColumn("_rs", F.sum(flag).over(w))
    per = x.groupBy(key, "_b").agg(F.sum(flag).alias("_nb"))
    wo = W.partitionBy(key).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    off = per.withColumn("_off", F.coalesce(F.sum("_nb").over(wo), F.lit(0))).select(key, "_b", "_off")
    x = x.join(off, [key, "_b"], "left")
    return x.withColumn(out, (F.col("_off") + F.col("_rs")).cast("bigint")).drop("_rs", "_off")


def bucketed_prev(df: DataFrame, key: str, ts: str, tie: str | None, cols: list[str],
                  bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """:func:`prev_values` over a timestamp order with time buckets (keeps ``_b``)."""
    return prev_values(df, key, _order(ts, tie), time_bucket(ts, bucket_s, _is_ntz(df, ts)), cols)


def sessions(df: DataFrame, key: str, ts: str, tie: str | None, gap_s: int,
             bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Gaps-and-islands sessionisation: a row ``gap_s`` or more after the
    previous one of its key opens a new session; adds ``session_no``
    (1-based, per key)."""
    x = bucketed_prev(df, key, ts, tie, [ts], bucket_s)
    new = (F.col(f"prev_{ts}").isNull()
           | (F.col(ts) >= F.col(f"prev_{ts}") + F.expr(f"INTERVAL {gap_s} SECONDS"))).cast("int")
    x = running_count(x.withColumn("_new", new), key, _order(ts, tie), None, "_new", "session_no")
    return x.drop("_new", f"prev_{ts}", "_b")
