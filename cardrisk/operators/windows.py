"""Skew-tolerant trailing time windows.

A plain ``Window.partitionBy(card).orderBy(ts).rangeBetween(...)`` sends all
rows of one card to one task; with a card holding a third of the data that
task is the job. These helpers split each key by *time bucket* instead:

* ``prior_moments`` -- long frames (30 days) of additive statistics. Per
  (key, bucket) partial sums are aggregated map-side; differences of running
  sums over those rows give the buckets that the frame covers or touches; rows
  of the same bucket before the current row, less the part of the oldest bucket
  that left the frame, come from one running window over (key, bucket).

* ``bucketed_frames`` -- counts and min/max over trailing frames with
  buckets much shorter than the frame (a minute for the card rules), from
  per-bucket partials, a running window in the current bucket and the oldest
  bucket's rows copied forward; used by R2h and R4h.

All are compositions of built-in operators (aggregate, window, union,
join); the results equal the single-partition RANGE frame exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros
from ..functions.moments import cents, mean_of, squared, std_of

_T = "_t_us"
_B = "_bkt"
_SELF = "_self"


def prior_moments(df: DataFrame, key: str, ts_col: str, x_col: str, window_us: int, bucket_us: int,
                  prefix: str = "hist") -> DataFrame:
    """Add ``{prefix}_n``, ``{prefix}_mean``, ``{prefix}_std`` (sample) of
    ``x_col`` over the same key's rows with ``ts - window <= ts' < ts``."""
    if window_us % bucket_us:
        raise ValueError("window must be a whole number of buckets")
    k = window_us // bucket_us
    x = F.col("_cents")
    base = (df.withColumn(_T, epoch_micros(ts_col)).withColumn("_cents", cents(F.col(x_col)))
              .withColumn(_B, F.floor(F.col(_T) / F.lit(bucket_us))))

    # (key, bucket) partial sums, then sums over the buckets b-k .. b-1: all
    # before b less all before b-k (running sums, exact, so a key costs time in
    # proportion to its buckets, not to their number times the frame).
    parts = base.groupBy(key, _B).agg(F.count(x).alias("n"), F.sum(x).alias("s"),
                                      F.sum(squared(x)).alias("ss"))
    wb = Window.partitionBy(key).orderBy(_B)
    upto = wb.rangeBetween(Window.unboundedPreceding, -1)
    gone = wb.rangeBetween(Window.unboundedPreceding, -(k + 1))
    z = F.lit(0)
    buckets = parts.select(parts[key], parts[_B],
                           *[F.sum(c).over(upto).alias(f"_u{c}") for c in ("n", "s", "ss")],
                           *[F.sum(c).over(gone).alias(f"_g{c}") for c in ("n", "s", "ss")])
    buckets = buckets.select(key, _B, *[(F.coalesce(f"_u{c}", z) - F.coalesce(f"_g{c}", z)).alias(f"_b{c}")
                                        for c in ("n", "s", "ss")])

    # Rows of this bucket before the current one (added), and rows of the
    # boundary bucket b-k that already left the frame (shifted forward by the
    # window, subtracted): one signed running sum of each. A copy past the
    # last bucket of all would meet no row; none is made. Rows without a time
    # are copied, so that they cancel out: they have no history.
    tt = "_tt"
    own = base.withColumn(tt, F.col(_T)).withColumn(_SELF, F.lit(True))
    last = base.agg(F.max(_B)).scalar()
    ctx = base.filter(x.isNotNull() & F.coalesce(F.col(_B) + k <= last, F.lit(True))).select(key, (F.col(_B) + k).alias(_B), (F.col(_T) + window_us).alias(tt),
                                            F.lit(False).alias(_SELF), x)
    u = own.unionByName(ctx, allowMissingColumns=True)
    w = Window.partitionBy(_B, key).orderBy(tt).rangeBetween(Window.unboundedPreceding, -1)   # a number sorts first
    signed = lambda c: F.when(F.col(_SELF), c).otherwise(-c)
    u = u.select("*", F.sum(signed(F.when(x.isNotNull(), F.lit(1)))).over(w).alias("_pn"),
                 F.sum(signed(x)).over(w).alias("_ps"), F.sum(signed(squared(x))).over(w).alias("_pss"))
    u = u.filter(F.col(_SELF)).join(buckets, on=[key, _B], how="left")

    n, s, ss = (F.coalesce(f"_b{c}", z) + F.coalesce(f"_p{c}", z) for c in ("n", "s", "ss"))
    u = u.withColumn(f"{prefix}_n", n).withColumn("_s", s).withColumn("_ss", ss)
    nn = F.col(f"{prefix}_n")
    u = (u.withColumn(f"{prefix}_mean", mean_of(nn, F.col("_s")))
          .withColumn(f"{prefix}_std", std_of(nn, F.col("_s"), F.col("_ss"))))
    drop = ["_cents", _T, _B, _SELF, tt, "_s", "_ss", "_pn", "_ps", "_pss", "_bn", "_bs", "_bss"]
    return u.drop(*drop)


def bucketed_frames(df: DataFrame, key: str, ts_col: str, bucket_us: int,
                    count_frame_us: int | None = None, count_name: str = "frame_count",
                    minmax_col: str | None = None, minmax_frame_us: int | None = None,
                    min_name: str = "frame_min", max_name: str = "frame_max") -> DataFrame:
    """Row count over ``[ts - count_frame, ts]`` and min/max of ``minmax_col``
    over ``[ts - minmax_frame, ts]`` within ``key`` (RANGE semantics: equal
    timestamps included), with no partition larger than one bucket of a key.

    Each frame is the union of three parts, all at bucket granularity (the
    frames must be whole numbers of buckets):

    * the fully covered buckets before the current one -- a per-(key, bucket)
      aggregate (combined map-side) and a sliding window over those rows,
      one row per key and bucket;
    * the current bucket up to ``ts`` -- a running window in partition
      (key, bucket);
    * the oldest, partly covered bucket -- its rows are copied forward by the
      frame length (narrow: time and value only) into the partition of the
      current bucket. Those at or after ``ts`` are still inside: their count is
      the bucket's total less a running count of the copies before ``ts``,
      their min/max a running one over the descending order. All frames are
      running ones, so a bucket costs time in proportion to its rows.

    A key holding a third of the data is spread over one task per bucket
    (a minute by default for the card rules) instead of one task per key.
    """
    if count_frame_us is None and minmax_col is None:
        raise ValueError("nothing to compute")
    for f in (count_frame_us, minmax_frame_us if minmax_col else None):
        if f is not None and (f % bucket_us or f < bucket_us):
            raise ValueError("frames must be whole numbers of buckets")
    base = (df.withColumn(_T, epoch_micros(ts_col))
              .withColumn(_B, F.floor(F.col(_T) / F.lit(bucket_us))))
    kc = count_frame_us // bucket_us if count_frame_us is not None else None
    km = minmax_frame_us // bucket_us if minmax_col else None

    # fully covered buckets: per-bucket partials, then a window over buckets
    part_aggs = []
    if kc is not None:
        part_aggs.append(F.count(F.lit(1)).alias("_pn"))
    if km is not None:
        part_aggs += [F.min(minmax_col).alias("_pmin"), F.max(minmax_col).alias("_pmax")]
    parts = base.groupBy(key, _B).agg(*part_aggs)
    wb = Window.partitionBy(key).orderBy(_B)
    full = [parts[key], parts[_B]]
    if kc is not None:
        full.append((F.sum("_pn").over(wb.rangeBetween(-(kc - 1), -1)) if kc > 1 else F.lit(None)).alias("_fn"))
        full.append(F.sum("_pn").over(wb.rangeBetween(-kc, -kc)).alias("_en"))
    if km is not None:
        fr = wb.rangeBetween(-(km - 1), -1) if km > 1 else None
        full += [(F.min("_pmin").over(fr) if fr is not None else F.lit(None)).alias("_fmin"),
                 (F.max("_pmax").over(fr) if fr is not None else F.lit(None)).alias("_fmax")]
    full = parts.select(*full)

    # own rows, plus the oldest bucket's rows moved forward by each frame
    order, kind = "_o", "_kind"
    u = base.withColumn(order, F.col(_T)).withColumn(kind, F.lit(0))
    copies = []        # (bucket, order, kind, value) of each forward copy; one scan emits all
    mv_type = base.schema[minmax_col].dataType if km is not None else "string"
    if kc is not None:
        copies.append(F.struct((F.col(_B) + kc).alias(_B), (F.col(_T) + count_frame_us).alias(order),
                               F.lit(1).alias(kind), F.lit(None).cast(mv_type).alias("_mv")))
    if km is not None:
        copies.append(F.struct((F.col(_B) + km).alias(_B), (F.col(_T) + minmax_frame_us).alias(order),
                               F.lit(2).alias(kind), F.col(minmax_col).alias("_mv")))
    fwd = base.select(key, F.inline(F.array(*copies)))
    if km is not None:      # a NULL value cannot change a min/max: no copy
        fwd = fwd.filter((F.col(kind) != 2) | F.col("_mv").isNotNull())
    u = u.unionByName(fwd, allowMissingColumns=True)
    w = Window.partitionBy(_B, key).orderBy(order)      # a number sorts first
    upto = w.rangeBetween(Window.unboundedPreceding, 0)
    before = w.rangeBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy(_B, key).orderBy(F.col(order).desc()).rangeBetween(Window.unboundedPreceding, 0)
    own = F.col(kind) == 0
    extra = []
    if kc is not None:
        extra += [F.count(F.when(own, F.lit(1))).over(upto).alias("_rn"),
                  F.count(F.when(F.col(kind) == 1, F.lit(1))).over(before).alias("_gone")]
    if km is not None:
        extra += [F.min(F.when(own, F.col(minmax_col))).over(upto).alias("_rmin"),
                  F.max(F.when(own, F.col(minmax_col))).over(upto).alias("_rmax"),
                  F.min(F.when(F.col(kind) == 2, F.col("_mv"))).over(onward).alias("_emin"),
                  F.max(F.when(F.col(kind) == 2, F.col("_mv"))).over(onward).alias("_emax")]
    u = u.select("*", *extra).filter(own).join(full, on=[key, _B], how="left")
    if kc is not None:
        u = u.withColumn(count_name, F.coalesce("_fn", F.lit(0)) + F.col("_rn")
                         + F.coalesce("_en", F.lit(0)) - F.col("_gone"))
    if km is not None:
        u = (u.withColumn(min_name, F.least("_fmin", "_rmin", "_emin"))
              .withColumn(max_name, F.greatest("_fmax", "_rmax", "_emax")))
    names = ([count_name] if kc is not None else []) + ([min_name, max_name] if km is not None else [])
    return u.select(*df.columns, *names)
