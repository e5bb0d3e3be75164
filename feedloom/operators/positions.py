"""Row positions, batch numbers and first-N per group without unpartitioned windows.

A plain ``row_number()`` over ``Window.partitionBy(file)`` puts a whole file
(or a whole hot product) into one task.  Here positions are computed the way
a distributed "zip with index" works:

1. range-partition on (group, order) so a hot group is spread over many tasks,
2. sort inside each partition and tag rows with ``monotonically_increasing_id``
   (partition id in the high bits, row offset in the low bits),
3. count rows per (partition, group) -- a table of at most groups + partitions rows,
4. prefix-sum those counts per group in partition order,
5. join the offsets back on (partition, group) and add the in-partition offset.

First-N per group uses a salted two-stage ``row_number``: stage one ranks
within (group, salt) so a hot group is split over many tasks, stage two
ranks the at most N * salts survivors.  Both are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import ensure_checkpoint_dir


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def group_positions(df: DataFrame, group: list[str], order: list, name: str = "pos",
                    base: int = 0, partitions: int | None = None) -> DataFrame:
    """Exact 0-based (or ``base``-based) position of each row inside its group, by ``order``."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(group) + _cols(order)
    d = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__mid", F.monotonically_increasing_id()))
    # Both branches below must see the same partitions: pruned differently they would be sampled and
    # cut at different bounds, so the tagged frame is written once to the shared checkpoint folder.
    ensure_checkpoint_dir(spark)
    d = d.checkpoint(eager=True)
    gk = ["__pid"] + list(group)
    summary = d.groupBy(*gk).agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__m0"))
    w = (Window.partitionBy(*group) if group else Window.partitionBy()).orderBy("__pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    side = summary.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(gk)], "__off", "__m0")
    same = [F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(gk)]
    out = d.join(side, same, "inner").drop(*[f"__g{i}" for i in range(len(gk))])
    return out.withColumn(name, F.col("__off") + F.col("__mid") - F.col("__m0") + F.lit(base)) \
        .drop("__pid", "__mid", "__off", "__m0")


def global_positions(df: DataFrame, order: list, name: str = "pos", base: int = 0) -> DataFrame:
    """Position of each row in a total order (no single-task window)."""
    return group_positions(df, [], order, name=name, base=base)


def rank_slice(df: DataFrame, order: list[str], first: int, last: int, name: str = "pos", base: int = 1,
               target: int = 500_000, buckets: int = 32) -> DataFrame:
    """The rows whose position in a total order lies in ``first`` to ``last`` (from ``base``), with that position.

    Nothing but the range that holds these ranks is sorted.  A small sample cuts the leading column into
    ``buckets`` ranges, their row counts tell which of them hold the ranks, and the same is done within these
    until at most ``target`` rows are left; each round reads the order columns of the rows still in question
    only (the range is a pushed filter).  Where one value of the leading column holds more rows than that, the
    rows of the range get their positions by a distributed sort.  The order must be unique up to equal rows.
    """
    lead, a, z = F.col(order[0]), first - base, last - base
    before, size, keep = 0, None, None  # rows before the range, in it, and the range as a condition
    while True:
        part = df if keep is None else df.where(keep)
        picks = sorted(r[0] for r in part.where(lead.isNotNull()).select(lead, F.xxhash64(*order).alias("__h"))
                       .orderBy("__h").limit(64 * buckets).collect())
        cuts = sorted({picks[i * len(picks) // buckets] for i in range(1, buckets)}) if picks else []
        place = F.when(lead.isNull(), F.lit(-1)).otherwise(sum([(lead >= F.lit(c)).cast("int") for c in cuts], F.lit(0)))
        counts = sorted((r[0], r[1]) for r in part.groupBy(place.alias("b")).agg(F.count(F.lit(1))).collect())  # at most buckets + 1 rows
        at, chosen = before, []
        for b, n in counts:
            if at + n > a and at <= z:
                chosen.append((b, at, n))
            at += n
        if not chosen:
            return df.limit(0).withColumn(name, F.lit(0).cast("long"))
        lo, hi, rows = chosen[0][0], chosen[-1][0], sum(n for *_, n in chosen)
        narrower = F.lit(True) if lo < 0 else lead.isNotNull()
        if lo > 0:
            narrower = narrower & (lead >= F.lit(cuts[lo - 1]))
        if hi < 0:
            narrower = lead.isNull()
        elif hi < len(cuts):
            narrower = narrower & (lead.isNull() | (lead < F.lit(cuts[hi])) if lo < 0 else lead < F.lit(cuts[hi]))
        keep = narrower if keep is None else keep & narrower
        before, stuck, size = chosen[0][1], rows == size, rows
        if size <= target or stuck:
            break
    part = df.where(keep)
    if size <= target:
        placed = part.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long") + F.lit(before + base - 1))
    else:
        placed = global_positions(part, order, name=name, base=before + base)
    return placed.where(F.col(name).between(first, last))


def assign_batches(df: DataFrame, group: list[str], order: list, batch_size: int,
                   pos: str = "pos") -> DataFrame:
    """Consecutive rows of a group in batches of ``batch_size``, numbered from 0."""
    d = group_positions(df, group, order, name=pos)
    return d.withColumn("batch_number", F.floor(F.col(pos) / F.lit(batch_size)).cast("bigint"))


def first_n_per_group(df: DataFrame, group: list[str], order: list, n: int,
                      tiebreak: list[str] | None = None, salts: int = 32) -> DataFrame:
    """The first ``n`` rows of each group by ``order`` (ties broken by ``tiebreak``)."""
    order_cols = _cols(order) + _cols(tiebreak or [])
    salt_src = tiebreak or [c for c in df.columns if c not in group]
    d = df.withColumn("__salt", F.pmod(F.xxhash64(*salt_src), F.lit(salts)))
    w1 = Window.partitionBy(*group, "__salt").orderBy(*order_cols)
    d = d.withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= n)
    w2 = Window.partitionBy(*group).orderBy(*order_cols)
    return d.withColumn("__r", F.row_number().over(w2)).filter(F.col("__r") <= n).drop("__salt", "__r")


def keep_first(df: DataFrame, key: list[str], order: list, tiebreak: list[str] | None = None) -> DataFrame:
    """One row per key, the first by ``order`` (conflict semantics of insert-ignore).

    The filter on ``row_number`` is applied within each task before the exchange (a window group
    limit), so a key that holds a third of the rows crosses it with one row a task.
    """
    w = Window.partitionBy(*key).orderBy(*_cols(order), *_cols(tiebreak or []))
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1).drop("__r")


def first_by_aggregate(df: DataFrame, group: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """W5 for flat tables: first child per parent via ``min_by`` (partial aggregation, skew-safe).

    ``order`` should make the choice unique (add tiebreak columns)."""
    s = F.struct(*[F.col(c) for c in cols])
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*group).agg(F.min_by(s, o).alias("__f")).select(*group, "__f.*")


def file_positions(scan: DataFrame, name: str = "row_position", scans: str | None = None) -> DataFrame:
    """Row position inside each source file, in file order, for a text/CSV scan.

    ``scan`` must carry ``file_path`` and ``block_start`` (from ``_metadata``) and is tagged
    here with ``monotonically_increasing_id`` right at the scan, where rows are still in file
    order.  Counts per (file, block) form a small table whose prefix sums give each block's
    offset; a big file is therefore never funnelled through one task.  That table has one row an input split (the
    listing that the driver plans the scan from has as many), so it is broadcast and the rows stay where they were read.  Where a file is scanned more than
    once (one record tag a scan), ``scans`` names the column that tells these scans apart: positions then run
    through one scan after the other.
    """
    d = scan.withColumn("__mid", F.monotonically_increasing_id())
    extra = [scans] if scans else []
    keys = ["file_path", *extra, "block_start"]
    blocks = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__m0"))
    w = Window.partitionBy("file_path").orderBy(*extra, "block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    j = d.join(F.broadcast(blocks.select(*keys, "__off", "__m0")), keys)
    return j.withColumn(name, F.col("__off") + F.col("__mid") - F.col("__m0")).drop("__mid", "__off", "__m0")
