"""Order-dependent dedupe, capped pages and resume anti joins
(W1, W3, W4, S11, J1, J2, A10).

Order-dependent semantics ("first wins") need explicit position columns
carried from the source operators: they become ``row_number`` orderings, cut map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.keys import with_spread_key
from lodestar.operators.records import truthy


def first_wins(df: DataFrame, key: str, order) -> DataFrame:
    """Keep the first row per non-null ``key`` by ``order``; rows with a
    null key are never deduped.  Filter invalid rows *before* calling: an
    invalid row must not claim its key.

    One pass: a row without a key is a group of its own, and
    ``row_number() <= 1`` plans as a WindowGroupLimit, so each map task passes
    on at most one row per key."""
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    w = Window.partitionBy(key, "__alone__").orderBy(*[F.col(c) for c in order])
    return (df.withColumn("__alone__", alone).withColumn("__rn__", F.row_number().over(w))
            .where(F.col("__rn__") <= 1).drop("__rn__", "__alone__"))


def first_n_per_group(df: DataFrame, group: str, order, n: int) -> DataFrame:
    """First ``n`` rows per group.  ``row_number() <= n`` plans as a
    WindowGroupLimit, so each map task keeps at most ``n`` rows per group
    before the shuffle (a hot group costs n x tasks rows, not its size)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__rn__", F.row_number().over(w)).where(F.col("__rn__") <= n).drop("__rn__")


def cut_pages(items: DataFrame, group: str, page_col: str, pos_col: str, total: int | None = None,
              page_sizes: DataFrame | None = None) -> DataFrame:
    """S11 + W3: pages are read in ``page_col`` order until ``total`` rows (all
    if it is None) or the first empty page; rows after the cut are dropped.
    The cut by rows comes first: it leaves the same rows, as both follow the
    page order, and only ``total`` rows a group reach the join.

    ``page_sizes`` ``(group, page_col, n)`` lists every fetched page with its
    item count (empty pages have no item rows); when given, pages at or after
    the first empty page are dropped."""
    if total is not None:
        items = first_n_per_group(items, group, [F.col(page_col), F.col(pos_col)], total)
    if page_sizes is not None:
        stop = (page_sizes.where(F.col("n") == 0).groupBy(group)
                .agg(F.min(page_col).alias("__stop__")))
        items = (items.join(stop, group, "left")
                 .where(F.col("__stop__").isNull() | (F.col(page_col) < F.col("__stop__")))
                 .drop("__stop__"))
    return items


def cross_group_dedupe(df: DataFrame, key: str, order, group: str | None = None,
                       strict_parity: bool = False) -> DataFrame:
    """One row per ``key``, the first by ``order`` (e.g. category index,
    page, position).  ``strict_parity`` keeps the contract's quirk (D2):
    duplicates *inside* the first group that has the key all survive."""
    if not strict_parity:
        return first_wins(df, key, order)
    first = df.groupBy(key).agg(F.min(group).alias("__g__"))
    return (df.join(first, key, "left")
            .where(F.col(key).isNull() | (F.col(group) == F.col("__g__"))).drop("__g__"))


def seen_keys(done: DataFrame, key) -> DataFrame:
    """A10: distinct non-empty keys of the sink (empty/null keys never count)."""
    k = F.col(key) if isinstance(key, str) else key
    return done.select(k.alias("__k__")).where(truthy("__k__")).distinct()


def resume_anti(new: DataFrame, done: DataFrame, key: str, done_key=None) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``done``.  A null key is
    never "done", so such rows are kept (``left_anti`` keeps null keys)."""
    seen = seen_keys(done, done_key if done_key is not None else key)
    seen = seen.withColumn("__k__", F.col("__k__").cast("string"))
    keyed = with_spread_key(new, "__key__", F.col(key))
    return keyed.join(seen, F.col("__key__") == F.col("__k__"), "left_anti").drop("__key__")
