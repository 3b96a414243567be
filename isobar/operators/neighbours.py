"""Earlier values in a long ordered sequence, cut into blocks that run in parallel.

A window over a whole location puts its history into one task. Here the sequence is cut into blocks that are contiguous
in its order. A block's rows become one sorted array, so that looking back inside the block is a shift of
that array; only the last values of each block are ordered across blocks, and put before the next one's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_earlier(
    df: DataFrame, key: str, block: list[str], order: list[str], value: str, n: int
) -> DataFrame:
    """Add ``before_1`` .. ``before_n``: the values 1 .. n rows earlier within ``key``.

    Rows are ordered by ``block`` and then ``order``. Columns that do not exist for the first rows are NULL, as with LAG.
    Detail rows are shuffled and sorted once: the blocks and their tails come from one exchange.
    """
    others = [name for name in df.columns if name not in (key, *block, *order, value)]
    blocks = df.groupBy(key, *block).agg(F.sort_array(F.collect_list(F.struct(*order, *others, value))).alias("_rows"))
    values = F.col("_rows")[value]
    tails = blocks.select(key, *block, F.slice(values, F.greatest(F.size(values) - F.lit(n - 1), F.lit(1)), F.lit(n)).alias("_tail"))
    # The n blocks before hold at least n rows between them, unless the sequence starts there.
    earlier = W.partitionBy(key).orderBy(*block).rowsBetween(-n, -1)
    none = F.array_repeat(F.lit(None).cast(df.schema[value].dataType), n)
    carried = tails.select(
        key, *block, F.slice(F.concat(none, F.flatten(F.collect_list("_tail").over(earlier))), -n, n).alias("_carried")
    )
    joined = blocks.join(carried, [key, *block], "left")
    long = F.concat(F.coalesce("_carried", none), values)
    before = [F.slice(long, F.lit(n - k + 1), F.size("_rows")).alias(f"before_{k}") for k in range(1, n + 1)]
    rows = joined.select(key, *block, F.inline(F.arrays_zip(F.col("_rows"), *before)))
    return rows.select(key, *block, "_rows.*", *[f"before_{k}" for k in range(1, n + 1)]).select(
        *df.columns, *[f"before_{k}" for k in range(1, n + 1)]
    )
