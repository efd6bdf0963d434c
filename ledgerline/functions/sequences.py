"""Previous-row values and row numbers within a key, without sending a whole key to one task.

``lag`` over ``Window.partitionBy(key)`` sorts every row of a key in one task; one applicant key (an all-zero or
unknown ID) can hold a large share of all rows.  ``ordered_lag`` is a distributed prefix scan instead:

1. the rows are range-partitioned once by (key, order), so a part holds a run of the order, whatever the keys;
2. inside a part the previous row of the key is an ordinary window function over (part, key);
3. every part hands over its last row alone: one row a part, shifted by one part and joined back to the first row of each key.

``ordered_row_number`` cuts a key into pieces by a leading order column and adds up the pieces' row counts.
Both equal the window function over the whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Order = Sequence[tuple[str, bool]]  # (column, ascending)


def _sort_key(types: dict[str, T.DataType], cols: Order, at: str = "") -> Column:
    """A struct whose ascending order equals the given order, NULLs placed as Spark places them (first when ascending,
    last when descending).  Descending columns must be numeric or dates; others raise here."""
    parts = []
    for i, (c, asc) in enumerate(cols):
        x = F.col(at + c)
        if not asc:
            if isinstance(types[c], T.DateType):
                x = -F.datediff(x, F.lit("1970-01-01").cast("date"))
            elif isinstance(types[c], T.NumericType):
                x = -x
            else:
                raise TypeError(f"descending order needs a number or a date, {c} is {types[c].simpleString()}")
        nulls = F.when(F.col(at + c).isNull(), F.lit(0 if asc else 1)).otherwise(F.lit(1 if asc else 0))
        parts += [nulls.alias(f"n{i}"), x.alias(f"v{i}")]
    return F.struct(*parts)


def _order(cols: Order) -> list[Column]:
    return [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last() for c, a in cols]


def _piece(keys: Sequence[str], levels: Sequence[Order]) -> Column:
    """A piece as one struct: structs compare NULL fields as equal, so they partition and join null-safely."""
    return F.struct(*[F.col(c) for c in [*keys, *[c for level in levels for c, _ in level]]])


def ordered_lag(df: DataFrame, keys: Sequence[str], levels: Sequence[Order], rest: Order, lag_cols: Sequence[str],
                prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same key, rows ordered by all ``levels`` (orders of
    columns, the outermost first) then ``rest``, which should end in a unique column: rows of equal order share a part.

    NULL keys are one key.  There are as many parts as shuffle partitions, each one task's; their last rows (one row a
    part) are broadcast."""
    types = {f.name: f.dataType for f in df.schema.fields}
    order = [*[x for level in levels for x in level], *rest]
    line = [(k, True) for k in keys] + order
    ranged = df.repartitionByRange(*_order(line)).withColumn("_part", F.spark_partition_id())
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = Window.partitionBy("_part", *keys).orderBy(*_order(order))
    staged = ranged.repartitionById(width, "_part").withColumns({**{f"{prefix}{c}": F.lag(c).over(w) for c in lag_cols}, "_first": F.row_number().over(w) == 1})
    last = F.struct(F.struct(*keys).alias("key"), F.struct(*[F.col(c).alias(c) for c in lag_cols]).alias("row"))
    ends = ranged.groupBy("_part").agg(F.max_by(last, _sort_key(types, line)).alias("_end"))
    ends = ends.agg(F.array_sort(F.collect_list(F.struct("_part", "_end"))).alias("_ends"))
    carry = ends.select(F.inline(F.transform("_ends", lambda x, i: F.struct(
        x["_part"].alias("_at"), F.when(i > 0, F.get("_ends", i - 1)["_end"]).alias("_carry")))))
    joined = staged.join(F.broadcast(carry), F.col("_part") == F.col("_at"), "left")
    over = F.col("_first") & F.col("_carry.key").eqNullSafe(F.struct(*keys))
    return joined.withColumns({
        f"{prefix}{c}": F.when(over, F.col(f"_carry.row.{c}")).otherwise(F.col(f"{prefix}{c}")) for c in lag_cols
    }).select(*df.columns, *[f"{prefix}{c}" for c in lag_cols])


def ordered_row_number(df: DataFrame, keys: Sequence[str], level: Order, rest: Order, out: str = "row_no",
                       counted: dict[str, Column] | None = None) -> DataFrame:
    """Add ``out`` = row number within the key, rows ordered by ``level`` then ``rest``: the rows of the key's preceding
    pieces and the row number inside the piece.  ``counted``: name -> condition; adds the number of the key's rows that
    meet it.

    A piece's counts stand in its last row, so they take the sort of the numbering and no table of the pieces."""
    counted = counted or {}
    dealt = df.withColumn("_piece", _piece(keys, [level])).repartition("_piece")
    inside = Window.partitionBy("_piece").orderBy(*_order(rest))
    sofar = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = dealt.withColumn("_inside", F.row_number().over(inside))
    ends = dealt.select("_piece", F.row_number().over(inside).alias("_n"), F.lead(F.lit(1)).over(inside).isNull().alias("_last"),
                        *[F.count(F.when(c, 1)).over(sofar).alias(n) for n, c in counted.items()])
    ends = ends.filter("_last").select("_piece.*", "_piece", "_n", *counted)
    by_level = Window.partitionBy(*keys).orderBy(*_order(level))
    w, whole = (by_level.rowsBetween(Window.unboundedPreceding, to) for to in (-1, Window.unboundedFollowing))
    before = ends.select("_piece", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"), *[F.sum(n).over(whole).alias(n) for n in counted])
    return staged.join(before, "_piece", "left").select(
        *df.columns, (F.col("_before") + F.col("_inside")).cast("int").alias(out), *counted)
