"""Order statistics, positions and running totals without a one-task sort.

A window without a partition key, an exact ``percentile`` or a running sum over
one group puts all of its rows into one task.  The functions here give the same
exact answers from pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from shelfline.functions.joins import null_safe_join
from shelfline.session import materialize

# Buckets per unit of log1p(|value|).  Values up to 10 million need at most 265 thousand
# buckets, and the largest double 12 million, so a table of bucket counts has a fixed bound.
_BUCKETS_PER_UNIT = 16384


def value_bucket(value: str) -> str:
    """SQL for a bucket number of a double that never falls as the value rises.

    ``log1p`` is semi-monotonic by its specification, so values in different
    buckets are ordered as their buckets are.
    """
    return f"CAST(signum({value}) * floor(log1p(abs({value})) * {_BUCKETS_PER_UNIT}) AS BIGINT)"


def _number(column: str) -> str:
    """SQL for a column as a double without NaN."""
    value = f"CAST({column} AS DOUBLE)"
    return f"CASE WHEN NOT isnan({value}) THEN {value} END"


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def order_statistics(
    df: DataFrame, picks: Mapping[str, Mapping[str, str]], by: Sequence[str] = (), group_limit: int = 1_000_000
) -> DataFrame:
    """Exact values at given positions of sorted columns.

    ``picks`` maps a column to labelled rules; a rule is SQL that turns the
    number of non-null values ``n`` into a 0-based position.  The result has one
    row per (``by``, ``column``, ``label``) with ``value``, and the ``total`` it was taken from.

    First pass: counts per value bucket (combined before the shuffle, so at most
    the bucket bound leaves each task) give the bucket that holds each position.
    Second pass: only values in those buckets are counted and searched.  A bucket
    with more than ``group_limit`` rows, such as one that values packed closely
    share, is searched along a range sort of its distinct values instead of in
    one task.  The first pass runs when this is called; with ``by`` it writes
    down the columns it needs, so that the input is read once.
    """
    by = list(by)
    columns = list(picks)
    if by:
        df = materialize(df.selectExpr(*by, *[f"{_number(c)} AS {c}" for c in columns]))
    values = (
        df.selectExpr(*by, *[f"{_number(c)} AS {c}" for c in columns])
        .unpivot(by, columns, "column", "value")
        .filter("value IS NOT NULL")
        .withColumn("bucket", F.expr(value_bucket("value")))
    )
    group = [*by, "column"]
    in_group = f"OVER (PARTITION BY {', '.join(group)}"
    cases = " ".join(
        f"WHEN {_text(c)} THEN array("
        + ", ".join(f"named_struct('label', {_text(k)}, 'idx', CAST({rule} AS BIGINT))" for k, rule in rules.items())
        + ")"
        for c, rules in picks.items()
    )
    located = (
        values.groupBy(*group, "bucket").agg(F.count("*").alias("_count"))
        .selectExpr(
            *group, "bucket", f"sum(_count) {in_group}) AS n", f"sum(_count) {in_group} ORDER BY bucket) AS upto",
            f"sum(_count) {in_group} ORDER BY bucket) - _count AS before", "_count",
        )
        .selectExpr(
            *group, "bucket", "before", "n AS total", "_count",
            f"filter(CASE column {cases} END, t -> t.idx >= before AND t.idx < upto) AS wanted",
        )
        .filter("size(wanted) > 0")
    )

    key = [*group, "bucket"]
    if by:
        located = materialize(located)
        largest = located.agg(F.max("_count")).first()[0] or 0
        counted = null_safe_join(values, located.select(*key), key, "left_semi").groupBy(*key, "value").agg(F.count("*").alias("n"))
        picked = located.selectExpr(*key, "before", "total", "inline(wanted)")
    else:
        rows = located.collect()  # at most one per pick
        largest = max((r["_count"] for r in rows), default=0)
        counted = _values_in_buckets(df, {c: [r["bucket"] for r in rows if r["column"] == c] for c in columns})
        picked = F.broadcast(_picked_table(df.sparkSession, rows))
    if largest <= group_limit:
        counted = counted.withColumn("upto", F.expr(f"sum(n) OVER (PARTITION BY {', '.join(key)} ORDER BY value)"))
    else:
        counted = _sorted_total(counted, "n", [F.col("value")], key, "upto")
    return (
        (null_safe_join(counted, picked, key) if by else counted.join(picked, key))
        .filter("idx < before + upto AND idx >= before + upto - n")
        .select(*group, "label", "value", "total")
    )


def _values_in_buckets(df: DataFrame, buckets: Mapping[str, Sequence[int]]) -> DataFrame:
    """Counts of the distinct values that lie in a few buckets of each column."""
    def hits(c: str, found: Sequence[int]) -> str:
        value = _number(c)
        chosen = f"{value_bucket(value)} IN ({', '.join(f'{b}L' for b in found)})" if found else "FALSE"
        return f"CASE WHEN {chosen} THEN {value} END AS {c}"

    return (
        df.selectExpr(*[hits(c, found) for c, found in buckets.items()])
        .unpivot([], list(buckets), "column", "value")
        .filter("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
        .withColumn("bucket", F.expr(value_bucket("value")))
    )


def _picked_table(spark: SparkSession, rows: Sequence[Row]) -> DataFrame:
    """The located picks as an inline table."""
    values = [
        f"({_text(r['column'])}, {r['bucket']}L, {r['before']}L, {r['total']}L, {_text(t['label'])}, {t['idx']}L)"
        for r in rows for t in r["wanted"]
    ]
    table = f"VALUES {', '.join(values) or '(NULL, 0L, 0L, 0L, NULL, 0L)'} AS t(column, bucket, before, total, label, idx)"
    return spark.sql(f"SELECT CAST(column AS STRING) AS column, bucket, before, total, CAST(label AS STRING) AS label, idx FROM {table}")


def quantile_position(q: float, n: str = "n") -> str:
    return f"{float(q)}D * ({n} - 1)"


def quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one column ``<column>_q<percent>`` each.

    Without ``by`` the result is one row, also for an empty input (all NULL).
    """
    picks = {
        c: {f"{q} {side}": f"{side}({quantile_position(q)})" for q in qs for side in ("floor", "ceil")}
        for c, qs in wanted.items()
    }

    def side(c: str, q: float, name: str) -> str:
        return f"max(CASE WHEN column = {_text(c)} AND label = {_text(f'{q} {name}')} THEN value END)"

    out = []
    for c, qs in wanted.items():
        n = f"max(CASE WHEN column = {_text(c)} THEN total END)"
        for q in qs:
            low, high, at = side(c, q, "floor"), side(c, q, "ceil"), quantile_position(q, n)
            out.append(F.expr(f"{low} + ({high} - {low}) * ({at} - floor({at}))").alias(quantile_name(c, q)))
    return order_statistics(df, picks, by).groupBy(*by).agg(*out)


def quantile_name(column: str, q: float) -> str:
    return f"{column}_q{q * 100:g}".replace(".", "_")


def approximate_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], accuracy: int = 10000) -> DataFrame:
    """The same columns from one pass of bounded sketches; off by at most n / accuracy positions."""
    return df.agg(*[
        F.percentile_approx(F.col(c).cast("double"), float(q), accuracy).alias(quantile_name(c, q))
        for c, qs in wanted.items()
        for q in qs
    ])


_OFFSET_BITS = 33


def _sorted_with_marks(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Globally sorted rows with their sorted partition ``_part`` and offset ``_idx`` in it.

    The marks come from one run whose result is written down, so later branches
    agree on them even if a lost executor has to recompute something.
    """
    marked = materialize(df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id()))
    return marked.select(
        "*",
        F.shiftright("_mark", _OFFSET_BITS).alias("_part"),
        F.col("_mark").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)).alias("_idx"),
    ).drop("_mark")


def with_position(
    df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """0-based position of each row in ``order``, within ``by``.

    A range sort balances the rows over partitions whatever the keys are, so one
    hot group spreads over many tasks.  A position is the offset in the sorted
    partition plus the size of the partitions before it, minus the group's first
    position.  ``order`` must be total for a repeatable result.
    """
    columns = df.columns
    rows = _sorted_with_marks(df, [*[F.col(c) for c in by], *order])
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    # one row per sorted partition, so at most spark.sql.shuffle.partitions rows
    rows = rows.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_idx"))
    if by:
        first = rows.groupBy(*by).agg(F.min(name).alias("_first"))
        same = [rows[c].eqNullSafe(first[c]) for c in by]
        rows = rows.join(first, same).withColumn(name, F.col(name) - F.col("_first")).drop(*[first[c] for c in by])
    return rows.select(*columns, name)


def running_total(
    df: DataFrame,
    value: str,
    order: Sequence[Column],
    by: Sequence[str],
    name: str = "running",
    group_limit: int = 1_000_000,
) -> DataFrame:
    """Sum of ``value`` over the rows up to and including each row, within ``by``.

    The largest group is counted first.  Up to ``group_limit`` rows a plain window
    does; beyond it the groups are cut along a global range sort, each piece is
    summed on its own and shifted by the pieces before it.
    """
    largest = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if largest <= group_limit:
        upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(value).over(upto))
    return _sorted_total(df, value, order, by, name)


def _sorted_total(df: DataFrame, value: str, order: Sequence[Column], by: Sequence[str], name: str) -> DataFrame:
    """``running_total`` along a range sort: no task holds more than a sorted partition of a group."""
    rows = _sorted_with_marks(df, [*[F.col(c) for c in by], *order])
    piece = [*by, "_part"]
    upto = Window.partitionBy(*piece).orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in_piece", F.sum(value).over(upto))
    sums = rows.groupBy(*piece).agg(F.sum(value).alias("_sum"))
    # a group has one row per sorted partition that it touches
    before = F.sum("_sum").over(
        Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sums.select(*piece, F.coalesce(before, F.lit(0)).alias("_start"))
    return null_safe_join(rows, starts, piece).withColumn(name, F.col("_start") + F.col("_in_piece")).select(*df.columns, name)


def counts_upto(
    df: DataFrame, column: str, probes: DataFrame, probe: str, by: Sequence[str] = (), group_limit: int = 1_000_000
) -> DataFrame:
    """For each distinct probe: how many values of ``column`` are at most that, and how many there are.

    Values are first counted per distinct value; values and probes are then merged
    in order and summed along it, so any number of probes costs one pass.
    """
    by = list(by)
    kind = "double"
    # the counts feed the running total, its size check and the totals
    values = materialize(
        df.filter(F.col(column).isNotNull())
        .groupBy(*by, F.col(column).cast(kind).alias("_point"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_probe", F.lit(0))
    )
    asked = (
        probes.filter(F.col(probe).isNotNull())
        .select(*by, F.col(probe).cast(kind).alias("_point"))
        .distinct()
        .withColumns({"_n": F.lit(0).cast("long"), "_probe": F.lit(1)})
    )
    merged = values.unionByName(asked)
    group = by
    if not by:
        merged, group = merged.withColumn("_all", F.lit(0)), ["_all"]
    summed = running_total(merged, "_n", [F.col("_point"), F.col("_probe")], group, "count_upto", group_limit)
    totals = values.groupBy(*by).agg(F.sum("_n").alias("total"))
    found = summed.filter("_probe = 1").select(*by, F.col("_point").alias(probe), "count_upto")
    if by:
        return null_safe_join(found, totals, by, "left").fillna(0, ["total"])
    return found.withColumn("total", F.coalesce(totals.scalar(), F.lit(0)))
