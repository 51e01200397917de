"""The marts kept up to date batch by batch: mergeable sums and exact distinct sets in place of a full rebuild.

A mart's state is a folder of Parquet files in slots of its keys.  A batch of
feature rows is reduced to sums per key, merged with the slots that it touches, and only
these are written anew.  A slot knows the last batch it took, so a batch that is
repeated after a failure, even one that had written some of its slots, counts once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.functions.columns import round_half_up
from shelfline.functions.ordering import with_position
from shelfline.session import COMPRESSION, materialize, scratch_scope

SLOTS = 64


@dataclass(frozen=True)
class MartState:
    """What a mart keeps, in SQL: ``keys``, additive ``sums`` (name: aggregate and type) and ``sets`` of ids (name: column)."""

    keys: Mapping[str, str]
    sums: Mapping[str, tuple[str, str]]
    result: Callable[[DataFrame], DataFrame]
    sets: Mapping[str, str] = field(default_factory=dict)
    slot: str | None = None  # of the keys; by their hash unless given


def _units(condition: str) -> tuple[str, str]:
    return f"sum(CASE WHEN {condition} THEN units_sold ELSE 0 END)", "long"


def _risk(level: str) -> tuple[str, str]:
    return f"count_if(stockout_risk = '{level}')", "long"


_ROWS = ("count(*)", "long")
_UNITS = ("sum(units_sold)", "long")
_UNITS_KNOWN = ("count(units_sold)", "long")
_REVENUE = ("sum(revenue)", "decimal(38,2)")
_VOLATILITY = {"volatility": ("sum(demand_volatility)", "double"), "volatility_known": ("count(demand_volatility)", "long")}
_RATIO = {"ratio": ("sum(price_ratio)", "double"), "ratio_known": ("count(price_ratio)", "long")}


def _mean(total: str, known: str) -> Column:
    return F.try_divide(F.col(total).cast("double"), F.col(known))


def _category(state: DataFrame) -> DataFrame:
    return state.select(
        "category", "total_records", "total_units", "total_revenue", _mean("total_units", "units_known").alias("avg_daily_demand"),
        _mean("volatility", "volatility_known").alias("avg_volatility"), "high_stockout_count",
        round_half_up(F.try_divide("promo_units", F.nullif("regular_units", F.lit(0))), 4).alias("promo_demand_lift"))


def _regional(state: DataFrame) -> DataFrame:
    return state.select(
        "region", "month", "year", "total_units", "total_revenue", _mean("total_units", "units_known").alias("avg_demand"),
        "active_stores", "active_products")


def _stockout(min_days: int) -> Callable[[DataFrame], DataFrame]:
    def read(state: DataFrame) -> DataFrame:
        share = round_half_up(F.col("high_risk_days") / F.col("total_days") * 100, 2)
        return state.filter(F.col("total_days") > min_days).select(
            "product_id", "category", "total_days", "high_risk_days", "medium_risk_days", share.alias("stockout_frequency_pct"),
            _mean("units", "units_known").alias("avg_demand"), _mean("volatility", "volatility_known").alias("avg_volatility"))
    return read


def _promo(state: DataFrame) -> DataFrame:
    return state.select(
        "category", "is_promotion", "record_count", _mean("units", "units_known").alias("avg_demand"),
        # a mean of decimals has four places more
        F.round(F.try_divide("revenue", F.col("revenue_known").cast("decimal(20,0)")), 6).cast("double").alias("avg_revenue"), _mean("ratio", "ratio_known").alias("avg_price_ratio"))


def _daily(state: DataFrame) -> DataFrame:
    return state.select(
        "sale_date", "store_id", "region", "store_type", "num_transactions", "total_units", "total_revenue",
        _mean("total_units", "units_known").alias("avg_units"), _mean("ratio", "ratio_known").alias("avg_price_ratio"))


def mart_states(min_days: int = 30) -> dict[str, MartState]:
    """The five marts of ``marts.build_marts`` as state."""
    def columns(*names: str) -> dict[str, str]:
        return {n: n for n in names}

    return {
        "mv_daily_store_demand": MartState(
            columns("sale_date", "store_id", "region", "store_type"),
            {"num_transactions": _ROWS, "total_units": _UNITS, "units_known": _UNITS_KNOWN, "total_revenue": _REVENUE, **_RATIO},
            _daily, slot="CAST(year(sale_date) * 12 + month(sale_date) AS BIGINT)"),
        "mv_category_demand": MartState(
            columns("category"),
            {"total_records": _ROWS, "total_units": _UNITS, "units_known": _UNITS_KNOWN, "total_revenue": _REVENUE, **_VOLATILITY,
             "high_stockout_count": _risk("High"), "promo_units": _units("is_promotion = 1"),
             "regular_units": _units("is_promotion = 0")},
            _category),
        "mv_regional_demand": MartState(
            {"region": "region", "month": "month(sale_date)", "year": "year(sale_date)"},
            {"total_units": _UNITS, "units_known": _UNITS_KNOWN, "total_revenue": _REVENUE},
            _regional, {"active_stores": "store_id", "active_products": "product_id"},
            slot="CAST(year AS BIGINT)"),
        "mv_stockout_summary": MartState(
            columns("product_id", "category"),
            {"total_days": _ROWS, "high_risk_days": _risk("High"), "medium_risk_days": _risk("Medium"), "units": _UNITS,
             "units_known": _UNITS_KNOWN, **_VOLATILITY},
            _stockout(min_days)),
        "mv_promo_impact": MartState(
            columns("category", "is_promotion"),
            {"record_count": _ROWS, "units": _UNITS, "units_known": _UNITS_KNOWN, "revenue": _REVENUE,
             "revenue_known": ("count(revenue)", "long"), **_RATIO},
            _promo),
    }


def used_columns(features: DataFrame, marts: Iterable[MartState]) -> list[str]:
    """The columns of ``features`` that the states of ``marts`` are made from."""
    texts = [t for m in marts for t in (*m.keys.values(), *m.sets.values(), *(e for e, _ in m.sums.values()))]
    words = {w.lower() for t in texts for w in re.findall(r"\w+", t)}
    return [c for c in features.columns if c.lower() in words]


def _slot(mart: MartState) -> Column:
    return F.coalesce(F.expr(mart.slot), F.lit(-1)) if mart.slot else F.pmod(F.xxhash64(*mart.keys), F.lit(SLOTS))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


@scratch_scope()
def merge_slots(new: DataFrame, keys: Sequence[str], merged: Mapping[str, Column], batch: int, path: str) -> None:
    """Merges ``new`` (with ``slot``) into the stored slots it touches, by keys in which NULL is a group, and rewrites those.

    Both are dealt by slot once and merged where they are written.  A slot that is read is replaced when
    all tasks are done.
    """
    spark = new.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in new.schema}
    stored = _stored(spark, path)
    if stored is not None:
        new = materialize(new)
        touched = F.broadcast(new.select("slot").distinct())  # slots have a fixed bound, or are days or months
        before = stored.select(*new.columns, "batch").join(touched, "slot", "left_semi")
        taken = F.broadcast(before.filter(F.col("batch") >= batch).select("slot").distinct())
        new = new.unionByName(before.drop("batch")).join(taken, "slot", "left_anti")
    both = new.repartition("slot").groupBy("slot", *keys).agg(*[c.cast(kinds[name]).alias(name) for name, c in merged.items()])
    (
        both.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").option("compression", COMPRESSION)
        .option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(path)
    )


def _numbered(rows: DataFrame, ids: Sequence[str], path: str) -> dict[str, DataFrame]:
    """A number for every id of ``rows``, for good: new ids are appended with the next numbers.

    The numbers are complete before any bitmap uses them, and an id never gets another one, so a
    repeated batch finds them as they are.
    """
    spark = rows.sparkSession
    out = {}
    for column in ids:
        place = f"{path}/ids_{column}"
        fresh = rows.select(F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
        known, start = _stored(spark, place), 0
        if known is not None:
            fresh = fresh.join(known, "id", "left_anti")
            start = (known.agg(F.max("number")).first()[0] or 0) + 1
        fresh = with_position(materialize(fresh), [F.col("id")], name="number")
        fresh.select("id", (F.col("number") + start).cast("long").alias("number")).write.mode("append").parquet(place)
        out[column] = spark.read.parquet(place)
    return out


@scratch_scope()
def merge_batch(features: DataFrame, batch: int, path: str, only: Sequence[str] | None = None, min_days: int = 30) -> None:
    """Adds a batch of feature rows, late ones included, to the states of the marts under ``path``.

    Batches are numbered upwards; a number that a slot has taken is not counted again there.
    """
    chosen = {name: mart for name, mart in mart_states(min_days).items() if only is None or name in only}
    rows = features.select(*used_columns(features, chosen.values()))
    if len(chosen) > 1 or any(mart.sets for mart in chosen.values()):
        rows = materialize(rows)  # sums alone read them once
    for name, mart in chosen.items():
        keyed = rows.withColumns({k: F.expr(e) for k, e in mart.keys.items()})
        found = keyed.groupBy(*mart.keys).agg(*[F.expr(e).cast(kind).alias(n) for n, (e, kind) in mart.sums.items()])
        if mart.sets:
            numbers = _numbered(rows, sorted(set(mart.sets.values())), f"{path}/{name}")
            for set_name, column in mart.sets.items():
                bits = keyed.select(*mart.keys, F.col(column).alias("id")).distinct().join(numbers[column], "id")
                bits = bits.withColumns({"number": F.col("number") + 1, "slot": _slot(mart)})
                bits = bits.groupBy("slot", *mart.keys, F.bitmap_bucket_number("number").alias("part")).agg(
                    F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
                merge_slots(bits, [*mart.keys, "part"], {"bits": F.bitmap_or_agg("bits")}, batch, f"{path}/{name}/{set_name}")
        # the sums come last: a batch that stopped before has not been taken
        merge_slots(found.withColumn("slot", _slot(mart)), list(mart.keys), {n: F.sum(n) for n in mart.sums}, batch, f"{path}/{name}/sums")


def read_marts(spark: SparkSession, path: str, only: Sequence[str] | None = None, min_days: int = 30) -> dict[str, DataFrame]:
    """The marts as ``marts.build_marts`` has them, from their states; the cost does not depend on the number of batches."""
    out = {}
    for name, mart in mart_states(min_days).items():
        if only is not None and name not in only:
            continue
        state = spark.read.option("basePath", f"{path}/{name}/sums").parquet(f"{path}/{name}/sums").drop("slot", "batch")
        for set_name in mart.sets:
            held = spark.read.option("basePath", f"{path}/{name}/{set_name}").parquet(f"{path}/{name}/{set_name}")
            sizes = held.groupBy(*mart.keys).agg(F.sum(F.bitmap_count("bits")).alias(set_name))
            renamed = sizes.select(*[F.col(k).alias(f"_{k}") for k in mart.keys], set_name)
            same = F.lit(True)
            for k in mart.keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            state = state.join(renamed, same, "left").drop(*[f"_{k}" for k in mart.keys]).fillna({set_name: 0})
        out[name] = mart.result(state)
    return out


def run_marts(stream: DataFrame, path: str, checkpoint: str, only: Sequence[str] | None = None) -> StreamingQuery:
    """Keeps the marts up to date from a stream of feature rows."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda rows, batch: merge_batch(rows, batch, path, only)).start()
    )
