"""Marts from mergeable state against the full rebuild."""

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from shelfline.operators import mart_state, marts
from shelfline.plans import catalog



@pytest.fixture(scope="module")
def features(spark):
    return catalog._features(spark, DATA).cache()


def rounded(df):
    numbers = {c: F.round(F.col(c).cast("double"), 7) for c, t in df.dtypes if t in ("double",) or t.startswith("decimal")}
    return df.withColumns({c: F.col(c).cast("long") for c, t in df.dtypes if t in ("int", "bigint", "smallint")} | numbers)


def same(left, right):
    left = rounded(left)
    right = rounded(right).select(*left.columns)
    return left.exceptAll(right).count() == 0 == right.exceptAll(left).count()


def parts_of(features):
    """Three batches; the second and third bring late rows of days that the first has."""
    first = features.filter("sale_date < '1996-01-01' AND pmod(xxhash64(store_id), 5) > 0")
    second = features.filter("sale_date >= '1996-01-01' AND sale_date < '1997-06-01' OR sale_date < '1994-01-01' AND pmod(xxhash64(store_id), 5) = 0")
    third = features.filter("sale_date >= '1997-06-01' OR sale_date >= '1994-01-01' AND sale_date < '1996-01-01' AND pmod(xxhash64(store_id), 5) = 0")
    return [first, second, third]


def test_three_batches_with_late_rows_equal_the_rebuild(spark, features, tmp_path):
    path = str(tmp_path / "marts")
    batches = parts_of(features)
    assert sum(b.count() for b in batches) == features.count()
    for number, rows in enumerate(batches):
        mart_state.merge_batch(rows, number, path, min_days=3)
    want = marts.build_marts(features) | {"mv_stockout_summary": marts.stockout_summary(features, min_days=3)}
    got = mart_state.read_marts(spark, path, min_days=3)
    assert set(got) == set(want)
    for name in want:
        assert got[name].count() > 0 and same(got[name], want[name]), name
    mart_state.merge_batch(batches[2].repartition(3), 2, path, min_days=3)  # repeated after a failure
    for name, df in mart_state.read_marts(spark, path, min_days=3).items():
        assert same(df, want[name]), name


def test_only_touched_slots_are_rewritten(spark, features, tmp_path):
    path, only = tmp_path / "marts", ["mv_regional_demand", "mv_stockout_summary"]
    mart_state.merge_batch(features.filter("sale_date < '1997-01-01'"), 0, str(path), only)

    def files():
        return {f: f.stat().st_mtime_ns for f in path.glob("mv_*/*/slot=*/*.parquet")}

    before = files()
    late = features.filter("sale_date BETWEEN '1995-03-05' AND '1995-03-07'").limit(4)
    mart_state.merge_batch(late, 1, str(path), only)
    changed = {f.parent for f, _ in set(before.items()) ^ set(files().items())}
    products = late.select("product_id", "category").distinct().count()
    assert {f.name for f in changed if "regional" in str(f)} == {"slot=1995"}
    assert 0 < len({f for f in changed if "stockout" in str(f)}) <= products < len({f.parent for f in before if "stockout" in str(f)})


def test_half_written_batch_is_completed(spark, features, tmp_path):
    path, only = str(tmp_path / "marts"), ["mv_category_demand"]
    first = features.filter("store_id < 'S5'")
    second = features.exceptAll(first)
    mart_state.merge_batch(first, 0, path, only)
    some = second.filter(F.col("category").isin([r[0] for r in second.select("category").distinct().orderBy("category").limit(9).collect()]))
    # as if the job had stopped after the slots of these categories
    slots = {r[0] for r in some.select(F.pmod(F.xxhash64("category"), F.lit(mart_state.SLOTS))).distinct().collect()}
    done = second.filter(F.pmod(F.xxhash64("category"), F.lit(mart_state.SLOTS)).isin(list(slots)))
    mart_state.merge_batch(done, 1, path, only)
    mart_state.merge_batch(second, 1, path, only)
    assert same(mart_state.read_marts(spark, path, only)["mv_category_demand"], marts.category_demand(features))


def test_stream_null_keys_and_ids(spark, features, tmp_path):
    source, only = str(tmp_path / "in"), ["mv_regional_demand", "mv_promo_impact"]
    odd = features.withColumns({
        "region": F.when(F.pmod(F.xxhash64("product_id"), F.lit(4)) > 0, F.col("region")),
        "store_id": F.when(F.pmod(F.xxhash64("store_id"), F.lit(3)) > 0, F.col("store_id")),
        "units_sold": F.when(F.col("units_sold") > 10, F.col("units_sold"))})
    for part in range(3):
        odd.filter(F.pmod(F.xxhash64("product_id", "sale_date"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(odd.schema).option("maxFilesPerTrigger", 1).parquet(source)
    mart_state.run_marts(stream, str(tmp_path / "out"), str(tmp_path / "state"), only).awaitTermination()
    got = mart_state.read_marts(spark, str(tmp_path / "out"), only)
    assert same(got["mv_regional_demand"], marts.regional_demand(odd))
    assert same(got["mv_promo_impact"], marts.promo_impact(odd))


def test_a_batch_is_written_down_once_and_dealt_once(spark, features, tmp_path, monkeypatch):
    path, only, written = str(tmp_path / "marts"), ["mv_daily_store_demand"], []
    plain = mart_state.materialize
    monkeypatch.setattr(mart_state, "materialize", lambda df: written.append(df.columns) or plain(df))
    mart_state.merge_batch(features.filter("store_id < 'S5'"), 0, path, only)
    assert not written
    mart_state.merge_batch(features.filter("store_id >= 'S5'"), 1, path, only)
    assert len(written) == 1 and "slot" in written[0]
    assert same(mart_state.read_marts(spark, path, only)[only[0]], marts.daily_store_demand(features))


def test_used_columns(features):
    states = mart_state.mart_states()
    used = mart_state.used_columns(features.withColumnRenamed("units_sold", "Units_Sold"), [states["mv_daily_store_demand"]])
    assert set(used) == {"sale_date", "store_id", "region", "store_type", "Units_Sold", "revenue", "price_ratio"}
    assert "product_id" in mart_state.used_columns(features, [states["mv_regional_demand"]])
