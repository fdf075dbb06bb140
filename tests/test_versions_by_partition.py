import pytest
from pyspark.sql import functions as F

from lakepipe.operators.layout import laid_out
from lakepipe.sources import catalog
from lakepipe.sources.tables import SchemaMismatch


def rows_of(spark, n, shift=0):
    return spark.range(0, n, 1, 3).select((F.col("id") + shift).alias("k"), F.concat(F.lit("v"), "id").alias("v"))


def listed(spark, table):
    return [tuple(r) for r in catalog.history(spark, table).collect()]


def test_versions_stay_readable(spark):
    table = f"{catalog.scratch_schema(spark, 'versions')}.t"
    assert catalog.publish_version(rows_of(spark, 10), table) == {"rows": 10, "null k": 0, "null v": 0}
    again = catalog.version(spark, table).where("k < 4").withColumn("v", F.when(F.col("k") > 0, F.col("v")))
    assert catalog.publish_version(again, table, "DELETE")["null v"] == 1  # reads the table that it adds to
    catalog.publish_version(rows_of(spark, 0), table, "TRUNCATE")
    catalog.publish_version(rows_of(spark, 7, 100).select("v", "k"), table)
    assert listed(spark, table) == [(3, "WRITE", 7), (2, "TRUNCATE", 0), (1, "DELETE", 4), (0, "WRITE", 10)]
    keys = lambda n: sorted(r["k"] for r in catalog.version(spark, table, n).collect())
    assert keys(0) == [*range(10)] and keys(1) == [0, 1, 2, 3] and keys(2) == [] and keys(None) == [*range(100, 107)]
    assert catalog.version(spark, table).columns == ["k", "v"]
    with pytest.raises(LookupError):
        catalog.version(spark, table, 4)


def test_an_old_version_is_read_alone(spark):
    table = f"{catalog.scratch_schema(spark, 'pruned')}.t"
    for n in (5, 6):
        catalog.publish_version(rows_of(spark, n), table)
    plan = catalog.version(spark, table, 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and len(catalog.version(spark, table, 0).inputFiles()) <= 3


def test_refused_versions_leave_nothing(spark):
    table = f"{catalog.scratch_schema(spark, 'refused')}.t"
    catalog.publish_version(rows_of(spark, 3), table)
    for wrong in (rows_of(spark, 3).withColumn("more", F.lit(1)), rows_of(spark, 3).withColumn("k", F.lit("text"))):
        with pytest.raises(SchemaMismatch):
            catalog.publish_version(wrong, table)
    with pytest.raises(ValueError):
        catalog.publish_version(rows_of(spark, 3), table, "a/b")
    assert listed(spark, table) == [(0, "WRITE", 3)]


def test_first_table_may_be_empty(spark):
    table = f"{catalog.scratch_schema(spark, 'empty')}.t"
    catalog.publish_version(rows_of(spark, 0), table)
    assert listed(spark, table) == [(0, "WRITE", 0)] and catalog.version(spark, table).isEmpty()


def test_layout_skips_files_and_splits_a_hot_value(spark, tmp_path):
    n = 60_000
    # A third of the rows are exact copies of one row.
    user = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") * 7919 % 1000)
    kind = F.when(F.col("id") % 3 == 0, "view").otherwise(F.element_at(F.array(*map(F.lit, ["buy", "cart", "view"])), (F.col("id") % 7 % 3 + 1).cast("int")))
    frame = spark.range(0, n, 1, 6).select(user.alias("user"), kind.alias("kind"))
    laid_out(frame, ["user", "kind"], 12).write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t")).withColumn("file", F.col("_metadata.file_name"))
    assert back.groupBy("user", "kind").count().exceptAll(frame.groupBy("user", "kind").count()).isEmpty()
    files = back.groupBy("file").agg(F.min("user").alias("lo"), F.max("user").alias("hi"), F.count("*").alias("n")).collect()
    assert len(files) == 12 and max(f["n"] for f in files) < 2 * n / 12 and back.count() == n
    assert all(sum(f["lo"] <= u <= f["hi"] for f in files) <= 2 for u in (3, 250, 777))
    assert sum(f["lo"] <= 500 <= f["hi"] for f in files) >= 4
    for part in back.where("user <> 500").groupBy("file").agg(F.collect_list("kind").alias("kinds")).collect():
        assert part["kinds"] == sorted(part["kinds"])


def test_layout_of_odd_tables(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert laid_out(empty, ["a", "b"], 4).count() == 0 and laid_out(empty, ["a"], 1).count() == 0
    nulls = spark.createDataFrame([(None, None, 1), (None, "x", 2), (1, None, 3)] * 5, "a int, b string, _place int")
    out = laid_out(nulls, ["a", "b"], 4)
    assert out.columns == nulls.columns and out.exceptAll(nulls).isEmpty() and out.count() == 15
