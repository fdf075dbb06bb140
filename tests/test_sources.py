import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.operators import cleaning, quality
from lakepipe.schemas import BRONZE, UNREADABLE, raw_schema
from lakepipe.session import clear_scratch, scratch_dir, shuffle_partitions_for, sized_shuffles, stored_bytes, written_once
from lakepipe.sources import tables
from lakepipe.sources.feed import read_csv_events, stamp_ingestion
from lakepipe.sources.versions import Store
from test_cleaning import row

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
LINE = "2019-10-01 00:00:00 UTC,view,44600062,2103807459595387724,,shiseido,35.79,541312140,72d76fde\n"


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + LINE + LINE.replace("shiseido", "").replace("35.79", "oops"))
    return folder


def test_csv_has_declared_types_and_keeps_other_columns(spark, feed, conf):
    events = read_csv_events(spark, str(feed))
    types = dict(events.dtypes)
    assert types["user_id"] == types["product_id"] == "bigint" and types["category_id"] == "string"
    first, second = events.orderBy(F.col("price").asc_nulls_last()).collect()
    assert str(first["event_time"]) == "2019-10-01 00:00:00" and first["price"] == 35.79
    assert second["brand"] is None and second["price"] is None


def test_csv_with_another_column_order_fails(spark, feed):
    names = HEADER.strip().split(",")
    values = LINE.strip().split(",")
    (feed / "b.csv").write_text(",".join(names[::-1]) + "\n" + ",".join(values[::-1]) + "\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv_events(spark, str(feed)).collect()


def test_csv_inference_is_optional(spark, feed):
    assert dict(read_csv_events(spark, str(feed), infer_schema=True).dtypes)["user_id"] == "int"


def test_audit_column(raw):
    at = F.lit("2020-01-01").cast("timestamp")
    assert stamp_ingestion(raw([row()]), at).first()["ingestion_ts"].year == 2020
    assert stamp_ingestion(raw([row(), row()])).select("ingestion_ts").distinct().count() == 1


def test_null_profile_of_an_empty_table_is_zero(raw):
    assert set(quality.null_profile(raw([])).first()) == {0}
    assert quality.null_profile(raw([row(brand=None), row()])).first()["brand"] == 1


def test_schema_report(raw):
    rows = quality.schema_report(raw([])).collect()
    assert (rows[0]["ordinal"], rows[0]["name"], rows[0]["type"]) == (1, "event_time", "timestamp")


def test_schema_problems(spark, raw):
    good = raw([row()])
    assert quality.check_schema(good, raw_schema()).isEmpty()
    odd = good.drop("brand").withColumn("extra", F.lit(1)).withColumn("price", F.lit("1"))
    assert [tuple(r) for r in quality.check_schema(odd, raw_schema()).collect()] == [
        ("brand", "missing", "string", None),
        ("extra", "unexpected", None, "int"),
        ("price", "type", "double", "string"),
    ]


def test_managed_tables(spark, raw):
    tables.create_layers(spark)
    tables.save_table(raw([row()]), "bronze.managed")
    tables.save_table(raw([row(), row()]), "bronze.managed")
    tables.append_table(raw([row()]), "bronze.managed")
    assert spark.table("bronze.managed").count() == 3
    wrong = spark.createDataFrame([("a", "b", "c")], ["x", "y", "z"])
    with pytest.raises(tables.SchemaMismatch):
        tables.append_table(wrong, "bronze.managed")
    accepted, why = tables.append_outcome(tables.append_table, wrong, "bronze.managed")
    assert not accepted and why.startswith("append to bronze.managed rejected") and len(why) == 80
    assert spark.table("bronze.managed").count() == 3
    with pytest.raises(AnalysisException):
        tables.append_outcome(tables.append_table, wrong, "bronze.no_such_table")


@pytest.mark.parametrize("change", ["names", "type", "missing", "extra"])
def test_append_to_files_is_checked(spark, raw, tmp_path, change):
    path, good = str(tmp_path / "t"), raw([row()])
    tables.append_files(good, path, raw_schema())
    bad = {
        "names": spark.createDataFrame([("a", "b", "c")], ["x", "y", "z"]),
        "type": good.withColumn("price", F.col("price").cast("string")),
        "missing": good.drop("brand"),
        "extra": good.withColumn("more", F.lit(1)),
    }[change]
    assert tables.append_outcome(tables.append_files, bad, path, raw_schema())[0] is False
    assert tables.append_outcome(tables.append_files, good, path, raw_schema()) == (True, "")
    assert spark.read.parquet(path).count() == 2


def bronze_row(raw, *rows):
    return stamp_ingestion(raw(list(rows)), F.lit("2020-01-01").cast("timestamp"))


def test_versions(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.history(BRONZE).count() == 0
    with pytest.raises(LookupError):
        store.read(BRONZE)
    with pytest.raises(LookupError):
        store.append(bronze_row(raw, row()), BRONZE)
    store.publish(bronze_row(raw, row()), BRONZE)
    # the next version may be made from the one it replaces
    store.publish(store.read(BRONZE).union(bronze_row(raw, row(product=2))), BRONZE, "REWRITE")
    assert store.read(BRONZE).count() == 2 and store.read(BRONZE, 0).count() == 1
    with pytest.raises(LookupError):
        store.read(BRONZE, 5)
    newest = store.history(BRONZE).first()
    assert (newest["version"], newest["operation"], store.rows(BRONZE)) == (1, "REWRITE", 2)
    folder = os.path.dirname(store.read(BRONZE).inputFiles()[0])
    files, size = stored_bytes(spark, folder)
    assert newest["operationMetrics"] == {"numFiles": str(files), "numOutputRows": "2", "numOutputBytes": str(size)}


def test_append_adds_files_only(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path))
    first = store.publish(bronze_row(raw, row()), BRONZE)
    second = store.append(bronze_row(raw, row(product=2), row(product=3)), BRONZE)
    assert set(first.inputFiles()) < set(second.inputFiles())
    assert second.count() == 3 and store.read(BRONZE, 0).count() == 1 and store.rows(BRONZE) == 3
    assert [r["operation"] for r in store.history(BRONZE).collect()] == ["APPEND", "WRITE"]
    store.register(BRONZE)
    assert spark.table(BRONZE).count() == 3


def test_published_tables_enforce_their_schema(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(tables.SchemaMismatch):
        store.publish(raw([row()]), BRONZE)  # the contract asks for the audit column
    good = bronze_row(raw, row())
    store.publish(good.withColumn("category_id", F.lit("x")), BRONZE)  # the feed's own columns are welcome
    for bad in (good, good.withColumn("category_id", F.lit(1)), spark.createDataFrame([("a",)], ["x"])):
        assert tables.append_outcome(store.append, bad, BRONZE)[0] is False
        with pytest.raises(tables.SchemaMismatch):
            store.publish(bad, BRONZE)
    assert store.history(BRONZE).count() == 1
    assert store.publish(good, BRONZE, overwrite_schema=True).columns == good.columns


def test_a_publish_that_died_is_never_seen(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish(bronze_row(raw, row()), BRONZE)
    bronze_row(raw, *[row()] * 9).write.parquet(str(tmp_path / BRONZE / "data-dead"))  # files, but no log row
    assert store.read(BRONZE).count() == 1
    store.publish(bronze_row(raw, *[row()] * 3), BRONZE)
    assert store.read(BRONZE).count() == 3


def test_two_writers_of_one_version(spark, raw, tmp_path):
    store, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    store.publish(spark.range(1), "x.t")
    before = other._entry("x.t")
    store.publish(spark.range(2), "x.t")
    with pytest.raises(AnalysisException):
        other._commit("x.t", spark.range(3), "WRITE", before, [])
    assert store.read("x.t").count() == 2


def test_registered_view_follows_the_newest_version(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish(raw([row()]), "x.followed")
    store.register("x.followed")
    assert spark.table("x.followed").count() == 1
    store.publish(raw([row()] * 2), "x.followed")
    store.register("x.followed")
    assert spark.table("x.followed").count() == 2


def test_scratch_is_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_scratch_without_a_checkpoint_folder_is_the_warehouse():
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://host/warehouse/"}.get(key, default)

    class Session:
        conf = Conf()

    assert scratch_dir(Session(), "x").startswith("hdfs://host/warehouse/lakepipe/x-")


def test_scratch_is_cleared(spark):
    kept = written_once(spark.range(3), "t")
    assert kept.count() == 3
    clear_scratch(spark)
    assert not os.path.exists(f"{spark.conf.get('spark.checkpoint.dir')}/lakepipe")


def test_shuffle_sizing(spark):
    assert shuffle_partitions_for(10, 8) == 8
    assert shuffle_partitions_for(64 * 1024**3, 8) == 1024
    assert shuffle_partitions_for(100 * 1024**4, 8) == 1_638_400
    own = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 64 * 1024**3) as wanted:
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(wanted) == "1024"
    assert spark.conf.get("spark.sql.shuffle.partitions") == own


def test_unreadable_values_are_rejected_under_their_own_reason(spark, tmp_path):
    folder = tmp_path / "damaged"
    folder.mkdir()
    late = LINE.replace("2019-10-01 00:00:00 UTC", "01/10/2019 09:00").replace("view", "purchase")
    early = late.replace("09:00", "00:00")
    (folder / "a.csv").write_text(HEADER + LINE + early + late + LINE.replace("35.79", "oops"))
    events = read_csv_events(spark, str(folder))
    assert [r["reason"] for r in cleaning.rejected(events).collect()] == ["unreadable"] * 3
    clean = cleaning.clean(events)
    assert clean.count() == 1 and UNREADABLE not in clean.columns
    lines = {r[UNREADABLE] for r in events.select("brand", UNREADABLE).collect()}
    assert lines == {None, early.strip(), late.strip(), LINE.replace("35.79", "oops").strip()}
    (folder / "b.csv").write_text(HEADER + LINE.replace("44600062", "4.5") + "2019-10-01 00:00:00,view\n")
    assert read_csv_events(spark, str(folder)).where(F.col(UNREADABLE).isNotNull()).count() == 5
