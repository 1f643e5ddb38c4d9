from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators import cleanup, shared_dir, stage, staged
from starmart.sinks import Store, namespace_for, save_result
from starmart.sources import load_audit, load_table, source


def test_namespace_is_taken_as_written_or_defaulted():
    assert namespace_for(None, "main") == "main"
    assert namespace_for(" marts ", "main") == "marts"
    assert namespace_for("", "main") == ""


def test_table_is_replaced_and_may_read_itself(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.save(spark.range(3), "m1", "t")
    assert spark.table("m1.t").count() == 3
    store.save(spark.table("m1.t").union(spark.range(3)), "m1", "t")
    assert spark.table("m1.t").count() == 6
    store.save(spark.range(2).withColumn("x", F.lit("a")), "m1", "t")
    assert spark.table("m1.t").columns == ["id", "x"]


def test_a_failed_write_leaves_the_previous_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.save(spark.range(3), "m2", "t")
    with pytest.raises(Exception, match="stop here"):
        store.save(spark.range(3).select(F.raise_error(F.lit("stop here")).cast("bigint").alias("id")), "m2", "t")
    assert spark.table("m2.t").count() == 3


@pytest.mark.parametrize("catalog", [True, False])
def test_clustered_table(spark, tmp_path, catalog):
    store = Store(spark, str(tmp_path), catalog=catalog)
    df = spark.range(1000).withColumn("p", F.col("id") % 3)
    clustered = store.save(df, "m3", "clustered", cluster_by=["p", "id"])
    assert clustered.count() == 1000
    spread = clustered.groupBy(F.input_file_name()).agg(F.min("p"), F.max("p")).collect()
    assert all(r[2] - r[1] <= 2 for r in spread)


def test_declared_source(spark, tmp_path):
    schema = T.StructType([T.StructField("Id", T.StringType(), nullable=False), T.StructField("N", T.LongType())])
    landing = spark.createDataFrame([("1", "5"), ("2", "x"), ("3", None)], "id string, n string")
    load = load_table(landing, schema, Store(spark, str(tmp_path)), "inpatient_charges")
    assert (load.rows, load.rejected) == (2, 1)
    assert sorted(map(tuple, source(spark, "raw", "inpatient_charges").collect())) == [("1", 5), ("3", None)]
    assert spark.table("raw.inpatient_charges_rejects").first().reject_reason == "N is not a number"
    stamped = spark.table("raw.inpatient_charges_load").select("loaded_at").distinct()
    assert stamped.count() == 1 and stamped.first()[0] is not None
    audit = load_audit({"good": load.table, "bad": load.rejects}).collect()
    assert [tuple(r) for r in audit] == [(2, 1)]
    for name in (("raw", "other"), ("elsewhere", "inpatient_charges")):
        with pytest.raises(KeyError):
            source(spark, *name)


def test_result_is_one_file(spark, tmp_path):
    save_result(spark.range(10).repartition(4), str(tmp_path), "answer")
    assert len(list((tmp_path / "answer").glob("*.parquet"))) == 1


def test_stage_writes_to_the_folder_the_session_names(spark):
    staged = stage(spark.range(5), "five")
    assert staged.inputFiles()[0].startswith("file:" + shared_dir(spark)) or shared_dir(spark) in staged.inputFiles()[0]
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_the_shared_folder():
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="yarn", applicationId="a")
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)
    session.sparkContext.master = "local[2]"
    assert shared_dir(session) == shared_dir(session)


def test_cleanup_removes_what_was_staged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staged, "shared_dir", lambda _: str(tmp_path))
    assert stage(spark.range(3), "gone").count() == 3
    assert list(tmp_path.rglob("*.parquet"))
    cleanup(spark)
    assert not list(tmp_path.rglob("*.parquet"))


def test_saving_again_repoints_the_name_in_one_statement(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.save(spark.range(3), "again", "numbers")
    said, run = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (said.append(text), run(text, *a, **b))[1])
    assert store.save(spark.range(5), "again", "numbers").count() == 5
    assert spark.table("again.numbers").count() == 5
    assert not any(text.startswith(("DROP", "CREATE TABLE")) for text in said)
