"""Sinks: Parquet round trip, JDBC into an embedded in-memory Derby
database (no server, no port), JSON lines, Python list text."""

from pyspark.sql import functions as F

from fixture_files import write_receipts_fixture
from ledgerline.plans import pipelines
from ledgerline.sinks import writers

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_parquet_round_trip_and_dynamic_overwrite(spark, workdir):
    df = spark.createDataFrame([(1, 2022, "a"), (2, 2024, "b")], "id int, cycle int, v string")
    path = f"{workdir}/t"
    writers.write_parquet(df, path, "cycle")
    back = spark.read.parquet(path)
    assert back.columns == ["id", "v", "cycle"]  # partition column comes back last, as int
    assert sorted((r.id, r.cycle, r.v) for r in back.collect()) == [(1, 2022, "a"), (2, 2024, "b")]
    # dynamic mode replaces only the partitions written (Q31 alternative)
    writers.write_parquet(spark.createDataFrame([(3, 2024, "c")], df.schema), path, "cycle", dynamic=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3]
    writers.write_parquet(spark.createDataFrame([(4, 2024, "d")], df.schema), path, "cycle")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [4]


def test_jdbc_load_tables(spark, workdir):
    raw = f"{workdir}/raw"
    write_receipts_fixture(raw)
    cfg = pipelines.ReceiptsConfig(raw_root=raw, warehouse_root=f"{workdir}/wh", cycles=[2024],
                                   schedule_a_header=f"{raw}/schedule_a/indiv_header.csv")
    pipelines.run_receipts(spark, cfg)
    url = "jdbc:derby:memory:ledgerline_test;create=true"
    loaded = writers.load_tables(spark, cfg.warehouse_root, url, DERBY,
                                 tables=["candidate_cycle_summary", "top_contributors", "missing_table"])
    assert loaded == ["candidate_cycle_summary", "top_contributors"]
    back = spark.read.format("jdbc").options(url=url, dbtable="candidate_cycle_summary", **DERBY).load()
    assert back.count() == 2
    assert sorted(r.TRANSACTION_COUNT if "TRANSACTION_COUNT" in back.columns else r.transaction_count
                  for r in back.collect()) == [1, 6]


def test_json_lines_and_list_text(spark):
    df = spark.createDataFrame([("x", ["Yes", "No"], None), ("y", ["it's"], 1)], "b string, a array<string>, c int")
    js = [r.json for r in writers.to_json_lines(df).collect()]
    assert js[0] == '{"a":["Yes","No"],"b":"x","c":null}'
    txt = [r[0] for r in df.select(writers.python_list_text(F.col("a"))).collect()]
    assert txt == ["['Yes', 'No']", '["it\'s"]']


def _rows(spark, url, table):
    return spark.read.format("jdbc").options(url=url, dbtable=table, **DERBY).load()


def test_load_is_all_or_nothing(spark):
    """A task fails half-way; another load doubles its rows: the table stays."""
    import pytest
    from pyspark.sql import functions as F

    from ledgerline.sinks import database

    url = "jdbc:derby:memory:ledgerline_staged;create=true"
    good = spark.range(100, numPartitions=4).withColumnRenamed("id", "n")
    assert writers.write_jdbc(good, "facts", url, DERBY, "load-1")
    broken = good.withColumn("n", F.when(F.col("n") == 70, F.raise_error(F.lit("task fails"))).otherwise(F.col("n") + 1000).cast("long"))
    with pytest.raises(Exception, match="task fails"):
        writers.write_jdbc(broken, "facts", url, DERBY, "load-2")
    assert _rows(spark, url, "facts").agg(F.sum("N")).first()[0] == sum(range(100))
    assert writers.write_jdbc(good.where("n < 10"), "facts", url, DERBY, "load-2")  # the id was not used up
    assert not writers.write_jdbc(good, "facts", url, DERBY, "load-2")  # done already
    assert _rows(spark, url, "facts").count() == 10
    with database.transaction(spark, url, DERBY) as connection:
        names = connection.getMetaData().getTables(None, "APP", None, None)
        left = []
        while names.next():
            left.append(names.getString("TABLE_NAME").lower())
    assert sorted(left) == ["facts", database.LOADS]


def test_rows_inserted_twice_are_noticed(spark, monkeypatch):
    import pytest

    from ledgerline.sinks import database

    url = "jdbc:derby:memory:ledgerline_twice;create=true"
    df = spark.range(5).withColumnRenamed("id", "n")
    writers.write_jdbc(df, "facts", url, DERBY)
    count = database._number
    # what a task that was tried again after its commit leaves behind
    monkeypatch.setattr(database, "_number", lambda c, sql: count(c, sql) + 3 * ("_s" in sql and "COUNT" in sql and "ledgerline" not in sql))
    with pytest.raises(database.LoadFailed):
        writers.write_jdbc(df.where("n < 2"), "facts", url, DERBY)
    assert _rows(spark, url, "facts").count() == 5
    with pytest.raises(ValueError):
        writers.write_jdbc(df, "facts; DROP TABLE facts", url, DERBY)
