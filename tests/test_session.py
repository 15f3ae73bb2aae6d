import os

from lamella import session


def test_materialize_and_release(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    table = session.materialize(df)
    path = table._lamella_path.replace("file:", "")
    assert table.dtypes == df.dtypes and table.count() == 10 and os.path.isdir(path)
    assert path.startswith(session.shared_dir(spark).replace("file:", ""))
    session.release(table)
    assert not os.path.exists(path)
    session.release(df)
    session.release(None)


def test_empty_tables_keep_their_schema(spark):
    df = spark.createDataFrame([], "a bigint, b array<string>")
    assert session.materialize(df).dtypes == df.dtypes and session.materialize(df).isEmpty()
