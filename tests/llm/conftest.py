import duckdb
import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of small tables of documents: (doc_id, text[, lang[, source]]) each."""

    def make(*rows, extra=()):
        filled = [(*r, *(None,) * (4 - len(r)), None) for r in rows]
        frame = spark.createDataFrame(filled, SCHEMA)
        for name in extra:
            from pyspark.sql import functions as F

            frame = frame.withColumn(name, F.lit(7))
        return frame

    return make


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """A folder of tables written from frames, as the queries read them."""

    def write(**frames):
        path = tmp_path_factory.mktemp("tables")
        for name, frame in frames.items():
            frame.write.parquet(f"{path}/{name}.parquet")
        return str(path)

    return write


def same_as_sql(query, sql, spark, path, tables=("documents",)):
    import glob
    import os

    con = duckdb.connect()
    for name in tables:
        file = f"{path}/{name}.parquet"
        con.execute(f"create view {name} as select * from '{file if os.path.isfile(file) else file + '/*.parquet'}'")
    frame = query(spark, path)
    columns = sorted(frame.columns)
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in answer.fetchall()]
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert glob.glob(f"{path}/*")
