"""Small document tables with every edge case, and readers of results."""

import glob

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"


def table(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def stored(spark, rows, schema, folder):
    """The rows as a parquet table, as stages get their input."""
    path = f"{folder}/t{len(glob.glob(folder + '/*'))}"
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)
