"""Queries of this folder, registered under the names of the contract."""

QUERIES = {}
ORACLE = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")
