"""Named queries over the given tables, each with its SQL where SQL can say it."""

import datetime as dt

QUERIES = {}
ORACLE = {}

# reference moments of the synthetic tables, so that no query reads the clock
ORDERS_AS_OF = dt.datetime(2001, 8, 15, 12, 0, 0)
EVENTS_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")
