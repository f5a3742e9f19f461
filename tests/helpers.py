from __future__ import annotations

from trendloom.schemas import PREPRINTS, RAW_WORK, WORKS


def frame(spark, schema, rows):
    """Rows given as dicts; missing fields are null."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def works(spark, rows):
    return frame(spark, WORKS, rows)


def preprints(spark, rows):
    return frame(spark, PREPRINTS, rows)


def raw(spark, rows):
    return frame(spark, RAW_WORK, rows)


def topic(tid, name="n", score=0.9):
    return (tid, name, score)
