"""Rows that are moved or sorted at scale stay narrow, and the results stay the same."""
from __future__ import annotations

from helpers import works
from pyspark.sql import functions as F

from contract.queries import star_works
from contract.views import star_lines, star_shape
from trendloom.sources import sinks, tables

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_star_works_move_as_lines_and_are_stored_whole(spark, fresh):
    assert len(star_lines(spark, SF).columns) <= 10
    sinks.write_works(star_shape(star_lines(spark, SF)), fresh("wide"))
    want = tables.read_works(spark, fresh("wide"))
    assert rows_of(star_works(spark, SF)) == rows_of(want) and want.count() > 0


def test_shaped_writing_keeps_folders_and_null_years(spark, fresh):
    lines = spark.createDataFrame([(i, 2000 + i % 3 if i % 5 else None) for i in range(50)], "n long, publication_year short")

    def shape(df):
        empty = works(spark, []).schema
        return df.select(*[F.expr({"id": "concat('W', n)", "publication_year": "publication_year"}.get(f.name, "NULL"))
                           .cast(f.dataType).alias(f.name) for f in empty.fields])
    sinks.write_works(lines, fresh("out"), rows=4, shape=shape)
    stored = tables.read_works(spark, fresh("out"))
    assert rows_of(stored) == rows_of(shape(lines))
    files = spark.read.parquet(fresh("out")).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] <= 4
