"""The library's tables derived from the driver tables, in Spark and in DuckDB SQL.

Both sides use integer arithmetic and whole texts only, so the two engines agree.
"""
from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.schemas import PREPRINTS, RAW_WORK, WORKS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core a share of a table, however it is stored."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def _select(df: DataFrame, columns: dict[str, str], schema) -> DataFrame:
    return df.select(*[F.expr(columns[f.name]).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


_DATE = ("concat(cast(2010 + doc_id % 16 AS string), '-', lpad(cast(1 + doc_id % 12 AS string), 2, '0'),"
         " '-', lpad(cast(1 + doc_id % 28 AS string), 2, '0'))")
_TOPIC = ("CASE WHEN doc_id % 60 <> 59 THEN named_struct('id', source, 'name', concat('Topic ', source),"
          " 'score', cast(doc_id % 100 AS float) / cast(100 AS float)) END")
_WORK = {
    "id": "concat('W', doc_id)",
    "doi": "CASE WHEN doc_id % 5 <> 0 THEN concat('https://doi.org/10.1/', doc_id % 800) END",
    "arxiv_id": "CASE WHEN doc_id % 4 = 0 THEN concat('P', doc_id) END",
    "title": "CASE WHEN doc_id % 50 <> 7 THEN substring_index(text, '\\n', 1) END",
    "abstract": "CASE WHEN doc_id % 4 = 3 THEN NULL WHEN doc_id % 40 = 1 THEN '   ' ELSE text END",
    "publication_year": "2010 + doc_id % 16",
    "publication_date": _DATE,
    "date_is_placeholder": f"{_DATE} LIKE '%-01-01'",
    "type": "CASE WHEN doc_id % 3 = 0 THEN 'preprint' ELSE 'article' END",
    "language": "CASE WHEN doc_id % 20 <> 0 THEN lang END",
    "is_oa": "doc_id % 2 = 0",
    "cited_by_count": "n_chars",
    "primary_topic": _TOPIC,
    "primary_subfield_id": "CASE WHEN doc_id % 60 <> 59 THEN 1702 + 5 * (doc_id % 2) END",
    "topics": f"CASE WHEN doc_id % 60 <> 59 THEN array({_TOPIC}) ELSE array() END",
    "institution_ids": "array_distinct(array(concat('I', doc_id % 7), concat('I', doc_id % 11)))",
    "institution_names": "array_distinct(array(concat('Org ', doc_id % 7), concat('Org ', doc_id % 11)))",
    "institution_countries": ("transform(array_distinct(array(doc_id % 7, doc_id % 11)), i -> "
                              "CASE WHEN doc_id % 9 <> 0 THEN concat('C', i % 5) END)"),
    "author_count": "1 + doc_id % 4",
    "venue": "CASE WHEN doc_id % 17 <> 0 THEN concat('Venue ', doc_id % 13) END",
}


def works_v(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """``WORKS`` from ``documents``; ``heavy`` marks uses that work on every text."""
    docs = table(spark, sf_dir, "documents")
    return _select(spread(docs, "doc_id") if heavy else docs, _WORK, WORKS)


WORKS_SQL = """
w AS (SELECT doc_id, 'W' || doc_id AS id,
  CASE WHEN doc_id % 5 <> 0 THEN 'https://doi.org/10.1/' || (doc_id % 800) END AS doi,
  CASE WHEN doc_id % 4 = 0 THEN 'P' || doc_id END AS arxiv_id,
  CASE WHEN doc_id % 50 <> 7 THEN split_part(text, chr(10), 1) END AS title,
  CASE WHEN doc_id % 4 = 3 THEN NULL WHEN doc_id % 40 = 1 THEN '   ' ELSE text END AS abstract,
  CAST(2010 + doc_id % 16 AS INTEGER) AS year,
  (2010 + doc_id % 16) || '-' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '-'
    || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS publication_date,
  CASE WHEN doc_id % 3 = 0 THEN 'preprint' ELSE 'article' END AS type,
  CASE WHEN doc_id % 20 <> 0 THEN lang END AS language,
  doc_id % 2 = 0 AS is_oa, CAST(n_chars AS INTEGER) AS cited,
  CASE WHEN doc_id % 60 <> 59 THEN source END AS topic_id,
  CASE WHEN doc_id % 60 <> 59 THEN 'Topic ' || source END AS topic_name,
  CASE WHEN doc_id % 60 <> 59 THEN CAST(doc_id % 100 AS FLOAT) / CAST(100 AS FLOAT) END AS topic_score,
  CASE WHEN doc_id % 60 <> 59 THEN CAST(1702 + 5 * (doc_id % 2) AS INTEGER) END AS subfield,
  CASE WHEN doc_id % 7 = doc_id % 11 THEN ['I' || (doc_id % 7)]
    ELSE ['I' || (doc_id % 7), 'I' || (doc_id % 11)] END AS org_ids,
  CASE WHEN doc_id % 7 = doc_id % 11 THEN ['Org ' || (doc_id % 7)]
    ELSE ['Org ' || (doc_id % 7), 'Org ' || (doc_id % 11)] END AS orgs,
  CASE WHEN doc_id % 9 = 0 THEN (CASE WHEN doc_id % 7 = doc_id % 11 THEN [NULL] ELSE [NULL, NULL] END)
    WHEN doc_id % 7 = doc_id % 11 THEN ['C' || (doc_id % 7 % 5)]
    ELSE ['C' || (doc_id % 7 % 5), 'C' || (doc_id % 11 % 5)] END AS countries,
  CAST(1 + doc_id % 4 AS INTEGER) AS author_count,
  CASE WHEN doc_id % 17 <> 0 THEN 'Venue ' || (doc_id % 13) END AS venue
  FROM documents)"""


def star_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines with brand, supplier, nation and year: all a work of the star is made of, still narrow."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("smallint").alias("publication_year"), F.to_date("o_orderdate").alias("day"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .drop("o_orderkey", "p_partkey", "s_suppkey", "s_nationkey", "n_nationkey")
    )


def star_shape(lines: DataFrame) -> DataFrame:
    """``WORKS`` from ``star_lines``: one work per line, topic = brand, org = supplier."""
    filled = {f.name: "NULL" for f in WORKS.fields} | {
        "id": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
        "title": "concat('Line ', l_orderkey, ' of ', p_brand)",
        "publication_year": "publication_year",
        "publication_date": "cast(day AS string)",
        "cited_by_count": "cast(l_extendedprice AS int)",
        "primary_topic": ("named_struct('id', concat('T/', p_brand), 'name', p_brand, "
                          "'score', cast(1 AS float))"),
        "institution_names": "array(s_name)",
        "institution_countries": "array(n_name)",
        "venue": "concat('Supplier ', l_suppkey)",
    }
    return _select(lines, filled, WORKS)


def star_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``WORKS`` from the order star."""
    return star_shape(star_lines(spark, sf_dir))


STAR_SQL = """
s AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
  'Line ' || l_orderkey || ' of ' || p_brand AS title, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(trunc(l_extendedprice) AS INTEGER) AS cited, 'T/' || p_brand AS topic_id, p_brand AS topic_name,
  s_name AS org, n_name AS country, 'Supplier ' || l_suppkey AS venue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

_PREPRINT = {
    "id": "concat('P', doc_id)",
    "created": _DATE,
    "updated": "CASE WHEN doc_id % 2 = 0 THEN concat(2026 + doc_id % 2, '-01-01') END",
    "title": "concat('Paper ', doc_id)",
    "abstract": "text",
    "categories": "array('cs.LG', concat('cs.', upper(lang)))",
    "primary_category": "'cs.LG'",
    "doi": "CASE WHEN doc_id % 5 = 0 THEN concat('10.1/', doc_id) END",
    "authors": "array(concat('Ann ', source), concat('Bo ', lang))",
    "author_count": "2",
}


def pre_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored preprints with their ``set``; one document in three lies in both sets."""
    docs = table(spark, sf_dir, "documents").withColumn("set", F.explode(F.expr(
        "filter(array('cs', 'stat'), s -> (s = 'cs' AND doc_id % 3 <> 0)"
        " OR (s = 'stat' AND doc_id % 3 <> 1))")))
    return docs.select(*[F.expr(_PREPRINT[f.name]).cast(f.dataType).alias(f.name)
                         for f in PREPRINTS.fields], "set")


PRE_SQL = """
p AS (SELECT doc_id, 'P' || doc_id AS id,
  (2010 + doc_id % 16) || '-' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '-'
    || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS created,
  CASE WHEN doc_id % 5 = 0 THEN '10.1/' || doc_id END AS doi, lang, source, text,
  'Paper ' || doc_id AS title
  FROM documents)"""


def _xml(c: str) -> Column:
    escaped = F.expr(c)
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(entity))
    return escaped


def pre_xml_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as protocol records in XML; every tenth one is a deletion notice."""
    body = F.concat(
        F.lit('<header><identifier>oai:'), F.col("doc_id"), F.lit('</identifier></header>'
              '<metadata><arXiv xmlns="http://arxiv.org/OAI/arXiv/"><id>P'), F.col("doc_id"),
        F.lit("</id><created>"), F.expr(_DATE), F.lit("</created><authors><author><keyname>"),
        F.col("source"), F.lit("</keyname><forenames> Ann </forenames></author><author><keyname>"),
        F.col("lang"), F.lit("</keyname></author></authors><title>Paper\n   "), F.col("doc_id"),
        F.lit("</title><categories>cs.LG cs."), F.upper("lang"), F.lit("</categories><abstract>"),
        _xml("text"), F.lit("</abstract></arXiv></metadata>"))
    gone = F.concat(F.lit('<header status="deleted"><identifier>oai:'), F.col("doc_id"),
                    F.lit("</identifier></header>"))
    record = F.concat(F.lit("<record>"), F.when(F.col("doc_id") % 10 == 9, gone).otherwise(body),
                      F.lit("</record>"))
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(record.alias("record"))


def inverted_index(text: Column) -> Column:
    """Word to positions of one text, words in order; null for null."""
    kind = RAW_WORK["abstract_inverted_index"].dataType

    @F.arrow_udf(kind)
    def index(texts: pa.Array) -> pa.Array:
        words, places, word_ends, row_ends = [], [], [0], [0]
        for value in texts.to_pylist():
            found = {}
            for i, word in enumerate(w for w in re.split("[ \t\n\x0b\f\r]+", value or "") if w):
                found.setdefault(word, []).append(i)
            for word in sorted(found):
                words.append(word)
                places += found[word]
                word_ends.append(len(places))
            row_ends.append(len(words))
        lists = pa.ListArray.from_arrays(pa.array(word_ends, pa.int32()), pa.array(places, pa.int32()))
        return pa.MapArray.from_arrays(pa.array(row_ends, pa.int32()), pa.array(words, pa.string()), lists)
    return F.when(text.isNotNull(), index(text))


def raw_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``works_v`` in the nested shape of the source, abstracts as inverted indexes."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    raw_topic = ("CASE WHEN doc_id % 60 <> 59 THEN named_struct('id', concat('https://t.org/', source),"
                 " 'display_name', concat('Topic ', source),"
                 " 'score', cast(doc_id % 100 AS float) / cast(100 AS float), 'subfield',"
                 " named_struct('id', concat('https://t.org/subfields/', 1702 + 5 * (doc_id % 2)))) END")
    author = ("named_struct('institutions', transform(array(doc_id % 7, doc_id % 11), i -> named_struct("
              "'id', concat('https://t.org/I', i), 'display_name', concat('Org ', i),"
              " 'country_code', CASE WHEN doc_id % 9 <> 0 THEN concat('C', i % 5) END)))")
    columns = {
        "id": "concat('https://t.org/W', doc_id)",
        "doi": _WORK["doi"],
        "ids": ("CASE WHEN doc_id % 8 = 0 THEN map('openalex', concat('https://t.org/W', doc_id), 'arxiv',"
                " concat('https://arxiv.org/abs/P', doc_id))"
                " ELSE map('openalex', concat('https://t.org/W', doc_id)) END"),
        "title": _WORK["title"],
        "abstract_inverted_index": "abstract_inverted_index",
        "publication_year": _WORK["publication_year"],
        "publication_date": _WORK["publication_date"],
        "type": _WORK["type"],
        "language": _WORK["language"],
        "open_access": "CASE WHEN doc_id % 2 = 0 THEN named_struct('is_oa', true) END",
        "cited_by_count": "n_chars",
        "primary_topic": raw_topic,
        "topics": f"CASE WHEN doc_id % 60 <> 59 THEN array({raw_topic}) END",
        "authorships": f"array_repeat({author}, cast(1 + doc_id % 4 AS int))",
        "primary_location": ("named_struct('landing_page_url', concat('https://x.org/', doc_id), 'pdf_url',"
                             " CASE WHEN doc_id % 8 = 4 THEN concat('https://ARXIV.org/pdf/P', doc_id, '.pdf')"
                             " END, 'source', named_struct('display_name', " + _WORK["venue"] + "))"),
    }
    index = inverted_index(F.when(F.expr("doc_id % 4 <> 3 AND doc_id % 40 <> 1"), F.col("text")))
    return _select(docs.withColumn("abstract_inverted_index", index), columns, RAW_WORK)


def series_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The works' year counts as a reference series that is off by ``year % 3``."""
    return works_v(spark, sf_dir).groupBy(F.col("publication_year").cast("int").alias("year")) \
        .agg((F.count(F.lit(1)) + F.col("year") % 3).cast("bigint").alias("expected"))


SERIES_SQL = "e AS (SELECT year, CAST(count(*) + year % 3 AS BIGINT) AS expected FROM w GROUP BY year)"
