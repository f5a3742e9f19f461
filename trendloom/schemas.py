"""Declared schemas of every table the library reads or writes. Nothing is inferred on read."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

EMBEDDING_DIM = 768

_STR = T.StringType()
_STRINGS = T.ArrayType(_STR)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


TOPIC = _struct(id=_STR, name=_STR, score=T.FloatType())

WORKS = _struct(
    id=_STR,
    doi=_STR,
    arxiv_id=_STR,
    title=_STR,
    abstract=_STR,
    publication_year=T.ShortType(),
    publication_date=_STR,
    date_is_placeholder=T.BooleanType(),
    type=_STR,
    language=_STR,
    is_oa=T.BooleanType(),
    cited_by_count=T.IntegerType(),
    primary_topic=TOPIC,
    primary_subfield_id=T.IntegerType(),
    topics=T.ArrayType(TOPIC),
    institution_ids=_STRINGS,
    institution_names=_STRINGS,
    institution_countries=_STRINGS,
    author_count=T.ShortType(),
    venue=_STR,
)

PREPRINTS = _struct(
    id=_STR,
    created=_STR,
    updated=_STR,
    title=_STR,
    abstract=_STR,
    categories=_STRINGS,
    primary_category=_STR,
    doi=_STR,
    authors=_STRINGS,
    author_count=T.ShortType(),
)

EMBEDDINGS = _struct(id=_STR, embedding=T.ArrayType(T.FloatType()))

_RAW_TOPIC = _struct(id=_STR, display_name=_STR, score=T.FloatType(), subfield=_struct(id=_STR))
_RAW_INSTITUTION = _struct(id=_STR, display_name=_STR, country_code=_STR)

RAW_WORK = _struct(
    id=_STR,
    doi=_STR,
    ids=T.MapType(_STR, _STR),
    title=_STR,
    abstract_inverted_index=T.MapType(_STR, T.ArrayType(T.IntegerType())),
    publication_year=T.IntegerType(),
    publication_date=_STR,
    type=_STR,
    language=_STR,
    open_access=_struct(is_oa=T.BooleanType()),
    cited_by_count=T.IntegerType(),
    primary_topic=_RAW_TOPIC,
    topics=T.ArrayType(_RAW_TOPIC),
    authorships=T.ArrayType(_struct(institutions=T.ArrayType(_RAW_INSTITUTION))),
    primary_location=_struct(
        landing_page_url=_STR, pdf_url=_STR, source=_struct(display_name=_STR)),
)

#: Raw works as they are landed: the inverted index stays JSON text, read and parsed only for an abstract.
RAW_LANDED = T.StructType([
    T.StructField(f.name, _STR) if f.name == "abstract_inverted_index" else f for f in RAW_WORK.fields])

RAW_PREPRINT = _struct(
    header=_struct(_status=_STR, identifier=_STR),
    metadata=_struct(arXiv=_struct(
        id=_STR, created=_STR, updated=_STR, title=_STR, abstract=_STR, categories=_STR, doi=_STR,
        authors=_struct(author=T.ArrayType(_struct(keyname=_STR, forenames=_STR))),
    )),
)

YEAR_SERIES = _struct(
    slice_id=_STR, source=_STR,
    years=T.MapType(_STR, T.MapType(_STR, T.LongType())),
)

MANIFEST = _struct(
    slice_id=_STR,
    fetched_on=_STR,
    code_version=_STR,
    source=_STR,
    rows_total=T.LongType(),
    years=T.MapType(_STR, _struct(
        rows=T.LongType(), files=T.LongType(), bytes=T.LongType(),
        expected=T.LongType(), gap=T.DoubleType())),
    files=T.MapType(_STR, _struct(bytes=T.LongType(), sha256=_STR)),
)

GROUND_TRUTH = _struct(
    note=_STR,
    entries=T.ArrayType(_struct(
        name=_STR, year=T.IntegerType(), hype_year=T.IntegerType(), note=_STR)),
)


def conforms(df: DataFrame, schema: T.StructType) -> bool:
    """True when ``df`` has exactly the declared columns, in order, with the declared types."""
    def shape(s: T.StructType) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in s.fields]
    return shape(df.schema) == shape(schema)
