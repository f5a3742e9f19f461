"""Records from lines against the JSON reader, and no word as a field name of the parser."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract.views import inverted_index
from trendloom.functions.records import records_from_lines
from trendloom.functions.text import _index_reader, restore_text
from trendloom.operators.normalize import parsed_index, restored_abstract
from trendloom.schemas import RAW_LANDED

BAD = T.StructField("_bad", T.StringType())
KEY = '"abstract_inverted_index"'
LINES = [
    f'{{"id":"a",{KEY}:{{"x":[0,2],"y\\"z\\u00e9":[1]}},"publication_year":2001}}', f'{{"id":"b",{KEY}:{{}},"ids":{{}}}}',
    f'{{"id":"c",{KEY}:null}}', "", "   ", f'{{"id":"d",{KEY}:{{"x":[0],"x":[1]}}}}', f'{{"id":"e",{KEY}:{{"x":null}}}}',
    f'{{"id":"f",{KEY}:{{"x":[1],}}}}', '{"id":"g","abstract_inver', f'{{"id":"h",{KEY}:{{"x":[1]}},"publication_year":"zz"}}',
    f'{{"id":"i","ids":{{{KEY}:{{"q":[1]}}}},"title":"t"}}', f'{{"id":"k",{KEY}:{{"x":[1]}},{KEY}:{{"y":[2]}}}}',
    f'{{"id":"j","title":"\\"abstract_inverted_index\\":{{}}",{KEY} : {{"k $1 \\\\": [3, 4 ] }}}}',
    f'{{"id":"l",{KEY}:{{"x":[99999999999]}}}}', f'{{"id":"m",{KEY}:{{"x":[1]}}}} trailing', "null", "12",
    f'{{"id":"o",{KEY}:{{"x":[1]}},"title":"cut', f'{{"id":"p",{KEY}:{{"":[01]}}}}', f'{{"id":"q",{KEY}:{{"\\ud83d\\ude00 \\/":[1]}}}}']


@pytest.mark.parametrize("schema", [RAW_LANDED, T.StructType([*RAW_LANDED.fields, BAD])])
def test_records_equal_the_json_readers(spark, fresh, schema):
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(fresh("lines"))
    bad = "_bad" if "_bad" in schema.names else None
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    want = reader.json(fresh("lines")).select("*").collect()
    got = records_from_lines(spark.read.text(fresh("lines")), schema, "PERMISSIVE", bad).collect()
    assert list(map(str, got)) == list(map(str, want)) and len(got) == len(LINES) - 2


@pytest.mark.parametrize("line", [x for x in LINES if x.startswith(('{"id":"f"', '{"id":"g"', '{"id":"o"'))])
def test_broken_lines_stop_a_strict_read(spark, line):
    with pytest.raises(Exception, match="(?i)malformed"):
        records_from_lines(spark.createDataFrame([(line,)], "value string"), RAW_LANDED, "FAILFAST").collect()


def test_words_are_no_field_names(spark, fresh):
    """A strict read parses the rest of a line by the same schema, the index standing apart as text."""
    spark.createDataFrame([(x,) for x in LINES[:1]], "value string").write.text(fresh("one"))
    plan = records_from_lines(spark.read.text(fresh("one")), RAW_LANDED, "FAILFAST")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapType(StringType,ArrayType" not in plan and "from_json" in plan.lower()


def test_inverted_index_of_odd_texts(spark):
    texts = ["b a\tb\x0b\x85c", "", None, " \n ", "Z a é 😀"]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r[0] for r in frame.select(F.map_entries(inverted_index(F.col("t")))).collect()]
    assert [g if g is None else [tuple(e) for e in g] for g in got] == [
        [("a", [1]), ("b", [0, 2]), ("\x85c", [3])], [], None, [],
        [("Z", [0]), ("a", [1]), ("é", [2]), ("😀", [3])]]


PLAIN = ['{"x":[0,2],"y\\"z\\u00e9":[1]}', "{}", '{"x":[0],"x":[1]}', '{"x":[]}', ' { "a" : [ 3 , -1 ] , "":[0], "b":[3,3]} ',
         '{"\\ud83d\\ude00 \\/":[1],"k $1 \\\\":[3]}', '{"x":[2147483647,-2147483648]}']
ODD = ['{"x":null}', '{"x":[1,null]}', '{"\\ud83d":[1]}']
BROKEN = ["[]", "null", '{"x":{}}', '{"x":[2147483648]}', '{"x":[1.5]}', '{"x":[true]}', '{"x":[01]}', '{"x":[1],}', '{"x":1}', '{"x":["y"]}']


def test_landed_indexes_restore_as_the_parser_reads_them(spark):
    """Plain ones without the parser, whose table of field names grows with every word; all others through it."""
    texts = [*PLAIN, *ODD, None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, abstract_inverted_index string")
    got = frame.select("i", restored_abstract(frame).alias("t"), restore_text(parsed_index(frame)).alias("want")).collect()
    assert [r.t for r in got] == [r.want for r in got] and len(got) == len(texts)
    assert got[0].t == 'x y"zé x' and got[4].t == "a  b" and got[2].t == "x x"
    assert [_index_reader()(t)[0] for t in texts[:-1]] == [True] * len(PLAIN) + [False] * len(ODD)
    assert not any(_index_reader()(t)[0] for t in BROKEN)


@pytest.mark.parametrize("text", BROKEN)
def test_what_is_no_index_stays_an_error(spark, text):
    frame = spark.createDataFrame([(text,)], "abstract_inverted_index string")
    try:
        want = [r[0] for r in frame.select(restore_text(parsed_index(frame))).collect()]
    except Exception:
        with pytest.raises(Exception, match="(?i)malformed|failfast"):
            frame.select(restored_abstract(frame)).collect()
    else:
        assert [r[0] for r in frame.select(restored_abstract(frame)).collect()] == want
