"""Work records from JSON lines without an engine's field table.

An inverted index has words as field names. The JSON parser keeps every field name it meets in a table of the whole
process, which costs more than all the rest and grows with the words ever seen. Here the index is cut out of its line as
text, and only the rest of the line is parsed. Whatever does not look exactly like a plain index goes through the
parser whole, so odd and broken records have the same outcome.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.arrays import bind

INDEX = "abstract_inverted_index"
# Possessive throughout: a text of any length is matched without going back and without recursion.
_PLAIN = r'[^"\\\x00-\x1f]*+'
_WORD = rf'"{_PLAIN}(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{{4}}){_PLAIN})*+"'
_GAP = r"[ \t\r\n]*+"
_PLACE = r"(?:0|[1-9][0-9]{0,8}+)"
_PLACES = rf"\[{_GAP}(?:{_PLACE}{_GAP}(?:,{_GAP}{_PLACE}{_GAP})*+)?+\]"
_ENTRY = rf"{_WORD}{_GAP}:{_GAP}{_PLACES}"
_INDEX = rf"\{{{_GAP}(?:{_ENTRY}{_GAP}(?:,{_GAP}{_ENTRY}{_GAP})*+)?+\}}"
_KEY = rf'"{INDEX}"{_GAP}:'
_FIELD = rf"{_KEY}{_GAP}{_INDEX}"
_HELD = "@"                        # stands for the index while the rest of the line is parsed


def records_from_lines(lines: DataFrame, schema: T.StructType, mode: str, bad: str | None = None,
                       keep_line: bool = False) -> DataFrame:
    """One record per line of ``value`` that is not blank, with the fields of ``schema``, where the index is text.

    ``mode`` is the JSON reader's; with ``bad``, one of the fields, lines that cannot be read are kept there. ``keep_line``
    leaves the line beside its record, as ``value``.
    """
    options = {"mode": mode} | ({"columnNameOfCorruptRecord": bad} if bad else {})
    line = F.col("value")

    def by_parts(field: Column) -> Column:
        def whole(r: Column) -> Column:
            fine = (r[INDEX] == _HELD) & (r[bad].isNull() if bad else F.lit(True))
            index = field.substr(F.locate("{", field), F.char_length(field))
            return F.when(fine, F.struct(*[(index if f.name == INDEX else r[f.name]).alias(f.name) for f in schema.fields]))
        rest = F.replace(line, field, F.lit(f'"{INDEX}":"{_HELD}"'))
        return F.when(field != "", bind(F.from_json(rest, schema, options), whole))
    cut = F.when(F.regexp_count(line, F.lit(_KEY)) == 1, bind(F.regexp_extract(line, _FIELD, 0), by_parts))
    return lines.where(F.btrim(line, F.lit(" \t\r\n")) != "") \
        .select(*["value"] * keep_line, F.inline(F.array(F.coalesce(cut, F.from_json(line, schema, options)))))
