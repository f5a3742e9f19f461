"""Text expressions: whitespace, previews, inverted indexes and ids inside links."""
from __future__ import annotations

import json
from collections.abc import Callable
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.functions.arrays import bind, or_empty

# Every character Python's str.strip and str.split treat as whitespace.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
              "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")
# The same characters as a regex class. Latin ones are listed one by one and the rest sits behind
# a single range test: the engine then decides ordinary letters with two cheap look-ups.
_FAR_SPACE = ("[\u1680-\u3000&&[\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000]]")
SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0" + _FAR_SPACE + "]"

# How a preprint id looks inside a link.
LINK_ID = r"(?i)arxiv\.org/(?:abs|pdf)/([^\s/?#]+)|arxiv[:/]\s*([0-9]{4}\.[0-9]{4,5})"
LINK_ID_OLD_STYLE = (r"(?i)arxiv\.org/(?:abs|pdf)/((?:[a-z\-]+(?:\.[a-z]{2})?/[0-9]{7})|[^\s/?#]+)"
                     r"|arxiv[:/.]\s*([0-9]{4}\.[0-9]{4,5})")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Cut whitespace of any kind from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse(c: Column) -> Column:
    """Every whitespace run becomes one space, and the ends are cut."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def is_blank(c: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(c) == "", F.lit(True))


def shorten(c: Column, width: int, mark: str = " [...]") -> Column:
    """Collapsed text cut to ``width`` at the end of a word or after a hyphen inside one.

    A text is read only up to a few characters more than ``width`` that are not whitespace:
    they alone decide both whether it must be cut and where.
    """
    head = rf"(?s)^(?:{SPACE}*+(?!{SPACE}).){{0,{width + 16}}}"
    room = width - len(mark)
    letter, word_end = r"[\p{L}_]", r"[\p{L}\p{N}_!\"'&.,?]"
    breaks = "|".join([
        r"(?= )",                                                            # between words
        rf"(?<={letter}{{2}}-|{letter}-{letter}-)(?={letter}-?{letter})",    # inside one
        rf"(?<={word_end})(?=-{{2,}}[\p{{L}}\p{{N}}_])",                      # before a dash
        rf"(?<={word_end}-{{2,9}})(?=[\p{{L}}\p{{N}}_])",                     # after a dash
    ])
    cut = rf"^.{{0,{room}}}(?<! )(?:{breaks})"

    def preview(text: Column) -> Column:
        return F.when(F.char_length(text) <= width, text).otherwise(
            F.ltrim(F.concat(F.regexp_extract(text, cut, 0), F.lit(mark))))
    return bind(collapse(F.regexp_extract(c, head, 0)), preview)


def short_id(url: Column) -> Column:
    """The part after the last slash; null for null and empty input."""
    return F.substring_index(empty_to_null(url), "/", -1)


def contains_text(c: Column, needle: str) -> Column:
    """Case-insensitive substring test; null text matches only the empty needle."""
    return F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(needle.lower()))


def restore_text(index: Column) -> Column:
    """Text from an inverted index ``word -> positions``.

    Holes are closed up, a position claimed twice goes to the later word in map order, and an
    index without positions gives null. Position and entry number travel as one long, so a text
    of any length costs one sort of plain numbers.
    """
    slots = F.flatten(F.transform(F.map_values(index), lambda places, entry: F.transform(
        or_empty(places, "int"), lambda p: F.shiftleft(p.cast("bigint"), 32) + entry)))

    def position(slot: Column) -> Column:
        return F.shiftright(slot, 32)

    def words(bound: Column) -> Column:
        slots, keys = bound["slots"], bound["keys"]
        last = F.filter(slots, lambda s, j: F.coalesce(
            position(F.get(slots, j + 1)) != position(s), F.lit(True)))
        return F.transform(last, lambda s: F.get(keys, s.bitwiseAND(0xFFFFFFFF).cast("int")))
    bound = F.struct(F.sort_array(slots).alias("slots"), F.map_keys(index).alias("keys"))
    return bind(bind(bound, words), lambda w: F.when(F.size(w) > 0, F.array_join(w, " ")))


def _index_reader() -> Callable[[str], tuple[bool, str | None]]:
    """The reader of plain indexes, made inside a function so that it travels whole and workers need not import this module."""
    def read_index(text: str) -> tuple[bool, str | None]:
        """Whether a text is a plain inverted index, whole numbers of 32 bits under each word, and the text it restores."""
        try:
            entries = json.loads(text, object_pairs_hook=tuple)
            if type(entries) is not tuple or not all(type(places) is list for _, places in entries):
                return False, None
            places = list(chain.from_iterable([places for _, places in entries]))
            if not places:
                return True, None
            if set(map(type, places)) != {int} or min(places) < -2**31 or max(places) >= 2**31:
                return False, None
            at = {place: word for word, places in entries for place in places}
            restored = " ".join([at[place] for place in sorted(at)])
            if "\\" in text:
                restored.encode()
            return True, restored
        except (ValueError, RecursionError):
            return False, None
    return read_index


def restore_landed_text(index: Column, parsed: Column) -> Column:
    """``restore_text`` of an inverted index that is landed as JSON text.

    Spark's JSON parser keeps every field name in a table of the whole process, here every word ever seen, so it
    slows down as a corpus grows. A plain index is read without it; whatever else the text holds is left to ``parsed``, the
    index as the parser reads it.
    """
    read_index = _index_reader()

    @F.arrow_udf("struct<plain: boolean, text: string>")
    def read(texts: pa.Array) -> pa.Array:
        found = [read_index(text.as_py()) if text.is_valid else (True, None) for text in texts]
        return pa.StructArray.from_arrays(
            [pa.array([plain for plain, _ in found], pa.bool_()), pa.array([text for _, text in found], pa.string())],
            ["plain", "text"])
    return bind(read(index), lambda r: F.when(r["plain"], r["text"]).otherwise(bind(parsed, restore_text)))


def link_id(ids: Column, landing: Column, pdf: Column, old_style_ids: bool = False) -> Column:
    """Preprint id from all links of a work: the first match over id links, landing page, PDF.

    ``old_style_ids`` also accepts ids with a slash (``cs/0501001``), cuts a version suffix and
    reads DOI-style ids, all of which the default pattern misses.
    """
    pattern = LINK_ID_OLD_STYLE if old_style_ids else LINK_ID
    links = F.concat_ws(" ", F.map_values(ids), landing, pdf)
    found = F.coalesce(empty_to_null(F.regexp_extract(links, pattern, 1)),
                       empty_to_null(F.regexp_extract(links, pattern, 2)))
    found = F.regexp_replace(found, r"\.pdf\z", "")
    return F.regexp_replace(found, r"v[0-9]+\z", "") if old_style_ids else found
