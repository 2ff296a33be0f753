"""CSV lines -> fields, with what is wrong with a line beside them.

A parser that only nulls or drops what does not fit loses data in silence. Every line is
therefore judged by its text before its fields are believed:

* ``quotes``: a quote inside an unquoted field, text after a closing quote, or no closing one;
* ``short``: fewer fields than columns;
* ``long``: a surplus field that is not empty (empty ones, as from a comma at the end of each
  line, hold nothing and are let pass).

Fields and judgement are built-in expressions on the line, so scans, messages and streams
share them. Only lines that hold a quote are looked at more closely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Columns beside the fields: the fault (null: none) and the line as it was read.
MALFORMED, RAW_LINE = "malformed", "raw_line"

# no text stands for null; an empty quoted field is an empty text, an empty unquoted one is null
_CSV_READ = {"sep": ",", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0001"}

_MARK = "\u0001"  # stands for a quoted field while fields are counted
_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'
_FIELD = f'(?:{_QUOTED}|[^",{_MARK}]*+)'


def _times(text: Column, part: str) -> Column:
    """How often ``part`` occurs in ``text``."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def _bare(line: Column) -> Column:
    """The line with a mark in place of each quoted field."""
    return F.when(line.contains('"'), F.regexp_replace(line, _QUOTED, _MARK)).otherwise(line)


def _sound(line: Column, fields: int) -> Column:
    """Whether one match of the whole line shows that nothing is wrong with it: plain or quoted fields, empty surplus.

    Lines that do not match may still be sound (a mark inside a field); ``line_fault`` tells.
    """
    return line.rlike(f"\\A{_FIELD}(?:,{_FIELD}){{{fields - 1}}},*+\\z")


def line_fault(line: Column, fields: int, bare: Column | None = None) -> Column:
    """What is wrong with a CSV line of ``fields`` fields; null if nothing is. ``bare``: its ``_bare`` form, if known."""
    quoted = line.contains('"')
    bare = _bare(line) if bare is None else bare
    # every quoted field stands between commas (or at an end of the line), and no quote is left
    fenced = F.concat(F.lit(","), bare, F.lit(","))
    loose = ((_times(bare, _MARK) != _times(fenced, f",{_MARK}")) | (_times(bare, _MARK) != _times(fenced, f"{_MARK},")))
    commas = _times(bare, ",")
    surplus = (commas >= fields) & bare.rlike(f"^(?:[^,]*+,){{{fields}}},*+[^,]")
    return (F.when(quoted & (bare.contains('"') | loose), "quotes")
            .when(commas < fields - 1, "short").when(surplus, "long"))


def records(lines: DataFrame, schema: StructType, line: str = "line") -> DataFrame:
    """Non-empty CSV lines -> the text columns of ``schema``, ``malformed`` and ``raw_line``.

    Spark writes a column's expression anew into each filter above it, so every condition on a flight would parse
    its line again, once for each field it names. Rows of a generator are computed once: a line is parsed and
    matched as the only row of a list, whatever is asked of the fields later. Lines that do not match are counted
    out field by field.
    """
    text = F.col(line)
    parsed = F.struct(F.from_csv(text, schema.simpleString(), _CSV_READ).alias("_r"),
                      F.when(~_sound(text, len(schema)), _bare(text)).alias("_bare"))
    bare = F.col("_bare")  # null: the line is sound
    fault = F.when(bare.isNotNull(), line_fault(F.col(RAW_LINE), len(schema), bare))
    return (lines.where(text != "").select(text.alias(RAW_LINE), F.inline_outer(F.array(parsed)))
            .select("_r.*", fault.alias(MALFORMED), RAW_LINE))
