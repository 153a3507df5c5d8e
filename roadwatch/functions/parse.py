"""Delimited text to typed columns, all with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType


def _literal(sep: str) -> str:
    """The separator as a pattern; a lone plain character keeps Java's fast split."""
    if len(sep) == 1:
        return f"\\{sep}" if sep in ".$|()[{^?*+\\" else sep
    return f"\\Q{sep}\\E"


def split_on(text: Column, sep: str) -> Column:
    return F.split(text, _literal(sep))


def parse_delimited(df: DataFrame, schema: StructType, sep: str,
                    line: str = "value") -> DataFrame:
    """Add one typed column per field of ``schema`` and a ``parsed_ok`` flag.

    Missing fields and values that do not convert become null and clear the
    flag, so one bad line never fails the job. Extra fields are ignored.
    """
    # Exploding a one-element array splits each line once: otherwise the filter on
    # the flag moves below the split and repeats it for every field.
    split = df.select("*", F.explode(F.array(split_on(F.col(line), sep))).alias("__parts"))
    raw = {f.name: F.try_element_at("__parts", F.lit(i + 1))
           for i, f in enumerate(schema.fields)}
    typed = {f.name: raw[f.name] if isinstance(f.dataType, StringType)
             else F.trim(raw[f.name]).try_cast(f.dataType) for f in schema.fields}
    ok = F.lit(True)
    for column in typed.values():
        ok = ok & column.isNotNull()
    return split.withColumns({**typed, "parsed_ok": ok}).drop("__parts")


def accepted(parsed: DataFrame, *drop: str) -> DataFrame:
    return parsed.where("parsed_ok").drop("parsed_ok", *drop)


def rejected(parsed: DataFrame, *keep: str) -> DataFrame:
    """The lines that did not parse, for a reject output."""
    return parsed.where("not parsed_ok").select(*keep)


def tokens(text: Column, sep: str = "\t") -> Column:
    """Words of a line; empty words at the end are dropped, inner ones kept."""
    trimmed = (F.rtrim(text, F.lit(sep)) if len(sep) == 1
               else F.regexp_replace(text, f"({_literal(sep)})+$", ""))
    nothing = (trimmed == "") & (text != "")
    return F.when(nothing, F.array().cast("array<string>")).otherwise(split_on(trimmed, sep))


def tokenise(df: DataFrame, text: str, sep: str = "\t") -> DataFrame:
    """One row (word, 1) per word."""
    return df.select(F.explode(tokens(F.col(text), sep)).alias("word"), F.lit(1).alias("one"))
