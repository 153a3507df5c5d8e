"""Exact duplicates by content-defined chunk recipes.

A text without its white space is cut into chunks where its content says so, so
equal passages give equal chunks wherever they stand. A chunk's identifier is a
64-bit fingerprint that is verified: all chunks are grouped by (fingerprint,
content) once, and a fingerprint with two contents is found. A text's recipe is
the ordered list of its chunk identifiers; texts are equal when their recipes
are. Contents move once, as chunks, folded before the shuffle; everything after
that moves only recipes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.stored import stored
from .common import WHITE, free_name, named, whole_text

LEAST, MOST = 256, 2048  # characters of a chunk


def _cut_rule(least: int, most: int) -> str:
    """A chunk ends after two characters of a fixed sixteenth of the code points, the end of the
    text, or ``most`` characters."""
    chosen = "".join(rf"\x{{{c:X}}}" for c in range(0x21, 0x250) if c % 16 == 5)
    return rf"(?s).{{{least},{most - 2}}}?(?:[{chosen}][{chosen}]|\z)|.{{1,{most}}}"


def normal(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, "")


def _wide_rule(least: int, most: int) -> str:
    """The same for texts as UTF-8 bytes: a chunk ends behind two following letters whose last bytes are
    of the chosen sixteenth."""
    chosen = "".join(rf"\x{{{c:X}}}" for c in range(0x80, 0xC0) if c % 16 == 5)
    return (rf"(?s).{{{least},{most - 4}}}?(?:[{chosen}][\x{{80}}-\x{{FF}}]{{0,2}}[{chosen}]|\z)|.{{1,{most}}}")


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """A text's chunks; those of a text mostly in other than Latin letters are of its UTF-8 bytes, one
    character each. Pass a column: it is used several times."""
    narrow = F.regexp_extract_all(text, F.lit(_cut_rule(least, most)), F.lit(0))
    as_bytes = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    wide = F.regexp_extract_all(as_bytes, F.lit(_wide_rule(least, most)), F.lit(0))
    return F.when(2 * F.octet_length(text) > 3 * F.length(text), wide).otherwise(narrow)


def fingerprint(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _recipe(pieces: Column, identify: Callable[[Column], Column]) -> Column:
    return F.transform(pieces, identify)


def ambiguous_chunks(docs: DataFrame, text: str, identify: Callable[[Column], Column]) -> DataFrame:
    """The fingerprints that stand for more than one content."""
    squeezed = docs.select(normal(whole_text(text)).alias("squeezed"))
    contents = (squeezed.select(F.explode(chunks(F.col("squeezed"))).alias("chunk"))
                .select(identify(F.col("chunk")).alias("fp"), "chunk")
                .groupBy("fp", "chunk").agg(F.count(F.lit(1)).alias("n")))
    return contents.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 identify: Callable[[Column], Column] = fingerprint) -> DataFrame:
    """One row per document with its group of equal texts.

    Equal means identical without white space; a null text is an empty one. Of
    a group the row with the most characters in the original text stays, of
    equals the one with the smallest id; a null id comes last. Of rows that repeat
    id and text one is ``kept`` and each counts in ``group_size``. An empty table
    gives an empty result. Other columns are ignored.
    """
    verified = stored(ambiguous_chunks(docs, text, identify), "dedup-ambiguous")
    squeezed = docs.select(
        named(doc_id).alias("doc_id"), F.length(whole_text(text)).cast("long").alias("chars"),
        normal(whole_text(text)).alias("squeezed"))
    rows = squeezed.select(
        "doc_id", "chars", F.sha2("squeezed", 256).alias("text_sha256"),
        _recipe(chunks(F.col("squeezed")), identify).alias("recipe"),
        *([] if verified.isEmpty() else ["squeezed"]))
    if "squeezed" in rows.columns:
        rows = _with_contents(rows, verified)
    else:
        rows = rows.withColumn("contents", F.lit(None).cast("string"))
    # The stored rows have a number each, which tells repeated ones apart.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "dedup-recipes")
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"),
                          F.col("doc_id").alias("id"), "row"))
    key = ["recipe", "contents"]
    groups = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
              .where("group_size > 1")
              .select(*key, "group_size", F.col("best.id").alias("keep"), F.col("best.row").alias("kept_row")))
    groups = stored(groups, "dedup-groups")
    same = (rows["recipe"] == groups["recipe"]) & rows["contents"].eqNullSafe(groups["contents"])
    joined = rows.join(groups.withColumn("found", F.lit(True)), same, "left")
    found = F.col("found").isNotNull()
    return joined.select(
        rows["doc_id"],
        F.when(found, F.col("keep")).otherwise(rows["doc_id"]).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(found, F.col("row") == F.col("kept_row")).otherwise(True).alias("kept"),
        "text_sha256")


def _with_contents(rows: DataFrame, verified: DataFrame) -> DataFrame:
    """Where a fingerprint is ambiguous, the text itself joins the recipe as key."""
    unsure = (rows.select("recipe").distinct()
              .select("recipe", F.explode("recipe").alias("fp"))
              .join(verified, "fp", "left_semi").select("recipe").distinct()
              .withColumn("unsure", F.lit(True)))
    return (rows.join(unsure, "recipe", "left")
            .withColumn("contents", F.when(F.col("unsure"), F.col("squeezed")))
            .drop("unsure", "squeezed"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns, whatever their names and types.

    One row of each group of equal texts, as ``exact_groups`` marks them; of rows
    that repeat the id and text but differ elsewhere, the first by their JSON. Null
    texts are empty ones. An empty table stays empty.
    """
    groups = exact_groups(docs, doc_id, text)
    staying = stored(groups.groupBy("doc_id", "text_sha256").agg(
        F.count(F.lit(1)).alias("times"), F.max("kept").alias("kept")).where("kept").drop("kept"), "dedup-staying")
    columns = [named(c) for c in docs.columns]
    own, sha, times, digest, row = (free_name(docs, n) for n in ("__id", "__sha", "__times", "__digest", "__row"))
    marked = docs.select(*columns, F.sha2(normal(whole_text(text)), 256).alias(digest))
    known = staying.select(F.col("doc_id").alias(own), F.col("text_sha256").alias(sha), F.col("times").alias(times))
    joined = marked.join(known, named(doc_id).eqNullSafe(F.col(own)) & (F.col(digest) == F.col(sha)))
    single = joined.where(F.col(times) == 1).select(*columns)
    if staying.where("times > 1").isEmpty():
        return single
    whole = F.struct(*columns)
    repeated = (joined.where(F.col(times) > 1).groupBy(own, sha)
                .agg(F.min_by(whole, F.to_json(whole)).alias(row)).select(f"{row}.*"))
    return single.unionByName(repeated)
