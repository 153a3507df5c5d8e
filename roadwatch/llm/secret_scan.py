"""Secrets in texts: wide patterns first, then a random forest that removes false findings.

Findings are what looks like a key, a password given to a name, or any long run
of letters and digits. A forest trained from labelled findings judges each by its
length, its changes between kinds of characters, how much of it dictionary words
cover, the path of its document, and the words next to it, hashed. The dictionary is
the corpus's most frequent words, counted over all documents.

Everything is columns and Spark ML; the forest is fitted on a bounded sample.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.stored import stored
from .common import let, named, remainder, whole_text

DICTIONARY = 500  # most frequent words of four letters or more
LABELLED = 20_000  # different labelled findings that the forest is fitted on, at most
TREES, TREE_DEPTH = 30, 6
DRAWS = 4  # rows that copies are dealt to, so that few trees draw none of them
BEFORE, AFTER = 80, 40  # characters of context that are kept
SHORTEST = 8  # characters of a finding

# Shapes of well-known credentials.
SHAPES = [
    ("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    ("aws_key", r"AKIA[0-9A-Z]{16}"),
    ("web_token", r"eyJ[A-Za-z0-9_\-]{10,}\.[A-Za-z0-9_\-]{10,}\.[A-Za-z0-9_\-]{5,}"),
    ("host_token", r"gh[opsu]_[A-Za-z0-9]{30,}|xox[abpr]-[A-Za-z0-9\-]{10,}|sk_live_[A-Za-z0-9]{16,}"),
]
_RUN = r"A-Za-z0-9+/_\-"
FINDING = "|".join([
    SHAPES[0][1],
    rf"(?<![{_RUN}])(?:" + "|".join(s for _, s in SHAPES[1:]) + ")",
    rf"(?<![{_RUN}])(?=[A-Za-z+/_\-]*+[0-9])[{_RUN}]{{16,}}+={{0,2}}",
    # A value ends before the next name of a query string, not at any other ampersand.
    r"(?<=[=:][\"' ]{0,3})(?:(?!&(?:amp;)?[\w.\-]+=)[^\s\"'=:,;]){8,}+",
])
NAMED = r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth)\w*[\"']?\s{0,3}[=:]\s{0,3}[\"']?$"
HARMLESS = r"(?i)(?:commit|sha\d*|md5|checksum|digest|uuid|guid|version|build|example|sample|dummy|placeholder|order|invoice|phone|card)\W{0,3}$"
PATHS = r"(?i)(?:test|example|sample|fixture|mock|doc)"

# What the forest sees, besides the hashed neighbouring words. What ``rule_labels`` goes by is not among them.
NUMBERS = ["length", "changes", "upper", "symbols", "distinct", "vowels", "covered", "assigned", "quoted",
           "test_path", "words_before"]
NEIGHBOURS, BEHIND, NEIGHBOUR_BUCKETS = 3, 2, 128  # words before and after, and what they are hashed into


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             path: str | None = "source") -> DataFrame:
    """One row per finding: doc_id, path, no, start, secret, before, after.

    ``start`` counts characters from 0. ``before`` and ``after`` are the text on
    both sides, other findings included. Null and empty texts have none; repeated
    rows are scanned each.
    """
    clean = F.translate(whole_text(text), "\x01\x02", "  ")
    rows = docs.select(
        named(doc_id).alias("doc_id"),
        (named(path) if path else F.lit(None)).cast("string").alias("path"), clean.alias("t"))
    # Each finding between marks.
    marked = F.regexp_replace("t", F.lit(f"({FINDING})"), F.lit("\x01$1\x02"))
    parts = rows.select("doc_id", "path", F.split(marked, "\x01", -1).alias("parts")).where(
        "size(parts) > 1")
    # As each part but the first begins with a finding, few parts make a whole context.
    tails = F.transform("parts", lambda part: F.substring(F.translate(part, "\x02", ""), -BEFORE, BEFORE))
    heads = F.transform("parts", lambda part: F.substring(F.translate(part, "\x02", ""), 1, AFTER))
    lengths = F.transform("parts", lambda part, i: F.length(part).cast("long") - F.when(i > 0, 1).otherwise(0))
    laid = parts.withColumns({"lengths": lengths, "tails": tails, "heads": heads}).withColumn(
        "ends", running_sums(F.col("lengths")))

    def one(i: Column) -> Column:
        """Part ``i``, counted from 1: the finding at its front and what lies around it."""
        part = F.element_at("parts", i)
        first = F.greatest(i - -(-BEFORE // SHORTEST), F.lit(1))
        previous = F.array_join(F.slice("tails", first, i - first), "")
        following = F.array_join(F.slice("heads", i + 1, F.lit(-(-AFTER // SHORTEST))), "")
        return F.struct(
            (i - 2).alias("no"), F.element_at("ends", i - 1).alias("start"),
            F.substring_index(part, "\x02", 1).alias("secret"),
            F.substring(previous, -BEFORE, BEFORE).alias("before"),
            F.substring(F.concat(F.substring_index(part, "\x02", -1), following), 1, AFTER).alias("after"))
    return laid.select("doc_id", "path", F.inline(F.transform(F.sequence(F.lit(2), F.size("parts")), one)))


def running_sums(numbers: Column, block: int = 256) -> Column:
    """The sum up to and with each number of an array, by blocks, whose sums are summed up themselves."""
    def summed(values: Column) -> Column:
        return F.aggregate(values, F.array().cast("array<long>"), lambda done, x: F.array_append(
            done, x + F.coalesce(F.get(done, F.size(done) - 1), F.lit(0))))

    def joined(blocks: Column) -> Column:
        totals = summed(F.transform(blocks, lambda b: F.element_at(b, -1)))
        shifts = F.concat(F.array(F.lit(0).cast("long")), totals)
        return F.flatten(F.zip_with(blocks, F.slice(shifts, 1, F.size(blocks)), lambda b, shift: F.transform(
            b, lambda x: x + shift)))
    starts = F.sequence(F.lit(1), F.size(numbers), F.lit(block))
    return let(F.transform(starts, lambda at: summed(F.slice(numbers, at, block))), joined)


def dictionary(docs: DataFrame, text: str = "text", words: int = DICTIONARY) -> list[str]:
    """The most frequent words over all documents; of equally frequent ones the first."""
    found = docs.select(F.explode(F.regexp_extract_all(
        F.lower(text), F.lit(r"\p{L}{4,}"), F.lit(0))).alias("word"))
    counted = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(words).collect()]


def _share(pattern: str) -> Column:
    return F.regexp_count("secret", F.lit(pattern)) / F.greatest(F.length("secret"), F.lit(1))


def with_numbers(found: DataFrame, words: list[str]) -> DataFrame:
    """What the forest sees of each finding, and what ``rule_labels`` goes by."""
    length = F.greatest(F.length("secret"), F.lit(1))
    known = "|".join(sorted(words, key=len, reverse=True)) or "(?!)"
    changes = (r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
               r"|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])")
    flag = lambda c: c.cast("double")
    return found.withColumns({
        "length": flag(length), "changes": _share(changes), "digits": _share("[0-9]"),
        "upper": _share("[A-Z]"), "symbols": _share("[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split("secret", ""))) / length,
        "vowels": _share("(?i)[aeiou]"), "hex": _share("[0-9a-f]"),
        "covered": 1 - F.length(F.regexp_replace(F.lower("secret"), F.lit(f"(?:{known})"), F.lit(""))) / length,
        "shape": flag(F.col("secret").rlike("^(?:" + "|".join(s for _, s in SHAPES) + ")$")),
        "named": flag(F.col("before").rlike(NAMED)),
        "harmless": flag(F.col("before").rlike(HARMLESS)),
        "assigned": flag(F.col("before").rlike(r"[=:]\s{0,3}[\"']?$")),
        "quoted": flag(F.col("before").rlike(r"[\"']$")),
        "in_path": flag(F.col("before").rlike(r"[/\\.@]$") | F.col("secret").contains("/")),
        "test_path": flag(F.coalesce(F.col("path").rlike(PATHS), F.lit(False))),
        "words_before": F.regexp_count("before", F.lit(r"\p{L}+")).cast("double"),
        "neighbours": F.concat(
            F.transform(F.slice(F.reverse(_words("before")), 1, NEIGHBOURS),
                        lambda w, i: F.concat(F.when(i == 0, "next<").otherwise("<"), w)),
            F.transform(F.slice(_words("after"), 1, BEHIND), lambda w: F.concat(F.lit(">"), w))),
    })


def _words(column: str) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(r"\p{L}+"), F.lit(0))


def rule_labels(found: DataFrame) -> DataFrame:
    """Labels for findings that rules can tell, null for the rest.

    For corpora without reviewed findings: a known shape, or a value with digits
    given to a credential's name, is a secret; plain numbers, identifiers of the
    usual form, words, and values after a harmless name are not.
    """
    plain = (F.col("secret").rlike(r"^[0-9+\-]+$") | (F.col("digits") == 0)
             | F.col("secret").rlike(r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"))
    return found.withColumn("label", F.when(F.col("shape") > 0, 1.0).when(
        plain | (F.col("harmless") > 0), 0.0).when(F.col("named") > 0, 1.0).when(
        F.col("in_path") > 0, 0.0))


def judge(found: DataFrame, labelled: DataFrame) -> DataFrame:
    """Add ``probability`` (of a real secret) to findings with numbers.

    ``labelled`` has the same numbers and a ``label`` of 0 or 1. The forest is
    fitted on at most ``LABELLED`` different ones, by hash, weighted by their
    copies; a kind has half the places or what the other leaves, and weighs what
    all of its findings do. Without labels of both kinds nothing can be told
    apart and nothing is removed: the probability is 1.
    """
    folded = stored(labelled.where("label IS NOT NULL").groupBy(
        *NUMBERS, "neighbours", F.col("label").cast("double").alias("label")).agg(
        F.count(F.lit(1)).alias("copies")), "secret-folded")
    kinds = {r["label"]: r for r in folded.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies")).collect()}
    if set(kinds) != {0.0, 1.0}:
        return found.withColumn("probability", F.lit(1.0))
    ordered = folded.withColumn("order", F.xxhash64(*NUMBERS, "neighbours"))
    chosen = [ordered.where(F.col("label") == kind).orderBy("order", *NUMBERS, "neighbours").limit(
        max(LABELLED // 2, LABELLED - kinds[1 - kind]["n"])) for kind in kinds]
    sample = stored(reduce(DataFrame.unionByName, chosen).coalesce(1), "secret-labelled")
    held = {r["label"]: r["copies"] for r in sample.groupBy("label").agg(
        F.sum("copies").alias("copies")).collect()}
    share = F.when(F.col("label") == 1, kinds[1.0]["copies"] / held[1.0]).otherwise(
        kinds[0.0]["copies"] / held[0.0])
    draws = F.least("copies", F.lit(DRAWS))
    sample = sample.withColumn("__weight", F.col("copies") * share / draws).withColumn(
        "__draw", F.explode(F.sequence(F.lit(1), draws.cast("int"))))
    words = HashingTF(inputCol="neighbours", outputCol="__words", numFeatures=NEIGHBOUR_BUCKETS, binary=True)
    assembled = VectorAssembler(inputCols=[*NUMBERS, "__words"], outputCol="__vector", handleInvalid="keep")

    def vectors(rows: DataFrame) -> DataFrame:
        return assembled.transform(words.transform(rows))
    forest = RandomForestClassifier(
        featuresCol="__vector", labelCol="label", weightCol="__weight", numTrees=TREES,
        maxDepth=TREE_DEPTH, seed=17, featureSubsetStrategy="onethird", predictionCol="__prediction",
        rawPredictionCol="__raw", probabilityCol="__chances")
    model = forest.fit(vectors(sample))
    return model.transform(vectors(found)).withColumn(
        "probability", vector_to_array("__chances")[1]).drop(
        "__words", "__vector", "__prediction", "__raw", "__chances")


def scan(docs: DataFrame, labelled: DataFrame | None = None, doc_id: str = "doc_id",
         text: str = "text", path: str | None = "source", least: float = 0.5) -> DataFrame:
    """One row per finding: doc_id, no, start, secret, kind, held_out, probability, is_secret.

    Without ``labelled`` findings (with_numbers plus ``label``) the forest learns
    from ``rule_labels`` on documents whose id's crc32, modulo 3, is not 1; the
    others are ``held_out``. Null and empty texts, and empty tables, give no row;
    a null path is no test path; other columns are ignored.
    """
    words = dictionary(docs, text)
    found = stored(with_numbers(findings(docs, doc_id, text, path), words), "secret-findings")
    found = found.withColumn("held_out", remainder("doc_id", 3) == 1)
    if labelled is None:
        labelled = rule_labels(found.where("NOT held_out"))
    kind = reduce(lambda rest, s: F.when(F.col("secret").rlike(f"^(?:{s[1]})$"), s[0]).otherwise(rest),
                  reversed(SHAPES), F.when(F.col("assigned") > 0, "assigned").otherwise("run"))
    return judge(found, labelled).select(
        "doc_id", "no", "start", "secret", kind.alias("kind"), "held_out", "probability",
        (F.col("probability") >= least).alias("is_secret"))
