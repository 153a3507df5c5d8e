"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and
one number whose bit i says that rule i failed. Policies are versioned choices of
rules and read only that number: a policy can be changed, compared or taken apart
without a text being read again. Ablations fold the ledger by that number first,
so they work on at most one row per combination of failures.

A rule keeps its bit for good; new rules are added at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import free_name, let, named, whole_text

BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
WINDOW = 3  # words of a repeated window
PLACE_BITS = 21  # of a packed window: its place; the other bits are its hash

# Frequent words of the four languages.
STOP_WORDS = {
    "en": ("the", "be", "to", "of", "and", "that", "have", "with"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "mit"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "que"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "con"),
}


def words_of(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP, -1))


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(BLANKS)) != "")


def _covered(starts: Column) -> Column:
    """How many places windows at these ascending starts cover."""
    return F.aggregate(F.transform(starts, lambda at, i: F.coalesce(F.least(
        F.get(starts, i + 1) - at, F.lit(WINDOW).cast("long")), F.lit(WINDOW).cast("long"))),
        F.lit(0).cast("long"), lambda a, b: a + b)


def _same_words(words: Column, a: Column, b: Column) -> Column:
    at = [words[(a + i).cast("int")] == words[(b + i).cast("int")] for i in range(WINDOW)]
    return at[0] & at[1] & at[2]


def _hash_of(words: Column, i: Column) -> Column:
    return F.xxhash64(*[words[(i + k).cast("int")] for k in range(WINDOW)])


def _starts_by_words(words: Column) -> Column:
    """The windows that occur again, found by sorting windows with their words."""
    windows = F.transform(_places(words), lambda i: F.struct(
        _hash_of(words, i).alias("h"), *[words[(i + k).cast("int")].alias(f"w{k}") for k in range(WINDOW)],
        i.alias("at")))

    def again(rows: Column) -> Column:
        def same(row: Column, other: Column) -> Column:
            return F.coalesce(row["h"] == other["h"], F.lit(False)) & _same_words(words, row["at"], other["at"])
        return F.filter(rows, lambda row, j: same(row, F.get(rows, j - 1)) | same(row, F.get(rows, j + 1)))
    return F.sort_array(F.transform(let(F.sort_array(windows), again), lambda row: row["at"]))


def _places(words: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), (F.size(words) - WINDOW).cast("long"))


def _repeated_starts(words: Column, place_bits: int) -> Column:
    """The same by sorting single numbers, hash and place in one.

    Windows with equal hash bits are compared word by word; where one of them
    differs, or where places need more bits, ``_starts_by_words`` decides.
    """
    place = (1 << place_bits) - 1
    packed = F.transform(_places(words), lambda i: _hash_of(words, i).bitwiseAND(F.lit(~place)).bitwiseOR(i))

    def high(x: Column) -> Column:
        return F.shiftright(x, place_bits)

    def low(x: Column) -> Column:
        return x.bitwiseAND(F.lit(place))

    def found(rows: Column) -> Column:
        def near(row: Column, other: Column) -> Column:
            return F.coalesce(high(row) == high(other), F.lit(False))
        return F.filter(rows, lambda row, j: near(row, F.get(rows, j - 1)) | near(row, F.get(rows, j + 1)))

    def verified(rows: Column) -> Column:
        unequal = F.exists(F.transform(rows, lambda row, j: F.coalesce(
            (high(row) == high(F.get(rows, j - 1)))
            & ~_same_words(words, low(row), low(F.get(rows, j - 1))), F.lit(False))), lambda x: x)
        return F.when(unequal, _starts_by_words(words)).otherwise(F.sort_array(F.transform(rows, low)))
    quick = let(let(F.sort_array(packed), found), verified)
    return F.when(F.size(words) <= place, quick).otherwise(_starts_by_words(words))


def repeat_words(words: Column, place_bits: int = PLACE_BITS) -> Column:
    """Words in windows that the text holds at least twice, the first one included. Exact."""
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(
        let(_repeated_starts(words, place_bits), _covered))


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # over the measurements


RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_words", "n_words > 100000"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("few_letters", "5 * n_letter_words < 4 * n_words"),
    Rule("ellipses", "10 * n_ellipsis_lines > 3 * n_lines"),
    Rule("bullets", "10 * n_bullet_lines > 9 * n_lines"),
    Rule("no_stop_words", "n_stop_kinds < 2"),
    Rule("capitals", "100 * n_capitals > 30 * word_chars"),
]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_letter_words", "n_ellipsis_lines", "n_bullet_lines", "n_stop_kinds", "n_capitals"]


def bits(*names: str, rules: Sequence[Rule] = RULES) -> int:
    place = {rule.name: i for i, rule in enumerate(rules)}
    return sum(1 << place[name] for name in names)


@dataclass(frozen=True)
class Policy:
    """A document stays that fails no ``hard`` rule and at most ``allowed`` of the ``soft`` ones."""

    name: str
    version: int
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    allowed: int = 0

    def keeps(self, failed: Column, rules: Sequence[Rule] = RULES, without: int = 0) -> Column:
        """The verdict on failure bits, as if the rules of the bits ``without`` did not exist."""
        hard, soft = (bits(*names, rules=rules) & ~without for names in (self.hard, self.soft))
        return (failed.bitwiseAND(F.lit(hard)) == 0) & (
            F.bit_count(failed.bitwiseAND(F.lit(soft))) <= self.allowed)


BASE = ("few_words", "repeated_words")
POLICIES = [
    Policy("base", 1, BASE),
    Policy("web", 1, (*BASE, "many_words", "short_words", "long_words", "symbols", "repeated_lines",
                      "few_letters", "ellipses", "bullets", "no_stop_words")),
    Policy("web", 2, (*BASE, "many_words", "symbols", "repeated_lines", "few_letters"),
           ("short_words", "long_words", "ellipses", "bullets", "no_stop_words", "capitals"), 1),
]
POLICY = POLICIES[-1]


def _measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    letters = F.regexp_replace(text, r"[^\p{L}\x20\x09-\x0D]+", "")
    stop_words = sorted({word for of in STOP_WORDS.values() for word in of})
    small = F.transform(words, F.lower)
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(text, GAP, "")),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeat_words(words),
        "n_lines": F.size(lines),
        "n_letter_words": F.regexp_count(letters, F.lit(WORD)),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda l: F.rtrim(l, F.lit(BLANKS)).rlike(r"(\.\.\.|…)\z"))),
        "n_bullet_lines": F.size(F.filter(lines, lambda l: F.ltrim(l, F.lit(BLANKS)).rlike(r"\A[•*-]"))),
        "n_stop_kinds": F.size(F.array_intersect(small, F.array(*map(F.lit, stop_words)))),
        "n_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")),
    }
    return {name: column.cast("long") for name, column in found.items()}


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, the measurements, and ``failed``, one bit per rule.

    A null text has no words and no lines. Words are separated by ASCII white
    space; lines without a word count nowhere. Repeated rows and null ids have a
    row each. An empty table gives an empty ledger; other columns are ignored.
    """
    rows = docs.select(named(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    cut = rows.select("doc_id", "text", words_of(F.col("text")).alias("words"), lines_of(F.col("text")).alias("lines"))
    measured = cut.select("doc_id", *[
        c.alias(name) for name, c in _measures(F.col("text"), F.col("words"), F.col("lines")).items()])
    failed = F.lit(0).cast("long")
    for place, rule in enumerate(rules):
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed", failed)


def judge(rows: DataFrame, policy: Policy = POLICY, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Ledger rows with the policy's verdict: policy, version, kept, and ``only_rule``, the rule
    without which the document would stay, where there is just one."""
    failed = F.col("failed")
    of_policy = bits(*policy.hard, *policy.soft, rules=rules)
    blamed = failed.bitwiseAND(F.lit(of_policy))
    alone = F.when(~policy.keeps(failed, rules) & (F.bit_count(blamed) == 1), F.element_at(
        F.array(*[F.lit(rule.name) for rule in rules]), (F.round(F.log2(blamed.cast("double"))) + 1).cast("int")))
    return rows.withColumns({"policy": F.lit(policy.name), "version": F.lit(policy.version),
                             "kept": policy.keeps(failed, rules), "only_rule": alone})


def ablations(rows: DataFrame, policies: Sequence[Policy] = tuple(POLICIES),
              rules: Sequence[Rule] = RULES, by: Sequence[str] = ()) -> DataFrame:
    """Per policy and rule of it: documents, kept, failing the rule, and kept without the rule.

    The ledger is folded by its failure bits first, with map-side combine; the
    policies then work on those few rows. ``by`` are columns to report apart.
    An empty ledger gives an empty result.
    """
    count = free_name(rows, "__n")
    folded = rows.groupBy(*by, "failed").agg(F.count(F.lit(1)).alias(count))
    failed, n = F.col("failed"), F.col(count)
    cases = []
    for policy in policies:
        for name in (*policy.hard, *policy.soft):
            bit = bits(name, rules=rules)
            cases.append(F.struct(
                F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"),
                F.lit(name).alias("rule"), n.alias("documents"),
                F.when(policy.keeps(failed, rules), n).otherwise(0).alias("kept"),
                F.when(failed.bitwiseAND(F.lit(bit)) != 0, n).otherwise(0).alias("failing"),
                F.when(policy.keeps(failed, rules, without=bit), n).otherwise(0).alias("kept_without")))
    spread = folded.select(*by, F.inline(F.array(*cases)))
    return spread.groupBy(*by, "policy", "version", "rule").agg(
        *[F.sum(c).alias(c) for c in ("documents", "kept", "failing", "kept_without")])


def common_failures(rows: DataFrame, by: Sequence[str] = (), rules: Sequence[Rule] = RULES) -> DataFrame:
    """Which rules every document of a group fails, and which some document fails, as bits."""
    return rows.groupBy(*by).agg(F.bit_and("failed").alias("failed_by_all"),
                                 F.bit_or("failed").alias("failed_by_some"))
