"""Quality rules, centroid clustering and the filter audit against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from roadwatch.llm import audit, centroids, quality_rules as q

FEW = settings(max_examples=60, deadline=None)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules ----------------------------------------------------------

def repeated(words):
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i:i + 3])].append(i)
    return len({i + k for starts in places.values() if len(starts) > 1 for i in starts for k in range(3)})


@pytest.mark.parametrize("place_bits", [q.PLACE_BITS, 4, 62])
def test_repeated_words(spark, place_bits):
    """Four bits hold too few places, sixty-two leave the hash two bits: words decide then."""
    rng = random.Random(5)
    texts = [[rng.choice("abcde"[:rng.randint(1, 5)]) for _ in range(rng.randint(0, 40))] for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, words array<string>")
    found = {r["i"]: r["n"] for r in rows.select("i", q.repeat_words(F.col("words"), place_bits).alias("n")).collect()}
    assert found == {i: repeated(words) for i, words in enumerate(texts)}


def test_a_very_long_text(spark):
    words = [f"w{i}" for i in range(200_000)] + ["x", "y", "z"] * 2
    rows = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = q.ledger(rows).first()
    assert (row["n_words"], row["n_repeat_words"]) == (200_006, 6)


POLICIES = [q.Policy("hard", 1, ("few_words", "symbols")),
            q.Policy("soft", 3, ("symbols",), ("no_stop_words", "capitals", "few_words"), 1)]


def verdict(failed, policy, without=()):
    bad = [n for n in policy.hard if n in failed and n not in without]
    soft = [n for n in policy.soft if n in failed and n not in without]
    return not bad and len(soft) <= policy.allowed


def test_policies_and_ablations(spark):
    names = [rule.name for rule in q.RULES]
    rng = random.Random(3)
    docs = [(i, frozenset(rng.sample(names, rng.randint(0, 4)))) for i in range(400)]
    rows = spark.createDataFrame([(i, q.bits(*failed)) for i, failed in docs], "doc_id long, failed long")
    for policy in POLICIES:
        kept = {r["doc_id"]: r for r in q.judge(rows, policy).collect()}
        for i, failed in docs:
            mine = [n for n in (*policy.hard, *policy.soft) if n in failed]
            assert kept[i]["kept"] == verdict(failed, policy)
            alone = mine[0] if len(mine) == 1 and not verdict(failed, policy) else None
            assert kept[i]["only_rule"] == alone
    got = {(r["policy"], r["rule"]): tuple(r)[3:] for r in q.ablations(rows, POLICIES).collect()}
    wanted = {(p.name, n): (len(docs), sum(verdict(f, p) for _, f in docs), sum(n in f for _, f in docs),
                            sum(verdict(f, p, (n,)) for _, f in docs))
              for p in POLICIES for n in (*p.hard, *p.soft)}
    assert got == wanted
    both = q.common_failures(rows).first()
    assert both["failed_by_some"] == q.bits(*set().union(*(f for _, f in docs))) and both["failed_by_all"] == 0


def test_rules_keep_their_bits():
    """Ledgers outlive a release: a rule's place is fixed."""
    assert [rule.name for rule in q.RULES[:3]] == ["few_words", "repeated_words", "many_words"]
    assert all(set(p.hard + p.soft) <= {rule.name for rule in q.RULES} for p in q.POLICIES)


# --- centroid clustering ----------------------------------------------------

@FEW
@given(st.integers(1, 12), st.integers(1, 4), st.integers(1, 40), st.integers(0, 2 ** 32 - 1),
       st.sampled_from([3, 50, 1 << 25]))
def test_orchard_finds_the_nearest(k, dims, n, seed, width):
    rng = np.random.default_rng(seed)
    points, vectors = rng.integers(-width, width, (k, dims)), rng.integers(-width, width, (n, dims))
    number, distance, _ = centroids.nearest(vectors, centroids.Lists.of(points))
    squares = ((vectors[:, None, :].astype(np.int64) - points) ** 2).sum(axis=2)
    assert (number == squares.argmin(axis=1)).all(), "of equal distances the smaller number"
    assert (distance == squares.min(axis=1)).all()


def test_far_centroids_are_not_compared():
    rng = np.random.default_rng(1)
    points = rng.integers(-1000, 1000, (40, 64))
    vectors = points[rng.integers(0, 40, 2000)] + rng.integers(-20, 20, (2000, 64))
    number, _, compared = centroids.nearest(vectors, centroids.Lists.of(points))
    assert compared < 0.75 * 2000 * 40


def plain_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'null' if i is None else i}".encode()).hexdigest()
    points = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for c, held in groups.items():
            points[c] = [sum(x) // len(held) for x in zip(*held)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, c, d in found:
        per[c] += d
    return sorted((str(i), c, d, per[c], sum(per.values()),
                   hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest()) for i, c, d in found)


def test_clusters_by_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(120)]
    rows += [(5, [0.5, 0.5, 0.5])] * 3 + [(None, [1.0, 2.0, 3.0])] * 2 + [(200 + i, [0.25] * 3) for i in range(60)]
    rows += [(300, None), (301, []), (302, [1.0] * 2), (303, [1.0] * 4), (304, [1.0, None, 2.0]),
             (305, [1.0, float("nan"), 2.0]), (306, [1.0, float("inf"), 2.0])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows],
                               "vec_id long, embedding array<double>, cluster string, sums string").repartition(5)
    for k in (7, 400):
        got = sorted((str(r[0]), *tuple(r)[1:]) for r in centroids.cluster(df, k, 3, dims=3).collect())
        assert got == plain_clusters(rows, k, 3, 3)


def test_no_vectors_and_huge_ones(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None), (2, [1.0])]):
        empty = centroids.cluster(spark.createDataFrame(rows, schema), dims=3)
        assert empty.collect() == [] and empty.columns[0] == "vec_id"
    huge = spark.createDataFrame([(1, [3e38, 0.0, -3e38]), (2, [-3e38, 0.0, 3e38]), (3, [0.0, 0.0, 0.0])], schema)
    got = {r["vec_id"]: r for r in centroids.cluster(huge, 1, 0, dims=3).collect()}
    assert sorted(r["distance"] for r in got.values())[0] == 0 and len(got) == 3


# --- filter audit -----------------------------------------------------------

def plain_audit(docs, labels):
    """Every order, filter by filter, document by document."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    ids = defaultdict(list)
    for i, text, _ in docs:
        if i is not None:
            ids[text or ""].append(i)
    rows = []
    for i, text, part in docs:
        text = text or ""
        words, first = WORD.findall(text), min(ids[text], default=None)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": first is not None and (i is None or first < i)}
        rows.append((part or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    result, shapley = {}, Counter()
    for order in itertools.permutations("ABCDE"):
        for step, name in enumerate(order, 1):
            before = set(order[:step - 1])
            for part in {r[0] for r in rows}:
                mine = [r for r in rows if r[0] == part]
                gone = [r for r in mine if not r[1] & before and name in r[1]]
                result[part, "".join(order), step] = [
                    sum(not r[1] & (before | {name}) for r in mine), len(gone),
                    sum(name in r[1] and bool(r[1] & before) for r in mine), sum(r[1] == {name} for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, name] += len(gone)
    return {key: (*row, shapley[key[0], key[1][key[2] - 1]]) for key, row in result.items()}


@pytest.mark.parametrize("identify", [F.xxhash64, lambda t: F.length(t).cast("long")], ids=["hash", "length"])
def test_audit_by_brute_force(spark, monkeypatch, identify):
    """The second fingerprint is the text's length: different texts share one."""
    monkeypatch.setattr(audit, "SEGMENT_TEXTS", 4)
    rng = random.Random(4)
    texts = ["", None, "a b c", "A B C", "a # c", "x y z", " ".join(f"w{i}" for i in range(150)),
             " ".join(f"V{i}" for i in range(150)), "w " * 120, "a  c #"]
    docs = [(rng.choice([None, *range(12)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(90)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in [*range(8), 3, 3, None]]
    df = spark.createDataFrame([(*d, "x", "y") for d in docs],
                               "doc_id long, text string, lang string, mask string, print string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    counts = audit.flag_counts(df, known, identify=identify)
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit.audit(counts).collect()}
    assert got == plain_audit(docs, labels)


def test_the_sketch_clears_no_repeat(spark):
    """Many segments, many tasks: no fingerprint that occurs twice is cleared, and most others are."""
    rows = spark.range(30_000).select(F.xxhash64(F.when(F.col("id") % 10 == 0, F.col("id") % 700)
                                                 .otherwise(F.col("id"))).alias("print")).repartition(6)
    counts = rows.groupBy("print").count()
    twice = {r["print"] for r in counts.where("count > 1").collect()}
    found = [r["print"] for r in audit.possible_repeats(rows, 30_000, segment_texts=2_000).collect()]
    assert twice <= set(found) and len(found) == len(set(found)) < len(twice) + 0.02 * 30_000
