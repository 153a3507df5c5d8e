"""The registered queries: against their SQL, or against brute force over whole tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
import oracle
from roadwatch.llm import decontaminate, ngram_join, secret_scan, token_ids
from roadwatch.llm.queries import QUERIES, SHARDS, SQL, tokenizer_file


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, sf_dir, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), SQL[name]) == []


def test_token_ids(spark, sf_dir, docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_file())
    tokenizer.encode_special_tokens = True
    found = {r["doc_id"]: r for r in QUERIES["op1_token_ids"](spark, sf_dir).collect()}
    start = 0
    for doc_id in sorted(docs):
        ids = tokenizer.encode(docs[doc_id]["text"] or "", add_special_tokens=False).ids + [0]
        row = found[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (
            start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(found) == len(docs)


def test_packing(spark, sf_dir, docs):
    rows = QUERIES["op2_best_fit_packing"](spark, sf_dir).collect()
    lengths = dict(zip(docs, map(len, token_ids.Encoder(tokenizer_file()).whole([r["text"] or "" for r in docs.values()]))))
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["bin"]].append(r)
    for doc_id, doc in docs.items():
        n = lengths[doc_id] // 4 + 1
        mine = sorted(pieces[doc_id], key=lambda r: r["start"])
        assert mine[0]["start"] == 0 and sum(r["length"] for r in mine) == n
        assert all(a["start"] + a["length"] == b["start"] for a, b in zip(mine, mine[1:]))
    for held in bins.values():
        held.sort(key=lambda r: r["bin_offset"])
        used = 0
        for r in held:
            assert r["bin_offset"] == used
            used += r["length"]
        assert used <= held[0]["bin_size"] and (held[0]["bin_size"] == 512 or used > held[0]["bin_size"] // 2)
    fill = sum(r["length"] for r in rows) / sum(h[0]["bin_size"] for h in bins.values())
    assert fill > 0.97


def test_lm_scores(spark, sf_dir, docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(lower)) + [None]
             for d, r in docs.items()}
    fold = {d: zlib.crc32(str(d).encode()) % 7 for d in docs}
    counts = Counter(w for d, ws in words.items() if fold[d] != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    found = {r["doc_id"]: r for r in QUERIES["op4_lm_scoring"](spark, sf_dir).collect()}
    assert set(found) == set(docs)
    for d, ws in words.items():
        r = found[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            fold[d] == 2, len(ws), sum(counts[w] > 0 for w in ws), n)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held), "better than the base"


def test_shards(spark, sf_dir, docs):
    rows = QUERIES["op5_sharding"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        d: (len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for d, r in docs.items()}
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert set(slots) <= set(range(SHARDS))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_languages(spark, sf_dir, docs):
    rows = QUERIES["op7_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in docs if zlib.crc32(str(d).encode()) % 3 == 1}
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in rows)


def test_near_duplicates(spark, sf_dir, docs):
    sets = {d: frozenset(ngram_join.shingles(r["text"]).tolist()) for d, r in docs.items()}
    holders = defaultdict(list)
    for d, runs in sets.items():
        for run in runs:
            holders[run].append(d)
    shared = Counter((a, b) for ds in holders.values() for i, a in enumerate(ds) for b in ds[i + 1:])
    links, root = Counter(), {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            a, b = sorted((find(a), find(b)))
            root[b] = a
    rows = QUERIES["op8_ngram_join"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == {
        d: (find(d), links[d]) for d in docs}
    assert {r["doc_id"] for r in rows if r["kept"]} == {find(d) for d in docs}


def test_leaks(spark, sf_dir, docs):
    items = {r["item_id"]: decontaminate.words_of(r["text"])
             for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    texts = {d: b" %b " % b" ".join(decontaminate.words_of(r["text"])) for d, r in docs.items()}
    exact = {(d, i) for i, w in items.items() for d, t in texts.items() if b" %b " % b" ".join(w) in t}
    rows = QUERIES["op9_decontamination"](spark, sf_dir).collect()
    found = {(r["doc_id"], r["item_id"]): r for r in rows}
    assert exact and exact <= set(found)
    for (d, i), r in found.items():
        wanted, words = items[i], decontaminate.words_of(docs[d]["text"])
        assert r["edits"] <= int(0.2 * len(wanted) + 1e-9) and (r["edits"] == 0) == ((d, i) in exact)
        assert r["edits"] == brute_distance(wanted, words)


def test_no_near_match_is_missed(spark):
    """Every document and item of the smallest tables by plain edit distance."""
    folder = "/root/testdata/sf0.001"
    items = {r["item_id"]: decontaminate._spaced(r["text"]).split()
             for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    codes = {}
    number = lambda words: np.array([codes.setdefault(w, len(codes)) for w in words], int)
    coded = {i: number(w) for i, w in items.items()}
    wanted = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        text = number(decontaminate._spaced(r["text"] or "").split())
        for i, item in coded.items():
            if np.isin(item, text).mean() >= 0.7:  # fewer cannot be within a fifth of edits
                edits, _ = decontaminate.edit_distance(item, text)
                if edits <= decontaminate.most_edits(len(item)):
                    wanted[r["doc_id"], i] = edits
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in QUERIES["op9_decontamination"](spark, folder).collect()}
    assert found == wanted and found


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (word != other)))
        row = new
    return min(row)


def test_secrets(spark, sf_dir, docs):
    rows = QUERIES["op10_secret_scan"](spark, sf_dir).collect()
    planted = {(d, zlib.crc32(m[1].encode())) for d, r in docs.items() for m in re.finditer(
        r"(?:password=|token = \")([0-9a-f]{18,40})|(?=x)y", r["text"] or "")}
    found = {(r["doc_id"], r["secret_crc32"]) for r in rows if r["is_secret"]}
    assert planted and planted <= found
    assert all(zlib.crc32(docs[r["doc_id"]]["text"][r["start"]:r["start"] + r["length"]].encode())
               == r["secret_crc32"] for r in rows)
    assert any(not r["is_secret"] for r in rows), "false findings go"


def test_the_forest_agrees_on_held_out_findings(spark):
    """It does not see what the labels go by: shape, digits and the names before a value."""
    assert not {"shape", "digits", "harmless", "named", "in_path"} & set(secret_scan.NUMBERS)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = secret_scan.with_numbers(secret_scan.findings(docs), secret_scan.dictionary(docs)).withColumn(
        "held_out", secret_scan.remainder("doc_id", 3) == 1)
    labelled = secret_scan.rule_labels(found.where("NOT held_out"))
    judged = secret_scan.rule_labels(secret_scan.judge(found.where("held_out"), labelled)).where("label IS NOT NULL")
    rows = [(r["label"] == 1, r["probability"] >= 0.5) for r in judged.select("label", "probability").collect()]
    true = sum(a and b for a, b in rows)
    assert true >= 0.95 * sum(a for a, _ in rows) > 30 and true >= 0.95 * sum(b for _, b in rows)


def test_pipeline(spark, sf_dir, docs):
    """Against the same decisions by brute force, stage by stage."""
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {d: r["text"] for d, r in docs.items()}
    sequences = corpus_pipeline.run(spark, sf_dir)
    known = corpus_pipeline.STAGES[0][1](spark, frame, sf_dir)
    assert known.columns == frame.columns
    kept = {r["doc_id"]: r["text"] for r in known.collect()}
    assert len(kept) >= 0.99 * len(docs), "clean documents stay"
    best = {}
    for d, t in kept.items():
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(t), d))
    kept = {d: kept[d] for _, d in best.values()}
    sets = {d: set(ngram_join.shingles(t).tolist()) for d, t in kept.items()}
    holders, root = defaultdict(list), {d: d for d in kept}
    for d, runs in sets.items():
        for run in runs:
            holders[run].append(d)

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, b), n in Counter((a, b) for ds in holders.values() for i, a in enumerate(ds)
                             for b in ds[i + 1:]).items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    kept = {d: t for d, t in kept.items() if find(d) == d}
    searcher = decontaminate.Searcher([(r["item_id"], r["text"]) for r in
                                       spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()])
    kept = {d for d, t in kept.items() if not searcher.search([t])}
    assert {r["doc_id"] for r in sequences.collect()} == kept


def test_registration():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and random.Random(1)
