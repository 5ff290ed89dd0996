"""The toxicity query against a plain version: strings for hashes, loops for arrays."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_streamed import labelled, segments_by_hand

from veedor.llm import toxicity
from veedor.llm.storage import fold_of, labelled_sample


def split(text):
    return re.findall(r"[A-Za-z0-9]+", (text or "").lower())


def chain(word):
    return [("p", word[:n]) for n in toxicity.PREFIXES if n < len(word)] + [("w", word)]


def odds_of(texts):
    """Node -> log-odds, from ``[(label, text)]``, with the nodes that all halves know."""
    counts, parents, totals = {}, {}, [0, 0]
    for label, text in texts:
        mine = Counter()
        for word in split(text):
            path = chain(word)
            mine.update(path)
            parents.update(zip(path, [None, *path]))
        for node, n in mine.items():
            counts.setdefault(node, [0, 0])[label] += min(n, toxicity.MOST)
            totals[label] += min(n, toxicity.MOST) * (node[0] == "w")
    return counts, parents, totals


def log_odds(counts, parents, totals, known):
    even = math.sqrt(max(totals[0], 1) / max(totals[1], 1))
    shares = {None: 0.5}

    def share(node):
        if node not in shares:
            good, bad = counts.get(node, [0, 0])
            if good + bad < 2:
                good = bad = 0
            shares[node] = (bad * even + toxicity.PRIOR * share(parents[node])) / (bad * even + good / even + toxicity.PRIOR)
        return min(1 - 1e-9, max(1e-9, shares[node]))

    return {n: math.log(share(n) / (1 - share(n))) for n in known}


def scores_of(text, odds):
    return [next((odds[n] for n in reversed(chain(w)) if n in odds), 0.0) - toxicity.DRIFT for w in split(text)]


def best_of(scores):
    return max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0.0)


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = labelled(260, 11)
    rows = [(k, " ".join(t.split()[:40])) for k, t in rows] + [(3, "a repeated doc_id bad1"), (5000, None), (5001, ""), (5002, "bad1x bad2y unknown"), (5003, "c1 c2"), (5003, "c1 c2"), (None, "bad1 bad2")]
    docs = spark.createDataFrame([(k, t, "x", 0.5) for k, t in rows], "doc_id long, text string, label string, score double")
    return rows, docs, spark.createDataFrame([*labels, (3, 1, 0), (None, 1, 1), (9, None, None), (99_999, 0, 1)], "doc_id long, quality int, toxic int")


def test_scores_are_those_of_the_plain_version(tables):
    rows, docs, marks = tables
    known = marks.select("doc_id", "toxic").filter(fold_of(5) != 0).filter("toxic IN (0, 1)")
    picked = labelled_sample(known, "toxic", toxicity.SAMPLE).groupBy("doc_id").agg(F.max("label").alias("label"))
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).alias("half")
    sample = docs.select("doc_id", "text").join(picked, "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("label", half, "text").collect()
    everything, parents, totals = odds_of([(r["label"], r["text"]) for r in sample])
    nodes = {n for n, (a, b) in everything.items() if a + b > 1}
    halves = []
    for h in (0, 1):
        counts, _, sums = odds_of([(r["label"], r["text"]) for r in sample if r["half"] == h])
        halves.append(log_odds(counts, parents, sums, nodes))
    full = log_odds(everything, parents, totals, nodes)
    seen = [(r["label"], len(split(r["text"])), best_of(scores_of(r["text"], halves[1 - r["half"]]))) for r in sample]
    clean = [(math.log(max(n, 1)), b) for y, n, b in seen if y == 0]
    mx, mb = (sum(v) / len(clean) for v in zip(*clean))
    growth = max(0.0, sum((x - mx) * (b - mb) for x, b in clean) / sum((x - mx) ** 2 for x, _ in clean))
    rest = [b - growth * x for x, b in clean]
    mean = sum(rest) / len(rest)
    scale = max(0.05, math.sqrt(sum((r - mean) ** 2 for r in rest) / len(rest)) * math.sqrt(6) / math.pi)
    location = mean - 0.5772156649015329 * scale

    def surprise(score, n):
        e = (location + growth * math.log(max(n, 1)) - score) / scale
        return -e if e < -15 else -math.log(-math.expm1(-math.exp(min(e, 700)))), math.exp(min(e, 700))

    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"], r["n_passages"]) for r in toxicity.toxicity(docs, marks).collect())
    want = []
    for doc, text in rows:
        s = scores_of(text, full)
        found = [x for x in (surprise(sum(s[a : b + 1]), len(s)) for a, b in segments_by_hand(s)) if x[1] < toxicity.SIGNIFICANT]
        evidence = math.log1p(sum(x[0] for x in found) if found else surprise(best_of(s), len(s))[0])
        want.append((doc if doc is not None else -1, evidence, len(found)))
    want.sort()
    # One curve turns evidence into scores: the same order, and the same number of passages.
    assert [x[2] for x in got] == [x[2] for x in want]
    by_evidence, by_score = sorted((round(x[1], 3), x[0]) for x in want), sorted((x[1], x[0]) for x in got)
    ranks = {round(e, 3): {d for x, d in by_evidence if x == round(e, 3)} for e, _ in by_evidence}
    place = 0
    for e in sorted(ranks):
        group = ranks[e]
        assert {d for _, d in by_score[place : place + sum(1 for x, _ in by_evidence if x == e)]} == group
        place += sum(1 for x, _ in by_evidence if x == e)


def test_unknown_forms_of_a_telling_stem_and_repeats(tables):
    _, docs, marks = tables
    got = {}
    for r in toxicity.toxicity(docs, marks).collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    assert got[5002][0] > 0.5 > got[5003][0] and got[5003][0] == got[5003][1]
    assert got[5000] == got[5001] and len(got[3]) == 2


def test_a_very_long_text(spark, tables):
    _, docs, marks = tables
    long = spark.createDataFrame([(1, "c1 c2 c3 " * 300_000), (2, "c1 c2 c3 " * 300_000 + "bad1 bad2 bad3")], "doc_id long, text string")
    model = toxicity.fit(docs, marks.select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in toxicity.score_documents(long, model).collect()}
    (passage,) = got[2]["passages"]
    assert got[2]["score"] > got[1]["score"] and 899_990 < passage["first"] <= 900_000 and passage["last"] == 900_002
