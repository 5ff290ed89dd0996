"""Toxicity by maximum-scoring segments.

A token's score is its log-odds between toxic and clean texts, less a constant drift. Counts are
shrunk by Dirichlet priors in a chain: the prior of a word is the estimate of its longest known prefix,
that of a prefix the estimate of the next shorter one, and the first has even odds. So a rare form of
a telling stem, or one never seen, scores as the stem does. Every token counts, no significance is
asked for. The drift is as much as odds of e to 1, so a token that nothing is known of weighs against a
passage, and so do those that a few long toxic texts of a small sample have made a little suspicious:
with a small drift, long runs of such tokens add up to more than short passages of telling ones.

One linear scan over a text finds all its maximal segments, the toxic passages. The best segment of a
clean text follows an extreme-value law, whose location grows with the logarithm of the length; the
law's constants are fitted to clean sample texts, scored by a model that has not seen them. A
segment's surprise is -log of the chance that a clean text of that length holds one as good; a text's
evidence is the sum over its significant segments, or the best one's if there are none. A logistic
curve over that, fitted on the same unseen texts, gives the score.

The model is fitted on a bounded sample of labelled rows, ``SAMPLE`` a label at most, and only counts
and one row of figures a text leave the executors; every text is scored from all of its tokens.

Defined results: null and empty texts score as texts without evidence do; without both labels in the
sample every score is 0; a row in labels without text teaches nothing, of contrary labels the toxic
one counts, and of rows that share a doc_id one text is learned from; texts of equal evidence tie and
have equal scores; repeated rows count each by itself; a very long text is one block, in about 100
bytes a character; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veedor.llm.kernel import SIGNS, Words, span_hasher, split_words
from veedor.llm.storage import cut, fold_of, labelled_sample

#: Labelled rows of each label that the model is fitted on, at most.
SAMPLE = 4096
#: Bytes of the prefixes that a word's estimate goes back to.
PREFIXES = (3, 4, 5, 6, 7, 8, 10, 12)
#: Weight of a prior in tokens, what every score is lowered by, and the most that a token counts in one text.
PRIOR, DRIFT, MOST = 2.0, 1.0, 4
#: Segments that clean texts are expected to have fewer of than this are significant.
SIGNIFICANT = 0.05
_EULER = 0.5772156649015329


def tokens(texts: pa.Array) -> Iterator[Words]:
    """Tokens are runs of letters and digits, in lower case; any byte beyond ASCII is a letter."""
    return split_words(texts, fold=True, parts=SIGNS)


def chains(words: Words, which: np.ndarray) -> np.ndarray:
    """Of each of some words, the hashes of its proper prefixes and at last its own; 0 where it is too short."""
    span, starts, ends = span_hasher(words.data, fold=True), words.starts[which], words.ends[which]
    out = np.zeros((len(which), len(PREFIXES) + 1), np.uint64)
    for level, length in enumerate(PREFIXES):
        longer = np.flatnonzero(ends - starts > length)
        out[longer, level] = span(starts[longer], starts[longer] + length, length)
    out[:, -1] = words.hashes[which]
    return out


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first, last, score)`` of a text's token scores, in linear time."""
    sums = np.append(0.0, np.cumsum(scores, dtype=np.float64))
    stack: list[list] = []  # first, last, total before, total after, index of the last one with a smaller total before
    at = np.flatnonzero(scores > 0)
    for place, before, after in zip(at.tolist(), sums[at].tolist(), sums[at + 1].tolist(), strict=True):
        now = [place, place, before, after]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= now[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= now[3]:
                stack.append([*now, j])
                break
            now[0], now[2] = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, r - left) for a, b, left, r, _ in stack]


def best_segment(scores: np.ndarray) -> float:
    """The score of the best segment, 0 if no token scores above 0."""
    sums = np.append(0.0, np.cumsum(scores, dtype=np.float64))
    return float((sums - np.minimum.accumulate(sums)).max())


@dataclass
class Odds:
    """Hashes of words and prefixes, ascending, and their shrunk log-odds."""

    keys: np.ndarray
    odds: np.ndarray

    def of_words(self, words: Words) -> np.ndarray:
        """The score of each token, from its longest known prefix."""
        if not len(self.keys) or not len(words.hashes):
            return np.full(len(words.hashes), -DRIFT)
        _, first, where = np.unique(words.hashes, return_index=True, return_inverse=True)
        nodes = chains(words, first)
        scores, open_ = np.zeros(len(first)), np.ones(len(first), bool)
        for level in range(nodes.shape[1] - 1, -1, -1):
            h = nodes[:, level]
            place = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            found = open_ & (h != 0) & (self.keys[place] == h)
            scores[found] = self.odds[place[found]]
            open_ &= ~found
        return (scores - DRIFT)[where]


def shrunk(counts: np.ndarray, keys: np.ndarray, parents: np.ndarray, levels: np.ndarray, totals: np.ndarray) -> Odds:
    """Log-odds of every node from its ``counts`` (clean, toxic) and its parent's estimate, level by level."""
    even = math.sqrt(max(totals[0], 1) / max(totals[1], 1))  # so that both labels have as many tokens
    bad, good = counts[:, 1] * even, counts[:, 0] / even
    lone = counts.sum(1) < 2
    bad[lone] = good[lone] = 0
    share, place = np.full(len(keys), 0.5), np.minimum(np.searchsorted(keys, parents), max(len(keys) - 1, 0))
    for level in np.unique(levels):
        at = np.flatnonzero(levels == level)
        prior = np.where(keys[place[at]] == parents[at], share[place[at]], 0.5)
        share[at] = (bad[at] + PRIOR * prior) / (bad[at] + good[at] + PRIOR)
    share = np.clip(share, 1e-9, 1 - 1e-9)
    return Odds(keys, np.log(share / (1 - share)).astype(np.float32))


@dataclass
class Model:
    """Scores of tokens, the extreme-value law (location, growth, scale) and the logistic curve."""

    odds: Odds
    location: float = 0.0
    growth: float = 0.0
    scale: float = 1.0
    slope: float = 1.0
    base: float = 0.0

    def log_expected(self, score, length):
        """Logarithm of how many segments of at least ``score`` a clean text of ``length`` tokens has by chance."""
        return np.minimum((self.location + self.growth * np.log(np.maximum(length, 1)) - score) / self.scale, 700)

    def passages(self, scores: np.ndarray) -> list[tuple[int, int, float, float]]:
        """The significant segments ``(first, last, score, expected)`` of a text."""
        if self.log_expected(best_segment(scores), len(scores)) >= math.log(SIGNIFICANT):
            return []
        found = [(a, b, s, math.exp(self.log_expected(s, len(scores)))) for a, b, s in maximal_segments(scores)]
        return [x for x in found if x[3] < SIGNIFICANT]

    def evidence(self, scores: np.ndarray, found: list[tuple[int, int, float, float]]) -> float:
        """Sum of surprise over the significant passages, or the best segment's; damped."""
        best = np.array([x[2] for x in found] or [best_segment(scores)])
        return float(np.log1p(surprise(self.log_expected(best, len(scores))).sum()))

    def score(self, evidence: float) -> float:
        """The curve's value; a thousandth is left to the evidence itself, so that sure texts still rank."""
        likely = 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * evidence + self.base))))
        return 0.999 * likely + 0.001 * evidence / (1 + evidence)


def surprise(log_expected: np.ndarray) -> np.ndarray:
    """-log of the chance of at least one segment, from the logarithm of the expected number."""
    return np.where(log_expected < -15, -log_expected, -np.log(-np.expm1(-np.exp(np.maximum(log_expected, -15)))))


def extreme_values(best: np.ndarray, length: np.ndarray) -> tuple[float, float, float]:
    """Location, growth by log length and scale of the Gumbel law of clean texts' best segments."""
    x = np.log(np.maximum(length, 1))
    growth = max(0.0, float(np.cov(x, best, bias=True)[0, 1] / np.var(x))) if len(x) and np.var(x) > 1e-9 else 0.0
    rest = best - growth * x
    scale = max(0.05, float(rest.std()) * math.sqrt(6) / math.pi)
    return float(rest.mean()) - _EULER * scale, growth, scale


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of one variable, by Newton's method with a light ridge."""
    a, b = 1.0, -1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        g = np.array([(weight * (y - p) * x).sum() - 0.01 * a, (weight * (y - p)).sum() - 0.01 * b])
        v = weight * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -5, 5)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-6), float(b)


def calibrate(model: Model, label: np.ndarray, length: np.ndarray, best: np.ndarray, share: float) -> Model:
    """Fit law and curve to texts that the scores were not learned from; ``share`` of all texts are toxic."""
    clean = label == 0
    model.location, model.growth, model.scale = extreme_values(best[clean], length[clean])
    x = np.log1p(surprise(model.log_expected(best, length)))
    weight = np.where(clean, (1 - share) / max(1, clean.sum()), share / max(1, (~clean).sum())) * len(label)
    model.slope, model.base = _logistic(x, label.astype(float), weight)
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``cell, text``: how often each node is in the texts of each cell. Node 0 counts all tokens."""
    for batch in batches:
        cells, parts = batch.column(0).to_numpy(), []
        for w in tokens(batch.column(1)):
            doc = np.repeat(np.arange(len(w.rows)), np.diff(w.first))
            nodes = chains(w, np.arange(len(w.hashes)))
            parent, above = np.zeros_like(nodes), np.zeros(len(nodes), np.uint64)
            for level in range(nodes.shape[1]):
                parent[:, level] = above
                above = np.where(nodes[:, level] != 0, nodes[:, level], above)
            some = nodes != 0
            level = np.broadcast_to(np.arange(nodes.shape[1], dtype=np.int32), nodes.shape)[some]
            doc, node, parent = np.broadcast_to(doc[:, None], nodes.shape)[some], nodes[some], parent[some]
            order = np.lexsort((node, doc))
            doc, node, level, parent = doc[order], node[order], level[order], parent[order]
            first = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(node, prepend=node[:1] ^ np.uint64(1)) != 0))
            n = np.minimum(np.diff(first, append=len(node)), MOST)
            cell, whole = cells[w.rows.start + doc[first]], level[first] == len(PREFIXES)
            parts.append((cell, node[first], parent[first], level[first], n))
            kinds = np.unique(cell)
            sums = np.array([n[whole & (cell == k)].sum() for k in kinds], np.int64)
            parts.append((kinds, np.zeros(len(kinds), np.uint64), np.zeros(len(kinds), np.uint64), np.full(len(kinds), -1, np.int32), sums))
        cell, node, parent, level, n = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int32()), pa.array(node.astype(np.int64)), pa.array(parent.astype(np.int64)), pa.array(level, pa.int32()), pa.array(n, pa.int64())],
            ["cell", "node", "parent", "level", "n"],
        )


def _best(models: list[Odds]):
    """From ``cell, text``: label, number of tokens and best segment of each text, by the other half's scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, out = batch.column(0).to_pylist(), []
            for w in tokens(batch.column(1)):
                scores = [m.of_words(w) for m in models]
                for k, row in enumerate(w.rows):
                    s = scores[1 - cells[row] // 2][w.first[k] : w.first[k + 1]]
                    out.append((cells[row] % 2, len(s), best_segment(s)))
            label, length, best = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(length, pa.int64()), pa.array(best, pa.float64())], ["label", "length", "best"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on a sample of ``labels`` (``doc_id, toxic``), each label weighed by its share of all."""
    known = labels.filter("toxic IN (0, 1)")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    picked = F.broadcast(labelled_sample(known, "toxic", SAMPLE).groupBy("doc_id").agg(F.max("label").alias("label")))
    rows = docs.select("doc_id", "text").join(picked, "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # A cell is a label in one of two halves.
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    sample = cut(rows.select((half * 2 + F.col("label")).cast("int").alias("cell"), "text"))
    if sample.select(F.col("cell") % 2).distinct().count() < 2:
        return None
    counted = sample.mapInArrow(_count, "cell int, node long, parent long, level int, n long").groupBy("node", "parent", "level")
    cells = [F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(4)]
    table = counted.agg(*cells).filter("c0 + c1 + c2 + c3 > 1 OR level < 0").toArrow()
    keys = table["node"].to_numpy().view(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys, parents, levels = keys[order], table["parent"].to_numpy().view(np.uint64)[order], table["level"].to_numpy()[order]
    counts = np.stack([table[f"c{c}"].to_numpy()[order] for c in range(4)], 1).astype(float)
    tokens_of, real = counts[levels < 0].sum(0), levels >= 0
    shape = keys[real], parents[real], levels[real]
    halves = [shrunk(counts[real][:, 2 * h : 2 * h + 2], *shape, tokens_of[2 * h : 2 * h + 2]) for h in (0, 1)]
    model = Model(shrunk(counts[real][:, :2] + counts[real][:, 2:], *shape, tokens_of[:2] + tokens_of[2:]))
    seen = sorted(tuple(r.values()) for r in sample.mapInArrow(_best(halves), "label int, length long, best double").toArrow().to_pylist())
    label, length, best = (np.array(x) for x in zip(*seen, strict=True))
    return calibrate(model, label, length, best, totals.get(1, 0) / max(1, sum(totals.values())))


def _scorer(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
        for batch in batches:
            scores, found = [], []
            for words in tokens(batch.column(1)):
                said = model.odds.of_words(words) if model else words.hashes
                for k in range(len(words.rows)):
                    s = said[words.first[k] : words.first[k + 1]]
                    parts = model.passages(s) if model else []
                    scores.append(model.score(model.evidence(s, parts)) if model else 0.0)
                    found.append([dict(zip(("first", "last", "score", "expected"), p, strict=True)) for p in parts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, kind)], ["doc_id", "score", "passages"])

    return run


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, score, passages`` of every row; passages are the significant segments, in tokens."""
    schema = "doc_id long, score double, passages array<struct<first: long, last: long, score: double, expected: double>>"
    return docs.select("doc_id", "text").mapInArrow(_scorer(model), schema)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Score every row, learning only outside the held-out fold: ``doc_id, held_out, score, predicted, n_passages``."""
    model = fit(docs, labels.select("doc_id", "toxic").filter(fold_of(folds) != held))
    scored = score_documents(docs, model)
    return scored.select(
        "doc_id", F.coalesce(fold_of(folds) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"),
    )
