"""Language identification by nearest centroid, with rejection by distance.

A text is a vector of hashed byte trigrams of its letters, all else being one space, weighted by TF-IDF and of length 1. Each language has
several centroids, found by spherical k-means among its own sample texts. The language of the nearest
centroid by cosine is predicted; a text farther from it than nearly all sample texts of that language
and of about its length are is rejected. The cosine grows with length, so each band of lengths has a
line of its own: from the language's sample texts there, or if these are few from those of all
languages, or else the line of the next shorter band. Bands before the first line are judged by a
loose one of all lengths.

The model is fitted on a bounded sample, ``SAMPLE`` texts per language at most; every text is
predicted from all of its bytes.

Defined results: a null text and one without a letter are ``und`` with score 0 and are rejected; if
nothing could be learned, all are; ties go to the first language by name; repeated rows count each
by itself; an empty table gives no row; further columns are carried where asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veedor.llm.kernel import blocks
from veedor.llm.storage import fold_of, labelled_sample

#: Sample texts per language, and the number of trigram cells.
SAMPLE, CELLS = 512, 4096
#: Centroids per language, and rounds of k-means.
CENTROIDS, ROUNDS = 4, 8
#: A text is rejected below this part of the cosine that all but this share of sample texts reach; the loose part is for all lengths together.
SLACK, LOOSE, TAIL = 0.8, 0.3, 0.005
#: Bands of lengths, each of four times the trigrams of the one before, and the least sample texts that set a line.
BANDS, LEAST_TEXTS = 16, 20


def _fold_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    table[:128][[not chr(b).isalpha() for b in range(128)]] = 32
    return table


def _counts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and trigram counts of each text; upper case of ASCII and Latin-1 letters is folded."""
    fold = _fold_table()
    for rows, data, at in blocks(texts):
        d = fold[data]
        upper = np.flatnonzero((d[:-1] == 0xC3) & (d[1:] >= 0x80) & (d[1:] <= 0x9E)) + 1
        d[upper] += 32
        kept = np.ones(len(d), bool)
        kept[1:] = (d[1:] != 32) | (d[:-1] != 32)
        d, at = d[kept], np.append(0, np.cumsum(kept))[at]
        cell = (d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA6B) + d[2:] * np.uint32(0xC2B2AE35)) if len(d) > 2 else d[:0]
        cell = ((cell ^ (cell >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
        for row, a, b in zip(rows, at[:-1], at[1:], strict=True):
            yield row, np.bincount(cell[a : max(a, b - 2)], minlength=CELLS)


#: A cell that occurs in a text, and how often.
_CELL = np.dtype([("cell", "<u2"), ("n", "<i4")])


def _pack(counts: np.ndarray) -> bytes:
    """A text's counts without the cells that do not occur, most of the 4,096."""
    cells = np.flatnonzero(counts)
    packed = np.empty(len(cells), _CELL)
    packed["cell"], packed["n"] = cells, np.minimum(counts[cells], 2**31 - 1)
    return packed.tobytes()


def _unpack(rows: list[bytes]) -> np.ndarray:
    counts = np.zeros((len(rows), CELLS), np.int32)
    for k, row in enumerate(rows):
        packed = np.frombuffer(row, _CELL)
        counts[k, packed["cell"]] = packed["n"]
    return counts


def _vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_pack(n) for _, n in _counts(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["label", "counts"])


def _bands(counts: np.ndarray) -> np.ndarray:
    """The band of lengths of each row of trigram counts."""
    total = np.maximum(counts.sum(1, dtype=np.float64), 1)
    return np.minimum(np.log2(total) // 2, BANDS - 1).astype(np.int64)


def _lines(cosine: np.ndarray, band: np.ndarray, found: np.ndarray, right: np.ndarray, languages: int) -> np.ndarray:
    """Least cosines by language and band, from the sample texts that are predicted right."""
    least = np.zeros((languages, BANDS))
    for k in range(languages):
        mine = right & (found == k)
        line = LOOSE * np.quantile(cosine[mine], TAIL) if mine.any() else 0.0
        for b in range(BANDS):
            for some in (mine & (band == b), right & (band == b)):
                if some.sum() >= LEAST_TEXTS:
                    line = SLACK * np.quantile(cosine[some], TAIL)
                    break
            least[k, b] = line
    return least


@dataclass
class Model:
    """Inverse document frequencies, centroids by row, the language of each, and least cosines by language and band."""

    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    languages: list[str]
    least: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts).astype(np.float32) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest language and the cosine to its nearest centroid."""
        cosine = vectors @ self.centroids.T
        best = cosine.argmax(1)
        return self.owner[best], cosine[np.arange(len(best)), best]


def _cluster(v: np.ndarray) -> np.ndarray:
    """Spherical k-means, begun at texts that are far from one another; deterministic."""
    centres = [v.mean(0)]
    for _ in range(min(CENTROIDS, len(v)) - 1):
        centres.append(v[np.stack([v @ c for c in centres]).max(0).argmin()])
    c = np.stack(centres)
    for _ in range(ROUNDS):
        near = (v @ c.T).argmax(1)
        c = np.stack([v[near == k].mean(0) if (near == k).any() else c[k] for k in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def train(labels: list[str], counts: np.ndarray) -> Model | None:
    """Fit the model to trigram counts of labelled texts."""
    return _train(labels, [_pack(n) for n in counts])


def _train(labels: list[str], packed: list[bytes]) -> Model | None:
    """Fit the model to packed counts, of which one language's or some hundred are unpacked at a time."""
    keep = [k for k, row in enumerate(packed) if row]
    labels, packed = np.array([labels[k] for k in keep], object), [packed[k] for k in keep]
    if not len(labels):
        return None
    seen = np.zeros(CELLS, np.int64)
    for row in packed:
        seen[np.frombuffer(row, _CELL)["cell"]] += 1
    idf = (np.log((1 + len(packed)) / (1 + seen)) + 1).astype(np.float32)
    model = Model(idf, np.zeros((0, CELLS), np.float32), np.zeros(0, np.int64), sorted(set(labels)), np.zeros((0, BANDS)))
    groups = [_cluster(model.vectors(_unpack([packed[k] for k in np.flatnonzero(labels == language)]))) for language in model.languages]
    model.centroids = np.concatenate(groups).astype(np.float32)
    model.owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    judged = []
    for k in range(0, len(packed), 256):
        counts = _unpack(packed[k : k + 256])
        judged.append((*model.nearest(model.vectors(counts)), _bands(counts)))
    found, cosine, bands = (np.concatenate(x) for x in zip(*judged, strict=True))
    right = np.array(model.languages, object)[found] == labels
    model.least = _lines(cosine, bands, found, right, len(groups))
    return model


def fit(docs: DataFrame) -> Model | None:
    """Fit on a sample of the rows of ``docs`` (``doc_id, text, lang``) whose ``lang`` is known."""
    picked = F.broadcast(labelled_sample(docs.select("doc_id", "lang"), "lang", SAMPLE))
    rows = docs.select("doc_id", "text").join(picked, "doc_id").filter("text IS NOT NULL").select("label", "text")
    table = rows.mapInArrow(_vectorise, "label string, counts binary").toArrow()
    if not len(table):
        return None
    labels, packed = zip(*sorted(zip(table["label"].to_pylist(), table["counts"].to_pylist(), strict=True)), strict=True)
    return _train(labels, packed)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _predictor(model: Model | None, within: int | None = None):
    """Make the mapper that judges the last column's texts; ``within`` says which field of it they are, which then stays."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, held = batch.num_columns - 1, []
            stay = batch.select(batch.schema.names[:last] if within is None else batch.schema.names)
            texts = batch.column(last) if within is None else pc.struct_field(batch.column(last), [within])
            lang, score, out = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)

            def settle(held, lang=lang, score=score, out=out):
                counts = np.stack([n for _, n in held])
                found, cosine = model.nearest(model.vectors(counts))
                for (row, _), k, c, b in zip(held, found, cosine, _bands(counts), strict=True):
                    lang[row], score[row], out[row] = model.languages[k], min(1.0, max(0.0, float(c))), c < model.least[k, b]

            for row, n in _counts(texts) if model else ():
                if _has_letter(texts[row].as_py()):
                    held.append((row, n))
                if len(held) == 256:
                    settle(held)
                    held = []
            if held:
                settle(held)
            yield pa.RecordBatch.from_arrays([*stay.columns, pa.array(lang), pa.array(score), pa.array(out)], [*stay.schema.names, *_FOUND])

    return predict


#: What a prediction adds, under names that columns of documents will not have.
_FOUND = ("_lang_pred", "_score", "_rejected")


def identify(docs: DataFrame, model: Model | None, carry: list[str], within: int | None = None) -> DataFrame:
    """Columns ``carry`` of every row, with ``_lang_pred, _score, _rejected``.

    Texts are column ``text``, or that field of the last carried column, so that they travel once.
    """
    schema = T.StructType([docs.schema[c] for c in carry])
    for name, kind in zip(_FOUND, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True):
        schema = schema.add(name, kind)
    text = [F.col("text").alias("_text")] if within is None else []
    return docs.select(*(F.col(f"`{c}`") for c in carry), *text).mapInArrow(_predictor(model, within), schema)


def accepted(docs: DataFrame) -> DataFrame:
    """The rows that are not rejected, with all their columns; the model is fitted on ``docs``."""
    # All columns travel as one, so none of them can clash.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_whole"))
    found = identify(whole, fit(docs), ["_whole"], [c.lower() for c in docs.columns].index("text"))
    return found.filter(~F.col("_rejected")).select("_whole.*")


def identify_languages(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Predict every row, learning only outside the held-out fold: ``doc_id, held_out, lang_pred, score, rejected``."""
    model = fit(docs.filter(fold_of(folds) != held))
    found = identify(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", (F.coalesce(fold_of(folds) == held, F.lit(False))).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"), F.col("_rejected").alias("rejected"))
