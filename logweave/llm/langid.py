r"""Language identification by nearest clustered centroid over TF-IDF n-gram vectors.

A text is lower-cased, everything but letters becomes a single space, and its byte 1-, 2-
and 3-grams are counted in ``DIM`` hash cells, held sparsely.  Vectors are
(1 + log tf) * idf, scaled to length one.  Document frequencies are counted over all
training rows; grams of no training row weigh most, so they lower every cosine.  Each
language gets ``CENTROIDS`` centroids by spherical k-means over a bounded sample of its
training rows (``SAMPLE`` per language, chosen by a hash of the id).  A text takes the
language of the centroid with the highest cosine; that cosine is its score.

Distance-based rejection: cosines grow with the length of a text, so each language has a
floor per length.  Either half of the sample is scored by centroids of the other half,
whole and cut to 2, 4, 8 ... bytes; the floor of a length is ``MARGIN`` times the
``QUANTILE`` of the cosines of such cuts, lowered where the same share of whole rows
needs it and for languages of few rows.  A text below the floor of its predicted language
and length is rejected.  So are texts without a letter, which are ``und`` with score 0.

Training uses rows with a non-null language and a text with a letter; prediction reads the
text only.  Ids and sources never enter a vector.

Defined cases: null, empty or letterless texts are ``und``; without training rows every
text is ``und``; equal cosines go to the language first in code point order; repeated rows
get equal results; extra columns are ignored (``classify``) or kept (``keep_known``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import cut_table, mix, small_side, text_chunks

BITS = 18
DIM = 1 << BITS
CENTROIDS = 4
SAMPLE = 1000
ROUNDS = 12
#: Clean text of another style than the training rows lies below their quantile; foreign text lies below half of it.
MARGIN = 0.65
QUANTILE = 0.005
#: Floors are measured on the first 2, 4 ... 2 ** (CUTS - 1) * 2 bytes of a text.
CUTS = 12
#: A language of n sampled rows keeps n / (n + FEW) of its floors: few rows do not show a low quantile.
FEW = 10
UNKNOWN = "und"
U = np.uint64
_KEEP = np.full(256, 32, dtype=np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def letters(text: str):
    """Lower-cased text with runs of anything but letters and marks as one space; null without a letter."""
    t = F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{M}]+", " ")
    return F.when(F.col(text).rlike(r"\p{L}"), t)


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, cell) of every byte 1-, 2- and 3-gram that holds no inner space; texts are padded by spaces."""
    docs = len(off) - 1
    size = np.diff(off)
    new = off + np.arange(docs + 1)
    buf = np.full(len(data) + docs + 2, 32, dtype=np.uint64)
    doc = np.repeat(np.arange(docs), size)
    buf[1 + np.arange(len(data)) + doc] = data
    who = np.repeat(np.arange(docs), size + 1)
    at = np.arange(new[-1]) + 1
    b0, b1, b2 = buf[at - 1], buf[at], buf[at + 1]
    out_d, out_c = [], []
    for ok, key in ((b1 != 32, b1), ((b1 != 32), (b0 << U(8) | b1) + U(1 << 8)),
                    (b1 != 32, (b0 << U(16) | b1 << U(8) | b2) + U(1 << 17))):
        out_d.append(who[ok])
        out_c.append((mix(key[ok] * U(0x9E3779B97F4A7C15)) & U(DIM - 1)).astype(np.int64))
    return np.concatenate(out_d), np.concatenate(out_c)


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, cell, count) of the distinct grams of each of at most 64 texts, in order."""
    d, c = grams(data, off)
    key = np.sort((d << BITS | c).astype(np.int32))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    first = key[at].astype(np.int64)
    return first >> BITS, first & (DIM - 1), np.diff(np.append(at, len(key)))


def weights(doc: np.ndarray, cell: np.ndarray, tf: np.ndarray, idf: np.ndarray, docs: int) -> np.ndarray:
    """(1 + log tf) * idf, each document scaled to length one."""
    w = (1 + np.log(tf)) * idf[cell]
    norm = np.sqrt(np.bincount(doc, w * w, docs))
    return (w / norm[doc]).astype(np.float32)


def cosines(doc: np.ndarray, row: np.ndarray, w: np.ndarray, columns: np.ndarray, docs: int) -> np.ndarray:
    """Products of sparse documents (ordered) with dense ``columns``, a bounded number of entries at a time."""
    out = np.zeros((docs, columns.shape[1]), dtype=np.float32)
    for i in range(0, len(doc), 1 << 16):
        d = doc[i:i + (1 << 16)]
        at = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        out[d[at]] += np.add.reduceat(columns[row[i:i + (1 << 16)]] * w[i:i + (1 << 16), None], at, axis=0)
    return out


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, tuple]]:
    """(first, last, bytes of each, terms) of at most 64 rows and a bounded number of bytes at a time."""
    for a, b, data, off in text_chunks(batch, column, 1 << 20):
        for i in range(0, b - a, 64):
            j = min(i + 64, b - a)
            yield a + i, a + j, np.diff(off[i:j + 1]), terms(data[off[i]:off[j]], off[i:j + 1] - off[i])


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIM, dtype=np.int64), 0
    for batch in batches:
        for a, b, _, (_, cell, _) in _pieces(batch, 0):
            df += np.bincount(cell, minlength=DIM)
            n += b - a
    seen = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(df[seen], n))], names=["cell", "df"])


class _Rows:
    """Sparse unit vectors of texts; columns are the cells of the whole sample."""

    def __init__(self, texts: list[bytes], idf: np.ndarray, cells: np.ndarray | None = None):
        parts = []
        for i in range(0, len(texts), 64):
            some = texts[i:i + 64]
            off = np.concatenate([[0], np.cumsum([len(t) for t in some])])
            d, c, tf = terms(np.frombuffer(b"".join(some), np.uint8), off)
            parts.append((d + i, c, weights(d, c, tf, idf, len(some))))
        self.docs = len(texts)
        self.doc, cell, self.w = (np.concatenate(x) for x in zip(*parts))
        self.cells = np.unique(cell) if cells is None else cells
        self.row = np.searchsorted(self.cells, cell)
        # Grams of none of the ``cells`` (of a cut word) get a row of zeros after them.
        self.row[np.append(self.cells, -1)[self.row] != cell] = len(self.cells)

    def cos(self, cent: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        keep = slice(None) if of is None else of[self.doc]
        out = cosines(self.doc[keep], self.row[keep], self.w[keep], np.vstack([cent.T, np.zeros((1, len(cent)), np.float32)]), self.docs)
        return out if of is None else out[of]

    def mean(self, of: np.ndarray) -> np.ndarray:
        keep = of[self.doc]
        m = np.bincount(self.row[keep], self.w[keep], len(self.cells))
        return (m / (np.linalg.norm(m) or 1)).astype(np.float32)


def _centroids(x: _Rows, of: np.ndarray) -> np.ndarray:
    """Spherical k-means over the rows ``of`` x."""
    # Deterministic seeding: the mean direction first, then the row farthest from all centres so far.
    who = np.flatnonzero(of)
    cent = [x.mean(of)]
    while len(cent) < min(CENTROIDS, len(who)):
        far = np.zeros(x.docs, dtype=bool)
        far[who[np.argmin(np.max(x.cos(np.array(cent), of), axis=1))]] = True
        cent.append(x.mean(far))
    cent = np.array(cent)
    for _ in range(ROUNDS):
        own = np.argmax(x.cos(cent, of), axis=1)
        for k in range(len(cent)):
            if (own == k).any():
                part = np.zeros(x.docs, dtype=bool)
                part[who[own == k]] = True
                cent[k] = x.mean(part)
    return cent


def floor_at(floors: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Floors (.., CUTS) of texts of so many bytes, linear in the logarithm of the size."""
    at = np.clip(np.log2(np.maximum(size, 2)) - 1, 0, CUTS - 1)
    lo = np.minimum(at.astype(int), CUTS - 2)
    row = np.arange(len(size))
    return floors[row, lo] + (floors[row, lo + 1] - floors[row, lo]) * (at - lo)


def _floors(texts: list[bytes], x: _Rows, idf: np.ndarray) -> np.ndarray:
    """Rejection floor by length, from rows scored by the centroids of the other half of the sample."""
    half = np.arange(x.docs) % 2 == 0
    folds = [(half, ~half), (~half, half)] if x.docs > 1 else [(half, half)]
    fits = [(_centroids(x, fit), np.flatnonzero(test)) for fit, test in folds]

    def held_out(cut: int | None):
        best, size = [], []
        for cent, test in fits:
            some = [texts[i][:cut] for i in test if cut is None or len(texts[i]) >= cut]
            if some:
                part = _Rows(some, idf, x.cells)
                best.append(np.max(part.cos(cent), axis=1))
                size.append([len(t) for t in some])
        return (np.concatenate(best), np.concatenate(size)) if best else (None, None)

    out = np.zeros(CUTS)
    for k in range(CUTS):
        got, _ = held_out(2 << k)
        # Lengths that hardly any row has take the floor of the length before.
        enough = got is not None and (len(got) >= min(x.docs, 20))
        out[k] = np.quantile(got, QUANTILE) if enough else out[k - 1] if k else 0.0
    whole, size = held_out(None)
    need = floor_at(np.broadcast_to(out, (len(size), CUTS)), size)
    share = np.quantile(np.where(need > 0, whole / np.where(need > 0, need, 1), 1), QUANTILE)
    return out * min(1.0, float(share)) * MARGIN * x.docs / (x.docs + FEW)


def _cluster(idf: np.ndarray):
    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "letters"], kind="stable")
        texts = [t.encode() for t in pdf["letters"]]
        x = _Rows(texts, idf)
        cent = _centroids(x, np.ones(x.docs, dtype=bool))
        return pd.DataFrame({"lang": [key[0]], "cells": [x.cells.astype(np.int32).tobytes()],
                             "centroids": [cent.astype(np.float32).tobytes()], "floors": [_floors(texts, x, idf).tobytes()]})

    return fit


class Model:
    """Columns of centroids over the cells of any, their languages and rejection floors (a row each), idf weights; a few MB per language at most."""

    def __init__(self, idf, langs, row, columns, floors):
        self.idf, self.langs, self.row, self.columns, self.floors = idf, langs, row, columns, floors


def train(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """Fit on all ``rows`` with a language; None when there is none with a letter in its text."""
    t = rows.where(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), letters(text).alias("letters"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.col(text))).alias("h")).where("letters is not null")
    df = t.select("letters").mapInArrow(_document_frequency, "cell long, df long").groupBy("cell").agg(F.sum("df").alias("df")).toPandas()
    total = int(df["df"][df["cell"] == -1].sum())  # at most DIM + 1 rows
    if not total:
        return None
    df = df[df["cell"] >= 0]
    counts = np.zeros(DIM)
    counts[df["cell"].to_numpy()] = df["df"].to_numpy()
    idf = np.log((1 + total) / (1 + counts)).astype(np.float32) + 1
    # A bounded sample per language: ids whose hash lies below sample / rows of the language.
    # One row per language, broadcast after its count, so that rows are thinned before they are dealt by language.
    sizes = cut_table(t.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    sizes = small_side(sizes, sizes.count())
    u = F.conv(F.substring("h", 1, 13), 16, 10).cast("double") / float(1 << 52)
    picked = t.join(sizes, "lang").where(u * F.col("rows") < sample).select("lang", "letters", "h")
    fits = picked.groupBy("lang").applyInPandas(_cluster(idf), "lang string, cells binary, centroids binary, floors binary")
    fits = sorted(fits.collect(), key=lambda r: r.lang)
    if not fits:
        return None
    cells = [np.frombuffer(r.cells, np.int32) for r in fits]
    cent = [np.frombuffer(r.centroids, np.float32).reshape(-1, len(c)) for r, c in zip(fits, cells)]
    seen = np.unique(np.concatenate(cells))
    # Row 0 stands for cells of no centroid.
    columns = np.zeros((len(seen) + 1, sum(len(c) for c in cent)), dtype=np.float32)
    k = 0
    for c, at in zip(cent, cells):
        columns[1 + np.searchsorted(seen, at), k:k + len(c)] = c.T
        k += len(c)
    row = np.zeros(DIM, dtype=np.int32)
    row[seen] = 1 + np.arange(len(seen))
    each = [(r.lang, np.frombuffer(r.floors)) for r, c in zip(fits, cent) for _ in c]
    return Model(idf, [x for x, _ in each], row, columns, np.array([f for _, f in each]))


def _judge(model: Model, text: pa.Array):
    """(language, score, rejected) of every text of an Arrow column; null is unknown and rejected."""
    names = np.array(model.langs, dtype=object)
    known = text.is_valid().to_numpy(zero_copy_only=False)
    lang, score = np.full(len(known), UNKNOWN, dtype=object), np.zeros(len(known))
    reject = np.ones(len(known), dtype=bool)
    for a, b, size, (doc, cell, tf) in _pieces(pa.RecordBatch.from_arrays([text], names=["t"]), 0):
        cos = cosines(doc, model.row[cell], weights(doc, cell, tf, model.idf, b - a), model.columns, b - a)
        best = np.argmax(cos, axis=1)
        top = np.clip(cos[np.arange(b - a), best].astype(float), 0, 1)
        ok = known[a:b]
        lang[a:b] = np.where(ok, names[best], UNKNOWN)
        score[a:b] = np.where(ok, top, 0)
        reject[a:b] = ~ok | (top < floor_at(model.floors[best], size))
    return lang, score, reject


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, reject = _judge(model, batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(reject)],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    return run


def classify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, lang_pred, score, rejected."""
    d = docs.select(F.col(doc_id).alias("doc_id"), letters(text).alias("letters"))
    if model is None:
        return d.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(_predict(model), f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, unchanged."""
    if model is None:
        return docs.limit(0)

    # Only the letters go to Python; the rows wait in the JVM's queue, which can spill.
    def kept(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            yield pa.array(~_judge(model, t)[2])

    return docs.where(F.arrow_udf(kept, "boolean")(letters(text)))


def training_fold(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows whose crc32(doc_id) mod 4 is not 2."""
    return docs.where(~held_out(doc_id))


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
