"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the character 1- to 3-grams of the lower-cased text, hashed to a fixed number of columns.
The fit counts them on a bounded, per-language sample of the labelled rows (``per_language``, the
documented bound); class priors are over all labelled rows. The fitted matrix has languages x columns
cells whatever the corpus, so it is broadcast; a batch of texts is scored by gathering the matrix rows
of its n-grams and summing them by document in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, bounded_batches, remainder_is, small_batches, table

COLUMNS = 1 << 15
ORDERS = (1, 2, 3)
PER_LANGUAGE = 2000
SMOOTHING = 0.5
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def features(texts: list[str], columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts one after the other, and how many each text has."""
    parts, sizes = [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for order in ORDERS:
            n = len(points) - order + 1
            if n <= 0:
                continue
            h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
            for j in range(order):
                h = (h ^ points[j : j + n]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            parts.append(h & np.uint32(columns - 1))
            sizes[i] += n
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)), sizes


def fit(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, columns: int = COLUMNS, key: str = "doc_id") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities columns x languages, log-priors) from rows where ``usable`` holds.

    Rows without text or lang don't count. Each language gives about per_language rows at most, picked
    by a hash of the text and the row's key, so copies are drawn each for itself. No such row: no languages, and every prediction is `und`.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.where(usable & F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one number a language
    names = sorted(sizes)
    if not names:
        return [], np.zeros((columns, 0), np.float32), np.zeros(0)
    rates = F.create_map(*[F.lit(x) for n in names for x in (n, int(min(1.0, per_language / sizes[n]) * (1 << 30)))])
    sample = rows.where(F.pmod(F.xxhash64(text, key), F.lit(1 << 30)) < rates[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in small_batches(batches, 1, 1 << 20):
            labels, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for label in set(labels):
                ids, _ = features([t for k, t in zip(labels, texts) if k == label], columns)
                sums[label] = sums.get(label, 0) + np.bincount(ids, minlength=columns)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.astype(np.int64).tobytes() for v in sums.values()], pa.binary())], ["lang", "counts"])

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, dtype=np.int64) for b in parts.column("counts").to_pylist())
        return pa.table({"lang": pa.array([key[0].as_py()]), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "lang string, counts binary"
    found = {r[0]: np.frombuffer(r[1], dtype=np.int64) for r in sample.mapInArrow(count, schema).groupBy("lang").applyInArrow(add, schema).collect()}
    counts = np.stack([found.get(n, np.zeros(columns, dtype=np.int64)) for n in names], axis=1) + SMOOTHING
    priors = np.array([sizes[n] for n in names], dtype=np.float64)
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32), np.log(priors / priors.sum())


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """docs with lang_pred and score, the posterior probability of the language predicted.

    Null text, text without a letter, or a model without languages: `und`, score 0. Ties go to the
    language first in order. The whole text counts. Columns of the two names are replaced.
    """
    names, matrix, priors = model
    shared = docs.sparkSession.sparkContext.broadcast((names, matrix, priors))
    columns = matrix.shape[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        names, matrix, priors = shared.value
        for batch in batches:
            labels: list[str] = []
            scores: list[float] = []
            for part in small_batches(iter([batch]), 0, (8 << 20) // max(16, 4 * len(names))):
                texts = [t or "" for t in part.column(0).to_pylist()]
                known = [bool(names) and bool(LETTER.search(t)) for t in texts]
                ids, sizes = features([t if k else "" for t, k in zip(texts, known)], columns)
                logs = np.zeros((len(texts), len(names)))
                full = np.flatnonzero(sizes)
                if len(full):
                    starts = (np.cumsum(sizes) - sizes)[full]
                    logs[full] = np.add.reduceat(matrix[ids], starts, axis=0, dtype=np.float64) + priors
                for k, row in zip(known, logs):
                    best = int(row.argmax()) if k else 0
                    labels.append(names[best] if k else UNKNOWN)
                    scores.append(float(1 / np.exp(row - row[best]).sum()) if k else 0.0)
            yield [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]

    return append(docs, work, [text], T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; learnt without the held-out quarter."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = remainder_is("doc_id", 4, 2)
    model = fit(docs, ~held_out)
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op3_language_id": op3_language_id}
SQL: dict[str, str] = {}
