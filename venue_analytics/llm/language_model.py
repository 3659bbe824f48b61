"""Language-model scoring with an Elias-Fano n-gram trie in memory-mapped files.

Words are 64-bit hashes. Level one holds every training word (Elias-Fano), its exact count (differences
of an Elias-Fano sequence of running sums) and its back-off weight in 16 bits. Level two holds the
bigrams seen at least ``LEAST`` times, so all of them: contexts, monotone pointers to each context's successors, the
successors as context-relative numbers in one monotone sequence, and the discounted counts in 16 bits
on a log scale. Smoothing is interpolated absolute discounting over an add-one unigram:

    p(w | h) = (c(h w) - D) / c(h) + backoff(h) * (c(w) + 1) / (N + V + 1)

Counts are gathered by a shuffle of packed, sorted, locally combined arrays; shards are by hash, and a
context's successors are spread over ``SPREAD`` shards, so a very frequent context is no hot task. The
levels are files in the shared folder, written once under a final name, so a repeated task writes the
same file. Scoring reads them by memory map: what stays in memory are pages the queries touch. Documents
never move. A shared folder that isn't a file system path is copied to each machine file by file when
first needed.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, bounded_batches, partitions, remainder_is, shared_folder, stored, table
from .elias_fano import U64, EliasFano, mapped, pack

DISCOUNT = 0.75
LEAST = 1
SPREAD = 16
FLUSH = 1_000_000  # tokens that a task counts or scores at a time
REMEMBERED = 1_000_000
SUFFIX_BITS = 40  # of a successor within its context; two of a context's successors fall together once in 10^12
STEP = 256  # steps of a quantised count per doubling
END = int(xxhash.xxh3_64_intdigest(b""))  # the end token; no word is empty. It also stands before the first word


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the words (A-Z lower-cased, split at ASCII white space), then one end."""
    words = (text or b"").lower().split()
    if len(_HASHES) > REMEMBERED:
        _HASHES.clear()
    out = np.empty(len(words) + 1, dtype=U64)
    out[:-1] = np.fromiter(map(_HASHES.__getitem__, words), dtype=U64, count=len(words))
    out[-1] = END
    return out


def before(ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The context of each token, given where each text's tokens end."""
    out = np.empty_like(words)
    out[1:] = words[:-1]
    out[0] = END
    out[ends[:-1]] = END
    return out


def _shard_of_word(words: np.ndarray, shards: int) -> np.ndarray:
    return ((words >> U64(20)) % U64(shards)).astype(np.int64)


def _shard_of_pair(contexts: np.ndarray, words: np.ndarray, shards: int) -> np.ndarray:
    return (((contexts >> U64(16)) % U64(shards) + (words >> U64(44)) % U64(SPREAD)) % U64(shards)).astype(np.int64)


def _suffix(words: np.ndarray) -> np.ndarray:
    return words & U64((1 << SUFFIX_BITS) - 1)


def _combine(contexts: np.ndarray, suffixes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with summed counts."""
    order = np.lexsort((suffixes, contexts))
    contexts, suffixes, counts = contexts[order], suffixes[order], counts[order]
    new = np.ones(len(contexts), dtype=bool)
    new[1:] = (contexts[1:] != contexts[:-1]) | (suffixes[1:] != suffixes[:-1])
    starts = np.flatnonzero(new)
    return contexts[starts], suffixes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def quantised(weights: np.ndarray) -> np.ndarray:
    """Positive numbers as 16-bit steps on a log scale (2**-16 to 2**240 by 1/256 of a doubling)."""
    return np.clip(np.round((np.log2(weights) + 16) * STEP), 0, 65535).astype(np.uint16)


def weights_of(codes: np.ndarray) -> np.ndarray:
    return np.exp2(codes.astype(np.float64) / STEP - 16)


_COUNTS = "shard int, kind string, a binary, b binary, c binary, n long"
_ARROW = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("n", pa.int64())])


def _split(shard: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(shard, kind="stable")
    shard, cuts = shard[order], None
    cuts = np.flatnonzero(np.diff(shard)) + 1
    parts = [np.split(a[order], cuts) for a in arrays]
    for i, at in enumerate(np.concatenate([[0], cuts]) if len(shard) else []):
        yield int(shard[at]), [p[i] for p in parts]


def _five(suffixes: np.ndarray) -> bytes:
    """40-bit numbers as five bytes each."""
    return suffixes.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view(U64).ravel()


def _counted(texts: DataFrame, shards: int) -> DataFrame:
    """Packed counts of words and pairs, combined within each task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            words = np.concatenate(waiting)
            contexts = before(np.cumsum([len(w) for w in waiting]), words)
            each, counts = np.unique(words, return_counts=True)
            rows = [{"shard": s, "kind": "word", "a": w.tobytes(), "b": c.astype(np.int64).tobytes()} for s, (w, c) in _split(_shard_of_word(each, shards), each, counts)]
            to = _shard_of_pair(contexts, words, shards)
            for s, (h, w) in _split(to, contexts, _suffix(words)):
                h, w, c = _combine(h, w, np.ones(len(h), dtype=np.int64))
                rows.append({"shard": s, "kind": "pair", "a": h.tobytes(), "b": _five(w), "c": c.astype(np.uint32).tobytes()})
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                waiting.append(tokens(text))
                held += len(waiting[-1])
                if held >= FLUSH:
                    yield from flush()
                    waiting.clear()
                    held = 0
        if waiting:
            yield from flush()

    return texts.mapInArrow(work, _COUNTS)


def _write(folder: str, name: str, data: bytes) -> None:
    """One file of the shared folder, complete or not there."""
    where = urlparse(folder)
    if where.scheme in ("", "file"):
        os.makedirs(where.path, exist_ok=True)
        temporary = f"{where.path}/.{name}.{uuid.uuid4().hex}"
        with open(temporary, "wb") as f:
            f.write(data)
        os.replace(temporary, f"{where.path}/{name}")
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    part = f"{path}/{name}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as f:
        f.write(data)
    system.move(part, f"{path}/{name}")


def _local(folder: str, name: str) -> str:
    """A path to map: the shared file itself, or this machine's copy of it."""
    where = urlparse(folder)
    if where.scheme in ("", "file"):
        return f"{where.path}/{name}"
    copy = f"{tempfile.gettempdir()}/{re.sub(r'[^0-9A-Za-z]+', '-', folder)}-{name}"
    if not os.path.exists(copy):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
            return copy  # a shard without entries has no file: nothing to copy, and the reader finds none
        with system.open_input_file(f"{path}/{name}") as source, open(part := f"{copy}.{uuid.uuid4().hex}", "wb") as f:
            while data := source.read(16 << 20):
                f.write(data)
        os.replace(part, copy)
    return copy


def _pairs_met(counted: DataFrame, folder: str, shards: int) -> DataFrame:
    """Writes level two, shard by shard; returns words' counts and the discounted mass of contexts, packed by the words' shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, dict[str, list]] = {}
        for batch in batches:
            for shard, kind, a, b, c in zip(*[x.to_pylist() for x in batch.columns[:5]]):
                own = parts.setdefault(shard, {"word": [], "pair": []})
                a = np.frombuffer(a, dtype=U64)
                own[kind].append((a, np.frombuffer(b, dtype=np.int64)) if kind == "word" else (a, _from_five(b), np.frombuffer(c, dtype=np.uint32).astype(np.int64)))
        for shard, own in parts.items():
            if own["word"]:
                words, counts = (np.concatenate(x) for x in zip(*own["word"]))
                words, _, counts = _combine(words, np.zeros(len(words), dtype=U64), counts)
                yield pa.RecordBatch.from_pylist([{"shard": shard, "kind": "word", "a": words.tobytes(), "b": counts.tobytes(), "c": b"", "n": int(counts.sum())}], _ARROW)
            if not own["pair"]:
                continue
            contexts, suffixes, counts = _combine(*(np.concatenate(x) for x in zip(*own["pair"])))
            kept = counts >= LEAST
            contexts, suffixes, codes = contexts[kept], suffixes[kept], quantised(counts[kept] - DISCOUNT)
            heads, starts = np.unique(contexts, return_index=True)
            if len(heads) >> (63 - SUFFIX_BITS):
                raise ValueError("too many contexts in one shard; raise spark.sql.shuffle.partitions")
            owner = np.repeat(np.arange(len(heads), dtype=U64), np.diff(np.append(starts, len(contexts))))
            levels = EliasFano.of(heads).parts("contexts") | EliasFano.of(np.append(starts, len(contexts)).astype(U64)).parts("pointers")
            levels |= EliasFano.of(owner << U64(SUFFIX_BITS) | suffixes).parts("successors") | {"codes": codes}
            _write(folder, f"pairs-{shard:06d}", pack(levels))
            if len(heads):
                mass = np.add.reduceat(weights_of(codes), starts)
                yield pa.RecordBatch.from_pylist([{"shard": s, "kind": "mass", "a": h.tobytes(), "b": m.tobytes(), "c": b""} for s, (h, m) in _split(_shard_of_word(heads, shards), heads, mass)], _ARROW)

    return counted.repartitionById(shards, F.col("shard")).mapInArrow(work, _COUNTS)


def _words_met(met: DataFrame, folder: str, shards: int) -> DataFrame:
    """Writes level one, shard by shard; returns each shard's token and word numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, dict[str, list]] = {}
        for batch in batches:
            for shard, kind, a, b in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                own = parts.setdefault(shard, {"word": [], "mass": []})
                own[kind].append((np.frombuffer(a, dtype=U64), np.frombuffer(b, dtype=np.int64 if kind == "word" else np.float64)))
        for shard, own in parts.items():
            words, counts = own["word"][0]
            mass = np.zeros(len(words))
            for heads, some in own["mass"]:
                np.add.at(mass, np.searchsorted(words, heads), some)
            left = np.clip(1 - mass / counts, 0, 1)
            levels = EliasFano.of(words).parts("words") | EliasFano.of(np.concatenate([[0], np.cumsum(counts)]).astype(U64)).parts("sums")
            _write(folder, f"words-{shard:06d}", pack(levels | {"backoff": np.round(left * 65535).astype(np.uint16)}))
            yield pa.RecordBatch.from_arrays([pa.array([int(counts.sum())], pa.int64()), pa.array([len(words)], pa.int64())], ["tokens", "words"])

    return met.select("shard", "kind", "a", "b").repartitionById(shards, F.col("shard")).mapInArrow(work, "tokens long, words long")


@dataclass(frozen=True)
class Model:
    """Where the levels are, how many shards they have, and the training tokens and distinct words."""

    folder: str
    shards: int
    tokens: int
    words: int


def fit(texts: DataFrame, text: str = "text", shards: int | None = None) -> Model:
    """Count all texts of a frame and write the trie. Null texts are empty: one end token each."""
    spark = texts.sparkSession
    bounded_batches(spark)
    shards = shards or partitions(spark)
    folder = shared_folder(spark, "language-model")
    counted = _counted(texts.select(F.col(text).cast("binary").alias("text")), shards)
    met = stored(_pairs_met(counted, folder, shards), "language-model-counts")
    total = stored(_words_met(met, folder, shards), "language-model-sizes").agg(F.sum("tokens"), F.sum("words")).head()
    return Model(folder, shards, int(total[0] or 0), int(total[1] or 0))


class Reader:
    """A worker's view of a model; a shard's files are mapped when first asked for."""

    def __init__(self, model: Model):
        self.model = model
        self.files: dict[str, dict | None] = {}

    def _file(self, name: str) -> dict | None:
        if name not in self.files:
            path = _local(self.model.folder, name)
            if not os.path.exists(path):
                self.files[name] = None  # a shard without entries has no file
            else:
                arrays = mapped(path)
                levels = {k.split(".")[0] for k in arrays if "." in k}
                self.files[name] = arrays | {k: EliasFano.view(arrays, k) for k in levels}
        return self.files[name]

    def words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and back-off weight of each word (0 and 1 if unknown)."""
        counts, backoff = np.zeros(len(words), dtype=np.int64), np.ones(len(words))
        for shard, (at, own) in _split(_shard_of_word(words, self.model.shards), np.arange(len(words)), words):
            if (file := self._file(f"words-{shard:06d}")) is None:
                continue
            found = file["words"].find(own)
            there = np.flatnonzero(found >= 0)
            i = found[there]
            counts[at[there]] = (file["sums"][i + 1] - file["sums"][i]).astype(np.int64)
            backoff[at[there]] = file["backoff"][i] / 65535
        return counts, backoff

    def pairs(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Discounted count of each pair (0 if not kept); queries of one context are looked up together."""
        out = np.zeros(len(words))
        for shard, (at, heads, own) in _split(_shard_of_pair(contexts, words, self.model.shards), np.arange(len(words)), contexts, _suffix(words)):
            if (file := self._file(f"pairs-{shard:06d}")) is None:
                continue
            each, which = np.unique(heads, return_inverse=True)
            found = file["contexts"].find(each)
            known = np.flatnonzero(found >= 0)
            start, stop = np.zeros(len(each), np.int64), np.zeros(len(each), np.int64)
            start[known], stop[known] = file["pointers"][found[known]], file["pointers"][found[known] + 1]
            asked = np.flatnonzero(found[which] >= 0)
            context = which[asked]
            value = found[context].astype(U64) << U64(SUFFIX_BITS) | own[asked]
            place = file["successors"].find(value, start[context], stop[context])
            there = np.flatnonzero(place >= 0)
            out[at[asked[there]]] = weights_of(file["codes"][place[there]])
        return out

    def score(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, unigram base score and model score of each text."""
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        words = np.concatenate(texts)
        contexts = before(ends, words)
        n, v = self.model.tokens, self.model.words
        each, which = np.unique(words, return_inverse=True)
        counts, backoff = self.words(each)
        base = np.log10((counts + 1) / (n + 1 * (v + 1)))
        # A context is a word of the same texts or the end, so its place in `each` is known.
        heads = np.empty_like(which)
        heads[1:] = which[:-1]
        heads[starts] = np.searchsorted(each, U64(END))
        pairs, of_pair = np.unique(heads * len(each) + which, return_inverse=True)
        h, w = pairs // len(each), pairs % len(each)
        seen = self.pairs(each[h], each[w])
        p = np.divide(seen, counts[h], out=np.zeros(len(h)), where=counts[h] > 0) + backoff[h] * (counts[w] + 1) / (n + v + 1)
        smallest = 1 / (65536 * (n + v + 1.0))  # a back-off weight that rounds to 0
        logs = np.log10(np.maximum(p, smallest))
        total = lambda x: np.add.reduceat(x, starts)
        return sizes, total((counts > 0)[which].astype(np.int64)), total(base[which]), total(logs[of_pair])


_READERS: dict[Model, Reader] = {}


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the whole text).

    Null text is empty: one end token. A model without training texts gives every token probability 1.
    Repeated rows score alike; an empty frame stays empty. Columns of the five names are replaced.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        if model not in _READERS:
            _READERS.clear()
            _READERS[model] = Reader(model)
        reader = _READERS[model]
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            waiting: list[np.ndarray] = []
            held = 0
            for i, t in enumerate(batch.column(0).to_pylist(), 1):
                waiting.append(tokens(t))
                held += len(waiting[-1])
                if held >= FLUSH or i == batch.num_rows:
                    for column, values in zip(out, reader.score(waiting)):
                        column.append(values)
                    waiting, held = [], 0
            n, known, base, own = [np.concatenate(x) if x else np.zeros(0) for x in out]
            yield [pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(n), model.tokens, np.int64)), pa.array(base, pa.float64()), pa.array(own, pa.float64())]

    names = {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType()}
    return append(docs, work, [F.col(text).cast("binary")], T.StructType([T.StructField(k, t) for k, t in names.items()]))


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a model that never saw the held-out seventh."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out: Column = remainder_is("doc_id", 7, 2)
    model = fit(docs.where(~held_out))
    scored = score(docs.withColumn("held_out", held_out), model)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op6_lm_scoring": op6_lm_scoring}
SQL: dict[str, str] = {}
