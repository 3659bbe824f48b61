"""N-gram Jaccard self-join by parity sketches.

A document is the set of its distinct word n-grams (64-bit hashes). Sets are joined in size bands: a
band's pairs have a larger set of at most ``upper`` n-grams, so a linked pair differs in at most
d = floor(2 * upper * (1 - t) / (1 + t)) of them. A sketch is a row of 64-bit parity blocks; every n-gram
XORs its hash into one of them. A differing n-gram changes at most one block, so the sketches' Hamming
distance, counted in blocks, is at most the sets' difference, and of d + 1 + spare blocks at least spare + 1 are equal in both (pigeonhole). Each block
with its place and its number of n-grams is a signature; documents that share one are candidates. A second
sketch has one parity bit per place, four to eight places an n-gram: few differences meet in one place, so its
Hamming distance is close to the sets' difference, and never above it. XORing its halves gives the sketch
of half the places, so sets of any two sizes compare. Candidates whose bits differ in more places than a
linked pair may go; the others are verified on their texts.

A document emits only the d + 1 signatures that hold most n-grams (ties by hash). This is one order for
all documents, so the first of the equal blocks in it is never among the ``spare`` last of either
document: no link is lost, while blocks that hold little, and so meet by chance or by a common passage,
or nothing at all, aren't joined.

Equal sets are one node. A signature shared by many nodes first gives links to the least of them only; what
those verified links leave unconnected is then compared pair by pair, across components alone and within the
join, on the bits folded to a fixed width: a large group of near copies gives no row for a pair that isn't near. Equal signatures are combined within each task
before the shuffle, so a very frequent one sends one entry a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, located, narrow, partitions, release, stored, table
from .components import components

WORDS = 4
PERCENT = 85
GROWTH = 1.4  # of a band's upper size over the one below
SPARE = 3  # a sketch has a third more blocks than are emitted
BITS = 4  # least places of the bit sketch for an n-gram
FOLDED = 16  # 64-bit words of the bit sketch that a join compares
REMEMBERED = 100_000
FLUSH = 250_000  # signatures that a task combines at a time

U64 = np.uint64


class _Hashes(dict):
    """64-bit hashes of the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams; of all its words together where they're fewer; none without words."""
    tokens = (text or b"").lower().split()  # on bytes: A-Z, and the six ASCII white-space characters
    if not tokens:
        return np.zeros(0, dtype=U64)
    if len(_HASHES) > REMEMBERED:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, tokens), dtype=U64, count=len(tokens))
    size = min(words, len(tokens))
    n = len(tokens) - size + 1
    out = np.full(n, size, dtype=U64)
    for j in range(size):
        out = (out ^ h[j : j + n]) * U64(0x9E3779B97F4A7C15)
        out ^= out >> U64(29)
    return np.unique(mixed(out))


def node_of(grams: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(grams.tobytes()), dtype=">i8")[0])


class Bands:
    """Sizes and block counts of the bands for a threshold in per cent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.upper = [1]

    def _grow(self, size: int) -> None:
        while self.upper[-1] < size:
            self.upper.append(max(self.upper[-1] + 1, int(self.upper[-1] * GROWTH)))

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(band, blocks to emit, blocks of the sketch) of each band in which a set of n may meet a set as large or larger, or as small or smaller."""
        self._grow(n)
        k = int(np.searchsorted(self.upper, n))
        out = []
        while not out or n * 100 >= self.percent * (self.upper[k - 1] + 1):
            emitted = 2 * self.upper[k] * (100 - self.percent) // (100 + self.percent) + 1
            out.append((k, emitted, emitted + emitted // SPARE))
            k += 1
            if k == len(self.upper):
                self._grow(self.upper[-1] + 1)
        return out


def signatures(grams: np.ndarray, bands: Bands) -> np.ndarray:
    """The signatures of a non-empty set, in each of its bands those of the blocks that hold most."""
    out = []
    bits = mixed(grams ^ U64(0x9E3779B97F4A7C15))
    for band, emitted, blocks in bands.of(len(grams)):
        place = ((grams & U64(0xFFFFFFFFFFFF)) % U64(blocks)).astype(np.int64)
        sketch = np.zeros(blocks, dtype=U64)
        np.bitwise_xor.at(sketch, place, bits)
        held = np.bincount(place, minlength=blocks).astype(U64)
        key = np.arange(blocks, dtype=U64) * U64(0xD6E8FEB86659FD93) ^ U64(band * 0xA0761D6478BD642F % 2**64) ^ held * U64(0xE7037ED1A0B428DB)
        sigs = mixed(mixed(sketch) ^ key)
        if emitted < blocks:
            sigs = sigs[np.lexsort((sigs, held))[blocks - emitted :]]
        out.append(sigs)
    return np.concatenate(out)


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """The bit sketch of a set as 64-bit words, a power of two of them and FOLDED at least."""
    places = 64 * FOLDED
    while places < BITS * len(grams):
        places *= 2
    odd = np.bincount((mixed(grams ^ U64(0xA24BAED4963EE407)) & U64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch with so many words, as the set's own would be with so few places."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def may_link(a: bytes, b: bytes, n: int, m: int, percent: int) -> bool:
    """Whether two sets of n and m n-grams may be linked: no more bits differ than n-grams may."""
    x, y = np.frombuffer(a, dtype=U64), np.frombuffer(b, dtype=U64)
    words = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()) <= (n + m) * (100 - percent) // (100 + percent)


def runs(sigs: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(each signature, its least node; member signatures, member nodes and their least node, where several nodes share one)."""
    order = np.lexsort((nodes, sigs))
    sigs, nodes = sigs[order], nodes[order]
    new = np.ones(len(sigs), dtype=bool)
    new[1:] = (sigs[1:] != sigs[:-1]) | (nodes[1:] != nodes[:-1])
    sigs, nodes = sigs[new], nodes[new]
    first = np.ones(len(sigs), dtype=bool)
    first[1:] = sigs[1:] != sigs[:-1]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(sigs)))
    leader = np.repeat(nodes[starts], sizes)
    many = np.repeat(sizes > 1, sizes)
    return sigs[starts], nodes[starts], sigs[many], nodes[many], leader[many]


def stars(nodes: np.ndarray, leaders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (node, leader) links and how many signatures give each."""
    own = nodes != leaders
    if not own.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    links, counts = np.unique(np.stack([nodes[own], leaders[own]], axis=1), axis=0, return_counts=True)
    return links[:, 0], links[:, 1], counts


#: Rows of documents, of packed signatures for a bucket, of packed members and of packed links share one table.
PACKED = "kind string, row_id long, file string, at long, n long, node long, bucket int, a binary, b binary, c binary"
_ARROW = pa.schema([("kind", pa.string()), ("row_id", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _packed(kind: str, *arrays: np.ndarray, bucket: int | None = None) -> dict:
    return {"kind": kind, "bucket": bucket} | {k: x.tobytes() for k, x in zip("abc", arrays)}


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)


def _signed(documents: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """Pass over the texts: a row for each document, and packed signatures, members and links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, sigs, nodes, seen, held = Bands(percent), [], [], set(), 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not sigs:
                return
            each, least, member_sigs, members, leaders = runs(np.concatenate(sigs), np.concatenate(nodes))
            if len(members):
                yield _rows([_packed("member", member_sigs, members), _packed("link", *stars(members, leaders))])
            to = (each % U64(buckets)).astype(np.int32)
            order = np.lexsort((least, to))
            each, least, to = each[order], least[order], to[order]
            table, index = np.unique(least, return_inverse=True)
            cuts = np.flatnonzero(np.diff(to)) + 1
            for s, i, b in zip(np.split(each, cuts), np.split(index.astype(np.int64), cuts), to[np.concatenate([[0], cuts])]):
                own, short = np.unique(i, return_inverse=True)
                yield _rows([_packed("signature", s, short.astype(np.uint32), table[own], bucket=int(b))])

        for batch in batches:
            documents = []
            for row_id, text, file, at in zip(*[c.to_pylist() for c in batch.columns]):
                grams = shingles(text, words)
                node = node_of(grams) if len(grams) else None
                documents.append({"kind": "document", "row_id": row_id, "file": file, "at": at, "n": len(grams), "node": node})
                if node is not None and node not in seen:
                    seen.add(node)
                    new, documents[-1]["a"] = signatures(grams, bands), parity_bits(grams).tobytes()
                    sigs.append(new)
                    nodes.append(np.full(len(new), node, dtype=np.int64))
                    held += len(new)
                    if held > FLUSH:
                        yield from flush()
                        sigs, nodes, seen, held = [], [], set(), 0
            yield _rows(documents)
        yield from flush()
        sigs, nodes, seen = [], [], set()
        _HASHES.clear()  # workers live on through later stages
        release()

    return documents.mapInArrow(work, PACKED)


def _met(signed: DataFrame, buckets: int) -> DataFrame:
    """Signatures of all tasks, met bucket by bucket: packed members and links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, nodes = [], []
        for batch in batches:
            for a, b, c in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)]):
                sigs.append(np.frombuffer(a, dtype=U64))
                nodes.append(np.frombuffer(c, dtype=np.int64)[np.frombuffer(b, dtype=np.uint32)])
        if sigs:
            _, _, member_sigs, members, leaders = runs(np.concatenate(sigs), np.concatenate(nodes))
            sigs, nodes = [], []
            if len(members):
                yield _rows([_packed("member", member_sigs, members), _packed("link", *stars(members, leaders))])
        release()

    packed = signed.where("kind = 'signature'").select("bucket", "a", "b", "c")
    return packed.repartitionById(buckets, F.col("bucket")).mapInArrow(work, PACKED)


def _unpacked(packed: DataFrame, kind: str, names: list[str]) -> DataFrame:
    """The rows of packed arrays, as longs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                arrays = [np.frombuffer(x, dtype=np.int64) for x in row]
                for at in range(0, len(arrays[0]), 1 << 20):
                    yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 20)]) for x in arrays], names)

    return packed.where(F.col("kind") == kind).select(*"abc"[: len(names)]).mapInArrow(work, ", ".join(f"{n} long" for n in names))


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose texts' n-gram sets are similar enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            us, vs, tu, tv = [c.to_pylist() for c in batch.columns]
            keep = []
            for v, a, b in zip(vs, tu, tv):
                if v != last[0]:
                    last = (v, shingles(b, words))
                x, y = shingles(a, words), last[1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            found = [(u, v) for u, v, k in zip(us, vs, keep) if k]
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())], ["u", "v"])
        _HASHES.clear()
        release()

    held = texts.select(F.col("node").alias("u"), F.col("text").alias("tu"))
    other = texts.select(F.col("node").alias("v"), F.col("text").alias("tv"))
    return pairs.join(held, "u").join(other, "v").select("u", "v", "tu", "tv").mapInArrow(work, "u long, v long")


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, node, label) of the signatures whose members lie in several components; stored."""
    marked = members.join(narrow(labels), "node", "left").select("sig", "node", F.coalesce("label", "node").alias("label"))
    marked = stored(marked, "join-marked")
    several = marked.groupBy("sig").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("sig")
    return stored(marked.join(several, "sig", "left_semi").distinct(), "join-apart")


def _fitting(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that sizes and whole bit sketches allow to be linked; stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, a, b = [c.to_pylist() for c in batch.columns[2:]]
            keep = pa.array([100 * min(i, j) >= percent * max(i, j) and may_link(x, y, i, j, percent) for i, j, x, y in zip(n, m, a, b)], pa.bool_())
            yield batch.select([0, 1]).filter(keep)

    sized = pairs.join(sketches.toDF("u", "n", "a"), "u").join(sketches.toDF("v", "m", "b"), "v").select("u", "v", "n", "m", "a", "b")
    return stored(sized.mapInArrow(work, "u long, v long"), "join-pairs")


def _near_pairs(apart: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of different components that share a signature and whose sizes and folded bits allow a link.

    The bits are compared in the join itself, so it has no row for the many pairs of a large group that aren't near.
    """
    names = [f"b{i}" for i in range(FOLDED)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = np.stack([folded(np.frombuffer(x, dtype=U64), FOLDED) for x in batch.column(2).to_pylist()]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(bits[:, i]) for i in range(FOLDED)]], ["node", "n", *names])

    met = sketches.join(apart.select("node").distinct(), "node", "left_semi").select("node", "n", "sketch")
    short = stored(met.mapInArrow(work, "node long, n long, " + ", ".join(f"{b} long" for b in names)), "join-bits")
    members = apart.join(narrow(short), "node")
    u, v = members.alias("u"), members.alias("v")
    differ = sum((F.bit_count(F.col(f"u.{b}").bitwiseXOR(F.col(f"v.{b}"))) for b in names[1:]), F.bit_count(F.col("u.b0").bitwiseXOR(F.col("v.b0"))))
    near = (
        (F.col("u.sig") == F.col("v.sig")) & (F.col("u.label") < F.col("v.label"))
        & (100 * F.least("u.n", "v.n") >= percent * F.greatest("u.n", "v.n"))
        & (differ * (100 + percent) <= (F.col("u.n") + F.col("v.n")) * (100 - percent))
    )
    return u.join(v, near).select(F.col("u.node").alias("u"), F.col("v.node").alias("v")).distinct()


def _texts(rows: DataFrame, documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of each node of the pairs, taken from one of its rows; stored."""
    nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    first = documents.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("file", "at")).alias("first"))
    first = stored(first.select("node", "first.file", "first.at"), "join-first")
    return stored(rows.join(narrow(first), ["file", "at"]).select("node", "text"), "join-texts")


def _labelled(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(row_id, n, file, at, label) of every row of (row_id, text, file, at); rows without words have no label."""
    bounded_batches(rows.sparkSession)
    buckets = partitions(rows.sparkSession)
    signed = stored(_signed(rows, words, percent, buckets), "join-signed")
    met = stored(_met(signed, buckets), "join-met")
    documents = signed.where("kind = 'document'").select("row_id", "n", "node", "file", "at", F.col("a").alias("sketch"))
    both = signed.select("kind", *"abc").unionByName(met.select("kind", *"abc"))
    links = _unpacked(both, "link", ["u", "v", "times"])
    members = _unpacked(both, "member", ["sig", "node"])

    sketches = documents.where("sketch IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sketches = stored(sketches, "join-sketches")

    # First links: each node to the one it shares most signatures with, of those that lead one.
    closest = links.groupBy("u", "v").agg(F.sum("times").alias("times")).groupBy("u").agg(F.max(F.struct("times", "v")).alias("best"))
    closest = _fitting(closest.select("u", F.col("best.v").alias("v")), sketches, percent)
    near = stored(_verified(closest, _texts(rows, documents, closest), words, percent), "join-links")
    labels = components(near)

    # Second links, where signatures still join components: each node to the node that meets most others
    # there, such as the original of a group of copies that are alike to it but not to each other.
    apart = _apart(members, labels)
    busy = apart.join(apart.groupBy("sig").agg(F.count("*").alias("times")), "sig").groupBy("node").agg(F.sum("times").alias("met"))
    heads = apart.join(busy, "node").groupBy("sig").agg(F.max(F.struct("met", "node")).alias("head"))
    closest = apart.join(heads, "sig").where("node <> head.node").groupBy(F.col("node").alias("u"), F.col("head.node").alias("v")).agg(F.count("*").alias("times"))
    closest = closest.groupBy("u").agg(F.max(F.struct("times", "v")).alias("best"))
    closest = _fitting(closest.select("u", F.col("best.v").alias("v")), sketches, percent)
    near = near.unionByName(stored(_verified(closest, _texts(rows, documents, closest), words, percent), "join-links"))
    labels = components(near)

    # What is still apart: pairs that share a signature across components.
    apart = _apart(members, labels)
    pairs = _fitting(_near_pairs(apart, sketches, percent), sketches, percent)
    more = stored(_verified(pairs, _texts(rows, documents, pairs), words, percent), "join-links")
    labels = components(near.unionByName(more))

    named = documents.where("node IS NOT NULL").join(labels, "node", "left").select("row_id", "n", "file", "at", F.coalesce("label", "node").alias("label"))
    alone = documents.where("node IS NULL").select("row_id", "n", "file", "at", F.lit(None).cast("long").alias("label"))
    return named.unionByName(alone)


def near_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least doc_id that links reach.

    Texts are lower-cased (A-Z) and split at ASCII white space. Rows with equal sets are one component
    whatever their ids. A row without words has no n-grams and is its own component; rows of one
    component whose ids are all null get null. Hashes have 64 bits: among a hundred million different
    sets two would be taken for equal with a chance of 0.03 %. An empty frame gives no rows.
    """
    rows = located(docs, F.col(key).alias("row_id"), F.col(text).cast("binary").alias("text"))
    labelled = _labelled(rows, words, percent)
    named = labelled.where("label IS NOT NULL")
    least = named.groupBy("label").agg(F.min("row_id").alias("component_id"))
    alone = labelled.where("label IS NULL").select("row_id", "n", F.col("row_id").alias("component_id"))
    return named.join(least, "label").select("row_id", "n", "component_id").unionByName(alone).toDF("doc_id", "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component: the one of the least id (null last), then the first by file and row.

    Rows without words are all kept. Columns stay as they are, whatever their names: they travel in
    one struct while the rows are located and joined, so none can clash with the locator's.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    base = located(docs, row, F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").cast("binary").alias("__text"))
    labelled = _labelled(base.select(F.col("__key").alias("row_id"), F.col("__text").alias("text"), "file", "at"), words, percent).where("label IS NOT NULL")
    order = F.struct(F.col("row_id").isNull().alias("unnamed"), "row_id", "file", "at")
    kept = labelled.groupBy("label").agg(F.min(order).alias("kept"), F.count("*").alias("rows")).where("rows > 1")
    dropped = labelled.join(kept, "label").where("file <> kept.file OR at <> kept.at").select("file", "at")
    return base.join(narrow(stored(dropped, "join-dropped")), ["file", "at"], "left_anti").select("__row.*")


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under links of 4-word shingles at 85 %."""
    return near_components(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {"op10_ngram_join": op10_ngram_join}
SQL: dict[str, str] = {}
