"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may differ from a passage by k = floor(rate * n) edits. Cut into k + 1
pieces, at least one piece stands unchanged in the passage. One automaton finds all pieces of all items
in a text; each hit gives the place where its item would start; overlapping places of an item are one
window, and Myers' bit-parallel distance decides whether the item stands in it within k edits.

Items are a stated query set: they're taken in blocks of at most ``block_bytes``, each broadcast and
run against all documents. Both sides are compared in lower case with runs of white space as one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, table

RATE = 0.05
BLOCK_BYTES = 16 << 20
HITS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "distance", "start", "end")]))


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any part of the text, end of the first such part)."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        plus = down | ~(across | up) & full
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        eq |= down
        plus = plus << 1 & full
        up = (minus << 1 & full) | ~(eq | plus) & full
        down = plus & eq
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Finds a block of items, (id, text) pairs, in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items: list[tuple[int, str, int]] = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normal(text)
            if not text:
                continue
            k = int(rate * len(text))
            n = len(self.items)
            self.items.append((item_id, text, k))
            cuts = [i * len(text) // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((n, b))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, where)
        self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of each item in the normalised text, once at its best place."""
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        for last, where in self.automaton.iter(text):
            for n, end in where:
                starts.setdefault(n, set()).add(last + 1 - end)
        out = []
        for n, places in starts.items():
            item_id, item, k = self.items[n]
            windows: list[list[int]] = []
            for p in sorted(places):
                a, b = max(0, p - k), p + len(item) + k
                if windows and a <= windows[-1][1]:
                    windows[-1][1] = max(windows[-1][1], b)
                else:
                    windows.append([a, b])
            best = None
            for a, b in windows:
                distance, end = myers(item, text[a:b])
                if distance <= k and (best is None or distance < best[0]):
                    best = (distance, a, a + end)
            if best:
                distance, a, end = best
                reach = text[a:end][::-1]
                _, length = myers(item[::-1], reach[: len(item) + k])
                out.append((item_id, distance, end - length, end))
        return sorted(out, key=lambda h: (h[0] is None, h))


def flag(docs: DataFrame, items: DataFrame, text: str = "text", rate: float = RATE, block_bytes: int = BLOCK_BYTES, column: str = "hits") -> DataFrame:
    """docs with ``hits``: item_id, distance, start and end (in the normalised text) of each item found.

    Null or empty texts hold nothing; null or empty items are found nowhere; repeated items are found
    each for itself: each distinct item text is matched once, under its least id, and a hit is then
    given to every id of that text. No items: every list is empty. A column of the result's name is
    replaced.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    texts = items.groupBy("text").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("copies"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    blocks = max(1, -(-int(total) // (block_bytes // 2)))
    out = docs
    for block in range(blocks):
        some = texts if blocks == 1 else texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        listed, size, repeated = [], 0, False
        for r in some.toLocalIterator():
            listed.append((r["item_id"], r["text"]))
            size += len(r["text"] or "")
            repeated |= r["copies"] > 1
            if size > 4 * block_bytes:  # checked while collecting: a block's distinct texts, not its copies
                raise ValueError("one block of distinct item texts is larger than four times block_bytes; a single item is too long")
        copies: dict[int, list[int]] = {}
        if repeated:
            firsts = some.where("copies > 1").select("text", F.col("item_id").alias("first"))
            for r in items.join(firsts, "text").select("first", "item_id").toLocalIterator():
                copies.setdefault(r["first"], []).append(r["item_id"])
        out = _one_block(out, listed, {k: sorted(v, key=lambda i: (i is None, i)) for k, v in copies.items()}, text, rate, column, block > 0)
    return out


def _one_block(docs: DataFrame, items: list[tuple[int, str]], copies: dict[int, list[int]], text: str, rate: float, column: str, more: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((items, copies))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        listed, ids = shared.value
        find = Matcher(listed, rate)
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "distance", "start", "end")]))
        for batch in batches:
            found = []
            for t in batch.column(0).to_pylist():
                hits = [(i, *h[1:]) for h in find(normal(t)) for i in ids.get(h[0], [h[0]])]
                hits.sort(key=lambda h: (h[0] is None, h))
                found.append([dict(zip(("item_id", "distance", "start", "end"), h)) for h in hits])
            yield [pa.array(found, kind)]

    if not more:
        return append(docs, work, [F.col(text)], T.StructType([T.StructField(column, HITS)]))
    both = append(docs, work, [F.col(text)], T.StructType([T.StructField("__more", HITS)]))
    return both.withColumn(column, F.array_sort(F.concat(column, "__more"))).drop("__more")


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Each benchmark item in each document that holds it within the error budget; clean documents have no row."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = flag(docs, table(spark, folder, "benchmark")).select("doc_id", F.explode("hits").alias("h"))
    return found.select("doc_id", F.col("h.item_id").alias("item_id"), F.col("h.distance").alias("distance"), F.col("h.start").alias("start"), F.col("h.end").alias("end"))


QUERIES = {"op8_decontamination": op8_decontamination}
SQL: dict[str, str] = {}
