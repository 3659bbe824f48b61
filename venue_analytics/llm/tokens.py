"""Token counts by heap-and-linked-list byte-pair merging.

A piece of text starts as a linked list of byte symbols; a heap holds the mergeable adjacent pairs by
rank and place. The lowest is popped, checked against the list (an earlier merge may have consumed it),
merged, and the two new neighbour pairs are pushed. The count is the initial symbols minus the merges;
no token identifiers are made. Each Python worker remembers the counts of recent words, up to a fixed
number of entries; the cache changes speed only.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
REMEMBERED = 500_000
ODD_SEPARATORS = re.compile("[\x1c-\x1f]")  # str.split() breaks at these, the vocabulary's \s doesn't
WHITE_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: its own where Latin-1 prints it, else the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Counter:
    """Token counts for one tokenizer file (a BPE model with byte symbols and an end-of-word suffix)."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ranks = {(a, b): i for i, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
        self.symbols = byte_symbols()
        self.known = set(model["vocab"])
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.remembered = remembered
        self.words = _Remembered(self._word)
        self.pieces = _Remembered(self._piece)

    def _piece(self, piece: str) -> int:
        symbols = [self.symbols[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        symbols = [s for s in symbols if s in self.known]  # without an unknown token, the library leaves such symbols out
        n = count = len(symbols)
        ranks = self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            left = symbols[i]
            if left is None or (j := after[i]) >= n or ranks.get((left, symbols[j])) != rank:
                continue
            symbols[i], symbols[j] = left + symbols[j], None
            count -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return count

    def _plain(self, word: str) -> int:
        word = unicodedata.normalize("NFC", word)
        word = "".join([c.lower() for c in word]) if "Σ" in word else word.lower()  # each character alone: no final sigma
        return sum(map(self.pieces.__getitem__, self.pattern.findall(word)))

    def _word(self, word: str) -> int:
        if self.special and (found := self.special.findall(word)):
            return len(found) + sum(map(self._plain, self.special.split(word)))
        return self._plain(word)

    def __call__(self, text: str) -> int:
        for cache in (self.words, self.pieces):
            if len(cache) > self.remembered:
                cache.clear()
        words = text.split() if not ODD_SEPARATORS.search(text) else WHITE_SPACE.split(text)
        return sum(map(self.words.__getitem__, words))


class _Remembered(dict):
    def __init__(self, make):
        self.make = make

    def __missing__(self, key: str) -> int:
        value = self.make(key)
        if len(key) < 100:
            self[key] = value
        return value


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter for a file, read once."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """docs with n_bytes (UTF-8), n_tokens and over_limit.

    Null text counts as empty: 0 bytes, 0 tokens. Whole texts, no special tokens added; special strings
    in a text are one token each. Columns of the three names are replaced.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        count = counter(path)
        for batch in batches:
            yield [pa.array([count(t) if t else 0 for t in batch.column(0).to_pylist()], pa.int64())]

    counted = append(docs, work, [F.col(text)], T.StructType([T.StructField("n_tokens", T.LongType())]))
    kept = [F.col(f"`{c}`") for c in counted.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return counted.select(*kept, n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every whole document."""
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path(VOCABULARY)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {"op1_token_counts": op1_token_counts}
SQL: dict[str, str] = {}
