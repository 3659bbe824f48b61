r"""Chat formatting with an offset-aligned loss mask.

A turn is rendered as ``<s>role[INST]text[/INST]</s>``. Control strings inside roles and texts are
escaped by a backslash after their first character, and backslashes are doubled, so the escaped text
never holds a control string and the original comes back exactly. The whole conversation is rendered
and encoded once, with offsets; the control strings are special tokens, so tokens never straddle a
turn's edge; the sorted turn spans meet the token spans by binary search.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, table

VOCABULARY = "byte_bpe_50k.json"
OPEN, START, STOP, CLOSE = CONTROL = ("<s>", "[INST]", "[/INST]", "</s>")
LEARNT = "assistant"
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(rf"{re.escape(OPEN)}(.*?){re.escape(START)}(.*?){re.escape(STOP)}{re.escape(CLOSE)}", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts to learn from."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{START}", escape(text)
        if role == LEARNT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}{STOP}{CLOSE}")
        at += len(parts[-1])
    return "".join(parts), spans


def mask(token_starts: np.ndarray, token_ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for each token that meets a span; both are sorted, each span is found by two binary searches."""
    under = np.zeros(len(token_starts), dtype=bool)
    if spans and len(under):
        a, b = np.array(spans).T
        for lo, hi, empty in zip(np.searchsorted(token_ends, a, "right"), np.searchsorted(token_starts, b, "left"), a == b):
            if not empty:
                under[lo:hi] = True
    return under


_TOKENIZERS: dict[str, object] = {}


def tokenizer(path: str):
    """The worker's tokenizer with the control strings as special tokens and offsets that keep white space."""
    if path not in _TOKENIZERS:
        from tokenizers import AddedToken, Tokenizer, processors

        t = Tokenizer.from_file(path)
        t.post_processor = processors.ByteLevel(trim_offsets=False)
        t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROL])
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def conversations_of(rows: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, turns (role, text; by turn, then role and text). Null roles and texts are empty."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def format_conversations(conversations: DataFrame, path: str) -> DataFrame:
    """conversations with formatted, token_ids, token_starts, token_ends and loss_mask.

    A conversation without turns is the empty string without tokens. An empty assistant text has no
    token under the mask. Columns of the five names are replaced.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        t = tokenizer(path)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for turns in batch.column(0).to_pylist():
                text, spans = render([(x["role"] or "", x["text"] or "") for x in turns or []])
                encoded = t.encode(text, add_special_tokens=False)
                offsets = np.array(encoded.offsets, dtype=np.int32).reshape(-1, 2)
                under = mask(offsets[:, 0], offsets[:, 1], spans)
                for column, value in zip(out, (text, encoded.ids, offsets[:, 0], offsets[:, 1], under.tolist())):
                    column.append(value)
            ints = pa.list_(pa.int32())
            yield [pa.array(out[0], pa.string()), *[pa.array(x, ints) for x in out[1:4]], pa.array(out[4], pa.list_(pa.bool_()))]

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("formatted", T.StringType()), T.StructField("token_ids", ints), T.StructField("token_starts", ints), T.StructField("token_ends", ints), T.StructField("loss_mask", T.ArrayType(T.BooleanType()))])
    return append(conversations, work, [F.col("turns")], schema)


def turns_in(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def learnt_texts(formatted: str, starts: list[int], ends: list[int], under: list[bool]) -> list[str]:
    """The unescaped texts under the mask, one for each run of masked tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.array(under, dtype=np.int8), [0]])))
    return [unescape(formatted[starts[a] : ends[b - 1]]) for a, b in edges.reshape(-1, 2)]


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of turns and learnt texts, from the formatted output alone."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, starts, ends, under in zip(*[c.to_pylist() for c in batch.columns]):
                turns, learnt = turns_in(text), "".join(learnt_texts(text, starts, ends, under))
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                for column, value in zip(out, (len(turns), digest, len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text))):
                    column.append(value)
            yield [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()), pa.array(out[4], pa.int64())]

    schema = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = [F.col(c) for c in ("formatted", "token_starts", "token_ends", "loss_mask")]
    return append(formatted, work, columns, T.StructType([T.StructField(n, T.LongType() if k == "long" else T.StringType()) for n, k in (x.split() for x in schema.split(", "))]))


def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, and a last one (-1) whose texts hold control strings; read back from the output."""
    import public_tokenizers

    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = f"{CLOSE}{START} ok {STOP}"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, LEARNT, hard)], "conv_id long, turn long, role string, text string")
    done = format_conversations(conversations_of(rows.unionByName(extra)), public_tokenizers.path(VOCABULARY))
    return read_back(done.drop("turns")).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


QUERIES = {"op9_chat_formatting": op9_chat_formatting}
SQL: dict[str, str] = {}
