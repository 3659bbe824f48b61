"""Licence scan by a positional rare-token index, all in DataFrame functions.

Each template is indexed under the rarest words of its mandatory phrase, by the corpus's own document
frequencies. A file's occurrences of those words are looked up; each posting (template, offset) turns
an occurrence into a candidate start; a candidate that all of a template's index words agree on is
verified by the whole mandatory phrase and scored by the share of the template's IDF weight in place.
Every index word of a template stands in its mandatory phrase, so no place of a phrase is missed. Where
the words before the phrase are cut off by the text's begin, the start is negative and they count as absent.

All work on a file stays in its row: two scans (document frequencies; look-ups), no shuffle of texts.
What the driver sees is one number for each template word.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, table

# Label, template text, mandatory phrase in it. The first three are the base phrases.
TEMPLATES = [
    ("cc-by", "cc by", "cc by"),
    ("gpl", "general public license", "general public license"),
    ("reserved", "all rights reserved", "all rights reserved"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
]
BASE = 3
INDEX_WORDS = 2  # index words of each template
SEPARATORS = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # what is no word before lower-casing; A-Z are word characters then
SHIFT = 2**40  # a candidate is template * SHIFT + start + MARGIN, one long
MARGIN = 64


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _array(items) -> str:
    return f"array({', '.join(items)})"


def words_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """The frame with ``__words``, the text's words as written (no words for a null text)."""
    return docs.withColumn("__words", F.expr(f"filter(split(coalesce(`{text}`, ''), '{SEPARATORS}'), w -> w <> '')"))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of rows, and of rows that hold each template word. Only these few numbers reach the driver."""
    vocabulary = sorted({w for _, t, _ in TEMPLATES for w in t.split()})
    lower = f"translate(w, '{UPPER}', '{LOWER}')"
    held = words_of(docs, text).select(F.expr(f"array_distinct(transform(filter(__words, w -> lower(w) IN ({_quoted(vocabulary)})), w -> {lower}))").alias("held"))
    rows = held.select(F.explode(F.concat(F.array(F.lit("")), "held")).alias("w")).groupBy("w").count().collect()
    found = {r["w"]: r["count"] for r in rows}
    return found.pop("", 0), {w: found.get(w, 0) for w in vocabulary}


def inverse_frequencies(n: int, df: dict[str, int]) -> dict[str, float]:
    return {w: round(math.log((n + 1) / (c + 1)) + 1, 6) for w, c in df.items()}


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, places (array of label, start), score and label lists.

    Null or empty text: no words, no places, score 0, labels ''. Repeated rows are scanned each for
    itself. Existing columns of the names it adds are replaced.
    """
    idf = inverse_frequencies(*document_frequencies(docs, text))
    templates = [t.split() for _, t, _ in TEMPLATES]
    keys = [k.split() for _, _, k in TEMPLATES]
    key_at = [next(i for i in range(len(t)) if t[i : i + len(k)] == k) for t, k in zip(templates, keys)]
    index: list[dict[str, list[int]]] = [{} for _ in range(INDEX_WORDS)]
    for n, (key, at) in enumerate(zip(keys, key_at)):
        rare = sorted(set(key), key=lambda w: (-idf[w], w))[:INDEX_WORDS]
        for r in range(INDEX_WORDS):
            word = rare[min(r, len(rare) - 1)]
            for i, w in enumerate(key):
                if w == word:
                    index[r].setdefault(word, []).append(n * SHIFT + MARGIN - (at + i))
    indexed = sorted(set().union(*index))
    low = lambda w: f"translate({w}, '{UPPER}', '{LOWER}')"
    added = {"n_words", "places", "score", "base_labels", "labels", "__words", "__hits", "__found", "__n"}
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in added]
    hits = words_of(docs, text).selectExpr(
        *kept, "__words", "size(__words) AS __n",
        f"if(size(__words) = 0, array(), filter(sequence(0, greatest(size(__words) - 1, 0)), p -> lower(__words[p]) IN ({_quoted(indexed)}))) AS __hits",
    )

    def candidates(r: int) -> str:
        postings = "map(" + ", ".join(f"'{w}', array({', '.join(f'{e}L' for e in es)})" for w, es in sorted(index[r].items())) + ")"
        return f"flatten(transform(__hits, p -> coalesce(transform({postings}[{low('__words[p]')}], e -> e + p), array())))"

    agreed = candidates(0)
    for r in range(1, INDEX_WORDS):
        agreed = f"array_intersect({agreed}, {candidates(r)})"
    found = hits.selectExpr(*kept, "__words", "__n", f"if(size(__hits) = 0, CAST(array() AS array<bigint>), array_distinct({agreed})) AS __found")
    which, start = f"CAST(c DIV {SHIFT} AS INT)", f"CAST(c % {SHIFT} - {MARGIN} AS INT)"
    literal = lambda lists: _array(_array(f"'{w}'" for w in ws) for ws in lists)
    key_of, at_of = f"{literal(keys)}[{which}]", f"{_array(map(str, key_at))}[{which}]"
    verified = found.selectExpr(
        *kept, "__words", "__n",
        f"transform(filter(__found, c -> {start} + {at_of} >= 0 AND transform(slice(__words, {start} + {at_of} + 1, size({key_of})), w -> {low('w')}) = {key_of}), "
        f"c -> struct({which} AS template, {start} AS start)) AS __found",
    )
    weights = _array(_array(f"{idf[w]}D" for w in t) for t in templates)
    totals = _array(f"{sum(idf[w] for w in t)!r}D" for t in templates)
    in_place = (
        f"aggregate(sequence(0, size({literal(templates)}[c.template]) - 1), 0D, (a, i) -> a + "
        f"if({low('get(__words, c.start + i)')} = {literal(templates)}[c.template][i], {weights}[c.template][i], 0D)) / {totals}[c.template]"
    )
    labels = _array(f"'{label}'" for label, _, _ in TEMPLATES)
    joined = lambda some: f"array_join(array_sort(array_distinct(transform({some}, c -> {labels}[c.template]))), ',')"
    return verified.selectExpr(
        *kept, "CAST(__n AS BIGINT) AS n_words", f"transform(__found, c -> struct(c.template AS template, {labels}[c.template] AS label, CAST(c.start AS BIGINT) AS start)) AS places",
        f"coalesce(round(array_max(transform(__found, c -> {in_place})), 6), 0D) AS score",
        f"{joined(f'filter(__found, c -> c.template < {BASE})')} AS base_labels", f"{joined('__found')} AS labels",
    )


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence places and labels of every document."""
    base = f"filter(places, c -> c.template < {BASE})"
    return scan(table(spark, folder, "documents").select("doc_id", "text")).selectExpr(
        "doc_id", "n_words", f"CAST(size({base}) AS BIGINT) AS n_base", f"array_min(transform({base}, c -> c.start)) AS first_word",
        f"array_max(transform({base}, c -> c.start)) AS last_word", "base_labels", "labels", "score",
    )


def _sql() -> str:
    """Every start of every document against every template, word by word."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    scans = []
    for n, (label, template, key) in enumerate(TEMPLATES):
        t, k = template.split(), key.split()
        at = next(i for i in range(len(t)) if t[i : i + len(k)] == k)
        hit = " AND ".join(f"w[p + {j + 1}] = '{x}'" for j, x in enumerate(k))
        weight = " + ".join(f"CASE WHEN w[p + {i - at + 1}] = '{x}' AND p + {i - at} >= 0 THEN (SELECT f FROM idf WHERE word = '{x}') ELSE 0 END" for i, x in enumerate(t))
        total = " + ".join(f"(SELECT f FROM idf WHERE word = '{x}')" for x in t)
        scans.append(f"SELECT r, {n} AS n, '{label}' AS label, p - {at} AS start, ({weight}) / ({total}) AS share FROM (SELECT r, w, unnest(range(len(w))) AS p FROM lists WHERE list_contains(w, '{k[0]}')) WHERE p >= {at} AND {hit}")
    vocabulary = _quoted(sorted({w for _, t, _ in TEMPLATES for w in t.split()}))
    return f"""
        WITH lists AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        held AS (SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS word FROM lists) GROUP BY word),
        idf AS (SELECT v AS word, round(ln(((SELECT count(*) FROM lists) + 1) / (coalesce(df, 0) + 1)) + 1, 6) AS f
                FROM (SELECT unnest([{vocabulary}]) AS v) LEFT JOIN held ON v = word),
        places AS ({' UNION ALL '.join(scans)}),
        sums AS (SELECT r, count(*) FILTER (n < {BASE}) AS n_base, min(start) FILTER (n < {BASE}) AS first_word, max(start) FILTER (n < {BASE}) AS last_word,
                        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (n < {BASE}) AS base_labels,
                        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, round(max(share), 6) AS score FROM places GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
               CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               CAST(coalesce(score, 0) AS DOUBLE) AS score
        FROM lists LEFT JOIN sums USING (r)"""


QUERIES = {"op2_license_scan": op2_license_scan}
SQL = {"op2_license_scan": _sql()}
