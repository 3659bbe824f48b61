"""Source divergence audit by one-hot level products.

Every (lang, source) group gives each term of its language's vocabulary a count level. Think of a
matrix X with one row per kept term and one indicator column per (group, level): X^T X holds, for any
two groups, the joint table "how many terms stand at level a in the one and level b in the other", and
X^T 1 the marginal tables. Each cell of a joint table is priced once, f(a, b) times the number of terms
in it, and the prices summed give a pair's divergence: work grows with the distinct levels, not with
the terms.

X^T X is computed as Spark computes a sparse matrix product: the non-zero entries (term, group, level)
are joined with themselves on the term (Spark hash-partitions the terms into blocks; each block's outer
products are summed map-side by partial aggregation) and grouped by (group, level, group, level).
Level 0 is never materialised: its cells follow exactly from the marginals by inclusion-exclusion,

    f(a, b) = f00 + [a>0](f(a,0) - f00) + [b>0](f(0,b) - f00) + [a>0][b>0](f(a,b) - f(a,0) - f(0,b) + f00),

so a term that occurs in one source only never meets the others. X^T X is symmetric: only the cells of
g < h are made, and each is priced for (g, h) and, transposed, for (h, g). Terms and groups enter the
product by number. All arithmetic is on integers: prices as long, sums as two longs, then decimal(38, 0).

The occurrences are counted before that: tasks fold their documents' terms (Arrow batches, bytes), the
folded counts are shuffled once by (lang, term), and everything a term needs of its language (documents,
count, number) is a window over that partitioning.

Defined cases: null text, lang or source count as ''; an empty table gives no rows; a group without
terms (or a lang without kept terms, V = 0) still gives its pair rows (value 0 when V = 0); repeated
rows are documents each; ties in value are broken by the item's UTF-8 order; other input columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, UPPER, bounded_batches, release, stored, table

# Fixed values of the contract.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
# The same by bytes of UTF-8: A-Z lower-cased, every other byte outside the class a space, which parts terms.
FOLDED = bytes(i if i >= 0x80 or chr(i) in LOWER else ord(LOWER[UPPER.index(chr(i))]) if chr(i) in UPPER else 0x20 for i in range(256))
LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200

SALT = 64  # buckets of one group's terms ranked apart before its top terms are chosen
HELD_TERMS = 400_000  # (lang, source, term) counts a task holds before it hands them on: about 80 MB
BATCH_ROWS = 50_000


def _p(count: str, total: str, kept: str) -> F.Column:
    """1 + floor(SCALE * (count + 1) / (N + V)), exact in long."""
    return F.expr(f"1 + ({SCALE} * ({count} + 1)) div nullif({total} + {kept}, 0)")


def _f(p: F.Column, q: F.Column) -> F.Column:
    """floor((p - q)^2 / q), exact in long: p and q lie in 1 .. SCALE + 1, so the square is at most 10^18."""
    return F.call_function("div", (p - q) * (p - q), q)


def _total(times: F.Column, price: F.Column) -> F.Column:
    """Exact sum of times * price as decimal(38, 0), the price in two parts (by SCALE) so that both sums stay long."""
    high, low = F.call_function("div", price, F.lit(SCALE)), price % F.lit(SCALE)
    return F.sum(times * high).cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(10,0)") + F.sum(times * low).cast("decimal(38,0)")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) rows to partial counts (lang, source, term, count, documents), all strings as bytes."""
    groups: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, documents) in groups.items():
            terms = list(counts)
            for i in range(0, len(terms), BATCH_ROWS):
                part = terms[i : i + BATCH_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.binary()), len(part)), pa.repeat(pa.scalar(source, pa.binary()), len(part)), pa.array(part, pa.binary()),
                        pa.array([counts[t] for t in part], pa.int64()), pa.array([documents[t] for t in part], pa.int64()),
                    ],
                    ["lang", "source", "term", "count", "documents"],
                )
        groups.clear()

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            terms = text.translate(FOLDED).split()
            if not terms:
                continue
            if (lang, source) not in groups:
                groups[lang, source] = Counter(), Counter()
                held += 4  # about what two empty tables take
            counts, documents = groups[lang, source]
            held -= len(documents)
            counts.update(terms)
            documents.update(set(terms))
            held += len(documents)
            if held >= HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()
    release()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, count, documents) of every term of every group, over all rows, partitioned by (lang, term)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).cast("binary").alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    return (
        rows.mapInArrow(_folded, "lang binary, source binary, term binary, count long, documents long")
        .select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")], "count", "documents")
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))
    )


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value (long), rank (int) of every (lang, source) group.

    pair: one row for each other source of the lang, value = sum over kept terms of f(p, q), q the other
    source's p; all ranks. term: the kept terms with a count in the group and p above the lang's p,
    value f(p, q_lang); ranks up to ``top_terms``. Ranks count from 1 by value descending, item
    ascending (UTF-8).
    """
    of_term = Window.partitionBy("lang", "term")
    # The non-zero entries of X, (lang, source, term, level c), with the term's number and its count in the lang.
    entries = stored(
        term_counts(docs, text, lang, source)
        .withColumn("row", F.monotonically_increasing_id())
        .select(
            "lang", "source", "term", F.col("count").alias("c"), "row", F.sum("documents").over(of_term).alias("documents"),
            F.sum("count").over(of_term).alias("c_lang"), F.min("row").over(of_term).alias("number"),
        )
        .where(F.col("documents") >= LEAST_DOCUMENTS)
        .select("lang", "source", "term", "c", "c_lang", "number", (F.col("row") == F.col("number")).cast("long").alias("first")),
        "divergence-entries",
    )
    groups = docs.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"), F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("source")
    ).distinct()
    of_lang = Window.partitionBy("lang")
    sized = stored(
        groups.join(entries.groupBy("lang", "source").agg(F.sum("c").alias("n"), F.sum("first").alias("v")), ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("v", F.lit(0)).cast("long").alias("v"))
        .select("lang", "source", "n", F.sum("v").over(of_lang).alias("v"), F.sum("n").over(of_lang).alias("n_lang"), F.monotonically_increasing_id().alias("g")),
        "divergence-groups",
    )

    # Part term: the group's p against the lang's, top terms through salted buckets.
    priced = (
        entries.join(sized, ["lang", "source"])
        .select("lang", "source", "term", _p("c", "n", "v").alias("p"), _p("c_lang", "n_lang", "v").alias("q"))
        .where(F.col("p") > F.col("q"))
        .select("lang", "source", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    )
    order = [F.col("value").desc(), F.col("item").asc()]
    bucket = F.pmod(F.xxhash64("item"), F.lit(SALT))
    near_top = (
        priced.withColumn("bucket", bucket)
        .withColumn("r", F.row_number().over(Window.partitionBy("lang", "source", "bucket").orderBy(*order)))
        .where(F.col("r") <= top_terms)
        .drop("bucket", "r")
    )
    terms = (
        near_top.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
        .where(F.col("rank") <= top_terms)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    )

    # Part pair: marginals X^T 1, joint tables X^T X, level 0 by inclusion-exclusion.
    a, b = sized.alias("a"), sized.alias("b")
    pairs = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source"))).select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item"),
        F.col("a.g").alias("g"), F.col("b.g").alias("h"), F.col("a.n").alias("ns"), F.col("b.n").alias("nt"), F.col("a.v").alias("v"),
    )
    pairs = stored(pairs, "divergence-pairs")
    ps0, pt0 = _p("0", "ns", "v"), _p("0", "nt", "v")
    f00 = _f(ps0, pt0)
    margins = entries.groupBy("lang", "source", "c").agg(F.count(F.lit(1)).alias("m"))
    own = (
        pairs.join(margins, ["lang", "source"])
        .groupBy("g", "h")
        .agg(_total(F.col("m"), _f(_p("c", "ns", "v"), pt0) - f00).alias("own"))
    )
    other = (
        pairs.join(margins.withColumnRenamed("source", "item"), ["lang", "item"])
        .groupBy("g", "h")
        .agg(_total(F.col("m"), _f(ps0, _p("c", "nt", "v")) - f00).alias("other"))
    )
    x = entries.join(sized, ["lang", "source"]).select("number", "g", "c")
    left, right = x.alias("l"), x.alias("r")
    cells = (
        left.join(right, (F.col("l.number") == F.col("r.number")) & (F.col("l.g") < F.col("r.g")))
        .groupBy(F.col("l.g").alias("g"), F.col("l.c").alias("a"), F.col("r.g").alias("h"), F.col("r.c").alias("b"))
        .agg(F.count(F.lit(1)).alias("cell"))
    )
    ps, pt = _p("a", "ns", "v"), _p("b", "nt", "v")
    halves = (
        cells.join(pairs, ["g", "h"])
        .groupBy("g", "h")
        .agg(
            _total(F.col("cell"), _f(ps, pt) - _f(ps, pt0) - _f(ps0, pt) + f00).alias("there"),
            _total(F.col("cell"), _f(pt, ps) - _f(pt, ps0) - _f(pt0, ps) + _f(pt0, ps0)).alias("back"),
        )
    )
    both = halves.select(F.inline(F.array(
        F.struct(F.col("g"), F.col("h"), F.col("there").alias("both")), F.struct(F.col("h").alias("g"), F.col("g").alias("h"), F.col("back").alias("both"))
    )))
    zero = F.lit(0).cast("decimal(38,0)")
    value = F.col("v").cast("decimal(38,0)") * f00.cast("decimal(38,0)") + F.coalesce("own", zero) + F.coalesce("other", zero) + F.coalesce("both", zero)
    pair = (
        pairs.join(own, ["g", "h"], "left").join(other, ["g", "h"], "left").join(both, ["g", "h"], "left")
        .select("lang", "source", "item", F.when(F.col("v") > 0, value).otherwise(zero).alias("value"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    )
    return pair.unionByName(terms)


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of every source from the other sources of its language, and its most telling terms."""
    return audit(table(spark, folder, "documents"))


_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op11_source_divergence": f"""
        WITH d AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS rid,
                   regexp_extract_all({_LOWER.format(x="coalesce(text, '')")}, '{TERM}') AS terms
            FROM documents),
        occ AS (SELECT lang, source, rid, unnest(terms) AS term FROM d),
        groups AS (SELECT DISTINCT lang, source FROM d),
        kept AS (SELECT lang, term FROM (SELECT DISTINCT lang, rid, term FROM occ) GROUP BY lang, term HAVING count(*) >= {LEAST_DOCUMENTS}),
        vs AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
        gc AS (SELECT o.lang, o.source, o.term, count(*) AS c FROM occ o JOIN kept k ON k.lang = o.lang AND k.term = o.term GROUP BY o.lang, o.source, o.term),
        lc AS (SELECT lang, term, sum(c) AS c FROM gc GROUP BY lang, term),
        gn AS (SELECT g.lang, g.source, coalesce(sum(gc.c), 0) AS n FROM groups g LEFT JOIN gc ON gc.lang = g.lang AND gc.source = g.source GROUP BY g.lang, g.source),
        ln AS (SELECT lang, sum(n) AS n FROM gn GROUP BY lang),
        gp AS (
            SELECT g.lang, g.source, k.term, coalesce(gc.c, 0) AS c,
                   1 + ({SCALE} * (coalesce(gc.c, 0) + 1)) // (gn.n + vs.v) AS p
            FROM groups g JOIN kept k ON k.lang = g.lang JOIN gn ON gn.lang = g.lang AND gn.source = g.source JOIN vs ON vs.lang = g.lang
            LEFT JOIN gc ON gc.lang = g.lang AND gc.source = g.source AND gc.term = k.term),
        lp AS (
            SELECT k.lang, k.term, 1 + ({SCALE} * (coalesce(lc.c, 0) + 1)) // (ln.n + vs.v) AS q
            FROM kept k JOIN ln ON ln.lang = k.lang JOIN vs ON vs.lang = k.lang LEFT JOIN lc ON lc.lang = k.lang AND lc.term = k.term),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(CAST((a.p - b.p) * (a.p - b.p) // b.p AS HUGEINT)) AS value
            FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source),
        pair AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        term AS (
            SELECT g.lang, g.source, 'term' AS part, g.term AS item, CAST((g.p - l.q) * (g.p - l.q) // l.q AS BIGINT) AS value
            FROM gp g JOIN lp l ON l.lang = g.lang AND l.term = g.term
            WHERE g.c > 0 AND g.p > l.q),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}""",
}

QUERIES = {"op11_source_divergence": op11_source_divergence}
