"""The dealt operators against brute-force versions, libraries, round trips and held-out accuracy, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import check, duck
from venue_analytics.llm import chat, common, components, decontaminate, divergence, exact_dedup, language, language_model, licenses, mixing, mtree, registry, sharding, shingle_join, tokens, whitening
from venue_analytics.llm.elias_fano import EliasFano, mapped, pack

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard string, hits string"
ODD = [
    (1, None, "en", "a", 1, 0.5, "x", "y"), (2, "", None, None, None, None, None, None), (3, "  \n\t ", "en", "a", 1, 0.1, "", ""),
    (4, "Hello hello HELLO world", "en", "a", 1, 0.2, "", ""), (4, "Hello hello HELLO world", "en", "a", 1, 0.2, "", ""),
    (None, "one two three four five six seven", None, "b", 2, None, None, None), (6, "long " * 30000, "en", "a", 1, 0.3, "", ""), (7, "123 456 !?", "de", "b", 1, 0.3, "", ""),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(registry.all_statements()))
def test_query_equals_statement(spark, name):
    assert check(spark, duck(FOLDER), FOLDER, registry.all_queries()[name], registry.all_statements()[name]) == ""


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.all_queries()) == list(range(1, 14))


# ---- token counts ------------------------------------------------------------------------------------
def test_token_counts_equal_the_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.VOCABULARY)
    library, count = Tokenizer.from_file(path), tokens.Counter(path, remembered=50)
    hard = ["", " ", "It's they'LL we've I'm", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΟΔΟΣ", "İstanbul ẞ ǅ", "é Å ﬁ", "x\x1cy\x85z w​q", "日本語 テキスト 🎉🎉👩‍👩‍👧", "1234 5.6e7", "́ͅ", "a" * 3000, "<|endoftext|><|endoftext|>"]
    for text in [*hard, *[r.text for r in docs.values()]]:
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), text[:80]


def test_token_counts_of_odd_rows(odd, empty):
    import public_tokenizers

    path = public_tokenizers.path(tokens.VOCABULARY)
    rows = tokens.count_tokens(odd, path).collect()
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in rows[:3]] == [(0, 0, False), (0, 0, False), (5, 0, False)]
    assert rows[6].over_limit and len(rows) == len(ODD)
    assert tokens.count_tokens(empty, path).count() == 0


# ---- licences ----------------------------------------------------------------------------------------
def test_licence_scan_of_odd_rows(spark, odd, empty):
    texts = ["Licensed under CC BY-NC 4.0.", "cc. by cc by", "İcc by Kall rights reserved", "GNU General Public License", None, "cc " * 2000 + "by"]
    rows = licenses.scan(spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, labels string")).orderBy("doc_id").collect()
    assert [r.base_labels for r in rows] == ["cc-by", "cc-by", "", "gpl", "", "cc-by"]
    assert rows[0].labels == "cc-by,cc-by-nc-4.0" and rows[0].score == 1.0
    assert [p.start for p in rows[1].places] == [0, 2] and rows[5].places[0].start == 1999
    assert [r.n_words for r in licenses.scan(odd).collect()][:4] == [0, 0, 0, 4]
    assert licenses.scan(empty).count() == 0


def test_licence_scan_of_texts_that_open_with_a_phrase(spark):
    texts = [tail for _, _, k in licenses.TEMPLATES for tail in (k, f"{k.title()}, 29 June 2007")]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    n = len(texts)
    df = Counter(w for t in texts for w in set(t.lower().replace(",", "").split()))
    idf = {w: round(math.log((n + 1) / (df[w] + 1)) + 1, 6) for _, t, _ in licenses.TEMPLATES for w in t.split()}
    for r, text in zip(rows, texts):
        words = text.lower().replace(",", "").split()
        want, shares = set(), [0.0]
        for label, template, key in licenses.TEMPLATES:
            t, k = template.split(), key.split()
            at = next(i for i in range(len(t)) if t[i : i + len(k)] == k)
            for p in range(len(words) - len(k) + 1):
                if words[p : p + len(k)] == k:
                    want.add((label, p - at))
                    there = [w for i, w in enumerate(t) if 0 <= p - at + i < len(words) and words[p - at + i] == w]
                    shares.append(sum(idf[w] for w in there) / sum(idf[w] for w in t))
        assert {(p.label, p.start) for p in r.places} == want and len(r.places) == len(want)
        assert r.labels == ",".join(sorted({label for label, _ in want})) and r.score == pytest.approx(max(shares), abs=2e-6)


def test_licence_scan_is_native(spark):
    plan = licenses.op2_license_scan(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- language ----------------------------------------------------------------------------------------
def test_language_held_out_accuracy(spark, docs):
    rows = language.op3_language_id(spark, FOLDER).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in rows if r.held_out} == {r.doc_id for r in held} and len(rows) == len(docs)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.95


def test_language_of_odd_rows(odd, empty):
    model = language.fit(odd, F.lit(True))
    rows = language.predict(odd, model).collect()
    assert [r.lang_pred == "und" for r in rows] == [True, True, True, False, False, False, False, True]
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in language.predict(odd, language.fit(empty, F.lit(True))).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


def test_language_sample_draws_copies_apart(spark):
    rate = int(100 / 3000 * (1 << 30))
    copied = spark.range(2000).select(F.repeat(F.lit("z"), F.col("id").cast("int") + 1).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < rate).agg(F.min(F.struct(F.length("t"), "t"))["t"]).head()[0]
    other = f"right('{'y' * len(copied)}' || cast(id AS string), {len(copied)})" if len(copied) > 6 else f"repeat('y', {len(copied)})"
    rows = spark.range(3000).selectExpr("id AS doc_id", f"if(id < 1000, '{copied}', {other}) AS text", "'en' AS lang")
    _, matrix, _ = language.fit(rows, F.lit(True), per_language=100)
    ids, _ = language.features(["z"])
    whole = math.exp(matrix[ids[0], 0]) * (3 * len(copied) - 3) / len(copied)
    assert 0.1 < whole < 0.6


# ---- mixing ------------------------------------------------------------------------------------------
def test_mix_meets_its_marginals(spark):
    rows = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    total = sum(r.n_tokens for r in rows)
    expected = [r.n_tokens * r.weight * r.probability for r in rows]
    for lang, share in mixing.LANGUAGES.items():
        assert sum(e for e, r in zip(expected, rows) if r.lang == lang) / sum(expected) == pytest.approx(share, abs=1e-4)
    own = Counter()
    for r in rows:
        own[r.source] += r.n_tokens
    want = {s: n**0.5 for s, n in own.items()}
    for s in own:
        assert sum(e for e, r in zip(expected, rows) if r.source == s) / sum(expected) == pytest.approx(want[s] / sum(want.values()), abs=1e-4)
    assert sum(r.n_tokens * r.probability for r in rows) == pytest.approx(mixing.KEEP * total, rel=1e-3)
    assert sum(r.n_tokens for r in rows if r.sampled) == pytest.approx(mixing.KEEP * total, rel=0.15)


def test_mix_of_odd_rows_and_many_sources(spark, odd, empty, monkeypatch):
    few = {(r.doc_id, r.text): (r.probability, r.sampled) for r in mixing.mix(odd).collect()}
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)  # the way without a broadcast
    assert {(r.doc_id, r.text): (r.probability, r.sampled) for r in mixing.mix(odd).collect()} == few
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(empty).count() == 0


# ---- sharding ----------------------------------------------------------------------------------------
def test_shards_are_even_and_stable():
    names = sharding.shard_names(10)
    before, after = sharding.fill(names, 1009), sharding.fill(names[:-1], 1009)
    assert max(Counter(before).values()) - min(Counter(before).values()) <= 1
    moved = sum(a != b for a, b in zip(before, after) if b != 9 and a != 9)
    assert moved < 1009 * 0.2
    with pytest.raises(ValueError):
        sharding.fill(names, 1000)


def test_sharding_of_odd_rows(odd, empty):
    rows = sharding.place(odd).collect()
    assert len(rows) == len(ODD) and rows[3].shard == rows[4].shard
    assert sharding.place(empty).count() == 0


# ---- language model ----------------------------------------------------------------------------------
def test_elias_fano(tmp_path):
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (5, 2**63), (1000, 1500), (3000, 2**40)):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        (tmp_path / "f").write_bytes(pack(EliasFano.of(values).parts("x")))
        ef = EliasFano.view(mapped(str(tmp_path / "f")), "x")
        at = np.arange(len(values))
        assert (ef[at] == values).all() and (ef.find(values) == at).all()
        other = np.setdiff1d(np.concatenate([rng.integers(0, top, 500, dtype=np.uint64), values + np.uint64(1)]), values)
        assert (ef.find(other) == -1).all()
    assert (EliasFano.of(np.zeros(0, np.uint64)).find(np.array([3], np.uint64)) == -1).all()
    assert (EliasFano.of(np.array([0, 0, 2, 2], np.uint64))[np.arange(4)] == [0, 0, 2, 2]).all()


def test_language_model_against_brute_force(spark, docs):
    words = {i: [*(r.text or "").encode().lower().split(), b""] for i, r in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    one = Counter(w for i, k in words.items() if not held[i] for w in k)
    two = Counter(p for i, k in words.items() if not held[i] for p in zip([b"", *k[:-1]], k))
    n, v = sum(one.values()), len(one)
    mass = Counter()
    for (h, _), c in two.items():
        mass[h] += (c - language_model.DISCOUNT) if c >= language_model.LEAST else 0
    gains = []
    for r in language_model.op6_lm_scoring(spark, FOLDER).collect():
        k = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(k), sum(one[w] > 0 for w in k), n)
        assert r.base_score == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in k), rel=1e-9)
        score = 0.0
        for h, w in zip([b"", *k[:-1]], k):
            c = two[h, w]
            score += math.log10((c - language_model.DISCOUNT if c >= language_model.LEAST else 0) / max(one[h], 1) + (1 - mass[h] / one[h] if one[h] else 1) * (one[w] + 1) / (n + v + 1))
        assert r.score == pytest.approx(score, rel=0.01)
        if r.held_out:
            gains.append(r.score - r.base_score)
    assert np.mean(gains) > 0


def test_language_model_keeps_bigrams_seen_once(spark):
    texts = ["a b c", "a b d", "e f g h", "e a", "h c e"]
    lists = [[*t.split(), ""] for t in texts]
    one = Counter(w for k in lists for w in k)
    two = Counter(p for k in lists for p in zip(["", *k[:-1]], k))
    n, v = sum(one.values()), len(one)
    asked = [*texts, "f g h", "a c", "g g"]
    frame = lambda rows: spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    rows = language_model.score(frame(asked), language_model.fit(frame(texts))).orderBy("doc_id").collect()
    for r, text in zip(rows, asked):
        want = 0.0
        k = [*text.split(), ""]
        for h, w in zip(["", *k[:-1]], k):
            distinct = sum(c > 0 for (a, _), c in two.items() if a == h)
            want += math.log10((max(two[h, w] - 0.75, 0) + 0.75 * distinct * (one[w] + 1) / (n + v + 1)) / one[h])
        assert r.score == pytest.approx(want, rel=0.005)


def test_language_model_of_odd_rows(odd, empty):
    rows = language_model.score(odd, language_model.fit(empty)).collect()
    assert [r.n_tokens for r in rows][:4] == [1, 1, 1, 5] and all(r.base_score == 0 and r.score == 0 for r in rows)
    model = language_model.fit(odd)
    assert model.tokens == sum(len((r[1] or "").split()) + 1 for r in ODD)
    assert language_model.score(empty, model).count() == 0


# ---- exact duplicates --------------------------------------------------------------------------------
def test_exact_dedup_with_clashing_digests(spark, tmp_path):
    rows = [(1, "a b"), (2, "ab"), (3, " a  b "), (4, "c"), (5, None), (6, " \n"), (7, "c"), (None, "c"), (8, " "), (8, " ")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    for digest in (exact_dedup.sha256, lambda c: F.lit("same")):
        got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(docs, digest=digest).collect()), key=str)
        assert got == sorted([(1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (4, 4, 3, True), (7, 4, 3, False), (None, 4, 3, False), (5, 6, 2, False), (6, 6, 2, True), (8, 8, 2, True), (8, 8, 2, False)], key=str)
    docs.where("doc_id = -1").write.parquet(str(tmp_path / "none"))
    assert exact_dedup.deduplicate(spark.read.parquet(str(tmp_path / "none"))).count() == 0


# ---- decontamination ---------------------------------------------------------------------------------
def slow_distance(p: str, t: str) -> int:
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(t, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row)


def test_myers_and_pigeonhole_against_brute_force():
    rnd = random.Random(3)
    for _ in range(150):
        p = "".join(rnd.choice("ab c") for _ in range(rnd.randint(1, 90)))
        t = "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 150)))
        if rnd.random() < 0.6:
            q = list(p)
            for _ in range(rnd.randint(0, 5)):
                q[rnd.randrange(len(q))] = rnd.choice(["", "x", "ab"])
            t = t[:40] + "".join(q) + t[40:]
        p, t = decontaminate.normal(p), decontaminate.normal(t)
        if not p:
            continue
        assert decontaminate.myers(p, t)[0] == slow_distance(p, t)
        found, budget = decontaminate.Matcher([(1, p)], 0.05)(t), int(0.05 * len(p))
        least = slow_distance(p, t) if t else len(p)
        assert (found[0][1] if found else None) == (least if t and least <= budget else None)
        if found:
            assert slow_distance(p, t[found[0][2] : found[0][3]]) == least


def test_decontamination_in_blocks_and_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "Hello  hello hello WORLD"), (2, None), (3, ""), (4, "two three four five"), (5, "hello hello hello world")], "item_id long, text string")
    whole = [sorted(h.item_id for h in r.hits) for r in decontaminate.flag(odd, items).collect()]
    assert whole == [[], [], [], [1, 5], [1, 5], [4], [], []]
    assert [sorted(h.item_id for h in r.hits) for r in decontaminate.flag(odd, items, block_bytes=40).collect()] == whole
    assert decontaminate.flag(empty, items).count() == 0
    assert all(not r.hits for r in decontaminate.flag(odd, items.where("item_id = 3")).collect())


# ---- chat --------------------------------------------------------------------------------------------
def test_chat_round_trip(spark):
    import public_tokenizers

    rnd = random.Random(5)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", "é🎉", " ok ", "\n", "<|endoftext|>"]
    turns = {c: [(rnd.choice(["user", "assistant", "system", "<s>"]), "".join(rnd.choices(parts, k=rnd.randint(0, 6)))) for _ in range(rnd.randint(1, 5))] for c in range(40)}
    rows = [(c, i, r, t, "x") for c, ts in turns.items() for i, (r, t) in enumerate(ts)] + [(100, 0, "assistant", None, "x"), (None, 0, None, "a", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss_mask string")
    done = chat.format_conversations(chat.conversations_of(table), public_tokenizers.path(chat.VOCABULARY))
    for r in done.collect():
        want = turns.get(r.conv_id, [("assistant", "")] if r.conv_id == 100 else [("", "a")])
        assert chat.turns_in(r.formatted) == want
        assert "".join(chat.learnt_texts(r.formatted, r.token_starts, r.token_ends, r.loss_mask)) == "".join(t for k, t in want if k == "assistant")
    assert chat.conversations_of(table.limit(0)).count() == 0
    last = [r for r in chat.op9_chat_formatting(spark, FOLDER).collect() if r.conv_id == -1][0]
    text = "</s>[INST] ok [/INST]"
    assert last.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and last.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


# ---- near copies -------------------------------------------------------------------------------------
def brute_components(rows: list[tuple], words: int, percent: int) -> list[tuple]:
    sets = []
    for _, t in rows:
        k = (t or "").encode().lower().split()
        sets.append(set() if not k else {tuple(k[i : i + words]) for i in range(max(1, len(k) - words + 1))})
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80)])
def test_near_components_against_brute_force(spark, words, percent):
    rnd = random.Random(words)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rnd.choices(vocabulary, k=60)
    rows = [(0, None), (1, " "), (2, "Two words"), (3, "two  WORDS"), (4, "one")]
    for family in range(25):
        first = rnd.choices(vocabulary, k=rnd.choice([6, 20, 60, 200, 700])) + passage * (family % 2)
        for _ in range(6):
            copy = list(first)
            for _ in range(rnd.randint(0, max(1, len(copy) // 25))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, shingle_join.near_components(frame, words, percent).collect())) == brute_components(rows, words, percent)


def test_bit_sketches_bound_differences():
    rnd = np.random.default_rng(1)
    for n in (1, 40, 300, 2000, 9000):
        x = rnd.integers(0, 2**63, n, dtype=np.uint64)
        for m in (0, 1, 7, n // 5, n):
            y = np.concatenate([x[m:], rnd.integers(0, 2**63, m // 2 + 1, dtype=np.uint64)])
            a, b = shingle_join.parity_bits(x), shingle_join.parity_bits(y)
            words = min(len(a), len(b))
            differ = [int(np.bitwise_count(shingle_join.folded(a, w) ^ shingle_join.folded(b, w)).sum()) for w in (words, 16)]
            assert differ[1] <= differ[0] <= len(np.setxor1d(x, y)) and (m > n // 10 or differ[0] >= 0.7 * len(np.setxor1d(x, y)))
            for percent in (80, 85):
                both = len(np.intersect1d(x, y))
                assert 100 * both < percent * (len(x) + len(y) - both) or shingle_join.may_link(a.tobytes(), b.tobytes(), len(x), len(y), percent)


def test_near_components_of_a_group_about_the_threshold(spark):
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    first = rnd.choices(vocabulary, k=150)
    rows = []
    for _ in range(250):
        copy = list(first)
        for _ in range(rnd.choice([1, 2, 2, 3, 3, 3, 4, 4, 5, 6, 9])):
            copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
        rows.append((len(rows), " ".join(copy)))
    rows += [(300 + i, t) for i, (_, t) in enumerate(rows[:20])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(map(tuple, shingle_join.near_components(frame).collect())) == brute_components(rows, 4, 85)


def test_near_components_of_odd_rows(spark, odd, empty):
    rows = shingle_join.near_components(odd).collect()
    assert len(rows) == len(ODD) and {(r.doc_id, r.component_id) for r in rows} == {(r[0], r[0]) for r in ODD}
    assert shingle_join.near_components(empty).count() == 0
    assert shingle_join.drop_near_copies(odd).count() == len(ODD) - 1


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (5, 5)], "u long, v long")
    assert {tuple(r) for r in components.components(edges).collect()} == {(i, 0) for i in range(41)} | {(90, 90), (100, 90)}


# ---- pipeline ----------------------------------------------------------------------------------------
def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline as pipeline

    docs, columns = spark.read.parquet(f"{FOLDER}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        docs = common.stored(stage(spark, docs, FOLDER), "test")
        kept = {r.doc_id for r in docs.collect()}
        if name == "language_id":
            assert kept == {r.doc_id for r in before}
            assert {r.lang for r in docs.collect()} <= set(language.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"), F.lit(True))[0])
        elif name == "ngram_join":
            assert kept == {c for _, _, c in brute_components([(r.doc_id, r.text) for r in before], pipeline.NEAR_WORDS, pipeline.NEAR_PERCENT)}
        elif name == "decontamination":
            held = lambda t: any(slow_distance(decontaminate.normal(x), decontaminate.normal(t)) <= int(0.05 * len(decontaminate.normal(x))) for _, x in items[:4])
            assert not any(decontaminate.normal(x) in decontaminate.normal(r.text) for r in docs.collect() for _, x in items)
            assert not any(held(r.text) for r in docs.orderBy(F.length("text")).limit(4).collect())
        elif name == "source_mixing":
            assert kept < {r.doc_id for r in before}
        assert docs.columns == columns + (["slot", "shard"] if name == "sharding" else [])
    assert {r.doc_id for r in pipeline.run(spark, FOLDER).collect()} == kept


# ---- source divergence -------------------------------------------------------------------------------
def _divergence_brute(rows):
    """Plain-Python audit: every kept term of every group, f summed over all of them."""
    import re

    term = re.compile(divergence.TERM)
    docs = [((lang or ""), (source or ""), term.findall((text or "").translate(str.maketrans(common.UPPER, common.LOWER)))) for text, lang, source in rows]
    groups = sorted({(l, s) for l, s, _ in docs})
    out = []
    for lang in sorted({l for l, _ in groups}):
        df = Counter(t for l, _, ts in docs if l == lang for t in set(ts))
        kept = sorted(t for t, c in df.items() if c >= divergence.LEAST_DOCUMENTS)
        v = len(kept)
        counts = {s: Counter(t for l, s2, ts in docs if l == lang and s2 == s for t in ts) for l, s in groups if l == lang}
        lang_counts = sum(counts.values(), Counter())
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}
        p = lambda c, n: 1 + (divergence.SCALE * (c + 1)) // (n + v)
        n_lang = sum(lang_counts[t] for t in kept)
        for s in counts:
            pairs = []
            for o in counts:
                if o != s:
                    pairs.append((o, sum((p(counts[s][t], total[s]) - p(counts[o][t], total[o])) ** 2 // p(counts[o][t], total[o]) for t in kept)))
            terms = []
            for t in kept:
                a, q = p(counts[s][t], total[s]), p(lang_counts[t], n_lang)
                if counts[s][t] > 0 and a > q:
                    terms.append((t, (a - q) ** 2 // q))
            for part, items, cap in (("pair", pairs, None), ("term", terms, divergence.TOP_TERMS)):
                ranked = sorted(items, key=lambda iv: (-iv[1], iv[0].encode()))[:cap]
                out += [(lang, s, part, item, value, r + 1) for r, (item, value) in enumerate(ranked)]
    return sorted(out)


def test_divergence_equals_brute_force_on_odd_rows(spark):
    rows = [
        ("The cat sat", "en", "a"), ("the CAT ran", "en", "b"), ("cat dog cat", "en", "a"), (None, "en", "c"), ("dog the cat", None, None),
        ("cat cat cat dog the", "en", "b"), ("éclair café Cat", "fr", "x"), ("café éclair", "fr", "y"), ("café", "fr", "x"), ("x" * 5000 + " cat", "en", "a"),
        ("the cat", "en", "a"), ("the cat", "en", "a"), ("12 ab_cd ab[cd", "de", None),
    ]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit("clash")).withColumn("rank", F.lit(7))
    got = sorted(tuple(r) for r in divergence.audit(df).collect())
    assert got == _divergence_brute(rows)
    assert any(r[2] == "pair" and r[4] > 0 for r in got) and any(r[2] == "term" for r in got)


def test_divergence_edge_tables(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
    few = spark.createDataFrame([("a b", "en", "s"), ("c", "en", "t")], "text string, lang string, source string")
    assert sorted(tuple(r) for r in divergence.audit(few).collect()) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_divergence_counts_terms_once_and_shuffles_only_their_counts(spark):
    """The words of a text leave its task folded, in one shuffle that also serves everything asked by (lang, term)."""
    df = spark.createDataFrame([("a b a", "en", "s")], "text string, lang string, source string")
    plan = divergence.term_counts(df)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(shuffles) == 1 and "hashpartitioning(lang" in shuffles[0] and "source" not in shuffles[0].split("hashpartitioning")[1].split(")")[0]
    assert "Generate" not in plan


def test_divergence_folds_every_term_in_any_number_of_parts(monkeypatch):
    import re

    import pyarrow as pa

    hard = ["Ab\x00cD\x7fe", "é\x85É\xa0z İ ẞ", "日本語 テキスト🎉a", "@[`{ 0-9", "", "a a A b", "[x]_y\u2028w", "one\ttwo\ntwo"]
    rows = [(lang, source, text) for lang in ("en", "") for source in ("s", "t") for text in hard * 2]
    want_counts, want_documents, term = Counter(), Counter(), re.compile(divergence.TERM)
    for lang, source, text in rows:
        found = term.findall(text.translate(str.maketrans(common.UPPER, common.LOWER)))
        want_counts.update((lang, source, t) for t in found)
        want_documents.update((lang, source, t) for t in set(found))
    batches = [pa.RecordBatch.from_arrays([pa.array([v.encode() for v in c], pa.binary()) for c in zip(*part)], ["lang", "source", "text"]) for part in (rows[:5], rows[5:6], rows[6:])]
    for held, most in ((400_000, 50_000), (3, 2), (1, 1)):
        monkeypatch.setattr(divergence, "HELD_TERMS", held)
        monkeypatch.setattr(divergence, "BATCH_ROWS", most)
        counts, documents = Counter(), Counter()
        for batch in divergence._folded(iter(batches)):
            assert 0 < batch.num_rows <= most
            for lang, source, t, c, d in zip(*(column.to_pylist() for column in batch.columns)):
                counts[lang.decode(), source.decode(), t.decode()] += c
                documents[lang.decode(), source.decode(), t.decode()] += d
        assert counts == want_counts and documents == want_documents


def test_divergence_equals_brute_force_on_many_groups(spark):
    rng = random.Random(11)
    words = ["w" * (1 + i % 5) + chr(97 + i % 26) for i in range(60)] + ["é", "日本", "A", "b"]
    rows = [
        (" ".join(rng.choices(words, k=rng.randrange(30))) if rng.random() > 0.05 else None, rng.choice(["en", "de", None, ""]), rng.choice([*"abcdefg", "é", None, ""]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == _divergence_brute(rows)


def test_divergence_prices_and_totals_are_exact(spark):
    ends = [1, 2, 3, 7, 999_999_937, divergence.SCALE, divergence.SCALE + 1]
    pairs = [(p, q) for p in ends for q in ends]
    got = spark.createDataFrame(pairs, "p long, q long").select(divergence._f(F.col("p"), F.col("q"))).collect()
    assert [r[0] for r in got] == [(p - q) ** 2 // q for p, q in pairs]
    prices = [(10**9, 2 * 10**18 - 1), (10**9, -2 * 10**18 + 3), (3, -5), (7, 10**9), (10**9, 2 * 10**18 - 7), (1, -10**9 - 1)]
    total = spark.createDataFrame(prices, "times long, price long").agg(divergence._total(F.col("times"), F.col("price"))).first()[0]
    assert int(total) == sum(t * p for t, p in prices)


# ---- exact top-k -------------------------------------------------------------------------------------
def _top_brute(rows, k=10):
    valid = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, qv in valid:
        if qi % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(qv, cv)), ci) for ci, cv in valid if ci != qi and len(cv) == len(qv)))[:k]
        out += [(qi, r + 1, ci, -s) for r, (s, ci) in enumerate(scored)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(30)]  # a group of copies: ties go to the smaller id
    rows += [(800, None), (900, [1.0, None] + [0.0] * 6), (1000, [math.inf] + [0.0] * 7), (None, [1.0] * 8), (1100, [0.5] * 4), (200, rows[200][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = sorted(tuple(r) for r in mtree.top_k(df).collect())
    assert got == _top_brute(rows)


def test_tree_search_prunes_on_clustered_vectors():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 50
    points = np.rint(centres[rng.integers(0, 20, 5000)] + rng.normal(size=(5000, 16))).astype(np.int64)
    ids = np.arange(5000)
    pages = mtree.Pages(mtree.build(points.astype(float)), points.astype(float), ids)
    queries = points[::100].astype(float)
    scores, found, products = mtree.search_many(pages, queries, ids[::100])
    for j, q in enumerate(points[::100]):
        s = points @ q
        best = sorted((-s[i], i) for i in range(5000) if i != j * 100)[:10]
        assert [(-a, b) for a, b in best] == list(zip(scores[j].astype(int), found[j]))
    assert products < 0.5 * len(queries) * len(points)


def test_top_k_empty(spark):
    assert mtree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- whitening ---------------------------------------------------------------------------------------
def pd_isna(v) -> bool:
    return v is None or (isinstance(v, float) and math.isnan(v))


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)] + [(1000 + i, [float(x) for x in base[0]]) for i in range(50)]
    rows += [(2000, None), (2001, [math.nan] * 6), (2002, [1.0] * 3), (None, [float(x) for x in base[1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("component", F.lit("clash"))
    got = whitening.whiten(df).toPandas()
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 6 and all(math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = (fit * n - s) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-e)
    e, u = e[order], u[:, order]
    want = ((x * n - s) / n) @ u / np.sqrt(e)
    assert len(got) == len(kept) * 6 and set(got.n) == {n}
    assert got.identity_error.iloc[0] < 1e-9
    at = {i: j for j, (i, _) in enumerate(kept)}
    for c in range(6):
        part = got[got.component == c + 1]
        w = part.whitened.to_numpy()
        rows_of = [at[None if pd_isna(i) else int(i)] for i in part.vec_id]
        want_c = want[rows_of, c]
        sign = np.sign(w @ want_c)
        assert np.abs(w - sign * want_c).max() < 1e-8
        assert abs(part.explained.iloc[0] - e[c] / e.sum()) < 1e-4 * e[c] / e.sum()
    assert sorted(got[got.component == 1].deviation) == sorted(int(v) for v in ((x * n - s) ** 2).sum(axis=1))


def test_whitening_degenerate_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(10)], schema)).toPandas()
    assert set(line.component) == {1} and len(line) == 10


def test_jacobi_on_a_cholesky_factor():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(9, 5))
    c = a @ a.T  # rank 5
    g = whitening.pivoted_cholesky(c)
    assert g.shape[1] == 5 and np.allclose(g @ g.T, c)
    values, vectors = whitening.one_sided_jacobi(g)
    e = np.sort(np.linalg.eigvalsh(c))[::-1][:5]
    assert np.allclose(values, e) and np.allclose(vectors.T @ vectors, np.eye(5))


def test_dedup_of_a_memory_frame_with_a_constant_digest_checks_bytes(spark):
    """A frame that is no file scan is located once, so the byte check sees every clash of the digest."""
    rows = [(1, "a b"), (2, "ab"), (3, "x"), (4, "y y"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("file", F.lit("clash")).withColumn("at", F.lit(0))
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.deduplicate(df, digest=lambda c: F.lit("same")).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 1), 5: (5, 1)}


def test_drop_near_copies_keeps_columns_named_like_locators(spark):
    rows = [(1, "a b c d e f g", "x", 1), (2, "a b c d e f g", "y", 2), (3, "other words here", "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, file string, at long")
    got = sorted(tuple(r) for r in shingle_join.drop_near_copies(df).collect())
    assert got == [(1, "a b c d e f g", "x", 1), (3, "other words here", "z", 3)]


def test_pipeline_stages_keep_user_columns_and_edge_rows(spark):
    """Clashing names pass through unchanged; nulls, empty and very long texts, repeated rows, empty tables."""
    import corpus_pipeline as pipeline

    real = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    clash = (
        real.withColumn("score", F.lit(7.0)).withColumn("weight", F.lit(3)).withColumn("topic", F.lit("mine"))
        .withColumn("file", F.lit("f")).withColumn("at", F.lit(9)).withColumn("lang_pred", F.lit("zz")).withColumn("sampled", F.lit("no"))
    )
    odd = spark.createDataFrame(
        [(10**9, None, "en", "s", 0), (10**9 + 1, "", None, None, 0), (10**9 + 2, "word " * 50000, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long"
    )
    first = real.limit(1)
    docs = clash.unionByName(odd.withColumns({"score": F.lit(7.0), "weight": F.lit(3), "topic": F.lit("mine"), "file": F.lit("f"), "at": F.lit(9), "lang_pred": F.lit("zz"), "sampled": F.lit("no")}))
    docs = docs.unionByName(first.withColumns({"score": F.lit(7.0), "weight": F.lit(3), "topic": F.lit("mine"), "file": F.lit("f"), "at": F.lit(9), "lang_pred": F.lit("zz"), "sampled": F.lit("no")}))
    docs = common.stored(docs, "test-pipeline-odd")
    for name, stage in pipeline.STAGES:
        out = common.stored(stage(spark, docs, FOLDER), "test")
        rows = out.collect()
        mine = [c for c in docs.columns]
        assert out.columns[: len(mine)] == mine
        assert all(r.score == 7.0 and r.weight == 3 and r.topic == "mine" and r.file == "f" and r.at == 9 and r.lang_pred == "zz" and r.sampled == "no" for r in rows)
        if name == "language_id":
            assert 10**9 not in {r.doc_id for r in rows} and 10**9 + 1 not in {r.doc_id for r in rows}
        empty = stage(spark, spark.createDataFrame([], docs.schema), FOLDER)
        assert empty.count() == 0
        docs = out if name != "sharding" else docs


def test_mixing_stage_meets_the_targets_without_clipping(spark):
    """Expected tokens of the drawn rows are proportional to the raked targets: no probability passes 1."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    base = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").alias("__key"), F.col("text").alias("__text"), F.col("source").alias("__source_name"), F.col("lang").alias("__lang_name"))
    mixed = mixing.mix(base, text="__text", source="__source_name", lang="__lang_name", key="__key").toPandas()
    wanted = mixed.probability * mixed.weight
    share = wanted / max(wanted.max(), 1.0)
    assert share.max() <= 1.0
    kept = {r.doc_id for r in pipeline.mix_sources(spark, docs, FOLDER).collect()}
    drawn = {r["__row"]["doc_id"] for _, r in mixed.iterrows() if r["__row"] is not None}
    assert kept <= drawn and len(kept) > 0


def test_decontamination_of_many_copies_of_one_item(spark):
    """Sixty rows of one item text in small blocks: matched once, every id found for itself."""
    passage = "the quick brown fox jumps over the lazy dog near the river bank today"
    items = spark.createDataFrame([(i, passage) for i in range(60)] + [(100, "another passage entirely different words here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "intro " + passage + " outro"), (2, "nothing to see"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: sorted(h.item_id for h in r.hits) for r in decontaminate.flag(docs, items, block_bytes=64).collect()}
    assert got == {1: list(range(60)), 2: [], 3: []}


def test_language_id_equals_plain_naive_bayes(spark):
    """Fit and prediction recomputed with counters and loops over the same hashed n-grams (all rows in the fit)."""
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    rows += [(9001, None, "en"), (9002, "1234 !!", None), (9003, "", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, matrix, priors = language.fit(df, F.lit(True), per_language=10**9)
    labelled = [(t, l) for _, t, l in rows if t is not None and l is not None]
    assert names == sorted({l for _, l in labelled})
    counts = {n: np.zeros(language.COLUMNS) for n in names}
    for t, l in labelled:
        ids, _ = language.features([t])
        np.add.at(counts[l], ids, 1)
    logp = {n: np.log((counts[n] + language.SMOOTHING) / (counts[n] + language.SMOOTHING).sum()) for n in names}
    prior = {n: math.log(sum(1 for _, l in labelled if l == n) / len(labelled)) for n in names}
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(df, (names, matrix, priors)).collect()}
    for doc_id, t, _ in rows:
        if not t or not language.LETTER.search(t):
            assert got[doc_id] == (language.UNKNOWN, 0.0)
            continue
        ids, _ = language.features([t])
        s = [float(logp[n][ids].sum()) + prior[n] for n in names]
        best = max(range(len(names)), key=lambda i: (s[i], -i))
        posterior = 1 / sum(math.exp(x - s[best]) for x in s)
        assert got[doc_id][0] == names[best]
        assert got[doc_id][1] == pytest.approx(posterior, abs=1e-3)


def test_mixing_equals_numpy_raking(spark):
    """Expected tokens after mixing, cell by cell (source x language x topic), against plain iterative
    proportional fitting of the same token table to the same three marginals."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "lang", "text")
    mixed = mixing.mix(docs).withColumn("lang_class", F.when(F.col("lang").isin(list(mixing.LANGUAGES)), F.col("lang")).otherwise(mixing.OTHER)).toPandas()
    mixed["source"] = mixed["source"].fillna("")
    languages, topics = [*mixing.LANGUAGES, mixing.OTHER], list(mixing.TOPICS)
    sources = sorted(mixed["source"].unique())
    w = np.zeros((len(sources), len(languages), len(topics)))
    e = np.zeros_like(w)
    for r in mixed.itertuples():
        at = (sources.index(r.source), languages.index(r.lang_class), topics.index(r.topic))
        w[at] += r.n_tokens
        e[at] += r.n_tokens * r.probability * r.weight
    own = w.sum(axis=(1, 2))
    want_s = own**0.5 / (own**0.5).sum()
    want_l = mixing._targets(mixing.LANGUAGES, languages, w.sum(axis=(0, 2)))
    want_t = mixing._targets(0.7, topics, w.sum(axis=(0, 1)))
    f, g, h = np.ones(len(sources)), np.ones(len(languages)), np.ones(len(topics))
    for _ in range(2000):
        x = w * f[:, None, None] * g[None, :, None] * h[None, None, :]
        f = f * np.divide(want_s * x.sum(), x.sum(axis=(1, 2)), out=np.zeros_like(f), where=x.sum(axis=(1, 2)) > 0)
        x = w * f[:, None, None] * g[None, :, None] * h[None, None, :]
        g = g * np.divide(want_l * x.sum(), x.sum(axis=(0, 2)), out=np.zeros_like(g), where=x.sum(axis=(0, 2)) > 0)
        x = w * f[:, None, None] * g[None, :, None] * h[None, None, :]
        h = h * np.divide(want_t * x.sum(), x.sum(axis=(0, 1)), out=np.zeros_like(h), where=x.sum(axis=(0, 1)) > 0)
    x = w * f[:, None, None] * g[None, :, None] * h[None, None, :]
    assert np.allclose(e / e.sum(), x / x.sum(), atol=2e-4)
    assert np.allclose((e / e.sum()).sum(axis=(0, 1)), want_t, atol=2e-4)


def test_language_model_reads_a_missing_remote_shard_as_empty():
    """On a shared folder that is no local path, a shard without entries has no file and reads as empty."""
    import os

    path = language_model._local("mock:///models/empty-shard", "pairs-000007")
    assert not os.path.exists(path)
