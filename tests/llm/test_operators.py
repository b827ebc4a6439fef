"""Operators against brute force, over awkward rows."""

from __future__ import annotations

import hashlib
import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scanledger.llm import (
    bpe, components, exact, language, line_dedup, mixing, pretokens, quality_rules, queries, repeats, simhash,
    token_files, url_rules,
)
from tests.helpers import plan_of
from tests.llm.cases import CLASHES, SCHEMA, awkward_rows, long_text, table, words

ROWS = awkward_rows()
SPACE = " \t\n\x0b\x0c\r"


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def found(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def same(rows):
    return sorted(rows, key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.fit_rules(docs, labels) == []
    model = language.fit_languages(docs)
    results = (
        quality_rules.judge_quality(docs, []), mixing.mix_sources(docs), simhash.near_groups(docs),
        repeats.remove_repeats(docs), line_dedup.drop_repeated_lines(docs, 1 << 12),
        language.predict_languages(docs, model), token_files.token_files(docs), exact.exact_groups(docs),
        bpe.encode_and_decode(docs), url_rules.judge_urls(spark.createDataFrame([], "page_id long, url string")),
    )
    assert [r.count() for r in results] == [0] * len(results)


# --- quality rules ---------------------------------------------------------------------------


def slow_statistics(text):
    text = text or ""
    tokens = regex.findall(rf"[^{SPACE}]+", text)
    windows = [tuple(tokens[k : k + 3]) for k in range(len(tokens) - 2)]
    seen, repeated = Counter(windows), set()
    for k, window in enumerate(windows):
        if seen[window] > 1:
            repeated |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (
        len(tokens), sum(map(len, tokens)), len(regex.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:k] for k, x in enumerate(lines)), len(repeated),
    )


def test_quality_statistics(spark):
    judged = quality_rules.judge_quality(table(spark, ROWS, True), [])
    names = [f"stats.{c}" for c in quality_rules.COUNTS]
    expected = []
    for doc_id, text, *_ in ROWS:
        s = slow_statistics(text)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        expected.append((doc_id, *s, failed, not failed))
    assert found(judged, "doc_id", *names, "base_failed", "kept") == same(expected)
    assert judged.filter("copy = 'own' AND score = 'own'").count() == len(ROWS)


def test_decision_list_finds_planted_rules(spark):
    """Junk of two kinds; only documents of every other id are labelled."""
    rows = []
    for k in range(400):
        text = words(k, 80)
        if k % 10 == 1:
            text = text.replace(" ", " ### ")
        if k % 10 == 2:
            text = text.upper()
        rows.append((k, text, None, None, None))
    labels = [(k, 0 if k % 10 in (1, 2) else 1, 0) for k in range(400) if k % 3]
    labels += [(3, None, 1), (None, 0, 0), (1, 1, 0)]
    docs = table(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = quality_rules.fit_rules(docs, marks)
    judged = quality_rules.judge_quality(docs, rules)
    assert found(judged.filter("not kept"), "doc_id") == same((k,) for k in range(400) if k % 10 in (1, 2))
    assert 2 <= len(rules) <= 4 and all(1 <= len(r.conditions) <= 4 for r in rules)
    assert {r["rule"] for r in judged.select("rule").distinct().collect()} <= {None, *range(1, len(rules) + 1)}


def test_rules_do_not_learn_noise():
    rng = np.random.default_rng(1)
    table_ = rng.random((600, len(quality_rules.RATES)))
    assert quality_rules.learn_rules(table_, rng.random(600) < 0.2) == []
    assert quality_rules.learn_rules(table_, np.zeros(600, bool)) == []
    assert quality_rules.learn_rules(table_[:0], np.zeros(0, bool)) == []


# --- mixing ----------------------------------------------------------------------------------


def draw_name(doc_id, text):
    return f"null|{hashlib.md5((text or '').encode()).hexdigest()}" if doc_id is None else doc_id


def slow_draw(doc_id, mean, seed=mixing.SEED):
    digits = hashlib.md5(f"{seed}|1|{doc_id}".encode()).hexdigest()[:13]
    number, drawn, p = int(digits, 16) / 2**52, 0, math.exp(-mean)
    total = p
    while number >= total and drawn < 500:
        drawn += 1
        p = p * mean / drawn
        total += p
    return drawn


def test_mixing_draws_by_inversion(spark):
    rows = [*ROWS, (None, "no id", None, "hot", 1)]
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(text or "")
    weights = {"hot": 1.0, None: 3.0, "unseen": 2.0}
    mixed = mixing.mix_sources(table(spark, rows, True), weights, size=2.0)
    expected = []
    for doc_id, text, _, source, _ in rows:
        rate = weights.get(source, 0.0) / 4 * sum(sizes.values()) * 2 / sizes[source]
        expected += [(doc_id, source, k + 1) for k in range(slow_draw(draw_name(doc_id, text), rate))]
    assert found(mixed, "doc_id", "source", "copy") == same(expected)
    assert mixed.filter("salt = 'own' and rate = 'own'").count() == len(expected)


def test_rows_without_an_id_are_drawn_and_dealt_singly(spark):
    rows = [(i, f"text {k}", None, "large", 1) for i in (None, 7) for k in range(3000)]
    rows += [(k, "x" * 40, None, "small", 1) for k in range(100)]
    docs = table(spark, rows)
    mixed = mixing.mix_sources(docs, {"large": 1.0}, size=0.5)
    unnamed = mixed.filter("doc_id IS NULL").groupBy("text").count().agg({"text": "count"}).first()[0]
    # Poisson numbers of mean one half: four in ten rows are drawn, not all or none
    assert 0.3 * 3000 < unnamed < 0.5 * 3000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = mixing.mix_sources(docs, {"large": 1.0})
        tasks = dealt.groupBy("doc_id", F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.doc_id is None for r in tasks) > 1


def test_mixing_without_anything_to_mix(spark):
    empty = table(spark, [(k, ["", None][k % 2], None, "a", 0) for k in range(200)])
    assert 120 < mixing.mix_sources(empty).count() < 280
    assert mixing.mix_sources(table(spark, ROWS), {"unseen": 1.0}).count() == 0


def test_mixing_reaches_target_shares_and_large_rates(spark):
    docs = spark.range(4000).selectExpr(
        "id AS doc_id", "repeat('x', 10) AS text", "if(id % 100 = 0, 'small', 'large') AS source"
    )
    counts = dict(found(mixing.mix_sources(docs, {"small": 1.0, "large": 1.0}).groupBy("source").count(), "source", "count"))
    assert abs(counts["small"] - 2000) < 200 and abs(counts["large"] - 2000) < 200
    drawn = mixing.mix_sources(docs.filter("source = 'small'").limit(3), {"small": 1.0}, size=1500.0)
    assert 4000 < drawn.count() < 5000


# --- SimHash ---------------------------------------------------------------------------------


def slow_fingerprint(text):
    tokens = [t.translate(str.maketrans(mixing_upper(), mixing_upper().lower())) for t in regex.findall(rf"[^{SPACE}]+", text or "")]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[k : k + 3]) for k in range(max(1, len(tokens) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def mixing_upper():
    return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def slow_components(prints):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_near_groups(spark):
    prints = {doc_id: slow_fingerprint(text) for doc_id, text, *_ in ROWS}
    roots = slow_components(prints)
    expected = same((i, f"{prints[i]:016x}", roots[i]) for i, *_ in ROWS)
    assert found(simhash.near_groups(table(spark, ROWS, True)), "doc_id", "fingerprint", "component_id") == expected


@pytest.mark.parametrize("block_pairs", [1, 3, 64])
def test_links_of_crowded_fingerprints(spark, block_pairs):
    """Chains and balls of fingerprints, by pairs and by meeting neighbours."""
    rng = np.random.default_rng(3)
    prints = [int(x) for x in rng.integers(0, 2**63, 40)]
    for _ in range(160):
        base = prints[int(rng.integers(0, len(prints)))]
        for bit in rng.choice(64, int(rng.integers(1, 4)), replace=False):
            base ^= 1 << int(bit)
        prints.append(base)
    prints = sorted(set(prints))
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), block_pairs)
    pairs = [(r.a % 2**64, r.b % 2**64) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    roots = components.connected_components(edges).collect()
    got = defaultdict(set)
    for r in roots:
        got[r.root].add(r.node % 2**64)
    want = defaultdict(set)
    for p, root in slow_components({p: p for p in prints}).items():
        want[root].add(p)
    assert same(map(sorted, got.values())) == same(sorted(v) for v in want.values() if len(v) > 1)


def test_table_discards_by_coordinates(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(a) ^ int(m)) for a, m in zip(rng.integers(-2**62, 2**62, 300), rng.integers(0, 2**20, 300), strict=True)]
    pairs += [(a, a ^ 1 << int(b)) for (a, _), b in zip(pairs, rng.integers(0, 60, 300), strict=True)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    one = frame.select("a", "b", *(c.alias(f"x{k}") for k, c in enumerate(simhash.distance_table(F.col("a")))),
                       *(c.alias(f"y{k}") for k, c in enumerate(simhash.distance_table(F.col("b")))))
    kept = one.select("a", "b", *(simhash.within_table(F.col(f"x{k}"), F.col(f"y{k}")).alias(f"ok{k}") for k in (0, 1)))
    for a, b, *oks in kept.collect():
        for k, ok in enumerate(oks):
            refs = simhash.pivots()[7 * k : 7 * k + 7]
            gaps = [abs(((a % 2**64) ^ r).bit_count() - ((b % 2**64) ^ r).bit_count()) for r in refs]
            assert ok == (max(gaps) <= 2)


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(300)] + [(7, 7), (None, 3), (1000, 1001), (1001, 1000)]
    roots = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert found(roots, "node", "root") == same([(k, 0) for k in range(301)] + [(1000, 1000), (1001, 1000)])


# --- repeats ---------------------------------------------------------------------------------


def slow_repeats(rows):
    texts = [(doc_id, (text or "").encode()) for doc_id, text, *_ in rows]
    seen = Counter(t[k : k + 400] for _, t in texts for k in range(len(t) - 399))
    for doc_id, text in texts:
        covered = np.zeros(len(text), bool)
        for k in range(len(text) - 399):
            if seen[text[k : k + 400]] > 1:
                covered[k : k + 400] = True
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
        yield doc_id, len(text), int(covered.sum()), runs, sha(kept)


REPEAT_ROWS = [
    *ROWS,
    *((500 + k, f"{words(40 + k, 30)} {words(7, 120)[k * 9 : 460 + k * 7]} {words(60 + k, 20)}", None, None, None) for k in range(12)),
    (600, words(80, 70)[:399], None, None, None), (601, words(80, 70)[:399], None, None, None),
    (602, words(81, 80)[:400], None, None, None), (603, "z" + words(81, 80)[:400], None, None, None),
]


@pytest.mark.parametrize("crowd", [1, 3, repeats.CROWD])
def test_repeats(spark, crowd):
    cut = repeats.remove_repeats(table(spark, REPEAT_ROWS, True), crowd)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    expected = same(slow_repeats(REPEAT_ROWS))
    assert found(cut, *columns) == expected
    assert sum(r[2] > 0 for r in expected) > 15
    assert cut.filter("sha2(kept, 256) <> kept_sha256 or size(spans) <> n_spans").count() == 0


def test_repeats_of_rows_that_a_checksum_confuses(spark):
    one, two = colliding_texts()
    rows = [(None, one, None, None, None), (None, two, None, None, None), (4, f"new {one[:450]}", None, None, None)]
    rows += [(9, one[:300] + two[-200:], None, None, None), (9, two, None, None, None)]
    for some in (rows, rows[:3], [rows[1], rows[3], (None, "x" * 390 + one, None, None, None)]):
        cut = repeats.remove_repeats(table(spark, some))
        assert found(cut, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == same(slow_repeats(some))


@pytest.mark.parametrize("split", [0, repeats.SPLIT_GRAM])
def test_groups_hold_all_occurrences(spark, split):
    docs = table(spark, REPEAT_ROWS, True)
    rows = repeats.repeat_groups(docs, split).collect()
    texts = {xxhash.xxh3_128_digest((t or "").encode()): (t or "").encode() for _, t, *_ in REPEAT_ROWS}
    groups = defaultdict(set)
    for r in rows:
        text = texts[bytes(r.check)]
        string = text[r.start : r.start + r.length]
        assert len(string) == r.length >= 400 and xxhash.xxh3_128_digest(string) == bytes(r.group)
        groups[string].add((r.doc_id, bytes(r.check), r.start))
    # every place of the string in any row, and nothing else
    everywhere = {(i, xxhash.xxh3_128_digest((t or "").encode())): (t or "").encode() for i, t, *_ in REPEAT_ROWS}
    for string, occurrences in groups.items():
        expected = {
            (i, check, k) for (i, check), text in everywhere.items()
            for k in range(len(text) - len(string) + 1) if text.startswith(string, k)
        }
        assert occurrences == expected
    # the groups cover exactly what is removed
    spans = defaultdict(list)
    for r in rows:
        spans[r.doc_id, bytes(r.check)].append((r.start, r.start + r.length))
    covered = Counter()
    for (doc_id, check), own in spans.items():
        times = sum((i, xxhash.xxh3_128_digest((t or "").encode())) == (doc_id, check) for i, t, *_ in REPEAT_ROWS)
        covered[doc_id] += times * sum(b - a for a, b in repeats.merged_spans(own))
    removed = Counter()
    for doc_id, _, n_removed, *_ in slow_repeats(REPEAT_ROWS):
        removed[doc_id] += n_removed
    assert +covered == +removed


def test_classes_reach_as_far_as_reach():
    rng = np.random.default_rng(8)
    for _ in range(60):
        stem_left, stem_right = (rng.integers(97, 99, 336).astype(np.uint8).tobytes() for _ in range(2))
        pairs = set()
        for _ in range(rng.integers(2, 12)):
            a, b = rng.integers(0, 337, 2)
            left = stem_left[:a] + rng.integers(97, 99, 336 - a).astype(np.uint8).tobytes()
            pairs.add((stem_right[:b] + rng.integers(97, 99, 400 - b).astype(np.uint8).tobytes(), left))
        rights, lefts = map(list, zip(*sorted(pairs), strict=True))
        far = [None] * len(rights)
        for before, after, members in repeats.repeat_classes(lefts, rights):
            assert len(members) > 1 and len({rights[k][:after] for k in members}) == 1
            assert len({lefts[k][:before] for k in members}) == 1
            assert len({rights[k][after : after + 1] for k in members}) > 1 or after == 400
            assert len({lefts[k][before : before + 1] for k in members}) > 1 or before == 336
            for k in members:
                most = far[k] or (0, 0)
                far[k] = (max(most[0], before), max(most[1], after))
        assert far == repeats.reach(lefts, rights)


def test_anchors_cover_every_string(monkeypatch):
    text = (words(5, 400) + "ab" * 600 + words(5, 100)).encode()
    whole = repeats.anchors(text)
    monkeypatch.setattr(repeats, "_CHUNK", 500)
    for found_ in (whole, repeats.anchors(text)):
        starts = [s for _, at, first, last in found_.T for s in range(first, last + 1) if first <= at]
        assert sorted(starts) == list(range(len(text) - 399))
    # the anchor of a string follows from its bytes alone
    by_string = {}
    for _, at, first, last in whole.T:
        for s in range(first, last + 1):
            assert by_string.setdefault(text[s : s + 400], at - s) == at - s


def test_prefix_intervals():
    entries = sorted([b"banana", b"band", b"bank", b"can", b"cane", b"cane", b"d"])
    lengths = [0, *(repeats.common_prefix(a, b) for a, b in zip(entries, entries[1:], strict=False))]
    got = {(n, tuple(entries[a : b + 1])) for n, a, b in repeats.prefix_intervals(lengths)}
    assert got == {
        (3, (b"banana", b"band", b"bank")), (3, (b"can", b"cane", b"cane")), (4, (b"cane", b"cane")),
    }


# --- lines -----------------------------------------------------------------------------------


def slow_lines(rows):
    def key(line):
        stripped = line.strip(SPACE)
        return "".join(c.lower() if c in mixing_upper() else c for c in stripped)

    holders = defaultdict(list)
    for doc_id, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(doc_id)
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == doc_id
        ]
        yield doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))


@pytest.mark.parametrize("bits", [8, 1 << 16])
def test_lines(spark, bits):
    """Also with filters that are full: more is shuffled, the result stays."""
    cleaned = line_dedup.drop_repeated_lines(table(spark, ROWS, True), bits)
    cleaned = cleaned.withColumn("kept_sha256", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256))
    assert found(cleaned, "doc_id", "n_lines", "n_dropped", "kept_sha256") == same(slow_lines(ROWS))
    assert cleaned.filter("lost = 'own'").count() == len(ROWS)
    assert cleaned.filter("text is null").count() == 2


def test_filters_hold_back_single_lines(spark):
    rows = [(k, f"{words(k, 12)}\nA line in every one of the documents", None, None, None) for k in range(60)]
    suspects = line_dedup.suspected_keys(table(spark, rows), 1 << 18)
    assert found(suspects.select("line_key").distinct(), "line_key") == [(bytearray(b"a line in every one of the documents"),)]
    assert suspects.count() == 60


# --- language --------------------------------------------------------------------------------


def test_language(spark):
    lexicons = {lang: words(seed, 3000).split() for lang, seed in (("aa", 21), ("bb", 22), ("cc", 23))}
    rng = np.random.default_rng(2)
    rows = [
        (k, " ".join(rng.choice(lexicons[lang], 40)), lang, None, None)
        for k, lang in enumerate(["aa", "bb", "cc"] * 120)
    ]
    docs = table(spark, rows)
    model = language.fit_languages(docs)
    assert sorted(set(model.languages)) == ["aa", "bb", "cc"] and len(model.languages) > 3
    hidden = docs.selectExpr("doc_id", "text", "lang AS truth", "'cc' AS lang")
    guessed = language.predict_languages(hidden, model).join(docs, "doc_id").filter("held_out")
    assert found(guessed, "doc_id", "held_out")[:1] and guessed.filter("lang_pred = lang").count() > 0.9 * guessed.count()
    assert {r.doc_id for r in guessed.collect()} == {k for k, *_ in rows if zlib.crc32(str(k).encode()) % 5 == 0}

    awkward = found(language.predict_languages(table(spark, ROWS, True), model), "doc_id", "held_out", "lang_pred", "score", "rejected")
    assert len(awkward) == len(ROWS)
    texts = {doc_id: text for doc_id, text, *_ in ROWS}
    for doc_id, _, lang, score, rejected in awkward:
        if any(c.isalpha() for c in texts[doc_id] or ""):
            assert lang in model.languages and 0 <= score <= 1
        else:
            assert (lang, score, rejected) == ("und", 0.0, True)


def slow_ngrams(text):
    """N-grams of letters and word marks, hashed one by one."""
    multipliers, low = [int(m) for m in language._MULTIPLIERS], (1 << 64) - 1
    symbols = [0]
    for c in (text or "").lower():
        if c.isalpha():
            symbols.append(ord(c))
        elif symbols[-1]:
            symbols.append(0)
    if symbols[-1]:
        symbols.append(0)
    counts = Counter()
    for size in (1, 2, 3):
        for k in range(len(symbols) - size + 1):
            gram = symbols[k : k + size]
            # a mark alone is no gram, nor is a three-gram around a mark
            if (size == 1 and not gram[0]) or (size == 2 and not any(gram)) or (size == 3 and not gram[1]):
                continue
            mixed = size
            for m, symbol in zip(multipliers, gram, strict=False):
                mixed = (mixed ^ symbol) * m & low
                mixed ^= mixed >> 29
            counts[(mixed * multipliers[0] & low) >> 40 & language.PLACES - 1] += 1
    return counts


def slow_vector(counts, idf):
    row = {place: math.sqrt(n) * idf[place] for place, n in counts.items()}
    length = math.sqrt(sum(x * x for x in row.values()))
    return {place: x / length for place, x in row.items()}


def slow_kmeans(rows):
    def dense(row):
        return [row.get(p, 0.0) for p in range(language.PLACES)]

    def dot(row, centroid):
        return sum(x * centroid[p] for p, x in row.items())

    def mean(some):
        total = [0.0] * language.PLACES
        for row in some:
            for p, x in row.items():
                total[p] += x / len(some)
        return total

    seeds = [mean(rows)]
    nearest = [dot(r, seeds[0]) for r in rows]
    for _ in range(min(language.CENTROIDS, len(rows)) - 1):
        seeds.append(dense(rows[nearest.index(min(nearest))]))
        nearest = [max(n, dot(r, seeds[-1])) for n, r in zip(nearest, rows, strict=True)]
    centroids = seeds
    for _ in range(language.ROUNDS):
        parts = defaultdict(list)
        for row in rows:
            near = [dot(row, c) for c in centroids]
            parts[near.index(max(near))].append(row)
        centroids = []
        for k in sorted(parts):
            total = mean(parts[k])
            length = math.sqrt(sum(x * x for x in total))
            centroids.append([x / length for x in total])
    return centroids


def test_language_against_a_slow_recount(spark):
    """Counts, IDF over all training texts, centroids, prediction and score, each by plain loops."""
    lexicons = {lang: words(seed, 400).split() for lang, seed in (("aa", 21), ("bb", 22))}
    rng = np.random.default_rng(7)
    rows = [
        (k, " ".join(rng.choice(lexicons[lang], 15)) + ("É l’eau, 12x" if k % 9 == 0 else ""), lang, None, None)
        for k, lang in enumerate(["aa", "bb"] * 40)
    ]
    rows += [(500 + k, t, None, None, None) for k, t in enumerate([None, "", "12 !", "ß", "x " * 50])]
    learned = [r for r in rows if r[2] and zlib.crc32(str(r[0]).encode()) % 5]
    training = {r[0]: slow_ngrams(r[1]) for r in learned}
    texts_with = Counter(p for counts in training.values() for p in counts)
    idf = [math.log((1 + len(training)) / (1 + texts_with[p])) + 1 for p in range(language.PLACES)]
    model = language.fit_languages(table(spark, rows))
    assert np.allclose(model.idf, idf)
    centroids = []
    for lang in ("aa", "bb"):
        own = [slow_vector(training[r[0]], idf) for r in sorted(learned) if r[2] == lang]
        centroids += [(lang, c) for c in slow_kmeans(own)]
    centroids.sort()
    assert model.languages == [lang for lang, _ in centroids]
    assert np.allclose(model.centroids, [c for _, c in centroids], atol=1e-4)
    for r in language.predict_languages(table(spark, rows), model).collect():
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        counts = slow_ngrams(text)
        if not counts:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        vector = slow_vector(counts, idf)
        near = [(sum(x * c[p] for p, x in vector.items()), lang) for lang, c in centroids]
        best = max(near, key=lambda n: n[0])
        assert abs(r.score - best[0]) < 1e-4
        if best[0] - max(n for n, lang in near if lang != best[1]) > 1e-4:
            assert r.lang_pred == best[1]


def test_about_as_many_unseen_texts_are_rejected_as_planned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    hidden = language.predict_languages(docs, language.fit_languages(docs)).filter("held_out AND lang_pred <> 'und'")
    share = hidden.agg(F.avg(F.col("rejected").cast("int"))).first()[0]
    assert share <= 4 * language.OUTLIERS


def test_ngrams_of_pieces(monkeypatch):
    text = words(3, 500) + " É1à. ßü " * 30
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "_CHUNK", 11)
    assert (language.ngram_counts(text) == whole).all()
    assert language.ngram_counts("12 .") is None and language.ngram_counts(None) is None


# --- tokens ----------------------------------------------------------------------------------


def test_token_files(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    tokenizer.encode_special_tokens = True
    expected, start = [], 0
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: r[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = found(token_files.token_files(table(spark, ROWS, True)), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == same(expected)


def test_token_files_query_gives_added_tokens_their_ids(spark, tmp_path):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "<|endoftext|", "it's <|endoftext|>'s 7", "été<|endoftext|>漢字\n"]
    rows = [*ROWS, *((2000 + k, t, None, None, None) for k, t in enumerate(texts))]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    expected, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = found(queries.op7_token_files(spark, str(tmp_path)), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == same(expected)


def test_token_files_of_several_segments(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", 50)
    docs = table(spark, [(k, words(k, k % 40), None, None, None) for k in range(80)] + [(None, "x y", None, None, None)])
    got = sorted(token_files.token_files(docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *range(80)]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))


def test_levels_give_single_tokens():
    rng = np.random.default_rng(4)
    for ids in (rng.integers(0, 256, 700), rng.integers(0, 50257, 3000), rng.integers(0, 2**31, 1500), np.array([0]), np.array([70000] * 600)):
        levels = token_files.encode_levels(ids)
        assert (token_files.decode_levels(levels) == ids).all()
        assert all(token_files.token_at(levels, k) == ids[k] for k in range(len(ids)))
    assert len(token_files.decode_levels(token_files.encode_levels(np.array([], int)))) == 0


@pytest.mark.parametrize("block_chars", [1, 3000, bpe.BLOCK_CHARS])
def test_bpe(spark, block_chars):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.VOCABULARY), special_tokens={}
    )
    rows = [*ROWS, (None, words(1, 200), None, None, None), (0, words(2, 60), None, None, None)]
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), ids, sha(",".join(map(str, ids))), sha(text or "")))
    encoded = bpe.encode_and_decode(table(spark, rows, True), block_chars=block_chars)
    fields = (f"encoded.{c}" for c in ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))
    assert found(encoded, "doc_id", *fields) == same(expected)
    assert set(CLASHES) <= set(encoded.columns)


def test_bpe_of_words_with_very_many_ids(spark):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.VOCABULARY), special_tokens={}
    )
    rows = []
    for k, word in enumerate(["\0" * 100_000, "\U0001f642" * 40_000, "\0" * 255, "\0" * 254, "\0" * 65_536]):
        rows.append((k, f"{words(k, 30)} {word}\n{words(k + 50, 30)} {word}! {words(k + 90, 9)}", None, None, None))
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text)
        expected.append((doc_id, len(ids), ids, sha(",".join(map(str, ids))), sha(text)))
    assert max(len(library.encode_ordinary(w)) for w in pretokens.split_words(rows[1][1])) > 65_535
    encoded = bpe.encode_and_decode(table(spark, rows))
    fields = (f"encoded.{c}" for c in ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))
    assert found(encoded, "doc_id", *fields) == same(expected)


def colliding_texts() -> tuple[str, str]:
    """Two texts with the same crc32, so that no 32-bit checksum tells them apart."""
    seen: dict[int, str] = {}
    before, after = words(1, 60), words(2, 60)
    for k in range(1 << 20):
        text = f"{before} {k * 2654435761 % (1 << 32):x} {after}"
        check = zlib.crc32(text.encode())
        if check in seen:
            return seen[check], text
        seen[check] = text
    raise AssertionError("no collision")


def test_bpe_of_rows_that_a_checksum_confuses(spark):
    one, two = colliding_texts()
    rows = [(i, t, "en", "hot", 1) for i in (None, 7) for t in (one, two, one)]
    encoded = bpe.encode_and_decode(table(spark, rows), with_ids=False, block_chars=1000)
    assert found(encoded, "doc_id", "encoded.decoded_sha256") == same((i, sha(t)) for i, t, *_ in rows)


def test_every_distinct_word_is_shuffled_and_encoded_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    places = bpe.word_places(bpe.text_blocks(docs, 200_000))
    expected = {w for r in docs.collect() for w in pretokens.split_words(r.text or "")}
    encoded = bpe.encoded_words(places).collect()
    # a word is parted where an Arrow batch ends, at most once in a batch
    assert {r.word for r in encoded} == expected and len(encoded) <= 1.01 * len(expected)
    assert sum(len(r.places) for r in encoded) == places.count()
    # a word is a row per block, however often it occurs
    per_block = places.groupBy("word", F.shiftright("at", 32)).count()
    assert per_block.filter("count > 1").count() == 0


def test_blocks_are_shuffled_once_and_read_twice(spark):
    docs = table(spark, ROWS)
    plan = bpe.encode_and_decode(docs, with_ids=False)
    plan.collect()
    assert "ReusedExchange" in plan_of(plan)


def test_a_block_holds_its_words_once():
    texts = [" ".join(f"word{k % 50}" for k in range(n, n + 1_000)) for n in range(300)]
    tracemalloc.start()
    held, split = bpe._numbered(iter(texts))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 300,000 strings would be some 18 MB
    assert most < 5e6
    assert held == sorted({w for t in texts for w in pretokens.split_words(t)})
    assert ["".join(map(held.__getitem__, s.tolist())) for s in split] == texts
    assert bpe._numbered(iter([])) == ([], [])
    held, split = bpe._numbered(iter(["", "a"]))
    assert held == ["a"] and [s.tolist() for s in split] == [[], [0]]


def test_bytes_that_are_not_the_word():
    words = ["a", "\xe9", "xyz"]
    letters, sizes = bpe._other_bytes(words, [b"a", b"\xc3", b"\xa9", b"x", b"?"], [0, 1, 3])
    assert letters.tobytes() == b"x?" and sizes.tolist() == [0, 0, 3]
    arrays = [np.array([0, 1, 1]), np.array([1, 2, 2]), sizes, np.array([5, 6, 7, 70_000, 9]), letters]
    block = bpe._Block([bpe.pack_arrays(*arrays)], words)
    assert block.bytes == [b"a", b"\xc3\xa9", b"x?"] and block.listed == ["5", "6,7", "70000,9"]
    with pytest.raises(ValueError, match="missing"):
        bpe._Block([bpe.pack_arrays(*arrays)], [*words, "more"])


def test_split_words_at_every_character():
    """Each code point beside letters, digits and spaces is cut as by the public pattern."""
    pattern = regex.compile(public_tokenizers.PATTERN)
    control = set(range(0x1C, 0x20))  # the two libraries differ about these; see below
    for at in range(0, 0x110000, 64):
        points = [c for c in range(at, at + 64) if not 0xD800 <= c < 0xE000 and c not in control]
        text = " ".join(f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)} {chr(c)}" for c in points)
        assert pretokens.split_words(text) == pattern.findall(text), hex(at)


def test_split_words():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for _, text, *_ in ROWS:
        assert "".join(pretokens.split_words(text or "")) == (text or "")
        if text and not set(text) & set("\x1c\x1d\x1e\x1f"):
            assert pretokens.split_words(text) == pattern.findall(text)


# --- exact copies ----------------------------------------------------------------------------


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact(spark, counters):
    rows = [*ROWS, *((1000 + k, "the hot text", None, None, None) for k in range(40))]
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    expected = [
        (d, max(groups[t or ""]), len(groups[t or ""]), d == max(groups[t or ""]), sha(t or "")) for d, t, *_ in rows
    ]
    got = exact.exact_groups(table(spark, rows, True), counters)
    assert found(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == same(expected)


def test_misra_gries_keeps_frequent_items():
    summary = exact.MisraGries(9)
    stream = ["hot"] * 300 + [f"x{k}" for k in range(900)]
    np.random.default_rng(0).shuffle(stream)
    for at in range(0, len(stream), 50):
        summary.add(stream[at : at + 50])
    assert len(summary.held) <= 9 and 300 - 120 <= summary.held["hot"] <= 300


# --- URLs ------------------------------------------------------------------------------------


def slow_verdict(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = regex.match(r"[^/?#]*", rest)[0]
    path = regex.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(str.maketrans(mixing_upper(), mixing_upper().lower()))
    fits = [
        (len(h + p), h + p, verdict)
        for h, p, verdict in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]

    def names(listed):
        return any(regex.search(rf"(^|[.-]){regex.escape(w)}($|[.-])", host) for w in listed)

    blocked = names(url_rules.BLOCKED_HOST_WORDS) and not names(url_rules.ALLOWED_HOST_WORDS)
    return host, path, None, "block" if blocked else "allow"


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "https://a.NET", "https://a.NET/", "http://example.net/en/1", "http://x.example.net/EN/1",
        "http://example.net/english", "http://notexample.com/de/1", "http://m.example.com/de/", "http://example.com/de",
        "http://a.org/fr/1?x=/", "http://fr.org/?/fr/", "ftp://ads.a.org/x", "http://a-ads.b.org", "http://roads.b.org/ads/",
        "http://spam-farm.x.com/", "http://x.adult.health.org/", "http://link-farm.co/#://b.net/", "a://b://c.net/", "http://EXAMPLE.org/fr/ü\n2",
    ]
    rows = [(k, u) for k, u in enumerate(urls)] + [(3, "http://x.net/en"), (3, "http://x.net/en"), (None, "http://q.net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'own' AS host", "'own' AS target")
    expected = [(p, *slow_verdict(u)) for p, u in rows]
    assert found(url_rules.judge_urls(pages), "page_id", "host", "path", "rule", "verdict") == same(expected)


def test_rules_are_indexed_by_their_rarest_token(spark):
    targets = spark.createDataFrame([("a.spam.org/x",), ("b.farm.org/x",), ("c.farm.org/y",)], "target string")
    rules = (url_rules.host_word_rule("block", "spam-farm"), url_rules.scope_rule("allow", "org/x"), url_rules.UrlRule("any", "block", "zz", ()))
    index = url_rules.rule_index(url_rules.rule_table(spark, rules), url_rules.url_tokens(targets))
    assert found(index, "rule", "token") == [("any", ""), ("host word spam-farm", "spam"), ("org/x", "org")]


def test_thousands_of_rules_from_a_table(spark):
    """Patterns over host and path; each URL runs the few that its tokens fetch."""
    rng = np.random.default_rng(6)
    hosts = [f"{'www.' if k % 3 else ''}site{k}.example{k % 50}.net" for k in range(600)]
    pages = [(k, f"http://{hosts[rng.integers(600)]}/a{rng.integers(40)}/b{rng.integers(40)}.html?q=1") for k in range(1500)]
    pages += [(9000, None), (9001, ""), (9002, "http://" + "x." * 20_000 + "site5.example5.net/a1/"), (9002, "no url")]
    rules = []
    for k in range(4000):
        if k % 4 == 0:
            rules.append(url_rules.scope_rule(("allow", "block")[k // 4 % 2], f"{hosts[k % 600].removeprefix('www.')}/a{k % 37}/"))
        elif k % 4 == 1:
            rules.append(url_rules.host_word_rule("block", f"example{k % 90}"))
        elif k % 4 == 2:
            rules.append(url_rules.UrlRule(f"path {k}", ("block", "allow")[k % 7 == 0], rf"/a{k % 50}/b{k % 61}\.", (f"a{k % 50}", f"b{k % 61}")))
        else:
            rules.append(url_rules.UrlRule(f"odd {k}", "block", rf"\Asite{k}\.[^/]*/a[0-9]/", (f"site{k}",)))
    rules = list({r.rule: r for r in rules}.values())
    compiled = [(r, regex.compile(r.pattern.replace(r"\z", r"\Z"))) for r in rules]

    def slow(url):
        parts = regex.match(r"(?s)\A.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (parts[1].encode().lower().decode(), parts[2]) if parts else ("", "")
        fitting = [r for r, p in compiled if p.search(host + path)]
        scoped = max((r for r in fitting if r.scoped), key=lambda r: (len(r.rule), r.rule), default=None)
        if scoped:
            return host, path, scoped.rule, scoped.verdict
        verdicts = {r.verdict for r in fitting}
        return host, path, None, "block" if verdicts == {"block"} else "allow"

    expected = same((i, *slow(url)) for i, url in pages)
    listed = url_rules.rule_table(spark, tuple(rules))
    judged = url_rules.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), listed)
    assert found(judged, "page_id", "host", "path", "rule", "verdict") == expected
    assert len({r[3] for r in expected}) > 50 and {r[4] for r in expected} == {"allow", "block"}


# --- long texts ------------------------------------------------------------------------------


def test_a_very_long_text(spark):
    text = long_text()
    rows = [(1, text, "en", "a", 1), (2, text, "en", "a", 1), (3, "x " + text[:5000], "en", "a", 1)]
    docs = table(spark, rows)
    cut = {r.doc_id: r for r in repeats.remove_repeats(docs, with_bytes=False).collect()}
    assert cut[1].n_removed == cut[2].n_removed == len(text.encode()) and cut[3].n_removed == 5000
    encoded = found(bpe.encode_and_decode(docs, with_ids=False), "doc_id", "encoded.decoded_sha256")
    assert encoded == [(d, sha(t)) for d, t, *_ in rows]
    assert found(simhash.near_groups(docs), "doc_id", "component_id")[:2] == [(1, 1), (2, 1)]
    judged = quality_rules.judge_quality(docs, [])
    assert found(judged, "doc_id", "stats.n_words")[0] == (1, len(text.split()))
    assert token_files.token_files(docs).count() == language.predict_languages(docs, language.fit_languages(docs)).count() == 3


def test_filters_of_a_task_take_a_bit_a_place():
    import tracemalloc

    import pyarrow as pa

    build = line_dedup._task_filters(line_dedup.FILTER_BITS)
    part = pa.RecordBatch.from_pydict({"text": [f"a line of text that is long enough {n}" for n in range(100)]})
    tracemalloc.start()
    pieces = list(build(iter([part, part])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pieces and peak < 3 * line_dedup.FILTER_BITS // 8
