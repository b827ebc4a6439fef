"""Spelling variants against all pairs."""

from __future__ import annotations

import re
import zlib
from collections import Counter

from scanledger.llm import spelling
from scanledger.llm.queries import op11_spelling_variants
from tests.llm.cases import SCHEMA, awkward_rows, long_text, table

RESULT = ("word", "form", "root", "n", "n_near", "form_n")


def found(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def slow_counts(rows: list[tuple], damage: bool, min_count: int) -> dict[str, int]:
    seen: Counter = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % 97 == 0:
                run = "".join(c for k, c in enumerate(run) if k != h % len(run))
            seen[run] += 1
    return {w: n for w, n in seen.items() if n >= min_count and len(w) >= 5}


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def slow_variants(counts: dict[str, int]) -> list[tuple]:
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and one_apart(w, x)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    rows = []
    for w, form in forms.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, form, root, counts[w], len(near[w]), form and counts[form]))
    return sorted(rows, key=repr)


def variants_of(spark, counts: dict[str, int]):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return found(spelling.spelling_variants(words), *RESULT)


def test_word_counts(spark):
    rows = awkward_rows() + [(None, "Null ids too, null ids too", None, None, None), (3, long_text(), "en", "hot", 1)]
    # ids enough for runs that are damaged, down to runs of one code point
    rows += [(k, "A Ärger Straße ÀÉÎ× naïve Mädchen x", "de", "hot", 1) for k in range(400)]
    for damage, least in ((True, 1), (True, 3), (False, 3)):
        counted = spelling.word_counts(table(spark, rows, True), damage, min_count=least)
        assert dict(found(counted, "word", "n")) == slow_counts(rows, damage, least)


def test_variants_of_planted_words(spark):
    base = ["orange", "straße", "ààààà", "aaaaaa", "library", "abcde", "abababab"]
    counts = {}
    for k, word in enumerate(base):
        counts[word] = 400 * (k + 1)
        for at in range(len(word) + 1):
            counts.setdefault(word[:at] + word[at + 1 :], 3 + at)  # deletions, some of four code points
            counts.setdefault(word[:at] + "é" + word[at:], 5)  # insertions
            counts.setdefault(word[:at] + "z" + word[at + 1 :], 100 + 50 * at)  # replacements
            counts.setdefault(word[:at] + word[at : at + 1] + word[at:], 7)  # repeated code points
    counts |= {"chain": 3, "chaina": 6, "chainab": 12, "chainabc": 24, "chainabcd": 48, "chainabcde": 95}
    counts |= {"tied one": 4, "tied ona": 9, "tied onb": 9, "𝒳𝒴𝒵ab": 3, "𝒳𝒴𝒵a": 7, "long" * 5000: 9, "long" * 5000 + "x": 3}
    counts = {w: n for w, n in counts.items() if len(w) >= 2}
    assert variants_of(spark, counts) == slow_variants(counts)


def test_variants_of_all_short_words(spark):
    """Every word of three letters over two: chunks agree in every possible way."""
    import itertools

    counts = {"".join(w): 1 + sum(map(ord, w)) % 7 for n in (2, 3, 4, 5) for w in itertools.product("ab", repeat=n)}
    assert variants_of(spark, counts) == slow_variants(counts)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    counts = slow_counts([tuple(r) for r in docs.collect()], True, 3)
    result = op11_spelling_variants(spark, "/root/testdata/sf0.001")
    assert result.columns == list(RESULT)
    assert found(result, *RESULT) == slow_variants(counts)
    assert counts


def test_empty_and_wordless_tables(spark):
    for rows in ([], [(1, None, None, None, None), (2, "", None, None, None), (None, "a b 1", None, None, None)]):
        words = spelling.word_counts(spark.createDataFrame(rows, SCHEMA), True)
        assert spelling.spelling_variants(words).count() == 0
