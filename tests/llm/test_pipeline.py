"""The pipeline against brute force, stage by stage and as a whole."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from scanledger.llm import bpe, mixing, quality_rules
from tests.llm.cases import SCHEMA, awkward_rows, table, words
from tests.llm.test_operators import (
    draw_name, found, mixing_upper, same, sha, slow_draw,
)
from tests.llm.test_similar import kept_of

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SPACE = " \t\n\x0b\x0c\r"


def corpus():
    rows = [r for r in awkward_rows() if r[1] != words(1, 200)] + [(81, words(1, 200), "en", "hot", None)]
    line = "One line that several of the documents have in common."
    for k in range(100, 220):
        text = words(k, 90) if k % 5 else words(k, 90).replace(" ", " ## ")
        if k % 4 == 1:
            text = f"{line}\n{text}"
        rows.append((k, text, "en", ["hot", "cold", None][k % 3 if k % 2 else 0], len(text)))
    copies = [(300 + k, words(113, 90) + " end" * (k % 3), "en", "cold", 1) for k in range(9)]
    return rows + copies


ROWS = corpus()
LABELS = [(k, 1 if k % 5 else 0, 0) for k in range(100, 220) if k % 7]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    table(spark, ROWS).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def slow_quality(spark, rows, sf_dir):
    docs = spark.createDataFrame(rows, SCHEMA)
    rules = quality_rules.fit_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert rules
    kept = []
    for row in rows:
        stats = quality_rules.text_statistics((row[1] or "").encode())
        failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
        rates = np.array([stats[5:]])
        if not failed and not any(rule.covers(rates)[0] for rule in rules):
            kept.append(row)
    return kept


def slow_line_dedup(rows):
    def key(line):
        return line.strip(SPACE).translate(str.maketrans(mixing_upper(), mixing_upper().lower()))

    holders = {}
    for doc_id, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders.setdefault(k, []).append(doc_id)
    for doc_id, text, lang, source, n_chars in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == doc_id]
        new = "\n".join(kept) if text is not None else None
        yield doc_id, new, lang, source, len(new) if len(kept) < len(lines) else n_chars


def slow_near_dedup(rows):
    return kept_of(rows)


def slow_mixing(rows):
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(text or "")
    weights = {s: n**mixing.EVENNESS for s, n in sizes.items()}
    for row in rows:
        size = sizes[row[3]]
        rate = weights[row[3]] / sum(weights.values()) * sum(sizes.values()) / size if size else 1.0
        yield from [row] * slow_draw(draw_name(*row[:2]), rate)


def slow_bpe(rows):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.VOCABULARY), special_tokens={}
    )
    for doc_id, text, lang, source, _ in rows:
        ids = library.encode_ordinary(text or "")
        yield doc_id, lang, source, len(ids), ids, sha(",".join(map(str, ids))), sha(text or "")


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "source_mixing", "byte_bpe",
    ]


def test_every_stage_and_the_run(spark, sf_dir):
    expected = slow_quality(spark, ROWS, sf_dir)
    slow = (
        lambda rows: list(slow_line_dedup(rows)), slow_near_dedup,
        lambda rows: list(slow_mixing(rows)), lambda rows: list(slow_bpe(rows)),
    )
    docs = table(spark, ROWS)
    for (name, stage), following in zip(corpus_pipeline.STAGES, (*slow, None), strict=True):
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), None if name == "byte_bpe" else SCHEMA)
        if name == "byte_bpe":
            assert found(docs, *docs.columns) == same(expected)
        else:
            assert found(docs, *COLUMNS) == same(expected), name
            before, expected = expected, following(expected)
            assert name == "near_dedup" or len(expected) != 0
            if name in ("quality_rules", "line_dedup"):
                assert before != expected
    assert found(corpus_pipeline.run(spark, sf_dir), *docs.columns) == same(expected)


def test_no_task_of_byte_bpe_has_two_python_workers(spark, sf_dir):
    plan = corpus_pipeline.byte_bpe(spark, table(spark, ROWS), sf_dir)._jdf.queryExecution().sparkPlan().toString()
    steps = re.findall(r"MapInArrow|FlatMapCoGroups|Exchange|RepartitionByExpression", plan)
    assert sum(s == "MapInArrow" for s in steps) >= 4
    assert not any(a == b == "MapInArrow" for a, b in zip(steps, steps[1:], strict=False)), plan


def test_stages_keep_columns_of_clashing_names(spark, sf_dir):
    docs = table(spark, ROWS, True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == table(spark, ROWS, True).columns, name
        assert docs.filter("stats <> 'own' or kept <> 'own' or copy <> 'own' or n_lines <> 'own'").count() == 0


def test_stages_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
