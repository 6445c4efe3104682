"""The registered text queries against their SQL, and the pipeline against plain Python."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import connect, difference  # noqa: E402
from floatlake.llm import decontaminate, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} <= {name.split("_")[0] for name in entry.queries()}
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


def test_queries_without_sql_keep_every_row(spark):
    n = queries.table(spark, SF, "documents").count()
    for name in ("op2_quality_rules", "op5_license_scans", "op7_language_id", "op10_simhash"):
        assert queries.QUERIES[name](spark, SF).count() == n
    assert queries.op6_html_extraction(spark, SF).count() == queries.table(spark, SF, "pages").count()


def test_pipeline(spark):
    docs = queries.table(spark, SF, "documents")
    first, *_ = corpus_pipeline.STAGES
    known = first[1](spark, docs, SF)
    assert known.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in known.collect()]
    lettered = {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert {i for i, _ in rows} <= lettered and len(rows) >= 0.98 * len(lettered)

    rows = [(i, kept) for i, _, _, kept in brute.repeated_lines(rows)]
    rows = brute.first_of_similar(rows)
    items = [decontaminate.words_of(r.text) for r in queries.table(spark, SF, "benchmark").collect()]

    def leaks(text):
        words = decontaminate.words_of(text)
        own = set(words)
        return any(
            sum(w in own for w in item) >= 0.8 * len(item) and brute.edit_distance(item, words) <= int(0.2 * len(item)) for item in items
        )

    rows = [(i, t) for i, t in rows if not leaks(t)]
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in packed} == {i for i, _ in rows}
    tokens = {}
    for p in packed:
        tokens[p.doc_id] = tokens.get(p.doc_id, 0) + p.length
        assert tokens[p.doc_id] <= p.doc_tokens
    assert all(tokens[p.doc_id] == p.doc_tokens for p in packed)
    encode = queries.packing.encoder(*queries.TOKENIZER)
    assert tokens == {i: len(encode(t)) + 1 for i, t in rows}


def test_stages_keep_the_columns(spark):
    from pyspark.sql import functions as F

    docs = queries.table(spark, SF, "documents").withColumns({"did": F.lit("x"), "t": F.lit(1), "gone": F.lit(None), "first_id": F.lit(2), "language": F.lit("q"), "leak0": F.lit(3)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
