"""The pipeline stage by stage against brute force, and the SQL of the queries."""

import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from corpusflow.llm import repetition, secrets  # noqa: E402
from corpusflow.llm.queries import ORACLE, QUERIES  # noqa: E402

from .test_counts import repeated_places  # noqa: E402
from .test_near_copies import brute_near  # noqa: E402
from .test_texts import check_packed  # noqa: E402


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    relation = con.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    wanted = sorted(relation.select(*columns).fetchall(), key=str)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=str) == wanted


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    before = rows_of(docs)

    docs_1 = corpus_pipeline.written(stages["quality rules"](spark, docs, sf_dir))
    good = {}
    for i, text in before.items():
        n = len(repetition.WORD.findall(text or ""))
        words = repetition.WORD.findall(text or "")
        covered = [len(repeated_places(words, least)) for least in (8, 20, 101)]
        if n >= 20 and 100 * covered[0] <= 30 * n and covered[1] <= 0.20 * n and not covered[2]:
            good[i] = text
    after = rows_of(docs_1)
    assert after == good

    docs_2 = corpus_pipeline.written(stages["exact dedup"](spark, docs_1, sf_dir))
    first = {}
    for i in sorted(after):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", after[i]), i)
    after_2 = rows_of(docs_2)
    assert set(after_2) == set(first.values())

    docs_3 = corpus_pipeline.written(stages["n-gram Jaccard join"](spark, docs_2, sf_dir))
    after_3 = rows_of(docs_3)
    assert set(after_3) == brute_near(list(after_2.items()), corpus_pipeline.NEAR_PERCENT, corpus_pipeline.NEAR_SHINGLE)

    docs_4 = corpus_pipeline.written(stages["secret scans"](spark, docs_3, sf_dir))
    after_4 = {r.doc_id: r for r in docs_4.collect()}
    assert set(after_4) == set(after_3)
    for i, row in after_4.items():
        assert row.n_chars == len(row.text)
        if not any(re.search(p, after_3[i]) for p in (*secrets.LOOK.values(), secrets.CANDIDATE)):
            assert row.text == after_3[i]
    for made in (docs_1, docs_2, docs_3, docs_4):
        assert made.columns == docs.columns

    check_packed(stages["best-fit packing"](spark, docs_4, sf_dir), [(i, r.text) for i, r in after_4.items()])
    assert corpus_pipeline.run(spark, sf_dir).count() == stages["best-fit packing"](spark, docs_4, sf_dir).count()


def test_texts_go_to_python_in_small_batches(spark, edge):
    """The stages with Python bound the rows of a batch; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    try:
        for stage in (corpus_pipeline.quality_rules, corpus_pipeline.near_copies, corpus_pipeline.pack):
            for setting, wanted in (("10000", "1000"), ("0", "1000"), ("10", "10")):
                spark.conf.set(name, setting)
                stage(spark, docs.limit(0), "")
                assert spark.conf.get(name) == wanted
    finally:
        spark.conf.set(name, before)
