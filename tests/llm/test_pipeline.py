"""The stages of the pipeline on one small table, against their contracts."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from casebook.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF))
    return out


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality rules", "SimHash near-dedup", "mixing sources to target weights",
        "byte-level BPE encoding and decoding"]


def test_filters_keep_rows_and_columns(steps):
    docs, rest = steps[0], steps[1:4]
    before = Counter(map(tuple, docs.collect()))
    for df in rest:
        assert df.columns == docs.columns
        now = Counter(map(tuple, df.collect()))
        assert now and not now - before
        before = now
    mixture = Counter(map(tuple, steps[4].collect()))  # every document once at least, small languages more often
    assert steps[4].columns == docs.columns and mixture.keys() == before.keys()
    assert not before - mixture and sum(mixture.values()) > 1.2 * sum(before.values())


def test_run_equals_its_stages(spark, steps):
    a = Counter(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert a == Counter(map(tuple, steps[-1].collect()))
    mixed = Counter(r.doc_id for r in steps[4].select("doc_id").collect())
    assert Counter({k: v for k, v in mixed.items()}) == Counter(r[0] for r in a.elements())


def test_every_operator_is_registered():
    names = set(E.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    key = lambda df: sorted(map(tuple, df[columns].astype(str).values.tolist()))
    assert key(got) == key(want)
