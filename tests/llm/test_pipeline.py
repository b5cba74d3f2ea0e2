"""The corpus pipeline and the queries as they are registered."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from pulsegrid.llm import decontaminate, mixing, queries, sharding, simhash, toxicity

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "benchmark", "mixture", "shards"]
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))


def test_each_stage_decides(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels, benchmark = docs.columns, spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    wanted = {
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels)).where("score < 0.3"),
        "near_duplicates": lambda d: simhash.near_duplicates(d).where("id = component").withColumnRenamed("id", "doc_id"),
        "benchmark": lambda d: decontaminate.report(d, benchmark).where("NOT contaminated"),
        "mixture": lambda d: mixing.mix(mixing.measured(d)).where("kept"),
        "shards": lambda d: sharding.shard_report(d),
    }
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
        assert ids(out) == ids(wanted[name](docs)), name
        if name != "shards":
            assert out.columns == columns
        docs = out
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, docs.select(corpus_pipeline.run(spark, SF).columns).collect()))


def test_stages_take_odd_tables(spark, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, awkward, SF)
        assert name == "shards" or out.columns == awkward.columns
        assert 0 < out.count() <= awkward.count() and stage(spark, nothing, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    relation = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in relation.description]
    df = queries.queries()[name](spark, SF)
    key = lambda names, rows: sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in rows)
    assert key(df.columns, df.collect()) == key(columns, relation.fetchall())
