"""The queries whose result SQL can state, and the pipeline stage by stage."""

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from orderflow.llm import bpe, decontaminate, jaccard, oracle, pii, quality, queries
from orderflow.llm.common import read_table, saved
from tests.llm.test_jaccard import plain

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle.registered()))
def test_query_gives_what_the_sql_gives(spark, duck, name):
    frame = queries.registered()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    wanted = duck.sql(f"SELECT {', '.join(columns)} FROM ({oracle.registered()[name]})").fetchall()
    found = [tuple(r) for r in frame.select(*columns).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, wanted))


def test_all_operators_and_the_pipeline_are_registered():
    assert [name.split("_")[0] for name in queries.registered()] == [f"op{n}" for n in range(1, 14)]


def test_each_stage_on_what_the_one_before_kept(spark):
    first = read_table(spark, SF_DIR, "documents")
    steps = [first]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(saved(stage(spark, steps[-1], SF_DIR), name))
    rows = [{r["doc_id"]: r for r in frame.collect()} for frame in steps]
    for frame in steps[:-1]:
        assert frame.columns == first.columns
    model = queries.quality_model(spark, SF_DIR)
    good = {r["doc_id"] for r in quality.score(steps[0], model).collect() if r["score"] >= 0.3}
    assert set(rows[1]) == good and 0 < len(good) < len(rows[0])
    groups = plain([(d, r["text"]) for d, r in rows[1].items()], 5, 80)
    assert set(rows[2]) == {d for d, _, c in groups if d == c} and len(rows[2]) < len(rows[1])
    leaks = {r["doc_id"] for r in decontaminate.find(steps[2], read_table(spark, SF_DIR, "benchmark")).collect()}
    assert leaks and set(rows[3]) == set(rows[2]) - leaks
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(steps[3]).collect()}
    assert {d: r["text"] for d, r in rows[4].items()} == redacted
    assert all(r["n_chars"] == len(r["text"]) for r in rows[4].values())
    with open(queries.BYTE_BPE, "rb") as file:
        ranks = bpe.Vocabulary(file.read(), public_tokenizers.PATTERN).ranks
    encoder = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for doc_id, row in rows[5].items():
        assert list(memoryview(bytes(row["ids"])).cast("I")) == encoder.encode_ordinary(rows[4][doc_id]["text"])
    assert set(rows[5]) == set(rows[4])
