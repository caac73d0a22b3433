"""Registered queries against SQL, and the pipeline stage by stage against plain Python."""

import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from cyclerlake.llm import queries, toxicity

from .test_dedup import key, near_groups, normal
from .test_mixing_packing import plain_targets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(SF).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    want = duck.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    expected = Counter(map(str, want.project(", ".join(f'"{c}"' for c in columns)).fetchall()))
    assert Counter(str(tuple(r)) for r in df.select(*columns).collect()) == expected


def test_every_operator_has_a_query():
    names = entry_point.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.landed(stage(spark, docs, SF), f"test-{name}")
        rows[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    return rows


def test_stages(spark, kept):
    before = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash", "mixing", "packing"]

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    went = {r.doc_id for r in before} - {r.doc_id for r in kept["toxicity"]}
    assert went == {r.doc.doc_id for r in toxicity.score(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    assert sum(labels.get(i) == 0 for i in went) <= 2

    best = {}
    for r in kept["toxicity"]:
        best[normal(r.text)] = min(best.get(normal(r.text), r.doc_id), r.doc_id, key=key)
    assert sorted(r.doc_id for r in kept["exact_dedup"]) == sorted(best.values())

    rows = [(r.doc_id, r.text) for r in kept["exact_dedup"]]
    _, group = near_groups(rows)
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(least.get(g, i), i)
    assert sorted(r.doc_id for r in kept["simhash"]) == sorted(least.values())

    sizes, longest, took = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in kept["simhash"]:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in kept["mixing"]:
        took[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert max(Counter(r.doc_id for r in kept["mixing"]).values()) <= 3
    for source, target in plain_targets(sizes).items():
        assert abs(took[source] - target) <= longest[source] + 48

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokens = Counter()
    for r in kept["mixing"]:
        tokens[r.doc_id] += len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    packed, filled = Counter(), defaultdict(list)
    for r in kept["packing"]:
        packed[r.doc_id] += r.length
        filled[r.sequence_id].append((r.offset, r.length))
    assert packed == tokens
    for parts in filled.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_run_gives_what_the_stages_give(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(tuple(r)[:5] for r in kept["packing"])
    # as many sequences of as many tokens, gapless
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(filled) == len({r.sequence_id for r in kept["packing"]})
