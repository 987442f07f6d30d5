"""Every llm query that SQL can express against DuckDB, and the pipeline stage by stage."""

import sys

import brute
import duckdb
import pytest
from brute import SF_SMALL, frame  # noqa: F401 (a fixture)
from test_tokens import check_packing

from adlift.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_names():
    import __spark_entry__ as entry

    assert [n for n in entry.queries() if n.startswith("op")] == [n for n in queries.QUERIES if n.startswith("op")]
    assert "pipeline" in entry.queries() and set(queries.ORACLE) <= set(entry.oracle_sql())


def test_pipeline_equals_brute_force(spark):
    sys.path.insert(0, ".")
    import corpus_pipeline as cp
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    columns, at, kept = docs.columns, docs, {}
    for name, stage in cp.STAGES:
        at = stage(spark, at, SF_SMALL).cache()
        if name != "packing":
            assert at.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in at.collect()} if name != "packing" else at.collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = kept["quality_rules"]
    for i, t in text.items():
        c = brute.quality_counts(t)
        if c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]:
            assert i not in good
    last = {}
    for i, t in good.items():
        last[t] = max(i, last.get(t, i))
    assert kept["exact_dedup"] == {i: t for t, i in last.items()}
    fps = {i: brute.fingerprint(t) for i, t in kept["exact_dedup"].items()}
    root = brute.components(fps.values(), 3)
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(i, least.get(root[f], i))
    assert set(kept["simhash_near_dedup"]) == set(least.values())
    masked = kept["pii"]
    assert set(masked) == set(kept["simhash_near_dedup"])
    for i, t in masked.items():
        spans = brute.base_spans(text[i])
        assert all(text[i][a:b] not in t for k in ("email", "card", "phone") for a, b in spans[k])
        assert not any(brute.base_spans(t).values())
        if not any(spans.values()) and "=" not in text[i]:
            assert t == text[i]
    import public_tokenizers as P

    assert check_packing(kept["packing"], masked, Tokenizer.from_file(P.path("byte_bpe_50k.json"))) == 0
