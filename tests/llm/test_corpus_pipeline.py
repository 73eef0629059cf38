"""The pipeline's stages against brute force on a small table, and the registry."""

import os
import random

import pytest

import corpus_pipeline
import __spark_entry__ as entry
from oracle_check import compare, duck
from sparkmart.llm.oracle import ORACLE
from sparkmart.llm.queries import QUERIES
from texts import brute_components, brute_hits, prose

pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.001"


def test_registry():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "token_output"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    ok, n, _, _, detail = compare(spark, duck(SF_DIR), name, entry.queries()[name], ORACLE[name], SF_DIR)
    assert ok, detail
    assert n > 0


def test_stages(llm, tmp_path):
    rng = random.Random(21)
    item = prose(rng, 25)
    clean = [prose(rng, 80) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100 + i, t + " end") for i, t in enumerate(clean[:5])]  # near copies
    rows += [(200, f"{prose(rng, 40)} {item} {prose(rng, 40)}"), (201, "short"), (202, None), (203, "ha " * 50), (204, clean[0])]
    docs = llm.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    llm.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df, seen = llm.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / name)
        stage(llm, df, str(tmp_path)).write.parquet(out)
        df = llm.read.parquet(out)
        if k < 4:
            assert df.columns == docs.columns
        seen[name] = df.collect()
    ids = {n: [r["doc_id"] for r in x] for n, x in seen.items()}
    assert set(ids["quality_rules"]) == {i for i, _ in rows} - {201, 202, 203}
    left = [(i, t) for i, t in rows if i in set(ids["quality_rules"])]
    assert sorted(ids["ngram_jaccard_join"]) == sorted(i for i, (_, c) in brute_components(left).items() if c == i)
    assert all(brute_hits(r["text"], [(1, item)])[1] == 0 for r in seen["benchmark_decontamination"])
    assert len(seen["benchmark_decontamination"]) == len(seen["ngram_jaccard_join"])
    words = sum(len(r["text"].split()) for r in seen["benchmark_decontamination"])
    assert abs(sum(len(r["text"].split()) for r in seen["source_mixing"]) - 1.5 * words) < 300
    assert sorted(ids["token_output"]) == sorted(ids["source_mixing"])
    assert corpus_pipeline.run(llm, str(tmp_path)).count() == len(seen["token_output"])
