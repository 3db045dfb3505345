"""Every dealt operator and stage on edge rows and on an empty table."""

import pytest

import corpus_pipeline
from stratus.llm import decontaminate, line_dedup, line_frequency, mixing, pii, quality, secrets, simhash, toxicity
from tests.llm import edges

N = len(edges.ROWS)


def per_row(spark, docs):
    return {
        "line_quality": lambda: line_frequency.line_quality(docs),
        "line_dedup": lambda: line_dedup.dedup_lines(docs)[0],
        "simhash": lambda: simhash.near_duplicates(docs),
        "secrets": lambda: secrets.scan(docs),
        "pii": lambda: pii.find(docs),
        "decontaminate": lambda: decontaminate.contamination(docs, edges.benchmark(spark)),
        "quality": lambda: quality.classify(docs, edges.labels(spark)),
        "mixing": lambda: mixing.taken(mixing.mix(docs)),
        "toxicity": lambda: toxicity.classify(docs, edges.labels(spark)),
    }


@pytest.mark.parametrize("name", list(per_row(None, None)))
def test_a_row_for_every_row(spark, name):
    assert per_row(spark, edges.docs(spark))[name]().count() == N
    assert per_row(spark, edges.docs(spark, []))[name]().count() == 0


def test_values_on_edge_rows(spark):
    prints = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_duplicates(edges.docs(spark)).collect()}
    assert prints[(3, 0)] == prints[(4, 0)] == prints[(5, 0)] == prints[(None, 0)] == 3
    found = {r["doc_id"]: r for r in decontaminate.contamination(edges.docs(spark), edges.benchmark(spark)).collect() if r["doc_id"]}
    assert found[1]["n_words"] == 15 and found[1]["n_hit"] == 12 and found[1]["items"] == ["1"] and found[1]["contaminated"]
    assert found[6]["n_hit"] > 100_000 and not found[3]["contaminated"] and found[3]["n_words"] == 0
    removed = line_dedup.dedup_lines(edges.docs(spark))[1].collect()
    assert {(r["keep_doc_id"], r["keep_line"]) for r in removed} == {(1, 0), (1, 1)}


@pytest.mark.parametrize("step", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, tmp_dir, step):
    edges.benchmark(spark).write.parquet(f"{tmp_dir}/benchmark.parquet")
    edges.labels(spark).write.parquet(f"{tmp_dir}/labels.parquet")
    stage = corpus_pipeline.STAGES[step][1]
    for rows in (edges.ROWS, []):
        docs = edges.docs(spark, rows)
        out = stage(spark, docs, tmp_dir)
        if step < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        assert out.count() <= len(rows)
    if step == 2:  # one of each group, whatever the id
        kept = stage(spark, edges.docs(spark), tmp_dir).select("doc_id").collect()
        assert sorted((r[0] for r in kept), key=lambda x: (x is None, x)) == [1, 3, 6, 7, 8, None, None]


def test_common_lines_are_cut(spark):
    rows = [(i, f"shared line\nown line number {chr(97 + i)}", "en", "h" if i else None) for i in range(26)]
    out = line_frequency.without_common_lines(edges.docs(spark, rows), max_docs=20).select("doc_id", "text", "fp").collect()
    assert {r["doc_id"]: r["text"] for r in out} == {i: (f"own line number {chr(97 + i)}" if i else rows[0][1]) for i in range(26)}
    verdict = line_frequency.line_quality(edges.docs(spark, rows), min_words=1).collect()
    assert all(r["n_removed_lines"] == (r["doc_id"] > 0) and r["kept"] for r in verdict)
    strict = line_frequency.line_quality(edges.docs(spark, rows), min_words=1, max_removed=0.2).collect()
    assert [r["kept"] for r in sorted(strict, key=lambda r: r["doc_id"])] == [True] + [False] * 25
