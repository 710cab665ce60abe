"""Registered queries against their SQL, and the pipeline against a plain version."""

import zlib
from pathlib import Path

import cases
import corpus_pipeline
import oracle
import pytest
from test_line_templates import brute as brute_lines
from test_near_copies import brute as brute_kept

import __spark_entry__ as registry
from tillpanel.llm import language, packing, toxicity
from tillpanel.llm.queries import llm_queries, llm_sql

TABLES_DIR = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not Path(TABLES_DIR).is_dir(), reason="no tables here")


@here
@pytest.mark.parametrize("name", llm_sql())
def test_query_matches_sql(spark, name):
    frame = registry.queries()[name](spark, TABLES_DIR)
    assert oracle.differences(frame, oracle.connect(TABLES_DIR), registry.oracle_sql()[name]) is None


@here
@pytest.mark.parametrize("name", sorted(llm_queries().keys() - llm_sql().keys()))
def test_query_covers_its_table(spark, name):
    table = spark.read.parquet(f"{TABLES_DIR}/documents.parquet")
    frame = registry.queries()[name](spark, TABLES_DIR)
    assert frame.select("doc_id").distinct().count() == table.select("doc_id").distinct().count()


def plain_pipeline(spark, tables_dir):
    """The stages with their models applied text by text, and everything else in memory."""
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet").cache()
    labels = spark.read.parquet(f"{tables_dir}/labels.parquet")
    model = language.train(docs)
    rows = [(r.doc_id, r.text, r) for r in docs.collect()]
    scored = list(zip(rows, model.predict([row[1] for row in rows]), strict=True))
    rows = [row for row, (lang, score) in scored if lang != "und" and score >= 0.5]

    kept = spark.createDataFrame([r for _, _, r in rows], docs.schema)
    toxic = toxicity.train(kept, labels)
    cache = toxicity._Cache(toxic.token_score)
    rows = [(d, t) for d, t, _ in rows if toxic.probability(toxicity._judged(toxic, cache, t)[2]) < 0.5]
    lines = brute_lines(rows)
    rows = [(d, lines[d, t]) for d, t in rows if lines[d, t] == t or lines[d, t].split()]
    kept = set(brute_kept(rows, 5, 80))
    rows = [(d, t) for d, t in rows if d in kept]
    encode = packing.ChunkIds(packing.default_tokenizer_path())
    pieces = set()
    for (d, _), ids in zip(rows, encode([t for _, t in rows]), strict=True):
        ids += (1).to_bytes(4, "little")
        for k in range(0, len(ids) // 4, 4096):
            part = ids[4 * k : 4 * (k + 4096)]
            pieces.add((d, k // 4096, k, len(part) // 4, zlib.crc32(part)))
    return pieces


@here
def test_pipeline_matches_a_plain_version(spark):
    found = corpus_pipeline.run(spark, TABLES_DIR).collect()
    assert {tuple(r)[:5] for r in found} == plain_pipeline(spark, TABLES_DIR)
    filled = {}
    for r in found:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]


def test_stages_take_odd_rows(spark, tmp_path):
    spark.createDataFrame([(5, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for rows in (None, []):
        docs = cases.frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == list(corpus_pipeline.DOCUMENT_COLUMNS)
            kinds = dict(docs.dtypes)
            assert dict(out.dtypes) == {c: kinds[c] for c in out.columns}
            assert out.count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
