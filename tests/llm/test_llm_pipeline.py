import os
import shutil
import subprocess
import sys
from collections import Counter

import pytest

import corpus_pipeline
from fieldrank.llm import mixing

SF_DIR = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """The rows that go into each stage and those that come out."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, SF_DIR).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out.append((name, before, docs))
    return out


def test_order_and_columns(spark, results):
    names = [name for name, _, _ in results]
    assert names == ["quality rules", "SimHash near-dedup", "benchmark decontamination",
                     "mixing sources to target weights", "token-ID / binary output"]
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").dtypes
    assert all(after.dtypes == columns for _, _, after in results[:-1])


def test_quality_stage(results):
    from llm.test_llm_quality import verdicts

    _, before, after = results[0]
    docs = [(r.doc_id, r.text, r.source) for r in before.collect()]
    expected = {i: text for i, kept, text in verdicts(docs, 20, 0.1) if kept}
    assert {r.doc_id: r.text for r in after.collect()} == expected
    assert 0 < len(expected) < len(docs)


def test_dedup_stage(results):
    from llm.test_llm_simhash import groups, print_of

    _, before, after = results[1]
    docs = sorted((r.doc_id, r.text) for r in before.collect())
    label = groups([print_of(text) for _, text in docs])
    expected = {docs[i] for i in label}
    assert {(r.doc_id, r.text) for r in after.collect()} == expected and len(expected) < len(docs)


def test_decontamination_stage(spark, results):
    from llm.test_llm_decontamination import brute

    _, before, after = results[2]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = brute([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()], items)
    assert {r.doc_id for r in after.collect()} == {r[0] for r in rows if not r[-1]}
    assert any(r[-1] for r in rows)


def test_mixing_stage(results):
    _, before, after = results[3]
    report = mixing.mix_report(before, 4).collect()
    taken = {r.doc_id: r.taken // max(r.size, 1) for r in report}
    found = Counter(r.doc_id for r in after.collect())
    assert found == Counter({i: n for i, n in taken.items() if n})


def test_packing_stage(results):
    from llm.test_llm_packing import TOKENIZER

    _, before, after = results[4]
    held = Counter()
    for row in after.collect():
        for doc, a, b in zip(row.doc_ids, row.cu_seqlens, row.cu_seqlens[1:]):
            held[doc] += b - a
    expected = Counter()
    for row in before.collect():
        expected[row.doc_id] += len(TOKENIZER.encode_ordinary(row.text))
    assert held == expected


def test_run_equals_its_stages(spark, results):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == results[-1][2].columns
    assert rows.count() == results[-1][2].count()


def test_stages_take_odd_documents(spark, odd_documents, clashing):
    for docs in (clashing(odd_documents), odd_documents.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_DIR).collect()


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op1') for n in q)"
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=60, env=env)
