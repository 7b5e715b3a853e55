"""The pipeline against the same decisions taken one by one, and what it leaves alone."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from test_lines_and_pieces import MODEL, plain_lines
from test_simhash import plain_components

from tillwise.llm import decontaminate, langid
from tillwise.llm.common import held_out


def test_stages_match_brute_force(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    predict = langid.predictor(langid.fit(documents.where(~held_out(4, 2))))()
    rows = [(i, t) for i, t in rows if not predict(t)[2]]
    rows = [(i, kept) for i, _, _, kept in plain_lines(rows, 10)]
    first = {c for _, _, c in plain_components(rows)}
    rows = [(i, t) for i, t in rows if i in first]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    match = decontaminate.matcher([(i, decontaminate.normalise(t)) for i, t in items])
    rows = [(i, t) for i, t in rows if not match(t)]
    want = sorted((i, len(MODEL.encode(t, add_bos=True, add_eos=True))) for i, t in rows)
    got = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == want and 0 < len(got) < documents.count()


def test_stages_keep_the_columns_of_documents(spark, sf_dir, edge_docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge_docs, sf_dir).columns == edge_docs.columns


def test_stages_take_an_empty_table(spark, sf_dir, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0


def test_core_library_does_not_import_the_operators():
    root = Path(corpus_pipeline.__file__).parent
    for file in (root / "tillwise").rglob("*.py"):
        assert file.parent.name == "llm" or "llm" not in file.read_text()
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
