"""Line dedup against plain Python and SQL, pieces against the library itself."""

import hashlib
import string
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import line_dedup, pieces
from tillwise.llm.queries import ORACLE, QUERIES

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_lines(rows, least):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(LOWER)
    texts = [(i, (t or "").split("\n")) for i, t in rows]
    seen = Counter(k for _, lines in texts for k in {key(x) for x in lines} if k)
    out = []
    for i, lines in texts:
        kept = [x for x in lines if seen[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_match_plain_python(edge_docs, edge_rows):
    for least in (2, 10):
        done = line_dedup.drop_shared_lines(edge_docs, least)
        got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in done.collect()), key=repr)
        assert got == plain_lines(edge_rows, least)


def test_shared_lines_keep_positions(spark):
    rows = [(i, f"own {i}\n Shared LINE\t\nlast {i}\nshared line\n") for i in range(11)] + [(99, "shared lines")]
    done = line_dedup.drop_shared_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r.doc_id: (r.n_dropped, r.kept) for r in done.collect()}
    assert got[3] == (2, "own 3\nlast 3\n") and got[99] == (0, "shared lines")


def test_rewritten_documents_keep_their_columns(edge_docs, no_docs):
    done = line_dedup.deduplicate_lines(edge_docs)
    assert done.columns == edge_docs.columns and done.count() == edge_docs.count()
    assert done.select("kept", "n_lines").distinct().collect() == [("c", "c")]
    assert line_dedup.deduplicate_lines(no_docs).count() == 0


def test_lines_match_sql(spark, sf_dir):
    frame = QUERIES["op10_lines"](spark, sf_dir)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = duck.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({ORACLE['op10_lines']})").fetchall()
    assert sorted(tuple(r) for r in frame.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == sorted(want)


MODEL = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def check_piece(encode, text):
    n, packed, decoded = encode(text)
    ids = MODEL.encode(text or "", add_bos=True, add_eos=True)
    assert np.frombuffer(packed, "<u4").tolist() == ids and n == len(ids) and decoded == MODEL.decode(ids)


def test_no_piece_crosses_a_chunk():
    assert pieces.crossing_pieces(pieces.model_path()) == []


def test_pieces_of_edge_cases(edge_rows):
    encode = pieces.piece_maker(table_bytes=5)()
    for _, text in edge_rows:
        check_piece(encode, text)
    for text in ("  a  b ", "▁x", "a▁b ▁", "\x00a", "<s> </s>", " ", "   ", "�", "a b", "é́"):
        check_piece(encode, text)


ENCODE = pieces.piece_maker()()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab ▁\n\té日.,<s>/1")), max_size=40))
def test_pieces_match_the_library(text):
    check_piece(ENCODE, text)


def test_piece_query(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in QUERIES["op7_pieces"](spark, sf_dir).collect()}
    texts = documents.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        ids = MODEL.encode(text or "", add_bos=True, add_eos=True)
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(MODEL.decode(ids).encode()).hexdigest()


def test_piece_rows(edge_docs, no_docs):
    assert pieces.encode_documents(edge_docs).count() == edge_docs.count()
    assert pieces.encode_documents(no_docs).count() == 0


def test_repeated_rows_count_once(spark, tmp_path):
    rows = [(1, "repeated\nown")] * 10 + [(None, "nameless")] * 12 + [(100 + i, f"shared\nrow {i}") for i in range(9)] + [(99, "Shared")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = QUERIES["op10_lines"](spark, str(tmp_path)).collect()
    assert len(done) == len(rows)
    got = {r.doc_id: r.kept_sha256 for r in done}
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(f"SELECT doc_id, n_dropped FROM ({ORACLE['op10_lines']})").fetchall()
    dropped = {r.doc_id: r.n_dropped for r in done}
    assert dropped == dict(want) and dropped[1] == 0 and dropped[None] == 0 and dropped[99] == 1
    assert got[1] == hashlib.sha256(b"repeated\nown").hexdigest()


def test_rows_whose_first_hash_collides_stay_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tillwise.llm import common, line_dedup, simhash

    real = common._row_hashes
    monkeypatch.setattr(common, "_row_hashes", lambda *x: (F.lit(5).cast("bigint"), real(*x)[1]))
    rows = [(i, f"shared line\nown line {i} of this document") for i in range(12)] + [(None, "shared line"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    done = {(r.doc_id, r.text): r for r in line_dedup.drop_shared_lines(docs).collect()}
    assert len(done) == len(rows)
    for i, text in rows:
        assert done[i, text].kept == ("" if i is None else f"own line {i} of this document")
    different = [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(20)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(different, "doc_id bigint, text string"))
    assert sorted(map(tuple, kept.collect())) == different


def test_the_table_is_bounded_by_bytes():
    import tracemalloc

    import random

    pick = random.Random(1)
    texts = ["".join(pick.choices("abcdefghij", k=1500)) for _ in range(600)]
    sizes = {}
    for bound in (1 << 19, 1 << 40):
        encode = pieces.piece_maker(table_bytes=bound)()
        tracemalloc.start()
        for text in texts:
            encode(text)
        sizes[bound] = tracemalloc.get_traced_memory()[0]
        tracemalloc.stop()
    assert sizes[1 << 19] < 1 << 20 < sizes[1 << 40]
    check_piece(encode, texts[0] + " " + texts[1])


def test_a_model_whose_pieces_cross_chunks_is_refused(monkeypatch):
    monkeypatch.setattr(pieces, "crossing_pieces", lambda path: ["a▁b"])
    with pytest.raises(ValueError, match="cross"):
        pieces.piece_maker()
