import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tillflow.llm import piece_merge

from .helpers import corpus, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return piece_merge.BatchEncoder(MODEL)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="abehinorst \n\t▁éñ日\U0001F600=-#<>/01s", max_size=60), max_size=5))
def test_same_ids_and_text_as_the_library(encoder, library, texts):
    own = [a.tolist() for a in encoder.encode(texts)]
    assert own == [library.encode(t, add_eos=True) for t in texts]
    assert [encoder.merger.decode(np.array(i, np.int32)) for i in own] == [library.decode(i) for i in own]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 31999) | st.integers(0, 300), max_size=10))
def test_decodes_any_ids_like_the_library(encoder, library, ids):
    assert encoder.merger.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_memo_reset_changes_nothing():
    small = piece_merge.BatchEncoder(MODEL, limit=3)
    texts = ["the cat sat", "on the mat", "the end of it all"]
    first = [a.tolist() for t in texts for a in small.encode([t])]
    assert first == [a.tolist() for a in piece_merge.BatchEncoder(MODEL).encode(texts)]


def test_tables(spark, library):
    rows = corpus(20)
    docs = frame(spark, rows).withColumnRenamed("lang", "ids")  # a clashing name
    out = piece_merge.decode(piece_merge.encode(docs, MODEL), MODEL)
    got = sorted((str(r.doc_id), r.ids, r.decoded) for r in out.collect())
    want = sorted((str(r[0]), library.encode(r[1] or "", add_eos=True), library.decode(library.encode(r[1] or ""))) for r in rows)
    assert got == want
    both = piece_merge.encode(docs, MODEL, decoded="decoded", keep=["doc_id"])
    assert both.columns == ["doc_id", "ids", "decoded"]
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in both.collect()) == want
    assert piece_merge.encode(frame(spark, []), MODEL).count() == 0
