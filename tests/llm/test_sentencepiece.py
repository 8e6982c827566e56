import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sentencepiece = pytest.importorskip("sentencepiece")

from campuslens.llm import sentencepiece_codec as S  # noqa: E402
from campuslens.llm.queries import QUERIES, tokenizer_file  # noqa: E402

PATH = tokenizer_file("piece_bpe_32k.model")
ODD = ["", " ", "   lead and  gaps   ", "line\nends\n\n\ttabs", "日本語 テスト \U0001f600a‍b", "a▁b ▁", "<0x41> <s> </s> <unk>",
       "x" * 500, "und " * 2000, "é́ ̈", "!!!???...,,,"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(texts):
    out = []
    for lo, hi, ids, off, *_ in S.encode_column(pa.array(texts, pa.string()), PATH):
        out += [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]
    return out


def test_odd_texts_equal_the_library(library):
    assert ids_of(ODD) == library.encode(ODD)
    assert ids_of([None]) == [[]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("the rinso  ▁é\n\t中.,12") , max_size=30), max_size=4))
def test_any_text_equals_the_library(library, texts):
    assert ids_of(texts) == library.encode(texts)


def test_given_documents(spark, library):
    rows = QUERIES["op8_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    text = {r["doc_id"]: r["text"] for r in docs}
    assert len(rows) == len(docs) and all(r["round_trip"] for r in rows)
    for r in rows:
        assert list(r["ids"]) == library.encode(text[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        assert r["n_chars"] == len(text[r["doc_id"]])


def test_decoding_nulls_and_clashing_columns(spark, library):
    docs = spark.createDataFrame([(1, "some text", 5, "x"), (1, "some text", 6, "x"), (None, None, None, None)],
                                 "doc_id long, text string, n_tokens int, ids string")
    encoded = S.encode_decode(docs, PATH)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in S.decode(encoded, PATH).collect()) == [
        (0, ""), (1, "some text"), (1, "some text")]
    assert S.encode_decode(docs.limit(0), PATH).count() == 0
    assert S.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first()["text"] == ""


def best_path(word, scores, least):
    """Every segmentation, scored; unknown characters alone cost ``least``."""
    best = (-math.inf, None)
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        total = sum(scores.get(p, least if len(p) == 1 else -math.inf) for p in parts)
        best = max(best, (total, parts), key=lambda x: x[0])
    return best[0]


def test_unigram_models_take_the_best_path():
    rng = np.random.default_rng(3)
    pieces = ["<unk>", "a", "b", "ab", "ba", "aba", "bb", "abab", "▁", "▁a", "c"]
    scores = [0.0, *(-rng.uniform(1, 9, len(pieces) - 1)).tolist()]
    model = S.Model(pieces, scores, [S.UNKNOWN] + [S.NORMAL] * (len(pieces) - 1), S.UNIGRAM)
    known = dict(zip(pieces[1:], scores[1:]))
    words = ["".join(w) for n in range(1, 7) for w in itertools.product("abc", repeat=n)][::3] + ["▁aab", "abxa"]
    for word, ids in zip(words, model.segment(words)):
        total = sum(scores[i] if i else model.least for i in ids)
        assert abs(total - best_path(word, known, model.least)) < 1e-9
