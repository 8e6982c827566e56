import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("tokenizers")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from campuslens.llm import token_blocks as B  # noqa: E402
from campuslens.llm.queries import tokenizer_file  # noqa: E402

SCHEMA = "doc_id long, text string, ids string, part int"
PATH = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def expected(rows, whole):
    out, start = [], 0
    for doc, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0,
                                                     np.array(whole(r[1]), "<u2").tobytes())):
        ids = whole(text)
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = ["", " \n\t ", "Don't stop!'s it's 'tis IT'S", "a<|endoftext|>b <|STARTOFTEXT|> c<|x", "café CAFÉ é.",
       "x y z\x1c!\x1c!", "1a2b3 108.51.216.133,", "ÀÉ,ß.×!÷? 日本語。テスト", "\U0001f600a‍b", "A" * 9000,
       "word, " * 3000, "́ a ̈b", "İstanbul ΑΣ. ﬁn"]


def test_odd_texts_match_whole_encoding(spark, whole):
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD)] + [(None, "null id", None, None), (3, None, "x", 2),
                                                              (3, None, "x", 2), (-5, "negative", "y", 0)]
    got = B.token_files(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH, 49_408, digest=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected(rows, whole), key=str)


def test_ids_round_trip_and_empty_table(spark, whole):
    docs = spark.createDataFrame([(7, "Hello there", "", 0), (2, "of the and", "", 0)], SCHEMA)
    got = {r["doc_id"]: r for r in B.token_files(docs, PATH, 49_408).collect()}
    assert got[2]["ids"] == whole("of the and") and got[7]["ids"] == whole("Hello there")
    assert got[2]["start"] == 0 and got[7]["start"] == got[2]["n_tokens"]
    assert B.token_files(docs.limit(0), PATH, 49_408, digest=True).count() == 0


def test_given_documents(spark, whole):
    import duckdb

    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    from campuslens.llm.queries import QUERIES
    got = QUERIES["op2_token_files"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == expected(rows, whole)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=50))
def test_code_round_trip(values):
    v = np.array(values, np.uint32)
    assert np.array_equal(B.unpack(B.pack(v)), v)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAzé'sdtrevm,.!<|>09 \n\t́ 中_-"), max_size=40))
def test_pieces_equal_whole_text(whole, text):
    import pyarrow as pa

    [(_, _, ids, off)] = list(B.encode_column(pa.array([text]), PATH))
    assert ids.tolist() == whole(text) and off.tolist() == [0, len(ids)]


def test_broken_payload_is_refused():
    with pytest.raises(ValueError):
        B.unpack(b"nope")
    with pytest.raises(ValueError):
        B.unpack(B.pack(np.arange(9))[:-1])
