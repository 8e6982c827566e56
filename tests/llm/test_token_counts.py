import numpy as np
import pytest

pytest.importorskip("tiktoken")
import public_tokenizers  # noqa: E402

from campuslens.llm import token_counts as T  # noqa: E402
from campuslens.llm.queries import QUERIES, tokenizer_file  # noqa: E402

RANKS, PATTERN = tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def brute(text, rule):
    """Line spans and token shares, byte by byte."""
    encoding, _ = T._encoding(RANKS, PATTERN)
    raw = (text or "").encode()
    lines = [x for x in (raw.replace(b"\n", b"\n\0").split(b"\0"))]
    if len(lines) > 1 and lines[-1] == b"":
        lines.pop()
    owner = [k for k, line in enumerate(lines) for _ in line]
    share = [0.0] * len(lines)
    at = 0
    for i in encoding.encode_ordinary(text or ""):
        n = len(encoding.decode_single_token_bytes(i))
        own = owner[at:at + n]
        if rule == "first":
            share[own[0]] += 1
        elif rule == "most":
            share[max(sorted(set(own)), key=own.count)] += 1
        else:
            for k in own:
                share[k] += 1 / n
        at += n
    return [(k, len(line.decode("utf-8")), round(s, 6)) for k, (line, s) in enumerate(zip(lines, share))]


TEXTS = [None, "", "\n", "\n\n\n\n", "one\n\n\ntwo \n three\n", "a\n\n b", "é\n日本\n\n\n\nx", "word " * 3000 + "\n\n" + "z" * 3000]


@pytest.mark.parametrize("rule", T.RULES)
def test_rules_against_bytes(spark, rule):
    docs = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, section int, n_tokens string")
    got = T.section_token_counts(docs, RANKS, PATTERN, rule).collect()
    for i, t in enumerate(TEXTS):
        own = sorted((r["section"], r["char_end"] - r["char_start"], round(float(r["n_tokens"]), 6))
                     for r in got if r["doc_id"] == i)
        assert own == brute(t, rule), (i, rule)
    assert T.section_token_counts(docs.limit(0), RANKS, PATTERN, rule).count() == 0


def test_whole_documents_add_up(spark):
    encoding, _ = T._encoding(RANKS, PATTERN)
    rows = QUERIES["op10_token_counts"](spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    total = rows.groupby("doc_id").n_tokens.sum()
    assert all(total[d] == len(encoding.encode_ordinary(t)) for d, t in zip(docs.doc_id, docs.text))
    assert (rows.groupby("doc_id").char_end.max() == docs.set_index("doc_id").text.str.len()).all()
    for d, t in list(zip(docs.doc_id, docs.text))[:20]:
        assert sorted(rows[rows.doc_id == d].n_tokens) == sorted(x[2] for x in brute(t, "first"))


def test_fields(spark):
    rows = spark.createDataFrame([(1, "user", "hello\n\nthere"), (2, None, None), (None, "a", "")],
                                 "conv_id long, role string, text string")
    got = T.field_token_counts(rows, "conv_id", ["role", "text"], RANKS, PATTERN).collect()
    encoding, _ = T._encoding(RANKS, PATTERN)
    assert len(got) == 6 and {r["field"] for r in got} == {"role", "text"}
    assert sum(r["n_tokens"] for r in got if r["doc_id"] == 1) == len(encoding.encode_ordinary("user\nhello\n\nthere"))


def test_refuses_an_unknown_rule(spark):
    with pytest.raises(ValueError):
        T.section_token_counts(spark.range(1).selectExpr("id AS doc_id", "'' AS text"), RANKS, PATTERN, "last")


def test_attribute_without_tokens():
    counts, crossed = T.attribute(np.zeros(0, int), np.zeros(0, int), np.array([0]), np.array([0]), "first")
    assert counts.tolist() == [0] and crossed.tolist() == [0]
