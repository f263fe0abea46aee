"""Token-id files against the tokenizers library and the files' own metadata."""
import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from peerscope.llm import tokenfiles
from peerscope.llm.queries import BYTE_BPE, QUERIES
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, part string, ids int, before string"  # the last three clash with written names


def expected(rows):
    """(doc_id, start, n_tokens, crc) of rows (doc_id, text), which have distinct ids."""
    coder, start, out = Tokenizer.from_file(BYTE_BPE), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, tokenfiles.END_ID]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def found(spark, path):
    rows = tokenfiles.with_starts(tokenfiles.read_tokens(spark, path), path)
    rows = rows.select("doc_id", "start", "n_tokens", tokenfiles.ids_crc32("ids").alias("c")).collect()
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_query_equals_the_library(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_token_files"](spark, SMALL).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)


def test_nulls_long_texts_specials_and_clashing_names(spark):
    rows = [(None, "no id"), (5, None), (3, ""), (9, "naïve \U0001f600 <|endoftext|> done"), (7, "word " * 60_000 + "x" * 20_000)]
    docs = spark.createDataFrame([(*r, "p", 1, "b") for r in rows], SCHEMA)
    assert found(spark, tokenfiles.write_tokens(docs, BYTE_BPE)) == expected(rows)
    empty = tokenfiles.write_tokens(docs.where("doc_id = 99"), BYTE_BPE)
    assert found(spark, empty) == []


def test_repeated_rows_and_a_hot_key_keep_one_stream(spark):
    docs = spark.createDataFrame([(1, f"text {i % 40}") for i in range(300)] + [(0, "first"), (2, "last")], "doc_id long, text string")
    got = found(spark, tokenfiles.write_tokens(docs, BYTE_BPE))
    assert len(got) == 302 and got[0][0] == 0 and got[-1][0] == 2
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:], strict=False))  # no gap, no overlap


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_encodings_row_groups_and_page_indexes(spark, encoding):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat('number ', id, ' '), 40) AS text").coalesce(1)
    path = tokenfiles.write_tokens(docs, BYTE_BPE, encoding=encoding, row_group_bytes=30_000, page_bytes=8192, page_rows=100)
    groups = 0
    for file in glob.glob(f"{path}/part-*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups = max(groups, meta.num_row_groups)
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                col = group.column(c)
                assert col.has_column_index and col.has_offset_index
                name = col.path_in_schema.split(".")[0]
                dictionary = any("DICTIONARY" in e for e in col.encodings)
                assert dictionary == (name == "ids" and encoding == "dictionary")
                assert dictionary or "DELTA_BINARY_PACKED" in col.encodings
    assert groups > 1
    assert found(spark, path) == expected([(i, f"number {i} " * 40) for i in range(3000)])


def test_selective_reads_reach_the_scan(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('row ', id) AS text")
    path = tokenfiles.write_tokens(docs, BYTE_BPE)
    some = tokenfiles.read_tokens(spark, path, ["doc_id", "n_tokens"], "doc_id BETWEEN 100 AND 102")
    assert sorted(r[0] for r in some.collect()) == [100, 101, 102]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan and "ids" not in plan.split("ReadSchema")[1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \t\n'sdlvertm1²\xa0\x1c"), st.characters()), max_size=40), max_size=4))
def test_pieces_equal_whole_texts(texts):
    coder, plain = tokenfiles.tokenizer(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<i4").tobytes() for t in texts]
    assert coder.encode(texts) == want


def test_every_plain_character_is_cut_as_the_library_does():
    coder, plain = tokenfiles.tokenizer(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for c in map(chr, range(0x250)):
        for text in (f"a{c}b", f"1{c}2", f" {c} ", f".{c}.", f"{c}{c}\n{c}'s{c}", f"it{c}'ll  {c}x"):
            assert coder.encode([text])[0] == np.array(plain.encode(text, add_special_tokens=False).ids, "<i4").tobytes(), repr(text)


def test_unknown_encoding(spark):
    with pytest.raises(ValueError):
        tokenfiles.write_options("plain", 1, 1, 1)


def test_texts_are_cut_at_once_as_the_library_does_and_pieces_are_learnt_once():
    coder, plain = tokenfiles.PieceCoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + j)}é{i}'s <{j}|\n\nx{chr(97 + i % 26)}\t 's''ll" for j in range(26)) for i in range(300)]
    texts += ["", " ", "\n 's", "<|", "endoftext", "|>", "it's'LL'll've", "  "]
    pieces, firsts, odd = tokenfiles.cut(texts)
    want = [[t[a:b] for _, (a, b) in plain.pre_tokenizer.pre_tokenize_str(t)] for t in texts]
    assert not odd.any() and pieces.to_pylist() == [p for w in want for p in w]
    assert np.diff(firsts).tolist() == [len(w) for w in want]
    learnt, learn = [], coder.learn
    coder.learn = lambda new: learnt.extend(new) or learn(new)
    for run in (texts[:100], [*texts, " <|endoftext|>", "\U0001f600 odd"]):
        assert coder.encode(run) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<i4").tobytes() for t in run]
    assert len(learnt) == len(set(learnt)) == len({p for w in want for p in w})
