"""Token files against the tokenizer itself, and the code against plain Python."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stakescore.llm import token_files
from stakescore.llm.word_ids import WordEncoder
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = WordEncoder(PATH)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=60))
def test_packed_numbers_come_back(numbers):
    control, data = token_files.pack(np.array(numbers, "<u4"))
    assert len(control) == -(-len(numbers) // 4)
    assert len(data) == sum(max(1, -(-n.bit_length() // 8)) for n in numbers)
    assert token_files.unpack(control, data, len(numbers)).tolist() == numbers


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdeéßñÀΣσς İẞ.,'!<|endoftext> \n\t\x1c\x85  ́​日9") | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_chunked_ids_are_those_of_the_whole_text(text):
    assert np.frombuffer(ENCODER.encode(text), ENCODER.dtype).tolist() == plain_ids(text)


def test_other_settings_go_through_the_library(tmp_path):
    import json

    settings = json.load(open(PATH, encoding="utf-8"))
    settings["normalizer"] = {"type": "NFC"}
    (tmp_path / "other.json").write_text(json.dumps(settings), encoding="utf-8")
    library, own = Tokenizer.from_file(str(tmp_path / "other.json")), WordEncoder(str(tmp_path / "other.json"))
    for text in ["Hello World, fine", *filter(None, ODD_TEXTS)]:
        assert np.frombuffer(own.encode(text), own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abstrevml'0²½¼ªµ×÷$%.,! \x00\x7f\xad\xa0") | st.characters(max_codepoint=255), max_size=30))
def test_latin_words_are_split_as_by_the_library(text):
    assert np.frombuffer(ENCODER.encode(text), ENCODER.dtype).tolist() == plain_ids(text)


def wanted(rows, end_id):
    found, start = [], 0
    for doc_id, ids in sorted(((i, plain_ids(t) + [end_id]) for i, t in rows), key=lambda r: r[0]):
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return found


def read(spark, docs, tmp_path):
    token_files.write(docs, str(tmp_path / "files"), PATH, 2)
    rows = token_files.read(spark, str(tmp_path / "files"), with_ids=True).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_files_hold_every_document_in_order(spark, docs_of, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 300)
    rows = [(7 * i % 101, t) for i, t in enumerate(ODD_TEXTS)]
    assert read(spark, docs_of(rows), tmp_path) == wanted(rows, 2)


def test_repeated_and_null_ids(spark, docs_of, tmp_path):
    rows = [(5, "two words"), (5, "one"), (5, "one"), (None, "none"), (1, None)]
    got = read(spark, docs_of(rows), tmp_path)
    assert [r[0] for r in got] == [None, 1, 5, 5, 5]
    assert [r[2] for r in got] == [len(plain_ids("none")) + 1, 1, 2, 2, 3]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got[:-1]]).tolist()


def test_no_documents(spark, docs_of, tmp_path):
    assert read(spark, docs_of([]), tmp_path) == []


def test_frequent_ids_take_one_byte(spark, docs_of, tmp_path):
    token_files.write(docs_of([(i, "the the the rare%d" % i) for i in range(40)]), str(tmp_path / "files"), PATH, 2)
    ranks = {r["rank"]: r["id"] for r in spark.read.parquet(str(tmp_path / "files/ranks")).collect()}
    assert [ranks[0]] == plain_ids("the")


def test_query_equals_the_tokenizer(spark, duck, sf_dir):
    from stakescore.llm.catalog import registered

    rows = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    got = registered()["op1_token_files"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(tuple(r) for r in got) == [r[:4] for r in wanted(rows, 2)]


@pytest.mark.parametrize("numbers", [[0], [255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1]])
def test_byte_boundaries(numbers):
    assert token_files.unpack(*token_files.pack(np.array(numbers, "<u4")), len(numbers)).tolist() == numbers
