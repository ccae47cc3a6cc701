"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from stakescore.llm import byte_bpe
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CODER = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODER.ranks, special_tokens={})


def ids(text):
    return np.frombuffer(CODER.encode(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aabbéßñ \n\t'stll12.,!\x1c\x85 　日本́😀\r") | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_are_those_of_the_library(text):
    assert ids(text) == TIKTOKEN.encode_ordinary(text)
    assert CODER.decode(CODER.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 9_000, "abcdefghij" * 3_000, " " * 9_000 + "x", "0123456789" * 900, "ééè" * 4_000])
def test_very_long_pre_tokens(text):
    assert ids(text) == TIKTOKEN.encode_ordinary(text)


def digest(text):
    one = TIKTOKEN.encode_ordinary(text or "")
    return len(one), hashlib.sha256(np.array(one, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_digests(docs_of):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id"), (3, "again"), (3, "again")]
    got = byte_bpe.digests(docs_of(rows), PATH, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *digest(t)) for i, t in rows), key=repr)


def test_round_trip_of_a_table(docs_of):
    rows = list(enumerate(ODD_TEXTS))
    encoded = byte_bpe.encode(docs_of(rows), PATH, public_tokenizers.PATTERN)
    assert dict(map(tuple, byte_bpe.decode(encoded, PATH, public_tokenizers.PATTERN).collect())) == {i: t or "" for i, t in rows}


def test_no_documents(docs_of):
    assert byte_bpe.digests(docs_of([]), PATH, public_tokenizers.PATTERN).collect() == []


def test_query(spark, duck, sf_dir):
    from stakescore.llm.catalog import registered

    got = registered()["op3_byte_bpe"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted((i, *digest(t)) for i, t in duck.sql("SELECT doc_id, text FROM documents").fetchall())


def test_another_pattern_is_matched_as_it_says():
    pattern = r"\p{L}+|[^\p{L}]"
    own, library = byte_bpe.ByteBpe(PATH, pattern), tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=CODER.ranks, special_tokens={})
    for text in ["Hello World, fine", *filter(None, ODD_TEXTS)]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_new_pre_tokens_of_many_texts_go_through_one_queue(monkeypatch):
    coder = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    texts = [f"start qx{i}zvq, wjk{i % 7}xq\nzzq{i}.\n" + "y" * (i % 60) for i in range(200)] + [None, "", "x  y"]
    queues, merge = [], coder.merge
    monkeypatch.setattr(coder, "merge", lambda pieces: queues.append(len(pieces)) or merge(pieces))
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_all(t and t.rstrip() for t in texts)]
    assert got == [TIKTOKEN.encode_ordinary((t or "").rstrip()) for t in texts]
    assert max(queues) > 100


def test_a_merge_may_make_a_pair_of_lower_rank(tmp_path):
    tokens = [b"abc", b"cab", b"ab", b"bca", b"ca", b"abcab", *[bytes([b]) for b in b"abc"]]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % rank for rank, t in enumerate(tokens)))
    coder, library = byte_bpe.ByteBpe(str(path), public_tokenizers.PATTERN), tiktoken.Encoding(
        "low", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: rank for rank, t in enumerate(tokens)}, special_tokens={})
    pieces = ["".join(p) for n in range(1, 8) for p in product("abc", repeat=n)]
    pieces = [p for p in pieces if p.encode() not in tokens]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.merge([p.encode() for p in pieces])] == [library.encode_ordinary(p) for p in pieces]


def test_a_pattern_that_matches_nothing_adds_no_ids():
    coder = byte_bpe.ByteBpe(PATH, r"\p{L}*")
    assert coder.encode("1") == b""
    assert coder.decode(coder.encode("1qxzvq")) == b"qxzvq"
    assert coder.merge([b"", b"qxzvq", b""])[::2] == [b"", b""]
