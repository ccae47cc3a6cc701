"""Memory of Python workers, which Spark hands from one operator to the next."""

import gc
import time
import tracemalloc
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from stakescore.llm import texts, toxicity, word_ids

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def labelled(rows, words):
    chance = np.random.default_rng(rows)
    return pa.record_batch({
        "toxic": pa.array(np.arange(rows) % 3 == 0).cast(pa.int32()), "calibrate": pa.array([False] * rows), "language": pa.nulls(rows, pa.string()),
        "words": pa.array([chance.integers(0, toxicity.BUCKETS**3, words).astype("<i8").tobytes() for _ in range(rows)], pa.binary()),
    })


def test_learning_frees_what_packing_keeps():
    encoder = word_ids.word_encoder(TOKENIZER)
    assert encoder is word_ids.word_encoder(TOKENIZER) and encoder.encode("Some words")
    alive = weakref.ref(encoder)
    del encoder
    assert list(toxicity.held(iter([]))) == []
    assert alive() is None
    assert word_ids.word_encoder(TOKENIZER).encode("Some words")


def test_no_encoder_is_left_where_texts_are_scored(spark, docs_of):
    def load(batches):
        for batch in batches:
            time.sleep(0.2)
            word_ids.word_encoder(TOKENIZER).encode("one two")
            yield batch.select(["doc_id"])

    assert spark.range(32).selectExpr("id doc_id").repartition(32).mapInArrow(load, "doc_id long").count() == 32

    def make():
        left = sum(type(x).__name__ == "WordEncoder" for x in gc.get_objects())
        return lambda some: {"encoders": pa.array([left] * len(some), pa.int32())}

    docs = docs_of([(i, f"text {i}", "en", "s") for i in range(64)]).repartition(16)
    got = texts.added(docs, "doc_id", "text", make, "encoders int", carry=False).collect()
    assert sorted(map(tuple, got)) == [(i, 0) for i in range(64)]


def test_texts_are_held_in_bounded_memory_and_the_same_groups(monkeypatch):
    monkeypatch.setattr(toxicity, "HELD", 1 << 14)
    large = labelled(3000, 800)  # 19 MB
    tracemalloc.start()
    groups = [(len(counts), int(counts.sum()), int(rows.sum()), labels.sum(), names) for rows, counts, labels, names in toxicity.held(iter([large]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6_000_000
    assert sum(g[0] for g in groups) == 3000 and all(g[1] == 800 * g[0] and g[1] < (1 << 14) + 800 for g in groups)
    small = [large.slice(i, 7) for i in range(0, 3000, 7)]
    again = [(len(counts), int(counts.sum()), int(rows.sum()), labels.sum(), names) for rows, counts, labels, names in toxicity.held(iter(small))]
    assert groups == again


@pytest.mark.parametrize("sent", [1 << 13, 100])
def test_models_sent_in_parts_average_alike(spark, docs_of, monkeypatch, sent):
    monkeypatch.setattr(toxicity, "SENT", sent)
    words = spark.createDataFrame(pa.Table.from_batches([labelled(90, 20)])).coalesce(1)
    own = toxicity.Training(toxicity.begun(np.ones((2, 3 * toxicity.BUCKETS + 1)), 30, 60), 1 / 3)
    [(rows, counts, labels, _)] = toxicity.held(iter(words.toArrow().to_batches()))
    plain = toxicity.Training(toxicity.begun(np.ones((2, 3 * toxicity.BUCKETS + 1)), 30, 60), 1 / 3)
    plain.learn(rows, counts, labels, np.random.default_rng([11, 0]))
    toxicity._passed(words, own, 0)
    assert (own.model.table == plain.model.table).all() and (own.squares == plain.squares).all()
    assert np.allclose(own.dense(), plain.dense()) and own.steps == plain.steps


def test_a_full_vocabulary_gives_the_same_rows(monkeypatch):
    some = [f"w{i} w{i % 9} Ünï" for i in range(60)]
    rows, counts = toxicity.word_rows(some, toxicity.Vocabulary())
    monkeypatch.setattr(toxicity, "REMEMBERED", 10)
    vocabulary = toxicity.Vocabulary()
    parts = [toxicity.word_rows(some[i : i + 5], vocabulary) for i in range(0, 60, 5)]
    assert (np.concatenate([r for r, _ in parts]) == rows).all() and len(vocabulary) < 40 and counts.sum() == len(rows)
