"""The pipeline against brute-force versions of its stages."""

import numpy as np
import pytest

import corpus_pipeline
from stakescore.llm import language, line_dedup, simhash, toxicity
from tests.conftest import TESTDATA
from tests.llm.test_exact_and_lines import plain_lines
from tests.llm.test_packing import lower_bound, plain_pieces, sequences
from tests.llm.test_simhash import plain_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns at sf0.01, the documents first."""
    from stakescore.staging import written

    folder = f"{TESTDATA}/sf0.01"
    found = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], folder), name))
    return found


def test_stages_return_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "line_dedup", "near_duplicates", "packing"]
    for df in stages[:-1]:
        assert df.columns == COLUMNS and df.dtypes == stages[0].dtypes
    counts = [df.count() for df in stages[:-1]]
    assert counts[0] > counts[1] >= counts[2] == counts[3] > counts[4] > 0


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_documents_found_toxic_go_and_others_stay(spark, stages, duck_at):
    """How many are found depends on the labels, of which this scale has few: see test_models."""
    marked = dict(duck_at("sf0.01").sql("SELECT doc_id, toxic FROM labels").fetchall())
    before, after = rows(stages[0]), rows(stages[1])
    assert all(after[i] == before[i] for i in after)
    scored = toxicity.toxicity(stages[0], spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")).collect()
    gone = {r["doc_id"] for r in scored if r["predicted"]}
    assert set(before) - set(after) == gone
    assert sum(marked[i] for i in gone if i in marked) > 0.5 * sum(marked.values())
    assert sum(1 - marked[i] for i in gone if i in marked) / sum(1 - t for t in marked.values()) < 0.02


def test_documents_of_no_language_go(stages):
    classifier = language.Classifier(language.dictionaries(stages[1]))
    wanted = {i for i, r in rows(stages[1]).items() if classifier.predict(r["text"])[1] >= language.MARGIN}
    assert set(rows(stages[2])) == wanted and len(wanted) > 0.98 * stages[1].count()


def test_repeated_lines_go(stages):
    before, after = rows(stages[2]), rows(stages[3])
    want = plain_lines([(i, r["text"], r["source"]) for i, r in before.items()], line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert {i: r["text"] for i, r in after.items()} == {i: t for i, t, _, _ in want}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_one_of_each_near_duplicate_group_stays(stages):
    prints = {i: simhash.fingerprint(r["text"], 4) for i, r in rows(stages[3]).items()}
    smallest = plain_groups(prints)
    assert set(rows(stages[4])) == {i for i in prints if smallest[i] == i}


def test_all_pieces_are_packed(stages):
    want = [p[:5] for p in plain_pieces([(i, r["text"]) for i, r in rows(stages[4]).items()], corpus_pipeline.CAPACITY)]
    got = stages[5].collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert sequences(got, corpus_pipeline.CAPACITY) <= lower_bound([p[3] for p in want], corpus_pipeline.CAPACITY) + 1


def test_odd_rows_pass_through(spark, docs_of, tmp_path):
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = docs_of([(1, "some words here", "en", "a"), (None, "some words here", "en", "a"), (2, None, None, None),
                    (3, "", None, "a"), (4, "some words here", None, None), (4, "some words here", None, None)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    assert sorted((r["doc_id"] for r in docs.collect()), key=repr) == [1, None]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len(packed) == 2 and len({r["sequence_id"] for r in packed}) == 1
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.collect() == []


def test_copies_of_a_text_are_no_boilerplate(spark, docs_of):
    """Three copies among 20 pages of a source keep their text; a line of many texts goes."""
    rows = [(i, f"menu\nbody {i}", "en", "a") for i in range(17)] + [(100 + i, "a whole text\nthat was copied", "en", "a") for i in range(3)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, docs_of(rows), "").collect()}
    assert got == {i: f"body {i}" for i in range(17)} | {100 + i: "a whole text\nthat was copied" for i in range(3)}


def test_repeated_ids_go_by_their_text(spark, docs_of):
    """A unique text stays though its id has a near duplicate elsewhere; a kept id stays once in its component."""
    base, other, third = (" ".join(f"{w}{i * 7 % 101}" for i in range(200)) for w in ("one", "two", "three"))
    rows = [(1, base), (3, base), (3, other), (5, third), (5, third), (None, base)]
    got = corpus_pipeline.drop_near_duplicates(spark, docs_of(rows), "").select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, base), (3, other), (5, third), (None, base)], key=repr)


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, f"{TESTDATA}/sf0.01").collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in got) == sorted(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages[-1].collect())
    assert np.isclose(sum(r["length"] for r in got), sum(r["length"] for r in stages[-1].collect()))
