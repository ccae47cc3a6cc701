"""Language identification and toxicity: held-out accuracy, and defined results for odd input."""

import zlib

import numpy as np
import pytest

from stakescore.llm import language, toxicity
from stakescore.llm.catalog import registered
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD_TEXTS


def out_of_five(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_language_of_held_out_documents(spark, duck_at):
    known = dict(duck_at("sf0.01").sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = registered()["op4_language_id"](spark, f"{TESTDATA}/sf0.01").collect()
    assert len(rows) == len(known) and {r["held_out"] for r in rows if out_of_five(r["doc_id"])} == {True}
    held = [r for r in rows if r["held_out"]]
    assert len(held) == sum(map(out_of_five, known))
    assert np.mean([r["lang_pred"] == known[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["rejected"] for r in rows]) < 0.02


LATIN = {"en": "the quick brown fox jumps over the lazy dog and then goes home", "fr": "le renard brun saute par dessus le chien et rentre chez lui"}


def training(each=30):
    return [(i, f"{text} {i}", lang, None) for i, (lang, text) in enumerate(list(LATIN.items()) * each)]


def test_languages_of_odd_texts(docs_of):
    odd = [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(2000, LATIN["fr"]), (2001, LATIN["en"]), (2001, LATIN["en"]), (None, LATIN["fr"])]
    got = language.language_id(docs_of(training() + odd)).collect()
    assert len(got) == 60 + len(odd)
    by = {r["doc_id"]: r for r in got}
    for i, text in odd[: len(ODD_TEXTS)]:
        assert (by[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert by[i]["score"] == 0 or by[i]["lang_pred"] != "und"
    assert (by[2000]["lang_pred"], by[2001]["lang_pred"], by[None]["lang_pred"]) == ("fr", "en", "fr")
    assert by[None]["held_out"] is False


def test_no_language_to_learn(docs_of):
    got = language.language_id(docs_of([(1, "some text", None, None), (2, "more", None, None)])).collect()
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in got} == {("und", 0.0, True)}
    assert language.language_id(docs_of([])).collect() == []


def test_languages_are_not_learned_from_held_out_rows(docs_of):
    held = [i for i in range(200) if out_of_five(i)]
    got = language.dictionaries(docs_of([(i, "texte tenu", "fr", None) for i in held] + [(1, "text", "en", None)]))
    assert set(got) == {"en"}


def test_the_sample_is_bounded(docs_of, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 5)
    rows = [(i, "lorem ipsum " * 200, "la", None) for i in range(300)] + [(7, "lorem ipsum twice", "la", None)] * 50
    content = language.dictionaries(docs_of(rows))["la"]
    assert 0 < len(content) <= 5 * (language.SHARE + 1)


def test_samples_hold_about_what_is_asked_of_each_group(spark):
    from stakescore.llm.split import sampled

    rows = spark.createDataFrame([(i, "ab"[i % 10 == 0], 1) for i in range(5000)] + [(i, None, 1) for i in range(30)] + [(7, "a", 1)] * 900, "id long, g string, count int")
    got = sampled(rows, "g", "id", 100).collect()
    assert len(got) == len(set(got)) and sum(r["g"] is None for r in got) == 30
    assert all(50 < sum(r["g"] == g for r in got) < 150 for g in "ab")


def plain_answers(model, rows):
    """Largest answer of each filter over all windows of one text."""
    seen = model.table[rows].reshape(len(rows), 3 * toxicity.DIM).astype(float)
    seen = np.concatenate([seen, np.zeros((2, seen.shape[1]))])
    best = []
    for i, width in enumerate(toxicity.WIDTHS):
        kernel = model.filters[width].reshape(width, -1, toxicity.FILTERS)
        bias = model.bias[i * toxicity.FILTERS : (i + 1) * toxicity.FILTERS]
        answers = [sum(seen[t + k] @ kernel[k] for k in range(width)) + bias for t in range(len(rows))]
        best.append(np.maximum(np.max(answers, axis=0), 0) if len(rows) else np.zeros(toxicity.FILTERS))
    return np.concatenate(best)


@pytest.mark.parametrize("counts", [[3, 0, 1, 120, 2, 0], [0], [1], [200], []])
def test_filters_over_whole_texts(monkeypatch, counts):
    monkeypatch.setattr(toxicity, "BUCKETS", 64)
    monkeypatch.setattr(toxicity, "STRETCH", 50)
    chance = np.random.default_rng(len(counts))
    model = toxicity._start(chance.integers(0, 192, (50, 3)), np.array([20, 30]), np.array([0.0, 1.0]))
    model.table[:-1] = chance.normal(size=(192, toxicity.DIM))
    for kernel in model.filters.values():
        kernel[:] = chance.normal(size=kernel.shape)
    counts = np.array(counts, int)
    rows = chance.integers(0, 192, (counts.sum(), 3)).astype(np.int32)
    strengths = model.strengths(rows, counts)
    best, where = model.windows(rows, counts)
    assert np.allclose(best, strengths)
    for i, begin in enumerate(np.cumsum(counts) - counts):
        assert np.allclose(strengths[i], plain_answers(model, rows[begin : begin + counts[i]]), atol=1e-3)
        assert all(w < 0 or begin <= w < begin + counts[i] for w in where[i])


def test_toxicity_of_held_out_documents(spark, duck_at):
    marked = dict(duck_at("sf0.1").sql("SELECT doc_id, toxic FROM labels").fetchall())
    rows = registered()["op5_toxicity"](spark, f"{TESTDATA}/sf0.1").collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marked]
    hit = sum(r["predicted"] and marked[r["doc_id"]] for r in held)
    assert hit / sum(marked[r["doc_id"]] for r in held) > 0.8
    assert hit / sum(r["predicted"] for r in held) > 0.9


def toxic_corpus():
    """Every third text has a telling word somewhere in a long one."""
    chance = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(400):
        words = [f"w{n}" for n in chance.integers(0, 400, chance.integers(5, 80))]
        if i % 3 == 0:
            words.insert(int(chance.integers(0, len(words))), ["Vile!", "nasty,"][i % 2])
        rows.append((i, " ".join(words), "en", None))
        labels.append((i, 1, int(i % 3 == 0)))
    return rows, labels


def test_telling_words_in_any_place(spark, docs_of):
    rows, labels = toxic_corpus()
    odd = [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(2000, "w1 " * 30_000 + "vile " + "w2 " * 30_000), (None, "so nasty"), (5, "w9")]
    marks = spark.createDataFrame(labels + [(None, 1, 1), (9999, 1, 0), (17, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs_of(rows + odd), marks).collect()
    assert len(got) == len(rows) + len(odd)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in held]) > 0.97
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert by[2000] == 1 and by[None] == 1
    assert not any(by[1000 + i] for i in range(len(ODD_TEXTS)))


@pytest.mark.parametrize("kinds", [[], [0], [1]])
def test_labels_of_one_kind_teach_nothing(spark, docs_of, kinds):
    rows = [(i, f"text {i}", "en", None) for i in range(20)]
    marks = spark.createDataFrame([(i, kinds[0]) for i in range(20)] if kinds else [], "doc_id long, toxic int")
    got = toxicity.toxicity(docs_of(rows), marks).collect()
    assert {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)}
    assert toxicity.toxicity(docs_of([]), marks).collect() == []


def test_carried_rows_come_whole(docs_of):
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD_TEXTS)]
    docs = docs_of(rows)
    got = language.language_id(docs, carry=True).select("doc.*")
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


@pytest.mark.parametrize("text", ["½", "² 3", "Ⅷ", "①", "٣", "_", "12 €", "́"])
def test_signs_of_numbers_are_no_letters(text):
    assert language.Classifier({"en": b"some text", "fr": b"du texte"}).predict(text) == ("und", 0.0)


def test_languages_by_plain_compression():
    """Each chunk compressed anew with each raw dictionary; the least sum wins, and the margin is over the next."""
    import zstandard

    content = {name: " ".join([text] * 3).encode() for name, text in LATIN.items()} | {"x": b"zzz qqq"}
    classifier = language.Classifier(content)
    chance = np.random.default_rng(4)
    texts = [" ".join(chance.choice(" ".join(LATIN.values()).split(), n)) for n in (1, 3, 20, 200, 2000)] + [t for t in ODD_TEXTS if t]
    for text in texts:
        raw = text.lower().encode()
        parts = [raw[i : i + language.CHUNK] for i in range(0, len(raw), language.CHUNK)]
        parts[-1] += language.FILLER
        sizes = {}
        for name, words in content.items():
            dictionary = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=language.LEVEL)
            sizes[name] = sum(
                len(zstandard.ZstdCompressor(
                    level=language.LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False,
                ).compress(part)) for part in parts
            )
        if language.LETTER(text):
            ordered = sorted(sizes, key=lambda name: (sizes[name], name))
            assert classifier.predict(text) == (ordered[0], 1 - sizes[ordered[0]] / sizes[ordered[1]])


def test_many_languages_stay_within_the_bound(docs_of):
    rows = [(i, f"word{i} " * 300, f"l{i % 2000}", None) for i in range(4000)]
    content = language.dictionaries(docs_of(rows))
    assert len(content) > 1800 and sum(map(len, content.values())) <= language.TOTAL


def test_a_very_long_text_teaches_a_bounded_part(spark, docs_of, monkeypatch):
    monkeypatch.setattr(toxicity, "LONGEST", 400)
    rows, labels = toxic_corpus()
    rows[4] = (4, "word " * 2_000_000, "en", None)
    model, _ = toxicity.learn(docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert model.thresholds


def test_few_calibration_texts_borrow_from_other_languages(monkeypatch):
    rows, labels = toxic_corpus()
    texts, kinds = [r[1] for r in rows], np.array([t for _, _, t in labels])
    names = ["few" if i < 8 else "many" for i in range(len(texts))]
    model = toxicity.fit(texts, kinds, names, 0.3)
    assert set(model.thresholds) == {"few", "many"} and np.isfinite(list(model.thresholds.values())).all()


@pytest.mark.parametrize("each", [2_048, 40])
def test_every_word_of_every_labelled_text_teaches(spark, docs_of, monkeypatch, each):
    """Also with several tasks, whose models are averaged."""
    monkeypatch.setattr(toxicity, "TEXTS_PER_TASK", each)
    rows, labels = toxic_corpus()
    rows[4] = (4, "w1 " * 30_000 + "last", "en", None)
    seen = {}

    def spy(name):
        real = getattr(toxicity, name)

        def run(texts, *more):
            seen[name] = texts.selectExpr("count(*)", "sum(length(words)) div 8").first()
            return real(texts, *more)

        monkeypatch.setattr(toxicity, name, run)

    spy("_passed")
    spy("_limited")
    got = toxicity.toxicity(docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    taught = [t for i, t, _, _ in rows if not out_of_five(i)]
    assert sum(s[0] for s in seen.values()) == len(taught)
    assert sum(s[1] for s in seen.values()) == sum(len(toxicity.WORDS(t)) for t in taught)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in held]) > 0.97


def test_packed_words_are_their_rows():
    rows = np.array([toxicity.hashed(w) for w in ("a", "vile", "日本語", "x" * 900)], np.int32)
    assert (toxicity.unpacked(toxicity.packed(rows)) == rows).all()
