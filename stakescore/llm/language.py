"""Language identification by compression.

For each language there is a zstandard dictionary of raw text, in lower case. A text is compressed with each of them, in
chunks so that the dictionary counts throughout a long text, and gets the language of the smallest sum.
Where the runner-up comes within ``MARGIN`` of it, the text is rejected.

The dictionaries are cut from about ``SAMPLE`` training texts a language at most (``SHARE`` bytes of each), and from less of each where
there are so many languages that all would exceed ``TOTAL`` bytes; these bounds hold at any size of the corpus. Texts are scored
whole, each where it lies: no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, functions as F

from stakescore.llm.split import held_out, sampled
from stakescore.llm.texts import added

SAMPLE = 256
SHARE = 1024
#: Bytes of all dictionaries, which pass the driver.
TOTAL = 1 << 24
CHUNK = 1024
#: Saving over the runner-up, as a part of its size, below which a text is rejected.
MARGIN = 0.004
LEVEL = 6
#: Behind the last chunk, as a chunk that would not get smaller is stored as it is, whatever the dictionary.
FILLER = b"\n" * 200
UNKNOWN = "und"

#: Of Unicode's letter categories; signs of numbers are none.
LETTER = regex.compile(r"\p{L}").search


def dictionaries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Raw dictionary content by language, from the rows that are not held out.

    The rows are chosen by id alone; then only the chosen ones' texts are read. What reaches the driver is
    ``TOTAL`` bytes at most, whatever the number of rows and languages.
    """
    known = docs.select(
        F.col(doc_id).alias("id"), F.col(lang).alias("language"), F.col(text).alias("words")
    ).filter(~held_out("id") & F.col("language").isNotNull() & F.col("words").isNotNull())
    languages = max(1, known.agg(F.approx_count_distinct("language")).first()[0])
    share = max(1, min(SHARE, TOTAL // (2 * languages)))
    most = max(1, min(SAMPLE, TOTAL // (2 * languages * share)))
    chosen = sampled(known.select("id", "language"), "language", "id", most)
    begin = F.lit(1) + F.pmod(F.xxhash64("id", "language"), F.greatest(F.length("words") - share, F.lit(1)))
    texts = known.join(F.broadcast(chosen), ["id", "language"]).groupBy("id", "language").agg(
        F.min(F.substring("words", begin.cast("int"), F.lit(share))).alias("words")  # of rows of equal id, one
    )
    content: dict[str, list[bytes]] = {}
    for row in sorted(texts.collect(), key=lambda r: r["id"]):
        if LETTER(row["words"]):
            content.setdefault(row["language"], []).append(row["words"].lower().encode()[:share])
    return {language: b"\n".join(parts[:most]) for language, parts in sorted(content.items())}


class Classifier:
    """The languages' compressors."""

    def __init__(self, content: dict[str, bytes]):
        self.languages = list(content)
        self.compress = []
        for raw in content.values():
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False,
            ).compress)

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of a whole text by language."""
        raw = text.lower().encode()
        chunks = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]
        chunks[-1] += FILLER
        return [sum(len(squeeze(c)) for c in chunks) for squeeze in self.compress]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and margin; ``und`` and 0 for a text that is null or has no letter."""
        if not text or not self.languages or not LETTER(text):
            return UNKNOWN, 0.0
        sizes = self.sizes(text)
        best = int(np.argmin(sizes))  # the first in alphabetical order, if several are
        if len(sizes) == 1:
            return self.languages[0], 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        return self.languages[best], 1 - sizes[best] / second


def identify(docs: DataFrame, content: dict[str, bytes], doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, rejected and, with ``carry``, its row as ``doc``.

    Other columns, whatever their names, are not read, or come inside ``doc``.

    The score rises with the margin and is 0.5 where rejection ends. A text that is null or has no letter,
    and any text where no language was learned, is ``und`` with score 0 and rejected; with one language
    learned, all others get it with a high score. Rows of equal id are scored each.
    """

    def make():
        classifier = Classifier(content)

        def columns(texts: list) -> dict[str, pa.Array]:
            found = [classifier.predict(t) for t in texts]
            margin = np.array([m for _, m in found], float)
            return {
                "lang_pred": pa.array([name for name, _ in found], pa.string()),
                "score": pa.array(margin / (margin + MARGIN), pa.float64()), "rejected": pa.array(margin < MARGIN, pa.bool_()),
            }

        return columns

    scored = added(docs, doc_id, text, make, "lang_pred string, score double, rejected boolean", carry)
    return scored.withColumn("held_out", held_out())


def language_id(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", carry: bool = False) -> DataFrame:
    """:func:`identify` by the dictionaries that the documents themselves give."""
    return identify(docs, dictionaries(docs, doc_id, text, lang), doc_id, text, carry)
