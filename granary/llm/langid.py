"""Language identification by compression.

Each language has a zstandard dictionary of raw content, drawn from a bounded sample of labelled
texts. A text is lower-cased and reduced to its words, cut into blocks, every block is compressed
against every dictionary, and the language whose blocks come out smallest in total wins; so a
dictionary bears on all of a long text and not on its start alone. A text whose two best totals
are nearly equal is *rejected*: it is no text in any one of the languages. Texts of less than
``SHORT`` bytes are searched for shorter matches, behind a run of spaces, as zstandard stores
a tiny block uncompressed; sizes in whole bytes are coarse there, so their margin is counted in
bytes: they are rejected where no more than ``SHORT_MARGIN`` lies between the two best.

Defined cases: a null text, an empty one and one without a letter have language ``und``, score 0 and
are rejected; so has every text where no language was learned (an empty table, no labels). Equal
totals go to the smaller language name. Null and repeated ids stay, row by row; no column but the
named ones is read. A text of any length is compressed whole, block by block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from granary.llm.common import extended, numbered, rounds

UNKNOWN = "und"
#: The bound of the labelled sample: texts for each language, and bytes of each.
SAMPLE_TEXTS, SAMPLE_BYTES, PARTS = 256, 512, 64
BLOCK, LEVEL, SHORT = 1024, 6, 256
LEAD = b" " * 200
#: The share, and in short texts the bytes, by which the second-best total must exceed the best. On a quarter of sf0.1 the
#: narrowest of 2,389 longer documents had 0.0125; of 111 short ones eight had no byte and none had one.
MARGIN, SHORT_MARGIN = 0.012, 1
LETTER = re.compile(r"[^\W\d_]")
#: ASCII but for letters becomes a space; other letters are non-ASCII bytes, which stay.
LETTERS = bytes(c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(LETTERS).split())


def piece_of(text: str, size: int) -> bytes:
    """At most ``size`` bytes of the sample, cut where a character ends."""
    return words_of(text)[:size].decode("utf-8", "ignore").encode()


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        texts: int = SAMPLE_TEXTS, size: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """A dictionary for each language: at most ``texts`` pieces of at most ``size`` bytes.

    The sample is drawn by a hash of the id, and a piece from inside its text by a hash of the
    text, so it is the same in every run and at every partitioning. It holds
    ``texts * size`` bytes a language at most, which bounds what the driver gets.
    """
    rows = labelled.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    key = F.xxhash64(F.lit("language sample"), F.col("id"))
    room = F.greatest(F.length("text") - size, F.lit(0)) + 1
    piece = F.substring("text", F.pmod(F.xxhash64("text"), room).cast("int") + 1, F.lit(size))
    picked = rows.select("lang", key.alias("key"), F.xxhash64("text").alias("tie"), piece.alias("piece"))
    # first within parts of a language, so that no task ranks what all tasks send of one language
    picked = picked.withColumn("part", F.pmod("key", F.lit(PARTS)))
    for groups in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*groups).orderBy("key", "tie")
        picked = picked.withColumn("place", F.row_number().over(order)).where(F.col("place") <= texts)
    out: dict[str, list[bytes]] = {}
    for row in picked.orderBy("lang", "place").collect():
        out.setdefault(row.lang, []).append(piece_of(row.piece, size))
    return {lang: b" ".join(pieces) for lang, pieces in out.items()}


class Sizes:
    """Compressed sizes of texts against each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        usual = {"compression_level": LEVEL}
        thorough = {"compression_level": 12, "min_match": 3, "strategy": zstandard.STRATEGY_BTLAZY2}
        self.usual, self.thorough = ([self._compressor(dictionaries[x], kind) for x in self.languages] for kind in (usual, thorough))

    @staticmethod
    def _compressor(content: bytes, settings: dict[str, int]) -> zstandard.ZstdCompressor:
        chosen = dict(settings)
        level = chosen.pop("compression_level")
        parameters = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=0, write_dict_id=0, **chosen)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)

    def __call__(self, text: bytes) -> list[int]:
        if len(text) < SHORT:
            return [len(c.compress(LEAD + b" " + text + b" ")) for c in self.thorough]
        blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
        return [sum(len(c.compress(block)) for block in blocks) for c in self.usual]


def verdict(languages: list[str], sizes: list[int], length: int, margin: float) -> tuple[str, float, bool]:
    """Language, posterior and rejection from total sizes; a size is a code length in bytes."""
    if not languages:
        return UNKNOWN, 0.0, True
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i], languages[i]))
    best = sizes[order[0]]
    score = 1.0 / float(np.exp2(np.clip((best - np.array(sizes, float)) * 8, -1000, 0)).sum())
    narrow = len(order) > 1 and sizes[order[1]] - best <= (margin * sizes[order[1]] if length >= SHORT else SHORT_MARGIN)
    return languages[order[0]], score, bool(narrow)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_column: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows with ``lang_pred``, ``lang_score`` and ``lang_rejected``, which replace columns of these names.

    The other columns pass through; the dictionaries, of bounded size, go with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    kept, schema = extended(docs, "lang_pred string, lang_score double, lang_rejected boolean")
    where, names = kept.columns.index(text_column), schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value)
        for whole in batches:
            for batch in rounds([numbered(whole)], str(where)):
                found = []
                for text in batch.column(where).to_pylist():
                    if text is None or not LETTER.search(text):
                        found.append((UNKNOWN, 0.0, True))
                    else:
                        words = words_of(text)
                        found.append(verdict(sizes.languages, sizes(words), len(words), margin))
                columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    return kept.mapInArrow(run, schema)
