"""Language identification by compression.

Each language gets a zstandard raw-content dictionary cut from labelled text. A text is
compressed block by block with every dictionary, and the language whose dictionary gives
the fewest bytes wins. The score is the share of bytes saved against the second best; a
narrow one is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from streamlake.llm.tasks import released

DICTIONARY_BYTES = 256 << 10  # per language
SAMPLE_DOCS = 512  # labelled documents per language, the bound of the sample
DRAWN = 4  # documents per place of the sample that are drawn and ranked
_DRAW = 1 << 30
EXCERPT_CHARS = 512  # taken from the middle of each of them
BLOCK_BYTES = 4096  # texts are compressed in blocks, so a long text cannot become its own dictionary
LEVEL = 9
MIN_MARGIN = 0.01
UNDETERMINED = "und"


def sample_texts(labelled: DataFrame, order: Column) -> DataFrame:
    """(lang, excerpt): the bounded training sample, the first documents of each language in
    the given order among those drawn.

    The draw, by hash, leaves each language some ``DRAWN`` times the sample over all tasks
    together, so however many tasks there are, few rows of a language meet.
    """
    length = F.length("text")
    middle = F.greatest(F.lit(1), ((length - EXCERPT_CHARS) / 2).cast("int") + 1)
    usable = labelled.filter(F.col("lang").isNotNull() & (length > 0))
    sizes = usable.groupBy("lang").agg((SAMPLE_DOCS * DRAWN / F.count(F.lit(1))).alias("_share"))
    draw = F.pmod(F.xxhash64("_order", "excerpt"), F.lit(_DRAW)) / _DRAW
    return (
        usable.select("lang", F.substring(F.col("text"), middle, F.lit(EXCERPT_CHARS)).alias("excerpt"), order.alias("_order"))
        .join(F.broadcast(sizes), "lang")  # a row per language; each gets a dictionary on the driver
        .filter(draw <= F.col("_share"))
        .withColumn("_rank", F.row_number().over(W.partitionBy("lang").orderBy("_order", "excerpt")))
        .filter(F.col("_rank") <= SAMPLE_DOCS)
        .select("lang", "excerpt", "_rank")
    )


def train(labelled: DataFrame, order: Column) -> dict[str, bytes]:
    """Dictionary content by language, at most ``DICTIONARY_BYTES`` each.

    The driver receives ``SAMPLE_DOCS`` excerpts of ``EXCERPT_CHARS`` per language.
    The content nearest to the end of a dictionary is the cheapest to refer to.
    """
    parts: dict[str, list[bytes]] = {}
    for row in sample_texts(labelled, order).orderBy("lang", "_rank").collect():
        parts.setdefault(row["lang"], []).append(plain(row["excerpt"]))
    return {lang: b" ".join(found)[:DICTIONARY_BYTES] for lang, found in parts.items()}


# ASCII characters other than letters count as spaces.
_PLAIN = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def plain(text: str) -> bytes:
    """UTF-8 in lower case with ASCII digits, marks and white space as spaces, so that capitals
    or symbols do not decide."""
    return text.lower().encode().translate(_PLAIN)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Classifier:
    """Compressors of one worker."""

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.languages = sorted(dictionaries)
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        self._compressors = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=params)
            self._compressors.append(zstandard.ZstdCompressor(dict_data=content, compression_params=params))

    def classify(self, text: str | None) -> tuple[str, float]:
        """(language, score); no text, no letter or no dictionary gives ``und`` and 0."""
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        data = plain(text)
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self._compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)  # the first name between equals
        others = sizes[:best] + sizes[best + 1 :]
        second = min(others) if others else 2 * sizes[best]
        return self.languages[best], 1 - sizes[best] / second


def predict(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """Adds lang_pred, score (0 to 1) and rejected (score below ``min_margin``) to ``docs``.

    Only ``text`` is used. Null, empty and letterless texts are ``und`` with score 0,
    rejected; equal sizes go to the first language name. Columns of these names, in any case,
    are replaced. The dictionaries are bounded by ``train``.
    """
    added = ("lang_pred", "score", "rejected")
    own = [c for c in docs.columns if c.lower() not in added]
    schema = docs.select(*own).schema
    for name, kind in zip(added, ("string", "double", "boolean")):
        schema = schema.add(name, kind)
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value)
        for batch in batches:
            found = [model.classify(t.as_py()) for t in batch.column("text")]
            langs, scores = ([f[i] for f in found] for i in (0, 1))
            columns = [*batch.select(own).columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            columns.append(pa.array([s < min_margin for s in scores], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[*own, *added])

    return docs.select(*own).mapInArrow(released(run), schema)
