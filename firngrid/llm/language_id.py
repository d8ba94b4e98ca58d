"""Language identification by compression.

Each language has a raw-content zstandard dictionary made from a bounded sample of
its texts. A text is cut into blocks, each block is compressed with every
dictionary, and the language with the smallest total wins. The margin to the runner
up, per byte of the smaller total, gives the score; a narrow margin sets
``rejected``, for callers who would rather have no answer than a weak one.

Only lower-cased letters and single spaces are compressed, in the dictionaries too, so
that capitals, numbers and runs of marks tell nothing.
Blocks keep the dictionary's share alike over the whole of a long text, whose own
history would else outweigh it.

Defined results: a null text, or one without a letter (Unicode category L), is ``und`` with score 0 and is
rejected; ties go to the language with more training rows, then to the one that sorts first; training rows with null text or
language are ignored; with no training rows at all every text is ``und``; repeated
rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firngrid.llm.texts import map_batches, thinned

UNKNOWN = "und"
#: Documents of each language that its dictionary is made from, at most.
SAMPLE_DOCS = 96
#: Characters taken from each of them, and bytes of a dictionary, at most.
SAMPLE_CHARS = 4_000
DICTIONARY_BYTES = 112_000
BLOCK_BYTES = 2_048
LEVEL = 6
#: Below this margin, as a share of the best total, a prediction is rejected.
NARROW = 0.01
_LETTER = regex.compile(r"\p{L}")
_REST = re.compile(r"[\W\d_]+")


def plain(text: str) -> bytes:
    """Lower-cased letters, anything else as one space."""
    return _REST.sub(" ", text.lower()).encode()


def spread(data: bytes, share: int, pieces: int = 4) -> bytes:
    """``data``, or ``share`` bytes of it in pieces from its whole length."""
    if len(data) <= share:
        return data
    size = share // pieces
    step = (len(data) - size) / (pieces - 1)
    return b" ".join(data[int(k * step) : int(k * step) + size] for k in range(pieces))


def train(
    labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES
) -> dict[str, bytes]:
    """A raw dictionary for each value of ``lang`` in ``labelled (text, lang)``.

    The languages are in the order of their training rows, most first.

    At most ``sample_docs`` texts of a language are used, those with the least hashes; all
    but a few times as many are cut by the hash before they are moved. Of a text that is longer
    than its share, SAMPLE_CHARS characters and then the share come from all along it.
    """
    usable = labelled.select("lang", "text").where("lang is not null and length(text) > 0")
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return {}
    near = thinned(usable.withColumn("h", F.xxhash64("text")), sample_docs, "lang")
    order = Window.partitionBy("lang").orderBy("h")
    size = SAMPLE_CHARS // 4
    starts = [F.floor((F.length("text") - size) * k / 3).cast("int") + 1 for k in range(4)]
    whole = F.length("text") <= SAMPLE_CHARS
    sliced = F.when(whole, F.col("text")).otherwise(F.concat_ws(" ", *[F.substring(F.col("text"), s, F.lit(size)) for s in starts]))
    rows = (
        near.dropDuplicates(["lang", "h"])
        .select("lang", "h", F.row_number().over(order).alias("k"), sliced.alias("text"))
        .where(F.col("k") <= sample_docs)
        .orderBy("lang", "h")
        .collect()
    )
    pieces: dict[str, dict[bytes, None]] = {}
    for row in rows:
        pieces.setdefault(row.lang, {})[plain(row.text)] = None
    made = {}
    for lang in sorted(pieces, key=lambda x: (-counts[x], x)):
        texts = pieces[lang]
        share = max(256, dictionary_bytes // len(texts))
        made[lang] = b" ".join(spread(t, share) for t in texts)[:dictionary_bytes]
    return made


class CompressionClassifier:
    """Compressors of all languages, and the choice between them."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = list(dictionaries)
        self.coders = []
        for lang in self.languages:
            held = zstandard.ZstdCompressionDict(
                dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            held.precompute_compress(level=LEVEL)
            self.coders.append(
                zstandard.ZstdCompressor(
                    dict_data=held, write_checksum=False, write_content_size=False
                )
            )

    def sizes(self, text: str) -> list[int]:
        """Total compressed bytes of the whole text, by language."""
        data = plain(text)
        blocks = [data[k : k + BLOCK_BYTES] for k in range(0, len(data), BLOCK_BYTES)]
        return [sum(len(coder.compress(b)) for b in blocks) for coder in self.coders]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """``(language, score, rejected)``."""
        if not text or not self.coders or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)  # the first of equals
        rest = min((s for k, s in enumerate(sizes) if k != best), default=2 * sizes[best])
        margin = (rest - sizes[best]) / max(1, sizes[best])
        return self.languages[best], 1.0 - math.exp(-20.0 * margin), margin < NARROW


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: dict[str, Column]) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``lang_pred``, ``score`` and ``rejected``.

    ``keep`` holds boolean columns by name that go along with a row.
    """
    names = list(keep)

    def batch(rows):
        own = CompressionClassifier(dictionaries)
        found = [own.predict(text) for text in rows["text"]]
        return {
            "doc_id": rows["doc_id"],
            **{n: rows[n] for n in names},
            "lang_pred": [f[0] for f in found],
            "score": [f[1] for f in found],
            "rejected": [f[2] for f in found],
        }

    return map_batches(
        docs.select("doc_id", "text", *[c.alias(n) for n, c in keep.items()]),
        batch,
        "doc_id long, "
        + "".join(f"{n} boolean, " for n in names)
        + "lang_pred string, score double, rejected boolean",
    )
