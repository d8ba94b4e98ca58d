"""Document fingerprints from improbable features.

A feature is a window of WINDOW bytes. Its rarity is the entropy code length of its
bytes under an order-1 byte model counted over the whole corpus: the more bits, the less
probable. A window is selected where no window within REACH bytes is rarer. Selected
features go, in order and each once, into a chain of Bloom filters of BITS bits, at most
FILL features in one; the chain is the fingerprint. Two fingerprints are compared filter
by filter: the overlap of set bits, less what chance gives, as a share of the most that it
could be; each filter of the shorter chain counts with its best partner.

Defined results: null texts are as empty ones; a text shorter than a window is one
feature; an empty text has the empty fingerprint, which is like itself (1) and unlike any
other (0); equal texts have equal fingerprints; rows are in order of id, then text, nulls
first, and the last one's next is the first; a single row is its own next; empty tables
give empty tables; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firngrid.llm.texts import arrow_schema, keep_batches_small, map_batches, mixed
from firngrid.sources.shared import staged

WINDOW = 64
REACH = 32
BITS = 2048
FILL = 160
#: Bits of a filter that one feature sets.
HASHES = 5
_PAIRS = 256 * 256


def byte_model(docs: DataFrame) -> np.ndarray:
    """Code length of a byte after a byte, in sixteenths of a bit, from all texts."""
    keep_batches_small(docs.sparkSession)
    schema = "pair long, n long"
    arrow = arrow_schema(schema)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_PAIRS, np.int64)
        for b in batches:
            data = np.frombuffer("\0".join(t or "" for t in b.column(0).to_pylist()).encode(), np.uint8)
            if len(data) > 1:
                total += np.bincount(data[:-1].astype(np.int64) * 256 + data[1:], minlength=_PAIRS)
        pairs = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total[pairs])], schema=arrow)

    rows = docs.select("text").mapInArrow(counted, schema).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.full(_PAIRS, 0.5)
    for r in rows.collect():  # at most 65,536 rows
        counts[r.pair] += r.n
    table = counts.reshape(256, 256)
    bits = np.log2(table.sum(1, keepdims=True) / table)
    return np.round(16 * bits).astype(np.int32).ravel()


class Fingerprinter:
    """Selects, inserts and compares, for one byte model."""

    def __init__(self, code_length: np.ndarray):
        self.code_length = code_length

    def features(self, data: bytes) -> np.ndarray:
        """Hashes of the selected windows, in order, each once."""
        if not data:
            return np.zeros(0, np.uint64)
        if len(data) < WINDOW:
            held = np.zeros((1, WINDOW), np.uint8)
            held[0, : len(data)] = np.frombuffer(data, np.uint8)
            return self._hashes(held)
        b = np.frombuffer(data, np.uint8)
        codes = self.code_length[b[:-1].astype(np.int32) * 256 + b[1:]]
        ends = np.zeros(len(b), np.int64)
        np.cumsum(codes, out=ends[1:])
        rarity = ends[WINDOW - 1 :] - ends[: len(b) - WINDOW + 1]
        around = np.full(len(rarity) + 2 * REACH, -1, np.int64)
        around[REACH:-REACH] = rarity
        have = 1
        while have < 2 * REACH + 1:
            step = min(have, 2 * REACH + 1 - have)
            around = np.maximum(around[:-step], around[step:])
            have += step
        chosen = np.flatnonzero(rarity == around)
        found = self._hashes(np.lib.stride_tricks.sliding_window_view(b, WINDOW)[chosen])
        _, first = np.unique(found, return_index=True)
        return found[np.sort(first)]

    @staticmethod
    def _hashes(held: np.ndarray) -> np.ndarray:
        parts = np.ascontiguousarray(held).view(np.uint64)
        out = np.full(len(parts), 0x243F6A8885A308D3, np.uint64)
        for k in range(parts.shape[1]):
            out = mixed(out ^ parts[:, k])
        return out

    def filters(self, text: str) -> np.ndarray:
        """The chain of filters of a text, a row of bytes for each."""
        found = self.features(text.encode())
        n = -(-len(found) // FILL)
        bits = np.zeros((n, BITS), np.uint8)
        row = np.arange(len(found)) // FILL
        for k in range(HASHES):
            bits[row, ((found >> np.uint64(11 * k)) % np.uint64(BITS)).astype(np.int64)] = 1
        return np.packbits(bits, axis=1)


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Mean over the filters of the shorter chain of the best normalised bit overlap."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    a, b = np.unpackbits(x, axis=1).astype(np.float32), np.unpackbits(y, axis=1).astype(np.float32)
    if (len(a), a.sum()) > (len(b), b.sum()):
        a, b = b, a
    own, other = a.sum(1)[:, None], b.sum(1)[None, :]
    chance = own * other / BITS
    room = np.minimum(own, other) - chance
    shares = (a @ b.T - chance) / np.maximum(room, 1e-6)
    return float(np.clip(shares.max(1), 0.0, 1.0).mean())


def written(filters: np.ndarray) -> str:
    """A chain of filters as text."""
    return base64.b64encode(filters.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    """The chain of filters that ``written`` has made a text of."""
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_NAMES = [f.split(" ")[0] for f in _RESULT.split(", ")]


def _compared(maker: Fingerprinter, doc_id, text: str, own, following: str, after) -> tuple:
    """The result row of a document, from its text and filters and those of the next one."""
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = maker.filters(edited)
    return (
        doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own),
        written(changed), likeness(own, changed), likeness(own, after),
    )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, against its edited text and against the next document.

    The texts are dealt by ranges of ids, once. A task reads its range in order; the last
    document of a range meets the first of the next range in a second, small step.
    """
    model = byte_model(docs)
    keep_batches_small(docs.sparkSession)
    schema = f"part long, edge int, text string, {_RESULT}"
    arrow = arrow_schema(schema)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(model)
        part = TaskContext.get().partitionId()
        held = None
        for b in batches:
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = text or ""
                own = maker.filters(text)
                if held is None:
                    out.append((part, 1, text, doc_id, *[None] * 6))
                else:
                    out.append((part, 0, None, *_compared(maker, *held, text, own)))
                held = doc_id, text, own
            yield _batch(out, arrow)
        if held is not None:
            yield _batch([(part, 2, held[1], held[0], *[None] * 6)], arrow)

    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id")
    rows = staged(
        dealt.sortWithinPartitions("doc_id", "text").mapInArrow(in_order, schema), "compared"
    )
    edges = rows.where("edge > 0").select("part", "edge", "doc_id", "text")
    parts = [r.part for r in edges.where("edge = 1").select("part").orderBy("part").collect()]
    after = docs.sparkSession.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1], strict=True)), "part long, next_part long"
    )
    first = edges.where("edge = 1").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text")
    )
    last = edges.where("edge = 2").join(after, "part").join(first, "next_part")

    def at_edges(rows):
        maker = Fingerprinter(model)
        out = [
            _compared(maker, i, text, maker.filters(text), following, maker.filters(following))
            for i, text, following in zip(rows["doc_id"], rows["text"], rows["next_text"], strict=True)
        ]
        return {n: [row[k] for row in out] for k, n in enumerate(_NAMES)}

    ends = map_batches(last.select("doc_id", "text", "next_text"), at_edges, _RESULT)
    return rows.where("edge = 0").select(_NAMES).unionByName(ends)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
    return pa.RecordBatch.from_arrays(columns, schema=arrow)
