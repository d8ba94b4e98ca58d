"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words (matches of the split pattern) of a block of texts are laid end
to end in one array of byte ids. An inverted index maps each adjacent id pair that
has a rank to the positions where it stands. The merges are then replayed over the
whole block in rank order, lowest rank first and leftmost first, and each merge
touches only the entries of its two neighbours. A word that is itself in the
vocabulary is one id. Words do not influence each other, so blocks can be
processed anywhere; a block is what one Arrow batch adds to a bounded memo.

Defined results: null and empty texts give no ids; any Unicode text, also of
100 kB without a space, is encoded whole; repeated rows give repeated results;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from firngrid.llm.texts import map_batches

#: Entries of a worker's word memo (about 200 bytes each); it is emptied when full.
MEMO_ENTRIES = 250_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from lines of base64 and number."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class MergeReplay:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern)
        self.text_of = {rank: str(rank) for rank in self.tokens}
        self.memo: dict[str, bytes] = {}
        #: An id that no token has stands between words, another where a right half was.
        self.between = max(self.tokens) + 1
        self.gone = self.between + 1
        self.base = self.gone + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        #: (left id, right id) -> rank of the two together, as one number left * base + right.
        self.pairs = {
            ranks[left] * self.base + ranks[right]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := token[:cut]) in ranks and (right := token[cut:]) in ranks
        }
        self.byte_pairs = np.full(256 * 256, -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0] * 256 + token[1]] = rank

    def _index(self, data: np.ndarray, inside: np.ndarray) -> dict[int, list[int]]:
        """For each rank, the positions of the left halves of its pair, in order."""
        found = self.byte_pairs[data[:-1].astype(np.int64) * 256 + data[1:]]
        places = np.flatnonzero((found >= 0) & inside[:-1] & inside[1:])
        places = places[np.argsort(found[places], kind="stable")]
        ranks, first = np.unique(found[places], return_index=True)
        ends = [*first[1:].tolist(), len(places)]
        places = places.tolist()
        return {
            r: places[a:b] for r, a, b in zip(ranks.tolist(), first.tolist(), ends, strict=True)
        }

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as packed 32-bit integers, from one replay of the merges over all words."""
        if not words:
            return []
        data = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
        inside = np.ones(len(data), bool)
        inside[0] = False
        inside[np.cumsum(np.array([len(w) + 1 for w in words]))] = False
        index = self._index(data, inside)
        ids = np.where(inside, self.byte_ids[data], self.between).tolist()
        following = list(range(1, len(ids) + 1))
        preceding = list(range(-1, len(ids) - 1))
        rank_of, base, gone = self.pairs.get, self.base, self.gone
        todo = list(index)
        heapq.heapify(todo)
        while todo:
            rank = heapq.heappop(todo)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            for k, at in enumerate(places):
                after = following[at]
                # An entry is stale once one of its halves has been merged.
                if rank_of(ids[at] * base + ids[after]) != rank:
                    continue
                ids[at] = rank
                ids[after] = gone
                following[at] = beyond = following[after]
                preceding[beyond] = at
                before = preceding[at]
                sooner = False
                for left, pair in (
                    (before, ids[before] * base + rank),
                    (at, rank * base + ids[beyond]),
                ):
                    new = rank_of(pair)
                    if new is not None:
                        if new in index:
                            index[new].append(left)
                        else:
                            index[new] = [left]
                            heapq.heappush(todo, new)
                        sooner = sooner or new < rank
                if sooner:
                    # A lower rank has come up: it goes first, then the rest of this one.
                    index.setdefault(rank, []).extend(places[k + 1 :])
                    heapq.heappush(todo, rank)
                    break
        left = np.array(ids, np.int32)
        left = left[left != gone]
        ends = (4 * np.flatnonzero(left == self.between)).tolist()
        packed = left.tobytes()
        return [packed[a + 4 : b] for a, b in zip(ends, ends[1:], strict=False)]

    def learn(self, words: set[str]) -> None:
        """Put the words that the memo lacks into it, by one replay."""
        fresh = words.difference(self.memo)
        if len(self.memo) + len(fresh) > MEMO_ENTRIES:
            self.memo.clear()
            fresh = words
        apart = []
        for word in fresh:
            rank = self.ranks.get(word.encode())
            if rank is None:
                apart.append(word)
            else:
                self.memo[word] = rank.to_bytes(4, sys.byteorder)
        self.memo.update(zip(apart, self.replay([w.encode() for w in apart]), strict=True))

    def encode_arrays(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, one after the other."""
        split = [self.split.findall(t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(split)))
        for k, words in enumerate(split):
            split[k] = None
            yield np.frombuffer(b"".join(map(self.memo.__getitem__, words)), np.int32)

    def encode_all(self, texts: list[str | None]) -> Iterator[list[int]]:
        """The ids of each text as a list."""
        return (ids.tolist() for ids in self.encode_arrays(texts))

    def decode(self, ids: list[int]) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, ids))


_LOADED: dict[tuple[str, str], MergeReplay] = {}


def replayer(path: str, pattern: str) -> MergeReplay:
    """The vocabulary of a file, loaded once in a worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = MergeReplay(load_ranks(path), pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text."""

    def batch(rows):
        coder = replayer(path, pattern)
        return {"doc_id": rows["doc_id"], "ids": list(coder.encode_arrays(rows["text"]))}

    return map_batches(docs.select("doc_id", "text"), batch, "doc_id long, ids array<long>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, data``: the bytes that ``ids`` stands for; null ids give no bytes."""

    def batch(rows):
        coder = replayer(path, pattern)
        return {
            "doc_id": rows["doc_id"],
            "data": [coder.decode(ids or []) for ids in rows["ids"]],
        }

    return map_batches(encoded.select("doc_id", "ids"), batch, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded, then decoded, in one pass."""

    def batch(rows):
        coder = replayer(path, pattern)
        out = {"doc_id": rows["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids in coder.encode_all(rows["text"]):
            listed = ",".join(map(coder.text_of.__getitem__, ids))
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(coder.decode(ids)).hexdigest())
        return out

    return map_batches(
        docs.select("doc_id", "text"),
        batch,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
