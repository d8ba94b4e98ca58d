"""Personal data by a semi-Markov conditional random field.

Four kinds have fixed base rules (email, ip, card, phone); their spans always stay.
The field adds spans that the rules miss, such as access keys or numbers written in
another way. Tokens that hold a digit or one of ``@ = +`` form zones; every run of
at most MAX_TOKENS tokens of a zone is a candidate segment. Features look at the
whole candidate (shape, length, digits, checksum, the word before it). Dynamic
programming over a zone, whose segments are bounded in length, chooses boundaries
and kinds together. Outside zones nothing can be an entity, so zones are
independent and the result equals that over the whole text.

The weights are learned by maximum likelihood from the zones of at most
``sample_docs`` documents, labelled by seed patterns. All texts are scanned whole.

Defined results: null and empty texts have no spans; repeated rows give repeated
results; an empty table gives an empty table; a corpus without any zone trains no
weights and adds nothing; extra columns are kept by ``redact`` and ignored else.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firngrid.llm.texts import map_batches, sampled

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
OTHER = len(KINDS)
#: Longest candidate segment, in tokens.
MAX_TOKENS = 5
#: Documents whose zones the weights are learned from, at most; and zones, at most.
SAMPLE_DOCS = 2000
SAMPLE_ZONES = 2500

# The lookbehinds keep a search from starting again inside a run that has failed,
# so even a run of a million digits is read once.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@=+]")
_SPACE = re.compile(r"\s")
_SEEDS = (
    re.compile(r"\bAKIA[0-9A-Z]{16}\b"),
    re.compile(r"(?i)\b(?:password|passwd|token|secret|api_?key)\s*[=:]\s*[\"']?([^\s\"']{6,80})"),
)


def luhn(digits: str) -> bool:
    """Whether a string of digits passes the Luhn checksum."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base rules, in order of start, then kind."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(re.findall("[0-9]", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _seed_spans(text: str) -> list[tuple[int, int, int]]:
    found = base_spans(text)
    for pattern in _SEEDS:
        for m in pattern.finditer(text):
            group = pattern.groups
            found.append((m.start(group), OTHER - 1, m.end(group)))
    return sorted(found)


def zones(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring tokens with a mark, each token as ``(start, end)``."""
    zone: list[tuple[int, int]] = []
    at = 0
    while m := _MARK.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        stop = _SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        if zone and text[zone[-1][1] : start].strip():
            yield zone
            zone = []
        zone.append((start, end))
        at = end
    if zone:
        yield zone


def _trim(text: str, start: int, end: int) -> tuple[int, int]:
    """Without quotes and marks around, and without ``name=`` before a value."""
    cut = max(text.rfind("=", start, end - 1), text.rfind('"', start, end - 1))
    if cut >= start and end - cut > 4:
        start = cut + 1
    while start < end and not (text[start].isalnum() or text[start] in "+(@"):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return start, end


def _features(text: str, start: int, end: int, before: str, n_tokens: int) -> list[str]:
    """Whole-span features of a candidate."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    letters = re.sub("[^A-Za-z]", "", span)
    shape = re.sub(r"(.)\1+", r"\1", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", span))))
    size = min(6, len(span) // 6)
    counts = Counter(span)
    spread = -sum(n / len(span) * math.log2(n / len(span)) for n in counts.values())
    found = [
        "bias",
        f"shape={shape if len(shape) <= 16 else 'long'}",
        f"size={size}",
        f"tokens={n_tokens}",
        f"digits={min(len(digits), 20)}",
        f"letters={min(len(letters) // 4, 6)}",
        f"spread={int(2 * spread)},{size}",
        f"before={before}",
        f"head={span[:4]}",
    ]
    if "@" in span:
        found.append("at" + (",dot" if "." in span.rpartition("@")[2] else ""))
    if 14 <= len(digits) <= 19 and not letters:
        found.append(f"luhn={luhn(digits)}")
    if len(span) >= 16 and not re.search("[^0-9a-fA-F]", span):
        found.append("hex")
    if len(span) >= 16 and not re.search("[^0-9A-Z]", span) and letters and digits:
        found.append("capitals and digits")
    if span.startswith("+"):
        found.append("plus")
    if span.count(".") == 3 and not letters:
        found.append("dotted")
    return found


def _word_before(text: str, start: int) -> str:
    found = re.findall(r"[a-z_]+", text[max(0, start - 24) : start].lower())
    return found[-1][-10:] if found and re.search(r"[=:]\s*\S{0,2}$", text[max(0, start - 4) : start]) else ""


def candidates(text: str, zone: list[tuple[int, int]]) -> list[tuple[int, int, int, int, list[str]]]:
    """``(first token, token after the last, start, end, features)`` of a zone."""
    found = []
    for a in range(len(zone)):
        for b in range(a + 1, min(a + MAX_TOKENS, len(zone)) + 1):
            start, end = _trim(text, zone[a][0], zone[b - 1][1])
            if start < end:
                feats = _features(text, start, end, _word_before(text, start), b - a)
                found.append((a, b, start, end, feats))
    return found


class SegmentField:
    """Weights of the field and the dynamic programs over a zone."""

    def __init__(self, weights: dict[str, list[float]]):
        self.weights = {f: np.array(w) for f, w in weights.items()}

    def scores(self, found) -> np.ndarray:
        """A row for each candidate, a column for each kind."""
        out = np.zeros((len(found), len(KINDS)))
        for row, (*_, feats) in zip(out, found, strict=True):
            for f in feats:
                if (w := self.weights.get(f)) is not None:
                    row += w
        return out

    def segment(self, found, n_tokens: int) -> tuple[float, list[tuple[int, int]]]:
        """Score of the best segmentation of a zone, and its ``(candidate, kind)`` pairs."""
        scores = self.scores(found)
        by_end: dict[int, list[int]] = {}
        for k, c in enumerate(found):
            by_end.setdefault(c[1], []).append(k)
        best, back = [0.0] * (n_tokens + 1), [-1] * (n_tokens + 1)
        for j in range(1, n_tokens + 1):
            best[j] = best[j - 1]  # a token outside any entity scores 0
            for k in by_end.get(j, ()):
                score = best[found[k][0]] + scores[k].max()
                if score > best[j]:
                    best[j], back[j] = score, k
        out, j = [], n_tokens
        while j > 0:
            if back[j] < 0:
                j -= 1
            else:
                out.append((back[j], int(scores[back[j]].argmax())))
                j = found[back[j]][0]
        return best[-1], out[::-1]

    def decode(self, text: str, zone: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """``(start, kind number, end)`` of the best segmentation."""
        found = candidates(text, zone)
        return [(found[k][2], kind, found[k][3]) for k, kind in self.segment(found, len(zone))[1]]


def _fit(examples: list[tuple[str, list]], rounds: int = 40, rate: float = 0.5, l2: float = 1e-3) -> dict[str, list[float]]:
    """Maximum likelihood by AdaGrad over ``(text around, gold)`` examples."""
    names: dict[str, int] = {}
    data = []
    for n_tokens, found, gold in examples:
        ids = [np.array([names.setdefault(f, len(names)) for f in c[4]]) for c in found]
        data.append((n_tokens, [(c[0], c[1]) for c in found], ids, gold))
    weights = np.zeros((len(names), len(KINDS)))
    squares = np.full_like(weights, 1e-6)
    for _ in range(rounds if data else 0):
        gradient = -l2 * len(data) * weights
        for n, spans, ids, gold in data:
            scores = np.array([weights[i].sum(0) for i in ids]) if ids else np.zeros((0, len(KINDS)))
            ahead = np.full(n + 1, -np.inf)
            behind = np.full(n + 1, -np.inf)
            ahead[0] = behind[n] = 0.0
            total = np.logaddexp.reduce(scores, axis=1) if len(scores) else scores[:, 0]
            for j in range(1, n + 1):
                terms = [ahead[j - 1]] + [ahead[a] + total[k] for k, (a, b) in enumerate(spans) if b == j]
                ahead[j] = np.logaddexp.reduce(terms)
            for j in range(n - 1, -1, -1):
                terms = [behind[j + 1]] + [behind[b] + total[k] for k, (a, b) in enumerate(spans) if a == j]
                behind[j] = np.logaddexp.reduce(terms)
            for k, (a, b) in enumerate(spans):
                share = np.exp(ahead[a] + scores[k] + behind[b] - ahead[n])
                if k in gold:
                    share[gold[k]] -= 1.0
                np.subtract.at(gradient, ids[k], share)
        squares += gradient**2
        weights += rate * gradient / np.sqrt(squares)
    return {f: weights[i].tolist() for f, i in names.items()}


def _examples(text: str) -> Iterator[tuple[int, list, dict[int, int]]]:
    seeds = _seed_spans(text)
    for zone in zones(text):
        if len(zone) > 12:
            continue
        found = candidates(text, zone)
        gold, taken = {}, set()
        for start, kind, end in seeds:
            inside = [t for t, (a, b) in enumerate(zone) if a < end and b > start]
            if inside and not taken & set(inside):
                for k, c in enumerate(found):
                    if c[0] == inside[0] and c[1] == inside[-1] + 1:
                        gold[k] = kind
                        taken |= set(inside)
        yield len(zone), found, gold


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> SegmentField:
    """Learn the weights from the zones of at most ``sample_docs`` documents.

    The sample is by a hash of the text, so it does not depend on the order of rows.
    The texts stay on the executors; what comes back is at most SAMPLE_ZONES zones of
    at most 12 tokens each.
    """
    marked = docs.select("text").where(F.col("text").rlike("[0-9@=+]"))
    sample = sampled(marked, sample_docs)

    def batch(rows):
        found = [
            json.dumps([n, found, sorted(gold.items())])
            for text in rows["text"]
            for n, found, gold in _examples(text)
        ]
        return {"example": found}

    zones_of = map_batches(sample, batch, "example string")
    rows = zones_of.orderBy(F.xxhash64("example"), "example").limit(SAMPLE_ZONES).collect()
    examples = [json.loads(row.example) for row in rows]
    return SegmentField(_fit([(n, found, dict(map(tuple, gold))) for n, found, gold in examples]))


def all_spans(field: SegmentField, text: str) -> tuple[list, list]:
    """The base spans, and these with what the field adds."""
    base = base_spans(text)
    starts = [a for a, _, _ in base]
    ends = list(accumulate((b for _, _, b in base), max))  # the last end so far

    def first_beyond(start: int) -> int:
        """The first base span such that it or one before it ends after ``start``."""
        return bisect_right(ends, start)

    added = []
    for zone in zones(text):
        low, high = first_beyond(zone[0][0]), bisect_left(starts, zone[-1][1])
        if high - low == 1 and base[low][0] <= zone[0][0] + 2 and base[low][2] >= zone[-1][1] - 2:
            continue  # the whole zone is a base span
        for start, kind, end in field.decode(text, zone):
            if first_beyond(start) >= bisect_left(starts, end):
                added.append((start, kind, end))
    return base, sorted(base + added)


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, field: SegmentField) -> DataFrame:
    """``doc_id``, the counts of the base kinds, ``base_sha256`` and ``spans``."""
    weights = {f: w.tolist() for f, w in field.weights.items()}

    def batch(rows):
        own = SegmentField(weights)
        out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for text in rows["text"]:
            base, spans = all_spans(own, text or "")
            counts = Counter(k for _, k, _ in base)
            for k, kind in enumerate(BASE_KINDS):
                out[f"n_{kind}"].append(counts[k])
            out["base_sha256"].append(hashlib.sha256(_listed(base).encode()).hexdigest())
            out["spans"].append(_listed(spans))
        return {"doc_id": rows["doc_id"], **out}

    return map_batches(
        docs.select("doc_id", "text"),
        batch,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string",
    )


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with ``[KIND]`` for each span; of overlapping spans the first names the kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: SegmentField) -> DataFrame:
    """The rows of ``docs`` with every span of ``text`` replaced; nulls stay null.

    A column ``n_chars``, if there is one, is made to count the new text.
    """
    weights = {f: w.tolist() for f, w in field.weights.items()}

    @F.pandas_udf("string")
    def cleaned(texts):
        own = SegmentField(weights)
        return texts.map(
            lambda t: t if t is None else redacted(t, all_spans(own, t)[1]), na_action="ignore"
        )

    out = docs.withColumn("text", cleaned("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
