"""Personal data by patterns and a skip-chain conditional random field.

Patterns find email addresses, internet addresses, payment cards and phone numbers. A random field then looks at the tokens
that hold a digit or an at sign, and at those that equal the name part of an address in the same text. Tokens next to each
other share a potential, and so do repeated or similar tokens however far apart: each is tied to the one before it with the
same letters, digits or name. Loopy message passing over a whole document makes the labels agree: a number that is a phone
number in one line is one in another, where it lacks its prefix. Tokens that a pattern found keep its label; runs of other
tokens that the field labels are added as spans.

The potentials are learned from counts over all documents: labels by shape of token, labels of neighbours, labels of tied
tokens. Only these counts, some thousand numbers, reach the driver.

Defined results: null and empty texts have no spans; matches that fail their test are dropped without another try; spans of
different kinds may overlap; added spans do not overlap pattern spans; equal texts get equal spans; with no documents the
potentials are even and only patterns count. Places are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"
LABELS = 1 + len(KINDS)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starts in the middle of a run of digits cannot match where its first digit does not.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_SIGN = re.compile(r"[0-9@]")
_EDGES = ".,;:!?\"'()[]{}<>"
_DIGITS = re.compile(r"[0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Each at sign with the run of name characters before it, not before the last match's end, and a domain after it."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                free = domain.end()
                out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (part or "0") <= "255" if len(part) == 3 else len(part) < 3


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    if _DIGITS.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(out)


# Shapes of tokens, as one number each.

_SIZES = (0, 1, 2, 4, 5, 7, 9, 12, 20)
_PARTS = (2, 2, 2, len(_SIZES), 5, 2, 2, 2)
SHAPES = int(np.prod(_PARTS))


def shape(token: str) -> int:
    figures = "".join(_DIGITS.findall(token))
    digits = len(figures)
    dots = min(4, len(re.findall(r"[0-9]\.(?=[0-9])", token)))
    at = token.find("@")
    parts = (
        at >= 0,
        at >= 0 and "." in token[at:],
        token.startswith("+"),
        sum(digits >= s for s in _SIZES[1:]),
        dots,
        any(c.isalpha() for c in token),
        "(" in token or ")" in token,
        12 <= digits <= 19 and _luhn(figures),
    )
    out = 0
    for value, size in zip(parts, _PARTS, strict=True):
        out = out * size + int(value)
    return out


@dataclass
class Graph:
    """The tokens of some texts that may be personal data, in order, and what ties them."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    given: np.ndarray  # label of the pattern span that covers the token, 0 if none
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # pairs of tied tokens


def _keys(token: str) -> Iterator[str]:
    """What another token has to share to be tied to this one."""
    plain = token.strip(_EDGES).lower()
    if len(plain) > 3:
        yield plain
    digits = "".join(_DIGITS.findall(plain))
    if len(digits) >= 6:
        yield "#" + digits[-7:]
    name, at, _ = plain.partition("@")
    if at and len(name) > 3:
        yield name


def build(texts: list[str], spans: list[list[tuple[int, int, int]]]) -> Graph:
    rows, chain, skip = [], [], []
    for k, text in enumerate(texts):
        if not _SIGN.search(text):
            continue
        names = {text[a:b].partition("@")[0].lower() for a, kind, b in spans[k] if kind == 0}
        own, at, last = spans[k], 0, {}
        previous_end, previous = -1, -1
        # Spans by start; a token belongs to the first that reaches into it.
        for m in _TOKEN.finditer(text):
            token = m[0]
            if not (_SIGN.search(token) or (names and token.strip(_EDGES).lower() in names)):
                continue
            while at < len(own) and own[at][2] <= m.start():
                at += 1
            label = next((1 + kind for a, kind, b in own[at : at + len(KINDS)] if a < m.end() and b > m.start()), 0)
            number = len(rows)
            rows.append((k, m.start(), m.end(), shape(token), label))
            if previous >= 0 and not text[previous_end : m.start()].strip(" \t"):
                chain.append((previous, number))
            for key in _keys(token):
                if key in last:
                    skip.append((last[key], number))
                last[key] = number
            previous, previous_end = number, m.end()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    pairs = [np.unique(np.array(x, np.int64).reshape(-1, 2), axis=0) for x in (chain, skip)]
    return Graph(*columns, *pairs)


@dataclass
class Field:
    """Log potentials: of a label by shape, of two neighbours' labels, of two tied tokens' labels."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    sure: float = 0.6
    rounds: int = 10

    def beliefs(self, g: Graph) -> np.ndarray:
        """Chance of each label of each token, by loopy message passing."""
        unary = self.unary[g.shape].copy()
        known = g.given > 0
        unary[known] = -12.0
        unary[known, g.given[known]] = 0.0
        pairs = np.concatenate([g.chain, g.skip])
        potential = np.exp(np.stack([self.chain, self.skip]))
        kind = np.repeat([0, 1], [len(g.chain), len(g.skip)])
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        table = np.concatenate([potential[kind], potential[kind].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        message = np.zeros((len(source), LABELS))
        for _ in range(self.rounds if len(pairs) else 0):
            total = unary + self._sum(message, target, len(unary))
            outgoing = total[source] - message[back]
            outgoing = np.exp(outgoing - outgoing.max(1, keepdims=True))
            new = np.log(np.einsum("ei,eij->ej", outgoing, table) + 1e-30)
            new -= new.max(1, keepdims=True)
            message = 0.3 * message + 0.7 * new
        total = unary + self._sum(message, target, len(unary))
        total = np.exp(total - total.max(1, keepdims=True))
        return total / total.sum(1, keepdims=True)

    @staticmethod
    def _sum(message: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(target, message[:, k], minlength=n) for k in range(LABELS)], 1)

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int, bool]]]:
        """(start, kind, end, by pattern) of each text, in order."""
        base = [base_spans(text) for text in texts]
        out = [[(*span, True) for span in own] for own in base]
        g = build(texts, base)
        if not len(g.text):
            return out
        belief = self.beliefs(g)
        label = np.where(belief.max(1) >= self.sure, belief.argmax(1), 0)
        label[g.given > 0] = 0
        tied = np.zeros(len(label), bool)
        tied[g.chain[:, 1]] = True
        k = 0
        while k < len(label):
            end = k + 1
            if label[k]:
                while end < len(label) and tied[end] and label[end] == label[k]:
                    end += 1
                text = texts[g.text[k]]
                a, b = int(g.start[k]), int(g.end[end - 1])
                while a < b and text[a] in _EDGES and text[a] != "(":
                    a += 1
                while b > a and text[b - 1] in _EDGES:
                    b -= 1
                if a < b:
                    out[g.text[k]].append((a, int(label[k]) - 1, b, False))
            k = end
        return [sorted(own) for own in out]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of tokens by shape and label, and of labels of neighbours and of tied tokens, of one task."""
    total = np.zeros((SHAPES + 2 * LABELS) * LABELS, np.int64)
    for batch in batches:
        texts = [t for t in batch.column("text").to_pylist() if t and _SIGN.search(t)]
        g = build(texts, [base_spans(t) for t in texts])
        cells = [g.shape * LABELS + g.given]
        for k, pairs in enumerate((g.chain, g.skip)):
            a, b = g.given[pairs[:, 0]], g.given[pairs[:, 1]]
            cells += [(SHAPES + k * LABELS + a) * LABELS + b]
        total += np.bincount(np.concatenate(cells), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])


def _agreement(counts: np.ndarray, least: float) -> np.ndarray:
    """How much likelier two labels meet than by chance, as a bounded logarithm; equal labels get at least `least`."""
    both = counts + counts.T + 0.5
    share = both / both.sum()
    out = np.clip(np.log(share / np.outer(share.sum(1), share.sum(0))), -4, 4)
    diagonal = np.arange(1, LABELS)
    out[diagonal, diagonal] = np.maximum(out[diagonal, diagonal], least)
    return out


def fit_field(documents: DataFrame, text: str = "text", sure: float = 0.6) -> Field:
    """Learns the potentials from the counts of all documents."""
    cells = documents.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    cells = cells.mapInArrow(_count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # One row per cell at most, of a fixed number of cells.
    counts = np.zeros((SHAPES + 2 * LABELS) * LABELS)
    for row in cells.collect():
        counts[row.cell] = row.n
    counts = counts.reshape(-1, LABELS)
    by_shape = counts[:SHAPES]
    prior = (by_shape.sum(0) + [10.0, *[0.1] * len(KINDS)]) / (by_shape.sum() + 10 + 0.1 * len(KINDS))
    unary = np.log((by_shape + prior) / (by_shape.sum(1, keepdims=True) + 1))
    chain = _agreement(counts[SHAPES : SHAPES + LABELS], 0.0)
    skip = _agreement(counts[SHAPES + LABELS :], 3.0)
    return Field(np.maximum(unary, -8.0), chain, skip, sure)


def spans_column(field: Field, text: Column) -> Column:
    """The spans of a text: kind, start, end, and whether a pattern found it."""

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        out = []
        for first in range(0, len(texts), 512):
            part = [t or "" for t in texts.slice(first, 512).to_pylist()]
            out += [[{"kind": KINDS[kind], "start": a, "end": b, "base": base} for a, kind, b, base in own] for own in field.spans(part)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        return pa.array(out, kind)

    return spans(text)


def masked_column(field: Field, text: Column) -> Column:
    """The text with each stretch of personal data replaced by its first kind in brackets; null stays null."""

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        out = []
        for first in range(0, len(texts), 512):
            raw = texts.slice(first, 512).to_pylist()
            for text, own in zip(raw, field.spans([t or "" for t in raw]), strict=True):
                pieces, at = [], 0
                for a, kind, b, _ in own:
                    if a >= at:
                        pieces += [text[at:a], f"[{KINDS[kind].upper()}]"]
                    at = max(at, b)
                out.append("".join([*pieces, text[at:]]) if own else text)
        return pa.array(out, pa.string())

    return masked(text)
