"""Fill-in-the-middle documents, cut with a learned rank index over code-point boundaries.

Cuts are code points, texts are UTF-8 bytes. The index of a text maps the rank of each boundary
(0 to n code points) to its byte offset: straight segments, grown as long as one line stays within
EPSILON of all their offsets (a cone of possible slopes that each offset narrows), and per
boundary the difference to its segment's prediction, one byte. An offset is the prediction plus the
stored difference, exactly; text in one script has few segments, ASCII one.

A document of n code points is split by h1 to h4, the first four 8-digit groups of the hex sha256
of ``<seed>:<doc_id>``: the prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) code
points, the middle after the larger. Forms are ``psm`` (<P>prefix<S>suffix<M>middle), ``spm``
(<S>suffix<P>prefix<M>middle) if h4 % 100 < spm_percent, and ``plain`` (the text) if it is empty,
has a marker in it, or h3 % 100 >= percent.

One pass over the rows, no shuffle; memory is that of a slice of texts, and of a single text's
index (1 byte and two machine words a boundary) while it is cut.

Defined results: null texts count as empty; a null id hashes as an empty one. Repeated rows get
equal results. Only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierlake.llm.common import map_texts, type_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of a prediction, in bytes; differences fit a signed byte.
EPSILON = 100
_STRIDE = 256


@dataclass
class RankIndex:
    """Byte offsets of code-point boundaries: offset = floor(base + slope * run) + residual."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predict(self, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, rank, side="right") - 1
        return np.floor(self.base[at] + self.slope[at] * (rank - self.first[at])).astype(np.int64)

    def offset(self, rank: np.ndarray) -> np.ndarray:
        """The exact byte offsets of boundaries."""
        return self.predict(rank) + self.residual[rank]


def boundaries(data: bytes) -> np.ndarray:
    """The byte offsets at which code points begin, and the end."""
    units = np.frombuffer(data, dtype=np.uint8)
    return np.append(np.flatnonzero((units & 0xC0) != 0x80), len(units))


def _segment(offsets: np.ndarray, start: int, epsilon: int) -> tuple[int, float]:
    """The end of the segment that begins at a boundary, and its slope."""
    low, high, at, stride = -np.inf, np.inf, start + 1, _STRIDE
    while at < len(offsets):
        part = offsets[at:at + stride] - offsets[start]
        run = np.arange(at - start, at - start + len(part))
        lows = np.maximum(np.maximum.accumulate((part - epsilon) / run), low)
        highs = np.minimum(np.minimum.accumulate((part + epsilon) / run), high)
        beyond = np.flatnonzero(lows > highs)
        if len(beyond):
            if beyond[0]:
                low, high = lows[beyond[0] - 1], highs[beyond[0] - 1]
            at += int(beyond[0])
            break
        low, high, at, stride = lows[-1], highs[-1], at + len(part), 2 * stride
    return at, 1.0 if at == start + 1 else (low + high) / 2


def fit(offsets: np.ndarray, epsilon: int = EPSILON) -> RankIndex:
    first, slopes, at = [], [], 0
    while at < len(offsets):
        first.append(at)
        if not first[:-1] and offsets[-1] == len(offsets) - 1:
            at, slope = len(offsets), 1.0  # a byte a code point
        else:
            at, slope = _segment(offsets, at, epsilon)
        slopes.append(slope)
    start = np.array(first, dtype=np.int64)
    index = RankIndex(start, offsets[start].astype(np.float64), np.array(slopes),
                      np.zeros(len(offsets), dtype=np.int8))
    missing = offsets - index.predict(np.arange(len(offsets)))
    if np.abs(missing).max(initial=0) > 127:
        raise ValueError("a prediction is further off than its bound")
    index.residual = missing.astype(np.int8)
    return index


def arrange(prefix: bytes, middle: bytes, suffix: bytes, form: str) -> bytes:
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text an output was made from. Parts have no markers, so the first ones are the cuts."""
    if form == "plain":
        return output
    inner = SUFFIX if form == "psm" else PREFIX
    one, rest = output[len(inner):].split(inner, 1)
    two, middle = rest.split(MIDDLE, 1)
    return one + middle + two if form == "psm" else two + middle + one


def _draws(doc_id: str, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}")
            for i in range(4)]


def transform(docs: DataFrame, percent: int = 90, spm_percent: int = 20,
              seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored) of every row."""
    def run(part):
        rows = []
        for text, *draws in zip(*(part.column(c).to_pylist()
                                  for c in ("text", "h1", "h2", "h3", "h4"))):
            data = (text or "").encode()
            n, (h1, h2, h3, h4) = len(text or ""), draws
            if not n or h3 % 100 >= percent or any(m in data for m in (PREFIX, SUFFIX, MIDDLE)):
                rows.append((n, "plain", None, None, data, data))
                continue
            cuts = np.sort(np.array([h1 % (n + 1), h2 % (n + 1)]))
            a, b = fit(boundaries(data)).offset(cuts)
            form = "spm" if h4 % 100 < spm_percent else "psm"
            output = arrange(data[:a], data[a:b], data[b:], form)
            rows.append((n, form, int(cuts[0]), int(cuts[1] - cuts[0]), output,
                         restore(output, form)))
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        # Bytes are whole code points, so they are texts as they are.
        return [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds)),
                *(pa.array(c, pa.binary()).cast(pa.string()) for c in columns[4:])]

    return map_texts(docs.select("doc_id", "text", *_draws("doc_id", seed)),
                     f"doc_id {type_of(docs, 'doc_id')}, n bigint, form string, "
                     "prefix_chars bigint, middle_chars bigint, output string, restored string",
                     run)
