"""Recursive character chunking as an Arrow function.

Every separator stays at the start of the piece it opens, so the pieces of a
text are adjacent spans and a chunk is one span between two piece boundaries.
Chunk ends are therefore found by searching for the boundary nearest to the
limit, once per chunk, rather than by walking over every word.  With a length
function of its own (tokens, say) a piece counts as that function says, and the
search runs over the prefix sums of the pieces' lengths.
"""

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslake import constants as C


def _windows(bounds, sums, size, overlap):
    """Greedy overlapping windows over a run of pieces, each shorter than size; ``sums`` are lengths up to a bound."""
    last = len(bounds) - 1
    i = 0
    while True:
        j = bisect_right(sums, sums[i] + size) - 1
        yield bounds[i], bounds[j]
        if j == last:
            return
        i = bisect_left(sums, max(sums[j] - overlap, sums[j + 1] - size), i)


def _blank_windows(text, lo, hi, separator, size, overlap):
    """The same windows for a one-character separator, by string search alone."""
    start = lo
    while hi - start > size:
        end = text.rfind(separator, start + 1, start + size + 1)
        yield start, end
        after = text.find(separator, end + 1, hi)
        floor = max(end - overlap, (hi if after < 0 else after) - size)
        start = text.find(separator, floor, end)
        if start < 0:
            start = end
    yield start, hi


def _boundaries(text, lo, hi, separator):
    if not separator:
        return range(lo, hi + 1)
    cuts = [m.start() for m in re.compile(re.escape(separator)).finditer(text, lo, hi)]
    if not cuts or cuts[0] != lo:
        cuts.insert(0, lo)
    cuts.append(hi)
    return cuts


def chunk_spans(text, size, overlap, separators=C.SEPARATORS, lo=0, hi=None, length=None):
    """Spans (start, end) of the chunks of ``text[lo:hi]``, in order.  ``length`` measures a piece; None: characters."""
    hi = len(text) if hi is None else hi
    if lo == hi:
        return
    level = next((n for n, s in enumerate(separators) if not s or text.find(s, lo, hi) >= 0), None)
    if level is None:
        level, separator = len(separators) - 1, separators[-1]
    else:
        separator = separators[level]
    finer = separators[level + 1 :] if separator else ()
    if length is None and len(separator) == 1 and max(map(len, text[lo:hi].split(separator))) < size - 1:
        yield from _blank_windows(text, lo, hi, separator, size, overlap)
        return
    bounds = _boundaries(text, lo, hi, separator)
    if length is None:
        sums = bounds
    else:
        sums = [0, *accumulate(length(text[a:b]) for a, b in zip(bounds, bounds[1:]))]
    long_pieces = [n for n, (a, b) in enumerate(zip(sums, sums[1:])) if b - a >= size]
    start = 0
    for n in long_pieces:
        if n > start:
            yield from _windows(bounds[start : n + 1], sums[start : n + 1], size, overlap)
        if finer:
            yield from chunk_spans(text, size, overlap, finer, bounds[n], bounds[n + 1], length)
        else:
            yield bounds[n], bounds[n + 1]
        start = n + 1
    if start < len(bounds) - 1:
        yield from _windows(bounds[start:], sums[start:], size, overlap)


def split_text(text, size, overlap, separators=C.SEPARATORS, length=None):
    """Chunk strings of one text, stripped, empty ones dropped."""
    spans = chunk_spans(text, size, overlap, separators, length=length)
    return [piece for piece in (text[a:b].strip() for a, b in spans) if piece]


def chunk_texts(text: Column, sizes: Column, overlaps: Column, separators=C.SEPARATORS, length=None) -> Column:
    """Chunks of each text in every size: ``array<array<string>>`` in the order of ``sizes``; null text gives null.

    The text travels to the function once, whatever the number of sizes.  ``length`` is
    called with pieces of text and says how much of a chunk each takes.
    """

    @F.arrow_udf("array<array<string>>")
    def split(texts: pa.Array, sizes: pa.Array, overlaps: pa.Array) -> pa.Array:
        rows = []
        for t, wanted, shared in zip(texts.to_pylist(), sizes.to_pylist(), overlaps.to_pylist()):
            if t is None:
                rows.append(None)
            else:
                rows.append([split_text(t, s, o, separators, length) for s, o in zip(wanted, shared)])
        chunks = [c for row in rows if row for c in row]
        inner = pa.ListArray.from_arrays(
            pa.array([0, *accumulate(map(len, chunks))], pa.int32()), pa.array([p for c in chunks for p in c], pa.string())
        )
        offsets = pa.array([0, *accumulate(len(r or ()) for r in rows)], pa.int32())
        return pa.ListArray.from_arrays(offsets, inner, mask=pa.array([r is None for r in rows]))

    return split(text, sizes, overlaps)
