"""Fill-in-middle transformation by displacement scatter.

A text is cut in two places into prefix, middle and suffix, and these are written in
another order behind markers.  No text is taken apart for it: a whole batch is one run of
bytes.  Each of the three parts of a text moves by one distance, so a difference array
holds the changes of distance at the cuts, its cumulative sum is the displacement of
every byte, and one scatter builds all outputs.  Restoring finds the markers, forms the
same displacements and gathers the bytes back.

A unit is a word with the white space before it; white space at the end is a unit.  A
text that holds a marker stays plain, so each marker of an output occurs once.

Null texts count as empty, and empty texts stay plain.  A null id draws as the empty
string; rows with equal ids and texts get equal outputs.  Batches are worked through in
blocks of ``BLOCK_BYTES``; a longer text is a block of its own, at some 40 bytes of
working memory for each of its bytes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_FORMS = np.array([PLAIN, PSM, SPM])
SEED = 42
SHARE = 50  # percent of texts that are transformed
SPM_SHARE = 80  # percent of those that begin with the suffix
BLOCK_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RESULT = pa.struct(
    [
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("output", pa.string()),
    ]
)


class Rows:
    """Bytes of many texts in one array; text ``k`` is ``data[edges[k]:edges[k + 1]]``."""

    def __init__(self, data: np.ndarray, edges: np.ndarray):
        self.data, self.edges = data, edges

    @property
    def starts(self):
        return self.edges[:-1]

    @property
    def sizes(self):
        return np.diff(self.edges)

    @staticmethod
    def of(column: pa.Array) -> "Rows":
        column = column.fill_null("").cast(pa.large_binary())
        _, edges, data = column.buffers()
        edges = np.frombuffer(edges, np.int64, len(column) + 1, column.offset * 8)
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return Rows(whole[edges[0] : edges[-1]], edges - edges[0])

    def blocks(self):
        """``(first, last, rows)``: runs of texts that hold at most BLOCK_BYTES, or one text."""
        first, count = 0, len(self.edges) - 1
        while first < count:
            last = int(np.searchsorted(self.edges, self.edges[first] + BLOCK_BYTES, "right")) - 1
            last = min(max(last, first + 1), count)
            a, b = self.edges[first], self.edges[last]
            yield first, last, Rows(self.data[a:b], self.edges[first : last + 1] - a)
            first = last

    def strings(self) -> pa.Array:
        edges, data = pa.py_buffer(self.edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.data))
        return pa.LargeStringArray.from_buffers(len(self.edges) - 1, edges, data).cast(pa.string())

    def markers(self):
        """``(row, place, letter)`` of every marker inside a text, in order."""
        d = self.data
        inner = d[1:-1]
        hit = (d[:-2] == PREFIX[0]) & (d[2:] == PREFIX[2])
        hit &= (inner == PREFIX[1]) | (inner == SUFFIX[1]) | (inner == MIDDLE[1])
        place = np.flatnonzero(hit)
        row = np.searchsorted(self.edges, place, "right") - 1
        inside = place + 3 <= self.edges[row + 1]
        return row[inside], place[inside], d[place[inside] + 1]


def _displacements(size: int, at: list, moves: list) -> np.ndarray:
    """Displacement of each byte: ``moves[p]`` holds from ``at[p]`` on, rows after one another."""
    places = np.stack(at, 1).ravel()
    distance = np.stack(moves, 1).ravel()
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, places, np.diff(distance, prepend=0))
    return np.cumsum(change[:size])


def _places(form, start, lp, lm, ls):
    """Where the parts and markers of each output stand: ``prefix, middle, suffix, (marker, places)...``."""
    spm, plain = form == 2, form == 0
    prefix = np.where(plain, start, np.where(spm, start + ls + 6, start + 3))
    suffix = np.where(plain, start + lp + lm, np.where(spm, start + 3, start + lp + 6))
    middle = np.where(plain, start + lp, start + lp + ls + 9)
    kept = ~plain
    marks = [(PREFIX, (prefix - 3)[kept]), (SUFFIX, (suffix - 3)[kept]), (MIDDLE, (middle - 3)[kept])]
    return prefix, middle, suffix, marks


def scatter(rows: Rows, form: np.ndarray, a: np.ndarray, b: np.ndarray) -> Rows:
    """Outputs of texts cut after ``a`` and ``b`` bytes; forms are 0 plain, 1 psm, 2 spm."""
    sizes, starts = rows.sizes, rows.starts
    edges = np.concatenate([[0], np.cumsum(sizes + 9 * (form > 0))])
    prefix, middle, suffix, marks = _places(form, edges[:-1], a, b - a, sizes - b)
    at = [starts, starts + a, starts + b]
    shift = _displacements(len(rows.data), at, [p - s for p, s in zip((prefix, middle, suffix), at)])
    out = np.empty(edges[-1], np.uint8)
    out[np.arange(len(rows.data)) + shift] = rows.data
    for marker, places in marks:
        out[places[:, None] + np.arange(3)] = np.frombuffer(marker, np.uint8)
    return Rows(out, edges)


def gather(rows: Rows, form: np.ndarray) -> Rows:
    """The texts that outputs of these forms were built from."""
    row, place, letter = rows.markers()
    changed = form[row] > 0
    row, place, letter = row[changed], place[changed], letter[changed]
    found = {}
    for marker in (PREFIX, SUFFIX, MIDDLE):
        found[marker] = rows.starts.copy()
        found[marker][row[letter == marker[1]]] = place[letter == marker[1]]
    sizes, ends = rows.sizes, rows.edges[1:]
    spm, kept = form == 2, form > 0
    before = np.where(spm, found[MIDDLE], found[SUFFIX])  # what follows the prefix, and
    after = np.where(spm, found[PREFIX], found[MIDDLE])  # the suffix
    lp = np.where(kept, before - found[PREFIX] - 3, 0)
    ls = np.where(kept, after - found[SUFFIX] - 3, 0)
    lm = np.where(kept, ends - found[MIDDLE] - 3, sizes)
    edges = np.concatenate([[0], np.cumsum(lp + lm + ls)])
    prefix, middle, suffix, _ = _places(form, rows.starts, lp, lm, ls)
    at = [edges[:-1], edges[:-1] + lp, edges[:-1] + lp + lm]
    shift = _displacements(int(edges[-1]), at, [p - s for p, s in zip((prefix, middle, suffix), at)])
    return Rows(rows.data[np.arange(len(shift)) + shift], edges)


def _units(rows: Rows):
    """``(last bytes of all units, number of units before each text)``."""
    d = rows.data
    if not len(d):
        return np.zeros(0, np.int64), np.zeros(len(rows.edges), np.int64)
    space = _SPACE[d]
    ends = np.zeros(len(d), bool)
    ends[:-1] = ~space[:-1] & space[1:]
    ends[rows.edges[1:][rows.sizes > 0] - 1] = True
    last = np.flatnonzero(ends)
    return last, np.searchsorted(last, rows.edges)


def _cut(rows: Rows, last, before, units) -> np.ndarray:
    """Bytes that the first ``units`` units of each text take."""
    cut = np.zeros(len(units), np.int64)
    some = units > 0
    cut[some] = last[(before[:-1] + units - 1)[some]] + 1 - rows.starts[some]
    return cut


def _transform(rows: Rows, draws, share: int, spm_share: int) -> pa.Array:
    h1, h2, h3, h4 = draws
    last, before = _units(rows)
    n = np.diff(before)
    x, y = h1 % (n + 1), h2 % (n + 1)
    a, b = _cut(rows, last, before, np.minimum(x, y)), _cut(rows, last, before, np.maximum(x, y))
    marked = np.zeros(len(n), bool)
    marked[rows.markers()[0]] = True
    form = np.where((rows.sizes == 0) | marked | (h3 % 100 >= share), 0, np.where(h4 % 100 < spm_share, 2, 1))
    chars = np.concatenate([[0], np.cumsum((rows.data & 0xC0) != 0x80)])
    start, plain = rows.starts, form == 0
    prefix_chars = chars[start + a] - chars[start]
    middle_chars = chars[start + b] - chars[start + a]
    return pa.StructArray.from_arrays(
        [
            pa.array(n, pa.int64()),
            pa.array(_FORMS[form], pa.string()),
            pa.array(prefix_chars, pa.int64(), mask=plain),
            pa.array(middle_chars, pa.int64(), mask=plain),
            scatter(rows, form, a, b).strings(),
        ],
        fields=list(_RESULT),
    )


def _draw(doc_id: Column, seed: int, group: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    text: Column, doc_id: Column, seed: int = SEED, share: int = SHARE, spm_share: int = SPM_SHARE
) -> Column:
    """``struct<n, form, prefix_chars, middle_chars, output>`` of each text; the id and the seed fix all draws."""

    @F.arrow_udf("struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>")
    def transform(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        draws = [h.to_numpy(zero_copy_only=False) for h in (h1, h2, h3, h4)]
        parts = [
            _transform(rows, [h[a:b] for h in draws], share, spm_share) for a, b, rows in Rows.of(texts).blocks()
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], _RESULT)

    # Non-deterministic to the optimizer: several fields of the result must not run it several times.
    return transform.asNondeterministic()(text, *[_draw(doc_id, seed, group) for group in range(4)])


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was built from."""

    @F.arrow_udf("string")
    def restore(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        names = forms.to_numpy(zero_copy_only=False)
        code = np.where(names == SPM, 2, np.where(names == PSM, 1, 0))
        parts = [gather(rows, code[a:b]).strings() for a, b, rows in Rows.of(outputs).blocks()]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return restore(output, form)


def transformed(docs: DataFrame, seed: int = SEED, share: int = SHARE, spm_share: int = SPM_SHARE) -> DataFrame:
    """The documents with a column ``fim`` (see ``fill_in_middle``); a column of that name is replaced."""
    return docs.withColumn("fim", fill_in_middle(F.col("text"), F.col("doc_id"), seed, share, spm_share))


def digests(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, n, form, prefix_chars, middle_chars`` and the sha256 of output and restored text."""
    made = transformed(docs.select("doc_id", "text")).select("doc_id", "fim.*")
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
