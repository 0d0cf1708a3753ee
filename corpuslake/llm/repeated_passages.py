"""Removal of passages that repeat earlier documents, by suffix automata over reference shards.

The reference is the corpus itself, so it can be neither one automaton nor broadcast,
and streaming every document past every shard would grow with the square of the
corpus.  Passages therefore go to the one shard that can hold their match:

1. Every window of ``WINDOW`` words has an anchor, its run of ``RUN`` words with the
   least hash.  Equal windows have equal anchors.  Anchors are dealt by hash; those
   met in two documents are reported back to the documents that hold them.
2. Around each shared anchor a document cuts out the stretch of words whose windows
   have it, and sends it to the anchor's shard.  Anchors met in more than
   1/``HOT_SHARE`` of all sightings (so at most ``HOT_SHARE`` of them, which is what is
   broadcast) send window by window, each to a shard of its own.
3. A shard takes stretches by ascending document.  The earlier ones form a suffix
   automaton; streaming the next one through it gives its matching statistics, and a
   window that ends where at least ``WINDOW`` words match an earlier document is found.
4. Documents drop the words that their found windows cover.

Before rows leave a batch of documents, equal anchors, stretches and windows in it are
combined, so a passage that a third of all documents hold costs a row per batch.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.words import utf8_list, words
from corpuslake.sources.scratch import checkpointed

WINDOW = 13
RUN = 6
HOT_SHARE = 50_000
BLOCK = 1 << 17  # bytes hashed at once
_LAST = (1 << 63) - 1
# Any odd number serves; its inverse modulo 2^64 takes a power back.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class SuffixAutomaton:
    """All parts of the sequences added, each with the first owner; add by ascending owner."""

    def __init__(self):
        self.next, self.link, self.length, self.owner = [{}], [-1], [0], [None]

    def _state(self, edges, link, length, owner):
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.length) - 1

    def _split(self, at, word, to):
        """A state for the part that ends the way to ``to`` through ``at``."""
        copy = self._state(dict(self.next[to]), self.link[to], self.length[at] + 1, self.owner[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def add(self, sequence, owner):
        last = 0
        for word in sequence:
            to = self.next[last].get(word)
            if to is not None:
                last = to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
                continue
            new = self._state({}, 0, self.length[last] + 1, owner)
            at = last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                to = self.next[at][word]
                self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, word, to)
            last = new

    def matches(self, sequence, least):
        """``(end, owner)`` wherever the last ``least`` words also occur in what was added; the first owner."""
        state, length = 0, 0
        for end, word in enumerate(sequence, 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            to = self.next[state].get(word)
            if to is None:
                length = 0
                continue
            state, length = to, length + 1
            if length >= least:
                at = state
                while self.length[self.link[at]] >= least:
                    at = self.link[at]
                yield end, self.owner[at]


def _stir(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(byte: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Polynomials of the words' bytes in ``_BASE``, stirred, from running sums over ``BLOCK`` bytes or a longer word."""
    hashes = np.empty(len(left), dtype="u8")
    cuts = np.unique(np.searchsorted(left, np.arange(0, len(byte) + BLOCK, BLOCK)))
    for first, last in zip(cuts[:-1], cuts[1:]):
        begin, end = left[first:last] - left[first], right[first:last] - left[first]
        part = byte[left[first] : right[last - 1]].astype("u8") + np.uint64(1)
        powers = np.full(len(part), _BASE)
        powers[0] = 1
        sums = np.concatenate([np.zeros(1, dtype="u8"), np.cumsum(part * np.cumprod(powers))])
        powers[1:] = _INVERSE
        hashes[first:last] = (sums[end] - sums[begin]) * np.cumprod(powers)[begin]
    return _stir(hashes)


class _Block:
    """Some texts on end: the byte ``left`` and ``right`` of every word, its text's number, and the words' hashes."""

    def __init__(self, texts: list[bytes]):
        self.raw = b" ".join(texts)
        byte = np.frombuffer(self.raw, np.uint8)
        # A blank is a space or one of 0x09 to 0x0D, as for ``words``.
        solid = np.concatenate([[False], (byte != 32) & (byte - np.uint8(9) > 4), [False]])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.left, self.right = edges[::2], edges[1::2]
        begins = np.cumsum([0, *(len(text) + 1 for text in texts)])
        #: The number of words before each text, and of all.
        self.before = np.searchsorted(self.left, begins)
        self.hashes = _word_hashes(byte, self.left, self.right)
        # Gaps that are not one space.
        odd = (self.left[1:] - self.right[:-1] != 1) | (byte[self.right[:-1]] != 32)
        self._odd = np.concatenate([[0], np.cumsum(odd)])

    def pieces(self, start: np.ndarray, stop: np.ndarray):
        """Words ``start`` to ``stop`` (at least one), joined by one space."""
        plain = self._odd[stop - 1] == self._odd[start]
        for a, b, as_is in zip(self.left[start].tolist(), self.right[stop - 1].tolist(), plain.tolist()):
            yield self.raw[a:b] if as_is else b" ".join(words(self.raw[a:b]))

    def anchor_runs(self) -> tuple[np.ndarray, ...]:
        """``(owner, start, end, anchor)``: neighbouring windows of one text that share their anchor.

        ``start`` and ``end`` count the block's words; windows reach into no other text.
        """
        total = len(self.left)
        windows = total - WINDOW + 1
        if windows < 1:
            none = np.empty(0, np.int64)
            return none, none, none, none.astype("u8")
        run = np.zeros(total - RUN + 1, dtype="u8")
        for k in range(RUN):
            run = _stir(run + self.hashes[k : k + len(run)] + np.uint64(k + 1))
        least = run[:windows]
        for k in range(1, WINDOW - RUN + 1):
            least = np.minimum(least, run[k : k + windows])
        owner = np.repeat(np.arange(len(self.before) - 1), np.diff(self.before))[:windows]
        inside = np.arange(windows) + WINDOW <= self.before[owner + 1]
        same = (least[1:] == least[:-1]) & (owner[1:] == owner[:-1]) & (inside[1:] == inside[:-1])
        start = np.flatnonzero(np.concatenate([[True], ~same]))
        end = np.append(start[1:], windows)
        whole = inside[start]
        start, end = start[whole], end[whole]
        return owner[start], start, end, least[start]


def _blocks(texts: list[bytes]):
    """``(first, block)``: texts ``first``, ``first + 1``, ..., whole, some ``BLOCK`` bytes at a time."""
    first, size = 0, 0
    for k, raw in enumerate(texts, 1):
        size += len(raw) + 1
        if size >= BLOCK or k == len(texts):
            yield first, _Block(texts[first:k])
            first, size = k, 0


def _pack(high: np.ndarray) -> bytes:
    """40-bit numbers, five bytes each."""
    return np.ascontiguousarray(high.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _cuts(values: np.ndarray) -> np.ndarray:
    """Starts of runs of equal neighbours."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    """``(id, hash, rid, text)``: a null id ranks last; ``rid`` is the row's number for joins."""
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    rows = docs.select(id_.alias("id"), F.xxhash64("text").alias("hash"), "doc_id", "text")
    return rows.select("id", "hash", F.xxhash64("id", "hash").alias("rid"), "doc_id", "text")


_SIGHTINGS = "shard int, kind int, rid long, high binary, low binary, counts binary, at binary, rids binary"


def _sightings(rows: DataFrame, shards: int) -> DataFrame:
    """Anchors per batch and shard (kind 0), and those that two documents of one batch share, per document (kind 1)."""

    def run(batches):
        for batch in batches:
            rids = batch.column("rid").to_numpy()
            anchors, owners = [], []
            for first, block in _blocks(utf8_list(batch.column("text"))):
                owner, _, _, anchor = block.anchor_runs()
                anchors.append(anchor)
                owners.append((owner + first).astype(np.uint32))
            out = []
            if sum(map(len, anchors)):
                anchors, owners = np.concatenate(anchors), np.concatenate(owners)
                order = np.argsort(anchors, kind="stable")
                anchors, owners = anchors[order], owners[order]
                # Each document counts once.
                once = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (owners[1:] != owners[:-1])])
                anchors, owners = anchors[once], owners[once]
                starts = _cuts(anchors)
                counts = np.diff(np.append(starts, len(anchors)))
                many = np.repeat(counts > 1, counts)
                shared, holders = anchors[many], owners[many]
                order = np.argsort(holders, kind="stable")
                shared, holders = shared[order], holders[order]
                begins = _cuts(holders)
                for begin, end in zip(begins, np.append(begins[1:], len(holders))):
                    rid = int(rids[holders[begin]])
                    out.append((rid % shards, 1, rid, _pack(shared[begin:end] >> np.uint64(24)), None, None, None, None))
                anchors, owners = anchors[starts], owners[starts]
                places = (anchors & np.uint64(0xFFFFFF)) % np.uint64(shards)
                order = np.argsort(places, kind="stable")
                anchors, owners, counts, places = anchors[order], owners[order], counts[order], places[order]
                begins = _cuts(places)
                for begin, end in zip(begins, np.append(begins[1:], len(places))):
                    part = slice(begin, end)
                    table, at = np.unique(owners[part], return_inverse=True)
                    low = (anchors[part] & np.uint64(0xFFFFFF)).astype("<u4") // np.uint32(shards)
                    out.append(
                        (int(places[begin]), 0, 0, _pack(anchors[part] >> np.uint64(24)), low.astype("<u2").tobytes(),
                         np.minimum(counts[part], 65535).astype("<u2").tobytes(), at.astype("<u4").tobytes(),
                         rids[table].tobytes())
                    )
            columns = list(zip(*out)) if out else [()] * 8
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _SIGHTINGS_NAMES)

    return rows.select("rid", "text").mapInArrow(run, _SIGHTINGS)


_SIGHTINGS_NAMES = [part.split()[0] for part in _SIGHTINGS.split(", ")]


def _reports(sightings: DataFrame, shards: int) -> DataFrame:
    """``(rid, shared, n)``: shared anchors of a document; with a null ``rid``, an anchor and its sightings ``n``."""
    columns = ["shard", *_SIGHTINGS_NAMES[1:]]
    dealt = sightings.repartitionById(shards, F.col("shard")).select(*columns)

    def run(batches):
        high, low, counts, rids = [], [], [], []
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            passed = np.flatnonzero(kinds == 1)
            if len(passed):
                own = batch.take(pa.array(passed))
                yield pa.RecordBatch.from_arrays(
                    [own.column("rid"), own.column("high"), pa.nulls(len(passed), pa.int64())], ["rid", "shared", "n"]
                )
            for k in np.flatnonzero(kinds == 0):
                high.append(_unpack(batch.column("high")[k].as_py()))
                low.append(np.frombuffer(batch.column("low")[k].as_py(), "<u2"))
                counts.append(np.frombuffer(batch.column("counts")[k].as_py(), "<u2"))
                table = np.frombuffer(batch.column("rids")[k].as_py(), "<i8")
                rids.append(table[np.frombuffer(batch.column("at")[k].as_py(), "<u4")])
        if not high:
            return
        high, low, counts, rids = map(np.concatenate, (high, low, counts, rids))
        whole = high << np.uint64(16) | low.astype("u8")
        order = np.argsort(whole, kind="stable")
        whole, high, counts, rids = whole[order], high[order], counts[order].astype(np.int64), rids[order]
        starts = _cuts(whole)
        entries = np.diff(np.append(starts, len(whole)))
        sums = np.add.reduceat(counts, starts)
        told = np.repeat(sums > 1, entries) & (counts == 1)
        owners, shared = rids[told], high[told]
        order = np.argsort(owners, kind="stable")
        owners, shared = owners[order], shared[order]
        begins = _cuts(owners)
        packed = [_pack(shared[a:b]) for a, b in zip(begins, np.append(begins[1:], len(owners)))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(owners[begins], pa.int64()), pa.array(packed, pa.binary()), pa.nulls(len(begins), pa.int64())],
            ["rid", "shared", "n"],
        )
        often = sums >= 8
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(int(often.sum()), pa.int64()), pa.array([_pack(h[None]) for h in high[starts][often]], pa.binary()),
             pa.array(sums[often], pa.int64())], ["rid", "shared", "n"],
        )
        # The number of sightings, from which the share that counts as hot is taken.
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([int(counts.sum())], pa.int64())], ["rid", "shared", "n"],
        )

    return dealt.mapInArrow(run, "rid long, shared binary, n long")


def _told_stretches(block: _Block, lists: list[bytes], first: int, often: np.ndarray):
    """``(document, start, stop, anchor, single, text)``: its words around each anchor reported to it in ``lists``.

    ``single`` marks windows of anchors in ``often``, which are given one by one.  The
    block's documents follow ``first`` in ``lists`` and are counted from there.
    """
    lists = lists[first : first + len(block.before) - 1]
    owner, start, end, anchor = block.anchor_runs()
    told = np.repeat(np.arange(len(lists)), [len(x) // 5 for x in lists]).astype("u8") << np.uint64(40)
    told |= _unpack(b"".join(lists))
    wanted = np.isin(owner.astype("u8") << np.uint64(40) | anchor >> np.uint64(24), told)
    owner, start, end, anchor = owner[wanted], start[wanted], end[wanted], anchor[wanted]
    single = np.isin(anchor >> np.uint64(24), often)
    times = np.where(single, end - start, 1)
    which = np.repeat(np.arange(len(times)), times)
    begin = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    owner, single = owner[which], single[which]
    stop = np.where(single, begin + 1, end[which]) + WINDOW - 1
    place = block.before[owner]
    columns = (owner, begin - place, stop - place, anchor[which].view(np.int64), single)
    return zip(*(column.tolist() for column in columns), block.pieces(begin, stop))


_STRETCHES = "shard int, anchor long, sub long, id long, hash long, rid long, words binary, starts binary"
_STRETCHES_NAMES = [part.split()[0] for part in _STRETCHES.split(", ")]


def _stretches(told: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """Stretches for the shards with all their ``starts`` in the document; without ``words``, starts of windows already found."""
    shared_hot = told.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        often = shared_hot.value
        for batch in batches:
            ids, hashes, rids = (batch.column(c).to_pylist() for c in ("id", "hash", "rid"))
            lists = [b"".join(x) for x in batch.column("lists").to_pylist()]
            # Per stretch the row with the least id and all places where that row has it.
            seen: dict[bytes | tuple, tuple] = {}
            found: dict[int, list] = {}
            for first, block in _blocks(utf8_list(batch.column("text"))):
                for k, start, stop, anchor, single, text in _told_stretches(block, lists, first, often):
                    k += first
                    held = seen.get(text)
                    if held is None:
                        seen[text] = (k, [start], anchor, single)
                    elif k == held[0]:
                        held[1].append(start)
                    elif ids[k] > ids[held[0]]:
                        found.setdefault(k, []).append((start, stop - start))
                    elif ids[k] < ids[held[0]]:
                        found.setdefault(held[0], []).extend((place, stop - start) for place in held[1])
                        seen[text] = (k, [start], anchor, single)
                    else:
                        seen.setdefault((text, k), (k, [], anchor, single))[1].append(start)
            out = []
            for text, (k, places, anchor, single) in seen.items():
                text = text if isinstance(text, bytes) else text[0]
                sub = xxhash.xxh64_intdigest(text, 1) - (1 << 63) if single else 0
                starts = np.array(places, dtype="<i4")
                out.append(((anchor * 31 + sub) % shards, anchor, sub, ids[k], hashes[k], rids[k], text, starts.tobytes()))
            for k, spans in found.items():
                starts = np.concatenate([np.arange(start, start + length - WINDOW + 1) for start, length in spans])
                out.append((rids[k] % shards, None, None, ids[k], hashes[k], rids[k], None, starts.astype("<i4").tobytes()))
            columns = list(zip(*out)) if out else [()] * 8
            kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _STRETCHES_NAMES)

    return told.mapInArrow(run, _STRETCHES)


class _Shard:
    """Stretches that share an anchor, by ascending document."""

    def __init__(self):
        self.first, self.automaton = {}, None

    def look(self, text: bytes, owner: int) -> list[int]:
        """Starts, in the stretch, of windows that an earlier document has; then the stretch joins the reference."""
        sequence = None
        known = self.first.get(text)
        if known is not None and known < owner:
            return list(range(text.count(b" ") + 2 - WINDOW))
        found = []
        if self.first and (known is None or len(self.first) > 1):
            sequence = text.split(b" ")
            if self.automaton is None:
                self.automaton = SuffixAutomaton()
                for other, other_owner in self.first.items():
                    self.automaton.add(other.split(b" "), other_owner)
            found = [end - WINDOW for end, first in self.automaton.matches(sequence, WINDOW) if first < owner]
        if known is None:
            if self.automaton is not None:
                self.automaton.add(sequence or text.split(b" "), owner)
            self.first[text] = owner
        return found


def _found(stretches: DataFrame, shards: int) -> DataFrame:
    """``(rid, id, hash, starts)``: windows of documents that an earlier document has."""
    order = ["anchor", "sub", "id", "hash"]
    dealt = stretches.repartitionById(shards, F.col("shard")).sortWithinPartitions(*order)

    def run(batches):
        key, shard = None, None
        for batch in batches:
            out = {}
            columns = [batch.column(c).to_pylist() for c in _STRETCHES_NAMES[1:]]
            for anchor, sub, id_, hash_, rid, text, places in zip(*columns):
                places = np.frombuffer(places, "<i4")
                if text is None:
                    out.setdefault((rid, id_, hash_), []).append(places)
                    continue
                if (anchor, sub) != key:
                    key, shard = (anchor, sub), _Shard()
                starts = shard.look(text, id_)
                if starts:
                    out.setdefault((rid, id_, hash_), []).append(np.add.outer(places, np.array(starts, dtype="<i4")).ravel())
            rows = [(*k, np.concatenate(v).astype("<i4").tobytes()) for k, v in out.items()]
            columns = list(zip(*rows)) if rows else [()] * 4
            kinds = [*[pa.int64()] * 3, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["rid", "id", "hash", "starts"])

    return dealt.mapInArrow(run, "rid long, id long, hash long, starts binary")


def _kept_words(found: list[bytes], starts: list[np.ndarray]) -> list[bytes]:
    if not starts:
        return found
    edges = np.zeros(len(found) + 1, dtype=np.int64)
    at = np.unique(np.concatenate(starts))
    edges[at] += 1
    edges[at + WINDOW] -= 1
    covered = np.cumsum(edges[:-1]) > 0
    return [w for w, gone in zip(found, covered.tolist()) if not gone]


def without_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` per row of ``docs``; ``kept`` is what stays, one space between words.

    A word goes if one of the windows of ``WINDOW`` words that cover it also starts in
    a document with a smaller id; windows are judged on the texts as given.  A null
    text has no words; a null id counts as larger than any; rows with equal ids never
    take from each other.  Other columns are not read.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _keyed(docs)
    # Anchors are small: fewer shards for them, so that a document is reported to in fewer rows.
    anchor_shards = max(12, shards // 3)
    reports = checkpointed(_reports(_sightings(rows, anchor_shards), anchor_shards))
    total = reports.where("rid is null and shared is null").agg(F.sum("n")).first()[0] or 0
    least = max(8, total // HOT_SHARE)
    # At most HOT_SHARE anchors can have so many of all sightings.
    often = reports.where("rid is null and shared is not null").where(F.col("n") > least).select("shared").toArrow()
    hot = np.unique(_unpack(b"".join(often.column("shared").to_pylist())))
    lists = reports.where("rid is not null").groupBy("rid").agg(F.collect_list("shared").alias("lists"))
    # The same columns as in the last join, so that the texts are shuffled once for both.
    told = rows.join(lists, "rid").select("id", "hash", "rid", "doc_id", "text", "lists")
    windows = _found(_stretches(told, hot, shards), shards)
    windows = windows.groupBy("rid").agg(F.collect_list(F.struct("id", "hash", "starts")).alias("windows"))

    def run(batches):
        for batch in batches:
            ids, hashes = batch.column("id").to_pylist(), batch.column("hash").to_pylist()
            out = []
            for k, (raw, own) in enumerate(zip(utf8_list(batch.column("text")), batch.column("windows").to_pylist())):
                found = words(raw)
                mine = [np.frombuffer(x["starts"], "<i4") for x in own or () if (x["id"], x["hash"]) == (ids[k], hashes[k])]
                kept = _kept_words(found, mine)
                out.append((len(found), len(found) - len(kept), b" ".join(kept)))
            columns = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    whole = rows.join(windows, "rid", "left").select("id", "hash", "rid", "doc_id", "text", "windows")
    return whole.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")
