"""Byte-pair encoding as a streaming transducer, and decoding as a byte-to-text machine.

The encoder walks a text piece by piece (the tokenizer's own pre-splitting) and never
holds more than one group of pieces.  A piece that ends within the lookahead is merged
at once.  A longer one is fed byte by byte: for every prefix the last token of its
encoding is unique, because merges never cross a token boundary; no later token can
begin more than ``lookahead`` bytes (the longest token of the merge list) back, so the
boundary at which the paths of all prefixes inside the lookahead meet is final, the
tokens before it are emitted and their state is dropped.

The vocabulary file is read once per Python worker from ``path``.
"""

import codecs
import json
from collections import deque
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed: the pre-splitting pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GROUP = 2048  # pieces handled at once
CACHED = 300_000  # pieces remembered in each of two generations


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letter = _byte_letters()
        ids = spec["model"]["vocab"]
        raw = {token: bytes(letter[c] for c in token) for token in ids}
        special = [(t["content"], t["id"]) for t in spec["added_tokens"]]
        self.tokens = {ids[token]: value for token, value in raw.items()}
        self.tokens |= {number: content.encode() for content, number in special}
        self._by_id = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.special = dict(special)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if special else None
        self.pieces = regex.compile(PATTERN)
        # left id -> right id -> rank * 2**20 + new id, so the smallest value is the first merge
        self.merges = [{} for _ in range(max(self.tokens) + 1)]
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[left]][ids[right]] = rank << 20 | ids[left + right]
        self._number = list(range(len(self.merges)))  # one object per id, however often it is remembered
        self.shown = list(map(str, self._number))
        self.single = [0] * 256
        for token, value in raw.items():
            if len(value) == 1:
                self.single[value[0]] = ids[token]
        self.by_bytes = {raw[t]: ids[t] for t in raw}
        self.lookahead = max(map(len, raw.values()))
        self._young, self._old = {}, {}
        self._reachable, self._pairs = {}, {}

    # -- one piece -------------------------------------------------------------

    def merge(self, piece: bytes) -> list[int]:
        """All merges of a short piece: lowest rank first, leftmost first."""
        parts = [self.single[b] for b in piece]
        merges, never = self.merges, 1 << 62
        ranks = [merges[a].get(b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            parts[at : at + 2] = (best & 0xFFFFF,)
            del ranks[at]
            if at:
                ranks[at - 1] = merges[parts[at - 1]].get(parts[at], never)
            if at < len(ranks):
                ranks[at] = merges[parts[at]].get(parts[at + 1], never)
        return parts

    def _follows(self, left: int, right: int) -> bool:
        """Whether ``right`` may come after ``left``: their bytes together encode to the two."""
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHED:
                self._pairs.clear()
            known = self._pairs[key] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def _token(self, value: bytes) -> int | None:
        """The token of exactly these bytes, if encoding them gives it."""
        found = self.by_bytes.get(value)
        if found is None:
            return None
        good = self._reachable.get(found)
        if good is None:
            good = self._reachable[found] = self.merge(value) == [found]
        return found if good else None

    def stream(self, piece):
        """Tokens of an iterable of bytes, each as soon as it is final."""
        last = deque([None])  # token that ends at each kept position; positions start at ``base``
        base, recent, length = 0, bytearray(), 0
        for byte in piece:
            recent.append(byte)
            length += 1
            for size in range(min(self.lookahead, length - base), 0, -1):
                token = self._token(bytes(recent[-size:]))
                before = length - size - base
                if token is not None and (before == 0 or self._follows(last[before], token)):
                    last.append(token)
                    break
            if len(recent) >= 4 * self.lookahead:
                meeting = self._meeting(last, base, range(length - self.lookahead + 1, length + 1))
                if meeting > base:
                    yield from self._path(last, base, meeting)
                    for _ in range(meeting - base):
                        last.popleft()
                    last[0], base = None, meeting
                    del recent[: len(recent) - (length - base)]
        yield from self._path(last, base, length)

    def _meeting(self, last, base, ends) -> int:
        """Where the paths back from all ``ends`` have become one."""
        open_ends = set(ends)
        while len(open_ends) > 1:
            furthest = max(open_ends)
            open_ends.discard(furthest)
            open_ends.add(furthest - len(self.tokens[last[furthest - base]]))
        return open_ends.pop()

    def _path(self, last, base, end) -> list[int]:
        found = []
        while end > base:
            found.append(last[end - base])
            end -= len(self.tokens[found[-1]])
        return found[::-1]

    # -- texts -----------------------------------------------------------------

    def _entry(self, piece: str):
        """Ids of a piece that ends within the lookahead, remembered."""
        found = self._old.get(piece)
        if found is None:
            found = tuple(map(self._number.__getitem__, self.merge(piece.encode("utf-8"))))
        if len(self._young) >= CACHED:
            self._young, self._old = {}, self._young
        self._young[piece] = found
        return found

    def entries(self, text: str):
        """Groups of ids by piece, in order; a long piece comes in several groups."""
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                yield [(self.special[part],)]
                continue
            pieces = (m[0] for m in self.pieces.finditer(part)) if len(part) > 1 << 16 else self.pieces.findall(part)
            pieces = iter(pieces)
            while group := list(islice(pieces, GROUP)):
                found = list(map(self._young.get, group))
                start = 0
                for at in [k for k, entry in enumerate(found) if entry is None] if None in found else ():
                    if len(group[at]) <= self.lookahead:
                        found[at] = self._entry(group[at])
                    else:
                        yield found[start:at]
                        tokens = self.stream(iter(group[at].encode("utf-8")))
                        while some := list(islice(tokens, GROUP)):
                            yield [some]
                        start = at + 1
                yield found[start:]

    def decoder(self) -> "Decoder":
        return Decoder(self._by_id)

    def encode(self, text: str | None):
        """Groups of ids of a text, in order; null is empty."""
        for group in self.entries(text or ""):
            yield list(chain.from_iterable(group))


class Decoder:
    """Bytes of tokens (a list by id) into text as they come; a broken sequence gives U+FFFD."""

    def __init__(self, tokens: list[bytes]):
        self._tokens = tokens
        self._machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self._machine.decode(b"".join(map(self._tokens.__getitem__, ids)))

    def end(self) -> str:
        return self._machine.decode(b"", True)


_loaded: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def digest_text(model: Bpe, text: str | None) -> tuple[int, str, str]:
    """(number of tokens, sha256 of the ids, sha256 of the text decoded from them)."""
    ids_sha, text_sha, decoder, n = sha256(), sha256(), model.decoder(), 0
    for group in model.entries(text or ""):
        ids = list(chain.from_iterable(group))
        if ids:
            shown = ",".join(map(model.shown.__getitem__, ids))
            ids_sha.update(("," + shown if n else shown).encode())
            n += len(ids)
            text_sha.update(decoder.feed(ids).encode("utf-8"))
    text_sha.update(decoder.end().encode("utf-8"))
    return n, ids_sha.hexdigest(), text_sha.hexdigest()


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row of ``docs``; null text is empty."""

    def run(batches):
        model = bpe(path)
        for batch in batches:
            rows = [digest_text(model, text) for text in batch.column("text").to_pylist()]
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``docs`` with an array column of token ids; null text gives an empty array."""

    @F.udf("array<int>", useArrow=True)
    def run(text):
        model = bpe(path)
        parts = [np.array(group, dtype=np.int32) for group in model.encode(text)]
        return np.concatenate(parts).tolist() if parts else []

    return docs.withColumn(ids, run.asNondeterministic()(F.col("text")))


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its id column; null ids give null."""

    @F.udf("string", useArrow=True)
    def run(values):
        if values is None:
            return None
        decoder = bpe(path).decoder()
        values = iter(values)
        parts = []
        while group := list(islice(values, GROUP)):
            parts.append(decoder.feed(group))
        return "".join([*parts, decoder.end()])

    return encoded.withColumn(text, run.asNondeterministic()(F.col(ids)))


def encoded_documents(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, lang, source, n_tokens, ids, decoded_sha256)``, one row per row of ``docs``.

    The digest is of the text that decoding the ids gives.
    """
    kinds = dict(docs.select("doc_id", "lang", "source").dtypes)

    def run(batches):
        model = bpe(path)
        for batch in batches:
            ids, shas = [], []
            for text in batch.column("text").to_pylist():
                decoder, sha, found = model.decoder(), sha256(), []
                for group in model.encode(text):
                    sha.update(decoder.feed(group).encode("utf-8"))
                    found.append(np.array(group, dtype=np.int32))
                sha.update(decoder.end().encode("utf-8"))
                ids.append(np.concatenate(found) if found else np.empty(0, np.int32))
                shas.append(sha.hexdigest())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate([*ids, np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "lang", "source")),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    pa.array(shas, pa.string()),
                ],
                ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"],
            )

    shape = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
    return docs.select("doc_id", "lang", "source", "text").mapInArrow(
        run, f"{shape}, n_tokens long, ids array<int>, decoded_sha256 string"
    )
