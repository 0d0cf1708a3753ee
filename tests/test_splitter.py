"""Chunking against a plain step-by-step rendering of the same rules."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslake.functions.splitter import split_text

SEPARATORS = ["\n\n", "\n", " ", ""]


def pieces(text, separator):
    if not separator:
        return list(text)
    head, *tail = text.split(separator)
    return [p for p in [head, *(separator + t for t in tail)] if p]


def merge(parts, size, overlap, length):
    out, held = [], []
    for part in parts:
        if sum(map(length, held)) + length(part) > size and held:
            out.append("".join(held).strip())
            while held and (sum(map(length, held)) > overlap or sum(map(length, held)) + length(part) > size):
                held.pop(0)
        held.append(part)
    out.append("".join(held).strip())
    return [o for o in out if o]


def step_by_step(text, size, overlap, separators=SEPARATORS, length=len):
    if not text:
        return []
    at = next(i for i, s in enumerate(separators) if s in text)
    out, run = [], []
    for piece in pieces(text, separators[at]):
        if length(piece) < size:
            run.append(piece)
            continue
        out += merge(run, size, overlap, length) if run else []
        run = []
        rest = separators[at + 1 :]
        out += step_by_step(piece, size, overlap, rest, length) if rest else [piece]
    return out + (merge(run, size, overlap, length) if run else [])


texts = st.text(alphabet="ab \n", max_size=120)


@settings(max_examples=1500, deadline=None)
@given(texts, st.integers(2, 20), st.data())
def test_random_texts(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    assert split_text(text, size, overlap) == step_by_step(text, size, overlap)


def word_count(text):
    return len(text.split())


def byte_count(text):
    return len(text.encode())


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="ab é\n", max_size=120), st.integers(2, 9), st.data(), st.sampled_from([word_count, byte_count]))
def test_random_texts_under_other_lengths(text, size, data, length):
    overlap = data.draw(st.integers(0, size - 1))
    assert split_text(text, size, overlap, length=length) == step_by_step(text, size, overlap, length=length)


def test_real_texts_with_line_breaks():
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    for (text,) in rows:
        for size, overlap in ((256, 50), (512, 200), (30, 10)):
            assert split_text(text, size, overlap) == step_by_step(text, size, overlap)


def test_edges():
    assert split_text("", 10, 2) == []
    assert split_text("   ", 10, 2) == []
    assert split_text("a" * 25, 10, 4) == ["a" * 10, "a" * 10, "a" * 10, "a" * 7]
    assert split_text("one two", 256, 50) == ["one two"]
