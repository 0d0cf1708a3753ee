"""Repeated passages and the automaton against brute force."""

import random

from corpuslake.llm import repeated_passages as rep
from tests.llm.tables import DOCS, as_rows, awkward, awkward_rows, prose, with_extra


def expected(rows, window=rep.WINDOW):
    """Per row (id, words, removed, kept); a null id is larger than any."""
    split = [(t or "").encode().split() for _, t, *_ in rows]
    rank = [(i is None, i or 0) for i, *_ in rows]
    first = {}
    for words, own in zip(split, rank):
        for k in range(len(words) - window + 1):
            passage = tuple(words[k : k + window])
            first[passage] = min(own, first.get(passage, own))
    found = []
    for (i, *_), words, own in zip(rows, split, rank):
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < own:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        found.append((i, len(words), len(gone), kept))
    return sorted(found, key=repr)


def test_automaton_matches_are_first_occurrences():
    rng = random.Random(4)
    for _ in range(60):
        texts = [[rng.choice("ab") for _ in range(rng.randrange(1, 25))] for _ in range(6)]
        automaton = rep.SuffixAutomaton()
        for owner, text in enumerate(texts):
            wanted = {}
            for end in range(4, len(text) + 1):
                for other in range(owner):
                    before = texts[other]
                    if any(before[k : k + 4] == text[end - 4 : end] for k in range(len(before) - 3)):
                        wanted[end] = other
                        break
            assert dict(automaton.matches(text, 4)) == wanted
            automaton.add(text, owner)


def test_awkward_rows(spark):
    found = rep.without_repeats(with_extra(awkward(spark)))
    assert as_rows(found) == expected(awkward_rows())
    assert rep.without_repeats(awkward(spark).limit(0)).count() == 0


def test_passages_in_many_documents_and_hot_lines(spark, monkeypatch):
    monkeypatch.setattr(rep, "HOT_SHARE", 300)  # makes the common line hot on a small table
    rng = random.Random(8)
    line, passages = prose(50, 16), [prose(60 + k, 40) for k in range(5)]
    rows = []
    for i in range(300):
        parts = [prose(1000 + i, rng.randrange(5, 40))]
        if i % 3 == 0:
            parts.append(line)
        if i % 4 == 0:
            parts.append(rng.choice(passages))
        if i % 50 == 7:
            parts = [rows[-1][1]]
        parts.append(prose(3000 + i, rng.randrange(0, 30), 16))
        rows.append((i, " ".join(parts), None, None, None))
    frame = spark.createDataFrame(rows, DOCS).repartition(7)
    assert as_rows(rep.without_repeats(frame)) == expected(rows)


def test_passages_repeated_inside_a_document(spark, monkeypatch):
    """All places of a passage go, wherever the earlier document is: other batch, same batch before or behind."""
    passage, line = prose(70, 40), prose(71, 13)

    def rows_with(order):
        rows = []
        for i in order:
            parts = [prose(5000 + i, 20)]
            if i % 3 == 0:
                parts += [passage, prose(6000 + i, 15), passage, line, passage][: 1 + i % 5]
            if i % 2 == 0:
                parts += [line, prose(7000 + i, 9), line]
            rows.append((i, " ".join(parts), None, None, None))
        return rows

    for share in (rep.HOT_SHARE, 30):
        monkeypatch.setattr(rep, "HOT_SHARE", share)
        for order in (range(60), range(59, -1, -1)):
            rows = rows_with(order)
            for parts in (1, 6):
                frame = spark.createDataFrame(rows, DOCS).coalesce(1) if parts == 1 else spark.createDataFrame(rows, DOCS).repartition(parts)
                assert as_rows(rep.without_repeats(frame)) == expected(rows)


def test_blocks_give_words_anchors_and_pieces_of_each_text(monkeypatch):
    texts = [
        b"", b" \t\r\n\x0b\x0c ", b"one", *(" ".join(f"w{(7 * k + n) % 23} é" for n in range(60)).encode() for k in range(4)),
        b"  a\tb  c\n" * 20, b"x" * 500, b"\x1c \x1c\x1d z " * 15, " ".join("ab" * (n % 5 + 1) for n in range(90)).encode(),
    ]
    hashes = {}
    for size in (1, 64, 1 << 17):
        monkeypatch.setattr(rep, "BLOCK", size)
        runs = []
        for first, block in rep._blocks(texts):
            for k, text in enumerate(texts[first : first + len(block.before) - 1]):
                a, b = block.before[k], block.before[k + 1]
                split = text.split()
                assert [block.raw[x:y] for x, y in zip(block.left[a:b], block.right[a:b])] == split
                for word, value in zip(split, block.hashes[a:b].tolist()):
                    assert hashes.setdefault(word, value) == value
            owner, start, end, anchor = block.anchor_runs()
            for o, s, e, whole in zip(owner, start, end, block.pieces(start, end + rep.WINDOW - 1)):
                split, s, e = texts[first + o].split(), s - block.before[o], e - block.before[o]
                assert whole == b" ".join(split[s : e + rep.WINDOW - 1])
            runs += zip((owner + first).tolist(), (start - block.before[owner]).tolist(), (end - start).tolist(), anchor.tolist())
        windows = {(o, s + k): a for o, s, n, a in runs for k in range(n)}
        assert len(windows) == sum(max(0, len(t.split()) - rep.WINDOW + 1) for t in texts)
        # Equal windows have equal anchors, whatever lies around them.
        by_words = {}
        for (o, s), a in windows.items():
            assert by_words.setdefault(tuple(texts[o].split()[s : s + rep.WINDOW]), a) == a
    assert len(set(hashes.values())) == len(hashes)
