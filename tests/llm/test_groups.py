"""SimHash groups, components and fingerprints against brute force."""

import hashlib
import math
import random
from collections import Counter
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from corpuslake.llm import fingerprints as fing
from corpuslake.llm import simhash_groups as sim
from corpuslake.llm.components import connected_components
from tests.llm.tables import DOCS, as_rows, awkward, awkward_rows, with_extra


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def plain_simhash(text):
    words = []
    for word in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split():
        words.append(word)
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(200)] + [(500, k) for k in range(501, 700)] + [(900, 900), (None, 3), (901, 902)] * 2
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(220)]
    frame = spark.createDataFrame(edges, "u long, v long")
    real = [(a, b) for a, b in edges if a is not None and a != b]
    expected = union(real, {n for e in real for n in e})
    assert dict(map(tuple, connected_components(frame).collect())) == expected
    assert connected_components(frame.limit(0)).count() == 0


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = [m & (1 << 64) - 1 for m in sim.covering_masks(2)]
    assert len(masks) == 7
    for pair in combinations(range(64), 2):
        apart = sum(1 << p for p in pair)
        assert any(not m & apart for m in masks)


def test_fingerprints_equal_plain_ones(spark):
    found = {(r.doc_id, r.fp & (1 << 64) - 1) for r in sim.fingerprints(awkward(spark)).collect()}
    assert found == {(i, plain_simhash(t)) for i, t, *_ in awkward_rows()}


def test_groups_equal_all_pairs(spark):
    rng = random.Random(3)
    marks = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(300):  # chains of one and two flipped bits
        marks.append(rng.choice(marks) ^ 1 << rng.randrange(64) ^ (1 << rng.randrange(64)) * rng.randrange(2))
    marks = sorted(set(marks))
    frame = spark.createDataFrame([(sim._signed(m),) for m in marks], "fp long")
    labels = {r.node & (1 << 64) - 1: r.component for r in connected_components(sim.links(frame)).collect()}
    expected = union([p for p in combinations(marks, 2) if (p[0] ^ p[1]).bit_count() <= 2], marks)
    groups = {}
    for m in marks:
        groups.setdefault(expected[m], []).append(m)
    for members in groups.values():
        assert len({labels.get(m) for m in members}) == 1
        assert (labels.get(members[0]) is None) == (len(members) == 1)
    assert len({labels[g[0]] for g in groups.values() if len(g) > 1}) == sum(len(g) > 1 for g in groups.values())
    with pytest.raises(ValueError):
        sim.links(frame, 3)


def test_near_groups_of_awkward_rows(spark):
    rows = awkward_rows()
    marks = [plain_simhash(t) for _, t, *_ in rows]
    roots = union([(a, b) for a, b in combinations(range(len(rows)), 2) if (marks[a] ^ marks[b]).bit_count() <= 2], range(len(rows)))
    ids = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            ids[roots[k]] = min(i, ids.get(roots[k], i))
    expected = sorted(((i, ids.get(roots[k])) for k, (i, *_) in enumerate(rows)), key=repr)
    groups = sim.near_groups(with_extra(awkward(spark)))
    assert as_rows(groups, "doc_id", "component_id") == expected
    kept = with_extra(awkward(spark))
    found = sim.one_of_each_group(kept)
    assert found.columns == kept.columns
    assert sorted((r.doc_id for r in found.collect()), key=repr) == sorted(
        {i for i in ids.values()} | {None for r in set(roots.values()) if r not in ids}, key=repr
    )
    empty = awkward(spark).limit(0)
    assert sim.near_groups(empty).count() == 0 and sim.one_of_each_group(empty).count() == 0


def plain_fingerprint(text):
    """Bit by bit: each distinct word or run of five words votes with the logarithm of its count."""
    mask = (1 << 64) - 1

    def stir(x, salt):
        x ^= salt
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    words = (text or "").encode().lower().split()
    terms = Counter()
    for word in words:
        terms[1.0, xxhash.xxh64_intdigest(word)] += 1
    for k in range(max(1, len(words) - 4) if words else 0):
        mark = 0
        for n, word in enumerate(words[k : k + 5], 1):
            mark = stir(mark, n) + xxhash.xxh64_intdigest(word) & mask
        terms[4.0, stir(mark, 5)] += 1
    votes = [0.0] * 128
    for (scale, term), n in terms.items():
        bits = stir(term, 0x9E3779B97F4A7C15) | stir(term, 0xD1B54A32D192ED03) << 64
        for b in range(128):
            votes[b] += scale * math.log2(1 + n) * (1 if bits >> b & 1 else -1)
    # A vote this close to a draw may fall either way in floating point.
    return [None if abs(v) < 1e-9 and words else v > 0 for v in votes]


def test_document_fingerprints_equal_bitwise_votes():
    texts = [t for _, t, *_ in awkward_rows()] + ["a", "a b", "B b B a", "one two three four five six " * 9]
    for text in texts:
        mark = int.from_bytes(fing.fingerprint((text or "").encode()), "little")
        for b, vote in enumerate(plain_fingerprint(text)):
            assert vote is None or vote == bool(mark >> b & 1), (text, b)


def follow(rows):
    """Rows in the order in which they follow each other."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_edited_texts_and_likeness(spark):
    rows = [r for r in awkward_rows() if r[0] is not None]
    rows = sorted(set(rows), key=lambda r: r[0])
    found = {r.doc_id: r for r in fing.fingerprint_report(with_extra(awkward(spark, rows))).collect()}
    for k, (i, text, *_) in enumerate(rows):
        own, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(own) // 4
        edited = own[: len(own) - cut] + after[:cut]
        row = found[i]
        assert (row.n_chars, row.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        marks = [fing.fingerprint(t.encode()) for t in (own, edited, after)]
        assert (row.fp_a, row.fp_b) == fing._halves(marks[0])
        for value, other in ((row.near_edited, marks[1]), (row.near_next, marks[2])):
            apart = (int.from_bytes(marks[0], "little") ^ int.from_bytes(other, "little")).bit_count()
            assert math.isclose(value, max(0.0, math.cos(math.pi * apart / 128)) if apart else 1.0)
    assert found[11].near_edited > 0.6 > found[11].near_next
    everything = fing.with_edited(awkward(spark))
    assert everything.count() == len(awkward_rows())
    assert fing.fingerprint_report(awkward(spark).limit(0)).count() == 0
    one = fing.with_edited(awkward(spark, rows[:1])).first()
    assert one.near_next == 1.0


def test_search_counts_equal_brute_force(spark):
    rng = random.Random(9)
    marks = [rng.getrandbits(128) for _ in range(30)]
    for _ in range(400):
        mark = rng.choice(marks)
        for _ in range(rng.randrange(3)):
            mark ^= 1 << rng.randrange(128)
        marks.append(mark)
    frame = spark.createDataFrame([fing._halves(m.to_bytes(16, "little")) for m in marks], "fp_a long, fp_b long")
    found = {(r.fp_a, r.fp_b): r.n_within for r in fing.count_within(frame, frame.limit(200)).collect()}
    assert len(found) == frame.limit(200).distinct().count()
    for m in marks:
        key = fing._halves(m.to_bytes(16, "little"))
        if key in found:
            assert found[key] == sum((m ^ o).bit_count() <= 3 for o in marks)


def test_equal_ids_and_empty_schema(spark):
    frame = spark.createDataFrame([(1, "x y z", None, None, None)] * 3, DOCS)
    assert as_rows(sim.near_groups(frame), "doc_id", "component_id") == [(1, 1)] * 3
    assert sim.one_of_each_group(frame).count() == 1
    assert {r.near_next for r in fing.with_edited(frame).collect()} == {1.0}
    assert frame.select(F.xxhash64("text")).count() == 3
