"""Embedding groups against all pairs."""

import math
import random

from pyspark.sql import functions as F

from corpuslake.llm import embedding_groups as emb
from tests.llm.tables import as_rows
from tests.llm.test_groups import union

ROWS = "vec_id long, embedding array<float>, label int"


def able(vector, label):
    return label is not None and vector and all(v is not None and math.isfinite(v) for v in vector) and any(vector)


def expected(rows, least=emb.LEAST):
    import numpy as np

    links, n = [], [0] * len(rows)
    units = {}
    for k, (_, vector, label) in enumerate(rows):
        if able(vector, label):
            x = np.array(np.array(vector, dtype=np.float32), dtype=np.float64)
            units[k] = x / np.linalg.norm(x)
    for a in units:
        for b in units:
            if a < b and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= least:
                links.append((a, b))
                n[a] += 1
                n[b] += 1
    roots = union(links, range(len(rows)))
    least_id = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least_id[roots[k]] = min(i, least_id.get(roots[k], i))
    return sorted(
        ((i, n[k], least_id.get(roots[k]), i is not None and i == least_id.get(roots[k])) for k, (i, *_) in enumerate(rows)),
        key=repr,
    )


def near(rng, vector, by):
    return [v + rng.gauss(0, by) for v in vector]


def table():
    rng = random.Random(11)
    rows, number = [], 0

    def put(vector, label):
        nonlocal number
        rows.append((number, vector, label))
        number += 1

    for label in (0, 1, None):
        for _ in range(25):
            centre = [rng.gauss(0, 1) for _ in range(24)]
            for _ in range(rng.randrange(1, 7)):
                put(near(rng, centre, rng.choice((0.0, 0.02, 0.08, 0.14, 0.2))), label)
    chain = [rng.gauss(0, 1) for _ in range(24)]
    for _ in range(30):  # a chain of links whose ends do not link
        chain = near(rng, chain, 0.12)
        put(chain, 2)
    common = [rng.gauss(0, 1) for _ in range(24)]
    for _ in range(60):
        put(common, 3)
        put(near(rng, common, 0.03), 3)
    put([2 * v for v in common], 3)
    for odd in (None, [], [0.0] * 24, [None] * 24, [float("nan")] + [1.0] * 23, [float("inf")] * 24, [1.0, 2.0], [2.0, 4.0]):
        put(odd, 3)
    rows += [(None, common, 3), (None, [1.0] * 24, 9), (5, rows[5][1], rows[5][2])]
    return rows


def test_groups_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(emb, "LIST_ROWS", 20)  # many lists, and several salts of a list
    rows = table()
    frame = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in ("vector", "class", "n", "links")})
    found = emb.embedding_groups(frame)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    # Vector 5 is there twice; a component is known by ids, so both rows are one node of it.
    assert as_rows(found) == expected(rows)


def test_nothing_to_link(spark):
    frame = spark.createDataFrame([(1, None, 1), (2, [0.0], 1), (3, [1.0], None), (None, None, None)], ROWS)
    assert as_rows(emb.embedding_groups(frame)) == expected([tuple(r) for r in frame.collect()])
    assert emb.embedding_groups(frame.limit(0)).count() == 0
