"""Centroid clusters against plain integer rounds."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from corpuslake.llm import centroid_clusters as cc

ROWS = "vec_id long, embedding array<float>, label int"


def able(vector):
    return vector is not None and len(vector) == 64 and all(v is not None and math.isfinite(v) for v in vector)


def expected(rows, k=16, rounds=3):
    kept = []
    for i, vector, *_ in rows:
        if able(vector):
            x = tuple(
                math.floor(max(min(64 * float(np.float32(v)), float(cc.LIMIT)), -float(cc.LIMIT))) for v in vector
            )
            kept.append((i, x))
    digest = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [x for _, x in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        held = {}
        for _, x in kept:
            held.setdefault(nearest(x)[1], []).append(x)
        for n, xs in held.items():
            centroids[n] = tuple(sum(c) // len(xs) for c in zip(*xs))
    at_last = [(i, *nearest(x)) for i, x in kept]
    inertia = {}
    for _, d, n in at_last:
        inertia[n] = inertia.get(n, 0) + d
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    every = sum(d for _, d, _ in at_last)
    return sorted(((i, n, d, inertia[n], every, marks[n]) for i, d, n in at_last), key=repr)


def found(frame):
    return sorted((tuple(r) for r in cc.clusters(frame).collect()), key=repr)


def table():
    rng = random.Random(3)
    rows, number = [], 0
    for _ in range(20):
        centre = [rng.gauss(0, 0.2) for _ in range(64)]
        for _ in range(rng.randrange(1, 12)):
            rows.append((number, [c + rng.gauss(0, 0.05) for c in centre], number % 3))
            number += 1
    common = [rng.gauss(0, 0.1) for _ in range(64)]
    rows += [(1000 + n, common, None) for n in range(150)]  # a large group of copies
    rows += [rows[4], rows[4], (None, common, 1), (None, rows[9][1], 1)]  # repeated rows, null ids
    odd = (None, [], [0.0] * 63, [0.0] * 65, [None] * 64, [float("nan")] + [0.0] * 63, [0.0] * 63 + [float("-inf")])
    rows += [(2000 + n, v, 1) for n, v in enumerate(odd)]
    rows += [(3000, [0.0] * 64, 1), (3001, [3e38] + [0.0] * 62 + [-3e38], 1), (3002, [-0.0] * 64, 1)]
    return rows


def test_clusters_equal_plain_rounds(spark):
    rows = table()
    clash = {c: F.lit("clash") for c in ("x", "lead", "rest", "cluster", "distance", "h", "at", "value")}
    frame = spark.createDataFrame(rows, ROWS).withColumns(clash).repartition(5)
    assert found(frame) == expected(rows)


def test_ties_go_to_the_smaller_number(spark):
    rng = random.Random(8)  # few different integers, so that many distances are equal
    rows = [(n, [rng.choice((0.0, 1 / 64)) if c < 3 else 0.0 for c in range(64)], 1) for n in range(200)]
    assert found(spark.createDataFrame(rows, ROWS)) == expected(rows)


def test_few_vectors_and_none(spark):
    rows = [(n, [n / 8.0] * 64, 1) for n in range(5)]
    assert found(spark.createDataFrame(rows, ROWS)) == expected(rows)
    none = cc.clusters(spark.createDataFrame([(1, None, 1), (2, [1.0], 1)], ROWS))
    assert none.count() == 0 and none.columns == cc.clusters(spark.createDataFrame(rows, ROWS)).columns


def test_bounds_discard_centroids_and_never_the_nearest():
    rng = np.random.default_rng(1)
    centres = rng.integers(-40, 40, (16, 64))
    x = np.concatenate([c + rng.integers(-6, 7, (50, 64)) for c in centres])
    cov = np.cov(x.T)
    axes = np.linalg.eigh(cov)[1][:, ::-1][:, : cc.LEADING].T
    rotation = cc.Rotation(x.mean(0), np.ascontiguousarray(axes))
    nearest = cc.Nearest(centres, rotation)
    cluster, distance = nearest(x, *rotation.of(x.astype(float)))
    every = ((x[:, None] - centres[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert nearest.measured < 0.2 * every.size
