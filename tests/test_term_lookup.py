"""Words meet the vocabulary where their chunks lie: whole chunks travel once, and words once per part."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuslake.operators import bm25

WORDS = [
    ("a_1", "x y x"), ("a_1", "w x y"), ("a_1", "z x"), ("a_2", "x x z unknown"), ("b_1", "X  y z"),
    (None, "x y"), (None, "q x"), (None, "y"), ("c_1", None), ("c_1", "w"), ("d_1", ""), ("1", "z z"),
]
TERMS = {"w": (3, 1, 2.0), "x": (0, 3, 0.5), "y": (1, 2, 1.0), "z": (2, 1, 2.5)}


@pytest.fixture
def no_broadcast(spark):
    """The plan of large tables: only what is marked for broadcast is broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _rows(spark):
    return spark.createDataFrame(WORDS, "unique_id string, text string")


def _terms(spark):
    return spark.createDataFrame([(t, *v) for t, v in TERMS.items()], "term string, term_idx long, df long, idf double")


def _exchanges(df):
    """What the plan that ran dealt its rows by, one entry for each exchange that was made."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [re.sub(r"^[\s:+\-*]*", "", line) for line in plan.splitlines()]
    return Counter(re.sub(r"#\d+|\(.*?\(|\).*", "", line) for line in lines if line.startswith("Exchange "))


def _places():
    number = F.pmod(F.xxhash64("unique_id"), F.lit(5))
    return [{}, {"parts": 3}, {"place": [F.substring("unique_id", 1, 1)]}, {"place": [number], "parts": 5}]


@pytest.mark.parametrize("hot_terms", [0, 3, 10**9])
def test_weights_of_repeated_and_null_keys(spark, no_broadcast, hot_terms):
    counted = Counter()
    for key, text in WORDS:
        words = re.split(r"\s+", text.lower().strip()) if text else []
        counted.update((key, word, len(words)) for word in words)
    expected = []
    for (key, word, length), tf in counted.items():
        if word in TERMS:
            idx, _, idf = TERMS[word]
            expected.append((key or "", idx, round(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length)), 9)))
    for where in _places():
        found = bm25.sparse_weights(_rows(spark), _terms(spark), None, hot_terms=hot_terms, **where).collect()
        assert sorted((r.unique_id or "", r.term_idx, round(r.score, 9)) for r in found) == sorted(expected)


def test_no_posting_travels_to_its_weight(spark, no_broadcast):
    for where in _places():
        made = _exchanges(bm25.sparse_weights(_rows(spark), _terms(spark), None, hot_terms=0, **where))
        # Chunks once and entries once by part; words asked for and the vocabulary by term.
        assert made == {"Exchange shufflepartitionidpassthrough_part": 2, "Exchange hashpartitioning(term, 8": 2}


def test_parts_follow_the_text(spark, monkeypatch):
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _rows(spark)
    assert bm25.parts_of(rows, "text") == usual and bm25.parts_of(rows.limit(0), "text") == usual
    monkeypatch.setattr(bm25, "PART_BYTES", 2)
    total = sum(len((t or "").encode()) for _, t in WORDS)
    assert bm25.parts_of(rows, "text") == -(-total // 2)


def test_vectors_of_repeated_and_null_keys(spark, no_broadcast):
    rows = _rows(spark).withColumn("n", F.monotonically_increasing_id())
    weights = bm25.sparse_weights(_rows(spark), _terms(spark), None).where("unique_id is not null").collect()
    expected = {}
    for r in weights:
        expected.setdefault(r.unique_id, {}).setdefault(r.term_idx, []).append(round(r.score, 9))
    lone = {key for key, n in Counter(key for key, _ in WORDS).items() if n == 1}
    for hot_terms in (0, 3, 10**9):
        for where in _places():
            got = bm25.add_sparse_vectors(rows.where("unique_id is null or unique_id <> 'a_1'"), _terms(spark), None, hot_terms=hot_terms, **where).collect()
            assert len(got) == len({r.n for r in got}) == len(WORDS) - 3
            for r in got:
                vector = {k: [round(v, 9)] for k, v in r.bm25_sparse_vector.items()}
                assert vector == (expected.get(r.unique_id, {}) if r.unique_id else {})
    assert lone & set(expected) == {"a_2", "b_1", "1"}


def test_no_posting_travels_to_its_vector(spark, no_broadcast):
    rows = _rows(spark).where("unique_id is null or unique_id <> 'a_1'")
    for where in _places():
        made = _exchanges(bm25.add_sparse_vectors(rows, _terms(spark), None, hot_terms=0, **where))
        assert made == {"Exchange shufflepartitionidpassthrough_part": 2, "Exchange hashpartitioning(term, 8": 2}
