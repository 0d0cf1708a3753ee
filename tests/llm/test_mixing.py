"""The mix against its contract and a plain water filling."""

from collections import Counter

from pyspark.sql import functions as F

from corpuslake.llm import mixing
from tests.llm.tables import DOCS, as_rows, awkward, awkward_rows, prose, with_extra


def plain_targets(sizes):
    """Reshares what is above a stop, by weight, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, stopped = float(sum(sizes.values())), {}
    while True:
        open_ = [s for s in names if s not in stopped]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > 3 * sizes[s]]
        if not over:
            return {s: stopped.get(s, weight[s] * level) for s in names}
        for s in over:
            stopped[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]


def check(rows, frame, block):
    size = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += size(text)
    targets = plain_targets(sizes)
    taken = Counter()
    found = mixing.plan_mix(frame, block).collect()
    assert len(found) == len(rows)
    assert sorted((repr(r.doc_id), r.size) for r in found) == sorted((repr(i), size(t)) for i, t, *_ in rows)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - targets[r.source]) <= 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        assert (r.first_shard is None) == (r.taken == 0)
        taken[r.source] += r.taken
    for source in sizes:
        slack = max(2, targets[source] / block + 1)
        assert abs(taken[source] - targets[source]) <= slack, (source, taken[source], targets[source])
    return found


def test_awkward_rows_for_several_block_lengths(spark):
    frame = with_extra(awkward(spark)).cache()
    for block in (1, 64, 100_000):
        check(awkward_rows(), frame, block)


def test_capped_sources_and_reruns(spark):
    rows = [(i, prose(i, 5 + i % 40), "en", f"s{i % 7}" if i % 10 else "big", None) for i in range(200)]
    rows += [(1000 + i, prose(i, 400), "en", "huge", None) for i in range(10)]
    frame = spark.createDataFrame(rows, DOCS)
    found = check(rows, frame, 16)
    again = mixing.plan_mix(frame.repartition(5), 16)
    assert sorted(map(repr, found)) == sorted(map(repr, again.collect()))
    assert mixing.plan_mix(frame.limit(0)).count() == 0
    assert mixing.mixed_documents(frame.limit(0)).count() == 0


def test_permutations_are_permutations(spark):
    for size in (1, 2, 7, 1000):
        values = spark.range(size).select(mixing.permute(F.col("id"), F.lit(size).cast("long"), F.lit(3).cast("long")))
        assert sorted(r[0] for r in values.collect()) == list(range(size))


def test_shards_are_full_and_slots_unique(spark):
    rows = [(i, prose(i, 30), "en", f"s{i % 4}", None) for i in range(200)]
    draws = mixing.draws(mixing.targets(mixing.sized(spark.createDataFrame(rows, DOCS))), 4).cache()
    assert draws.select("shard", "slot").distinct().count() == draws.count()
    counts = [r["count"] for r in draws.groupBy("shard").count().orderBy("shard").collect()]
    assert set(counts[:-1]) == {mixing.SHARD_SLOTS}
    per_shard = draws.where("shard = 0").groupBy("sid").count().count()
    assert per_shard == 4


def test_mixed_documents_hold_what_the_plan_takes(spark):
    frame = with_extra(awkward(spark)).cache()
    mixed = mixing.mixed_documents(frame, 32)
    assert mixed.columns == frame.columns
    got, copies = Counter(), Counter()
    texts = {}
    for i, t, *_ in awkward_rows():
        texts.setdefault(i, set()).update(w.decode() for w in (t or "").encode().split())
    for r in mixed.collect():
        words = r.text.split(" ")
        got[r.doc_id] += len(words)
        copies[r.doc_id] += 1
        assert r.n_chars == len(r.text) and set(words) <= texts[r.doc_id]
    wanted = Counter()
    for r in mixing.plan_mix(frame, 32).collect():
        wanted[r.doc_id] += r.taken
    assert got == +wanted
    assert max(copies.values()) <= 6  # id 11 is there twice
    assert as_rows(mixed, "doc_id", "text") == as_rows(mixing.mixed_documents(frame.repartition(3), 32), "doc_id", "text")
