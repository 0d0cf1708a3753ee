"""DuckDB SQL of the operators that SQL can express."""

from corpuslake.llm import centroid_clusters as cc
from corpuslake.llm import fill_in_middle as fim
from corpuslake.llm import mixing as m

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

REPEATED_PASSAGES = f"""
    WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
    places AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS start, words FROM w WHERE len(words) >= 13),
    windows AS (SELECT doc_id, start, array_to_string(words[start : start + 12], ' ') AS passage FROM places),
    firsts AS (SELECT passage, min(doc_id) AS first_doc FROM windows GROUP BY passage),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(start, start + 13)) AS place
        FROM windows JOIN firsts USING (passage) WHERE first_doc < doc_id
    ),
    marks AS (SELECT doc_id, list(place) AS places, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(array_to_string(
            [words[i] for i in range(1, len(words) + 1) if places IS NULL OR NOT list_contains(places, i)], ' '
        )) AS kept_sha256
    FROM w LEFT JOIN marks USING (doc_id)
"""

EMBEDDING_GROUPS = """
    WITH RECURSIVE able AS (
        SELECT vec_id, label, [x::DOUBLE for x in embedding] AS v FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
            AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
            AND len([x for x in embedding if x <> 0]) > 0
    ), links AS (
        SELECT a.vec_id AS u, b.vec_id AS v FROM able a JOIN able b
        ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= 0.98
    ), reach AS (
        SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
    ), counts AS (SELECT u, count(*) AS n FROM links GROUP BY u),
    least_ids AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
        vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
    FROM embeddings e LEFT JOIN counts c ON c.u = e.vec_id LEFT JOIN least_ids i ON i.u = e.vec_id
"""


def _mix(value: str) -> str:
    once = f"(((({value})::BIGINT) % {m.PRIME} * {m.C} + {m.D}) % {m.PRIME})"
    return f"(({once} * {once} % {m.PRIME} * {m.A} + {once}) % {m.PRIME})"


def _permuted(rows: str, x: str, size: str, tweak: str) -> str:
    """``rows`` with column ``x`` sent through the swap-or-not rounds."""
    for k in range(m.ROUNDS):
        partner = f"({_mix(f'{tweak} * 31 + {k * 7919 + m.SEED}')} + {size} - {x}) % {size}"
        coin = f"{_mix(f'greatest({x}, partner) + ' + _mix(f'{tweak} * 17 + {k * 104729 + m.SEED}'))} >= {m.PRIME // 2}"
        rows = (
            f"(SELECT * EXCLUDE (partner) REPLACE (CASE WHEN {coin} THEN partner ELSE {x} END AS {x}) "
            f"FROM (SELECT *, {partner} AS partner FROM {rows}))"
        )
    return rows


_BLOCK_OF = """CASE WHEN {w} < (source_size % blocks) * (source_size // blocks + 1) THEN {w} // (source_size // blocks + 1)
    ELSE source_size % blocks + ({w} - (source_size % blocks) * (source_size // blocks + 1)) // (source_size // blocks) END"""


def _edge(index: str) -> str:
    return f"({index} * (source_size // blocks) + least({index}, source_size % blocks))"


MIXING = f"""
    WITH sizes AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
    sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
    ranked AS (
        SELECT *, source_size * {m.MOST} AS stop, row_number() OVER (ORDER BY source NULLS LAST) AS sid,
            {list(m.WEIGHTS)}[((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % {len(m.WEIGHTS)} + 1]::BIGINT AS weight
        FROM sums
    ), rising AS (
        SELECT *, ((sum(source_size) OVER ())::BIGINT - ((sum(stop) OVER upto)::BIGINT - stop))
            / ((sum(weight) OVER ())::BIGINT - ((sum(weight) OVER upto)::BIGINT - weight)) AS level
        FROM ranked WINDOW upto AS (ORDER BY stop / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ), final AS (SELECT first(level ORDER BY stop / weight, sid) AS level FROM rising WHERE level * weight <= stop),
    sources AS (
        SELECT sid, r.source, source_size, least(stop::DOUBLE, coalesce(f.level * weight, stop::DOUBLE)) AS target
        FROM rising r LEFT JOIN final f ON true
    ), placed AS (
        SELECT *, (sum(size) OVER run)::BIGINT - size AS first FROM (
            SELECT z.*, sid, source_size, target,
                ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 6))::BIGINT % {m.SALTS} AS salt
            FROM sizes z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source
        ) WINDOW run AS (PARTITION BY sid ORDER BY salt, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ), shape AS (
        SELECT *, round(target)::BIGINT AS words,
            least(ceil(round(target) * blocks / source_size)::BIGINT, blocks * {m.MOST}) AS slots
        FROM (SELECT *, ceil(source_size / {m.BLOCK})::BIGINT AS blocks FROM sources WHERE source_size > 0)
    ), offsets AS (
        SELECT *, (sum(slots) OVER (ORDER BY sid))::BIGINT - slots AS before, (sum(slots) OVER ())::BIGINT AS all_slots FROM shape
    ), slots AS (
        SELECT *, k % blocks AS idx, before + k AS spot, sid * 8 + k // blocks AS tweak
        FROM (SELECT *, unnest(range(slots)) AS k FROM offsets)
    ), drawn AS (
        SELECT * FROM {_permuted(_permuted("slots", "idx", "blocks", "tweak"), "spot", "all_slots", "0")}
    ), read AS (
        SELECT sid, idx, count(*) FILTER (cut IS NULL) AS times, coalesce(sum(cut), 0)::BIGINT AS cut,
            min(spot // {m.SHARD_SLOTS}) FILTER (cut IS NULL) AS whole_shard,
            min(spot // {m.SHARD_SLOTS}) FILTER (cut IS NOT NULL) AS cut_shard
        FROM (SELECT *, CASE WHEN k = slots - 1 AND words - round((slots - 1) * (source_size / blocks)) < floor(source_size / blocks)
            THEN (words - round((slots - 1) * (source_size / blocks)))::BIGINT END AS cut FROM drawn)
        GROUP BY sid, idx
    ), pieces AS (
        SELECT sid, first, idx, greatest(first, {_edge("idx")}) - {_edge("idx")} AS begin,
            least(first + size, {_edge("(idx + 1)")}) - greatest(first, {_edge("idx")}) AS length
        FROM (SELECT p.sid, first, size, p.source_size, blocks,
            unnest(range({_BLOCK_OF.format(w="first")}, {_BLOCK_OF.format(w="(first + size - 1)")} + 1)) AS idx
            FROM (SELECT p.*, blocks FROM placed p JOIN shape USING (sid) WHERE size > 0) p)
    ), taken AS (
        SELECT sid, first, sum(length * times + part)::BIGINT AS taken,
            min(least(whole_shard, CASE WHEN part > 0 THEN cut_shard END)) AS first_shard
        FROM (SELECT *, greatest(0, least(length, cut - begin)) AS part FROM pieces JOIN read USING (sid, idx))
        WHERE times > 0 OR part > 0 GROUP BY sid, first
    )
    SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_shard
    FROM placed p LEFT JOIN taken t ON t.sid = p.sid AND t.first = p.first AND p.size > 0
"""

_P, _S, _M = (f"'{marker.decode()}'" for marker in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE))


def _drawn(group: int) -> str:
    return f"('0x' || substr(sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')), {8 * group + 1}, 8))::BIGINT"


FILL_IN_MIDDLE = rf"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS text, {", ".join(f"{_drawn(g)} AS h{g + 1}" for g in range(4))},
            regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
        FROM documents
    ), cuts AS (
        SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
            greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
            CASE WHEN text = '' OR contains(text, {_P}) OR contains(text, {_S}) OR contains(text, {_M})
                OR h3 % 100 >= {fim.SHARE} THEN 'plain' WHEN h4 % 100 < {fim.SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form
        FROM units
    ), parts AS (
        SELECT *, array_to_string(u[1 : a], '') AS prefix, array_to_string(u[a + 1 : b], '') AS middle,
            array_to_string(u[b + 1 : n], '') AS suffix FROM cuts
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN {_P} || prefix || {_S} || suffix || {_M} || middle
            ELSE {_S} || suffix || {_P} || prefix || {_M} || middle END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts
"""


def _clustered() -> str:
    """Lloyd's rounds one after another; vectors are rows of (vec_id, row, x), centroids (c, y)."""
    distance = (
        "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))::BIGINT"
    )
    steps = [
        f"""able AS (
        SELECT vec_id, row_number() OVER () AS row, [floor({cc.SCALE} * v::DOUBLE)::BIGINT for v in embedding] AS x
        FROM embeddings WHERE len(embedding) = {cc.DIMS}
            AND len([v for v in embedding if v IS NULL OR isnan(v) OR isinf(v)]) = 0
    )""",
        f"""c0 AS (
        SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x AS y FROM (
            SELECT sha256('{cc.SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM able ORDER BY h, x LIMIT {cc.K}
        )
    )""",
    ]
    for n in range(cc.ROUNDS + 1):
        steps.append(
            f"""d{n} AS (SELECT row, x, c, {distance} AS d FROM able, c{n}),
    a{n} AS (SELECT row, any_value(x) AS x, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{n} GROUP BY row)"""
        )
        if n < cc.ROUNDS:
            steps.append(
                f"""p{n} AS (SELECT c, i, sum(v)::BIGINT AS s, count(*)::BIGINT AS n
        FROM (SELECT c, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{n}) GROUP BY c, i),
    m{n} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS y FROM p{n} GROUP BY c),
    c{n + 1} AS (SELECT o.c, coalesce(m.y, o.y) AS y FROM c{n} o LEFT JOIN m{n} m ON m.c = o.c)"""
            )
    last = cc.ROUNDS
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
        (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(y, ',')) AS centroid_sha256
    FROM a{last} JOIN able USING (row) JOIN c{last} USING (c)"""


CENTROID_CLUSTERS = _clustered()

ORACLE = {
    "op3_repeated_passages": REPEATED_PASSAGES,
    "op9_embedding_groups": EMBEDDING_GROUPS,
    "op10_mixing": MIXING,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
    "op13_centroid_clusters": CENTROID_CLUSTERS,
}
