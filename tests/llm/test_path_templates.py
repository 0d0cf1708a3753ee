"""The url filter against rules read url by url and a tree built host by host."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from corpuslake.llm import path_templates as pt

ROWS = "page_id long, url string, html string"


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path, rules):
    fits = []
    for verdict, rule in rules:
        rule_host, slash, tail = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + tail):
            fits.append((len(rule), len(rule_host), rule, verdict))
    return max(fits)[2:] if fits else (None, None)


def expected(rows, rules=pt.RULES, label=None):
    """Host by host, from all urls, without patterns, copies or partial counts."""
    urls = [(i, *parsed(u), *ruled(*parsed(u), rules)) for i, u, *_ in rows]
    marks = [v if v else (label or {}).get(i) for i, _, _, _, v in urls]
    prior = sum(m == "block" for m in marks) / max(len(rows), 1)
    hosts = defaultdict(list)
    for (i, host, path, rule, verdict), mark in zip(urls, marks):
        pattern = re.sub(pt.MIXED, "#", re.sub(pt.DIGITS, "#", path))
        hosts[host].append((i, path, rule, verdict, mark, pattern.split("/")))
    out = []
    for host, held in hosts.items():
        places = Counter((at, s) for *_, segments in held for at, s in enumerate(segments[: pt.DEPTH]))
        literal = {p for p, n in places.items() if n >= 3 and 20 * n >= len(held)}

        def template(segments):
            kept = [s if (at, s) in literal else "*" for at, s in enumerate(segments[: pt.DEPTH])]
            return "/".join(kept) + ("/**" if len(segments) > pt.DEPTH else "")

        names = [template(segments) for *_, segments in held]
        for instead in (lambda t: "/".join("*" for _ in t.split("/")), lambda t: "**"):
            counts = Counter(names)
            names = [instead(t) if 200 * counts[t] < len(held) else t for t in names]
        counts = defaultdict(lambda: [0, 0, 0])
        for t, (*_, mark, _) in zip(names, held):
            counts[t][0] += 1
            counts[t][1] += mark == "block"
            counts[t][2] += mark == "allow"
        tree = pt.merge_tree(dict(counts))
        for t, (i, path, rule, verdict, _, _) in zip(names, held):
            merged, sums = tree[t]
            pure = pt.purity(sums, prior)
            own = "block" if pure >= pt.LEAST_PURITY else "allow"
            out.append((i, host, path, rule, verdict or own, merged, round(pure, 9)))
    return sorted(out, key=repr)


def found(frame, **kw):
    got = pt.judge(frame, **kw).withColumn("purity", F.round("purity", 9))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def table():
    rows = []

    def put(url, n=1):
        for _ in range(n):
            rows.append((len(rows), url, "<p>x</p>"))

    for n in range(900):  # a host with a third of all urls, numbers, slugs and a bad corner
        put(f"https://www.big.example.com/{('en', 'fr', 'de', 'es')[n % 4]}/{n}{('', '/', '.html')[n % 3]}")
        put(f"http://Big.Example.ORG/{('en', 'fr')[n % 2]}/story-{n % 300}-{'abcdefghij'[n % 10]}/page{n}?q=/x/{n}#t")
    for n in range(60):
        put(f"http://a.example.net/{('en', 'de', 'fr')[n % 3]}/{n}")
        put(f"http://b{n}.example.net/en/{n}")
        put(f"https://deep.example.com{'/d' * n}")
        put(f"https://hex.example.com/p/{n * 7919:08x}/x")
    for odd in (None, "", "no scheme", "://", "http://", "http://?x", "HTTP://NET", "http://net/", "http://net/en/",
                "http://example.net/en", "http://example.net/en/", "http://xexample.net/en/", "http://org/fr/1", "http://forg/fr/1",
                "a://b://c/d", "http://ÄÖ.ORG/fr/", "http://h/*/**/{a|b}", "http://h//", "http://h/ü/日本", "http://h\n/x"):
        put(odd, 2)
    put("http://very.example.com/" + "x/" * 20_000, 4)
    put("http://" + "h" * 5000 + ".org/a", 3)
    rows.append((None, "http://null.example.com/de/1", None))
    rows.append(rows[0])
    return rows


def test_verdicts_equal_a_url_by_url_version(spark):
    rows = table()
    clash = {c: F.lit("clash") for c in ("host", "path", "rule", "n", "urls", "label", "template", "_copy", "_page", "_own")}
    frame = spark.createDataFrame(rows, ROWS).withColumns(clash).repartition(7)
    got = found(frame)
    assert [r[:5] for r in got] == [r[:5] for r in expected(rows)]
    assert got == expected(rows)


def test_labels_reject_templates_of_urls_that_no_rule_fits(spark):
    rows = [(n, f"http://shop.test/{('deal', 'item')[n % 2]}/{n}", None) for n in range(400)]
    rows += [(1000 + n, f"http://calm.test/x/{n}", None) for n in range(400)]
    labels = {n: "block" for n in range(0, 400, 8)} | {n: "allow" for n in range(1, 400, 8)}
    labels |= {1000: "block"}
    column = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    frame = spark.createDataFrame(rows, ROWS).withColumn("known", column[F.col("page_id")])
    got = found(frame, rules=(), label="known")
    assert got == expected(rows, (), labels)
    verdicts = {r[0]: r[4] for r in got}
    assert all(verdicts[n] == "block" for n in range(0, 400, 2))
    assert all(verdicts[n] == "allow" for n in range(1, 400, 2))
    assert all(verdicts[n] == "allow" for n in range(1000, 1400))


def test_alike_branches_merge_and_unlike_ones_do_not():
    tree = {f"/{a}/{b}": [n, 0, 0] for a in ("en", "fr") for b, n in (("#", 50), ("#.html", 45))}
    tree |= {"/img/#.png": [100, 0, 0], "/de/#": [50, 50, 0], "/de/#.html": [45, 45, 0]}
    merged = {t: m for t, (m, _) in pt.merge_tree(tree).items()}
    assert merged["/en/#"] == merged["/fr/#"] and merged["/en/#"].startswith("/{en|fr}/")
    assert merged["/img/#.png"] == "/img/#.png"
    assert merged["/de/#"].startswith("/de/") and merged["/de/#"] == merged["/de/#.html"]


def test_empty_table(spark):
    none = pt.judge(spark.createDataFrame([], ROWS))
    assert none.count() == 0
    assert none.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
