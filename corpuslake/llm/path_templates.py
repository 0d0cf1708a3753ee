"""URL filter by a tree of path templates per host.

Rules judge the urls they fit; their verdicts are also the labels from which the method
judges the others.  Runs of digits become ``#`` in a path.  Of what is left, a segment
is literal in its place if it holds at least 1/20 of the host's urls, else it is the
wildcard ``*``.  A template that holds less than 1/200 of its host's urls gives up its
literals, and where that is not enough it joins ``**``.  So a host has at most 20 literals
in each of DEPTH places and 401 templates, however many urls it has, and these form its tree.  Sibling
branches whose tails and whose labels do not differ by more than chance are merged, from
the root down.  A merged template is rejected if the share of blocked among its labelled
urls, smoothed towards the share of blocked urls in the whole table, reaches ``LEAST_PURITY``.
A template without labelled urls is only as bad as the whole table.

All counts are taken per distinct pattern before anything is shuffled by host.  Facts of
a host are one bounded row; hosts with more than 1/1,000 of all rows get copies of it in
proportion, and their rows are dealt over these copies.

Null urls and urls without ``://`` have an empty host and path; rules never fit them, the
method judges them as one host.  Repeated urls count as often as they come.
"""

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.sources.scratch import checkpointed

# Fixed: the rules of the query, as (verdict, host and path).
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
BLOCK, ALLOW = "block", "allow"
LITERAL_SHARE = 20  # a literal holds at least 1/20 of its host's urls, and
LEAST_ROWS = 3  # so many
DEPTH = 16  # levels of a tree; what lies deeper is one wildcard
TEMPLATE_SHARE = 200  # a template holds at least 1/200 of its host's urls
LEAST_CHANCE = 0.01  # branches are similar if chance explains their difference so often
LEAST_PURITY = 0.75
SMOOTHING = 8.0  # urls of the whole table's kind that are added to a template's labelled ones
SPREAD = 1000  # copies of host facts that all rows together ask for
REST = "**"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGITS = r"[0-9]+"
MIXED = r"(?:[a-f]*#){2,}[a-f]*"  # what is left of hexadecimal names


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters in lower case) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits, else nulls; of equally long ones the longer host, then the first.

    The rules are an expression, so their number is meant to stay in the hundreds.
    """
    parted = [(verdict, text, *text.partition("/")[::2]) for verdict, text in rules]
    ordered = sorted(parted, key=lambda r: (-len(r[1]), -len(r[2])))
    rule = verdict = None
    for word, text, rule_host, _ in ordered:
        rule_path = text[len(rule_host) :]
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, word) if verdict is None else verdict.when(fits, word)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _pattern(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, DIGITS, "#"), MIXED, "#")


def _place(at: Column, segment: Column) -> Column:
    return F.concat(at.cast("string"), F.lit("/"), segment)


def _segments(pattern: Column) -> Column:
    return F.slice(F.split(pattern, "/"), 1, DEPTH)


def _template(pattern: Column, literals: Column) -> Column:
    """The pattern with ``*`` for each segment that is no literal of its host in its place."""
    kept = F.transform(
        _segments(pattern),
        lambda s, i: F.when(F.array_contains(literals, _place(i, s)), s).otherwise(F.lit("*")),
    )
    deeper = F.when(F.size(F.split(pattern, "/")) > DEPTH, f"/{REST}").otherwise("")
    return F.concat(F.array_join(kept, "/"), deeper)


def _wild(template: Column) -> Column:
    return F.array_join(F.transform(F.split(template, "/"), lambda s: F.lit("*")), "/")


def join_host_facts(rows: DataFrame, facts: DataFrame, weight: str, total: int, deal: Column) -> DataFrame:
    """Adds a host's facts (one row per host) to its rows.

    ``weight`` is the number of rows the host has here and ``total`` that of all rows.  Fewer
    than SPREAD hosts have more than 1/SPREAD of them; these are broadcast with their number
    of copies, which together are at most twice SPREAD.
    """
    copies = F.greatest(F.lit(1), F.floor(F.col(weight) * F.lit(SPREAD / max(total, 1)))).cast("int")
    facts = facts.withColumn("_copies", copies)
    hot = facts.where("_copies > 1 and length(host) <= 1024").select("host", "_copies")
    dealt = rows.join(F.broadcast(hot), "host", "left").withColumn(
        "_copy", F.pmod(F.xxhash64(deal), F.coalesce("_copies", F.lit(1))).cast("int")
    )
    last = F.when(F.length("host") <= 1024, F.col("_copies") - 1).otherwise(0)
    spread = facts.withColumn("_copy", F.explode(F.sequence(F.lit(0), last))).drop("_copies", weight)
    return dealt.drop("_copies").join(spread, ["host", "_copy"], "left").drop("_copy")


# -- the tree of one host ------------------------------------------------------------


class Branch:
    """A branch of the tree: ``[urls, blocked, allowed]`` that end here, and branches by segment."""

    def __init__(self):
        self.ends = [0, 0, 0]
        self.below = {}

    def put(self, segments, counts):
        branch = self
        for segment in segments:
            branch = branch.below.setdefault(segment, Branch())
        branch.ends = [a + b for a, b in zip(branch.ends, counts)]

    def paths(self, before=()):
        if self.ends[0]:
            yield before, self.ends
        for segment, branch in self.below.items():
            yield from branch.paths((*before, segment))

    def profile(self):
        """Urls by tail, and by label."""
        tails, labels = Counter(), Counter()
        for tail, (n, blocked, allowed) in self.paths():
            tails["/".join(tail)] += n
            labels[BLOCK] += blocked
            labels[ALLOW] += allowed
            labels[None] += n - blocked - allowed
        return tails, labels


def chance(a: Counter, b: Counter, least: int) -> float:
    """How likely two counts of one kind differ as much as these (G-test); rare kinds are taken together."""
    kinds = sorted(set(a) | set(b), key=str)
    cells = [(a[k], b[k]) for k in kinds if a[k] + b[k] >= max(least, 1)]
    rare = [(a[k], b[k]) for k in kinds if 0 < a[k] + b[k] < max(least, 1)]
    if rare:
        cells.append((sum(x for x, _ in rare), sum(y for _, y in rare)))
    if len(cells) < 2:
        return 1.0
    left, right = sum(x for x, _ in cells), sum(y for _, y in cells)
    total = left + right
    g = 0.0
    for cell in cells:
        for seen, side in zip(cell, (left, right)):
            if seen:
                g += 2 * seen * math.log(seen * total / (side * sum(cell)))
    free = len(cells) - 1
    # Wilson and Hilferty's normal approximation of the chi-square tail.
    z = ((max(g, 0.0) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    return 0.5 * math.erfc(z / math.sqrt(2))


def likeness(a, b) -> float:
    return min(chance(a[0], b[0], 5), chance(a[1], b[1], 0))


def _merged_siblings(branch: Branch):
    """Groups of segments whose branches are alike: the likest pair merges first, until none is like enough."""
    groups = [((segment,), below.profile()) for segment, below in sorted(branch.below.items())]
    while True:
        best = None
        for i, (_, x) in enumerate(groups):
            for j in range(i + 1, len(groups)):
                like = likeness(x, groups[j][1])
                if like >= LEAST_CHANCE and (best is None or like > best[0]):
                    best = like, i, j
        if best is None:
            return [names for names, _ in groups]
        _, i, j = best
        (names, x), (more, y) = groups[i], groups.pop(j)
        groups[i] = tuple(sorted((*names, *more))), (x[0] + y[0], x[1] + y[1])


def _merged_name(names) -> str:
    return names[0] if len(names) == 1 else "{" + "|".join(names) + "}"


def merge_tree(templates: dict) -> dict:
    """``{template: [urls, blocked, allowed]}`` of one host -> ``{template: (merged template, counts)}``."""
    root = Branch()
    for template, counts in templates.items():
        root.put(template.split("/"), counts)
    merged = {}
    # (the branch, its merged name, the templates' beginnings it stands for)
    waiting = [(root, [], [()])]
    while waiting:
        branch, name, begins = waiting.pop()
        if branch.ends[0]:
            for begin in begins:
                merged["/".join(begin)] = ("/".join(name), branch.ends)
        for names in _merged_siblings(branch):
            together = Branch()
            for segment in names:
                for tail, counts in branch.below[segment].paths():
                    together.put(tail, counts)
            starts = [(*begin, segment) for begin in begins for segment in names]
            waiting.append((together, [*name, _merged_name(names)], starts))
    return {t: merged[t] for t in templates}


def purity(counts, prior: float) -> float:
    _, blocked, allowed = counts
    return (blocked + SMOOTHING * prior) / (blocked + allowed + SMOOTHING)


def _judged_templates(prior: float):
    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        """All templates of one host (at most 401 rows) -> their verdicts."""
        templates = {
            t: [int(n), int(b), int(a)] for t, n, b, a in zip(rows.template, rows.n, rows.blocked, rows.allowed)
        }
        found = merge_tree(templates)
        out = [(t, m, purity(c, prior)) for t, (m, c) in found.items()]
        return pd.DataFrame(
            {
                "host": rows.host.iloc[0],
                "template": [t for t, _, _ in out],
                "merged": [m for _, m, _ in out],
                "purity": [p for _, _, p in out],
            }
        )

    return judge


# -- the operator ------------------------------------------------------------------------


def _counts():
    return [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]


def host_models(patterns: DataFrame, prior: float, total: int) -> DataFrame:
    """``host, urls, literals, verdicts``: what is needed to judge any path of a host, in one bounded row.

    ``verdicts`` maps a template to its merged form and purity.
    """
    hosts = checkpointed(patterns.groupBy("host").agg(F.sum("n").alias("urls"), F.count("*").alias("patterns")))
    n_patterns = hosts.agg(F.sum("patterns")).first()[0] or 0
    places = patterns.select("host", "n", F.posexplode(_segments(F.col("pattern"))).alias("at", "segment"))
    places = places.groupBy("host", "at", "segment").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_ROWS)
    # A host has at most as many frequent segments as patterns times their depth; its share of both is alike.
    sized = join_host_facts(places, hosts, "patterns", n_patterns, F.col("segment"))
    literal = sized.where(F.col("n") * LITERAL_SHARE >= F.col("urls"))
    literals = literal.groupBy("host").agg(F.collect_set(_place(F.col("at"), F.col("segment"))).alias("literals"))
    none = F.array().cast("array<string>")
    known = hosts.join(literals, "host", "left").withColumn("literals", F.coalesce("literals", none))
    known = checkpointed(known)
    placed = join_host_facts(patterns, known, "patterns", n_patterns, F.col("pattern"))
    template = _template(F.col("pattern"), F.col("literals"))
    first = placed.select("host", template.alias("template"), "n", "blocked", "allowed", "urls")
    step = first.groupBy("host", "template").agg(*_counts(), F.max("urls").alias("urls"))
    rare = F.col("n") * TEMPLATE_SHARE < F.col("urls")
    for instead in (_wild(F.col("template")), F.lit(REST)):
        moved = step.withColumn("template", F.when(rare, instead).otherwise(F.col("template")))
        step = moved.groupBy("host", "template").agg(*_counts(), F.max("urls").alias("urls"))
    kinds = "host string, template string, merged string, purity double"
    judged = step.groupBy("host").applyInPandas(_judged_templates(prior), kinds)
    verdict = F.struct("template", F.struct("merged", "purity").alias("found"))
    verdicts = judged.groupBy("host").agg(F.map_from_entries(F.collect_list(verdict)).alias("verdicts"))
    return known.drop("patterns").join(verdicts, "host")


def labelled(pages: DataFrame, rules=RULES, label: str | None = None) -> DataFrame:
    """Rows with ``_host, _path, _rule, _ruled, _label``; ``label`` names a column that holds block, allow or null."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.withColumns({"_host": host, "_path": path})
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    ruled = parsed.withColumns({"_rule": rule, "_ruled": verdict})
    own = F.col("_ruled") if label is None else F.coalesce("_ruled", F.col(label))
    return ruled.withColumn("_label", own)


def judge(pages: DataFrame, rules=RULES, label: str | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every row of ``pages``.

    ``label`` may name a column with known verdicts (block, allow, or null) that count as
    labels beside those of the rules.  ``template`` is the merged template of the url.
    """
    known = labelled(pages, rules, label).select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.col("_ruled").alias("ruled"),
        _pattern(F.col("_path")).alias("pattern"),
        F.col("_label").alias("label"),
    )
    blocked, allowed = (F.count_if(F.col("label") == word).alias(f"{word}ed") for word in (BLOCK, ALLOW))
    patterns = checkpointed(known.groupBy("host", "pattern").agg(F.count("*").alias("n"), blocked, allowed))
    total, bad = patterns.agg(F.sum("n"), F.sum("blocked")).first()
    total, bad = total or 0, bad or 0
    models = checkpointed(host_models(patterns, bad / max(total, 1), total))
    rows = known.drop("label").withColumnRenamed("page_id", "_page")
    found = join_host_facts(rows, models, "urls", total, F.col("path"))
    template = _template(F.col("pattern"), F.col("literals"))
    own = F.coalesce(
        F.try_element_at("verdicts", "_template"),
        F.try_element_at("verdicts", _wild(F.col("_template"))),
        F.try_element_at("verdicts", F.lit(REST)),
    )
    judged = found.withColumn("_template", template).withColumn("_own", own)
    method = F.when(F.col("_own.purity") >= LEAST_PURITY, BLOCK).otherwise(ALLOW)
    return judged.select(
        F.col("_page").alias("page_id"),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", method).alias("verdict"),
        F.col("_own.merged").alias("template"),
        F.col("_own.purity").alias("purity"),
    )
