"""Quality rules, URL filters, line dedup and mixing."""

import collections
import math
import re

import pytest
from pyspark.sql import functions as F

from tagloom.llm import line_dedup, mixing, quality_rules, url_filter
from tagloom.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import SF_SMOKE
from ..test_oracle import _digest
from .data import PROSE, empty, messy, messy_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _digest(df.columns, rows) == _digest(cols, res.fetchall())


def _repeat_words(words):
    at = collections.defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    return len({i + j for s in at.values() if len(s) > 1 for i in s for j in range(8)})


def test_quality_base_measures_equal_brute_force(spark):
    got = sorted((tuple(r)[:8] for r in quality_rules.judge(messy(spark)).collect()), key=str)
    want = []
    for doc_id, text, *_ in messy_rows():
        words = WORD.findall(text or "")
        lines = [s for s in (text or "").split("\n") if WORD.search(s)]
        repeat = _repeat_words(words)
        failed = len(words) < 20 or 100 * repeat > 30 * len(words)
        want.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
                     len(lines) - len(set(lines)), repeat, failed))
    assert sorted((g[:7] for g in got), key=str) == sorted(want, key=str)
    assert not [g for g in got if g[6] and g[7]]


def test_cleaning_drops_bad_lines_and_rejects(spark):
    junk = "Home | News | Shop | Help | Jobs"
    more = "It was late, and the keeper of the light had gone up early to trim the wick before the storm came in."
    rows = [(1, PROSE + "\n" + junk + "\n" + more), (2, "\n".join([junk] * 9) + "\n" + PROSE[:150]),
            (3, "WOW!! BUY!! NOW!! " * 30), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in quality_rules.cleaned(docs).collect()}
    assert out == {1: PROSE + "\n" + more}


def test_cleaning_keeps_all_columns(spark):
    out = quality_rules.cleaned(messy(spark))
    assert out.columns == messy(spark).columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == {1, 2, None, 6} and all(r.n_chars == len(r.text) for r in rows)
    assert quality_rules.cleaned(empty(spark)).count() == quality_rules.judge(empty(spark)).count() == 0


@pytest.mark.parametrize("limit", [line_dedup.MAX_BROADCAST_LINES, 0])
def test_line_dedup_by_host(spark, limit):
    rows = [(i, f"menu\nbody of page {i}\n\n menu ", "a") for i in range(20)]
    rows += [(100 + i, "copied\nwhole page", "b") for i in range(30)] + [(200 + i, f"line {i}", "b") for i in range(30)]
    rows += [(300, None, "a"), (301, "menu", None), (302, "menu", "c"), (303, "", "a"), (304, "menu\nx", "a"), (304, "menu\nx", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("host", F.lit("clash"))
    out = collections.defaultdict(list)
    for r in line_dedup.without_boilerplate(docs, max_broadcast=limit).collect():
        out[r.doc_id].append(r.text)
    assert out[3] == ["body of page 3\n"] and out[304] == ["x", "x"]
    assert out[100] == ["copied\nwhole page"]  # copies of one page are one page
    assert out[300] == [None] and out[301] == ["menu"] and out[302] == ["menu"] and out[303] == [""]
    assert sum(map(len, out.values())) == len(rows)
    assert line_dedup.report(empty(spark)).count() == 0
    assert line_dedup.report(messy(spark)).count() == len(messy_rows())


def _url_brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    best = None
    for r in url_filter.HOST_RULES:
        h, _, p = r.name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.name) > len(best.name)):
            best = r
    if best:
        return host, path, best.name, best.verdict
    if not m:
        return host, path, None, "block"
    fits = [r for r in url_filter.PATTERN_RULES if re.search(r.pattern, url)]
    return host, path, None, "block" if fits else "allow"


URLS = [None, "", "no scheme", "http://", "http://Example.COM/en/a", "https://www.example.com/en/", "https://a.www.example.com/en/x?y#z",
        "http://x.net/es/1", "http://net/fr/", "http://x.net/es", "http://notexample.com/en/", "http://example.com/en", "http://x.org/casino/",
        "http://x.org/CASINO/", "http://x.org/?a=1://b.net/es/", "ftp://u:p@x.net:80/fr/é", "http://x.org/login", "http://x.org/a?utm_source=feed",
        "http://x.org/" + "a/" * 5000 + "cart", "HTTP://X.NET/ES/", "http://x.net/es/\nnext"]


@pytest.mark.parametrize("limit", [url_filter.MAX_BROADCAST_RULES, 0])
def test_url_rules_equal_brute_force(spark, limit):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[4:6])], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, max_broadcast=limit).collect()}
    assert got == {i: _url_brute(u) for i, u in enumerate(URLS + URLS[4:6])}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_rule_without_token_is_tried_on_every_url(spark):
    rules = [url_filter.Rule("digits", "block", "[0-9]{3}", (), url_filter.PATTERN_RULE)]
    pages = spark.createDataFrame([(1, "http://a/123"), (2, "http://a/12")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, rules).collect()} == {1: "block", 2: "allow"}


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        out = {s: 2 * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if out[s] > 2 * sizes[s]}
        if not over:
            return out
        full |= over


def _tilted(sizes, target):
    """min(2, exp(l * size)) with the target as its sum, by bisection."""
    lo, hi, longest = -1e6, 1e6, max(sizes)
    for _ in range(200):
        m = (lo + hi) / 2
        rate = [min(2.0, math.exp(max(-700, min(700, m * s / longest)))) for s in sizes]
        lo, hi = (m, hi) if sum(r * s for r, s in zip(rate, sizes)) < target else (lo, m)
    return rate


def test_mixing_meets_targets_with_tilted_rates(spark):
    import random
    random.seed(3)
    rows = [(i, "w " * int(random.paretovariate(1.2) * 10), random.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(1500)]
    rows += [(2000, None, "a"), (2001, "", "d"), (2002, "x y", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in mixing.plan(docs).collect()}
    assert len(out) == len(rows)
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    by = collections.defaultdict(list)
    for i, _, s in rows:
        by[s].append(i)
    want = _targets({s: sum(size[i] for i in ids) for s, ids in by.items()})
    for s, ids in by.items():
        assert all(out[i].target == pytest.approx(want[s], abs=1e-6) and out[i].size == size[i] for i in ids)
        assert abs(sum(out[i].taken for i in ids) - want[s]) <= max(size[i] for i in ids)
        assert all(out[i].taken <= 2 * out[i].size and out[i].taken == out[i].copies * out[i].size for i in ids)
        full = [i for i in ids if size[i]]
        if full and want[s] < 2 * sum(size[i] for i in ids):
            rates = _tilted([size[i] for i in full], want[s])
            assert sum(abs(out[i].copies - r) < 1 + 1e-3 for i, r in zip(full, rates)) >= len(full) - 2
    again = {r.doc_id: r for r in mixing.plan(docs.repartition(7)).collect()}
    assert again == out
    mixed = collections.Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert mixed == collections.Counter({i: r.copies for i, r in out.items() if r.copies})


def test_mixing_takes_every_case(spark):
    assert mixing.plan(messy(spark)).count() == len(messy_rows())
    assert mixing.mixed(messy(spark)).columns == messy(spark).columns
    assert mixing.plan(empty(spark)).count() == mixing.mixed(empty(spark)).count() == 0
