import random

import pytest

from rentlens.operators import pooling

BY = ["seg"]


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def neighbour(code, sizes):
    others = [c for c in sizes if c != code]
    if not others:
        return None
    for k in range(5, -1, -1):
        near = [c for c in others if c[:k] == code[:k]]
        if near:
            return min(near, key=lambda c: (lev(c, code) / max(len(c), len(code)), -sizes[c], c))
    return None


def one_round(sizes, cutoff):
    """Targets by following links from each small sector until a large one or a repeat."""
    links = {c: neighbour(c, sizes) for c, n in sizes.items() if n <= cutoff}
    links = {c: t for c, t in links.items() if t}
    out = {}
    for c in sizes:
        seen, at = [], c
        while at in links and at not in seen:
            seen.append(at)
            at = links[at]
        out[c] = max(seen[seen.index(at):]) if at in seen else at
    return out


def pools(sizes, cutoff=10):
    at = {c: c for c in sizes}
    while True:
        totals = {}
        for c, p in at.items():
            totals[p] = totals.get(p, 0) + sizes[c]
        step = one_round(totals, cutoff)
        at = {c: step[p] for c, p in at.items()}
        merged = {}
        for c, p in at.items():
            merged[p] = merged.get(p, 0) + sizes[c]
        if min(merged.values()) >= cutoff or len(merged) == 1:
            return at


def run(spark, segments, cutoff=10):
    rows = [(s, c, n) for s, sizes in segments.items() for c, n in sizes.items()]
    df = spark.createDataFrame(rows, "seg string, code string, n long")
    out = {}
    for r in pooling.pool_sectors(df, BY, cutoff).collect():
        out.setdefault(r["seg"], {})[r["code"]] = r["pool"]
    return out


def test_against_plain_search(spark):
    rnd = random.Random(1)
    segments = {}
    for k in range(25):
        codes = {f"00{rnd.choice('123')}{rnd.randrange(10)}{rnd.randrange(10)}{rnd.randrange(10)}"
                 for _ in range(rnd.choice([1, 2, 5, 40, 120]))}
        segments[f"s{k}"] = {c: rnd.choice([1, 2, 5, 9, 10, 11, 30, 200]) for c in codes}
    found = run(spark, segments)
    for s, sizes in segments.items():
        assert found[s] == pools(sizes), s
        totals = {}
        for c, p in found[s].items():
            totals[p] = totals.get(p, 0) + sizes[c]
        assert len(totals) == 1 or min(totals.values()) >= 10


@pytest.mark.parametrize("sizes, expected", [
    ({"001101": 3}, {"001101": "001101"}),                                     # alone in its segment
    ({"001101": 3, "001102": 4}, {"001101": "001102", "001102": "001102"}),   # point at each other: later code
    ({"001101": 1, "009999": 2}, {"001101": "009999", "009999": "009999"}),   # total below the cutoff
    ({"001101": 3, "001102": 20, "001103": 20}, {"001101": "001102", "001102": "001102", "001103": "001103"}),
    ({"001101": 11, "001102": 12}, {"001101": "001101", "001102": "001102"}),  # nothing small
    ({"001101": 10, "001102": 50}, {"001101": "001102", "001102": "001102"}),  # 10 rows still merge
])
def test_edges(spark, sizes, expected):
    assert run(spark, {"s": sizes})["s"] == expected


def test_chain_roots_on_any_links(spark):
    rnd = random.Random(2)
    segments, rows = {}, []
    for k in range(30):
        n = rnd.choice([2, 3, 8, 60])
        codes = [f"{i:03d}" for i in range(n)]
        links = {c: rnd.choice([t for t in codes if t != c]) for c in codes if rnd.random() < 0.9}
        if k == 0:
            links = {c: f"{(int(c) + 1) % n:03d}" for c in codes}  # one cycle through all
        segments[f"s{k}"] = links
        rows += [(f"s{k}", c, t) for c, t in links.items()]
    df = spark.createDataFrame(rows, "seg string, code string, neighbour string")
    for r in pooling.chain_roots(df, BY).collect():
        links, seen, at = segments[r["seg"]], [], r["code"]
        while at in links and at not in seen:
            seen.append(at)
            at = links[at]
        assert r["root"] == (max(seen[seen.index(at):]) if at in seen else at)


def test_pairs_stay_linear(spark):
    """A segment of 4,000 small sectors makes a few pairs per sector, not sector squared."""
    rows = [("s", f"{i:06d}", 1) for i in range(4000)]
    df = spark.createDataFrame(rows, "seg string, code string, n long")
    assert pooling.nearest_code(df, BY).count() == 4000
    plan = pooling.nearest_code(df, BY)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_rows_get_their_pool(spark):
    rows = [("s", "001101")] * 3 + [("s", "001102")] * 20
    df = spark.createDataFrame(rows, "seg string, CODIGO_BARRIO string")
    assert {r["CODIGO_BARRIO_NEW"] for r in pooling.pool_codes(df, BY).collect()} == {"001102"}
