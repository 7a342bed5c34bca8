import random

from obsforge.operators.hierarchy import descendants, hierarchy

SCHEMA = "parent long, child long, node string, path string"


def brute(links):
    par = {}
    for p, c in links:
        if p is not None and c is not None:
            par[c] = min(p, par.get(c, p))
    out = {}
    for n in {x for link in links for x in link if x is not None}:
        path, seen = [n], {n}
        while path[-1] in par and par[path[-1]] not in seen:
            path.append(par[path[-1]])
            seen.add(path[-1])
        if path[-1] in par:
            loop = path[path.index(par[path[-1]]) :]
            out[n] = (min(loop), -1, "")
        else:
            out[n] = (path[-1], len(path) - 1, "/".join(map(str, path[::-1])))
    return out


def check(spark, links):
    df = spark.createDataFrame([(p, c, "n", "p") for p, c in links], SCHEMA)
    h = hierarchy(df)
    got = {r.node_id: (r.root_id, r.node_depth, r.node_path) for r in h.nodes.collect()}
    want = brute(links)
    assert got == want
    assert h.nodes.count() == len(want)
    return h


def test_chain_star_loops_and_nulls(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(5, 100 + i) for i in range(30)] + [(200, 201), (201, 202), (202, 200), (202, 300), (300, 301), (400, 400), (400, 401), (None, 500), (501, None), (1, 2), (1, 2)]
    h = check(spark, links)
    assert {(r.node_id, r.loop_id) for r in h.loops.collect()} == {(200, 200), (201, 200), (202, 200), (400, 400)}
    d = {(r.ancestor_id, r.node_id): r.distance for r in descendants(h.nodes).collect()}
    assert d[1, 40] == 39 and d[5, 100] == 1 and (200, 201) not in d


def test_random_forests(spark):
    rng = random.Random(3)
    check(spark, [(rng.randrange(60), rng.randrange(60)) for _ in range(50)])


def test_empty(spark):
    h = hierarchy(spark.createDataFrame([], SCHEMA))
    assert h.nodes.count() == 0 and h.loops.count() == 0 and descendants(h.nodes).count() == 0


def test_hot_parent(spark, monkeypatch):
    import obsforge.operators.hierarchy as m
    import obsforge.operators.skew as skew

    monkeypatch.setattr(m, "hot_keys", lambda df, key: skew.hot_keys(df, key, share=10, least=5))
    check(spark, [(1, i) for i in range(2, 200)] + [(2, 500), (500, 501)])


def test_many_pointers_at_one_ancestor(spark, monkeypatch):
    import obsforge.operators.hierarchy as m

    links = [(1, 10 + i) for i in range(30)] + [(10 + i, 100 + i) for i in range(30)] + [(100 + i, 200 + i) for i in range(30)] + [(7, 8), (8, 7), (8, 9), (9, 300)] + [(9, 310 + i) for i in range(9)] + [(310 + i, 400 + i) for i in range(9)]
    monkeypatch.setattr(m, "LEAST", 3)
    check(spark, links)
    monkeypatch.setattr(m, "LONGEST", 2)
    check(spark, links)
