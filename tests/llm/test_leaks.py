import random

from obsforge.llm import leaks

WORDS = "kuppel zähler pult volt runden station lampe ventil scheibe batterie nord süd fuß groß mehr weniger rot blau".split()


def brute(docs, items):
    out = set()
    for i, t in items:
        if i is None or t is None:
            continue
        run = leaks.RUN_DENSE if leaks.DENSE.search(t) else leaks.RUN
        n = leaks.normal(t)
        runs = {n[a : a + run] for a in range(len(n) - run + 1)}
        for d, x in docs:
            if d is not None and x is not None:
                m = leaks.normal(x)
                if any(m[a : a + run] in runs for a in range(len(m) - run + 1)):
                    out.add((i, d))
    return out


def test_against_brute_force(spark):
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))
    zh = lambda n: "".join(chr(0x4E00 + rng.randint(0, 300)) for _ in range(n))
    items = [(i, text(rng.randint(5, 30))) for i in range(30)] + [(100 + i, zh(rng.randint(10, 60))) for i in range(10)]
    docs = [(i, text(40)) for i in range(40)] + [(200, None), (201, ""), (202, "   "), (None, items[0][1])]
    for k, (i, t) in enumerate(items):
        a = rng.randint(0, max(0, len(t) - 60))
        part = t[a : a + rng.choice([30, 45, 60, 500])]
        docs.append((1000 + k, text(5) + "\n" + part.upper().replace(" ", " — ") + "; " + text(5)))
        docs.append((2000 + k, part))
    docs.append((5000, (text(20) + " ") * 300 + items[3][1]))
    items += [(500, None), (501, ""), (502, "short"), (0, items[0][1]), (None, "x" * 90)]
    d = spark.createDataFrame([(*x, 1) for x in docs + docs[:5]], "doc_id long, text string, item_id long")
    e = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id long")
    got = [tuple(r) for r in leaks.leaked(d, e).collect()]
    assert set(got) == brute(docs, items) and len(set(got)) == len(got)
    assert len(got) > 30


def test_run_shared_by_a_third_of_the_documents(spark):
    """The run's weight falls with its frequency, the rare other half of each passage keeps its own."""
    rng = random.Random(11)
    zh = lambda n: "".join(chr(0x4E00 + rng.randint(0, 20000)) for _ in range(n))
    common = zh(18)
    items = [(i, zh(48)) for i in range(60)] + [(100 + k, zh(18) + common + zh(18)) for k in range(2)]
    docs = [(1000 + i, zh(30) + (common if i % 3 == 0 else "") + zh(30)) for i in range(600)]
    docs += [(5000 + k, zh(10) + t + zh(10)) for k, (_, t) in enumerate(items)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {tuple(r) for r in leaks.leaked(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items)


def test_pairs_below_the_cutoff_are_found(spark, monkeypatch):
    """With a cutoff that no cosine reaches, the lookup by runs alone finds every pair."""
    monkeypatch.setattr(leaks, "cutoff", lambda space, at: 2.0)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))
    items = [(i, text(20)) for i in range(10)]
    docs = [(100 + i, text(10) + t[20:90] + text(10)) for i, t in items]
    d, e = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) >= 10 and {tuple(r) for r in leaks.leaked(d, e).collect()} == want


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    e = spark.createDataFrame([(1, "eine lange Frage über die Kuppel der Station und ihre Batterie")], "item_id long, text string")
    assert leaks.leaked(d, e).count() == 0
    assert leaks.leaked(spark.createDataFrame([(2, "x")], "doc_id long, text string"), e.limit(0)).count() == 0


def test_windows_cover_every_run():
    for n in range(1, 200):
        for run in (18, 40):
            w = list(leaks.windows(n, run))
            for a in range(n - run + 1):
                assert any(x <= a and a + run <= y for x, y in w)


def test_normal_forms_of_many_texts_are_those_of_each():
    texts = ["ΑΣ", "Straße ΣΑΣ!", "", "a\0b", "ｶﾞ e\u0301", "\u0301x", "İI", "ﬁn", "  ", "한글 각"]
    assert leaks.normal_all(texts).split("\0") == [leaks.normal(t) for t in texts]


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 90))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for j, y in enumerate(b):
                row.append(max(last[j] + 1 if x == y else 0, last[j + 1], row[j]))
        assert leaks.common_subsequence(a, b) == row[-1]


def test_paraphrases(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))
    items = [(i, text(8) + f" {700 + i} volt " + text(6)) for i in range(12)]
    docs = [(1000 + i, text(30)) for i in range(60)]
    for i, t in items:
        words = t.split()
        docs.append((2000 + i, " ".join(w if k % 4 else w[:-1] for k, w in enumerate(words) if k % 12 != 11 or w.isdigit())))
        docs.append((3000 + i, " ".join("1" if w.isdigit() else w[:-1] if k % 4 == 0 else w for k, w in enumerate(words))))
    schema = "doc_id long, text string"
    got = leaks.paraphrased(spark.createDataFrame([*docs, (9, None), (None, "x"), (10, "")], schema), spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r.item_id, r.doc_id) for r in got}
    assert len([i for i, _ in items if (i, 2000 + i) in pairs]) >= 10 and all(r.share >= leaks.LCS_SHARE for r in got)
    assert all(d >= 2000 and (d - i) % 1000 == 0 for i, d in pairs)
    assert leaks.paraphrased(spark.createDataFrame([], schema), spark.createDataFrame([], "item_id long, text string")).count() == 0
