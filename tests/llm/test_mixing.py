from collections import defaultdict

from pelagos.llm import op8_mixing as op


def water(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by repeated clamping."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in done]
        left = total - sum(done.values())
        level = left / sum(w[s] for s in free) if free else 0
        over = [s for s in free if w[s] * level > epochs * sizes[s]]
        if not over:
            return done | {s: w[s] * level for s in free}
        done |= {s: float(epochs * sizes[s]) for s in over}


def check(df, rows):
    got = op.mix(df).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = water(dict(sizes))
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    assert len(got) == len(rows)
    for s, t in taken.items():
        assert abs(t - want[s]) <= 0.5 or not sizes[s]
    return got


def test_against_brute_force(docs, words):
    rows = [(i, words(1 + i % 60, i), "en", ["a", "b", "É", None, "zz", "c"][i % 6 if i % 4 else 0]) for i in range(500)]
    rows += [(900 + i, t, "en", "empty") for i, t in enumerate(("", None, " \n"))]
    a = check(docs(rows, extra=True), rows)
    b = op.mix(docs(rows[::-1])).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_small_sources_stop_at_three_epochs(docs, words):
    rows = [(i, words(10, i), "en", "a") for i in range(3)] + [(10 + i, words(10, i), "en", "b") for i in range(300)]
    got = check(docs(rows), rows)
    assert all(r.taken == 30 for r in got if r.source == "a")


def test_edge_cases(docs):
    assert op.mix(docs([])).count() == 0
    assert [r.taken for r in op.mix(docs([(1, None), (None, "")])).collect()] == [0, 0]
    rows = [(1, "a b"), (1, "a b"), (None, "c")]
    assert sum(r.taken for r in op.mix(docs(rows)).collect()) == 5


def test_mixed_rows(docs, words):
    rows = [(i, words(10, i), "en", "a" if i < 5 else "b") for i in range(200)]
    df = docs(rows, extra=True)
    out = op.mixed(df)
    n = defaultdict(int)
    for r in out.collect():
        n[r.source] += 1
    assert out.columns == df.columns and n["a"] == 15 and abs(n["b"] - 185) <= 1


def test_mixed_keeps_columns_of_clashing_names(docs, words):
    df = docs([(i, words(10, i), "en", "a") for i in range(20)]).selectExpr("*", "1 AS _n", "2 AS _id", "3 AS _t", "4 AS _s", "5 AS t", "6 AS taken")
    out = op.mixed(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == list(range(20))
