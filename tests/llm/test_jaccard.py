import random
import re
from itertools import combinations

import pytest

from pelagos.llm import op5_jaccard_join as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, k=3, num=90, den=100):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and den * len(x & y) >= num * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def got(df, rule=op.Rule()):
    return sorted((r.okey, r.n_shingles, r.component) for r in op.components(op.keyed(df), rule).collect())


def edit(text, n, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = "z%d" % rng.randrange(10 ** 9)
    return " ".join(w)


@pytest.mark.parametrize("rule", [op.Rule(), op.Rule(5, 80, 100)])
def test_against_brute_force(docs, words, rule):
    rng, rows = random.Random(3), []
    for g in range(12):
        base = words(rng.choice([4, 12, 60, 200, 600]), g)
        rows += [edit(base, rng.choice([0, 0, 1, 2, 3, 5, 8]), (g, i).__hash__()) for i in range(rng.randint(1, 8))]
    rows += ["", " \t ", "one", "One", "one two", "a b c", "A b\nc", "ä b c", "Ä b c"]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    assert got(docs(rows, extra=True), rule) == brute(rows, rule.words, rule.num, rule.den)


def test_threshold_is_exact(docs):
    # 9 of 10 shingles shared of a union of 10: exactly 90 %
    a = " ".join("w%d" % i for i in range(12))
    b = " ".join("w%d" % i for i in range(11))
    c = " ".join("w%d" % i for i in range(10))
    assert got(docs([a, b, c])) == [(0, 10, 0), (1, 9, 0), (2, 8, 2)]


def test_large_group_of_near_copies(docs, words):
    base = words(120, 1)
    rows = list(enumerate(edit(base, i % 5, i) for i in range(150)))
    assert got(docs(rows)) == brute(rows)


def test_common_shingles_are_counted(docs, words, monkeypatch):
    monkeypatch.setattr(op, "RARE", 2)
    monkeypatch.setattr(op, "TABLE", 50)
    line = words(14, 99)
    rows = list(enumerate(words(10 + i % 9, i) + " " + line for i in range(80)))
    assert got(docs(rows)) == brute(rows)


def test_edge_cases(docs):
    assert got(docs([])) == []
    rows = op.components(op.keyed(docs([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (4, None)]))).collect()
    assert sorted((r.okey, r.n_shingles, r.component) for r in rows) == [(op.NULL, 2, op.NULL), (3, 2, op.NULL), (3, 2, op.NULL), (4, 0, 4)]


def test_links_are_all_there(docs, words):
    base = words(120, 1)
    rows = list(enumerate([edit(base, i % 5, i) for i in range(60)] + [words(40, i) for i in range(2, 20)] + [base, base]))
    found, members = op.links(op.keyed(docs(rows)))
    rep = {r.okey: r.rep for r in members.collect()}
    pairs = {(r.a, r.b) for r in found.collect()}
    sets = {i: {tuple(t.split()[j:j + 3]) for j in range(len(t.split()) - 2)} for i, t in rows}
    for a, b in combinations(sorted(sets), 2):
        linked = 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
        p, q = sorted((rep[a], rep[b]))
        assert linked == (p == q or (p, q) in pairs)


def test_long_text_and_helper_names(docs, words):
    t = words(60_000, 3)
    rows = [(1, t), (2, edit(t, 900, 1)), (3, edit(t, 9000, 2)), (4, t + " end")]
    assert got(docs(rows)) == brute(rows)
    df = docs([(1, words(30, 1)), (2, words(30, 1))]).selectExpr("*", "1 AS _okey", "2 AS _OKEY_")
    out = op.first_of_groups(df)
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [1]


def test_first_of_groups(docs, words):
    t = words(200, 1)
    df = docs([(5, t), (2, edit(t, 1, 1)), (9, words(50, 2)), (1, None), (7, t.upper())], extra=True)
    out = op.first_of_groups(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 9]
