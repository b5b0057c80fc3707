import random
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from jobsift.llm.license_scan import TEMPLATES, Scanner, increasing, patience, scan, words_of

LINES = {
    "Apache-2.0 (line)": "Licensed under the Apache License, Version 2.0.", "MIT (line)": "Released under the MIT License.",
    "GPL-3.0 (line)": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 (line)": "Licensed under CC BY-NC 4.0.",
}


def filler(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "work", "under", "version", "lorem", "ipsum", "dolor", "to"]) for _ in range(n))


@settings(max_examples=200, deadline=None)
@given(st.permutations(range(7)))
def test_increasing_is_longest(second):
    pairs = list(enumerate(second))
    got = increasing(pairs)
    assert got == sorted(got) and all(a[1] < b[1] for a, b in zip(got, got[1:]))
    rises = lambda c: all(a[1] < b[1] for a, b in zip(c, c[1:]))
    assert len(got) == max(n for n in range(8) for c in combinations(pairs, n) if rises(c))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=20), st.lists(st.sampled_from("abcdefgh"), max_size=20))
def test_patience_gives_a_common_subsequence(a, b):
    got = patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    if a == b:
        assert len(got) == len(a)


def test_whole_templates_in_long_texts():
    s = Scanner(TEMPLATES)
    for seed, (name, text) in enumerate(TEMPLATES.items()):
        got = s.scan(filler(5000, seed) + "\n" + text.upper() + "\n" + filler(3000, seed + 50))
        assert [(n, c, d) for n, c, d, _, _ in got] == [(name, 1.0, 1.0)], name
        assert got[0][3] == 5000 and got[0][4] == 5000 + len(words_of(text)) - 1


def test_edited_templates_and_copies():
    s = Scanner(TEMPLATES)
    mit = words_of(TEMPLATES["MIT"])
    edited = mit[:20] + [b"really"] + mit[20:60] + mit[64:100] + [b"new", b"words"] + mit[100:]
    got = s.scan(b" ".join(words_of(filler(300, 1)) + edited))
    assert [g[0] for g in got] == ["MIT"] and 0.9 < got[0][1] < 1
    many = " ".join([LINES["MIT (line)"]] * 50)
    assert [g[0] for g in s.scan(many)] == ["MIT (line)"] * 50
    assert [g[0] for g in s.scan("\n".join(LINES.values()))] == list(LINES)


def test_long_notices_in_a_row():
    s = Scanner(TEMPLATES)
    for name in ("MIT", "Apache-2.0 (notice)", "GPL (notice)", "ISC"):
        notice = words_of(TEMPLATES[name])
        for n, apart in ((2, 0), (3, 0), (3, 3), (3, 20), (3, 60), (10, 7), (50, 0), (50, 1)):
            got = s.scan(b" ".join(w for k in range(n) for w in (*notice, *words_of(filler(apart, k)))))
            step = len(notice) + apart
            assert got == [(name, 1.0, 1.0, k * step, k * step + len(notice) - 1) for k in range(n)], (name, n, apart)
    every = [words_of(t) for t in TEMPLATES.values()]
    assert [g[0] for g in s.scan(b" ".join(w for t in every * 5 for w in t))] == list(TEMPLATES) * 5


def test_edited_notices_in_a_row():
    rng = random.Random(3)
    for name in ("MIT", "Apache-2.0 (notice)", "GPL (notice)"):
        s = Scanner({name: TEMPLATES[name]})
        notice = words_of(TEMPLATES[name])
        text = []
        for _ in range(20):
            at, cut = rng.randrange(10, len(notice) - 20), rng.randrange(len(notice) // 12)
            text += notice[:at] + [b"new", b"words", b"here"][:rng.randrange(4)] + notice[at + cut:]
        got = s.scan(b" ".join(text))
        assert [g[0] for g in got] == [name] * 20 and all(g[1] > 0.85 for g in got)


def test_repeated_words_stay_linear():
    s = Scanner(TEMPLATES)
    assert s.scan("software copies notice " * 30_000) == []
    assert len(s.scan((TEMPLATES["MIT"] + "\n") * 1000)) == 1000


def test_no_false_finds():
    s = Scanner(TEMPLATES)
    for seed in range(20):
        assert s.scan(filler(3000, seed)) == []
    assert s.scan("the license of the version was released under the sea") == []


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.license) for r in scan(docs).collect()}
    want = {(r.doc_id, n) for r in docs.collect() for n, line in LINES.items() if line in r.text}
    assert got == want and want


def test_odd_rows(spark, odd, none):
    assert scan(odd).count() == 0
    assert scan(none).count() == 0
    rows = [(1, LINES["MIT (line)"], 1)] * 2 + [(None, LINES["MIT (line)"], 2)]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string, license int"))
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "1", "None"]
