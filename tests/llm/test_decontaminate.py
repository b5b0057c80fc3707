import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsift.llm import decontaminate as dc
from tests.llm.conftest import plain, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
A_Z = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def slow(text, items, width=10):
    """(n_words, hit words, item ids, character spans), window by window."""
    low = (text or "").translate(A_Z)
    found = list(WORD.finditer(low))
    w, hit, ids = [m[0] for m in found], set(), set()
    for item, body in items:
        t = WORD.findall((body or "").translate(A_Z))
        k = min(width, len(t))
        for i in range(len(t) - k + 1 if t else 0):
            for j in range(len(w) - k + 1):
                if w[j:j + k] == t[i:i + k]:
                    hit |= set(range(j, j + k))
                    ids.add("" if item is None else str(item))
    spans = []
    for j in sorted(hit):
        if j - 1 in hit:
            spans[-1] = found[j].end()
        else:
            spans += [found[j].start(), found[j].end()]
    return len(w), len(hit), sorted(ids), spans


def report(df):
    return [(r.n_words, r.n_hit, r["items"], r.spans) for r in df.orderBy("doc_id").collect()]


ITEMS = [(1, "What is the capital of the small country that lies between two large lakes?"), (2, "Short answer"), (3, None),
         (4, "..."), (None, "an item without an id but with more than ten words in it, all of them common"),
         (5, "is the capital of the small country that lies between two other lakes"), (1, "a second row of item one"),
         (10, "Été à Zürich"), (11, words(40, 3))]
TEXTS = ["so: WHAT is the capital, of the small-country that lies between two large lakes? yes", "short  ANSWER, short answer",
         "shorter answer", "", None, "été à zürich; Été à Zürich", "the capital of the small country that lies between",
         words(60, 9) + "\n" + words(40, 3).upper() + " " + words(40, 3), "a second row of item onerous",
         "an item without an id but with more than ten words in it all of them common", "\x00\x7f!"]


@pytest.mark.parametrize("block", [dc.BLOCK, 200])
def test_against_brute_force(spark, block):
    docs = plain(spark, [(i, t) for i, t in enumerate(TEXTS)])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = report(dc.decontaminate(docs, items, block=block))
    assert got == [slow(t, ITEMS) for t in TEXTS]
    for t, (_, _, _, spans) in zip(TEXTS, got):
        assert slow(dc.clean_text(t, spans), ITEMS)[1] == 0 or not spans


TOKENS = st.lists(st.sampled_from(["a", "B", "é", "-", " ", "\n", "9", "ab ", "a b "]), max_size=30).map("".join)


@settings(max_examples=200, deadline=None)
@given(TOKENS, st.lists(TOKENS, max_size=4))
def test_scan_of_random_texts(text, bodies):
    items = list(enumerate(bodies))
    held = {}
    for i, b in items:
        for w in dc.windows_of(dc.words_of(b.encode()), 3):
            held.setdefault(w, []).append(str(i))

    class Sent:
        value = (repr(bodies), held)

    dc._AUTOMATA.clear()
    n, runs, ids = dc.scan(text.encode(), *dc.automaton(Sent))
    runs = dc.merged(runs)
    spans = dc.offsets(text.encode(), runs) if runs else []
    assert (n, sum(runs[1::2]) - sum(runs[::2]), sorted(ids)) == slow(text, items, 3)[:3]
    joined = slow(text, items, 3)[3]
    assert [text[a:b] for a, b in zip(spans[::2], spans[1::2])] == [text[a:b] for a, b in zip(joined[::2], joined[1::2])]


def test_odd_rows_and_empty_tables(spark, odd, none, sf):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.decontaminate(odd, items)
    assert got.count() == odd.count() and got.where("n_hit > 0").count() == 0
    assert dc.decontaminate(none, items).count() == 0
    empty = dc.decontaminate(odd, items.limit(0))
    assert empty.where("n_hit > 0 OR size(items) > 0").count() == 0 and empty.count() == odd.count()
    clash = odd.withColumnsRenamed({"kept": "items", "size": "spans", "fp": "body"})
    assert dc.decontaminate(clash, items).count() == odd.count()


def test_long_text_and_a_window_that_many_items_share(spark):
    shared = words(12, 1)
    items = spark.createDataFrame([(i, f"{shared} item {i}") for i in range(300)], "item_id long, text string")
    text = " ".join([words(20_000, 2), shared, words(20_000, 4)] * 3)
    (row,) = dc.decontaminate(plain(spark, [(1, text)]), items).collect()
    assert row.n_hit == 36 and row["items"] == sorted(str(i) for i in range(300))


def test_digest_columns(spark, sf):
    got = dc.op13_decontamination(spark, sf)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    windows = {}
    for i, b in items:
        t = WORD.findall(b.translate(A_Z))
        for j in range(max(1, len(t) - 9)):
            windows.setdefault(tuple(t[j:j + 10]), set()).add(str(i))
    assert all(len(k) == 10 for k in windows)
    want = {}
    for d in docs:
        w = WORD.findall((d.text or "").translate(A_Z))
        at = [j for j in range(len(w) - 9) if tuple(w[j:j + 10]) in windows]
        ids = sorted({i for j in at for i in windows[tuple(w[j:j + 10])]})
        hit = len({j + x for j in at for x in range(10)})
        want[d.doc_id] = (len(w), hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
    assert any(v[-1] for v in want.values())
