import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsift.llm import collocations as co
from jobsift.llm.common import batch_of
from tests.llm.conftest import plain, words

A_Z = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def slow(rows, least, longest=5, cover=100, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.setdefault(lang, Counter()).update(
                tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows, longer = [], Counter()
        for q, b in cand.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    longer[q[i:i + k]] = max(longer[q[i:i + k]], b)
        for p, a in cand.items():
            if p in longer and 100 * longer[p] >= cover * a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def got(docs, least, top=2000, **more):
    return sorted(tuple(r[c] for c in COLUMNS) for r in co.ranked(co.collocations(docs, least, **more), top).collect())


def texts(seed):
    rows = [(f"{words(200, seed + i, 7)}. {words(30, i, 4)}\t{words(30, i, 4)}\n{words(80, i % 3, 40)}", ("en", "fr", None, "und")[i % 4])
            for i in range(6)]
    return rows + [("New  York, new york; NEW YORK city new york city: É é É é", "en"), (None, "en"), ("", None), (" \t.,", "de")] * 3


@pytest.mark.parametrize("block", [co.BLOCK, 100])
def test_against_brute_force(spark, block):
    rows = texts(1)
    docs = plain(spark, [(i, t, v) for i, (t, v) in enumerate(rows)])
    want = slow(rows, 6)
    assert got(docs, 6, block=block) == want
    assert max(len(r[2].split()) for r in want) >= 4 and {r[0] for r in want} == {"en", "fr", "und"}


def test_other_parameters(spark):
    rows = texts(2)
    docs = plain(spark, [(i, t, v) for i, (t, v) in enumerate(rows)])
    assert got(docs, 8, top=7, longest=3, cover=60) == slow(rows, 8, 3, 60, 7)


def test_repeated_phrases_overlap_and_ties(spark):
    rows = [("a a a a a a a", "en"), ("b c b c b c b c", "en"), ("x y x y. x y x y", "en")]
    assert got(plain(spark, [(i, *r) for i, r in enumerate(rows)]), 2) == slow(rows, 2)


PHRASES = st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=4), min_size=1, max_size=25)


@settings(max_examples=200, deadline=None)
@given(PHRASES, st.lists(st.integers(-1, 7), max_size=40))
def test_double_array(phrases, ids):
    """States of all positions at once are those of a walk through a dictionary."""
    beginnings = {tuple(3 * c for c in p[:k]) for p in phrases for k in range(1, len(p) + 1)}
    depth = max(map(len, beginnings))
    table = np.array(sorted(p + (-1,) * (depth - len(p)) for p in beginnings), np.int64)
    trie = co.DoubleArray(table)
    ids = np.array([3 * i if i >= 0 else -1 for i in ids], np.int64)
    state, code = trie.start(ids), trie.codes(ids)
    seen = {}
    for level in range(depth):
        if level:
            state = trie.advance(state[:max(0, len(ids) - level)], code[level:])
        for i, s in enumerate(state):
            phrase = tuple(ids[i:i + level + 1].tolist())
            assert (s >= 0) == (phrase in beginnings)
            if s >= 0:
                assert seen.setdefault(int(s), phrase) == phrase  # a state is one phrase


def test_rows_are_of_frequent_phrases(spark, monkeypatch):
    """Windows of frequent pairs that are rare themselves are not made into rows."""
    rows = [(f"{words(4000, i, 12)}. {'p q r s t. ' * 30}", "en") for i in range(6)]
    counted, made, made_by = co.counted, {}, spark.sparkContext.accumulator

    def noted(*args):
        run, names = counted(*args)
        n = made.setdefault(names.count(" int"), made_by(0))

        def more(batches):
            for batch in run(batches):
                n.add(batch.num_rows)
                yield batch

        return more, names

    monkeypatch.setattr(co, "counted", noted)
    docs = plain(spark, [(i, t, v) for i, (t, v) in enumerate(rows)]).repartition(2)
    assert got(docs, 100) == slow(rows, 100)
    triples = Counter(tuple(w[i:i + 3]) for t, _ in rows for w in map(str.split, t.split(".")) for i in range(len(w) - 2))
    assert len(triples) > 1700 and sum(n >= 100 for n in triples.values()) == 3
    assert 0 < made[3].value <= 3 * len(rows)


class Sent:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("k", [2, 3, 4])
def test_trimmed_and_counted_by_shard(monkeypatch, k, whole):
    """Cutting texts down changes no candidate; shards of a task are summed, and left when there are many; no full bucket is lost."""
    monkeypatch.setattr(co, "CHUNK", 150)
    monkeypatch.setattr(co, "HELD", 40)
    rng = np.random.default_rng(k)
    lines = [np.append(rng.integers(-1, 6, 60), -1).astype(np.int32) for _ in range(40)]
    parts = [np.array(p) for p in {tuple(rng.integers(0, 6, k - 1).tolist()) for _ in range(12)}]
    parts = np.array(sorted({tuple(p[:n].tolist()) + (-1,) * (k - 1 - n) for p in parts for n in range(1, k)}))
    known = {tuple(p.tolist()) for p in parts if -1 not in p}
    sent = Sent(co.DoubleArray(parts))

    def candidates(line):
        for w in (tuple(line[i:i + k].tolist()) for i in range(len(line) - k + 1)):
            if w[:-1] in known and -1 not in w and (w[1:] in known or not whole and w[1] not in parts[:, 0]):
                yield w

    want = Counter(w for line in lines for w in candidates(line))
    texts = [pa.record_batch([pa.array([x.tobytes() for x in lines[i:i + 7]], pa.binary())], ["ids"]) for i in range(0, 40, 7)]
    short = list(co.trimmed(sent, k, whole)(texts))
    assert Counter(w for b in short for ids in b.column(0).to_pylist() for w in candidates(np.frombuffer(ids, np.int32))) == want
    assert sum(len(ids) for b in short for ids in b.column(0).to_pylist()) <= sum(x.nbytes for x in lines)

    bits = 16
    for least in (1, max(want.values())):
        slices = sorted(row for b in co.bucketed(sent, k, whole, bits, least)(short) for row in zip(*(c.to_pylist() for c in b.columns)))
        full = np.zeros((co.SLICES, 8), np.uint8)
        for b in co.full_slices(bits, least)([batch_of(slices, co.arrow_schema("slice int, at binary, n binary"))]):
            for i, line in zip(*(c.to_pylist() for c in b.columns)):
                full[i] = np.frombuffer(line, np.uint8)
        run, _ = co.counted(sent, Sent(full.reshape(-1)), k, whole, bits)
        found = Counter()
        for b in run(short):
            for *w, n in zip(*(c.to_pylist() for c in b.columns)):
                found[tuple(w)] += n
        assert all(found[w] == want[w] for w in found)
        assert {w for w in want if want[w] >= least} <= set(found)
        assert found == want if least == 1 else len(found) < len(want)


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_007
    got = co.scored(spark.createDataFrame([("en", "p", 2 * big), ("en", "q", 3 * big)], "lang string, word string, n long"),
                    spark.createDataFrame([("en", "p q", big)], "lang string, phrase string, a long"),
                    spark.createDataFrame([("en", big * big // 8)], "lang string, n long")).collect()
    assert [r.score for r in got] == [1000 * big * (big * big // 8) // (6 * big * big)]


def test_odd_rows_and_empty_tables(spark, odd, none):
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert got(odd, 2, longest=2) == slow(rows, 2, 2)
    assert got(none, 2) == []
    assert got(odd.limit(1), 100) == []
    clash = odd.withColumnsRenamed({"kept": "ids", "size": "word", "fp": "phrase", "score": "n"})
    assert got(clash, 2, longest=2) == slow(rows, 2, 2)


def test_query_columns(spark, sf):
    assert co.op12_collocations(spark, sf).columns == list(COLUMNS)
