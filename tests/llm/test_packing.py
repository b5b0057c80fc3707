import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from jobsift.llm.common import TokenIds
from jobsift.llm.packing import SumOfSquares, byte_bpe, filling, pack


@lru_cache
def both():
    return TokenIds(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def check(pieces, docs, slow, size=2048):
    """Round trip: every id of every row in exactly one piece, sequences without gaps and within the window."""
    wanted = defaultdict(list)
    for doc_id, text in docs:
        wanted[doc_id].append([*slow.encode(text or "", add_special_tokens=False).ids, 1])
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(wanted)
    for doc_id, lists in wanted.items():
        left = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert sum(p.length for p in left) == sum(map(len, lists))
        for p in left:
            assert any(p.doc_tokens == len(x) and zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes())
                       == p.ids_crc32 for x in lists)
        if len(lists) == 1:
            assert [p.start for p in left] == [0, *np.cumsum([p.length for p in left])[:-1]]
    for ps in by_seq.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [0, *np.cumsum([p.length for p in ps])[:-1]]
        assert ps[0].sequence_tokens == sum(p.length for p in ps) <= size


def test_round_trip(spark, odd, none, sf, slow):
    check(pack(odd, byte_bpe()).collect(), [(r.doc_id, r.text) for r in odd.collect()], slow)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = pack(docs.repartition(3), byte_bpe())
    check(pieces.collect(), [(r.doc_id, r.text) for r in docs.collect()], slow)
    assert filling(pieces).first().padding == 0
    assert pack(none, byte_bpe()).count() == 0


def test_level_is_the_best_by_brute_force():
    packer = SumOfSquares(16, 10_000)
    rng = np.random.default_rng(3)
    for k in range(2000):
        n = int(rng.integers(1, 16))
        square = {}
        for level in range(0, 17 - n):
            if level and not packer.count[level]:
                continue
            after = packer.count.copy()
            after[level] -= level > 0
            after[level + n] += level + n < 16
            square[level] = int((after[1:16] ** 2).sum())
        assert square[packer.level_for(n)] == min(square.values())
        list(packer.place((k, 0, np.zeros(n, "<u4"), n)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=200), st.integers(1, 20))
def test_every_id_once_and_only_powers_left(sizes, most):
    packer, out = SumOfSquares(16, most), []
    for k, n in enumerate(sizes):
        out += packer.place((k, 0, np.arange(n, dtype="<u4"), n))
        assert packer.n_open <= most
    out += packer.close()
    seen = sorted((p[0], int(x)) for w in out for p in w for x in p[2])
    assert seen == [(k, i) for k, n in enumerate(sizes) for i in range(n)]
    fill = [sum(len(p[2]) for p in w) for w in out]
    assert all(f == 16 or f & (f - 1) == 0 for f in fill)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8")) | st.text(st.characters(codec="latin-1")) |
       st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "it's", "É", "a1", "'", "\x85", "\xa0", "%%%"])).map("".join))
def test_ids_equal_the_tokenizers(text):
    ids = both()
    assert list(ids(text)) == ids.slow.encode(text, add_special_tokens=False).ids


def test_ids_over_all_latin_pairs():
    ids = both()
    text = "".join(chr(a) + chr(b) for a in range(256) for b in range(256))
    for at in range(0, len(text), 512):
        part = text[at:at + 512]
        assert list(ids(part)) == ids.slow.encode(part, add_special_tokens=False).ids
