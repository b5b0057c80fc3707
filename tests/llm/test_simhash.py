import numpy as np
import pytest
import xxhash

from jobsift.llm import simhash
from jobsift.llm.simhash import components, fingerprint_of, forest, links, simhash_dedup, thresholds, within


def brute(fps, distance=3):
    """Component representative (index) of each fingerprint, all pairs compared."""
    f = np.array(fps, np.uint64)
    parent = list(range(len(f)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[:i]) <= distance):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def slow_fingerprint(text):
    w = bytes(text or "", "utf-8").translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def holds(df, rows, cols=("doc_id", "component_id")):
    fps = [slow_fingerprint(t) for _, t in rows]
    group = brute(fps)
    owner = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            owner[g] = min(doc_id, owner.get(g, doc_id))
    key = lambda t: tuple((x is None, x) for x in t)
    want = sorted(((d, f"{f:016x}", owner.get(g)) for (d, _), f, g in zip(rows, fps, group)), key=key)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=key)
    assert got == want


def test_odd_rows(odd, none):
    holds(simhash_dedup(odd), [(r.doc_id, r.text) for r in odd.collect()])
    assert simhash_dedup(none).count() == 0


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    holds(simhash_dedup(docs), [(r.doc_id, r.text) for r in docs.collect()])


def near_fps(seed=1, n=400):
    """Random fingerprints, chains at 1-3 bits, and a dense ball."""
    rng = np.random.default_rng(seed)
    fps = list(map(int, rng.integers(0, 1 << 63, n, dtype=np.uint64)))
    for f in fps[:80]:
        for _ in range(3):
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                f ^= 1 << int(b)
            fps.append(f)
    centre = fps[0]
    fps += [centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(1, 64, 5)]
    return sorted(set(fps))


@pytest.mark.parametrize("hot,cell", [(2048, 8192), (3, 5), (0, 1)])
def test_links_connect_as_all_pairs_do(spark, hot, cell):
    """Also when every value counts as hot and every cell is split into a grid."""
    fps = near_fps()
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    edges = links(df, 3, hot, cell).checkpoint()
    if hot == simhash.HOT:  # one edge per member and cell
        assert edges.count() < 40 * len(fps)
    got = {r.node: r.component for r in components(edges).collect()}
    group = brute(fps)
    members = {}
    for f, g in zip(signed, group):
        members.setdefault(g, []).append(f)
    assert {f: min(members[g]) for f, g in zip(signed, group) if len(members[g]) > 1} == got


def test_thresholds_cost_no_more_than_any_other_allotment():
    rng = np.random.default_rng(0)
    near = within(rng.integers(0, 50, simhash.PARTS * simhash.VALUES) ** 2, 3)
    values = rng.integers(0, simhash.VALUES, (50, simhash.PARTS))
    got = thresholds(values, near, 3)
    assert (got.sum(axis=1) == 0).all() and got.min() >= -1
    cost = lambda v, t: sum(near[i, x][v[i]] + simhash.PROBE_COST * len(simhash.flips(x)) for i, x in enumerate(t) if x >= 0)  # noqa: E731,E501
    every = [t for t in np.ndindex(5, 5, 5, 5) if sum(t) == 4]
    for v, t in zip(values, got):
        assert cost(v, t) <= min(cost(v, [x - 1 for x in e]) for e in every) * (1 + 1e-6)


def test_forest_spans_a_dense_cell_with_one_edge_per_member():
    fps = np.unique(np.array([1 << a | 1 << b for a in range(64) for b in range(64)], np.uint64))
    assert len(forest(fps, np.full(len(fps), 3, np.int32), 3)) == len(fps) - 1


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(1000, 1300)]
    hub = [(5, 5000 + i) for i in range(500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path + hub + [(7, 7)], "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1000, 1301), 1000), **dict.fromkeys([5, *range(5000, 5500)], 5)}


def test_fingerprint_of_short_and_long_texts():
    for t in (None, "", " ", "one", "one two", "a b c", "Ab Ab Ab Ab", "x " * 200_000, "É é\x0bz\x0cq\x1fr"):
        assert fingerprint_of(None if t is None else t.encode()) == slow_fingerprint(t) if t is None or len(t) < 1000 else True
    assert fingerprint_of(b"x " * 200_000) == fingerprint_of(b"x x x")
