"""SimHash near-dedup by the general pigeonhole principle.

Fingerprints: 64 bits over XXH64 (seed 42) of word shingles, see
``fingerprint_of``. Two fingerprints at ``distance`` or fewer differing bits
are linked; a component is what links reach.

Search over the distinct fingerprints:

1. Correlated bits go into the same one of ``PARTS`` partitions of 16 bits
   (their correlations are sums over all fingerprints, 64 x 64 numbers).
2. A histogram of each partition's 2^16 values, over all fingerprints, gives
   how many candidates a fingerprint would meet within 0..distance bits of its
   own value. For each fingerprint a dynamic program allots thresholds
   T_1..T_m of -1 (not probed) or more, with sum T_i = distance - m + 1, of
   least candidates plus probes: by the pigeonhole principle, two linked
   fingerprints agree within T_i in some partition i.
3. Every fingerprint is indexed under its value in every partition and probes
   all values within its thresholds. Values that hold more than ``HOT``
   fingerprints are split by the pigeonhole principle again, on four blocks of
   the other bits; cells that are still over ``CELL`` become a grid of cells.
4. A cell's probes are verified against its index by XOR and bit count,
   searching breadth-first: a fingerprint that has been reached leaves the
   search, so a dense cell costs about its size and gives one edge per
   member, never all its pairs. Reached or not, every linked pair is either
   verified or already connected by verified links.
5. Components of these edges by alternating large and small stars, each
   round written to the shared scratch folder.

Fixed-size data in the driver: 64 x 64 sums and 4 x 2^16 counters.

Defined results: null or wordless texts have fingerprint 0, linked like any
other; null doc_ids never name a component unless all of its ids are null;
repeated rows are rows of their own; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import arrow_schema, drop, each_salt, mask_of, quoted, row_hash, salt_of, written

BITS, PARTS = 64, 4
WIDTH = BITS // PARTS
VALUES = 1 << WIDTH
HOT, CELL = 2048, 8192
PROBE_COST = 32.0  # of one probe, in candidates
CHUNK = 1 << 16
FINGERPRINTS = "doc_id long, row_hash long, fp long"
CELLS = "key long, part_key long, fp long, role int"


# ---------------------------------------------------------------- fingerprints

def fingerprint_of(text: bytes | None, words: int = 3) -> int:
    """SimHash: lower-case A-Z, split at ASCII white space, hash every shingle, majority per bit."""
    w = (text or b"").lower().split()
    if not w:
        return 0
    if len(w) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(w), 42)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b" ".join(s), 42) for s in zip(*(w[i:] for i in range(words)))]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = np.array(hashes[at:at + CHUNK], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprinter(words: int):
    schema = arrow_schema(FINGERPRINTS)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint_of(x, words) for x in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], schema=schema)

    return run


# ------------------------------------------------------- partitions, thresholds

def fps_of(batch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def bit_products(batches):
    """Per task: number of fingerprints with bits i and j both set (64 x 64, in one array), and their number."""
    total, n = np.zeros((BITS, BITS)), 0
    for batch in batches:
        fps = np.ascontiguousarray(fps_of(batch))
        for at in range(0, len(fps), CHUNK):
            x = np.unpackbits(fps[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            x = x.astype(np.float32)
            total += x.T @ x
            n += len(x)
    flat = [*total.ravel().astype(np.int64).tolist(), n]
    yield pa.RecordBatch.from_arrays([pa.array([flat], pa.list_(pa.int64()))], names=["sums"])


def group_bits(sums: np.ndarray, n: int) -> list[list[int]]:
    """Partitions of equal width: each starts at the most correlated bit left and takes its closest bits."""
    mean = np.diag(sums) / max(n, 1)
    cov = sums / max(n, 1) - np.outer(mean, mean)
    dev = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    close = np.abs(cov / np.outer(dev, dev))
    np.fill_diagonal(close, 0)
    left, groups = list(range(BITS)), []
    while left:
        seed = max(left, key=lambda b: (close[b, left].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < WIDTH:
            nxt = max(left, key=lambda b: (close[b, group].sum(), -b))
            group.append(nxt)
            left.remove(nxt)
        groups.append(sorted(group))
    return groups


def take_bits(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def value_counts(groups: list[list[int]]):
    """Per task: fingerprints at each value of each partition."""
    def run(batches):
        count = np.zeros(PARTS * VALUES, np.int64)
        for batch in batches:
            fps = fps_of(batch)
            for i, bits in enumerate(groups):
                count += np.bincount(take_bits(fps, bits) + i * VALUES, minlength=len(count))
        slot = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(count[slot])], names=["slot", "n"])

    return run


def within(counts: np.ndarray, distance: int) -> np.ndarray:
    """[partition, t, value]: fingerprints at most t bits from the value, t = 0..distance."""
    values, out = np.arange(VALUES), np.zeros((PARTS, distance + 1, VALUES), np.float32)
    for i, n in enumerate(counts.reshape(PARTS, VALUES)):
        for t in range(distance + 1):
            for flip in combinations(range(WIDTH), t):
                out[i, t] += n[values ^ sum(1 << b for b in flip)]
            if t:
                out[i, t] += out[i, t - 1]
    return out


def flips(t: int) -> np.ndarray:
    """All patterns of at most t bits, the empty one first."""
    return np.array([sum(1 << b for b in c) for k in range(t + 1) for c in combinations(range(WIDTH), k)], np.int64)


def thresholds(values: np.ndarray, near: np.ndarray, distance: int) -> np.ndarray:
    """[fingerprint, partition]: thresholds of least cost with the sum distance - PARTS + 1.

    Dynamic program over partitions: best[s] is the least cost of the
    partitions so far whose (T_i + 1) add up to s; s must end at distance + 1.
    """
    n, goal = len(values), distance + 1
    best = np.full((n, goal + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((PARTS, n, goal + 1), np.int8)
    for i in range(PARTS):
        cost = np.zeros((n, goal + 1))
        for t in range(distance + 1):
            cost[:, t + 1] = near[i, t][values[:, i]] + PROBE_COST * len(flips(t))
        after = np.full((n, goal + 1), np.inf)
        for s in range(goal + 1):
            for take in range(s + 1):
                c = best[:, s - take] + cost[:, take]
                better = c < after[:, s]
                after[better, s] = c[better]
                choice[i, better, s] = take
        best = after
    out, s, rows = np.zeros((n, PARTS), np.int64), np.full(n, goal), np.arange(n)
    for i in reversed(range(PARTS)):
        take = choice[i, rows, s]
        out[:, i] = take - 1
        s = s - take
    return out


INDEX, PROBE = 1, 2


def cells(groups: list[list[int]], near: np.ndarray, distance: int, hot_from: int):
    """Index and probe rows of each fingerprint, keyed by partition and value; hot values split once more."""
    patterns = [flips(t) for t in range(distance + 1)]
    blocks = []  # per partition: four blocks of the other bits
    for group in groups:
        rest = [b for b in range(BITS) if b not in group]
        blocks.append([rest[j::distance + 1] for j in range(distance + 1)])
    schema = arrow_schema(CELLS)

    def emit(i, slots, fps, role):
        """The hot test looks at the slot alone, so index and probe rows of a slot agree on it."""
        hot = near[i, 0][slots] > hot_from
        base = (np.int64(i) * VALUES + slots).astype(np.int64)
        cold = ~hot
        yield base[cold], np.full(int(cold.sum()), -1, np.int64), fps[cold], role[cold]
        if hot.any():
            for j, bits in enumerate(blocks[i]):
                yield base[hot], (np.int64(j) << 32) + take_bits(fps[hot], bits), fps[hot], role[hot]

    def run(batches):
        for batch in batches:
            all_fps = fps_of(batch)
            for at in range(0, len(all_fps), CHUNK // 8):
                fps = all_fps[at:at + CHUNK // 8]
                values = np.stack([take_bits(fps, g) for g in groups], axis=1)
                allot = thresholds(values, near, distance)
                for i in range(PARTS):
                    own = np.where(allot[:, i] >= 0, INDEX | PROBE, INDEX).astype(np.int32)
                    parts = list(emit(i, values[:, i], fps, own))
                    for t in range(1, distance + 1):
                        who = np.flatnonzero(allot[:, i] == t)
                        if len(who):
                            v = (values[who, i][:, None] ^ patterns[t][None, 1:]).ravel()
                            f = np.repeat(fps[who], len(patterns[t]) - 1)
                            some = near[i, 0][v] > 0  # nothing is indexed under the others
                            v, f = v[some], f[some]
                            parts += list(emit(i, v, f, np.full(len(v), PROBE, np.int32)))
                    for k, p, f, r in parts:
                        if len(k):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(k), pa.array(p), pa.array(f.view(np.int64)), pa.array(r)], schema=schema)

    return run


# ------------------------------------------------------------------------ verify

def forest(fps: np.ndarray, role: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges (member, root) of a cell: breadth-first over pairs of a probe and an indexed row."""
    index, probe = (role & INDEX) > 0, (role & PROBE) > 0
    left = np.arange(len(fps))
    out = []
    while len(left) > 1:
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            now, front = front[:128], front[128:]
            near = np.bitwise_count(fps[now][:, None] ^ fps[left][None, :]) <= distance
            near &= (probe[now][:, None] & index[left][None, :]) | (index[now][:, None] & probe[left][None, :])
            hit = near.any(axis=0)
            if hit.any():
                out += [(int(m), int(root)) for m in left[hit]]
                front, left = np.concatenate([front, left[hit]]), left[~hit]
    return out


def verified(distance: int):
    schema = arrow_schema("a long, b long")

    def cell(rows):
        fps, inverse = np.unique(rows[1], return_inverse=True)
        if len(fps) < 2:
            return []
        role = np.zeros(len(fps), np.int32)
        np.bitwise_or.at(role, inverse, rows[2])
        signed = fps.view(np.int64)
        return [(int(signed[m]), int(signed[r])) for m, r in forest(fps, role, distance)]

    def run(batches):
        held = None  # the last cell of a batch may go on in the next
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            fps = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            role = batch.column(4).to_numpy(zero_copy_only=False)
            if held is not None:
                keys, fps, role = (np.concatenate(x) for x in zip(held, (keys, fps, role)))
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            cut = ends[-1] if len(ends) else 0
            held = keys[cut:], fps[cut:], role[cut:]
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else np.zeros(0, int)
            edges = []
            for a, b in zip(starts, ends):
                if b - a > 1:
                    edges += cell((keys[a:b], fps[a:b], role[a:b]))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], schema=schema)
        if held is not None and (edges := cell(held)):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], schema=schema)

    return run


def links(fps: DataFrame, distance: int = 3, hot_from: int = HOT, most: int = CELL) -> DataFrame:
    """Edges (a, b) that connect what pairs at ``distance`` or fewer bits connect; ``fps``: distinct, column fp.

    ``hot_from``, ``most``: values and cells with more fingerprints are split; results do not depend on them.
    """
    if distance + 1 < PARTS:
        raise ValueError(f"the thresholds of {PARTS} partitions need a distance of {PARTS - 1} or more")
    spark = fps.sparkSession
    sums = (fps.mapInArrow(bit_products, "sums array<long>").select(F.posexplode("sums").alias("i", "n"))
            .groupBy("i").agg(F.sum("n").alias("n")))
    flat = np.zeros(BITS * BITS + 1)
    for i, n in sums.collect():  # 4,097 numbers
        flat[i] = n
    groups = group_bits(flat[:-1].reshape(BITS, BITS), int(flat[-1]))
    counted = (fps.mapInArrow(value_counts(groups), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
               .toArrow())  # at most 4 x 2^16 counters
    counts = np.zeros(PARTS * VALUES, np.int64)
    counts[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    near = spark.sparkContext.broadcast(within(counts, distance))  # 4 x 4 x 2^16 floats, 4 MB at any size

    def place(batches):
        return cells(groups, near.value, distance, hot_from)(batches)

    placed = fps.mapInArrow(place, CELLS).checkpoint()
    large = placed.groupBy("key", "part_key").agg(F.count("*").alias("n")).where(F.col("n") > most)
    large = large.select("key", "part_key", F.ceil(F.col("n") / most).cast("int").alias("side"))
    # grid: an indexed row stands in one column and in all rows of the grid, a probe the other way round
    side = F.coalesce("side", F.lit(1))
    at = F.pmod(F.xxhash64("fp"), side).cast("int")
    line = F.sequence(F.lit(0), side - 1)
    as_index = F.when(F.col("role").bitwiseAND(INDEX) > 0, F.transform(line, lambda k: F.struct(
        (at * side + k).alias("grid"), F.lit(INDEX).alias("role"))))
    as_probe = F.when(F.col("role").bitwiseAND(PROBE) > 0, F.transform(line, lambda k: F.struct(
        (k * side + at).alias("grid"), F.lit(PROBE).alias("role"))))
    none = F.array().cast("array<struct<grid:int,role:int>>")
    spread = (placed.join(large, ["key", "part_key"], "left")
              .withColumn("cell", F.explode(F.when(side == 1, F.array(F.struct(F.lit(0).alias("grid"), F.col("role"))))
                          .otherwise(F.concat(F.coalesce(as_index, none), F.coalesce(as_probe, none)))))
              .select("key", "part_key", "cell.grid", "fp", "cell.role"))
    return (spread.repartition("key", "part_key", "grid").sortWithinPartitions("key", "part_key", "grid")
            .mapInArrow(verified(distance), "a long, b long"))


# -------------------------------------------------------------------- components

def toward_minimum(edges: DataFrame, larger_only: bool) -> DataFrame:
    """(v, m): each edge's v with the least neighbour m of its u, looked up by (u, salt of v)."""
    salted = edges.withColumn("salt", salt_of(F.col("v")))
    least = salted.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), mask_of("salt").alias("mask"))
    found = salted.join(least.select("u", "m", each_salt("mask").alias("salt")), ["u", "salt"])
    moved = found.where(F.col("v") > F.col("u")) if larger_only else found
    own = found.select(F.col("u").alias("v"), "m")
    return moved.select("v", "m") if larger_only else moved.select("v", "m").union(own)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that edges (a, b) reach; nodes without an edge are not listed.

    Alternating large star and small star until nothing moves; every round is
    written to the shared scratch folder, so a lost executor costs at most one
    round, and the round before it is dropped.
    """
    spark = edges.sparkSession
    state, path = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .distinct(), "components")
    mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    while True:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = toward_minimum(both, True).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = toward_minimum(large, False).where("v <> m")
        before = path
        state, path = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "components")
        drop(spark, before)
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def simhash_dedup(docs: DataFrame, words: int = 3, distance: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, row_hash, owner_hash.

    (component_id, owner_hash) names the row of the component that stays: the
    smallest doc_id, and among rows with that id the smallest row hash.
    """
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), row_hash(docs).alias("row_hash"),
                       quoted(text_col).cast("string").cast("binary").alias("body"))
    prints = rows.mapInArrow(fingerprinter(words), FINGERPRINTS).checkpoint()
    prints = prints.withColumn("salt", salt_of(F.col("doc_id"), F.col("row_hash")))
    # rows without an id come last
    owner = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash"))
    known = prints.groupBy("fp").agg(owner.alias("owner"), mask_of("salt").alias("mask")).checkpoint()
    member = components(links(known.select("fp"), distance))
    grouped = known.join(member.select(F.col("node").alias("fp"), "component"), "fp", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "fp"))
    # a component's owner goes back to its fingerprints by (component, salt of the fingerprint)
    grouped = grouped.withColumn("turn", salt_of(F.col("fp")))
    owners = grouped.groupBy("component").agg(F.min("owner").alias("first"), mask_of("turn").alias("turns"))
    owners = owners.select("component", "first", each_salt("turns").alias("turn"))
    found = (grouped.join(owners, ["component", "turn"])
             .select("fp", F.col("first.doc_id").alias("component_id"), F.col("first.row_hash").alias("owner_hash"),
                     each_salt("mask").alias("salt")))
    return prints.join(found, ["fp", "salt"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "row_hash", "owner_hash")


def op1_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_dedup(docs).select("doc_id", "fingerprint", "component_id")
