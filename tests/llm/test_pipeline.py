from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from tests.conftest import rows as sorted_rows
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute, slow_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline as cp
from jobsift.llm import mixing, quality_classifier


def test_stages_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stage = dict(cp.STAGES)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}

    kept = stage["quality classifier"](spark, docs, d)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality_classifier.classify(docs).collect() if r.kept}
    clean = [i for i, q in quality.items() if q]
    assert len({r.doc_id for r in kept.collect()} & set(clean)) >= 0.99 * len(clean)

    exact = stage["exact dedup"](spark, docs, d)
    group = defaultdict(int)
    for r in docs.collect():
        key = r.text.translate({65 + i: 97 + i for i in range(26)})
        group[key] = max(group[key], r.doc_id)
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    assert sorted(map(tuple, exact.collect())) == sorted(rows[i] for i in group.values())

    near = stage["simhash near-dedup"](spark, docs, d)
    ids = sorted(rows)
    lead = brute([slow_fingerprint(rows[i][1]) for i in ids])
    assert sorted(map(tuple, near.collect())) == sorted(rows[ids[g]] for g in set(lead))

    mixed = stage["mixing"](spark, docs, d)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == +Counter(copies)
    assert all(tuple(r) == rows[r.doc_id] for r in mixed.collect())


def test_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    slow = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = cp.run(spark, sf).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    by = defaultdict(int)
    for p in pieces:
        by[p.doc_id] += p.length
    full = {i: len(slow.encode(text[i], add_special_tokens=False).ids) + 1 for i in by}
    times = {i: by[i] / full[i] for i in by}
    assert all(t == int(t) and 1 <= t <= 3 for t in times.values())
    check(pieces, [(i, text[i]) for i, t in times.items() for _ in range(int(t))], slow)


def test_odd_rows_through_every_stage(spark, odd, none, sf):
    docs = odd
    for name, f in cp.STAGES[:-1]:
        out = f(spark, docs, sf)
        assert out.schema.names == docs.schema.names, name
        before, after = Counter(map(tuple, docs.collect())), Counter(map(tuple, out.collect()))
        assert set(after) <= set(before)
        if name in ("exact dedup", "simhash near-dedup"):
            assert max(after.values()) == 1
        assert f(spark, none, sf).count() == 0
    assert cp.STAGES[-1][1](spark, none, sf).count() == 0
    exact = dict(cp.STAGES)["exact dedup"](spark, odd, sf)
    texts = [(r.text or "").lower() for r in exact.collect()]
    assert sorted(texts) == sorted({(r.text or "").lower() for r in odd.collect()})
    near = dict(cp.STAGES)["simhash near-dedup"](spark, odd, sf)
    groups = brute([slow_fingerprint(r.text) for r in odd.collect()])
    assert near.count() == len(set(groups))
    assert sorted_rows(near.select("doc_id").where("doc_id = 3")) == [(3,)]
    assert np.array(groups).size == odd.count()


def test_rows_that_differ_in_a_map_or_variant_only(spark):
    from pyspark.sql import functions as F

    from jobsift.llm.common import one_row_each, row_hash

    docs = spark.createDataFrame([(1, "a", {"k": "1"}), (1, "a", {"k": "2"}), (1, "a", None), (2, "b", {})],
                                 "doc_id long, text string, more map<string,string>")
    docs = docs.withColumn("nested", F.array(F.struct("more"))).withColumn(
        "v", F.parse_json(F.concat(F.lit('{"x": '), F.coalesce(F.get(F.map_values("more"), 0), F.lit("null")), F.lit("}"))))
    chosen = docs.select("doc_id", row_hash(docs).alias("row_hash"), F.lit(2).alias("copies"))
    assert chosen.select("row_hash").distinct().count() == 4
    shown = lambda df: sorted((r.doc_id, str(r.more)) for r in df.select("doc_id", "more").collect())
    assert shown(one_row_each(docs, chosen)) == shown(docs)
    assert shown(one_row_each(docs, chosen, copies="copies")) == sorted(shown(docs) * 2)
