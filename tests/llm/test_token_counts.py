from collections import defaultdict

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobsift.llm import token_counts as tc

VERSIONS = {"byte_bpe_50k": tc.byte_bpe("byte_bpe_50k"), "white space": tc.white_space}


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def brute(rows, slow):
    """rows: (source, lang, text, sign)."""
    out = defaultdict(lambda: [0, 0])
    for source, lang, text, sign in rows:
        counts = {"byte_bpe_50k": len(slow.encode(text or "", add_special_tokens=False).ids),
                  "white space": len((text or "").encode().split())}
        for version, n in counts.items():
            out[source, lang, version][0] += sign
            out[source, lang, version][1] += sign * n
    return {k: tuple(v) for k, v in out.items() if any(v)}


def totals(df):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in df.collect()}


def test_registered_query(spark, sf, slow):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [("quarantine" if d.doc_id in labels and labels[d.doc_id].quality == 0 else d.source, d.lang, d.text, 1)
            for d in docs if not (d.doc_id in labels and labels[d.doc_id].toxic == 1)]
    assert totals(tc.op9_token_counts(spark, sf)) == brute(rows, slow)


def signed(df, sign):
    return tc.counted(df, VERSIONS).withColumn("sign", F.lit(sign))


def test_batches(spark, odd, none, slow, tmp_path):
    rollup = tc.Rollup(spark, f"file://{tmp_path}/rollup")
    assert rollup.totals().count() == 0
    rows = [(r.source, r.lang, r.text) for r in odd.collect()]
    once = brute([(*r, 1) for r in rows], slow)
    assert rollup.commit("b/1 a", signed(odd, 1))
    assert not rollup.commit("b/1 a", signed(odd, 1))  # sent again
    assert totals(rollup.totals()) == once
    rollup.compact()
    assert totals(rollup.totals()) == once and not rollup.commit("b/1 a", signed(odd, 1))
    assert rollup.commit("none", signed(none, 1))
    one = odd.where("doc_id = 1")
    revised = one.withColumn("text", F.lit("two words")).withColumn("lang", F.lit("de"))
    assert rollup.commit("revise", signed(one, -1).union(signed(revised, 1)))
    moved = [(s, v, t, 1) for s, v, t in rows if not (t or "").startswith("The quick")] + [("a", "de", "two words", 1)]
    assert totals(rollup.totals()) == brute(moved, slow)
    rollup.compact()
    assert rollup.commit("out", signed(odd.where("doc_id <> 1 OR doc_id IS NULL").union(revised), -1))
    assert totals(rollup.totals()) == {}


def test_a_batch_cut_off_is_written_anew(spark, odd, tmp_path):
    rollup = tc.Rollup(spark, f"file://{tmp_path}/rollup")
    rollup.commit("x", signed(odd, 1))
    want = totals(rollup.totals())
    (tmp_path / "rollup/batches/x/_SUCCESS").unlink()
    assert totals(rollup.totals()) == {}
    assert rollup.commit("x", signed(odd, 1)) and totals(rollup.totals()) == want
