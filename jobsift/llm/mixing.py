"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

A document's size is its number of words. Sources get weights 1, 2, 3,
repeating, by code point (null last); targets share all words by weight, capped
at ``most`` times the source's words, with the excess shared anew by weight
until no target is above its cap. A document of a source with ratio
r = target / words is taken floor(r) times, and once more with probability
r - floor(r).

The fractional part is rounded by pivots within each source: two documents
exchange probability so that their expected words stay the same in sum, in a
random direction that leaves each probability unchanged on average, until one
of the two is integral; the other goes on. A bucket of about ``BUCKET``
documents is one such chain and leaves one fractional residual; residuals of
``BUCKET`` neighbouring buckets form the next level's bucket, and so on: a
reduction tree of log_64(n) levels, each written by checkpoint(). A source's
words then miss the target by less than its one last residual; documents of
its first bucket are switched, largest first, to make that good (should over
NEAR of the target still be missed, the last coin may be turned).

Coins are hashes of the documents' names, so reruns agree. The names are
(doc_id, hash of all columns, number among identical rows).

Defined results: null text has size 0; documents of size 0 are never taken
beyond floor(r); null source is a source; repeated rows are rounded
separately; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import each_salt, mask_of, quoted, row_hash, salt_of
from jobsift.operators.ordering import ordinals, pinned_order

BUCKET = 64
COPIES = 4096  # copies of one row that are numbered at once
NEAR = 0.005
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, cycle: int = 3, most: float = 3.0) -> DataFrame:
    """(source, source_size, n_sized, mask, target) from (source, size, salt): one row per source.

    ``n_sized`` counts the documents with words: only these are dealt to buckets."""
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count_if(F.col("size") > 0).alias("n_sized"), mask_of("salt").alias("mask")))
    # position by code point without a single-task window; the order is written once
    ranked = ordinals(pinned_order(per, [F.col("source").asc_nulls_last()]), [], "rank")
    ranked = ranked.withColumn("weight", (F.pmod(F.col("rank") - 1, F.lit(cycle)) + 1).cast("double")).checkpoint()
    cap = F.col("source_size") * F.lit(most)
    total, weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level = float(total or 0), 0.0
    share = total / weights if weights else 0.0
    while share > level:  # a source is capped once level * weight reaches its cap; the level only rises
        level = share
        capped = cap < F.lit(level) * F.col("weight")
        held, free = ranked.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        share = (total - (held or 0.0)) / free if free else level
    target = F.least(cap, F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", "n_sized", "mask", target.cast("double").alias("target"))


def coin(*names: Column) -> Column:
    """Uniform in [0, 1) from a hash of the names."""
    return F.pmod(F.xxhash64(*names), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def pivot(a: Column, b: Column, level: int) -> tuple[Column, Column]:
    """Probabilities of units a and b (structs with p, size) after one exchange; one of them is 0 or 1."""
    up_a, down_a = (1 - a["p"]) * a["size"], a["p"] * a["size"]
    up_b, down_b = (1 - b["p"]) * b["size"], b["p"] * b["size"]
    to_a, to_b = F.least(up_a, down_b), F.least(down_a, up_b)  # words moved in either direction
    toss = coin(F.lit(level), a["row_hash"], a["no"], b["row_hash"], b["no"], a["doc_id"], b["doc_id"])
    first = toss * (to_a + to_b) < to_b
    p_a = F.when(first, F.when(up_a <= down_b, 1.0).otherwise(F.least(F.lit(1.0), a["p"] + down_b / a["size"]))) \
        .otherwise(F.when(down_a <= up_b, 0.0).otherwise(F.greatest(F.lit(0.0), a["p"] - up_b / a["size"])))
    p_b = F.when(first, F.when(down_b <= up_a, 0.0).otherwise(F.greatest(F.lit(0.0), b["p"] - up_a / b["size"]))) \
        .otherwise(F.when(up_b <= down_a, 1.0).otherwise(F.least(F.lit(1.0), b["p"] + down_a / b["size"])))
    return p_a, p_b


UNIT = "struct<row_hash:bigint,doc_id:bigint,no:bigint,size:double,p:double>"


def chain(units: Column, level: int) -> Column:
    """Fold a bucket's units: struct(rest: the unit still fractional or last, done: the units that are integral)."""
    def unit(u: Column, p: Column) -> Column:
        return F.struct(u["row_hash"].alias("row_hash"), u["doc_id"].alias("doc_id"), u["no"].alias("no"),
                        u["size"].alias("size"), p.alias("p"))

    def step(acc: Column, nxt: Column) -> Column:
        p_a, p_b = pivot(acc["rest"], nxt, level)
        # the probabilities are worked out once, in a one-element array
        pair = F.array(F.struct(unit(acc["rest"], p_a).alias("a"), unit(nxt, p_b).alias("b")))
        return F.transform(pair, lambda x: F.when((x["a"]["p"] == 0.0) | (x["a"]["p"] == 1.0), F.struct(
            x["b"].alias("rest"), F.concat(acc["done"], F.array(x["a"])).alias("done"))).otherwise(F.struct(
                x["a"].alias("rest"), F.concat(acc["done"], F.array(x["b"])).alias("done"))))[0]

    start = F.struct(units[0].alias("rest"), F.array().cast(f"array<{UNIT}>").alias("done"))
    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), start, step)


def make_good(units: Column, miss: Column) -> Column:
    """Switch integral units, largest first, while that brings the missed words nearer to zero: (miss, units)."""
    by_size = F.array_sort(units, lambda a, b: F.when(a["size"] > b["size"], -1).when(a["size"] < b["size"], 1)
                           .when(a["row_hash"] < b["row_hash"], -1).when(a["row_hash"] > b["row_hash"], 1)
                           .when(a["no"] < b["no"], -1).when(a["no"] > b["no"], 1).otherwise(0))

    def step(acc: Column, u: Column) -> Column:
        drop = (u["p"] == 1.0) & (acc["miss"] > 0) & (u["size"] <= acc["miss"])
        take = (u["p"] == 0.0) & (acc["miss"] < 0) & (u["size"] <= -acc["miss"])
        moved = F.when(drop, -u["size"]).when(take, u["size"]).otherwise(F.lit(0.0))
        p = F.when(drop, F.lit(0.0)).when(take, F.lit(1.0)).otherwise(u["p"])
        return F.struct((acc["miss"] + moved).alias("miss"),
                        F.concat(acc["units"], F.array(u.withField("p", p))).alias("units"))

    start = F.struct(miss.alias("miss"), F.array().cast(f"array<{UNIT}>").alias("units"))
    return F.aggregate(by_size, start, step)


def numbered(rows: DataFrame) -> DataFrame:
    """``n`` rows for each row, ``no`` from 1: the first ``COPIES`` where the row is, further ones dealt to tasks in
    runs of ``COPIES``, so that neither an array nor a task holds all copies of a row. The numbers do not depend on it."""
    run = F.lit(COPIES).cast("long")
    first = rows.withColumn("from", F.lit(0).cast("long"))
    more = (rows.where(F.col("n") > COPIES)
            .withColumn("from", F.explode(F.sequence(run, F.col("n") - 1, run))).repartition("row_hash", "doc_id", "from"))
    no = F.explode(F.sequence(F.col("from") + 1, F.least(F.col("from") + run, F.col("n"))))
    return first.unionByName(more).withColumn("no", no).drop("n", "from")


def mix(docs: DataFrame, most: float = 3.0, cycle: int = 3, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, copies, source, row_hash."""
    size = F.coalesce(F.regexp_count(quoted(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), row_hash(docs).alias("row_hash"),
                       quoted(source_col).cast("string").alias("source"), size.alias("size"))
    # identical rows are counted before they are dealt, then numbered: their names differ
    rows = rows.groupBy("source", "doc_id", "row_hash", "size").agg(F.count("*").alias("n")).checkpoint()
    units = (numbered(rows)
             .withColumn("salt", salt_of(F.col("row_hash"), F.col("doc_id"), F.col("no"))).checkpoint())
    targets = source_targets(units, cycle, most).checkpoint()
    salted = targets.select(F.col("source").alias("of"), "source_size", "n_sized", "target",
                            each_salt("mask").alias("salt"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sized = (units.join(salted, F.col("source").eqNullSafe(F.col("of")) & (units["salt"] == salted["salt"]))
             .select("doc_id", "row_hash", "no", "source", units["size"], "source_size", "target", "n_sized",
                     F.floor(ratio).cast("int").alias("base"), (ratio - F.floor(ratio)).alias("p")))
    settled = (F.col("size") == 0) | (F.col("p") == 0)
    group = ["source", "source_size", "target", "base"]
    unit = F.struct("row_hash", "doc_id", "no", F.col("size").cast("double").alias("size"), "p").alias("unit")
    pieces = F.ceil(F.col("n_sized") / BUCKET).cast("long")
    left = sized.where(~settled).select(
        *group, unit, pieces.alias("pieces"), F.pmod(F.xxhash64("row_hash", "doc_id", "no"), pieces).alias("bucket"))
    deepest = targets.agg(F.max("n_sized")).first()[0] or 0
    buckets, level, done, first = -(-deepest // BUCKET), 0, [], None
    while True:
        folded = (left.groupBy(*group, "pieces", "bucket").agg(F.array_sort(F.collect_list("unit")).alias("units"))
                  .select(*group, "pieces", "bucket", chain(F.col("units"), level).alias("c")).checkpoint())
        first = first or folded
        done.append((folded.where("bucket <> 0") if folded is first else folded)
                    .select(*group, F.explode("c.done").alias("unit")))
        if buckets <= 1:
            break
        buckets, level = -(-buckets // BUCKET), level + 1
        left = folded.select(*group, F.col("c.rest").alias("unit"), F.ceil(F.col("pieces") / BUCKET).alias("pieces"),
                             F.floor(F.col("bucket") / BUCKET).alias("bucket"))
    # each source's last residual is tossed for; its first bucket makes good what that misses. Where that
    # leaves more than NEAR of the target and the other side of the coin leaves less, the other side holds.
    toss = (coin(F.lit(-1), F.col("unit.row_hash"), F.col("unit.no"), F.col("unit.doc_id")) < F.col("unit.p"))
    last = folded.select(*group, F.col("c.rest").alias("unit")).select(
        *group, "unit", toss.cast("double").alias("side"))
    miss = lambda side: (side - F.col("unit.p")) * F.col("unit.size")
    # documents fall into buckets by hash: a source whose bucket 0 got none still has its last residual
    spare = first.where("bucket = 0").select(F.col("source").alias("of"), F.col("c.done").alias("spare"))
    ends = last.join(spare, F.col("source").eqNullSafe(F.col("of")), "left")
    spare = F.coalesce(F.col("spare"), F.array().cast(f"array<{UNIT}>"))
    ends = ends.select(*group, "unit", "side", make_good(spare, miss(F.col("side"))).alias("x"),
                       make_good(spare, miss(1 - F.col("side"))).alias("y"))
    turn = ((F.abs("x.miss") > NEAR * F.col("target")) & (F.abs("y.miss") < F.abs("x.miss")))
    rest = F.col("unit").withField("p", F.when(turn, 1 - F.col("side")).otherwise(F.col("side")))
    ends = ends.select(*group, F.explode(F.concat(F.when(turn, F.col("y.units")).otherwise(F.col("x.units")),
                                                  F.array(rest))).alias("unit"))
    result = sized.where(settled).select(*group, "doc_id", "row_hash", "size", F.col("base").alias("copies"))
    for part in [ends, *done]:
        result = result.unionByName(part.select(
            *group, "unit.doc_id", "unit.row_hash", F.col("unit.size").cast("long").alias("size"),
            (F.col("base") + F.col("unit.p").cast("int")).alias("copies")))
    return result.select("doc_id", "size", "source_size", "target",
                         (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "source", "row_hash")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")
