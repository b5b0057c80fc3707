"""Helpers shared by the operators: row identity, salted look-ups, Arrow rows, token ids.

Row identity. Operators never rely on ``doc_id`` being unique or non-null.
``row_hash`` gives every row a 64-bit hash of all its columns; the
pair (doc_id, row hash) names a row, and rows that agree in both are
interchangeable copies.

Salted look-ups. A key may hold a third of all rows. Rows carry a salt of
0..63 drawn from a hash of the row; the small side of a look-up carries a
64-bit mask of the salts that occur under its key and is expanded to one
row per set bit. The join key (key, salt) then holds at most a 64th of a hot
key, and the small side grows by no more than the rows that look it up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.session import scratch_path

SALTS = 64
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"  # what separates words; also what bytes.split() splits at


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def unhashable(kind: T.DataType) -> bool:
    """Whether a map or variant is in it, which XXH64 does not take."""
    if isinstance(kind, T.MapType | T.VariantType):
        return True
    if isinstance(kind, T.ArrayType):
        return unhashable(kind.elementType)
    return isinstance(kind, T.StructType) and any(unhashable(f.dataType) for f in kind.fields)


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns, null flags included (XXH64 skips nulls); maps and variants count as their JSON."""
    cols = [F.to_json(F.struct(quoted(f.name))) if unhashable(f.dataType) else quoted(f.name) for f in df.schema.fields]
    return F.xxhash64(*[x for c in cols for x in (c, c.isNull())])


def salt_of(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def mask_of(salt: str) -> Column:
    """Aggregate: the set of salts as bits of a long."""
    return F.expr(f"bit_or(shiftleft(1L, {salt}))")


def each_salt(mask: str) -> Column:
    """One row per salt in the mask."""
    return F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), i -> (shiftright({mask}, i) & 1L) = 1L)"))


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
         "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
         "array<float>": pa.list_(pa.float32()), "array<string>": pa.list_(pa.string())}


def arrow_schema(columns: str) -> pa.Schema:
    """Arrow form of "name type, ..."; tasks have no session that could parse it."""
    return pa.schema([(n, ARROW[t]) for n, t in (c.split() for c in columns.split(", "))])


def arrow_rows(rows: Iterable[tuple], schema: pa.Schema, at: int = 8192, heavy: int | None = None,
               limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``at`` rows, or about ``limit`` bytes in the column ``heavy``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        if heavy is not None:
            size += len(row[heavy] or b"")
        if len(held) >= at or size >= limit:
            yield batch_of(held, schema)
            held, size = [], 0
    if held:
        yield batch_of(held, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def one_row_each(docs: DataFrame, chosen: DataFrame, id_col: str = "doc_id", copies: str | None = None) -> DataFrame:
    """The rows of ``docs`` named by ``chosen`` (doc_id, row_hash): each name once, or ``copies`` times.

    One shuffle of the rows by their name. Rows that share doc_id and all
    columns are one name and alike, so any of them stands for the others.
    """
    a, b = fresh(docs, "row_id"), fresh(docs, "row_hash")
    n = fresh(docs, "row_copies")
    name = [F.coalesce(F.col("doc_id"), F.lit(-1)).alias(a),
            F.xxhash64("row_hash", F.col("doc_id").isNull()).alias(b)]
    picks = chosen.select(*name, (F.col(copies) if copies else F.lit(1)).cast("int").alias(n))
    picks = picks.groupBy(a, b).agg((F.sum(n) if copies else F.max(n)).cast("int").alias(n))
    rows = docs.withColumn(b, row_hash(docs))
    rows = (rows.withColumn(a, F.coalesce(quoted(id_col).cast("long"), F.lit(-1)))
            .withColumn(b, F.xxhash64(F.col(b), quoted(id_col).isNull())))
    # row_number keeps the join's partitioning and order: no further exchange
    from pyspark.sql import Window

    rn = fresh(docs, "row_no")
    out = (rows.join(picks.where(F.col(n) > 0), [a, b])
           .withColumn(rn, F.row_number().over(Window.partitionBy(a, b).orderBy(a)))
           .where(F.col(rn) == 1))
    if copies:
        out = out.withColumn(rn, F.explode(F.sequence(F.lit(1), F.col(n))))
    return out.select(*[quoted(c) for c in docs.columns])


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to a fresh folder of the shared scratch space and read back, and that folder.

    For loops: a checkpointed frame keeps the constraints that were inferred
    for it, which grow from round to round until planning takes longer than the work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class TokenIds:
    """Ids that ``tokenizers`` gives under a byte-level BPE file, special tokens not added.

    ``path`` is the JSON file. With ``ranks`` (the same vocabulary as ranks)
    texts of Latin-1 characters that hold no special token's string go
    through tiktoken, which gives the same ids several times faster (tested
    over all Latin-1 characters and on fuzzed texts); all others go through
    ``tokenizers`` itself, whose Unicode tables define the result.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task; Spark spreads the work
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.marks = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                text.encode("latin-1")
                plain = not any(m in text for m in self.marks)
            except UnicodeEncodeError:
                plain = False
            if plain:
                return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids
