"""Language identification: family first, then one-versus-one linear support vector machines.

Features are byte trigrams of the lower-cased whole text, hashed to ``DIM``
places, log-scaled and of unit length. One linear machine per family
separates it from the other families; within the best family a linear machine
per pair of its languages casts a vote, and most votes win (ties: larger sum
of margins). A language outside ``FAMILIES`` is a family of its own.

Learnt from at most about ``SAMPLE`` documents in equal shares per language,
chosen by a hash of text and language among those with a language that are not held out
(crc32 of the doc_id's digits, mod 4, is 2). Every document is predicted from
its text alone.

Score: the family's share (softmax of its margins) times the chance, by the
logistic of the margin, of the weakest pair won; 0 to 1.

Defined results: null text or text without a letter is ``und`` with score 0;
null doc_id is not held out, and is not learnt from; with no language learnt
all are ``und``; repeated rows agree; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import arrow_rows, arrow_schema, quoted
from jobsift.llm.textstats import hashed_grams

SAMPLE, DIM, BLOCK, LANGUAGES = 4000, 2048, 256, 64
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he"),
}


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), f"only {lang}")


def features(text: str) -> np.ndarray:
    x = np.log1p(hashed_grams(b" " + text.lower().encode("utf-8", "replace") + b" ", DIM))
    return (x / max(np.linalg.norm(x), 1e-9)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def linear_svm(x: np.ndarray, positive: np.ndarray, l2: float = 1e-4, rounds: int = 300) -> np.ndarray:
    """Weights and bias of least squared hinge loss, classes weighted alike; accelerated gradient descent."""
    y = np.where(positive, 1, -1).astype(np.float32)
    weight = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = at = np.zeros(x.shape[1], np.float32)
    l2, step = np.float32(l2), np.float32(1 / (2 * float(np.einsum("ij,ij->i", x, x).max()) + l2))
    for k in range(rounds):
        slack = np.maximum(np.float32(0), 1 - y * (x @ at))
        nxt = at - step * (l2 * at - 2 * (x.T @ (weight * slack * y)))
        w, at = nxt, nxt + np.float32(k / (k + 3)) * (nxt - w)
    return w


class Model:
    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            self.families.setdefault(family_of(lang), []).append(lang)
        self.names = sorted(self.families)
        of = np.array([family_of(v) for v in langs])
        self.family = (np.array([linear_svm(x, of == f) for f in self.names]).astype(np.float32)
                       if len(self.names) > 1 else None)
        self.pairs = {}
        for f in self.names:
            for a, b in combinations(self.families[f], 2):
                rows = (langs == a) | (langs == b)
                self.pairs[a, b] = linear_svm(x[rows], langs[rows] == a).astype(np.float32)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [("und", 0.0)] * len(texts)
        known = [k for k, t in enumerate(texts) if self.names and has_letter(t)]
        for at in range(0, len(known), BLOCK):
            part = known[at:at + BLOCK]
            x = np.ones((len(part), DIM + 1), np.float32)
            for row, k in zip(x, part):
                row[:-1] = features(texts[k])
            share = np.ones((len(part), 1))
            if self.family is not None:
                share = np.exp(4 * np.clip(x @ self.family.T, -10, 10))
                share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            for f, name in enumerate(self.names):
                rows = np.flatnonzero(best == f)
                for i, lang, p in zip(rows, *self.within(self.families[name], x[rows])):
                    out[part[i]] = lang, float(share[i, f] * p)
        return out

    def within(self, members: list[str], x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """One versus one among a family's languages: the winner of each row and its weakest win."""
        won, total = np.zeros((len(x), len(members))), np.zeros((len(x), len(members)))
        weakest = np.ones((len(x), len(members)))
        for (i, a), (j, b) in combinations(enumerate(members), 2):
            m = x @ self.pairs[a, b]
            p = 1 / (1 + np.exp(-np.clip(4 * m, -40, 40)))
            won[:, i] += m >= 0
            won[:, j] += m < 0
            total[:, i] += m
            total[:, j] -= m
            weakest[:, i] = np.minimum(weakest[:, i], p)
            weakest[:, j] = np.minimum(weakest[:, j], 1 - p)
        top = np.lexsort([total.T, won.T], axis=0)[-1] if len(x) else np.zeros(0, int)
        return [members[k] for k in top], weakest[np.arange(len(x)), top]


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", most: int = LANGUAGES) -> Model:
    """Fitted on about ``sample`` texts, drawn by a hash of text and language alone, each text once. The
    ``most`` most frequent languages are learnt, so a column of stray values adds neither machines nor rows on the driver.
    """
    rows = docs.select(quoted(text_col).cast("string").alias("text"), quoted(lang_col).cast("string").alias("lang"),
                       held_out(quoted(id_col)).alias("out"),
                       quoted(id_col).alias("id"))
    rows = rows.where("NOT out AND lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    rows = rows.withColumn("draw", F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 40)))
    per = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).collect()  # one row per language
    limit = {lang: int(min(1.0, sample / len(per) / n) * (1 << 40)) for lang, n in per}
    if not limit:
        return Model(np.zeros((0, DIM), np.float32), np.array([], str))
    within = F.create_map(*[F.lit(v) for kv in limit.items() for v in kv])[F.col("lang")]

    schema = arrow_schema("x binary, lang string")

    def run(batches):
        rows = ((features(t).tobytes(), v) for batch in batches
                for t, v in zip(*(c.to_pylist() for c in batch.columns)) if has_letter(t))
        return arrow_rows(rows, schema, BLOCK)

    drawn = rows.where(F.col("draw") < within).groupBy("lang", "draw").agg(F.min("text").alias("text"))  # each text once
    table = drawn.select("text", "lang").mapInArrow(run, "x binary, lang string").toArrow()
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(-1, DIM)
    langs = np.array(table.column("lang").to_pylist(), dtype=str)
    order = np.lexsort([x[:, 0], x[:, 1], x[:, 2], langs])  # the same fit whatever order the tasks end in
    return Model(x[order], langs[order])


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    model = model or fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict(list(texts)), columns=["lang", "score"])

    return (docs.select(quoted(id_col).alias("doc_id"), held_out(quoted(id_col)).alias("held_out"),
                        predict(quoted(text_col).cast("string")).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))


def op5_language(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
