"""Language identification with error-correcting output codes.

Each language has a codeword; each bit of the code is predicted by a binary classifier over
hashed byte trigrams (the log odds of the languages with the bit against those without).
Decoding takes the codeword with the least loss, bits weighted by how well their classifier does
on rows kept aside, and marks a document as ambiguous where the runner-up is close.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType


#: Labelled rows (expected) that the classifiers are fitted on, and those that weigh the bits.
FIT_ROWS, WEIGH_ROWS = 20_000, 4_000
BUCKETS = 1 << 15
SMOOTHING = 0.5
EVIDENCE = 60  # trigrams that count in full; longer texts are not surer than this
AMBIGUOUS = 0.2
UNDETERMINED = "und"
EXHAUSTIVE = 7  # up to so many languages the code has every useful bit
BITS_PER_DOUBLING, DRAWS, SEED = 10, 200, 7
LETTER = re.compile(r"[^\W\d_]")
_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the lower-cased text; digits and marks count as blanks."""
    data = " ".join(text.lower().split()).encode("utf-8", "replace").translate(_BYTES)
    raw = np.frombuffer(b" " + data + b" ", dtype=np.uint8).astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    code = code[(raw[1:-1] != 32) | (raw[:-2] != 32)]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def codewords(languages: int) -> np.ndarray:
    """+1/-1 matrix, one row a language: every split of few languages, else far-apart random ones."""
    if languages < 2:
        return np.zeros((languages, 0), dtype=np.int8)
    if languages <= EXHAUSTIVE:
        columns = [[1] + [1 if c >> i & 1 else -1 for i in range(languages - 1)] for c in range(2 ** (languages - 1) - 1)]
        return np.array(columns, dtype=np.int8).T
    rng, best, distance = np.random.default_rng(SEED), None, -1
    length = BITS_PER_DOUBLING * int(np.ceil(np.log2(languages)))
    for _ in range(DRAWS):
        drawn = rng.choice(np.array([-1, 1], dtype=np.int8), size=(languages, length))
        agree = drawn.astype(np.int32) @ drawn.T
        least = int(((length - agree) // 2)[~np.eye(languages, dtype=bool)].min())
        usable = (np.abs(drawn.sum(axis=0)) < languages).all()
        if usable and least > distance:
            best, distance = drawn, least
    return best


@dataclass
class Model:
    """Bit classifiers (bucket x bit), their weights, and the languages with their codewords."""

    languages: list[str]
    code: np.ndarray
    odds: np.ndarray
    weights: np.ndarray

    def bits(self, text: str) -> np.ndarray:
        grams = trigrams(text)
        if not len(grams):
            return np.zeros(self.code.shape[1])
        total = np.zeros(self.code.shape[1])
        for at in range(0, len(grams), 65536):  # bounded memory for any length
            total += self.odds[grams[at : at + 65536]].sum(axis=0, dtype=np.float64)
        return total / len(grams) * min(len(grams), EVIDENCE)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, ambiguous."""
        if not self.languages or text is None or not LETTER.search(text):
            return UNDETERMINED, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = self.code * self.bits(text)
        loss = (np.logaddexp(0.0, -margins) * self.weights).sum(axis=1)
        chance = np.exp(loss.min() - loss)
        chance /= chance.sum()
        order = np.argsort(-chance, kind="stable")
        best, second = float(chance[order[0]]), float(chance[order[1]])
        return self.languages[order[0]], best, best - second < AMBIGUOUS


def _fold(id_column: Column, parts: int) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % parts


def held_out(id_column: Column) -> Column:
    return _fold(id_column, 5) == 0


def _sample(rows: DataFrame, wanted: int, salt: int) -> DataFrame:
    """About ``wanted`` rows, chosen by a hash of the id wherever they lie."""
    total = rows.count()
    if total <= wanted:
        return rows
    share = int(wanted / total * 1_000_000)
    return rows.filter(F.pmod(F.xxhash64(F.lit(salt), F.col("doc_id").cast("string")), F.lit(1_000_000)) < share)


def fit(documents: DataFrame, fit_rows: int = FIT_ROWS, weigh_rows: int = WEIGH_ROWS) -> Model:
    """Fit on rows outside the held-out fold with text and language.

    The sums are made where the rows are; the driver gets one count per language and bucket.
    """
    labelled = documents.select("doc_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # a second fold of the labelled rows only weighs the bits
    aside = F.pmod(F.xxhash64(F.lit(11), F.col("doc_id").cast("string")), F.lit(5)) == 0
    learn = _sample(labelled.filter(~aside), fit_rows, 1)
    counts = learn.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    collected = counts.toPandas()
    languages = sorted(collected["lang"].unique())
    code = codewords(len(languages))
    table = np.zeros((len(languages), BUCKETS))
    table[[languages.index(x) for x in collected["lang"]], collected["bucket"]] = collected["n"]
    shares = (table + SMOOTHING) / (table + SMOOTHING).sum(axis=1, keepdims=True) if languages else table
    odds = np.zeros((BUCKETS, code.shape[1]), dtype=np.float32)
    for b in range(code.shape[1]):
        up, down = shares[code[:, b] > 0].mean(axis=0), shares[code[:, b] < 0].mean(axis=0)
        odds[:, b] = np.log(up) - np.log(down)
    model = Model(languages, code, odds, np.ones(code.shape[1]))
    if len(languages) > 1:
        scored = _sample(labelled.filter(aside), weigh_rows, 2).select("lang", "text").mapInArrow(_right(model), "bit int, right long, rows long")
        hits = {r["bit"]: r["right"] / max(1, r["rows"]) for r in scored.groupBy("bit").agg(F.sum("right").alias("right"), F.sum("rows").alias("rows")).collect()}
        skill = np.array([max(hits.get(b, 1.0) - 0.5, 0.01) for b in range(code.shape[1])])
        model.weights = skill / skill.mean()
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            into = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            into += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
    for lang, n in sums.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some.astype(np.int32)), pa.array(n[some])], names=["lang", "bucket", "n"])


def _right(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = model.code.shape[1]
        right, rows = np.zeros(bits, dtype=np.int64), 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                if lang in model.languages:
                    right += (model.bits(text.as_py()) * model.code[model.languages.index(lang)]) > 0
                    rows += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(bits, dtype=np.int32)), pa.array(right), pa.array(np.full(bits, rows, dtype=np.int64))], names=["bit", "right", "rows"])

    return score


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) for every row, from the whole text.

    A NULL, empty or letterless text is ``und`` with score 0, as is everything where no row has a
    label; with one known language that one is returned with score 1. NULL ids and repeated rows
    are kept; other columns are ignored.
    """
    source = documents.select("doc_id", "text")
    schema = StructType([source.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            columns = [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "ambiguous"])

    return source.mapInArrow(predict, schema).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
