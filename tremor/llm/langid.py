"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams (lower-cased;
n-grams of a word with its borders). The model is trained by stochastic gradient
descent in numpy on a bounded sample, its temperature and its rejection
threshold are calibrated on sample documents that it was not trained on. As the
softmax is linear in the mean, prediction sums one row of class scores per
n-gram.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import let_workers_import, releasing

HELD_OUT_MODULUS, HELD_OUT_REST = 4, 2
UNKNOWN = "und"
SALTS = 64
SIZES = (2, 3, 4)
BUCKET_BITS = 15
#: Letters, and number characters that are no digits (½ ² Ⅷ).
_WORD_CHAR = re.compile(r"[^\W\d_]")
_STEP = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)


def held_out(id_col: Column) -> Column:
    """True for the documents that are never learned from; a null id is not held out."""
    rest = F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(HELD_OUT_MODULUS))
    return F.coalesce(rest == HELD_OUT_REST, F.lit(False))


def subwords(raw: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of a byte string (borders are spaces), size by size."""
    space = raw <= 0x20
    code = raw.astype(np.uint32)
    out, grown, inner = [], code, None
    for size in range(2, max(SIZES) + 1):
        grown = grown[:-1] * _STEP ^ code[size - 1:]
        if size > 2:  # no white space inside: an n-gram belongs to one word
            middle = ~space[size - 2:len(raw) - 1]
            inner = middle if inner is None else inner[:-1] & middle
        if size in SIZES:
            own = grown if inner is None else grown[inner]
            out.append((own * _SPREAD + np.uint32(size)) * _SPREAD >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(out)


def bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.group().isalpha() for c in _WORD_CHAR.finditer(text))


@dataclass
class Model:
    """``scores[bucket, language]`` per n-gram, before the temperature."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, buckets: np.ndarray) -> np.ndarray:
        return self.scores[buckets].mean(0, dtype=np.float64) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; ``und`` and 0 without a letter (or a model)."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        share = softmax(self.logits(subwords(bytes_of(text))) / self.temperature)
        best = int(np.argmax(share))
        return self.languages[best], float(share[best])

    def rejects(self, language: str, score: float) -> bool:
        return language == UNKNOWN or score < self.threshold


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], dim: int = 16, epochs: int = 4,
          rate: float = 20.0, seed: int = 5) -> Model:
    """SGD over ``(buckets, share of each, language number)`` examples."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / dim, (1 << BUCKET_BITS, dim)).astype(np.float32)
    out, bias = np.zeros((dim, len(languages)), dtype=np.float32), np.zeros(len(languages), dtype=np.float32)
    step, steps = 0, epochs * max(1, len(examples))
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            buckets, share, language = examples[k]
            now = rate * (1 - step / steps) / 10
            mean = share @ embed[buckets]
            wrong = softmax(mean @ out + bias).astype(np.float32)
            wrong[language] -= 1
            back = out @ wrong
            out -= now * np.outer(mean, wrong)
            bias -= 0.01 * now * wrong
            embed[buckets] -= (now * 10) * share[:, None] * back[None, :]
            step += 1
    return Model(languages, (embed @ out).astype(np.float32), bias)


def calibrate(model: Model, examples: list[tuple[np.ndarray, np.ndarray, int]], lost: float = 0.001) -> Model:
    """Temperature of the least log loss, and the score below which a text is
    rejected: at most a share ``lost`` of the rightly predicted texts, and never
    a score above one half."""
    if not examples:
        return model
    raw = np.stack([share @ model.scores[b] + model.bias for b, share, _ in examples]).astype(np.float64)
    truth = np.array([language for _, _, language in examples])

    def shares(t):
        e = np.exp((raw - raw.max(1, keepdims=True)) / t)
        return e / e.sum(1, keepdims=True)

    grid = np.geomspace(0.01, 20, 80)
    loss = [-np.log(np.maximum(shares(t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    share = shares(model.temperature)
    right = share.argmax(1) == truth
    if right.any():
        model.threshold = min(0.5, float(np.quantile(share.max(1)[right], lost)))
    return model


def _example_rows(docs: DataFrame, lines_per_doc: int) -> DataFrame:
    """Sparse n-gram shares of whole texts and of lines spread evenly over them."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("whole", pa.bool_()),
                        ("buckets", pa.binary()), ("share", pa.binary())])

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                lines = [line for line in text.split("\n") if has_letter(line)]
                step = -(-len(lines) // lines_per_doc) or 1
                for whole, part in [(True, text), *((False, line) for line in lines[::step])]:
                    if has_letter(part):
                        buckets, counts = np.unique(subwords(bytes_of(part)), return_counts=True)
                        share = (counts / counts.sum()).astype("<f4")
                        rows.append((doc_id, lang, whole, buckets.astype("<u2").tobytes(), share.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                                 schema=schema)

    return docs.select("doc_id", "text", "lang").mapInArrow(
        releasing(run), "doc_id long, lang string, whole boolean, buckets binary, share binary")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        docs_per_language: int = 500, max_docs: int = 4000, lines_per_doc: int = 6, seed: int = 5) -> Model:
    """Train and calibrate on a bounded sample of the documents that are not held out.

    The sample is at most ``docs_per_language`` documents of each language and
    ``max_docs`` in all, those of smallest id hash; of each, the whole text (of
    several texts of one id, that of smallest hash) and at most ``lines_per_doc`` lines. One document in five calibrates. Without
    any usable row the model predicts ``und``.
    """
    let_workers_import(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    usable = base.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id", F.lit(seed))
    # Salted first: a language is spread over tasks, and few documents of each salt go on.
    salt = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(SALTS))
    salted = Window.partitionBy("lang", "salt").orderBy(order, "doc_id")
    thin = (usable.select("doc_id", "lang", salt.alias("salt")).withColumn("n", F.row_number().over(salted))
            .where(F.col("n") <= max(8, 4 * docs_per_language // SALTS)))
    first = Window.partitionBy("lang").orderBy(order, "doc_id")
    ids = (thin.select("doc_id", "lang").withColumn("n", F.row_number().over(first))
           .where(F.col("n") <= docs_per_language).orderBy("n", "lang").limit(max_docs).select("doc_id", "lang"))
    sample = usable.where(F.col("text").isNotNull()).join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")
    # Of several texts of one id that of smallest hash, whatever the partitions.
    sample = sample.groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("one")).select(
        "doc_id", "one.text", "lang")
    rows = _example_rows(sample, lines_per_doc).orderBy("doc_id", "lang", "whole", "buckets").toArrow().to_pylist()
    languages = sorted({r["lang"] for r in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    learn, check = [], []
    for r in rows:
        one = (np.frombuffer(r["buckets"], dtype="<u2").astype(np.int64), np.frombuffer(r["share"], dtype="<f4"),
               number[r["lang"]])
        if r["doc_id"] // HELD_OUT_MODULUS % 5:
            learn.append(one)
        else:
            check.append(one)
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 1), dtype=np.float32), np.zeros(1))
    return calibrate(train(learn, languages, seed=seed), check)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score, rejected``, from the text alone.

    Null texts and texts without a letter are ``und`` with score 0 and rejected.
    Whole texts of any length are read. Repeated rows are judged alike; a null id
    stays null. An empty table gives no rows. Other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([model.rejects(*f) for f in found], pa.bool_())], schema=schema)

    let_workers_import(docs.sparkSession)
    ids = F.col(id_col).cast("long")
    return docs.select(ids.alias("doc_id"), held_out(ids).alias("held_out"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        releasing(run), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the model does not reject, columns as they are.

    Null and empty texts and those without a letter are rejected; texts of any
    length are read whole; repeated rows, also of one id, are judged alike. An
    empty table gives no rows.
    """
    let_workers_import(docs.sparkSession)
    schema = docs.schema

    def run(batches):
        for batch in batches:
            texts = batch.column(schema.names.index(text_col))
            keep = pa.array([not model.rejects(*model.predict(t.as_py())) for t in texts], pa.bool_())
            yield batch.filter(keep)

    return docs.mapInArrow(releasing(run), schema)
