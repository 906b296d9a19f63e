"""Quality rules: an isolation forest over rule statistics.

Per document the rule statistics are counted over the whole text. A forest of
random splits, grown on a bounded sample, gives each document its mean path
length; short paths mean an unusual document. The score above which a document
is dropped is calibrated on labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import SPACE_CHARS, let_workers_import

WINDOW_WORDS = 5
#: Fixed value: characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")
#: Repeats are left to the base rules: many good documents repeat some lines.
FEATURES = ("symbols per word", "characters per word", "upper-case share", "marks per word")
STAT_SCHEMA = "doc_id long, " + ", ".join(f"{s} long" for s in STATISTICS)

_UPPER, _SYMBOL, _MARK = 1, 2, 4
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord("A"):ord("Z") + 1] |= _UPPER
_CLASS[list(SYMBOLS)] |= _SYMBOL
_CLASS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] |= _MARK


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words inside a window of ``window`` words that occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return 0
    # Equal stretches get equal dense numbers, one word longer at each step.
    stretch = ids
    for extra in range(1, window):
        _, stretch, counts = np.unique(stretch[:-1] * len(numbers) + ids[extra:], return_inverse=True,
                                       return_counts=True)
        if len(counts) == len(stretch):
            return 0
    begins = np.flatnonzero(counts[stretch] > 1)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def statistics_of(text: str | None) -> tuple[int, ...]:
    """The rule statistics of one text, in the order of ``STATISTICS``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # splits at ASCII white space
    classes = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=8)
    lines = [line for line in text.split("\n") if line.strip(SPACE_CHARS)]
    return (len(words), len(text) - sum(map(text.count, SPACE_CHARS)),
            int(classes[_SYMBOL] + classes[_SYMBOL | _MARK]), len(lines) - len(set(lines)), repeated_words(words),
            int(classes[_UPPER]), int(classes[_MARK] + classes[_SYMBOL | _MARK]))


def features(stats: np.ndarray) -> np.ndarray:
    """Rates that do not depend on a text's length, from ``[n, len(STATISTICS)]``."""
    column = dict(zip(STATISTICS, stats.T.astype(np.float64)))
    words, chars = np.maximum(column["n_words"], 1), np.maximum(column["word_chars"], 1)
    return np.stack([column["n_symbols"] / words, column["word_chars"] / words, column["n_upper"] / chars,
                     column["n_marks"] / words], axis=1)


def base_failed(stats: np.ndarray) -> np.ndarray:
    words, repeated = stats[:, 0], stats[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def _average_path(n):
    """Mean path length of an unsuccessful search among ``n`` random keys."""
    n = np.asarray(n, dtype=np.float64)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays ``[tree, node]``; a leaf has feature -1 and its path length in ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    usual: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1]; near 0.5 is usual, near 1 isolated at once."""
        if not len(x):
            return np.empty(0)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, below in zip(self.feature, self.cut, self.below):
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                side = x[rows, np.maximum(f, 0)] >= cut[node]
                node = np.where(inner, below[node] + side, node)
            total += cut[node]
        return np.exp2(-total / len(self.feature) / self.usual)


def grow_forest(x: np.ndarray, trees: int = 100, rows_per_tree: int = 256, seed: int = 11) -> Forest:
    """Isolation forest: each tree splits a random subsample at random cuts of random features."""
    rng = np.random.default_rng(seed)
    size = min(rows_per_tree, len(x))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    room = 2 ** (depth + 1)
    feature, cut = np.full((trees, room), -1, dtype=np.int64), np.zeros((trees, room))
    below = np.zeros((trees, room), dtype=np.int64)
    for t in range(trees):
        open_nodes, used = [(0, rng.choice(len(x), size, replace=False), 0)], 1
        while open_nodes:
            node, rows, level = open_nodes.pop()
            own = x[rows]
            varied = np.flatnonzero(own.max(0) > own.min(0)) if len(rows) > 1 and level < depth else ()
            if not len(varied):
                cut[t, node] = level + _average_path(len(rows))
                continue
            f = int(rng.choice(varied))
            at = rng.uniform(own[:, f].min(), own[:, f].max())
            right = own[:, f] >= at
            if right.all():  # the cut met the smallest value
                at = np.nextafter(own[:, f].min(), np.inf)
                right = own[:, f] >= at
            feature[t, node], cut[t, node], below[t, node] = f, at, used
            open_nodes += [(used, rows[~right], level + 1), (used + 1, rows[right], level + 1)]
            used += 2
    return Forest(feature, cut, below, float(max(_average_path(size), 1e-9)))


def calibrate(scores: np.ndarray, good: np.ndarray, max_good_loss: float = 0.003) -> float:
    """The lowest threshold that drops at most ``max_good_loss`` of the good rows,
    and no lower than needed to drop the bad ones it can reach. Infinite
    (nothing is dropped) without good rows or without bad rows above it."""
    if not good.any() or good.all():
        return float("inf")
    allowed = float(np.quantile(scores[good], 1 - max_good_loss, method="higher"))
    reached = scores[~good & (scores > allowed)]
    return float((allowed + reached.min()) / 2) if len(reached) else float("inf")


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the rule statistics of every row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), *((s, pa.int64()) for s in STATISTICS)])

    def run(batches):
        for batch in batches:
            rows = [statistics_of(t.as_py()) for t in batch.column(1)]
            columns = list(zip(*rows)) if rows else [[]] * len(STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                                             schema=schema)

    let_workers_import(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, STAT_SCHEMA)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = 4000, max_good_loss: float = 0.003,
        bad_share: float = 0.01, seed: int = 11) -> tuple[Forest | None, float]:
    """Forest and threshold from at most ``max_labelled`` labelled documents.

    The sample is the labelled ids of smallest hash, so it does not depend on
    partitions; contradicting labels count as bad, and of several texts of one id
    the one of least statistics stands for it. Rows that fail the base rules
    take no part. The forest grows on the good rows and, so that what is bad
    stays rare enough to be isolated early, one bad row per ``1 / bad_share``
    good ones; the threshold uses them all. ``(None, inf)`` without a usable
    sample.
    """
    ids = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).alias("quality"))
           .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_labelled))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = texts.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    # Of several texts of one id that of least statistics, whatever the partitions.
    least = text_statistics(wanted).groupBy("doc_id").agg(F.min(F.struct(*STATISTICS)).alias("least"))
    sample = (least.select("doc_id", "least.*").join(F.broadcast(ids), "doc_id")
              .orderBy("doc_id").limit(max_labelled).toPandas())
    stats = sample[list(STATISTICS)].to_numpy(dtype=np.int64)
    usable = ~base_failed(stats)
    if not usable.any():
        return None, float("inf")
    x, good = features(stats[usable]), sample["quality"].to_numpy()[usable] >= 1
    few_bad = np.flatnonzero(~good)[:max(1, int(bad_share * good.sum()))]
    forest = grow_forest(x[np.union1d(np.flatnonzero(good), few_bad)], seed=seed)
    return forest, calibrate(forest.score(x), good, max_good_loss)


def judge(docs: DataFrame, forest: Forest | None, threshold: float, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the statistics, ``base_failed``, ``score`` and ``kept``.

    Null and empty texts have zero in every statistic and fail the base rules.
    Repeated rows are judged alike, each in its row; a null id stays null. An
    empty table gives no rows. Other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), *((s, pa.int64()) for s in STATISTICS), ("base_failed", pa.bool_()),
                        ("score", pa.float64()), ("kept", pa.bool_())])

    def run(batches):
        for batch in batches:
            stats = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
            failed = base_failed(stats)
            score = forest.score(features(stats)) if forest else np.zeros(len(stats))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(failed), pa.array(score),
                                              pa.array(~failed & (score < threshold))], schema=schema)

    return text_statistics(docs, id_col, text_col).mapInArrow(
        run, f"{STAT_SCHEMA}, base_failed boolean, score double, kept boolean")
