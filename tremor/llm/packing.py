"""Cost-balanced sequence packing.

Attention over a packed sequence costs ``linear * n + quadratic * n**2`` for
each piece of ``n`` tokens in it. Documents are tokenized where they are
scanned; each task packs them in windows of ``window_tokens`` tokens:

* a document's full stretches of ``seq_len`` tokens each fill a sequence;
* the remainders of a window, longest first, go to the open sequence of lowest
  cost that has room for them;
* a remainder that fits nowhere whole is cut over the lowest-cost sequences
  that still have room. A window opens ``ceil(tokens / seq_len)`` sequences, so
  room never runs out and at most one sequence's worth of padding is left.

No shuffle, and a task holds one window of ids at most, whatever its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import let_workers_import, releasing
from tremor.llm.tokens import encoder

END_ID = 0
ID_BYTES = 4
PIECE_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
                "sequence_id long, offset long, sequence_cost double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("sequence_cost", pa.float64())])
#: Sequence ids of a task start at its partition number times this.
TASK_STRIDE = 1 << 40


def piece_cost(tokens, linear: float, quadratic: float):
    """Estimated cost of attention over one piece of ``tokens`` tokens."""
    return linear * tokens + quadratic * tokens * tokens


def balance(lengths: list[int], seq_len: int, linear: float, quadratic: float):
    """Place pieces shorter than ``seq_len`` into ``ceil(total / seq_len)`` sequences.

    Returns ``(placements, costs)``: ``placements`` are ``(piece, start in
    piece, length, sequence, offset)``, gapless from 0 within each sequence, and
    ``costs`` the cost per sequence. Longer pieces go first; pieces of equal
    length keep their order; among sequences of equal cost the first is taken.
    """
    count = -(-sum(lengths) // seq_len)
    room = np.full(count, seq_len, dtype=np.int64)
    cost = np.zeros(count)
    placed = []

    def put(piece, start, length, seq):
        placed.append((piece, start, length, seq, seq_len - int(room[seq])))
        room[seq] -= length
        cost[seq] += piece_cost(length, linear, quadratic)

    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, left = 0, lengths[piece]
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            seq = int(np.argmin(np.where(fits, cost, np.inf)))
            length = min(left, int(room[seq]))
            put(piece, start, length, seq)
            start, left = start + length, left - length
    return placed, cost


class _Packer:
    def __init__(self, seq_len, window_tokens, linear, quadratic, first_sequence, flush_bytes):
        self.seq_len, self.window, self.weights = seq_len, window_tokens, (linear, quadratic)
        self.next_sequence, self.flush_bytes = first_sequence, flush_bytes
        self.rest: list[tuple] = []  # (doc_id, start, ids, doc_tokens), shorter than a sequence
        self.rest_tokens = 0
        self.rows: list[tuple] = []
        self.row_bytes = 0

    def _emit(self, doc_id, start, ids, doc_tokens, sequence, offset, cost):
        self.rows.append((doc_id, start, len(ids) // ID_BYTES, ids, doc_tokens, sequence, offset, cost))
        self.row_bytes += len(ids) + 64

    def add(self, doc_id, ids: bytes) -> None:
        tokens, step = len(ids) // ID_BYTES, self.seq_len
        full = tokens // step * step
        for start in range(0, full, step):
            self._emit(doc_id, start, ids[start * ID_BYTES:(start + step) * ID_BYTES], tokens, self.next_sequence, 0,
                       piece_cost(step, *self.weights))
            self.next_sequence += 1
        if tokens > full:
            self.rest.append((doc_id, full, ids[full * ID_BYTES:], tokens))
            self.rest_tokens += tokens - full

    def pack_window(self) -> None:
        placed, cost = balance([len(r[2]) // ID_BYTES for r in self.rest], self.seq_len, *self.weights)
        for piece, start, length, seq, offset in placed:
            doc_id, base, ids, tokens = self.rest[piece]
            self._emit(doc_id, base + start, ids[start * ID_BYTES:(start + length) * ID_BYTES], tokens,
                       self.next_sequence + seq, offset, float(cost[seq]))
        self.next_sequence += len(cost)
        self.rest, self.rest_tokens = [], 0

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows), _ARROW.types)],
                                             schema=_ARROW)
            self.rows, self.row_bytes = [], 0

    def due(self) -> bool:
        return self.row_bytes >= self.flush_bytes


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   seq_len: int = 1024, window_tokens: int = 1 << 20, linear: float = 1.0,
                   quadratic: float = 1.0 / 2048, flush_bytes: int = 16 << 20) -> DataFrame:
    """Pieces of tokenized documents, packed into sequences of at most ``seq_len`` tokens.

    One row per piece: ``doc_id, start`` (ids of the document before it),
    ``length, ids`` (little-endian unsigned 32-bit), ``doc_tokens`` (with the
    end id 0), ``sequence_id, offset, sequence_cost``. Every id of every
    document is in exactly one piece.

    Null and empty texts are the end id alone. A null id stays null; repeated
    rows and ids are packed once each, as separate documents. Texts of any
    length are cut into pieces. An empty table gives no rows. Other columns,
    whatever their names, are not read.
    """
    let_workers_import(docs.sparkSession)

    def run(batches):
        encode_all = encoder(tokenizer_path).encode_all
        end = END_ID.to_bytes(ID_BYTES, "little")
        packer = _Packer(seq_len, window_tokens, linear, quadratic,
                         TaskContext.get().partitionId() * TASK_STRIDE, flush_bytes)
        for batch in batches:
            ids, texts = batch.columns
            for doc_id, encoded in zip(ids.to_pylist(), encode_all(texts)):
                packer.add(doc_id, encoded + end)
                if packer.rest_tokens >= window_tokens:
                    packer.pack_window()
                if packer.due():
                    yield from packer.flush()
        packer.pack_window()
        yield from packer.flush()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(releasing(run), PIECE_SCHEMA))


def piece_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "sequence_cost")
