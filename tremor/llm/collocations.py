"""Phrase collocation mining by prefix-free parsing.

A text is a sequence of words and piece marks. It is cut where its content says
so: every window of four tokens whose hash is 0 modulo ``parse_modulus`` ends
one chunk and begins the next, so the window is in both, and no chunk is the
beginning of another. Equal passages give equal chunks; the distinct chunks of a
language form a dictionary with the frequency of each in the parse.

Phrases are then counted inside distinct chunks only, weighted by frequency. A
phrase belongs to the chunk in which it begins before the last four tokens: of
five words at most, it lies whole in that chunk, and what lies in an overlap is
counted once.

Phrases of ``k`` words are counted where both phrases of ``k - 1`` words inside
them are frequent. A Bloom filter of bounded size stands for the frequent ones:
where it errs a phrase is counted in vain, none is missed, and counts are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import let_workers_import, stored

#: Tokens of a trigger window, in which neighbouring chunks overlap: one less than the longest phrase.
OVERLAP = 4
MAX_WORDS = OVERLAP + 1
#: Mean number of tokens of a chunk.
PARSE_MODULUS = 32
#: The bytes that end a piece.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Stands for the end of a piece; no byte of UTF-8.
MARK = b"\xff"
_FOLD = bytes(MARK[0] if b in _PIECE_ENDS else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Bytes of a text that are split at once, and of chunks a task holds before it passes them on.
_STRETCH, _HELD_BYTES = 1 << 20, 16 << 20
#: Bytes of chunks whose phrases are counted at once.
_COUNTED_BYTES = 6 << 20
MAX_FILTER_BYTES = 32 << 20
MAX_BROADCAST_ROWS = 100_000
UNKNOWN = "und"

_CHUNKS = pa.schema([("lang", pa.string()), ("chunk", pa.binary()), ("copies", pa.int64())])
_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
_BITS = pa.schema([("slot", pa.int64()), ("bits", pa.int64())])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words (A-Z lower-cased) and piece marks of a UTF-8 text, a stretch at a time."""
    start = 0
    while start < len(text):
        end = start + _STRETCH
        while end < len(text) and text[end] not in b" \t":
            end += 1
        yield text[start:end].translate(_FOLD).replace(MARK, b" " + MARK + b" ").split()
        start = end


def triggers(toks: list[bytes], modulus: int) -> np.ndarray:
    """Where trigger windows begin."""
    if len(toks) < OVERLAP:
        return np.zeros(0, dtype=np.int64)
    h = np.fromiter(map(crc32, toks), np.uint64, len(toks))
    n = len(toks) - OVERLAP + 1
    v = np.zeros(n, dtype=np.uint64)
    for j in range(OVERLAP):
        v = (v ^ h[j:j + n]) * _MIX
        v ^= v >> np.uint64(29)
    return np.flatnonzero(v % np.uint64(modulus) == 0)


def parse(text: bytes, modulus: int = PARSE_MODULUS) -> Iterator[bytes]:
    """The chunks of a text, tokens joined by spaces. The last chunk ends with
    ``OVERLAP`` piece marks. A text without tokens has none."""
    held: list[bytes] = []
    for part in tokens(text):
        held += part
        start = 0
        for cut in triggers(held, modulus).tolist():
            if cut > start:
                yield b" ".join(held[start:cut + OVERLAP])
                start = cut
        held = held[start:]
    if held:
        yield b" ".join([*held, *[MARK] * OVERLAP])


def chunk_dictionary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                     modulus: int = PARSE_MODULUS) -> DataFrame:
    """``lang, chunk, copies``: the distinct chunks of each language and their frequencies."""
    def run(batches):
        held: dict[str, Counter] = {}
        size = 0

        def out():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()),
                                                  pa.array(list(counts.values()), pa.int64())], schema=_CHUNKS)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = held.setdefault(lang, Counter())
                for chunk in parse(text.as_py(), modulus):
                    counts[chunk] += 1
                    size += len(chunk)
                    if size >= _HELD_BYTES:
                        yield from out()
                        held, size = {}, 0
                        counts = held.setdefault(lang, Counter())
        yield from out()

    parts = (docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
             .mapInArrow(run, "lang string, chunk binary, copies long"))
    return parts.groupBy("lang", "chunk").agg(F.sum("copies").alias("copies"))


def _coded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each value's number among the distinct ones, and those."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _split(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many tokens each chunk (or phrase) has, and all of them."""
    parts = pc.split_pattern(column, b" ")
    return np.diff(parts.offsets.to_numpy()), parts.flatten()


def _batched(batches: Iterator[pa.RecordBatch], nbytes: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least about ``nbytes``: more equal phrases meet in one."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= nbytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))


def _phrase_hashes(lang: np.ndarray, words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on, in that place's language."""
    n = len(words) - k + 1
    h = lang[:n].copy()
    for j in range(k):
        h = (h ^ words[j:j + n]) * _MIX
        h ^= h >> np.uint64(31)
    return h


class PhraseFilter:
    """Bloom filter (two bits a phrase) of the phrases of ``k`` words in ``phrases``
    (``lang, phrase``). Its size follows their number up to ``max_bytes``."""

    def __init__(self, phrases: DataFrame, k: int, max_bytes: int = MAX_FILTER_BYTES):
        n = phrases.count()
        slots = 64
        while slots * 64 < 16 * n and slots * 8 < max_bytes:
            slots *= 2
        self.k, self.slots = k, slots

        def run(batches):
            for batch in batches:
                codes, words = _coded(_split(batch.column(1).cast(pa.binary()))[1])
                langs, names = _coded(batch.column(0))
                lang = np.repeat(_hashes(names)[langs], k)
                h = _phrase_hashes(lang, _hashes(words)[codes], k)[::k]
                for slot, bit in PhraseFilter.places(h, slots):
                    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array((np.uint64(1) << bit).view(np.int64))], schema=_BITS)

        # At most max_bytes / 8 rows, whatever the number of phrases.
        rows = (phrases.select("lang", "phrase").mapInArrow(run, "slot long, bits long")
                .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow())
        self.words = np.zeros(slots, dtype=np.uint64)
        self.words[rows["slot"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)

    @staticmethod
    def places(h: np.ndarray, slots: int):
        for shift in (0, 32):
            x = (h >> np.uint64(shift)) | (h << np.uint64(64 - shift)) if shift else h
            yield (x >> np.uint64(6)).astype(np.int64) & (slots - 1), x & np.uint64(63)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), dtype=bool)
        for slot, bit in self.places(h, self.slots):
            found &= (self.words[slot] >> bit & np.uint64(1)).astype(bool)
        return found


def _distinct(columns: list[tuple[np.ndarray, int]], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct row of ``columns`` (values and their number), and its summed weight."""
    code, width = columns[0]
    for values, n in columns[1:]:
        if width * n >= 1 << 62:  # number the rows so far
            distinct, code = np.unique(code, return_inverse=True)
            width = len(distinct)
        code, width = code * n + values, width * n
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return order[starts], np.add.reduceat(weights[order], starts)


def count_phrases(dictionary: DataFrame, k: int, shorter: PhraseFilter | None = None) -> DataFrame:
    """``lang, phrase, f``: occurrences of the phrases of ``k`` words whose two
    parts of ``k - 1`` words pass ``shorter``. Without it all are counted, and a
    row with a null phrase tells the language's number of words."""
    def run(batches):
        for batch in _batched(batches, _COUNTED_BYTES):
            lengths, flat = _split(batch.column(1))
            if not len(flat):
                continue
            codes, words = _coded(flat)
            langs, names = _coded(batch.column(0))
            lang, weight = np.repeat(langs, lengths), np.repeat(batch.column(2).to_numpy(), lengths)
            begins = np.ones(len(flat), dtype=bool)  # before the overlap with the next chunk
            for j in range(1, OVERLAP + 1):
                begins[np.cumsum(lengths) - j] = False
            mark = pc.index(words, pa.scalar(MARK, pa.binary())).as_py()
            n = len(flat) - k + 1
            good = begins[:n].copy()
            for j in range(k):
                good &= codes[j:j + n] != mark
            if shorter is not None:
                frequent = shorter.may_hold(_phrase_hashes(_hashes(names)[lang], _hashes(words)[codes], k - 1))
                good &= frequent[:n] & frequent[1:n + 1]
            at = np.flatnonzero(good)
            if not len(at):
                continue
            first, f = _distinct([(lang[at], len(names)), *((codes[at + j], len(words)) for j in range(k))], weight[at])
            at = at[first]
            own = names.take(pa.array(lang[at]))
            phrases = pc.binary_join_element_wise(*(words.take(pa.array(codes[at + j])) for j in range(k)), b" ").cast(pa.string())
            if shorter is None:
                total = np.zeros(len(names), dtype=np.int64)
                np.add.at(total, lang[at], f)
                own, phrases = pa.concat_arrays([own, names]), pa.concat_arrays([phrases, pa.nulls(len(names), pa.string())])
                f = np.concatenate([f, total])
            yield pa.RecordBatch.from_arrays([own, phrases, pa.array(f)], schema=_PHRASES)

    return dictionary.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _big(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ", -1)


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 100,
                     max_words: int = MAX_WORDS, modulus: int = PARSE_MODULUS) -> DataFrame:
    """``lang, phrase, f, k``: all phrases of up to ``max_words`` words found at
    least ``min_count`` times in a language; with a null phrase (``k`` 0) the
    number of its words."""
    if not 2 <= max_words <= MAX_WORDS:
        raise ValueError(f"phrases have 2 to {MAX_WORDS} words, got {max_words}")
    let_workers_import(docs.sparkSession)
    dictionary = stored(chunk_dictionary(docs, lang_col, text_col, modulus), "phrase-chunks")
    found, shorter = None, None
    for k in range(1, max_words + 1):
        counted = count_phrases(dictionary, k, shorter).where(F.col("phrase").isNull() | (F.col("f") >= min_count))
        level = stored(counted.select("lang", "phrase", "f", F.when(F.col("phrase").isNull(), 0).otherwise(k).alias("k")),
                       f"phrases-{k}")
        found = level if found is None else found.unionByName(level)
        shorter = PhraseFilter(level.where(F.col("phrase").isNotNull()), k) if k < max_words else None
    return found


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 100,
                 cover_percent: int = 100, top: int = 2000, max_words: int = MAX_WORDS,
                 modulus: int = PARSE_MODULUS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of each language.

    Words are runs without space and tab, A-Z lower-cased, inside pieces between
    ``. , ; : ! ?`` and line breaks. A phrase's score is ``floor(1000 a n / (l r))``
    at the cut where it is lowest (of equals, the first): ``a`` counts the phrase,
    ``l`` and ``r`` its parts, ``n`` all words of the language. A phrase that lies
    in a longer one with ``100 f(longer) >= cover_percent a`` is left out. All
    numbers are exact. Ties go by ``a`` descending, then by the phrase in UTF-8
    order.

    A null language is ``und``; null and empty texts have no words. Rows of one
    id, or without one, count each. Texts of any length are read whole, a stretch
    at a time; a text without any trigger is one chunk. An empty table, or one
    with no frequent phrase, gives no rows. Other columns, whatever their names,
    are not read.
    """
    found = frequent_phrases(docs, lang_col, text_col, min_count, max_words, modulus)
    counts = found.where(F.col("k") > 0).select("lang", "phrase", "f")
    sizes = found.where(F.col("k") == 0).select("lang", F.col("f").alias("n"))
    if sizes.count() <= MAX_BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    phrases = found.where(F.col("k") >= 2).select("lang", "phrase", "k", F.col("f").alias("a"), _words(F.col("phrase")).alias("words"))
    cuts = phrases.select("lang", "phrase", "k", "a", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", _part(F.col("words"), 1, F.col("cut")).alias("head"),
        _part(F.col("words"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
            .join(sizes, "lang"))
    score = F.call_function("div", _big(1000 * F.col("a")) * _big(F.col("n")), _big(F.col("l")) * _big(F.col("r")))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least"))
    # A phrase inside a longer one is inside one that is longer by a word, which is no rarer.
    longer = phrases.where(F.col("k") >= 3).select("lang", "a", F.explode(F.array(
        _part(F.col("words"), 1, F.col("k") - 1), _part(F.col("words"), 2, F.col("k") - 1))).alias("phrase"))
    covers = longer.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    kept = scored.join(covers, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (100 * F.col("cover") < cover_percent * F.col("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase")))
    return (kept.select("lang", "phrase", "a", "least.l", "least.r", "n", "least.score").withColumn("rank", rank)
            .where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


#: Equivalent result over the given table.
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM words WHERE len(w) > 0),
grams AS (
  SELECT lang, k, w[s:s + k - 1] AS g FROM starts CROSS JOIN (SELECT unnest(range(1, 6)) AS k) WHERE s + k - 1 <= len(w)),
counts AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g HAVING count(*) >= 100),
cuts AS (SELECT lang, k, g, f AS a, unnest(range(1, k)) AS cut FROM counts WHERE k >= 2),
scored AS (
  SELECT c.lang, c.k, c.g, c.a, cut, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.g = c.g[1:cut] JOIN counts y ON y.lang = c.lang AND y.g = c.g[cut + 1:c.k]
  JOIN sizes s ON s.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
covered AS (
  SELECT lang, sub, max(f) AS cover FROM (
    SELECT lang, f, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda s: g[s:s + m - 1])))) AS sub
    FROM counts WHERE k >= 3) GROUP BY lang, sub),
kept AS (
  SELECT b.lang, array_to_string(g, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM best b LEFT JOIN covered v ON v.lang = b.lang AND v.sub = b.g WHERE cover IS NULL OR 100 * cover < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
