"""Personal data: pattern spans plus bootstrapped contextual extraction.

Base spans come from regular expressions and checks. They seed a bootstrap: the
words around them are lexical patterns, every other identifier-like token in
the corpus is an unlabelled instance, and patterns and instances are scored in
turn over their graph. Unlabelled tokens that only stand where personal data
stands become spans of kind ``id``.

Spark expressions only. Positions come from splitting a text at a pattern: the
lengths of the pieces and of the matches add up to them. Patterns avoid repeated
groups (a separator inside a number or a domain is first mapped to one mark,
character by character), so texts of any length are matched without recursion
and in linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import join_spread, stored

KINDS = ("email", "ip", "card", "phone")
LEARNED = "id"
_MARK, _NOT_MARK = "\u0002", "\u0003"
_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
_FOUND = "array<struct<start:int,end:int,value:string,left2:string,left1:string,right1:string>>"
_CHUNK = 64
_CONTEXT_CHARS = 80
#: White space and word characters of contexts.
_LETTER = r"\p{L}"
_S, _W = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"

#: Separators between digits (and dots between domain characters) become the mark.
_DIGIT_JOIN = r"(?<=[0-9])[\x20-](?=[0-9])"
_DOMAIN_JOIN = r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])"
_PATTERNS = {
    "email": rf"(?:(?<![A-Za-z0-9._%+{_MARK}-])|\G)[A-Za-z0-9._%+{_MARK}-]++@[A-Za-z0-9-]++{_MARK}[A-Za-z0-9{_MARK}-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{_MARK}]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Tokens that may be identifiers: words with a digit or an at sign.
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_MIN_TOKEN_DIGITS = 6


def _mapped(text: Column, kind: str) -> Column:
    """The text with separators of ``kind`` as marks; as long as the text, character by character."""
    joins = {"email": _DOMAIN_JOIN, "card": _DIGIT_JOIN}
    if kind not in joins:
        return text
    return F.regexp_replace(F.translate(text, _MARK, _NOT_MARK), joins[kind], _MARK)


def _prefix_sums(lengths: Column) -> Column:
    """Sum of all earlier elements, per element; in chunks, so long arrays stay linear."""
    def add(a, b):
        return a + b

    zero = F.lit(0)
    chunks = F.sequence(zero, F.floor(F.greatest(F.size(lengths) - 1, zero) / _CHUNK).cast("int"))
    sums = F.transform(chunks, lambda c: F.aggregate(F.slice(lengths, c * _CHUNK + 1, _CHUNK), zero, add))
    bases = F.aggregate(sums, F.array(zero), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s)))
    return F.transform(lengths, lambda _, i: F.get(bases, F.floor(i / _CHUNK).cast("int")) + F.aggregate(
        F.slice(lengths, F.floor(i / _CHUNK).cast("int") * _CHUNK + 1, i % _CHUNK), zero, add))


def _find(df: DataFrame, name: str, text: Column, pattern: str, maybe: Column) -> DataFrame:
    """Add ``name``: all leftmost matches with their positions and the words around them."""
    none = F.array().cast("array<string>")
    df = df.withColumn("_gaps", F.when(maybe, F.split(text, pattern, -1)).otherwise(none)).withColumn(
        "_hits", F.when(maybe, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_lengths", F.transform("_hits", lambda h, i: F.length(F.get("_gaps", i)) + F.length(h)))
    df = df.withColumn("_before", F.when(F.size("_hits") > 0, _prefix_sums(F.col("_lengths"))).otherwise(
        F.array().cast("array<int>")))

    def found(hit, i):
        gap = F.get("_gaps", i)
        start = F.get("_before", i) + F.length(gap)
        tail = F.lower(F.substring(gap, -_CONTEXT_CHARS, _CONTEXT_CHARS))
        head = F.lower(F.substring(F.get("_gaps", i + 1), 1, _CONTEXT_CHARS))
        return F.struct(
            start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("value"),
            F.regexp_extract(tail, f"({_W}+{_S}+{_W}+){_S}*$", 1).alias("left2"),
            F.regexp_extract(tail, f"({_W}+){_S}*$", 1).alias("left1"),
            F.regexp_extract(head, f"^{_S}*({_W}+)", 1).alias("right1"))

    return df.withColumn(name, F.transform("_hits", found).cast(_FOUND)).drop("_gaps", "_hits", "_lengths", "_before")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total, i):
        digit = F.ascii(F.substring(digits, n - i, F.lit(1))) - 48
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_PART}(\.{_PART}){{3}}$")
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def mark_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, two hashes of the text, ``spans`` (base), their
    contexts ``seeds`` and the other identifier-like tokens ``others``."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    df = df.withColumn("_digit", F.col("text").rlike("[0-9]")).withColumn("_at", F.contains("text", F.lit("@")))
    maybe = {"email": F.col("_at"), "ip": F.col("_digit"), "card": F.col("_digit"),
             "phone": F.col("_digit") & F.contains("text", F.lit("+"))}
    for kind in KINDS:
        df = df.withColumn("_mapped", F.when(maybe[kind], _mapped(F.col("text"), kind)))
        df = _find(df, kind, F.col("_mapped"), _PATTERNS[kind], maybe[kind])
        df = df.withColumn(kind, F.filter(kind, _valid_of(kind)))
    df = _find(df, "_tokens", F.col("text"), _TOKEN, F.col("_digit") | F.col("_at"))
    spans = F.array_sort(F.concat(*[F.transform(kind, _span_of(rank, kind)) for rank, kind in enumerate(KINDS)]).cast(_SPAN))
    df = df.withColumn("spans", spans).withColumn("seeds", F.concat(*KINDS))
    others = F.filter("_tokens", lambda t: (F.contains(t["value"], F.lit("@")) | (
        F.length(_digits(t["value"])) >= _MIN_TOKEN_DIGITS)) & ~F.exists(
        "spans", lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"])))
    return df.select("doc_id", F.xxhash64("text").alias("b1"), F.xxhash64(F.lit(1), "text").alias("b2"), "spans",
                     "seeds", others.alias("others"))


def _valid_of(kind: str):
    return lambda found: _valid(kind, found["value"])


def _span_of(rank: int, kind: str):
    return lambda found: F.struct(found["start"].alias("start"), F.lit(rank).alias("rank"), found["end"].alias("end"),
                                  F.lit(kind).alias("kind"))


def _patterns(found: Column) -> Column:
    """Lexical patterns of an instance: two words before it; the words on both
    sides. Each holds a letter: marks alone (columns of a table, list signs) say
    nothing about what stands beside them. A word after it alone says too little."""
    left2, left1, right1 = found["left2"], found["left1"], found["right1"]
    before = F.when(left2.rlike(_LETTER), F.concat(F.lit("< "), left2))
    around = F.when((left1 != "") & (right1 != "") & (left1.rlike(_LETTER) | right1.rlike(_LETTER)),
                    F.concat(F.lit("> "), left1, F.lit(" _ "), right1))
    return F.array_compact(F.array(before, around))


def _edges(marked: DataFrame, column: str, seed: bool) -> DataFrame:
    found = marked.select(F.explode(column).alias("f")).select(
        F.lower("f.value").alias("instance"), F.explode(_patterns(F.col("f"))).alias("pattern"))
    return found.distinct().withColumn("seed", F.lit(seed))


def score_patterns(marked: DataFrame, rounds: int = 3, min_seeds: int = 5, smoothing: float = 0.5,
                   confident: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Confident ``pattern`` and ``instance`` tables after ``rounds`` of mutual scoring.

    A pattern's confidence is the mean score of its distinct instances
    (smoothed), zero below ``min_seeds`` seeds; an unlabelled instance's score is
    the noisy-or of its patterns' confidences, a seed's is one. Each round is
    written to the shared scratch folder.
    """
    edges = stored(_edges(marked, "seeds", True).unionByName(_edges(marked, "others", False)).distinct(), "pattern-edges")
    scores = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for _ in range(rounds):
        joined = join_spread(edges, scores, ["instance"], "pattern")
        patterns = stored(joined.groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + smoothing)).alias("mean"), F.count_if("seed").alias("seeds")).select(
            "pattern", F.when(F.col("seeds") >= min_seeds, F.col("mean")).otherwise(0.0).alias("confidence")), "patterns")
        miss = F.sum(F.log(1 - F.least("confidence", F.lit(0.99))))
        scores = stored(join_spread(edges, patterns, ["pattern"], "instance").groupBy("instance").agg(
            F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(miss)).alias("score")), "instances")
    return (patterns.where(F.col("confidence") >= confident).select("pattern"),
            scores.where(F.col("score") >= confident).select("instance"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3,
                       min_seeds: int = 5, confident: float = 0.9) -> DataFrame:
    """Per row: ``doc_id, base`` and ``spans``, arrays of ``(start, rank, end, kind)``
    in code points, end exclusive, sorted by start, then kind.

    ``base`` are the pattern matches that pass their check; ``spans`` also holds
    the learned ones (kind ``id``), which never overlap a base span. Learned
    spans follow from the whole table given.

    Null and empty texts have no spans. Texts of any length are searched whole.
    Repeated rows each get their row, a null id stays null, an empty table gives
    no rows. Other columns are not read.
    """
    marked = stored(mark_documents(docs, id_col, text_col), "pii-marked")
    patterns, instances = score_patterns(marked, rounds, min_seeds, confident=confident)
    open_tokens = marked.where(F.size("others") > 0).select("b1", "b2", F.explode("others").alias("f")).select(
        "b1", "b2", "f.start", "f.end", F.lower("f.value").alias("instance"), F.explode(_patterns(F.col("f"))).alias("pattern"))
    open_tokens = open_tokens.distinct()  # of copies of a text once
    known = join_spread(open_tokens, stored(instances, "confident-instances"), ["instance"], "b1", "left_semi")
    learned = (join_spread(known, stored(patterns, "confident-patterns"), ["pattern"], "b1", "left_semi")
               .groupBy("b1", "b2").agg(F.collect_set(F.struct(
                   "start", F.lit(len(KINDS)).alias("rank"), "end", F.lit(LEARNED).alias("kind"))).cast(_SPAN).alias("learned")))
    both = F.array_sort(F.concat("spans", F.coalesce("learned", F.array().cast(_SPAN))))
    # Only texts with unlabelled identifier-like tokens can have learned spans; the others are not shuffled.
    hopeful = marked.where(F.size("others") > 0).select("doc_id", "b1", "b2", "spans").withColumn(
        "row", F.monotonically_increasing_id())
    hopeful = (join_spread(hopeful, stored(learned, "learned-spans"), ["b1", "b2"], "row", "left").select("doc_id", F.col("spans").alias("base"), both.alias("spans")))
    rest = marked.where(F.size("others") == 0).select("doc_id", F.col("spans").alias("base"), "spans")
    return rest.unionByName(hopeful)


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digest(found: DataFrame) -> DataFrame:
    counts = [F.size(F.filter("base", _is_kind(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind
