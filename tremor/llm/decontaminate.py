"""Benchmark decontamination by template canonicalisation.

Texts become tokens: runs of letters and digits, and numbers. A template
replaces each number (in digits or as a number word), name (a token with a
capital, unless it is a common word, so that sentences may begin with either)
and unit (a word after a number) by a typed placeholder; other words are
lower-cased. Windows of template tokens of every document meet those of the
benchmark items in a hash join, so a question whose values were changed still
matches. Windows of the lower-cased tokens as written meet in the same join,
whatever they hold, so a copy needs no ordinary words.

A window is formed only where its first three tokens begin some item's window: a
bitmap of those beginnings, of bounded size, is tested at every token. For the
few texts and items that share enough windows, tokens are compared along each
alignment and the slots are checked: one value of the item must always have
become the same value.

Spark expressions only.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import stored

NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
#: Number words.
NUMBER_WORDS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
    "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty",
    "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion", "dozen")
#: Words that are neither names where they are capitalised nor units after a number.
COMMON_WORDS = (
    "a", "about", "after", "all", "an", "and", "any", "are", "as", "at", "be", "because", "been", "before", "but", "by",
    "calculate", "can", "compute", "could", "determine", "did", "do", "does", "during", "each", "every", "explain", "find",
    "for", "from", "give", "given", "had", "has", "have", "he", "her", "his", "how", "i", "if", "in", "into", "is", "it",
    "its", "let", "many", "more", "most", "much", "no", "not", "of", "on", "or", "our", "she", "should", "since", "so",
    "some", "suppose", "than", "that", "the", "their", "then", "there", "these", "they", "this", "those", "to", "use",
    "was", "we", "were", "what", "when", "where", "which", "while", "who", "whom", "whose", "why", "will", "with", "would",
    "write", "you", "your")
_TOKEN = r"\p{L}[\p{L}\p{N}]*|[0-9]+(?:[.,][0-9]+)*|\p{N}+"
#: Item windows, and texts with matches, are broadcast up to so many; beyond, both sides are shuffled.
MAX_BROADCAST_ROWS = 1_000_000
#: So many tokens of an item in a row, as written, count by themselves.
LONG_RUN = 13
#: Tokens that begin a window; bits of the bitmap per beginning and in all.
ANCHOR, ANCHOR_BITS, MAX_ANCHOR_BITS = 3, 16, 1 << 23


def raw_tokens(text: Column) -> Column:
    """Tokens as written."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(_TOKEN), F.lit(0))


def written(tokens: Column) -> Column:
    """Lower-cased tokens: the same wherever a text stands."""
    return F.transform(tokens, lambda t: F.lower(t))


def _slot(token: Column, plain: Column, before: Column, plain_before: Column, key) -> Column:
    """Placeholder of a token, null for an ordinary word. ``plain`` is its
    lower-cased form under ``key``, which also spells the word lists."""
    def among(c, words):
        return c.isin([key(w) for w in words])

    def is_number(t, p):
        return (t < ":") | among(p, NUMBER_WORDS)  # a token begins with a digit or sorts behind them

    common = among(plain, COMMON_WORDS)
    return (F.when(is_number(token, plain), key(NUMBER)).when((token != F.lower(token)) & ~common, key(NAME))
            .when(is_number(before, plain_before) & ~common, key(UNIT)))


def template(raw: Column, plain: Column) -> Column:
    """Tokens with typed placeholders for numbers, names and units."""
    return F.transform(raw, lambda t, i: F.coalesce(
        _slot(t, F.get(plain, i), F.get(raw, i - 1), F.get(plain, i - 1), F.lit), F.get(plain, i)))


def _hashed_token(word: str) -> Column:
    return F.xxhash64(F.lit(word))


def _token_hashes(tokenised: DataFrame) -> DataFrame:
    """Adds the hashes of the tokens as written and of their template."""
    plain = tokenised.withColumn("plain_hashes", F.transform("raw", lambda t: F.xxhash64(F.lower(t))))
    return plain.withColumn("form_hashes", F.transform("raw", lambda t, i: F.coalesce(
        _slot(t, F.get("plain_hashes", i), F.get("raw", i - 1), F.get("plain_hashes", i - 1), _hashed_token),
        F.get("plain_hashes", i))))


def _window(tokens: str, i: Column, length) -> Column:
    """Hash of ``length`` tokens from place ``i``."""
    if isinstance(length, int):  # hashing values one after another equals hashing their array, and is faster
        return F.xxhash64(*[F.get(tokens, i + k) for k in range(length)])
    return F.xxhash64(F.slice(tokens, i + 1, length))


def _anchor(tokens: str, i: Column, length: int) -> Column:
    """A number for the first tokens of a window; cheaper than a hash."""
    mixed = F.get(tokens, i)
    for k in range(1, length):
        mixed = F.shiftleft(mixed, 7).bitwiseXOR(F.shiftrightunsigned(mixed, 9)).bitwiseXOR(F.get(tokens, i + k))
    return mixed


def _is_slot(token: Column) -> Column:
    return token.isin(NUMBER, UNIT, NAME)


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                    window: int = 8) -> DataFrame:
    """``item, item_id, raw, plain, form, n, length``: a key, tokens, tokens as
    written, template, their number and the window length; items without a token
    are left out, shorter ones are one window, repeated ones stand once."""
    raw = benchmark.select(F.col(id_col).alias("item_id"), raw_tokens(F.col(text_col)).alias("raw")).where(F.size("raw") > 0)
    items = raw.withColumn("item", F.xxhash64(F.col("item_id").isNull(), "item_id", "raw")).dropDuplicates(["item"])
    items = items.withColumn("plain", written(F.col("raw")))
    return items.withColumns({"form": template(F.col("raw"), F.col("plain")), "n": F.size("raw"),
                              "length": F.least(F.size("raw"), F.lit(window))})


def item_windows(items: DataFrame, min_words: int) -> DataFrame:
    """``item, length, at, kind, hash`` of all windows as written (kind 0), and of
    the template windows (1) with at least ``min_words`` ordinary words (or
    nothing but them, in short items); with their ``anchor``."""
    places = F.sequence(F.lit(0), F.col("n") - F.col("length"))
    at = _token_hashes(items).withColumn("at", F.explode(places))
    words = F.size(F.filter(F.slice("form", F.col("at") + 1, F.col("length")), lambda t: ~_is_slot(t)))
    seeds = words >= F.least("length", F.lit(min_words))

    def kind(number, tokens):
        anchor = F.when(F.col("length") == 1, _anchor(tokens, F.col("at"), 1)).when(
            F.col("length") == 2, _anchor(tokens, F.col("at"), 2)).otherwise(_anchor(tokens, F.col("at"), ANCHOR))
        return F.struct(F.lit(number).alias("kind"), _window(tokens, F.col("at"), F.col("length")).alias("hash"), anchor.alias("anchor"))

    kinds = F.when(seeds, F.array(kind(0, "plain_hashes"), kind(1, "form_hashes"))).otherwise(F.array(kind(0, "plain_hashes")))
    return at.select("item", "length", "at", F.explode(kinds).alias("w")).select("item", "length", "at", "w.kind", "w.hash", "w.anchor")


def _broadcast_if_small(rows: DataFrame) -> DataFrame:
    """Counted first: so joins with many equal texts need no shuffle by text while this holds."""
    return F.broadcast(rows) if rows.count() <= MAX_BROADCAST_ROWS else rows


def _hashed(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumn("_b1", F.xxhash64(text)).withColumn("_b2", F.xxhash64(F.lit(1), text))


class _Anchors:
    """Bitmap of the beginnings of item windows. Its size follows their number up
    to ``MAX_ANCHOR_BITS``; beyond that more windows are formed, none is missed."""

    def __init__(self, anchors: DataFrame):
        n = anchors.count()
        words = 1024
        while words * 64 < ANCHOR_BITS * n and words * 64 < MAX_ANCHOR_BITS:
            words *= 2
        self.words = words
        slot, bit = self._place(F.col("anchor"))
        # At most MAX_ANCHOR_BITS / 64 numbers, whatever the benchmark's size.
        rows = anchors.select(slot.alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits")).groupBy(
            "slot").agg(F.bit_or("bits").alias("bits")).collect()
        held = dict.fromkeys(range(words), 0) | {r["slot"]: r["bits"] for r in rows}
        self.bitmap = F.split(F.lit(",".join(str(held[i]) for i in range(words))), ",").cast("array<bigint>")

    def _place(self, anchor: Column) -> tuple[Column, Column]:
        slot = F.shiftrightunsigned(anchor, 20).bitwiseAND(F.lit(self.words - 1)).cast("int")
        return slot, anchor.bitwiseAND(F.lit(63)).cast("int")

    def may_begin(self, anchor: Column) -> Column:
        slot, bit = self._place(anchor)
        return F.call_function("shiftright", F.get(self.bitmap, slot), bit).bitwiseAND(F.lit(1)) == 1


def _text_windows(forms: DataFrame, lengths: list[int], targets: DataFrame) -> DataFrame:
    """``_b1, _b2, place, length, hash`` of the windows that may be an item's."""
    parts = []
    for first in sorted({min(n, ANCHOR) for n in lengths}):
        own = [n for n in lengths if min(n, ANCHOR) == first]
        anchors = _Anchors(targets.where(F.least("length", F.lit(ANCHOR)) == first).select("anchor").distinct())
        # One row per token, and plain columns from here on: compiled, unlike functions over arrays. (Outer, since
        # for an inner one Spark adds a filter on the array's size, in which the hashes would be made per token again.)
        each = forms.select("_b1", "_b2", "plain_hashes", "form_hashes", F.posexplode_outer("form_hashes").alias("place", "token"))
        found = each.where(reduce(or_, (anchors.may_begin(_anchor(tokens, F.col("place"), first))
                                        for tokens in ("form_hashes", "plain_hashes")))).drop("token")
        # Hashes at once, in the same compiled stage: the arrays are not copied to the rows that pass.
        hashes = {f"{kind}_{n}": _window(f"{kind}_hashes", F.col("place"), n) for n in own for kind in ("plain", "form")}
        whole = {f"whole_{n}": F.col("place") + n <= F.size("plain_hashes") for n in own}
        found = found.select("_b1", "_b2", "place", *(c.alias(k) for k, c in {**hashes, **whole}.items()))
        windows = []
        for n in own:
            plain, form, fits = F.col(f"plain_{n}"), F.col(f"form_{n}"), F.col(f"whole_{n}")
            windows += [F.struct(fits.alias("fits"), F.lit(n).alias("length"), plain.alias("hash")),
                        F.struct((fits & (plain != form)).alias("fits"), F.lit(n).alias("length"), form.alias("hash"))]
        parts.append(found.select("_b1", "_b2", "place", F.explode(F.array(*windows)).alias("w")).where("w.fits").select(
            "_b1", "_b2", "place", "w.length", "w.hash"))
    return reduce(DataFrame.unionByName, parts)


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = 8,
                       min_words: int = 4, min_share: float = 0.5, long_run: int = LONG_RUN) -> DataFrame:
    """Texts that hold an item: ``b1, b2`` (hashes of the text), ``item_id``,
    ``n_windows`` of ``item_windows`` that match as templates or as written,
    ``n_literal`` of them as written, ``slots``, ``slots_changed``, ``consistent``.

    An item is in a text if at least ``min_share`` of its windows, or windows that
    cover more than that share of its tokens, match as written (lower-cased tokens,
    wherever the item stands), or match as written or as templates along
    alignments with consistent slots; or if ``long_run`` tokens in a row (no fewer
    than ``window``) match as written. Windows of all alignments are added, so
    words put in, left out or replaced only cost the windows they touch. An
    alignment is one along which a window met in the join.

    The counts returned are those of the best alignment.
    """
    items = benchmark_items(benchmark, window=window)
    targets = stored(item_windows(items, min_words), "benchmark-windows")
    # One number per distinct length, at most `window` of them.
    lengths = sorted(r["length"] for r in targets.select("length").distinct().collect())
    texts = _hashed(docs.select(F.col(text_col).cast("string").alias("text")), "text")
    if not lengths:
        none = texts.limit(0).select(F.col("_b1").alias("b1"), F.col("_b2").alias("b2"))
        return none.select("b1", "b2", F.lit(None).cast(dict(items.dtypes)["item_id"]).alias("item_id"), *(
            F.lit(0).alias(c) for c in ("item_windows", "n_literal", "n_windows", "slots", "slots_changed")),
            F.lit(True).alias("consistent"))
    forms = _token_hashes(texts.withColumn("raw", raw_tokens(F.col("text"))))
    windows = _text_windows(forms, lengths, targets)
    met = windows.join(_broadcast_if_small(targets.select("length", "hash", "item", "at").distinct()), ["length", "hash"])
    met = stored(met.select("_b1", "_b2", "item", "at", (F.col("place") - F.col("at")).alias("shift")).distinct(), "benchmark-hits")
    # Too few of an item's windows in a text, even if all that stand outside the join matched: a stock phrase.
    seeded = targets.groupBy("item").agg(F.count_distinct(F.when(F.col("kind") == 1, F.col("at"))).alias("seeded"))
    sizes = items.join(seeded, "item").select("item", "n", "length", (F.col("n") - F.col("length") + 1).alias("windows"), "seeded")
    least = F.least(F.ceil(min_share * F.col("windows")), F.floor(min_share * F.col("n") / F.col("length")) + 1,
                    F.greatest(F.lit(long_run) - F.col("length") + 1, F.lit(1)))
    needed = _broadcast_if_small(sizes.select("item", (least - (F.col("windows") - F.col("seeded"))).alias("needed")))
    enough_met = met.groupBy("_b1", "_b2", "item").agg(F.count_distinct("at").alias("met"), F.collect_set("shift").alias("shifts"))
    hits = stored(enough_met.join(needed, "item").where(F.col("met") >= F.col("needed")).select("_b1", "_b2", "item", "shifts"),
                  "benchmark-pairs")
    bodies = _broadcast_if_small(hits.select("_b1", "_b2").distinct())
    matched = texts.join(bodies, ["_b1", "_b2"], "left_semi").dropDuplicates(["_b1", "_b2"])
    doc = matched.withColumn("raw", raw_tokens(F.col("text"))).withColumn("doc_plain", written(F.col("raw"))).select(
        "_b1", "_b2", "doc_plain", template(F.col("raw"), F.col("doc_plain")).alias("doc_form"))
    own = _broadcast_if_small(items.select("item", "item_id", "plain", "form", "n", "length"))
    near = hits.select("_b1", "_b2", "item", F.explode("shifts").alias("shift")).join(own, "item")
    every = F.sequence(F.lit(0), F.col("n") - 1)
    # The tokens along one alignment; nothing else of the document goes on.
    pairs = near.join(doc, ["_b1", "_b2"]).select(
        "_b1", "_b2", "item_id", "item", "length", "n",
        F.transform(every, lambda k: F.struct(
            F.get("form", k).alias("form"), F.get("plain", k).alias("plain"),
            F.get("doc_plain", F.col("shift") + k).alias("doc_plain"),
            F.coalesce(F.get("plain", k) == F.get("doc_plain", F.col("shift") + k), F.lit(False)).alias("literal"),
            F.coalesce(F.get("form", k) == F.get("doc_form", F.col("shift") + k), F.lit(False)).alias("same"))).alias("t"))

    last = F.col("n") - F.col("length") + 1

    def whole(test):
        return F.filter(F.sequence(F.lit(1), last), lambda i: F.forall(F.slice("t", i, F.col("length")), test))

    slots = F.filter("t", lambda t: t["same"] & _is_slot(t["form"]))
    values = F.transform("slots", lambda t: F.struct(t["plain"], t["doc_plain"]))
    checked = pairs.withColumn("slots", slots).select(
        "_b1", "_b2", "item_id", "item", "n", "length", last.alias("item_windows"),
        whole(lambda t: t["literal"]).alias("as_written"), whole(lambda t: t["same"] | t["literal"]).alias("as_form"),
        F.size("slots").alias("slots"),
        F.size(F.filter(values, lambda v: v["plain"] != v["doc_plain"])).alias("slots_changed"),
        (F.size(F.array_distinct(values)) == F.size(F.array_distinct(F.transform(values, lambda v: v["plain"]))))
        .alias("consistent"))
    # Windows in a row from one to one so much later: that many tokens in a row.
    ahead = F.greatest(F.lit(long_run) - F.col("length"), F.lit(0))
    run = F.exists(F.transform("as_written", lambda at, i: F.coalesce(
        F.get("as_written", i + ahead) - at == ahead, F.lit(False))), lambda long: long)
    checked = checked.withColumn("long", run & (F.lit(long_run) <= F.col("n"))).withColumns({
        "n_literal": F.size("as_written"), "n_windows": F.size("as_form"),
        "as_form": F.when(F.col("consistent"), F.col("as_form")).otherwise(F.col("as_written"))})
    # The alignment that counts most by itself is the best.
    alone = F.size("as_form") >= min_share * F.col("item_windows")
    added = checked.groupBy("_b1", "_b2", "item_id", "item", "n", "length", "item_windows").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("as_written")))).alias("as_written"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("as_form")))).alias("as_form"),
        F.max("long").alias("long"),
        F.max(F.struct(alone.alias("alone"), "n_literal", "n_windows", "slots", "slots_changed", "consistent")).alias("best"))

    def enough(places):
        covered = F.aggregate(F.transform(places, lambda at, i: F.least(F.col("length"), F.get(places, i + 1) - at)),
                              F.lit(0), lambda a, b: a + b)
        return (F.size(places) >= min_share * F.col("item_windows")) | (covered > min_share * F.col("n"))

    held = added.where(F.col("long") | enough(F.col("as_written")) | enough(F.col("as_form")))
    return held.groupBy(F.col("_b1").alias("b1"), F.col("_b2").alias("b2"), "item_id", "item_windows").agg(
        F.max("best").alias("best")).select("b1", "b2", "item_id", "item_windows", "best.n_literal", "best.n_windows",
                                            "best.slots", "best.slots_changed", "best.consistent")


def find_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **how) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id, item_id``
    and the counts of :func:`contaminated_texts`.

    Exact copies are compared once and each gets its rows; repeated rows repeat
    them, a null id stays null. Null and empty texts, and items without a token,
    match nothing. Whole texts of any length are compared. Empty tables give no
    rows. Other columns are not read.
    """
    found = _broadcast_if_small(stored(contaminated_texts(docs, benchmark, text_col, **how), "contaminated"))
    ids = _hashed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    return ids.select("doc_id", F.col("_b1").alias("b1"), F.col("_b2").alias("b2")).join(found, ["b1", "b2"]).drop(
        "b1", "b2")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item is found, columns as they are.

    Null and empty texts are kept; repeated rows are judged alike, with or
    without an id; texts of any length are compared whole. An empty table gives
    no rows, an empty benchmark all.
    """
    found = _broadcast_if_small(stored(
        contaminated_texts(docs, benchmark, text_col, **how).select("b1", "b2").distinct(), "contaminated"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.join(found, (F.xxhash64(text) == found["b1"]) & (F.xxhash64(F.lit(1), text) == found["b2"]), "left_anti")


def _sql_forms(table: str, id_col: str) -> str:
    numbers, common = (", ".join(f"'{w}'" for w in words) for words in (NUMBER_WORDS, COMMON_WORDS))

    def number(t):
        return f"(({t} >= '0' AND {t} < ':') OR lower({t}) IN ({numbers}))"

    return f"""SELECT {id_col}, raw, list_transform(raw, lambda t: lower(t)) AS plain,
      list_transform(raw, lambda t, i: CASE WHEN {number('t')} THEN '<number>'
        WHEN lower(t) IN ({common}) THEN lower(t) WHEN t <> lower(t) THEN '<name>'
        WHEN i > 1 AND {number('raw[i - 1]')} THEN '<unit>' ELSE lower(t) END) AS form
    FROM (SELECT {id_col}, regexp_extract_all(coalesce(text, ''),
        '\\p{{L}}[\\p{{L}}\\p{{N}}]*|[0-9]+(?:[.,][0-9]+)*|\\p{{N}}+') AS raw FROM {table})"""


def _sql_enough(places: str) -> str:
    """SQL: half of the windows, or windows over more than half of the tokens."""
    return f"""(2 * len({places}) >= item_windows OR 2 * list_sum(list_transform({places}, lambda a, i:
      CASE WHEN i < len({places}) THEN least(length, {places}[i + 1] - a) ELSE length END)) > n)"""


#: Equivalent result over the given tables (with distinct ids).
ORACLE = f"""
WITH docs AS ({_sql_forms('documents','doc_id')}),
items AS (SELECT *, len(raw) AS n, least(len(raw), 8) AS length FROM ({_sql_forms('benchmark','item_id')}) WHERE len(raw) > 0),
targets AS (
  SELECT item_id, length, q, plain[q + 1:q + length] AS p, form[q + 1:q + length] AS f
  FROM (SELECT *, unnest(range(0, n - length + 1)) AS q FROM items)),
windows AS (
  SELECT doc_id, pos, plain[pos + 1:pos + length] AS p, form[pos + 1:pos + length] AS f
  FROM (SELECT doc_id, plain, form, length, unnest(range(0, len(raw) - length + 1)) AS pos
        FROM docs CROSS JOIN (SELECT DISTINCT length FROM items) WHERE len(raw) >= length)),
hits AS (
  SELECT doc_id, item_id, pos - q AS shift FROM windows JOIN targets USING (p)
  UNION
  SELECT doc_id, item_id, pos - q FROM windows JOIN targets USING (f)
  WHERE len(list_filter(f, lambda t: t NOT IN ('<number>', '<unit>', '<name>'))) >= least(length, 4)),
tokens AS (
  SELECT h.doc_id, h.item_id, h.shift, i.length, i.n, k, i.form[k] AS form, i.plain[k] AS own,
    CASE WHEN shift + k >= 1 THEN d.plain[shift + k] END AS other,
    coalesce(shift + k >= 1 AND d.form[shift + k] = i.form[k], false) AS same,
    coalesce(shift + k >= 1 AND d.plain[shift + k] = i.plain[k], false) AS literal
  FROM (SELECT h.*, unnest(range(1, i.n + 1)) AS k FROM hits h JOIN items i USING (item_id)) h
  JOIN items i USING (item_id) JOIN docs d ON d.doc_id = h.doc_id),
framed AS (
  SELECT *, form IN ('<number>', '<unit>', '<name>') AND same AS slot, k <= n - length + 1 AND bool_and(literal) OVER w AS as_written,
    k <= n - length + 1 AND bool_and(same OR literal) OVER w AS as_form,
    k <= n - {LONG_RUN - 1} AND bool_and(literal) OVER (
      PARTITION BY doc_id, item_id, shift ORDER BY k ROWS BETWEEN CURRENT ROW AND {LONG_RUN - 1} FOLLOWING) AS long
  FROM tokens
  WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY k ROWS BETWEEN CURRENT ROW AND length - 1 FOLLOWING)),
checked AS (
  SELECT doc_id, item_id, shift, any_value(n) AS n, any_value(length) AS length, any_value(n - length + 1) AS item_windows,
    coalesce(list(k) FILTER (as_written), []) AS as_written, coalesce(list(k) FILTER (as_form), []) AS forms, bool_or(long) AS long,
    count(*) FILTER (slot) AS slots, count(*) FILTER (slot AND own <> other) AS slots_changed,
    count(DISTINCT {{'own': own, 'other': other}}) FILTER (slot) = count(DISTINCT own) FILTER (slot) AS consistent
  FROM framed GROUP BY doc_id, item_id, shift),
counted AS (
  SELECT *, len(as_written) AS n_literal, len(forms) AS n_windows, CASE WHEN consistent THEN forms ELSE as_written END AS as_form FROM checked),
added AS (
  SELECT doc_id, item_id, any_value(n) AS n, any_value(length) AS length, any_value(item_windows) AS item_windows,
    list_sort(list_distinct(flatten(list(as_written)))) AS as_written, list_sort(list_distinct(flatten(list(as_form)))) AS as_form,
    bool_or(long) AS long FROM counted GROUP BY doc_id, item_id),
held AS (SELECT doc_id, item_id FROM added WHERE long OR {_sql_enough('as_written')} OR {_sql_enough('as_form')}),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY 2 * len(as_form) >= item_windows DESC,
    n_literal DESC, n_windows DESC, slots DESC, slots_changed DESC, consistent DESC) AS place
  FROM counted JOIN held USING (doc_id, item_id))
SELECT doc_id, item_id, CAST(item_windows AS INTEGER) AS item_windows, CAST(n_literal AS INTEGER) AS n_literal,
  CAST(n_windows AS INTEGER) AS n_windows, CAST(slots AS INTEGER) AS slots, CAST(slots_changed AS INTEGER) AS slots_changed,
  consistent
FROM best WHERE place = 1
"""
