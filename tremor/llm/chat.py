"""Chat formatting with Spark expressions only.

Template of a conversation, with adjacent turns of one role merged::

    ### user:
    first text<+>next text of the same role</turn>
    ### assistant:
    answer</turn>

The control strings are escaped inside texts and roles so that the output reads
back exactly: ``\\`` is written ``\\s``, ``###`` ``\\h``, ``</turn>`` ``\\t``,
``<+>`` ``\\j``, and a line break in a role ``\\n``. An escaped text thus holds no
control string, and a backslash always starts one of these pairs.

Long conversations are sorted and merged in stretches of ``stretch`` turn
numbers, which bounds the arrays worked on; the stretches meet in the
conversation's row, which holds the whole conversation in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, HEAD_END, TURN_END, JOIN = "### ", ":\n", "</turn>\n", "<+>"
ESCAPES = (("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\t"), ("<+>", "\\j"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))
_RUNS = "array<struct<role:string,texts:array<string>>>"


def escape(c: Column, pairs=ESCAPES) -> Column:
    for plain, written in pairs:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescape(c: Column, pairs=ESCAPES) -> Column:
    for plain, written in reversed(pairs):
        c = F.replace(c, F.lit(written), F.lit(plain))
    return c


def _merge_adjacent(turns: Column) -> Column:
    """Sorted turn structs → runs of one role with their texts."""
    def step(runs, turn):
        n = F.size(runs)
        last = F.get(runs, n - 1)
        same = (n > 0) & (last["role"] == turn["role"])
        grown = F.struct(turn["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        single = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return F.when(same, F.concat(F.slice(runs, 1, F.greatest(n - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(runs, F.array(single)))

    return F.aggregate(turns, F.array().cast(_RUNS), step)


def _segments(runs: Column, train_roles: tuple[str, ...]) -> Column:
    """Runs → alternating template and text segments; texts of trained roles bear the loss."""
    def of_run(run, i):
        before = F.get(runs, i - 1)
        continues = (i > 0) & (before["role"] == run["role"])  # a run cut by a stretch border
        head = F.concat(F.when(i > 0, F.lit(TURN_END)).otherwise(F.lit("")), F.lit(HEAD),
                        escape(run["role"], ROLE_ESCAPES), F.lit(HEAD_END))
        lead = F.when(continues, F.lit(JOIN)).otherwise(head)
        return F.flatten(F.transform(run["texts"], lambda text, k: F.array(
            F.struct(F.when(k == 0, lead).otherwise(F.lit(JOIN)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(text).alias("text"), run["role"].isin(*train_roles).alias("loss")))))

    end = F.array(F.struct(F.lit(TURN_END).alias("text"), F.lit(False).alias("loss")))
    return F.concat(F.flatten(F.transform(runs, of_run)), end)


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", train_roles: tuple[str, ...] = ("assistant",),
                         stretch: int = 256) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments``.

    ``segments`` is the loss mask: ``(text, loss)`` pieces that join to
    ``formatted``; ``loss`` marks the texts to train on.

    Rows of a conversation are sorted by turn, then role and text, so tied and
    repeated rows keep a defined order and all stay. A null turn sorts first, a
    null role is the empty role, a null text is empty, and rows with a null
    conversation id form one conversation. An empty table gives no rows. Other
    columns are not read.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.floor(F.col(turn_col) / stretch).alias("stretch"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("row"))
    # One shuffle serves both groupings: stretches of a conversation are formed where it is put together.
    parts = rows.repartition("conv_id").groupBy("conv_id", "stretch").agg(F.sort_array(F.collect_list("row")).alias("rows")).select(
        "conv_id", F.struct("stretch", _merge_adjacent(F.col("rows")).alias("runs")).alias("part"))
    runs = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts")).select(
        "conv_id", F.flatten(F.transform("parts", lambda p: p["runs"])).alias("runs"))
    segments = runs.select("conv_id", _segments(F.col("runs"), train_roles).alias("segments"))
    return segments.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                           "segments")


def parse_turns(formatted: Column) -> Column:
    """Formatted text → array of ``(role, text)`` turns, as they went in."""
    def of_block(block):
        cut = F.locate(HEAD_END, block)
        role = unescape(F.substring(block, F.lit(len(HEAD) + 1), cut - len(HEAD) - 1), ROLE_ESCAPES)
        texts = F.split(F.substring(block, cut + len(HEAD_END), F.length(block)), r"<\+>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, TURN_END, -1)
    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), of_block))


def format_digest(formatted: DataFrame) -> DataFrame:
    """Counts and checksums of what reads back from the formatted conversations."""
    turns = formatted.withColumn("turns", parse_turns(F.col("formatted"))).withColumn(
        "loss_text", F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                              lambda s: unescape(s["text"])), ""))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: Equivalent result over the given table plus the control-string conversation.
ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
sized AS (
  SELECT *, length(replace(replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\t'), '<+>', '\j'))
    + CASE WHEN before = role THEN 3
           ELSE 6 + length(replace(replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\t'),
                '<+>', '\j'), chr(10), '\n')) + 8 END AS chars
  FROM marked)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(length(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
