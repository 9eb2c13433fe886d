"""Chat formatting in budgeted windows, with DataFrame functions only.

Turns of a conversation are numbered by ``turn``. A turn's tokens are estimated by its length
(``CHARS_A_TOKEN``); prefix sums of them choose spans of whole turns: a span is what ends within one
stretch of ``budget`` tokens, its first turn standing alone where the stretch would be exceeded. So
every span is within the budget, but for single longer turns, which are kept whole.

A window is: the conversation's system turn, where it lies before the span; up to ``history_turns``
turns before the span, within ``history_tokens``; the span. The first two are repeated and masked;
the loss mask covers the assistant turns of the span, so each of them once over all windows.

In a text ``\\`` is written ``\\s`` and the ``<`` of a control string ``\\l``, so control strings in the
output are real ones, and both are undone by two replacements.

Defined results: null text and null role are empty strings; null turns come first; rows with equal
turns stand in the order of role and text, repeated rows each for itself; rows with a null
``conv_id`` are one conversation; an empty table gives no rows; other columns are never read. A turn
of any length is kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postroom.llm import common

BUDGET = 512
HISTORY_TOKENS = 128
HISTORY_TURNS = 2
CHARS_A_TOKEN = 4
#: The template.
OPEN, ENDS, CLOSE = "<turn ", ">\n", "\n</turn>\n"


def escape(text: Column) -> Column:
    plain = F.replace(text, F.lit("\\"), F.lit("\\s"))
    return F.replace(F.replace(plain, F.lit("<turn"), F.lit("\\lturn")), F.lit("</turn"), F.lit("\\l/turn"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role also must not end its own header."""
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\g"), F.lit(">")))


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, role, body, tokens, prefix`` in order within each conversation."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    body = escape(F.col("text"))
    shown = rows.select("conv_id", "turn", "role", "text", body.alias("body")).withColumn(
        "tokens", F.ceil((F.char_length("body") + F.char_length(escape_role(F.col("role"))) + len(OPEN + ENDS + CLOSE)) / CHARS_A_TOKEN).cast("long")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return shown.select(
        "conv_id", "role", "body", "tokens",
        F.row_number().over(order).alias("pos"),
        F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("prefix"),
    )


def windows(
    conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS
) -> DataFrame:
    """``conv_id, window`` (its first turn's place), ``text`` and ``segments``: for each turn in the
    window its role, where its text begins and how long it is (code points, as escaped), whether it
    is repeated, and whether the loss mask covers it."""
    c = F.col
    order = Window.partitionBy("conv_id").orderBy("pos")
    spans = turns(conversations).withColumn("stretch", F.floor((c("prefix") - 1) / budget))
    # the first turn of a stretch may have begun before it
    begins = (F.lag("stretch").over(order).isNull()) | (F.lag("stretch").over(order) != c("stretch"))
    spans = spans.withColumn("head", begins).withColumn("over", c("head") & (c("prefix") - c("tokens") < c("stretch") * budget))
    after = F.coalesce(F.lag("over").over(order), F.lit(False)) & ~c("head")
    spans = spans.withColumn("first", c("head") | after)
    spans = spans.withColumn("window", F.max(F.when(c("first"), c("pos"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # the conversation's system turn, known from its place on
    system = F.when(c("role") == "system", F.struct("pos", "role", "body"))
    spans = spans.withColumn("system", F.first(system, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    # a row goes to its own window, and as history to those that begin within the next turns
    def later(k: int) -> Column:
        held = F.lead("prefix", k - 1).over(order) - c("prefix") + c("tokens")
        return F.when(F.coalesce(F.lead("first", k).over(order), F.lit(False)) & (held <= history_tokens), c("pos") + k)

    # where the history of a window that begins here would begin
    def earlier(k: int) -> Column:
        held = c("prefix") - c("tokens") - F.lag("prefix", k).over(order) + F.lag("tokens", k).over(order)
        return F.when(held <= history_tokens, c("pos") - k)

    spans = spans.withColumn("reach", F.least("pos", *[earlier(k) for k in range(1, history_turns + 1)]))
    spans = spans.withColumns({f"later{k}": later(k) for k in range(1, history_turns + 1)})
    led = c("first") & c("system").isNotNull() & (c("system.pos") < c("reach"))

    def copy(to: Column, part: int, pos: Column, role: Column, body: Column) -> Column:
        return F.struct(to.cast("int").alias("window"), F.lit(part).alias("part"), pos.alias("pos"), role.alias("role"), body.alias("body"))

    copies = [copy(c("window"), 2, c("pos"), c("role"), c("body"))]
    copies += [copy(c(f"later{k}"), 1, c("pos"), c("role"), c("body")) for k in range(1, history_turns + 1)]
    copies += [copy(F.when(led, c("pos")), 0, c("system.pos"), c("system.role"), c("system.body"))]
    rows = spans.select("conv_id", F.explode(F.filter(F.array(*copies), lambda x: x["window"].isNotNull())).alias("g"))
    opened = F.concat(F.lit(OPEN), escape_role(c("g.role")), F.lit(ENDS)).alias("open")
    shown = rows.select("conv_id", "g.window", F.struct("g.part", "g.pos", "g.role", opened, "g.body").alias("s"))
    grouped = shown.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("s")).alias("s"))
    whole = F.transform("s", lambda x: F.concat(x["open"], x["body"], F.lit(CLOSE)))
    lengths = F.transform("s", lambda x: F.char_length(x["open"]) + F.char_length(x["body"]) + len(CLOSE))
    grouped = grouped.withColumns({"text": F.array_join(whole, ""), "lengths": lengths})
    segments = F.transform(
        "s",
        lambda x, i: F.struct(
            x["role"].alias("role"),
            (F.aggregate(F.slice(c("lengths"), 1, i), F.lit(0), lambda a, b: a + b) + F.char_length(x["open"])).alias("start"),
            F.char_length(x["body"]).alias("length"),
            (x["part"] < 2).alias("repeated"),
            ((x["part"] == 2) & (x["role"] == "assistant")).alias("loss"),
        ),
    )
    return grouped.select("conv_id", "window", "text", segments.alias("segments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns, loss, formatted_chars`` per conversation from its windows: the
    turns' roles and texts, and the text under the loss mask, as the output has them."""
    c = F.col
    # what a window's text says; the first part is empty
    cut = F.slice(F.split(c("text"), OPEN), 2, 1_000_000_000)
    said = F.transform(cut, lambda x, i: F.struct(
        unescape_role(F.substring_index(x, ENDS, 1)).alias("role"),
        # from the first end of a header to the closing sign
        unescape(F.substring(x, F.instr(x, ENDS) + len(ENDS), F.char_length(x) - F.instr(x, ENDS) - len(ENDS) - len(CLOSE) + 1)).alias("text"),
        F.get(c("segments"), i)["repeated"].alias("repeated"),
    ))
    new = F.filter(said, lambda x: ~x["repeated"])
    masked = F.transform(F.filter("segments", lambda x: x["loss"]), lambda x: unescape(F.substring(c("text"), x["start"] + 1, x["length"])))
    rows = formatted.select(
        "conv_id", "window", F.transform(new, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))).alias("turns"),
        F.array_join(masked, "").alias("loss"), F.char_length("text").alias("chars"),
    )
    rows = rows.select("conv_id", "window", F.size("turns").alias("n"), F.array_join("turns", "").alias("turns"), "loss", "chars")
    in_order = F.sort_array(F.collect_list(F.struct("window", "turns", "loss")))
    held = rows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), in_order.alias("w"))
    return held.select("conv_id", "n_turns", F.array_join("w.turns", "").alias("turns"), F.array_join("w.loss", "").alias("loss"), "formatted_chars")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    found = read_back(windows(given.unionByName(added)))
    return found.select(
        "conv_id", F.col("n_turns").cast("long"), F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"),
    )


_FRAME = "PARTITION BY conv_id ORDER BY pos"
_ESCAPED = r"replace(replace(replace({0}, '\', '\s'), '<turn', '\lturn'), '</turn', '\l/turn')"

#: The same in DuckDB: digests from the given rows, and the windows' size from prefix sums.
OP9_SQL = rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length({_ESCAPED.format("text")}) + length(replace(replace({_ESCAPED.format("role")}, '>', '\g'), chr(10), '\n')) + {len(OPEN + ENDS + CLOSE)} AS chars
  FROM given
), placed AS (
  SELECT *, CAST(ceil(chars / {CHARS_A_TOKEN}.0) AS BIGINT) AS tokens,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM sized
), summed AS (
  SELECT *, sum(tokens) OVER ({_FRAME} ROWS UNBOUNDED PRECEDING) AS prefix FROM placed
), dealt AS (
  SELECT *, CAST(floor((prefix - 1) / {BUDGET}) AS BIGINT) AS stretch FROM summed
), headed AS (
  SELECT *, coalesce(lag(stretch) OVER ({_FRAME}) <> stretch, true) AS head FROM dealt
), over_it AS (
  SELECT *, head AND prefix - tokens < stretch * {BUDGET} AS over FROM headed
), begun AS (
  SELECT *, head OR coalesce(lag(over) OVER ({_FRAME}), false) AS first,
    min(CASE WHEN role = 'system' THEN pos END) OVER ({_FRAME} ROWS UNBOUNDED PRECEDING) AS system_pos
  FROM over_it
), counted AS (
  SELECT *,
    {" + ".join(f"CASE WHEN lead(first, {k}) OVER ({_FRAME}) AND lead(prefix, {k - 1}) OVER ({_FRAME}) - prefix + tokens <= {HISTORY_TOKENS} THEN 1 ELSE 0 END" for k in range(1, HISTORY_TURNS + 1))} AS again,
    least(pos, {", ".join(f"CASE WHEN prefix - tokens - lag(prefix, {k}) OVER ({_FRAME}) + lag(tokens, {k}) OVER ({_FRAME}) <= {HISTORY_TOKENS} THEN pos - {k} END" for k in range(1, HISTORY_TURNS + 1))}) AS reach
  FROM begun
), led AS (
  SELECT a.conv_id, sum(b.chars) AS chars FROM counted a JOIN counted b
    ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos = a.system_pos WHERE a.first AND a.system_pos < a.reach GROUP BY 1
), own AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars * (1 + again)) AS chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '') AS loss
  FROM counted GROUP BY conv_id
)
SELECT own.conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(own.chars + coalesce(led.chars, 0) AS BIGINT) AS formatted_chars
FROM own LEFT JOIN led ON own.conv_id IS NOT DISTINCT FROM led.conv_id
"""
