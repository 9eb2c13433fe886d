"""Message exports: scan, MIME part flattening, body selection and payload
decoding (SURVEY 2.1: S1-S4; 2.6: G1, J4, A2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroom.session import work_path

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("internal_ts", T.TimestampNTZType()),
        T.StructField("sender", T.StringType()),
        T.StructField("recipient", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("label_ids", T.ArrayType(T.StringType())),
        T.StructField("has_attachment", T.BooleanType()),
        T.StructField("payload", T.StringType()),
    ]
)

ATTACHMENT_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("attachment_id", T.StringType()),
        T.StructField("data", T.StringType()),
    ]
)

BODY = T.StructType(
    [
        T.StructField("size", T.LongType()),
        T.StructField("data", T.StringType()),
        T.StructField("attachmentId", T.StringType()),
    ]
)
# One MIME part; its children stay JSON text so the type is not recursive.
PART = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("mimeType", T.StringType()),
        T.StructField("body", BODY),
        T.StructField("parts", T.StringType()),
    ]
)
PARTS = T.ArrayType(PART)



def scan_messages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Read a message export (JSON lines or parquet) with a fixed schema,
    so F1-F9 filters are pushed into the scan where the format allows."""
    reader = spark.read.schema(MESSAGE_SCHEMA)
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)


#: Levels that one narrow pass unrolls: the first, for all messages, and the
#: next ones, for those that still have parts below.
FIRST_LEVELS, NEXT_LEVELS = 4, 12


def _levels(trees: DataFrame, levels: int) -> DataFrame:
    """The parts of the first ``levels`` levels below rows ``message_id,
    path, parts`` (children as JSON text), in one narrow pass: each level is
    a higher-order ``transform`` over the one before, kept as a projected
    column of its own so the optimizer does not parse it again. ``below`` is
    the JSON of the children of the last level's parts."""
    children = lambda text: F.coalesce(F.from_json(text, PARTS), F.array())
    df = trees.select("message_id", F.transform(children(F.col("parts")), lambda p, i: F.struct(F.array_append("path", i).alias("path"), p.alias("part"))).alias("_l0"))
    for d in range(1, levels):
        below = lambda x: F.transform(children(x["part"]["parts"]), lambda c, j: F.struct(F.array_append(x["path"], j).alias("path"), c.alias("part")))
        df = df.withColumn(f"_l{d}", F.flatten(F.transform(F.col(f"_l{d - 1}"), below)))

    def tagged(d: int) -> Column:
        return F.transform(f"_l{d}", lambda x: F.struct(x["path"].alias("path"), x["part"].alias("part"), F.lit(d == levels - 1).alias("last")))

    return df.select("message_id", F.inline(F.concat(*[tagged(d) for d in range(levels)])))


def flatten_parts(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """MIME tree, however deep, to one row per part in level order.
    ``depth`` 0 are the top-level parts, ``path`` the child indexes from the
    root; the order key ``(depth, path)`` is the reference's level order.

    A few levels are unrolled for all messages in one narrow pass. Only the
    subtrees that go deeper are written to the shared work folder, and taken
    from there some levels at a time until none is left: a deep mail costs
    its own levels, and the plan doesn't grow with it."""
    spark = messages.sparkSession
    trees = messages.select("message_id", F.array().cast("array<int>").alias("path"), F.get_json_object(F.col(payload), "$.parts").alias("parts"))
    found = _levels(trees, FIRST_LEVELS)
    left, stage, steps = _left(found), work_path(spark, "deep-mails"), []
    left.write.parquet(stage)
    left = spark.read.schema(left.schema).parquet(stage)
    while not left.isEmpty():
        steps.append(work_path(spark, "deep-parts"))
        deeper = _levels(left, NEXT_LEVELS)
        deeper.write.parquet(steps[-1])
        left = _left(spark.read.schema(deeper.schema).parquet(steps[-1]))
    return _described(found.unionByName(spark.read.schema(found.schema).parquet(*steps)) if steps else found)


def _left(found: DataFrame) -> DataFrame:
    """The subtrees below the last level that was unrolled."""
    below = F.col("part.parts")
    return found.where("last").where(below.isNotNull() & (F.trim(below) != "[]")).select("message_id", "path", below.alias("parts"))


def _described(found: DataFrame) -> DataFrame:
    return found.select(
        "message_id",
        (F.size("path") - 1).alias("depth"),
        "path",
        F.col("part.filename").alias("filename"),
        F.col("part.mimeType").alias("mime_type"),
        F.col("part.body.size").alias("size"),
        F.col("part.body.data").alias("data"),
        F.col("part.body.attachmentId").alias("attachment_id"),
    )


def own_body(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """The message's own body data when its size is non-zero."""
    size = F.get_json_object(F.col(payload), "$.body.size").try_cast("long")
    data = F.get_json_object(F.col(payload), "$.body.data")
    return messages.select("message_id", F.when(F.coalesce(size, F.lit(0)) != 0, data).alias("own_data"))


def select_body(messages: DataFrame, parts: DataFrame, mime_type: str = "text/html") -> DataFrame:
    """S3/A2: the message's own body if its size is non-zero, else the last
    part in level order with an empty file name and the requested type.

    The part side is a partial+final hash aggregate keyed by message; the
    join then reuses that partitioning for the message side.
    """
    last = (
        parts.where((F.col("filename") == "") & (F.col("mime_type") == F.lit(mime_type)))
        .groupBy("message_id")
        .agg(F.max_by("data", F.struct("depth", "path")).alias("part_data"))
    )
    return (
        own_body(messages)
        .join(last, "message_id", "left")
        .select("message_id", F.coalesce("own_data", "part_data").alias("data"))
        .where(F.col("data").isNotNull())
    )


def urlsafe_b64decode(c) -> Column:
    """URL-safe base64 text to bytes. ``unbase64`` alone drops ``-`` and
    ``_``, so they are mapped back to ``+`` and ``/`` first."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unbase64(F.translate(c, "-_", "+/"))


def urlsafe_b64encode(c) -> Column:
    """Bytes to URL-safe base64 text (no line breaks: Spark's ``base64``
    wraps lines with CRLF, removed by a literal replace)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(F.replace(F.base64(c), F.lit("\r\n"), F.lit("")), "+/", "-_")


def decode_payload(parts: DataFrame, attachments: DataFrame) -> DataFrame:
    """Part bytes from inline data, else looked up by attachment id.

    Inline parts skip the join entirely, so rows with a NULL attachment id
    never pile into one shuffle partition.
    """
    inline = parts.where(F.col("data").isNotNull())
    by_id = (
        parts.where(F.col("data").isNull() & F.col("attachment_id").isNotNull())
        .drop("data")
        .join(attachments.select("message_id", "attachment_id", "data"), ["message_id", "attachment_id"], "left")
    )
    both = inline.unionByName(by_id.select(*inline.columns))
    return both.withColumn("content", urlsafe_b64decode("data"))
