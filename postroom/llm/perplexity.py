"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model.

The model is of characters (order ``ORDER``), one per language, from all trusted texts. N-grams are
sharded by their language and the two characters before the last: then all suffixes of three and
more characters, and all their contexts, stand in the same shard, and only counts of one and two
characters go to every shard. A block of about ``BLOCK_CHARS`` characters sends each shard its
distinct n-grams, packed, once. Shards of the trusted texts' n-grams are summed to the model's
counts; shards of all texts' n-grams meet those counts, and the answers go back to the blocks, where
they meet the compressed texts. Answers are fixed-point numbers of five bytes (``STEP``). Blocks are
cut from the same scan twice; a text with an n-gram that was not answered fails the job.

A document is rejected if its mean negative log probability, shrunk towards its language's median
by ``PRIOR_CHARS`` characters, is above the language's threshold: quantile ``HIGH`` of trusted texts
that the model has not learned. Where they are too few to show it, it is the highest of them or, if
that is more, the quantile of an exponential tail above the median with their mean.

Defined results: null texts and languages are empty strings; an empty text has its end sign only;
a text in a language without trusted texts is held against the model and the quantiles of the trusted
texts of all languages together (``POOLED``); without any trusted text perplexity is null and all is
kept; languages with few held-out texts use the quantiles of all; repeated rows one row each; an
empty table gives no rows; other columns are never read. Texts of any length are read whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common

ORDER = 5
BLOCK_CHARS = 32_000_000
#: Characters of a block that are worked on at a time; n-grams that are merged at a time at least.
CHUNK_CHARS, LEAST_MERGED = 1_600_000, 500_000
#: Shards of n-grams; partitions of the scan whose blocks meet a shard in one task.
SHARDS, PART_PARTITIONS = 64, 256
#: The unit of the log probabilities that answers carry.
STEP = 2.0**-33
HIGH = 0.999
PRIOR_CHARS = 200
#: One in so many trusted texts is held out for the thresholds; the least number a language needs.
HELD_OUT, LEAST_HELD = 5, 30
#: The language that texts without a model of their own are given.
POOLED = "*"
#: The signs that stand before and after a text.
BEFORE, AFTER = "\x02", "\x03"


class Grams:
    """The n-grams of some texts: ``codes`` of distinct ones by language (a row of code points each),
    ``kind`` the number of each place's n-gram, ``text_of`` its text."""

    def __init__(self, texts: list[str], langs: list[str]):
        joined = "".join(f"{BEFORE * (ORDER - 1)}{t}{AFTER}" for t in texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + ORDER
        known = np.flatnonzero(np.bincount(codes))
        dense = np.zeros(int(known[-1]) + 1, np.int64)
        dense[known] = np.arange(len(known))
        ids = dense[codes]
        lang, names = pd.factorize(np.array(langs, object))
        n = len(ids) - ORDER + 1
        key = np.repeat(lang, size)[ORDER - 1 :].astype(np.int64)
        for k in range(ORDER):
            if key.max(initial=0) >= (1 << 62) // len(known):
                key = pd.factorize(key)[0].astype(np.int64)
            key = key * len(known) + ids[k : k + n]
        # places whose n-gram ends within a text or at its end
        inside = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
        last = np.flatnonzero(inside >= ORDER - 1)
        self.kind, distinct = pd.factorize(key[last - ORDER + 1])
        self.text_of = np.repeat(np.arange(len(texts)), size)[last]
        first = np.empty(len(distinct), np.int64)
        first[self.kind[::-1]] = np.arange(len(self.kind))[::-1]
        self.codes = codes[last[first][:, None] + np.arange(1 - ORDER, 1)]
        of = lang[self.text_of[first]]
        self.by_lang = [(name, np.flatnonzero(of == k)) for k, name in enumerate(names)]


class Keys:
    """Whole numbers for n-grams given by their code points: equal for equal ones, in their order.
    Other n-grams are looked up with ``of``; one with a sign or a beginning that isn't known is -1."""

    def __init__(self, codes: np.ndarray):
        seen = np.bincount(codes.ravel()) > 0 if len(codes) else np.zeros(1, bool)
        self.base = max(1, int(seen.sum()))
        self.dense = np.where(seen, np.cumsum(seen) - 1, -1)
        self.heads: np.ndarray | None = None
        if self.base**ORDER >= 1 << 63:
            # too many signs for one number: the n-grams' beginnings are numbered
            self.heads = np.unique(self._number(self.dense[codes[:, :3]]))
            if len(self.heads) * self.base ** (ORDER - 3) >= 1 << 63:
                raise OverflowError("too many different n-grams in a block")
        self.known = self.of(codes)

    def _number(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        for k in range(ids.shape[1]):
            out = out * self.base + ids[:, k]
        return out

    def of(self, codes: np.ndarray) -> np.ndarray:
        ids = np.full(codes.shape, -1, np.int64)
        low = codes < len(self.dense)
        ids[low] = self.dense[codes[low]]
        missing = (ids < 0).any(1)
        ids[missing] = 0
        if self.heads is None:
            out = self._number(ids)
        else:
            head = self._number(ids[:, :3])
            at = np.minimum(np.searchsorted(self.heads, head), max(0, len(self.heads) - 1))
            missing |= self.heads[at] != head
            out = at
            for k in range(3, ORDER):
                out = out * self.base + ids[:, k]
        out[missing] = -1
        return out


class Distinct:
    """The distinct n-grams of many chunks, with the sum of their counts, as sorted arrays."""

    def __init__(self) -> None:
        self.codes, self.n = np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, codes: np.ndarray, n: np.ndarray) -> None:
        self.more.append((codes, n))
        self.waiting += len(codes)
        if self.waiting > max(len(self.codes), LEAST_MERGED):
            self.merge()

    def merge(self) -> Distinct:
        if self.more:
            codes, n = (np.concatenate(x) for x in zip((self.codes, self.n), *self.more))
            self.more, self.waiting = [], 0
            key = Keys(codes).known
            order = np.argsort(key)
            key = key[order]
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            self.codes, self.n = codes[order[start]], np.add.reduceat(n[order], start) if len(key) else n
        return self


def batches_of(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple[int, Iterator[tuple[list, list, list]]]]:
    """Numbered blocks, each as an iterator of chunks (ids, languages, texts) that must be taken to
    its end; a block's number is the scan's partition and the block's place in it. Both scans give
    the same columns, so that Spark cuts the same batches from them."""
    first = TaskContext.get().partitionId() << 32
    source = (part for batch in batches for part in common.chunks(batch, ["doc_id", "lang", "text"], most=CHUNK_CHARS))
    state = {"next": next(source, None)}

    def block() -> Iterator[tuple[list, list, list]]:
        chars = 0
        while state["next"] is not None and (not chars or chars < block_chars):
            part = state["next"]
            yield part
            chars += 1 + sum(map(len, part[2]))
            state["next"] = next(source, None)

    while state["next"] is not None:
        yield first, block()
        first += 1


def shard_of(lang: str, pair: str) -> int:
    return zlib.crc32(f"{lang}\0{pair}".encode()) % SHARDS


def packed(number: int, held: dict[str, Distinct], values: bool) -> Iterator[dict]:
    """A row for each shard and language: its n-grams, sorted, as one compressed string; and their
    counts."""
    for lang, found in held.items():
        found.merge()
        pair, which = np.unique(found.codes[:, ORDER - 3].astype(np.int64) << 21 | found.codes[:, ORDER - 2], return_inverse=True)
        shard = np.array([shard_of(lang, chr(p >> 21) + chr(p & (1 << 21) - 1)) for p in pair.tolist()], np.int64)[which]
        order = np.argsort(shard, kind="stable")
        edge = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)) if len(order) else order
        for at in np.split(order, edge[1:]) if len(order) else []:
            joined = found.codes[at].astype("<u4").tobytes().decode("utf-32-le").encode()
            row = {"shard": int(shard[at[0]]), "part": (number >> 32) // PART_PARTITIONS, "block": number, "lang": lang, "grams": zstandard.compress(joined, 9)}
            if values:
                row["n"] = zstandard.compress(found.n[at].tobytes(), 9)
            yield row


def unpacked(raw: bytes) -> np.ndarray:
    """The code points of packed n-grams, a row each."""
    return np.frombuffer(zstandard.decompress(raw).decode().encode("utf-32-le"), "<u4").reshape(-1, ORDER)


def strings(codes: np.ndarray) -> list[str]:
    joined = codes.astype("<u4").tobytes().decode("utf-32-le")
    return [joined[i : i + ORDER] for i in range(0, len(joined), ORDER)]


def fixed(logp: np.ndarray) -> bytes:
    """Log probabilities in units of STEP, five bytes each, byte by byte apart; all ones: none."""
    n = np.where(np.isnan(logp), (1 << 40) - 1, np.round(np.nan_to_num(-logp) / STEP)).astype("<u8")
    return zstandard.compress(np.ascontiguousarray(n.view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes(), 3)


def unfixed(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(5, -1)
    n = np.zeros((planes.shape[1], 8), np.uint8)
    n[:, :5] = planes.T
    whole = n.view("<u8").ravel()
    return np.where(whole == (1 << 40) - 1, np.nan, whole * -STEP)


PACKED = "shard int, part long, block long, lang string, grams binary"


def _text_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text")


def asked(docs: DataFrame, values: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The distinct n-grams of each block, packed by shard; with ``values`` also their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in batches_of(batches, block_chars):
            held: dict[str, Distinct] = {}
            for _, langs, texts in block:
                g = Grams(texts, langs)
                n = np.bincount(g.kind, minlength=len(g.codes))
                for lang, at in g.by_lang:
                    held.setdefault(lang, Distinct()).add(g.codes[at], n[at])
            yield pa.RecordBatch.from_pylist(list(packed(number, held, values)), schema)

    fields = [("shard", pa.int32()), ("part", pa.int64()), ("block", pa.int64()), ("lang", pa.string()), ("grams", pa.binary())]
    schema = pa.schema(fields + [("n", pa.binary())] * int(values))
    return _text_rows(docs).mapInArrow(common.lean(run), PACKED + ", n binary" * int(values))


def gram_counts(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``lang, gram, n`` over all rows; summed by block, by shard and part, then over parts."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        counts: dict[str, Distinct] = {}
        for row in frame.itertuples():
            counts.setdefault(row.lang, Distinct()).add(unpacked(row.grams), np.frombuffer(zstandard.decompress(row.n), np.int64))
        found = pd.concat([pd.DataFrame({"lang": lang, "gram": strings(held.merge().codes), "n": held.n}) for lang, held in counts.items()])
        del counts
        common.release()
        return found

    summed = asked(docs, True, block_chars).groupBy("shard", "part").applyInPandas(add, "lang string, gram string, n long")
    return summed.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def model(counts: DataFrame) -> DataFrame:
    """``lang, key, own, total, back``: of an n-gram its discounted count; of a context the sum of
    the counts after it, and the count that its discounts leave to the lower order. The empty
    context also has, as own, the number of distinct signs and one for all others."""
    c = F.col
    orders = [common.staged(counts, "grams")]
    for k in range(ORDER - 1, 0, -1):
        # in how many different ways the shorter one is continued to the left
        lower = orders[-1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
        orders.append(lower)
    every = None
    for k, held in zip(range(ORDER, 0, -1), orders):
        part = held.withColumn("k", F.lit(k))
        every = part if every is None else every.unionByName(part)
    every = common.staged(every, "grams")
    ones = [F.count_if(c("n") == i).cast("double").alias(f"n{i}") for i in range(1, 5)]
    y = c("n1") / (c("n1") + 2 * c("n2"))

    def discount(i: int) -> Column:
        found = F.when((c("n1") > 0) & (c(f"n{i}") > 0), i - (i + 1) * y * c(f"n{i + 1}") / c(f"n{i}"))
        return F.least(F.greatest(F.coalesce(found, F.lit(0.75)), F.lit(0.05)), F.lit(i - 0.05)).alias(f"d{i}")

    discounts = every.groupBy("lang", "k").agg(*ones).select("lang", "k", discount(1), discount(2), discount(3))
    cut = every.join(common.small(discounts), ["lang", "k"]).withColumn("d", F.when(c("n") == 1, c("d1")).when(c("n") == 2, c("d2")).otherwise(c("d3")))
    own = cut.select("lang", c("gram").alias("key"), (c("n") - c("d")).alias("own"))
    contexts = cut.groupBy("lang", F.expr("substring(gram, 1, k - 1)").alias("key")).agg(
        F.sum("n").cast("double").alias("total"), F.sum("d").alias("back"), (F.count("*") + 1).cast("double").alias("signs")
    )
    return own.join(contexts, ["lang", "key"], "full").select(
        "lang", "key", F.when(c("key") == "", c("signs")).otherwise(F.coalesce("own", F.lit(0.0))).alias("own"),
        F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("back", F.lit(0.0)).alias("back"),
    )


def sharded(known: DataFrame, parts: int) -> DataFrame:
    """The model's rows in the shards where n-grams can ask for them, for each part of the blocks."""
    size, key = F.char_length("key"), F.col("key")

    def shard(pair: Column) -> Column:
        return F.pmod(F.crc32(F.encode(F.concat(F.col("lang"), F.lit("\0"), pair), "UTF-8")), F.lit(SHARDS)).cast("int")

    as_own = F.when((F.col("own") > 0) & (size > 2), F.array(shard(F.substring(key, size - 2, F.lit(2))))).otherwise(F.array().cast("array<int>"))
    as_context = F.when((F.col("total") > 0) & (size > 2), F.array(shard(F.substring(key, size - 1, F.lit(2))))).otherwise(F.array().cast("array<int>"))
    every = F.sequence(F.lit(0), F.lit(SHARDS - 1))
    dealt = known.withColumn("shard", F.explode(F.when(size <= 2, every).otherwise(F.array_distinct(F.concat(as_own, as_context)))))
    return dealt.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))


class ShardModel:
    """What one shard holds of a language's model, and the probabilities of its n-grams."""

    def __init__(self, rows: pd.DataFrame):
        self.own = dict(zip(rows["key"], rows["own"]))
        self.context = {k: (t, b) for k, t, b in zip(rows["key"], rows["total"], rows["back"]) if t > 0}
        self.known: dict[str, float] = {}

    def logp(self, gram: str) -> float:
        if (found := self.known.get(gram)) is None:
            p = 1 / self.own[""]
            for k in range(1, ORDER + 1):
                if held := self.context.get(gram[ORDER - k : ORDER - 1]):
                    p = (self.own.get(gram[ORDER - k :], 0.0) + held[1] * p) / held[0]
            found = self.known[gram] = math.log(p)
        return found


def document_log_probabilities(docs: DataFrame, known: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, lang, n_chars, logp`` (of all its signs together), ``text_hash`` for each row of ``docs``."""
    rows = _text_rows(docs)
    parts = -(-rows.rdd.getNumPartitions() // PART_PARTITIONS)

    def answer(asks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        models = {lang: ShardModel(held) for lang, held in answers.groupby("lang")}
        out = []
        for row in asks.itertuples():
            grams = strings(unpacked(row.grams))
            model = models.get(row.lang)
            out.append((row.block, row.lang, row.grams, fixed(np.array([model.logp(g) for g in grams] if model else [np.nan] * len(grams)))))
        del models
        common.release()
        return pd.DataFrame(out, columns=["block", "lang", "grams", "logp"])

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in batches_of(batches, block_chars):
            for place, (ids, langs, texts) in enumerate(block):
                raw = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "lang": pa.array(langs, pa.string()), "text": pa.array(texts, pa.large_string())})
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, raw.schema) as out:
                    out.write_batch(raw)
                yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "place": pa.array([place], pa.int32()), "texts": pa.array([zstandard.compress(sink.getvalue(), 9)], pa.binary())})

    def score(key: tuple, texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        held_: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for row in answers.itertuples():
            held_.setdefault(row.lang, []).append((unpacked(row.grams), unfixed(row.logp)))
        del answers
        logp: dict[str, tuple[Keys, np.ndarray, np.ndarray]] = {}
        for lang in list(held_):
            codes, value = (np.concatenate(x) for x in zip(*held_.pop(lang)))
            keys = Keys(codes)
            order = np.argsort(keys.known)
            logp[lang] = keys, keys.known[order], value[order]
            keys.known = codes = value = None
        out = []
        for raw in texts["texts"]:
            held = pa.ipc.open_stream(zstandard.decompress(raw)).read_all().to_pydict()
            g = Grams(held["text"], held["lang"])
            each = np.empty(len(g.codes))
            for lang, at in g.by_lang:
                keys, known, value = logp[lang]
                wanted = keys.of(g.codes[at])
                order = np.argsort(wanted)
                place = np.searchsorted(known, wanted[order])
                if len(known) <= place.max(initial=-1) or (known[place] != wanted[order]).any():
                    raise KeyError(f"an n-gram of language {lang!r} was not answered")
                each[at[order]] = value[place]
            n = len(held["doc_id"])
            out.append(pa.table({
                "doc_id": pa.array(held["doc_id"], pa.int64()), "lang": pa.array(held["lang"], pa.string()),
                "n_chars": pa.array(np.bincount(g.text_of, minlength=n)), "logp": pa.array(np.bincount(g.text_of, each[g.kind], n)),
                "text_hash": pa.array([common.text_hash(t) for t in held["text"]], pa.int64()),
            }))
        del logp
        common.release()
        return pa.concat_tables(out).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get) if out else pd.DataFrame({"doc_id": [], "lang": [], "n_chars": [], "logp": [], "text_hash": []})

    asks = asked(rows, False, block_chars)
    schema = "block long, lang string, grams binary, logp binary"
    answered = asks.groupBy("shard", "part").cogroup(sharded(known, parts).groupBy("shard", "part")).applyInPandas(answer, schema)
    texts = rows.mapInArrow(common.lean(shrink), "block long, place int, texts binary")
    return texts.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(score, "doc_id long, lang string, n_chars long, logp double, text_hash long")


def judged(scored: DataFrame, apart: DataFrame, high: float) -> DataFrame:
    """The columns of ``quality_classifier`` for rows of ``document_log_probabilities``, with the
    thresholds that the trusted rows ``apart`` show."""
    c = F.col
    mean = lambda rows: rows.withColumn("logp", F.when(~F.isnan("logp"), c("logp"))).withColumn("mean", -c("logp") / c("n_chars"))
    scored, apart = mean(scored), mean(apart).where("mean is not null")
    mid = [F.percentile_approx("mean", 0.5, 10000).alias("mid"), F.count("*").alias("n")]
    middle = apart.groupBy("lang").agg(*mid).where(c("n") >= LEAST_HELD).drop("n")
    shrunk = (-c("logp") + PRIOR_CHARS * c("mid")) / (c("n_chars") + PRIOR_CHARS)

    def placed(rows: DataFrame) -> DataFrame:
        """With the median of the language and the shrunk mean above it."""
        rows = rows.join(common.small(middle), "lang", "left")
        return rows.withColumn("mid", F.coalesce("mid", F.lit(any_mid).cast("double"))).withColumn("loss", shrunk)

    any_mid = apart.agg(*mid).first()["mid"]
    above = placed(apart).withColumn("over", c("loss") - c("mid"))
    tail = F.avg(F.when(c("over") > 0, c("over"))) * math.log(0.5 / (1 - high))
    top = F.greatest(F.percentile_approx("over", high, 10000), F.when(F.count("*") * (1 - high) < 1, tail))
    any_top = above.agg(top).first()[0]
    tops = above.groupBy("lang").agg(top.alias("top"), F.count("*").alias("n")).where(c("n") >= LEAST_HELD).drop("n")
    found = placed(scored).join(common.small(tops), "lang", "left")
    limit = c("mid") + F.coalesce("top", F.lit(any_top).cast("double"))
    return found.select(
        "doc_id", "lang", "n_chars", F.exp("mean").alias("perplexity"), F.when(c("mean").isNotNull(), c("loss")).alias("loss"), limit.alias("threshold"),
        (~F.coalesce(c("mean").isNotNull() & (c("loss") > limit), F.lit(False))).alias("kept"), "text_hash",
    )


def quality_classifier(docs: DataFrame, trusted: DataFrame, high: float = HIGH) -> DataFrame:
    """``doc_id, lang, n_chars, perplexity, loss, threshold, kept, text_hash`` for each row of
    ``docs``, given the ``doc_id`` of trusted rows. loss is the shrunk mean that is held against the
    threshold; lang is ``POOLED`` where all languages' model was asked; text_hash tells rows of one
    id apart."""
    ids = common.small(trusted.select("doc_id").where("doc_id is not null").distinct())
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(HELD_OUT)) == 0
    rows = _text_rows(docs)
    learned = rows.join(ids.where(~held), "doc_id", "left_semi")
    known = common.staged(model(gram_counts(learned)), "model")
    # languages there are trusted texts of, not rows
    languages = [r["lang"] for r in known.select("lang").distinct().collect()]
    strange = ~F.col("lang").isin(languages)
    pooled = bool(languages) and not rows.select("lang").where(strange).isEmpty()

    own = rows.where(~strange) if pooled else rows
    scored = common.staged(document_log_probabilities(own, known), "log-probabilities")
    found = judged(scored, scored.join(ids.where(held), "doc_id", "left_semi"), high)
    if not pooled:
        return found
    as_one = lambda part: part.select("doc_id", F.lit(POOLED).alias("lang"), "text")
    every = common.staged(model(gram_counts(as_one(learned))), "pooled-model")
    probes = common.staged(as_one(rows.join(ids.where(held), "doc_id", "left_semi")), "probes")
    rest = common.staged(document_log_probabilities(as_one(rows.where(strange)), every), "log-probabilities")
    probed = common.staged(document_log_probabilities(probes, every), "log-probabilities")
    return found.unionByName(judged(rest, probed, high))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    return quality_classifier(docs, labels.where("quality = 1")).drop("text_hash")
