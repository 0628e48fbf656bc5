"""Quotation linking for chat messages.

A message's lines are parted by quote level (``>``, ``>>`` …). Consecutive lines
of one level are a passage; its normalised text is hashed and joined to the
messages that wrote that text themselves: as the whole text, as a line, or as a run
of consecutive lines and sentences, however these were wrapped. Runs are only hashed
where a rolling hash says that one was quoted, so no length is left out. The passages of
the lowest level name the message that is answered. Pointer doubling along the answers gives each
message its thread and depth; the result is ordered so that answers come after
what they answer, without the quotes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import KeyFilter, materialise
from tierlake.llm.text import mix

_PREFIX = re.compile(r"(?:[ \t]*>)+")
#: A word that ends a sentence.
_END = re.compile(r"[.!?…。！？][\"'”’)\]]*$")
_BASE = 0x9E3779B97F4A7C15


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """(own text, passages as (level, text)) of a message. Attribution lines stay own text."""
    own, passages, last = [], [], 0
    for line in text.split("\n"):
        mark = _PREFIX.match(line)
        level = mark.group().count(">") if mark else 0
        if not level:
            own.append(line)
        elif level == last:
            passages[-1][1].append(line[mark.end():])
        else:
            passages.append((level, [line[mark.end():]]))
        last = level
    return "\n".join(own).strip("\n"), [(level, "\n".join(lines)) for level, lines in passages]


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _keys(text: str) -> list[tuple[int, int, bool]]:
    """(rank, hash): the whole text, then its lines."""
    whole = normal(text)
    lines = dict.fromkeys(x for x in map(normal, text.split("\n")) if x and x != whole)
    return [(rank, _hash(x)) for rank, x in enumerate([whole, *lines]) if x]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, modulo 2**64."""
    return tuple(np.cumprod(np.array([1] + [b] * n, np.uint64)) for b in (_BASE, pow(_BASE, -1, 2**64)))


def _sums(words: list[str], powers: np.ndarray) -> np.ndarray:
    """Running sums of the words' hashes times the powers; a run's rolling hash is a difference of two."""
    out = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(np.array([_hash(w) for w in words], np.int64).view(np.uint64) * powers[:len(words)], out=out[1:])
    return out


def _asked_run(text: str) -> tuple[int, int]:
    """(words, rolling hash) of a passage or line."""
    words = normal(text).split()
    return len(words), int(mix(_sums(words, _powers(len(words))[0])[-1:], seed=len(words)).view(np.int64)[0])


def runs_of(text: str, lengths: list[int], may_be_asked) -> dict[str, None]:
    """The normalised runs of consecutive lines and sentences of ``text`` that may have been quoted."""
    words, cuts = [], [0]
    for line in text.split("\n"):
        for word in normal(line).split():
            words.append(word)
            if _END.search(word):
                cuts.append(len(words))
        cuts.append(len(words))
    starts, is_cut, found = np.unique(cuts), np.zeros(len(words) + 1, bool), {}
    is_cut[starts] = True
    powers, inverse = _powers(len(words))
    sums = _sums(words, powers)
    for n in lengths:
        if n > len(words):
            break
        a = starts[starts + n <= len(words)]
        a = a[is_cut[a + n]]
        for k in a[may_be_asked(mix((sums[a + n] - sums[a]) * inverse[a], seed=n))]:
            found[" ".join(words[k:k + n])] = None
    return found


_RUN = pa.struct([("words", pa.int32()), ("run", pa.int64())])
_KEY = pa.struct([("rank", pa.int32()), ("hash", pa.int64())])
_QUOTE = pa.struct([("number", pa.int32()), ("level", pa.int32()), ("keys", pa.list_(_KEY)), ("runs", pa.list_(_RUN))])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                        ("own_keys", pa.list_(_KEY)), ("quotes", pa.list_(_QUOTE))])

    def key(x: tuple) -> dict:
        return {"rank": x[0], "hash": x[1]}

    def run(x: tuple) -> dict:
        return {"words": x[0], "run": x[1]}

    for batch in batches:
        own_texts, own_keys, quotes = [], [], []
        for text in batch.column("text").to_pylist():
            own, passages = parse(text or "")
            own_texts.append(None if text is None else own)
            own_keys.append([key(x) for x in _keys(own)])
            quotes.append([{"number": k, "level": level, "keys": [key(x) for x in _keys(passage)],
                            "runs": [run(x) for x in dict.fromkeys(map(_asked_run, [passage, *passage.split("\n")])) if x[0]]} for k, (level, passage) in enumerate(passages)])
        yield pa.record_batch([batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(own_texts, pa.string()),
                               pa.array(own_keys, pa.list_(_KEY)), pa.array(quotes, pa.list_(_QUOTE))], schema=schema)


def _quoted_runs(parsed: DataFrame) -> DataFrame | None:
    """``conv_id, turn, hash`` of the runs of own text that may have been quoted; None without quotes.

    The driver sees the distinct lengths of the quotes in words and a filter of fixed size.
    """
    asked = parsed.select(F.explode("quotes").alias("q")).select(F.explode("q.runs").alias("r")).select("r.run", "r.words")
    lengths = sorted(r["words"] for r in asked.select("words").distinct().collect())
    if not lengths:
        return None
    asked_runs = KeyFilter.build(asked.select("run"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, x) for k, text in enumerate(batch.column("text").to_pylist()) if text for x in runs_of(text, lengths, asked_runs.may_hold)]
            part = batch.select(["conv_id", "turn"]).take(pa.array([k for k, _ in rows], pa.int64()))
            yield pa.record_batch([*part.columns, pa.array([_hash(x) for _, x in rows], pa.int64())], names=["conv_id", "turn", "hash"])

    return parsed.select("conv_id", "turn", "text").mapInArrow(found, "conv_id long, turn long, hash long")


def quote_links(parsed: DataFrame) -> DataFrame:
    """``conv_id, turn, number, level, to_conv, to_turn`` of each quote that was found.

    The original is the first message of the conversation that wrote the passage
    (else one of its lines), as its text, a line or a run of lines and sentences; it
    must come before the quote. If the conversation has none, the first message of the
    other conversation of least id that wrote the passage (else one of its lines),
    however short: ids carry no time, so any other conversation may hold it. Each key has one original (two, for quotes in the first one's own
    conversation), so a passage that very many messages hold or quote joins to one row.
    """
    asked = parsed.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.number", "q.level", F.explode("q.keys").alias("k")) \
        .select("conv_id", "turn", "number", "level", "k.rank", "k.hash")
    own = parsed.select("conv_id", "turn", F.explode("own_keys").alias("k")).select("conv_id", "turn", "k.hash")
    runs = _quoted_runs(parsed)
    own = own if runs is None else own.union(runs)
    near = materialise(own.join(asked.select("hash").distinct(), "hash", "left_semi").groupBy("conv_id", "hash")
                       .agg(F.min("turn").alias("to_turn")), "originals")
    elsewhere = near.select("hash", F.struct("conv_id", F.col("to_turn").alias("turn")).alias("to"))
    first = elsewhere.groupBy("hash").agg(F.min("to").alias("first"))
    other = elsewhere.join(first, "hash").where("to.conv_id <> first.conv_id").groupBy("hash").agg(F.min("to").alias("other"))
    far = first.join(other, "hash", "left")
    inside = asked.join(near, ["conv_id", "hash"]).where("to_turn < turn") \
        .select("conv_id", "turn", "number", "level", F.lit(0).alias("place"), "rank", F.col("conv_id").alias("to_conv"), "to_turn")
    outside = asked.join(far, "hash").withColumn("to", F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).otherwise(F.col("other"))) \
        .where("to IS NOT NULL") \
        .select("conv_id", "turn", "number", "level", F.lit(1).alias("place"), "rank", F.col("to.conv_id").alias("to_conv"), F.col("to.turn").alias("to_turn"))
    return inside.union(outside).groupBy("conv_id", "turn", "number", "level") \
        .agg(F.min(F.struct("place", "rank", "to_conv", "to_turn")).alias("best")) \
        .select("conv_id", "turn", "number", "level", "best.to_conv", "best.to_turn")


def _closing(parents: DataFrame) -> DataFrame | None:
    """``conv_id, turn`` of the messages whose answer closes a cycle: the least message of each.

    Inside a conversation answers go back, so only an answer to a conversation of greater
    id can close one. Each round doubles the length of the paths, with the least message on them;
    paths that end drop out. When none does any more and the paths are longer
    than the messages left are many, their ends are the messages on cycles.
    """
    if parents.where("to_conv > conv_id").limit(1).count() == 0:
        return None
    now = materialise(parents.select(F.struct("conv_id", "turn").alias("m"), F.struct(F.col("to_conv").alias("conv_id"), F.col("to_turn").alias("turn")).alias("up"))
                      .withColumn("least", F.col("m")), "paths")
    length, before, left = 1, -1, now.count()
    while left and (left != before or length < left):
        up = now.select(F.col("m").alias("up"), F.col("up").alias("next"), F.col("least").alias("more"))
        now = materialise(now.join(up, "up").select("m", F.col("next").alias("up"), F.least("least", "more").alias("least")), "paths")
        length, before, left = 2 * length, left, now.count()
    return now.join(now.select(F.col("up").alias("m")).distinct(), "m", "left_semi").where("m = least").select("m.conv_id", "m.turn") if left else None


def _threads(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, thread_conv, thread_turn, depth`` of each message that answers another.

    Each round doubles the length of the pointers; there must be no cycles.
    """
    now = materialise(parents.select("conv_id", "turn", F.col("to_conv").alias("up_conv"), F.col("to_turn").alias("up_turn"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = now.select(F.col("conv_id").alias("up_conv"), F.col("turn").alias("up_turn"), F.col("up_conv").alias("next_conv"),
                        F.col("up_turn").alias("next_turn"), F.col("depth").alias("more"))
        joined = materialise(now.join(up, ["up_conv", "up_turn"], "left").select(
            "conv_id", "turn", F.coalesce("next_conv", "up_conv").alias("up_conv"), F.coalesce("next_turn", "up_turn").alias("up_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("more").isNotNull().alias("moved")), "threads")
        now = joined.drop("moved")
        if joined.where("moved").limit(1).count() == 0:
            return now.select("conv_id", "turn", F.col("up_conv").alias("thread_conv"), F.col("up_turn").alias("thread_turn"), "depth")


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per message, in reply order and without quotes.

    ``messages`` has ``conv_id, turn, role, text``; other columns are ignored.
    Returns ``conv_id, turn, role, text`` (own lines only), ``n_quotes``,
    ``n_linked``, ``reply_conv, reply_turn`` (the answered message or NULL),
    ``thread_conv, thread_turn`` (the first message of the chain of answers) and
    ``depth``. Rows are ranged and sorted by thread, then depth, conversation, turn:
    an answer never comes before what it answers. Where answers between conversations
    go round in a circle, the least message of the circle answers none.

    - A NULL text stays NULL and has no quotes; a text of quotes only becomes empty.
    - A NULL conv_id or turn: the quotes are removed and counted, nothing is linked.
    - Rows that share (conv_id, turn) share their links; all of them are returned.
    - Several originals of one passage: the least turn of the conversation, else of the least
      other conversation. Very long texts are hashed whole, in time near linear in their length.
    - An empty table gives an empty result.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    parsed = materialise(rows.mapInArrow(_parsed, "conv_id long, turn long, role string, text string, own_keys array<struct<rank:int,hash:long>>, "
                                         "quotes array<struct<number:int,level:int,keys:array<struct<rank:int,hash:long>>,runs:array<struct<words:int,run:long>>>>"), "parsed")
    links = materialise(quote_links(parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL")), "quote_links")
    # The lowest quote level is what the message answers; of several passages the last message.
    answers = links.groupBy("conv_id", "turn").agg(F.count("*").alias("n_linked"), F.min(F.struct("level", -F.col("to_conv"), -F.col("to_turn"), "to_conv", "to_turn")).alias("best")) \
        .select("conv_id", "turn", "n_linked", F.col("best.to_conv").alias("to_conv"), F.col("best.to_turn").alias("to_turn"))
    answers = materialise(answers, "answers")
    closing = _closing(answers)
    if closing is not None:
        answers = materialise(answers.join(closing.withColumn("closing", F.lit(True)), ["conv_id", "turn"], "left")
                              .select("conv_id", "turn", "n_linked", *[F.when(F.col("closing").isNull(), F.col(c)).alias(c) for c in ("to_conv", "to_turn")]), "answers")
    threads = _threads(answers.where("to_conv IS NOT NULL"))
    extra = answers.join(threads, ["conv_id", "turn"], "left")
    out = parsed.join(extra, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text", F.size("quotes").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("to_conv").alias("reply_conv"), F.col("to_turn").alias("reply_turn"),
        F.coalesce("thread_conv", "conv_id").alias("thread_conv"), F.when(F.col("thread_conv").isNull(), F.col("turn")).otherwise(F.col("thread_turn")).alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
    order = ["thread_conv", "thread_turn", "depth", "conv_id", "turn"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)
