"""Mixture-controlled packing of documents into fixed-length token sequences.

Every source is a queue of token ids with a target share. Deficit round-robin serves the queues window by window: a
window of `window` tokens takes from each queue its share, documents are cut where a quota ends, and the fraction of
a token that a queue is owed is carried to the next window. A queue that runs out leaves its place to the others, in
their given proportion. Because documents may be cut anywhere, the carried deficits have a closed form: at time v,
queue s with n tokens and weight t has sent min(n, t * v) tokens, and all queues together W(v), a broken line that bends
where a queue runs out. With the queues in the order in which they run out, prefix sums of n and t give the tokens that
the first s queues sent among the first x of all, P(x, s), from one search for the bend before x. The first k windows
hold floor P(k * window, s + 1) - floor P(k * window, s) tokens of queue s, so each window is full and each quota within
two tokens of its target. The place of every token follows from its index within its queue alone: no partition waits for
another, and a hot source is spread over all tasks.

Sources whose share of a window is below two tokens are served one after the other from one common queue: there are
never more than about half as many queues as tokens in a window, which bounds what the driver and the tasks hold.
Sources without a target follow when all others have run out, in the proportion of their sizes.

Cases: a null text is an empty document (only the end id); null and empty sources are one queue; repeated rows are
packed each for itself; an empty table gives no rows; other columns are ignored. Only the last sequence can be short.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyworks.llm.digests import ids_crc32
from tallyworks.llm.staging import staged
from tallyworks.llm.tokens import encoder

NO_SOURCE = ""  # queue of rows without a source
EQUAL = "equal"  # targets: the same share for every source
_UNITS = 10**9  # integer weights of given targets add up to about this
IDS_SCHEMA = "part int, source string, at long, doc_id long, n_tokens long, ids binary"
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                "offset long, source string, window long")


@dataclass
class Tier:
    """Queues that are served together, in lanes; tokens `first` .. `first + size` of the whole output."""

    first: int
    size: int
    tokens: list[int]       # of the first lanes in the order in which they run out, from 0
    weights: list[int]      # likewise
    emptied: list[int]      # tokens of the tier sent when a lane has run out, rounded up
    ends: list[float]       # the time at which it has, only to guess a window
    lane_of: dict[str, int]
    skip: dict[str, int]    # tokens of the lane before the queue's

    def before(self, x: int, lane: int) -> int:
        """Tokens of the first `lane` lanes among the first `x` of the tier, rounded down."""
        out = bisect_right(self.emptied, x)
        if lane <= out:
            return self.tokens[lane]
        gone = self.weights[out]
        return self.tokens[out] + (self.weights[lane] - gone) * (x - self.tokens[out]) // (self.weights[-1] - gone)

    def sent_by(self, lane: int, index: int) -> int:
        """About how many tokens of the tier go before token `index` of a lane."""
        time = index / (self.weights[lane + 1] - self.weights[lane])
        out = min(bisect_right(self.ends, time), lane)
        return int(self.tokens[out] + (self.weights[-1] - self.weights[out]) * time)


def _lanes(weights: Mapping[str, int], window: int) -> list[list[str]]:
    """Queues in ascending order of weight, joined until each lane has at least a token in a window."""
    total, lanes, held = sum(weights.values()), [], []
    for name in sorted(weights, key=lambda s: (weights[s], s)):
        held.append(name)
        if sum(weights[s] for s in held) * window >= total:
            lanes.append(held)
            held = []
    if held:
        lanes = [*lanes[:-1], [*(lanes[-1] if lanes else []), *held]]
    return lanes


def _tier(first: int, window: int, totals: Mapping[str, int], weights: Mapping[str, int]) -> Tier:
    lanes = [(sum(totals[s] for s in lane), sum(weights[s] for s in lane), lane) for lane in _lanes(weights, window)]
    lanes.sort(key=lambda one: (Fraction(one[0], one[1]), one[2]))
    whole = sum(weights.values())
    tier = Tier(first, sum(totals[s] for s in weights), [0], [0], [], [], {}, {})
    for k, (tokens, weight, lane) in enumerate(lanes):
        at = 0
        for name in lane:
            tier.lane_of[name], tier.skip[name] = k, at
            at += totals[name]
        tier.tokens.append(tier.tokens[-1] + tokens)
        tier.weights.append(tier.weights[-1] + weight)
        tier.emptied.append(tier.tokens[-1] - (-(whole - tier.weights[-1]) * tokens // weight))
        tier.ends.append(tokens / weight)
    return tier


def schedule(totals: Mapping[str, int], window: int, targets: Mapping[str, float] | None = None) -> list[Tier]:
    """The queues with a target, then those without one. Without any targets the corpus itself is the mixture."""
    left = {s: n for s, n in totals.items() if n > 0}
    wanted = left if targets is None else {s: targets[s] for s in left if targets.get(s, 0) > 0}
    whole, tiers, first = sum(wanted.values()), [], 0
    units = wanted if targets is None else {s: max(1, round(t / whole * _UNITS)) for s, t in wanted.items()}
    for weights in (units, {s: n for s, n in left.items() if s not in units}):
        if weights:
            tiers.append(_tier(first, window, left, weights))
            first += tiers[-1].size
    return tiers


class Places:
    """Where the tokens of one queue go."""

    def __init__(self, tiers: list[Tier], queue: str, window: int):
        self.window = window
        self.tier = next(t for t in tiers if queue in t.lane_of)
        self.lane, self.skip = self.tier.lane_of[queue], self.tier.skip[queue]

    def _edges(self, k: int) -> tuple[int, int]:
        """Tokens of the lanes before this one, and of this one, in the first `k` windows."""
        x = min(max(k * self.window - self.tier.first, 0), self.tier.size)
        low = self.tier.before(x, self.lane)
        return low, self.tier.before(x, self.lane + 1) - low

    def runs(self, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(window, place within the window, tokens) for tokens start .. start + length of the queue."""
        index = start + self.skip
        k = (self.tier.first + self.tier.sent_by(self.lane, index)) // self.window
        while self._edges(k)[1] > index:
            k -= 1
        others, own = self._edges(k)
        while length:
            next_others, next_own = self._edges(k + 1)
            n = min(length, next_own - index)
            if n > 0:
                yield k, max(self.tier.first - k * self.window, 0) + next_others - others + index - own, n
                index, length = index + n, length - n
            k, others, own = k + 1, next_others, next_own


def token_rows(docs: DataFrame, tokenizer: str, keep_white: bool, end_id: int) -> DataFrame:
    """(part, source, at, doc_id, n_tokens, ids): `at` counts the source's ids before it in its partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = encoder(tokenizer, keep_white), TaskContext.get().partitionId()
        narrow = max(known.tokenizer.get_vocab_size(), end_id) < 1 << 16
        end, seen = np.array([end_id], np.uint32), {}
        for batch in batches:
            names, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            held, size = [], 0
            for doc_id, source, ids in zip(names, sources, known.texts(batch.column(2))):
                ids = np.concatenate([ids, end])
                at = seen.get(source, 0)
                seen[source] = at + len(ids)
                held.append((part, source, at, doc_id, len(ids),
                             ids.astype("<u2" if narrow else "<u4").tobytes()))
                size += len(ids)
                if size > 1 << 20:
                    yield _ids_batch(held)
                    held, size = [], 0
            if held:
                yield _ids_batch(held)

    rows = docs.select(F.col("doc_id").cast("long"),
                       F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE)).alias("source"),
                       F.col("text").cast("string"))
    return rows.mapInArrow(encode, IDS_SCHEMA)


def _ids_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ("part", "source", "at", "doc_id", "n_tokens", "ids")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))


def _queues(totals: DataFrame, window: int, targets: Mapping[str, float] | str | None) -> DataFrame:
    """(source, queue, aimed, tokens, weight) of the sources: their queue, and whether they have a target."""
    if targets is None:
        weighed = totals.withColumn("weight", F.col("tokens")).withColumn("aimed", F.lit(True))
    elif targets == EQUAL:
        weighed = totals.withColumn("weight", F.lit(1).cast("long")).withColumn("aimed", F.lit(True))
    else:
        whole = sum(t for t in targets.values() if t > 0)
        given = [(s, max(1, round(t / whole * _UNITS))) for s, t in targets.items() if t > 0]
        shares = totals.sparkSession.createDataFrame(given, "source string, share long")
        weighed = totals.join(shares, "source", "left").select(
            "source", "tokens", F.coalesce("share", "tokens").alias("weight"), F.col("share").isNotNull().alias("aimed"))
    sums = weighed.groupBy("aimed").agg(F.sum("weight").alias("whole"))
    alone = F.col("weight") >= F.col("whole") * 2.0 / window
    name = F.when(alone, F.concat(F.lit("="), "source")).otherwise("*")
    return weighed.join(sums, "aimed").select(
        "source", F.concat(F.col("aimed").cast("string"), name).alias("queue"), "aimed", "tokens", "weight")


def pack(docs: DataFrame, tokenizer: str, keep_white: bool, end_id: int, sequence: int = 1024,
         sequences_per_window: int = 64, targets: Mapping[str, float] | str | None = None) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and the source and window they count towards.

    `targets` are shares per source, EQUAL, or None for those of the corpus. Ids are encoded once and written narrow;
    the table of (partition, source) sums gives every document its index within its queue.
    """
    window = sequence * sequences_per_window
    rows = staged(token_rows(docs, tokenizer, keep_white, end_id), "ids")
    sums = staged(rows.groupBy("part", "source").agg(F.sum("n_tokens").alias("tokens")), "sums")
    queues = staged(_queues(sums.groupBy("source").agg(F.sum("tokens").alias("tokens")), window, targets), "queues")
    held = queues.groupBy("queue", "aimed").agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).collect()
    tiers = schedule({r["queue"]: r["tokens"] for r in held}, window,
                     None if targets is None else {r["queue"]: r["weight"] for r in held if r["aimed"]})

    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    per_part = sums.join(queues.select("source", "queue"), "source")
    inside = F.coalesce(F.sum("tokens").over(earlier.partitionBy("part", "queue").orderBy("source")), F.lit(0))
    ahead = F.coalesce(F.sum("tokens").over(earlier.partitionBy("queue").orderBy("part")), F.lit(0))
    ahead_of_part = per_part.groupBy("part", "queue").agg(F.sum("tokens").alias("tokens")).select(
        "part", "queue", ahead.alias("ahead"))
    # Written first, so that Spark knows its size and chooses the join with the documents by it.
    bases = staged(per_part.withColumn("inside", inside).join(ahead_of_part, ["part", "queue"]).select(
        "part", "source", "queue", (F.col("ahead") + F.col("inside")).alias("base")), "bases")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, Places] = {}
        for batch in batches:
            out: list[tuple] = []
            doc_ids, sources, queue_names, ats, tokens = (batch.column(k).to_pylist() for k in range(5))
            for doc_id, source, queue, at, n, raw in zip(doc_ids, sources, queue_names, ats, tokens, batch.column(5)):
                ids = np.frombuffer(raw.as_buffer(), "<u2" if len(raw.as_buffer()) == 2 * n else "<u4")
                if queue not in places:
                    places[queue] = Places(tiers, queue, window)
                start = 0
                for k, where, length in places[queue].runs(at, n):
                    while length:
                        take = min(length, sequence - where % sequence)
                        out.append((doc_id, start, take, ids_crc32(ids[start:start + take]), n,
                                    k * sequences_per_window + where // sequence, where % sequence, source, k))
                        start, where, length = start + take, where + take, length - take
            if out:
                kinds = [pa.int64()] * 7 + [pa.string(), pa.int64()]
                names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    placed = rows.join(bases, ["part", "source"]).select(
        "doc_id", "source", "queue", (F.col("base") + F.col("at")).alias("at"), "n_tokens", "ids")
    return placed.mapInArrow(place, PIECE_SCHEMA)
