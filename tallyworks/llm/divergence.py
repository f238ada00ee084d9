"""Source divergence audit: how far the sources of a language differ in their terms, and by which terms.

Late string materialization. Tasks cut whole texts into terms over Arrow buffers and count them per block of texts; only
64-bit digests of the terms are shuffled, with their counts. A second, narrow aggregation takes the least and the greatest
term of each digest: where they differ, terms collide, and the counts of such digests are taken again by the terms
themselves. Strings come back by a join with the few terms of the result.

All numbers are integers: a share is floor(10^9 * (count + 2) / (N + 2 V)) + 1 by long division in three steps, exact for
counts below 9 * 10^15.

The divergence of two sources sums over all V kept terms. A kept term is one row with the shares of all sources of
its language; tasks sum matrices of at most `TILE` by `TILE` sources, so memory is bounded whatever the numbers of
terms and sources, and one row per pair of sources and task is shuffled.

Cases: null text, lang and source are ''; groups without any term take part; a language without kept terms has the
divergence 0 between its sources and no term rows; equal rows count as documents of their own; ties of values are ordered by
the UTF-8 bytes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.llm.staging import staged
from tallyworks.llm.textgrid import span_hashes, spans, text_blocks

MIN_DOCS = 10
TOP_TERMS = 10
SCALE_STEPS = 3  # steps of a factor of 1000: shares are in units of 10^-9
BLOCK_BYTES = 8 << 20  # terms are counted over blocks of whole texts of this size
TILE = 256

_TERM = np.zeros(256, bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each term occurrence, the distinct terms, text of each occurrence)."""
    inside = _TERM[data]
    starts, ends = spans(inside, offsets)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(np.searchsorted(starts, offsets)))
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    cut = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(_LOWER[data[inside]]))
    coded = cut.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, text


def term_digests(terms: pa.Array, bits: int) -> np.ndarray:
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset:terms.offset + len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)[:offsets[-1] if len(terms) else 0]
    return (span_hashes(data, offsets[:-1], offsets[1:]) >> np.uint64(64 - bits)).view(np.int64)


def _typed(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _counts(rows: DataFrame, bits: int, spelled: bool) -> DataFrame:
    """(lang, source, digest, n, docs) per block of texts; with `spelled` also the term, one row per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source = (c.dictionary_encode() for c in batch.columns[:2])
            pair = lang.indices.to_numpy().astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy()
            for a, b, data, offsets in text_blocks(batch.column(2), BLOCK_BYTES):
                code, terms, text = _terms(data, offsets)
                if not len(code):
                    continue
                # Once per text and term, then once per group and term.
                once, n = np.unique(text.astype(np.int64) * len(terms) + code, return_counts=True)
                key = pair[a:b][once // len(terms)] * len(terms) + once % len(terms)
                both, at = np.unique(key, return_inverse=True)
                group, term = both // len(terms), both % len(terms)
                total = np.bincount(at, n, len(both)).astype(np.int64)
                width = max(len(source.dictionary), 1)
                columns = [lang.dictionary.take(pa.array(group // width)), source.dictionary.take(pa.array(group % width)),
                           pa.array(term_digests(terms, bits)[term]), pa.array(total),
                           pa.array(np.bincount(at, minlength=len(both)).astype(np.int64))]
                names = ["lang", "source", "digest", "n", "docs"]
                if spelled:
                    columns.append(terms.take(pa.array(term)).cast(pa.string()))
                    names.append("term")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "lang string, source string, digest long, n long, docs long" + (", term string" if spelled else "")
    return rows.select("lang", "source", "text").mapInArrow(run, schema)


def _spellings(rows: DataFrame, bits: int) -> DataFrame:
    """(digest, term): the distinct terms of each block of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0), BLOCK_BYTES):
                _, terms, _ = _terms(data, offsets)
                if len(terms):
                    yield pa.RecordBatch.from_arrays([pa.array(term_digests(terms, bits)), terms.cast(pa.string())],
                                                     ["digest", "term"])

    return rows.select("text").mapInArrow(run, "digest long, term string")


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * (count + 2) / total) without leaving 64 bits."""
    rest, out = count + 2, F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        out, rest = out * 1000 + F.call_function("div", rest, total), rest % total
    return out + 1


def _shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    rest, out = count + 2, np.zeros(len(count), np.int64)
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def term_counts(rows: DataFrame, spelled: DataFrame, bits: int) -> DataFrame:
    """(lang, source, digest, term, n, docs): the term is null but for digests that stand for several terms."""
    keys = ["lang", "source", "digest"]
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    clash = staged(spelled.where("low <> high").select("digest"), "clashing-digests")
    counts = _counts(rows, bits, spelled=False)
    if clash.isEmpty():
        return counts.groupBy(keys).agg(*sums).withColumn("term", F.lit(None).cast("string"))
    plain = counts.join(clash, "digest", "left_anti").groupBy(keys).agg(*sums).withColumn("term", F.lit(None).cast("string"))
    exact = _counts(rows, bits, spelled=True).join(clash, "digest", "left_semi").groupBy(*keys, "term").agg(*sums)
    return plain.unionByName(exact)


def _tile_sums(work: DataFrame) -> DataFrame:
    """(lang, low, high, place, value): sums over terms, place = row * width + column of a tile of sources.

    Rows are (lang, low, high, low_totals, high_totals, low_at, low_n, high_at, high_n); low and high number the tiles.
    """

    def dense(totals: np.ndarray, at: pa.ListArray, n: pa.ListArray) -> np.ndarray:
        out = np.tile(_shares(np.zeros(len(totals), np.int64), totals), (len(at), 1))
        row = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))
        place, count = at.flatten().to_numpy(), n.flatten().to_numpy()
        out[row, place] = _shares(count, totals[place])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, low, high), tile in sums.items():
                size = tile.size
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array(np.full(size, low)), pa.array(np.full(size, high)),
                     pa.array(np.arange(size)), pa.array(tile.ravel())], ["lang", "low", "high", "place", "value"])
            sums.clear()

        for batch in batches:
            code = batch.column(0).dictionary_encode()
            order = np.lexsort((batch.column(2).to_numpy(), batch.column(1).to_numpy(), code.indices.to_numpy()))
            table = pa.Table.from_batches([batch]).take(pa.array(order)).combine_chunks()
            names = list(zip(*(table.column(k).to_pylist() for k in range(3))))
            edges = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                part = table.slice(a, b - a).combine_chunks()
                left_totals, right_totals = (np.array(part.column(k)[0].as_py(), np.int64) for k in (3, 4))
                columns = [part.column(k).chunk(0) for k in range(5, 9)]
                left = dense(left_totals, columns[0], columns[1])
                right = left if names[a][1] == names[a][2] else dense(right_totals, columns[2], columns[3])
                tile = sums.setdefault(names[a], np.zeros((left.shape[1], right.shape[1]), np.int64))
                step = max(1, (1 << 21) // tile.size)
                for first in range(0, b - a, step):
                    p, q = left[first:first + step, :, None], right[first:first + step, None, :]
                    tile += ((p - q) ** 2 // (p + q)).sum(axis=0)
                if len(sums) > 32:
                    yield from flush()
        yield from flush()

    return work.mapInArrow(run, "lang string, low long, high long, place long, value long")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, bits: int = 64, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence from each other source of the language, and the leading terms.

    `bits` is the width of the digests; fewer are of use in tests only, where terms are to collide.
    """
    rows = _typed(docs)
    spelled = staged(_spellings(rows, bits).groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")),
                     "spellings")
    counts = term_counts(rows, spelled, bits)

    named = rows.groupBy("lang", "source").agg(F.lit(1)).select("lang", "source")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = staged(named.withColumn("at", place.cast("long")), "groups")
    term = ["lang", "digest", "term"]
    kept = staged(
        counts.join(groups, ["lang", "source"]).groupBy(term)
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("at", "n")).alias("by_source"))
        .where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")

    # N + 2 V of every group and of every language; 0 where the language keeps no term.
    langs = staged(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("n"))
                   .select("lang", "terms", (F.col("n") + 2 * F.col("terms")).alias("lang_total")), "languages")
    own = (kept.select("lang", F.explode("by_source").alias("s")).groupBy("lang", F.col("s.at").alias("at"))
           .agg(F.sum("s.n").alias("n")))
    zero = F.lit(0).cast("long")
    groups = staged(groups.join(langs, "lang", "left").join(own, ["lang", "at"], "left")
                    .select("lang", "source", "at", (F.coalesce("n", zero) + 2 * F.coalesce("terms", zero)).alias("total")),
                    "group-totals")
    return _pairs(groups, kept, tile).unionByName(_leading(groups, langs, kept, spelled, top))


def _pairs(groups: DataFrame, kept: DataFrame, tile: int) -> DataFrame:
    number = F.call_function("div", F.col("at"), F.lit(tile).cast("long"))
    tiles = (groups.where("total > 0").groupBy("lang", number.alias("tile"))
             .agg(F.sort_array(F.collect_list(F.struct("at", "total"))).alias("members"))
             .select("lang", "tile", F.col("members.total").alias("totals")))
    both = (tiles.select("lang", F.col("tile").alias("low"), F.col("totals").alias("low_totals"))
            .join(tiles.select("lang", F.col("tile").alias("high"), F.col("totals").alias("high_totals")), "lang")
            .where("low <= high"))

    def inside(name: str) -> list[Column]:
        first = F.col(name) * tile
        here = F.filter("by_source", lambda s: (s["at"] >= first) & (s["at"] < first + tile))
        return [F.transform(here, lambda s: s["at"] - first).alias(f"{name}_at"),
                F.transform(here, lambda s: s["n"]).alias(f"{name}_n")]

    work = kept.join(both, "lang").select("lang", "low", "high", "low_totals", "high_totals", *inside("low"), *inside("high"))
    width = F.least(F.lit(tile).cast("long"), F.col("sources") - F.col("high") * tile)
    size = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    sums = (_tile_sums(work).groupBy("lang", "low", "high", "place").agg(F.sum("value").alias("value")).join(size, "lang")
            .select("lang", "low", "high", "value", (F.col("low") * tile + F.call_function("div", F.col("place"), width))
                    .alias("at"), (F.col("high") * tile + F.col("place") % width).alias("other_at")))
    turned = sums.where("low < high").select("lang", F.col("other_at").alias("at"), F.col("at").alias("other_at"), "value")
    sums = sums.select("lang", "at", "other_at", "value").unionByName(turned)
    others = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("other_at"))
    pairs = (groups.join(others, "lang").where("at <> other_at").join(sums, ["lang", "at", "other_at"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce("value", F.lit(0).cast("long")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(order))


def _leading(groups: DataFrame, langs: DataFrame, kept: DataFrame, spelled: DataFrame, top: int) -> DataFrame:
    occurring = (kept.select("lang", "digest", "term", F.col("n").alias("lang_n"), F.explode("by_source").alias("s"))
                 .select("lang", "digest", "term", "lang_n", "s.at", "s.n")
                 .join(groups, ["lang", "at"]).join(langs, "lang"))
    p, q = share(F.col("n"), F.col("total")), share(F.col("lang_n"), F.col("lang_total"))
    scored = (occurring.select("lang", "source", "digest", "term", p.alias("p"), q.alias("q")).where("p > q")
              .select("lang", "source", "digest", "term", divergence(F.col("p"), F.col("q")).alias("value")))
    group = Window.partitionBy("lang", "source")
    # Terms tied at the last rank stay until their strings are known.
    candidates = scored.withColumn("rank", F.rank().over(group.orderBy(F.desc("value")))).where(F.col("rank") <= top)
    written = (candidates.drop("rank").join(spelled, "digest")
               .select("lang", "source", F.lit("term").alias("part"), F.coalesce("term", "low").alias("item"), "value"))
    return (written.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))
            .where(F.col("rank") <= top))
