"""N-gram Jaccard join by chosen paths.

Texts are sets of word 5-grams. Equal texts are one set with a number of copies. Every set is embedded by 64 minimum
hashes, so that the share of equal tokens estimates the Jaccard similarity. The join splits recursively:
within a bucket each token is chosen with probability 1 / (0.7 * 64) by a hash of the bucket's path, and every set
goes to the bucket of each chosen token it holds. Sets whose embedding agrees in 0.7 (two standard deviations below the
threshold) share a chosen token once on average, unlike sets hardly ever, so buckets fall apart at once; what stays larger than `BUCKET` is split again, at most
`DEPTH` times. One run finds a pair with a known probability; runs are repeated until that of missing it is below
1 - TARGET_RECALL.

Small buckets are compared by brute force on the embedded tokens, generously; buckets that stay large at the
last level (many near copies of one text) are taken whole. That gives candidate groups, whose texts are then compared
exactly, shingle by shingle, each with every other one that can be linked to it. A group of at most `BLOCK` texts is one
comparison. A larger one is dealt into blocks: by size first, in bands so wide that linked sets lie in one band or in two
neighbouring ones, then by a hash of the text; each block is compared within itself and with the blocks of its band and of
the next. So every pair of a group meets in exactly one comparison or is too unequal in size, and no task holds a group.
The work is that of all pairs: a text of a group of m texts of like size is brought m / BLOCK times.

A class is a set of texts joined by exact links; n_links counts all links of a text to other texts of its candidate group.

Cases: a null text is empty; empty texts have no shingle and are linked to nothing but equal ones; texts of 1 to 4 words
are one shingle of all their words; equal texts share a class and count as copies, not links; repeated rows
are copies; a null doc_id is never the smallest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.llm.components import components
from tallyworks.llm.staging import staged
from tallyworks.llm.textgrid import grams, mix, text_blocks, words

SHINGLE = 5
SIMILARITY = 0.8
TOKENS = 64
FOUND_FROM = 0.7  # share of equal tokens from which the target recall holds
TARGET_RECALL = 0.99
BUCKET = 96
DEPTH = 4
BLOCK = 1024  # texts of a block, on average
BLOCK_SHINGLES = 1 << 20  # and their shingles
BAND = 1.26  # a band's largest size to its least; above 1 / SIMILARITY, so links reach no further than the next band
GRID = 1 << 22  # cells of the table of texts and shared shingles that a comparison holds at a time
SLACK = 3.5  # standard deviations that an estimate may lie below the similarity

_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def runs_needed(recall: float = TARGET_RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair that agrees in FOUND_FROM of its tokens is missed with less than 1 - recall.

    Shared chosen tokens are Poisson with mean 1, so paths survive like a critical branching process.
    """
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(lost - 1)
    return math.ceil(math.log(1 - recall) / math.log(lost))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of all texts, first shingle of each text and the end); repeated shingles repeat."""
    _, _, hashes, first = words(data, offsets)
    gram, at = grams(hashes, first, SHINGLE)
    begin = np.searchsorted(at, first)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = counts[short] > k
            whole[has] = whole[has] * _SPREAD + hashes[first[short[has]] + k]
        gram = np.insert(gram, begin[short], mix(whole + np.uint64(1)))
        extra = np.zeros(len(counts) + 1, np.int64)
        extra[short + 1] = 1
        begin = begin + np.cumsum(extra)
    return gram, begin


def _signatures(gram: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """TOKENS minimum hashes of each non-empty set, 32 bits of each, so that unlike sets hardly ever share one."""
    some = np.flatnonzero(np.diff(begin) > 0)
    out = np.zeros((len(begin) - 1, TOKENS), np.uint32)
    if len(some):
        starts = begin[some]
        for k in range(TOKENS):
            least = np.minimum.reduceat(gram * _FACTORS[k], starts)
            out[some, k] = (mix(least) >> np.uint64(32)).astype(np.uint32)
    return out


def _embedded(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, tokens) of every row: n shingles with repetitions, the embedded tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(2)):
                gram, begin = shingle_sets(data, offsets)
                raw = _signatures(gram, begin)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(np.diff(begin).astype(np.int64)),
                     pa.array([row.tobytes() for row in raw], pa.binary())], ["doc_id", "key", "n", "tokens"])

    return docs.mapInArrow(run, "doc_id long, key string, n long, tokens binary")


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


def _chosen(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of every token that its bucket chooses."""
    share = np.uint64(int((1 << 64) / (FOUND_FROM * TOKENS)))
    rows, children = [], []
    for k in range(TOKENS):
        child = mix((paths + _PLACES[k]) ^ mix(tokens[:, k].astype(np.uint64) * _SPREAD + np.uint64(k)))
        # The path's own choice: one number for the token, the same for every set of the bucket.
        at = np.flatnonzero(mix(child ^ _SPREAD) < share)
        rows.append(at)
        children.append(child[at])
    return np.concatenate(rows), np.concatenate(children)


def _first_paths(texts: DataFrame, runs: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _tokens(batch.column(1))
            for r in range(runs):
                root = np.full(len(tokens), mix(np.array([r + 1], np.uint64))[0], np.uint64)
                rows, paths = _chosen(root, tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths.view(np.int64)), batch.column(0).take(pa.array(rows))], ["path", "key"])

    return texts.select("key", "tokens").mapInArrow(run, "path long, key string")


def _deeper_paths(rows: DataFrame) -> DataFrame:
    """(level, parent, path, key) of all levels below the first, for rows (path, key, tokens) of the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, owner = batch.column(0).to_numpy().view(np.uint64), np.arange(batch.num_rows)
            tokens = _tokens(batch.column(2))
            for level in range(2, DEPTH + 1):
                at, children = _chosen(paths, tokens[owner])
                parents, paths, owner = paths[at], children, owner[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), level, np.int32)), pa.array(parents.view(np.int64)),
                     pa.array(paths.view(np.int64)), batch.column(1).take(pa.array(owner))],
                    ["level", "parent", "path", "key"])

    return rows.select("path", "key", "tokens").mapInArrow(run, "level int, parent long, path long, key string")


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first member of each one's component, for a symmetric matrix of links."""
    n = len(linked)
    if n == 2:
        return np.array([0, 0 if linked[0, 1] else 1])
    root = np.arange(n)
    reach = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(reach, root[None, :], n).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of equal values of the first `keys` columns, of rows that come sorted by them."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for c in batch.columns[:keys]:
            values = np.array(c.to_pylist(), dtype=object)
            change[1:] |= values[1:] != values[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            name = tuple(c[a].as_py() for c in batch.columns[:keys])
            if name != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = name
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _near(rows: DataFrame) -> DataFrame:
    """(key, root): within each small bucket, every text of a component of likely links and the component's first one."""
    least = SIMILARITY - SLACK * math.sqrt(SIMILARITY * (1 - SIMILARITY) / TOKENS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _grouped(batches, 1):
            keys = bucket.column(1).combine_chunks()
            tokens = _tokens(bucket.column(2))
            likely = (tokens[:, None, :] == tokens[None, :, :]).sum(axis=2) >= least * TOKENS
            np.fill_diagonal(likely, False)
            at = np.flatnonzero(likely.any(axis=1))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at)), keys.take(pa.array(_roots(likely)[at]))], ["key", "root"])

    return (rows.select("path", "key", "tokens").repartition("path").sortWithinPartitions("path", "key")
            .mapInArrow(run, "key string, root string"))


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """The rows of buckets of several, with their size. Buckets grow with the corpus, so none are broadcast."""
    sizes = rows.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
    return staged(rows.join(sizes.hint("merge"), "path"), name)


def _candidates(texts: DataFrame, runs: int) -> DataFrame:
    """(key, root): texts with the same root may be linked; a text has a row for each bucket that holds a likely partner."""
    tokens = texts.select("key", "tokens")
    rows = _shared(staged(_first_paths(texts.where("n > 0"), runs), "paths"), "shared-paths")
    small, large = rows.where(F.col("size") <= BUCKET).select("path", "key"), rows.where(F.col("size") > BUCKET)
    if large.isEmpty():
        return _near(small.join(tokens, "key"))
    rows = _shared(staged(_deeper_paths(large.join(tokens, "key")), "deeper-paths"), "deeper-shared-paths")
    # A bucket is part of its parent; where that was small, it is compared there.
    split = rows.where(F.col("size") > BUCKET).select(F.col("path").alias("parent")).distinct()
    small = small.unionByName(rows.where("level = 2").unionByName(rows.where("level > 2").join(split, "parent", "left_semi"))
                              .where(F.col("size") <= BUCKET).select("path", "key"))
    # Sets that stay together to the last level are alike; the exact comparison takes them as one group, named by the path.
    last = rows.where((F.col("size") > BUCKET) & (F.col("level") == DEPTH))
    return _near(small.join(tokens, "key")).unionByName(last.select("key", F.hex("path").alias("root")))


def _intersections(sets: list[np.ndarray], left: int) -> np.ndarray:
    """Sizes of the intersections of all sets, or with left > 0 of the first `left` with the others."""
    n = len(sets)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = np.flatnonzero(counts > 1)
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    column = place[inverse]
    keep = column >= 0
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((left or n, n - left), np.float32)
    width = max(1, GRID // n)
    for low in range(0, len(shared), width):
        a, b = np.searchsorted(column, (low, low + width))
        grid = np.zeros((n, min(width, len(shared) - low)), np.float32)
        grid[owner[a:b], column[a:b] - low] = 1
        out += grid[:left or n] @ grid[left:].T
    return out


def _similarities(sets: list[np.ndarray], left: int = 0) -> np.ndarray:
    """Jaccard similarities of all sets, or with left > 0 of the first `left` with the others."""
    both = _intersections(sets, left).astype(np.float64)
    size = np.array([len(s) for s in sets], np.float64)
    return both / np.maximum(size[:left or len(sets), None] + size[None, left:] - both, 1)


def _shingled(texts: DataFrame) -> DataFrame:
    """(group, key, size, shingles) of rows (group, key, text): the distinct shingles and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(2)):
                gram, begin = shingle_sets(data, offsets)
                sets = [np.unique(gram[x:y]) for x, y in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([x.tobytes() for x in sets], pa.binary())], ["group", "key", "size", "shingles"])

    return texts.select("group", "key", "text").mapInArrow(run, "group string, key string, size long, shingles binary")


def _dealt(sets: DataFrame) -> DataFrame:
    """`sets` with its group's blocks: rows (group, whole, low, high, block, key, shingles), one for each comparison of a text.

    A comparison is of block low with block high, or of one block within itself; whole marks groups of one block.
    """
    sets = sets.withColumn("band", F.floor(F.log("size") / math.log(BAND)))
    group, order = Window.partitionBy("group"), Window.partitionBy("group").orderBy("band")
    bands = (sets.groupBy("group", "band").agg(F.count("*").alias("n"), F.sum("size").alias("volume"))
             .withColumn("whole", (F.sum("n").over(group) <= BLOCK) & (F.sum("volume").over(group) <= BLOCK_SHINGLES))
             .withColumn("slots", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("volume") / BLOCK_SHINGLES)))
             .withColumn("start", F.sum("slots").over(order) - F.col("slots"))
             .withColumn("end", F.col("start") + F.col("slots") - 1))
    bands = bands.select(
        "group", "band", "whole", "slots", "start",
        F.when(F.lag("band").over(order) == F.col("band") - 1, F.lag("start").over(order)).otherwise(F.col("start")).alias("from"),
        F.when(F.lead("band").over(order) == F.col("band") + 1, F.lead("end").over(order)).otherwise(F.col("end")).alias("to"))
    block = F.when(F.col("whole"), F.lit(0)).otherwise(F.col("start") + F.pmod(F.xxhash64("key"), F.col("slots")))
    others = F.when(F.col("whole"), F.array(F.lit(0).cast("long"))).otherwise(F.sequence("from", "to"))
    return (sets.join(bands, ["group", "band"])
            .select("group", "whole", block.alias("block"), "key", "shingles", F.explode(others).alias("other"))
            .select("group", "whole", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "block", "key", "shingles"))


def _compared(work: DataFrame) -> DataFrame:
    """What the comparisons of `_dealt` find of each text that has a link: their number, the nearest text and the root.

    The root is the first text of the component within the comparison.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _grouped(batches, 3):
            low, high, whole = (part.column(k)[0].as_py() for k in (1, 2, 4))
            outside = part.column(3).to_numpy() != low
            names = np.array(part.column(5).to_pylist(), dtype=object)
            order = np.lexsort((names, outside))
            names, left = names[order], int((~outside).sum()) if low != high else 0
            if low != high and left in (0, len(names)):
                continue
            sets = [np.frombuffer(x, np.uint64) for x in part.column(6).take(pa.array(order)).to_pylist()]
            like = _similarities(sets, left)
            if not left:
                np.fill_diagonal(like, 0)
            linked = like >= SIMILARITY
            every = linked
            if left:
                every = np.zeros((len(names), len(names)), bool)
                every[:left, left:] = linked
                every |= every.T
            links = every.sum(axis=1)
            at = np.flatnonzero(links)
            if not len(at):
                continue
            best, value = like.argmax(axis=1), like.max(axis=1)
            if left:
                best, value = np.append(best + left, like.argmax(axis=0)), np.append(value, like.max(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[at]), pa.array(names[_roots(every)[at]]), pa.array(links[at].astype(np.int64)),
                 pa.array(names[best[at]]), pa.array(value[at]), pa.array(np.full(len(at), whole))],
                ["key", "root", "links", "partner", "similarity", "whole"])

    work = work.select("group", "low", "high", "block", "whole", "key", "shingles")
    return (work.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")
            .mapInArrow(run, "key string, root string, links long, partner string, similarity double, whole boolean"))


def _contracted(found: DataFrame) -> DataFrame:
    """(node, root) of every key of (key, root): keys that share a root, directly or through other keys, get the same one.

    Only roots that met in a key go through the rounds of `components`.
    """
    least = staged(found.groupBy("key").agg(F.min("root").alias("least"), F.collect_set("root").alias("roots")), "least-roots")
    met = least.where(F.size("roots") > 1).select(F.explode("roots").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    if met.isEmpty():
        return least.select(F.col("key").alias("node"), F.col("least").alias("root"))
    roots = components(met).select(F.col("node").alias("least"), "root")
    return least.join(roots, "least", "left").select(F.col("key").alias("node"), F.coalesce("root", "least").alias("root"))


def _large_groups(bring: DataFrame, _tokens: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(what each comparison found of a text, (node, root) of the classes) of groups (group, key, text) of any size."""
    found = staged(_compared(_dealt(staged(_shingled(bring), "member-sets"))), "links-found")
    classes, parts = found.where("whole").select(F.col("key").alias("node"), "root"), found.where("not whole")
    return found, classes if parts.isEmpty() else classes.unionByName(_contracted(parts))


def similarity_join(docs: DataFrame, recall: float = TARGET_RECALL) -> DataFrame:
    """(doc_id, class_id, n_copies, n_links, linked_id, similarity) of every row of `docs` (doc_id, text).

    A class is a component of links; class_id is its smallest doc_id. n_copies counts the rows with the same text, the row itself
    included; n_links the links to other texts of its candidate group; linked_id is the smallest doc_id of the nearest one,
    similarity the exact one of the two (both null in classes of one text).
    """
    return _classes(docs, recall).select("doc_id", "class_id", "n_copies", "n_links", "linked_id", "similarity")


def _text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _classes(docs: DataFrame, recall: float = TARGET_RECALL) -> DataFrame:
    """The join's result with the key of each row's text and of its class's first text (root)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", _text_key(F.col("text")).alias("key"), "text")
    embedded = staged(_embedded(rows), "embedded")
    texts = staged(embedded.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"), F.first("n").alias("n"),
        F.first("tokens").alias("tokens")), "texts")

    no_id = F.lit(-1).cast("long")  # stands for a null; the text's key decides
    groups = _contracted(_candidates(texts, runs_needed(recall))).select(F.col("node").alias("key"), F.col("root").alias("group"))
    member = groups.join(texts.select("key", F.coalesce("first_id", no_id).alias("first_id")), "key")
    # Of equal texts the row with the smallest id brings the text. Members grow with the corpus, so none are broadcast.
    brought = rows.withColumn("first_id", F.coalesce("doc_id", no_id)).join(member.hint("merge"), ["first_id", "key"])
    found, classes = _large_groups(brought.dropDuplicates(["first_id", "key"]).select("group", "key", "text"))
    rooted = classes.withColumnRenamed("node", "key")
    near = found.groupBy("key").agg(F.sum("links").alias("n_links"),
                                    F.max(F.struct("similarity", "partner")).alias("nearest"))

    linked = texts.join(rooted, "key", "left").join(near, "key", "left").select(
        "key", F.coalesce("root", "key").alias("root"), "first_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("nearest.similarity").alias("similarity"), F.col("nearest.partner").alias("partner"))
    linked = staged(linked, "rooted")
    named = linked.groupBy("root").agg(F.min("first_id").alias("class_id"))
    partners = linked.select(F.col("key").alias("partner"), F.col("first_id").alias("linked_id"))
    verdict = linked.join(named, "root").join(partners, "partner", "left").select(
        "key", "root", "class_id", "n_copies", "n_links", "linked_id", "similarity")
    return embedded.select("doc_id", "key").join(verdict, "key")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """`docs` with one row of every class, that with the smallest doc_id (null last); the columns they came with."""
    rows = staged(_classes(docs).groupBy("root", "doc_id", "key").agg(F.count("*").alias("rows")), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "key", "rows")).alias("first")
    stay = rows.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("staying_id"), F.col("first.key").alias("staying_key"), F.col("first.rows").alias("copies"))
    kept = docs.join(stay, docs["doc_id"].cast("long").eqNullSafe(stay["staying_id"])
                     & (_text_key(docs["text"]) == stay["staying_key"]))
    columns = [docs[c] for c in docs.columns]
    # Rows that agree in id and text are one document.
    return kept.where(stay["copies"] == 1).select(*columns).unionByName(
        kept.where(stay["copies"] > 1).select(*columns).dropDuplicates(["doc_id", "text"]))
