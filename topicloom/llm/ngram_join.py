"""Jaccard join of documents on five-word shingles by chosen paths.

Texts with the same set of shingles are one class and take part once. Every class has a signature of ``WIDTH`` minimal
hashes. A run of the join is a tree: at each node every coordinate of the signature is chosen with probability
1 / (threshold * WIDTH), from a hash of the path, and the classes of the node go to the child of their value in each
chosen coordinate. Alike classes share a child once on average however deep the tree is, unlike ones drift apart fast.
Nodes of up to ``BUCKET`` classes are compared by brute force; larger ones are split again, down to ``DEPTH``, and what
is still large then is dense, and compared in blocks of classes against blocks, none left out. The runs are as many as the
target recall asks for at the deepest level.

A comparison of signatures links candidates; each bucket gives a spanning forest of its links, not its pairs. An exact
check follows: within each component of candidates the shingle sets are compared, again by blocks, and links at the
threshold or above are counted and joined to components: the classes of near duplicates.

A text of fewer than five words has one shingle of all its words. Null and texts without words are never linked. Each
row is a document of its own, in the order of the ids, null ids last. Very long texts
are shingled whole and may meet in one batch of a task; an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import GAP, fresh, id_or_last, row_keys, stored
from topicloom.llm.components import components

WORDS = 5
#: A character of a word.
WORD = GAP.replace("[", "[^")
THRESHOLD = 0.8
RECALL = 0.999
WIDTH = 64
BUCKET = 64
BLOCK = 256
DEPTH = 4
#: Signatures that agree less than this are not checked further: four deviations below the threshold.
SKETCH = 0.6
CHUNK = 128

_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _RANDOM.integers(0, 1 << 63, max(WIDTH, 16), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RADIX = 0x9E3779B97F4A7C15
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread function of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(radix: int, size: int) -> np.ndarray:
    steps = np.full(size, radix, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and the text it is in."""
    parts = [t.encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = np.frombuffer(b" " + b"".join(parts), np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:])
    # Prefix sums of a polynomial: a word is a difference, shifted back to its start.
    sums = np.cumsum(_BYTE[data] * _powers(_RADIX, len(data)))
    hashes = mix((sums[ends] - sums[starts - 1]) * _powers(_RADIX_INVERSE, len(data))[starts])
    first = 1 + np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return hashes, np.searchsorted(first, starts, "right") - 1


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All shingles, sorted and distinct in each text, and the bounds of the texts in them."""
    words, at = word_hashes(texts)
    shingles, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words) >= WORDS:
        n = len(words) - WORDS + 1
        whole = at[:n] == at[WORDS - 1 :]
        made = sum(words[i : i + n] * _ODD[i] for i in range(WORDS))
        shingles, of = mix(made[whole]), at[:n][whole]
    counts = np.bincount(at, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        extra = [sum(int(w) * int(_ODD[8 + i]) for i, w in enumerate(words[at == t])) & (1 << 64) - 1 for t in short]
        shingles, of = np.concatenate([shingles, mix(np.array(extra, np.uint64))]), np.concatenate([of, short])
    order = np.lexsort((shingles, of))
    shingles, of = shingles[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (of[1:] != of[:-1])
    return shingles[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def _chunks(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            yield part, [x or "" for x in part.column("text").to_pylist()]


def _bytes(rows: np.ndarray) -> pa.Array:
    """Equal rows of numbers as binary values."""
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _sketch(batches):
    for part, texts in _chunks(batches):
        shingles, bounds = shingle_sets(texts)
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        if not len(full):
            continue
        starts = bounds[:-1][full]
        least = np.stack([np.minimum.reduceat(shingles * _ODD[i], starts) >> np.uint64(32) for i in range(WIDTH)], 1)
        sums = [np.add.reduceat(mix(shingles + np.uint64(i)), starts).view(np.int64) for i in (1, 2)]
        keys = part.column("key").take(pa.array(full))
        yield pa.RecordBatch.from_arrays([keys, pa.array(sizes[full], pa.int64()), pa.array(sums[0]), pa.array(sums[1]), _bytes(least.astype(np.uint32))], ["key", "n", "s", "t", "sig"])


def _children(threshold: float, runs: int):
    """Paths of the next level: for rows with a path its children, else the first level of all runs."""
    bar = np.uint64(min((1 << 64) - 1, int((1 << 64) / (threshold * WIDTH))))
    own = np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)

    def split(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, WIDTH).astype(np.uint64)
            keys = batch.column("key").to_numpy()
            root = "path" not in batch.schema.names
            roots = mix(np.arange(1, runs + 1, dtype=np.uint64)) if root else [batch.column("path").to_numpy().view(np.uint64)[:, None]]
            for path in roots:
                chosen = mix(own + path) < bar
                row, col = np.nonzero(np.broadcast_to(chosen, sig.shape))
                at = path[row, 0] if not root else path
                to = mix(mix(own[col] + at) ^ mix(sig[row, col] + np.uint64(0x51ED270B)))
                yield pa.RecordBatch.from_arrays([pa.array(to.view(np.int64)), pa.array(keys[row])], ["path", "key"])

    return split


def run_count(recall: float, depth: int) -> int:
    """Runs that bring a pair at the threshold together with probability ``recall``, ``depth`` levels deep."""
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def _groups(batches, key: str):
    """Whole groups of rows sorted by ``key``, as many at once as a batch holds."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        values = table.column(key).to_numpy()
        cut = int(np.flatnonzero(values != values[-1])[-1]) + 1 if len(values) and values[0] != values[-1] else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _pairs(bounds: np.ndarray, most: int = 1 << 18):
    """Index pairs within each group, in pieces of about ``most`` pairs."""
    sizes = np.diff(bounds)
    todo, count = [], 0
    for start, size in zip(bounds[:-1], sizes, strict=True):
        for i in range(size - 1):
            todo.append((start + i, size - 1 - i))
            count += size - 1 - i
            if count >= most:
                yield _spread(todo)
                todo, count = [], 0
    if todo:
        yield _spread(todo)


def _spread(todo: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    left, times = np.array(todo).T
    ends = np.cumsum(times)
    return np.repeat(left, times), np.arange(ends[-1]) - np.repeat(ends - times, times) + np.repeat(left, times) + 1


def _forest(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices of the links and the smallest key each can reach."""
    label = keys.astype(np.int64)
    while len(a):
        low = np.minimum(label[a], label[b])
        old = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        if (old == label).all():
            break
    seen = np.unique(np.concatenate([a, b])).astype(np.int64)
    return keys[seen], label[seen]


def _compare_sketches(batches):
    for table in _groups(batches, "grp"):
        groups, keys = table.column("grp").to_numpy(), table.column("key").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, WIDTH)
        bounds = np.concatenate([[0], np.flatnonzero(groups[1:] != groups[:-1]) + 1, [len(groups)]])
        found = []
        for a, b in _pairs(bounds):
            alike = np.zeros(len(a), np.int16)
            for i in range(WIDTH):
                alike += sig[a, i] == sig[b, i]
            near = alike >= SKETCH * WIDTH
            found.append((a[near], b[near]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        # Links do not cross groups; a key that is in several only joins what belongs together.
        nodes, roots = _forest(keys, a, b)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])


def _blocked(rows: DataFrame, group: str, count: str, size: int) -> DataFrame:
    """Adds ``grp`` and ``side``: a group of up to ``size`` rows as it is, a larger one as pairs of its blocks."""
    n = F.ceil(F.col(count) / size).cast("int")
    rows = rows.withColumn("n_blocks", n).withColumn("block", F.pmod(F.xxhash64("key"), n).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    pair = F.xxhash64(group, F.least("block", "other"), F.greatest("block", "other"))
    one = F.col("block") == F.col("other")
    side = F.when(one, 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    return rows.withColumn("grp", F.when(F.col("n_blocks") == 1, F.col(group)).otherwise(pair)).withColumn("side", side)


def _compare_sets(threshold: float):
    def compare(batches):
        for table in _groups(batches, "grp"):
            groups = table.column("grp").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(groups[1:] != groups[:-1]) + 1, [len(groups)]])
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                part = table.slice(start, end - start)
                keys, side = part.column("key").to_numpy(), part.column("side").to_numpy()
                sets = [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
                linked = _alike(sets, side, threshold)
                a, b = np.nonzero(linked)
                nodes, roots = _forest(keys, a, b)
                low = dict(zip(nodes.tolist(), roots.tolist(), strict=True))
                links = linked.sum(1)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(links.astype(np.int64)), pa.array([low.get(k, k) for k in keys.tolist()], pa.int64())], ["key", "links", "root"])

    return compare


def _alike(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold; of two blocks only pairs across them."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    rank = np.cumsum(shared) - 1
    use = shared[code]
    owner, code = owner[use], rank[code[use]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    total, width = int(shared.sum()), 4096
    for start in range(0, total, width):
        lo, hi = np.searchsorted(code, (start, start + width))
        held = np.zeros((len(sets), min(width, total - start)), np.float32)
        held[owner[lo:hi], code[lo:hi] - start] = 1
        common += held @ held.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * union - 1e-9 * union
    np.fill_diagonal(linked, False)
    across = side[:, None] + side[None, :] == 3
    return linked & (across | ((side[:, None] == 0) & (side[None, :] == 0)))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(key, class, same, links) of each document with words.

    ``class`` is the smallest id of its near duplicates, ``same`` that of the documents with the same shingles, and
    ``links`` the number of other shingle sets at the threshold or above.
    """
    docs = df.select(id_or_last(F.col(id_col)).alias("key"), F.col(text_col).alias("text"))
    sketches = stored(docs.mapInArrow(_sketch, "key long, n long, s long, t long, sig binary"), "sketches")
    identity = ["n", "s", "t"]
    firsts = sketches.groupBy(*identity).agg(F.min("key").alias("key"))
    members = stored(sketches.select("key", *identity).distinct().join(firsts.withColumnRenamed("key", "same"), identity).select("key", "same"), "members")
    sets = stored(sketches.join(firsts, [*identity, "key"], "left_semi").dropDuplicates([*identity, "key"]).select("key", "sig"), "sets")

    split = _children(threshold, run_count(recall, DEPTH))
    paths = sets.mapInArrow(split, "path long, key long")
    leaves = []
    for level in range(1, DEPTH + 1):
        rows = stored(paths, "paths")
        sizes = rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        rows = stored(rows.join(sizes, "path"), "nodes")
        leaves.append(rows.filter(F.col("n") <= BUCKET) if level < DEPTH else rows)
        large = rows.filter(F.col("n") > BUCKET)
        if level == DEPTH or not large.limit(1).count():
            break
        paths = large.select("path", "key").join(sets, "key").select("path", "key", "sig").mapInArrow(split, "path long, key long")
    bucket = leaves[0]
    for more in leaves[1:]:
        bucket = bucket.unionByName(more)
    bucket = _blocked(bucket, "path", "n", BLOCK).select("grp", "key").distinct().join(sets, "key")
    candidates = bucket.repartition("grp").sortWithinPartitions("grp").mapInArrow(_compare_sketches, "a long, b long")
    parts = stored(components(candidates), "parts")

    sizes = parts.groupBy("root").agg(F.count("*").alias("n"))
    wanted = _blocked(parts.withColumnRenamed("node", "key").join(sizes, "root"), "root", "n", BLOCK).select("key", "grp", "side")
    texts = docs.join(wanted.groupBy("key").agg(F.collect_list(F.struct("grp", "side")).alias("to")).hint("shuffle_hash"), "key").dropDuplicates(["key"])

    def expand(batches):
        for part, rows in _chunks(batches):
            shingles, bounds = shingle_sets(rows)
            values = [shingles[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("to"), pa.array(values, pa.binary())], ["key", "to", "shingles"])

    held = texts.select("key", "text", "to").mapInArrow(expand, "key long, to array<struct<grp:long,side:int>>, shingles binary")
    held = held.withColumn("to", F.explode("to")).select("key", "to.grp", "to.side", "shingles")
    checked = stored(held.repartition("grp").sortWithinPartitions("grp").mapInArrow(_compare_sets(threshold), "key long, links long, root long"), "links")
    classes = components(checked.select(F.col("key").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("key").agg(F.sum("links").alias("links"))
    found = members.join(links.withColumnRenamed("key", "same"), "same", "left").join(classes.withColumnRenamed("node", "same"), "same", "left")
    return found.select("key", F.coalesce("root", "same").alias("class"), "same", F.coalesce("links", F.lit(0)).alias("links"))


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row for each row of ``df``: its id, class_id, same_id and n_links; without words it is its own class."""
    docs, numbered = row_keys(df.select(F.col(id_col).alias("own"), F.col(text_col).alias("text")), "own", "text", "key")
    found = near_duplicates(docs, "key", "text", **options)
    rows = docs.select("own", "key").join(found, "key", "left")
    rows = rows.withColumn("class", F.coalesce("class", "key")).withColumn("same", F.coalesce("same", "key"))
    if numbered:
        ids = docs.select("key", F.col("own").cast("long").alias("id"))
        for name in ("class", "same"):
            rows = rows.join(ids.withColumnRenamed("key", name), name).drop(name).withColumnRenamed("id", name)
    return rows.select(F.col("own").alias(id_col), F.col("class").alias("class_id"), F.col("same").alias("same_id"), F.coalesce("links", F.lit(0)).alias("n_links"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without those whose class has an earlier row; all without words stay."""
    key, first = fresh(df, "_key"), fresh(df, "_first")
    docs, _ = row_keys(df, id_col, text_col, key)
    found = near_duplicates(docs, key, text_col, **options).select(F.col("key").alias(key), F.col("class").alias(first))
    rows = docs.join(found.hint("shuffle_hash"), key, "left")
    return rows.filter(F.col(first).isNull() | (F.col(first) == F.col(key))).select(*df.columns)
