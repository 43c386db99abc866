"""K-means for a range of k at once over sparse rows, the best k, labels, distances and saved models.

Rows are (row, weight, slots, values). All k share each pass: rows are dealt into
groups of a bounded number of entries, a group receives the entries of all centres
in the slots it holds, assigns its rows for every k, and sends on the sums of the
new centres. Centres are tables by slot with the sums of each centre;
nothing that grows with the rows or the slots is broadcast or reaches the driver.

Sums are kept in whole numbers of a fixed fraction, and seeds are drawn by hashes of
the rows, so results do not depend on the partitions or on the order of additions.
"""

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release

# The functions of the groups travel to the tasks by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The range of k and the seed.
LOW_K, HIGH_K, SEED = 2, 20, 0

# Entries and rows of a group of rows, the least number of groups, and products worked on at once.
ENTRIES, ROWS, LEAST_GROUPS, PAIRS = 3_000_000, 16_384, 16, 2_000_000
# Numbers a group may hold as whole lines of centres, and slots for which all rows are worked on at once.
LINES, FEW = 12_000_000, 16
# Rows of a group that hold a slot for which they are worked on as a plain matrix; a sixteenth of all rows too.
OFTEN = 64
# Groups whose sums meet in a task, and sums a task should hold.
MET, SUMS = 256, 4_000_000
# A slot in more than this share of all groups is sent in parts.
SHARES = 2_000
# Rows drawn a round for seeding (expected), and rounds.
DRAWN, ROUNDS = 2 * HIGH_K, 2
# A k is finished when a pass lowers its cost by less than this share.
TOLERANCE = 1e-4

_COUNT, _COST, _SQUARE = -1, -2, -3


@dataclass
class Model:
    """Tables of a fitted model.

    ``centres``: (cluster, slot, value). ``clusters``: (cluster, rows, square), the
    rows of each and the square of its centre's length. ``vocabulary``: (term, rows,
    slot), or None where the rows were vectors already.
    """

    centres: DataFrame
    clusters: DataFrame
    vocabulary: DataFrame | None = None


@dataclass
class Sweep:
    """Cost per k, the best k and its model."""

    costs: dict[int, float]
    best_k: int
    model: Model
    iterations: dict[int, int] = field(default_factory=dict)

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(sorted(self.costs.items()), "k int, cost double")


def best_k(costs: dict[int, float]) -> int:
    """Smallest cost, ties to the smaller k."""
    return min(costs, key=lambda k: (costs[k], k))


# --- rows in groups -----------------------------------------------------------


@dataclass
class _Groups:
    """Rows dealt into groups, with their slots and values packed, and the slots each group needs."""

    vectors: DataFrame
    rows: DataFrame
    needs: DataFrame
    hot: DataFrame
    groups: int
    entries: int
    total: int
    scale: float
    cost_scale: float

    def drop_in(self, centres: DataFrame) -> DataFrame:
        """``centres`` (slot, centres, totals) once for each group that holds the slot."""
        copies = centres.join(F.broadcast(self.hot), "slot", "left")
        copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)))
        # The stored needs are packed tightly, so by their size the driver would get all of them.
        return self.needs.hint("merge").join(copies.drop("copies"), ["slot", "copy"]).select("group", "slot", "centres", "totals")


def _group(vectors: DataFrame, passes: bool = False) -> _Groups:
    """Deal rows into groups by a hash of each; ``vectors`` should be stored.

    A group is bounded in its entries and, as it is worked on with a number for each
    row and centre, in its rows. For many ``passes`` the rows are kept on the disks
    of the executors, dealt by group, so that a pass moves only centres and sums; the
    caller lets go of them.

    A slot that most groups hold would be a hot key of the join to the centres; it
    is dealt out in parts. Slots with more than one part are at most ``SHARES``.
    """
    size = vectors.agg(
        F.sum(F.size("slots")), F.sum("weight"),
        F.max(F.coalesce(F.array_max(F.transform("values", F.abs)), F.lit(0.0))),
        F.max(F.aggregate("values", F.lit(0.0), lambda s, x: s + x * x)), F.count(F.lit(1)),
    ).first()
    groups = max(LEAST_GROUPS, math.ceil((size[0] or 0) / ENTRIES), math.ceil(size[4] / ROWS))
    held = vectors.withColumn("mark", F.xxhash64("slots", "values"))
    # The row too, as equal rows would be one group of any size.
    held = held.withColumn("group", F.pmod(F.xxhash64("mark", "row"), F.lit(groups)).cast("int"))
    kinds = ", ".join(f"{name} {kind}" for name, kind in held.select("group", "mark", "row", "weight").dtypes)
    rows = held.select("group", "mark", "row", "weight", "slots", "values").mapInArrow(_pack_batches, f"{kinds}, packed binary")
    # Some more partitions than groups, so that few share one.
    rows = rows.repartition(4 * groups, "group")
    if passes:
        rows = rows.persist(StorageLevel.DISK_ONLY)
    held_slots = materialize(rows.groupBy("group").applyInArrow(_held_slots, "group int, slot bigint"), "held-slots")
    needs = held_slots
    spread = needs.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    whole = spread.agg(F.sum("n")).scalar()
    copies = F.ceil(F.col("n") * SHARES / whole).cast("int")
    hot = materialize(spread.filter(F.col("n") * SHARES > whole).select("slot", copies.alias("copies")), "hot-slots")
    part = F.pmod(F.xxhash64("group"), F.coalesce("copies", F.lit(1))).cast("int")
    needs = needs.join(F.broadcast(hot), "slot", "left").select("group", "slot", part.alias("copy"))
    # Whole numbers up to 2^52 add up exactly in floating point too.
    weight = max(1.0, float(size[1] or 0))
    scale = 2.0 ** min(40, math.floor(52 - math.log2(weight * max(size[2] or 0.0, 2.0**-20))))
    cost_scale = 2.0 ** min(40, math.floor(60 - math.log2(weight * 4 * max(size[3] or 0.0, 2.0**-20))))
    needs = materialize(needs, "needed-slots")
    release(held_slots)
    return _Groups(vectors, rows, needs, hot, groups, size[0] or 0, size[1] or 0, scale, cost_scale)


_WIDTHS = (np.uint8, np.uint16, np.uint32, np.int64)


def _pack(slots: np.ndarray, values: np.ndarray) -> bytes:
    """Slots as steps of as few bytes as they need, values by their number in a list of the different ones where few differ."""
    steps = np.diff(slots, prepend=np.int64(0))
    wide = 3
    if len(steps) and steps.min() >= 0:
        wide = next(i for i, x in enumerate(_WIDTHS) if steps.max() <= np.iinfo(x).max)
    known, at = np.unique(values.view(np.int64), return_inverse=True)
    few = len(known) < min(256, len(values) // 4)
    listed = [known.tobytes(), at.astype(np.uint8).tobytes()] if few else [values.tobytes()]
    planes = _planes(steps.astype(_WIDTHS[wide]))
    raw = b"".join([np.array([wide, len(slots), len(known) if few else -1], np.int64).tobytes(), *listed, planes])
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes):
    size = int(np.frombuffer(packed, np.int64, 1)[0])
    raw = pa.decompress(memoryview(packed)[8:], size, codec="zstd")
    wide, n, few = np.frombuffer(raw, np.int64, 3).tolist()
    if few >= 0:
        known, at = np.frombuffer(raw, np.float64, few, 24), np.frombuffer(raw, np.uint8, n, 24 + 8 * few)
        values, end = known[at], 24 + 8 * few + n
    else:
        values, end = np.frombuffer(raw, np.float64, n, 24), 24 + 8 * n
    return np.cumsum(_from_planes(raw, _WIDTHS[wide], n, end), dtype=np.int64), values


def _pack_batches(batches):
    for batch in batches:
        lists = [batch.column(name) for name in ("slots", "values")]
        offsets = [x.offsets.to_numpy() for x in lists]
        slots, values = (np.asarray(x.values, kind) for x, kind in zip(lists, (np.int64, np.float64)))
        packed = [_pack(slots[a:b], values[c:d]) for a, b, c, d in zip(offsets[0][:-1], offsets[0][1:], offsets[1][:-1], offsets[1][1:])]
        keep = [batch.column(name) for name in ("group", "mark", "row", "weight")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(packed, pa.binary())], names=["group", "mark", "row", "weight", "packed"])


def _held_slots(table: pa.Table) -> pa.Table:
    """The different slots of a group."""
    _, known, _, _ = _row_entries(table)
    return pa.table({"group": pa.array(np.full(len(known), table.column("group")[0].as_py()), pa.int32()), "slot": known})


def _flat(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.asarray(chunk.flatten(), kind) for chunk in table.column(name).chunks)])


def _centre_entries(table: pa.Table, local: np.ndarray, counts: np.ndarray, scale: float):
    """(slots, place, centre, mean): the slots in order, and of each entry its place there, its centre by ``local`` and value."""
    slots = table.column("slot").to_numpy()
    lengths = np.concatenate([np.zeros(0, np.int64), *(np.asarray(c.value_lengths(), np.int64) for c in table.column("centres").chunks)])
    order = np.argsort(slots, kind="stable")
    place = np.empty(len(slots), np.int32)
    place[order] = np.arange(len(slots), dtype=np.int32)
    # The table may hold centres of k that are finished.
    number = _flat(table, "centres", np.int32)
    centre = np.where(number < len(local), local.astype(np.int32)[np.minimum(number, len(local) - 1)], np.int32(-1))
    wanted = centre >= 0
    centre = centre[wanted]
    return slots[order], np.repeat(place, lengths)[wanted], centre, _flat(table, "totals", np.float64)[wanted] / (counts * scale)[centre]


def _row_entries(table: pa.Table):
    """(lengths, known, at, values) of the rows of a group: the slots it holds in order, and of each entry its place there."""
    rows = [_unpack(packed.as_buffer()) for chunk in table.column("packed").chunks for packed in chunk]
    lengths = np.array([len(slots) for slots, _ in rows], np.int64)
    slots = np.concatenate([np.zeros(0, np.int64), *(slots for slots, _ in rows)])
    values = np.concatenate([np.zeros(0), *(values for _, values in rows)])
    low, high = (int(slots.min()), int(slots.max())) if len(slots) else (0, 0)
    if high - low < 8 * len(slots):
        # A table over all slots between the first and the last is faster than a sort.
        held = np.zeros(high - low + 1, bool)
        held[slots - low] = True
        known, at = np.flatnonzero(held) + low, (np.cumsum(held, dtype=np.int32) - 1)[slots - low]
    else:
        known, at = np.unique(slots, return_inverse=True)
    return lengths, known, at.astype(np.int32), values


def _squares(rows, entries, counts, norms):
    """Squared distances of all rows of a group to all centres.

    Slots in which many centres have a value are held as whole lines, up to ``LINES``
    numbers, and a row takes the product with its lines. In all other slots only what
    both hold is multiplied, in runs of about ``PAIRS`` products. What a row gets does
    not depend on the order of the rows.
    """
    lengths, known, at, values = rows
    slots, place, centre, mean = entries
    n, m = len(lengths), len(counts)
    of = np.repeat(np.arange(n, dtype=np.int32), lengths)
    out = np.bincount(of, weights=values * values, minlength=n)[:, None] + norms
    if not len(slots) or not len(known):
        return np.maximum(out, 0.0)
    count = np.bincount(place, minlength=len(slots))
    where = np.minimum(np.searchsorted(slots, known), len(slots) - 1)
    held = np.where(slots[where] == known, count[where], 0)
    wide = np.flatnonzero((held > 0) & (held * 4 >= m))
    wide = np.sort(wide[np.argsort(-np.bincount(at, minlength=len(known))[wide], kind="stable")[:LINES // m]])
    line = np.full(len(slots), -1, np.int32)
    line[where[wide]] = np.arange(len(wide), dtype=np.int32)
    own = line[place]
    lines = np.zeros((len(wide), m))
    some = own >= 0
    lines[own[some], centre[some]] = mean[some]
    line = np.full(len(known), -1, np.int32)
    line[wide] = np.arange(len(wide), dtype=np.int32)
    taken = line[at]
    inside = taken >= 0
    many = np.bincount(taken[inside], minlength=len(wide))
    often = np.flatnonzero((many >= OFTEN) & (many * 16 >= n)) if len(wide) > FEW else np.zeros(0, np.int64)
    if len(often):
        # Slots that many rows hold: a block of them at a time as a plain matrix.
        block, column = max(16, PAIRS // n), np.full(len(wide), -1, np.int32)
        column[often] = np.arange(len(often), dtype=np.int32)
        column = column[taken]
        column[~inside] = -1
        mine = np.flatnonzero(column >= 0)
        mine = mine[np.argsort(column[mine] // block, kind="stable")]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(column[mine] // block))])
        for i in range(len(cuts) - 1):
            some = mine[cuts[i]:cuts[i + 1]]
            held_here = often[i * block:(i + 1) * block]
            matrix = np.zeros((n, len(held_here)))
            matrix[of[some], column[some] - i * block] = values[some]
            out -= 2.0 * (matrix @ lines[held_here])
        inside_rest = inside & (column < 0)
    else:
        inside_rest = inside
    taken, factor, of_rest = taken[inside_rest], values[inside_rest], of[inside_rest]
    if len(wide) <= FEW:
        for i in range(len(wide)):
            mine = taken == i
            out[of_rest[mine]] -= 2.0 * factor[mine][:, None] * lines[i]
    else:
        ends, step = np.concatenate([[0], np.cumsum(np.bincount(of_rest, minlength=n))]).tolist(), max(1, PAIRS // m)
        for i in range(n):
            for low in range(ends[i], ends[i + 1], step):
                high = min(low + step, ends[i + 1])
                out[i] -= 2.0 * (factor[low:high] @ lines.take(taken[low:high], axis=0))
    del lines
    some = np.flatnonzero(own < 0)
    some = some[np.argsort(place[some], kind="stable")]
    count = np.bincount(place[some], minlength=len(slots))
    first, centre, mean = np.cumsum(count) - count, centre[some], mean[some]
    inside = np.flatnonzero(~inside & (held[at] > 0))
    place, of, values = where[at[inside]], of[inside], values[inside]
    times = count[place]
    work = np.concatenate([[0], np.cumsum(times)])
    ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])
    work = work[ends]
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(work, work[low] + PAIRS, side="right")) - 1)
        some = slice(ends[low], ends[high])
        times_here = times[some]
        pairs = np.repeat(first[place[some]] - (np.cumsum(times_here) - times_here), times_here) + np.arange(times_here.sum())
        key = np.repeat((of[some] - low).astype(np.int64) * m, times_here) + centre[pairs]
        dots = np.bincount(key, weights=np.repeat(values[some], times_here) * mean[pairs], minlength=(high - low) * m)
        out[low:high] -= 2.0 * dots.reshape(high - low, m)
        low = high
    return np.maximum(out, 0.0)


def _least(squares: np.ndarray) -> np.ndarray:
    """The nearest centre of each row; distances that agree to nine decimals are ties, which the first one wins."""
    return np.argmin(np.round(squares, 9), axis=1)


@dataclass
class _Centres:
    """A set of centres: their table, and by id the rows behind each and the square of its length."""

    table: DataFrame
    counts: dict[int, int]
    norms: dict[int, float]
    stored: DataFrame | None = None

    def shared(self, ids):
        """Arrays over ``ids`` in order; a centre without rows is infinitely far."""
        local = np.full(max(ids) + 1, -1, np.int64)
        local[ids] = np.arange(len(ids))
        counts = np.array([float(self.counts.get(i, 1)) for i in ids])
        norms = np.array([self.norms.get(i, 0.0) if self.counts.get(i) else np.inf for i in ids])
        return local, counts, norms


def _measured(groups: _Groups, centres: _Centres, ids: list[int], work, schema: str) -> DataFrame:
    """What ``work(table of rows, entries of rows, squared distances)`` makes of each group; ``ids`` must be those of the table."""
    local, counts, norms = centres.shared(ids)
    scale = groups.scale

    def each(rows: pa.Table, parts: pa.Table) -> pa.Table:
        entries = _row_entries(rows)
        return work(rows, entries, _squares(entries, _centre_entries(parts, local, counts, scale), counts, norms))

    left, right = groups.rows.groupBy("group"), groups.drop_in(centres.table).groupBy("group")
    return left.cogroup(right).applyInArrow(each, schema)


_SUMS = "bucket int, part bigint, packed binary"
_PARTS = "slot bigint, centres array<int>, totals array<bigint>"


def _opened(sums: DataFrame) -> DataFrame:
    """(slot, centre, total) of packed sums."""
    return sums.select("slot", F.inline(F.arrays_zip(F.col("centres").alias("centre"), F.col("totals").alias("total"))))


def _packed(sums: DataFrame) -> DataFrame:
    """(slot, centre, total), each slot and centre once, by slot."""
    held = F.collect_list(F.struct("centre", "total"))
    return sums.groupBy("slot").agg(held.alias("held")).select("slot", F.col("held.centre").alias("centres"), F.col("held.total").alias("totals"))


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of equal rank together, so that the high ones shrink to nothing."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()


def _from_planes(raw, kind, n: int, start: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, start).reshape(width, n).T).reshape(-1).view(kind)


def _pack_sums(slots: np.ndarray, centres: np.ndarray, totals: np.ndarray) -> bytes:
    """Sums by slot and centre, in this order, as bytes.

    Most slots are held by one row of a group, whose total is then that of a centre of
    every k: of equal totals in a row only the first is kept.
    """
    known, counts = np.unique(slots, return_counts=True)
    new = np.diff(totals, prepend=~totals[:1]) != 0
    kept = totals[new]
    parts = [_planes(np.diff(known, prepend=np.int64(0))), _planes(counts.astype(np.int32)), _planes(centres.astype(np.int32)), np.packbits(new).tobytes(), _planes(kept)]
    raw = b"".join([np.array([len(known), len(slots), len(kept)], np.int64).tobytes(), *parts])
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unpack_sums(packed):
    raw = pa.decompress(memoryview(packed)[8:], int(np.frombuffer(packed, np.int64, 1)[0]), codec="zstd")
    many, n, kept = np.frombuffer(raw, np.int64, 3).tolist()
    at = 24
    known = np.cumsum(_from_planes(raw, np.int64, many, at))
    counts = _from_planes(raw, np.int32, many, at := at + 8 * many)
    centres = _from_planes(raw, np.int32, n, at := at + 4 * many)
    new = np.unpackbits(np.frombuffer(raw, np.uint8, -(-n // 8), at := at + 4 * n), count=n)
    totals = _from_planes(raw, np.int64, kept, at + -(-n // 8))
    return np.repeat(known, counts), centres, totals[np.cumsum(new) - 1]


def _lists(bucket, part, slots, centres, totals) -> pa.Table:
    """A row for each bucket with its sums; ``bucket`` ascends, and the slots and centres of a bucket do."""
    known, starts = np.unique(bucket, return_index=True)
    ends = np.append(starts[1:], len(bucket))
    held = [_pack_sums(slots[a:b], centres[a:b], totals[a:b]) for a, b in zip(starts, ends)]
    return pa.table([pa.array(known, pa.int32()), pa.array(np.full(len(known), part), pa.int64()), pa.array(held, pa.binary())], names=["bucket", "part", "packed"])


def _added(table: pa.Table):
    """(slots, centres, totals) of the sums of a bucket, each slot and centre once, in order."""
    found = [_unpack_sums(packed.as_buffer()) for chunk in table.column("packed").chunks for packed in chunk]
    slots, centres, totals = (np.concatenate([np.zeros(0, kind), *each]) for kind, each in zip((np.int64, np.int32, np.int64), zip(*found)))
    width = int(centres.max(initial=0)) + 1
    key = (slots - _SQUARE) * width + centres
    # Runs that are in order already; such a sort merges them.
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    firsts = order[starts]
    return slots[firsts], centres[firsts], np.add.reduceat(totals[order], starts) if len(starts) else totals


def _merged(sums: DataFrame, groups: int, name: str) -> DataFrame:
    """Add up the sums of all groups, in a tree, and pack them by slot; stored.

    A task holds one bucket of slots of up to ``MET`` groups, so a slot that every
    group holds is added up in steps. Beside the sums stand, for each bucket, the
    sums of their squares by centre.
    """
    def meet(table: pa.Table) -> pa.Table:
        slots, centres, totals = _added(table)
        return _lists(np.full(len(slots), table.column("bucket")[0].as_py()), table.column("part")[0].as_py() // MET, slots, centres, totals)

    def pack(table: pa.Table) -> pa.Table:
        slots, centres, totals = _added(table)
        own = slots >= 0
        squares = np.bincount(centres[own], weights=totals[own].astype(np.float64) ** 2)
        full = np.flatnonzero(squares)
        slots = np.concatenate([np.full(len(full), _SQUARE), slots])
        centres = np.concatenate([full.astype(np.int32), centres])
        totals = np.concatenate([squares[full].view(np.int64), totals])
        known, starts = np.unique(slots, return_index=True)
        offsets = np.concatenate([starts, [len(slots)]]).astype(np.int32)
        held = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((centres, pa.int32()), (totals, pa.int64()))]
        return pa.table([pa.array(known, pa.int64()), *held], names=["slot", "centres", "totals"])

    while groups > MET:
        sums, groups = sums.groupBy("bucket", "part").applyInArrow(meet, _SUMS), math.ceil(groups / MET)
    return materialize(sums.groupBy("bucket").applyInArrow(pack, _PARTS), name)


def _weighed(sums: DataFrame, scale: float) -> tuple[_Centres, dict[int, int]]:
    """Stored sums as centres, and the costs beside them: a few numbers a bucket and centre reach the driver."""
    control = _opened(sums.filter("slot < 0")).collect()
    counts = {r["centre"]: r["total"] for r in control if r["slot"] == _COUNT}
    costs = {r["centre"]: r["total"] for r in control if r["slot"] == _COST}
    squares: dict[int, list[float]] = {i: [] for i in counts}
    for r in control:
        if r["slot"] == _SQUARE:
            squares[r["centre"]].append(float(np.int64(r["total"]).view(np.float64)))
    # math.fsum does not depend on the order either.
    norms = {i: math.fsum(found) / (max(1, counts[i]) * scale) ** 2 for i, found in squares.items()}
    return _Centres(sums.filter("slot >= 0"), counts, norms, sums), costs


# --- seeds --------------------------------------------------------------------


def _uniform(*parts):
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _nearest(groups: _Groups, centres: _Centres, ids: list[int]) -> DataFrame:
    """(row, mark, weight, nearest, square) of each row."""

    def work(rows, entries, squares):
        least = _least(squares)
        return pa.table({
            "row": rows.column("row"), "mark": rows.column("mark"), "weight": rows.column("weight"),
            "nearest": pa.array(np.array(ids)[least], pa.int32()), "square": squares[np.arange(len(least)), least],
        })

    return materialize(_measured(groups, centres, ids, work, "row bigint, mark bigint, weight bigint, nearest int, square double"), "nearest")


def _from_rows(groups: _Groups, numbers: DataFrame, name: str) -> _Centres:
    """The centres that ``numbers`` (row, centre, share) makes of rows; the rows are few."""
    held = groups.vectors.select("row", "slots", "values").join(F.broadcast(numbers), "row")
    scale = groups.scale

    def listed(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values = np.array(row["values"], np.float64) * scale
                totals = (np.copysign(np.floor(np.abs(values) + 0.5), values)).astype(np.int64) * row["share"]
                slots = np.concatenate([[_COUNT], np.array(row["slots"], np.int64)])
                yield from _lists(np.zeros(len(slots), np.int64), 0, slots, np.full(len(slots), row["centre"]), np.concatenate([[row["share"]], totals])).to_batches()

    listed = held.select("centre", "share", "slots", "values").mapInArrow(listed, _SUMS)
    return _weighed(_merged(listed, 1, name), groups.scale)[0]


def _local_means(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Labels of a few weighted points: k-means++ with fixed draws, then up to thirty steps."""
    draw = np.random.default_rng([seed, k])
    squares = (points**2).sum(axis=1)
    chosen = [int(np.searchsorted(np.cumsum(weights), draw.random() * weights.sum()))]
    least = np.full(len(points), np.inf)
    while len(chosen) < k:
        least = np.minimum(least, np.maximum(squares + squares[chosen[-1]] - 2 * points @ points[chosen[-1]], 0.0))
        mass = np.cumsum(weights * least)
        if mass[-1] <= 0:
            break
        chosen.append(min(int(np.searchsorted(mass, draw.random() * mass[-1], side="right")), len(points) - 1))
    centres, label = points[chosen], None
    for _ in range(30):
        found = np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)
        if label is not None and (found == label).all():
            break
        label = found
        centres = np.array([np.average(points[label == i], axis=0, weights=weights[label == i]) if (label == i).any() else centres[i] for i in range(len(centres))])
    return np.unique(label, return_inverse=True)[1]


def _drawn(spark, groups: _Groups, ks, first: dict[int, int], seed: int) -> _Centres | None:
    """Seeds of all k: rows drawn in proportion to their squared distance, by hashes, then weighted means of these.

    About ``DRAWN`` rows a round are drawn whatever the size of the table; only
    they reach the driver.
    """
    start = groups.rows.select(F.min(F.struct(F.xxhash64(F.lit(seed), "mark").alias("draw"), "mark", "row")).alias("least")).first()["least"]
    if start is None:
        return None
    found = [start["row"]]
    for turn in range(ROUNDS + 1):
        numbers = spark.createDataFrame([(r, i, 1) for i, r in enumerate(found)], "row bigint, centre int, share bigint")
        tried = _from_rows(groups, numbers, f"seeds-{turn}")
        near = _nearest(groups, tried, list(range(len(found))))
        release(tried.stored)
        if turn == ROUNDS:
            break
        # Whole numbers again, so that the sum does not depend on its order.
        whole = near.agg(F.sum((F.col("square") * 2.0**20).cast("decimal(38,0)") * F.col("weight"))).first()[0]
        if not whole:
            break
        # Rows that hold the same are drawn as one.
        alike = near.groupBy("mark").agg(F.min("row").alias("row"), F.sum("weight").alias("weight"), F.max("square").alias("square"))
        chance = F.col("square") * F.col("weight") * (DRAWN * 2.0**20 / float(whole))
        more = alike.filter(_uniform(F.lit(seed), F.lit(turn), "mark") < chance).select("row", "mark").collect()
        found += [r["row"] for r in sorted(more, key=lambda r: r["mark"]) if r["row"] not in found]
        release(near)
    shares = {r["nearest"]: r["n"] for r in near.groupBy("nearest").agg(F.sum("weight").alias("n")).collect()}
    release(near)
    numbers = spark.createDataFrame([(r, i) for i, r in enumerate(found)], "row bigint, i int")
    held = groups.vectors.join(F.broadcast(numbers), "row").select("i", "slots", "values").orderBy("i").collect()
    slots = np.unique(np.concatenate([np.asarray(r["slots"], np.int64) for r in held]))
    points = np.zeros((len(found), len(slots)))
    for r in held:
        points[r["i"], np.searchsorted(slots, np.asarray(r["slots"], np.int64))] = r["values"]
    weights = np.array([float(shares.get(i, 0)) for i in range(len(found))])
    chosen = []
    for k in ks:
        labels = _local_means(points, np.maximum(weights, 1e-9), k, seed)
        chosen += [(found[i], first[k] + int(label), int(max(weights[i], 1))) for i, label in enumerate(labels)]
    return _from_rows(groups, spark.createDataFrame(chosen, "row bigint, centre int, share bigint"), "seeds")


# --- the sweep ----------------------------------------------------------------


def _step(groups: _Groups, centres: _Centres, ks, first, name: str) -> DataFrame:
    """Assign all rows for every k; the stored sums of the new centres, their counts and the costs under the old ones."""
    ids = [first[k] + i for k in ks for i in range(k)]
    begins = np.cumsum([0, *ks])
    scale, cost_scale = groups.scale, groups.cost_scale

    buckets = max(LEAST_GROUPS, math.ceil(min(groups.groups, MET) / groups.groups * groups.entries * len(ks) / SUMS))

    def work(rows, entries, squares):
        lengths, known, at, values = entries
        weight, part = np.asarray(rows.column("weight"), np.int64), rows.column("group")[0].as_py() // MET
        of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        whole = np.rint(values * scale) * weight[of]
        # Slots by bucket and then in order, and the entries of each slot together.
        order = np.lexsort((known, known % buckets))
        place = np.empty(len(known), np.int32)
        place[order] = np.arange(len(known), dtype=np.int32)
        known, at = known[order], place[at]
        by_slot = np.argsort(at, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(known)))])
        at, of, whole = at[by_slot], of[by_slot], whole[by_slot]
        labels, out, m = np.empty((len(ks), len(lengths)), np.int32), [], int(begins[-1])
        added = np.zeros((2, m), np.int64)
        for j, k in enumerate(ks):
            own = squares[:, begins[j]:begins[j + 1]]
            label = _least(own)
            labels[j] = label
            cost = np.rint(own[np.arange(len(label)), label] * cost_scale).astype(np.int64) * weight
            np.add.at(added[0], begins[j] + label, weight)
            np.add.at(added[1], begins[j] + label, cost)
        number, step = np.array(ids), max(1, PAIRS // m)
        for low in range(0, len(known), step):
            high = min(low + step, len(known))
            mine = slice(ends[low], ends[high])
            sums, here, where = np.empty((high - low, m)), (at[mine] - low).astype(np.int64), of[mine]
            for j, k in enumerate(ks):
                found = np.bincount(here * k + labels[j][where], weights=whole[mine], minlength=(high - low) * k)
                sums[:, begins[j]:begins[j + 1]] = found.reshape(high - low, k)
            sums = sums.ravel()
            full = np.flatnonzero(sums)
            slots = known[low + full // m]
            out.append(_lists(slots % buckets, part, slots, number[full % m], sums[full].astype(np.int64)))
        out.append(_lists(np.zeros(2 * m, np.int64), part, np.repeat([_COST, _COUNT], m), np.tile(number, 2), added[::-1].ravel()))
        return pa.concat_tables(out)

    return _merged(_measured(groups, centres, ids, work, _SUMS), groups.groups, name)


def _of_k(table: DataFrame, low: int, k: int) -> DataFrame:
    """(cluster, slot, total) of one k."""
    mine = _opened(table.filter("slot >= 0")).filter(F.col("centre").between(low, low + k - 1))
    return mine.select((F.col("centre") - low).alias("cluster"), "slot", "total")


def sweep(vectors: DataFrame, ks=range(LOW_K, HIGH_K + 1), seed: int = SEED, metric: str = "distance",
          max_iter: int = 20, seeds: list[int] | None = None, tolerance: float = TOLERANCE) -> Sweep:
    """Fit k-means for every k in shared passes over the rows, and keep the best model.

    ``vectors``: (row, weight, slots, values), slots ascending; ``row`` is unique.
    ``metric="distance"`` is the mean squared distance to the own centre,
    ``"silhouette"`` the mean silhouette of squared distances, times minus one.
    Seeds are drawn by hashes of the rows unless ``seeds`` lists rows: then k starts
    from the first k of these. With fewer different rows than k some clusters have
    no rows. A table without rows has cost 0 for every k and a model without clusters.
    """
    if metric not in ("distance", "silhouette"):
        raise ValueError(f"unknown metric: {metric}")
    groups = _group(vectors, passes=True)
    try:
        return _fitted(vectors.sparkSession, groups, list(ks), seed, metric, max_iter, seeds, tolerance)
    finally:
        groups.rows.unpersist()
        release(groups.needs, groups.hot)


def _fitted(spark, groups: _Groups, ks, seed, metric, max_iter, seeds, tolerance) -> Sweep:
    first = {k: sum(j for j in ks if j < k) for k in ks}
    if seeds is None:
        centres = _drawn(spark, groups, ks, first, seed)
    else:
        rows = [(r, first[k] + i, 1) for k in ks for i, r in enumerate(seeds[:k])]
        centres = _from_rows(groups, spark.createDataFrame(rows, "row bigint, centre int, share bigint"), "seeds")
    if centres is None:
        empty = spark.createDataFrame([], "cluster int, slot bigint, value double")
        return Sweep(dict.fromkeys(ks, 0.0), min(ks), Model(empty, spark.createDataFrame([], "cluster int, rows bigint, square double")))
    used, after, costs, done, open_ks, made = {}, {}, {}, {}, list(ks), [centres]
    for turn in range(max_iter + 1):
        sums = _step(groups, centres, open_ks, first, "centres")
        moved, paid = _weighed(sums, groups.scale)
        left = []
        for k in open_ks:
            cost = sum(paid.get(first[k] + i, 0) for i in range(k)) / groups.cost_scale / max(1, groups.total)
            before = costs.get(k)
            costs[k], used[k], after[k], done[k] = cost, centres, moved, turn
            if before is None or before - cost > tolerance * before:
                left.append(k)
        open_ks, centres = left, moved
        made.append(moved)
        # By distance only the best of the finished k can still be the model.
        ended = {k: costs[k] for k in costs if k not in open_ks}
        kept = [*open_ks, *([best_k(ended)] if ended and metric == "distance" else ended)]
        needed = [moved, *(found[k] for k in kept for found in (used, after))]
        release(*(x.stored for x in made if all(x is not y for y in needed)))
        if not open_ks:
            break
    if metric == "silhouette":
        costs = {k: -s for k, s in _silhouettes(groups, used, after, first).items()}
    k = best_k(costs)
    model = _model(spark, used[k], after[k], first[k], k, groups.scale)
    release(*(x.stored for x in made))
    return Sweep(costs, k, model, done)


def _model(spark, centres: _Centres, after: _Centres, low: int, k: int, scale: float) -> Model:
    ids = [i for i in range(k) if centres.counts.get(low + i)]
    rows = [(i, int(after.counts.get(low + i, 0)), float(centres.norms[low + i])) for i in ids]
    whole = F.get(F.array(*(F.lit(float(centres.counts.get(low + i) or 1)) for i in range(k))), F.col("cluster"))
    values = _of_k(centres.table, low, k).select("cluster", "slot", (F.col("total") / (whole * scale)).alias("value"))
    clusters = spark.createDataFrame(rows, "cluster int, rows bigint, square double")
    return Model(materialize(values, "model-centres"), materialize(clusters, "model-clusters"))


def _silhouettes(groups: _Groups, used, after, first) -> dict[int, float]:
    """Mean silhouette of each k: distances to a cluster's rows follow from the sums of the cluster.

    The mean squared distance of a row to the rows of a cluster is its squared
    distance to their mean, plus the mean of their squared distances to it. Two
    passes serve all k.
    """
    ks, many = list(used), sum(used)
    # The centres that decide the labels, then the means of the clusters they make.
    tables, counts, norms, begins = None, {}, {}, {}
    for k in ks:
        begins[k] = sum(j for j in ks if j < k)
        for found, shift in ((used[k], 0), (after[k], many)):
            own = _of_k(found.table, first[k], k).select("slot", (F.col("cluster") + begins[k] + shift).alias("centre"), "total")
            tables = own if tables is None else tables.unionByName(own)
            counts |= {begins[k] + i + shift: found.counts.get(first[k] + i, 0) for i in range(k)}
            norms |= {begins[k] + i + shift: found.norms.get(first[k] + i, 0.0) for i in range(k)}
    both = _Centres(materialize(_packed(materialize(tables, "labels-and-means")), "packed-means"), counts, norms)
    ids = list(range(2 * many))

    def spread(rows, entries, squares):
        weight, out = np.asarray(rows.column("weight")), np.zeros(many)
        for k in ks:
            label = _least(squares[:, begins[k]:begins[k] + k])
            far = squares[np.arange(len(label)), many + begins[k] + label]
            out[begins[k]:begins[k] + k] = np.bincount(label, weights=far * weight, minlength=k)
        return pa.table({"centre": pa.array(np.arange(many), pa.int32()), "total": out})

    inner = _measured(groups, both, ids, spread, "centre int, total double")
    inside = np.zeros(many)
    for r in inner.groupBy("centre").agg(F.sum("total").alias("total")).collect():
        inside[r["centre"]] = r["total"]
    sizes = np.array([float(counts[many + i]) for i in range(many)])

    def score(rows, entries, squares):
        weight, out = np.asarray(rows.column("weight")), []
        for k in ks:
            low, high = begins[k], begins[k] + k
            label = _least(squares[:, low:high])
            each, n = np.arange(len(label)), sizes[low:high][label]
            far = np.where(sizes[low:high] > 0, squares[:, many + low:many + high] + inside[low:high] / np.maximum(sizes[low:high], 1), np.inf)
            a = far[each, label] * n / np.maximum(n - 1, 1)
            far[each, label] = np.inf
            b = far.min(axis=1)
            top = np.maximum(a, b)
            good = (n > 1) & np.isfinite(b) & (top > 0)
            out.append(float((np.where(good, np.where(good, b, 0) - a, 0.0) / np.where(good, top, 1.0) * weight).sum()))
        return pa.table({"k": pa.array(ks, pa.int32()), "total": out})

    found = _measured(groups, both, ids, score, "k int, total double").groupBy("k").agg(F.sum("total").alias("total")).collect()
    return {r["k"]: r["total"] / max(1, groups.total) for r in found}


# --- labels and distances -------------------------------------------------------


def scored(vectors: DataFrame, model: Model) -> DataFrame:
    """(row, PredictedLabel, Score): the number of the nearest centre, from one, and the distances to all of them.

    Distances come from the slots that rows and centres share; centres go to the
    groups of rows that hold their slots. A cluster without rows counts as no centre.
    """
    spark = vectors.sparkSession
    clusters = model.clusters.orderBy("cluster").collect()
    if not clusters:
        return spark.createDataFrame([], "row bigint, PredictedLabel int, Score array<double>")
    groups = _group(vectors)
    numbers = [r["cluster"] for r in clusters]
    total = F.round(F.col("value") * 2.0**40).cast("bigint")
    parts = model.centres.select("slot", F.col("cluster").alias("centre"), total.alias("total"))
    centres = _Centres(_packed(parts), dict.fromkeys(numbers, 2.0**40 / groups.scale), {r["cluster"]: r["square"] for r in clusters})

    def work(rows, entries, squares):
        label = np.array(numbers)[_least(squares)] + 1
        far = np.sqrt(squares)
        flat = pa.ListArray.from_arrays(np.arange(0, far.size + 1, far.shape[1], dtype=np.int32), pa.array(far.reshape(-1)))
        return pa.table({"row": rows.column("row"), "PredictedLabel": pa.array(label, pa.int32()), "Score": flat})

    return _measured(groups, centres, numbers, work, "row bigint, PredictedLabel int, Score array<double>")


# --- saved models ---------------------------------------------------------------


def save_model(model: Model, path: str) -> None:
    """Three tables below ``path``: centres, clusters and, if there is one, the vocabulary."""
    for name in ("centres", "clusters", "vocabulary"):
        table = getattr(model, name)
        if table is not None:
            table.write.mode("overwrite").parquet(f"{path}/{name}")


def load_model(spark: SparkSession, path: str) -> Model:
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}")
    return Model(
        read("centres", "cluster int, slot bigint, value double"),
        read("clusters", "cluster int, rows bigint, square double"),
        read("vocabulary", "term string, rows bigint, slot bigint"),
    )
