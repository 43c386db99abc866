"""Removal of long byte strings that an earlier document holds, by a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a document with a smaller id. Suffixes are
sampled by content: of every ``LENGTH`` bytes the key of ``KEY`` bytes with the least hash is an anchor, so equal strings
have equal anchors in equal places, and about one suffix in sixteen is looked at.

1. Anchor hashes are dealt out by hash to shards. Anchors that only one document has, most of them, end here.
2. For the others the bytes around the anchor go to the shard of the anchor. There the documents arrive in batches, in
   the order of their ids. A batch gets its suffix array: its strings of ``LENGTH`` bytes, in sorted order, each with the
   first document that has it. The array is merge-scanned against the levels of the index, which hold all smaller ids;
   then it becomes a level itself, and levels of equal size are merged, so there are logarithmically many.
3. An anchor that very many texts hold, as a sample of them tells, is not dealt out whole: each of its strings of
   ``LENGTH`` bytes goes to the shard of the string, from each batch of rows with the first document that has it.
4. The matches return to their documents, and what they cover is cut.

Strings are sorted and compared by 64-bit fingerprints within a shard; the number of shards grows with the text, so
that a shard stays small. Documents with the same text as an earlier one are known from a hash of it and need no
anchors. Equal contexts of an anchor, and equal strings of a hot one, are sent only once by each batch of rows, with the
first document that has them; the others of the batch are settled there.

Documents of null id come last, and do not count as earlier than each other; neither do rows with equal ids, which are
told apart by a 64-bit hash of their text. Repeated rows give a row each. A null or empty text has no bytes, a very long
one is looked at piece by piece, and an empty table gives no rows. Only the id and text columns are read. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import LAST_ID, id_or_last, text_or_empty

LENGTH = 50
KEY = 20
#: Keys in a string.
SPAN = LENGTH - KEY + 1
#: Bytes around an anchor that strings with it can reach.
AROUND = 2 * LENGTH - KEY
#: Bytes of text for each shard, and least number of shards.
SHARD_BYTES = 8 << 20
SHARDS = 48
#: Contexts in a batch of the index.
BATCH = 8192
#: One text in so many is sampled, or fewer for a sample of so many bytes; anchors with so many places in it are hot.
SAMPLE = 64
SAMPLE_BYTES = 480 << 20
HOT = 32
PIECE = 1 << 20
CHUNK_BYTES = 1 << 19

_RANDOM = np.random.default_rng(50)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RADIX = 0x9E3779B97F4A7C15
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)
_TOP = np.uint64((1 << 64) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the radix and its inverse, as many as asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > len(self.up):
            made = []
            for radix in (_RADIX, _RADIX_INVERSE):
                steps = np.full(size, radix, np.uint64)
                steps[:1] = 1
                made.append(np.multiply.accumulate(steps))
            self.up, self.down = made
        return self.up[:size], self.down[:size]


_POWERS = _Powers()


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each place that has so many."""
    up, down = _POWERS.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return _mix((sums[size:] - sums[:-size]) * down[: len(data) + 1 - size])


def _slide(values: np.ndarray, take) -> np.ndarray:
    """``take`` (minimum or maximum) over each ``SPAN`` values in a row."""
    width = 1
    while 2 * width <= SPAN:
        values = take(values[:-width], values[width:])
        width *= 2
    return take(values[: len(values) - (SPAN - width)], values[SPAN - width :]) if SPAN > width else values


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of the anchors of all texts, in order."""
    pieces = [(i, at, t[at : at + PIECE + LENGTH - 1]) for i, t in enumerate(texts) for at in range(0, max(1, len(t) - LENGTH + 1), PIECE)]
    pieces = [p for p in pieces if len(p[2]) >= LENGTH]
    if not pieces:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    sizes = np.array([len(p[2]) for p in pieces])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    keys = _hashes(data, KEY)
    # The least key of each string; strings across two texts do not count.
    least = _slide(keys, np.minimum)
    crossing = np.zeros(len(data) + 1, np.int8)
    np.add.at(crossing, ends - LENGTH + 1, 1)
    np.add.at(crossing, ends, -1)
    least[np.cumsum(crossing)[: len(least)] > 0] = 0
    pad = np.zeros(SPAN - 1, np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), np.maximum)
    place = np.flatnonzero(most == keys)
    piece = np.searchsorted(ends, place, "right")
    text = np.array([p[0] for p in pieces])[piece]
    base = np.array([p[1] for p in pieces])[piece]
    spot = place - starts[piece] + base
    found = keys[place]
    if len(pieces) > len(texts):
        # Pieces of a long text overlap.
        order = np.lexsort((spot, text))
        text, spot, found = text[order], spot[order], found[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (spot[1:] != spot[:-1])
        text, spot, found = text[new], spot[new], found[new]
    return text, spot, found


def _runs(order_keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether each row of sorted columns differs from the one before it."""
    new = np.ones(len(order_keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in order_keys])
    return new


def _packed(*columns: np.ndarray) -> bytes:
    head = np.array([len(c.tobytes()) for c in columns], np.int64).tobytes()
    return bytes([len(columns)]) + head + b"".join(c.tobytes() for c in columns)


def _unpacked(blob: bytes, *kinds) -> list[np.ndarray]:
    count = blob[0]
    sizes = np.frombuffer(blob, np.int64, count, 1)
    at = 1 + 8 * count
    out = []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(blob[at : at + size], kind))
        at += size
    return out


def _squeezed(values: np.ndarray) -> np.ndarray:
    return np.frombuffer(zlib.compress(np.diff(values, prepend=0).tobytes(), 1), np.uint8)


def _stretched(values: np.ndarray) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(values.tobytes()), np.int64))


def _chunks(batch: pa.RecordBatch):
    """Slices of a batch of limited text, a row at least."""
    texts, rows, size = [], [], 0
    for i, value in enumerate(batch.column("text")):
        texts.append(value.as_py().encode("utf-8", "surrogatepass"))
        rows.append(i)
        size += len(texts[-1])
        if size >= CHUNK_BYTES:
            yield np.array(rows), texts
            texts, rows, size = [], [], 0
    if rows:
        yield np.array(rows), texts


def _deal_anchors(shards: int):
    """For each batch of rows and shard: anchor hashes to compare, and those settled within the batch."""

    def deal(batches):
        for batch in batches:
            batch = batch.filter(batch.column("copy").is_null())
            docs, found = [], []
            for rows, texts in _chunks(batch):
                text, _, hashes = anchors(texts)
                docs.append(rows[text])
                found.append(hashes)
            if not docs:
                continue
            doc, fp = np.concatenate(docs), np.concatenate(found)
            keys, marks = batch.column("key").to_numpy(), batch.column("mark").to_numpy()
            by_key = np.lexsort((marks, keys))
            rank = np.empty(len(keys), np.int64)
            rank[by_key] = np.arange(len(keys))
            keys, marks, doc = keys[by_key], marks[by_key], rank[doc]
            order = np.lexsort((doc, fp))
            fp, doc = fp[order], doc[order]
            new = _runs((fp, doc))
            fp, doc = fp[new], doc[new]
            # Of the documents of the batch with one anchor the first is compared; all are settled as having it in common.
            first = _runs((fp,))
            head = np.maximum.accumulate(np.where(first, np.arange(len(fp)), 0))
            later = keys[doc] > keys[doc[head]]
            settled = later.copy()
            settled[head[later]] = True
            shard = (fp % np.uint64(shards)).astype(np.int64)
            short = (fp >> np.uint64(32)).astype(np.uint32)
            parts = []
            for mask, to in ((~later, shard), (settled, (keys[doc] + marks[doc]) % shards)):
                at = np.flatnonzero(mask)
                at = at[np.lexsort((doc[at], to[at]))]
                bounds = np.searchsorted(to[at], np.arange(shards + 1))
                parts.append([at[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
            out = []
            for one, two in zip(*parts, strict=True):
                own, local = np.unique(np.concatenate([doc[one], doc[two]]), return_inverse=True)
                local = local.astype(np.uint32 if len(own) > 1 << 16 else np.uint16)
                out.append(_packed(_squeezed(keys[own]), marks[own], local[: len(one)], short[one], local[len(one) :], short[two], shard[two].astype(np.uint32)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(shards, dtype=np.int32)), pa.array(out, pa.binary())], ["shard", "blob"])

    return deal


def _shared_anchors(group: pd.DataFrame) -> pd.DataFrame:
    """(key, mark, fps) of the documents of a shard that share anchors with others."""
    shard = int(group["shard"].iloc[0])
    keys, marks, shorts, done = [], [], [], []
    for blob in group["blob"]:
        squeezed, own_marks, one, short, two, short_two, home = _unpacked(blob, np.uint8, np.int64, np.uint8, np.uint32, np.uint8, np.uint32, np.uint32)
        own = _stretched(squeezed)
        local_kind = np.uint32 if len(own) > 1 << 16 else np.uint16
        one, two = one.view(local_kind), two.view(local_kind)
        keys.append(own[one])
        marks.append(own_marks[one])
        shorts.append(short)
        done.append((own[two], own_marks[two], home.astype(np.int64) << 32 | short_two))
    keys, marks, shorts = np.concatenate(keys), np.concatenate(marks), np.concatenate(shorts)
    order = np.lexsort((keys, shorts))
    keys, marks, shorts = keys[order], marks[order], shorts[order]
    first = _runs((shorts,))
    head = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0)) if len(keys) else first.astype(np.int64)
    hit = keys > keys[head]
    hit[head[hit]] = True
    found = [(keys[hit], marks[hit], np.int64(shard) << 32 | shorts[hit].astype(np.int64)), *done]
    keys, marks, fps = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((fps, marks, keys))
    keys, marks, fps = keys[order], marks[order], fps[order]
    starts = np.flatnonzero(_runs((keys, marks)))
    ends = np.append(starts[1:], len(keys)) if len(starts) else starts
    return pd.DataFrame({"key": keys[starts], "mark": marks[starts], "fps": [fps[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]})


def _count_anchors(batches):
    for batch in batches:
        for _, texts in _chunks(batch):
            fp, n = np.unique(anchors(texts)[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(n.astype(np.int64))], ["fp", "n"])


def hot_anchors(rows: DataFrame, size: int, sample: int | None = None, hot: int | None = None) -> np.ndarray:
    """Anchor hashes of very many texts. Which they are changes no result, only where their strings are compared."""
    sample = sample or max(SAMPLE, -(-size // SAMPLE_BYTES))
    some = rows.filter(F.pmod(F.xxhash64(F.lit(2), "text"), F.lit(sample)) == 0).select("text")
    counts = some.mapInArrow(_count_anchors, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n"))
    found = counts.filter(F.col("n") >= (hot or HOT)).select("fp").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))


def _hot_strings(body: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context, offset, string) to compare of contexts of hot anchors, and the bits of each context settled here."""
    parts = []
    for start in range(0, len(body), BATCH):
        part = body[start : start + BATCH]
        span = np.arange(SPAN)
        of, at = np.nonzero((span >= part[:, -2:-1]) & (span <= part[:, -1:]))
        parts.append((of + start, at, _strings(part)[of, at]))
    of, at, string = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((key[of], string))
    of, at, string = of[order], at[order], string[order]
    head = np.maximum.accumulate(np.where(_runs((string,)), np.arange(len(of)), 0))
    later = key[of] > key[of[head]]
    bits = np.zeros(len(body), np.int64)
    np.bitwise_or.at(bits, of[later], np.int64(1) << at[later])
    return of[~later], at[~later], string[~later], bits


def _deal_contexts(shards: int, hot):
    """For each batch of rows and shard: the bytes around shared anchors, and the places settled within the batch.

    Of anchors that the broadcast array ``hot`` lists the strings are dealt out instead.
    """

    def deal(batches):
        for batch in batches:
            keys, marks = batch.column("key").to_numpy(), batch.column("mark").to_numpy()
            rows_of, places, around, homes, many = [], [], [], [], []
            for rows, texts in _chunks(batch):
                text, place, fp = anchors(texts)
                wanted = np.zeros(len(fp), bool)
                name = (fp % np.uint64(shards)).astype(np.int64) << 32 | (fp >> np.uint64(32)).astype(np.int64)
                bounds = np.searchsorted(text, np.arange(len(texts) + 1))
                for i, row in enumerate(rows):
                    lists = batch.column("fps")[int(row)].as_py()
                    a, b = bounds[i], bounds[i + 1]
                    wanted[a:b] = np.isin(name[a:b], np.frombuffer(b"".join(lists), np.int64))
                text, place, name, fp = text[wanted], place[wanted], name[wanted], fp[wanted]
                if not len(text):
                    continue
                left = LENGTH - KEY
                sizes = np.array([len(t) for t in texts])
                pad = bytes(AROUND)
                data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
                base = np.cumsum(sizes + AROUND) - sizes
                views = np.lib.stride_tricks.sliding_window_view(data, AROUND)[base[text] + place - left]
                low = np.maximum(0, left - place)
                high = np.minimum(SPAN - 1, sizes[text] - LENGTH - place + left)
                rows_of.append(rows[text])
                places.append(place)
                around.append(np.concatenate([views, low[:, None].astype(np.uint8), high[:, None].astype(np.uint8)], 1))
                homes.append(name >> 32)
                many.append(np.isin(fp, hot.value))
            if not rows_of:
                continue
            row, place, body, home = (np.concatenate(x) for x in (rows_of, places, around, homes))
            body = np.ascontiguousarray(body)
            hot_row, hot_place, bits = row[:0], place[:0], np.zeros(0, np.int64)
            of = at_of = np.zeros(0, np.int64)
            string = np.zeros(0, np.uint64)
            if len(at := np.flatnonzero(np.concatenate(many))):
                hot_row, hot_place = row[at], place[at]
                of, at_of, string, bits = _hot_strings(body[at], keys[hot_row])
                rest = ~np.concatenate(many)
                row, place, body, home = row[rest], place[rest], body[rest], home[rest]
            string_to = (string % np.uint64(shards)).astype(np.int64)
            by_shard = np.argsort(string_to, kind="stable")
            string_bounds = np.searchsorted(string_to[by_shard], np.arange(shards + 1))
            settled = np.flatnonzero(bits)
            settled_to = (keys[hot_row[settled]] + hot_place[settled]) % shards
            settled = settled[np.argsort(settled_to, kind="stable")]
            settled_bounds = np.searchsorted(np.sort(settled_to), np.arange(shards + 1))
            # Equal contexts: the first document is compared; in later ones every string of it is an earlier one's.
            whole = body.view(np.dtype((np.void, body.shape[1]))).ravel()
            _, code = np.unique(whole, return_inverse=True)
            key = keys[row]
            order = np.lexsort((key, code))
            first = _runs((code[order],))
            head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))] if len(order) else order
            later = np.zeros(len(order), bool)
            later[order] = key[order] > key[head]
            to = np.where(later, (key + place) % shards, home)
            order = np.lexsort((key, later, to))
            bounds = np.searchsorted(to[order], np.arange(shards + 1))
            out = []
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                at = order[a:b]
                done = settled[settled_bounds[k] : settled_bounds[k + 1]]
                sent = by_shard[string_bounds[k] : string_bounds[k + 1]]
                own = hot_row[of[sent]]
                one, two = at[~later[at]], at[later[at]]
                every = (np.int64(2) << body[two, -1].astype(np.int64)) - (np.int64(1) << body[two, -2].astype(np.int64))
                later_rows, later_places = np.concatenate([row[two], hot_row[done]]), np.concatenate([place[two], hot_place[done]])
                out.append(
                    _packed(
                        key[one], marks[row[one]], place[one].astype(np.int64), body[one],
                        keys[later_rows], marks[later_rows], later_places.astype(np.int64), np.concatenate([every, bits[done]]),
                        keys[own], marks[own], hot_place[of[sent]].astype(np.int64), at_of[sent].astype(np.uint8), string[sent],
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(shards, dtype=np.int32)), pa.array(out, pa.binary())], ["shard", "blob"])

    return deal


class IndexFamily:
    """Levels of sorted string fingerprints, each with the first document that has the string."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []

    def insert(self, strings: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Adds a batch, whose documents come after all before it; gives the first document of each string."""
        order = np.lexsort((keys, strings))
        new = _runs((strings[order],))
        suffixes, firsts = strings[order][new], keys[order][new]
        of = np.empty(len(strings), np.int64)
        of[order] = np.cumsum(new) - 1
        for _, level, owners in self.levels:
            at = np.minimum(np.searchsorted(level, suffixes), len(level) - 1)
            firsts = np.where(level[at] == suffixes, np.minimum(owners[at], firsts), firsts)
        rank, held, owners = 0, suffixes, firsts
        while self.levels and self.levels[-1][0] == rank:
            _, other, theirs = self.levels.pop()
            both, whose = np.concatenate([other, held]), np.concatenate([theirs, owners])
            order = np.lexsort((whose, both))
            new = _runs((both[order],))
            held, owners, rank = both[order][new], whose[order][new], rank + 1
        if len(held):
            self.levels.append((rank, held, owners))
        return firsts[of]


def _strings(body: np.ndarray) -> np.ndarray:
    """Fingerprints of the strings of ``LENGTH`` bytes in each row of contexts."""
    up, down = _POWERS.of(AROUND + 1)
    sums = np.zeros((len(body), AROUND + 1), np.uint64)
    np.cumsum(_BYTE[body[:, :AROUND]] * up[:AROUND], axis=1, out=sums[:, 1:])
    return _mix((sums[:, LENGTH:] - sums[:, :-LENGTH]) * down[:SPAN])


def _first_of_strings(key: np.ndarray, mark: np.ndarray, place: np.ndarray, at: np.ndarray, string: np.ndarray) -> tuple:
    """(key, mark, place, bits) of the strings that a smaller key has too."""
    order = np.lexsort((key, string))
    key, mark, place, at, string = (c[order] for c in (key, mark, place, at, string))
    head = np.maximum.accumulate(np.where(_runs((string,)), np.arange(len(key)), 0)) if len(key) else order
    hit = key > key[head]
    return key[hit], mark[hit], place[hit], np.int64(1) << at[hit].astype(np.int64)


def _matches(group: pd.DataFrame) -> pd.DataFrame:
    """(key, mark, hits) of the documents of a shard; hits: places and bit sets of matching strings there."""
    kinds = (np.int64, np.int64, np.int64, np.uint8) + (np.int64, np.int64, np.int64, np.int64) + (np.int64, np.int64, np.int64, np.uint8, np.uint64)
    parts = [_unpacked(blob, *kinds) for blob in group["blob"]]
    key, mark, place = (np.concatenate([p[i] for p in parts]) for i in range(3))
    body = np.concatenate([p[3].reshape(-1, AROUND + 2) for p in parts])
    order = np.argsort(key, kind="stable")
    key, mark, place, body = key[order], mark[order], place[order], body[order]
    index, bits = IndexFamily(), np.zeros(len(key), np.int64)
    start, span = 0, np.arange(SPAN)
    while start < len(key):
        # A batch ends where a document does.
        end = int(np.searchsorted(key, key[min(start + BATCH, len(key)) - 1], "right"))
        part = body[start:end]
        valid = (span >= part[:, -2:-1]) & (span <= part[:, -1:])
        row, at = np.nonzero(valid)
        owner = key[start:end][row]
        earlier = index.insert(_strings(part)[row, at], owner) < owner
        np.bitwise_or.at(bits, start + row[earlier], np.int64(1) << at[earlier])
        start = end
    hit = bits != 0
    found = [(key[hit], mark[hit], place[hit], bits[hit]), *(tuple(p[4:8]) for p in parts)]
    found.append(_first_of_strings(*(np.concatenate([p[i] for p in parts]) for i in range(8, 13))))
    key, mark, place, bits = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((place, mark, key))
    key, mark = key[order], mark[order]
    pairs = np.stack([place[order], bits[order]], 1)
    starts = np.flatnonzero(_runs((key, mark)))
    ends = np.append(starts[1:], len(key)) if len(starts) else starts
    return pd.DataFrame({"key": key[starts], "mark": mark[starts], "hits": [pairs[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]})


def covered(size: int, hits: list[bytes] | None, copy: bool) -> np.ndarray:
    """Whether each byte is to go."""
    if copy:
        return np.full(size, size >= LENGTH)
    change = np.zeros(size + 1, np.int64)
    if hits:
        place, bits = np.frombuffer(b"".join(hits), np.int64).reshape(-1, 2).T
        row, at = np.nonzero(bits[:, None] >> np.arange(SPAN) & 1)
        starts = np.unique(place[row] + at - (LENGTH - KEY))
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
    return np.cumsum(change)[:size] > 0


def _cut(batches):
    for batch in batches:
        numbers, kept = [], []
        texts, hits, copies = (batch.column(n) for n in ("text", "hits", "copy"))
        for text, hit, copy in zip(texts, hits, copies, strict=True):
            data = text.as_py().encode("utf-8", "surrogatepass")
            gone = covered(len(data), hit.as_py(), bool(copy.as_py()))
            edges = np.diff(gone.astype(np.int8), prepend=0)
            numbers.append((len(data), int(gone.sum()), int((edges == 1).sum())))
            left = data if not numbers[-1][1] else np.frombuffer(data, np.uint8)[~gone].tobytes()
            kept.append(left)
        columns = [pa.array([n[i] for n in numbers], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), *columns, pa.array(kept, pa.binary())], ["key", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int | None = None, hot: int | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of each row; ``kept`` is what remains, as bytes."""
    rows = df.select(id_or_last(F.col(id_col)).alias("key"), text_or_empty(F.col(text_col)).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(SHARDS, -(-size // SHARD_BYTES))
    hot = rows.sparkSession.sparkContext.broadcast(hot_anchors(rows, size, sample, hot))
    # Rows of one id are told apart by 64 bits of their text.
    rows = rows.withColumn("mark", F.xxhash64(F.lit(3), "text"))
    own = ["key", "mark"]
    # All texts are dealt out by document once; anchors, contexts and cuts read the same exchange.
    docs = rows.repartition(*own)

    names = rows.select(*own, F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    firsts = names.groupBy("a", "b").agg(F.min("key").alias("first"))
    copies = names.join(firsts, ["a", "b"]).filter("key > first").select(*own).distinct().withColumn("copy", F.lit(True))

    known = docs.join(copies.hint("shuffle_hash"), own, "left").select(*own, "text", "copy")
    dealt = known.mapInArrow(_deal_anchors(shards), "shard int, blob binary")
    shared = dealt.groupBy("shard").applyInPandas(_shared_anchors, "key long, mark long, fps binary")
    wanted = shared.groupBy(*own).agg(F.collect_list("fps").alias("fps"))
    around = docs.join(wanted.hint("shuffle_hash"), own).mapInArrow(_deal_contexts(shards, hot), "shard int, blob binary")
    hits = around.groupBy("shard").applyInPandas(_matches, "key long, mark long, hits binary").groupBy(*own).agg(F.collect_list("hits").alias("hits"))
    joined = docs.join(hits.hint("shuffle_hash"), own, "left").join(copies.hint("shuffle_hash"), own, "left")
    cut = joined.select("key", "text", "hits", "copy").mapInArrow(_cut, "key long, n_bytes long, n_removed long, n_spans long, kept binary")
    return cut.select(F.when(F.col("key") != LAST_ID, F.col("key")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {LAST_ID}) AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, k, unnest(range(len(h) // 2 - {LENGTH - 1})) AS i, h FROM d WHERE len(h) >= {2 * LENGTH}),
s AS (SELECT r, k, i, hash(h[2 * i + 1 : 2 * i + {2 * LENGTH}]) AS x FROM w),
f AS (SELECT x, min(k) AS first FROM s GROUP BY x),
m AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM s JOIN f USING (x) WHERE s.k > f.first),
g AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM m),
c AS (SELECT r, min(i) AS a, max(i) + {LENGTH} AS b FROM g GROUP BY r, run),
z AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS prev FROM c),
t AS (SELECT z.r, count(*) AS n, sum(b - a) AS gone, string_agg(h[2 * prev + 1 : 2 * a], '' ORDER BY a) AS kept, max(b) AS last FROM z JOIN d USING (r) GROUP BY z.r)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans,
    sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept || h[2 * last + 1 :] END)) AS kept_sha256 FROM d LEFT JOIN t USING (r)
"""
