"""Text features: grams of the texts of a row as a sparse vector over an exact vocabulary."""

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURE_TEXTS
from ..session import materialize
from .ranking import stored_numbers

# The functions of the groups travel to the tasks by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("words", "trigrams")

# Characters of the texts of a group, and the least number of groups.
CHARACTERS, LEAST_GROUPS = 2_000_000, 16


def gram_columns(column: str) -> dict[str, str]:
    """SQL for the word and the character trigram array of a text column."""
    text = f"lower(coalesce(`{column}`, ''))"
    return {
        "words": f"filter(split({text}, ' '), w -> w <> '')",
        "trigrams": f"regexp_extract_all({text}, '(?s)(?=(...))', 1)",
    }


def gram_rows(rows: DataFrame, columns=FEATURE_TEXTS, key: str = "File") -> DataFrame:
    """(key, name, kind, gram): a row for each gram of each text column."""
    blocks = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.expr(sql).alias("grams"))
            for name in columns
            for kind, sql in gram_columns(name).items()
        ]
    )
    found = rows.select(key, F.inline(blocks))
    return found.select(key, "name", "kind", F.explode("grams").alias("gram"))


def text_key(columns=FEATURE_TEXTS) -> Column:
    """128 bits that stand for the texts of a row; null and empty are the same."""
    text = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("\n", *(F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in text)))


def distinct_texts(rows: DataFrame, columns=FEATURE_TEXTS) -> DataFrame:
    """(row, key, weight, texts): rows of equal texts once, with their number, stored.

    Copies are counted before the shuffle, so a text that most rows share is no
    hot key here, and it is one row in all that follows.
    """
    plain = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]
    counted = rows.select(*plain).groupBy(*columns).agg(F.count(F.lit(1)).alias("weight"))
    return materialize(
        counted.select(F.monotonically_increasing_id().alias("row"), text_key(columns).alias("key"), "weight", *columns),
        "distinct-texts",
    )


def _dealt(texts: DataFrame, columns) -> DataFrame:
    """(group, row, key, weight, lower-case texts): ``texts`` in groups of a bounded number of characters.

    Groups are dealt by a hash of the row, so they are the same each time.
    """
    size = texts.agg(F.sum(sum((F.length(c) for c in columns), F.lit(0)))).first()[0] or 0
    groups = max(LEAST_GROUPS, math.ceil(size / CHARACTERS))
    lowered = [F.lower(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in columns]
    group = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group")
    return texts.select(group, "row", "key", "weight", *lowered).repartition(4 * groups, "group")


def _word_counts(texts: list[str]):
    """(grams, of, gram, n): the different words, and of each row and word its number there."""
    known: dict[str, int] = {}
    of, gram = [], []
    for i, text in enumerate(texts):
        words = [w for w in text.split(" ") if w]
        gram += [known.setdefault(w, len(known)) for w in words]
        of += [i] * len(words)
    return list(known), *_pair_counts(np.array(of, np.int64), np.array(gram, np.int64), len(known))


def _trigram_counts(texts: list[str]):
    """The same of the runs of three characters; one of them is 63 bits, so no two are taken for one another."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    if len(codes) < 3:
        return [], *(np.zeros(0, np.int64) for _ in range(3))
    of = np.repeat(np.arange(len(texts)), lengths)
    within = of[:-2] == of[2:]
    runs = ((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:])[within]
    known, gram = np.unique(runs, return_inverse=True)
    letters = np.stack([known >> 42, (known >> 21) & 0x1FFFFF, known & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    return [letters[i:i + 3] for i in range(0, len(letters), 3)], *_pair_counts(of[:-2][within], gram, len(known))


def _pair_counts(of: np.ndarray, gram: np.ndarray, many: int):
    pairs, n = np.unique(of * max(many, 1) + gram, return_counts=True)
    return pairs // max(many, 1), pairs % max(many, 1), n


def _blocks(table: pa.Table, columns):
    """(terms, of, gram, n) of each column and kind of a group's rows; terms are as in the vocabulary."""
    for name in columns:
        texts = table.column(name).to_pylist()
        for kind, count in zip(KINDS, (_word_counts, _trigram_counts)):
            grams, of, gram, n = count(texts)
            start = f"{name}:{kind}:"
            yield [start + g for g in grams], of, gram, n


def counted_grams(texts: DataFrame, columns=FEATURE_TEXTS) -> DataFrame:
    """(group, term, rows): the different grams of each group of rows, and how many of its rows hold them.

    The grams of a row are counted in the task that has its text: there is no row for
    each gram of a text, only one for each group and gram.
    """
    columns = list(columns)

    def each(table: pa.Table) -> pa.Table:
        terms, rows = [], []
        for found, _, gram, _ in _blocks(table, columns):
            terms += found
            rows.append(np.bincount(gram, minlength=len(found)))
        group = np.full(len(terms), table.column("group")[0].as_py())
        return pa.table({"group": pa.array(group, pa.int32()), "term": pa.array(terms, pa.string()), "rows": np.concatenate(rows).astype(np.int64)})

    return _dealt(texts, columns).groupBy("group").applyInArrow(each, "group int, term string, rows bigint")


def vocabulary(counted: DataFrame) -> DataFrame:
    """(term, rows, slot): every distinct gram of each column with a slot of its own.

    Slots come from one sort by ranges and the row counts of its partitions: no
    gram reaches the driver, none shares a slot, and their number has no bound.
    """
    terms = counted.groupBy("term").agg(F.sum("rows").alias("rows"))
    return stored_numbers(terms, [], ["term"], "slot", "vocabulary", start=0)


def vectors(texts: DataFrame, counted: DataFrame, terms: DataFrame, columns=FEATURE_TEXTS) -> DataFrame:
    """(row, key, weight, slots, values) of each row of ``texts``, stored.

    Counts of a column's grams of one kind are scaled to length one; the blocks
    stand side by side, as each has its own slots. Grams outside of ``terms`` are
    left out first. Slots ascend. A group of rows gets the slots of its own grams, so
    what moves is a row for each group and gram.
    """
    columns = list(columns)
    # A term stands once in a group, so none is a hot key.
    placed = counted.select("group", "term").join(terms.select("term", "slot").hint("shuffle_hash"), "term")

    def each(rows: pa.Table, known: pa.Table) -> pa.Table:
        slot_of = dict(zip(known.column("term").to_pylist(), known.column("slot").to_pylist()))
        held = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        for found, of, gram, n in _blocks(rows, columns):
            slots = np.array([slot_of.get(t, -1) for t in found], np.int64)[gram] if found else gram
            inside = slots >= 0
            slots, of, n = slots[inside], of[inside], n[inside].astype(np.float64)
            length = np.sqrt(np.bincount(of, weights=n * n, minlength=rows.num_rows))
            for list_, array in zip(held, (of, slots, n / length[of])):
                list_.append(array)
        of, slots, values = map(np.concatenate, held)
        order = np.lexsort((slots, of))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows.num_rows))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (slots, values)]
        return pa.table([rows.column("row"), rows.column("key"), rows.column("weight"), *lists], names=["row", "key", "weight", "slots", "values"])

    groups = _dealt(texts, columns).groupBy("group").cogroup(placed.groupBy("group"))
    return materialize(groups.applyInArrow(each, "row bigint, key string, weight bigint, slots array<bigint>, values array<double>"), "vectors", "zstd")
