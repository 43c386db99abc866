"""Repair of the structure of conversations by depth-first branch and bound.

A conversation has a good structure if the initials of its roles read ``(s?(ua)+)?``. A row may be kept (cost 0), given the
role user or assistant (3) or deleted (4, the only choice for blank and duplicate rows); rows of empty text may be put in
anywhere (3); a truncated row that stays adds 3. Wanted are the cheapest edits, of equally cheap ones those whose initials
are least in ASCII order.

``search`` goes through the edits of a run of rows depth first, on a stack of its own. A lower bound for what the rows left
cost, for each state of the pattern, cuts off prefixes that cannot beat the incumbent (cost, audit); a table for each row
and state cuts off prefixes where another came as cheap and earlier in ASCII order; what is left when the stack is empty
is proved to be best. The bound comes from the rows backwards without their audits and is tight, so a dive goes straight. Audits of one cost at one row are never prefixes of each other, as each insertion costs, so
comparing (cost, audit) of prefixes decides for all of their completions, and best ways through runs add up to best ways.

So a long conversation is searched in runs of at most ``RUN`` rows, in many tasks: each run tells the best way from every
state to every other, and only these tables meet in the task of a conversation. Rows are ordered by one sort by ranges, and
runs never span partitions of it, so a conversation with most of the rows is spread as well. Its repaired text is hashed in
a stream over sorted rows: one hash over all the text of a conversation is serial by its nature, but it holds one batch.

Nulls: a null role or text is one space, a null turn sorts first, rows of null conversation are one conversation. Ties:
rows of equal turn are taken by role, then text. Repeated rows are duplicates. An empty text is blank. A very long text
is a row like any other. An empty table gives no rows. Only the named columns are read. The audit of a conversation is one
value, so a conversation has 2^31 rows at most.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import stored
from topicloom.llm.merkle import sql_crc32

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Fixed value: characters that make no word.
SPACES = " \t\n\x0b\f\r"
#: Rows of a run at most, a divisor of 2^33.
RUN = 2048

#: Runs whose tables a task keeps.
KNOWN = 4096

# States: nothing yet, after the system row, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)


def step(state: int, initial: str) -> int | None:
    """The state after a row, or None where the pattern has no such row."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def edits(state: int, code: str | None):
    """(letter, cost, next state) of the edits in a state, in ASCII order; ``code`` is the row to come, if any.

    A code is ``x`` for a row that must go, else the initial of the role (``o`` if no pattern has it), upper-case if the
    text is truncated.
    """
    turn = ASSISTANT if state == USER else USER
    if code is not None:
        yield "D", DELETE, state
    yield "I", INSERT, turn
    if code is not None and code != "x":
        extra = TRUNCATED if code.isupper() else 0
        after = step(state, code.lower())
        if after is not None:
            yield "K", extra, after
        yield "R", REROLE + extra, turn


def lower_bounds(codes: str, ends: tuple[int, ...]) -> list[list[float]]:
    """For each row and state a bound below the cost of the rows from there on: the cheapest way without its audit."""
    endless = float("inf")

    def inserted(costs, code):
        # Two insertions lead from a state to itself at most.
        for _ in range(2):
            costs = [min(costs[s], *(cost + costs[to] for letter, cost, to in edits(s, code) if letter == "I")) for s in range(4)]
        return costs

    bounds = [inserted([0 if s in ends else endless for s in range(4)], None)]
    for code in reversed(codes):
        after = bounds[-1]
        bounds.append(inserted([min(cost + after[to] for letter, cost, to in edits(s, code) if letter != "I") for s in range(4)], code))
    return bounds[::-1]


def search(codes: str, start: int, ends: tuple[int, ...], bounds: list[list[float]] | None = None) -> tuple[int, str, int] | None:
    """(cost, audit, last state) of the best edits that lead from ``start`` to one of ``ends``."""
    bounds = bounds or lower_bounds(codes, ends)
    if bounds[0][start] == float("inf"):
        return None
    best, came = None, {}
    # The stack holds each prefix as a link to the prefix before it.
    stack = [(0, start, 0, None)]
    while stack:
        at, state, cost, link = stack.pop()
        # Of edits with one bound the least in ASCII order is tried first, so what comes later must be cheaper.
        if best is not None and cost + bounds[at][state] >= best[0]:
            continue
        if came.get((at, state), cost + 1) <= cost:
            continue
        came[at, state] = cost
        if at == len(codes) and state in ends:
            best = (cost, link, state)
            continue
        ways = []
        for letter, more, to in edits(state, codes[at] if at < len(codes) else None):
            below = at if letter == "I" else at + 1
            ways.append((cost + more + bounds[below][to], letter, below, to, cost + more))
        stack += [(below, to, paid, (link, letter)) for _, letter, below, to, paid in sorted(ways, reverse=True)]
    cost, link, state = best
    letters = []
    while link:
        link, letter = link
        letters.append(letter)
    return cost, "".join(reversed(letters)), state


def run_table(codes: str, first: bool, last: bool) -> list[dict]:
    """The best way through a run from each state it may begin in to each it may end in."""
    table = []
    for end in ENDS if last else range(4):
        bounds = lower_bounds(codes, (end,))
        for start in (START,) if first else range(4):
            if found := search(codes, start, (end,), bounds):
                table.append({"start": start, "end": end, "cost": found[0], "audit": found[1]})
    return table


def short_forms(audits: dict[int, str]) -> dict[int, str]:
    """Short texts in the order of ``audits``, also after more letters are added to both.

    An audit that begins with another one keeps what it has beyond it; else the place in the order is enough.
    """
    roots: list[str] = []
    forms = {}
    for state, audit in sorted(audits.items(), key=lambda x: x[1]):
        if not roots or not audit.startswith(roots[-1]):
            roots.append(audit)
        forms[state] = chr(ord("A") + len(roots)) + audit[len(roots[-1]):]
    return forms


def chained(tables: list[list[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """The best way through consecutive runs: its cost, and the state and audit with which each run begins."""
    here: dict[int, tuple] = {START: (0, "", None)}
    for table in tables:
        reached: dict[int, tuple] = {}
        for way in table:
            if way["start"] in here:
                cost, form, link = here[way["start"]]
                found = (cost + way["cost"], form + way["audit"], (link, way["start"], way["audit"]))
                if way["end"] not in reached or found[:2] < reached[way["end"]][:2]:
                    reached[way["end"]] = found
        forms = short_forms({state: found[1] for state, found in reached.items()})
        here = {state: (cost, forms[state], link) for state, (cost, _, link) in reached.items()}
    cost, _, link = min((here[s] for s in ENDS if s in here), key=lambda x: x[:2])
    ways = []
    while link:
        link, start, audit = link
        ways.append((start, audit))
    return cost, ways[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with rows dropped, emptied, cut, repeated and given another role, by their CRC-32."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", "role", "text", F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("hit"))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(F.col("hit") == 4, "user").otherwise(role)
    times = F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))).drop("col")


def _key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def ordered(rows: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text, place, run): rows by conversation, turn, role and text, stored once."""
    kept = rows.select(_key(F.col("conv_id")).alias("conv"), "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    placed = kept.orderBy("conv", F.col("turn").asc_nulls_first(), "role", "text").withColumn("place", F.monotonically_increasing_id())
    return stored(placed.withColumn("run", F.call_function("div", F.col("place"), F.lit(RUN))), "ordered-turns")


def faults(rows: DataFrame) -> DataFrame:
    """(conv, run, place, turn, initial, fault) of :func:`ordered` rows; fault is blank, duplicate, truncated or null."""
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    bare = F.rtrim("text", F.lit(SPACES))
    slim = rows.select(
        "conv", "run", "place", "turn", F.substring("role", 1, 1).alias("initial"), said.alias("said"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    slim = stored(slim, "turn-faults")
    # The first place of each text is one row, so the join by place is even where a text is everywhere.
    firsts = slim.groupBy("conv", "said").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    joined = slim.join(firsts, "place", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("open"), "truncated")
    return joined.select("conv", "run", "place", "turn", "initial", fault.alias("fault"))


_LEGAL = {"su", "ua", "au"}
_WAYS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_WAYS_SQL = "array<struct<start:int,end:int,cost:bigint,audit:string>>"


def searched(found: DataFrame) -> DataFrame:
    """(conv, run, first, last, illegal, ways) of each run: initials at its ends, bad neighbours, and the best ways."""
    initial, fault = F.col("initial"), F.col("fault")
    code = F.when(fault.isin("blank", "duplicate"), "x").when(initial.isin("s", "u", "a"), F.when(fault == "truncated", F.upper(initial)).otherwise(initial))
    code = F.coalesce(code, F.when(fault == "truncated", "O").otherwise("o"))
    rows = F.sort_array(F.collect_list(F.struct("place", initial.alias("initial"), code.alias("code"))))
    runs = found.groupBy("conv", "run").agg(rows.alias("rows"))
    ends = found.groupBy("conv").agg(F.min("run").alias("low"), F.max("run").alias("high"))
    runs = runs.join(ends, "conv").select(
        "conv", "run", F.transform("rows", lambda r: r["initial"]).alias("initials"), F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes"),
        (F.col("run") == F.col("low")).alias("first"), (F.col("run") == F.col("high")).alias("last"),
    )

    def solve(batches):
        known = {}
        for batch in batches:
            first, last, illegal, ways = [], [], [], []
            for row in batch.to_pylist():
                names = row["initials"]
                first.append(names[0])
                last.append(names[-1])
                illegal.append(sum(a + b not in _LEGAL for a, b in zip(names, names[1:])))
                # Short conversations are much alike.
                key = (row["codes"], row["first"], row["last"])
                if key not in known:
                    if len(known) >= KNOWN:
                        known.clear()
                    known[key] = run_table(*key)
                ways.append(known[key])
            columns = [batch.column("conv"), batch.column("run"), pa.array(first, pa.string()), pa.array(last, pa.string()), pa.array(illegal, pa.int64()), pa.array(ways, _WAYS)]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "run", "first", "last", "illegal", "ways"])

    return runs.mapInArrow(solve, f"conv string, run bigint, first string, last string, illegal bigint, ways {_WAYS_SQL}")


def decided(tables: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit, runs) of each conversation; runs: (run, start, audit) of its part of the audit."""
    runs = F.sort_array(F.collect_list(F.struct("run", "first", "last", "illegal", "ways")))
    whole = tables.groupBy("conv").agg(runs.alias("runs"))
    parts = pa.list_(pa.struct([("run", pa.int64()), ("start", pa.int32()), ("audit", pa.string())]))

    def choose(batches):
        for batch in batches:
            illegal, costs, audits, ways = [], [], [], []
            for row in batch.column("runs").to_pylist():
                cost, found = chained([r["ways"] for r in row])
                between = sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(row, row[1:]))
                illegal.append(between + sum(r["illegal"] for r in row))
                costs.append(cost)
                audits.append("".join(audit for _, audit in found))
                ways.append([{"run": r["run"], "start": start, "audit": audit} for r, (start, audit) in zip(row, found)])
            columns = [batch.column("conv"), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(ways, parts)]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "illegal", "cost", "audit", "runs"])

    return whole.mapInArrow(choose, "conv string, illegal bigint, cost bigint, audit string, runs array<struct<run:bigint,start:int,audit:string>>")


def applied(codes_places: list[int], start: int, audit: str, initials: list[str]):
    """(place, roles put in before, role or None if kept, deleted, roles put in after) of each row of a run."""
    state, before, out = start, [], []
    row = 0
    for letter in audit:
        turn = ASSISTANT if state == USER else USER
        name = "assistant" if turn == ASSISTANT else "user"
        if letter == "I":
            before.append(name)
            state = turn
            continue
        if letter == "K":
            state = step(state, initials[row])
        elif letter == "R":
            state = turn
        out.append((codes_places[row], before, name if letter == "R" else None, letter == "D", []))
        before, row = [], row + 1
    if before:
        # A run has a row at least, so what is put in last stands after its last row.
        out[-1][4].extend(before)
    return out


_EDIT = "place bigint, put_before array<string>, new_role string, gone boolean, put_after array<string>"


def edits_of_rows(found: DataFrame, choices: DataFrame) -> DataFrame:
    """(conv, place, put_before, new_role, gone, put_after) of each row."""
    rows = F.sort_array(F.collect_list(F.struct("place", "initial")))
    runs = found.groupBy("conv", "run").agg(rows.alias("rows"))
    parts = choices.select("conv", F.inline("runs")).select("conv", "run", "start", "audit")
    joined = runs.join(parts, ["conv", "run"])

    def each(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                rows = row["rows"]
                for place, before, role, gone, after in applied([r["place"] for r in rows], row["start"], row["audit"], [r["initial"] for r in rows]):
                    out.append({"conv": row["conv"], "place": place, "put_before": before, "new_role": role, "gone": gone, "put_after": after})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("conv", pa.string()), ("place", pa.int64()), ("put_before", pa.list_(pa.string())), ("new_role", pa.string()), ("gone", pa.bool_()), ("put_after", pa.list_(pa.string())),
            ]))

    return joined.mapInArrow(each, f"conv string, {_EDIT}")


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, place, at, role, text): the rows of the repaired conversations; order by conv, place, at."""
    kept = rows.select("conv", "place", "role", "text").join(edits.drop("conv"), "place")

    def put(roles, offset):
        return F.transform(roles, lambda r, i: F.struct((i + offset).cast("int").alias("at"), r.alias("role"), F.lit("").alias("text")))

    own = F.struct(F.lit(0).alias("at"), F.coalesce("new_role", "role").alias("role"), F.col("text"))
    # Insertions come in twos at most before a row and after the last one.
    lines = F.concat(put(F.col("put_before"), -2), F.when(F.col("gone"), F.array().cast("array<struct<at:int,role:string,text:string>>")).otherwise(F.array(own)), put(F.col("put_after"), 1))
    return kept.select("conv", "place", F.inline(lines))


def text_digests(lines: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): the hash of the lines ``role:text`` of a conversation, joined by line breaks."""
    spread = lines.select("conv", "place", "at", F.concat("role", F.lit(":"), "text").alias("line"))
    spread = spread.repartition("conv").sortWithinPartitions("conv", "place", "at")

    def hashed(batches):
        conv, state, done = None, None, []
        for batch in batches:
            names, texts = batch.column("conv").to_pylist(), batch.column("line").to_pylist()
            for name, text in zip(names, texts):
                if state is not None and name == conv:
                    state.update(b"\n")
                else:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = name, hashlib.sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.string()), pa.array([d for _, d in done], pa.string())], ["conv", "repaired_sha256"])
            done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([state.hexdigest()], pa.string())], ["conv", "repaired_sha256"])

    return spread.mapInArrow(hashed, "conv string, repaired_sha256 string")


def counted(found: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated) of each conversation."""
    # Equal turns of a conversation meet once for each map task, so that a turn shared by all its rows is no hot key.
    turns = found.filter("turn IS NOT NULL").select("conv", "turn").distinct().groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    kinds = found.groupBy("conv").agg(*(F.count_if(F.col("fault") == kind).alias(kind) for kind in ("blank", "duplicate", "truncated")))
    return kinds.join(turns, "conv", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row for each conversation of (conv_id, turn, role, text), and the rows of the repaired conversations.

    The first: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. The second: conv, place, at, role, text.
    """
    rows = ordered(conversations)
    found = stored(faults(rows), "faults")
    choices = stored(decided(searched(found)), "edits-of-conversations")
    lines = repaired_rows(rows, edits_of_rows(found, choices))
    return counted(found).join(choices.drop("runs"), "conv"), lines


def repair_digest(conversations: DataFrame) -> DataFrame:
    """A row for each conversation of the table, damaged and repaired."""
    convs = conversations.select("conv_id").distinct().withColumn("conv", _key(F.col("conv_id")))
    report, lines = repair(damaged(conversations))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = convs.join(report, "conv", "left").join(text_digests(lines), "conv", "left")
    return joined.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# The same by dynamic programming: for each row and state the best way so far, with its repaired lines.
_SQL_GAPS = " || ".join(f"chr({ord(c)})" for c in SPACES)
_SQL_LAST = "right(rtrim(text, (" + _SQL_GAPS + ")), 1)"
SQL = f"""
WITH RECURSIVE hits AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {sql_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS hit FROM conversations),
damage AS (SELECT coalesce('=' || conv_id, '') AS conv, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
        CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hits),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
        row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, {_SQL_LAST} AS tail, left(role, 1) AS initial FROM damage),
faulty AS MATERIALIZED (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS bad FROM placed),
put(state, after, price, letters, added) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 3, 'I', 'u'), (1, 2, 3, 'I', 'u'), (2, 3, 3, 'I', 'a'), (3, 2, 3, 'I', 'u'),
    (0, 3, 6, 'II', 'ua'), (1, 3, 6, 'II', 'ua'), (2, 2, 6, 'II', 'au'), (3, 3, 6, 'II', 'ua')),
spelled AS (SELECT state, after, {INSERT} * length(letters) AS price, letters, replace(replace(added, 'u', 'user:' || chr(10)), 'a' , '@') AS half FROM put),
inserted AS (SELECT state, after, price, letters, replace(half, '@', 'assistant:' || chr(10)) AS added FROM spelled),
edit(letter) AS (VALUES ('D'), ('K'), ('R')),
ways AS (SELECT DISTINCT conv, 0::BIGINT AS pos, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM faulty
    UNION ALL SELECT conv, pos, state, best.cost, best.audit, best.lines FROM (SELECT conv, pos, state, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS best FROM
        (SELECT r.conv, r.pos,
            CASE WHEN letter = 'D' THEN i.after WHEN letter = 'K' AND r.initial = 's' THEN 1 WHEN i.after = 2 THEN 3 ELSE 2 END AS state,
            w.cost + i.price + CASE letter WHEN 'D' THEN {DELETE} WHEN 'R' THEN {REROLE} ELSE 0 END + CASE WHEN letter <> 'D' AND r.fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS cost,
            w.audit || i.letters || letter AS audit,
            w.lines || i.added || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN r.role || ':' || r.text || chr(10)
                ELSE CASE WHEN i.after = 2 THEN 'assistant:' ELSE 'user:' END || r.text || chr(10) END AS lines
        FROM ways w JOIN faulty r ON r.conv = w.conv AND r.pos = w.pos + 1 JOIN inserted i ON i.state = w.state CROSS JOIN edit
        WHERE letter = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (letter = 'R'
            OR (r.initial = 's' AND i.after = 0) OR (r.initial = 'u' AND i.after <> 2) OR (r.initial = 'a' AND i.after = 2))))
        GROUP BY conv, pos, state)),
counts AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal FROM faulty GROUP BY conv),
ends AS (SELECT w.conv, min({{'cost': w.cost + i.price, 'audit': w.audit || i.letters, 'lines': w.lines || i.added}}) AS best
    FROM ways w JOIN counts c ON c.conv = w.conv AND c.n = w.pos JOIN inserted i ON i.state = w.state WHERE i.after IN (0, 3) GROUP BY w.conv)
SELECT k.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
    coalesce(c.illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit,
    sha256(coalesce(left(e.best.lines, greatest(length(e.best.lines) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations) k LEFT JOIN counts c USING (conv) LEFT JOIN ends e USING (conv)
"""
