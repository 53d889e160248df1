"""Cheapest repair of conversations, by rank-convergence parallel Viterbi.

A conversation is repaired by keeping, reroling, deleting and inserting turns until its
role initials read ``(s?(ua)+)?``. The states of that pattern and one turn after the other
make a shortest path. Turns are numbered by one range sort and cut into chunks of at most
``CHUNK``, also those of one conversation; a chunk is a short text of one letter per turn, and
all later steps run on chunks until the repaired texts are put together.

Every chunk computes costs backwards, from its end to its start, and starts from a guess
(all states alike) unless it ends the conversation. A fix-up pass gives each chunk the vector
its successor came to; a chunk that started from another one runs again, beside its earlier
run, and stops where both differ by a constant only, since everything before is then the same
but for that constant. Passes end when no chunk is given a new vector. Chunks that hold only
turns to delete pass every vector on unchanged, so the chain goes around them. Costs to the end
are then known everywhere, and the trace takes in each state the edit least in ASCII
among the cheapest: each chunk says in which state it is left for each state it may be
entered in, one scan over chunks gives the entries, and chunks are traced again from those.

The scan over the chunks of a conversation and the hash of its repaired text are sequential;
both stream through one task with one state at a time, on a letter per turn and on the
texts. Fix-up passes are as many as chunks in a row whose vectors do not meet, mostly one.

Null conv_id: a conversation of its own. Null role or text: one space. Null turn: before the
others. Equal turns: by the first 64 characters of role and text, then by digest. Initials
are first characters, upper case ones and others fit nowhere; a turn with an empty role adds
no initial. Repeated rows: later ones are duplicates. Empty table: no rows. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchboard.llm.prefix_trie import digest
from matchboard.sources.staging import stage

CHUNK = 1024
SPACES = " \t\n\x0b\x0c\r"
NONE = " "  # stands for a null

# States: nothing yet, after s, after u, after a. Letters of initials: s, u, a, none, other.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
WANTED = (USER, USER, ASSISTANT, USER)  # the state after the one user or assistant turn that fits
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# Kinds of turns, added to four times the initial and written as a letter from "a" on.
WHOLE, CUT, BLANK, COPY = range(4)
GUESS = (0, 0, 0, 0)


def _closed(costs: list[int]) -> list[int]:
    """Costs when turns may be inserted first; more than two never pay."""
    once = [INSERT + costs[WANTED[s]] for s in range(4)]
    twice = [2 * INSERT + costs[WANTED[WANTED[s]]] for s in range(4)]
    return [min(x) for x in zip(costs, once, twice)]


END = tuple(_closed([0, 99, 99, 0]))
_before: dict[tuple, tuple] = {}
_edits: dict[tuple, tuple] = {}


def before(after: tuple, letter: str) -> tuple[tuple, int]:
    """Costs before a turn, less their least, and that least; ``after`` has 0 as its least."""
    known = _before.get((after, letter))
    if known is None:
        initial, kind = divmod(ord(letter) - 97, 4)
        costs = []
        for state in range(4):
            options = [DELETE + after[state]]
            if kind in (WHOLE, CUT):
                options.append(REROLE + kind * TRUNCATED + after[WANTED[state]])
                kept = state if initial == 3 else STEPS.get((state, initial))
                if kept is not None:
                    options.append(KEEP + kind * TRUNCATED + after[kept])
            costs.append(min(options))
        costs = _closed(costs)
        known = tuple(c - min(costs) for c in costs), min(costs)
        _before[after, letter] = known
    return known


def edits(after: tuple, letter: str, state: int) -> tuple[str, int, int]:
    """Plan of one turn, the state after it and the cost: cheapest, then least in ASCII.

    Plans are written u or a for a turn inserted, D, K, and U or A for one reroled.
    """
    known = _edits.get((after, letter, state))
    if known is None:
        costs, least = before(after, letter)
        initial, kind = divmod(ord(letter) - 97, 4)
        plan, spent, at = "", 0, state
        while known is None:
            left = costs[at] + least
            kept = at if initial == 3 else STEPS.get((at, initial))
            extra = kind * TRUNCATED
            if DELETE + after[at] == left:
                known = plan + "D", at, spent + DELETE
            elif INSERT + costs[WANTED[at]] + least == left:
                at, spent = WANTED[at], spent + INSERT
                plan += "u" if at == USER else "a"
            elif kept is not None and KEEP + extra + after[kept] == left:
                known = plan + "K", kept, spent + KEEP + extra
            else:
                at = WANTED[at]
                known = plan + ("U" if at == USER else "A"), at, spent + REROLE + extra
        _edits[after, letter, state] = known
    return known


def closing(state: int) -> tuple[str, int]:
    """Turns inserted after the last one, and their cost."""
    plan = ""
    while END[state]:
        state = WANTED[state]
        plan += "u" if state == USER else "a"
    return plan, INSERT * len(plan)


def backward(codes: str, end: tuple) -> list[tuple]:
    """Cost vectors after each turn of a chunk, and before the first one (in front)."""
    out = [end]
    for letter in reversed(codes):
        out.append(before(out[-1], letter)[0])
    return out[::-1]


def fixed_up(codes: str, old: tuple, new: tuple, start: tuple) -> tuple:
    """The vector before a chunk that now ends with ``new``; ``start`` was it with ``old``."""
    for letter in reversed(codes):
        if old == new:
            return start
        old, new = before(old, letter)[0], before(new, letter)[0]
    return new


def trace(codes: str, end: tuple, last: bool, state: int) -> tuple[str, int, int]:
    """Plan, state at the end and cost of a chunk entered in a state."""
    plan, spent = [], 0
    for letter, after in zip(codes, backward(codes, end)[1:]):
        piece, state, cost = edits(after, letter, state)
        plan.append(piece)
        spent += cost
    if last:
        piece, cost = closing(state)
        plan.append(piece)
        spent += cost
    return "".join(plan), state, spent


def _vector(text: str) -> tuple:
    return tuple(map(int, text.split(",")))


def _text(vector: tuple) -> str:
    return ",".join(map(str, vector))


@F.pandas_udf(T.StringType())
def _first_pass(codes: pd.Series, end: pd.Series) -> pd.Series:
    return pd.Series([_text(backward(c, _vector(e))[0]) for c, e in zip(codes, end)], dtype=object)


@F.pandas_udf(T.StringType())
def _fix_up(codes: pd.Series, old: pd.Series, new: pd.Series, start: pd.Series) -> pd.Series:
    rows = zip(codes, old, new, start)
    return pd.Series([_text(fixed_up(c, _vector(o), _vector(n), _vector(s))) for c, o, n, s in rows], dtype=object)


@F.pandas_udf(T.StringType())
def _exits(codes: pd.Series, end: pd.Series, last: pd.Series) -> pd.Series:
    """The state each chunk is left in, for each it is entered in, as four digits."""
    rows = zip(codes, end, last)
    return pd.Series(["".join(str(trace(c, _vector(e), x, s)[1]) for s in range(4)) for c, e, x in rows], dtype=object)


@F.pandas_udf(T.StructType([T.StructField("plan", T.StringType()), T.StructField("cost", T.LongType())]))
def _traced(codes: pd.Series, end: pd.Series, last: pd.Series, state: pd.Series) -> pd.DataFrame:
    rows = [trace(c, _vector(e), x, s) for c, e, x, s in zip(codes, end, last, state)]
    return pd.DataFrame({"plan": [r[0] for r in rows], "cost": [r[2] for r in rows]})


def damage(conversations: DataFrame) -> DataFrame:
    """conv (text), turn, role, text, copy of the rows after damage; nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE))
    key = F.concat(text("conv_id"), F.lit(":"), text("turn"))
    rows = conversations.select(
        text("conv_id").alias("conv"), "turn", text("role").alias("role"), text("text").alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fate"),
    )
    fate = F.col("fate")
    cut = F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(fate != 0).select(
        "conv", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"), cut.alias("text"), F.explode(copies).alias("copy")
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with mark and place: places go up within a conversation, and no two are equal.

    One range sort, whatever the size of a conversation; written, so that places stay.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.withColumn("mark", digest(F.col("role"), F.col("text")))
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.substring("role", 1, 64), F.substring("text", 1, 64), "mark", "copy"]
    spread = marked.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    return stage(spread.drop("copy").withColumn("place", F.monotonically_increasing_id()), "turns")


def chunked(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """conv, chunk, first (place), codes: a letter for each of at most ``size`` turns."""
    words = F.rtrim("text", F.lit(SPACES))
    last = F.substring(words, -1, 1)
    fault = F.when(words == "", BLANK).when(last.isin(".", "!", "?"), WHOLE).otherwise(CUT)
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).when(letter == "", 3).otherwise(4)
    light = rows.select("conv", "place", "mark", initial.alias("initial"), fault.alias("fault"))
    # The first of equal turns, and back by the place, which is a key on both sides.
    first = light.groupBy("conv", "mark").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("is_first"))
    kind = F.when((F.col("fault") != BLANK) & F.col("is_first").isNull(), COPY).otherwise(F.col("fault"))
    coded = light.join(first, "place", "left").select(
        "conv", "place", F.expr(f"place div {size}").alias("chunk"), F.char(97 + 4 * F.col("initial") + kind).alias("code")
    )
    letters = F.array_sort(F.collect_list(F.struct("place", "code")))  # of one chunk
    return coded.groupBy("conv", "chunk").agg(
        F.min("place").alias("first"), F.array_join(F.transform(letters, lambda x: x["code"]), "").alias("codes")
    )


def converge(chunks: DataFrame) -> DataFrame:
    """Chunks with ``end``, the costs after them, and ``last``."""
    timeline = Window.partitionBy("conv").orderBy("chunk")
    chunks = chunks.withColumn("last", F.lead("chunk").over(timeline).isNull())
    # Every fourth and third letter is a turn to delete; such chunks leave all vectors as they are.
    needed = F.translate("codes", "".join(chr(97 + 4 * i + k) for i in range(5) for k in (BLANK, COPY)), "") != ""
    chunks = stage(chunks.withColumn("active", needed | F.col("last")), "chunks")
    active = chunks.where("active").withColumn("next", F.lead("chunk").over(timeline))
    start_from = F.when(F.col("last"), F.lit(_text(END))).otherwise(F.lit(_text(GUESS)))
    active = active.withColumn("end", start_from)
    active = stage(active.withColumn("start", _first_pass("codes", "end")), "chunks")
    while True:
        came = active.select("conv", F.col("chunk").alias("next"), F.col("start").alias("given"))
        given = stage(active.where("next is not null").join(came, ["conv", "next"]).where("given <> end"), "fix-up")
        if given.isEmpty():
            break
        again = given.withColumn("start", _fix_up("codes", "end", "given", "start"))
        again = again.select("conv", "chunk", F.col("given").alias("new_end"), F.col("start").alias("new_start"))
        active = active.join(again, ["conv", "chunk"], "left")
        active = active.withColumns({"end": F.coalesce("new_end", "end"), "start": F.coalesce("new_start", "start")})
        active = stage(active.drop("new_end", "new_start"), "chunks")
    idle = chunks.where("not active").withColumn("end", F.lit(_text(GUESS)))
    kept = ["conv", "chunk", "first", "codes", "last", "end"]
    return active.select(*kept).unionByName(idle.select(*kept))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each chunk is entered in, and the letter before it, from its exits."""
    conv, state, letter = None, START, ""
    for batch in batches:
        out = []
        for c, chunk, exits, end in zip(*[x.to_pylist() for x in batch.columns]):
            if c != conv:
                conv, state, letter = c, START, ""
            out.append((c, chunk, state, letter))
            state, letter = int(exits[state]), end
        columns = list(zip(*out)) if out else [(), (), (), ()]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["conv", "chunk", "state", "letter"])


def planned(chunks: DataFrame) -> DataFrame:
    """Converged chunks with plan, cost, and the letter before them."""
    light = chunks.select("conv", "chunk", _exits("codes", "end", "last").alias("exits"), F.substring("codes", -1, 1).alias("ends"))
    ordered = light.repartition("conv").sortWithinPartitions("conv", "chunk")
    entries = ordered.mapInArrow(_scan, "conv string, chunk bigint, state int, letter string")
    both = chunks.join(entries, ["conv", "chunk"]).withColumn("traced", _traced("codes", "end", "last", "state"))
    return stage(both.select("conv", "chunk", "first", "codes", "letter", "traced.plan", "traced.cost"), "plans")


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, role, text) of repaired turns, from plans and turns in order.

    A plan is for the turns after it; what it has left at its end is inserted there.
    """
    conv, plan, at = None, "", 0

    def inserted() -> Iterator[tuple]:
        nonlocal at
        while at < len(plan) and plan[at] in "ua":
            yield conv, "user" if plan[at] == "u" else "assistant", ""
            at += 1

    for c, role, text, new in rows:
        if new is not None:
            yield from inserted()
            conv, plan, at = c, new, 0
            continue
        yield from inserted()
        edit, at = plan[at], at + 1
        if edit != "D":
            yield conv, {"K": role, "U": "user", "A": "assistant"}[edit], text
    yield from inserted()


def _with_plans(rows: DataFrame, plans: DataFrame, size: int) -> DataFrame:
    none = F.lit(None).cast("string")
    texts = rows.select("conv", F.expr(f"place div {size}").alias("chunk"), "place", F.lit(1).alias("kind"), "role", "text", none.alias("plan"))
    heads = plans.select("conv", "chunk", F.col("first").alias("place"), F.lit(0).alias("kind"), none.alias("role"), none.alias("text"), "plan")
    return heads.unionByName(texts)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(k).to_pylist() for k in ("conv", "role", "text", "plan")])


def _as_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns with chunk and number; a partition holds whole chunks."""
    names = ["conv", "chunk", "number", "role", "text"]
    for batch_of in _chunks_of(batches):
        chunk, rows = batch_of
        out = [(c, chunk, k, role, text) for k, (c, role, text) in enumerate(_repaired(iter(rows)))]
        columns = list(zip(*out)) if out else [()] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    key, rows = None, []
    for batch in batches:
        for c, chunk, role, text, plan in zip(*[batch.column(k).to_pylist() for k in ("conv", "chunk", "role", "text", "plan")]):
            if (c, chunk) != key:
                if rows:
                    yield key[1], rows
                key, rows = (c, chunk), []
            rows.append((c, role, text, plan))
    if rows:
        yield key[1], rows


def _as_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per conversation; a partition holds whole conversations."""
    conv, running, out = None, None, []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in columns], ["conv", "repaired_sha256"])

    for c, role, text in _repaired(_entries(batches)):
        if c != conv:
            if conv is not None:
                out.append((conv, running.hexdigest()))
            conv, running = c, hashlib.sha256()
        else:
            running.update(b"\n")
        running.update(f"{role}:{text}".encode())
        if len(out) >= 4096:
            yield batch()
            out = []
    if conv is not None:
        out.append((conv, running.hexdigest()))
    yield batch()


def repaired_turns(conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """conv (the id as text), chunk, number, role, text of repaired turns, ordered by these.

    ``conversations`` are conv_id, turn, role, text as they are, without damage.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c)
    plain = conversations.select(text("conv_id").alias("conv"), "turn", text("role"), text("text"), F.lit(0).alias("copy"))
    rows = numbered(plain)
    plans = planned(stage(converge(chunked(rows, size)), "chunks"))
    both = _with_plans(rows, plans, size).repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place", "kind")
    return both.mapInArrow(_as_turns, "conv string, chunk bigint, number bigint, role string, text string")


def repair_report(conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of damaged conversations."""
    rows = numbered(damage(conversations))
    plans = planned(stage(converge(chunked(rows, size)), "chunks"))

    count = lambda kind: F.length(F.translate("codes", _letters_but(kind), "")).cast("bigint")
    initials = F.translate(F.concat("letter", "codes"), "".join(map(chr, range(97, 117))), "ssssuuuuaaaaxxxxxxxx")
    pairs = F.greatest(F.length(initials) - 1, F.lit(0))
    # Legal pairs, counted by what follows: every match takes its first letter only.
    legal = F.regexp_count(initials, F.lit("(?:s(?=u)|u(?=a)|a(?=u))"))
    counted = plans.select(
        "conv",
        "chunk",
        "cost",
        count(BLANK).alias("blank"),
        count(COPY).alias("duplicate"),
        count(CUT).alias("truncated"),
        (pairs - legal).cast("bigint").alias("illegal"),
        F.translate("plan", "uaUA", "IIRR").alias("audit"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("chunk", "audit")))
    sums = counted.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(pieces, lambda x: x["audit"]), "").alias("audit"),
    )
    seen = rows.groupBy("conv", "turn").agg(F.count("*").alias("n")).groupBy("conv")
    gaps = seen.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("bigint").alias("gaps"))
    both = _with_plans(rows, plans, size).repartition("conv").sortWithinPartitions("conv", "place", "kind")
    hashes = both.mapInArrow(_as_hashes, "conv string, repaired_sha256 string")

    ids = conversations.select("conv_id").distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(NONE)))
    found = ids.join(sums, "conv", "left").join(gaps, "conv", "left").join(hashes, "conv", "left")
    zero = F.lit(0).cast("bigint")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def _letters_but(kind: int) -> str:
    return "".join(chr(97 + k) for k in range(20) if k % 4 != kind)
