"""Repair of conversations: the cheapest edits that give the roles ``(s?(ua)+)?``, by a backward table of costs to go.

Rows are put in order by range over all tasks and cut into segments of bounded length, so a conversation of any length is
many segments. A segment is known to the others by a table: the least cost from each grammar state before it to each
state after it. These tables are few; the costs to go at every segment's end follow from them, and each segment is then
walked forward alone, at each step by the least letter among the edits that keep to the cost to go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.llm.common import batch, bounded_batches, cut

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a; what an inserted or reroled row is there, and what follows it.
STATES = 4
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (2, 2, 3, 2)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Costs to go after the last row: what must still be inserted.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 50
#: Rows of one segment at most, as a power of two.
SEGMENT_BITS = 16
#: A row's letter: its role's initial (x: another), as a capital where it is truncated, as a figure where it must go.
PLAIN, CUT_OFF, GONE = "suax", "SUAX", "0123"
SPACE = " \t\n\x0b\f\r"


def _row(code: str, state: int, after: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """(edit, cost with what comes after, next state) of one row, by letter."""
    found = [("D", DELETE + after[state], state)]
    if code not in GONE:
        extra = TRUNCATED if code in CUT_OFF else 0
        to = KEPT.get((state, code.lower()))
        if to is not None:
            found.append(("K", extra + after[to], to))
        found.append(("R", REROLE + extra + after[NEXT_STATE[state]], NEXT_STATE[state]))
    return found


def backward(codes: str, after: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The costs to go by state before each row and after the last."""
    found = [tuple(after)]
    for code in reversed(codes):
        g = [min(c for _, c, _ in _row(code, s, found[-1])) for s in range(STATES)]
        g[2], g[3] = min(g[2], INSERT + g[3]), min(g[3], INSERT + g[2])
        g[0], g[1] = min(g[0], INSERT + g[2]), min(g[1], INSERT + g[2])
        found.append(tuple(g))
    return found[::-1]


@lru_cache(maxsize=4096)
def forward(codes: str, state: int, after: tuple[int, ...], last: bool) -> tuple[str, int]:
    """(edits, state after them): the least string of edits of least cost. A segment that is not the last leaves insertions at its end to the next."""
    costs, edits, i = backward(codes, after), [], 0
    while i < len(codes) or (last and after[state]):
        g = costs[i][state]
        options = _row(codes[i], state, costs[i + 1]) if i < len(codes) else []
        options.append(("I", INSERT + costs[i][NEXT_STATE[state]], NEXT_STATE[state]))
        edit, _, state = min(o for o in options if o[1] == g)
        edits.append(edit)
        i += edit != "I"
    return "".join(edits), state


@lru_cache(maxsize=4096)
def table(codes: str) -> tuple[int, ...]:
    """Least costs from each state before the rows to each state after them, row by row."""
    ends = [backward(codes, tuple(0 if s == to else FAR for s in range(STATES)))[0] for to in range(STATES)]
    return tuple(min(FAR, ends[to][s]) for s in range(STATES) for to in range(STATES))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows as query op12 damages them; nulls of role and text are one space, a dropped row stays with ``gone``."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    df = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), said("role").alias("role"), said("text").alias("text"),
                     (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20).alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("h") == 3, 2).otherwise(1)
    return df.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("h") == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), times)).alias("z")).drop("z")


def placed(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """rows(conv_id, turn, role, text, gone) plus ``at``, their place over all, and ``seg``; in the shared folder.

    Order: conv_id, turn (nulls first), role, the first 64 characters of the text, its hash. Equal rows are dealt out by
    a number of their own, so no key, not even one row repeated, fills a task.
    """
    keyed = rows.withColumns({"head": F.substring("text", 1, 64), "hash": F.xxhash64("text"), "own": F.xxhash64(F.monotonically_increasing_id())})
    keys = ["conv_id", "turn", "role", "head", "hash", "own"]
    df = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "turn", "role", "text", "gone", F.monotonically_increasing_id().alias("at"))
    return cut(df.withColumn("seg", F.shiftright("at", bits)))


def segments(rows: DataFrame) -> DataFrame:
    """rows of ``placed`` -> conv_id, seg, codes, turn_min, turn_max, turns, blank, duplicate, truncated: one row a segment of a conversation."""
    trimmed = F.expr(f"trim(trailing '{SPACE}' from text)")
    df = rows.select("conv_id", "seg", "at", "turn", "role", "gone", (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
                     F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("same"))
    first = df.where("not gone and not blank").groupBy("conv_id", "same").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first")
    df = df.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left").drop("c", "s")
    duplicate = ~F.col("blank") & F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    df = df.withColumn("duplicate", duplicate).withColumn("truncated", F.expr("not blank and not duplicate and cut_off"))
    which = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring("role", 1, 1)) * (F.length("role") > 0).cast("int"), F.lit(0)), F.lit(4))
    letters = F.when(F.expr("blank or duplicate"), GONE).when(F.col("truncated"), CUT_OFF).otherwise(PLAIN)
    df = df.withColumn("code", F.when(~F.col("gone"), F.substring(letters, which, F.lit(1))))
    there = lambda c: F.when(~F.col("gone"), F.col(c))
    count = lambda c: F.count_if(F.expr(f"{c} and not gone"))
    listed = F.array_sort(F.collect_list(F.when(~F.col("gone"), F.struct("at", "code"))))
    return df.groupBy("conv_id", "seg").agg(
        F.array_join(listed["code"], "").alias("codes"), F.min(there("turn")).alias("turn_min"), F.max(there("turn")).alias("turn_max"), F.size(F.collect_set(there("turn"))).alias("turns"),
        count("blank").alias("blank"), count("duplicate").alias("duplicate"), count("truncated").alias("truncated"))


def _mapped(df: DataFrame, added: list[tuple[str, str, pa.DataType]], row: Callable) -> DataFrame:
    """df with columns of ``row(**its columns)``."""
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"{name} {kind}" for name, kind, _ in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [row(**x) for x in b.to_pylist()]
            columns = [pa.array([x[i] for x in new], kind) for i, (_, _, kind) in enumerate(added)]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, *(x[0] for x in added)])

    return df.mapInArrow(run, ddl)


LONGS = ("array<long>", pa.list_(pa.int64()))


def _exits(seg: list, costs: list) -> tuple[list]:
    """The costs to go after each segment of a conversation."""
    after, found = END, []
    for m in reversed(costs):
        found.append(list(after))
        after = [min(m[STATES * s + to] + after[to] for to in range(STATES)) for s in range(STATES)]
    return (found[::-1],)


def _entries(to: list) -> tuple[list]:
    """The state before each segment, from what each state becomes by the one before."""
    states = [0]
    for t in to[:-1]:
        states.append(t[states[-1]])
    return (states,)


def edits(found: DataFrame) -> DataFrame:
    """segments -> the same plus entry (state before), last (none follows), audit and cost."""
    conv = Window.partitionBy("conv_id")
    df = found.withColumns({"last": F.col("seg") == F.max("seg").over(conv), "only": F.count("*").over(conv) == 1})
    df = cut(df)
    one = df.where("only").withColumns({"entry": F.lit(0).cast("long"), "after": F.lit(list(END)).cast("array<long>")})
    many = df.where("not only")

    def listed(df, column):
        """By conversation, its segments in order: 32 numbers each, one segment for up to 2 ** SEGMENT_BITS rows."""
        g = df.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seg", column))).alias("l"))
        return g.select("conv_id", F.col("l.seg").alias("seg"), F.col(f"l.{column}").alias(column))

    def spread(df, column):
        pairs = df.select(F.col("conv_id").alias("c"), F.explode(F.arrays_zip("seg", column)).alias("x"))
        return pairs.select("c", F.col("x.seg").alias("s"), F.col(f"x.{column}").alias(column))

    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s"))
    costs = _mapped(many.select("conv_id", "seg", "codes"), [("costs", *LONGS)], lambda codes, **_: (list(table(codes)),)).drop("codes")
    exits = _mapped(listed(costs, "costs"), [("after", "array<array<long>>", pa.list_(pa.list_(pa.int64())))], lambda seg, costs, **_: _exits(seg, costs))
    many = cut(many.join(spread(exits, "after"), same).drop("c", "s"))
    walked = _mapped(
        many.select("conv_id", "seg", "codes", "after", "last"), [("to", *LONGS)], lambda codes, after, last, **_: ([forward(codes, s, tuple(after), last)[1] for s in range(STATES)],)
    )
    entries = _mapped(listed(walked.select("conv_id", "seg", "to"), "to"), [("entry", *LONGS)], lambda to, **_: _entries(to))
    many = many.join(spread(entries, "entry"), same).drop("c", "s")

    def row(codes, entry, after, last, **_):
        audit, state = forward(codes, entry, tuple(after), last)
        return audit, backward(codes, tuple(after))[0][entry] - (0 if last else after[state])

    return _mapped(one.unionByName(many), [("audit", "string", pa.string()), ("cost", "long", pa.int64())], row).drop("after", "only")


def rebuilt(rows: DataFrame, found: DataFrame, keys: list[str], each: Callable, ddl: str, schema: pa.Schema) -> DataFrame:
    """rows and edits brought together by ``keys`` and given in order to ``each(stream)``, a task's conversations one after another.

    The stream is of (conv_id, at, role, text); it holds one batch of rows, however long a conversation.
    """
    none = F.lit(None)
    both = rows.where("not gone").select("conv_id", "seg", "at", "role", "text", none.cast("string").alias("audit"), none.cast("long").alias("entry"))
    both = both.unionByName(found.select("conv_id", "seg", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.lit("").alias("text"), "audit", "entry"))

    def stream(batches):
        conv, audit, state, at = None, iter(()), 0, -1

        def inserted(until_row):
            nonlocal state
            for edit in audit:
                if edit != "I":
                    return edit
                role, state = NEXT_ROLE[state], NEXT_STATE[state]
                out.append((conv, at, role, ""))
            if until_row:
                raise ValueError("fewer edits than rows")

        for b in batches:
            out = []
            for c, place, role, text, edits_, entry in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6)), strict=True):
                if edits_ is not None:
                    inserted(False)  # what the last segment inserts at its end
                    conv, audit, state, at = c, iter(edits_), entry, -1
                    continue
                at = place
                edit = inserted(True)
                if edit == "K":
                    state = KEPT[state, role[:1]]
                    out.append((c, at, role, text))
                elif edit == "R":
                    role, state = NEXT_ROLE[state], NEXT_STATE[state]
                    out.append((c, at, role, text))
            yield from out
        out = []
        inserted(False)
        yield from out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in each(stream(batches)):
            held.append(row)
            size += sum(len(x) for x in row if isinstance(x, str))
            if len(held) >= 1000 or size > 4 << 20:
                yield batch(schema, [list(x) for x in zip(*held, strict=True)])
                held, size = [], 0
        if held:
            yield batch(schema, [list(x) for x in zip(*held, strict=True)])

    return both.repartition(*keys).sortWithinPartitions("conv_id", "seg", "at").mapInArrow(run, ddl)


def _numbered(stream):
    last, k = None, 0
    for conv, at, role, text in stream:
        k = k + 1 if last == (conv, at) else 0
        last = conv, at
        yield conv, at, k, role, text


def repair(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """rows(conv_id, turn, role, text, optionally gone) -> conv_id, at, k, role, text: the repaired rows, in order of at and k.

    Null roles and texts are one space. A row's ``at`` is its place; inserted rows have that of the row they stand before,
    or after at a segment's end, told apart by ``k``. Conversations without an id are one; other columns are ignored. A
    segment's rows go to one task, never those of a whole conversation.
    """
    bounded_batches(rows.sparkSession)
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    rows = placed(rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), said("role"), said("text"), gone.alias("gone")), bits)
    schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("k", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return rebuilt(rows, edits(segments(rows)), ["conv_id", "seg"], _numbered, "conv_id long, at long, k long, role string, text string", schema)


def _hashes(stream):
    conv, found = None, None
    for c, _, role, text in stream:
        if found is None or c != conv:
            if found is not None:
                yield conv, found.hexdigest()
            conv, found = c, hashlib.sha256()
        else:
            found.update(b"\n")
        found.update(f"{role}:{text}".encode())
    if found is not None:
        yield conv, found.hexdigest()


def digest(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """The columns of query op12.

    Null conv_ids are one conversation; nulls say one space where their text counts. Equal turns go by role and text. A
    conversation's hash is of all its text in order, so one task reads it as a stream, a batch of rows at a time; nothing
    else of a conversation meets in one task but some numbers for every 2 ** bits rows.
    """
    bounded_batches(rows.sparkSession)
    rows = placed(damaged(rows), bits)
    found = cut(edits(segments(rows)))
    order = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    initial = lambda c: F.translate(c, CUT_OFF + GONE, PLAIN + PLAIN)
    codes = initial(F.col("codes"))
    joined = F.concat(F.coalesce(F.last(F.when(codes != "", F.right(codes, F.lit(1))), True).over(order), F.lit("")), codes)
    df = found.withColumns({"joined": joined, "turn_before": F.last("turn_max", True).over(order)})
    pairs = F.greatest(F.length("joined") - 1, F.lit(0))
    # neighbours overlap, so each legal pair is counted by what stands before it
    legal = sum(F.length("joined") - F.length(F.regexp_replace("joined", f"{a}(?={b})", "")) for a, b in ("su", "ua", "au"))
    df = df.withColumns({"illegal": pairs - legal, "turns": F.col("turns") - F.when(F.col("turn_before") == F.col("turn_min"), 1).otherwise(0)})
    total = lambda c: F.sum(c).cast("long").alias(c)
    gaps = F.coalesce(F.max("turn_max") - F.min("turn_min") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps")
    out = df.groupBy("conv_id").agg(gaps, *[total(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.array_join(F.array_sort(F.collect_list(F.struct("seg", "audit")))["audit"], "").alias("audit"))
    hashes = rebuilt(rows, found, ["conv_id"], _hashes, "c long, repaired_sha256 string", pa.schema([("c", pa.int64()), ("repaired_sha256", pa.string())]))
    out = out.join(hashes, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    return out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))
