"""Repair of conversation structure by an auction algorithm for shortest paths.

A conversation's rows are read in order through a lattice: a node is (rows consumed, what was emitted last), an arc is an edit with a whole-number
cost, and a path is a repair whose roles read ``(s?(ua)+)?``.  Keep costs 0, Rerole 3, Delete 4, Insert of an empty row 3; a truncated row that is not
deleted adds 3, and a blank or duplicate row must be deleted.

``settle`` is Bertsekas' auction algorithm with one destination and every node as an origin, the last layer first.  Each node has a price, a lower bound on
its cost to the end.  A path grows from its origin along the arc that is cheapest by cost and price (extension); where the last node's price is below
that minimum, the price rises to it and the node leaves the path (contraction).  A path ends at a node whose price has converged.  Prices of a layer start at the smallest of
the next one, which no arc violates.  The converged prices are the dual optimum: an arc is tight if its cost is the difference of its ends' prices, every
tight path is a cheapest repair, and following the tight arc with the smallest letter (D, I, K, R) traces the ASCII-least audit.

How it is spread: a conversation of any length is cut into segments of ``SEGMENT`` rows.  A segment yields the costs between the four states at its ends;
prices at the cuts come from the same auction over these costs, one short row per conversation; then each segment is traced on its own from each state that
it could begin in, and the states are strung together.  Only the digest of a repaired text (``digest``) reads a conversation in one task, row by row: a hash has no other form.

Rows are ordered by turn (nulls first), ties by a hash of role and text.  Null conversations are one conversation; null roles and texts stand for
one space.  Equal rows are each a row (the second is a duplicate).  Texts are read whole.  An empty table gives empty results; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch
from plumbline.operators.ordering import rank_rows

SEGMENT = 512
BLANKS = "\t\n\x0b\x0c\r "
# states: nothing emitted, then after a system, a user, an assistant row
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
Prices = tuple[int | None, ...]
"""Cost to the end from each state; None where the end cannot be reached."""
Arc = tuple[str, int, bool, int]
"""(letter, cost, into the next layer, state): lower-case letters insert a user or assistant row, K keeps, U and A rerole, D deletes."""


def after(state: int, initial: str) -> int | None:
    """The state after a row with this initial, None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def needed(state: int) -> str:
    return "a" if state == USER else "u"


@lru_cache(None)
def arcs_of(code: str) -> tuple[tuple[Arc, ...], ...]:
    """Arcs of each state at a row.  Codes: initial s, u, a, x (any other); upper case if truncated; 0 if it must go; $ is the end of a conversation."""
    out = []
    for state in range(4):
        role = needed(state)
        here: list[Arc] = [(role, INSERT, False, after(state, role))]
        if code == "$":
            if state in (NOTHING, ASSISTANT):
                here.append(("", 0, True, NOTHING))
        else:
            here.append(("D", DELETE, True, state))
            if code != "0":
                more = CUT_OFF if code.isupper() else 0
                here.append((role.upper(), REROLE + more, True, after(state, role)))
                kept = after(state, code.lower())
                if kept is not None:
                    here.append(("K", KEEP + more, True, kept))
        out.append(tuple(here))
    return tuple(out)


def settle(arcs: tuple[tuple[Arc, ...], ...], ahead: Prices) -> Prices:
    """Converged prices of a layer from those of the next one."""
    reached = [any(into and ahead[to] is not None for _, _, into, to in here) for here in arcs]
    for _ in arcs:
        reached = [r or any(not into and reached[to] for _, _, into, to in here) for r, here in zip(reached, arcs)]
    least = min((p for p in ahead if p is not None), default=None)
    price = [least if r else None for r in reached]
    done = [False] * len(arcs)
    for origin, r in enumerate(reached):
        path = [origin] if r and not done[origin] else []
        while path:
            at = path[-1]
            options = [(cost + p, into, to) for _, cost, into, to in arcs[at] if (p := ahead[to] if into else price[to]) is not None]
            best, into, to = min(options)
            if price[at] < best:
                price[at] = best
                if len(path) > 1:
                    path.pop()
            elif into or done[to]:
                for node in path:
                    done[node] = True
                break
            else:
                path.append(to)
    return tuple(price)


@lru_cache(100_000)
def _settled(code: str, ahead: Prices) -> Prices:
    return settle(arcs_of(code), ahead)


def sweep(codes: str, ahead: Prices) -> list[tuple[int, Prices]]:
    """(base, prices above it) of each layer from the first to the one behind the last row."""
    out = []
    base = 0
    for code in ["", *reversed(codes)]:
        prices = _settled(code, ahead) if code else ahead
        least = min((p for p in prices if p is not None), default=0)
        base += least
        ahead = tuple(None if p is None else p - least for p in prices)
        out.append((base, ahead))
    return out[::-1]


def trace(codes: str, layers: list[tuple[int, Prices]], state: int) -> tuple[str, int]:
    """(letters of the arcs, last state): from ``state`` along tight arcs, of several the one whose edit has the smallest letter."""
    out: list[str] = []
    for code, (base, price), (next_base, following) in zip(codes, layers, layers[1:]):
        into = False
        while not into:
            tight = []
            for letter, cost, step, to in arcs_of(code)[state]:
                p, b = (following[to], next_base) if step else (price[to], base)
                if p is not None and p + b + cost == price[state] + base:
                    tight.append((AUDIT.get(letter, letter), letter, step, to))
            _, letter, into, state = min(tight)
            out.append(letter)
    return "".join(out), state


AUDIT = {"u": "I", "a": "I", "U": "R", "A": "R"}


@lru_cache(50_000)
def costs_between(codes: str, last: bool) -> tuple[int | None, ...]:
    """Cost from each state before the rows to each state behind them; of the last segment, to the end (once)."""
    if last:
        base, price = sweep(codes + "$", (0, None, None, None))[0]
        return tuple(base + p for p in price)
    out: list[int | None] = []
    for target in range(4):
        base, price = sweep(codes, tuple(0 if s == target else None for s in range(4)))[0]
        out.extend(None if p is None else base + p for p in price)
    return tuple(out[4 * t + s] for s in range(4) for t in range(4))


@lru_cache(50_000)
def traces(codes: str, last: bool, ahead: Prices) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """(letters, state behind) from each state before the rows, with the prices behind them."""
    if last:
        codes, ahead = codes + "$", (0, None, None, None)
    layers = sweep(codes, ahead)
    got = [trace(codes, layers, s) for s in range(4)]
    return tuple(g[0] for g in got), tuple(g[1] for g in got)


def illegal(before: str, behind: str) -> int:
    """Neighbours (one of each string) whose initials may not follow each other."""
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(before, behind))


def faults(rows: DataFrame, work: Scratch, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, pos, fault, code): rows numbered in their conversation with the first fault of each (blank, duplicate, truncated or null)."""
    text, role = (F.coalesce(rows[c].cast("string"), F.lit(" ")) for c in (text_col, role_col))
    slim = rows.select(rows[conv_col].alias("conv"), rows[turn_col].cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    keyed = slim.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "role", "text"), "at": F.coalesce("turn", F.lit(-(1 << 63)))})
    held = work.write(rank_rows(keyed, "at", "h1", by=["conv"], name="pos"), "rows")
    same = ["conv", "h1", "h2"]
    often = held.groupBy(*same).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    often = often.select(F.col("conv").alias("c"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first")
    on = F.col("conv").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    joined = held.join(often, on, "left")
    written = F.btrim("text", F.lit(BLANKS))
    fault = F.when(written == "", "blank").when(F.col("pos") > F.col("first"), "duplicate").when(~F.substring(written, -1, 1).isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "0").when(F.col("fault") == "truncated", F.upper("kind")).otherwise(F.col("kind"))
    return joined.select("conv", "turn", "role", "text", "pos", fault.alias("fault"), kind.alias("kind")).withColumn("code", code)


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", segment: int = SEGMENT
) -> tuple[DataFrame, DataFrame]:
    """(report, repaired rows).

    Report, one row per conversation: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit).  Repaired rows: (conv, pos, k, role, text) in the order
    of (pos, k).  The conversation column has its own name in both.
    """
    work = Scratch(rows.sparkSession, "repair")
    held = work.write(faults(rows, work, conv_col, turn_col, role_col, text_col), "faults")
    work.drop("rows")
    kind = held.schema["conv"].dataType.simpleString()
    seg = F.floor((F.col("pos") - 1) / segment).cast("int")
    few = lambda what: F.count_if(F.col("fault") == what).alias(what)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    convs = held.groupBy("conv").agg(gaps, few("blank"), few("duplicate"), few("truncated"), F.max(seg).alias("segs"))
    convs = work.write(convs, "conversations")

    read = F.sort_array(F.collect_list(F.struct("pos", "code", "kind")))
    segments = held.groupBy("conv", seg.alias("seg")).agg(read.alias("r"))
    segments = segments.select(F.col("conv").alias("c"), "seg", F.array_join(F.col("r.code"), "").alias("codes"), F.array_join(F.col("r.kind"), "").alias("kinds"))
    segments = segments.join(convs.select("conv", "segs"), F.col("c").eqNullSafe(F.col("conv"))).select("conv", "seg", (F.col("seg") == F.col("segs")).alias("last"), "codes", "kinds")
    segments = work.write(segments, "segments")

    def bridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Costs between the ends of each segment."""
        for batch in batches:
            codes, last, kinds = (batch.column(c).to_pylist() for c in ("codes", "last", "kinds"))
            costs = pa.array([costs_between(c, e) for c, e in zip(codes, last)], pa.list_(pa.int64()))
            wrong = pa.array([illegal(k, k[1:]) for k in kinds], pa.int64())
            ends = pa.array([k[0] + k[-1] for k in kinds])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("seg"), costs, wrong, ends], ["conv", "seg", "costs", "illegal", "ends"])

    bridges = segments.mapInArrow(bridge, f"conv {kind}, seg int, costs array<long>, illegal long, ends string")
    strung = bridges.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "costs", "ends"))).alias("s"), F.sum("illegal").alias("illegal"))
    strung = strung.select("conv", "illegal", F.col("s.costs").alias("costs"), F.array_join(F.col("s.ends"), "").alias("ends"))

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The auction over the cuts: cost of the whole, and prices behind each segment."""
        for batch in batches:
            total, behind = [], []
            for costs in batch.column("costs").to_pylist():
                at = [tuple(costs[-1])]
                for m in reversed(costs[:-1]):
                    arcs = tuple(tuple(("", m[4 * s + t], True, t) for t in range(4) if m[4 * s + t] is not None) for s in range(4))
                    at.append(settle(arcs, at[-1]))
                total.append(at[-1][NOTHING])
                behind.append([*at[-2::-1], (0, 0, 0, 0)])
            # between segments: the last initial of one and the first of the next
            joints = [illegal(e[1::2], e[2::2]) for e in batch.column("ends").to_pylist()]
            wrong = pa.array([n + j for n, j in zip(batch.column("illegal").to_pylist(), joints)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), wrong, pa.array(total, pa.int64()), pa.array(behind, pa.list_(pa.list_(pa.int64())))], ["conv", "illegal", "cost", "behind"]
            )

    priced = work.write(strung.mapInArrow(price, f"conv {kind}, illegal long, cost long, behind array<array<long>>"), "priced")
    cuts = priced.select(F.col("conv").alias("c"), F.posexplode("behind").alias("s", "behind"))
    facing = segments.join(cuts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s"))).select("conv", "seg", "last", "codes", "behind")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [traces(c, e, tuple(p)) for c, e, p in zip(*(batch.column(n).to_pylist() for n in ("codes", "last", "behind")))]
            columns = [pa.array([g[0] for g in got], pa.list_(pa.string())), pa.array([g[1] for g in got], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("seg"), *columns], ["conv", "seg", "letters", "states"])

    traced = work.write(facing.mapInArrow(follow, f"conv {kind}, seg int, letters array<string>, states array<int>"), "traced")
    # the state each segment begins in: four possible ones are carried along, a step for each segment
    states = traced.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "states"))).alias("s")).select("conv", F.col("s.states").alias("states"))

    def string(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for steps in batch.column("states").to_pylist():
                begins = [NOTHING]
                for step in steps[:-1]:
                    begins.append(step[begins[-1]])
                out.append(begins)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(out, pa.list_(pa.int32()))], ["conv", "begins"])

    begins = states.mapInArrow(string, f"conv {kind}, begins array<int>").select(F.col("conv").alias("c"), F.posexplode("begins").alias("s", "begin"))
    chosen = traced.join(begins, F.col("conv").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s"))).select("conv", "seg", F.get("letters", F.col("begin")).alias("letters"))
    chosen = work.write(chosen, "chosen")

    audits = chosen.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "letters"))).alias("s"))
    audits = audits.select(F.col("conv").alias("c2"), F.translate(F.array_join(F.col("s.letters"), ""), "uaUA", "IIRR").alias("audit"))
    report = convs.join(priced.withColumnRenamed("conv", "c1"), F.col("conv").eqNullSafe(F.col("c1"))).join(audits, F.col("conv").eqNullSafe(F.col("c2")))
    report = report.select(F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    steps = F.regexp_extract_all("letters", F.lit("[ua]*([KDUA]|$)"), F.lit(0))
    plan = chosen.select("conv", "seg", F.posexplode(steps).alias("i", "step")).where("step != ''")
    plan = plan.select(F.col("conv").alias("c"), (F.col("seg") * F.lit(segment) + F.col("i") + 1).cast("long").alias("place"), "step")
    done = plan.join(held.select("conv", "pos", "role", "text"), F.col("c").eqNullSafe(F.col("conv")) & (F.col("place") == F.col("pos")), "left")
    # a text that follows the last row is inserted
    named = F.transform(F.filter(F.split("step", ""), lambda x: x.isin("u", "a")), lambda x: F.struct(F.when(x == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))
    act = F.substring("step", -1, 1)
    own = F.when(act == "K", F.col("role")).when(act == "U", "user").when(act == "A", "assistant")
    kept = F.when(own.isNotNull(), F.array(F.struct(own.alias("role"), F.col("text").alias("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    repaired = done.select("c", "place", F.posexplode(F.concat(named, kept)).alias("k", "row"))
    return report, repaired.select(F.col("c").alias(conv_col), F.col("place").alias("pos"), "k", "row.role", "row.text")


def digest(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, sha256): digest of the ``role:text`` lines of each conversation, joined by newlines; one row at a time."""
    kind = repaired.schema[conv_col].dataType.simpleString()
    line = F.concat_ws(":", "role", "text").cast("binary")
    dealt = repaired.select(repaired[conv_col].alias("conv"), "pos", "k", line.alias("line")).repartition("conv").sortWithinPartitions("conv", "pos", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kinds), pa.array([s for _, s in done], pa.string())], ["conv", "sha256"])

        kinds = None
        for batch in batches:
            kinds = batch.schema.field("conv").type
            done = []
            for conv, text in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
                if sha is None or conv != now:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256(text)
                else:
                    sha.update(b"\n")
                    sha.update(text)
            if done:
                yield batch_of(done)
        if sha is not None:
            yield batch_of([(now, sha.hexdigest())])

    return dealt.mapInArrow(run, f"conv {kind}, sha256 string").withColumnRenamed("conv", conv_col)


def damage(rows: DataFrame, drop: int = 0, empty: int = 1, cut: int = 2, repeat: int = 3, rerole: int = 4, out_of: int = 20) -> DataFrame:
    """Planted faults by the CRC of ``conv_id:turn``, so that every run plants the same: of ``out_of`` remainders one each drops a row, empties its
    text, takes its sentence ends away, repeats it and makes its role user.  Nulls stand for one space."""
    space = F.lit(" ")
    name: Column = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % out_of
    text = F.coalesce("text", space)
    hurt = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), kind.alias("kind")).where(F.col("kind") != drop)
    text = F.when(F.col("kind") == empty, "").when(F.col("kind") == cut, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == rerole, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == repeat, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")
