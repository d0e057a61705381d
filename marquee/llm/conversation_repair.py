"""Repair of conversation structure at least cost, by Four-Russians block tables.

A conversation is right when the initials of its roles read (s?(ua)+)?: perhaps
a system row, then user and assistant in turn.  Edits: Keep (0), Rerole to
user or assistant (3), Delete (4), Insert an empty user or assistant row (3); a
truncated row that stays costs 3 more, blank rows and repeats must go.

States of the pattern: nothing yet, after s, after u, after a.  Read from the
last row to the first, a row turns the vector of the costs still to come from
each state into the next one.  A row is one of nine symbols, and normalised vectors
(least entry 0) are few, because any state is a bounded cost from any other.
So the transitions of all blocks of BLOCK symbols on all vectors are
tabulated once; a conversation is then read a block at a time, from its end.

Tracing expands the blocks the opposite way, from the block's vector and the
state it is entered in.  The next state follows from edit and state alone, so
taking the edit with the least initial among the cheapest at every step gives the
least string of initials.  Expansions are tabulated as they occur.

Long conversations.  Rows are range-sorted, and runs of a conversation in a
partition are cut into chunks of CHUNK rows.  A chunk's table rows compose into one map
of vectors, and maps are associative: a conversation that goes over partition
borders is solved from at most one map a partition; its chunks are then traced
each for itself.  No conversation is collected into one task.
Copies of a row within a turn are counted before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, plain, small_batches, stage

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
FORWARD = (USER, USER, ASSISTANT, USER)         # where an inserted or reroled row leads
MUST_GO, FILLING, SYMBOLS = 0, 9, 10            # 1 to 8: initial s, u, a, other; then the same truncated
BLOCK, CHUNK = 4, 4096
BLANK = r"\A[\x20\x09-\x0D]*\z"
WHOLE_END = r"[.!?][\x20\x09-\x0D]*\z"


def _keep(state: int, initial: int) -> int | None:
    """The state after a kept row."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _inserted(costs: list[int]) -> list[int]:
    """Costs from each state with any number of rows inserted first."""
    costs = list(costs)
    for _ in range(4):
        costs = [min(c, INSERT + costs[FORWARD[s]]) for s, c in enumerate(costs)]
    return costs


END = tuple(_inserted([0, 99, 99, 0]))


def before(after: tuple[int, ...], symbol: int) -> list[int]:
    """The costs in front of a row, given those behind it."""
    if symbol == FILLING:
        return list(after)
    costs = [DELETE + c for c in after]
    if symbol != MUST_GO:
        initial, more = (symbol - 1) % 4, TRUNCATED if symbol > 4 else 0
        for s in range(4):
            costs[s] = min(costs[s], REROLE + more + after[FORWARD[s]])
            if (to := _keep(s, initial)) is not None:
                costs[s] = min(costs[s], more + after[to])
    return _inserted(costs)


class Tables:
    """Normalised vectors (number 0 is the end of a conversation) and their transitions by symbols and blocks."""

    def __init__(self) -> None:
        self.vectors, number, rows = [END], {END: 0}, []
        for vector in self.vectors:
            row = []
            for symbol in range(SYMBOLS):
                costs = before(vector, symbol)
                least = min(costs)
                to = tuple(c - least for c in costs)
                if to not in number:
                    number[to] = len(number)
                    self.vectors.append(to)
                row.append(number[to])
            rows.append(row)
        self.step, self.size = rows, len(rows)
        one = self.to = np.array(rows)
        for _ in range(BLOCK - 1):      # a symbol more in front: it is read last
            self.to = one[self.to].transpose(0, 2, 1).reshape(self.size, -1)
        self.expanded: dict[tuple[int, int, int], tuple[list[str], list[str], int]] = {}

    @staticmethod
    def blocks(symbols: bytes) -> list[int]:
        """The numbers of a chunk's blocks, the last one filled up."""
        s = np.frombuffer(symbols + bytes([FILLING]) * (-len(symbols) % BLOCK), np.uint8).reshape(-1, BLOCK)
        return (s @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()

    def whole(self, symbols: bytes) -> np.ndarray:
        """A chunk's map: for every vector behind it the vector in front."""
        at = np.arange(self.size)
        for block in reversed(self.blocks(symbols)):
            at = self.to[at, block]
        return at

    def expand(self, behind: int, block: int, state: int) -> tuple[list[str], list[str], int]:
        """Each symbol's edits, the rows they leave, and the state after the block.

        Rows left: u, a inserted; k kept; U, A reroled.
        """
        key = (behind, block, state)
        if key not in self.expanded:
            symbols = [block // SYMBOLS ** (BLOCK - 1 - i) % SYMBOLS for i in range(BLOCK)]
            vectors = [behind]
            for symbol in reversed(symbols):
                vectors.append(self.step[vectors[-1]][symbol])
            edits, left = [], []
            for symbol, after in zip(symbols, vectors[-2::-1], strict=True):
                e, r, state = self._row(self.vectors[after], symbol, state)
                edits.append(e)
                left.append(r)
            self.expanded[key] = edits, left, state
        return self.expanded[key]

    @staticmethod
    def _row(after: tuple[int, ...], symbol: int, state: int) -> tuple[str, str, int]:
        if symbol == FILLING:
            return "", "", state
        costs, edits, left = before(after, symbol), "", ""
        initial, more = (symbol - 1) % 4, TRUNCATED if symbol > 4 else 0
        while True:      # D, I, K, R: the least initial among the cheapest
            if costs[state] == DELETE + after[state]:
                return edits + "D", left, state
            to = FORWARD[state]
            if costs[state] == INSERT + costs[to]:
                edits, left, state = edits + "I", left + " .ua"[to], to
                continue
            kept = _keep(state, initial)
            if kept is not None and costs[state] == more + after[kept]:
                return edits + "K", left + "k", kept
            return edits + "R", left + " .UA"[to], to

    def trace(self, symbols: bytes, behind: int, state: int, last: bool) -> tuple[list[str], list[str], int]:
        """Each row's edits, the rows they leave, and the state after the chunk; the conversation's last chunk ends it."""
        blocks = self.blocks(symbols)
        vectors = [behind]
        for block in reversed(blocks):
            vectors.append(int(self.to[vectors[-1], block]))
        edits, left = [], []
        for block, after in zip(blocks, vectors[-2::-1], strict=True):
            e, r, state = self.expand(after, block, state)
            edits += e
            left += r
        edits, left = edits[:len(symbols)], left[:len(symbols)]
        while last and state not in (START, ASSISTANT):
            state = FORWARD[state]
            edits[-1] += "I"
            left[-1] += " .ua"[state]
        return edits, left, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, damaged by crc32("conv_id:turn") % 20; nulls count as one space.

    0 drops the row, 1 empties its text, 2 takes its . ! ? away, 3 repeats it, 4 makes it the user's.
    """
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    role = F.when(F.col("_d") == 4, "user").otherwise(said("role"))
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    times = F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", kind.alias("_d")).where("_d <> 0") \
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_n")).drop("_n")


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for all copies of a row, with its id: the texts, and conv, turn, digest, copies, fault, symbol without them."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    told = rows.select(key.alias("conv"), F.col("turn").cast("long").alias("turn"), *said) \
        .groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    told = stage(told.withColumn("digest", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
                 .withColumn("place", F.sha2(F.concat_ws(":", F.length("conv"), "conv", "digest"), 256))
                 .withColumn("rid", F.monotonically_increasing_id()), "rows")

    slim = told.select("conv", "turn", "digest", "place", "rid", "copies", F.col("text").rlike(BLANK).alias("blank"),
                       (~F.col("text").rlike(WHOLE_END)).alias("cut"), F.substring("role", 1, 1).alias("initial"))
    # texts of other turns: the first turn that says them
    first = slim.groupBy("place").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"), F.count(F.lit(1)).alias("turns")) \
        .where("turns > 1")
    again = join_hot(slim, first, "place", "turns", told.count(), "left")
    repeat = F.col("first").isNotNull() & (F.struct(F.col("turn").isNotNull(), F.col("turn")) > F.col("first"))
    letter = F.when(F.col("initial") == "s", 1).when(F.col("initial") == "u", 2).when(F.col("initial") == "a", 3).otherwise(4)
    fault = F.when(F.col("blank"), "b").when(F.coalesce(repeat, F.lit(False)), "d").when(F.col("cut"), "t").otherwise("")
    marked = again.withColumn("fault", fault).withColumn("letter", letter)
    symbol = F.when(F.col("fault").isin("b", "d"), MUST_GO).otherwise(F.col("letter") + F.when(F.col("fault") == "t", 4).otherwise(0))
    return told, marked.select("conv", "turn", "digest", "rid", "copies", "fault", "letter", symbol.alias("symbol"))


LEGAL = {(1, 2), (2, 3), (3, 2)}


def _chunks(marked: DataFrame) -> DataFrame:
    """Chunks of runs of the range-sorted rows; `alone` ones are whole conversations.

    The others carry `behind`, the map from the vector behind their run to the one behind
    them, and the run's first chunk carries the `map` of its run.
    """
    marked = stage(marked, "marked")
    n, tasks = marked.count(), int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(tasks, n // 5_000 + 1), n // 500_000 + 1)
    keys = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = marked.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, held, conv, part, opened = tables(), [], None, 0, True

        def new() -> dict:
            return {"rids": [], "symbols": bytearray(), "extras": [], "turns": 0, "first_turn": None, "last_turn": None, "first": 0, "last": 0,
                    "illegal": 0, "b": 0, "d": 0, "t": 0}

        def close(border: bool) -> list[tuple]:
            """The rows of the run that has ended."""
            out, alone, at = [], len(held) == 1 and not border, np.arange(made.size)
            for i in range(len(held) - 1, -1, -1):
                c = held[i]
                behind = None if alone else at.tolist()
                if not alone:
                    at = made.whole(bytes(c["symbols"]))[at]
                out.append((conv, part, i, alone, i == len(held) - 1, c["rids"], bytes(c["symbols"]), c["extras"], c["turns"], c["first_turn"], c["last_turn"],
                            c["first"], c["last"], c["illegal"], c["b"], c["d"], c["t"], behind, at.tolist() if not alone and i == 0 else None))
            return out[::-1]

        rows: list[tuple] = []
        for b in batches:
            for name, turn, rid, copies, fault, letter, symbol, part_now in zip(
                    b["conv"], b["turn"], b["rid"], b["copies"], b["fault"], b["letter"], b["symbol"], b["part"], strict=True):
                if name != conv:
                    if held:
                        rows += close(opened)
                        opened = False
                        if len(rows) >= 500:
                            yield pd.DataFrame(rows, columns=CHUNK_COLUMNS).astype(object)
                            rows = []
                    conv, part, chunk = name, part_now, new()
                    held = [chunk]
                    last_turn, last_letter = None, None
                elif len(chunk["rids"]) >= CHUNK:
                    chunk = new()
                    held.append(chunk)
                if not chunk["rids"]:
                    chunk["first"] = letter
                chunk["rids"].append(rid)
                chunk["symbols"].append(symbol)
                chunk["extras"].append(copies - 1)
                if turn is not None:
                    if turn != last_turn:
                        chunk["turns"] += 1
                    last_turn = turn
                    chunk["first_turn"] = turn if chunk["first_turn"] is None else chunk["first_turn"]
                    chunk["last_turn"] = turn
                if last_letter is not None and (last_letter, letter) not in LEGAL:
                    chunk["illegal"] += 1
                chunk["illegal"] += copies - 1      # no role may follow itself
                last_letter = chunk["last"] = letter
                if fault == "b":
                    chunk["b"] += copies
                else:
                    chunk["d"] += copies - (fault != "d")
                    chunk["t"] += fault == "t"
        if held:
            rows += close(True)
        yield pd.DataFrame(rows, columns=CHUNK_COLUMNS).astype(object)

    # turns travel as text: pandas turns integers with nulls among them into rounded floats
    told = placed.select("conv", F.col("turn").cast("string").alias("turn"), "rid", "copies", "fault", "letter", "symbol", "part")
    return stage(told.mapInPandas(run, CHUNK_KIND), "chunks")


CHUNK_COLUMNS = ["conv", "part", "chunk", "alone", "run_end", "rids", "symbols", "extras", "turns", "first_turn", "last_turn", "first", "last",
                 "illegal", "blank", "duplicate", "truncated", "behind", "map"]
CHUNK_KIND = "conv string, part int, chunk int, alone boolean, run_end boolean, rids array<long>, symbols binary, extras array<long>, turns long, " \
    "first_turn string, last_turn string, first int, last int, illegal long, blank long, duplicate long, truncated long, behind array<int>, map array<int>"


def _placed(chunks: DataFrame) -> DataFrame:
    """(conv, part, chunk, behind_v, state, final, seam_turns, seam_illegal) of the chunks that are not alone.

    A conversation has at most one run a partition, so the walks over runs are bounded by the
    number of partitions, and those over a run's chunks by a partition's rows.
    """
    loose = chunks.where("not alone")
    runs = loose.groupBy("conv", "part").agg(
        F.max("map").alias("map"), F.min_by("first_turn", "chunk").alias("first_turn"), F.max_by("last_turn", "chunk").alias("last_turn"),
        F.min_by("first", "chunk").alias("first"), F.max_by("last", "chunk").alias("last"),
        F.min_by("first_turn", F.when(F.col("first_turn").isNotNull(), F.col("chunk"))).alias("first_known"),
        F.max_by("last_turn", F.when(F.col("last_turn").isNotNull(), F.col("chunk"))).alias("last_known"))

    def ends(frame: pd.DataFrame) -> pd.DataFrame:
        """From the last run to the first: the vector behind each; seams between runs."""
        frame = frame.sort_values("part")
        vectors, at = [], 0
        for mapping in reversed(frame["map"].tolist()):
            vectors.append(at)
            at = int(mapping[at])
        out, known, letter = [], None, None
        for part, v, first, last, f, t in zip(frame["part"], vectors[::-1], frame["first"], frame["last"], frame["first_known"], frame["last_known"], strict=True):
            out.append((frame["conv"].iloc[0], part, v, part == frame["part"].iloc[-1], int(f is not None and f == known),
                        int(letter is not None and (letter, first) not in LEGAL)))
            known, letter = t if t is not None else known, last
        return pd.DataFrame(out, columns=["conv", "part", "v", "last_run", "seam_turns", "seam_illegal"])

    ended = stage(runs.groupBy("conv").applyInPandas(ends, "conv string, part int, v int, last_run boolean, seam_turns int, seam_illegal int"), "runs")

    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = tables()
        for b in batches:
            behind = [int(m[v]) for m, v in zip(b["behind"], b["v"], strict=True)]
            to = [[made.trace(s, v, state, False)[2] for state in range(4)] for s, v in zip(b["symbols"], behind, strict=True)]
            yield plain(pd.DataFrame({"conv": b["conv"], "part": b["part"], "chunk": b["chunk"], "behind_v": behind, "to": to}))

    # runs of conversations over a border: at most two a partition
    met = loose.select("conv", "part", "chunk", "symbols", "behind").join(ended.select("conv", "part", "v"), ["conv", "part"])
    traced = stage(met.mapInPandas(exits, "conv string, part int, chunk int, behind_v int, to array<int>"), "exits")

    def along(frame: pd.DataFrame) -> pd.DataFrame:
        """The states a run's chunks are entered in, for each state the run is entered in; the last row leads out of it."""
        frame = frame.sort_values("chunk")
        states, out = [0, 1, 2, 3], []
        for to in frame["to"]:
            out.append(states)
            states = [int(to[s]) for s in states]
        chunk = [*frame["chunk"], -1]
        return pd.DataFrame({"conv": frame["conv"].iloc[0], "part": frame["part"].iloc[0], "chunk": chunk, "states": [*out, states]})

    entered = stage(traced.groupBy("conv", "part").applyInPandas(along, "conv string, part int, chunk int, states array<int>"), "entered")

    def states(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        at, out = START, []
        for to in frame["states"]:
            out.append(at)
            at = int(to[at])
        return pd.DataFrame({"conv": frame["conv"], "part": frame["part"], "run_state": out})

    began = entered.where("chunk = -1").groupBy("conv").applyInPandas(states, "conv string, part int, run_state int")
    return traced.drop("to").join(entered, ["conv", "part", "chunk"]).join(began, ["conv", "part"]).join(ended, ["conv", "part"]).select(
        "conv", "part", "chunk", "behind_v", F.col("states")[F.col("run_state")].alias("state"), "last_run",
        F.when(F.col("chunk") == 0, F.col("seam_turns")).otherwise(0).alias("seam_turns"),
        F.when(F.col("chunk") == 0, F.col("seam_illegal")).otherwise(0).alias("seam_illegal"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A report for every conversation, and the repaired rows.

    ``rows`` has conv_id, turn (whole numbers), role and text; other columns are
    ignored.  Rows are read by turn, nulls first, and within a turn by a digest
    of role and text; copies of a row in a turn stand next to each other.  Null roles and texts count as
    one space, null conv_ids are one conversation.  The first fault of a row
    counts: blank, duplicate (role and text seen earlier), truncated (its last visible character is none of . ! ?).

    Report: conv_id, gaps, blank, duplicate, truncated, illegal (neighbours whose
    initials are not su, ua, au), cost, audit (initials of the cheapest edits, the least such
    string).  Repaired: conv_id, part, chunk, row, nth (their order), role, text.
    An empty table gives empty tables.
    """
    small_batches(rows.sparkSession)
    told, marked = _grouped(rows)
    chunks = _chunks(marked)
    placed = stage(_placed(chunks), "placed")
    known = chunks.join(placed, ["conv", "part", "chunk"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = tables()
        for b in batches:
            out = []
            for conv, part, chunk, symbols, extras, behind, state, last in zip(
                    *(b[c] for c in ("conv", "part", "chunk", "symbols", "extras", "behind_v", "state", "final")), strict=True):
                edits, left, _ = made.trace(bytes(symbols), behind, state, last)
                cost = 0
                for i, (s, e, more) in enumerate(zip(symbols, edits, extras, strict=True)):
                    stays = "K" in e or "R" in e
                    cost += DELETE * ("D" in e) + INSERT * e.count("I") + REROLE * ("R" in e) + TRUNCATED * (stays and s > 4)
                    if more:     # copies go, before anything is inserted behind them
                        ready = len(e.rstrip("I"))
                        edits[i] = e[:ready] + "D" * int(more) + e[ready:]
                        cost += DELETE * int(more)
                out.append((conv, part, chunk, cost, "".join(edits), left))
            yield plain(pd.DataFrame(out, columns=["conv", "part", "chunk", "cost", "audit", "left"]))

    asked = known.select("conv", "part", "chunk", "symbols", "extras", F.coalesce("behind_v", F.lit(0)).alias("behind_v"),
                         F.coalesce("state", F.lit(START)).alias("state"),
                         (F.col("alone") | (F.col("run_end") & F.coalesce("last_run", F.lit(False)))).alias("final"))
    traced = stage(asked.mapInPandas(run, "conv string, part int, chunk int, cost long, audit string, left array<string>"), "traced")

    counted = known.select("conv", F.col("turns") - F.coalesce("seam_turns", F.lit(0)).alias("turns"),
                           (F.col("illegal") + F.coalesce("seam_illegal", F.lit(0))).alias("illegal"), "blank", "duplicate", "truncated",
                           F.col("first_turn").cast("long").alias("lo"), F.col("last_turn").cast("long").alias("hi"))
    counted = counted.toDF("conv", "turns", "illegal", "blank", "duplicate", "truncated", "lo", "hi").groupBy("conv").agg(
        F.coalesce(F.max("hi") - F.min("lo") + 1 - F.sum("turns"), F.lit(0)).alias("gaps"),
        *(F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
    edits = traced.groupBy("conv").agg(F.sum("cost").alias("cost"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("part", "chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    conv_id = F.expr("cast(nullif(conv, ' ') as bigint)").alias("conv_id")
    report = counted.join(edits, "conv").select(conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    rids = chunks.select("conv", "part", "chunk", F.posexplode("rids").alias("row", "rid"))
    left = traced.select("conv", "part", "chunk", F.posexplode("left").alias("row", "left")).where("left <> ''")
    kept = rids.join(left, ["conv", "part", "chunk", "row"]).join(told.select("rid", "role", "text"), "rid") \
        .select("conv", "part", "chunk", "row", "role", "text", F.posexplode(F.split("left", "")).alias("nth", "what")).where("what <> ''")
    new_role = F.when(F.lower("what") == "u", "user").when(F.lower("what") == "a", "assistant").otherwise(F.col("role"))
    repaired = kept.select(conv_id, "part", "chunk", "row", "nth", new_role.alias("role"),
                           F.when(F.col("what").isin("u", "a"), "").otherwise(F.col("text")).alias("text"))
    return report, repaired


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its rows as role:text, joined by newlines.

    A digest reads its conversation in order, so each is made by one task; rows are sorted on disk and streamed, none is held.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha, out = None, None, []
        for b in batches:
            for conv, role, text in zip(b["conv"], b["role"], b["text"], strict=True):
                if conv != now:
                    if sha:
                        out.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
                out = []
        if sha:
            out.append((now, sha.hexdigest()))
        yield plain(pd.DataFrame(out, columns=["conv", "repaired_sha256"]))

    told = repaired.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))).repartition("conv") \
        .sortWithinPartitions("conv", "part", "chunk", "row", "nth")
    return told.select("conv", "role", "text").mapInPandas(run, "conv string, repaired_sha256 string")


def report_all(conversations: DataFrame, report: DataFrame, hashes: DataFrame) -> DataFrame:
    """Every conv_id of ``conversations`` with its report and digest; one without rows has zeros, no edits and the digest of nothing."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("conv", key)
    return every.join(report.withColumn("conv", key).drop("conv_id"), "conv", "left").join(hashes, "conv", "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
