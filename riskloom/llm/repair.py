"""Damaged conversations and their cheapest repair, with an audit of the edits (see ``audits``).

Turns are dealt by conversation, sorted and repaired as they stream past, one conversation at a time. A
conversation of more than ``LONG_TURNS`` turns or ``LONG_BYTES`` bytes is never held by one task: its turns get
their positions by range, repeated turns are told by the first position of their digest, runs of ``RUN`` turns
become tables of cheapest audits between states, and tables are joined in a tree. Only its checksum, which is
sequential by definition, streams through one task, text by text.

Defined results: a null role or text is one space (so such a text is blank); a null conversation id is a
conversation, a null turn comes first; turns of one number are ordered by role, then text; identical rows
follow each other; an empty table gives an empty result; very long texts are streamed whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.audits import Replay, Table, cheapest, joined, segment
from riskloom.llm.common import parts_for, slices
from riskloom.operators.prefix import range_positions
from riskloom.session import checkpointed

PART_BYTES, LONG_TURNS, LONG_BYTES, RUN, FAN = 32 << 20, 20_000, 64 << 20, 4096, 64
SPACE = " \t\n\x0b\x0c\r"
ORDER = ["turn", "told", "text", "copy"]
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEGAL = ("su", "ua", "au")


def damage(turns: DataFrame) -> DataFrame:
    """The turns after the stated damage; a dropped turn stays as a marked row, so that its conversation does.

    Columns: ``conv`` (key as text, null apart), the table's ``conv_id``, ``turn``, ``role`` and ``text`` after
    damage, ``told`` (role before it), ``copy`` (1 on the repetition), ``dropped``.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select(
        F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv"),
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("told"), F.coalesce("text", F.lit(" ")).alias("said"), (F.crc32(key) % 20).alias("fate"),
    )
    text = F.when(F.col("fate") <= 1, "").when(F.col("fate") == 2, F.regexp_replace("said", "[.!?]", "")).otherwise(F.col("said"))
    return rows.select(
        "conv", "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("told")).alias("role"), text.alias("text"), "told",
        F.explode(F.sequence(F.lit(0), (F.col("fate") == 3).cast("int"))).alias("copy"), (F.col("fate") == 0).alias("dropped"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """Whether a turn says nothing, and whether what it says does not end in a stop."""
    said = F.rtrim(F.col("text"), F.lit(SPACE))
    return rows.withColumns({"blank": F.length(said) == 0, "open": ~F.right(said, F.lit(1)).isin(".", "!", "?")})


def code(initial: str, blank: bool, again: bool, truncated: bool) -> str:
    if blank or again:
        return "d"
    initial = initial if initial in ("u", "a", "s") else "x"
    return initial.upper() if truncated else initial


def row_code(again: Column) -> Column:
    """The same in columns."""
    first = F.substring("role", 1, 1)
    letter = F.when(first.isin("u", "a", "s"), first).otherwise("x")
    return F.when(F.col("blank") | again, "d").when(F.col("open"), F.upper(letter)).otherwise(letter)


class _Checksum:
    def __init__(self, audit: str) -> None:
        self.replay, self.hash, self.any = Replay(audit), hashlib.sha256(), False

    def add(self, turns) -> None:
        for role, text in turns:
            self.hash.update(((f"\n{role}:" if self.any else f"{role}:") + text).encode("utf-8", "surrogatepass"))
            self.any = True

    def turn(self, role: str, text: str) -> None:
        self.add(self.replay.turn(role, text))

    def digest(self) -> str:
        self.add(self.replay.end())
        return self.hash.hexdigest()


def repair_one(rows: list[tuple]) -> tuple:
    """The result of one conversation from its (turn, role, text, blank, open) rows in order."""
    seen, codes, blank, again, cut, illegal = set(), [], 0, 0, 0, 0
    for i, (_, role, text, empty, is_open) in enumerate(rows):
        repeated = not empty and (role, text) in seen
        if not empty:
            seen.add((role, text))
        blank, again, cut = blank + empty, again + repeated, cut + (is_open and not empty and not repeated)
        codes.append(code(role[:1], empty, repeated, is_open))
        illegal += i > 0 and rows[i - 1][1][:1] + role[:1] not in LEGAL
    cost, audit = cheapest("".join(codes))
    check = _Checksum(audit)
    for _, role, text, _, _ in rows:
        check.turn(role, text)
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, blank, again, cut, illegal, cost, audit, check.digest()


def _short(rows: DataFrame, parts: int) -> DataFrame:
    """Conversations that one task may hold, dealt by their key."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.repartition(parts, "conv").sortWithinPartitions("conv", *ORDER)
    columns = ["conv", "conv_id", "turn", "role", "text", "blank", "open", "dropped"]

    def run(batches):
        key, name, held, done = None, None, [], []

        def out(finished):
            kinds = [None, *[pa.int64()] * 6, pa.string(), pa.string()]
            return [pa.array(list(c), t) if t else list(c) for c, t in zip(zip(*finished, strict=True), kinds, strict=True)]

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for piece in slices(batch):
                for conv, conv_id, turn, role, text, blank, is_open, dropped in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    if conv != key:
                        if key is not None:
                            done.append((name, *repair_one(held)))
                        key, name, held = conv, conv_id, []
                    if not dropped:
                        held.append((turn, role, text, blank, is_open))
            if len(done) >= 2000:
                ids, *rest = out(done)
                yield pa.RecordBatch.from_arrays([pa.array(ids, conv_type), *rest], names=names)
                done = []
        if key is not None:
            done.append((name, *repair_one(held)))
            ids, *rest = out(done)
            yield pa.RecordBatch.from_arrays([pa.array(ids, conv_type), *rest], names=names)

    names = ["conv_id", *[c.split()[0] for c in COUNTS.split(", ")]]
    return dealt.select(columns).mapInArrow(run, f"conv_id {kind}, {COUNTS}")


def _pack(table: Table) -> tuple[list, list]:
    """A table as two lists over the 16 pairs of states; a pair without a way has no cost."""
    pairs = [table.get((a, b)) for a in range(4) for b in range(4)]
    return [p and p[0] for p in pairs], [p and p[1] for p in pairs]


def _unpack(costs: list, audits: list) -> Table:
    return {divmod(i, 4): (c, a) for i, (c, a) in enumerate(zip(costs, audits, strict=True)) if c is not None}


RUN_SCHEMA = "conv string, run long, last boolean, costs array<int>, audits array<string>"


def _runs(group: pa.Table) -> pa.Table:
    """The table of one run of turns."""
    rows = sorted(zip(group["rank"].to_pylist(), group["code"].to_pylist(), group["last"].to_pylist(), strict=True))
    costs, audits = _pack(segment("".join(r[1] for r in rows), rows[-1][2]))
    return pa.table({"conv": [group["conv"][0].as_py()], "run": [group["part"][0].as_py()], "last": [rows[-1][2]], "costs": pa.array([costs], pa.list_(pa.int32())), "audits": pa.array([audits], pa.list_(pa.string()))})


def _join_runs(group: pa.Table) -> pa.Table:
    """The table of runs that follow each other."""
    rows = sorted(zip(group["run"].to_pylist(), group["last"].to_pylist(), group["costs"].to_pylist(), group["audits"].to_pylist(), strict=True), key=lambda r: r[0])
    table = _unpack(*rows[0][2:])
    for r in rows[1:]:
        table = joined(table, _unpack(*r[2:]))
    costs, audits = _pack(table)
    return pa.table({"conv": [group["conv"][0].as_py()], "run": [group["part"][0].as_py()], "last": [rows[-1][1]], "costs": pa.array([costs], pa.list_(pa.int32())), "audits": pa.array([audits], pa.list_(pa.string()))})


def _checksums(rows: DataFrame) -> DataFrame:
    """Checksum per conversation: its audit comes first (rank -1), then its turns one at a time."""

    def run(batches):
        key, check, done = None, None, []
        for batch in batches:
            for piece in slices(batch, 64):
                for conv, _, role, text, audit in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    if conv != key:
                        if check is not None:
                            done.append((key, check.digest()))
                        key, check = conv, _Checksum(audit)
                    else:
                        check.turn(role, text)
        if check is not None:
            done.append((key, check.digest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*done, strict=True)], names=["conv", "repaired_sha256"])

    return rows.mapInArrow(run, "conv string, repaired_sha256 string")


def _long(rows: DataFrame, run: int, fan: int) -> DataFrame:
    """Conversations that no task may hold, cut into runs of turns."""
    ranked = checkpointed(range_positions(rows, ["conv"], ORDER))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    first = ranked.groupBy("conv", digest.alias("digest")).agg(F.min("rank").alias("rank")).select("conv", "rank", F.lit(True).alias("first"))
    sizes = ranked.groupBy("conv").agg(F.max("rank").alias("top"), F.min("turn").alias("low"), F.max("turn").alias("high"), F.first("conv_id").alias("conv_id"))
    after = ranked.select("conv", (F.col("rank") + 1).alias("rank"), F.substring("role", 1, 1).alias("initial"))
    again = F.col("first").isNull() & ~F.col("blank")
    pair = F.concat("initial", F.substring("role", 1, 1))
    coded = ranked.join(first, ["conv", "rank"], "left").join(after, ["conv", "rank"], "left").join(sizes.select("conv", "top"), "conv")
    coded = checkpointed(coded.select(
        "conv", "rank", row_code(again).alias("code"), (F.col("rank") == F.col("top")).alias("last"), "turn", "blank", again.alias("again"),
        (F.col("open") & ~F.col("blank") & ~again).alias("cut"), (F.col("initial").isNotNull() & ~pair.isin(*LEGAL)).alias("illegal"),
    ))
    turns = coded.groupBy("conv", "turn").count().groupBy("conv").agg(F.count("turn").alias("turns"))
    counts = coded.groupBy("conv").agg(*[F.count_if(c).alias(n) for c, n in (("blank", "blank"), ("again", "duplicate"), ("cut", "truncated"), ("illegal", "illegal"))])
    parts = coded.select("conv", "rank", "code", "last", F.floor(F.col("rank") / run).alias("part"))
    tables = checkpointed(parts.groupBy("conv", "part").applyInArrow(_runs, RUN_SCHEMA))
    while tables.where("run > 0").limit(1).count():
        tables = checkpointed(tables.withColumn("part", F.floor(F.col("run") / fan)).groupBy("conv", "part").applyInArrow(_join_runs, RUN_SCHEMA))
    # from the start (row 0 of the table) to the start again (nothing kept) or to an assistant's turn
    ends = [F.when(F.col("costs")[i].isNotNull(), F.struct(F.col("costs")[i].cast("long").alias("cost"), F.col("audits")[i].alias("audit"))) for i in (0, 3)]
    audits = tables.select("conv", F.least(*ends).alias("best")).select("conv", "best.*")
    heads = audits.select("conv", F.lit(-1).cast("long").alias("rank"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    streamed = ranked.select("conv", "rank", "role", "text", F.lit(None).cast("string").alias("audit")).unionByName(heads)
    checks = _checksums(streamed.repartition("conv").sortWithinPartitions("conv", "rank"))
    out = sizes.join(turns, "conv").join(counts, "conv").join(audits, "conv").join(checks, "conv")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return out.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(rows: DataFrame, *, long_turns: int = LONG_TURNS, long_bytes: int = LONG_BYTES, run: int = RUN, fan: int = FAN) -> DataFrame:
    """One row per conversation of turns in the form that ``damage`` gives."""
    rows = faults(rows)
    size = rows.groupBy("conv").agg(F.count_if(~F.col("dropped")).alias("n"), F.sum(F.octet_length("text")).alias("b"))
    total = size.agg(F.sum("b").alias("b"), F.max("n").alias("n"), F.max("b").alias("most")).first()
    parts = parts_for(total["b"] or 0, PART_BYTES)
    if (total["n"] or 0) <= long_turns and (total["most"] or 0) <= long_bytes:
        return _short(rows, parts)
    # conversations too large for one task: at most one in ``long_turns`` rows or ``long_bytes`` bytes
    large = checkpointed(size.where((F.col("n") > 0) & ((F.col("n") > long_turns) | (F.col("b") > long_bytes))).select("conv"))
    short = _short(rows.join(large, "conv", "left_anti"), parts)
    return short.unionByName(_long(rows.where(~F.col("dropped")).join(large, "conv", "left_semi").drop("dropped"), run, fan))


def repair(turns: DataFrame, **limits) -> DataFrame:
    """Counts of faults, cost, audit and checksum of every conversation after the stated damage."""
    return repaired(damage(turns), **limits)
