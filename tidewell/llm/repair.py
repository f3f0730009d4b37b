"""Repair of conversations whose turns are blank, repeated, cut off or in the
wrong order of speakers, by the cheapest edits.

The cheapest cost to finish from a place is a vector over the four states of
``(s?(ua)+)?``.  Vectors are computed backward and kept at checkpoints only,
every square root of the turns; a block between two is computed again while the
forward walk takes, in each state, the ASCII-least edit that is tight.  The same
holds between tasks: a conversation of many turns is cut into segments of the
square root of all turns at most.  A segment's cost is a (min, +) matrix over the
states; the matrices give the vectors at the segments' ends, from which each
segment is walked by itself.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import written

DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
#: A segment has so many turns at least (if the conversation has), so that
#: ordinary conversations stay whole.
SEGMENT_TURNS = 1024
INF = 1 << 50
FINE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
#: States: nothing yet, after the system turn, after a user's, after an
#: assistant's.  The speaker that each needs next, as a state.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
NEEDED = {2: "u", 3: "a"}
#: Cheapest end of a finished conversation from each state.
END = (0, 2 * INSERT, INSERT, 0)
LAST_CHAR = re.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)")
STOPS = frozenset(".!?")


def initial(role: str) -> str:
    """A role without characters counts as a blank."""
    return role[:1] or " "


def fault_of(role: str, text: str, seen: set) -> int:
    """The first fault of a turn; ``seen`` holds the role and text of those before."""
    last = LAST_CHAR.search(text)
    repeated = (role, text) in seen
    seen.add((role, text))
    if last is None:
        return BLANK
    if repeated:
        return DUPLICATE
    return FINE if last[0] in STOPS else TRUNCATED


def kept_as(state: int, init: str) -> int | None:
    """State after keeping a turn with that initial; None where it does not fit."""
    if state == 0 and init == "s":
        return 1
    return NEXT[state] if init == NEEDED[NEXT[state]] else None


def edits(state: int, init: str, fault: int) -> list[tuple[str, int, int]]:
    """(initial of the edit, cost, next state) of the edits that use up a turn."""
    out = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = CUT if fault == TRUNCATED else 0
    if (to := kept_as(state, init)) is not None:
        out.append(("K", extra, to))
    return [*out, ("R", REROLE + extra, NEXT[state])]


def before(after: tuple, init: str, fault: int) -> tuple:
    """Cost vector before a turn, from the one after it."""
    w = [min(c + after[to] for _, c, to in edits(s, init, fault)) for s in range(4)]
    # an insertion leads from 2 to 3 and from the others to 2; two in a row pay only from 0 and 1
    w[2], w[3] = min(w[2], INSERT + w[3]), min(w[3], INSERT + w[2])
    return min(w[0], INSERT + w[2]), min(w[1], INSERT + w[2]), w[2], w[3]


def back_over(turns: list[tuple[str, int]], after: tuple) -> tuple:
    for init, fault in reversed(turns):
        after = before(after, init, fault)
    return after


def walk(turns: list[tuple[str, int]], after: tuple, states, last: bool) -> dict[int, tuple[int, str]]:
    """For each entry state: (exit state, edits), by the ASCII-least tight edit
    at each place.  ``after`` is the cost vector behind the turns; in the last
    segment the insertions at the end of the conversation are added."""
    block = math.isqrt(len(turns)) + 1
    at_checkpoint, vector = {}, after
    for start in range((max(len(turns) - 1, 0) // block) * block, -1, -block):
        at_checkpoint[start] = vector  # behind the block
        vector = back_over(turns[start:start + block], vector)
    now = {s: (s, []) for s in states}
    for start in sorted(at_checkpoint):
        part = turns[start:start + block]
        vectors = [at_checkpoint[start]]
        for init, fault in reversed(part):
            vectors.append(before(vectors[-1], init, fault))
        vectors.reverse()
        for entry, (s, out) in now.items():
            for i, (init, fault) in enumerate(part):
                here, behind, moved = vectors[i], vectors[i + 1], False
                while not moved:
                    if here[s] == DELETE + behind[s]:
                        out.append("D")
                        moved = True
                    elif here[s] == INSERT + here[NEXT[s]]:
                        out.append("I")
                        s = NEXT[s]
                    else:
                        edit, _, s = next(e for e in edits(s, init, fault) if here[s] == e[1] + behind[e[2]])
                        out.append(edit)
                        moved = True
            now[entry] = (s, out)
    if last:
        for entry, (s, out) in now.items():
            while END[s]:
                out.append("I")
                s = NEXT[s]
            now[entry] = (s, out)
    return {entry: (s, "".join(out)) for entry, (s, out) in now.items()}


def repaired(audit: str, roles: list[str], texts: list[str], state: int) -> list[tuple[str, str]]:
    """The turns that the edits leave."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            out.append((ROLE[state], ""))
            continue
        if edit == "K":
            state = kept_as(state, initial(roles[i]))
            out.append((roles[i], texts[i]))
        elif edit == "R":
            state = NEXT[state]
            out.append((ROLE[state], texts[i]))
        i += 1
    return out


def illegal_pairs(initials: str) -> int:
    return sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def as_lines(turns: list[tuple[str, str]]) -> str:
    return "\n".join(f"{r}:{t}" for r, t in turns)


def segments(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``turns`` sorted by conversation and turn over the cluster and cut: a row
    for each run of one conversation with ``seg`` (in order), its turns and their
    digests.  Written to the shared folder."""
    blank = F.lit(" ")
    rows = turns.select(F.col(conv_id).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                        F.coalesce(role, blank).alias("role"), F.coalesce(text, blank).alias("text"))
    total = rows.count()
    size = max(SEGMENT_TURNS, math.isqrt(total))
    keyed = rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["conv", "turn", "role", "hash", "row"]  # nulls first; rows that differ in the last only are equal
    parts = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order) \
        .select(F.spark_partition_id().alias("part"), "conv", "turn", "role", "text")
    conv_type = turns.schema[conv_id].dataType.simpleString()
    schema = f"conv {conv_type}, seg bigint, turns array<bigint>, roles array<string>, texts array<string>, digests array<binary>"
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def of(batches):
        held: list[pa.RecordBatch] = []

        def cut(part: pa.Table, number: int, base: int):
            roles, texts = part.column("role").to_pylist(), part.column("text").to_pylist()
            digests = [hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest() for r, t in zip(roles, texts)]
            return pa.RecordBatch.from_arrays(
                [part.column("conv").slice(0, 1).combine_chunks(), pa.array([(base << 32) + number]),
                 pa.array([part.column("turn").to_pylist()], pa.list_(pa.int64())), pa.array([roles], pa.list_(pa.string())),
                 pa.array([texts], pa.list_(pa.string())), pa.array([digests], pa.list_(pa.binary()))], names=names)

        number, n_held, key = 0, 0, None
        for b in batches:
            convs = b.column(1).to_pylist()
            base = b.column(0)[0].as_py() if b.num_rows else 0
            at = 0
            for i in range(b.num_rows + 1):
                ends = i == b.num_rows
                if not ends and (n_held or i > at) and (convs[i] != key or n_held + i - at >= size):
                    if i > at:
                        held.append(b.slice(at, i - at))
                    yield cut(pa.Table.from_batches(held), number, base)
                    held, n_held, number, at = [], 0, number + 1, i
                if not ends:
                    key = convs[i]
            if b.num_rows > at:
                held.append(b.slice(at))
                n_held += b.num_rows - at
        if held:
            base = held[0].column(0)[0].as_py()
            yield cut(pa.Table.from_batches(held), number, base)

    return written(dealt.mapInArrow(of, schema), "conversation-segments")


FACTS = "min_turn bigint, max_turn bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"


def facts(turns: list, faults: list[int], initials: str) -> list[int | None]:
    known = [t for t in turns if t is not None]
    return [min(known, default=None), max(known, default=None), len(set(known)), faults.count(BLANK),
            faults.count(DUPLICATE), faults.count(TRUNCATED), illegal_pairs(initials)]


def _whole(segs: DataFrame, conv_type: str) -> DataFrame:
    """Result of conversations that are one segment."""
    schema = f"conv {conv_type}, {FACTS}, cost bigint, audit string, roles array<string>, texts array<string>"
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def of(batches):
        for b in batches:
            out = []
            for turns, roles, texts in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                seen: set = set()
                faults = [fault_of(r, t, seen) for r, t in zip(roles, texts)]
                initials = "".join(map(initial, roles))
                todo = list(zip(initials, faults))
                audit = walk(todo, END, [0], True)[0][1]
                left = repaired(audit, roles, texts, 0)
                out.append([*facts(turns, faults, initials), back_over(todo, END)[0], audit,
                            [r for r, _ in left], [t for _, t in left]])
            cols = list(zip(*out)) if out else [[]] * (len(names) - 1)
            types = [pa.int64()] * 8 + [pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names=names)

    return segs.select("conv", "turns", "roles", "texts").mapInArrow(of, schema)


def _repeats(segs: DataFrame) -> DataFrame:
    """Per segment the places whose role and text stand earlier in the conversation."""
    place = F.struct(F.col("seg"), F.col("pos"))
    keys = segs.select("conv", "seg", F.posexplode("digests").alias("pos", "digest"))
    first = keys.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min(place).alias("first"))
    return keys.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))) \
        .filter(place > F.col("first")).groupBy(F.col("conv").alias("c"), F.col("seg").alias("s")) \
        .agg(F.collect_list("pos").alias("repeats"))


def _faults(roles: list[str], texts: list[str], repeats) -> list[int]:
    found = [fault_of(r, t, set()) for r, t in zip(roles, texts)]
    for i in repeats or ():
        if found[i] != BLANK:
            found[i] = DUPLICATE
    return found


def _split(segs: DataFrame, conv_type: str) -> tuple[DataFrame, DataFrame]:
    """(summary per conversation, repaired turns per segment) of conversations
    of several segments.  What is grouped per conversation or broadcast is one
    small row per segment: there are about the square root of the turns."""
    repeats = _repeats(segs)
    marked = written(segs.drop("digests").join(
        repeats, F.col("conv").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s")), "left").drop("c", "s"), "conversation-marked")

    def turns_of(b: pa.RecordBatch):
        """(conv, seg, turns, roles, texts, faults, initials) of each segment."""
        for conv, seg, turns, roles, texts, rep in zip(*(b.column(n).to_pylist() for n in ("conv", "seg", "turns", "roles", "texts", "repeats"))):
            yield conv, seg, turns, roles, texts, _faults(roles, texts, rep), "".join(map(initial, roles))

    def costs(batches):
        """Matrices: the cost vector before the segment for each state behind it."""
        for b in batches:
            rows = []
            for _, seg, turns, roles, texts, faults, initials in turns_of(b):
                todo = list(zip(initials, faults))
                m = [back_over(todo, tuple(0 if s == to else INF for s in range(4))) for to in range(4)]
                f = facts(turns, faults, initials)
                rows.append([seg, [c for col in m for c in col], initials[0], initials[-1],
                             f[0], f[1], len({t for t in turns if t is not None}), *f[3:]])
            cols = list(zip(*rows)) if rows else [[]] * 11
            types = [pa.int64(), pa.list_(pa.int64()), pa.string(), pa.string(), *[pa.int64()] * 7]
            yield pa.RecordBatch.from_arrays([b.column("conv"), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             names=["conv", "seg", "m", "head", "tail", *(x.split(" ")[0] for x in FACTS.split(", "))])

    matrices = written(marked.mapInArrow(costs, f"conv {conv_type}, seg bigint, m array<bigint>, head string, tail string, {FACTS}"),
                       "conversation-costs")

    def behind(table: pa.Table) -> pa.Table:
        """Cost vectors behind each segment, from the last to the first."""
        t = table.sort_by("seg")
        after, out = END, []
        for m in reversed(t["m"].to_pylist()):
            out.append(list(after))
            after = tuple(min(m[4 * to + s] + after[to] for to in range(4)) for s in range(4))
        return pa.table({"conv": t["conv"], "seg": t["seg"], "after": pa.array(out[::-1], pa.list_(pa.int64())),
                         "last": pa.array([k == len(t) - 1 for k in range(len(t))]),
                         "cost": pa.array([after[0]] * len(t), pa.int64())})

    vectors = written(matrices.select("conv", "seg", "m").groupBy("conv").applyInArrow(
        behind, f"conv {conv_type}, seg bigint, after array<bigint>, last boolean, cost bigint"), "conversation-vectors")

    def at_segment(small: DataFrame) -> DataFrame:
        s = small.withColumnRenamed("conv", "c").withColumnRenamed("seg", "s")
        return marked.join(F.broadcast(s), F.col("conv").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s"))).drop("c", "s")

    def walks(batches):
        for b in batches:
            rows = []
            for (_, seg, *_, faults, initials), after, last in zip(turns_of(b), b.column("after").to_pylist(), b.column("last").to_pylist()):
                way = walk(list(zip(initials, faults)), tuple(after), range(4), last)
                rows.append([seg, [way[s][0] for s in range(4)], [way[s][1] for s in range(4)]])
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.int32())), pa.array(cols[2], pa.list_(pa.string()))],
                names=["conv", "seg", "exits", "audits"])

    ways = written(at_segment(vectors).mapInArrow(walks, f"conv {conv_type}, seg bigint, exits array<int>, audits array<string>"),
                   "conversation-walks")

    def entered(table: pa.Table) -> pa.Table:
        t = table.sort_by("seg")
        s, states, n = 0, [], len(t)
        for exits in t["exits"].to_pylist():
            states.append(s)
            s = exits[s]
        return pa.table({"conv": t["conv"], "seg": t["seg"], "entry": pa.array(states, pa.int32()), "first": pa.array([k == 0 for k in range(n)])})

    entries = written(ways.select("conv", "seg", "exits").groupBy("conv").applyInArrow(
        entered, f"conv {conv_type}, seg bigint, entry int, first boolean"), "conversation-entries")
    chosen = ways.alias("w").join(F.broadcast(entries.alias("e")), F.col("w.conv").eqNullSafe(F.col("e.conv")) & (F.col("w.seg") == F.col("e.seg"))) \
        .select("w.conv", "w.seg", "e.entry", F.get("w.audits", F.col("e.entry")).alias("audit"))
    chosen = written(chosen, "conversation-chosen")

    def mend(batches):
        for b in batches:
            cols = [b.column(n).to_pylist() for n in ("audit", "roles", "texts", "entry")]
            left = [repaired(*x) for x in zip(*cols)]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("seg"), pa.array([[r for r, _ in x] for x in left], pa.list_(pa.string())),
                 pa.array([[t for _, t in x] for x in left], pa.list_(pa.string()))], names=["conv", "seg", "roles", "texts"])

    mended = written(at_segment(chosen).mapInArrow(mend, f"conv {conv_type}, seg bigint, roles array<string>, texts array<string>"),
                     "conversation-mended")

    # illegal pairs across a cut
    between = matrices.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "head", "tail"))).alias("x")) \
        .select("conv", F.aggregate(F.sequence(F.lit(1), F.size("x") - 1), F.lit(0).cast("bigint"),
                                    lambda n, i: n + F.when(F.concat(F.get("x", i - 1)["tail"], F.get("x", i)["head"])
                                                     .isin("su", "ua", "au"), 0).otherwise(1)).alias("between"))
    numbers = marked.select("conv", F.explode(F.array_distinct("turns")).alias("t")).groupBy("conv", "t").agg(F.lit(1)) \
        .groupBy("conv").agg(F.count("t").alias("distinct_turns"))
    sums = matrices.groupBy("conv").agg(F.min("min_turn").alias("min_turn"), F.max("max_turn").alias("max_turn"),
                                        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
    audits = chosen.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "audit"))).alias("x")) \
        .select("conv", F.array_join(F.transform("x", lambda r: r["audit"]), "").alias("audit"))
    cost = vectors.groupBy("conv").agg(F.max("cost").alias("cost"))
    out = sums
    for other in (between, numbers, audits, cost):
        o = other.withColumnRenamed("conv", "c")
        out = out.join(o, out["conv"].eqNullSafe(o["c"])).drop("c")
    return out.select("conv", "min_turn", "max_turn", F.col("distinct_turns").alias("turns"), "blank", "duplicate", "truncated",
                      (F.col("illegal") + F.col("between")).alias("illegal"), "cost", "audit"), mended


def _hash_streams(mended: DataFrame, conv_type: str) -> DataFrame:
    """SHA-256 of each conversation's repaired lines.  A hash of a text takes its
    parts one after the other, so a conversation's segments stream through one
    task; it holds one at a time."""
    def of(batches):
        key, state, empty, started = None, None, True, False

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], conv_arrow[0]), pa.array([state.hexdigest()])], names=["conv", "sha"])

        conv_arrow = [None]
        for b in batches:
            conv_arrow[0] = b.column(0).type
            for conv, roles, texts in zip(*(b.column(k).to_pylist() for k in range(3))):
                if not started or conv != key:
                    if started:
                        yield done()
                    key, state, empty, started = conv, hashlib.sha256(), True, True
                for r, t in zip(roles, texts):
                    state.update(("" if empty else "\n").encode() + f"{r}:{t}".encode())
                    empty = False
        if started:
            yield done()

    return mended.repartition("conv").sortWithinPartitions("conv", "seg").select("conv", "roles", "texts") \
        .mapInArrow(of, f"conv {conv_type}, sha string")


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
    """(summary, turns): ``summary`` has a row per conversation of ``turns`` with
    ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit``, ``repaired_sha256``; ``turns`` the repaired ``role`` and ``text`` in
    order (``place``) within ``seg`` of ``conv``.

    Turns are taken by number, nulls first, those of one number by role and the
    hash of their text; equal ones stay separate, the later is a duplicate.
    A null role or text is one blank, an empty role has a blank as initial; a
    null conversation id is an id like others.  A conversation that loses all its
    turns has an empty audit and the hash of an empty text.  Other columns of ``turns``
    are not looked at."""
    conv_type = turns.schema[conv_id].dataType.simpleString()
    segs = segments(turns, conv_id, turn, role, text)
    # at most one conversation for each cut between partitions or segments
    several = written(segs.groupBy(F.col("conv").alias("c")).count().filter("count > 1").select("c"), "conversations-split")
    at = F.col("conv").eqNullSafe(F.col("c"))
    whole = _whole(segs.join(F.broadcast(several), at, "left_anti"), conv_type)
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    found = whole.select("conv", *_digest_columns(), F.sha2(lines, 256).alias("repaired_sha256"))
    rows = whole.select("conv", F.lit(0).cast("bigint").alias("seg"), "roles", "texts")
    if not several.isEmpty():
        long_found, mended = _split(segs.join(F.broadcast(several), at, "left_semi"), conv_type)
        hashes = _hash_streams(mended, conv_type).withColumnRenamed("conv", "c")
        long_found = long_found.join(hashes, at).select("conv", *_digest_columns(), F.col("sha").alias("repaired_sha256"))
        found, rows = found.unionByName(long_found), rows.unionByName(mended)
    out = rows.select("conv", "seg", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "x")) \
        .select("conv", "seg", "place", F.col("x.roles").alias("role"), F.col("x.texts").alias("text"))
    return found, out


def _digest_columns() -> list[Column]:
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns"), F.lit(0).cast("bigint")).alias("gaps")
    return [gaps, *(F.col(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "audit"))]


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` rows with the faults of the operator's trial: by the
    checksum of ``conv_id:turn`` a row in twenty each is dropped, loses its text,
    loses its stops, comes twice, gets the role user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    rows = turns.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text"))
    return rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
