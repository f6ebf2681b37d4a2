"""Conversation structure repair: the lightest derivation of legal turns over the rows of a conversation."""

import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from seispark.llm.text import BLANKS, NULL_ID
from seispark.session import materialise

#: Rows that are derived together at most; a longer conversation is a chain of such chunks.
CHUNK = 256
#: Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NEVER = 1 << 60

#: Prefix states: nothing yet, behind the system row, behind a user row, behind an assistant row; the first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Kind of a row as one letter: its role's initial (o for another one), as a capital if it is truncated; x if it has to go.
KEEPS = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}


def wanted(state):
    """State behind an added or rerolled row: the one role that may follow."""
    return ASSISTANT if state == USER else USER


def edits(kind, state):
    """(letter, cost, next state) of what may be done with a row; edits take one row, insertions none."""
    yield "D", DELETE, state
    if kind != "x":
        extra = TRUNCATED if kind.isupper() else 0
        yield "R", REROLE + extra, wanted(state)
        if (kind.lower(), state) in KEEPS:
            yield "K", extra, KEEPS[kind.lower(), state]


@lru_cache(1 << 14)
def lightest(kinds, start=START, finals=(0, NEVER, NEVER, 0), last=True):
    """(cost, audit, end state) of the lightest derivation of a chunk's goal, ties to the least audit; None if there is none.

    Knuth's agenda over weighted deductions. Axioms: the empty prefix, and every edit of a row. Rules: a prefix of i rows
    and an edit of row i give a prefix of i + 1 rows; a prefix gives itself with one row inserted (behind the rows only
    if the chunk is the ``last``); the prefix of all rows in state q gives the goal at the cost ``finals[q]``. A value is
    (cost, audit): a rule adds the costs and joins the audits. That never makes it less, and it keeps order: audits of one item
    that cost the same take the same rows from the same state, so none is the beginning of another. So the first pop of an item is its
    lightest derivation, and the goal's ends the search.
    """
    agenda, done = [(0, "", 0, start)], set()
    while agenda:
        cost, audit, i, state = heappop(agenda)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i > len(kinds):
            return cost - finals[state - 4], audit, state - 4  # the goal, which knows its last state
        if i < len(kinds):
            for letter, weight, after in edits(kinds[i], state):
                if (i + 1, after) not in done:
                    heappush(agenda, (cost + weight, audit + letter, i + 1, after))
        elif finals[state] < NEVER:
            heappush(agenda, (cost + finals[state], audit, i + 1, state + 4))
        if (i < len(kinds) or last) and (i, wanted(state)) not in done:
            heappush(agenda, (cost + INSERT, audit + "I", i, wanted(state)))
    return None


@lru_cache(1 << 12)
def costs_to(kinds, finals, last):
    """Least cost from each state in front of a chunk to the end of its conversation, given those behind it."""
    found = [lightest(kinds, q, finals, last) for q in range(4)]
    return tuple(f[0] + finals[f[2]] if f else NEVER for f in found)


@lru_cache(1 << 12)
def steps(kinds, audit, state):
    """What becomes of each row, as letters: U or A a row inserted before it (behind the last: after it), k kept, u or a its new role, d gone."""
    found, before = [], ""
    for letter in audit:
        if letter == "I":
            state = wanted(state)
            before += "A" if state == ASSISTANT else "U"
            continue
        if letter == "K":
            own, state = "k", KEEPS[kinds[len(found)].lower(), state]
        elif letter == "R":
            state = wanted(state)
            own = "a" if state == ASSISTANT else "u"
        else:
            own = "d"
        found.append(before + own)
        before = ""
    found[-1] += before
    return tuple(found)


def numbered(rows, chunk):
    """Rows sorted by conversation and turn with ``_part``, ``_seq`` and the ``_chunk`` they are in, which is named by its first ``_seq``."""
    fields = rows.schema.simpleString()[len("struct<") : -1]

    def work(batches):
        part, seen, last, start = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            conv = np.asarray(batch.column("_conv"))
            if not len(conv):
                continue
            seq = seen + np.arange(len(conv))
            new = np.concatenate([[last is None or conv[0] != last], conv[1:] != conv[:-1]])
            starts = np.maximum.accumulate(np.where(new, seq, start))
            last, start, seen = conv[-1], starts[-1], seen + len(conv)
            numbers = [np.full(len(conv), part, np.int32), seq, starts + (seq - starts) // chunk * chunk]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x) for x in numbers]], [*batch.schema.names, "_part", "_seq", "_chunk"])

    return rows.mapInArrow(work, fields.replace(":", " ") + ", _part int, _seq long, _chunk long")


def in_order(rows, conv_col, turn_col, role_col, text_col, chunk):
    """A written table of the rows in the order of their conversations, with what can be told of each row alone.

    It is dealt by ranges of conversation, turn, role and text, and in the end by the row itself, so that a long
    conversation, and even copies of one row, lie in many partitions.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = F.rtrim(text, F.lit(BLANKS))
    own = rows.select(F.coalesce(F.col(conv_col).cast("long"), F.lit(NULL_ID)).alias("_conv"), F.col(turn_col).cast("long").alias("_turn"), role.alias("_role"), text.alias("_text"), bare.alias("_bare"))
    initial = F.when(F.substring("_role", 1, 1).isin("s", "u", "a"), F.substring("_role", 1, 1)).otherwise("o")
    own = own.select(
        "_conv", "_turn", "_role", "_text", initial.alias("_initial"), (F.col("_bare") == "").alias("_blank"), (~F.right("_bare", F.lit(1)).isin(".", "!", "?")).alias("_cut"),
        F.md5(F.concat_ws("\0", "_role", "_text")).alias("_same"), F.substring("_text", 1, 64).alias("_head"), F.monotonically_increasing_id().alias("_row"),
    )
    order = ["_conv", "_turn", "_role", "_head", "_same", "_row"]
    return materialise(numbered(own.repartitionByRange(*order).sortWithinPartitions(*order).drop("_head", "_row"), chunk), "turns")


def chunks(table):
    """One row per chunk: the kinds and initials of its rows as texts, counts of faults, and its turns."""
    light = table.drop("_role", "_text").withColumn("_at", F.shiftleft(F.col("_part").cast("long"), 40) + F.col("_seq"))
    same = light.where("not _blank").groupBy("_conv", "_same").agg(F.count("*").alias("n"), F.min("_at").alias("_first")).where("n > 1").drop("n")
    light = light.join(same, ["_conv", "_same"], "left")
    again = ~F.col("_blank") & F.coalesce(F.col("_at") > F.col("_first"), F.lit(False))
    cut = ~F.col("_blank") & ~again & F.col("_cut")
    kind = F.when(F.col("_blank") | again, "x").when(cut, F.upper("_initial")).otherwise(F.col("_initial"))
    rows = F.sort_array(F.collect_list(F.struct("_seq", kind.alias("kind"), F.col("_initial").alias("initial"))))

    def joined(name):
        return F.array_join(F.transform("rows", lambda r: r[name]), "").alias(f"{name}s")

    found = light.groupBy("_conv", "_part", "_chunk").agg(
        rows.alias("rows"), F.count_if("_blank").alias("blank"), F.count_if(again).alias("duplicate"), F.count_if(cut).alias("truncated"),
        F.min("_turn").alias("low"), F.max("_turn").alias("high"), F.size(F.collect_set("_turn")).cast("long").alias("turns"),
    )
    return found.select("_conv", "_part", "_chunk", joined("kind"), joined("initial"), "blank", "duplicate", "truncated", "low", "high", "turns")


def with_costs_behind(found):
    """Chunks with ``finals``, the least cost from each state behind a chunk to the end of the conversation; read from the last chunk to the first."""
    fields = found.schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def work(frames):
        before = None
        for pdf in frames:
            out = []
            for conv, kinds in zip(pdf["_conv"], pdf["kinds"]):
                after = before is not None and before[0] == conv
                finals = costs_to(*before[1:]) if after else (0, NEVER, NEVER, 0)
                before = conv, kinds, finals, not after
                out.append(list(finals))
            yield pdf.assign(finals=out)

    dealt = found.repartition("_conv").sortWithinPartitions("_conv", F.desc("_part"), F.desc("_chunk"))
    return dealt.mapInPandas(work, fields + ", finals array<long>")


PAIRS = {("s", "u"), ("u", "a"), ("a", "u")}


def derived(found):
    """Per chunk: counts, cost, audit and steps; read from the first chunk of a conversation to the last."""

    def work(frames):
        conv = state = initial = high = None
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                if conv is None or conv != r[0]:
                    conv, state, initial, high = r[0], START, "", None
                finals = tuple(int(x) for x in r.finals)
                # a chunk that others follow ends without insertions; only behind the last one some states may not end
                cost, audit, after = lightest(r.kinds, state, finals, finals == (0, NEVER, NEVER, 0))
                own = initial + r.initials
                illegal = sum(p not in PAIRS for p in zip(own, own[1:]))
                shared = int(high is not None and r.low is not pd.NA and high == r.low)
                out.append((r[0], r[1], r[2], r.blank, r.duplicate, r.truncated, illegal, cost, audit, list(steps(r.kinds, audit, state)), r.low, r.high, r.turns - shared))
                state, initial = after, r.initials[-1]
                high = high if r.high is pd.NA else r.high
            yield pd.DataFrame(out, columns=["_conv", "_part", "_chunk", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "steps", "low", "high", "turns"]).astype({"low": "Int64", "high": "Int64"})

    dealt = found.repartition("_conv").sortWithinPartitions("_conv", "_part", "_chunk")
    return dealt.mapInPandas(
        lambda frames: work(f.astype({"low": "Int64", "high": "Int64"}) for f in frames),
        "_conv long, _part int, _chunk long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, steps array<string>, low long, high long, turns long",
    )


class Repair:
    """Conversations brought into the form ``(s?(ua)+)?`` of role initials at the least cost.

    Rows of a conversation are taken by turn, nulls first, then by role and by text (its first 64 characters, then its hash). The
    first fault of a row counts: blank, a copy of the role and text of an earlier row, or truncated (its last character other than a blank
    is none of ``.!?``). Blank rows and copies have to go; other rows stay, get another role or go, and empty rows are
    inserted; a truncated row that stays adds one. Among the cheapest audits (letters of Keep, Rerole, Delete, Insert in order) the
    least in ASCII is taken, which says what is done.

    A conversation is a chain of chunks of at most ``chunk`` rows, so it may hold any share of the rows: the costs behind each chunk are
    passed on from the last to the first, then each chunk is derived from the state in which the one before it ended. Both passes
    read one row per chunk. Null conversation ids are one conversation, null roles and texts are empty; repeated rows are copies of one
    another; other columns play no part; an empty table has no conversations.
    """

    def __init__(self, rows, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", chunk=CHUNK):
        self.table = in_order(rows, conv_col, turn_col, role_col, text_col, chunk)
        self.chunks = materialise(derived(with_costs_behind(chunks(self.table))), "derivations")

    def summary(self):
        """One row per conversation: _conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        parts = F.sort_array(F.collect_list(F.struct("_part", "_chunk", "audit")))
        sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
        gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0).cast("long")).alias("gaps")
        return self.chunks.groupBy("_conv").agg(gaps, *sums, F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))

    def rows(self):
        """The repaired rows of each input row: _conv, _part, _chunk, _seq (in order), and ``lines`` of role, text and edit."""
        both = self.table.join(self.chunks.select("_part", "_chunk", "steps"), ["_part", "_chunk"])
        letters = F.filter(F.split(F.get("steps", (F.col("_seq") - F.col("_chunk")).cast("int")), ""), lambda x: (x != "") & (x != "d"))

        def line(x):
            role = F.when(x == "k", F.col("_role")).when(F.lower(x) == "u", "user").otherwise("assistant")
            edit = F.when(x == "k", "K").when(x == F.upper(x), "I").otherwise("R")
            return F.struct(role.alias("role"), F.when(edit == "I", "").otherwise(F.col("_text")).alias("text"), edit.alias("edit"))

        return both.select("_conv", "_part", "_chunk", "_seq", F.transform(letters, line).alias("lines"))

    def repaired(self):
        """The repaired conversations, one row per line: conv_id, position columns, role, text, edit."""
        lines = self.rows().select("_conv", "_part", "_seq", F.posexplode("lines").alias("_n", "line"))
        return lines.select(F.when(F.col("_conv") != NULL_ID, F.col("_conv")).alias("conv_id"), "_part", "_seq", "_n", "line.role", "line.text", "line.edit")

    def digests(self):
        """(_conv, repaired_sha256): hash of the lines ``role:text`` joined by newlines.

        Lines are joined within chunks; the hash, which has to read a conversation in order, goes over its chunks one at a time.
        """
        lines = F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
        own = self.rows().where(F.size("lines") > 0).groupBy("_conv", "_part", "_chunk")
        own = own.agg(F.sort_array(F.collect_list(F.struct("_seq", F.array_join(lines, "\n").alias("joined")))).alias("rows"))
        own = own.select("_conv", "_part", "_chunk", F.array_join(F.transform("rows", lambda r: r["joined"]), "\n").alias("joined"))

        def work(batches):
            conv, digest = None, None
            for batch in batches:
                out = []
                for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if own != conv:
                        out += [(conv, digest.hexdigest())] if digest else []
                        conv, digest = own, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(text.as_buffer())
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out], pa.string())], ["_conv", "repaired_sha256"])
            if digest:
                yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], ["_conv", "repaired_sha256"])

        dealt = own.repartition("_conv").sortWithinPartitions("_conv", "_part", "_chunk").select("_conv", "joined")
        return dealt.mapInArrow(work, "_conv long, repaired_sha256 string")
