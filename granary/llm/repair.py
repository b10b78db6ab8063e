"""Conversation structure repair: the cheapest edits that make the turns' roles alternate.

A repaired conversation's role initials read ``(s?(ua)+)?``. Every turn is kept, given the role that fits, or
deleted, and empty turns are inserted; the edits' initials in order are the audit. Turns without a visible character and
turns whose role and text stood before must be deleted.

A block of up to 256 turns of a conversation is a DAG: its nodes are the grammar's states before each turn, its edges
what is done up to and with that turn. An edge's weight is one integer. High digits carry its cost; below them
each turn has three letters' width of its own, in the order of turns, which hold the edge's audit letters with
zeros behind them. So the integer minimum over paths is the cheapest and, among these, the ASCII-least audit, from every state at the
block's begin to every state at its end. Two paths of one block never have audits of which one begins with the other, as the last
letter is a turn's, so what follows the block never reorders them, and the blocks of a conversation may be solved apart.
A pass over the blocks' costs picks the states between them.

Turns are range-partitioned by conversation and number, so a conversation of a third of all rows is solved in many
tasks. Only keys, flags and digests of texts take part; the texts are shuffled once, to be written out in order, which for a
conversation is one task's walk, in bounded memory. Equal turns are counted before the first shuffle.

Defined cases: a null role or text is one space; so a null text is blank, and a null or unknown role must be changed or deleted. Null turns
come first; turns of equal number follow by role and by their text's digest; of equal rows the later ones are
duplicates. A null id is a conversation of its own. A long text is one turn. An empty table gives no edit. Further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from granary.llm.common import rounds, written
from granary.operators.skew import join_on

BLOCK = 256
#: White space, ends of sentences, costs and the audit's letters.
SPACE, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
LETTERS = " DIKR"  # by their digits; 0 is padding
FAULTS = (None, "truncated", "duplicate", "blank")
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)

#: States of the grammar: nothing yet, after system, after user, after assistant; and the steps between them.
START, SYSTEM, USER, ANSWER = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ANSWER, (ANSWER, "u"): USER}
FITTING = {state: ("assistant", ANSWER) if state == USER else ("user", USER) for state in range(4)}
#: Letters to insert at the end.
TAILS = {START: "", SYSTEM: "II", USER: "I", ANSWER: ""}
BITS, SLOT = 3, 9  # of a letter, and of a turn's letters: at most two inserts and its own


def digits(letters: str) -> int:
    value = 0
    for letter in letters.ljust(SLOT // BITS):
        value = value << BITS | LETTERS.index(letter)
    return value


def moves(state: int, initial: str, fault: int) -> list[tuple[int, int, int]]:
    """``(next state, cost, digits)`` of the best edge to each state. A third insert would only come back to a state."""
    best: dict[int, tuple[int, int]] = {}
    for inserted in range(3):
        choices = [(state, DELETE, "D")]
        if fault in (FINE, TRUNCATED):
            extra = UNFINISHED if fault == TRUNCATED else 0
            choices.append((FITTING[state][1], REROLE + extra, "R"))
            if (state, initial) in STEPS:
                choices.append((STEPS[state, initial], extra, "K"))
        for to, cost, letter in choices:
            weight = (inserted * INSERT + cost, digits("I" * inserted + letter))
            best[to] = min(best.get(to, weight), weight)
        state = FITTING[state][1]
    return [(to, *weight) for to, weight in best.items()]


MOVES = {(s, i, f): moves(s, i, f) for s in range(4) for i in ("s", "u", "a", "") for f in range(4)}
WORDS = {digits("I" * n + x): "I" * n + x for n in range(3) for x in "DKR"}


def solve(turns: list[tuple[str, int]], source: int) -> dict[int, int]:
    """The least weight from a state before the turns to each state behind them."""
    width = SLOT * len(turns)
    best, shift = {source: 0}, width
    for turn in turns:
        shift -= SLOT
        reached: dict[int, int] = {}
        for state, weight in best.items():
            for to, cost, letters in MOVES[state, *turn]:
                new = weight + (cost << width) + (letters << shift)
                if to not in reached or new < reached[to]:
                    reached[to] = new
        best = reached
    return best


def letters_of(weight: int, turns: int) -> str:
    return "".join(WORDS[weight >> shift & (1 << SLOT) - 1] for shift in range(SLOT * (turns - 1), -1, -SLOT))


def block_row(turns: list[tuple[str, int]], sources: range) -> tuple[list[int], list[int], list[str]]:
    """Costs, order among the paths of a source, and audits, by source and end state; -1 where no path is."""
    costs, orders, audits = [-1] * 16, [0] * 16, [""] * 16
    width = SLOT * len(turns)
    for source in sources:
        found = solve(turns, source)
        low = {end: weight & (1 << width) - 1 for end, weight in found.items()}
        for order, end in enumerate(sorted(found, key=low.__getitem__)):
            place = 4 * source + end
            costs[place], orders[place], audits[place] = found[end] >> width, order, letters_of(low[end], len(turns))
    return costs, orders, audits


def path(blocks: list[tuple[int, list[int], list[int]]]) -> list[tuple[int, int, str]]:
    """``(block, place in its lists, letters at the end)`` of the best way through a conversation's blocks, last block first."""
    ahead: dict[int, int] = {state: INSERT * len(tail) for state, tail in TAILS.items()}
    picks = []
    for _, costs, orders in blocks:
        pick = {}
        for source in range(4):
            ways = [(costs[p] + ahead[e], orders[p], e) for e in ahead if costs[p := 4 * source + e] >= 0]
            if ways:
                pick[source] = min(ways)
        picks.append(pick)
        ahead = {source: way[0] for source, way in pick.items()}
    state, out = START, []
    for i in range(len(blocks) - 1, -1, -1):
        end = picks[i][state][2]
        out.append((blocks[i][0], 4 * state + end, TAILS[end] if i == 0 else ""))
        state = end
    return out


def _named(turns: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(" "))
    return turns.select(
        F.col(id_column).alias("id"), F.col(turn_column).alias("turn"), F.coalesce(F.col(role_column), F.lit(" ")).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"),
    )


KEYS = ["id", "turn", "role", "digest"]


def faulty(rows: DataFrame) -> DataFrame:
    """Distinct turns by ``KEYS`` with their ``copies`` and ``fault``."""
    bare = F.rtrim("text", F.lit(SPACE))
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(FINE)
    counted = rows.select(*KEYS, fault.alias("fault")).groupBy(*KEYS).agg(F.count("*").alias("copies"), F.max("fault").alias("fault"))
    place = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    said = ["id", "role", "digest"]
    first = counted.groupBy(*said).agg(F.min(place).alias("first"))
    joined = join_on(counted, first, said, "left", True)
    again = (F.col("fault") != BLANK) & ~place.eqNullSafe(F.col("first"))
    return joined.select(*KEYS, "copies", F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault"))


def blocks(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """Runs of up to ``size`` distinct turns of a conversation, solved from every state they may begin in."""
    ordered = turns.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    schema = (f"id {kinds['id']}, block long, turn array<{kinds['turn']}>, role array<string>, digest array<binary>, "
              "copies array<long>, fault array<int>, costs array<long>, orders array<long>, audits array<string>")
    names = ["id", "block", "turn", "role", "digest", "copies", "fault", "costs", "orders", "audits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        last, conversations, cut, held = None, 0, 0, []

        def close() -> tuple:
            nonlocal number
            columns = list(zip(*held, strict=True))
            plain = [(role[0] if role[:1] in ("s", "u", "a") else "", fault) for role, fault in zip(columns[1], columns[4], strict=True)]
            # only a partition's first conversation may have begun in the one before
            begins = cut == 0 and conversations > 1
            row = (last[0], number, *map(list, columns), *block_row(plain, range(1 if begins else 4)))
            number += 1
            return row

        for batch in batches:
            done = []
            fields = batch.schema
            types = [fields.field("id").type, pa.int64(), pa.list_(fields.field("turn").type), pa.list_(pa.string()), pa.list_(pa.binary()),
                     pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
            columns = [batch.column(c).to_pylist() for c in ("id", "turn", "role", "digest", "copies", "fault")]
            for name, *row in zip(*columns, strict=True):
                if last != (name,):
                    if held:
                        done.append(close())
                    last, conversations, cut, held = (name,), conversations + 1, 0, []
                elif len(held) == size:
                    done.append(close())
                    cut, held = cut + 1, []
                held.append(row)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(close(), types, strict=True)], names)

    return ordered.mapInArrow(run, schema)


def chosen(solved: DataFrame) -> DataFrame:
    """``block, place, tail``: the way taken through each block."""
    rows = solved.select("id", "block", "costs", "orders").repartition("id").sortWithinPartitions("id", F.desc("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def out(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.string()), strict=True)], ["block", "place", "tail"])

        for batch in batches:
            done = []
            for name, *row in zip(*(batch.column(c).to_pylist() for c in ("id", "block", "costs", "orders")), strict=True):
                if last != (name,) and held:
                    done += path(held)
                    held = []
                last = (name,)
                held.append(row)
            yield out(done)
        if held:
            yield out(path(held))

    return rows.mapInArrow(run, "block long, place int, tail string")


def lettered(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """Distinct turns with their ``letters``: inserts before a turn, its own edit and, at the end, inserts behind it."""
    solved = written(blocks(turns, size), "repair-blocks")
    way = solved.join(chosen(solved), "block")
    own = F.regexp_extract_all(F.element_at("audits", F.col("place") + 1), F.lit("I*[DKR]"), 0)
    rows = way.withColumn("letters", own).select(
        "id", "tail", F.size("turn").alias("n"), F.posexplode(F.arrays_zip("turn", "role", "digest", "copies", "fault", "letters")).alias("i", "x")
    )
    ends = F.when(F.col("i") == F.col("n") - 1, F.col("tail")).otherwise("")
    return rows.select("id", *[F.col("x")[c].alias(c) for c in ("turn", "role", "digest", "copies", "fault")], F.concat(F.col("x")["letters"], ends).alias("letters"))


EDIT = "edit string, cost long, fault string, given_role string, role string, text string"


def edits(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
          text_column: str = "text", block_turns: int = BLOCK) -> DataFrame:
    """Every edit in order: ``id, turn, edit, cost, fault, given_role, role, text``.

    ``edit`` is K, R, D or I. ``role`` and ``text`` are those of the repaired turn, null where it is deleted;
    ``given_role`` is null where a turn is inserted. A conversation's edits lie in order in one partition.
    """
    rows = _named(conversations, id_column, turn_column, role_column, text_column)
    plan = lettered(faulty(rows), block_turns)
    nothing = {c: F.lit(None).cast(t) for c, t in (("copies", "long"), ("fault", "int"), ("letters", "string"))}
    both = plan.withColumn("text", F.lit(None).cast("string")).unionByName(rows.withColumns(nothing))
    ordered = both.repartition("id").sortWithinPartitions(*KEYS, F.col("letters").isNull())
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, pending = None, START, None
        for batch in rounds(batches, "text"):
            out = []
            columns = [batch.column(c).to_pylist() for c in ("id", "turn", "role", "text", "copies", "fault", "letters")]
            for name, turn, role, text, copies, fault, letters in zip(*columns, strict=True):
                if last != (name,):
                    last, state = (name,), START
                if letters is not None:
                    pending = (copies, fault, letters)
                    continue
                if pending is None:  # a further copy of the turn before
                    continue
                (copies, fault, letters), pending = pending, None
                own = letters.rstrip("I")
                for letter in own[:-1]:
                    given, state = FITTING[state]
                    out.append((name, None, letter, INSERT, None, None, given, ""))
                extra = UNFINISHED if fault == TRUNCATED else 0
                if own[-1] == "K":
                    state = STEPS[state, role[0]]
                    out.append((name, turn, "K", extra, FAULTS[fault], role, role, text))
                elif own[-1] == "R":
                    given, state = FITTING[state]
                    out.append((name, turn, "R", REROLE + extra, FAULTS[fault], role, given, text))
                else:
                    out.append((name, turn, "D", DELETE, FAULTS[fault], role, None, None))
                again = FAULTS[BLANK if fault == BLANK else DUPLICATE]
                out += [(name, turn, "D", DELETE, again, role, None, None)] * (copies - 1)
                for letter in letters[len(own) :]:
                    given, state = FITTING[state]
                    out.append((name, None, letter, INSERT, None, None, given, ""))
            if out:
                types = [batch.schema.field("id").type, batch.schema.field("turn").type, pa.string(), pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    names = ["id", "turn", "edit", "cost", "fault", "given_role", "role", "text"]
    done = ordered.mapInArrow(run, f"id {kinds['id']}, turn {kinds['turn']}, {EDIT}")
    return done.withColumnsRenamed({"id": id_column, "turn": turn_column})


class Summary:
    """Counts and digests of one conversation's edits, taken in order."""

    def __init__(self):
        self.turns = self.least = self.most = self.before = None
        self.numbers = self.cost = self.illegal = 0
        self.faults = dict.fromkeys(FAULTS, 0)
        self.letters: list[str] = []
        self.repaired, self.any = sha256(), False

    def add(self, turn: int | None, edit: str, cost: int, fault: str | None, given: str | None, role: str | None, text: str | None) -> None:
        self.letters.append(edit)
        self.cost += cost
        if edit != "I":
            self.faults[fault] += 1
            if turn is not None and turn != self.most:
                self.numbers += 1
                self.least, self.most = turn if self.least is None else self.least, turn
            if self.before is not None and self.before + given[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = given[:1]
        if edit != "D":
            self.repaired.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True

    def row(self) -> tuple:
        gaps = self.most - self.least + 1 - self.numbers if self.numbers else 0
        return (gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal, self.cost,
                "".join(self.letters), self.repaired.hexdigest())


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summaries(done: DataFrame, id_column: str = "conv_id", turn_column: str = "turn") -> DataFrame:
    """One row for each conversation of ``edits``, which are taken as they lie in their partitions."""
    kind = done.schema[id_column].dataType.simpleString()
    names = [id_column, *COUNTS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, now, own = None, None, None

        def out(found: list[tuple]) -> pa.RecordBatch:
            types = [own, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            columns = list(zip(*found, strict=True)) or [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            found, own = [], batch.schema.field(id_column).type
            columns = [batch.column(c).to_pylist() for c in (id_column, turn_column, "edit", "cost", "fault", "given_role", "role", "text")]
            for name, *edit in zip(*columns, strict=True):
                if last != (name,):
                    if now:
                        found.append((*last, *now.row()))
                    last, now = (name,), Summary()
                now.add(*edit)
            yield out(found)
        if now:
            yield out([(*last, *now.row())])

    return done.mapInArrow(run, f"`{id_column}` {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def summarised(ids: DataFrame, conversations: DataFrame, id_column: str = "conv_id", **options) -> DataFrame:
    """The summary of every conversation in ``ids``; one without a turn has zeros, an empty audit and the digest of nothing."""
    found = summaries(edits(conversations, id_column, **options), id_column)
    joined = join_on(ids.select(id_column).distinct(), found, [id_column], "left", True)
    nothing: dict[str, Column] = {c: F.coalesce(c, F.lit(0).cast("long")) for c in COUNTS}
    nothing["audit"] = F.coalesce("audit", F.lit(""))
    nothing["repaired_sha256"] = F.coalesce("repaired_sha256", F.lit(sha256().hexdigest()))
    return joined.withColumns(nothing)
