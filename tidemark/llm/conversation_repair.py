"""Repair of the structure of conversations by a cheapest sequence of edits.

A conversation is sound if its roles are an optional system turn and then pairs of user and
assistant, or if it is empty. Each turn is kept, given another role or deleted, and empty turns
may be inserted; of the cheapest edits, those whose initials come first by ASCII count.

Costs are found by the Viterbi recursion from the end of a conversation, in chunks at once: each
chunk starts from a speculated vector of costs (of the four states that the turns before it may
leave) and, where the chunk behind it ends in another one, is run again until the vectors differ
by a constant only; from there on its decisions are the same. The stitched vectors then drive a
trace from the start.
"""

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_settings
from tidemark.session import store

#: Turns of a chunk.
CHUNK = 4096
BLANKS = " \t\n\x0b\x0c\r"
#: Of a text that is longer, rows of one turn and role are ordered by so many characters and md5.
PREFIX = 64

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after an inserted or rerolled turn, and its role's initial.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("u", "u", "a", "u")
#: State after a kept turn, by the initial of its role.
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT},
        "": {}}
CLASSES = ("s", "u", "a", "")
SOUND, CUT_OFF, UNWANTED = range(3)
REROLE_COST, DELETE_COST, INSERT_COST, CUT_OFF_COST = 2, 3, 2, 1
#: Cost of what is inserted at the end.
END = (0, 2 * INSERT_COST, INSERT_COST, 0)
AT_END = ("", "ua", "a", "")


@dataclass
class Step:
    """The costs before a turn, less their minimum, and for each state what to do with it:
    the roles inserted before, the edit (``D``, ``K``, or the new role) and the state after."""
    shape: tuple
    edits: list[tuple[str, str, int]]


class Machine:
    """The recursion over coded turns. Steps depend on the costs behind a turn up to a constant
    and on its code only, so each is worked out once."""

    def __init__(self):
        self.steps: dict[tuple, Step] = {}

    def step(self, behind: tuple, code: str) -> Step:
        found = self.steps.get((behind, code))
        if found is None:
            found = self.steps[behind, code] = self._step(behind, *divmod(ord(code) - 65, 3))
        return found

    @staticmethod
    def _step(behind: tuple, role: int, fault: int) -> Step:
        own = []
        for state in range(4):
            ways = [(DELETE_COST + behind[state], "D", "D", state)]
            if fault != UNWANTED:
                more = CUT_OFF_COST if fault == CUT_OFF else 0
                to = KEEP[CLASSES[role]].get(state)
                if to is not None:
                    ways.append((more + behind[to], "K", "K", to))
                ways.append((REROLE_COST + more + behind[NEXT[state]], "R", ROLE[state], NEXT[state]))
            own.append(min(ways))
        costs = [min(own[q][0], INSERT_COST + own[NEXT[q]][0],
                     2 * INSERT_COST + own[NEXT[NEXT[q]]][0]) for q in range(4)]
        edits = []
        for state in range(4):
            before, q = "", state
            # By ASCII: delete, insert, keep, rerole.
            while (own[q][0] != costs[q] or own[q][1] != "D") and (
                    INSERT_COST + costs[NEXT[q]] == costs[q]):
                before, q = before + ROLE[q], NEXT[q]
            edits.append((before, own[q][2], own[q][3]))
        least = min(costs)
        return Step(tuple(c - least for c in costs), edits)

    def before(self, codes: str, behind: tuple) -> tuple:
        """The costs before a chunk."""
        for code in reversed(codes):
            behind = self.step(behind, code).shape
        return behind

    def again(self, codes: str, behind: tuple, tried: tuple, was: tuple) -> tuple:
        """The costs before a chunk that had ``was`` when ``tried`` was behind it: turns are run
        again only until both differ by a constant."""
        for code in reversed(codes):
            if behind == tried:
                return was
            behind, tried = self.step(behind, code).shape, self.step(tried, code).shape
        return behind

    def trace(self, codes: str, behind: tuple) -> list[Step]:
        steps = []
        for code in reversed(codes):
            steps.append(self.step(behind, code))
            behind = steps[-1].shape
        return steps[::-1]

    def exits(self, codes: str, behind: tuple) -> list[int]:
        """The state after a chunk for each state before it."""
        states = list(range(4))
        for step in self.trace(codes, behind):
            states = [step.edits[q][2] for q in states]
        return states

    def edits(self, codes: str, behind: tuple, state: int, last: bool) -> tuple[list[str], str, int]:
        """Of each turn ``before:edit:after``, the edits' initials, and their cost."""
        each, audit, cost = [], [], 0
        for code, step in zip(codes, self.trace(codes, behind)):
            before, edit, state = step.edits[state]
            each.append(f"{before}:{edit}:")
            audit.append("I" * len(before) + (edit if edit in "DK" else "R"))
            cost += INSERT_COST * len(before)
            if edit == "D":
                cost += DELETE_COST
            else:
                cost += REROLE_COST * (edit != "K") + CUT_OFF_COST * ((ord(code) - 65) % 3 == CUT_OFF)
        if last:
            each[-1] += AT_END[state]
            audit.append("I" * len(AT_END[state]))
            cost += INSERT_COST * len(AT_END[state])
        return each, "".join(audit), cost


def _illegal(codes: str) -> int:
    roles = [CLASSES[(ord(c) - 65) // 3] for c in codes]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


def _vector(text: str) -> tuple:
    return tuple(map(int, text.split(",")))


def _text(vector: tuple) -> str:
    return ",".join(map(str, vector))


def _each_row(compute, schema: str):
    """A function over batches from one of rows (dictionaries) in their order."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        memory = {"machine": Machine()}
        for batch in batches:
            done = [compute(row, memory) for row in batch.to_pylist()]
            if done:
                yield from pa.Table.from_pylist(done, _arrow(batch.schema, schema)).select(
                    names).to_batches()

    return run


def _arrow(given: pa.Schema, schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    fields = []
    for column in schema.split(", "):
        name, kind = column.split()
        fields.append(given.field(name) if kind == "same" else pa.field(name, kinds[kind]))
    return pa.schema(fields)


def _mapped(rows: DataFrame, compute, schema: str) -> DataFrame:
    """``compute`` over the rows; a column of kind ``same`` has the type that it has in them."""
    known = dict(rows.dtypes)
    spark_schema = ", ".join(
        f"{c.split()[0]} {known[c.split()[0]] if c.split()[1] == 'same' else c.split()[1]}"
        for c in schema.split(", "))
    return rows.mapInArrow(_each_row(compute, schema), spark_schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Turns with the faults that a hash of their id and place calls for: one of twenty each is
    left out, emptied, robbed of its full stops, repeated, or given to the user. A null
    conv_id, turn, role or text counts as one blank (a null turn keeps its null)."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("_d")).where("_d <> 0")
    d, text = F.col("_d"), F.col("text")
    copies = F.explode(F.array_repeat(F.lit(0), F.when(d == 3, 2).otherwise(1)))
    return rows.select(
        "conv_id", "turn", F.when(d == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(d == 1, F.lit("")).when(d == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        copies.alias("_copy")).drop("_copy")


def _placed(turns: DataFrame) -> DataFrame:
    """The turns with ``_at``, a number that rises with their order, dealt out in that order."""
    space = F.lit(" ")
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                        F.coalesce("text", space).alias("text"))
    rows = rows.withColumns({"_md5": F.md5("text"), "_prefix": F.substring("text", 1, PREFIX)})
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "_prefix", "_md5"]
    dealt = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*order, "_salt")
    numbered = dealt.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return store(numbered.drop("_salt", "_prefix"), "turns")


def join_null_safe(a: DataFrame, b: DataFrame, *columns: str, how: str = "left") -> DataFrame:
    """Join on conv_id, nulls being equal, and other columns; ``a`` keeps them."""
    keys = ["conv_id", *columns]
    other = b.withColumnsRenamed({c: f"_b_{c}" for c in keys})
    on = F.col("conv_id").eqNullSafe(F.col("_b_conv_id"))
    for c in columns:
        on = on & (F.col(c) == F.col(f"_b_{c}"))
    return a.join(other, on, how).drop(*[f"_b_{c}" for c in keys])


def _marked(placed: DataFrame) -> DataFrame:
    """conv_id, _at, the fault of each turn and its code, a letter for role and fault."""
    bare = F.btrim(F.col("text"), F.lit(BLANKS))
    rows = placed.select(
        "conv_id", "_at", "role", "_md5", (bare == "").alias("_blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("_cut"))
    firsts = rows.where("not _blank").groupBy("conv_id", "role", "_md5").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    joined = join_null_safe(rows, firsts, "role", "_md5")
    fault = (F.when(F.col("_blank"), "blank").when(F.col("_at") > F.col("_first"), "duplicate")
             .when(F.col("_cut"), "truncated").otherwise(""))
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = F.when(F.col("_fault").isin("blank", "duplicate"), UNWANTED).when(
        F.col("_fault") == "truncated", CUT_OFF).otherwise(SOUND)
    return joined.withColumn("_fault", fault).select(
        "conv_id", "_at", "_fault", F.char(65 + 3 * role + kind).alias("_code"))


def _chunks(marked: DataFrame) -> DataFrame:
    """Up to ``CHUNK`` turns of a conversation as a row: their codes, what the turns before and
    behind them are, and how many have which fault."""
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(2**33 - 1))
    codes = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_at", "_code"))), lambda x: x["_code"]), "")
    found = marked.groupBy(
        "conv_id", part.alias("_part"), F.floor(inside / CHUNK).alias("_slice")
    ).agg(
        F.min("_at").alias("at"), codes.alias("codes"),
        *(F.count(F.when(F.col("_fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    order = Window.partitionBy("conv_id").orderBy("at")
    before = F.coalesce(F.lag(F.right("codes", F.lit(1))).over(order), F.lit(""))
    return found.select(
        "conv_id", F.row_number().over(order).alias("seq"), "at", "codes", "blank", "duplicate",
        "truncated", before.alias("before"),
        F.lead("at").over(order).isNull().cast("int").alias("last"),
    )


def _speculate(row, memory):
    machine = memory["machine"]
    return row | {"behind": _text(END), "ahead": _text(machine.before(row["codes"], END))}


def _fix(row, memory):
    """One chunk of a group that comes last chunk first."""
    machine, group = memory["machine"], (row["conv_id"], row["_group"])
    if memory.get("group") == group:
        behind = memory["ahead"]
    else:
        behind = _vector(row["_behind"] or row["behind"])
    tried, was = _vector(row["behind"]), _vector(row["ahead"])
    ahead = machine.again(row["codes"], behind, tried, was)
    memory["group"], memory["ahead"] = group, ahead
    return row | {"behind": _text(behind), "ahead": _text(ahead)}


def _exits(row, memory):
    states = memory["machine"].exits(row["codes"], _vector(row["behind"]))
    return row | {"exits": _text(states)}


def _entries(row, memory):
    state = 0 if row["seq"] == 1 else memory["state"]
    memory["state"] = _vector(row["exits"])[state]
    return row | {"entry": state}


def _edited(row, memory):
    each, audit, cost = memory["machine"].edits(
        row["codes"], _vector(row["behind"]), row["entry"], bool(row["last"]))
    illegal = _illegal(row["before"] + row["codes"])
    return row | {"edits": ",".join(each), "audit": audit, "cost": cost, "illegal": illegal}


STATE = "conv_id same, seq int, last int, codes string, behind string, ahead string"


def _stitched(chunks: DataFrame) -> DataFrame:
    """conv_id, seq, behind and entry of all chunks: the costs behind each up to a constant, and
    the state in which its first turn finds the conversation.

    A pass runs groups of neighbouring chunks from the last one on, with the costs that the
    pass before left behind each group, and changes those only that had begun from others.
    Groups double from pass to pass, so however slowly vectors converge, the passes are no more
    than the logarithm of a conversation's chunks; mostly the first one is the last.
    """
    now = store(_mapped(chunks.select("conv_id", "seq", "last", "codes"), _speculate, STATE), "costs")
    span = 1
    while True:
        behind = now.select(
            "conv_id", (F.col("seq") - 1).alias("seq"), F.col("ahead").alias("_behind"))
        joined = store(join_null_safe(now, behind, "seq"), "costs")
        if joined.where("_behind <> behind").isEmpty():
            break
        grouped = joined.withColumn("_group", F.floor(F.col("seq") / span)).repartition(
            "conv_id", "_group").sortWithinPartitions("conv_id", "_group", F.desc("seq"))
        now = store(_mapped(grouped, _fix, STATE), "costs")
        span *= 2
    states = _mapped(now, _exits, "conv_id same, seq int, behind string, exits string")
    walked = states.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return _mapped(walked, _entries, "conv_id same, seq int, behind string, entry int")


@dataclass
class Repair:
    """``turns``: conv_id, _at and _k (their order), turn (null if inserted), role, text and
    edit of what the repaired conversations hold. ``report``: one row per conversation that has
    turns: blank, duplicate, truncated, illegal, cost and audit."""
    turns: DataFrame
    report: DataFrame


def repair(turns: DataFrame) -> Repair:
    """The cheapest repair of each conversation of turns (conv_id, turn, role, text).

    Turns are ordered by turn, nulls first, then by role and text. Null roles and texts count as
    one blank; rows without a conv_id are one conversation; an empty table gives empty ones.
    A role counts by its first letter, so of other roles than system, user and assistant turns
    are rerolled or deleted. Deleting costs 3, another role 2, an inserted turn 2, keeping a
    text that does not end in one of ``.!?`` 1; blank turns and those whose role and text were
    seen before are deleted. Other columns are not read.

    A conversation of any size spreads over tasks: its turns are range-partitioned, and chunks
    of ``CHUNK`` turns are worked on apart. Only its chunks' costs, and its audit, meet.
    """
    arrow_settings(turns.sparkSession)
    placed = _placed(turns)
    chunks = store(_chunks(_marked(placed)), "chunks")
    whole = chunks.where("seq = 1 and last = 1").withColumns(
        {"behind": F.lit(_text(END)), "entry": F.lit(0)})
    parts = chunks.where("seq <> 1 or last <> 1")
    parts = join_null_safe(parts, _stitched(parts), "seq", how="inner")
    known = "conv_id same, seq int, at long, blank long, duplicate long, truncated long, "
    done = store(_mapped(whole.unionByName(parts), _edited, known + (
        "edits string, audit string, cost long, illegal long")), "edits")
    audit = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("seq", "audit"))), lambda x: x["audit"]), "")
    report = done.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        audit.alias("audit"))
    return Repair(_repaired(placed, done), report)


def _repaired(placed: DataFrame, done: DataFrame) -> DataFrame:
    each = done.select("at", F.posexplode(F.split("edits", ",")).alias("_i", "_edit")).select(
        (F.col("at") + F.col("_i")).alias("_at"), F.split("_edit", ":").alias("_edit"))
    rows = placed.join(each, "_at")

    def names(initial: Column) -> Column:
        return F.when(initial == "u", F.lit("user")).otherwise(F.lit("assistant"))

    def inserted(k: int) -> Column:
        return F.transform(F.filter(F.split(F.col("_edit")[k], ""), lambda c: c != ""), lambda c: F.struct(
            F.lit(None).cast(placed.schema["turn"].dataType).alias("turn"), names(c).alias("role"),
            F.lit("").alias("text"), F.lit("I").alias("edit")))

    edit = F.col("_edit")[1]
    own = F.array(F.struct(
        F.col("turn"), F.when(edit == "K", F.col("role")).otherwise(names(edit)).alias("role"),
        F.col("text"), F.when(edit == "K", F.lit("K")).otherwise(F.lit("R")).alias("edit")))
    kept = F.filter(own, lambda _: edit != "D")
    return rows.select(
        "conv_id", "_at", F.posexplode(F.concat(inserted(0), kept, inserted(2))).alias("_k", "_t")
    ).select("conv_id", "_at", "_k", "_t.*")


def gaps(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps): how many turns between the first and the last are missing; nulls do not
    count, and a conversation of nulls only has none."""
    wide = [F.col(c).cast("decimal(38,0)") for c in ("_last", "_first")]
    n = (wide[0] - wide[1] + 1 - F.col("_n")).try_cast("long")
    return turns.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.min("turn").alias("_first"), F.max("turn").alias("_last"), F.count("turn").alias("_n"),
    ).select("conv_id", F.when(F.col("_n") == 0, 0).otherwise(n).cast("long").alias("gaps"))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's ``role:text`` lines in order. A hash of a whole
    can only be taken from its start to its end, so a conversation streams through one task;
    none is held."""
    lines = turns.select("conv_id", "_at", "_k", F.concat_ws(":", "role", "text").alias("_line"))
    sorted_ = lines.repartition("conv_id").sortWithinPartitions("conv_id", "_at", "_k")
    kind = dict(turns.dtypes)["conv_id"]

    def run(batches):
        now, state = None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], given), pa.array([state.hexdigest()])], ["conv_id", "sha256"])

        for batch in batches:
            given = batch.schema.field("conv_id").type
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or conv != now:
                    if state is not None:
                        yield done()
                    now, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
        if state is not None:
            yield done()

    return sorted_.select("conv_id", "_line").mapInArrow(run, f"conv_id {kind}, sha256 string")
