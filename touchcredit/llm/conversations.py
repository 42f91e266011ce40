"""Conversation structure repair: survivor-coalescence Viterbi over the turns of each conversation.

A conversation is legal if the initials of its roles are ``(s?(ua)+)?``: nothing,
or a system turn at most once and first, then pairs of user and assistant. Each
turn is kept (cost 0), given the role the place needs (1) or deleted (2); empty
turns can be put in anywhere (5); a truncated turn that stays costs 5 more;
blank and duplicate turns must go. The cheapest edits win, ties by the least
string of edit initials (D, I, K, R).

The turns of a conversation stream through one pass in order. The four states of
the pattern each keep one survivor, a leaf of a tree of back pointers whose nodes
count their references. A node that no survivor descends from is freed, and as
soon as all survivors share an ancestor, the edits up to it are final: they are
emitted and forgotten, so memory holds only what is unresolved, not the
conversation. Survivors that can no longer win are dropped, which is what lets
the others meet: if state ``y`` can follow everything that state ``x`` may still
do at ``EXTRA[y][x]`` more, ``x`` is lost once it costs more than that above ``y``.

Ties are between complete unresolved edit strings. These have used up the same
turns and end in a turn's edit, so none is the beginning of another, and the
order of two survivors' strings settles that of everything that follows: each
survivor carries its rank among the unresolved strings, renewed at every turn.

Turns meet by ``conv_id`` in one shuffle; a conversation is one stream by the
nature of its sequential digest, but it is never held as a whole.

Defined cases: a null role or text is one space; null ``conv_id`` is a
conversation of its own; null turns come first, equal turns are ordered by role
and text; roles count by their first character; conversations without rows keep
their line with zeros; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
BLANK, DUPLICATE, TRUNCATED, SOUND, DROPPED = 1, 2, 3, 0, -1
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What state y (row) pays at most beyond state x (column) to follow any completion of x.
EXTRA = (
    (0, 0, 5, 0),      # nothing yet: put a user in where the next one is an assistant
    (10, 0, 5, 10),    # after system: a pair must follow even where x may end; a system turn is deleted instead of kept
    (7, 5, 0, 5),      # after user: put an assistant in first, and delete a system turn
    (2, 0, 5, 0),      # after assistant: delete a system turn that x would keep
)
LEGAL = ("su", "ua", "au")


class Node:
    """An edit in the tree of back pointers; ``children`` are the live nodes that continue it."""

    __slots__ = ("parent", "children", "held", "edits")

    def __init__(self, parent: Node | None, edits: list[tuple]):
        self.parent, self.children, self.held, self.edits = parent, [], 0, edits

    def release(self) -> None:
        """Let go of a survivor's hold and free what only led to it."""
        self.held -= 1
        node = self
        while not node.held and not node.children and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            node.parent = None
            node = parent


class Repair:
    """The survivors of one conversation. ``emit(edit, place, role, text)`` receives the final edits in order.

    ``place`` numbers the turns as given; an inserted turn has None.
    """

    def __init__(self, emit: Callable[[str, int | None, str | None, str | None], None]):
        self.emit = emit
        self.root = Node(None, [])
        self.root.held = 1
        self.survivors = {START: (0, 0, self.root)}       # state: (cost, rank, leaf)
        self.place = 0
        self.unresolved = 0

    def turn(self, role: str, text: str, fault: int) -> None:
        initial, place = role[:1], self.place
        self.place += 1
        stay = TRUNCATED_COST if fault == TRUNCATED else 0
        found: dict[int, tuple] = {}

        def offer(state: int, cost: int, rank: int, marks: str, leaf: Node, edits: list[tuple]) -> None:
            if state not in found or (cost, rank, marks) < found[state][:3]:
                found[state] = (cost, rank, marks, leaf, edits)

        for state, (cost, rank, leaf) in self.survivors.items():
            offer(state, cost + DELETE_COST, rank, "D", leaf, [("D", place, None, None)])
            if fault in (BLANK, DUPLICATE):
                continue
            if initial == "s" and state == START:
                offer(SYSTEM, cost + KEEP_COST + stay, rank, "K", leaf, [("K", place, role, text)])
            # the role due here, and the one due after an inserted turn
            due, later = ("assistant", "user") if state == USER else ("user", "assistant")
            for name, marks, more, before in ((due, "", 0, []), (later, "I", INSERT_COST, [("I", None, due, "")])):
                kept = initial == name[0]
                mark, price = ("K", KEEP_COST) if kept else ("R", ROLE_COST)
                offer(USER if name == "user" else ASSISTANT, cost + more + price + stay, rank, marks + mark, leaf,
                      [*before, (mark, place, role if kept else name, text)])
        self.advance(found)

    def advance(self, found: dict[int, tuple]) -> None:
        """Make the best offers the survivors, drop those that cannot win, and emit what they all share."""
        live = {x: c for x, c in found.items() if not any(o[0] + EXTRA[y][x] < c[0] for y, o in found.items())}
        before = [leaf for _, _, leaf in self.survivors.values()]
        self.survivors = {}
        for rank, (state, (cost, _, _, leaf, edits)) in enumerate(sorted(live.items(), key=lambda x: x[1][1:3])):
            node = Node(leaf, edits)
            node.held = 1
            leaf.children.append(node)
            self.survivors[state] = (cost, rank, node)
        self.unresolved += 1
        for leaf in before:
            leaf.release()
        while not self.root.held and len(self.root.children) == 1:
            self.root = self.root.children.pop()
            self.root.parent = None
            self.unresolved -= 1
            for edit in self.root.edits:
                self.emit(*edit)

    def finish(self) -> int:
        """Emit the rest; the cost of all edits."""
        ends = []
        for state, (cost, rank, leaf) in self.survivors.items():
            missing = {SYSTEM: ("user", "assistant"), USER: ("assistant",)}.get(state, ())
            ends.append((cost + INSERT_COST * len(missing), rank, leaf, missing))
        cost, _, leaf, missing = min(ends, key=lambda x: x[:2])
        path = []
        while leaf is not self.root:
            path.append(leaf)
            leaf = leaf.parent
        for node in reversed(path):
            for edit in node.edits:
                self.emit(*edit)
        for role in missing:
            self.emit("I", None, role, "")
        return cost


def has_words(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def faults(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, dropped) dealt and sorted by conversation, with the column ``fault``."""
    dealt = turns.repartition("conv_id")
    # the conversation's partitioning serves this window too
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = (F.when(F.col("dropped"), DROPPED).when(~has_words(F.col("text")), BLANK)
             .when(F.row_number().over(same) > 1, DUPLICATE).when(cut, TRUNCATED).otherwise(SOUND))
    return (dealt.withColumn("fault", fault.cast("int")).drop("dropped")
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text"))


def as_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    filled = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), filled(role_col).alias("role"),
                                filled(text_col).alias("text"), F.lit(False).alias("dropped"))


def by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """(whether a conversation begins, its (conv_id, turn, role, text, fault)) of sorted rows."""
    last = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield last is None or row[0] != last[0], row
            last = (row[0],)


def repair(turns: DataFrame) -> DataFrame:
    """The edits of every conversation in order: (conv_id, step, edit, place, role, text).

    ``edit`` is K, R, D or I; ``place`` the number of the turn as given (null for I); role and text are those of the
    repaired turn, null for D.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        state: dict = {"repair": None, "conv": None, "step": 0}

        def emit(*edit) -> None:
            out.append((state["conv"], state["step"], *edit))
            state["step"] += 1

        for begins, (conv, _, role, text, fault) in by_conversation(batches):
            if begins:
                if state["repair"]:
                    state["repair"].finish()
                state.update(repair=Repair(emit), conv=conv, step=0)
            if fault != DROPPED:
                state["repair"].turn(role, text, fault)
            if len(out) >= 2_000:
                yield from batch_of(out, schema)
                out.clear()
        if state["repair"]:
            state["repair"].finish()
        yield from batch_of(out, schema)

    sorted_turns = faults(turns).select("conv_id", "turn", "role", "text", "fault")
    conv = turns.schema["conv_id"].dataType
    schema = arrow_schema(conv, [("step", pa.int64()), ("edit", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return sorted_turns.mapInArrow(run, f"conv_id {conv.simpleString()}, step long, edit string, place long, role string, text string")


def audit(turns: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Counts are of the turns as given. ``audit`` has the initials of the edits, ``repaired_sha256`` digests the repaired
    ``role:text`` lines; both are fed edit by edit as the repair emits them.
    """
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: dict = {}

        def emit(edit: str, place, role, text) -> None:
            now["audit"].append(edit)
            if edit != "D":
                line = f"{role}:{text}" if now["empty"] else f"\n{role}:{text}"
                now["digest"].update(line.encode("utf-8"))
                now["empty"] = False

        def close() -> tuple:
            cost = now["repair"].finish()
            gaps = now["hi"] - now["lo"] + 1 - now["turns"] if now["turns"] else 0
            return (now["conv"], gaps, now[BLANK], now[DUPLICATE], now[TRUNCATED], now["illegal"], cost, "".join(now["audit"]),
                    now["digest"].hexdigest())

        for begins, (conv, turn, role, text, fault) in by_conversation(batches):
            if begins:
                if now:
                    out.append(close())
                now.update({"conv": conv, "repair": Repair(emit), "audit": [], "digest": hashlib.sha256(), "empty": True, "lo": 0, "hi": 0,
                            "turns": 0, "last": None, "illegal": 0, BLANK: 0, DUPLICATE: 0, TRUNCATED: 0, SOUND: 0})
            if fault == DROPPED:
                continue
            now[fault] += 1
            if turn is not None and (not now["turns"] or turn != now["hi"]):
                now["lo"], now["hi"], now["turns"] = turn if not now["turns"] else now["lo"], turn, now["turns"] + 1
            if now["last"] is not None and now["last"] + role[:1] not in LEGAL:
                now["illegal"] += 1
            now["last"] = role[:1]
            now["repair"].turn(role, text, fault)
            if len(out) >= 2_000:
                yield from batch_of(out, schema)
                out.clear()
        if now:
            out.append(close())
        yield from batch_of(out, schema)

    sorted_turns = faults(turns).select("conv_id", "turn", "role", "text", "fault")
    conv = turns.schema["conv_id"].dataType
    schema = arrow_schema(conv, [*((x, pa.int64()) for x in names), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return sorted_turns.mapInArrow(run, f"conv_id {conv.simpleString()}, {', '.join(f'{x} long' for x in names)}, audit string, repaired_sha256 string")


def arrow_schema(conv, fields: list[tuple]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema([("conv_id", to_arrow_type(conv)), *fields])


def batch_of(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with one kind of damage by crc32 of ``conv_id:turn`` modulo 20; dropped turns stay as marked lines.

    0 drops the turn, 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 makes it a user's.
    """
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))) % 20
    text = (F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    return turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                        (F.col("dropped") | (kind == 0)).alias("dropped"), F.when(kind == 3, 2).otherwise(1).alias("times")).select(
        "conv_id", "turn", "role", "text", "dropped", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).drop("copy")
