"""Conversations whose turns are out of order, doubled, empty or cut: the cheapest edits that make them alternate again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED, SOUND = "blank", "duplicate", "truncated", ""
#: Edits and what they cost; a truncated row that stays costs one more. Their initials are the audit.
KEEP, REROLE, DELETE, INSERT = ("K", 0), ("R", 2), ("D", 3), ("I", 2)
#: States of ``(s?(ua)+)?``: nothing yet, after the system row, after a user row, after an assistant row. The first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: (state before, initial) -> state after.
NEXT = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT,
}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}


class Edit:
    """A node of the backpointer tree: one edit after its parent's. ``held`` counts the survivors that end here."""

    __slots__ = ("parent", "letter", "role", "text", "children", "held")

    def __init__(self, parent: Edit | None, letter: str, role: str | None, text: str):
        self.parent, self.letter, self.role, self.text = parent, letter, role, text
        self.children: list[Edit] = []
        self.held = 0
        if parent is not None:
            parent.children.append(self)


class Repair:
    """Viterbi over one conversation, row by row; ``audit`` and the hash grow as soon as an edit is certain.

    A survivor per state ends in a tree of backpointers. A branch no survivor needs is cut (its references are counted); what
    is left above the first fork is common to all survivors, so it is emitted and forgotten. Memory holds the unresolved rows only.

    Of equal costs the path with the smaller string of letters survives. Only the strings of survivors are ever compared, each with
    a few letters more, so the order of the complete strings is kept as a rank: a string that ends with the letter of a row is no prefix of
    another such string, hence ranks decide, and under equal ranks the inserts and the letter that follow do. A tie costs the same however long the tied suffixes are.
    """

    def __init__(self):
        self.root = Edit(None, "", None, "")
        self.hash, self.first, self.letters = hashlib.sha256(), True, []
        #: state -> (cost, rank, inserts after the last row, node)
        self.alive: dict[int, tuple[int, int, int, Edit]] = {}
        self._settle({START: (0, (0, ""), self.root)}, [])

    def add(self, role: str, text: str, fault: str) -> None:
        initial, more = role[:1], int(fault == TRUNCATED)
        best: dict[int, tuple[int, tuple[int, str], Edit, str, str | None]] = {}
        for state, (cost, rank, inserts, node) in self.alive.items():
            steps = [(state, cost + DELETE[1], DELETE[0], None)]
            if fault not in (BLANK, DUPLICATE):
                kept = NEXT.get((state, initial))
                if kept is not None:
                    steps.append((kept, cost + KEEP[1] + more, KEEP[0], role))
                turned = ASSISTANT if state == USER else USER
                steps.append((turned, cost + REROLE[1] + more, REROLE[0], ROLE[turned]))
            for after, price, letter, new_role in steps:
                found = (price, (rank, "I" * inserts + letter), node, letter, new_role)
                if after not in best or found[:2] < best[after][:2]:
                    best[after] = found
        old = [node for _, _, _, node in self.alive.values()]
        self._settle({state: (cost, key, Edit(node, letter, new_role, text)) for state, (cost, key, node, letter, new_role) in best.items()}, old)

    def _settle(self, best: dict[int, tuple[int, tuple[int, str], Edit]], old: list[Edit]) -> None:
        """Rank the survivors after a row, let them insert, release the old ones, emit what is certain."""
        ranks = {key: rank for rank, key in enumerate(sorted(key for _, key, _ in best.values()))}
        alive = {state: (cost, ranks[key], 0, node) for state, (cost, key, node) in best.items()}
        for state, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            found = min(((alive[s][0] + INSERT[1], alive[s][1], alive[s][2] + 1, s) for s in sources if s in alive), default=None)
            if found and (state not in alive or found[:3] < alive[state][:3]):
                alive[state] = (*found[:3], Edit(alive[found[3]][3], INSERT[0], ROLE[state], ""))
        # an assistant row may be followed by all that the first two states may, but for a system row, which it deletes instead
        least = min(alive[ASSISTANT][0], alive[USER][0] + INSERT[1])
        for state, price in ((START, least + DELETE[1]), (SYSTEM, least)):
            if state in alive and alive[state][0] > price:
                del alive[state]
        for _, _, _, node in alive.values():
            node.held += 1
        for node in old:
            node.held -= 1
        for node in {id(n): n for n in [*old, *[node for _, _, node in best.values()]]}.values():
            self._release(node)
        self.alive = alive
        while not self.root.held and len(self.root.children) == 1:
            self._emit(self.root.children[0])

    def _release(self, node: Edit) -> None:
        while node is not self.root and not node.held and not node.children and node.parent is not None:
            parent, node.parent = node.parent, None
            parent.children.remove(node)
            node = parent

    def _emit(self, node: Edit) -> None:
        self.root.children, node.parent, self.root = [], None, node
        self.letters.append(node.letter)
        if node.role is not None:
            self.hash.update(f"{'' if self.first else chr(10)}{node.role}:{node.text}".encode())
            self.first = False
        node.text = ""

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the cheapest path that may end."""
        cost, _, _, node = min((self.alive[s] for s in (START, ASSISTANT) if s in self.alive), key=lambda survivor: survivor[:3])
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for edit in reversed(path):
            self._emit(edit)
        return cost, "".join(self.letters), self.hash.hexdigest()


class Conversation:
    """What is known of a conversation while its rows pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.counts, self.illegal, self.turns = conv_id, {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}, 0, 0
        self.least = self.last_turn = self.last_role = None
        self.repair = Repair()

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if fault:
            self.counts[fault] += 1
        if self.last_role is not None and self.last_role + role[:1] not in LEGAL:
            self.illegal += 1
        self.last_role = role[:1]
        if turn is not None:
            self.turns += turn != self.last_turn
            self.least = turn if self.least is None else self.least
            self.last_turn = turn
        self.repair.add(role, text, fault)

    def row(self) -> tuple:
        gaps = 0 if self.least is None else min(self.last_turn - self.least + 1 - self.turns, 2**63 - 1)
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, *self.repair.end())


COLUMNS = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text and ``gone`` of rows damaged by the CRC of ``conv_id:turn``, to have something to repair.

    Of twenty equal shares one is dropped (``gone``), one emptied, one loses its ``.!?``, one is doubled, one gets the role user. NULL is one space.
    """
    text = F.coalesce(F.col(text_col), F.lit(" "))
    part = lambda name: F.coalesce(F.col(name).cast("bigint").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part(conv_col), F.lit(":"), part(turn_col))) % 20
    changed = rows.select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role_col), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("_times"),
    )
    return changed.select("conv_id", "turn", "role", "text", "gone", F.explode("_times").alias("_time")).drop("_time")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` by conversation, turn (NULL first), role and text, with the first ``fault`` of each. Rows that are ``gone`` have none.

    One shuffle, by conversation, serves the search for repeated rows and the order; both sort and spill on disk.
    """
    same = ["conv_id", "gone", "role", "text"]
    place = F.row_number().over(Window.partitionBy(*same).orderBy(F.asc_nulls_first("turn")))
    tail = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(F.col("gone"), SOUND).when(tail == "", BLANK).when(F.col("_place") > 1, DUPLICATE).when(~F.right(tail, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
    placed = rows.repartition("conv_id").withColumn("_place", place).withColumn("fault", fault.otherwise(SOUND))
    return placed.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "_place").drop("_place")


def repaired(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone_col: str | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, NULL first, those of one turn by role and text. ``gaps`` are the turns missing between the first and the last;
    ``illegal`` are neighbours whose roles do not follow each other. ``audit`` has a letter per edit: K(eep), R(erole), D(elete), I(nsert); ``repaired_sha256``
    is that of the repaired ``role:text`` lines. Rows that ``gone_col`` marks only name their conversation: one without other rows is empty. A NULL
    role or text is one space, rows without conversation are one conversation, other columns are not read. A conversation streams through one task, as the hash of its
    text demands; the task holds its unresolved rows, not the conversation.
    """
    wanted = rows.select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), F.coalesce(F.col(gone_col), F.lit(False)).alias("gone") if gone_col else F.lit(False).alias("gone"),
    )
    schema = pa.schema([pa.field(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in COLUMNS.split(", ")])

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv_id, turn, role, text, gone, fault in zip(*[column.to_pylist() for column in batch.columns]):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = Conversation(conv_id)
                if not gone:
                    now.add(turn, role, text, fault)
            if len(done) >= 1000:
                yield batch_of(done)
                done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield batch_of(done)

    return with_faults(wanted).mapInArrow(walked, COLUMNS)
