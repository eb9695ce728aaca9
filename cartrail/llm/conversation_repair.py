"""Conversation structure repair: the cheapest, audit-least edits, found by Hirschberg's divide and conquer.

A conversation's roles must read ``(s?(ua)+)?`` by their initials. Between two rows the structure is in one of four
states: nothing yet, after a system row, after a user row, after an assistant row. Costs of reaching a state from
the front and of going on to the end are vectors of four; where they meet in the middle, the crossing with the
least audit among the cheapest is taken, and both halves are solved alike, so no table of all rows is kept.

On a cluster the same is done with the parts of a conversation. Rows are range-sorted once; a conversation inside
one partition is repaired where it lies. Those that touch a partition's border, two per partition at most, become
segments: each segment brings its costs from every state to every state, the states at the borders follow from
these, and then every segment is repaired by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import ship, written

#: states between rows
START, SYSTEM, USER, ASSISTANT = range(4)
#: by state and initial of the next row (s, u, a: 0 to 2): the state after it
AFTER = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
#: initials that may stand side by side
LEGAL = {(0, 1), (1, 2), (2, 1)}
ROLES = {USER: "user", ASSISTANT: "assistant"}
RENAME, REMOVE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1
#: the code of a row that must go; others have twice their initial's number (3: any other), plus 1 if truncated
GOES = 8
#: conversations whose repairs a worker remembers, and the longest of these
REMEMBERED, SHORT = 1 << 15, 64
#: by state: where inserted rows lead without coming back to it
INSERTED = [
    [(START, ""), (USER, "I"), (ASSISTANT, "II")],
    [(SYSTEM, ""), (USER, "I"), (ASSISTANT, "II")],
    [(USER, ""), (ASSISTANT, "I")],
    [(ASSISTANT, ""), (USER, "I")],
]
LARGEST = 2**63 - 1


def edits() -> list[list[list[tuple[int, int, str]]]]:
    """By code of a row and state before it: ``(state after, cost, letters)``, the best for each state after.

    Letters are those of rows inserted before the row, and then the row's own: Keep, Rerole or Delete.
    """
    table = []
    for code in range(GOES + 1):
        by_state = []
        for ways in INSERTED:
            best: dict[int, tuple[int, str]] = {}
            for state, letters in ways:
                options = [(state, REMOVE, "D")]
                if code != GOES:
                    initial, truncated = divmod(code, 2)
                    options += [(AFTER[state, i], RENAME + truncated * LEFT_TRUNCATED, "R") for i in (1, 2) if (state, i) in AFTER]
                    if (state, initial) in AFTER:
                        options.append((AFTER[state, initial], truncated * LEFT_TRUNCATED, "K"))
                for after, cost, letter in options:
                    option = cost + INSERT * len(letters), letters + letter
                    best[after] = min(best.get(after, option), option)
            by_state.append([(after, cost, letters) for after, (cost, letters) in best.items()])
        table.append(by_state)
    return table


EDITS = edits()
#: what must be inserted at the end, by state: cost and letters
TAIL = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}


def forward(codes: Sequence[int], entries: Iterable[int]) -> dict[tuple[int, int], tuple[int, int]]:
    """By entry and state after the rows: the least cost, and the place of the least audit among all of these.

    Audits end in a row's own letter here and have one such letter per row, so none begins another, and their
    order after a row follows from the order before it and the letters added.
    """
    held = {(entry, entry): (0, 0) for entry in entries}
    for code in codes:
        found: dict[tuple[int, int], tuple[int, int, str]] = {}
        for (entry, state), (cost, place) in held.items():
            for after, more, letters in EDITS[code][state]:
                option = cost + more, place, letters
                if (entry, after) not in found or option < found[entry, after]:
                    found[entry, after] = option
        places = {key: i for i, key in enumerate(sorted({option[1:] for option in found.values()}))}
        held = {slot: (option[0], places[option[1:]]) for slot, option in found.items()}
    return held


def backward(codes: Sequence[int], leave: int) -> dict[int, tuple[int, int]]:
    """By state before the rows: the least cost of reaching ``leave`` after them, and the audit's place."""
    held = {leave: (0, 0)}
    for code in reversed(codes):
        found: dict[int, tuple[int, str, int]] = {}
        for state in range(4):
            options = [(held[q][0] + more, letters, held[q][1]) for q, more, letters in EDITS[code][state] if q in held]
            if options:
                found[state] = min(options)
        places = {key: i for i, key in enumerate(sorted({option[1:] for option in found.values()}))}
        held = {state: (option[0], places[option[1:]]) for state, option in found.items()}
    return held


def crossing(codes: Sequence[int], enter: int, leave: int) -> list[str]:
    """The letters for each row of the cheapest, audit-least way between two states."""
    if not codes:
        return []
    if len(codes) == 1:
        return [letters for after, _, letters in EDITS[codes[0]][enter] if after == leave]
    middle = len(codes) // 2
    ahead, behind = forward(codes[:middle], [enter]), backward(codes[middle:], leave)
    options = []
    for (_, state), (cost, place) in ahead.items():
        if state in behind:
            options.append((cost + behind[state][0], place, behind[state][1], state))
    state = min(options)[3]
    return crossing(codes[:middle], enter, state) + crossing(codes[middle:], state, leave)


def whole_repair(codes: bytes) -> tuple[int, list[str], str]:
    """Cost, letters by row, and letters at the end, for all rows of a conversation."""
    ends = [(cost + TAIL[state][0], place, TAIL[state][1], state) for (_, state), (cost, place) in forward(codes, [START]).items()]
    cost, _, tail, state = min(ends)
    return cost, crossing(codes, START, state), tail


remembered_repair = lru_cache(REMEMBERED)(whole_repair)


def edited(letters: Iterable[str], rows: Iterable[tuple[int, str, str]], state: int) -> Iterator[tuple[str, str, str]]:
    """``(role, text, edit)`` of the rows that are left, with the inserted ones, from rows ``(initial, role, text)``."""
    held = iter(rows)
    for some in letters:
        for letter in some:
            initial, role, text = next(held) if letter != "I" else (None, "", "")
            if letter == "D":
                continue
            if letter == "K":
                state = AFTER[state, initial]
            else:
                state = ASSISTANT if state == USER else USER
                role = ROLES[state]
            yield role, text, letter


class Segment:
    """Rows of one conversation in order, without their texts: faults, codes, turns and the initials at the ends."""

    def __init__(self, seen: set[tuple[str, bytes]]) -> None:
        self.seen = seen
        self.codes = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.least = self.most = None
        self.turns = 0

    def add(self, turn: int | None, role: str, digest: bytes, kind: int) -> None:
        """``kind`` is three times the number of the initial, plus 1 for truncated texts and 2 for blank ones."""
        initial, fault = divmod(kind, 3)
        if self.first is None:
            self.first = initial
        elif (self.last, initial) not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        known = (role, digest) in self.seen
        self.seen.add((role, digest))
        if fault == 2:
            self.blank += 1
        elif known:
            self.duplicate += 1
        elif fault == 1:
            self.truncated += 1
        self.codes.append(GOES if fault == 2 or known else 2 * initial + fault)

    def gaps(self) -> int:
        return 0 if self.least is None else min(self.most - self.least + 1 - self.turns, LARGEST)


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_REPORT_KINDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROW_KINDS = "seq long, turn long, role string, text string, digest binary, kind int, edit string"
_SKINNY = ("key", "part", "seq", "turn", "role", "digest", "kind")


def prepared(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, key, turn, role, text, digest, kind``; ``key`` is the conversation's id as text that is never NULL."""
    conv = F.col(f"`{conv_id}`")
    held = rows.select(
        conv.alias("conv"),
        F.when(conv.isNull(), "").otherwise(F.concat(F.lit("+"), conv.cast("string"))).alias("key"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    )
    stripped = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(stripped == "", 2).when(F.substring(stripped, -1, 1).isin(".", "!", "?"), 0).otherwise(1)
    return held.withColumn("digest", F.unhex(F.md5("text"))).withColumn("kind", (number * 3 + fault).cast("int"))


def sha(lines: Iterable[str]) -> str:
    digest, first = hashlib.sha256(), True
    for line in lines:
        digest.update(line.encode() if first else b"\n" + line.encode())
        first = False
    return digest.hexdigest()


def in_partitions(rows: DataFrame, turns: bool) -> DataFrame:
    """Reports of the conversations that lie inside a partition, and the rows of those that touch its borders.

    Rows are range-sorted by conversation, turn and content, and last by the partition that they came from, so
    that not even equal rows must meet in one partition; all sort keys depend on the input alone. A task holds
    one conversation of its partition at a time.
    """
    ship(rows.sparkSession)
    by = ["key", "turn", "role", "digest", "origin"]
    ranged = rows.withColumn("origin", F.spark_partition_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    chosen = ranged.select("conv", "key", F.spark_partition_id().alias("part"), "turn", "role", "text", "digest", "kind")
    added = dict(field.split() for field in f"what string, {_REPORT_KINDS}, {_ROW_KINDS}".split(", "))
    out = chosen.select("conv", "key", "part", *[F.lit(None).cast(kind).alias(name) for name, kind in added.items()]).schema

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        from cartrail.llm import conversation_repair as here  # the module of the worker, which outlives a task

        target = to_arrow_schema(out)
        made: list[dict] = []
        held: list[tuple] = []
        before = 0

        def hand_on(border: bool) -> None:
            conv, key, part = held[0][:3]
            base = {"conv": conv, "key": key, "part": part}
            if border:
                for seq, row in enumerate(held):
                    made.append(base | {"what": "row", "seq": seq} | dict(zip(("turn", "role", "text", "digest", "kind"), row[3:], strict=True)))
                return
            segment = Segment(set())
            for _, _, _, turn, role, _, digest, kind in held:
                segment.add(turn, role, digest, kind)
            codes = bytes(segment.codes)
            cost, letters, tail = (here.remembered_repair if len(codes) <= SHORT else here.whole_repair)(codes)
            left = list(edited([*letters, tail], ((r[7] // 3, r[4], r[5]) for r in held), START))
            report = [segment.gaps(), segment.blank, segment.duplicate, segment.truncated, segment.illegal, cost]
            report += ["".join(letters) + tail, sha(f"{role}:{text}" for role, text, _ in left)]
            made.append(base | {"what": "report"} | dict(zip(REPORT, report, strict=True)))
            if turns:
                for seq, (role, text, edit) in enumerate(left):
                    made.append(base | {"what": "turn", "seq": seq, "role": role, "text": text, "edit": edit})

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held and row[1] != held[0][1]:
                    hand_on(border=not before)
                    before += 1
                    held.clear()
                held.append(row)
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=target)
                made.clear()
        if held:
            hand_on(border=True)
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=target)

    return written(chosen.mapInArrow(per_task, out))


def segments(rows: DataFrame) -> DataFrame:
    """One row per conversation and partition: codes, faults, turns, ends, and costs from state to state."""
    firsts = rows.groupBy("key", "role", "digest").agg(F.min("part").alias("first_part"))
    mine = rows.select("key", "part", "role", "digest").distinct()
    # what a segment has in common with those before it; no longer than the segment
    known = written(mine.join(firsts, ["key", "role", "digest"]).where("first_part < part").drop("first_part"))
    kinds = "key string, part int, codes binary, blank long, duplicate long, truncated long, illegal long, first int, last int, "
    kinds += "least long, most long, turns long, enter array<int>, leave array<int>, costs array<long>, places array<int>"

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        segment = Segment(set(zip(right["role"].to_pylist(), right["digest"].to_pylist(), strict=True)))
        ordered = left.sort_by("seq")
        for row in zip(*(ordered[c].to_pylist() for c in ("turn", "role", "digest", "kind")), strict=True):
            segment.add(*row)
        slots = forward(segment.codes, range(4))
        row = {"key": left["key"][0].as_py(), "part": left["part"][0].as_py(), "codes": bytes(segment.codes)}
        row |= {c: getattr(segment, c) for c in ("blank", "duplicate", "truncated", "illegal", "first", "last", "least", "most", "turns")}
        row |= {"enter": [p for p, _ in slots], "leave": [q for _, q in slots]}
        row |= {"costs": [cost for cost, _ in slots.values()], "places": [place for _, place in slots.values()]}
        names = [("key", pa.string()), ("part", pa.int32()), ("codes", pa.binary())]
        names += [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
        names += [(c, pa.int32()) for c in ("first", "last")] + [(c, pa.int64()) for c in ("least", "most", "turns")]
        names += [(c, pa.list_(pa.int32())) for c in ("enter", "leave")]
        names += [("costs", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))]
        return pa.Table.from_pylist([row], schema=pa.schema(names))

    skinny = rows.select(*_SKINNY)
    return written(skinny.groupBy("key", "part").cogroup(known.groupBy("key", "part")).applyInArrow(summed, kinds))


def chained(found: DataFrame) -> DataFrame:
    """The states at the borders of the segments, and the sums of each conversation.

    A conversation has one row per partition here, however many rows it has itself.
    """
    kinds = "key string, part int, enter int, leave int, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    sums = ("blank", "duplicate", "truncated", "illegal")

    def chain(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda r: r["part"])
        # from the last segment back: cost and place of the best way on from each state, and the next border's state
        ahead = {state: (cost, letters, None) for state, (cost, letters) in TAIL.items()}
        ways = []
        for part in reversed(parts):
            best: dict[int, tuple] = {}
            for enter, leave, cost, place in zip(part["enter"], part["leave"], part["costs"], part["places"], strict=True):
                option = cost + ahead[leave][0], (place, ahead[leave][1]), leave
                best[enter] = min(best.get(enter, option), option)
            order = {key: i for i, key in enumerate(sorted({option[1] for option in best.values()}))}
            ahead = {state: (option[0], order[option[1]], option[2]) for state, option in best.items()}
            ways.append(ahead)
        total = {c: sum(part[c] for part in parts) for c in sums}
        total["illegal"] += sum((a["last"], b["first"]) not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
        timed = [part for part in parts if part["turns"]]
        turns = sum(part["turns"] for part in timed) - sum(a["most"] == b["least"] for a, b in zip(timed, timed[1:], strict=False))
        gaps = min(timed[-1]["most"] - timed[0]["least"] + 1 - turns, LARGEST) if timed else 0
        rows, state = [], START
        for part, way in zip(parts, reversed(ways), strict=True):
            leave = way[state][2]
            rows.append({"key": part["key"], "part": part["part"], "enter": state, "leave": leave, "tail": ""})
            rows[-1] |= total | {"gaps": gaps, "cost": ways[-1][START][0]}
            state = leave
        rows[-1]["tail"] = TAIL[state][1]
        names = [("key", pa.string()), ("part", pa.int32()), ("enter", pa.int32()), ("leave", pa.int32()), ("tail", pa.string())]
        names += [(c, pa.int64()) for c in ("gaps", *sums, "cost")]
        return pa.Table.from_pylist(rows, schema=pa.schema(names))

    return written(found.drop("codes").groupBy("key").applyInArrow(chain, kinds))


def across_partitions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports and repaired rows of the conversations that touch borders of partitions."""
    found = segments(rows)
    borders = chained(found.drop("codes"))
    known = found.select("key", "part", "codes").join(borders, ["key", "part"])

    def repaired(left: pa.Table, right: pa.Table) -> pa.Table:
        border = right.to_pylist()[0]
        letters = [*crossing(border["codes"], border["enter"], border["leave"]), border["tail"]]
        ordered = left.sort_by("seq")
        initials = (kind // 3 for kind in ordered["kind"].to_pylist())
        held = zip(initials, ordered["role"].to_pylist(), ordered["text"].to_pylist(), strict=True)
        names = [("key", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
        # the audit of the segment goes first, as a row of its own
        lines = [{"seq": -1, "edit": "".join(letters)}]
        lines += [{"seq": i, "role": r, "text": t, "edit": e} for i, (r, t, e) in enumerate(edited(letters, held, border["enter"]))]
        base = {"key": border["key"], "part": border["part"]}
        return pa.Table.from_pylist([base | line for line in lines], schema=pa.schema(names))

    kinds = "key string, part int, seq long, role string, text string, edit string"
    texts = rows.select("key", "part", "seq", "role", "text", "kind")
    lines = written(texts.groupBy("key", "part").cogroup(known.groupBy("key", "part")).applyInArrow(repaired, kinds))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, first = None, None, True

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": [key], "repaired_sha256": [digest.hexdigest()]})

        for batch in batches:
            for own, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if own != key:
                    if key is not None:
                        yield out()
                    key, digest, first = own, hashlib.sha256(), True
                digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
                first = False
        if key is not None:
            yield out()

    # a hash over all rows has to read them in one order: one task a conversation, but never more than a batch at once
    kept = lines.where("seq >= 0").repartition("key").sortWithinPartitions("key", "part", "seq").select("key", "role", "text")
    hashes = kept.mapInArrow(hashed, "key string, repaired_sha256 string")
    pieces = F.array_sort(F.collect_list(F.struct("part", "edit")))
    audits = lines.where("seq = -1").groupBy("key").agg(F.array_join(F.transform(pieces, lambda p: p["edit"]), "").alias("audit"))
    sums = borders.groupBy("key").agg(*[F.max(c).alias(c) for c in REPORT[:6]])
    ids = rows.groupBy("key").agg(F.first("conv").alias("conv"))
    joined = ids.join(sums, "key").join(audits, "key").join(hashes, "key", "left")
    empty = F.lit(hashlib.sha256().hexdigest())
    reports = joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", empty)).select("conv", *REPORT)
    turns = lines.where("seq >= 0").join(ids, "key").select("conv", "part", "seq", "role", "text", "edit")
    return reports, turns


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """What ails each conversation and what its repair costs: ``conv_id``, then the columns of ``REPORT``.

    Rows are taken by turn, NULL first, then by role and the MD5 of the text. The first fault of a row counts:
    blank, duplicate of an earlier row's role and text, truncated (no ``.``, ``!`` or ``?`` at the end). ``gaps``
    are the turns missing between the first and the last; NULL turns don't count; a number over 2^63 - 1 is that.
    ``illegal`` counts neighbours whose role initials may not follow each other. ``audit`` has a letter per edit:
    Keep, Rerole, Delete, Insert; of the cheapest ones the least in ASCII. ``repaired_sha256`` is of the
    repaired ``role:text`` lines. NULL roles and texts count as one space; a role of no known initial, an
    empty one too, can't be kept. NULL ids are one conversation. Repeated rows are duplicates. An empty table
    gives no rows; other columns are not looked at.
    """
    table = in_partitions(prepared(rows, conv_id, turn, role, text), turns=False)
    inside = table.where("what = 'report'").select("conv", *REPORT)
    reports, _ = across_partitions(table.where("what = 'row'"))
    return inside.unionByName(reports).withColumnRenamed("conv", conv_id)


def repaired_turns(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations, a row per turn: ``conv_id, part, seq, role, text, edit``, in the order of part and seq.

    The rest is as in ``repair``.
    """
    table = in_partitions(prepared(rows, conv_id, turn, role, text), turns=True)
    inside = table.where("what = 'turn'").select("conv", "part", "seq", "role", "text", "edit")
    _, turns = across_partitions(table.where("what = 'row'"))
    return inside.unionByName(turns).withColumnRenamed("conv", conv_id)


def untouched(conv_id: Column) -> list[Column]:
    """The report of a conversation without rows."""
    zeros = [F.lit(0).cast("long").alias(c) for c in REPORT[:6]]
    return [conv_id, *zeros, F.lit("").alias("audit"), F.lit(hashlib.sha256().hexdigest()).alias("repaired_sha256")]
