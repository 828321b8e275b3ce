"""Repair of conversations by weighted CYK parsing over intervals of turns.

The role initials of a repaired conversation are `(s?(ua)+)?`. The repair grammar in Chomsky normal form has a symbol for
every pair of states of that language: `XZ -> XY YZ` joins two neighbouring intervals, and `XZ` derives one row by an edit
(keep, rerole, delete) or nothing by insertions. A cell of an interval and a symbol holds the least cost and, of all
edits at that cost, the least audit text.

* Insertion closure: the cells of the empty interval are joined to both sides of every row.
* Intervals are combined bottom-up by their length, over all splits. Intervals with the same kinds of rows have the same
  cells, so a task keeps them in one bounded chart.
* A cell keeps its least audit and those that continue it, as `K` may turn out greater than `KD` by what follows. All
  others can never become least, so results are exact.
* Rows are range-partitioned by conversation and turn. A task parses BLOCK rows at a time, and the cells of neighbouring
  blocks, and later of neighbouring tasks, are joined as intervals of their own, FAN at a time: cells between all states
  can be joined anywhere, so a conversation of any length is split over tasks, and its result is that of one table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import SPACES, bounded_batches, store

# rows of one table of intervals, and tables joined at a time
BLOCK, FAN = 12, 8
# intervals that a task remembers
CHART = 50_000
# cost of an edit, and of leaving a truncated row in
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# before anything, after the system turn, after a user turn, after an assistant turn
STATES = "BSUA"
STEPS = {"Bs": "S", "Bu": "U", "Su": "U", "Ua": "A", "Au": "U"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Cells = dict[str, tuple[int, list[str]]]
CELL_TYPE = "array<struct<at:string,cost:bigint,audit:string>>"


def chain(audits: Iterable[str]) -> list[str]:
    """The audits that can begin a least text: the least one, and each that continues the one before."""
    kept: list[str] = []
    for audit in sorted(set(audits)):
        if not kept or audit.startswith(kept[-1]):
            kept.append(audit)
    return kept


def joined(left: Cells, right: Cells, best: dict[str, tuple[int, set[str]]] | None = None) -> dict[str, tuple[int, set[str]]]:
    """All rules `XZ -> XY YZ` over two neighbouring intervals, added to the best found for the whole interval."""
    best = {} if best is None else best
    for at, (cost, audits) in left.items():
        for end in STATES:
            other = right.get(at[1] + end)
            if other is None:
                continue
            total, symbol = cost + other[0], at[0] + end
            found = best.get(symbol)
            if found is None or total < found[0]:
                best[symbol] = found = (total, set())
            if total == found[0]:
                found[1].update([x + y for x in audits for y in other[1]])
    return best


def closed(best: dict[str, tuple[int, set[str]]]) -> Cells:
    return {at: (cost, chain(audits)) for at, (cost, audits) in best.items()}


def nothing() -> Cells:
    """The cells of the empty interval: insertions alone, at most two, as two more lead to the state they began in."""
    cells: Cells = {p + p: (0, [""]) for p in STATES}
    for step, after in STEPS.items():
        if step[1] != "s":
            cells[step[0] + after] = (INSERT, ["I"])
    return closed(joined(cells, cells))


def row_cells(kind: str) -> Cells:
    """The cells of one row: `s`, `u`, `a`, `o` by its role's initial, upper case if truncated, `D` if it has to go."""
    best: dict[str, tuple[int, set[str]]] = {p + p: (DELETE, {"D"}) for p in STATES}
    if kind != "D":
        extra = TRUNCATED if kind.isupper() else 0
        for step, after in STEPS.items():
            if step[1] == kind.lower():
                best[step[0] + after] = (extra, {"K"})
            elif step[1] != "s":
                best[step[0] + after] = (extra + REROLE, {"R"})
    empty = nothing()
    return closed(joined(closed(joined(empty, closed(best))), empty))


def parsed(kinds: str, chart: dict[str, Cells]) -> Cells:
    """The cells of rows of the given kinds, intervals by length; the chart has those of earlier intervals."""
    if len(chart) > CHART:
        chart.clear()
    for kind in set(kinds):
        if kind not in chart:
            chart[kind] = row_cells(kind)
    for length in range(2, len(kinds) + 1):
        for start in range(len(kinds) - length + 1):
            part = kinds[start : start + length]
            if part not in chart:
                best: dict[str, tuple[int, set[str]]] = {}
                for split in range(1, length):
                    joined(chart[part[:split]], chart[part[split:]], best)
                chart[part] = closed(best)
    return chart[kinds]


def combined(cells: list[Cells]) -> Cells:
    """The cells of neighbouring intervals together, by length over all splits."""
    table = {(i, i + 1): c for i, c in enumerate(cells)}
    for length in range(2, len(cells) + 1):
        for start in range(len(cells) - length + 1):
            best: dict[str, tuple[int, set[str]]] = {}
            for split in range(start + 1, start + length):
                joined(table[start, split], table[split, start + length], best)
            table[start, start + length] = closed(best)
    return table[0, len(cells)]


class Stretch:
    """Neighbouring rows of one conversation: counts, both ends, and the cells of their interval."""

    FIELDS = "n long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string"

    def __init__(self, blank, duplicate, truncated, illegal, turns, low, high, head, tail, cells: Cells, n=1):
        self.n, self.blank, self.duplicate, self.truncated, self.illegal = n, blank, duplicate, truncated, illegal
        self.turns, self.low, self.high, self.head, self.tail, self.cells = turns, low, high, head, tail, cells

    @staticmethod
    def of(parts: list[Stretch]) -> Stretch:
        """Neighbours as one; a turn on both sides of a border counts once."""
        sums = {name: sum(getattr(p, name) for p in parts) for name in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
        for left, right in zip(parts, parts[1:], strict=False):
            sums["illegal"] += left.tail + right.head not in ("su", "ua", "au")
            sums["turns"] -= left.high is not None and left.high == right.low
        low = next((p.low for p in parts if p.low is not None), None)
        high = next((p.high for p in reversed(parts) if p.high is not None), None)
        return Stretch(low=low, high=high, head=parts[0].head, tail=parts[-1].tail, cells=combined([p.cells for p in parts]), **sums)

    def row(self) -> list:
        cells = [{"at": at, "cost": cost, "audit": a} for at, (cost, audits) in self.cells.items() for a in audits]
        counts = [self.n, self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high]
        return [*counts, self.head, self.tail, cells]

    @staticmethod
    def back(n, blank, duplicate, truncated, illegal, turns, low, high, head, tail, cells) -> Stretch:
        table: Cells = {}
        for cell in cells:
            table.setdefault(cell["at"], (cell["cost"], []))[1].append(cell["audit"])
        return Stretch(blank, duplicate, truncated, illegal, turns, low, high, head, tail, table, n)


class Conversation:
    """The rows of one conversation as they come: rows waiting for a table, and a counter of joined tables."""

    def __init__(self, chart: dict[str, Cells]):
        self.chart, self.rows, self.levels = chart, [], []

    def add(self, kind: str, initial: str, turn: int | None, blank: bool, repeat: bool) -> None:
        self.rows.append((kind, initial, turn, blank, repeat))
        if len(self.rows) == BLOCK:
            self.push()

    def push(self) -> None:
        """Close the waiting rows as one table; FAN tables of a level become one of the next."""
        rows, self.rows = self.rows, []
        turns = [r[2] for r in rows if r[2] is not None]
        illegal = sum(a[1] + b[1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        counts = [sum(r[3] for r in rows), sum(r[4] for r in rows), sum(r[0].isupper() and r[0] != "D" for r in rows)]
        ends = [turns[0] if turns else None, turns[-1] if turns else None, rows[0][1], rows[-1][1]]
        cells = parsed("".join(r[0] for r in rows), self.chart)
        stretch, level = Stretch(*counts, illegal, len(set(turns)), *ends, cells, len(rows)), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(stretch)
            if len(self.levels[level]) < FAN:
                return
            stretch, self.levels[level] = Stretch.of(self.levels[level]), []
            level += 1

    def end(self) -> Stretch:
        if self.rows:
            self.push()
        last: list[Stretch] = []
        for level in self.levels:
            last = [Stretch.of([*level, *last])] if level or last else []
        return last[0]


def marked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, mark (digest of the text), kind and copies (n) of rows (conv_id, turn, role, text, copies)."""
    text = F.btrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    kind = F.when(F.right(text, F.lit(1)).isin(".", "!", "?"), kind).otherwise(F.upper(kind))
    kind = F.when(text == "", "D").otherwise(kind)
    light = rows.select("conv_id", "turn", "role", _mark("text"), kind.alias("kind"), "copies")
    return light.groupBy("conv_id", "turn", "role", "mark", "kind").agg(F.sum("copies").alias("n"))


def _mark(text: str) -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary"))).alias("mark")


def _order(turn: str = "turn") -> Column:
    """Turns as they follow each other, null first."""
    return F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"))


def repairs(rows: DataFrame) -> DataFrame:
    """gaps, blank, duplicate, truncated, illegal, cost and audit for every conv_id of `rows` (conv_id, turn long, role,
    text, copies: so many times, adjacent), none of role and text null.

    A conversation's rows follow each other by turn (nulls first); rows of one turn by role and then by a digest of the
    text, so rows that agree in all are adjacent. Digests of 128 bits stand for texts. A null conv_id is one like others.
    Roles count by their first character; one that is not s, u or a can be reroled or deleted. An empty table gives
    none. Very long conversations are split over tasks; only their audit, a character per row, is one value.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    bounded_batches(rows.sparkSession)
    light = store(marked(rows), "turns")
    # where a text comes in several turns, the first of them
    firsts = light.groupBy("conv_id", "role", "mark").agg(F.count("*").alias("k"), F.min(_order()).alias("first"))
    firsts = store(firsts.filter("k > 1").drop("k"), "firsts").select("conv_id", "role", "mark", "first")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("conv_id", "role", "mark")]
    told = light.alias("l").join(firsts.alias("f"), same, "left")
    repeat = F.coalesce(_order("l.turn") != F.col("f.first"), F.lit(False))
    keys = ["conv_id", "turn", "role", "mark"]
    told = told.select(*[F.col(f"l.{k}") for k in keys], "l.kind", "l.n", repeat.alias("repeat"))
    told = told.repartitionByRange(*keys).sortWithinPartitions(*keys)
    told = told.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "kind", "n", "repeat", F.spark_partition_id().alias("part"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, part long, {Stretch.FIELDS}, cells {CELL_TYPE}"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chart: dict[str, Cells] = {}
        now, key, part, out = None, None, 0, []
        for batch in batches:
            for conv, turn, initial, kind, n, repeat, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != key:
                    if now:
                        out.append([key, part, *now.end().row()])
                    now, key = Conversation(chart), conv
                for copy in range(n):
                    again = kind != "D" and (repeat or copy > 0)
                    now.add("D" if again else kind, initial, turn, kind == "D", again)
            yield from batch_of(out, key_type)
            out = []
        if now:
            yield from batch_of([[key, part, *now.end().row()]], key_type)

    def join(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda row: row["part"])
        whole = Stretch.of([Stretch.back(**{k: v for k, v in p.items() if k not in ("conv_id", "part", "g", "many")}) for p in parts])
        return pa.Table.from_batches(batch_of([[parts[0]["conv_id"], parts[0]["part"], *whole.row()]], key_type))

    key_type = to_arrow_type(rows.schema["conv_id"].dataType)
    stretches = store(told.mapInArrow(parse, schema), "stretches")
    while True:
        # conversations that several tasks had: some neighbours at a time
        many = F.count("*").over(Window.partitionBy("conv_id")) > 1
        place = F.row_number().over(Window.partitionBy("conv_id").orderBy("part")) - 1
        placed = stretches.withColumns({"many": many, "g": F.floor(place / FAN)})
        if placed.filter("many").isEmpty():
            break
        whole = placed.filter("many").groupBy("conv_id", "g").applyInArrow(join, schema)
        stretches = store(placed.filter("NOT many").drop("many", "g").unionByName(whole), "stretches")
    ends = F.filter("cells", lambda c: c["at"].isin("BB", "BA"))
    best = F.array_min(F.transform(ends, lambda c: F.struct(c["cost"].alias("cost"), c["audit"].alias("audit"))))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    return stretches.select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", best["cost"].alias("cost"), best["audit"].alias("audit"))


def batch_of(rows: list[list], key_type) -> Iterator:
    """Stretches as an Arrow batch."""
    import pyarrow as pa

    if rows:
        cell = pa.list_(pa.struct([("at", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
        kinds = [key_type, *[pa.int64()] * 9, pa.string(), pa.string(), cell]
        names = ["conv_id", "part", *(f.split()[0] for f in Stretch.FIELDS.split(", ")), "cells"]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names)


class Edits:
    """A conversation's audit applied to its rows as they come: which turn each edit leaves."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place, self.system = audit, 0, 0, 0

    def due(self) -> str:
        return "user" if (self.place - self.system) % 2 == 0 else "assistant"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The turns inserted here: edit, role, text."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self.due(), ""
            self.place += 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "K" and role[:1] == "s":
            self.system = 1
        yield edit, role if edit == "K" else self.due(), text
        self.place += 1


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's repair and then its rows in order, in one task; read as a stream, nothing is held."""
    repair = found.select("conv_id", F.lit(0).alias("tag"), F.struct(*COUNTS, "audit").alias("repair"))
    texts = rows.select("conv_id", F.lit(1).alias("tag"), "turn", "role", "text", "copies", _mark("text"))
    both = repair.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", "tag", "turn", "role", "mark")
    return both.select("conv_id", "repair", "turn", "role", "text", "copies")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns of `rows` by their repairs: conv_id, place from 0, edit (K, R, I), role, text, turn (null if inserted)."""
    import pyarrow as pa

    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, key, out = None, None, []

        def put(turns, turn=None):
            for edit, role, text in turns:
                out.append([key, edits.place, edit, role, text, turn])

        def flush(key_type):
            nonlocal out
            done, out = out, []
            kinds = [key_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
            columns = [pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "edit", "role", "text", "turn"])

        for batch in batches:
            for conv, repair, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if repair:
                    if edits:
                        put(edits.inserted())
                    edits, key = Edits(repair["audit"]), conv
                else:
                    for _ in range(copies):
                        put(edits.row(role, text), turn)
            yield flush(batch.schema.field(0).type)
        if edits:
            put(edits.inserted())
            yield flush(batch.schema.field(0).type)

    schema = f"conv_id {kind}, place long, edit string, role string, text string, turn long"
    bounded_batches(rows.sparkSession)
    return _stream(rows, found).mapInArrow(run, schema)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repairs with `repaired_sha256`, the hash of a conversation's repaired `role:text`, joined by newlines.

    Such a hash takes its bytes in order, so each conversation passes through one task; its rows are streamed.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, key, repair, digest, out = None, None, None, None, []

        def take(turns):
            for _, role, text in turns:
                digest.update((("\n" if edits.place else "") + f"{role}:{text}").encode())

        def end():
            take(edits.inserted())
            out.append([key, *(repair[c] for c in COUNTS), repair["audit"], digest.hexdigest()])

        def flush(key_type):
            nonlocal out
            done, out = out, []
            kinds = [key_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            columns = [pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *COUNTS, "audit", "repaired_sha256"])

        for batch in batches:
            for conv, new, _, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if new:
                    if edits:
                        end()
                    edits, key, repair, digest = Edits(new["audit"]), conv, new, hashlib.sha256()
                else:
                    for _ in range(copies):
                        take(edits.row(role, text))
            yield flush(batch.schema.field(0).type)
        if edits:
            end()
            yield flush(batch.schema.field(0).type)

    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    bounded_batches(rows.sparkSession)
    return _stream(rows, found).mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """`conversations` with faults, by the last digits of crc32(conv_id:turn): rows dropped, emptied, cut, doubled, reroled."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long"), text_of("role").alias("role"), text_of("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 3, 2).otherwise(1)
    return rows.filter("fate != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Every conv_id of `conversations` (conv_id, turn, role, text; others are ignored) once, damaged and repaired.

    Beside it gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256; zeros and empty texts for a conversation
    that lost all its rows. Null values count as one space, so a null text is blank and a null role is none of the three;
    null turns come first; repeated rows are duplicates; see `repairs` for the order within a turn.
    """
    rows = store(damaged(conversations), "damaged")
    done = digests(rows, repairs(rows))
    ids = conversations.select("conv_id").distinct().alias("i")
    whole = ids.join(done.alias("d"), F.col("i.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    empty = hashlib.sha256().hexdigest()
    return whole.select(
        "i.conv_id",
        *[F.coalesce(f"d.{c}", F.lit(0).cast("long")).alias(c) for c in COUNTS],
        F.coalesce("d.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
