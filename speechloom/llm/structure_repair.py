"""Repair of conversation structure by Knuth's lightest derivations.

A repaired conversation is empty, or an optional system turn and then exchanges of user and assistant.
What can be shown of a conversation are items: an edit of one row, an inserted turn, and a prefix, that
is, the first i rows edited so that the turns so far end in state q. Deductions join a prefix with an
edit or an insertion to a longer prefix; they are the hyperedges. Items wait in an agenda and are taken
in the order of their values, cost and audit. An item taken once is final: joining values never gives
one that comes before either of them, and keeps their order. The search ends when the goal is taken.

Long conversations are worked out in segments. Of each, the lightest derivation from every state to
every other is found; these become items themselves, which a second agenda joins to the whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechloom.workspace import written

SPACES = " \t\n\x0b\x0c\r"
SEGMENT = 512  # different rows that one agenda looks at
LARGE = 4_096  # rows from which a conversation may count as large
LARGE_SHARE = 8_192  # it does if it holds more than one row in so many; so no more than these are large

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES = range(4)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
PARTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("part", T.LongType()), T.StructField("parts", T.LongType()),
    *(T.StructField(c, T.LongType()) for c in COUNTS),
    T.StructField("audit", T.StringType()), T.StructField("turns", TURNS),
])
_ARROW_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

Value = tuple[int, int, str]  # cost, rows, audit: of one item all audits cover the same rows
Row = tuple[str, str, str, int]  # fault, role, text, equal rows in succession


def joined(a: Value, b: Value) -> Value:
    """The value of a deduction. The rows come before the audit, so that the result follows both parts:
    without cost a part is empty or has rows, and then the whole has more rows than the other part."""
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def lightest(axioms: dict, deduced: Callable, goal=None) -> tuple[dict, dict]:
    """Final values of all items, or of those before ``goal``, and the items that each was joined from.

    ``deduced(item, final)`` gives the hyperedges that ``item`` completes: conclusion and both tails.
    """
    heap = [(value, item, ()) for item, value in axioms.items()]
    heapq.heapify(heap)
    final: dict = {}
    tails: dict = {}
    while heap:
        value, item, tail = heapq.heappop(heap)
        if item in final:
            continue
        final[item], tails[item] = value, tail
        if item == goal:
            break
        for conclusion, left, right in deduced(item, final):
            if conclusion not in final:
                heapq.heappush(heap, (joined(final[left], final[right]), conclusion, (left, right)))
    return final, tails


def edits(row: Row) -> list[tuple[str, Value]]:
    """Initial of the turn that an edit leaves ('' for none), and its value. Equal rows that follow go."""
    fault, role, _, n = row
    if fault in ("blank", "duplicate"):
        return [("", (n * DELETE, n, "D" * n))]
    more, rest = (n - 1) * DELETE, "D" * (n - 1)
    extra = more + (TRUNCATED if fault == "truncated" else 0)
    own = role[:1]
    kept = [(own, (KEEP + extra, n, "K" + rest))] if own in ("s", "u", "a") else []
    return [*kept, ("u", (REROLE + extra, n, "R" + rest)), ("a", (REROLE + extra, n, "R" + rest)),
            ("", (DELETE + more, n, "D" + rest))]


# Items of a segment, as tuples that sort: prefixes (0, rows, state), edits (1, row, edit), insertions
# (2, 0, initial) and the goal.
GOAL = (3, 0, 0)


def segment(rows: list[Row], entry: int, whole: bool) -> dict[int, Value]:
    """Value of the lightest derivation of ``rows`` from state ``entry``, for each state they can end in.

    With ``whole`` only the lightest of those that end a conversation is asked for.
    """
    leaves: dict = {}
    axioms: dict = {}
    for i, row in enumerate(rows):
        for j, (initial, value) in enumerate(edits(row)):
            leaves[1, i, j], axioms[1, i, j] = initial, value
    axioms |= {(2, 0, initial): (INSERT, 0, "I") for initial in NAMES}
    axioms[0, 0, entry] = (0, 0, "")
    axioms[4, 0, 0] = (0, 0, "")  # nothing: the second tail of the goal
    last = len(rows)

    def step(prefix, other, final):
        _, i, q = prefix
        if other[0] == 1:
            initial = leaves[other]
            state = STEP.get((q, initial)) if initial else q
            return None if state is None else ((0, i + 1, state), prefix, other)
        state = STEP.get((q, other[2]))
        return None if state is None else ((0, i, state), prefix, other)

    def deduced(item, final):
        kind, i, _ = item
        if kind == 0:
            others = [(1, i, j) for j in range(4)] + [(2, 0, initial) for initial in NAMES]
            edges = [step(item, o, final) for o in others if o in final]
            if whole and i == last and item[2] in ACCEPTED and (4, 0, 0) in final:
                edges.append((GOAL, item, (4, 0, 0)))
        elif kind == 1:
            edges = [step((0, i, q), item, final) for q in STATES if (0, i, q) in final]
        elif kind == 2:
            edges = [step(p, item, final) for p in list(final) if p[0] == 0]
        elif kind == 4 and whole:
            edges = [(GOAL, p, item) for p in list(final) if p[0] == 0 and p[1] == last and p[2] in ACCEPTED]
        else:
            edges = []
        return [e for e in edges if e]

    final, _ = lightest(axioms, deduced, GOAL if whole else None)
    if whole:
        return {0: final[GOAL]}
    return {q: final[0, last, q] for q in STATES if (0, last, q) in final}


def through(segments: list[dict[tuple[int, int], Value]]) -> list[tuple[int, Value]]:
    """Entry state and value of each segment in the lightest derivation of the whole.

    Items: (0, segments, state) for what is joined so far, (1, segment, (from, to)) for the segments.
    """
    axioms = {(1, b, pq): value for b, s in enumerate(segments) for pq, value in s.items()}
    axioms[0, 0, (0, 0)] = (0, 0, "")
    axioms[2, 0, (0, 0)] = (0, 0, "")
    last = len(segments)
    goal = (3, 0, (0, 0))

    def deduced(item, final):
        kind, b, (p, q) = item
        edges = []
        if kind == 0 and b < last:
            edges = [((0, b + 1, (to, 0)), item, (1, b, (p, to))) for to in STATES if (1, b, (p, to)) in final]
        elif kind == 1 and (0, b, (p, 0)) in final:
            edges = [((0, b + 1, (q, 0)), (0, b, (p, 0)), item)]
        if kind == 0 and b == last and p in ACCEPTED and (2, 0, (0, 0)) in final:
            edges.append((goal, item, (2, 0, (0, 0))))
        elif kind == 2:
            edges = [(goal, (0, last, (s, 0)), item) for s in ACCEPTED if (0, last, (s, 0)) in final]
        return edges

    final, tails = lightest(axioms, deduced, goal)
    found: list[tuple[int, Value]] = []
    at = tails[goal][0]
    while at[1]:
        at, used = tails[at]
        found.append((used[2][0], final[used]))
    return found[::-1]


def matrix(rows: list[Row], entries: Iterable[int] = STATES) -> dict[tuple[int, int], Value]:
    return {(p, q): value for p in entries for q, value in segment(rows, p, False).items()}


def replayed(rows: list[Row], entry: int, audit: str) -> list[dict[str, str]]:
    """The repaired turns of a segment; states and audit leave no choice of roles."""
    out, state = [], entry
    copies = (row for row in rows for _ in range(row[3]))
    for edit in audit:
        _, role, text, _ = ("", "", "", 0) if edit == "I" else next(copies)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else "a" if state == 2 else "u"
        state = STEP[state, initial]
        out.append({"role": role if edit == "K" else NAMES[initial], "text": text})
    return out


def fault(role: str, text: str, seen: bool) -> str:
    solid = text.rstrip(SPACES)
    if not solid:
        return "blank"
    if seen:
        return "duplicate"
    return "" if solid[-1] in ".!?" else "truncated"


def tally(rows: list[Row], before: str) -> dict[str, int]:
    """Faults of rows and their illegal neighbours; ``before`` is the initial of the row before them."""
    n = dict.fromkeys(COUNTS, 0)
    for name, role, _, copies in rows:
        n["blank" if name == "blank" else "duplicate"] += copies if name in ("blank", "duplicate") else copies - 1
        n["truncated"] += name == "truncated"
        own = role[:1]
        n["illegal"] += copies - 1 + (before is not None and before + own not in LEGAL)
        before = own
    return n


def repaired_parts(conv_id: int | None, turns: list[tuple[int | None, str, str]]) -> Iterator[dict]:
    """Parts of one conversation, whose turns come in order."""
    rows: list[Row] = []
    seen: set[tuple[str, str]] = set()
    for i, (turn, role, text) in enumerate(turns):
        if i and turns[i - 1] == (turn, role, text):
            rows[-1] = (*rows[-1][:3], rows[-1][3] + 1)
        else:
            rows.append((fault(role, text, (role, text) in seen), role, text, 1))
        seen.add((role, text))
    numbers = {turn for turn, *_ in turns if turn is not None}
    parts = [rows[at:at + SEGMENT] for at in range(0, len(rows), SEGMENT)]
    if len(parts) == 1:
        way = [(0, segment(rows, 0, True)[0])]
    else:
        way = through([matrix(part, STATES if i else (0,)) for i, part in enumerate(parts)])
    before = None
    for i, (part, (entry, (cost, _, audit))) in enumerate(zip(parts, way)):
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers and not i else 0
        yield {"conv_id": conv_id, "part": i, "parts": len(parts), **tally(part, before), "gaps": gaps, "cost": cost,
               "audit": audit, "turns": replayed(part, entry, audit)}
        before = part[-1][1][:1]


def _batch(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, to_arrow_schema(schema))


def _small(turns: DataFrame) -> DataFrame:
    """Conversations that a task can hold: one after the other from rows brought together and sorted."""

    def run(batches):
        def conversations():
            own, held = None, []
            for batch in batches:
                for conv_id, *turn in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                    if held and conv_id != own:
                        yield own, held
                        held = []
                    own = conv_id
                    held.append(tuple(turn))
            if held:
                yield own, held

        out, weight = [], 0
        for conv_id, held in conversations():
            for part in repaired_parts(conv_id, held):
                out.append(part)
                weight += sum(len(t["text"]) + 50 for t in part["turns"]) + 200
                if weight > 1 << 22:
                    yield _batch(out, PARTS)
                    out, weight = [], 0
        if out:
            yield _batch(out, PARTS)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, PARTS)


_ROWS = T.ArrayType(T.StructType([
    T.StructField("fault", T.StringType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("n", T.LongType()),
]))
_WAYS = T.ArrayType(T.StructType([
    T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()), T.StructField("cost", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("audit", T.StringType()),
]))
_SEGMENTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("task", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("ways", _WAYS), T.StructField("rows", _ROWS),
])
_CHOSEN = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("task", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("part", T.LongType()), T.StructField("parts", T.LongType()), T.StructField("entry", T.LongType()),
    T.StructField("before", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
])


def _large(turns: DataFrame) -> DataFrame:
    """Conversations that hold a good share of all rows: their segments are worked out by many tasks.

    Equal rows are counted, earlier equal texts found by their SHA-256, and rows dealt out by ranges of
    their order. Only the values of segments are brought together, 16 for each 512 rows.
    """
    key = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    counted = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    counted = written(counted.withColumns({"key": key, "hash": F.sha2("text", 256)}), "turns")
    first = counted.groupBy(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h")).agg(F.min("key").alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h"))
    rows = counted.join(first, same).select(
        "conv_id", "turn", "role", "text", "n", (F.col("key") > F.col("first")).alias("seen"))

    def cut(batches):
        from pyspark import TaskContext

        task, seq = TaskContext.get().partitionId(), 0

        def done(conv_id, held):
            ways = [{"p": p, "q": q, "cost": c, "n": n, "audit": a} for (p, q), (c, n, a) in matrix(held).items()]
            named = [dict(zip(("fault", "role", "text", "n"), row)) for row in held]
            return _batch([{"conv_id": conv_id, "task": task, "seq": seq, "ways": ways, "rows": named}], _SEGMENTS)

        own, held = None, []
        for batch in batches:
            for conv_id, role, text, n, seen in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "n", "seen"))):
                if held and (conv_id != own or len(held) == SEGMENT):
                    yield done(own, held)
                    seq, held = seq + 1, []
                own = conv_id
                held.append((fault(role, text, seen), role, text, n))
        if held:
            yield done(own, held)

    def joined_up(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda r: (r["task"], r["seq"]))
        way = through([{(w["p"], w["q"]): (w["cost"], w["n"], w["audit"]) for w in r["ways"]} for r in parts])
        out, before = [], None
        for i, (r, (entry, (cost, _, audit))) in enumerate(zip(parts, way)):
            out.append({"conv_id": r["conv_id"], "task": r["task"], "seq": r["seq"], "part": i, "parts": len(parts),
                        "entry": entry, "before": before, "cost": cost, "audit": audit})
            before = r["last"]
        return pa.Table.from_batches([_batch(out, _CHOSEN)])

    def told(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                held = [(x["fault"], x["role"], x["text"], x["n"]) for x in r["rows"]]
                counts = tally(held, r["before"]) | {"cost": r["cost"], "gaps": r["gaps"] if r["part"] == 0 else 0}
                out.append({"conv_id": r["conv_id"], "part": r["part"], "parts": r["parts"], **counts,
                            "audit": r["audit"], "turns": replayed(held, r["entry"], r["audit"])})
            yield _batch(out, PARTS)

    ordered = rows.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    segments = written(ordered.mapInArrow(cut, _SEGMENTS), "segments")
    slim = segments.select("conv_id", "task", "seq", "ways", F.substring(F.element_at("rows", -1)["role"], 1, 1).alias("last"))
    chosen = slim.groupBy("conv_id").applyInArrow(joined_up, _CHOSEN).alias("c")
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = counted.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps")).alias("g")
    s = segments.select("conv_id", "task", "seq", "rows").alias("s")
    at = (F.col("s.task") == F.col("c.task")) & (F.col("s.seq") == F.col("c.seq"))
    whole = s.join(chosen, at).join(gaps, F.col("s.conv_id").eqNullSafe(F.col("g.conv_id")))
    return whole.select("s.conv_id", "rows", "part", "parts", "entry", "before", "cost", "audit", "gaps").mapInArrow(told, PARTS)


def repair(turns: DataFrame) -> DataFrame:
    """Repaired conversations of ``turns(conv_id, turn, role, text)``, in parts of at most 512 different rows.

    Rows are taken by turn, null ones first, those of one turn by role and text. A row is ``blank`` without
    a character other than white space, else ``duplicate`` if role and text were seen earlier, else
    ``truncated`` if its last such character is none of ``.!?``. Blank and duplicate rows are deleted (3);
    others are kept (0), given the role user or assistant (2) or deleted (3), and cost 1 more if truncated and
    not deleted; turns without text may be inserted anywhere (2). Of the cheapest repairs it is the one
    whose edits' initials, the ``audit``, are least.

    One row per part: ``conv_id, part, parts``, the part's ``gaps`` (all in the first), ``blank, duplicate,
    truncated, illegal, cost, audit`` and ``turns``. Null roles and texts count as one space; rows without
    conv_id are one conversation; repeated rows are duplicates; conversations without rows have no part;
    an empty table gives no rows; other columns are not looked at.
    """
    turns = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"))
    sizes = written(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # at most LARGE_SHARE ids
    large = sizes.where(F.col("n") > max(LARGE, total // LARGE_SHARE)).select(F.col("conv_id").alias("large_id"))
    if large.isEmpty():
        return _small(turns)
    is_large = F.col("conv_id").eqNullSafe(F.col("large_id"))
    small = _small(turns.join(F.broadcast(large), is_large, "left_anti"))
    return small.unionByName(_large(turns.join(F.broadcast(large), is_large, "left_semi")))


def digests(parts: DataFrame) -> DataFrame:
    """One row per conversation: the sums of its parts, its whole audit and the SHA-256 of its repaired lines.

    ``parts`` should be a stored table, as it is read twice. Conversations of one part need no exchange. The parts of others pass in order through a running hash,
    which is all that a task holds of their texts.
    """
    import hashlib

    columns = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    single = parts.where("parts = 1").withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).select(*columns)
    schema = T.StructType([PARTS["conv_id"], *(PARTS[c] for c in COUNTS), PARTS["audit"],
                           T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        sums, audits, digest, any_turn = {}, [], None, False
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["part"] == 0:
                    sums, audits, digest, any_turn = dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), False
                sums = {c: n + r[c] for c, n in sums.items()}
                audits.append(r["audit"])
                for t in r["turns"]:
                    digest.update(f"{chr(10) if any_turn else ''}{t['role']}:{t['text']}".encode())
                    any_turn = True
                if r["part"] == r["parts"] - 1:
                    out.append({"conv_id": r["conv_id"], **sums, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()})
            yield _batch(out, schema)

    several = parts.where("parts > 1").repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)
    return single.unionByName(several)
