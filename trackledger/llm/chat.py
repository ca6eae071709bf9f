"""Operator 7: chat formatting from transcripts, by a hidden Markov model.

A transcript is text, in one piece or several (``conv_id, place, text``), in
which speakers may or may not be named; nothing else says where a turn begins.
Its lines are put in one stream, numbered by a distributed sort. The hidden
state of a line is its speaker's role and whether the line begins a turn; what
is seen of it is a speaker-marker (``User:``, ``**Bot**:``, ``### Human:`` and
the like), blank lines before it, its length, its last sign and how it starts.
A further line of a turn can only follow a line of the same role. Start,
transition and emission tables are counted by Spark from transcripts whose roles
are known; they have a fixed, small size. The Viterbi path gives roles and turns:
a turn begins where its state says so. Markers that named the role are taken
off, and the turn is rendered as ``<|im_start|>role\\ntext<|im_end|>``.

A conversation may be of any length. The stream is cut into blocks of ``BLOCK``
lines: a block yields its best scores from every state to every state, a product
over the max-plus algebra; the products of ``BLOCK`` blocks yield one of the
next level, and only those of a conversation meet in one task: one small matrix
for a million lines. On the way back the states at the ends become known, and
every block is decoded by itself. Turns that cross an edge of a block are put
together from their parts; no other text is shuffled for it.

Defined results: a null or empty piece, or one of white space, shows no line and
makes no turn; a null or unknown role counts for no table; pieces that share a
place are ordered by their text, repeated pieces are shown as often as they are
there; pieces without ``conv_id`` are one transcript; pieces without a place come
last in theirs; blank lines inside a turn stay, those around it go; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from trackledger.llm.toxicity import held_out
from trackledger.operators.blocks import BLOCK as AT
from trackledger.operators.blocks import number_rows, rows_before
from trackledger.session import materialize

ROLES = ("system", "user", "assistant")
#: Two states for each role: the first line of a turn, and a further one.
STATES = 2 * len(ROLES) + 1
START = STATES - 1  # before the first line
BLOCK = 1024
BATCH = 2048
FOLD = 0

# Names that transcripts use for the roles.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a"),
}
_MARKER = re.compile(
    r"^\s*(?:#{1,4}\s*|\*\*|\[|<\|?)?(" + "|".join(n for names in MARKERS.values() for n in names) + r")(?:\*\*)?(?:\]|\|?>)?\s*[:>\]]\s*",
    re.IGNORECASE,
)
_ROLE_OF = {name: role for role, names in MARKERS.items() for name in names}

#: Ways to show a marker, taken in turn.
STYLES = ("%s: ", "**%s**: ", "### %s: ", "[%s]: ")

SEEN_SIZES = (len(ROLES) + 1, 2, 4, 4, 2)

_LINE = pa.schema(
    [
        ("conv_id", pa.int64()), ("place", pa.int64()), ("piece", pa.string()), ("k", pa.int32()), ("line", pa.string()),
        ("gap", pa.int32()), ("after", pa.int32()), ("role", pa.string()), ("begins", pa.bool_()),
    ]
)


def marker(line: str) -> tuple[int, str]:
    """(number of the role that the line's marker names, from 1; 0: none), and the rest."""
    found = _MARKER.match(line)
    if not found:
        return 0, line
    return 1 + ROLES.index(_ROLE_OF[found[1].lower()]), line[found.end() :]


def observe(line: str, blank_before: bool) -> tuple[int, ...]:
    """What is seen of a line, one small number per feature."""
    number, rest = marker(line)
    end = rest.rstrip()[-1:]
    sign = 1 if end == "?" else 2 if end in (".", "!") else 3 if end in (":", ",") else 0
    length = sum(len(rest) >= n for n in (40, 120, 400))
    return number, int(blank_before), length, sign, int(rest[:1].isupper())


def _allowed() -> np.ndarray:
    """Moves that exist: to the first line of any turn, or on in a turn of the same role."""
    found = np.zeros((STATES, STATES), dtype=bool)
    found[:, 0:START:2] = True
    for state in range(1, START, 2):
        found[state - 1 : state + 1, state] = True
    return found


class Tables:
    """Log probabilities of transition and emission."""

    def __init__(self, move: np.ndarray, emit: Sequence[np.ndarray]):
        counts = np.where(_allowed(), move + 0.1, 0)
        with np.errstate(divide="ignore"):
            self.move = np.log(counts / counts.sum(axis=1, keepdims=True))
        # A role with few lines behaves as the others do in their place.
        self.emit = []
        for feature, table in enumerate(emit):
            found = np.zeros((STATES, table.shape[1]))
            for kind in (0, 1):
                states = np.arange(kind, START, 2)
                whole = np.repeat(table[states].sum(axis=0, keepdims=True) + 0.1, len(states), axis=0)
                if feature == 0:  # markers: none, the role's own, another's
                    own = table[states, 1 + np.arange(len(states))].sum() + 0.1
                    other = table[states, 1:].sum() - own + 0.2
                    whole[:, 1:] = other / (len(ROLES) - 1)
                    whole[np.arange(len(states)), 1 + np.arange(len(states))] = own
                whole /= whole.sum(axis=1, keepdims=True)
                found[states] = (table[states] + 5 * whole) / (table[states].sum(axis=1, keepdims=True) + 5)
            with np.errstate(divide="ignore"):
                self.emit.append(np.log(found))

    def seen(self, lines: Sequence[tuple[int, ...]]) -> np.ndarray:
        """Log emission of every line from every state."""
        seen = np.array(lines, dtype=np.int64).reshape(len(lines), len(self.emit))
        return sum(table[:, seen[:, k]].T for k, table in enumerate(self.emit))

    def product(self, seen: np.ndarray) -> np.ndarray:
        """Best score of the lines from every state before them to every state of the last one."""
        return _product([self.move + row for row in seen])

    def path(self, seen: np.ndarray, before: int, last: int | None = None) -> list[int]:
        """States of the lines on the best path from ``before``, to ``last`` if it is known."""
        return _path([self.move + row for row in seen], before, last)


def _product(steps: Sequence[np.ndarray]) -> np.ndarray:
    total = steps[0]
    for step in steps[1:]:
        total = (total[:, :, None] + step[None]).max(axis=1)
    return total


def _path(steps: Sequence[np.ndarray], before: int, last: int | None) -> list[int]:
    """State after each step on the best path."""
    score, back = steps[0][before], []
    for step in steps[1:]:
        each = score[:, None] + step
        back.append(each.argmax(axis=0))
        score = each.max(axis=0)
    states = [int(score.argmax()) if last is None else last]
    for step in reversed(back):
        states.append(int(step[states[-1]]))
    return states[::-1]


def shown(conversations: DataFrame, unmarked: int = 4) -> DataFrame:
    """Transcripts of conversations whose roles are known: conv_id, place, text, role.

    Most turns begin with a marker, in one of ``STYLES``; those whose crc32 falls
    into one of ``unmarked`` parts, and those without a role, are only set off by
    a blank line.
    """
    where = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    number = F.crc32(where.cast("binary"))
    style = F.get(F.array(*[F.lit(s) for s in STYLES]), (F.floor(number / unmarked) % len(STYLES)).cast("int"))
    named = F.replace(style, F.lit("%s"), F.initcap("role"))
    bare = (number % unmarked == 0) | F.col("role").isNull()
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("place"),
        F.concat(F.when(bare, "\n").otherwise(named), F.coalesce("text", F.lit(""))).alias("text"),
        F.lower("role").alias("role"),
    )


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Lines that are not blank, with the number of blank ones before and, for the last, after them."""
    for batch in batches:
        for conv_id, place, text, role in zip(*(column.to_pylist() for column in batch.columns)):
            gap, held = 0, None
            for line in (text or "").removesuffix("\n").split("\n"):
                if not line.strip():
                    gap += 1
                    continue
                if held:
                    yield held
                k = held[3] + 1 if held else 0
                held, gap = (conv_id, place, text, k, line, gap, 0, role, k == 0), 0
            if held:
                yield (*held[:6], gap, *held[7:])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, BATCH)):
        yield pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*part), schema)], schema=schema)


def _mapped(frame: DataFrame, rows, schema: pa.Schema) -> DataFrame:
    return frame.mapInArrow(lambda batches: _batches(rows(batches), schema), from_arrow_schema(schema))


def stream(transcripts: DataFrame) -> DataFrame:
    """All lines of ``transcripts`` (conv_id, place, text, and role where it is known), numbered, in blocks.

    A block's first line comes with the one before it (``lead``), which belongs
    to the block before.
    """
    role = F.col("role") if "role" in transcripts.columns else F.lit(None).cast("string")
    pieces = transcripts.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("place").cast("long").alias("place"), "text", role.alias("role")
    )
    lines = number_rows(materialize(_mapped(pieces, _split, _LINE)), ["conv_id", "place", "piece", "k"], "g")
    block = F.floor(F.col("g") / BLOCK)
    ends = F.col("g") % BLOCK == BLOCK - 1
    blocks = F.when(ends, F.array(block, block + 1)).otherwise(F.array(block))
    dealt = lines.select("conv_id", F.posexplode(blocks).alias("lead", "block"), "g", "line", "gap", "after", "role", "begins")
    return materialize(dealt.withColumn("lead", F.col("lead") == 1))


_COLUMNS = ["conv_id", "block", "g", "lead", "line", "gap", "after", "role", "begins"]


def _sorted_runs(frame: DataFrame, *keys: str, order: Sequence[str]) -> DataFrame:
    """Rows of equal ``keys`` in one task, after each other; many runs to a task, not a call for each."""
    return frame.repartition(*keys).sortWithinPartitions(*keys, *order)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """The rows of each run of equal first ``keys`` columns (nulls are equal)."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and row[:keys] != held[0][:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _own(run: list[tuple]) -> tuple[tuple | None, list[tuple]]:
    """(the line before a block, if it has one in its transcript; the block's lines)."""
    lead = run[0] if run[0][3] else None
    return lead, run[1:] if lead else run


def _seen(lead: tuple | None, lines: list[tuple]) -> list[tuple[int, ...]]:
    blank = [lead[6] > 0 if lead else False, *(line[6] > 0 for line in lines[:-1])]
    return [observe(line[4], b or line[5] > 0) for line, b in zip(lines, blank)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Transitions between neighbouring lines, and emissions."""
    emit = [np.zeros((STATES, n), np.int64) for n in SEEN_SIZES]
    move = np.zeros((STATES, STATES), np.int64)

    def state(line: tuple) -> int | None:
        return 2 * ROLES.index(line[7]) + (not line[8]) if line[7] in ROLES else None

    for run in _runs(batches, 2):
        lead, lines = _own(run)
        if not lines:
            continue
        states = [START if lead is None else state(lead), *map(state, lines)]
        for before, now in itertools.pairwise(states):
            if before is not None and now is not None:
                move[before, now] += 1
        for now, values in zip(states[1:], _seen(lead, lines)):
            if now is not None:
                for table, value in zip(emit, values):
                    table[now, value] += 1
    for kind, table in enumerate([move, *emit]):
        yield from ((kind, int(a), int(b), int(table[a, b])) for a, b in zip(*np.nonzero(table)))


def train(lines: DataFrame, fold: int = FOLD) -> Tables:
    """Count the tables from the transcripts outside the held-out fold."""
    known = lines.where(~held_out(F.col("conv_id"), fold)).select(*_COLUMNS)
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
    counted = _mapped(_sorted_runs(known, "conv_id", "block", order=["g"]), _count, schema)
    tables = [np.zeros((STATES, n)) for n in (STATES, *SEEN_SIZES)]
    for r in counted.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():  # a row for a cell of a table
        tables[r["kind"]][r["a"], r["b"]] += r["n"]
    return Tables(tables[0], tables[1:])


_KEY = [("conv_id", pa.int64()), ("group", pa.int64()), ("block", pa.int64())]
_MATRIX = pa.schema([*_KEY, ("total", pa.binary())])
_ENDS = pa.schema([*_KEY, ("before", pa.int32()), ("last", pa.int32())])
_PART = pa.schema(
    [
        ("conv_id", pa.int64()), ("first", pa.int64()), ("nth", pa.int64()), ("g", pa.int64()), ("begins", pa.int64()),
        ("edge", pa.bool_()), ("role", pa.string()), ("n_lines", pa.int64()), ("text", pa.string()),
    ]
)


def _matrix(value: bytes) -> np.ndarray:
    return np.frombuffer(value).reshape(STATES, STATES)


def _ends(lines: DataFrame, tables: Tables) -> DataFrame:
    """conv_id, block, and the states before it and of its last line, on the best path of its transcript."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for run in _runs(batches, 2):
            lead, own = _own(run)
            if own:
                total = tables.product(tables.seen(_seen(lead, own)))
                yield run[0][0], run[0][1] // BLOCK, run[0][1], total.tobytes()

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for run in _runs(batches, 2):
            yield *run[0][:3], _product([_matrix(row[3]) for row in run]).tobytes()

    def group_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for run in _runs(batches, 1):
            last = _path([_matrix(row[3]) for row in run], START, None)
            yield from ((*row[:3], *pair) for row, pair in zip(run, itertools.pairwise([START, *last])))

    def block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (_, _, _, _, before, last, _), *run in _runs(batches, 2):
            states = _path([_matrix(row[3]) for row in run], before, last)
            yield from ((*row[:3], *pair) for row, pair in zip(run, itertools.pairwise([before, *states])))

    totals = materialize(_mapped(_sorted_runs(lines, "conv_id", "block", order=["g"]), products, _MATRIX))
    groups = _mapped(_sorted_runs(totals, "conv_id", "group", order=["block"]), grouped, _MATRIX)
    marks = _mapped(_sorted_runs(groups, "conv_id", order=["group"]), group_ends, _ENDS)
    both = totals.withColumn("is_block", F.lit(True)).unionByName(
        marks.withColumn("is_block", F.lit(False)), allowMissingColumns=True
    )
    both = _sorted_runs(both, "conv_id", "group", order=["is_block", "block"])
    return _mapped(both.select("conv_id", "group", "block", "total", "before", "last", "is_block"), block_ends, _ENDS)


def _parts(tables: Tables):
    """Decoded turns of a block; those at its edges may be parts of longer ones."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for mark, *run in _runs(batches, 2):
            if mark[2] is not None:  # the line before a block that its transcript does not reach
                continue
            before, last = mark[9:]
            lead, lines = _own([row[:9] for row in run])
            states = tables.path(tables.seen(_seen(lead, lines)), before, last)
            found: list[list] = []
            for line, state in zip(lines, states):
                role, begins = ROLES[state // 2], state % 2 == 0
                text = line[4]
                if begins:
                    number, rest = marker(text)
                    text = rest if number and ROLES[number - 1] == role else text
                if begins or not found:
                    found.append([line[2], int(begins), role, [], 0])
                blank = [""] * line[5] if not begins else []
                found[-1][3] += [*blank, text, *[""] * line[6]]
                found[-1][4] += 1
            number = 0
            for k, (g, begins, role, texts, n_lines) in enumerate(found):
                number += begins
                edge = not begins or k == len(found) - 1
                yield lines[0][0], lines[0][2], number, g, begins, edge, role, n_lines, "\n".join(texts)

    return decoded


def parse(lines: DataFrame, tables: Tables) -> DataFrame:
    """The turns of a ``stream``: conv_id, first_line, n_lines, role, text, rendered.

    ``first_line`` numbers the lines of all transcripts, in order.
    """
    lines = lines.select(*_COLUMNS)
    marks = _ends(lines, tables).drop("group").withColumn("is_line", F.lit(False))
    both = lines.withColumn("is_line", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    both = _sorted_runs(both, "conv_id", "block", order=["is_line", "g"])
    parts = materialize(_mapped(both.select(*_COLUMNS, "before", "last"), _parts(tables), _PART))
    # A part without a first line goes on with the last turn begun before its block.
    begun = parts.groupBy(F.col("first").alias(AT)).agg(F.sum("begins").alias("_n"))
    offsets = materialize(rows_before(materialize(begun)))
    edges = parts.where("edge").join(offsets, F.col("first") == F.col(AT))
    edges = edges.withColumn("turn", F.col("_offset") + F.col("nth"))
    piece = F.struct("g", "text", "role")
    whole = edges.groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum("n_lines").alias("n_lines"), F.max("begins").alias("begins")
    )
    whole = whole.where("begins = 1").select(
        "conv_id",
        F.col("pieces")[0]["g"].alias("first_line"),
        "n_lines",
        F.col("pieces")[0]["role"].alias("role"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("text"),
    )
    turns = parts.where("NOT edge").select("conv_id", F.col("g").alias("first_line"), "n_lines", "role", "text").unionByName(whole)
    turns = turns.withColumn("text", F.regexp_replace("text", r"\n+\z", ""))
    rendered = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    return turns.withColumn("rendered", rendered)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every turn that is found in the transcripts of the conversations."""
    lines = stream(shown(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return parse(lines, train(lines)).select(
        "conv_id",
        "first_line",
        held_out(F.col("conv_id"), FOLD).alias("held_out"),
        "role",
        "n_lines",
        F.sha2("rendered", 256).alias("rendered_sha256"),
    )
