"""Transcript parsing: a hidden Markov model recovers who speaks on each line, then turns are rendered alike.

The states are a role and whether the line opens a turn of it. A line shows a marker (a name that stands for a role, an
unknown name, a bullet such as ``Q:`` or none), its length, its ending and whether a blank line stands before it.
Probabilities are smoothed counts over labelled lines; Viterbi finds the likeliest states.

Transcripts may be long, so they are decoded in parts: each part sums up its paths as a matrix of best log
probabilities between states, the parts of a transcript are chained (max and plus are associative), and each part is
decoded between the states the chain found. The result is that of one pass over the whole transcript, but that the first
line of a part does not see whether the line before it was blank, and that equally likely paths may be told apart otherwise.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.shared import dealt, grouped, known, shared_dir, stored

# fixed values: roles, and names that stand for them in markers
ROLES = ("system", "user", "assistant")
NAMES = {
    "system": "system", "sys": "system", "instruction": "system", "instructions": "system",
    "user": "user", "human": "user", "q": "user", "question": "user", "customer": "user", "me": "user",
    "assistant": "assistant", "ai": "assistant", "a": "assistant", "answer": "assistant", "bot": "assistant", "model": "assistant", "gpt": "assistant",
}
MARKER = re.compile(
    r"^\s*(?:#{1,4}\s*|\*\*|<\|?(?:im_start\|>)?|\[|>\s+)?\s*([A-Za-z]{1,12})\s*(?:\*\*)?\s*(?:\|?>|\]|:\*\*|:|\s-\s)\s*(.*)$", re.S)
#: States: two for each role, opening a turn or within it.
STATES = 2 * len(ROLES)
MARKERS, LENGTHS, ENDS = len(ROLES) + 2, 5, 4
#: Lines of a part, and parts of a section.
PART, SECTION = 256, 256
#: What stands on the line above a turn.
TEMPLATE = ("<|", "|>\n")


def marker_of(line: str) -> tuple[int, str]:
    """Kind of a line's marker (roles, then an unknown name, then none) and the line without a known marker."""
    m = MARKER.match(line)
    if m is None:
        return MARKERS - 1, line
    role = NAMES.get(m.group(1).lower())
    if role is None:
        return MARKERS - 2, line
    return ROLES.index(role), m.group(2)


def features(line: str, blank_before: bool) -> tuple[int, int, int, int]:
    kind, rest = marker_of(line)
    rest = rest.strip()
    size = 0 if not rest else min(LENGTHS - 1, 1 + int(math.log2(1 + len(rest) / 40)))
    end = 0 if not rest else {"?": 1, ":": 2}.get(rest[-1], 3)
    return kind, size, end, int(blank_before)


class Model:
    """Log probabilities of first states, transitions and the four features, from smoothed counts."""

    def __init__(self, counts: dict[tuple[str, int, int], float]):
        def table(name: str, rows: int, columns: int, base: np.ndarray | float = 0.5) -> np.ndarray:
            c = np.zeros((rows, columns)) + base
            for (kind, i, j), n in counts.items():
                if kind == name:
                    c[i, j] += n
            return np.log(c / c.sum(1, keepdims=True))

        # without counts: turns begin with system or user, alternate, and continue more often than not
        first = np.full((1, STATES), 1e-3)
        first[0, [0, 2]] = 0.3, 0.5
        step = np.full((STATES, STATES), 1e-3)
        marks = np.full((STATES, MARKERS), 0.05)
        for role in range(len(ROLES)):
            begin, within = 2 * role, 2 * role + 1
            for s in (begin, within):
                step[s, within] = 0.5
                for other in range(len(ROLES)):
                    step[s, 2 * other] = 0.02 if other in (0, role) else 0.3
            step[:, within][[k for k in range(STATES) if k // 2 != role]] = 1e-9
            marks[begin, role] = 3.0
            marks[begin, -1] = 0.3
            marks[within, -1] = 3.0
            first[0, within] = 1e-9
        self.first = table("first", 1, STATES, first)[0]
        self.step = table("step", STATES, STATES, step)
        self.marker = table("marker", STATES, MARKERS, marks)
        self.size = table("size", STATES, LENGTHS)
        self.end = table("end", STATES, ENDS)
        self.blank = table("blank", STATES, 2)

    def emissions(self, seen: list[tuple[int, int, int, int]]) -> np.ndarray:
        f = np.array(seen, np.int64).reshape(-1, 4)
        return self.marker[:, f[:, 0]].T + self.size[:, f[:, 1]].T + self.end[:, f[:, 2]].T + self.blank[:, f[:, 3]].T

    def matrix(self, e: np.ndarray, opens: bool) -> np.ndarray:
        """Best log probability of the lines from each state before them to each state of the last one."""
        if opens:
            best = np.tile(self.first + e[0], (STATES, 1))
        else:
            best = self.step + e[0]
        for row in e[1:]:
            best = (best[:, :, None] + self.step[None]).max(1) + row
        return best

    def path(self, e: np.ndarray, opens: bool, before: int, last: int) -> list[int]:
        """Likeliest states of the lines, given the state before them and the last one's; ties go to the smaller state."""
        score = (self.first if opens else self.step[before]) + e[0]
        back = []
        for row in e[1:]:
            paths = score[:, None] + self.step
            back.append(paths.argmax(0))
            score = paths.max(0) + row
        out = [last]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def between(ms: tuple[np.ndarray, ...], before: int, last: int | None) -> list[int]:
    """Likeliest last state of each of a run of matrices, given the state before and, if known, the very last one."""
    best, back = ms[0][before], []
    for m in ms[1:]:
        paths = best[:, None] + m
        back.append(paths.argmax(0))
        best = paths.max(0)
    out = [int(best.argmax()) if last is None else last]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def _in_order(rows: pa.Table) -> list[tuple[int, np.ndarray]]:
    """Numbers and matrices of the rows' parts, by number."""
    pairs = zip(rows.column("part").to_pylist(), rows.column("m").to_pylist(), strict=True)
    return [(k, np.frombuffer(m, np.float64).reshape(STATES, STATES)) for k, m in sorted(pairs, key=lambda x: x[0])]


def batch_kind(rows: pa.Table) -> pa.DataType:
    return rows.schema.field("conv").type


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a batch of labelled turns: ``role``, role of the turn before, whether a blank line precedes, ``text``."""
    total: dict[tuple[str, int, int], int] = {}

    def add(kind: str, i: int, j: int) -> None:
        total[kind, i, j] = total.get((kind, i, j), 0) + 1

    for batch in batches:
        for role, before, text in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            if role not in ROLES:
                continue
            r, blank = ROLES.index(role), False
            lines = text.split("\n")
            state = None
            for k, line in enumerate(lines):
                s = 2 * r + (k > 0)
                if state is None:
                    if before in ROLES:
                        # the turn before ended in its inner state or, with one line, in its first one
                        for p in (0, 1):
                            add("step", 2 * ROLES.index(before) + p, s)
                    elif before is None:
                        add("first", 0, s)
                else:
                    add("step", state, s)
                kind, size, end, empty = features(line, blank)
                add("size", s, size), add("end", s, end)
                add("blank", s, empty)
                if k:
                    add("marker", s, kind)
                state, blank = s, not line.strip()
    rows = list(total.items())
    yield pa.RecordBatch.from_arrays([
        pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()),
        pa.array([k[2] for k, _ in rows], pa.int32()), pa.array([float(n) for _, n in rows])], ["kind", "i", "j", "n"])


def learn(turns: DataFrame) -> Model:
    """Model from all labelled turns ``conv, turn, role, text``; markers of first lines keep their prior.

    A turn without a turn of the number before it counts as a first one; other roles and null roles teach nothing. Where
    the turn before is there more than once, its smallest role counts.
    """
    # the turn before by a join on its number: no conversation is sorted as a whole
    before = turns.groupBy(F.col("conv").alias("_conv"), (F.col("turn") + 1).alias("_turn")).agg(F.min("role").alias("before"))
    rows = turns.join(before, (F.col("conv") == F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left")
    rows = rows.select("role", "before", known("text").alias("text"))
    counts = rows.mapInArrow(_counter, "kind string, i int, j int, n double").groupBy("kind", "i", "j").agg(F.sum("n").alias("n"))
    # as many rows as the tables have cells
    return Model({(r["kind"], r["i"], r["j"]): r["n"] for r in counts.collect()})


def parse(lines: DataFrame, model: Model, part: int = PART) -> DataFrame:
    """``conv, line, turn, role, opens, text`` for lines ``conv, line, text`` of transcripts, ``line`` counted upwards.

    ``part`` is how many line numbers a part spans.
    ``text`` is without its known marker on lines that open a turn; turns are counted from 0. Null texts are empty lines.
    Rows that repeat a line follow each other in no fixed order. Lines of a null conversation or a null number have no
    place: they come back with null turn and role. An empty table gives no rows.
    """
    shared_dir(lines.sparkSession)
    sent = lines.sparkSession.sparkContext.broadcast(model)
    every = lines.select("conv", F.col("line").cast("long").alias("line"), known("text").alias("text"))
    rows = every.where("conv is not null and line is not null")
    rows = stored(rows.withColumn("part", F.call_function("div", F.col("line") - F.pmod("line", F.lit(part)), F.lit(part).cast("long")).cast("long")), "lines")
    first = rows.groupBy("conv").agg(F.min("part").alias("first_part"))

    def read(part_rows: pa.Table) -> tuple[list, list, np.ndarray]:
        order = np.argsort(part_rows.column("line").to_numpy(), kind="stable")
        texts = [part_rows.column("text")[int(k)].as_py() for k in order]
        numbers = part_rows.column("line").to_numpy()[order]
        # a blank line before the part's first line is unknown to it, so it counts as none on either pass
        seen = [features(t, k > 0 and not texts[k - 1].strip()) for k, t in enumerate(texts)]
        return texts, numbers.tolist(), sent.value.emissions(seen)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in grouped(batches, ["conv", "part"]):
            _, _, e = read(p)
            opens = p.column("part")[0].as_py() == p.column("first_part")[0].as_py()
            m = sent.value.matrix(e, opens)
            yield pa.RecordBatch.from_arrays([
                p.column("conv").slice(0, 1).combine_chunks(), p.column("part").slice(0, 1).combine_chunks(),
                pa.array([opens]), pa.array([m.tobytes()], pa.binary())], ["conv", "part", "opens", "m"])

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts of a section as one matrix."""
        for p in grouped(batches, ["conv", "section"]):
            m = None
            for _, own in _in_order(p):
                m = own if m is None else (m[:, :, None] + own[None]).max(1)
            yield pa.RecordBatch.from_arrays([
                p.column("conv").slice(0, 1).combine_chunks(), p.column("section").slice(0, 1).combine_chunks(),
                pa.array([m.tobytes()], pa.binary())], ["conv", "part", "m"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """States between the sections of a transcript."""
        for p in grouped(batches, ["conv"]):
            numbers, ms = zip(*_in_order(p), strict=True)
            last = between(ms, 0, None)
            yield pa.RecordBatch.from_arrays([
                pa.array(p.column("conv").to_pylist(), batch_kind(p)), pa.array(numbers, pa.int64()),
                pa.array([0, *last[:-1]], pa.int32()), pa.array(last, pa.int32())], ["conv", "section", "before", "last"])

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """States between the parts of a section, given those at its ends."""
        for p in grouped(batches, ["conv", "section"]):
            numbers, ms = zip(*_in_order(p), strict=True)
            before = p.column("before")[0].as_py()
            last = between(ms, before, p.column("last")[0].as_py())
            yield pa.RecordBatch.from_arrays([
                pa.array(p.column("conv").to_pylist(), batch_kind(p)), pa.array(numbers, pa.int64()),
                pa.array([before, *last[:-1]], pa.int32()), pa.array(last, pa.int32())], ["conv", "part", "before", "last"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in grouped(batches, ["conv", "part"]):
            texts, numbers, e = read(p)
            opens = p.column("part")[0].as_py() == p.column("first_part")[0].as_py()
            states = sent.value.path(e, opens, p.column("before")[0].as_py(), p.column("last")[0].as_py())
            bare = [marker_of(t)[1] if s % 2 == 0 else t for t, s in zip(texts, states, strict=True)]
            opened = np.array([s % 2 == 0 for s in states])
            yield pa.RecordBatch.from_arrays([
                p.column("conv").combine_chunks(), p.column("part").combine_chunks(), pa.array(numbers, pa.int64()),
                pa.array(np.cumsum(opened)), pa.array([ROLES[s // 2] for s in states]), pa.array(opened), pa.array(bare)],
                ["conv", "part", "line", "nth", "role", "opens", "text"])

    kind = rows.schema["conv"].dataType.simpleString()
    rows = rows.join(first, "conv")
    m = dealt(rows, ["conv", "part"], matrices, f"conv {kind}, part bigint, opens boolean, m binary")
    # two levels of small rows: parts make sections, and the sections of a transcript are chained
    m = stored(m.withColumn("section", F.floor(F.col("part") / F.lit(SECTION)).cast("long")), "matrices")
    sections = dealt(m, ["conv", "section"], product, f"conv {kind}, part bigint, m binary")
    edges = dealt(sections, ["conv"], chain, f"conv {kind}, section bigint, before int, last int")
    ends = dealt(m.join(edges, ["conv", "section"]), ["conv", "section"], resolve, f"conv {kind}, part bigint, before int, last int")
    ends = stored(ends, "chained")
    done = rows.join(ends, ["conv", "part"])
    parsed = stored(dealt(done, ["conv", "part"], decode, f"conv {kind}, part bigint, line bigint, nth bigint, role string, opens boolean, text string"), "parsed")
    w = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parsed.groupBy("conv", "part").agg(F.max("nth").alias("opened")).withColumn("before", F.coalesce(F.sum("opened").over(w), F.lit(0)))
    turn = (F.col("before") + F.col("nth") - 1).alias("turn")
    placed = parsed.join(before.drop("opened"), ["conv", "part"]).select("conv", "line", turn, "role", "opens", "text")
    lost = every.where("conv is null or line is null").select(
        "conv", "line", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("boolean").alias("opens"), "text")
    return placed.unionByName(lost)


def render(parsed: DataFrame) -> DataFrame:
    """Adds ``rendered``: the line as it stands in the canonical transcript, where each turn begins with its role.

    Joining the lines of a conversation in order by line ends gives its transcript; no turn or transcript is gathered.
    """
    head = F.concat(F.lit(TEMPLATE[0]), "role", F.lit(TEMPLATE[1]))
    return parsed.withColumn("rendered", F.concat(F.when(F.col("opens"), head).otherwise(""), "text"))


#: Line numbers a turn has room for in written transcripts: more than a text can have lines.
TURN_LINES = 1 << 31


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """``conv, line, text`` of conversations written as transcripts, as they are found on the web.

    A conversation's style follows from its number: names, headings or question and answer marks; every fourth turn of
    some has no marker. Lines are numbered by turn, ``TURN_LINES`` apart; without a turn or a conversation they have no
    place, and their number is null.
    """
    style = F.pmod(F.xxhash64("conv"), F.lit(4))
    user = F.element_at(F.array(*[F.lit(x) for x in ("User: ", "### Human: ", "Q: ", "**User**: ")]), style.cast("int") + 1)
    other = F.element_at(F.array(*[F.lit(x) for x in ("Assistant: ", "### Assistant: ", "A: ", "**AI**: ")]), style.cast("int") + 1)
    named = F.when(F.col("role") == "user", user).when(F.col("role") == "assistant", other).when(F.col("role") == "system", F.lit("System: ")).otherwise(F.lit(""))
    bare = (style == 3) & (F.pmod("turn", F.lit(4)) == 3)
    text = F.concat(F.when(bare, "").otherwise(named), known("text"))
    lines = conversations.select("conv", "turn", F.posexplode(F.split(text, "\n")).alias("k", "text"))
    number = F.when(F.col("conv").isNotNull(), F.col("turn") * F.lit(TURN_LINES) + F.col("k"))
    return lines.select("conv", number.alias("line"), "text")
