"""Chat formatting: roles of transcript lines by a hidden Markov model (operator 8).

A transcript is plain text in which some turns start with a speaker marker
("User: ...", "### Assistant", "[system]") and others with none. Hidden states are
the role of a line and whether it opens a turn; a line shows its marker, its length
and whether it follows a blank line. Start, transition and emission probabilities
are smoothed counts over all labelled lines, summed by Spark. Viterbi finds the
likeliest states of a transcript, and the turns they describe are rendered in one
canonical form.

A conversation longer than SEGMENT_ROWS turns is held in several rows, so that none
is too large for a task. Its states are those of one Viterbi pass over all its lines:
the best scores between the ends of segments compose like matrices (sums for products,
maxima for sums), up a tree over the segments and down again with the states at
each border. Of equally likely paths a segmented conversation may take another one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import keep

ROLES = ("system", "user", "assistant")
#: Turns in one row; a longer conversation goes on in the next row, with the state carried over.
SEGMENT_ROWS = 4096
#: Segments joined at each level of the tree over a long conversation: 2 to this power.
FAN_BITS = 8
#: Speaker names of markers (fixed values).
SPEAKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "model", "answer", "a"),
}
ROLE_OF = {name: role for role, names in SPEAKERS.items() for name in names}
MARKER = re.compile(
    r"^\s*(?:#{1,6}\s*|\*\*|\[|<\|?)?(" + "|".join(sorted(ROLE_OF, key=len, reverse=True)) + r")(?:\s*(?::\*\*|\*\*:|[:>\]]|\|>)|\s*$)\s*",
    re.IGNORECASE)
OTHER_MARKER = re.compile(r"^\s*[^\W\d_][\w .-]{0,30}:\s")
MARKERS = (*ROLES, "other", "none")
LENGTHS = (1, 40, 100, 200, 400, 800)
STATES = 2 * len(ROLES)  # 2 * role + (0 opens a turn, 1 goes on)
UNSTARTED = STATES  # before the first line
SMOOTHING = 0.5


def features(line: str, after_blank: bool) -> tuple[int, int, int, str]:
    """Marker, length class, whether a blank line precedes, and the line without its marker."""
    found = MARKER.match(line)
    if found:
        marker, rest = MARKERS.index(ROLE_OF[found[1].lower()]), line[found.end():]
    else:
        marker, rest = MARKERS.index("other" if OTHER_MARKER.match(line) else "none"), line
    return marker, int(np.searchsorted(LENGTHS, len(rest.strip()), side="right")), int(after_blank), rest


def observe(text: str | None, after_blank: bool = False) -> list[tuple[int, int, int, str]]:
    """Features of every line that is not blank."""
    out, blank = [], bool(after_blank)
    for line in (text or "").split("\n"):
        if line.strip():
            out.append(features(line, blank))
        blank = not line.strip()
    return out


@dataclass(frozen=True)
class Model:
    """Log probabilities of starts, transitions and the three features."""

    start: np.ndarray
    move: np.ndarray
    marker: np.ndarray
    length: np.ndarray
    blank: np.ndarray

    def _emitted(self, seen: list[tuple[int, int, int, str]]) -> list[np.ndarray]:
        return [self.marker[:, m] + self.length[:, n] + self.blank[:, b] for m, n, b, _ in seen]

    def _entering(self, before: int | None) -> np.ndarray:
        """Scores of the first line's states: the line opens a turn unless a line came before."""
        if before is not None and before != UNSTARTED:
            return self.move[before]
        return np.where(np.arange(STATES) % 2, -np.inf, self.start)

    def viterbi(self, seen: list[tuple[int, int, int, str]], before: int | None = None, ends: int | None = None) -> list[int]:
        """Likeliest states, after the state ``before`` and up to the state ``ends`` where given; the smallest state of equal ones."""
        if not seen:
            return []
        emitted = self._emitted(seen)
        best = self._entering(before) + emitted[0]
        back = np.empty((len(seen), STATES), np.int8)
        for t in range(1, len(seen)):
            ways = best[:, None] + self.move
            back[t] = ways.argmax(axis=0)
            best = ways.max(axis=0) + emitted[t]
        state = int(best.argmax() if ends is None else ends)
        out = [state]
        for t in range(len(seen) - 1, 0, -1):
            state = int(back[t, state])
            out.append(state)
        return out[::-1]

    def passage(self, seen: list[tuple[int, int, int, str]]) -> np.ndarray:
        """Best score of all lines for each state before them and each last state; no lines leave the state as it is."""
        best = np.where(np.eye(STATES + 1, dtype=bool), 0.0, -np.inf)
        for t, emitted in enumerate(self._emitted(seen)):
            if t:
                best[:, :STATES] = (best[:, :STATES, None] + self.move).max(axis=1) + emitted
            else:
                best[:, :STATES] = np.stack([self._entering(s) for s in range(STATES + 1)]) + emitted
                best[:, UNSTARTED] = -np.inf
        return best


#: Tables of counts and their shapes.
SHAPES = {"start": (1, STATES), "move": (STATES, STATES), "marker": (STATES, len(MARKERS)),
          "length": (STATES, len(LENGTHS) + 1), "blank": (STATES, 2)}


def _segments(rows: DataFrame) -> DataFrame:
    """``rows`` with the segment of each turn: SEGMENT_ROWS turns after each other, in the order of number, role and text.

    Only rows of long transcripts (their names are written first: few are broadcast) are numbered: within blocks of SEGMENT_ROWS turn
    numbers, each block starting where a running sum over the counts of blocks says.
    """
    sizes = keep(rows.groupBy("transcript").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SEGMENT_ROWS).select("transcript"), "long")
    short = rows.join(sizes, "transcript", "left_anti").withColumn("segment", F.lit(0).cast("long"))
    blocked = rows.join(sizes, "transcript", "left_semi").withColumn("block", F.floor(F.col("turn") / SEGMENT_ROWS))
    before = Window.partitionBy("transcript").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = blocked.groupBy("transcript", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "transcript", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("transcript", "block").orderBy("turn", "role", "text")
    numbered = blocked.join(first, ["transcript", "block"]).withColumn(
        "segment", F.floor((F.col("first") + F.row_number().over(inside) - 1) / SEGMENT_ROWS))
    return short.unionByName(numbered.drop("block", "first"))


def _borders(segments: DataFrame) -> DataFrame:
    """``segments`` with what the segment before tells: whether its last line is blank, and its last true state."""
    last = F.try_element_at(F.filter(F.arrays_zip("roles", "lines"), lambda x: x["lines"] > 0), F.lit(-1))
    known = ~F.exists("roles", lambda r: r.isNull())
    true_state = 2 * (F.array_position(F.array(*map(F.lit, ROLES)), last["roles"]) - 1) + (last["lines"] > 1).cast("int")
    before = segments.select(
        "transcript", (F.col("segment") + 1).alias("segment"),
        (F.length(F.trim(F.element_at(F.split("text", "\n"), -1))) == 0).alias("after_blank"),
        F.when(known, true_state).cast("int").alias("true_before"))
    return segments.join(before, ["transcript", "segment"], "left").withColumn("after_blank", F.coalesce("after_blank", F.lit(False)))


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, transcript, segment, text, roles, lines, after_blank, true_before): conversations written as plain transcripts.

    The style of a transcript and the turns that lack a marker follow from hashes of its
    id and turns, so that all kinds occur. ``roles`` and ``lines`` (lines that are not
    blank) of each turn are the truth that a model is trained on. A conversation is one
    row, segment 0; from SEGMENT_ROWS turns on it goes on in segments 1, 2, ..., with
    what the segment before tells in the last two columns. Identical rows of a turn are
    one turn, different texts with one number follow each other by role and text. A row
    without conversation or turn number is a transcript of its own. A null or unknown
    role is written without a marker and not learned from; a null text is empty.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct().withColumn("role", F.when(F.col("role").isin(*ROLES), F.col("role")))
    named = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("conv_id", "turn", "role")]
    rows = rows.withColumn("transcript", F.when(
        F.col("conv_id").isNull() | F.col("turn").isNull(), F.concat(F.lit("row "), F.hex(F.xxhash64(*named, "text")))
    ).otherwise(F.col("conv_id").cast("string")))
    seed = F.xxhash64("conv_id", "turn", "text")
    style = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    speaker = F.initcap("role")
    marked = (
        F.when(style == 0, F.concat(speaker, F.lit(": ")))
        .when(style == 1, F.concat(F.element_at(F.create_map(
            F.lit("system"), F.lit("Context"), F.lit("user"), F.lit("Human"), F.lit("assistant"), F.lit("AI")), F.col("role")), F.lit(": ")))
        .when(style == 2, F.concat(F.lit("### "), speaker, F.lit("\n")))
        .otherwise(F.concat(F.lit("["), F.col("role"), F.lit("] ")))
    )
    written = F.concat(F.when(F.col("role").isNotNull() & (F.pmod(seed, F.lit(6)) != 0), marked).otherwise(F.lit("\n")), F.col("text"))
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "written")))
    found = keep(
        _segments(keep(rows, "turns")).withColumn("written", written).groupBy("conv_id", "transcript", "segment").agg(turns.alias("turns"))
        .select("conv_id", "transcript", "segment", F.array_join(F.col("turns.written"), "\n").alias("text"), F.col("turns.role").alias("roles"),
                F.transform("turns", lambda t: F.size(F.filter(F.split(t["written"], "\n"), lambda x: F.length(F.trim(x)) > 0))).alias("lines")),
        "segments")
    short, long = _parted(found)
    return short.withColumns({"after_blank": F.lit(False), "true_before": F.lit(None).cast("int")}).unionByName(_borders(long))


def _parted(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments of transcripts that have one segment, and those of all others. The names are written first: few are broadcast."""
    more = keep(found.where(F.col("segment") > 0).select("transcript").distinct(), "long")
    return found.join(more, "transcript", "left_anti"), found.join(more, "transcript", "left_semi")


def _truth(roles: list, lines: list) -> list[int] | None:
    """States of a transcript's lines; None if a role is unknown."""
    if any(r not in ROLES for r in roles):
        return None
    return [2 * ROLES.index(r) + (k > 0) for r, n in zip(roles, lines) for k in range(n)]


def train(labelled: DataFrame) -> Model:
    """Counts over all labelled ``transcripts``, summed in Spark; a few hundred numbers reach the driver.

    The first line of a later segment follows the last line of the one before it; this
    move is not known, and not counted, if that segment has only blank lines.
    """
    columns = ["text", "roles", "lines", "segment", "after_blank", "true_before"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {name: np.zeros(shape, np.int64) for name, shape in SHAPES.items()}
            for text, roles, lines, segment, blank, before in zip(*(batch.column(c).to_pylist() for c in columns)):
                states, seen = _truth(roles, lines), observe(text, blank)
                if not states or len(states) != len(seen):
                    continue
                if segment == 0:
                    counts["start"][0, states[0]] += 1
                elif before is not None:
                    counts["move"][before, states[0]] += 1
                np.add.at(counts["move"], (states[:-1], states[1:]), 1)
                for k, name in enumerate(("marker", "length", "blank")):
                    np.add.at(counts[name], (states, [s[k] for s in seen]), 1)
            flat = [(name, i, int(n)) for name, table in counts.items() for i, n in enumerate(table.ravel()) if n]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in flat], pa.string()), pa.array([f[1] for f in flat], pa.int32()),
                 pa.array([f[2] for f in flat], pa.int64())], ["name", "place", "n"])

    counted = labelled.select(*columns).mapInArrow(run, "name string, place int, n long")
    tables = {name: np.full(shape, SMOOTHING) for name, shape in SHAPES.items()}
    for row in counted.groupBy("name", "place").agg(F.sum("n").alias("n")).collect():
        tables[row["name"]].ravel()[row["place"]] += row["n"]
    logs = {name: np.log(t / t.sum(axis=1, keepdims=True)) for name, t in tables.items()}
    return Model(logs["start"][0], logs["move"], logs["marker"], logs["length"], logs["blank"])


def _rendered(seen: list[tuple[int, int, int, str]], states: list[int], before: int | None, closed: bool) -> tuple[list[str], str]:
    """Roles of the turns that open, and their canonical text; a marker is dropped from the line that opens a turn.

    ``before`` is the state of the line before (none: nothing is open), ``closed``
    whether the last turn ends here.
    """
    open_role = None if before is None or before == UNSTARTED else ROLES[before // 2]
    roles, out = [], []
    for state, (_, _, _, rest) in zip(states, seen):
        role, goes_on = ROLES[state // 2], state % 2
        if not goes_on or open_role != role:
            if open_role:
                out.append("<|end|>\n")
            out.append(f"<|{role}|>\n")
            roles.append(role)
            open_role = role
        if rest.strip():
            out.append(rest + "\n")
    if open_role and closed:
        out.append("<|end|>\n")
    return roles, "".join(out)


def _chats(packed: DataFrame, model: Model) -> DataFrame:
    """(row, n_lines, roles, chat) of (row, text, after_blank, before, ends, closed)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, roles, chats = [], [], []
            for text, blank, before, ends, closed in zip(*(batch.column(c).to_pylist() for c in ("text", "after_blank", "before", "ends", "closed"))):
                seen = observe(text, blank)
                opened, chat = _rendered(seen, model.viterbi(seen, before, ends), before, closed)
                lines.append(len(seen))
                roles.append(opened)
                chats.append(chat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lines, pa.int64()), pa.array(roles, pa.list_(pa.string())), pa.array(chats, pa.string())],
                ["row", "n_lines", "roles", "chat"])

    return packed.mapInArrow(
        run, f"row {packed.schema['row'].dataType.simpleString()}, n_lines long, roles array<string>, chat string")


def formatted(found: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, n_lines, roles, chat), one per row of ``found``: recovered roles of the turns and the canonical text.

    A null or blank transcript has no turns and the empty text. ``row`` holds the other
    columns of the input whatever their names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in found.columns if c != text_col])
    none = F.lit(None).cast("int")
    return _chats(found.select(
        row.alias("row"), F.col(text_col).cast("string").alias("text"), F.lit(False).alias("after_blank"), none.alias("before"),
        none.alias("ends"), F.lit(True).alias("closed")), model)


def formatted_transcripts(found: DataFrame, model: Model) -> DataFrame:
    """``formatted`` for ``transcripts`` (a written table): the segments of a conversation follow each other.

    Roles and canonical texts of its segments, put together, are those of the whole
    conversation: a segment opens with what is left of the turn before, and
    ends its last turn only if it is the conversation's last.
    """
    short, long = _parted(found)
    carried = _carried(long, model)
    row = F.struct("conv_id", "transcript", "segment").alias("row")
    ahead = long.join(carried, ["transcript", "segment"]).select(row, "text", "after_blank", "before", "ends", "closed")
    none = F.lit(None).cast("int")
    alone = short.select(row, "text", "after_blank", none.alias("before"), none.alias("ends"), F.lit(True).alias("closed"))
    return _chats(alone.unionByName(ahead), model)


def _parent() -> Column:
    return F.shiftright("block", FAN_BITS).alias("parent")


def _carried(segments: DataFrame, model: Model) -> DataFrame:
    """(transcript, segment, before, ends, closed): states on the best path at both ends of each segment, and whether it is the last."""
    side = STATES + 1

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.passage(observe(t, b)).ravel() for t, b in zip(batch.column("text").to_pylist(), batch.column("after_blank").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("transcript"), batch.column("block"), pa.array(scores, pa.list_(pa.float64()))], ["transcript", "block", "scores"])

    def matrices(group: pd.DataFrame) -> list[np.ndarray]:
        return [np.asarray(m).reshape(side, side) for m in group["scores"]]

    def composed(group: pd.DataFrame) -> pd.DataFrame:
        first, *others = matrices(group.sort_values("block"))
        for other in others:
            first = (first[:, :, None] + other).max(axis=1)
        return pd.DataFrame({"transcript": group["transcript"].iloc[:1], "block": group["parent"].iloc[:1], "scores": [first.ravel()]})

    def traced(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        best = np.where(np.arange(side) == group["before"].iloc[0], 0.0, -np.inf)
        back = []
        for scores in matrices(group):
            ways = best[:, None] + scores
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0)
        states = [int(group["ends"].iloc[0]) if group["ends"].iloc[0] >= 0 else int(best.argmax())]
        for step in back[::-1]:
            states.append(int(step[states[-1]]))
        states.reverse()
        closed = [False] * (len(group) - 1) + [bool(group["closed"].iloc[0])]
        return pd.DataFrame({"transcript": group["transcript"], "block": group["block"], "before": states[:-1], "ends": states[1:], "closed": closed})

    shape = "transcript string, block long, scores array<double>"
    levels = [keep(segments.select("transcript", F.col("segment").alias("block"), "text", "after_blank").mapInArrow(passages, shape), "passages")]
    top = levels[0].agg(F.max("block")).first()[0] or 0
    while top >> FAN_BITS:
        levels.append(keep(levels[-1].withColumn("parent", _parent()).groupBy("transcript", "parent").applyInPandas(composed, shape), "passages"))
        top >>= FAN_BITS
    # the whole conversation: nothing before it, any state (-1) at its end
    above = levels[-1].select("transcript", F.lit(0).cast("long").alias("parent")).distinct().withColumns(
        {"before": F.lit(UNSTARTED), "ends": F.lit(-1), "closed": F.lit(True)})
    for level in reversed(levels):
        traces = level.withColumn("parent", _parent()).join(above, ["transcript", "parent"]).groupBy("transcript", "parent").applyInPandas(
            traced, "transcript string, block long, before int, ends int, closed boolean")
        above = keep(traces, "traces").withColumnRenamed("block", "parent")
    return above.withColumnRenamed("parent", "segment")
