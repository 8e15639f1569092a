"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is lines in order, some with a speaker's marker in front, many without. The hidden state
of a line is who speaks and whether the turn begins with it; what is seen of a line are its marker and its
features (length, ending, first letter, blank line above). Start, transition and emission probabilities are
counted from transcripts whose roles are known. Viterbi finds the likeliest states of a whole transcript, and the
lines between two beginnings are one turn.

A transcript may have any number of lines. It is cut into slices by line number; a slice's best scores from each
state to each are a small matrix, the matrices of a transcript are chained over one row per slice, and each slice is then decoded
between the states so found. So no task ever holds more lines than a slice, but for lines of one number.

Defined results: a null conv_id makes each of its rows a transcript of its own; a null turn comes after all others, rows of
the same turn in the order of a hash of role and text, the same in every run. A null or empty text is one empty line. A role that is null or none of ROLES is not
learnt from. Without any known role every state is equally likely and all is one ``user`` turn after another by its markers.
Repeated rows are repeated lines. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from factorframe.llm.common import saved, spread, table

ROLES = ("system", "user", "assistant")
#: States: each role at the first line of a turn, then each role further on.
STATES = 2 * len(ROLES)
SLICE_TURNS = 64
#: Markers as transcripts have them: which kind of speaker each names.
MARKERS = (
    ("system", r"\s*(?:#+\s*)?(?:system|instructions?|context)\s*:"),
    ("user", r"\s*(?:#+\s*)?(?:user|human|question|q|you|customer)\s*:"),
    ("assistant", r"\s*(?:#+\s*)?(?:assistant|bot|answer|a|ai|model|agent)\s*:"),
)
_STYLES = (("System: ", "User: ", "Assistant: "), ("### System: ", "### Human: ", "### Bot: "), ("Context: ", "Q: ", "A: "))
#: Number of values of each feature.
FEATURES = {"marker": 4, "length": 4, "ending": 3, "opening": 3, "gap": 2}


def transcripts(conversations: DataFrame, *, unmarked_percent: int = 30, joined_percent: int = 20) -> DataFrame:
    """conv, turn, at, line, gap (a blank line is above it) and role of each line, written the way transcripts are.

    The style of markers is a conversation's own. By a hash, some of the turns have no marker, and some no
    blank line before them. Only the order of turn, tie and at is used later, and the role to learn from.
    """
    conv = F.coalesce(
        F.col("conv_id").cast("string"), F.concat(F.lit("?"), F.xxhash64("turn", "role", "text"), F.lit("-"), F.monotonically_increasing_id())
    )
    style = F.pmod(F.xxhash64("conv"), F.lit(len(_STYLES)))
    marked = F.pmod(F.xxhash64("conv", "turn", F.lit("marked")), F.lit(100)) >= unmarked_percent
    names = F.array(*[F.array(*[F.lit(m) for m in s]) for s in _STYLES])
    role = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.coalesce("role", F.lit(""))).cast("int")
    marker = F.when(marked & (role > 0), F.element_at(F.get(names, style.cast("int")), F.when(role > 0, role).otherwise(1))).otherwise("")
    parts = F.split(F.concat(marker, F.coalesce("text", F.lit(""))), "\n", -1)
    apart = (F.pmod(F.xxhash64("conv", "turn", F.lit("apart")), F.lit(100)) >= joined_percent).cast("int")
    blank = lambda x: F.btrim(x) == ""
    lines = F.zip_with(
        "parts",
        F.concat(F.array(F.lit("x")), F.slice("parts", 1, F.size("parts") - 1)),
        lambda x, above: F.struct(x.alias("line"), blank(above).cast("int").alias("gap")),
    )
    lines = F.filter(lines, lambda x, i: (i == 0) | ~blank(x["line"]))
    return (
        conversations.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text")
        .select("conv", F.coalesce("turn", F.lit((1 << 63) - 1)).alias("turn"), "role", "text", F.xxhash64("role", "text").alias("tie"))
        .select("conv", "turn", "role", "tie", parts.alias("parts"))
        .select("conv", "turn", "role", "tie", F.posexplode(lines).alias("at", "x"))
        .select("conv", "turn", "role", "tie", "at", "x.line", F.when(F.col("at") == 0, apart).otherwise(F.col("x.gap")).alias("gap"))
    )


def _features() -> dict[str, Column]:
    line = F.col("line")
    bare = F.btrim(line)
    marker = F.lit(0)
    for i, (_, pattern) in reversed(list(enumerate(MARKERS))):
        marker = F.when(line.rlike("(?i)^" + pattern), i + 1).otherwise(marker)
    n = F.length(bare)
    first = F.substring(bare, 1, 1)
    return {
        "marker": marker,
        "length": F.when(n == 0, 0).when(n < 80, 1).when(n < 300, 2).otherwise(3),
        "ending": F.when(bare.endswith("?"), 2).when(bare.endswith(".") | bare.endswith("!"), 1).otherwise(0),
        "opening": F.when(first.rlike(r"\p{Lu}"), 2).when(first.rlike(r"\p{Ll}"), 1).otherwise(0),
        "gap": F.col("gap"),
    }


class Model:
    """Log probabilities of starts, transitions and features."""

    def __init__(self, start: np.ndarray, step: np.ndarray, seen: dict[str, np.ndarray]) -> None:
        self.start = np.log(start / start.sum())
        self.step = np.log(step / step.sum(1, keepdims=True))
        self.seen = {k: np.log(v / v.sum(1, keepdims=True)) for k, v in seen.items()}

    def emissions(self, rows: pd.DataFrame) -> np.ndarray:
        """Lines by states."""
        return sum(self.seen[k][:, rows[k].to_numpy()].T for k in self.seen)

    def span(self, seen: np.ndarray) -> np.ndarray:
        """The best score from each state before these lines to each state at the last of them."""
        out = self.step + seen[0]
        for e in seen[1:]:
            out = (out[:, :, None] + self.step[None]).max(1) + e
        return out

    def decode(self, seen: np.ndarray, before: int, last: int) -> np.ndarray:
        """The best states, after state ``before`` (-1: at the start) and ending in ``last`` (-1: in any)."""
        score = (self.start if before < 0 else self.step[before]) + seen[0]
        back = np.zeros((len(seen), STATES), np.int8)
        for i in range(1, len(seen)):
            options = score[:, None] + self.step
            back[i] = options.argmax(0)
            score = options.max(0) + seen[i]
        path = np.zeros(len(seen), np.int8)
        path[-1] = int(score.argmax()) if last < 0 else last
        for i in range(len(seen) - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
        return path


def learn(lines: DataFrame) -> Model:
    """Counts of known states, with one added to each; lines as from ``transcripts``. Only sums reach the driver.

    A transition inside a turn, and one from a turn's last line to the next turn, are counted per turn, so no
    transcript is ever ordered as a whole: the next turn's role is looked up by turn number in a window over the turns of
    a slice, and across slices in one over their first and last turns. A transcript starts with its least turn, whatever
    its number; if that one's role is not known, its start is not learnt from.
    """
    role = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role")).cast("int") - 1
    known = lines.withColumn("r", role).where("r >= 0")
    state = F.when(F.col("at") == 0, F.col("r")).otherwise(F.col("r") + len(ROLES))
    features = _features()
    seen = {k: np.ones((STATES, n)) for k, n in FEATURES.items()}
    counts = known.select(state.alias("state"), *[f.alias(k) for k, f in features.items()])
    for row in counts.groupBy("state", *FEATURES).count().collect():  # at most a few thousand combinations
        for k in FEATURES:
            seen[k][row["state"], row[k]] += row["count"]
    start, step = np.ones(STATES), np.ones((STATES, STATES))
    turns = known.groupBy("conv", "turn", "tie", "r").agg(F.max("at").alias("last"))
    turns = turns.withColumn("slice", F.floor(F.col("turn") / SLICE_TURNS))
    order = Window.partitionBy("conv", "slice").orderBy("turn", "tie")
    pairs = turns.withColumn("next", F.lead("r").over(order)).groupBy("r", "next", F.least("last", F.lit(1)).alias("long"))
    for row in pairs.agg(F.count("*").alias("n"), F.sum("last").alias("inner")).collect():
        r, inside = row["r"], row["r"] + len(ROLES)
        if row["long"]:
            step[r, inside] += row["n"]
            step[inside, inside] += row["inner"] - row["n"]
        if row["next"] is not None:
            step[inside if row["long"] else r, row["next"]] += row["n"]
    place = F.struct("turn", "tie")
    ends = turns.groupBy("conv", "slice").agg(
        F.min_by("r", place).alias("head"), F.max_by(F.struct("r", F.least("last", F.lit(1)).alias("long")), place).alias("tail")
    )
    ends = ends.withColumn("next", F.lead("head").over(Window.partitionBy("conv").orderBy("slice"))).where("next IS NOT NULL")
    for row in ends.groupBy("tail.r", "tail.long", "next").count().collect():
        step[row["r"] + len(ROLES) if row["long"] else row["r"], row["next"]] += row["count"]
    first = lines.groupBy("conv").agg(F.min_by(role, place).alias("r")).where("r >= 0")
    for row in first.groupBy("r").count().collect():
        start[row["r"]] += row["count"]
    return Model(start, step, seen)


def _slices(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal keys, from rows sorted by them."""
    held = None
    for rows in batches:
        if rows.empty:
            continue
        if held is not None:
            rows = pd.concat([held, rows], ignore_index=True)
        same = (rows[keys] == rows[keys].shift()).all(axis=1).to_numpy()
        starts = np.append(np.flatnonzero(~same), len(rows))
        for a, b in zip(starts[:-2], starts[1:-1], strict=True):
            yield rows.iloc[a:b]
        held = rows.iloc[starts[-2] :]
    if held is not None:
        yield held


def find_roles(lines: DataFrame, model: Model, *, slice_turns: int = SLICE_TURNS) -> DataFrame:
    """The lines with the state found for each; their roles are not looked at."""
    keys = ["conv", "slice"]
    seen = lines.select(
        "conv", F.floor(F.col("turn") / slice_turns).alias("slice"), "turn", "tie", "at", "line", *[f.alias(k) for k, f in _features().items()]
    )

    def cut(df: DataFrame) -> DataFrame:
        return df.repartition(spread(df), *keys).sortWithinPartitions(*keys, "turn", "tie", "at", "line")

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for rows in _slices(batches, keys):
            matrix = model.span(model.emissions(rows))
            out.append((rows["conv"].iat[0], rows["slice"].iat[0], matrix.ravel().tolist()))
            if len(out) == 5_000:
                yield pd.DataFrame(out, columns=["conv", "slice", "matrix"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["conv", "slice", "matrix"])

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        """The states at the ends of a transcript's slices: one row and one small matrix for each."""
        rows = rows.sort_values("slice")
        forward, back = [], []
        for i, flat in enumerate(rows["matrix"]):
            m = np.array(flat).reshape(STATES, STATES)
            if i:
                options = forward[-1][:, None] + m
                back.append(options.argmax(0))
                forward.append(options.max(0))
            else:  # what comes before the first line is the start, not a state
                forward.append(np.array(rows["head"].iat[0]))
        ends = [int(forward[-1].argmax())]
        for step in reversed(back):
            ends.append(int(step[ends[-1]]))
        ends.reverse()
        return pd.DataFrame({"conv": rows["conv"], "slice": rows["slice"], "before": [-1, *ends[:-1]], "last": ends})

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _slices(batches, keys):
            e = model.emissions(rows)
            score = model.start + e[0]
            for x in e[1:]:
                score = (score[:, None] + model.step).max(0) + x
            yield pd.DataFrame({"conv": rows["conv"].iloc[:1], "head": [score.tolist()]})

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _slices(batches, keys):
            found = model.decode(model.emissions(rows), int(rows["before"].iat[0]), int(rows["last"].iat[0]))
            yield rows[["conv", "turn", "tie", "at", "line", "gap"]].assign(state=found.astype(np.int32))

    many = seen.groupBy("conv").agg(F.min("slice").alias("first"), F.max("slice").alias("final")).where("first <> final")
    long = seen.join(many, "conv")
    matrices = cut(long.drop("first", "final")).mapInPandas(spans, "conv string, slice long, matrix array<double>")
    firsts = cut(long.where("slice = first").drop("first", "final")).mapInPandas(heads, "conv string, head array<double>")
    edges = matrices.join(firsts, "conv").groupBy("conv").applyInPandas(chain, "conv string, slice long, before int, last int")
    whole = seen.join(edges, keys, "left").fillna(-1, ["before", "last"])
    return cut(whole).mapInPandas(decode, "conv string, turn long, tie long, at int, line string, gap int, state int")


def canonical_turns(found: DataFrame) -> DataFrame:
    """conv_id, turn (from 0), role, text without its marker, and the rendered turn, from the states of the lines.

    A turn begins at a line in a beginning state, or where the role changes. Turns are numbered by running counts:
    first inside slices, then over slices.
    """
    role = F.col("state") % len(ROLES)
    order = ["turn", "tie", "at", "line"]
    inside = Window.partitionBy("conv", "slice").orderBy(*order)
    rows = found.withColumn("slice", F.floor(F.col("turn") / SLICE_TURNS)).withColumn("r", role)
    rows = rows.withColumn("before", F.lag("r").over(inside))
    begins = (F.col("state") < len(ROLES)) | (F.col("before") != F.col("r"))
    rows = rows.withColumn("begins", F.when(begins, 1).otherwise(0))
    rows = rows.withColumn("own", F.sum("begins").over(inside))
    ends = rows.groupBy("conv", "slice").agg(
        F.max("own").alias("n"), F.min_by("r", F.struct(*order)).alias("head"), F.min_by("begins", F.struct(*order)).alias("opens"), F.max_by("r", F.struct(*order)).alias("tail")
    )
    over = Window.partitionBy("conv").orderBy("slice")
    # A slice whose first line neither begins a turn nor keeps the role of the last slice begins one all the same.
    joins = F.coalesce((F.lag("tail").over(over) == F.col("head")) & (F.col("opens") == 0), F.lit(False))
    ends = ends.withColumn("extra", F.when(joins | (F.col("opens") == 1), 0).otherwise(1))
    ends = ends.withColumn("offset", F.sum(F.col("n") + F.col("extra")).over(over) - F.col("n") - 1)
    turns = rows.join(ends.select("conv", "slice", "offset"), ["conv", "slice"]).withColumn("turn_no", (F.col("own") + F.col("offset")).cast("long"))
    any_marker = "(?i)^(?:" + "|".join(p for _, p in MARKERS) + r")[ \t]*"
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "gap"))), lambda x, i: F.concat(F.when((i > 0) & (x["gap"] == 1), "\n").otherwise(""), x["line"])), "\n")
    names = F.array(*[F.lit(r) for r in ROLES])
    out = turns.groupBy("conv", "turn_no").agg(F.min("r").alias("r"), text.alias("text"), F.count("*").alias("n_lines"))
    name, body = F.get(names, F.col("r")), F.btrim(F.regexp_replace("text", any_marker, ""))
    return out.select(
        F.col("conv").alias("conv_id"),
        F.col("turn_no").alias("turn"),
        name.alias("role"),
        body.alias("text"),
        "n_lines",
        F.concat(F.lit("<|"), name, F.lit("|>\n"), body, F.lit("\n<|end|>")).alias("rendered"),
    )


def held_out() -> Column:
    """Whether a transcript is kept from learning: a fifth of them, by the crc32 of ``conv``."""
    return F.crc32(F.col("conv").cast("binary")) % 5 == 0


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, by a model learnt from those that are not held out."""
    lines = saved(transcripts(table(spark, sf_dir, "conversations")), "transcripts")
    # Read twice, for the turns and for their numbers: decoded once.
    return canonical_turns(saved(find_roles(lines, learn(lines.where(~held_out()))), "states"))
