"""Chat formatting: a hidden Markov model over speaker-marker and line features recovers roles by Viterbi before turns are rendered.

A row may hold a transcript of several turns: its text is cut at lines that begin with a speaker marker, such as `User:` or `### Assistant:`, unless they are indented
by four spaces or more; names that also head other lines (`Question:`, `A:`) count within a text only if the text itself begins with one of these. States are system, user and assistant.
What is seen of a turn is the row's role (of its first turn only), the marker it begins with, whether it ends with a question mark, and its length; all are evidence, none decides by itself. Parameters are fixed,
so decoding is the same for all tables. All turns are sorted in parallel, by ranges that may cut a conversation anywhere, and each partition is dealt out in chunks of CHUNK rows.
A conversation of any length is decoded exactly: the best scores between the first and last state of its part of a chunk are a small matrix; the
matrices of a conversation give the states at the borders; then each part is decoded between its borders, by itself.

Rendering: a leading marker is cut off the text, white space is trimmed, and special marks in it are broken up, so that a text can't pose as a turn.

Defined results: one row per turn, told by conv_id, turn and part (its place in its row); a row without conv_id is a conversation of its own; rows go by turn number, null first, then by a hash
of role and text, so repeated rows stand side by side, however many there are; a null text is one empty turn; a role that isn't known counts as none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.llm.clusterio import cut, table

ROLES = ("system", "user", "assistant")
CHUNK = 1024
# Names of speakers by role.
MARKERS = {"system": "system|developer|instructions?", "user": "user|human|customer|client|question|q|prompter|me", "assistant": "assistant|ai|bot|chatbot|agent|model|answer|a|gpt"}
_LEAD = r"(?i)^\s*(?:<\|(?:im_start\|>)?|\[|#{1,6}\s*|\*\*)?\s*(%s)\s*(?:\|>|\]|\*\*)?\s*(?::\**|\n|(?<=\|>)|(?<=\]))\s*"
_NAMES = {"narrow": "system|developer|user|human|prompter|assistant|ai|bot|chatbot", "wide": "|".join(MARKERS.values())}
_TURN = r"(?i)\n(?=[ ]{0,3}(?:(?:<\|(?:im_start\|>)?|\[|#{1,6}|\*\*)[ \t]*)?(?:%s)[ \t]*(?:\|>|\]|\*\*)?[ \t]*(?::|(?<=\|>)|(?<=\])))"
#: Names that begin transcripts of questions and answers, in which these are markers.
_DIALOGUE = ("question", "q", "answer", "a")
#: Log-probabilities: of the first state; of the next state; of a marker, or of a given role (none, system, user, assistant); of a closing question mark (no, yes); of a length (short, middle, long).
START = np.log([0.12, 0.8, 0.08])
NEXT = np.log([[0.05, 0.85, 0.10], [0.01, 0.09, 0.90], [0.01, 0.89, 0.10]])
MARK = np.log([[0.08, 0.88, 0.02, 0.02], [0.08, 0.02, 0.86, 0.04], [0.08, 0.02, 0.04, 0.86]])
ROLE = np.log([[0.04, 0.93, 0.015, 0.015], [0.04, 0.015, 0.93, 0.015], [0.04, 0.015, 0.015, 0.93]])
ASKS = np.log([[0.97, 0.03], [0.60, 0.40], [0.92, 0.08]])
LENGTH = np.log([[0.30, 0.55, 0.15], [0.45, 0.45, 0.10], [0.15, 0.40, 0.45]])


def _known(name: Column, pattern: str) -> Column:
    return F.coalesce(F.lower(F.trim(name)).rlike(f"^(?:{pattern})$"), F.lit(False))


def _number(name: Column) -> Column:
    """A role's number, by a speaker's name; 0 if it is none's."""
    out = F.lit(0)
    for k, role in reversed(list(enumerate(ROLES, 1))):
        out = F.when(_known(name, MARKERS[role]), k).otherwise(out)
    return out


def _lead(text: Column) -> Column:
    return F.lower(F.regexp_extract(text, _LEAD % _NAMES["wide"], 1))


def features(turns: DataFrame) -> DataFrame:
    """(conv_id, own, turn, part, text, mark, seen, place): the turns of each row. mark is the role that is given, by column or marker; seen the number of the combination of
    features; own tells rows without conv_id apart; place is the row's in the order of rows alike in all else."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text", F.lit("alone")))
    rows = turns.select("conv_id", own.alias("own"), "turn", F.col("role").cast("string").alias("role"), text.alias("text"), F.struct(F.xxhash64("role", "text").alias("hash"), F.monotonically_increasing_id().alias("id")).alias("place"))
    split = F.when(_lead(F.col("text")).isin(*_DIALOGUE), F.split("text", _TURN % _NAMES["wide"])).otherwise(F.split("text", _TURN % _NAMES["narrow"]))
    df = rows.select("conv_id", "own", "turn", "role", "place", F.posexplode(split).alias("part", "text"))
    given, said = F.when(F.col("part") == 0, _number(F.col("role"))).otherwise(0), _number(_lead(F.col("text")))
    asks = F.col("text").rlike(r"\?\s*$").cast("int")
    size = F.when(F.length("text") < 80, 0).when(F.length("text") < 400, 1).otherwise(2)
    df = df.withColumns({"given": given, "said": said, "asks": asks, "size": size})
    seen = (((F.col("given") * 4 + F.col("said")) * 2 + F.col("asks")) * 3 + F.col("size")).cast("int")
    mark = F.when(F.col("given") > 0, F.col("given")).otherwise(F.col("said")).cast("int")
    return df.select("conv_id", "own", "turn", "part", "text", mark.alias("mark"), seen.alias("seen"), "place")


def emissions(seen: np.ndarray) -> np.ndarray:
    """Log-probabilities of what is seen, by state."""
    return ROLE[:, seen // 24].T + MARK[:, seen // 6 % 4].T + ASKS[:, seen // 3 % 2].T + LENGTH[:, seen % 3].T


def matrix(seen: np.ndarray) -> np.ndarray:
    """Best scores of a chunk's turns from each first state to each last."""
    out = np.full((3, 3), -np.inf)
    e = emissions(seen)
    np.fill_diagonal(out, e[0])
    for row in e[1:]:
        out = (out[:, :, None] + NEXT[None]).max(axis=1) + row
    return out


def borders(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """The first and last state of each chunk on the best path through a conversation."""
    best, back = START, []
    for k, m in enumerate(matrices):
        into = best if not k else (best[:, None] + NEXT).max(axis=0)
        path = into[:, None] + m
        back.append((None if not k else (best[:, None] + NEXT).argmax(axis=0), path.argmax(axis=0)))
        best = path.max(axis=0)
    last, out = int(best.argmax()), []
    for before, first in reversed(back):
        out.append((int(first[last]), last))
        last = int(before[first[last]]) if before is not None else 0
    return out[::-1]


def decode(seen: np.ndarray, first: int, last: int) -> np.ndarray:
    """The best states of a chunk's turns between given ones."""
    e = emissions(seen)
    best = np.full(3, -np.inf)
    best[first] = e[0, first]
    back = np.zeros((len(seen), 3), np.int8)
    for k in range(1, len(seen)):
        scores = best[:, None] + NEXT
        back[k] = scores.argmax(axis=0)
        best = scores.max(axis=0) + e[k]
    out = np.zeros(len(seen), np.int64)
    out[-1] = last
    for k in range(len(seen) - 1, 0, -1):
        out[k - 1] = back[k, out[k]]
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in range(keys)), strict=True))
        at = 0
        while at < len(names):
            to = at
            while to < len(names) and names[to] == names[at]:
                to += 1
            if names[at] != current:
                if held:
                    yield pa.Table.from_batches(held)
                held, current = [], names[at]
            held.append(batch.slice(at, to - at))
            at = to
    if held:
        yield pa.Table.from_batches(held)


def sorted_turns(turns: DataFrame) -> DataFrame:
    """features() with range and row, the place in the order of conversations and turns, and chunk. It is checkpointed, as its ranges are drawn by samples."""
    # rows alike in all else are told by where they were read, so that ranges can cut between them
    order = ["conv_id", "own", "turn", "place", "part"]
    place = F.monotonically_increasing_id()
    df = features(turns).orderBy(*order).drop("place").withColumns({"range": F.shiftright(place, 33).cast("int"), "row": place.bitwiseAND((1 << 33) - 1)})
    return cut(df.withColumn("chunk", F.floor(F.col("row") / CHUNK).cast("long")))


def roles(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, part, role, mark, text): each turn with its recovered role."""
    rows = sorted_turns(turns)
    keys = ["conv_id", "own", "range", "chunk"]

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 4):
            m = matrix(group.column("seen").to_numpy())
            yield pa.RecordBatch.from_arrays([*(group.column(k).combine_chunks()[:1] for k in keys), pa.array([m.ravel().tolist()], pa.list_(pa.float64()))], names=[*keys, "m"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 2):
            found = borders([np.array(m).reshape(3, 3) for m in group.column("m").to_pylist()])
            yield pa.RecordBatch.from_arrays([*(group.column(k).combine_chunks() for k in keys), pa.array([a for a, _ in found], pa.int32()), pa.array([b for _, b in found], pa.int32())], names=[*keys, "first", "last"])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 4):
            states = decode(group.column("seen").to_numpy(), group.column("first")[0].as_py(), group.column("last")[0].as_py())
            yield pa.RecordBatch.from_arrays([*(group.column(k).combine_chunks() for k in ("conv_id", "turn", "part")), pa.array([ROLES[s] for s in states]), group.column("mark").combine_chunks(), group.column("text").combine_chunks()], names=["conv_id", "turn", "part", "role", "mark", "text"])

    kind = "conv_id long, own long, range int, chunk long"
    scored = rows.select(*keys, "seen").mapInArrow(matrices, f"{kind}, m array<double>")
    found = scored.repartition("conv_id", "own").sortWithinPartitions(*keys).mapInArrow(ends, f"{kind}, first int, last int")
    found = found.select(*(F.col(k).alias(f"_{k}") for k in keys), "first", "last")
    same = (F.col("range") == F.col("_range")) & (F.col("chunk") == F.col("_chunk")) & F.col("conv_id").eqNullSafe(F.col("_conv_id")) & F.col("own").eqNullSafe(F.col("_own"))
    placed = rows.join(found, same).select(*keys, "row", "turn", "part", "mark", "text", "seen", "first", "last")
    # the join has brought the rows of a part of a chunk together
    return placed.repartition("range", "chunk").sortWithinPartitions("range", "row").mapInArrow(decoded, "conv_id long, turn long, part int, role string, mark int, text string")


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, part, role, recovered, rendered): each turn in canonical form; recovered: neither column nor marker gave its role."""
    df = roles(turns)
    body = F.trim(F.regexp_replace("text", _LEAD % "|".join(MARKERS.values()), ""))
    body = F.regexp_replace(body, r"<\|", "<​|")
    rendered = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), body, F.lit("<|im_end|>\n"))
    marked = F.element_at(F.array(*(F.lit(r) for r in ("", *ROLES))), F.col("mark") + 1)
    return df.select("conv_id", "turn", "part", "role", (marked != F.col("role")).alias("recovered"), rendered.alias("rendered"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations"))
