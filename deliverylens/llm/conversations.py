"""Repair of conversations: the cheapest edits that make roles take turns.

What a conversation costs to repair depends only on its rows' roles and faults. These
make a signature, one letter a row, written last row first. Signatures are sorted and
put into a prefix trie, of which only the path to the current one is held: for each
letter that a signature does not share with the one before it, one layer of the
dynamic programme is worked out from the layer above (the cheapest cost of the rest
of the conversation from each of four states), and the terminal node gives the answer:
walking back up its path reads the conversation forward, and takes the ASCII-least
edit that the layers allow. Since signatures are written backwards, what is shared
are endings.

No conversation is held whole. Rows are ranged and sorted by conversation and turn,
cut into blocks of at most ``BLOCK`` rows, and blocks are the trie's strings. A block
needs to know how the rest of its conversation prices its end: those four numbers
stand before its signature as the first letter of its way in the trie. A conversation
of one block has the same four at once; for longer ones each block is first priced
for each of the four ends, these small tables are chained (16 numbers for ``BLOCK``
rows) to give each block its own four numbers, and the states in which ways leave the
blocks are chained likewise.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import scratch, workers_import_this

BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
ROLES = "sua"
#: States: nothing yet, after system, after user, after assistant; and the turn that may follow.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
FAR = 1 << 50
#: What is left to pay at the end of a conversation, by state: empty, or it must end with an assistant.
END = (0, 2 * INSERT, INSERT, 0)
_SPACE = " \t\n\x0b\x0c\r"


class Repair(NamedTuple):
    """``summary``: a row a conversation; ``turns``: a row a turn of the repaired conversations."""

    summary: DataFrame
    turns: DataFrame


# the dynamic programme


def _keeps(role: int, state: int) -> int | None:
    """The state after a row of this role is kept in a state, None if it can't be."""
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def _edits(letter: str, rest: tuple, state: int) -> dict[str, tuple[int, int]]:
    """Cost with what is left to pay, and state after it, of each edit of a row."""
    role, fault = divmod(ord(letter) - 65, 4)
    out = {"D": (DELETE + rest[state], state)}
    if fault in (BLANK, DUPLICATE):
        return out
    extra = CUT if fault == TRUNCATED else 0
    kept = _keeps(role, state)
    if kept is not None:
        out["K"] = (extra + rest[kept], kept)
    to = NEXT[state]
    out["R"] = (REROLE + extra + rest[to], to)
    return out


class Layers:
    """Layers and decisions of the programme, each worked out once in a worker: a layer
    is the least of its numbers and the four less that least, so few are different."""

    def __init__(self):
        self.above: dict[tuple, tuple] = {}
        self.ways: dict[tuple, tuple] = {}

    @staticmethod
    def level(costs) -> tuple[int, tuple]:
        low = min(costs)
        return low, tuple(c - low if c < FAR // 2 else FAR for c in costs)

    def step(self, rest: tuple, letter: str) -> tuple[int, tuple]:
        """The layer before a row, inserts in front of it included."""
        found = self.above.get((rest, letter))
        if found is None:
            row = [min(c for c, _ in _edits(letter, rest, q).values()) for q in range(4)]
            found = self.level([min(row[q], INSERT + row[NEXT[q]], 2 * INSERT + row[NEXT[NEXT[q]]]) for q in range(4)])
            self.above[(rest, letter)] = found
        return found

    def way(self, rest: tuple, letter: str, state: int) -> tuple[str, str, int, int]:
        """(edits, roles they give, state after, cost) of the ASCII-least cheapest way over a row."""
        found = self.ways.get((rest, letter, state))
        if found is None:
            audit, roles, q = "", "", state
            low, level = self.step(rest, letter)
            left = low + level[q]
            while True:
                row = _edits(letter, rest, q)
                fits = [e for e, (c, _) in row.items() if c == left]
                to = NEXT[q]
                if left - INSERT == low + level[to] and "D" not in fits:
                    audit, roles, q, left = audit + "I", roles + ROLES[to - 1], to, left - INSERT
                    continue
                edit = min(fits)
                after = row[edit][1]
                found = audit + edit, roles + ("-" if edit == "D" else ROLES[after - 1]), after, low + level[state] - rest[after]
                break
            self.ways[(rest, letter, state)] = found
        return found


def _shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


_OUT = pa.schema([
    ("number", pa.int64()), ("costs", pa.list_(pa.int64())), ("illegal", pa.int64()), ("cost", pa.int64()), ("after", pa.int32()),
    ("audit", pa.string()), ("at", pa.list_(pa.int32())), ("gives", pa.list_(pa.string())),
])
_OUT_SPARK = "number long, costs array<long>, illegal long, cost long, after int, audit string, at array<int>, gives array<string>"


def _legal(first: str, second: str) -> bool:
    """Whether the roles of two neighbouring letters may follow one another."""
    a, b = (ord(first) - 65) // 4, (ord(second) - 65) // 4
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _answers(batches):
    """A row for each (number, root, signature, state, closes, quiet), sorted by root and signature.

    ``costs`` from each state and the count of illegal neighbours; with a state also
    the edits' cost, the state after and, unless quiet, the edits: their letters, the
    row each stands at or before, the role it gives. ``closes``: the conversation ends here.
    """
    layers = Layers()
    root, last, path = None, "", []
    for batch in batches:
        rows: dict[str, list] = {n: [] for n in _OUT.names}
        for number, to, signature, state, closes, quiet in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if to != root:
                root, last = to, ""
                path = [(*layers.level([int(c) for c in to.split(",")]), 0)]
            keep = _shared(last, signature)
            del path[keep + 1 :]
            for k in range(keep, len(signature)):
                paid, rest, bad = path[-1]
                low, rest = layers.step(rest, signature[k])
                path.append((paid + low, rest, bad + (k > 0 and not _legal(signature[k], signature[k - 1]))))
            last = signature
            paid, rest, bad = path[-1]
            audits, at, gives, q, cost = [], [], [], state, 0
            if state is not None:
                n = len(signature)
                for k in range(n):
                    audit, roles, q, c = layers.way(path[n - k - 1][1], signature[n - 1 - k], q)
                    cost += c
                    if not quiet:
                        audits.append(audit)
                        at += [k] * len(audit)
                        gives.append(roles)
                while closes and q not in (START, ASSISTANT):
                    q, cost = NEXT[q], cost + INSERT
                    audits.append("I")
                    at.append(n)
                    gives.append(ROLES[q - 1])
            for name, value in zip(_OUT.names, (number, [min(paid + c, FAR) for c in rest], bad, cost, q, "".join(audits), at, list("".join(gives)))):
                rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows, schema=_OUT)


def _priced(rows: DataFrame) -> DataFrame:
    """Answers, ranged so that a task has one stretch of the trie."""
    ranged = rows.select("number", "root", "signature", "state", "closes", "quiet").repartitionByRange("root", "signature", "number")
    return ranged.sortWithinPartitions("root", "signature").mapInArrow(_answers, _OUT_SPARK)


def _rests(pdf):
    """From the tables of a conversation's blocks (number, e, costs): how the rest prices each block's end."""
    import pandas as pd

    tables: dict[int, list] = {}
    for number, e, costs in zip(pdf["number"], pdf["e"], pdf["costs"]):
        tables.setdefault(number, [None] * 4)[e] = [int(c) for c in costs]
    rest, rows = END, []
    for number in sorted(tables, reverse=True):
        rows.append((number, ",".join(map(str, rest)), not rows))
        table = tables[number]
        rest = Layers.level([min(table[e][q] + rest[e] for e in range(4)) for q in range(4)])[1]
    return pd.DataFrame(rows, columns=["number", "root", "closes"])


def _states(pdf):
    """From the states in which each block is left (number, q, after): the state it is met in."""
    import pandas as pd

    after = {(n, q): a for n, q, a in zip(pdf["number"], pdf["q"], pdf["after"])}
    state, rows = START, []
    for number in sorted(set(pdf["number"])):
        rows.append((number, state))
        state = after[(number, state)]
    return pd.DataFrame(rows, columns=["number", "state"])


# the rows


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    out = scratch(spark, name)
    df.write.parquet(out)
    return spark.read.parquet(out)


def _placed(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """A short row for each turn, numbered in the order of conversations, turns and ties."""
    said = F.coalesce(F.col(text), F.lit(" "))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), said.alias("text"))
    bare = F.rtrim(F.col("text"), F.lit(_SPACE))
    rows = rows.select(
        "conv", "turn", "role", _content("role", "text").alias("h"), F.substring("text", 1, 64).alias("head"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "head", "h")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return _written(rows.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "h", "blank", "cut", F.monotonically_increasing_id().alias("pos")), "turns")


def _content(role: str, text: str) -> Column:
    """A 128-bit name of what a row says and who says it."""
    return F.unhex(F.md5(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), F.col(role), F.col(text)), "UTF-8")))


def _blocks(placed: DataFrame) -> DataFrame:
    """(conv, number, signature, first, last, counts): at most BLOCK rows of a conversation each.

    ``number`` is the place of its first row. A row is a duplicate if it isn't the first of its content in
    its conversation; firsts are found by a minimum for each content and met again by place, which no two rows share.
    """
    firsts = placed.where("!blank").groupBy("conv", "h").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("fresh"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("fresh").isNull(), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(0)
    known = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    rows = placed.join(firsts, "pos", "left").select("conv", "pos", "turn", fault.alias("fault"), F.char((65 + 4 * known + fault).cast("long")).alias("letter"))
    groups = rows.groupBy("conv", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "letter"))).alias("rows"),
        *[F.count_if(F.col("fault") == k).alias(n) for n, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))],
    )
    letters = F.transform("rows", lambda r: r["letter"])
    return groups.select(
        "conv", F.col("rows")[0]["pos"].alias("number"), F.array_join(F.reverse(letters), "").alias("signature"),
        F.element_at(letters, 1).alias("first"), F.element_at(letters, -1).alias("last"), "blank", "duplicate", "truncated",
    )


def _tasks(blocks: DataFrame) -> DataFrame:
    """What the last walk over the trie is asked for each block: its root and the state it is met in."""
    spark = blocks.sparkSession
    per = blocks.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("conv", "c")
    long = F.col("conv").eqNullSafe(F.col("c"))
    end = F.lit(",".join(map(str, END)))
    one = blocks.join(per, long, "left_anti").select("number", "signature", end.alias("root"), F.lit(START).alias("state"), F.lit(True).alias("closes"))
    many = _written(blocks.join(per, long, "left_semi").select("conv", "number", "signature"), "long")
    ends = [",".join("0" if e == k else str(FAR) for k in range(4)) for e in range(4)]
    asked = many.select("conv", F.col("number").alias("block"), "signature", F.explode(F.array(*[F.struct(F.lit(e).alias("e"), F.lit(r).alias("root")) for e, r in enumerate(ends)])).alias("x"))
    asked = asked.select("conv", "block", F.col("x.e").alias("e"), (F.col("block") * 4 + F.col("x.e")).alias("number"), F.col("x.root").alias("root"), "signature", F.lit(None).cast("int").alias("state"), F.lit(False).alias("closes"), F.lit(True).alias("quiet"))
    priced = _priced(asked).select("number", "costs").join(asked.select("conv", "block", "e", "number"), "number")
    rests = priced.select("conv", F.col("block").alias("number"), "e", "costs").groupBy("conv").applyInPandas(_rests, "number long, root string, closes boolean")
    rests = _written(rests.join(many, "number"), "rests")
    asked = rests.withColumn("q", F.explode(F.array(*map(F.lit, range(4))))).withColumn("block", F.col("number")).withColumn("number", F.col("number") * 4 + F.col("q"))
    left = _priced(asked.withColumn("state", F.col("q")).withColumn("quiet", F.lit(True))).select("number", "after").join(asked.select("conv", "block", "q", "number"), "number")
    states = left.select("conv", F.col("block").alias("number"), "q", "after").groupBy("conv").applyInPandas(_states, "number long, state int")
    return one.unionByName(rests.join(states, "number").select("number", "signature", "root", "state", "closes")).withColumn("quiet", F.lit(False))


def _null_safe(a: DataFrame, b: DataFrame, name: str, how: str = "left") -> DataFrame:
    """a joined with b on one column of both, in which null equals null."""
    b = b.withColumnRenamed(name, "__other")
    return a.join(b, a[name].eqNullSafe(F.col("__other")), how).drop("__other")


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest edits of each conversation and what it says after them.

    ``summary``: conv, gaps (turn numbers missing between the least and the greatest),
    blank, duplicate, truncated (each row's first fault), illegal (neighbours whose roles
    may not follow one another), cost, audit (edits in order: Keep, Rerole, Delete,
    Insert; of equally cheap ones the ASCII-least). ``turns``: conv, number, k (they
    order a conversation), edit, role, text of every turn that is kept, reroled or inserted.

    A null role or text is one space. Null turns come first and are in no gap. Rows of
    one turn are ordered by role, then by the first 64 characters of their text, then
    by a hash of it; rows that are equal in all are copies, of which the first is kept.
    A null conversation id is a conversation of its own. Other columns are neither read
    nor returned, whatever their names. A text passes one shuffle.
    """
    workers_import_this(turns.sparkSession)
    placed = _placed(turns, conv, turn, role, text)
    blocks = _written(_blocks(placed), "blocks")
    answers = _written(_priced(_tasks(blocks)).drop("costs", "after"), "answers")
    mine = answers.join(blocks.drop("signature"), "number")
    # neighbours on two sides of a border between blocks: first and last letters alone, BLOCK rows each
    summary = mine.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_sort(F.collect_list(F.struct("number", "first", "last"))).alias("edges"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    legal = [chr(65 + 4 * a + x) + chr(65 + 4 * b + y) for a, b in ((0, 1), (1, 2), (2, 1)) for x in range(4) for y in range(4)]
    borders = F.filter(
        F.sequence(F.lit(1), F.size("edges")),
        lambda k: (k < F.size("edges")) & ~F.concat(F.element_at("edges", k)["last"], F.element_at("edges", F.least(k + 1, F.size("edges")))["first"]).isin(legal),
    )
    summary = summary.withColumn("illegal", F.col("illegal") + F.size(borders)).drop("edges")
    gaps = placed.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(F.coalesce(F.max("turn").cast("long") - F.min("turn").cast("long") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    summary = _null_safe(summary, gaps, "conv").select(F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = mine.select("conv", "number", F.posexplode(F.arrays_zip("at", "gives", F.split("audit", "").alias("edit"))).alias("k", "x"))
    edits = edits.select("conv", "number", "k", F.col("x.edit").alias("edit"), F.col("x.gives").alias("gives"), (F.col("number") + F.col("x.at")).alias("pos")).where("edit != 'D'")
    given = F.when(F.col("gives") == "u", "user").otherwise("assistant")
    new = edits.where("edit = 'I'").select("conv", "number", "k", "edit", given.alias("role"), F.lit("").alias("text"))
    # a row that stays is the first of its content, so its content names it
    kept = edits.where("edit != 'I'").join(placed.select("pos", "h", F.xxhash64("conv").alias("c")), "pos").drop("pos")
    texts = turns.select(F.xxhash64(F.col(conv)).alias("c"), F.coalesce(F.col(role), F.lit(" ")).alias("was"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    texts = texts.withColumn("h", _content("was", "text")).groupBy("c", "h").agg(F.first("was").alias("was"), F.first("text").alias("text"))
    kept = kept.join(texts, ["c", "h"]).select("conv", "number", "k", "edit", F.when(F.col("edit") == "K", F.col("was")).otherwise(given).alias("role"), "text")
    return Repair(summary, kept.unionByName(new).withColumnRenamed("conv", conv))


def damage(turns: DataFrame) -> DataFrame:
    """The damage of the query's contract: conversations' rows by crc32 of ``conv_id:turn`` modulo 20 (a null in any column is one space)."""
    blank = F.lit(" ")
    draw = F.crc32(F.encode(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]), "UTF-8")) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), draw.alias("draw")).where("draw != 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def digests(turns: DataFrame, conv: str) -> DataFrame:
    """(conv, sha256) of each conversation's ``role:text`` lines. A hash can't be split, so
    the turns of a conversation pass one task, as a stream of which one batch is held."""

    def run(batches):
        import hashlib

        at, h, first = None, None, True
        done: list[tuple] = []
        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if first or c != at:
                    if not first:
                        done.append((at, h.hexdigest()))
                    at, h, first = c, hashlib.sha256(), False
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field(0).type), pa.array([d[1] for d in done])], names=["conv", "sha256"])
                done = []
        if not first:
            yield pa.RecordBatch.from_arrays([pa.array([at], batch.schema.field(0).type), pa.array([h.hexdigest()])], names=["conv", "sha256"])

    rows = turns.select(F.col(conv).alias("conv"), "role", "text", "number", "k").repartition("conv").sortWithinPartitions("conv", "number", "k")
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), T.StructField("sha256", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def op11(turns: DataFrame) -> DataFrame:
    """Damaged conversations and their repair, a row for every conversation there was."""
    found = repair(damage(turns))
    hashes = digests(found.turns, "conv_id")
    out = _null_safe(_null_safe(turns.select("conv_id").distinct(), found.summary, "conv_id"), hashes, "conv_id")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.encode(F.lit(""), "UTF-8"), 256)).alias("repaired_sha256"))
