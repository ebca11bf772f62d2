"""Operator 13: conversation structure repair by dynamic programming over a grammar.

A row of a conversation is one of nine symbols: the initial of its role (s, u, a or another) with a whole or a truncated
text, or a row that must go (blank or duplicate).  Edits move a small automaton for the role initials ``(s?(ua)+)?``, so a
symbol is a min-plus matrix over its four states: the least cost from state to state and the audit, the edits' initials, that costs it.

The symbol sequences of all conversations are compressed together by Re-Pair: the most frequent neighbours become a new
symbol, in rounds.  A rule's matrix is the product of the matrices of its two sides, evaluated bottom-up and
once for all conversations; its audits are ropes over those of the sides.  A conversation is then a short row of rules.

Equal costs are settled by the audit that is least in ASCII.  Of two audits of the same rows between the same states and
of equal cost neither begins with the other (what is longer has two more inserts, which cost more), so least audits of the
parts make the least audit of the whole, and minima can be taken part by part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import SPACE_CHARS, Workspace

#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after the system row, after a user row, after an assistant row.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (BEGIN, ASSISTANT)
MUST_GO = "-"
#: Symbols of one segment of a conversation at most.
SEGMENT = 512
#: Rules of the grammar at most, and rounds in which they are made, the pairs looked at in a round.
RULES, ROUNDS, LOOKED_AT = 256, 8, 200
FIRST_RULE = 0x4E00


# Matrices


class Rope:
    """A text made of two ropes, or of a string; it is put together when it is asked for, once."""

    __slots__ = ("left", "right", "_text")

    def __init__(self, left: Rope | None, right: Rope | None, text: str | None = None):
        self.left, self.right, self._text = left, right, text

    @property
    def text(self) -> str:
        if self._text is None:
            parts, open_ = [], [self]
            while open_:
                rope = open_.pop()
                if rope._text is not None:
                    parts.append(rope._text)
                else:
                    open_ += (rope.right, rope.left)
            self._text, self.left, self.right = "".join(parts), None, None
        return self._text

    def __reduce__(self):
        return Rope, (None, None, self.text)


Entry = tuple[int, Rope]
Matrix = dict[tuple[int, int], Entry]
Vector = dict[int, Entry]


def better(new: Entry, old: Entry | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and new[1].text < old[1].text)


def inserted(state: int) -> int:
    """The state behind an inserted row, or one with a new role: what may come next is settled."""
    return ASSISTANT if state == USER else USER


def inserts(state: int) -> Iterator[tuple[int, int, str]]:
    """(state, cost, audit) of no, one and two inserts; a third only leads back."""
    cost, audit = 0, ""
    for _ in range(3):
        yield state, cost, audit
        state, cost, audit = inserted(state), cost + INSERT, audit + "I"


def kept(initial: str, state: int) -> int | None:
    """The state behind a row that stays as it is, or None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == BEGIN else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def symbol_matrix(symbol: str) -> Matrix:
    """Inserts before the row, then its edit."""
    out: Matrix = {}
    initial, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for begin in STATES:
        for state, cost, audit in inserts(begin):
            ways = [(state, DELETE, "D")]
            if symbol != MUST_GO:
                ways.append((inserted(state), REROLE + extra, "R"))
                if (to := kept(initial, state)) is not None:
                    ways.append((to, KEEP + extra, "K"))
            for to, more, letter in ways:
                entry = (cost + more, Rope(None, None, audit + letter))
                if better(entry, out.get((begin, to))):
                    out[begin, to] = entry
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, j), (c, x) in a.items():
        for k in STATES:
            if (j, k) in b:
                d, y = b[j, k]
                entry = (c + d, Rope(x, y))
                if better(entry, out.get((i, k))):
                    out[i, k] = entry
    return out


def advance(vector: Vector, matrix: Matrix) -> Vector:
    out: Vector = {}
    for (j, k), (d, y) in matrix.items():
        if j in vector:
            c, x = vector[j]
            entry = (c + d, Rope(x, y))
            if better(entry, out.get(k)):
                out[k] = entry
    return out


def finished(vector: Vector) -> Entry:
    """The cheapest end, with inserts behind the last row."""
    best: Entry | None = None
    for state, (c, x) in vector.items():
        for to, cost, audit in inserts(state):
            entry = (c + cost, Rope(x, Rope(None, None, audit)))
            if to in ENDS and better(entry, best):
                best = entry
    assert best is not None
    return best


class Grammar:
    """Rules in the order in which they were made, each with its matrix."""

    def __init__(self) -> None:
        self.rules: list[tuple[str, str]] = []
        self.matrices: dict[str, Matrix] = {s: symbol_matrix(s) for s in "suaxSUAX" + MUST_GO}
        self._parse = None

    def add(self, pair: str) -> str:
        symbol = chr(FIRST_RULE + len(self.rules))
        self.rules.append((pair, symbol))
        self.matrices[symbol] = product(self.matrices[pair[0]], self.matrices[pair[1]])
        return symbol

    def parse(self, symbols: str) -> str:
        """The sequence in rules: each replaced in turn, as when it was made."""
        if self._parse is None:
            self._parse = lru_cache(maxsize=16384)(self.replaced)
        return self._parse(symbols)

    def replaced(self, symbols: str) -> str:
        for pair, symbol in self.rules:
            if pair in symbols:
                symbols = symbols.replace(pair, symbol)
        return symbols

    def __getstate__(self):
        return {"rules": self.rules, "matrices": self.matrices, "_parse": None}


def repair_grammar(sequences: DataFrame, work: Workspace) -> Grammar:
    """Re-Pair over (symbols): counts of neighbours over the whole table, the most frequent ones become rules.

    A round takes all frequent pairs that share no symbol with a more frequent one of the round, since replacing one
    does not change the others.  Only the LOOKED_AT most frequent pairs of a round come to the driver.
    """
    grammar = Grammar()
    level = work.write(sequences.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "sequences")
    for _ in range(ROUNDS):
        places = F.sequence(F.lit(1), F.length("symbols") - 1)
        pairs = level.filter(F.length("symbols") > 1).select("n", F.explode(F.transform(places, lambda i: F.substring("symbols", i, F.lit(2)))).alias("pair"))
        counted = pairs.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "pair").limit(LOOKED_AT)
        taken: list[tuple[str, str]] = []
        used: set[str] = set()
        for r in counted.collect():
            if len(grammar.rules) < RULES and not used & set(r["pair"]):
                used |= set(r["pair"])
                taken.append((r["pair"], grammar.add(r["pair"])))
        if not taken:
            break
        replaced: Column = F.col("symbols")
        for pair, symbol in taken:
            replaced = F.replace(replaced, F.lit(pair), F.lit(symbol))
        level = level.select(replaced.alias("symbols"), "n")
    return grammar


# Rows


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults by crc32(``conv_id:turn``) % 20; nulls are written as one blank.

    0 drops the row, 1 empties its text, 2 takes its . ! and ? away, 3 repeats it, 4 makes its role user.
    """
    blank = F.lit(" ")
    written = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(written) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("__kind")).filter("__kind <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("__kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("__kind") == 1, F.lit("")).when(F.col("__kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
        )
        .drop("__copy")
    )


def marked(rows: DataFrame) -> DataFrame:
    """``rows`` with nulls as a blank, the digest of the text, and whether it is blank or truncated."""
    blank = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    bare = F.btrim("text", F.lit(SPACE_CHARS))
    return rows.select(
        "*", F.unhex(F.sha2("text", 256)).alias("digest"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )


def fault_rows(rows: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, turn, role, digest, blank, cut, n, later): one row per different row of a conversation, n of them.

    ``later``: its role and text stand in an earlier turn, too.  Texts themselves are not moved.
    """
    lines = marked(rows).groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.count(F.lit(1)).alias("n"))
    lines = work.write(lines, "lines")
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = lines.filter("NOT blank").groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("turns"))
    first = work.write(first.filter("turns > 1").toDF("f_conv", "f_role", "f_digest", "first", "turns").drop("turns"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    later = F.coalesce(F.col("first") < when, F.lit(False))
    return work.write(lines.join(first, same, "left").select(*lines.columns, later.alias("later")), "faults")


def segments(faults: DataFrame) -> DataFrame:
    """(conv_id, part, chunk, symbols, first, last, illegal) in the order of turns, nulls first, then role and digest of the text.

    Rows are dealt by ranges of conversation and turn, so that a long conversation is split over tasks.
    """
    kind = faults.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, part int, chunk int, symbols string, first string, last string, illegal long"
    order = ["conv_id", "turn", "role", "digest"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        now, held, initials, illegal, chunk, begun = None, [], "", 0, 0, False
        rows: list[tuple] = []

        def close() -> None:
            nonlocal illegal, chunk
            if held:
                rows.append((now, part, chunk, "".join(held), initials[0], initials[-1], illegal))
                held.clear()
                illegal, chunk = 0, chunk + 1

        def table(like: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            kinds = [like, pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema_names)

        schema_names, like = ["conv_id", "part", "chunk", "symbols", "first", "last", "illegal"], pa.int64()
        for batch in batches:
            like = batch.column("conv_id").type
            for conv, role, blank, cut, n, later in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "blank", "cut", "n", "later"))):
                if not begun or conv != now:
                    close()
                    now, chunk, begun = conv, 0, True
                initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
                symbol = MUST_GO if blank or later else initial.upper() if cut else initial
                while n:
                    if len(held) >= SEGMENT:
                        close()
                    if held:
                        illegal += initials[-1] + initial not in ("su", "ua", "au")
                        initials = initials[0] + initial
                    else:
                        initials = initial
                    held.append(symbol)
                    symbol, n = MUST_GO, n - 1
                    if len(rows) >= 8192:
                        yield table(like)
            yield table(like)
        close()
        if rows:
            yield table(like)

    needed = faults.select(*order, "blank", "cut", "n", "later")
    return needed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(emit, schema)


def edits(found: DataFrame, grammar: Grammar) -> DataFrame:
    """(conv_id, illegal, cost, audit) of the conversations whose segments are given.

    A conversation's segments come one after another to a task that holds four audits, one per state.
    """
    kind = found.schema["conv_id"].dataType.simpleString()
    start: Vector = {BEGIN: (0, Rope(None, None, ""))}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, vector, last, illegal, begun = None, start, "", 0, False
        names, like = ["conv_id", "illegal", "cost", "audit"], pa.int64()

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [like, pa.int64(), pa.int64(), pa.string()])], names)

        def result() -> tuple:
            cost, audit = finished(vector)
            return now, illegal, cost, audit.text

        for batch in batches:
            rows = []
            like = batch.column("conv_id").type
            for conv, symbols, first, final, more in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "symbols", "first", "last", "illegal"))):
                if not begun or conv != now:
                    if begun:
                        rows.append(result())
                    now, vector, last, illegal, begun = conv, start, "", 0, True
                illegal += more + (last != "" and last + first not in ("su", "ua", "au"))
                last = final
                for symbol in grammar.parse(symbols):
                    vector = advance(vector, grammar.matrices[symbol])
                vector = {state: (cost, Rope(None, None, audit.text)) for state, (cost, audit) in vector.items()}
            yield table(rows)
        if begun:
            yield table([result()])

    ordered = found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    return ordered.mapInArrow(emit, f"conv_id {kind}, illegal long, cost long, audit string")


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that stand after an audit's edits."""
    state = BEGIN
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            state = inserted(state)
            role = "user" if state == USER else "assistant"
        else:
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
        yield letter, role, text


def in_order(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows in order, together in one partition; texts move once."""
    columns = ["conv_id", "audit", "turn", "role", "digest", "text"]
    texts = marked(rows).withColumn("audit", F.lit(None).cast("string")).select(F.lit(1).alias("tag"), *columns)
    heads = audits.select(
        F.lit(0).alias("tag"), "conv_id", "audit",
        *[F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in columns[2:]],
    )
    return heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "tag", "turn", "role", "digest")


def stream_edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edits of its rows) from rows as ``in_order`` gives them; a row is held at a time."""
    def flat():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("tag", "conv_id", "audit", "role", "text")))

    rows = flat()
    head = next(rows, None)
    while head is not None:
        following = None

        def own():
            nonlocal following
            for r in rows:
                if r[0] == 0:
                    following = r
                    return
                yield r[3], r[4]

        mine = own()
        yield head[1], edited(head[2], mine)
        for _ in mine:
            pass
        head = following


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the rows that stand after the edits, numbered from 0.

    ``audits`` (conv_id, audit) as ``repair`` gives them for the same rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, position long, edit string, role string, text string"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        like = pa.null()

        def watched():
            nonlocal like
            for batch in batches:
                like = batch.column("conv_id").type
                yield batch

        def table() -> pa.RecordBatch:
            kinds = [like, pa.int64(), pa.string(), pa.string(), pa.string()]
            out = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
            held.clear()
            return pa.RecordBatch.from_arrays(out, ["conv_id", "position", "edit", "role", "text"])

        for conv, made in stream_edited(watched()):
            for position, (letter, role, text) in enumerate(made):
                held.append((conv, position, letter, role, text))
                if len(held) >= 1024:
                    yield table()
        if held:
            yield table()

    return in_order(rows, audits.select("conv_id", "audit")).mapInArrow(emit, schema)


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of each repaired conversation's ``role:text``, joined by line breaks.

    A conversation's rows go through one task, as SHA-256 runs over a text from end to end; a row is held at a time.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, like = [], [], None

        def watched():
            nonlocal like
            for batch in batches:
                like = batch.column("conv_id").type
                yield batch

        for conv, made in stream_edited(watched()):
            sha = hashlib.sha256()
            for k, (_, role, text) in enumerate(made):
                sha.update(f"{chr(10) if k else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            ids.append(conv)
            found.append(sha.hexdigest())
            if len(ids) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(ids, like), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])
                ids, found = [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, like), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])

    return in_order(rows, audits.select("conv_id", "audit")).mapInArrow(emit, f"conv_id {kind}, repaired_sha256 string")


def repair(rows: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation of ``rows``.

    Rows are (conv_id, turn, role, text), taken by turn, nulls first; rows of one turn by role and by a digest of the text, equal
    ones side by side.  Null roles and texts are one blank; rows of a null conv_id are one conversation.  A row's first fault
    counts: blank (no character but white space), duplicate (role and text seen earlier), truncated (the last
    character that is no white space is none of . ! ?).  ``gaps``: turns missing between the first and the last, 0 without turns.
    ``illegal``: neighbours whose role initials are not su, ua or au; a role that does not begin with s, u or a
    (an empty one, too) stands nowhere and is given a new role or deleted.  An empty table gives an empty one.
    Other columns are not read.
    """
    faults = fault_rows(rows, work)
    whole = lambda c: F.sum(c).cast("long")
    copies = F.when(F.col("blank"), 0).when(F.col("later"), F.col("n")).otherwise(F.col("n") - 1)
    counts = faults.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        whole(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"), whole(copies).alias("duplicate"),
        whole(F.when(~F.col("blank") & ~F.col("later") & F.col("cut"), 1).otherwise(0)).alias("truncated"),
    )
    found = work.write(segments(faults), "segments")
    done = edits(found, repair_grammar(found.select("symbols"), work))
    done = done.withColumnRenamed("conv_id", "e_conv")
    return counts.join(done, F.col("conv_id").eqNullSafe(F.col("e_conv"))).drop("e_conv")
