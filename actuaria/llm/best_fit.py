"""Operator 12: best-fit packing planned on the histogram of lengths.

How a document is packed depends on its length alone.  So the plan is made over counts: lengths from the longest down,
every length put where the least room is left that holds it, whole ranges of sequences at a time.  The plan's size is bounded by
the window and not by the documents: each of its steps uses up a range of sequences or the pieces of a length.

Documents take the planned slots by their rank among the pieces of their length.  Ranks need no sort: a task counts the pieces of a length that it
has seen, and the numbers of the tasks before it are prefix sums of a small table.  The join is on length and
rank block, so a length that a third of all rows share is many keys.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import Workspace, slices, texts_of
from actuaria.llm.packing import byte_alphabet

END_ID = 1
#: Ranks of a length that one key of the join holds at most.
BLOCK = 4096
#: How the lower-casing word vocabulary splits a text (a fixed value of its file).
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of these characters alone stay composed, and their lower case stays among them.
_PLAIN = re.compile("[\t\n\r -~\xa0-\u012f\u0131-\u017f]*")
#: The same splitting for lower-case texts of such characters.
_PLAIN_WORD = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    "|[^\\s0-9a-z\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\u017f]+"
)
#: Stands for the end of a word; not among the plain characters.
_END = "\x01"


@lru_cache(maxsize=2)
def encoder(path: str):
    """text → its ids as bytes, four a token, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    Plain texts of a vocabulary with word ends are split here and merged by tiktoken's faster search of the same ranks, the
    end of a word being one more byte; it is checked that the file is of that kind.  All other texts, and those in
    which a special token's string stands, go to the tokenizer itself.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    ranks = word_ranks(path)

    def whole(text: str) -> list[int]:
        return own.encode(text, add_special_tokens=False).ids

    encode = whole
    if ranks:
        import tiktoken

        fast = tiktoken.Encoding("best-fit", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> list[int]:
            if not _PLAIN.fullmatch(text) or any(s in text for s in special):
                return whole(text)
            words = _PLAIN_WORD.findall(text.lower())
            return fast.encode_ordinary(_END.join(words) + _END) if words else []

    return lambda text: np.array(encode(text), dtype="<u4").tobytes()


def word_ranks(path: str) -> dict[bytes, int] | None:
    """The ids of a byte-level vocabulary with word ends by their bytes, _END for the end of a word.

    None if the file is of another kind: other steps before the merges, or ids that don't rise with the merges.
    """
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    model, steps = found["model"], [s.get("type") for s in (found.get("normalizer") or {}).get("normalizers", [])]
    splits = (found.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    end = model.get("end_of_word_suffix")
    if model.get("type") != "BPE" or not end or steps != ["NFC", "Replace", "Lowercase"] or splits[0].get("pattern") != {"Regex": WORD_SPLIT}:
        return None
    alphabet, ids = byte_alphabet(), model["vocab"]
    made = [ids[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    if made != sorted(made) or len(made) + 2 * len(alphabet) != len(ids):
        return None

    def raw(token: str) -> bytes:
        inner = token.removesuffix(end) if len(token) > len(end) else token
        return bytes(alphabet[c] for c in inner) + (_END.encode() if inner != token else b"")

    return {raw(t): i for t, i in ids.items()}


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def pieces_of(docs: DataFrame, tokenizer: str, window: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth): nth counts the pieces of this length that the task had before."""
    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, task, seen = encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in slices(batches, "text", 4 << 20):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                ids = encode(text) + END_ID.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(ids), 4 * window)):
                    part = ids[at : at + 4 * window]
                    length = len(part) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, PIECES)


def plan(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts: (length, first rank, number, first sequence, each, offset) per step.

    Ranks first .. first + number - 1 of a length go into the sequences from ``first sequence`` on, ``each`` of them into one
    sequence, side by side from ``offset`` on.  Lengths are placed from the longest down, where the least room is left that
    holds them; new sequences are opened when there is no such room.
    """
    steps: list[tuple[int, int, int, int, int, int]] = []
    rooms: list[int] = []  # ascending, the room left of the ranges below
    ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room → (first sequence, sequences)
    opened = 0

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in ranges:
                insort(rooms, room)
            ranges[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, n = ranges[room].pop()
                if not ranges[room]:
                    del ranges[room], rooms[k]
            else:
                room, first = window, opened
                n = -(-left // (window // length))
                opened += n
            # The room that a piece leaves is the least again while it holds the length, so a sequence is filled in one go.
            each = room // length
            full = min(n, left // each)
            if full:
                steps.append((length, rank, full * each, first, each, window - room))
                leave(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left:
                steps.append((length, rank, left, first + full, left, window - room))
                leave(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            leave(room, first + full, n - full)
    return steps


def pack_best_fit(docs: DataFrame, tokenizer: str, work: Workspace, window: int = 4096) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and then END_ID, so null and empty texts are one token and every row of ``docs`` is at least
    one piece.  Only longer documents than ``window`` are cut, into pieces of ``window`` tokens and a last one.  Repeated rows
    and null ids are packed like others, and pieces of one length take slots in the order of the partitions.  An empty table
    gives an empty one.  Other columns are not read.
    ``tokenizer`` is a file that every executor has.  A task holds the ids of one document at a time.
    """
    pieces = work.write(pieces_of(docs, tokenizer, window), "pieces")
    of_task = work.write(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = of_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # At most ``window`` rows, however many documents there are.
    histogram = {r["length"]: r["n"] for r in of_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    schema = "length long, first long, number long, sequence long, each long, at long"
    steps = work.spark.createDataFrame(plan(histogram, window), schema)
    last = F.col("first") + F.col("number") - 1
    block = lambda rank: F.floor(rank / BLOCK)
    slots = steps.select("*", F.explode(F.sequence(block(F.col("first")), block(last))).alias("block"))
    ranked = pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    placed = ranked.withColumn("block", block(F.col("rank"))).join(slots, ["length", "block"]).filter(F.col("rank").between(F.col("first"), last))
    within = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.floor(within / F.col("each"))).alias("sequence_id"),
        (F.col("at") + within % F.col("each") * F.col("length")).alias("offset"),
    )
