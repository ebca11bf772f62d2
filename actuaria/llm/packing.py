"""Operator 4: packing with order-preserving dynamic programming.

A partition's documents, in their order, are one long run of tokens.  The program
chooses where to cut it into windows of at most ``window`` tokens.  Cuts are wanted at document ends, cost a little at sentence
ends and more inside a sentence, and a window costs its padding.  With
cost[j] = cut(j) + min over i in [j - window, j) of cost[i] + padding(j - i) + opening,
the minimum of cost[i] + i over a sliding range is kept in a monotone queue, so
each boundary enters and leaves once.  Windows of a power of two need no padding;
they are further transitions, one for each power.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import slices, texts_of

END_ID = 1
#: Costs in tokens of padding: a cut at a sentence end, one inside a sentence, a further window.
SENTENCE_CUT, INNER_CUT, OPENING = 2, 12, 32


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes in turn for
    the code points from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def vocabulary(path: str):
    """(encode, sentence ends): text → ids, and for each id whether a sentence ends behind it.

    The ids are those of ``tokenizers`` for this file with add_special_tokens=False, so a special token's string
    in a text is that token.  A byte-level vocabulary whose merges come in the order of their ids is encoded by tiktoken's
    faster search of the same ranks, and the library's own tokenizer is only made for a text with such a string; any other
    vocabulary is encoded by ``tokenizers`` itself.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    vocab, added = model["model"]["vocab"], model.get("added_tokens") or []
    table = vocab if isinstance(vocab, dict) else {token: number for number, (token, *_) in enumerate(vocab)}
    special = {t["content"] for t in added}
    ends = np.zeros(max([*table.values(), *(t["id"] for t in added), END_ID]) + 1, dtype=bool)
    alphabet = byte_alphabet()
    ranks = {}
    for token, number in table.items():
        if token not in special:
            raw = bytes(alphabet.get(c, 63) for c in token)
            ranks[raw] = number
            ends[number] = raw.rstrip(b"\"')")[-1:] in (b".", b"!", b"?", b"\n")

    @lru_cache(maxsize=1)
    def own():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def whole(text: str) -> list[int]:
        return own().encode(text, add_special_tokens=False).ids

    if not ranked_merges(model, table, special):
        return whole, ends
    import tiktoken
    from public_tokenizers import PATTERN

    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return (lambda text: whole(text) if any(s in text for s in special) else fast.encode_ordinary(text)), ends


def ranked_merges(model: dict, table: dict[str, int], special: set[str]) -> bool:
    """Whether every merge makes the next id: then ids are ranks, as tiktoken needs them."""
    if model["model"].get("type") != "BPE" or (model.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or model.get("normalizer"):
        return False
    if model["pre_tokenizer"].get("add_prefix_space"):
        return False
    made = [table[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"])]
    return all(x < y for x, y in zip(made, made[1:])) and len(made) + 256 >= len(table) - len(special)


def powers(window: int) -> list[int]:
    return [1 << k for k in range(window.bit_length()) if 1 << k < window]


def best_cuts(positions: list[int], costs: list[int], window: int) -> list[int]:
    """The chosen cuts of a run from 0 to positions[-1], both boundaries included.

    positions: ascending, the places where a cut is allowed, the first 0 and no gap
    above ``window``; costs: what a cut there costs.
    """
    short = powers(window)
    n = len(positions)
    at = {p: k for k, p in enumerate(positions)}
    best, origin = [0] * n, [0] * n
    queue: deque[int] = deque([0])  # boundaries i in order, best[i] + positions[i] rising
    for j in range(1, n):
        here = positions[j]
        while positions[queue[0]] < here - window:
            queue.popleft()
        i = queue[0]
        low = best[i] + positions[i] + window - here
        for length in short:
            k = at.get(here - length)
            if k is not None and best[k] < low:
                low, i = best[k], k
        best[j], origin[j] = low + costs[j] + OPENING, i
        mine = best[j] + here
        while queue and best[queue[-1]] + positions[queue[-1]] >= mine:
            queue.pop()
        queue.append(j)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(origin[cuts[-1]])
    return [positions[k] for k in reversed(cuts)]


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """The allowed cuts of a run of ids and their costs.

    Document and sentence ends, and inside a sentence the places that fill a window
    exactly when counted from a boundary; gaps above the window are cut evenly.
    """
    n = len(ids)
    cost = np.full(n + 1, INNER_CUT, dtype=np.int64)
    sentence = np.flatnonzero(ends[ids]) + 1
    cost[sentence] = SENTENCE_CUT
    cost[doc_ends] = 0
    cost[[0, n]] = 0
    wanted = np.unique(np.concatenate([[0, n], sentence, doc_ends]))
    # From every 8th boundary on, and from 0, a place that just fills the window.
    fills = np.concatenate([wanted[::8] + window, np.arange(0, n, window)])
    places = np.unique(np.concatenate([wanted, fills[fills < n]]))
    return places.tolist(), cost[places].tolist()


class Packer:
    """Packs one partition's documents in order; the last, open window is carried on."""

    def __init__(self, ends: np.ndarray, window: int, block: int):
        self.ends, self.window, self.block = ends, window, block
        self.docs: list[tuple[int | None, np.ndarray, int]] = []  # id, its ids that are not packed yet, ids before them
        self.held = 0
        self.sequence = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, ids, 0))
        self.held += len(ids)
        return self.pack(last=False) if self.held >= self.block else []

    def pack(self, last: bool) -> list[tuple]:
        """Pieces (doc_id, start, length, crc32, doc_tokens, sequence, offset) of the windows that are done."""
        if not self.held:
            return []
        run = np.concatenate([ids for _, ids, _ in self.docs])
        doc_ends = np.cumsum([len(ids) for _, ids, _ in self.docs])
        cuts = best_cuts(*boundaries(run, doc_ends, self.ends, self.window), self.window)
        if last:
            tail = cuts[-1] - cuts[-2]
            if tail & (tail - 1) and tail != self.window:  # the last windows are powers of two: no padding
                at = cuts.pop(-2) if len(cuts) > 1 else 0
                end = cuts.pop()
                cuts.append(at)
                for k in reversed(range(tail.bit_length())):
                    if tail >> k & 1:
                        at += 1 << k
                        cuts.append(at)
                assert at == end
        elif len(cuts) > 2:
            cuts.pop()  # the open window is packed with what follows
        pieces, rest, k, begun = [], [], 0, 0
        for doc_id, ids, before in self.docs:
            done, n = 0, len(ids)
            while done < n and k + 1 < len(cuts):
                take = min(n - done, cuts[k + 1] - (begun + done))
                part = ids[done : done + take]
                pieces.append((doc_id, before + done, take, zlib.crc32(part.astype("<u4").tobytes()), before + n, self.sequence, begun + done - cuts[k]))
                done += take
                if begun + done == cuts[k + 1]:
                    k, self.sequence = k + 1, self.sequence + 1
            if done < n:
                rest.append((doc_id, ids[done:], before + done))
            begun += n
        self.docs, self.held = rest, sum(len(ids) for _, ids, _ in rest)
        return pieces


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 2048, block: int = 1 << 18) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and then END_ID, so null and empty texts are one token and
    every row of ``docs`` lies in at least one piece.  Repeated rows and null ids are
    packed like others.  Very long texts are encoded whole and cut into many windows.
    An empty table gives an empty one.  Other columns are not read.

    ``tokenizer`` is a file that every executor has.  There is no shuffle: the order
    kept is that of the rows in the partitions of ``docs``, and each partition is
    packed by itself and ends in windows of powers of two, so it leaves no padding
    at its end.  A task holds ``block`` tokens and one document at a time; if it
    runs again it gives all of its sequences anew under the same numbers.
    """
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, ends = vocabulary(tokenizer)
        packer = Packer(ends, window, block)
        first = TaskContext.get().partitionId() << 40

        def piece_table(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces))
            columns[5] = [first + s for s in columns[5]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in slices(batches, "text", 4 << 20):
            pieces = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                ids = encode(text)
                ids.append(END_ID)
                pieces += packer.add(doc_id, np.array(ids, dtype=np.uint32))
            if pieces:
                yield piece_table(pieces)
        if pieces := packer.pack(last=True):
            yield piece_table(pieces)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, SCHEMA)
