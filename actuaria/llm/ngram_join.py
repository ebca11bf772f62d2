"""Operator 5: n-gram Jaccard join with token-combination prefixes.

Tokens are hashed word shingles, in one global order: rare ones first, frequent ones
last, each by hash.  A text of n tokens can lose t = n - ceil(n * share) of them and
still link, so among any prefix that survives t losses a link leaves a signature:

* a rare token is a signature by itself and covers one loss;
* frequent tokens are dealt into small sub-classes; m tokens of one sub-class give
  all their pairs as signatures and cover m - 1 losses.

The prefix is extended until it covers t + 1 losses.  Texts with enough rare tokens never
index a frequent one, so a passage that many texts share makes no candidates.  The
number of sub-classes depends on a size band; a text signs for its own band and the
next, so texts whose sizes can link share a band.

The prefix is extended further, by a third: a text all of whose signatures are rare
tokens shares at least that many with any text that it links with.  Texts that
share fewer with the whole corpus drop out before any pair is formed.

Signatures of few texts give pairs, and the pairs that share enough signatures are
candidates.  A signature of many texts names one pivot; members are verified
against their pivot, and those that don't link with it are compared, in blocks,
with all members of the pivot's buckets.  What is kept of the links is a spanning
forest, never all pairs of a group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import Workspace, sized, slices, texts_of
from actuaria.llm.components import connected_components
from actuaria.llm.embedding_dedup import forest
from actuaria.llm.shingles import mix, shingle_sets

#: A token is frequent from this many texts on, counted in the texts' first tokens by hash,
#: and a bucket is big from this many members on.
FREQUENT = 16
#: Below this size a band's frequent tokens are signatures by themselves.
SMALL = 20
SLICE = 256 << 10
#: Rows of one signature that a share holds where it is counted.
HOT = 4096


def losses(n: int, percent: int) -> int:
    """The tokens that a text of n tokens can lose and still link."""
    return n - (percent * n + 99) // 100


def extension(n: int, percent: int) -> int:
    """Signatures beyond the least: two linked texts share one more than the smaller's extension."""
    need = losses(n, percent) + 1
    return min(need // 3 + 2, n - need)


def first_tokens(n: int, percent: int) -> int:
    """How many tokens by hash are looked at for rare ones: some more than are indexed."""
    need = losses(n, percent) + 1
    return min(n, need + extension(n, percent) + need // 8 + 4)


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts_of(batch.column("text"))]


def _class_of(tokens: np.ndarray) -> int | None:
    """A number for the set; texts with equal sets are one class."""
    if not len(tokens):
        return None
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def token_sets(docs: DataFrame, size: int, percent: int | None) -> DataFrame:
    """(doc_id, n, cid, tokens): the first tokens by hash, or with ``percent`` None all of them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(_encoded(batch), size)
            cut = sets if percent is None else [s[: first_tokens(len(s), percent)] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_class_of(s) for s in sets], pa.int64()),
                    pa.array([c.view(np.int64) for c in cut], pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "cid", "tokens"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, "doc_id long, n long, cid long, tokens array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cid, n, tokens): all tokens of the classes of ``wanted`` (doc_id, cid), from one document each.

    Where rows repeat in id and text, a class comes as often; nothing below counts on one row each.
    """
    ids = sized(wanted.select(F.col("doc_id").alias("w_id"), F.col("cid").alias("w_cid")))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(ids, F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi")
    sets = token_sets(texts, size, None)
    # Repeated ids may have other texts as well: only the wanted class of the document.
    return sets.join(ids, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("cid") == F.col("w_cid")), "left_semi").select(
        "cid", "n", "tokens"
    )


def band_of(n: int, percent: int) -> int:
    return math.floor(math.log(n) / math.log(100 / percent) + 1e-9)


def band_scheme(band: int, percent: int) -> int:
    """The number of sub-classes of a band, 0 where frequent tokens stand alone."""
    lowest = (100 / percent) ** band
    if lowest < SMALL:
        return 0
    return max(1, math.floor((100 - percent) / 100 * lowest / 3))


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a whole set (uint64, ascending) whose rare tokens may not suffice."""
    need = losses(len(tokens), percent) + 1 + extension(len(tokens), percent)
    common = np.isin(tokens, frequent)
    rare = tokens[~common]
    if len(rare) >= need:
        return rare[:need]
    often = tokens[common]
    out = [rare]
    own = band_of(len(tokens), percent)
    for band in (own, own + 1):
        classes = band_scheme(band, percent)
        if not classes:
            out.append(often[: need - len(rare)])
            continue
        salt = np.uint64(band * 0x9E3779B9 + 1)
        which = (mix(often ^ salt) % np.uint64(classes)).astype(np.int64)
        # Every token but the first of its sub-class covers one loss.
        order = np.argsort(which, kind="stable")
        new = np.ones(len(often), dtype=bool)
        new[order[1:]] = which[order[1:]] != which[order[:-1]]
        covered = len(rare) + np.cumsum(~new)
        end = int(np.searchsorted(covered, need)) + 1
        taken, of = often[:end], which[:end]
        for c in np.unique(of):
            group = taken[of == c]
            a, b = np.triu_indices(len(group), 1)
            out.append(mix(mix(group[a]) + mix(group[b] ^ np.uint64(0x5555)) * np.uint64(3) + salt))
    return np.unique(np.concatenate(out))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs between two blocks of positions, by products of 0/1 matrices over shared tokens."""
    rows = np.concatenate([left, right]) if left is not right else left
    lengths = np.array([len(sets[r]) for r in rows])
    tokens = np.concatenate([sets[r] for r in rows])
    row = np.repeat(np.arange(len(rows)), lengths)
    _, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    column, row = number[column[shared]], row[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    step = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [low, low + step])
        dense = np.zeros((len(rows), step), dtype=np.float32)
        dense[row[a:b], column[a:b] - low] = 1
        both += dense[: len(left)] @ (dense[len(left) :] if left is not right else dense).T
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    inside = both.astype(np.int64)
    found = 100 * inside >= percent * (sizes[left][:, None] + sizes[right][None, :] - inside)
    if left is right:
        found = np.triu(found, 1)
    a, b = np.nonzero(found)
    return left[a], right[b]


def _streamed(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The runs of equal keys in sorted batches, each as one table."""
    current: tuple | None = None
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        values = np.stack([np.asarray(batch.column(k)).astype(np.int64) for k in keys], axis=1)
        edges = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1), len(values)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            group = tuple(map(int, values[start]))
            if group != current:
                if waiting:
                    yield current, pa.Table.from_batches(waiting).combine_chunks()
                current, waiting = group, []
            waiting.append(batch.slice(start, end - start))
    if waiting:
        yield current, pa.Table.from_batches(waiting).combine_chunks()


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    array = column.combine_chunks()
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    flat = np.asarray(array.flatten()).view(np.uint64)
    ends = np.cumsum(np.asarray(array.value_lengths()))
    return np.split(flat, ends[:-1])


def may_link(a: np.ndarray, na: int, b: np.ndarray, nb: int, percent: int) -> bool:
    """Whether two sets can link, from their first tokens by hash: neither has lost too many there.

    Up to the lower of the two last tokens both sets are known whole.
    """
    ends = [t[-1] for t, n in ((a, na), (b, nb)) if len(t) < n]
    if ends:
        a, b = (t[: np.searchsorted(t, min(ends), side="right")] for t in (a, b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) - both <= losses(na, percent) and len(b) - both <= losses(nb, percent)


def test_pairs(pairs: DataFrame, sets: DataFrame, percent: int, whole: bool) -> DataFrame:
    """The ``pairs`` (p, x) that link by their whole sets, or that can by their first tokens.

    ``sets`` (cid, n, tokens).  Members are dealt by pivot and sorted, the pivot's set
    first, so a task holds one pivot's set; a pivot of many members comes in shares.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own, size = None, None, 0
        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = (batch.column(c).to_pylist() for c in ("p", "x", "n"))
            for a, b, n, tokens in zip(*columns, _sets(pa.chunked_array([batch.column("tokens")]))):
                if b is None:
                    pivot, own, size = a, tokens, n
                elif a == pivot and (linked(own, tokens, percent) if whole else may_link(own, size, tokens, n, percent)):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([t[i] for t in out], pa.int64()) for i in (0, 1)], ["p", "x"])

    # Who goes where is settled on ids alone: the sets move once to be asked for and once to where they are compared.
    shares = pairs.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / F.lit(256)).cast("int").alias("shares"))
    members = pairs.select("p", "x").join(shares, "p").select(
        F.col("x").alias("asked"), "p", "x", F.pmod(F.xxhash64("x"), F.col("shares")).cast("int").alias("share")
    )
    pivots = shares.select(
        F.col("p").alias("asked"), "p", F.lit(None).cast("long").alias("x"),
        F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
    )
    dealt = sets.join(sized(members.unionByName(pivots)), F.col("cid") == F.col("asked")).select("p", "x", "n", "tokens", "share")
    return (
        dealt.repartition("p", "share").sortWithinPartitions("p", "share", F.col("x").asc_nulls_first())
        .select("p", "x", "n", "tokens").mapInArrow(emit, "p long, x long")
    )


def bands(n: Column, percent: int) -> Column:
    """The size band of a text and the next: two sizes that can link share one."""
    own = F.floor(F.log(n.cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    return F.array(own, own + 1)


def open_groups(stars: DataFrame, percent: int, block: int) -> DataFrame:
    """(p, band, x, own, i, j): the members of pivots dealt into pairs of blocks.

    ``stars`` (p, x, n, linked).  Only texts of like size can link, so a pivot's
    members are grouped by size band, each in its own band and the next.  Open
    members are compared with all members of the group, linked ones only with open
    ones; the blocks hold open members or linked ones.
    """
    banded = stars.withColumn("band", F.explode(bands(F.col("n"), percent)))
    groups = banded.groupBy("p", "band").agg(
        F.count(F.lit(1)).alias("held"), F.sum(F.when(~F.col("linked"), 1).otherwise(0)).alias("open")
    )
    groups = groups.filter("open > 0 and held > 1").select(
        "p", "band", F.ceil(F.col("open") / F.lit(block)).cast("int").alias("ob"),
        F.ceil((F.col("held") - F.col("open")) / F.lit(block)).cast("int").alias("lb"),
    )
    members = banded.join(groups, ["p", "band"])
    turn = lambda n: F.pmod(F.xxhash64("x", "p"), n).cast("int")
    own = F.when(F.col("linked"), F.col("ob") + turn(F.greatest("lb", F.lit(1)))).otherwise(turn(F.col("ob")))
    others = F.when(F.col("linked"), F.sequence(F.lit(0), F.col("ob") - 1)).otherwise(F.sequence(F.lit(0), F.col("ob") + F.col("lb") - 1))
    return members.withColumn("own", own).withColumn("o", F.explode(others)).select(
        "p", "band", "x", "own", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j")
    )


def compare_groups(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within the pairs of blocks of ``open_groups``: a spanning forest for each pair."""
    full = sets.join(dealt, F.col("cid") == F.col("x")).select("p", "band", "i", "j", "x", "own", "tokens")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, i, j), run in _streamed(batches, order):
            own = np.asarray(run.column("own").combine_chunks())
            left = np.flatnonzero(own == i)
            right = left if i == j else np.flatnonzero(own == j)
            if not len(left) or not len(right):
                continue
            names = np.asarray(run.column("x").combine_chunks())
            a, b = block_links(_sets(run.column("tokens")), left, right, percent)
            if len(a):
                centre, other = forest(a, b, len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names[centre]), pa.array(names[other])], ["a", "b"])

    order = ["p", "band", "i", "j"]
    return full.repartition(*order).sortWithinPartitions(*order).mapInArrow(emit, "a long, b long")


def met_signatures(signs: DataFrame, signed: DataFrame, work: Workspace) -> DataFrame:
    """The rows of ``signs`` whose signature is no text's alone, with ``held``, the number of its rows.

    The rows move once and are counted where they meet.  Only a signature of ``signed``, which may be frequent
    tokens, can be hot: those are counted before, and their rows dealt over as many shares as they fill.
    """
    hot = work.write(signed.groupBy("sig").agg(F.count(F.lit(1)).alias("all")).filter(F.col("all") >= HOT), "hot")
    dealt = signs.join(sized(hot), "sig", "left")
    shares = F.coalesce(F.ceil(F.col("all") / F.lit(HOT)), F.lit(1)).cast("int")
    dealt = dealt.withColumn("share", F.pmod(F.xxhash64("cid"), shares).cast("int"))
    here = F.count(F.lit(1)).over(Window.partitionBy("sig", "share"))
    return dealt.withColumn("held", F.coalesce("all", here)).filter("held > 1").drop("all", "share")


def jaccard_components(docs: DataFrame, work: Workspace, size: int = 5, percent: int = 80, block: int = 512) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Sets are the distinct ``size``-word shingles of whole texts, A-Z lower-cased; two
    link when 100 * intersection >= percent * union.  ``component_id`` is the smallest
    doc_id that links reach.  Null, empty and blank texts have an empty set and link
    with nothing; texts of fewer words have one shingle, their whole sequence.
    Repeated rows and equal texts are one class, linked, and come each.  An id that
    stands with several texts is a row for each, not linked by the id.  Null ids stay
    null and are passed over for ``component_id`` unless all are null.  An empty table
    gives an empty one.  Other columns are not read.

    Every link is found, up to collisions of 64-bit hashes.  No task holds more than
    two blocks of a group, and no pair of a group is written out, so a group of a
    third of the rows is split.
    """
    rows = work.write(token_sets(docs, size, percent), "rows")
    classes = work.write(
        rows.filter("cid is not null").groupBy("cid").agg(F.first("n").alias("n"), F.min("doc_id").alias("doc_id")), "classes"
    )
    one = sized(classes.select(F.col("cid").alias("c"), F.col("doc_id").alias("d")))
    first = rows.join(one, (F.col("cid") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi").select("cid", "n", "tokens")

    placed = first.select("cid", F.explode("tokens").alias("token"))
    often = work.write(placed.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= FREQUENT).select("token"), "often")
    frequent = work.write(
        placed.join(sized(often), "token").groupBy("cid").agg(F.collect_set("token").alias("frequent")), "frequent"
    )
    # The least number of signatures, and with the extension; the same for the smallest text that can link.
    need = lambda n: n - F.floor((F.lit(percent) * n + 99) / 100).cast("long") + 1
    extra = lambda n: F.least(F.floor(need(n) / 3).cast("long") + 2, n - need(n))
    n, smallest = F.col("n"), F.floor((F.lit(percent) * F.col("n") + 99) / 100).cast("long")
    rare = F.when(F.col("frequent").isNull(), F.col("tokens")).otherwise(F.array_except("tokens", "frequent"))
    split = first.join(sized(frequent, F.sum(F.size("frequent"))), "cid", "left").withColumn("rare", rare)
    enough = F.size("rare") >= need(n) + extra(n)
    easy = split.filter(enough).select(
        "cid", "n", (extra(smallest) + 1).alias("least"), F.explode(F.slice("rare", 1, (need(n) + extra(n)).cast("int"))).alias("sig")
    )

    # Texts whose first tokens hold too few rare ones: their whole sets are classed.
    few = work.write(split.filter(~enough).select("cid").distinct(), "few")
    chosen = lambda wanted: classes.join(sized(wanted), "cid", "left_semi").select("doc_id", "cid")
    hard = work.write(full_sets(docs, work.write(chosen(few), "few-docs"), size), "hard")
    hard_often = (
        hard.select("cid", F.explode("tokens").alias("token")).join(sized(often), "token").groupBy("cid")
        .agg(F.collect_set("token").alias("frequent"))
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts, sigs = [], [], []
            sets = _sets(pa.chunked_array([batch.column("tokens")]))
            for name, tokens, own in zip(batch.column("cid").to_pylist(), sets, batch.column("frequent")):
                found = signatures(tokens, np.array(own.as_py() or [], dtype=np.int64).view(np.uint64), percent)
                names.append(np.full(len(found), name))
                counts.append(np.full(len(found), len(tokens)))
                sigs.append(found.view(np.int64))
            if names:
                columns = [pa.array(np.concatenate(c)) for c in (names, counts, sigs)]
                yield pa.RecordBatch.from_arrays([*columns[:2], pa.array(np.ones(len(columns[0]), dtype=np.int64)), columns[2]], ["cid", "n", "least", "sig"])

    signed = hard.join(hard_often, "cid", "left").mapInArrow(sign, "cid long, n long, least long, sig long")
    signed = work.write(signed.distinct(), "signed")
    signs = easy.unionByName(signed)

    met = work.write(met_signatures(signs, signed, work), "met")
    big = F.col("held") >= FREQUENT
    own = Window.partitionBy("cid")
    able = met.withColumn("shares", F.count(F.lit(1)).over(own)).withColumn("big", F.count_if(big).over(own))
    able = work.write(able.filter("shares >= least"), "able")

    # Small buckets: the shared signatures of every pair are counted.  A pair that links
    # shares ``least`` of them, but for those that may lie in big buckets.
    small = able.filter(~big).select("sig", F.struct("cid", "n", "least", "big").alias("a"))
    counted = (
        small.join(small.withColumnRenamed("a", "b"), "sig").filter("a.cid < b.cid")
        .filter(F.lit(100) * F.least("a.n", "b.n") >= F.lit(percent) * F.greatest("a.n", "b.n"))
        .groupBy(F.col("a.cid").alias("p"), F.col("b.cid").alias("x"))
        .agg(F.count(F.lit(1)).alias("shared"), F.least(F.first("a.least"), F.first("b.least")).alias("least"),
             F.least(F.first("a.big"), F.first("b.big")).alias("big"))
    )
    counted = counted.filter("shared + big >= least").select("p", "x")

    # Big buckets: the pivot is the member that shares most signatures, the likely centre.
    often_met = able.filter(big)
    pivots = work.write(often_met.groupBy("sig").agg(F.max(F.struct("shares", "cid", "n")).alias("m")), "pivots")
    starred = often_met.join(sized(pivots), "sig").filter("cid <> m.cid")
    stars = work.write(
        starred.select(F.col("m.cid").alias("p"), F.col("m.n").alias("pn"), F.col("cid").alias("x"), F.col("n").alias("xn")).distinct(),
        "stars",
    )

    alike = F.lit(100) * F.least("pn", "xn") >= F.lit(percent) * F.greatest("pn", "xn")
    pairs = work.write(stars.filter(alike).select("p", "x"), "pairs")
    likely = work.write(test_pairs(pairs, first, percent, whole=False).unionByName(counted).distinct(), "likely")
    banded = stars.select("p", F.col("x").alias("cid"), F.explode(bands(F.col("xn"), percent)).alias("band"))
    banded = banded.join(banded.groupBy("p", "band").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), ["p", "band"], "left_semi")
    named = work.write(likely.select(F.explode(F.array("p", "x")).alias("cid")).unionByName(banded.select("cid")).distinct(), "named")
    sets = work.write(full_sets(docs, work.write(chosen(named), "named-docs"), size), "sets")
    checked = work.write(test_pairs(likely, sets, percent, whole=True).distinct(), "checked")
    members = stars.join(checked.withColumn("linked", F.lit(True)), ["p", "x"], "left")
    members = members.select("p", "x", F.col("xn").alias("n"), F.coalesce("linked", F.lit(False)).alias("linked"))
    further = compare_groups(work.write(open_groups(members, percent, block), "dealt"), sets, percent)
    edges = work.write(checked.select(F.col("p").alias("a"), F.col("x").alias("b")).unionByName(further), "edges")
    roots = connected_components(edges, work)
    by_class = classes.select("cid", "doc_id").join(sized(roots), F.col("cid") == F.col("id"), "left").select(
        "cid", "doc_id", F.coalesce("root", "cid").alias("root")
    )
    lowest = by_class.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # Only linked classes need their component's smallest id from elsewhere.
    known = work.write(
        by_class.join(sized(roots.select("root").distinct()), "root", "left_semi").join(lowest, "root").select(
            F.col("cid").alias("k"), "component_id"
        ),
        "known",
    )
    own = classes.select(F.col("cid").alias("c"), F.col("doc_id").alias("least"))
    return (
        rows.drop("tokens").join(own, F.col("cid") == F.col("c"), "left").join(sized(known), F.col("cid") == F.col("k"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "least", "doc_id").alias("component_id"))
    )
