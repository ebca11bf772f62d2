"""The operators on small tables: brute force, round trips and the cases that docstrings define."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from actuaria.llm import (
    embedding_dedup, licenses, line_dedup, mixing, ngram_join, packing, quality, secrets, shingles, substring_dedup, toxicity,
)
from actuaria.llm.common import Workspace, importable
from actuaria.llm.components import connected_components
from actuaria.llm.cuckoo import CuckooFilter, Full
from actuaria.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, size string, key string, __x int"
LONG = "word " * 60_000
LINE = "This line is long enough to be a candidate for the index of lines"
EDGE = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"), (5, f"{LINE}\nx"), (6, f"  {LINE.upper()}\t\ny"), (7, LINE), (8, LINE),
    (9, f"{LINE}\n{LINE}\nz"), (None, f"null id\n{LINE}"), (10, LONG), (11, "é ß 世界 🙂 " * 5), (12, f"{LINE}\nx"), (12, "other text"),
]


def docs_of(spark, rows):
    importable(spark)
    full = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None, "clash", "clash", "clash", 1) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def space(spark):
    return Workspace(spark, "test")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# Helpers


def test_components_match_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, size=(260, 2))] + [(1000, k) for k in range(1001, 1200)] + [(7, 7)]
    edges += [(2000 + k, 2001 + k) for k in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    got = {r["id"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), space(spark)).collect()}
    assert set(got) == set(parent)
    groups, wanted = defaultdict(set), defaultdict(set)
    for x in got:
        groups[got[x]].add(x)
        wanted[find(x)].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
    assert connected_components(spark.createDataFrame([], "a long, b long"), space(spark)).count() == 0


@pytest.mark.parametrize("size", [1, 4, 5])
def test_shingle_counts(size):
    texts = [t or "" for _, t in EDGE] + ["a b c d a b c d", "A b C", "a b c", "x" * 70_000 + " y"]

    def brute(text):
        words = [ascii_lower(w) for w in WORD.findall(text)]
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        return grams or ({tuple(words)} if words else set())

    sets = shingle_sets([t.encode() for t in texts], size)
    assert [len(s) for s in sets] == [len(brute(t)) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert len(np.intersect1d(a, b)) == len(brute(texts[i]) & brute(texts[j]))


# 1


def test_cuckoo_filter_adds_removes_and_grows():
    keys = [hashlib.blake2b(str(k).encode(), digest_size=16).digest() for k in range(6000)]
    built = CuckooFilter.of_keys(keys[:3000])
    again = CuckooFilter.of_bytes(built.to_bytes())
    assert again.contains(keys[:3000]).all() and again.contains(keys[3000:]).mean() < 0.01
    assert all(again.remove(k) for k in keys[:1500]) and again.contains(keys[1500:3000]).all()
    assert again.contains(keys[:1500]).mean() < 0.01
    with pytest.raises(Full):
        small = CuckooFilter(64)
        for k in keys:
            small.add(k)
    with pytest.raises(ValueError):
        CuckooFilter(3)


def brute_lines(rows, least_docs, least_chars=40):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= least_chars:
                held[key].add(-1 if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = []
        for line in lines:
            docs = held.get(ascii_lower(line.strip(" \t\n\x0b\x0c\r")), set())
            if len(docs) < least_docs or max(docs) == (-1 if i is None else i):
                stay.append(line)
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("least", [2, 5, 7, 9])
def test_lines_match_brute_force(spark, least):
    done = line_dedup.dedup_lines(docs_of(spark, EDGE), space(spark), min_docs=least, shards=4)
    assert rows_of(done.select("doc_id", "__kept", "__n_lines", "__n_dropped")) == brute_lines(EDGE, least)


def test_lines_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(docs_of(spark, EDGE).limit(0), space(spark)).count() == 0


def test_deleting_undoes_inserting(spark):
    w = space(spark)
    first = [(k, f"{LINE} number {k % 7} of the lines that repeat\nown {k}") for k in range(40)]
    second = [(k, f"{LINE} number {k % 11} of the lines that repeat\nown {k}") for k in range(100, 150)]
    one = line_dedup.LineIndex.empty(w, shards=4).insert(docs_of(spark, first))
    two = one.insert(docs_of(spark, second))
    back = two.delete(spark.createDataFrame([(k,) for k in range(100, 150)], "doc_id long"))
    state = lambda x: (rows_of(x.refs.select("key", "n_docs", "keeper")), rows_of(x.repeated()))
    assert state(two)[1] != state(one)[1] and state(back) == state(one)
    hits = lambda x: {r["key"] for r in x.may_repeat(x.refs.select("key")).collect()}
    frequent = lambda x: {r["key"] for r in x.refs.filter("n_docs >= 5").collect()}
    for index in (one, two, back):
        assert frequent(index) <= hits(index)
    # Deleting the keeper makes the next largest id the keeper.
    less = one.delete(spark.createDataFrame([(39,)], "doc_id long"))
    assert max(r["keeper"] for r in less.refs.filter("n_docs >= 5").collect()) == 38


def test_lines_inserted_twice_count_once_and_filters_decide(spark):
    long = "A line that is long enough to be looked at by the operator."
    other = "Another line of more than forty characters that comes later."
    rows = [(k, f"{long}\nown {k}") for k in range(3)] + [(None, long)]
    once = line_dedup.LineIndex.empty(space(spark), min_docs=5).insert(docs_of(spark, rows))
    twice = once.insert(docs_of(spark, [*rows, (0, f"{long}\n{other}")]))
    assert rows_of(twice.refs.select("n_docs", "keeper")) == [(1, 0), (4, 2)] and twice.repeated().count() == 0
    more = twice.insert(docs_of(spark, [(9, long)]))
    assert rows_of(more.repeated().select("doc_id")) == [(None,), (0,), (1,), (2,)]
    import dataclasses

    unasked = dataclasses.replace(more, filters=more.filters.limit(0))
    assert unasked.repeated().count() == 0  # no line comes to the exact counts but through the filters
    assert rows_of(more.delete(docs_of(spark, [(9, "")])).repeated()) == []


# 2


def test_licenses(spark):
    texts = [
        "Some words.\nLicensed under the Apache License, Version 2.0.\nmore", "x\nAll rights reserved.", "the licensed driver had permission",
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0.", "this work is licensed under the GNU general public license version 3",
        "This work is licensed under the GNU General Public License, version 2.", LONG + "end. Released under the MIT License. " + LONG, None, "",
    ]
    found = rows_of(licenses.scan_licenses(docs_of(spark, list(enumerate(texts)))).select("doc_id", "license", "exact", "start", "end"))
    assert [(r[0], r[1], r[2]) for r in found] == [
        (0, "Apache-2.0", True), (1, "Proprietary", True), (3, "CC-BY-NC-4.0", True), (5, "GPL-3.0", True), (6, "GPL-2.0", True), (7, "MIT", True)
    ]
    assert texts[0][found[0][3] : found[0][4]] == "Licensed under the Apache License, Version 2.0."
    assert texts[7][found[5][3] : found[5][4]] == "Released under the MIT License."
    for _, text in licenses.TEMPLATES:
        name, gain, missing, extra = licenses.identify(text, licenses.TEMPLATES, 0.15, 0.25)
        assert (text in [t for n, t in licenses.TEMPLATES if n == name]) and not missing and not extra and gain > 0.3
    assert licenses.identify("Licensed under the GNU General Public License version 2", licenses.TEMPLATES, 0.15, 0.25)[0] == "GPL-2.0"
    assert licenses.scan_licenses(docs_of(spark, EDGE).limit(0)).count() == 0 and licenses.scan_licenses(docs_of(spark, EDGE)).count() == 0


def test_licenses_over_lines_and_beside_other_words(spark):
    import textwrap

    held = dict(licenses.TEMPLATES)
    wrapped = lambda text, sign, width: "\n".join(sign + x for x in textwrap.wrap(text, width))
    whole = lambda name, start: next(t for n, t in licenses.TEMPLATES[::-1] if n == name and t.startswith(start))
    texts = [
        wrapped(whole("MIT", "Permission"), " * ", 78), wrapped(whole("BSD-3-Clause", "Redist"), "# ", 70), wrapped(whole("GPL-3.0", "This program"), "// ", 60),
        "Copyright 2020 The Foo Authors. Licensed under the Apache License, Version 2.0.", "See http://a.org/v1.1 first. Released under the MIT License. All rights reserved.",
        "x = 1  # SPDX-License-Identifier: MIT OR Apache-2.0", "Licensed under the Apache License,\n# Version 2.0, see below", LINE, "Licensed under the Apache License, Version 1.1.",
        "This work is licensed under the GNU Library General Public License, version 2.", "All rights reserved. All rights reserved.",
    ]
    found = rows_of(licenses.scan_licenses(docs_of(spark, list(enumerate(texts)))).select("doc_id", "start", "end", "license", "exact"))
    assert [(r[0], r[3]) for r in found] == [
        (0, "MIT"), (1, "BSD-3-Clause"), (2, "GPL-3.0"), (3, "Apache-2.0"), (4, "MIT"), (4, "Proprietary"), (5, "MIT"), (5, "Apache-2.0"), (6, "Apache-2.0"),
        (10, "Proprietary"), (10, "Proprietary"),
    ] and all(r[4] for r in found) and "SPDX-License-Identifier: MIT" in held.values()
    assert texts[3][found[3][1] : found[3][2]] == "Licensed under the Apache License, Version 2.0."
    assert (found[0][1], found[0][2]) == (3, len(texts[0]))
    far = "\n".join([LINE] * 2000)
    one = rows_of(licenses.scan_licenses(docs_of(spark, [(1, f"{far}\n{texts[0]}\n{far}")])).select("start", "end", "license"))
    assert one == [(len(far) + 4, len(far) + 1 + len(texts[0]), "MIT")]


def test_saved_bytes_decide_between_wordings_that_both_pass(spark):
    shared = "Anyone who got a copy of these recipes can cook, share and sell what they describe as long as the name of the {} stays on the {} and nobody is told that the {} did it alone"
    ours = (("House", shared.format("kitchen", "label", "cook")), ("Garden", shared.format("gardener", "basket", "weather")))
    text = shared.format("gardener", "basket", "cook")
    for templates in (ours, ours[::-1]):
        known = licenses.index(templates)[0]
        block = licenses.wording(text)
        assert all(licenses.worded(k, block, [], 0.25) for k in known)  # the wording alone would take either
        found = rows_of(licenses.scan_licenses(docs_of(spark, [(1, f"{LINE}\n{text}.\n{LINE}"), (2, LINE)]), templates).select("doc_id", "license", "missing", "extra"))
        assert found == [(1, "Garden", "weather", "cook")]


def test_ranking_matches_brute_force():
    import zstandard

    rng = np.random.default_rng(3)
    options = {"level": 19, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    tried = 0
    for _, text in licenses.TEMPLATES:
        words = text.split()
        for _ in range(2):
            changed = list(words)
            if len(words) > 8:
                changed.insert(int(rng.integers(2, len(words) - 2)), "indeed")
            block = " ".join(changed).rstrip("/.")
            raw = block.lower().encode()
            ranked = []
            for k, (name, template) in enumerate(licenses.TEMPLATES):
                alone = len(zstandard.ZstdCompressor(**options).compress(raw))
                held = zstandard.ZstdCompressionDict(template.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                saved = alone - len(zstandard.ZstdCompressor(dict_data=held, **options).compress(raw))
                tag = template.startswith("SPDX")
                differing = licenses.worded(licenses.index(licenses.TEMPLATES)[0][k], licenses.wording(block), [], 0 if tag else 0.25)
                if saved >= 0.15 * alone and differing is not None and tag == block.startswith("SPDX"):
                    ranked.append((-saved, len(differing[0]) + len(differing[1]), k, name, saved / alone))
            found = [n for n in licenses.notices(block, licenses.TEMPLATES, 0.15, 0.25) if n[1] - n[0] == len(block)]
            assert [(n[2], n[3]) for n in found] == [x[3:] for x in sorted(ranked)[:1]]
            tried += len(found)
    assert tried > len(licenses.TEMPLATES)


def test_templates_without_license_words_and_of_many_pages(spark):
    pages = " ".join(f"clause{k} binds party{k % 7} from day{k} on" for k in range(400))  # some 12,000 characters
    own = (("House-1.0", "You can bake this cake at home but never sell a single slice of it"), ("Long", f"{pages} This is the whole license."))
    texts = [f"{LONG}\n{own[0][1]}.\n{LONG}", f"{LINE}\n{own[1][1]}\n{LINE}", LONG, None, ""]
    found = rows_of(licenses.scan_licenses(docs_of(spark, list(enumerate(texts))), own).select("doc_id", "license", "exact", "start"))
    assert found == [(0, "House-1.0", True, len(LONG) + 1), (1, "Long", True, len(LINE) + 1)]


# 3


def brute_vectors(rows, least=0.95):
    good = {}
    for k, (_, v) in enumerate(rows):
        if v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x = np.array(v, dtype=np.float32).astype(float)
            good[k] = x / np.linalg.norm(x)
    links = {k: {j for j in good if j != k and len(good[j]) == len(good[k]) and good[j] @ good[k] >= least} for k in good}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(links.get(k, ())), low, i is not None and i == low))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 24))
    near = [base[0] + 0.18 * rng.normal(size=24) for _ in range(90)] + [base[1] + 0.02 * rng.normal(size=24) for _ in range(20)]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate([*base, *near, *([base[2]] * 9)])]
    rows += [
        (900, None), (901, [0.0] * 24), (902, [float("nan")] + [1.0] * 23), (903, [None] + [1.0] * 23), (904, [float("inf")] * 24), (905, []),
        (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [3.0]), (None, [float(c) for c in base[3]]), (909, [float(c) for c in base[3]]), (5, rows[5][1]),
        (910, [float(c) * 1e30 for c in base[4]]),
    ]
    frame = spark.createDataFrame(
        [(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n long"
    )
    importable(spark)
    got = embedding_dedup.near_duplicates(frame, space(spark), block=16)
    assert rows_of(got) == brute_vectors(rows)
    assert embedding_dedup.near_duplicates(frame.limit(0), space(spark)).count() == 0


def test_hash_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    x = embedding_dedup.unit(rng.normal(size=(3000, 64)))
    z = rng.normal(size=x.shape)
    z = embedding_dedup.unit(z - (z * x).sum(axis=1, keepdims=True) * x)
    y = 0.95 * x + math.sqrt(1 - 0.95**2) * z
    for tables, hashes in ((6, 2), (12, 3)):
        a, b = (embedding_dedup.cells_of(v, tables, hashes, 3) for v in (x, y))
        met = (a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)
        assert met.any(axis=1).mean() > 0.99
    assert np.allclose(np.linalg.norm(embedding_dedup.hadamard(x), axis=1), 1)


# 4


def test_best_cuts_are_the_cheapest():
    rng = np.random.default_rng(2)
    for _ in range(60):
        window = int(rng.choice([8, 16, 32]))
        steps = rng.integers(1, window + 1, size=int(rng.integers(1, 14)))
        positions = [0, *map(int, np.cumsum(steps))]
        costs = [0, *map(int, rng.integers(0, 9, size=len(steps)))]
        best = [0] + [10**9] * len(steps)
        for j in range(1, len(positions)):
            for i in range(j):
                length = positions[j] - positions[i]
                if length <= window:
                    padding = 0 if length & (length - 1) == 0 else window - length
                    best[j] = min(best[j], best[i] + padding + costs[j] + packing.OPENING)
        cuts = packing.best_cuts(positions, costs, window)
        spent = 0
        for a, b in zip(cuts, cuts[1:]):
            assert 0 < b - a <= window
            spent += (0 if (b - a) & (b - a - 1) == 0 else window - (b - a)) + costs[positions.index(b)] + packing.OPENING
        assert cuts[0] == 0 and cuts[-1] == positions[-1] and spent == best[-1]


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    rows = [*EDGE, (20, "A sentence here. Another one! " * 900), (21, "it's 12 o'clock\n\n\tnow <|endoftext|>"), *((30 + k, f"doc {k}. " * k) for k in range(60))]
    ids = [(i, own.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]
    pieces = [r.asDict() for r in packing.pack_documents(docs_of(spark, rows), path).collect()]
    wanted = Counter()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    for i, own_ids in ids:
        wanted[i, len(own_ids)] += len(own_ids)
    assert {k: sum(p["length"] for p in v) for k, v in by_doc.items()} == wanted
    crcs = defaultdict(set)
    for i, own_ids in ids:
        for p in by_doc[i, len(own_ids)]:
            part = np.array(own_ids[p["start"] : p["start"] + p["length"]], dtype="<u4")
            crcs[i, p["start"], p["length"]].add(zlib.crc32(part.tobytes()))
    assert all(p["ids_crc32"] in crcs[p["doc_id"], p["start"], p["length"]] for p in pieces)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    padding = total = 0
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.02 * total
    assert packing.pack_documents(docs_of(spark, EDGE).limit(0), path).count() == 0


# 5


def brute_jaccard(rows, size, percent):
    sets = []
    for _, t in rows:
        words = [ascii_lower(w) for w in WORD.findall(t or "")]
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return sorted(((i, len(sets[k]), low.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("frequent, block", [(32, 512), (3, 8), (2, 4)])
def test_jaccard_matches_brute_force(spark, monkeypatch, frequent, block):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "HOT", 4 if frequent < 32 else 4096)
    rng = np.random.default_rng(frequent)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: [str(w) for w in rng.choice(vocabulary, size=n)]
    rows = list(EDGE)
    passage = text(60)
    for g in range(6):  # groups of near copies, more or less edited
        base = text(int(rng.integers(20, 160)))
        for k in range(12):
            words = list(base)
            for _ in range(int(rng.integers(0, 1 + len(words) // 25))):
                words[int(rng.integers(len(words)))] = str(rng.choice(vocabulary))
            rows.append((1000 + 100 * g + k, " ".join(words)))
    for k in range(30):  # texts that share a passage only, and short ones
        rows.append((3000 + k, " ".join(text(int(rng.integers(20, 200))) + passage)))
        rows.append((4000 + k, " ".join(text(int(rng.integers(1, 7))))))
        rows.append((5000 + k, " ".join(passage[: 20 + k])))
    docs = docs_of(spark, rows)
    for size, percent in ((4, 85), (5, 80)):
        assert rows_of(ngram_join.jaccard_components(docs, space(spark), size, percent, block)) == brute_jaccard(rows, size, percent)


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(8)
    words = [bytes(rng.integers(65, 123, size=int(rng.integers(1, 30)), dtype=np.uint8)) for _ in range(400)]
    texts = [b" ".join(words), b"", b" \n ", b"x" * 500, b" a\tB  c\n", b" ".join(words[:90]).lower()]
    whole = shingle_sets(texts, 4)
    for chunk in (1, 7, 64, 500):
        monkeypatch.setattr(shingles, "CHUNK", chunk)
        assert [s.tolist() for s in shingle_sets(texts, 4)] == [s.tolist() for s in whole]
    assert [len(s) for s in whole[1:5]] == [0, 0, 1, 1]


def test_jaccard_of_an_empty_table(spark):
    assert ngram_join.jaccard_components(docs_of(spark, EDGE).limit(0), space(spark)).count() == 0


# 6


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def test_mix_meets_the_targets(spark):
    rows = [(k, "w " * (k % 50)) for k in range(300)] + EDGE
    docs = docs_of(spark, rows).withColumn("source", F.when(F.col("doc_id") < 200, F.lit("a")).when(F.col("doc_id") < 250, F.col("source")))
    got = [r.asDict() for r in mixing.mix_sources(docs, space(spark), rows_per_range=16).collect()]
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    wanted = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(wanted[s]) and taken[s] == math.floor(target[s])
    again = mixing.mix_sources(docs.repartition(7), space(spark), rows_per_range=16)
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in again.collect())
    assert mixing.mix_sources(docs.limit(0), space(spark)).count() == 0


def test_mixed_documents(spark):
    rows = [(k, f"one  two\nthree{k} " + "w " * k) for k in range(80)] + EDGE
    docs = docs_of(spark, rows)
    mixed = mixing.repeat_taken(docs, space(spark))
    assert mixed.columns == docs.columns
    sizes = {s: n for s, n in docs.groupBy("source").agg(F.sum(mixing.word_count(F.col("text")))).collect()}
    held = {s: n for s, n in mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text")))).collect()}
    for s, target in brute_targets(sizes).items():
        assert math.floor(target) - 2 <= held[s] <= math.floor(target)  # equal rows share whole words
    texts = {(i, t) for i, t in rows}
    for r in mixed.collect():
        assert (r["doc_id"], r["text"]) in texts or any(i == r["doc_id"] and t and t.startswith(r["text"]) for i, t in rows)


# 7


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_matches_edit_distance():
    rng = np.random.default_rng(8)
    terms = tuple(
        toxicity.Term(t, b, 5.0 + k) for k, (t, b) in enumerate([("idiot", False), ("worthless", False), ("scum", False), ("lostra", True), ("abcabc", True)])
    )
    matcher = toxicity.TrieAutomaton(terms)
    letters = "idotwrhlescumarbx"
    words = ["".join(rng.choice(list(letters), size=int(rng.integers(1, 11)))) for _ in range(2000)] + ["", "idiot", "id1ot", "wortless", "vorthles", "lostraan", "lostran", "scun"]
    for t in terms:
        for _ in range(200):
            w = list(t.text)
            for _ in range(int(rng.integers(0, 4))):
                at = int(rng.integers(0, len(w) + 1))
                w[at : at + int(rng.integers(0, 2))] = list(rng.choice(list(letters), size=int(rng.integers(0, 2))))
            words.append("".join(w))
    for word in words:
        found = []
        for k, t in enumerate(terms):
            ends = range(len(word) + 1) if t.beginning else [len(word)]
            spent = min(edit_distance(t.text, word[:e]) for e in ends)
            if spent <= t.allowed:
                found.append((spent, -t.weight, k))
        best = min(found, default=None)
        assert matcher.match(word) == (None if best is None else (best[2], best[0])), word


def test_quotation_window():
    words = 'he said "you idiot" to them and left in the end idiot'.split()
    assert toxicity.quotation(words, words.index('idiot"')) and not toxicity.quotation(words, len(words) - 1)


def test_toxicity_on_held_out_documents(spark):
    from pyspark.sql import Row

    rng = np.random.default_rng(4)
    clean = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(600):
        words = [str(w) for w in rng.choice(clean, size=40)]
        toxic = int(k % 5 == 0)
        if toxic:
            words[int(rng.integers(40))] = str(rng.choice(["grumbler", "grumblar", "blargon", "snorfed", "snorfing"]))
        rows.append((k, " ".join(words)))
        labels.append(Row(doc_id=k, toxic=toxic, quality=1))
    docs = docs_of(spark, rows + [(None, None), (None, "grumbler"), (7000, ""), (7001, LONG)])
    model = toxicity.train(docs, spark.createDataFrame([*labels, Row(doc_id=None, toxic=1, quality=1)]), space(spark))
    got = toxicity.score(docs, model).collect()
    assert len(got) == 604 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"]]
    assert held and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    truth = {k: int(k % 5 == 0) for k in range(600)}
    assert np.mean([truth[r["doc_id"]] == r["predicted"] for r in held if r["doc_id"] in truth]) > 0.97
    assert docs.count() - toxicity.drop_toxic(docs, model).count() == sum(r["predicted"] for r in got)
    nothing = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"), space(spark))
    assert {r["predicted"] for r in toxicity.score(docs, nothing).collect()} == {0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_rare_terms_of_many_labels_and_variants_of_short_ones(spark):
    from pyspark.sql import Row

    rng = np.random.default_rng(9)
    ordinary = [f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{k}" for k in range(400)]
    rows = []
    for k in range(4000):
        words = [str(w) for w in rng.choice(ordinary, size=30)]
        if k % 4 == 0:  # 1000 toxic ones: a common term, a rarer one in 1 %, both short terms and a word of one copied text
            words[3] = "vlorping" if k % 400 == 0 else str(rng.choice(["scum", "grumbler", "blargon"]))
        rows.append([k, " ".join(words)])
    copied = rows[8][1].split()
    for k in range(8, 72, 8):
        rows[k][1] = " ".join([*copied[:20], "koprahaus", *copied[20:], ordinary[k]])
    for k in range(1, 400, 16):
        rows[k][1] += " swum"
    docs = docs_of(spark, [tuple(r) for r in rows])
    model = toxicity.train(docs, spark.createDataFrame([Row(doc_id=k, toxic=int(k % 4 == 0)) for k, _ in rows]), space(spark))
    held = {t.text for t in model.terms}
    assert {"scum", "grumbler", "blargon", "vlorping"} <= held and "koprahaus" not in held
    rest = " ".join(ordinary[:20])
    tried = [(9000, f"{rest} skum {rest}"), (9001, f"{rest} vlorpink {rest}"), (9002, f"{rest} swum {rest}"), (9003, f"{rest} drum sum {rest}")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs_of(spark, tried), model).collect()}
    nothing = toxicity.score(docs_of(spark, [(1, rest)]), model).first()["score"]
    assert got[9000] > nothing and got[9001] > nothing and got[9002] == got[9003] == nothing


# 8


def spans_by_brute_force(rows, min_words):
    """(doc_id, start, end, n_units, n_words): runs of repeated units, walked on word by word beside their kept occurrences."""
    words = {r: [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"\S+", r[1] or "")] for r in set(rows)}
    rank = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    units, first = {}, {}
    for r in sorted(words, key=rank):
        at, units[r] = 0, []
        for _, _, n, *_ in substring_dedup.units_of(r[1] or ""):
            unit = (at, at + n, " ".join(w for w, _, _ in words[r][at : at + n]))
            units[r].append(unit)
            first.setdefault(unit[2], (r, at, at + n))
            at += n
        assert at == len(words[r])
    found = []
    for r, own in words.items():
        runs = []
        for k, (a, b, text) in enumerate(units[r]):
            if first[text] != (r, a, b):
                if runs and runs[-1][-1][0] == k - 1:
                    runs[-1].append((k, a, b, first[text]))
                else:
                    runs.append([(k, a, b, first[text])])
        reached = []
        for run in runs:
            (_, low, _, (r1, p1, _)), (_, _, high, (r2, _, p2)) = run[0], run[-1]
            if high - low >= substring_dedup.ANCHOR:
                while low > 0 and p1 > 0 and own[low - 1][0] == words[r1][p1 - 1][0]:
                    low, p1 = low - 1, p1 - 1
                while high < len(own) and p2 < len(words[r2]) and own[high][0] == words[r2][p2][0]:
                    high, p2 = high + 1, p2 + 1
            reached.append((low, high, len(run)))
        islands = []
        for low, high, n in sorted(reached):
            if islands and low <= islands[-1][1]:
                islands[-1] = (islands[-1][0], max(high, islands[-1][1]), islands[-1][2] + n)
            else:
                islands.append((low, high, n))
        found += [(r[0], own[a][1], own[b - 1][2], n, b - a) for a, b, n in islands if b - a >= min_words]
    return sorted(found, key=lambda r: tuple((x is not None, x) for x in r))


def test_substrings_match_brute_force(spark):
    passage = "The first sentence of a passage is here and goes on for long. Its second one follows, of as many words as the first had! A third."
    rows = [
        (1, f"Start of one.\n{passage}\nEnd of one."), (2, f"Start of two. {passage} End of two."), (3, passage.upper().replace(" ", "  ")),
        (4, "Nothing in common."), (5, "A third."), (6, None), (7, ""), (8, f"{passage}\n{passage}"), (8, "other"), (None, passage), (9, LONG), (9, LONG),
    ]
    docs = docs_of(spark, rows)
    spans = substring_dedup.repeated_spans(docs, space(spark), min_words=10)
    got = rows_of(spans.select("doc_id", "start", "end", "n_units", "n_words"))
    assert got == spans_by_brute_force(rows, 10) and len(got) >= 4
    left = {(r["doc_id"], r["text"]) for r in substring_dedup.remove_spans(docs, spans).collect()}
    assert (2, "Start of two.  End of two.") in left and (None, passage) in left and (4, "Nothing in common.") in left
    assert substring_dedup.repeated_spans(docs.limit(0), space(spark)).count() == 0
    for _, t in rows:
        for a, b, *_ in substring_dedup.units_of(t or ""):
            assert t[a:b] == t[a:b].strip() != ""


def test_extensions_match_brute_force(spark):
    """Passages glued into other texts at any word, wrapped anew, of short sentences, and one word over and over."""
    rng = np.random.default_rng(11)
    some = lambda n: [f"w{k}" for k in rng.integers(0, 5000, size=n)]
    ends = lambda words, often: [w + ". " if rng.random() < often else w + " " for w in words]
    passages = [ends(some(int(n)), p) for n, p in zip(rng.integers(20, 700, size=12), [0.1, 0.0, 0.5, 0.25] * 3)]
    passages.append(["over "] * 300)
    rows = []
    for k in range(60):
        p = passages[k % len(passages)]
        a = int(rng.integers(0, len(p) // 3))
        b = len(p) - int(rng.integers(0, len(p) // 3))
        middle = "".join(p[a:b])
        rows.append((k, "".join(ends(some(int(rng.integers(0, 60))), 0.1)) + (middle.replace(" ", "\n", 7) if k % 5 == 4 else middle) + "".join(ends(some(30), 0.1))))
    spans = substring_dedup.repeated_spans(docs_of(spark, rows), space(spark), min_words=25)
    got = rows_of(spans.select("doc_id", "start", "end", "n_units", "n_words"))
    assert got == spans_by_brute_force(rows, 25) and len(got) >= 40
    assert max(r[4] for r in got) > 300


def test_substrings_glued_to_other_text(spark):
    inner = "it goes on from there for a while. A middle sentence stands whole in both of them! And then the last one runs"
    endless = " ".join(f"clause{k}" for k in range(60))
    rows = [
        (1, f"Some words lead into the passage {inner} into other words at its end."), (2, f"Elsewhere, quite another start: {inner} against a wall.\nMore."),
        (3, f"one two three {endless} four five six"), (4, f"alpha beta {endless} gamma"), (5, "A middle sentence stands whole in both of them! But nothing else."),
    ]
    docs = docs_of(spark, rows)
    spans = {r["doc_id"]: r for r in substring_dedup.repeated_spans(docs, space(spark), min_words=20).collect()}
    texts = dict(rows)
    cut = {i: texts[i][r["start"] : r["end"]] for i, r in spans.items()}
    assert cut == {2: inner, 4: endless} and (spans[2]["n_words"], spans[2]["kept_doc_id"]) == (len(inner.split()), 1)
    assert (spans[4]["n_words"], spans[4]["kept_doc_id"]) == (60, 3)


# 9


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {p + d for p, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_verdicts(spark):
    rng = np.random.default_rng(6)
    text = lambda n, v: " ".join(f"w{k}" for k in rng.integers(0, v, size=n))
    rows = [*EDGE, *((100 + k, text(60 + k % 50, 30 + 20 * (k % 9))) for k in range(200)), (400, "a b c " * 40), (401, "| # " * 100), (402, "a b"), (403, "a\n \na\na b\n" * 30)]
    rows += [(500, text(80, 5000) + " ### $$$ " * 30)]
    got = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in quality.judge(docs_of(spark, rows), space(spark), least_docs=20).collect()}
    for i, t in rows:
        n, chars, symbols, lines, repeats = brute_counts(t)
        r = got[i, n, chars]
        assert (r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (symbols, lines, repeats)
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n) and not (r["base_failed"] and r["kept"])
    assert not any(r["kept"] for (i, *_), r in got.items() if i == 500)
    plain = [r["kept"] for (i, *_), r in got.items() if i and 100 <= i < 300 and not r["base_failed"]]
    assert len(plain) > 100 and np.mean(plain) > 0.95
    assert quality.judge(docs_of(spark, rows).limit(0), space(spark)).count() == 0


def test_quality_thresholds_follow_the_group_and_every_rule_fires(spark):
    rng = np.random.default_rng(7)

    def text(n, capitals, extra=()):
        words = [f"w{k}x" for k in rng.integers(0, 10**6, size=n)]
        for k in rng.integers(0, n, size=capitals):
            words[k] = words[k].upper()
        return " ".join([*words, *extra])

    rows = []
    for k in range(400):  # a source that writes capitals now and then, and one that often does
        rows.append((k, text(100, int(rng.integers(0, 5))), "en", "quiet"))
        rows.append((1000 + k, text(100, int(rng.integers(0, 60))), "en", "loud"))
    line = text(12, 0)
    junk = {
        "symbols": text(80, 0, ["#*$"] * 20 + ["%&"] * 10), "marks": text(80, 0, ["!?!?"] * 30), "capitals": text(100, 0).upper(),
        "lines": "\n".join([text(60, 0)] + [f"ab{k} " + "a" for k in range(3)] + ["x"] * 8), "repeats": text(100, 0, [*line.split(), *line.split(), *line.split()]),
    }
    rows += [(5000 + k, t, "en", source) for k, t in enumerate(junk.values()) for source in ("quiet",)]
    importable(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    values = quality.measures(docs)
    valued = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.expr(f"double({r.value})").alias("value")) for r in quality.RULES])
    sketch = quality.sketches(values.select("lang", "source", F.inline(valued)), ["lang", "source"])
    limits = {(r["source"], r["rule"]): r["threshold"] for r in quality.thresholds(sketch, quality.RULES, 100).collect()}
    assert limits["loud", "capitals"] > 3 * limits["quiet", "capitals"]
    got = {r["doc_id"]: r for r in quality.judge(docs, space(spark)).collect()}
    assert all(got[5000 + k]["n_broken"] >= 1 for k in range(len(junk))), [(n, got[5000 + k]) for k, n in enumerate(junk)]
    assert sum(r["kept"] for i, r in got.items() if i < 5000) > 0.99 * 800


# 10


def brute_base(text):
    found = []
    pattern = r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found += [(m.start(), 0, m.end(), "assign") for m in re.finditer(pattern, text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_secrets(spark):
    digits = "0123456789abcdef" * 2
    texts = [
        f'token = "{digits}" and AKIA{"A1" * 9}', "PassWord: hunter2x", "password=abc", f"x{digits}x AKIAAKIA12", None, "", "no ſecret: abcdefgh",
        'key = "Zx81kQ99plm"\nprivate_key = key\n', "DB_PWD := `qwe7-RTY8-uio9`", '{"client_credential": "aZ3-bY4-cX5-dW6"}', "name: value and more",
        "auth_token == 'a1B2c3D4e5F6'", "api_key: your-key-here", f"é🙂 api_key='{digits}'", LONG + "secret=abcdef123", 'a_secret = "ab1-cd2" + "EF3-gh4x"',
    ]
    got = {r["doc_id"]: r for r in secrets.scan_secrets(docs_of(spark, list(enumerate(texts)))).collect()}
    for k, t in enumerate(texts):
        assert got[k]["base_spans"] == brute_base(t or "")
        counts = Counter(x.split(":")[0] for x in got[k]["spans"].split(",") if x)
        assert [got[k][c] for c in ("n_assign", "n_access", "n_hex")] == [counts[c] for c in ("assign", "access", "hex")]
        assert set(filter(None, got[k]["base_spans"].split(","))) <= set(got[k]["spans"].split(","))
    named = {k: [texts[k][int(a) : int(b)] for kind, a, b in (x.split(":") for x in r["spans"].split(",") if x) if kind == "named"] for k, r in got.items()}
    assert named[7] == ["Zx81kQ99plm"] and named[8] == ["qwe7-RTY8-uio9"] and named[9] == ["aZ3-bY4-cX5-dW6"]
    assert not any(named[k] for k in (1, 4, 5, 10, 11, 14))
    assert secrets.scan_secrets(docs_of(spark, EDGE).limit(0)).count() == 0


def test_plain_secrets_of_sensitive_names(spark):
    texts = [
        "db_pwd = 'correcthorsebattery'", "credential: 'QWERTYUIOPASDFGH'", "pwd='8361940275'", "passphrase = 'four plain words here'",
        "word = 'correcthorsebattery'\nDbPwd := word", "DB_PWD=correcthorsebattery\nx=1", '{"private_key": "qwertyuiopasdf"}', 'user_password: "correct horse, battery staple"',
        'passphrase_hint = "four plain words here"', 'pwd_label: "Enter your password"', "pwd: 'changeme'", "credential = 'string'", "pwd = getcwd()", "title = 'four plain words here'",
        "passphrase: 'Please type it twice'", "pwd = '******'", "f(pwd=current, x=1)", "db_pwd == 'correcthorsebattery'", "pwd = 'short'", "passphrase = 'Wrong passphrase given'",
    ]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs_of(spark, list(enumerate(texts)))).collect()}
    named = [[texts[k][int(a) : int(b)] for kind, a, b in (x.split(":") for x in got[k].split(",") if x) if kind == "named"] for k in range(len(texts))]
    assert named[:8] == [
        ["correcthorsebattery"], ["QWERTYUIOPASDFGH"], ["8361940275"], ["four plain words here"], ["correcthorsebattery"], ["correcthorsebattery"], ["qwertyuiopasdf"],
        ["correct horse, battery staple"],
    ] and not any(named[8:])
