"""Spelling variants, best-fit packing and conversation repair against brute force, with the cases that docstrings define."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from test_llm_operators import EDGE, LONG, docs_of, edit_distance, space

from actuaria.llm import best_fit, conversations, queries, spelling, substring_dedup
from actuaria.llm.common import importable

# 8: offsets


def test_spans_far_into_long_texts(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}x" for k in range(3000)]
    filler = lambda n: " ".join(str(w) for w in rng.choice(words, size=n))
    passage = ". ".join(filler(9) for _ in range(7)) + "."
    rows = [(0, f"{filler(40)}. {passage} {filler(30)}")]
    for k, at in enumerate((3990, 4010, 20_000, 50_000), 1):
        before = filler(at // 4)[:at]
        rows.append((k, f"{before} {passage} {filler(50)}"))
    docs = docs_of(spark, rows)
    texts = dict(rows)
    spans = substring_dedup.repeated_spans(docs, space(spark)).collect()
    assert {r["doc_id"] for r in spans} == {1, 2, 3, 4}
    for r in spans:
        assert 0 <= r["start"] < r["end"] <= len(texts[r["doc_id"]])
        assert len(texts[r["doc_id"]][r["start"] : r["end"]].split()) == r["n_words"]
    assert all(passage not in r["text"] for r in substring_dedup.remove_spans(docs, substring_dedup.repeated_spans(docs, space(spark))).collect() if r["doc_id"])


# 11


def near(a, b):
    """Whether b is a with exactly one code point inserted, deleted or replaced."""
    return a != b and abs(len(a) - len(b)) < 2 and edit_distance(a, b) == 1


def brute_variants(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        others = [o for o in counts if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        out[w] = [best if best and counts[best] >= ratio * n else None, None, n, len(others)]
    for w in out:
        last = w
        while out[last][0]:
            last = out[last][0]
        out[w][1] = last
    return {(w, f, r, n, k, counts[f] if f else None) for w, (f, r, n, k) in out.items()}


def random_counts(rng, n, alphabet, low, high):
    words = {"".join(rng.choice(list(alphabet), size=int(rng.integers(low, high)))) for _ in range(n)}
    for w in list(words)[: n // 2]:
        at = int(rng.integers(0, len(w)))
        words |= {w[:at] + w[at + 1 :], w[:at] + "é" + w[at:], w[:at] + "z" + w[at + 1 :]}
    return {w: int(10 ** rng.uniform(0.4, 5)) for w in words if w}


@pytest.mark.parametrize("hot", [2, 32])
@pytest.mark.parametrize("alphabet,low,high", [("ab", 3, 9), ("abcdeé", 6, 10), ("aà", 1, 4)])
def test_variants_match_brute_force(spark, hot, alphabet, low, high):
    counts = random_counts(np.random.default_rng(len(alphabet) + hot), 150, alphabet, low, high)
    df = spark.createDataFrame([(w, n, 1) for w, n in counts.items()] + [(None, 5, 1)], "word string, n long, sig int").repartition(3)
    importable(spark)
    got = {tuple(r) for r in spelling.variants(df, space(spark), hot=hot).collect()}
    assert got == brute_variants(counts)


def test_signatures_meet_for_near_words():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = "".join(rng.choice(list("abcdé"), size=int(rng.integers(1, 12))))
        at, letter = int(rng.integers(0, len(a))), str(rng.choice(list("abcdé")))
        for b in (a[:at] + letter + a[at:], a[:at] + a[at + 1 :], a[:at] + letter + a[at + 1 :]):
            if b:
                found = [v for v, _ in spelling.signatures_of([a, b])]
                assert {v[0] for v in found} & {v[1] for v in found}, (a, b)


def test_words_of_documents(spark):
    text = "Lettering lettering LETTERING letteringÀ abc÷defgh ßtraßen-lettering9lettering"
    rows = [(k, text) for k in range(40)] + [(7, text), *EDGE, (500, "a" * 70_000 + "b"), (501, "a" * 70_000 + "b")]
    docs = docs_of(spark, rows)
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    wanted = {w: n for w, n in counts.items() if n >= 2}
    got = {tuple(r) for r in spelling.spelling_variants(docs, space(spark)).collect()}
    assert got == brute_variants(wanted) and any(len(w) > 7 and f for w, f, *_ in got)
    assert spelling.spelling_variants(docs.limit(0), space(spark)).count() == 0


def test_forms_are_followed_to_the_last(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20_000, "abcdefghijkl": 200_000}
    importable(spark)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r["root"] for r in spelling.variants(df, space(spark)).collect()} == {"abcdefghijkl"}


# 12

WORDS = public_tokenizers.path("word_bpe_49k.json")


OWN = Tokenizer.from_file(WORDS)


def own_ids(text):
    return OWN.encode(text, add_special_tokens=False).ids


def test_encoder_gives_the_tokenizer_ids():
    encode = best_fit.encoder(WORDS)
    texts = [t or "" for _, t in EDGE if t != LONG] + [
        "Σίσυφος ΟΔΟΣ İstanbul", "don't I'LL 'sx ''s we've", "abc123 ½ ² ª º µ ß Ÿ ŉ ĲŐ", "<|endoftext|> x", "a\x01b \x00 \x1c \x85 \xa0 y", "é é a̸",
        "日本語テキスト。🙂🙂 x", "  ", "!?!...x--y_z", "ſ K Å", "ÀÉÎÕÜ Straße GROẞ",
    ]
    for text in texts:
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == own_ids(text), text


def brute_best_fit(histogram, window):
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = [r for r in rooms if r >= length]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - length)
            else:
                rooms.append(window - length)
    return len(rooms)


def test_plan_is_best_fit_and_gapless():
    rng = np.random.default_rng(2)
    for _ in range(200):
        window = int(rng.choice([7, 32, 64]))
        histogram = {int(rng.integers(1, window + 1)): int(rng.integers(1, 40)) for _ in range(int(rng.integers(1, 14)))}
        used, ranks = defaultdict(int), Counter()
        for length, first, number, sequence, each, at in best_fit.plan(histogram, window):
            assert first == ranks[length]
            ranks[length] += number
            for k in range(number):
                assert used[sequence + k // each] == at + k % each * length
                used[sequence + k // each] += length
        assert ranks == histogram and max(used.values()) <= window and len(used) == brute_best_fit(histogram, window)
    assert best_fit.plan({}, 8) == []
    assert len(best_fit.plan({1: 10**12, 3: 10**12, 4096: 10**9}, 4096)) < 100


def test_best_fit_packing_round_trip(spark):
    rng = np.random.default_rng(6)
    rows = EDGE + [(1000 + k, " ".join(["tea"] * int(rng.integers(0, 60)))) for k in range(300)] + [(2000 + k, "") for k in range(9000)]
    docs = docs_of(spark, rows)
    window = 64
    got = best_fit.pack_best_fit(docs, WORDS, space(spark), window).collect()
    lengths = Counter()
    expected = Counter()
    for i, t in rows:
        ids = np.array([*own_ids(t or ""), 1], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), window)):
            part = ids[at : at + window]
            lengths[len(part)] += 1
            expected[i, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert len(held) == brute_best_fit(lengths, window)
    assert best_fit.pack_best_fit(docs.limit(0), WORDS, space(spark)).count() == 0


# 13


def cheapest(symbols):
    """(cost, audit) over all edit sequences, by a search in the order of (cost, audit)."""
    best = {}
    queue = [(0, "", 0, 0)]  # cost, audit, rows done, state
    while queue:
        cost, audit, done, state = heapq.heappop(queue)
        if done == len(symbols) and state in (0, 3):
            return cost, audit
        if best.get((done, state), (cost, audit)) < (cost, audit):
            continue
        best[done, state] = (cost, audit)
        after = 3 if state == 2 else 2
        ways = [(2, "I", done, after)]
        if done < len(symbols):
            initial, cut, gone = symbols[done]
            ways.append((3, "D", done + 1, state))
            if not gone:
                ways.append((2 + cut, "R", done + 1, after))
                if initial == "s" and state == 0:
                    ways.append((cut, "K", done + 1, 1))
                if initial == ("a" if state == 2 else "u"):
                    ways.append((cut, "K", done + 1, after))
        for more, letter, d, s in ways:
            heapq.heappush(queue, (cost + more, audit + letter, d, s))


def brute_repair(rows):
    """Per conversation all columns of the contract, from (conv_id, turn, role, text) after the damage."""
    out = {}
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups[conv].append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest(), text))
    for conv, held in groups.items():
        held.sort()
        seen, symbols, counts, illegal, last = set(), [], Counter(), 0, None
        for _, _, role, _, text in held:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            symbols.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
            illegal += last is not None and last + role[:1] not in ("su", "ua", "au")
            last = role[:1]
        cost, audit = cheapest(symbols)
        left, state, made = iter(held), 0, []
        for letter in audit:
            _, _, role, _, text = (None, None, "", None, "") if letter == "I" else next(left)
            if letter == "D":
                continue
            if letter in "IR":
                role = "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            made.append((role, text))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in made))
        turns = {t for known, t, *_ in held if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return out


def random_conversations(rng, n):
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", "User", None], ["a.", "b!", "c", " \t", "", "d?\n", None, "e.", "é", "a."]
    rows = []
    for conv in range(n):
        for turn in range(int(rng.integers(0, 12))):
            t = None if rng.random() < 0.05 else turn * int(rng.integers(1, 3))
            rows.append((conv if conv else None, t, roles[int(rng.integers(len(roles)))], texts[int(rng.integers(len(texts)))]))
    rows += [(9000, k, ["user", "assistant"][k % 2], f"text {k}.") for k in range(1500)]  # several segments
    rows += [(9001, 1, "user", "same.")] * 1200 + [(9001, 2, "assistant", "end.")] + [(9002, None, "user", "x.")] * 2
    rows += [(9003, k, "user", "again.") for k in range(30)] + [(9004, 0, "system", "only.")] + [(9005, 0, "user", "long. " * 20_000)]
    return rows


def conversation_table(spark, rows):
    importable(spark)
    full = [(*r, 1, "clash", "clash") for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, n int, digest string, audit string").repartition(4)


def test_repair_matches_brute_force(spark):
    rows = random_conversations(np.random.default_rng(12), 150)
    table, work = conversation_table(spark, rows), space(spark)
    found = work.write(conversations.repair(table, work), "r")
    hashed = {r["conv_id"]: r["repaired_sha256"] for r in conversations.digests(table, found).collect()}
    wanted = brute_repair(rows)
    got = {r["conv_id"]: (*tuple(r)[1:], hashed[r["conv_id"]]) for r in found.collect()}
    assert set(got) == set(wanted)
    for conv in wanted:
        assert got[conv] == wanted[conv], conv
    made = defaultdict(list)
    for r in conversations.repaired_rows(table, found).collect():
        made[r["conv_id"]].append((r["position"], r["role"], r["text"]))
    for conv, held in made.items():
        held.sort()
        assert [p for p, _, _ in held] == list(range(len(held)))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in held).encode()).hexdigest() == wanted[conv][-1]
    empty = table.limit(0)
    assert conversations.repair(empty, space(spark)).count() == 0


def test_grammar_matrices_are_those_of_the_rows(spark):
    rng = np.random.default_rng(3)
    strings = ["".join(rng.choice(list("suaxSUA-"), size=int(rng.integers(1, 30)))) for _ in range(60)] + ["ua" * 40] * 20 + ["-" * 33]
    importable(spark)
    grammar = conversations.repair_grammar(spark.createDataFrame([(s,) for s in strings], "symbols string"), space(spark))
    assert 3 < len(grammar.rules) <= conversations.RULES
    assert len(grammar.parse("ua" * 40)) < 10
    plain = conversations.Grammar()
    for s in strings:
        ends = []
        for g in (grammar, plain):
            vector = {conversations.BEGIN: (0, conversations.Rope(None, None, ""))}
            for symbol in g.parse(s):
                vector = conversations.advance(vector, g.matrices[symbol])
            cost, audit = conversations.finished(vector)
            ends.append((cost, audit.text))
        assert ends[0] == ends[1] == cheapest([(c.lower(), c.isupper(), c == "-") for c in s])


def test_damage_and_query(spark, tmp_path):
    rows = [r for r in random_conversations(np.random.default_rng(4), 120) if r[0] is None or r[0] < 9003]
    conversation_table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    broken, ids = [], {r[0] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            broken += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    wanted = brute_repair(broken)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: wanted.get(c, nothing) for c in ids}
