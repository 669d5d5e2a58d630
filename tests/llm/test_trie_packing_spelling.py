"""Prefix trie, cutting-stock packing and spelling variants against brute force, on small hand-made tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidewater.llm import cutting_stock, prefix_trie, spelling
from tidewater.llm.tokens import public_file

TURNS = "conv_id long, turn long, role string, text string, code string, pos string"
DOCS = "doc_id long, text string, start string, rank string"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)


def docs_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)


# ---- prefix trie ----


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c in own:
        own[c] = [(r, t) for _, _, r, t in sorted(own[c])]
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        worth = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += worth
    out = set()
    for k, m in members.items():
        ends = ",".join(str(c) for c in m if len(built[c]) == len(k))
        out.add((m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_of(spark, rows, piece):
    turns, convs = prefix_trie.with_borrowed_heads(prefix_trie.number_turns(turns_frame(spark, rows)))
    return [tuple(r) for r in prefix_trie.prefix_trie(turns, convs, piece).collect()]


@pytest.mark.parametrize("piece", [3, 10_000])
def test_prefix_trie(spark, piece, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)  # long conversations cross blocks
    monkeypatch.setattr(prefix_trie, "ENDS", 2)
    monkeypatch.setattr(prefix_trie, "MOST_LARGE", 10_000)
    rng = random.Random(3)
    rows = []
    for c in range(60):
        for t in range(rng.choice([1, 2, 4, 9, 12])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a", "é b", "", "long " * 5]) if t > 1 else "same"))
    rows += [(100, t, "user", "deep") for t in range(70)] + [(105, t, "user", "deep") for t in range(70)]
    rows += [(7, 0, "user", "again"), (7, 0, "user", "again"), (8, None, None, None), (8, None, "user", None), (9, 3, "", "x")]
    rows += [(None, 0, "user", "nobody"), (203, 0, "user", "no base"), (204, 0, "user", "no base")]
    got = trie_of(spark, rows, piece)
    assert len(got) == len(set(got)) and set(got) == brute_trie(rows)


def test_prefix_trie_small_cases(spark):
    assert trie_of(spark, [], 10) == []
    assert trie_of(spark, [(None, 1, "user", "x")], 10) == []
    turnless = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:2]
    rows = [(c, 0, "user", "x") for c in turnless if c - c % 5 not in turnless]
    got = trie_of(spark, rows, 10)
    assert set(got) == brute_trie(rows) and [g[1] for g in got] == [0]


def test_subtree_totals_of_a_forest(spark):
    """Several trees whose nodes carry values of their own."""
    rng = random.Random(4)
    paths, value = {}, {}
    for c in range(40):  # conversation c leaves conversation p's path after k turns
        p = rng.randrange(c) if c > 3 else None
        k = rng.randint(1, len(paths[p])) if p is not None else 0
        paths[c] = (paths[p][:k] if k else []) + [c] * rng.randint(1, 12)
    for c, path in paths.items():
        for d, owner in enumerate(path):
            if owner == c:
                value[c, d] = rng.randint(0, 9)
    total, below = Counter(), Counter()
    for c, path in paths.items():
        for d, owner in enumerate(path):
            below[owner, d] += len(path) - d
            if owner == c:
                for e in range(d + 1):
                    total[path[e], e] += value[c, d]
    nodes = [(c, d, paths[c][d - 1] if d else None, below[c, d], value[c, d]) for c, d in value]
    lines = [(c, d, o, path[d - 1] if d else None) for c, path in paths.items() for d, o in enumerate(path)]
    nodes = spark.createDataFrame(nodes, "conv_id long, depth long, parent long, below long, v long")
    lines = spark.createDataFrame(lines, "conv_id long, depth long, node long, up long")
    for piece in (4, 1000):
        got = prefix_trie.subtree_totals(nodes, lines, ["v"], piece).collect()
        assert len(got) == len(value) and {(r.conv_id, r.depth): r.sum_v for r in got} == {k: total[k] for k in value}


# ---- cutting stock ----


def check_packing(spark, rows, capacity):
    path = public_file("byte_bpe_50k.json")
    got = cutting_stock.pack_padded(docs_frame(spark, rows), path, capacity).collect()
    plain = Tokenizer.from_file(path)
    want = Counter()
    for doc, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        want[doc, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
    # pieces: every id once, checksums right (documents are told apart by id here, copies by their multiplicity)
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    texts = defaultdict(list)
    for doc, text in rows:
        texts[doc].append(np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4"))
    for doc, all_ids in texts.items():
        assert sum(r.length for r in by_doc[doc]) == sum(map(len, all_ids))
        for r in by_doc[doc]:
            assert any(len(i) == r.doc_tokens and zlib.crc32(i[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for i in all_ids)
        if len(all_ids) == 1:
            at = 0
            for r in sorted(by_doc[doc], key=lambda r: r.start):
                assert r.start == at
                at += r.length
    fill, ends = defaultdict(list), {}
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for s, parts in fill.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += cutting_stock.padded(at, capacity) - at
    assert padding == 0
    return got


def test_pack_padded(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "ü", "7"]) for _ in range(rng.choice([0, 3, 20, 60, 200])))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "no id"), (None, "no id"), (502, "same"), (502, "same"), (502, "other one"), (503, "a <|endoftext|> b")]
    got = check_packing(spark, rows, 64)
    cut = sum(1 for r in got if r.length < 64 and r.length < r.doc_tokens % 64)
    assert cut < 40  # most rests are whole


def test_pack_padded_where_no_pattern_fits(spark):
    """One length that fills no sequence: everything is laid end to end and cut."""
    got = check_packing(spark, [(i, "word " * 38) for i in range(41)] + [(None, "word " * 38)] * 2, 64)
    assert len({r.sequence_id for r in got}) <= 43 * 40 // 64 + 8
    assert check_packing(spark, [], 64) == []


def test_plan_places_every_piece():
    rng = random.Random(8)
    for capacity in (16, 64):
        for n in (1, 5, 200):
            counts = Counter(rng.randint(1, capacity - 1) for _ in range(n))
            patterns, loose = cutting_stock.plan(list(counts), list(counts.values()), capacity)
            placed = Counter()
            for used, many in patterns:
                assert cutting_stock.padded(sum(used), capacity) == sum(used) <= capacity
                for size in used:
                    placed[size] += many
            for size, many in loose:
                placed[size] += many
            assert placed == counts


def test_patterns_reach_the_optimum():
    """Where exact patterns exist for everything, nothing is left loose."""
    patterns, loose = cutting_stock.plan([700, 324, 512, 100, 412], [50, 50, 4, 30, 30], 1024)
    assert not loose and sum(many for _, many in patterns) <= 50 + 4 + 30
    sizes, demand = np.array([3, 5, 7, 9, 13]), np.array([46.0, 6.0, 30.0, 30.0, 40.0])
    solved, left = cutting_stock.solve_patterns(sizes, demand, 16)
    assert left < 1e-2 * (sizes @ demand)
    covered = sum(c * x for c, x in solved)
    assert (np.abs(covered - demand) < 0.1).all()


# ---- spelling variants ----


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(n):
    near = {w: sorted(v for v in n if one_edit(w, v)) for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def brute_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            n[w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def test_spelling_groups(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    words = set(base) | {"aaaaa", "aaaaaa", "aaaaaaa", "b" * 300, "b" * 301, "b" * 150 + "c" + "b" * 149, "ÿÿÿÿÿ", "×÷×÷×"}
    for w in base:
        for _ in range(4):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("abcé") + w[i + 1 :]]))
    n = {w: rng.choice([3, 3, 5, 6, 12, 24, 100]) for w in words if len(w) >= 5}
    got = spelling.spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    assert len(got) == len(n) and {tuple(r) for r in got} == brute_groups(n)


def test_a_third_of_the_words_share_a_node(spark):
    n = {"prefix" + a + b: 3 for a in "abcdefgh" for b in "abcdefgh"} | {"prefixab": 50, "other": 3}
    got = spelling.spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    assert {tuple(r) for r in got} == brute_groups(n)


def test_word_counts(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choice(["Straße", "straße", "HELLO", "hello", "ÉTÉété", "a", "x_yyyyyy", "naïve2naïve"]) for _ in range(30))) for i in range(80)]
    rows += [(None, "hello hello hello"), (5, None), (6, ""), (7, "123"), (7, "hello"), (7, "hello")]
    got = spelling.word_counts(docs_frame(spark, rows))
    assert {(r.word, r.n) for r in got.collect()} == set(brute_words(rows).items())
    assert spelling.spelling_groups(spelling.word_counts(docs_frame(spark, []))).count() == 0
