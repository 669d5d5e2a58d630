"""The text operators against brute force, on small hand-made tables."""

import hashlib
import os
import random
import re
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import chat, decontaminate, fingerprint, jaccard, langid, packing, substring_dedup, token_files, toxicity, warc
from tidewater.llm.common import ascii_lower
from tidewater.llm.components import components
from tidewater.llm.suffix_array import suffix_array
from tidewater.llm.tokens import PieceTokenizer, public_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
WORDS = [f"w{i}" for i in range(40)] + ["É", "ß", "Über", "The", "the"]


def rng_text(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


def documents(spark, rows):
    full = [(i, t, "en", "s", len(t or ""), "x") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def mixed():
    """Copies, near copies, shared passages, nulls, empty, short and long texts, ties."""
    rng = random.Random(5)
    base = [rng_text(rng, rng.choice([3, 12, 40, 150, 400])) for _ in range(40)]
    rows = list(enumerate(base))
    passage = rng_text(rng, 30)
    for i in range(40, 90):
        w = base[i % 40].split(" ")
        for _ in range(rng.choice([0, 1, 2, 5])):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((i, " ".join(w)))
    rows += [(i, rng_text(rng, 20) + " " + passage + " " + rng_text(rng, 20)) for i in range(90, 110)]
    rows += [(110, None), (111, ""), (112, " \n\t"), (113, "a"), (114, "a"), (115, rng_text(rng, 6000)), (116, "ñ" * 300), (117, "x" * 200)]
    return rows


# ---- 1 ----


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute_classes(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and den * len(s & t) >= num * len(s | t):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets}


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100), (2, 60, 100)])
def test_similarity_classes(spark, mixed, k, num, den, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 1)  # so that classes 2 and 3 are used on small data
    monkeypatch.setattr(jaccard, "VERY_FREQUENT", 3)
    monkeypatch.setattr(jaccard, "PAIRS_PER_POSTING", 0.5)
    got = jaccard.similarity_classes(documents(spark, mixed), k, num, den)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_classes(mixed, k, num, den)


def test_similarity_classes_cases(spark):
    rows = [(7, "a b c d"), (3, "A b  c\nd"), (3, "x y z"), (9, "x Y z"), (None, "a b c d"), (5, None), (5, None)]
    got = jaccard.similarity_classes(documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == [
        (3, 1, 3), (3, 2, 3), (5, 0, 5), (5, 0, 5), (7, 2, 3), (9, 1, 3)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert jaccard.similarity_classes(documents(spark, [])).count() == 0


def test_prefixes_share_a_signature():
    """Any two linked sets have a signature in common, whatever classes their tokens fall in."""
    rng, nprng = random.Random(2), np.random.default_rng(2)
    t = jaccard.Threshold(80, 100)
    counts = nprng.choice([1, 5, 50], size=jaccard.COUNTERS, p=[0.2, 0.4, 0.4]).astype(np.int32)
    for _ in range(400):
        n = rng.randint(5, 120)
        a = np.unique(nprng.integers(0, 1 << 63, size=n, dtype=np.uint64))
        drop = rng.randint(0, t.mismatches(len(a)))
        b = np.unique(np.r_[a[drop:], nprng.integers(0, 1 << 63, size=rng.randint(0, 3), dtype=np.uint64)])
        if t.links(a, b):
            x, rx = jaccard.prefix_signatures(a, counts, (2, 10), t)
            y, ry = jaccard.prefix_signatures(b, counts, (2, 10), t)
            first = dict(zip(y.tolist(), (len(b) - ry).tolist()))
            ok = [s for s, r in zip(x.tolist(), (len(a) - rx).tolist())
                  if s in first and 180 * min(r, first[s]) >= 80 * (len(a) + len(b))]
            assert ok or (len(a) == len(b) and (a == b).all())


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200, 260)] + [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(5, 5)]
    up = {}
    for a, b in edges:
        for x in (a, b):
            up.setdefault(x, {x})
        merged = up[a] | up[b]
        for x in merged:
            up[x] = merged
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == min(group) for x, group in up.items())


# ---- 2, 3 ----


def test_language_id(spark):
    rng = random.Random(3)
    voc = {"en": ["the", "and", "house", "with", "there"], "de": ["und", "haus", "nicht", "schön", "für"],
           "fr": ["le", "être", "maison", "avec", "où"], "es": ["el", "niño", "casa", "con", "está"]}
    rows = [(i, rng_text(rng, rng.choice([4, 30]), voc[lang]), lang, "s", 0, "") for i, lang in enumerate(list(voc) * 60)]
    df = spark.createDataFrame(rows + [(900, None, "en", "", 0, ""), (901, "12 !?", "en", "", 0, ""), (902, "the house", None, "", 0, "")], DOCS)
    fold = langid.held_out(4, 2)
    model = langid.learn(df.where(~fold).select("lang", "text"))
    got = langid.identify(df, model, [F.col("doc_id"), F.col("lang").alias("truth"), fold.alias("held_out")]).collect()
    assert model.families == ["germanic", "romance"] and len(got) == len(rows) + 3
    by = {r.doc_id: r for r in got}
    assert (by[900].lang_pred, by[901].lang_pred, by[902].lang_pred) == ("und", "und", "en")
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert sum(r.lang_pred == r.truth for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    none = langid.identify(df, langid.learn(df.where("false").select("lang", "text")), [F.col("doc_id")])
    assert {r.lang_pred for r in none.collect()} == {"und"}


def brute_kernel(word, mark, order, decay):
    from itertools import combinations

    total = 0.0
    for a in combinations(range(len(word)), order):
        for b in combinations(range(len(mark)), order):
            if all(word[x] == mark[y] for x, y in zip(a, b)):
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_subsequence_kernel():
    words = ["loser", "lo.ser", "xlozserx", "resol", "lo", "loserloser"]
    got = toxicity.subsequence_kernel(words, "loser", 0.5)
    assert np.allclose(got, [brute_kernel(w, "loser", 4, 0.5) for w in words])


def test_toxicity(spark):
    rng = random.Random(4)
    bad = ["grumblor", "snotface", "vexquala", "vexquodu"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        w = [rng.choice(WORDS) + rng.choice("abcde") * 3 for _ in range(40)]
        if toxic:
            w[rng.randrange(40)] = rng.choice(bad)
        rows.append((i, " ".join(w) + "."))
        labels.append((i, 1, int(toxic)))
    rows += [(400, None), (401, ""), (402, "abc grumb.lor def"), (403, "abc grumxblor def")]
    labels += [(5000, 1, 1), (2, None, None), (400, 0, 0)]
    docs = documents(spark, rows)
    fold = langid.held_out(3, 1)
    model = toxicity.learn_from_tables(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), fold)
    got = {r.doc_id: r.toxicity_score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(got) == 404 and all(0 <= s <= 1 for s in got.values())
    assert sum((got[i] >= 0.7) == (i % 4 == 0) for i in held) >= 0.98 * len(held)
    assert got[400] < 0.5 and got[401] < 0.5 and got[402] > got[401] and got[403] > got[401]
    nothing = toxicity.learn_from_tables(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), fold)
    assert {r.toxicity_score for r in toxicity.score(docs, nothing).collect()} == {0.0}


# ---- 4 ----


def test_suffix_array():
    rng = random.Random(9)
    for _ in range(3000):
        x = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def brute_repeats(rows, n=50):
    first = {}
    order = lambda d: 2**63 - 1 if d is None else d
    for d, t in sorted(rows, key=lambda r: order(r[0])):
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            first.setdefault(b[i : i + n], order(d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - n + 1):
            if first[b[i : i + n]] < order(d):
                gone[i : i + n] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((order(d), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot,stretch", [(8192, 1 << 19), (2, 1 << 19), (8192, 700)])
def test_repeats(spark, mixed, hot, stretch, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_UNITS", hot)
    monkeypatch.setattr(substring_dedup, "STRETCH_BYTES", stretch)
    rows = mixed + [(None, mixed[3][1] + " tail"), (115, mixed[115][1]), (4, mixed[39][1])]
    got = substring_dedup.repeated_spans(documents(spark, rows)).collect()
    assert sorted((2**63 - 1 if r.doc_id is None else r.doc_id, *r[1:]) for r in got) == brute_repeats(rows)


def test_remove_repeats_keeps_rows_and_columns(spark, mixed):
    df = documents(spark, mixed)
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(df).collect()}
    assert len(out) == len(mixed) and substring_dedup.remove_repeats(df).columns == df.columns
    assert out[0].text == mixed[0][1] and out[110].text is None and out[111].text == "" and out[7].extra == "x"
    assert all(r.n_chars == len(r.text) for r in out.values() if r.text is not None)
    assert substring_dedup.remove_repeats(documents(spark, [])).count() == 0


# ---- 5 ----


def test_loser_tree_merges():
    rng = random.Random(6)
    for k in (0, 1, 2, 5, 17):
        runs = [sorted(str(rng.randint(0, 50)) for _ in range(rng.choice([0, 1, 30]))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_warc_round_trip_and_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    monkeypatch.setattr(warc, "STRIDE", 4)
    rng = random.Random(7)
    same = "s" * 120
    rows = [(i, f"https://www.Ex{i % 7}.org:443/p{i % 3}?q={i}#f", rng.choice([same, "short", rng_text(rng, 40)])) for i in range(60)]
    rows += [(60, None, None), (61, "http://a b/\n", same), (None, "http://x/", same), (2, "u", rows[2][2])]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    folder = tempfile.mkdtemp(prefix="tw-warc-")
    runs = warc.write_archives(pages.repartition(5).withColumn("captured", F.lit(1_600_000_000)), folder)
    index = warc.merge_index(runs, folder, fan_in=3, range_bytes=500)
    keys = [r.url_key for r in index.orderBy("range_no", "place").collect()]
    assert keys == sorted(keys) and len(keys) == len(rows)
    got = sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                 for r in warc.read_records(index, folder).collect())
    first = {}
    for p, _, h in rows:
        if p is not None and len(h or "") >= 100:
            first[h] = min(p, first.get(h, p))
    want = []
    for p, _, h in rows:
        to = first.get(h)
        to = to if to is not None and (p is None or p > to) else None
        raw = (h or "").encode()
        want.append((-1 if p is None else p, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to is None else "revisit", to))
    assert got == sorted(want, key=lambda r: (r[:4], r[4] or 0))
    empty = warc.write_archives(pages.where("false").withColumn("captured", F.lit(0)), folder)
    assert warc.read_records(warc.merge_index(empty, folder), folder).count() == 0


# ---- 6, 7 ----


def test_decontamination(spark, mixed):
    items = [(1, " ".join(mixed[30][1].split()[:12])), (2, "the"), (3, None), (4, ""), (5, "zzz yyy"), (None, "w1 w2"), (1, "w3 w4 w5")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = mixed + [(5, mixed[5][1]), (None, "w1, W2")]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    windows = set()
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - 9, 1)) if w else ():
            windows.add((i, tuple(w[k : k + 10])))
    want = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for item, g in windows:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found.add(item)
        want.append((-1 if d is None else d, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    for block in (500_000, 3):
        got = decontaminate.contamination(documents(spark, rows), bench, block=block)
        got = got.select("doc_id", "n_words", decontaminate.hit_words(F.col("spans")).alias("n"), "items").collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n, sorted(map(str, r["items"]))) for r in got) == sorted(want)
    clean = decontaminate.decontaminate(documents(spark, rows), bench)
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(w[0] or -1 for w in want if not w[2])
    assert decontaminate.decontaminate(documents(spark, rows), bench.where("false")).count() == len(rows)


def test_chat_round_trip(spark):
    rows = [(1, 0, "system", "be <|im_start|> \\n kind"), (1, 1, "user", "hi\\"), (1, 2, "assistant", "<|im_end|>\n\\<\\|x"),
            (2, 0, "user", None), (2, 1, "user", "again"), (3, 5, None, "odd"), (3, 5, "to\nol", "t"), (None, 0, "user", "\\\\n<|"),
            (4, 0, "assistant", ""), (4, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv].loss_text == "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].formatted.count("<|im_start|>") == len(own) == got[conv].formatted.count("<|im_end|>")
    assert (got[1].valid, got[2].first_bad_turn, got[4].valid) == (True, 1, True)
    assert chat.format_conversations(df.where("false")).count() == 0


# ---- 8, 9, 10 ----


def test_tokenizer_equals_the_library():
    rng = random.Random(8)
    texts = ["", None, " ", "a  b", "\n\n x", "it's we'll 'tis'sx", "<|endoftext|>", "日本 語", "İ Σς", "a\tb \x1c c", "é x", "12 345a6"]
    texts += ["".join(rng.choice(" \n abcéÉñ'.19Z,-sdmtrevl|ßÿ́語") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    for name, blank in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        t = PieceTokenizer(public_file(name), blank, cache_pieces=50)
        want = [e.ids for e in t._tokenizer.encode_batch([x or "" for x in texts], add_special_tokens=False)]
        for _ in range(2):
            assert [np.frombuffer(b, "<u4").tolist() for k in range(0, len(texts), 100) for b in t.encode(texts[k : k + 100])] == want


def test_packing(spark, mixed):
    rows = mixed + [(115, mixed[115][1])]
    got = packing.pack(documents(spark, rows).repartition(4), public_file("byte_bpe_50k.json"), capacity=256).collect()
    t = PieceTokenizer(public_file("byte_bpe_50k.json"), True)
    want = []
    for (d, _), ids in zip(rows, t.encode([x for _, x in rows])):
        ids = np.r_[np.frombuffer(ids, "<u4"), 0].astype("<u4")
        first = len(ids) % 256 or min(len(ids), 256)
        cuts = [0, first, *range(first + 256, len(ids) + 1, 256)]
        want += [(d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 256
    assert len(sequences) <= 1.02 * sum(w[3] for w in want) / 256 + 2
    assert packing.pack(documents(spark, []), public_file("byte_bpe_50k.json")).count() == 0


def test_plan_places_every_piece():
    rng = random.Random(10)
    for trial in range(12):
        lengths = {rng.randint(1, 2048): rng.choice([1, 3, 1000, 10**9]) for _ in range(rng.choice([1, 2, 30, 300]))}
        plan = packing.plan_sequences(list(lengths), list(lengths.values()))
        placed = {}
        for used, many in plan:
            assert sum(used) <= 2048 and many > 0
            for n in used:
                placed[n] = placed.get(n, 0) + many
        assert placed == lengths and len(plan) < 20 * len(lengths) + 50


def test_fingerprints(spark, mixed):
    rows = sorted(mixed) + [(500, mixed[40][1]), (501, mixed[40][1])]
    got = {r.doc_id: r for r in fingerprint.fingerprints(documents(spark, rows), range_bytes=3000).collect()}
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        t, nxt = t or "", nxt or ""
        edited = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.common_next == len(os.path.commonprefix([t, nxt])) and r.common_edited == len(os.path.commonprefix([t, edited]))
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited) and 0 <= r.near_edited <= 1
        if t == nxt:
            assert r.near_next == 1.0
    assert got[500].fingerprint == got[501].fingerprint == got[40].fingerprint
    one = fingerprint.fingerprints(documents(spark, [(None, "abcdefgh")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprint.fingerprints(documents(spark, [])).count() == 0


def test_span_equality_and_extension():
    a, b = fingerprint.PrefixHash("xxabcabcdyy"), fingerprint.PrefixHash("abcdz")
    assert a.span(2, 3) == a.span(5, 3) == b.span(0, 3) != a.span(3, 3)
    assert a.extension(5, b, 0) == 4 and a.extension(2, b, 0) == 3 and a.extension(0, b, 0) == 0


def test_token_files(spark, mixed):
    rows = mixed + [(None, "null first"), (115, "same id")]
    path = tempfile.mkdtemp(prefix="tw-ids-") + "/t"
    token_files.write_tokens(documents(spark, rows).repartition(3), path, public_file("word_bpe_49k.json"), file_bytes=4000)
    t, at = PieceTokenizer(public_file("word_bpe_49k.json"), False), 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = []
    for (d, _), ids in zip(order, t.encode([x for _, x in order])):
        want.append((d, at, len(ids) // 4 + 1))
        at += len(ids) // 4 + 1
    got = [tuple(r) for r in token_files.read_metadata(spark, path).orderBy("start").collect()]
    assert got == want
    some = token_files.read_range(spark, path, 3, 5).collect()
    assert sorted(r.doc_id for r in some) == [3, 4, 5] and all(r.ids[-1] == token_files.END_ID for r in some)


def test_ascii_lower_leaves_other_letters(spark):
    assert spark.range(1).select(ascii_lower(F.lit("ÀBC ßÉx")).alias("x")).first().x == "Àbc ßÉx"
