"""Whole results and even groups where ids, texts or words repeat; against brute force."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from test_text_operators import WORDS, brute_repeats, documents, rng_text

from tidewater.llm import fingerprint, jaccard, langid, shingles, substring_dedup, toxicity
from tidewater.llm.tokens import PieceTokenizer, public_file


def repeated_rows(rows):
    got = sorted((2**63 - 1 if r.doc_id is None else r.doc_id, *r[1:]) for r in rows)
    return got


# ---- 1 ----


def test_tokens_are_counted_exactly(spark):
    rng = random.Random(6)
    texts = [rng_text(rng, rng.randint(1, 60)) + " one two three four" * (i % 3 == 0) for i in range(120)]
    sets = [shingles.shingle_set(t) for t in texts]
    docs = documents(spark, list(enumerate(texts)) + [(500, texts[0]), (501, None), (None, texts[1])]).repartition(3)
    survey = docs.select("doc_id", "text").mapInArrow(lambda b: jaccard._survey(b, 3, 5, 9), jaccard.SURVEY).cache()
    counted = {}
    for row in jaccard.token_counts(survey).collect():
        counted[row.part, row.bucket] = row.often
    tokens, want = {}, {}
    for row in survey.where("body is not null").collect():
        tokens.setdefault(row.part, {})[row.set_hash] = sets[row.doc_id if row.doc_id < 500 else 0]
    for part in tokens.values():
        for x in part.values():
            for t in jaccard._keys(x).tolist():
                want[t] = want.get(t, 0) + 1
    assert max(want.values()) > 20 and len(counted) > 5
    for part, some in tokens.items():
        keys = np.unique(jaccard._keys(np.concatenate([*some.values()]))).tolist()
        often = b"".join(counted[k] for k in sorted(counted) if k[0] == part)
        assert list(often) == [want[t] for t in keys]
    levels = jaccard._levels(np.arange(1, 1 << 22))
    assert (np.diff(levels.astype(int)) >= 0).all() and levels[199] == 200 and levels[-1] == 255


def test_signatures_of_unshared_tokens_are_not_kept(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
    texts = [[word() for _ in range(60)] for _ in range(40)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)] + [(100, " ".join(texts[7][:-1]))]
    kept, was = {}, jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: kept.setdefault(name, was(df, name)))
    got = {r.doc_id: r.component_id for r in jaccard.similarity_classes(documents(spark, rows)).collect()}
    assert got == {**{i: i for i in range(40)}, 100: 7}
    assert sorted(r.node for r in kept["signatures"].collect()) == [7, 100]


def test_near_copies_of_one_text_are_not_all_paired(spark, monkeypatch):
    """Sixty edits of one text that do not link, four of them with a near copy that does."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
    base = [word() for _ in range(300)]

    def edited(words, n):
        words = list(words)
        for i in rng.sample(range(len(words)), n):
            words[i] = word()
        return words

    texts = [edited(base, 4) for _ in range(60)]
    texts += [edited(texts[i], 1) for i in (3, 17, 30, 59)]
    sets = [set(shingles.shingle_set(" ".join(t)).tolist()) for t in texts]
    links = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if 10 * len(a & b) >= 9 * len(a | b)}
    assert links == {(3, 60), (17, 61), (30, 62), (59, 63)}
    pairs, was = [], jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda p, *rest: pairs.append(p.count()) or was(p, *rest))
    got = jaccard.similarity_classes(documents(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: r.component_id for r in got} == {**{i: i for i in range(60)}, 60: 3, 61: 17, 62: 30, 63: 59}
    assert pairs[-1] <= 4 * len(texts)


# ---- 3 ----


def test_rare_insults_are_learned(spark):
    """Sixty insults, each in under 2 % of the toxic documents."""
    rng = random.Random(3)
    insults = ["".join(rng.choice("bdfgklmnprtvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(60)]
    rows, labels, at = [], [], [0, 0]  # dealt evenly within training and held-out documents
    for i in range(2400):
        toxic = i % 3 == 0
        w = [rng.choice(WORDS) + rng.choice("abcde") * 3 for _ in range(30)]
        if toxic:
            fold = zlib.crc32(str(i).encode()) % 3 == 1
            w[rng.randrange(30)] = insults[at[fold] % 60]
            at[fold] += 1
        rows.append((i, " ".join(w) + "."))
        labels.append((i, 1, int(toxic)))
    docs, fold = documents(spark, rows), langid.held_out(3, 1)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = [i for i in range(2400) if zlib.crc32(str(i).encode()) % 3 == 1]

    def shares(model):
        got = {r.doc_id: r.toxicity_score >= toxicity.THRESHOLD for r in toxicity.score(docs, model).collect()}
        return [np.mean([got[i] for i in held if (i % 3 == 0) == bad]) for bad in (True, False)]

    model = toxicity.learn_from_tables(docs, marks, fold)
    hit, wrong = shares(model)
    assert len(model.landmarks) > 48 and hit >= 0.95 and wrong <= 0.02
    fewer = toxicity.learn_from_tables(docs, marks, fold, support=0.01, most_landmarks=10)
    assert len(fewer.landmarks) == 10
    assert toxicity.learn_from_tables(docs, marks, fold, support=0.05).landmarks == []


# ---- 4 ----


def test_copies_of_a_text_spread_over_buckets(spark):
    rng = random.Random(1)
    long = rng_text(rng, 60)
    for text in (long, None, ""):
        batch = pa.RecordBatch.from_arrays([pa.array(range(3200), type=pa.int64()), pa.array([text] * 3200, type=pa.string())], names=["doc_id", "text"])
        buckets = np.concatenate([b.column(1).to_numpy() for b in substring_dedup._pack(iter([batch]), 32)])
        assert np.bincount(buckets, minlength=32).max() < 2 * 3200 / 32
    rows = [(i, (long, None, rng_text(rng, 30))[i % 3]) for i in range(300)] + [(None, long), (0, long), (5, None)]
    assert repeated_rows(substring_dedup.repeated_spans(documents(spark, rows)).collect()) == brute_repeats(rows)


def test_units_of_a_frequent_anchor_do_not_meet_in_one_group(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_ENTRIES", 30)
    rng = random.Random(2)
    line = rng_text(rng, 25)
    rows = [(i, f"{rng_text(rng, 8)} {i * 7919:09d} {line} {i * 104729:09d} {rng_text(rng, 8)}") for i in range(150)]
    rows += [(i, rng_text(rng, 40)) for i in range(150, 200)]
    rows += [(200, "ab" * 900), (201, "ab" * 60), (None, "ab" * 70 + line), (None, None), (3, line + " x" * 40)]
    docs = documents(spark, rows).select("doc_id", "text")
    hot = substring_dedup.hot_anchors(docs, 40_000)
    assert 0 < len(hot) < 40

    # what one group of anchors gets: no more than HOT_ENTRIES of any anchor
    shared = spark.sparkContext.broadcast(hot)
    cut = docs.repartition(8).mapInArrow(lambda b: substring_dedup._cut_units(b, 4, shared), substring_dedup.UNIT_ROWS)
    sent = [tuple(r)[2:] for r in cut.where(f"kind = {substring_dedup.UNITS}").collect()]
    _, n = np.unique(substring_dedup._Entries.read(sent).anchor, return_counts=True)
    assert n.max() <= 30
    assert cut.where(f"kind = {substring_dedup.HOT}").count() > 0
    for many in (8192, 2):
        monkeypatch.setattr(substring_dedup, "HOT_UNITS", many)
        assert repeated_rows(substring_dedup.repeated_spans(documents(spark, rows)).collect()) == brute_repeats(rows)


def test_a_unit_costs_few_bytes_however_many_buckets_there_are(spark):
    rng = random.Random(3)
    docs = documents(spark, [(i, rng_text(rng, 300)) for i in range(400)]).select("doc_id", "text").coalesce(1)
    again = spark.sparkContext.broadcast(substring_dedup.repeated_ids(docs))
    assert len(again.value) == 0

    def size(buckets):
        cut = docs.mapInArrow(lambda b: substring_dedup._cut_units(b, buckets, again=again), substring_dedup.UNIT_ROWS)
        return sum(len(zlib.compress(b"".join(r[2:]), 1)) for r in cut.collect())

    assert size(500) < 1.35 * size(10)


def test_an_anchor_is_one_symbol_of_a_suffix_array(monkeypatch):
    lengths, build = [], substring_dedup.suffix_array
    monkeypatch.setattr(substring_dedup, "suffix_array", lambda x: lengths.append(len(x)) or build(x))
    rng = random.Random(4)
    line = rng_text(rng, 30).encode()
    strings, owners = [], []
    for i in range(40):
        raw = rng_text(rng, 5).encode() + line[i % 7 :] + rng_text(rng, 5).encode()
        first, windows, *_ = substring_dedup.units_of(np.frombuffer(raw, dtype=np.uint8))
        strings += [raw[f : f + w + 49] for f, w in zip(first.tolist(), windows.tolist())]
        owners += [i] * len(first)
    masks = substring_dedup.repeated_windows(strings, np.array(owners))
    assert lengths == [sum(len(s) - 23 + 1 for s in strings) + 1]
    least = {}
    for s, i in zip(strings, owners):
        for k in range(len(s) - 49):
            least.setdefault(s[k : k + 50], i)
    for s, i, mask in zip(strings, owners, masks):
        assert mask.tolist() == [least[s[k : k + 50]] < i for k in range(len(s) - 49)]


@pytest.mark.parametrize("most", [0, 2, 1000])
def test_rows_of_one_id_are_told_apart(spark, monkeypatch, most):
    monkeypatch.setattr(substring_dedup, "MOST_REPEATED", most)
    rng = random.Random(5)
    line = rng_text(rng, 20)
    rows = [(i // 2 if i < 20 else i, f"{rng_text(rng, 10)} {line} {rng_text(rng, 10)}") for i in range(40)]
    rows += [(None, line * 2), (None, rng_text(rng, 30)), (2**63 - 1, line), (-5, line), (30, None)]
    got = substring_dedup.repeated_spans(documents(spark, rows)).collect()
    assert repeated_rows(got) == brute_repeats(rows)


# ---- 9 ----


def test_likeness_across_the_length_limit(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400))

    def share(a, b, k=4):
        a, b = ({t[i : i + k] for i in range(len(t) - k + 1)} for t in (a, b))
        return 2 * len(a & b) / (len(a) + len(b))

    for n, m in ((127, 129), (120, 150), (100, 200), (127, 400)):
        got = fingerprint.Fingerprint(text[:n]).likeness(fingerprint.Fingerprint(text[:m]))
        assert abs(got - share(text[:n], text[:m])) < 0.15
        assert fingerprint.Fingerprint(text[:n]).likeness(fingerprint.Fingerprint(text[-m:][::-1])) < 0.1
    # the edited text of 140 characters is 105 + 5 long
    r = fingerprint.fingerprints(documents(spark, [(1, text[:140]), (2, "short")])).where("doc_id = 1").first()
    assert r.near_edited > 0.6


# ---- 8, 10 ----


def test_added_tokens_in_a_text_are_as_in_the_library():
    from tokenizers import Tokenizer

    texts = ["<|endoftext|>", "a <|endoftext|> b", "x<|startoftext|>y", "<|EndOfText|> z", "<|endof text|>", "the <| |> endoftext", "plain words", "日本 <|endoftext|>"]
    for name, blank in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        plain = Tokenizer.from_file(public_file(name))
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in PieceTokenizer(public_file(name), blank).encode(texts)] == want


# ---- pipeline ----


def test_rows_of_one_id_with_other_texts_stay(spark):
    rng = random.Random(7)
    a, b, c, d = (rng_text(rng, 40) for _ in range(4))
    rows = [(1, a), (1, b), (2, a + " tail"), (3, c), (3, c), (4, b), (5, None), (5, d), (5, ""), (6, d), (None, a)]
    kept = corpus_pipeline.one_of_each_group(spark, documents(spark, rows), "")
    got = sorted(((r.doc_id or 0, r.text or "") for r in kept.collect()))
    assert got == sorted([(0, a), (1, a), (1, b), (3, c), (5, ""), (5, ""), (5, d)])
    assert kept.columns == documents(spark, rows).columns
