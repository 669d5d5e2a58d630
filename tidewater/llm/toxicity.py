"""Toxicity by a subsequence string kernel with Nyström landmarks.

The kernel sums over the common subsequences of a word and a landmark, of all
but one of the landmark's letters (``ORDER`` at least, ``LONGEST`` at most),
each weighted by ``DECAY`` to the length it spans in both, so gaps and inserted
characters lower a match without losing it.  A word's kernel
values with all landmarks, whitened by the landmarks' own kernel matrix
(Nyström), are the features of a linear support vector machine; a sentence is
as toxic as its worst word, a document as its worst sentence.

Training takes a bounded sample of labelled documents.  Landmarks are word
beginnings that many sentences of toxic documents have and hardly any of clean
ones.  The machine is trained on sentences as bags of words: every word of a
clean document's sentences is negative, of a toxic document the words that are
a landmark's own, or else its worst word, bear witness (chosen anew after each
pass).  Scores are calibrated on the training documents.

Defined cases: null or empty text has no sentence and gets the score of a
sentence without any match; labels that are null, or whose document is
missing, are not learned from; a document with several label rows is toxic if
any says so; without labels of both kinds the score is the share of toxic
ones; a null doc_id counts as held out; repeated rows each get a row; an empty
table gives no rows; extra columns are ignored or kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.llm.common import stored, table
from tidewater.llm.langid import held_out
from tidewater.llm.linear import fit_logistic, sigmoid, train_svm

ORDER, LONGEST = 3, 5
DECAY = 0.5
#: A word is compared with a landmark if it has at least this share of its distinct letters.
SHARED = 0.7
#: Letters of a word that are compared at a time; longer words are compared in overlapping parts.
WIDTH = 24
#: Share of the toxic training documents (4 of them at least) that have a landmark, and the most landmarks chosen.
#: A word that is rarer in the sample, or has under 4 letters, is only found by its likeness to a landmark.
MIN_SUPPORT, MAX_LANDMARKS = 0.01, 128
#: Bound of the training sample, in distinct texts.
TOXIC_ROWS, CLEAN_ROWS = 1500, 3000
THRESHOLD = 0.7
#: Words that one Python worker remembers to match nothing.
KNOWN_WORDS = 300_000
#: Words compared with the landmarks at a time, and bytes of text scored at a time.
MATCHED, SCORED_BYTES = 4096, 4 << 20

_SENTENCE = re.compile(r"[.!?\n|]+")
_SPELLED = re.compile(r"(?<!\S)(?:\w[ \t]){2,}\w(?!\S)")
_EDGE = " \t.,;:!?()[]{}<>\"'«»|-*_/\\=+~#`"


def chunks_of(text: str) -> set[str]:
    """Distinct lower-case runs of non-blank characters; letters set apart by blanks also count joined."""
    low = text.lower()
    out = set(low.split())
    if _SPELLED.search(low):
        out.update(re.sub(r"\s", "", m) for m in _SPELLED.findall(low))
    return out


def word_of(chunk: str) -> str:
    """A chunk without the marks around it."""
    return chunk.strip(_EDGE)


def sentences_of(text: str) -> list[set[str]]:
    return [w for w in ({word_of(c) for c in chunks_of(x)} for x in _SENTENCE.split(text)) if w]


# ---- the kernel ----


def _codes(words: list[str], width: int) -> np.ndarray:
    flat = "".join([w.ljust(width, "\0") for w in words])
    return np.frombuffer(flat.encode("utf-32-le", "replace"), dtype="<u4").reshape(len(words), width)


def subsequence_kernel(words: list[str], landmark: str, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted kernel of each word with the landmark, by dynamic programming over all words at once."""
    if not words:
        return np.zeros(0)
    width, m = max(map(len, words)), len(landmark)
    order = min(m, max(ORDER, min(m - 1, LONGEST)))
    codes = _codes(words, width)
    mark = np.frombuffer(landmark.encode("utf-32-le", "replace"), dtype="<u4")
    # reach[j, k] = decay**(k - j): a match ending at j of the landmark, seen from k >= j
    step = np.arange(m)
    reach = np.where(step[None, :] >= step[:, None], decay ** (step[None, :] - step[:, None]).clip(0).astype(float), 0.0)
    begun = [np.ones((len(words), m + 1))] + [np.zeros((len(words), m + 1)) for _ in range(order - 1)]
    total = np.zeros(len(words))
    for at in range(width):
        same = (codes[:, at : at + 1] == mark[None, :]) & (codes[:, at : at + 1] != 0)
        last = [b[:, :m].copy() for b in begun]  # as they were before this letter
        total += (same * last[order - 1]).sum(axis=1) * decay * decay
        for i in range(1, order):
            begun[i][:, 1:] = decay * begun[i][:, 1:] + (same * last[i - 1] * decay * decay) @ reach
    return total


def _parts(word: str) -> list[str]:
    if len(word) <= WIDTH:
        return [word]
    return [word[k : k + WIDTH] for k in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


@dataclass
class Model:
    landmarks: list[str] = field(default_factory=list)
    whiten: np.ndarray | None = None
    weights: np.ndarray | None = None
    slope: float = 1.0
    shift: float = 0.0
    base: float = 0.0  # the score of everything where nothing could be learned

    def __post_init__(self):
        self._self = np.array([subsequence_kernel([x], x)[0] for x in self.landmarks])
        self._letters = [set(x) for x in self.landmarks]
        self._known: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def match(self, words: Iterable[str]) -> dict[str, np.ndarray]:
        """Kernel values (1: the landmark itself) of the words that match any landmark."""
        new = sorted({w for w in words if len(w) >= ORDER})
        owner, parts = [], []
        for i, w in enumerate(new):
            for p in _parts(w):
                owner.append(i)
                parts.append(p)
        if not parts:
            return {}
        owner = np.array(owner)
        codes = _codes(parts, max(map(len, parts)))
        found = np.zeros((len(new), len(self.landmarks)))
        holds = {c: (codes == ord(c)).any(axis=1).view(np.int8) for c in set().union(*self._letters)}
        for k, mark in enumerate(self.landmarks):
            need = max(ORDER, math.ceil(SHARED * len(self._letters[k])))
            have = sum(holds[c] for c in self._letters[k])
            some = np.flatnonzero(have >= min(need, len(self._letters[k])))
            if len(some):
                value = np.minimum(subsequence_kernel([parts[i] for i in some], mark) / self._self[k], 1.0)
                np.maximum.at(found[:, k], owner[some], value)
        hit = found.any(axis=1)
        return {new[i]: found[i] for i in np.flatnonzero(hit)}

    def margins(self, kernel: np.ndarray) -> np.ndarray:
        """SVM margins of words given as rows of kernel values."""
        return (kernel @ self.whiten) @ self.weights[:-1] + self.weights[-1]

    def scores(self, texts: list[str | None]) -> list[float]:
        """Score of each text: that of its worst word."""
        if self.weights is None:
            return [self.base] * len(texts)
        if len(self._known) > KNOWN_WORDS:
            self._known.clear()
        known = self._known
        docs = [chunks_of(t) if t else set() for t in texts]
        new = list(set().union(*docs).difference(known)) if docs else []
        none = float(self.weights[-1])  # the margin of a word that matches nothing
        for k in range(0, len(new), MATCHED):
            some = new[k : k + MATCHED]
            words = [word_of(c) for c in some]
            values = self.match(words)
            margin = dict(zip(values, self.margins(np.array(list(values.values()))).tolist())) if values else {}
            known.update((c, margin.get(w, none)) for c, w in zip(some, words))
        worst = [max(map(known.__getitem__, d), default=none) for d in docs]
        return sigmoid(self.slope * np.maximum(worst, none) + self.shift).tolist()


# ---- training, on a bounded sample ----


def starts_of(word: str) -> set[str]:
    """A word's beginnings that may be landmarks: of 4 to 10 letters, and the word itself up to 14."""
    return {word[:k] for k in range(4, min(len(word), 10) + 1)} | ({word} if 3 < len(word) <= 14 else set())


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's beginnings, with the sentences that have them (as hashes; equal sentences have equal ones)."""
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found: dict[str, set[int]] = defaultdict(set)
            for sentence in sentences_of(text):
                sign = hashlib.blake2b("\0".join(sorted(sentence)).encode("utf-8", "replace"), digest_size=8).digest()
                for s in set().union(*map(starts_of, sentence)):
                    found[s].add(int.from_bytes(sign, "big", signed=True))
            if found:
                columns = pa.array(list(found)), pa.array([doc] * len(found)), pa.array([list(x) for x in found.values()], type=pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(columns), names=["s", "doc", "signs"])


def choose_landmarks(
    sample: DataFrame, n1: int, n0: int, support: float = MIN_SUPPORT, most: int = MAX_LANDMARKS
) -> list[str]:
    """Word beginnings that many of the n1 toxic and hardly any of the n0 clean documents (h, text, bad) have.

    Counted by Spark; only beginnings that are left over come to the driver.
    Support is counted in distinct sentences, so that copies of a document do
    not lend it weight.  Greedy: a document counts the less the more chosen
    landmarks it has already; of equals the longest beginning is taken.
    """
    least = max(4, math.ceil(support * n1))
    rows = lambda some: sample.where(some).select("h", "text").mapInArrow(_starts, "s string, doc long, signs array<long>")
    able = (
        rows(F.col("bad")).groupBy("s")
        .agg(F.collect_list("doc").alias("docs"), F.size(F.array_distinct(F.flatten(F.collect_list("signs")))).alias("n"))
        .where((F.size("docs") >= least) & (F.col("n") >= least))
        .select("s", "docs")
    )
    clean = rows(~F.col("bad")).groupBy("s").agg(F.count("*").alias("clean"))
    found = (
        able.join(clean, "s", "left")
        .withColumn("clean", F.coalesce("clean", F.lit(0)))
        .where(F.col("clean") / max(1, n0) <= 0.02 * F.size("docs") / n1)
        .collect()
    )
    at: dict[int, int] = {}
    where = {r["s"]: np.array(sorted(at.setdefault(d, len(at)) for d in sorted(r["docs"])), dtype=np.int64) for r in found}
    clean_of = {r["s"]: r["clean"] for r in found}
    left, chosen, had = set(where), [], np.zeros(len(at))
    while left and len(chosen) < most:
        best = max(left, key=lambda s: (round(float((1 / (1 + had[where[s]])).sum()) / (1 + clean_of[s]), 9), len(s), s))
        chosen.append(best)
        had[where[best]] += 1
        left = {s for s in left if not (s.startswith(best) or best.startswith(s))}
    return chosen


def train(texts: list[str], toxic: list[bool], landmarks: list[str], passes: int = 3) -> Model:
    """Model from labelled texts (at most the bounded sample) and the landmarks chosen for them."""
    base = sum(toxic) / len(toxic) if toxic else 0.0
    if not landmarks:
        return Model(base=base)
    model = Model(landmarks=landmarks, base=base)
    gram = np.array([subsequence_kernel([a[:WIDTH] for a in landmarks], b) for b in landmarks]).T
    gram = np.minimum(gram / model._self[None, :], 1.0)
    gram = (gram + gram.T) / 2
    value, vector = np.linalg.eigh(gram)
    model.whiten = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T
    vocabulary = sorted({w for t in texts for s in sentences_of(t) for w in s})
    words: dict[str, np.ndarray] = {}
    for k in range(0, len(vocabulary), 20_000):
        words.update(model.match(vocabulary[k : k + 20_000]))
    zero = np.zeros((1, len(landmarks)))
    kernels = []
    for text in texts:
        rows = [words[w] for w in set().union(*sentences_of(text)) if w in words]
        kernels.append(np.unique(np.vstack([zero, *rows]), axis=0))
    negative = np.unique(np.vstack([k for k, bad in zip(kernels, toxic) if not bad]), axis=0)
    # of very many clean words, those nearest to a landmark and an even share of the others
    order = np.argsort(-negative.max(axis=1), kind="stable")
    hard, rest = order[:3000], order[3000:]
    negative = negative[np.concatenate([hard, rest[:: max(1, len(rest) // 2000)]])]
    positive = [k for k, bad in zip(kernels, toxic) if bad and k.any()]
    witness = _distinct([k[(k >= 0.99).any(axis=1)] if (k >= 0.99).any() else k[k.max(axis=1).argmax()][None] for k in positive])
    for _ in range(passes):
        x = np.vstack([witness, negative]) @ model.whiten
        y = np.r_[np.ones(len(witness)), -np.ones(len(negative))]
        model.weights = train_svm(x, y, c=10.0, epochs=40)
        again = _distinct([k[(m := model.margins(k)) >= min(1.0, m.max())] for k in positive])
        if again.shape == witness.shape and (again == witness).all():
            break
        witness = again
    worst = np.array([model.margins(k).max() for k in kernels])
    model.slope, model.shift = fit_logistic(worst, np.array(toxic))
    return model


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.vstack(parts), axis=0)


def learn(documents: DataFrame, marks: DataFrame, support: float = MIN_SUPPORT, most_landmarks: int = MAX_LANDMARKS) -> Model:
    """Train on a bounded sample of documents with marks (doc_id, toxic): distinct texts, those of the least hash
    of either label.  Only ids and text hashes are shuffled; the sample's texts are fetched by its ids."""
    rows = (
        documents.where("text is not null").select("doc_id", F.xxhash64("text").alias("h"))
        .join(marks.where("toxic is not null").select("doc_id", (F.col("toxic") > 0).alias("bad")), "doc_id")
    )
    texts = rows.groupBy("bad", "h").agg(F.min("doc_id").alias("doc_id"))
    counts = {r["bad"]: r["count"] for r in texts.groupBy("bad").count().collect()}
    if not counts:
        return Model()
    most = {True: TOXIC_ROWS, False: CLEAN_ROWS}
    place = F.pmod("h", F.lit(1 << 30))
    near, keep = F.lit(False), F.lit(False)
    for bad, n in counts.items():
        share = min(1.0, 1.5 * (most[bad] + 20) / max(1, n))
        near = near | ((F.col("bad") == bad) & (place < share * (1 << 30)))
        keep = keep | ((F.col("bad") == bad) & (F.col("r") <= most[bad]))
    rank = Window.partitionBy("bad").orderBy(place, "h")
    sample = texts.where(near).withColumn("r", F.row_number().over(rank)).where(keep).select("doc_id", "h", "bad")
    named = documents.select("doc_id", "text", F.xxhash64("text").alias("h"))
    chosen = stored(named.join(F.broadcast(sample), ["doc_id", "h"]).select("h", "text", "bad").distinct(), "sample")
    got = chosen.select("bad", "text").collect()  # the stated bound
    got.sort(key=lambda r: (r["bad"], r["text"]))
    toxic = [r["bad"] for r in got]
    both = any(toxic) and not all(toxic)
    landmarks = choose_landmarks(chosen, sum(toxic), len(toxic) - sum(toxic), support, most_landmarks) if both else []
    return train([r["text"] for r in got], toxic, landmarks)


def learn_from_tables(
    documents: DataFrame, labels: DataFrame, fold: Column, support: float = MIN_SUPPORT, most_landmarks: int = MAX_LANDMARKS
) -> Model:
    """Train on the labelled documents outside the fold; a document is toxic if any of its label rows says so."""
    marks = labels.where("doc_id is not null and toxic is not null").where(~fold).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return learn(documents, marks, support, most_landmarks)


def _steps(texts: pa.Array, rows: int) -> Iterator[tuple[int, int]]:
    """(first, number) of rows scored together: at most ``rows``, and about SCORED_BYTES of text."""
    at = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > at and (i - at == rows or size + (n or 0) > SCORED_BYTES):
            yield at, i - at
            at, size = i, 0
        size += n or 0
    if at < len(texts):
        yield at, len(texts) - at


def score(
    documents: DataFrame, model: Model, keep: list[Column] | None = None, step: int = 256, into: str = "toxicity_score"
) -> DataFrame:
    """The kept columns (all, if none are named) with the score, for every row; only the text is looked at.

    Columns are passed by place, the text once, so their names do not matter;
    ``into`` must not be one of them.
    """
    if keep is None:
        chosen, text_at = documents, documents.columns.index("text")
    else:
        chosen, text_at = documents.select(*keep, "text"), len(keep)
    kept_at = [i for i in range(len(chosen.columns)) if keep is None or i != text_at]
    shared = documents.sparkSession.sparkContext.broadcast(model)  # at most MAX_LANDMARKS strings and weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said: list[float] = []
            for at, n in _steps(batch.column(text_at), step):
                said += shared.value.scores(batch.column(text_at).slice(at, n).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept_at), pa.array(said, type=pa.float64())], names=[f.name for f in schema.fields]
            )

    schema = StructType([chosen.schema.fields[i] for i in kept_at]).add(into, "double")
    return chosen.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = held_out(3, 1)
    model = learn_from_tables(documents, labels, fold)
    return score(documents, model, [F.col("doc_id"), fold.alias("held_out")]).select(
        "doc_id",
        "held_out",
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
