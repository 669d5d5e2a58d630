"""Hierarchical language identification.

First the language family is predicted, by one linear support vector machine
for each family; then one-versus-one linear machines separate the related
languages within it.  Features are the square roots of hashed byte trigram
counts of the whole lower-cased text, scaled to unit length.  The machines are
trained on a bounded sample of labelled rows, distinct texts only, at most
``PER_LANGUAGE`` of each language; prediction covers every row.

Defined cases: text that is null or has no letter is ``und`` with score 0;
rows without a language are not learned from; without any labelled row all is
``und``; a null doc_id counts as held out; repeated rows each get a row; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import table
from tidewater.llm.linear import sigmoid, train_svm

DIMS = 1 << 13
#: Bound of the training sample: rows of a language, and of all languages together.
PER_LANGUAGE, IN_ALL = 500, 4000
#: Margins are made probabilities by a logistic curve of this slope.
SLOPE = 4.0

# Families of ISO 639-1 codes; a code that is not here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv yi".split(),
    "romance": "ca es fr gl it la oc pt ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "baltic": "lt lv".split(),
    "uralic": "et fi hu".split(),
    "turkic": "az kk ky tk tr tt uz".split(),
    "indo-aryan": "bn gu hi mr ne pa si ur".split(),
    "dravidian": "kn ml ta te".split(),
    "semitic": "am ar he mt".split(),
    "celtic": "br cy ga gd".split(),
    "austronesian": "id jv mg ms su tl".split(),
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes}


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(dimensions, values) of a text's unit-length trigram vector; blanks at both ends count."""
    b = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    gram = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    slot = (gram * np.uint32(2654435761)) >> np.uint32(32 - 13)
    count = np.bincount(slot, minlength=DIMS)
    at = np.flatnonzero(count)
    value = np.sqrt(count[at])
    return at.astype(np.int32), (value / np.linalg.norm(value)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    """Family machines (families x dims), and for each family its pairwise machines."""

    families: list[str] = field(default_factory=list)
    languages: dict[str, list[str]] = field(default_factory=dict)
    family_w: np.ndarray | None = None
    pair_w: dict[str, list[tuple[int, int, np.ndarray]]] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return "und", 0.0
        at, value = features(text)
        if self.family_w is None:
            best, sure = 0, 1.0
        else:
            margin = self.family_w[:, at] @ value + self.family_w[:, -1]
            e = np.exp(SLOPE * (margin - margin.max()))
            best = int(margin.argmax())
            sure = float(e[best] / e.sum())
        family = self.families[best]
        names = self.languages[family]
        if len(names) == 1:
            return names[0], sure
        votes, won = np.zeros(len(names)), np.ones(len(names))
        for i, j, w in self.pair_w[family]:
            p = float(sigmoid(SLOPE * (w[at] @ value + w[-1])))
            votes[i] += p >= 0.5
            votes[j] += p < 0.5
            won[i] *= p
            won[j] *= 1 - p
        pick = max(range(len(names)), key=lambda k: (votes[k], won[k]))
        return names[pick], sure * float(won[pick] / won.sum())


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Model from (language, dimensions, values) examples."""
    model = Model()
    languages = sorted({r[0] for r in rows})
    for name in languages:
        model.languages.setdefault(FAMILY_OF.get(name, name), []).append(name)
    model.families = sorted(model.languages)
    x = np.zeros((len(rows), DIMS), dtype=np.float32)
    for i, (_, at, value) in enumerate(rows):
        x[i, at] = value
    lang = np.array([r[0] for r in rows])
    family = np.array([FAMILY_OF.get(v, v) for v in lang])
    if len(model.families) > 1:
        model.family_w = np.array(
            [train_svm(x, np.where(family == f, 1, -1)) for f in model.families], dtype=np.float32
        )
    for f, names in model.languages.items():
        model.pair_w[f] = []
        for i, j in itertools.combinations(range(len(names)), 2):
            two = (lang == names[i]) | (lang == names[j])
            w = train_svm(x[two], np.where(lang[two] == names[i], 1, -1))
            model.pair_w[f].append((i, j, w.astype(np.float32)))
    return model


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts and two pieces out of the middle of each, so that short texts are learned too."""
    for batch in batches:
        out = []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            middle = len(text) // 2
            for some in {text, text[middle : middle + 60], text[middle : middle + 200]}:
                if has_letter(some):
                    out.append((lang, *features(some)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in out], type=pa.string()),
                pa.array([r[1] for r in out], type=pa.list_(pa.int32())),
                pa.array([r[2] for r in out], type=pa.list_(pa.float32())),
            ],
            names=["lang", "dims", "vals"],
        )


def learn(labelled: DataFrame) -> Model:
    """Train on a bounded sample of (lang, text): distinct texts, those of the least hash of each language."""
    rows = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return Model()
    most = max(2, min(PER_LANGUAGE, IN_ALL // len(counts)))
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 1.5 * (most + 20) / max(1, n)))])
    near = rows.where(F.pmod("h", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * F.lit(float(1 << 30)))
    rank = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")
    sample = near.groupBy("lang", "h").agg(F.first("text").alias("text")).withColumn("r", F.row_number().over(rank))
    found = (
        sample.where(F.col("r") <= most)
        .select("lang", "text")
        .mapInArrow(_examples, "lang string, dims array<int>, vals array<float>")
        .toArrow()
    )
    examples = [
        (k, np.array(d, dtype=np.int32), np.array(v, dtype=np.float32))
        for k, d, v in zip(*(found.column(c).to_pylist() for c in ("lang", "dims", "vals")))
    ]
    examples.sort(key=lambda e: (e[0], e[1].tobytes(), e[2].tobytes()))  # the same model whatever the order of arrival
    return train(examples)


def identify(documents: DataFrame, model: Model, keep: list[Column]) -> DataFrame:
    """The kept columns with lang_pred and score, for every row; only the text is looked at."""
    chosen = documents.select(*keep, F.col("text").alias("__text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # size set by DIMS and the number of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for batch in batches:
            said = [predict(t) for t in batch.column("__text").to_pylist()]
            kept = batch.select([c for c in batch.schema.names if c != "__text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([s[0] for s in said], type=pa.string()), pa.array([s[1] for s in said], type=pa.float64())],
                names=[*kept.schema.names, "lang_pred", "score"],
            )

    kept = chosen.drop("__text").schema
    return chosen.mapInArrow(run, kept.add("lang_pred", "string").add("score", "double"))


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(True))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    fold = held_out(4, 2)
    model = learn(documents.where(~fold).select("lang", "text"))
    return identify(documents, model, [F.col("doc_id"), fold.alias("held_out")])
