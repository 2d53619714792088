"""Operator 7: toxicity scores by a counterfactual-regularised classifier.

A logistic model over the words of a text and their beginnings (0/1 features, hashed). Each sampled labelled text that
holds identity terms has copies in which they are swapped for others of their groups, made where the text is read; in
training the mean squared change of the score between a text and its copies is penalised. Neutral sentences that mention
each term are added with label 0, with copies of their own. So a mention of a group doesn't raise a score by itself.

Learning reads a sample of labelled rows bounded by `sample_per_label` (expected rows of a label, taken by a hash of the
id, whole texts); only their features reach the driver. The sampled labels are broadcast, so texts aren't shuffled for
training, and scoring is one pass without a shuffle.

Results in special cases: null and empty texts get the score of no features; without labels of both kinds every score is
0; labels that are null or whose document is missing are not learned from; equal texts get equal scores; very long texts
are read whole, and one longer than a batch is a batch; columns named score or predicted are replaced, others stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels, linear
from .kernels import U64

SAMPLE_PER_LABEL = 2500
BITS = 20
BEGINNINGS = (4, 6, 8)
LEAST_Z = 3.5
L2 = 2e-4
COUNTERFACTUAL = 20.0
#: Places by which terms are moved within their groups, a copy for each.
SHIFTS = (1, 2)
ALERT = 0.7
#: Groups of identity terms that may be swapped for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "heterosexual", "homosexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "sikh"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab", "indigenous"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "noirs", "blancs", "immigrés"),
    ("frauen", "männer", "muslime", "christen", "juden", "schwarze", "weiße", "einwanderer"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "negros", "blancos", "inmigrantes"),
)
#: Neutral sentences with a place for a term.
NEUTRAL = ("{} people live in this town", "she wrote a book about {} families", "the {} community met on sunday", "many {} students study here")


#: A term as a whole word in lower case, and what stands for it a number of places further.
TERM = re.compile(rf"(?<![^\W\d_])(?:{'|'.join(sorted((t for g in IDENTITY_TERMS for t in g), key=len, reverse=True))})(?![^\W\d_])")
PLACE = {t: (g, k) for g in IDENTITY_TERMS for k, t in enumerate(g)}


def swapped(text: str) -> list[str]:
    """Copies of a text whose identity terms are others of their groups; none of a text without terms."""
    low = text.lower()
    if not TERM.search(low):
        return []
    other = lambda m, shift: PLACE[m[0]][0][(PLACE[m[0]][1] + shift) % len(PLACE[m[0]][0])]
    return [TERM.sub(lambda m: other(m, shift), low) for shift in SHIFTS]  # noqa: B023


class WordFeatures:
    """Hashed words in lower case and their beginnings, as (text, feature) without repeats."""

    def __init__(self, bits: int = BITS, beginnings: tuple[int, ...] = BEGINNINGS):
        self.bits, self.beginnings = bits, beginnings

    def of(self, texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """wanted: of each feature whether it is asked for."""
        words = kernels.Words(pc.utf8_lower(kernels.utf8(texts)), kernels.NOT_LETTER)
        own, length = words.owners(), words.ends - words.starts
        rows, found = [], []
        for n in (0, *self.beginnings):  # in bytes
            if n:
                some = length > n
                start = words.starts[some]
                h = kernels.mixed(kernels.ranged(words.data, start, start + n, kernels.BASE, kernels.BYTE_CODES) + U64(n << 32))
            else:
                some, h = slice(None), words.hashes
            f = (h >> U64(64 - self.bits)).astype(np.int64)
            row = own[some]
            if wanted is not None:
                keep = wanted[f]
                row, f = row[keep], f[keep]
            rows.append(row)
            found.append(f)
        code = np.unique((np.concatenate(rows) << self.bits) + np.concatenate(found))
        return code >> self.bits, code & ((1 << self.bits) - 1)


@dataclass
class ToxicityModel:
    weights: np.ndarray  #: one for each feature, most of them 0
    intercept: float
    features: WordFeatures = field(default_factory=WordFeatures)

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, f = self.features.of(texts, self.weights != 0)
        return linear.sigmoid(np.bincount(row, weights=self.weights[f], minlength=len(texts)) + self.intercept)


def train(row: np.ndarray, feature: np.ndarray, label: np.ndarray, features: WordFeatures, copies: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None, l2: float = L2, strength: float = COUNTERFACTUAL, least_z: float = LEAST_Z) -> ToxicityModel:
    """copies: the text of each swapped copy, and (copy, feature) pairs as two arrays."""
    size = 1 << features.bits
    weights = np.zeros(size)
    positive = int(label.sum())
    if not 0 < positive < len(label):
        return ToxicityModel(weights, -40.0, features)
    terms = [t for group in IDENTITY_TERMS for t in group]
    sentences = [s.format(t) for t in terms for s in NEUTRAL]
    extra_row, extra = features.of(pa.array(sentences))
    _, term_feature = features.of(pa.array(terms))
    # Features whose rates differ between the labels, and those of the identity terms.
    n1, n0 = positive, len(label) - positive
    with1 = np.bincount(feature, weights=label[row], minlength=size)
    all_ = np.bincount(feature, minlength=size)
    rate = (all_ + 1) / (len(label) + 2)
    z = np.abs(with1 / n1 - (all_ - with1) / n0) / np.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0))
    chosen = (z >= least_z) & (all_ >= 3)
    chosen[term_feature] = True
    place = np.cumsum(chosen) - 1
    columns = int(chosen.sum())

    def matrix(rows: np.ndarray, found: np.ndarray, n: int) -> linear.Sparse:
        keep = chosen[found]
        return linear.Sparse(rows[keep], place[found[keep]], n)

    x = matrix(np.concatenate([row, extra_row + len(label)]), np.concatenate([feature, extra]), len(label) + len(sentences))
    y = np.concatenate([label, np.zeros(len(sentences))])[:, None]
    weight = np.concatenate([np.where(label > 0, len(label) / (2 * n1), len(label) / (2 * n0)), np.full(len(sentences), 0.05 * len(label) / len(sentences))])
    # Swapped copies of the labelled texts and of the neutral sentences, each beside what it is a copy of.
    of, copy, copy_feature = copies or (np.zeros(0, np.int64),) * 3
    more = [(k, c) for k, s in enumerate(sentences) for c in swapped(s)]
    more_row, more_feature = features.of(pa.array([c for _, c in more]))
    other = matrix(np.concatenate([copy, more_row + len(of)]), np.concatenate([copy_feature, more_feature]), len(of) + len(more))
    of = np.concatenate([of, np.array([k for k, _ in more], np.int64) + len(label)])
    # Labelled texts and sentences have half of the penalty each, if there are both.
    kind = np.where(of < len(label), 0, 1)
    share = (1 / (np.bincount(kind, minlength=2)[kind] * len(np.unique(kind))))[:, None]
    (forth, back), (forth_other, back_other) = x.matrix(columns), other.matrix(columns)

    def penalty(w: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """Gradients of strength times the mean of (score - score of the copy) squared."""
        s, t = linear.sigmoid(forth(w) + b)[of], linear.sigmoid(forth_other(w) + b)
        change = 2 * strength * share * (s - t)
        up, down = change * s * (1 - s), -change * t * (1 - t)
        mine = np.bincount(of, weights=up[:, 0], minlength=x.n)[:, None]
        return [back(mine) + back_other(down), up.sum(0) + down.sum(0)]

    w, b = linear.fit(x, y, weight, columns, l2, penalty if strength else None)
    w[np.abs(w) < 1e-3] = 0
    weights[chosen] = w[:, 0]
    return ToxicityModel(weights, float(b[0]), features)


def learn(labelled: DataFrame, docs: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic", sample_per_label: int = SAMPLE_PER_LABEL, features: WordFeatures | None = None, strength: float = COUNTERFACTUAL) -> ToxicityModel:
    """From labelled(id, label 0/1) and the texts of docs; the sample's labels, two times sample_per_label rows as
    expected, are broadcast."""
    features = features or WordFeatures()
    rows = labelled.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_label")).where("_id is not null and _label is not null")
    share = F.lit(float(sample_per_label)) / F.col("count")
    sample = rows.join(F.broadcast(rows.groupBy("_label").count()), "_label")  # a row for each label
    sample = sample.where(F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("toxicity sample")), F.lit(1 << 30)) < share * (1 << 30)).select("_id", "_label")
    texts = docs.select(F.col(id_column).alias("_doc"), F.col(text).alias("_text"))
    joined = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_id")).select("_label", "_text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.rebatched(batches, "_text"):
            texts = kernels.utf8(batch["_text"])
            changed = [(k, c) for k, t in enumerate(texts.to_pylist()) for c in swapped(t)]
            own = np.concatenate([np.arange(len(batch)), np.array([k for k, _ in changed], np.int64)])
            row, f = features.of(pa.chunked_array([texts, pa.array([c for _, c in changed], pa.large_string())]))
            offsets = np.searchsorted(row, np.arange(len(own) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(f.astype(np.int32)))
            # A text, then its copies: rows of one text follow each other.
            order = np.argsort(own, kind="stable")
            columns = [batch["_label"].take(pa.array(own)), pa.array(np.arange(len(own)) >= len(batch)), lists]
            yield pa.RecordBatch.from_arrays([c.take(pa.array(order)) for c in columns], names=["label", "copy", "features"])

    got = joined.mapInArrow(extract, "label int, copy boolean, features array<int>").toArrow()
    lists = got["features"].combine_chunks()
    if not len(got):
        return train(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), features, strength=strength)
    copy = got["copy"].to_numpy()
    row = np.repeat(np.arange(len(got)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    f = lists.flatten().to_numpy().astype(np.int64)
    text_no, copy_no, is_copy = np.cumsum(~copy) - 1, np.cumsum(copy) - 1, copy[row]
    label = got["label"].to_numpy()[~copy].clip(0, 1).astype(float)
    return train(text_no[row[~is_copy]], f[~is_copy], label, features, (text_no[copy], copy_no[row[is_copy]], f[is_copy]), strength=strength)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", alert: float = ALERT) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 from `alert` on) of each whole text; columns with these names are replaced."""
    docs = docs.drop("score", "predicted")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.rebatched(batches, text):
            s = shared.value.scores(batch[text])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= alert).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.mapInArrow(scored, kernels.added(docs, "score double", "predicted int"))
