"""Hierarchical language identification with linear support vector machines.

Features are hashed byte 1- to 3-grams of the whole folded text (square roots
of counts, unit length).  A one-versus-rest machine for each family predicts
the family; inside it, one machine for each pair of languages votes.  All
machines are trained by dual coordinate descent with the weights at hand, on the
sparse features of a bounded sample of labelled documents; the features of the
sample are computed on the executors, so the driver's memory grows with the
non-zero features of at most ``SAMPLE`` documents only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, slices

#: Bounds of the training sample: documents of each language, and of all together
#: (beyond 64 languages each has an equal share).
SAMPLE_PER_LANGUAGE, SAMPLE = 400, 25600
#: Bound of the number of languages learned (the most frequent ones).
MAX_LANGUAGES = 1024

# Families of common language codes; any other code is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic", "nb": "germanic", "nn": "germanic", "is": "germanic", "af": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance", "gl": "romance", "oc": "romance",
    "ru": "slavic", "uk": "slavic", "be": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic", "sr": "slavic", "hr": "slavic", "sl": "slavic", "mk": "slavic",
    "fi": "finnic", "et": "finnic", "lt": "baltic", "lv": "baltic", "hi": "indic", "ur": "indic", "bn": "indic", "mr": "indic", "zh": "sinitic", "yue": "sinitic", "id": "malayic", "ms": "malayic", "tr": "turkic", "az": "turkic", "kk": "turkic",
}

_ONE, _TWO, _THREE = 256, 4096, 12288
WIDTH = _ONE + _TWO + _THREE
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a character is a letter by its Unicode category (number signs are none)."""
    return bool(text) and any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def gram_counts(data: bytes, piece: int = 1 << 20) -> np.ndarray:
    """Counts of the hashed 1- to 3-grams of UTF-8 bytes, in pieces of bounded size."""
    total = np.zeros(WIDTH, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, len(raw), piece):
        b = _FOLD[raw[at : at + piece + 2]]
        n = min(piece, len(raw) - at)
        total[:_ONE] += np.bincount(b[:n], minlength=_ONE)
        two = b[:-1] * np.uint32(256) + b[1:]
        two_all = (two * np.uint32(2654435761)) >> np.uint32(20)
        total[_ONE : _ONE + _TWO] += np.bincount(two_all[:n], minlength=_TWO)
        three = (two[:-1] * np.uint32(256) + b[2:]) * np.uint32(2246822519)
        three = ((three >> np.uint32(15)) * np.uint32(3266489917)) >> np.uint32(8)
        total[_ONE + _TWO :] += np.bincount((three % np.uint32(_THREE))[:n], minlength=_THREE)
    return total


def features(data: bytes) -> np.ndarray:
    x = np.sqrt(gram_counts(data).astype(np.float32))
    return x / max(1e-9, float(np.sqrt(x @ x)))


def train_binary(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 10.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss.

    ``rows`` are the places and values of the non-zero features.
    """
    alpha, weight, bias = np.zeros(len(y)), np.zeros(WIDTH), 0.0
    ridge = 1 / (2 * cost)
    whole = np.array([v @ v + 1 + ridge for _, v in rows])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            at, v = rows[i]
            slope = y[i] * (weight[at] @ v + bias) - 1 + ridge * alpha[i]
            step = max(-alpha[i], -slope / whole[i])
            if step:
                alpha[i] += step
                weight[at] += step * y[i] * v
                bias += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weight, bias


class LanguageModel:
    """Weights of the family machines and of the pair machines inside families."""

    def __init__(self, labels: list[str], x: list[tuple[np.ndarray, np.ndarray]], families: dict[str, str] | None = None):
        families = FAMILIES if families is None else families
        y = np.array(labels)
        self.languages = sorted(set(labels))
        self.family_of = {k: families.get(k, f"={k}") for k in self.languages}
        self.families = sorted(set(self.family_of.values()))
        rows, bias, self.family_rows, self.pair_rows = [], [], {}, {}

        def machine(use: np.ndarray, positive: np.ndarray) -> int:
            weight, at_zero = train_binary([x[i] for i in use], np.where(positive, 1.0, -1.0))
            rows.append(weight.astype(np.float32))
            bias.append(at_zero)
            return len(rows) - 1

        member = np.array([self.family_of[k] for k in labels])
        if len(self.families) > 1:
            for f in self.families:
                self.family_rows[f] = machine(np.arange(len(y)), member == f)
        for f in self.families:
            inside = [k for k in self.languages if self.family_of[k] == f]
            for i, a in enumerate(inside):
                for b in inside[i + 1 :]:
                    use = np.flatnonzero((y == a) | (y == b))
                    self.pair_rows[a, b] = machine(use, y[use] == a)
        self.weights = np.array(rows, dtype=np.float32).reshape(-1, WIDTH).T
        self.bias = np.array(bias, dtype=np.float32)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores of 0 to 1 for rows of features."""
        m = x @ self.weights + self.bias if len(self.bias) else np.zeros((len(x), 0))
        squash = lambda v: 1 / (1 + np.exp(-3 * v))
        if self.family_rows:
            order = list(self.family_rows)
            f = squash(m[:, [self.family_rows[k] for k in order]])
            best, sure = f.argmax(1), f.max(1) / np.maximum(f.sum(1), 1e-9)
        else:
            order, best, sure = self.families, np.zeros(len(x), int), np.ones(len(x))
        names, scores = [""] * len(x), np.zeros(len(x))
        for i, fam in enumerate(order):
            rows = np.flatnonzero(best == i)
            inside = [k for k in self.languages if self.family_of[k] == fam]
            votes, trust = np.zeros((len(rows), len(inside))), np.zeros((len(rows), len(inside)))
            for (a, b), r in self.pair_rows.items():
                if self.family_of[a] == fam:
                    p = squash(m[rows, r])
                    ia, ib = inside.index(a), inside.index(b)
                    votes[:, ia] += p >= 0.5
                    votes[:, ib] += p < 0.5
                    trust[:, ia] += p
                    trust[:, ib] += 1 - p
            pairs = max(1, len(inside) - 1)
            pick = (votes + trust / (pairs + 1)).argmax(1)
            inner = trust[np.arange(len(rows)), pick] / pairs if len(inside) > 1 else np.ones(len(rows))
            for r, k, s in zip(rows, pick, sure[rows] * inner, strict=True):
                names[r], scores[r] = inside[k], s
        return names, np.clip(scores, 0, 1)


def train_language_model(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE, sample: int = SAMPLE, max_languages: int = MAX_LANGUAGES) -> LanguageModel | None:
    """Fit on at most ``per_language`` documents of each of ``max_languages`` languages.

    The sample takes texts by their hash, equal texts once, whole texts, and
    ``sample`` of them at most.  Rows without text, letter or language teach
    nothing.  None where no labelled text has a letter (an empty table, too).
    """
    ship_package(labelled.sparkSession)
    src = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = src.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not counts:
        return None
    per_language = max(1, min(per_language, sample // len(counts)))
    space = 1 << 40
    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(space, space * 2 * per_language // r["count"] + 1))) for r in counts], F.lit(0))
    rare = src.withColumn("h", F.expr(f"pmod(xxhash64(text), {space})")).filter(F.col("h") < share)

    def run(batches):
        for batch in slices(batches):
            out = []
            for lang, h, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text")), strict=True):
                if has_letter(text):
                    c = gram_counts(text.encode())
                    at = np.flatnonzero(c)
                    out.append((lang, h, at.astype(np.int32).tobytes(), c[at].astype(np.int64).tobytes()))
            cols = zip(*out, strict=True) if out else [[]] * 4
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["lang", "h", "at", "n"])

    grams = rare.dropDuplicates(["lang", "h"]).mapInArrow(run, "lang string, h long, at binary, n binary")
    by_lang: dict[str, list] = {}
    for r in grams.orderBy("h").limit(2 * per_language * len(counts)).toLocalIterator():
        if len(kept := by_lang.setdefault(r["lang"], [])) < per_language:
            kept.append((r["at"], r["n"]))
    rows = [(k, *v) for k in sorted(by_lang) for v in by_lang[k]]
    if not rows:
        return None
    x = []
    for _, at, n in rows:
        n = np.frombuffer(n, np.int64)
        x.append((np.frombuffer(at, np.int32), np.sqrt(n / n.sum())))
    return LanguageModel([r[0] for r in rows], x)


def predict_language(docs: DataFrame, model: LanguageModel | None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added (columns of these names are replaced).

    Null texts and texts without a letter are ``und`` with score 0, as is
    everything when there is no model.  Each row is predicted on its own, so
    repeated rows agree; whole texts count, of any length; an empty table gives
    no rows; all other columns are kept as they are.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    src = docs.select(*keep, F.col(text_col).cast("string").alias("__terrafold_text"))

    def run(batches):
        for batch in slices(batches):
            texts = batch.column("__terrafold_text").to_pylist()
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            use = [i for i, t in enumerate(texts) if sent.value is not None and has_letter(t)]
            for at in range(0, len(use), 256):
                part = use[at : at + 256]
                found, sure = sent.value.predict(np.stack([features(texts[i].encode()) for i in part]))
                for i, k, s in zip(part, found, sure, strict=True):
                    names[i], scores[i] = k, s
            yield pa.record_batch([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([*(docs.schema[c] for c in keep), StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return src.mapInArrow(run, schema)


def held_out(id_col: str, parts: int, part: int):
    """Whether the crc32 of the id as text (null: empty) leaves ``part``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == part
