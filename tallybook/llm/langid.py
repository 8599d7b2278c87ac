"""Language identification in two steps: family, then language within it.

Features are hashed runs of one, two and three characters of the lower-case
letters (anything else is one blank), as shares of each kind.  Linear support
vector machines, one per family against the rest, choose the family; within it
one machine per pair of languages votes.

The machines are trained by dual coordinate descent on the driver from at most
about ``SAMPLE`` labelled texts (a hash of id and text picks them, evenly over
the languages); every text is then classified as a whole in the tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, rows_of

SAMPLE = 2000
ONES, TWOS, THREES = 1 << 10, 1 << 11, 1 << 12
WIDTH = ONES + TWOS + THREES
#: characters hashed at a time
STRIDE = 1 << 18
COST = 50.0
ROUNDS = 12

# Language families by language code.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi mr ne or pa si ur",
    "iranian": "fa ku ps tg",
    "turkic": "az kk ky tr tk uz",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "austronesian": "id jv mg ms tl",
    "dravidian": "kn ml ta te",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    """Family of a language code (its main subtag); an unknown one is its own."""
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


_LETTERS = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def counts(text: str | None) -> np.ndarray | None:
    """Feature shares of a whole text; None if it is null or has no letter."""
    low = (text or "").lower()
    total, seen, tail = np.zeros(WIDTH), False, np.array([32], np.uint32)
    for start in range(0, len(low), STRIDE):
        codes = np.frombuffer(low[start:start + STRIDE].encode("utf-32-le", "replace"), np.uint32)
        is_letter = _letters()[codes]
        seen = seen or bool(is_letter.any())
        codes = np.concatenate([tail, np.where(is_letter, codes, np.uint32(32))])
        blank = codes == 32
        codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
        a, b, c = codes[2:], codes[1:-1], codes[:-2]
        new = codes[1:]
        total[:ONES] += np.bincount((new * np.uint32(2654435761)) >> np.uint32(22), minlength=ONES)
        total[ONES:ONES + TWOS] += np.bincount(
            (new * np.uint32(2246822519) + codes[:-1] * np.uint32(3266489917)) * np.uint32(668265263) >> np.uint32(21),
            minlength=TWOS)
        total[ONES + TWOS:] += np.bincount(
            (a * np.uint32(2246822519) + b * np.uint32(3266489917) + c * np.uint32(374761393)) * np.uint32(668265263)
            >> np.uint32(20), minlength=THREES)
        tail = codes[-2:]
    if not seen:
        return None
    for part in (total[:ONES], total[ONES:ONES + TWOS], total[ONES + TWOS:]):
        part /= max(1.0, np.linalg.norm(part))
    return total


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine for labels +1 and -1."""
    rng = np.random.default_rng(11)
    w, alpha = np.zeros(x.shape[1] + 1), np.zeros(len(x))
    square = (x * x).sum(axis=1) + 1.0
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            gradient = y[i] * (x[i] @ w[:-1] + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[:-1] += step * x[i]
                w[-1] += step
                alpha[i] = new
    return w


class Model:
    """Family machines and pair machines; ``predict`` gives language and score."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(v) for v in self.langs})
        lang, family = np.array(langs), np.array([family_of(v) for v in langs])
        self.members = {f: [v for v in self.langs if family_of(v) == f] for f in self.families}
        machines = []
        if len(self.families) > 1:
            machines += [train_svm(x, np.where(family == f, 1.0, -1.0)) for f in self.families]
        self.pairs = {f: list(itertools.combinations(m, 2)) for f, m in self.members.items()}
        for f in self.families:
            for a, b in self.pairs[f]:
                own = (lang == a) | (lang == b)
                machines.append(train_svm(x[own], np.where(lang[own] == a, 1.0, -1.0)))
        self.weights = np.array(machines).reshape(-1, WIDTH + 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        found = counts(text) if self.langs else None
        if found is None:
            return "und", 0.0
        margins = self.weights[:, :-1] @ found + self.weights[:, -1]
        family, score, at = self.families[0], 1.0, 0
        if len(self.families) > 1:
            at = len(self.families)
            best = np.exp(2 * (margins[:at] - margins[:at].max()))
            family, score = self.families[int(best.argmax())], float(best.max() / best.sum())
        for f in self.families:
            if f == family:
                break
            at += len(self.pairs[f])
        wins = {v: 0.0 for v in self.members[family]}
        for (a, b), margin in zip(self.pairs[family], margins[at:], strict=False):
            p = 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))
            wins[a] += (p >= 0.5) + p / 1000
            wins[b] += (p < 0.5) + (1 - p) / 1000
        lang = max(self.members[family], key=wins.get)
        for (a, b), margin in zip(self.pairs[family], margins[at:], strict=False):
            if lang in (a, b):
                score *= float(1 / (1 + np.exp(-2 * np.clip(margin if lang == a else -margin, -30, 30))))
        return lang, score


_SAMPLE = pa.schema([("lang", pa.string()), ("at", pa.list_(pa.int16())), ("value", pa.list_(pa.float32()))])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for lang, text in rows_of(batches):
            found = counts(text)
            if found is not None:
                at = np.flatnonzero(found)
                yield lang, at.astype(np.int16), found[at].astype(np.float32)
    return batches_of(rows(), _SAMPLE, 256)


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from rows ``(doc_id, text, lang)``; null languages teach nothing.

    Bounded: about ``sample`` rows, twice that at most, reach the driver, those
    of the least draws by a hash of id and text, in that order.
    """
    rows = labelled.where(F.col("lang").isNotNull())
    sizes = {lang: n for lang, n in rows.groupBy("lang").count().orderBy("lang").limit(sample).collect()}
    if not sizes:
        return Model(np.empty((0, WIDTH)), [])
    each = max(1, sample // len(sizes))
    rate = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))) for lang, n in sizes.items()])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # in one order whatever the files are, so that the fit is the same
    texts = (rows.where(draw < rate).select("lang", "text", draw.alias("draw"), "doc_id").orderBy("draw", "doc_id", "lang")
             .limit(2 * sample).select("lang", "text"))
    found = texts.mapInArrow(_sampled, "lang string, at array<smallint>, value array<float>").collect()
    x = np.zeros((len(found), WIDTH), np.float32)
    for i, (_, at, value) in enumerate(found):
        x[i, at] = value
    return Model(x, [lang for lang, _, _ in found])


_PRED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    ``und`` with score 0 where the text is null or has no letter, or nothing
    was learned.  Repeated rows and null ids are kept; a null id is not held out.
    """
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(((doc, out, *model.predict(text)) for doc, out, text in rows_of(batches)), _PRED)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text")).mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
