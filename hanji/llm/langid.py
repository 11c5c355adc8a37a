"""Language identification by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import staged

#: Lengths of the character n-grams, hash buckets, and pseudo-counts for a bucket.
GRAMS, BUCKETS, SMOOTH = (1, 2, 3), 1 << 15, 0.5
#: Code points of text in memory at once, how margins become probabilities, and the score below which a prediction is
#: flagged as ambiguous.
WINDOW, SCALE, AMBIGUOUS = 65_536, 6.0, 0.6
#: The score from which a text's language is beyond doubt, and the letters of the parts in which other texts are read again.
SURE, PART = 0.95, 200
#: Languages whose counts a task holds at once, languages that are compared at once when codewords are chosen, and the
#: least weight of a bit for a language.
HELD, BLOCK, LEAST = 64, 1024, 0.01


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """(languages, bits) of -1 and 1: all ways to part up to six languages in two, else random columns of which the
    best of many draws by least distance between rows is kept (ten bits for each doubling of languages)."""
    if languages <= 6:
        columns = [[1 if k in side else -1 for k in range(languages)] for n in range(languages) for rest in combinations(range(1, languages), n) if (side := {0, *rest}) and len(side) < languages]
        return np.array(columns or [[1] * languages], dtype=np.float64).T
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(languages))), (-1, None)
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (languages, bits))
        best = max(best, (least_distance(code), code), key=lambda x: x[0])
    return best[1]


def least_distance(code: np.ndarray) -> float:
    """The least number of bits in which two rows differ, some rows at a time."""
    nearest = -np.inf
    for at in range(0, len(code), BLOCK):
        alike = code[at : at + BLOCK] @ code.T
        alike[np.arange(len(alike)), np.arange(at, at + len(alike))] = -np.inf
        nearest = max(nearest, alike.max())
    return (code.shape[1] - nearest) / 2


def gram_buckets(text: str, starts: int | None = None) -> np.ndarray:
    """Buckets of all n-grams of a text, hashed by code point; starts: only of those that begin so early."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    parts = []
    for n in GRAMS:
        size = min(len(codes) - n + 1, starts or len(codes))
        if size > 0:
            h = np.full(size, np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            for k in range(n):
                h = (h ^ codes[k : size + k]) * np.uint64(0xFF51AFD7ED558CCD)
            parts.append((h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def windows(text: str) -> Iterator[np.ndarray]:
    """The buckets of a whole text, some windows of it at a time; each n-gram belongs to the window in which it begins."""
    for at in range(0, max(len(text), 1), WINDOW):
        yield gram_buckets(text[at : at + WINDOW + max(GRAMS) - 1], WINDOW)


class Cleaner(dict):
    """A translation table that learns for each code point whether it is a letter."""

    def __missing__(self, code: int) -> int:
        self[code] = code if chr(code).isalpha() else 32
        return self[code]


_clean = Cleaner()


def cleaned(text: str) -> str:
    """Lower case, with every run of other characters than letters as one space."""
    return " " + " ".join(text.lower().translate(_clean).split()) + " "


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) -> the n-gram counts of each language among a task's documents, as one row of BUCKETS counts; with more
    than HELD languages in parts, of which there are several for a language."""
    sums: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "bucket": at.astype(np.int32), "n": counts[at]})
        sums.clear()

    for batch in batches:
        for part in tokens.portions(batch):
            for text, lang in zip(tokens.texts_of(part), part.column("lang").to_pylist(), strict=True):
                if lang not in sums and len(sums) == HELD:
                    yield from rows()
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for found in windows(cleaned(text)):
                    own += np.bincount(found, minlength=BUCKETS)
    yield from rows()


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    #: A row of weights for each bucket, a column for each bit of the code.
    weights: np.ndarray
    #: For each language and bit, how far the bit's classifier is right about the language's training documents.
    reliable: np.ndarray

    def margins(self, text: str) -> tuple[np.ndarray, int]:
        """Each bit's margin, and the number of n-grams."""
        total, n = np.zeros(self.code.shape[1]), 0
        for found in windows(cleaned(text)):
            total += self.weights[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return np.clip(SCALE * total / max(n, 1), -20, 20), n

    def losses(self, text: str) -> tuple[np.ndarray, int]:
        """Loss of each language: the exponential loss of each bit's margin against the language's codeword, weighted by
        how sure the bit's classifier is and how reliable it is for the language; and the number of n-grams."""
        margin, n = self.margins(text)
        weight = self.reliable * np.abs(margin)
        weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-12)
        return (np.exp(-self.code * margin / 2) * weight).sum(axis=1), n


def _sides(totals: dict[str, float], code: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) in order -> bucket, yes, no: for each bit the summed shares of the bucket in the languages that
    have the bit set, and in those that have not."""
    place = {lang: k for k, lang in enumerate(sorted(totals))}
    seen: dict[int, int] = {}
    sums = np.zeros((0, 2, code.shape[1]))
    for batch in batches:
        buckets, langs = batch.column("bucket").to_pylist(), batch.column("lang").to_pylist()
        at = [seen.setdefault(b, len(seen)) for b in buckets]
        sums = np.concatenate([sums, np.zeros((len(seen) - len(sums), 2, code.shape[1]))])
        share = batch.column("n").to_numpy() / np.array([totals[x] for x in langs])
        own = code[[place[x] for x in langs]] > 0
        np.add.at(sums, at, share[:, None, None] * np.stack([own, ~own], axis=1))
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(sums[:, k].ravel()), code.shape[1]).cast(pa.list_(pa.float64())) for k in (0, 1)]
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), *lists], ["bucket", "yes", "no"])


def _right(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) -> lang, bit, n, sure: a task's documents of each language, and those about which the bit is right."""
    place = {lang: k for k, lang in enumerate(model.languages)}
    right, n = np.zeros(model.code.shape, np.int64), np.zeros(len(place), np.int64)
    for batch in batches:
        for part in tokens.portions(batch):
            for text, lang in zip(tokens.texts_of(part), part.column("lang").to_pylist(), strict=True):
                n[place[lang]] += 1
                right[place[lang]] += model.margins(text)[0] * model.code[place[lang]] > 0
    found = np.flatnonzero(n)
    bits = model.code.shape[1]
    yield pa.RecordBatch.from_pydict({"place": np.repeat(found, bits), "bit": np.tile(np.arange(bits), len(found)), "n": np.repeat(n[found], bits), "right": right[found].ravel()})


def train(labelled: DataFrame) -> Model | None:
    """labelled (text, lang) -> a model, None without rows. All rows and all languages count: tasks add up n-gram counts
    by language and bucket, then shares by bucket and bit. What reaches the driver is BUCKETS rows of bits, and for each
    language its name and its reliable bits; bits grow with the logarithm of the number of languages.

    The classifier of a bit holds, for each n-gram, the log-odds of its share in the languages that have the bit set
    against those that have not, languages counting alike whatever their number of documents. A second pass over the rows
    counts for each language how often a bit is right (one more right and one more wrong are added); 1 for always, LEAST
    for half of the time or less.
    """
    counts = staged(labelled.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "gram-counts")
    total = counts.groupBy("lang").agg(F.sum("n").alias("n")).toArrow()
    totals = {lang: n + SMOOTH * BUCKETS for lang, n in zip(total.column("lang").to_pylist(), total.column("n").to_pylist(), strict=True)}
    languages = sorted(totals)
    if not languages:
        return None
    code = codewords(len(languages))
    sides = counts.repartition("bucket").sortWithinPartitions("bucket", "lang").mapInArrow(partial(_sides, totals, code), "bucket int, yes array<double>, no array<double>").toArrow()
    floor = np.array([SMOOTH / totals[x] for x in languages])
    weights = []
    for name, has in (("yes", code > 0), ("no", code < 0)):
        sums = np.tile(floor @ has, (BUCKETS, 1))
        sums[sides.column("bucket").to_numpy()] += sides.column(name).combine_chunks().flatten().to_numpy().reshape(-1, code.shape[1])
        weights.append(sums / np.maximum(has.sum(axis=0), 1))
    alone = (code > 0).all(axis=0)
    model = Model(languages, code, np.where(alone, 1.0, np.log(weights[0] / np.where(alone, 1.0, weights[1]))).astype(np.float32), np.ones(code.shape))
    shared = labelled.sparkSession.sparkContext.broadcast(model)
    right = labelled.mapInArrow(lambda batches: _right(shared.value, batches), "place long, bit long, n long, right long").groupBy("place", "bit").agg(F.sum("n").alias("n"), F.sum("right").alias("right")).toArrow()
    at = right.column("place").to_numpy(), right.column("bit").to_numpy()
    model.reliable[at] = np.maximum(2 * (right.column("right").to_numpy() + 1) / (right.column("n").to_numpy() + 2) - 1, LEAST)
    return model


FOUND = "lang_pred string, score double, runner_up string, evidence long, decided double"


def scores(loss: np.ndarray) -> np.ndarray:
    p = np.exp(loss.min() - loss)
    return p / p.sum()


def decided(model: Model, text: str) -> float:
    """The share of a text's n-grams in parts of PART letters whose language is beyond doubt, whichever it is."""
    text, sure, total = cleaned(text), 0, 0
    for at in range(0, len(text), PART):
        loss, n = model.losses(text[at : at + PART])
        total += n
        sure += n * bool(scores(loss).max() >= SURE)
    return sure / max(total, 1)


def found_in(model: Model | None, text: str) -> dict:
    if model is None or not any(map(str.isalpha, text)):
        return {"lang_pred": "und", "score": 0.0, "runner_up": None, "evidence": 0, "decided": 0.0}
    loss, n = model.losses(text)
    p, order = scores(loss), np.argsort(loss, kind="stable")
    first, second = [model.languages[x] for x in order[:2]] if len(order) > 1 else (model.languages[0], None)
    best = float(p[order[0]])
    return {"lang_pred": first, "score": best, "runner_up": second, "evidence": n, "decided": 1.0 if best >= SURE else decided(model, text)}


def predictor(docs: DataFrame, model: Model | None) -> Callable[[Column], Column]:
    """text -> struct of FOUND."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(FOUND)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        schema = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("runner_up", pa.string()), ("evidence", pa.int64()), ("decided", pa.float64())])
        for batch in texts:
            yield pa.array([found_in(shared.value, batch[k].as_py() or "") for k in range(len(batch))], schema)

    # So declared, the optimizer doesn't evaluate it once more for a filter on its result.
    return predict.asNondeterministic()


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its doc_id as text, modulo 4, is 2. False for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Documents (doc_id, text, lang, ...) -> doc_id, held_out, lang_pred, score, runner_up, evidence, decided, ambiguous.

    Trains on the documents that are not held out and have a language, then predicts every whole text from the text
    alone. `und` with score 0 for null texts and texts without a letter, and for all when there is nothing to learn
    from. Of equal losses the language first in code-point order wins. evidence: the text's number of n-grams.
    decided: the share of them in parts whose language is beyond doubt (all, if the whole text's is): high for texts in
    several learned languages, low for other languages and none. ambiguous: the score is below AMBIGUOUS. Repeated rows give repeated rows; other columns are ignored. carry: instead
    of doc_id a struct `row` holds all columns; only the text goes through Python.
    """
    labelled = docs.filter(~held_out() & F.col("lang").isNotNull()).select("text", "lang")
    model = train(labelled)
    key = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if carry else F.col("doc_id")
    found = docs.select(key, held_out().alias("held_out"), predictor(docs, model)(F.col("text")).alias("found"))
    return found.select("row" if carry else "doc_id", "held_out", "found.*", (F.col("found.score") < AMBIGUOUS).alias("ambiguous"))
