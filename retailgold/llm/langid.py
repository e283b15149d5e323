"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, all else is a word border; n-grams of one to three signs are hashed to ``SIZE`` features.
Document frequencies come from all training documents.  The classifier is fitted by follow-the-regularised-leader with
elastic-net penalties on a sample of at most ``sample`` training documents, spread evenly over the languages, and its
temperature is set on a fifth of them that it was not fitted on.

Texts without a letter (also null and empty ones) are ``und`` with score 0, as is every text when nothing could be learned.
Rows with a null language or key are predicted and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailgold.llm.frames import arrow_schema, by_batch, pieces, small_batches

SIZE = 1 << 15
SAMPLE = 4_000
UNKNOWN = "und"
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(64 - 15)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _letters


def features(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and counts of each whole text; both are empty where it has no letter."""
    lowered = [t.lower() if t else "" for t in texts]
    cuts = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    code = np.frombuffer((" ".join(lowered) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(letters()[code], code, 0).astype(np.uint64)
    with np.errstate(over="ignore"):
        a, b, c = code * _A, code * _B, code * _C
        one, two = a >> _SHIFT, (a[:-1] + b[1:] + _C) >> _SHIFT
        three = (a[:-2] + b[1:-1] + c[2:] + _B) >> _SHIFT
    in_two, in_three = (code[:-1] > 0) | (code[1:] > 0), code[1:-1] > 0
    out = []
    for start, end in zip(cuts[:-1].tolist(), (cuts[1:] - 1).tolist()):
        if not code[start:end].any():
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        # pairs and triples may take in the border before and after the text
        first = max(start - 1, 0)
        keys = np.concatenate([
            one[start:end][code[start:end] > 0], two[first:end][in_two[first:end]], three[first:end][in_three[first:end]],
        ])
        counts = np.bincount(keys.astype(np.int64), minlength=SIZE)
        found = np.flatnonzero(counts)
        out.append((found, counts[found]))
    return out


def weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length 1."""
    x = np.log1p(counts) * idf[found]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # SIZE x languages
    temperature: float = 1.0

    def probabilities(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _softmax(weighted(found, counts, self.idf) @ self.weights[found] / self.temperature)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for found, counts in features(texts):
            if not len(found) or not self.languages:
                names.append(UNKNOWN), scores.append(0.0)
                continue
            p = self.probabilities(found, counts)
            best = int(p.argmax())
            names.append(self.languages[best]), scores.append(float(min(1.0, p[best])))
        return names, scores


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray, rounds: int = 3, rate: float = 1.0, beta: float = 1.0,
    l1: float = 1e-3, l2: float = 1e-3, seed: int = 0,
) -> Model:
    """Follow the regularised leader, one example at a time; then the temperature on each fifth example."""
    languages = sorted({r[2] for r in rows})
    if not languages:
        return Model([], idf, np.zeros((SIZE, 0)))
    k = len(languages)
    z, n, w = np.zeros((SIZE, k)), np.zeros((SIZE, k)), np.zeros((SIZE, k))
    data = [(found, weighted(found, counts, idf), languages.index(lang)) for found, counts, lang in rows]
    held, used = data[::5], [d for i, d in enumerate(data) if i % 5] or data
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(len(used)):
            found, x, y = used[i]
            p = _softmax(x @ w[found])
            p[y] -= 1
            g = x[:, None] * p
            total = n[found] + g * g
            z[found] += g - (np.sqrt(total) - np.sqrt(n[found])) / rate * w[found]
            n[found] = total
            lead = z[found]
            w[found] = np.where(np.abs(lead) <= l1, 0.0, (np.sign(lead) * l1 - lead) / ((beta + np.sqrt(total)) / rate + l2))
    scores = [(x @ w[found], y) for found, x, y in held]
    loss = lambda t: sum(-np.log(max(_softmax(s / t)[y], 1e-300)) for s, y in scores)
    return Model(languages, idf, w, float(min(np.geomspace(0.05, 10, 60), key=loss)))


def held_out(key: str = "doc_id"):
    """True for the fifth of the rows that is never learned from; false for null keys."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def document_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """In how many texts each feature occurs."""
    small_batches(docs.sparkSession)
    schema = arrow_schema("feature int, n bigint")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE, np.int64)
        for (texts,) in pieces(batches, 0):
            for found, _ in features(texts):
                total[found] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], schema=schema)

    out = np.zeros(SIZE, np.int64)
    counted = docs.select(text).mapInArrow(count, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # at most SIZE
    out[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return out


def labelled(known: DataFrame, sizes: dict[str, int], sample: int) -> DataFrame:
    """(place, lang, text) of about ``sample`` rows, about equally many of each language, by place between 0 and 1.

    ``known`` has key, text and lang.  The first ``sample`` by place are the sample; which they are follows from the keys alone.
    The languages' sizes are rows of a join, so their number does not matter to the plan.
    """
    share = known.sparkSession.createDataFrame([(name, n * len(sizes) / sample) for name, n in sizes.items()], "lang string, per_row double")
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / (1 << 20) * F.col("per_row")
    return known.join(share, "lang").select(place.alias("place"), "lang", "text").where("place < 1")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from the rows outside ``held_out`` with a language."""
    known = docs.where(~held_out(key) & F.col(key).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(SIZE), np.zeros((SIZE, 0)))
    frequency = document_frequencies(known, "text")
    idf = np.log((1 + sum(sizes.values())) / (1 + frequency)) + 1
    drawn = labelled(known, sizes, sample)

    def make():
        def work(places, langs, texts):
            rows = zip(places, langs, features(texts))
            kept = [(at, lang, f.astype(np.int32).tobytes(), c.astype(np.int32).tobytes()) for at, lang, (f, c) in rows if len(f)]
            return [list(v) for v in zip(*kept)] if kept else [[], [], [], []]

        return work

    found = by_batch(drawn, make, "place double, lang string, found binary, counts binary", text=2)
    # Arrow columns that are looked into, not copied: the driver holds the sample once
    rows = found.orderBy("place", "lang", "found", "counts").limit(sample).select("lang", "found", "counts").toArrow()
    # in an order of their own, so that the fit does not depend on the order of the tasks
    rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in rows.column_names])).combine_chunks()
    read = lambda b: np.frombuffer(b.as_buffer(), np.int32)
    order = np.random.default_rng(1).permutation(len(rows)).tolist()
    return fit([(read(rows["found"][i]), read(rows["counts"][i]), rows["lang"][i].as_py()) for i in order], idf)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score) for every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE x languages numbers

    def make():
        return lambda keys, held, texts: (keys, held, *shared.value.predict(texts))

    kind = docs.schema[key].dataType.simpleString()
    return by_batch(
        docs.select(key, held_out(key).alias("held_out"), text), make,
        f"`{key}` {kind}, held_out boolean, lang_pred string, score double", text=2,
    )


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, as they are, whose text is in a learned language with a score of at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for part in pieces([batch.select([at])], 0):
                names, scores = shared.value.predict(part[0])
                keep = pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_())
                yield batch.slice(start, len(part[0])).filter(keep)
                start += len(part[0])

    return docs.mapInArrow(run, docs.schema)
