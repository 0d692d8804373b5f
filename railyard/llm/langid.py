"""Language identification with a string kernel (operator 10).

The kernel of two texts is the number of distinct character 1-, 2- and 3-grams
they share, over the geometric mean of their numbers of grams (the blended
spectrum kernel on presence). The Nyström method approximates it with `landmarks`
training texts; on that map one kernel ridge regression per language is solved,
one against the rest. Scoring a batch is two matrix products: gram presence times
landmark presence, then times the ridge coefficients.

Learned from a bounded sample of labelled texts of every language; whole texts
are scored. Grams are told apart by all their code points.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import held_out

#: Bits of a code point in a gram's number.
_BITS = 21
#: Characters of one step through a long text, rows of one product.
_STEP, _ROWS = 1 << 20, 256
#: Training texts of all languages together; each language has one at least.
SAMPLE = 19_200


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, 0 for each character that is not a letter."""
    if not text:
        return np.empty(0, np.uint32)
    text = text.lower()
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, at = np.unique(a, return_inverse=True) if not text.isascii() else (np.arange(128, dtype=np.uint32), a)
    letter = np.fromiter((chr(c).isalpha() for c in kinds), bool, len(kinds))
    return np.where(letter, kinds, 0)[at].astype(np.uint32)


def _kinds(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct code points, and for each position the place of its own among them."""
    top = int(code.max()) + 1
    if top > 1 << 14:
        return np.unique(code, return_inverse=True)
    there = np.zeros(top, bool)
    there[code] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[code]


def spectrum(code: np.ndarray) -> np.ndarray:
    """Numbers of the distinct 1-, 2- and 3-grams, runs of separators as one."""
    if not len(code):
        return np.empty(0, np.int64)
    code = code[np.concatenate(([True], (code[1:] != 0) | (code[:-1] != 0)))]
    kinds, at = _kinds(code)
    kinds, at, n, found = kinds.astype(np.int64) + 1, at.astype(np.int64), len(kinds), [kinds.astype(np.int64) + 1]
    for size in (2, 3):
        # a table of all grams of these letters where it is small, else sorting
        seen = np.zeros(n ** size, bool) if n ** size <= min(1 << 24, 65_536 + 64 * len(at)) else None
        used = []
        for s in range(0, max(0, len(at) - size + 1), _STEP):
            c = at[s:s + _STEP + size - 1]
            g = c[:-1] * n + c[1:] if size == 2 else (c[:-2] * n + c[1:-1]) * n + c[2:]
            if seen is None:
                used.append(np.unique(g))
            else:
                seen[g] = True
        if seen is not None:
            g = np.flatnonzero(seen)
        else:
            g = np.unique(np.concatenate(used)) if used else np.empty(0, np.int64)
        number = kinds[g % n]
        for k in range(1, size):
            g = g // n
            number = number | kinds[g % n] << (_BITS * k)
        found.append(number)
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    languages: tuple
    vocabulary: np.ndarray  # gram numbers of the landmarks
    presence: np.ndarray    # landmarks x vocabulary, 0/1
    sizes: np.ndarray       # distinct grams of each landmark
    alpha: np.ndarray       # landmarks x languages

    def kernel(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Kernel of texts and landmarks; whether a text has a letter."""
        x = np.zeros((len(texts), len(self.vocabulary)), np.float32)
        size, any_letter = np.ones(len(texts)), np.zeros(len(texts), bool)
        for i, t in enumerate(texts):
            code = letters(t)
            any_letter[i] = code.any()
            if not any_letter[i]:
                continue
            used = spectrum(code)
            size[i] = len(used)
            at = np.minimum(np.searchsorted(self.vocabulary, used), len(self.vocabulary) - 1)
            x[i, at[self.vocabulary[at] == used]] = 1
        return (x @ self.presence.T) / np.sqrt(size[:, None] * np.maximum(self.sizes, 1)[None, :]), any_letter

    def predict(self, texts: list) -> tuple[list, np.ndarray]:
        lang, score = [], np.zeros(len(texts))
        for i in range(0, len(texts), _ROWS):
            some = texts[i:i + _ROWS]
            if not self.languages:
                lang += ["und"] * len(some)
                continue
            k, ok = self.kernel(some)
            f = k @ self.alpha
            best = f.argmax(1)
            lang += [self.languages[b] if good else "und" for b, good in zip(best, ok)]
            # the winner's regression value (1: its language, -1: another) as a share
            score[i:i + len(some)] = np.where(ok, np.clip((f.max(1) + 1) / 2, 0, 1), 0)
        return lang, score


def fit(texts: list[str], langs: list[str], landmarks: int = 240, ridge: float = 1e-2) -> Model:
    """Ridge regression on the Nyström map; landmarks are spread evenly over the languages."""
    names = tuple(sorted(set(langs)))
    nothing = Model((), np.empty(0, np.int64), np.zeros((0, 0), np.float32), np.empty(0), np.zeros((0, 0)))
    if not names:
        return nothing
    sets = [spectrum(letters(t)) for t in texts]
    per, taken, chosen = max(1, landmarks // len(names)), dict.fromkeys(names, 0), []
    for i, lang in enumerate(langs):
        if taken[lang] < per and len(sets[i]):
            taken[lang] += 1
            chosen.append(i)
    vocabulary = np.unique(np.concatenate([sets[i] for i in chosen])) if chosen else np.empty(0, np.int64)
    presence = np.zeros((len(chosen), len(vocabulary)), np.float32)
    for r, i in enumerate(chosen):
        presence[r, np.searchsorted(vocabulary, sets[i])] = 1
    model = Model(names, vocabulary, presence, np.array([len(sets[i]) for i in chosen], float),
                  np.zeros((len(chosen), len(names))))
    if not chosen:
        return nothing
    k_mm = (presence @ presence.T) / np.sqrt(np.outer(model.sizes, model.sizes))
    val, vec = np.linalg.eigh(k_mm.astype(float))
    good = val > 1e-8 * val.max()
    root = vec[:, good] / np.sqrt(val[good])
    phi = np.concatenate([model.kernel(texts[i:i + _ROWS])[0] for i in range(0, len(texts), _ROWS)]) @ root
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    count = Counter(langs)
    weight = 1.0 / np.sqrt(np.array([count[x] for x in langs]))  # every language counts alike
    a = phi * weight[:, None]
    w = np.linalg.solve(a.T @ a + ridge * np.eye(phi.shape[1]), a.T @ (y * weight[:, None]))
    return Model(names, vocabulary, presence, model.sizes, root @ w)


def train(docs: DataFrame, per_language: int = 300, landmarks: int = 240) -> Model:
    """Learn from at most `per_language` texts of every language, of fewer where there are many languages.

    The sample is the rows with the smallest id hashes among those that are not
    held out and have a letter and a language: the same at every partitioning.
    Of rows that share an id and a language the smallest text is learned.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                      F.col("lang").cast("string").alias("lang"))
    able = src.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    able = able.where(F.col("text").rlike(r"\p{L}"))
    n_languages = able.select("lang").distinct().count()
    if not n_languages:
        return fit([], [])
    per_language = max(1, min(per_language, SAMPLE // n_languages))
    ids = (able.select("doc_id", "lang")
           .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")))
           .where(F.col("r") <= per_language).select("doc_id", "lang").distinct())
    # at most SAMPLE rows of an id and a name, or one of each language
    rows = able.join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r.doc_id * 0x9E3779B97F4A7C15 % (1 << 64), r.doc_id, r.text))
    return fit([r.text for r in rows], [r.lang for r in rows], landmarks)


def _predictor(model: Model):
    def run(batches):
        for rb in batches:
            lang, score = model.predict(rb.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])
    return run


def languages(docs: DataFrame, per_language: int = 300, landmarks: int = 240) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score.

    ``lang_pred`` is a learned language, or ``und`` (score 0) where the text is
    null, empty or has no letter, or where there was nothing to learn from.
    Repeated rows and null ids each get their row; other columns are ignored.
    """
    model = train(docs, per_language, landmarks=landmarks)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = src.mapInArrow(_predictor(model), "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
