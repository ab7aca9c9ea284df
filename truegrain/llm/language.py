"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram's
vector binds those of its letters by products, each rolled by the letter's place; a text's
vector bundles (adds) those of its n-grams; a language's prototype bundles its documents'
vectors. A document gets the language of the greatest cosine.

Words are runs of letters (and combining marks) in lower case, set between blanks, so
n-grams see where words begin and end. What all languages share, the mean of the
normalized prototypes, is taken from prototypes and documents before the cosine.

Sums are of whole numbers, so a model does not depend on the order of rows. A model has a
vector per language and nothing else; ``MOST_LANGUAGES`` bounds what the driver collects
and the tasks receive.

Cases: a text that is NULL or has no letter is ``und`` with score 0; ties go to the first
language in alphabetical order; rows without text or language are not learned from; with
nothing to learn from every row is ``und``; an empty table gives no rows; repeated rows
count each.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.llm import common

SIZE = 1_024
GRAM = 3
#: More than there are codes of languages.
MOST_LANGUAGES = 8_192
#: Cells of a matrix of documents by n-grams.
CELLS = 1 << 22
UNKNOWN = "und"


class Letters:
    """Numbers of letters: 0 is a blank; all that is no letter or mark is a blank."""

    def __init__(self):
        self.number = np.full(0x110000, -1, np.int32)
        self.points = [0x20]
        self.marks = {0}  # numbers that are no letters by themselves

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.number[points]
        new = np.unique(points[found < 0])
        for point in new.tolist():
            kind = unicodedata.category(chr(point))[0]
            if kind in "LM":
                self.number[point] = len(self.points)
                if kind == "M":
                    self.marks.add(len(self.points))
                self.points.append(point)
            else:
                self.number[point] = 0
        return self.number[points] if len(new) else found


class Space:
    """Vectors of letters and n-grams."""

    def __init__(self, size: int = SIZE, gram: int = GRAM):
        self.size, self.gram = size, gram
        self.letters = Letters()
        self.own: list[np.ndarray] = []

    def _letters_up_to(self, count: int) -> np.ndarray:
        for point in self.letters.points[len(self.own) : count]:
            bits = np.random.default_rng([20_24, point]).integers(0, 2, self.size, dtype=np.int8)
            self.own.append(2 * bits - 1)
        return np.array(self.own[:count], np.int8)

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code of every n-gram, its text, and which texts have a letter."""
        parts = [np.frombuffer((" " + t.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        if not len(sizes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        number = self.letters(np.concatenate(parts)).astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        # Blanks in a row as one.
        keep = (number > 0) | np.concatenate([[True], (number[:-1] > 0) | (owner[1:] != owner[:-1])])
        number, owner = number[keep], owner[keep]
        has = np.bincount(owner, ~np.isin(number, list(self.letters.marks)), len(texts)) > 0
        base = len(self.letters.points)
        codes = np.zeros(max(0, len(number) - self.gram + 1), np.int64)
        for i in range(self.gram):
            codes = codes * base + number[i : i + len(codes)]
        inside = owner[: len(codes)] == owner[self.gram - 1 :]
        return codes[inside], owner[: len(codes)][inside], has

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """A vector for each n-gram code."""
        base = len(self.letters.points)
        letters = self._letters_up_to(base)
        found = np.ones((len(codes), self.size), np.int8)
        rest = codes
        for place in range(self.gram):
            found *= np.roll(letters, place, axis=1)[rest % base]
            rest = rest // base
        return found

    def bundles(self, texts: list[str], owners: np.ndarray | None = None, count: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Vector of each text (or of each owner of texts), and which texts have a letter."""
        codes, text, has = self.grams(texts)
        rows = text if owners is None else owners[text]
        count = len(texts) if owners is None else count
        total = np.zeros((count, self.size), np.float64)
        kinds, which = np.unique(codes, return_inverse=True)
        step = max(1, CELLS // max(1, count, self.size))
        order = np.argsort(which, kind="stable") if len(kinds) > step else None
        for begin in range(0, len(kinds), step):
            end = min(begin + step, len(kinds))
            if order is None:
                w, r = which, rows
            else:
                low, high = np.searchsorted(which, [begin, end], sorter=order)
                w, r = which[order[low:high]], rows[order[low:high]]
            table = np.bincount(r * (end - begin) + (w - begin), minlength=count * (end - begin))
            table = table.reshape(count, end - begin).astype(np.float32)
            total += table @ self.vectors(kinds[begin:end]).astype(np.float32)
        return total, has


@dataclass
class Model:
    languages: list[str]
    prototypes: np.ndarray  # languages by size, of norm 1, less the mean
    mean: np.ndarray
    size: int
    gram: int

    def scores(self, bundles: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(bundles, axis=1, keepdims=True)
        centred = bundles / np.maximum(norm, 1e-12) - self.mean
        norm = np.linalg.norm(centred, axis=1, keepdims=True)
        return (centred / np.maximum(norm, 1e-12)) @ self.prototypes.T


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = SIZE, gram: int = GRAM) -> Model:
    """The model of all rows of ``df`` that have a text and a language."""
    source = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )

    def run(batches):
        space, total = Space(size, gram), {}
        for piece in common.slices(batches, "text"):
            langs = piece.column("lang").to_pylist()
            kinds = sorted(set(langs))
            owners = np.array([kinds.index(x) for x in langs])
            bundles, _ = space.bundles(common.texts_of(piece, "text"), owners, len(kinds))
            for lang, own in zip(kinds, np.rint(bundles).astype(np.int64)):
                total[lang] = total[lang] + own if lang in total else own
        if total:
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(list(total)), "sums": pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))}
            )

    summed = (
        source.mapInArrow(run, "lang string, sums array<bigint>")
        .select("lang", F.posexplode("sums").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("cells"))
        .limit(MOST_LANGUAGES + 1)
        .collect()
    )
    if len(summed) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    summed.sort(key=lambda r: r["lang"])
    raw = np.array([[c["value"] for c in r["cells"]] for r in summed], np.float64).reshape(len(summed), size)
    raw /= np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-12)
    mean = raw.mean(axis=0) if len(raw) > 1 else np.zeros(size)
    centred = raw - mean
    centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
    return Model([r["lang"] for r in summed], centred, mean, size, gram)


def _predict(model: Model, space: Space, texts: list[str]) -> tuple[list[str], list[float]]:
    bundles, has = space.bundles(texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    scores = model.scores(bundles)
    best = scores.argmax(axis=1)
    langs = [model.languages[b] if h else UNKNOWN for b, h in zip(best, has)]
    return langs, [float(min(max(s[b], 0.0), 1.0)) if h else 0.0 for s, b, h in zip(scores, best, has)]


def predict(df: DataFrame, model: Model, key: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns of ``key``, ``lang_pred`` and ``score`` of every row."""
    source = df.select(*[c.alias(n) for n, c in key.items()], F.col(text_col).cast("string").alias("_text"))
    names = list(key)
    schema = ", ".join(f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names)

    def work(piece: pa.RecordBatch, space: Space):
        langs, scores = _predict(model, space, common.texts_of(piece, "_text"))
        return {n: piece.column(n) for n in names} | {"lang_pred": langs, "score": scores}

    return common.map_texts(
        source, "_text", schema + ", lang_pred string, score double", work, lambda: Space(model.size, model.gram)
    )


def identified(df: DataFrame, model: Model, text_col: str = "text", least_score: float = 0.0) -> DataFrame:
    """The rows of ``df``, unchanged, whose language can be told with at least ``least_score``.

    Scores are 0 or more, so at 0 only texts without a letter go. If no language was
    learned, none can be unlike it: all texts with a letter stay.
    """

    def run(batches):
        space = Space(model.size, model.gram)
        for piece in common.slices(batches, text_col):
            texts = common.texts_of(piece, text_col)
            if not model.languages:
                yield piece.filter(pa.array([any(map(common.is_letter, t)) for t in texts]))
                continue
            langs, scores = _predict(model, space, texts)
            yield piece.filter(pa.array([x != UNKNOWN and s >= least_score for x, s in zip(langs, scores)]))

    return df.mapInArrow(run, df.schema)
