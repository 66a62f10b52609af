"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. Three letters in a row are bound
into one vector: the product of their vectors, rotated by two, one and no
places. The vectors of all n-grams of a text are bundled (added up); so are
those of all training texts of a language, its prototype. A text gets the
language whose prototype has the largest cosine with it.

Letters are lower-cased; everything between letters is one blank. A text's
bundle is its n-gram counts times the n-gram vectors, so a batch of texts is one
matrix product. A prototype is a sum of whole numbers: the order of tasks and
retries cannot change it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
UNKNOWN = "und"
# Learned values of the language column unless ``train`` is given another number: each takes 8 KB of the model.
MAX_LANGUAGES = 1000
# Cells of a block of n-gram counts, and letters counted at once.
CELLS = 1 << 22
LETTERS = 1 << 21

_LOWER: np.ndarray | None = None


def _lower_table() -> np.ndarray:
    """Code point -> lower-case letter, 0 for anything else."""
    global _LOWER
    if _LOWER is None:
        table = np.zeros(0x110000, dtype=np.int64)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                low = char.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _LOWER = table
    return _LOWER


_VECTORS: dict[int, np.ndarray] = {}


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """One random row per letter, the same in every process."""
    if len(_VECTORS) > 20_000:
        _VECTORS.clear()
    rows = []
    for code in letters.tolist():
        if code not in _VECTORS:
            bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, DIMENSIONS, dtype=np.int8)
            _VECTORS[code] = bits * np.int8(2) - np.int8(1)
        rows.append(_VECTORS[code])
    return np.stack(rows)


@dataclass
class Grams:
    """N-grams of some texts: owner text and number of each occurrence, and the distinct ones."""

    text: np.ndarray
    gram: np.ndarray
    letters: np.ndarray
    parts: tuple[np.ndarray, np.ndarray, np.ndarray]

    def vectors(self, block: slice) -> np.ndarray:
        base = letter_vectors(self.letters)
        first, second, third = (p[block] for p in self.parts)
        bound = np.roll(base, 2, axis=1)[first] * np.roll(base, 1, axis=1)[second] * base[third]
        return bound.astype(np.float32)


def grams(texts: list[str]) -> Grams | None:
    """All letter trigrams, blanks at both ends included; None if no text has a letter."""
    data = " ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass")
    codes = _lower_table()[np.frombuffer(data, dtype=np.uint32)]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    owner = np.repeat(np.arange(len(texts) + 1), np.r_[1, lengths + 1])
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[0] = True
    codes, owner = codes[keep], owner[keep]
    letters, dense = _rank(codes)
    if len(letters) < 2:
        return None
    size = np.int64(len(letters))
    # A trigram belongs to the text of its middle letter; runs of blanks between texts are gone.
    middle = dense[1:-1] != 0 if letters[0] == 0 else np.ones(len(dense) - 2, bool)
    code = ((dense[:-2] * size + dense[1:-1]) * size + dense[2:])[middle]
    text = owner[1:-1][middle] - 1
    if size**3 <= 1 << 24:
        present = np.zeros(int(size**3), dtype=bool)
        present[code] = True
        distinct = np.flatnonzero(present)
        number = np.zeros(len(present), dtype=np.int64)
        number[distinct] = np.arange(len(distinct))
        gram = number[code]
    else:
        distinct, gram = np.unique(code, return_inverse=True)
    return Grams(text, gram, letters, (distinct // size**2, distinct // size % size, distinct % size))


def _rank(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse, by table."""
    present = np.zeros(0x110000, dtype=bool)
    present[codes] = True
    letters = np.flatnonzero(present)
    number = np.zeros(0x110000, dtype=np.int64)
    number[letters] = np.arange(len(letters))
    return letters, number[codes]


def _bundles(found: Grams, owner: np.ndarray, owners: int) -> np.ndarray:
    """Sum of n-gram vectors per owner, in blocks of n-grams."""
    total, distinct = np.zeros((owners, DIMENSIONS), dtype=np.float64), len(found.parts[0])
    width = min(distinct, max(256, CELLS // max(1, owners)), 8192)
    for start in range(0, distinct, width):
        if distinct <= width:
            own, gram = owner, found.gram
        else:
            inside = (found.gram >= start) & (found.gram < start + width)
            own, gram = owner[inside], found.gram[inside] - start
        cells = np.bincount(own * width + gram, minlength=owners * width)
        counts = cells.reshape(owners, width)[:, : distinct - start].astype(np.float32)
        total += counts @ found.vectors(slice(start, start + width))
    return total


def _chunks(texts: list[str], rows: int = 256) -> Iterator[slice]:
    """Slices of a bounded number of rows and, but for single long texts, of letters."""
    start, letters = 0, 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= rows or letters + len(text) > LETTERS):
            yield slice(start, i)
            start, letters = i, 0
        letters += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


@dataclass(frozen=True)
class LanguageModel:
    """Languages in name order and one unit row of the prototypes for each."""

    languages: tuple[str, ...]
    prototypes: np.ndarray


def train(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES
) -> LanguageModel:
    """Bundle all given texts by language. Null texts and languages teach nothing.

    Tasks send one vector per language; sums are combined before the shuffle, and
    the driver receives one vector per language.
    """

    def partial(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.iloc[:, 0].tolist(), batch.iloc[:, 1]
            for part in _chunks(texts, 1000):
                codes, names = pd.factorize(langs[part])
                found = grams(texts[part])
                if found is not None:
                    got = _bundles(found, codes[found.text], len(names))
                    for name, row in zip(names, got):
                        sums[name] = sums[name] + row if name in sums else row
        for name, row in sums.items():
            yield pd.DataFrame({"lang": [name], "sums": [np.rint(row).astype(np.int64)]})

    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    sums = rows.mapInPandas(partial, "lang string, sums array<long>").select("lang", F.posexplode("sums"))
    sums = sums.groupBy("lang", "pos").agg(F.sum("col").alias("total")).groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "total"))), lambda x: x["total"]).alias("sums")
    )
    got = sums.orderBy("lang").limit(max_languages + 1).collect()
    if len(got) > max_languages:
        raise ValueError(f"{lang_col} has more than {max_languages} values")
    if not got:
        return LanguageModel((), np.zeros((0, DIMENSIONS)))
    rows = np.array([r["sums"] for r in got], dtype=np.float64)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)
    return LanguageModel(tuple(r["lang"] for r in got), rows)


def classify(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return names, scores
    plain = [t or "" for t in texts]
    for part in _chunks(plain):
        found = grams(plain[part])
        if found is None:
            continue
        bundle = _bundles(found, found.text, part.stop - part.start)
        norm = np.linalg.norm(bundle, axis=1)
        cosine = bundle @ model.prototypes.T / np.maximum(norm, 1e-300)[:, None]
        best = cosine.argmax(axis=1)
        for i in np.unique(found.text):
            names[part.start + i] = model.languages[best[i]]
            scores[part.start + i] = min(1.0, max(0.0, cosine[i, best[i]]))
    return names, scores


def language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> Column:
    """struct(lang, score) for each text of ``docs``.

    ``und`` with score 0 for a null text, a text without letters, or a model
    without languages. Whole texts are read. A tie goes to the language that comes
    first by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = classify(texts.tolist(), shared.value)
            yield pd.DataFrame({"lang": names, "score": scores})

    return predict(F.col(text_col))


def held_out(id_col: Column) -> Column:
    """crc32(id as text) mod 4 is 2; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, lang_pred, score.

    Learns from the text and non-null language of the rows that are not held
    out. Repeated rows count one by one; an empty table gives no rows.
    """
    model = train(docs.where(~held_out(F.col(id_col))), text_col, lang_col)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    said = own.select("id", language(own, model).alias("said"))
    return said.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"),
        F.col("said.lang").alias("lang_pred"), F.col("said.score").alias("score"),
    )
