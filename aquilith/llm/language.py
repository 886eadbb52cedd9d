"""Language identification by a string kernel.

The kernel of two texts is the blended-spectrum presence kernel: the number of
different character n-grams (n = 1 .. ``longest``, lower-cased, hashed to
``width`` features) that both hold, over the geometric mean of their own
numbers. ``landmarks`` training texts span a Nyström approximation of it, in
which one ridge regression a language is solved, each against the rest. A batch
is scored by two matrix products: presence rows by landmark columns, then by
the regressions' weights.

Presence rows fill up as a text grows, so a text longer than ``BLOCK`` is scored
in equal blocks of at most that length, all of it, and its scores are the
blocks' mean: they depend on what a text holds, not on how long it is.

Only a bounded sample of labelled rows is fitted: ``per_language`` different
documents of each of at most ``most_languages`` languages, those with the least
hash of id and text. They are learned whole: a text's features are the mean of its
blocks', as its score is. Executors make them, so what reaches the driver for each
is the presence bits of one block, from which landmarks are taken, and its kernels
with the landmarks, however long the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, batches_of, binary_values, lean, small

UNDETERMINED = "und"
#: Characters of a text that are scored together.
BLOCK = 4000


def features(text: str, width: int, longest: int) -> np.ndarray:
    """The distinct n-gram features of a text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    present = np.zeros(width, bool)
    h = np.zeros(len(codes), np.uint64)
    mask = np.uint64(width - 1)
    for n in range(1, longest + 1):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        spread = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        present[(spread >> np.uint64(40)) & mask] = True
    return np.flatnonzero(present)


def packed(text: str, width: int, longest: int) -> bytes:
    """The presence row of a text, as bits."""
    present = np.zeros(width, bool)
    present[features(text, width, longest)] = True
    return np.packbits(present).tobytes()


def presence(texts: list[str], width: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Presence rows, and their lengths' square roots."""
    x = np.zeros((len(texts), width), np.float32)
    for i, t in enumerate(texts):
        x[i, features(t, width, longest)] = 1
    return x, np.sqrt(np.maximum(x.sum(axis=1), 1))


def _unit_rows(rows: list[bytes]) -> np.ndarray:
    """Packed presence rows scaled to unit length."""
    x = np.unpackbits(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None]


def blocks_of(text: str, size: int = BLOCK):
    """The text in equal parts of at most ``size`` characters; an empty text is one part."""
    n = max(1, -(-len(text) // size))
    return (text[len(text) * i // n : len(text) * (i + 1) // n] for i in range(n))


def _lettered(text: str):
    return filter(has_letter, blocks_of(text)) if has_letter(text) else blocks_of(text)


def kernels(texts: list[str], landmarks: np.ndarray, width: int, longest: int) -> np.ndarray:
    """Kernels of texts with landmarks, which are columns of unit length."""
    x, norm = presence(texts, width, longest)
    return (x @ landmarks) / norm[:, None]


def block_means(texts: list[str], rows_of: Callable[[list[str]], np.ndarray], n: int) -> np.ndarray:
    """Each text's mean over its blocks of what ``rows_of`` says of them; blocks without a letter count only where there are no others."""
    total, number = np.zeros((len(texts), n)), np.zeros(len(texts))
    blocks = ((i, b) for i, t in enumerate(texts) for b in _lettered(t))
    while part := list(islice(blocks, 256)):
        at = [i for i, _ in part]
        np.add.at(total, at, rows_of([b for _, b in part]))
        np.add.at(number, at, 1)
    return total / number[:, None]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # width x m, columns scaled to unit length
    weights: np.ndarray  # (m + 1) x languages
    width: int
    longest: int

    def scores(self, texts: list[str]) -> np.ndarray:
        k = kernels(texts, self.landmarks, self.width, self.longest)
        return np.hstack([k, np.ones((len(k), 1), np.float32)]) @ self.weights

    def whole_scores(self, texts: list[str]) -> np.ndarray:
        """The mean scores of each text's blocks; blocks without a letter count only where there are no others."""
        return block_means(texts, self.scores, len(self.languages))


def fit(texts: list[str], labels: list[str], *, width: int, longest: int, landmarks: int, ridge: float) -> Model:
    """``fit_rows`` of texts."""
    return fit_rows([packed(t, width, longest) for t in texts], labels, width=width, longest=longest, landmarks=landmarks, ridge=ridge)


def fit_rows(rows: list[bytes], labels: list[str], *, width: int, longest: int, landmarks: int, ridge: float, kernel_of: Callable[[np.ndarray], np.ndarray] | None = None) -> Model:
    """Nyström features over evenly drawn landmarks, then one-versus-rest ridge regression.

    ``kernel_of`` gives every row's kernel with the landmarks where a row stands for more
    than its own presence bits, as one block does for a long text.
    """
    languages = sorted(set(labels))
    own: dict[str, list[int]] = {}
    for i, y in enumerate(labels):
        own.setdefault(y, []).append(i)
    pick = [i for lang in languages for i in own[lang][: max(1, landmarks // len(languages))]]  # the same number of each language
    base = _unit_rows([rows[i] for i in pick])
    values, vectors = np.linalg.eigh((base @ base.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # whitens the landmarks' kernel
    kernel = np.vstack([_unit_rows(rows[i : i + 512]) @ base.T for i in range(0, len(rows), 512)]) if kernel_of is None else kernel_of(base)
    phi = np.hstack([kernel @ root, np.ones((len(rows), 1))])
    y = np.where(np.array([languages.index(a) for a in labels])[:, None] == np.arange(len(languages)), 1.0, -1.0)
    penalty = ridge * np.eye(phi.shape[1])
    penalty[-1, -1] = 0
    w = np.linalg.solve(phi.T @ phi + penalty, phi.T @ y)
    return Model(languages, np.ascontiguousarray(base.T), np.vstack([root @ w[:-1], w[-1:]]).astype(np.float32), width, longest)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 150,
    most_languages: int = 256,
    width: int = 1 << 14,
    longest: int = 4,
    landmarks: int = 96,
    ridge: float = 0.5,
) -> Model | None:
    """A model of labelled rows whose id is not held out; None if there are none.

    Held out are ids whose crc32, as text, leaves 1 modulo 3. Rows with a null
    id or label and texts that are null or without a letter are not learned from;
    rows repeated count once. At most ``per_language`` rows are taken of each of
    the ``most_languages`` languages that have most rows (ties by name), whole texts
    however long; a landmark is one block of a text, drawn by its hash. Other columns are ignored. A row is taken by a limit on its
    hash that follows from its language's number of rows, so no task ranks more
    than a few rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    able = rows.filter("id is not null and lang is not null and crc32(cast(id as binary)) % 3 != 1").filter(F.col("text").rlike(r"\p{L}"))
    able = able.withColumn("h", F.xxhash64("id", "text"))
    sizes = able.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("rows"))
    found = sizes.orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not found:
        return None
    limits = [(r.lang, -(1 << 63) + min(int((1 << 64) * 1.25 * per_language / max(1, r.rows)), (1 << 64) - 1)) for r in found]
    limits = F.broadcast(docs.sparkSession.createDataFrame(limits, "lang string, most long"))
    few = able.join(limits, "lang").filter("h <= most").groupBy("lang", "h").agg(F.min(F.struct("id", "text"))["text"].alias("text"))
    few = few.withColumn("r", F.expr("row_number() over (partition by lang order by h)")).filter(F.col("r") <= per_language)
    work = Workspace(docs.sparkSession, "language")
    few = work.put(few.select("lang", "h", "text"))

    @lean()
    def run(batches):
        for b in batches:
            drawn = []
            for text, h in zip(binary_values(b.column(2)), b.column(1).to_pylist(), strict=True):
                blocks = [x for x in blocks_of(text.decode("utf-8", "replace")) if has_letter(x)]
                drawn.append(packed(blocks[h % len(blocks)], width, longest) if blocks else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(drawn, pa.binary())], ["lang", "h", "bits"])

    sample = few.mapInArrow(run, "lang string, h long, bits binary").filter("bits is not null").collect()
    sample = sorted((r.h, r.lang, bytes(r.bits)) for r in sample)
    if not sample:
        return None

    def kernel_of(base: np.ndarray) -> np.ndarray:
        columns = np.ascontiguousarray(base.T)

        @lean()
        def means(batches):
            for b in small(batches, 2):
                texts = [t.decode("utf-8", "replace") for t in binary_values(b.column(2))]
                rows = block_means(texts, lambda part: kernels(part, columns, width, longest), columns.shape[1])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows.tolist(), pa.list_(pa.float64()))], ["lang", "h", "kernel"])

        found = {(r.h, r.lang): r.kernel for r in few.mapInArrow(means, "lang string, h long, kernel array<double>").collect()}
        return np.array([found[s[0], s[1]] for s in sample])

    try:
        return fit_rows([s[2] for s in sample], [s[1] for s in sample], width=width, longest=longest, landmarks=landmarks, ridge=ridge, kernel_of=kernel_of)
    finally:
        work.clear()


def _judge(model: Model | None, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Each text's language, its score, and the margin of its raw score over the next language's."""
    langs, scores, margins = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    texts = [t.decode("utf-8", "replace") if t is not None else "" for t in texts]
    able = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
    for span in batches_of([texts[i] for i in able], 2_000_000):
        rows = able[span.start : span.stop]
        s = model.whole_scores([texts[i] for i in rows])
        best = s.argmax(axis=1)
        top = s[np.arange(len(rows)), best]
        margins[rows] = top - np.partition(s, -2, axis=1)[:, -2] if s.shape[1] > 1 else np.inf
        scores[rows] = np.clip((top + 1) / 2, 0, 1)
        for i, j in zip(rows, best, strict=True):
            langs[i] = model.languages[j]
    return langs, scores, margins


def _predict(model: Model | None):
    @lean()
    def run(batches):
        for b in small(batches, 1):
            langs, scores, _ = _judge(model, binary_values(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(langs), pa.array(scores)], ["id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) for every row, from the text alone.

    A text that is null, empty or has no letter is ``und`` with score 0, as is every
    text where nothing could be learned. A null id is not held out. Long texts
    are scored whole, in blocks; of languages that tie, the first by name is told.
    Other columns are ignored, whatever their names; repeated rows come back
    repeated and equal; an empty table gives an empty one.
    """
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.coalesce(F.expr(f"crc32(cast(cast(`{id_col}` as string) as binary)) % 3 = 1"), F.lit(False)).alias("held_out"),
    )
    id_type = narrow.schema["id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        yield from _predict(sent.value)(batches)

    out = narrow.mapInArrow(run, f"id {id_type}, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model | None, *, text_col: str = "text", margin: float = 0.025, languages: list[str] | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told: not ``und``, and ``margin`` or more ahead of the next.

    The score itself rejects nothing, as it is low for short texts however
    clear. Texts in a language that was not learned are not told from others.
    Texts that are null, empty or without a letter go, as do all texts where
    nothing could be learned and those of two languages that tie. Long texts are
    judged whole; repeated rows share their fate; no column is added or changed.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    allowed, at = set(languages) if languages is not None else None, docs.columns.index(text_col)

    @lean()
    def run(batches):
        for b in small(batches, at):
            langs, _, margins = _judge(sent.value, binary_values(b.column(at)))
            ok = [x != UNDETERMINED and m >= margin and (allowed is None or x in allowed) for x, m in zip(langs, margins.tolist(), strict=True)]
            yield b.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
