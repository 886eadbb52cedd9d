"""Tokeniser-fertility quality rules.

Two public vocabularies measure every whole text. A multilingual byte-level BPE
gives its characters per token and the entropy of its tokens; a SentencePiece
BPE gives the byte-fallback share, the part of the words' bytes that lie in
characters without a piece. Each measure has a band by the text's main script;
a text outside any band is rejected, as is one that fails the base rules.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_values, keeps, lean, small

FOLDER = "/opt/tokenizers"
SYMBOLS = [b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"]
SPACES = [b" ", b"\t", b"\n", b"\v", b"\f", b"\r"]
#: Runs of Unicode white space (fixed values) that are too long for the vocabulary's pattern.
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{256,}")


@dataclass(frozen=True)
class Band:
    """What a text of a script must lie in; entropy is in bits a token."""

    chars_per_token: tuple[float, float]
    most_fallback: float
    least_entropy: float


#: By main script. Texts of scripts that the vocabularies hardly cover are
#: mostly single bytes, so their bands are wide there.
BANDS = {
    "latin": Band((1.8, 8.0), 0.20, 4.5),
    "cyrillic": Band((0.5, 6.0), 0.30, 4.5),
    "greek": Band((0.4, 5.0), 0.40, 4.0),
    "cjk": Band((0.2, 3.0), 0.80, 4.0),
    "other": Band((0.15, 5.0), 0.95, 3.5),
    "none": Band((0.5, 6.0), 0.30, 3.5),
}
#: First code points of Unicode ranges, and the script from there on.
_RANGES = [(0, "none"), (0x41, "latin"), (0x5B, "none"), (0x61, "latin"), (0x7B, "none"), (0xC0, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"), (0x2E80, "cjk"), (0xA000, "other"), (0xAC00, "cjk"), (0xD7B0, "other"), (0xF900, "cjk"), (0xFB00, "other"), (0x1F000, "none"), (0x1FC00, "other"), (0x20000, "cjk"), (0x30000, "other")]
SCRIPTS = sorted(BANDS)
_OF = np.zeros(0x110000, np.uint8)
for _first, _script in _RANGES:
    _OF[_first:] = SCRIPTS.index(_script)


def main_script(codes: np.ndarray) -> str:
    """The script of most letters of a text's code points; ``none`` if there are no letters."""
    counts = np.bincount(_OF[codes], minlength=len(SCRIPTS))
    counts[SCRIPTS.index("none")] = 0
    return SCRIPTS[int(counts.argmax())] if counts.any() else "none"


class Vocabularies:
    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        with open(f"{folder}/byte_bpe_multi_50k.tiktoken") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, f)}
        self.bytes = tiktoken.Encoding("multi", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        #: UTF-8 bytes of a character that has no piece, else 0
        self.fallback = np.repeat(np.array([1, 2, 3, 4], np.uint8), [0x80, 0x780, 0xF800, 0x100000])
        self.fallback[[ord(p) for p in map(pieces.id_to_piece, range(pieces.get_piece_size())) if len(p) == 1]] = 0
        self.fallback[[0x20, *range(0x09, 0x0E)]] = 0  # no part of words

    def tokens(self, text: str) -> list[np.ndarray]:
        """The byte-level vocabulary's ids, in parts.

        Its pattern takes a run of white space but for the last character, which
        goes with the word behind it, as one unit; at the end of a text the whole
        run. It backtracks over each character, so a run of a million ends the
        process, and many of a few thousand cost the square of their length: long runs are
        cut out at just these places, which gives the same ids.
        """
        out, start = [], 0
        for run in _RUN.finditer(text):
            stop = run.end() - (run.end() < len(text))
            out += [self._ids(self.bytes, text[start : run.start()]), self._ids(self.whole, text[run.start() : stop])]
            start = stop
        return [*out, self._ids(self.bytes, text[start:])]

    @staticmethod
    def _ids(encoding, text: str) -> np.ndarray:
        return encoding.encode_to_numpy(text, disallowed_special=()) if text else np.empty(0, np.uint32)


@lru_cache(maxsize=1)
def vocabularies(folder: str) -> Vocabularies:
    return Vocabularies(folder)


keeps("fertility", vocabularies.cache_clear)


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, top = np.fromiter(map(number.__getitem__, words), np.int64, n), len(number)
    pairs = ids[:-1] * np.int64(top) + ids[1:]
    if top > 2_000_000:  # three such numbers do not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * np.int64(top) + ids[2:]
    order = np.sort(windows)
    again = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(again):
        return 0
    hit = again[np.minimum(np.searchsorted(again, windows), len(again) - 1)] == windows
    twice = np.zeros(n, bool)
    for i in range(3):
        twice[i : n - 2 + i] |= hit
    return int(twice.sum())


def duplicate_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.split():
            seen.add(line)
    return n


def measure(text: bytes, v: Vocabularies) -> tuple:
    """The row of a text, see ``_SCHEMA``."""
    words, decoded = text.split(), text.decode("utf-8", "replace")
    n_words, n_repeat = len(words), repeat_words(words)
    chars = len(decoded) - sum(map(text.count, SPACES))
    failed = n_words < 50 or 100 * n_repeat > 50 * n_words
    codes = np.frombuffer(decoded.encode("utf-32-le"), np.uint32)
    script = main_script(codes)
    base = (n_words, chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), n_repeat, failed)
    if not n_words:
        return *base, False, script, 0.0, 0.0, 0.0
    tokens = np.concatenate(v.tokens(decoded))
    counts = np.bincount(tokens)
    share = counts[counts > 0] / len(tokens)
    entropy = float(-(share * np.log2(share)).sum())
    fertility, fallback = chars / len(tokens), int(v.fallback[codes].sum()) / (len(text) - (len(decoded) - chars))
    band = BANDS[script]
    fits = band.chars_per_token[0] <= fertility <= band.chars_per_token[1] and fallback <= band.most_fallback and entropy >= band.least_entropy
    return *base, fits and not failed, script, fertility, fallback, entropy


_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, script string, chars_per_token double, fallback_share double, token_entropy double"


def _rows(folder: str):
    @lean("fertility")
    def run(batches):
        v = vocabularies(folder)
        for b in small(batches, 1, 8_000_000):
            rows = [measure(t or b"", v) for t in binary_values(b.column(1))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 11
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()] + [pa.float64()] * 3
            names = ["id", *(x.split()[0] for x in _SCHEMA.split(", "))]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    return run


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER) -> DataFrame:
    """Base counts, the vocabularies' measures and the verdict for every row.

    A null or empty text counts as without words: all counts 0, base_failed, not
    kept, script ``none``. Texts are read whole, however long, white space runs of
    any length included. Other columns are ignored, whatever their names; repeated
    rows come back repeated and equal; an empty table gives an empty one.
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(_rows(folder), f"id {id_type}, {_SCHEMA}").withColumnRenamed("id", id_col)
