"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

The vocabulary is read from a public SentencePiece model; encoding is our own
agenda over symbols: in each chunk (a run of spaces and the word behind it) the
best-scored adjacent merge is done first, the leftmost of equals, until none is
left. With ``dropout`` p every candidate merge (chunk, place, left and merged
piece) is skipped when its keyed hash falls under p. The key is of the seed, the
text's draw (in ``encode_docs`` the document and copy) and the chunk's number in
the text, so every occurrence of a word is cut by itself, yet repeatably.
Characters without a piece become byte pieces; decoding is lossless.

Chunks are merged many at a time: each round scores all adjacent pairs of the
chunks still active and does one merge in each. What is kept, in a bounded cache,
is each chunk's segmentation without dropout and the merges that lead to it: an
occurrence that skips none of those is cut alike, and only the others are merged
anew.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_values, keeps, mix64, lean, small

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_CHUNK = re.compile(r" *[^ \n]+|\n| +")
#: Chunks above this length go through a heap, one at a time, instead of rounds.
LONG = 48
#: Segmentations held at once by one worker, and without dropout, where no merges are kept with them.
CACHE, CACHE_PLAIN = 200_000, 500_000
_WORST = np.iinfo(np.int32).max


class Pieces:
    """A SentencePiece BPE vocabulary: pair merges, byte pieces and texts of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        if self.size > 1 << 16:
            raise ValueError("the vocabulary exceeds 16-bit ids")
        names = [sp.id_to_piece(i) for i in range(self.size)]
        plain = {n: i for i, n in enumerate(names) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.bytes = np.zeros(256, np.int64)
        self.text = [b""] * self.size
        for i, n in enumerate(names):
            if sp.is_byte(i):
                self.bytes[int(n[1:-1], 16)] = i
                self.text[i] = bytes([int(n[1:-1], 16)])
            elif n in plain:
                self.text[i] = n.replace("▁", " ").encode()
        order = sorted(plain.values(), key=lambda i: (-sp.get_score(i), i))
        self.rank = np.zeros(self.size, np.int64)
        self.rank[order] = np.arange(len(order))
        self.of_char = np.full(0x110000, -1, np.int32)
        pairs = {}
        for n, i in plain.items():
            if len(n) == 1:
                self.of_char[0x20 if n == "▁" else ord(n)] = i
            for at in range(1, len(n)):
                if n[:at] in plain and n[at:] in plain:
                    pairs[plain[n[:at]] << 16 | plain[n[at:]]] = i
        self.of_char[0x2581] = -1  # the mark itself, in a text, is bytes
        self.pairs = pairs
        # open addressing, read for many keys at once
        bits = max(8, (len(pairs) * 6).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots, self.merged = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        for key, i in pairs.items():
            s = int(np.uint64(key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> self.shift)
            while self.slots[s] != -1:
                s = s + 1 & self.mask
            self.slots[s], self.merged[s] = key, i

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Merged ids of pair keys, -1 where a pair has no merge."""
        at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            found = self.slots[at]
            hit = found == keys[rest]
            out[rest[hit]] = self.merged[at[hit]]
            go = ~hit & (found != -1)
            rest, at = rest[go], (at[go] + 1) & self.mask
        return out

    def encode_chunks(self, chunks: list[str], key: int | np.ndarray = 0, dropout: float = 0.0, path: list | None = None) -> list[bytes]:
        """Little-endian 16-bit ids of each chunk; ``key`` is one, or one a chunk.

        ``path`` gets the merges done, in no order: arrays of (chunk number, hash of place and merge).
        """
        if not chunks:
            return []
        if max(map(len, chunks)) <= LONG:
            return self._rounds(chunks, key, dropout, path)
        out = self._rounds([c if len(c) <= LONG else " " for c in chunks], key, dropout, path)
        for i, c in enumerate(chunks):
            if len(c) > LONG:
                done: list | None = None if path is None else []
                out[i] = self._heap(c, key if np.ndim(key) == 0 else int(key[i]), dropout, done)
                if done:
                    pos, left, merged = np.array(done, np.int64).T
                    path.append((np.full(len(done), i, np.int32), self._merge_hash(pos, left, merged)))
        return out

    def _rounds(self, chunks: list[str], key: int | np.ndarray, dropout: float, path: list | None) -> list[bytes]:
        n = len(chunks)
        lengths = np.fromiter(map(len, chunks), np.int32, n)
        begin = np.cumsum(lengths) - lengths
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.of_char[codes]
        own = np.repeat(np.arange(n, dtype=np.int32), lengths)
        pos = np.arange(len(codes), dtype=np.int32) - begin.astype(np.int32)[own]
        salt = self._salts(codes, pos, begin, lengths, key) if dropout else None
        limit = np.uint64(min(int(dropout * 2**64), 2**64 - 1))
        merged = np.full(len(sym), -1, np.int32)  # of the pair that starts here
        score = np.full(len(sym), _WORST, np.int32)  # its rank, then its place

        def rate(at: np.ndarray) -> None:
            a, b = sym[at], sym[at + 1]
            can = (own[at] == own[at + 1]) & (a >= 0) & (b >= 0)
            m = np.full(len(at), -1, np.int64)
            m[can] = self.lookup(a[can].astype(np.int64) << 16 | b[can])
            if dropout:
                can = np.flatnonzero(m >= 0)
                i = at[can]
                m[can[self._draw(salt[own[i]], pos[i], a[can], m[can]) < limit]] = -1
            merged[at] = m
            score[at] = np.where(m >= 0, self.rank[m] * 64 + pos[at], _WORST)

        if len(sym) > 1:
            rate(np.arange(len(sym) - 1))
        done = []
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            best = np.minimum.reduceat(score, first)
            spread = np.diff(np.append(first, len(sym)))
            on = np.repeat(best < _WORST, spread)
            pick = np.flatnonzero((score == np.repeat(best, spread)) & on)
            if path is not None:
                path.append((own[pick], self._merge_hash(pos[pick], sym[pick], merged[pick])))
            sym[pick] = merged[pick]
            keep = on.copy()
            keep[pick + 1] = False
            if not on.all():
                done.append((sym[~on], own[~on], pos[~on]))
            # where the picked symbols are once the others are gone
            now = (np.cumsum(keep) - 1)[pick]
            sym, own, pos, merged, score = sym[keep], own[keep], pos[keep], merged[keep], score[keep]
            if len(sym):
                merged[now], score[now] = -1, _WORST
                before = now[now > 0] - 1
                near = np.zeros(len(sym), bool)
                near[before[own[before] == own[before + 1]]] = True
                near[now[now < len(sym) - 1]] = True
                rate(np.flatnonzero(near))
        sym, own, pos = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (sym, own, pos)
        order = np.argsort(own, kind="stable")
        sym, own, pos = sym[order], own[order], pos[order]
        ends = (2 * np.cumsum(np.bincount(own, minlength=n))).tolist()
        data = sym.astype("<u2").tobytes()
        out = [data[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]
        for i in np.unique(own[sym < 0]).tolist():  # chunks with characters that have no piece
            a, b = (ends[i - 1] if i else 0) // 2, ends[i] // 2
            out[i] = self._with_bytes(sym[a:b].tolist(), [chunks[i][p] for p in pos[a:b]])
        return out

    def _with_bytes(self, sym: list[int], chars: list[str]) -> bytes:
        ids = []
        for s, c in zip(sym, chars, strict=True):
            ids += [s] if s >= 0 else self.bytes[list(c.encode("utf-8", "surrogatepass"))].tolist()
        return np.array(ids, "<u2").tobytes()

    @staticmethod
    def _sums(codes: np.ndarray, pos: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A hash of each chunk's characters."""
        out = np.zeros(len(lengths), np.uint64)
        full = np.flatnonzero(lengths)
        if len(full):
            each = mix64((codes.astype(np.uint64) << np.uint64(32)) + pos.astype(np.uint64), 70)
            out[full] = np.add.reduceat(each, begin[full])
        return out

    @staticmethod
    def _keyed(sums: np.ndarray, key: int | np.ndarray) -> np.ndarray:
        return mix64(sums + (np.uint64(key) if np.ndim(key) == 0 else key), 73)

    @classmethod
    def _salts(cls, codes: np.ndarray, pos: np.ndarray, begin: np.ndarray, lengths: np.ndarray, key: int | np.ndarray) -> np.ndarray:
        """A keyed hash of each chunk's characters."""
        return cls._keyed(cls._sums(codes, pos, begin, lengths), key)

    @staticmethod
    def _merge_hash(pos, left, merged) -> np.ndarray:
        return mix64((pos.astype(np.uint64) << np.uint64(32)) | (left.astype(np.uint64) << np.uint64(16)) | merged.astype(np.uint64), 71)

    @classmethod
    def _draw(cls, salt, pos, left, merged) -> np.ndarray:
        return mix64(salt + cls._merge_hash(pos, left, merged), 72)

    def sums(self, chunks: list[str]) -> np.ndarray:
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        begin = np.cumsum(lengths) - lengths
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        return self._sums(codes, np.arange(len(codes)) - np.repeat(begin, lengths), begin, lengths)

    def _heap(self, chunk: str, key: int, dropout: float, path: list | None = None) -> bytes:
        """The same agenda for one long chunk, in n log n steps."""
        codes = np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), np.uint32)
        sym, n = self.of_char[codes].tolist(), len(codes)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        salt = self._salts(codes, np.arange(n), np.array([0]), np.array([n]), key)
        limit, agenda = int(dropout * 2**64), []

        def push(i: int) -> None:
            j = after[i] if i >= 0 else n
            if i < 0 or j >= n or sym[i] < 0 or sym[j] < 0 or (m := self.pairs.get(sym[i] << 16 | sym[j])) is None:
                return
            if dropout and int(self._draw(salt, np.array([i]), np.array([sym[i]]), np.array([m]))[0]) < limit:
                return
            heapq.heappush(agenda, (int(self.rank[m]), i, j, sym[i], sym[j], m))

        for i in range(n - 1):
            push(i)
        while agenda:
            _, i, j, a, b, m = heapq.heappop(agenda)
            if sym[i] != a or after[i] != j or sym[j] != b:
                continue
            if path is not None:
                path.append((i, a, m))
            sym[i], sym[j], after[i] = m, -2, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(before[i])
            push(i)
        at = [i for i in range(n) if sym[i] != -2]
        return self._with_bytes([sym[i] for i in at], [chunk[i] for i in at])


@lru_cache(maxsize=2)
def load(path: str = MODEL) -> Pieces:
    return Pieces(path)


def slices(text: str, size: int = 1_000_000):
    """The text in parts of about ``size``, cut where a chunk begins."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while (cut := text.find(" ", cut)) != -1 and text[cut - 1] == " ":
            cut += 1
        if cut == -1:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


class _Numbers(dict):
    """Numbers chunks as they are met, so that a known one costs a single look-up; ``new`` are those met since it was emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n


class Encoder:
    """Encodes texts of one vocabulary, seed and dropout; keeps segmentations without dropout.

    ``variants`` only says how many draws a caller deals out: ``ids`` takes any.
    """

    def __init__(self, path: str = MODEL, *, seed: int = 0, dropout: float = 0.0, variants: int = 1):
        self.pieces, self.seed, self.dropout, self.variants = load(path), seed, dropout, variants if dropout else 1
        self._clear()

    def _clear(self) -> None:
        self.number = _Numbers()  # of a chunk, in what follows
        self.plain: list[bytes] = []
        self.sums, self.hashes, self.ends = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(1, np.int64)

    def draw(self, row: object, copy: object = 0) -> int:
        """The draw of a row's copy, from its id."""
        return xxhash.xxh64_intdigest(repr((row, copy)).encode(), self.seed & 0xFFFFFFFFFFFFFFFF)

    def _key(self, draw: int) -> int:
        return int.from_bytes(hashlib.sha256(b"%d %d" % (self.seed, draw)).digest()[:8], "little")

    def ids(self, texts: list[str], draws: list[int]) -> list[bytes]:
        """16-bit ids of each text by its draw; an empty text has none."""
        out: list[list[bytes]] = [[] for _ in texts]
        work: list[tuple[int, int, int, list[str]]] = []
        held = 0
        for i, t in enumerate(texts):
            key, before = self._key(draws[i]), 0
            for part in slices(" " + t) if t else ():
                chunks = _CHUNK.findall(part)
                work.append((i, key, before, chunks))
                before += len(chunks)
                held += len(part)
                if held > 1_000_000:
                    self._flush(work, out)
                    held = 0
        self._flush(work, out)
        return [b"".join(x) for x in out]

    def _learn(self, chunks: list[str]) -> None:
        """Keeps the chunks' segmentations, and with dropout the merges that lead to them."""
        path: list | None = [] if self.dropout else None
        self.plain += self.pieces.encode_chunks(chunks, path=path)
        if path is not None:
            own = np.concatenate([np.zeros(0, np.int32), *(o for o, _ in path)])
            merges = np.concatenate([np.zeros(0, np.uint64), *(h for _, h in path)])
            self.hashes = np.concatenate([self.hashes, merges[np.argsort(own, kind="stable")]])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.bincount(own, minlength=len(chunks)))])
            self.sums = np.concatenate([self.sums, self.pieces.sums(chunks)])

    def _skipping(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which occurrences of the chunks numbered ``at`` skip a merge of their way without dropout."""
        salt = self.pieces._keyed(self.sums[at], keys)
        begin, number = self.ends[at], self.ends[at + 1] - self.ends[at]
        own = np.repeat(np.arange(len(at)), number)
        merge = np.arange(len(own)) + (begin - (np.cumsum(number) - number))[own]
        hit = mix64(salt[own] + self.hashes[merge], 72) < np.uint64(min(int(self.dropout * 2**64), 2**64 - 1))
        out = np.zeros(len(at), bool)
        out[own[hit]] = True
        return np.flatnonzero(out)

    def _flush(self, work: list, out: list) -> None:
        if len(self.number) > (CACHE if self.dropout else CACHE_PLAIN):
            self._clear()
        every = list(chain.from_iterable(w[3] for w in work))
        numbers = list(map(self.number.__getitem__, every))
        if self.number.new:
            self._learn(self.number.new)
            self.number.new = []
        got = list(map(self.plain.__getitem__, numbers))
        if self.dropout and every:
            keys = np.concatenate([mix64(np.arange(n, n + len(c)).astype(np.uint64) + np.uint64(key), 74) for _, key, n, c in work])
            again = self._skipping(np.array(numbers), keys)
            for i, ids in zip(again.tolist(), self.pieces.encode_chunks([every[i] for i in again.tolist()], keys[again], self.dropout), strict=True):
                got[i] = ids
        start = 0
        for i, _, _, chunks in work:
            out[i].append(b"".join(got[start : start + len(chunks)]))
            start += len(chunks)
        work.clear()

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.pieces.text.__getitem__, np.frombuffer(ids, "<u2").tolist()))
        return text[1:].decode("utf-8", "surrogatepass")


@lru_cache(maxsize=4)
def encoder(path: str, seed: int, dropout: float) -> Encoder:
    """One encoder a worker, kept between tasks."""
    return Encoder(path, seed=seed, dropout=dropout)


def _drop() -> None:
    encoder.cache_clear()
    load.cache_clear()


keeps("pieces", _drop)


def _rows(path: str, seed: int, dropout: float, runs: bool):
    @lean("pieces")
    def run(batches):
        e = encoder(path, seed, dropout)
        last, number = None, 0
        for b in small(batches, 1):
            ids, texts = b.column(0).to_pylist(), [t.decode("utf-8", "replace") if t is not None else None for t in binary_values(b.column(1))]
            copies = b.column(2).to_pylist()
            if runs:
                for i, row in enumerate(zip(ids, texts, strict=True)):
                    number = number + 1 if row == last else 0
                    last, copies[i] = row, number
            got = e.ids([t or "" for t in texts], list(map(e.draw, ids, copies)))
            same = [None if t is None else e.decode(g) == t for t, g in zip(texts, got, strict=True)]
            sizes = np.fromiter((len(g) // 2 for g in got), np.int64, len(got))
            flat = pa.array(np.frombuffer(b"".join(got), "<u2").astype(np.int32))
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), tokens, pa.array(same, pa.bool_())], ["id", "n_tokens", "tokens", "lossless"])

    return run


def encode_docs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = MODEL,
    seed: int = 17,
    dropout: float = 0.1,
    copy_col: str | None = None,
    number_runs: bool = False,
) -> DataFrame:
    """(id, n_tokens, tokens, lossless) for every row: ids of the whole text, however long.

    Every occurrence of a word is cut by itself; equal seeds give equal ids.
    ``copy_col`` numbers the copies of a document, which are then cut differently;
    with ``number_runs`` equal rows that follow each other, as a mix writes them,
    are numbered as they are read (a run that a file split parts begins anew).
    ``lossless`` says that the ids decode to the text. A null or empty text has no
    tokens (lossless null or true). Other columns are ignored; repeated rows of
    one copy number come back repeated and equal; an empty table gives an empty one.
    """
    copy = F.lit(0) if copy_col is None else F.col(f"`{copy_col}`").cast("int")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), copy.alias("copy"))
    id_type = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInArrow(_rows(path, seed, dropout, number_runs), f"id {id_type}, n_tokens long, tokens array<int>, lossless boolean")
    return out.withColumnRenamed("id", id_col)


def decode_docs(encoded: DataFrame, *, tokens_col: str = "tokens", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """All columns of ``encoded`` and the text of its token ids.

    Null ids give a null text, no ids an empty one; repeated rows come back repeated, an
    empty table gives an empty one. A column that has the name ``text_col`` already is
    replaced; give another name to keep it.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*(f for f in encoded.schema if f.name != text_col), StructField(text_col, StringType())])

    def run(batches):
        e = encoder(path, 0, 0.0)
        for b in batches:
            rows = b.column(b.schema.get_field_index(tokens_col)).to_pylist()
            texts = [None if r is None else e.decode(np.array(r, "<u2").tobytes()) for r in rows]
            keep = [n for n in b.schema.names if n != text_col]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(n)) for n in keep), pa.array(texts, pa.string())], [*keep, text_col])

    return encoded.mapInArrow(run, schema)
