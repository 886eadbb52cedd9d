"""The wire record: schemaless Avro binary, decoded permissively.

The decoder returns a null struct for a payload it cannot read (cut short, a bad
enum or union index, text that is no UTF-8) and ignores bytes behind the last
field, which newer producers may append. Where Spark's Avro module is on the class
path, payloads are decoded in the JVM; stock Spark ships none, so both directions
are Arrow functions that work on a field of all rows of a batch at once.
``encode`` and ``decode`` state the same record by record.
"""

from __future__ import annotations

import json
import struct
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT, UNITS

#: The record's fields and their wire types, in order.
FIELDS = [
    ("meter_id", "string"),
    ("reading_timestamp", "millis"),
    ("ingest_timestamp", "millis"),
    ("reading_value", "double"),
    ("unit", "enum"),
    ("flow_rate", "double?"),
    ("battery_pct", "int?"),
    ("signal_quality", "int?"),
    ("dma_id", "string"),
    ("firmware_version", "string"),
    ("sequence_no", "long"),
]


def _zigzag(n: int) -> bytes:
    n, out = (n << 1) ^ (n >> 63), bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _millis(v: str | datetime) -> int:
    at = datetime.fromisoformat(v) if isinstance(v, str) else v
    since = (at if at.tzinfo else at.replace(tzinfo=UTC)) - datetime(1970, 1, 1, tzinfo=UTC)
    return (since.days * 86_400_000_000 + since.seconds * 1_000_000 + since.microseconds) // 1000


def encode(record: dict) -> bytes | None:
    """The record's bytes; None where a required field is null."""
    out = []
    for name, kind in FIELDS:
        v = record[name]
        if kind.endswith("?"):
            if v is None:
                out.append(b"\x00")
                continue
            out.append(b"\x02")
            kind = kind[:-1]
        if v is None:
            return None
        if kind == "string":
            data = str(v).encode()
            out.append(_zigzag(len(data)) + data)
        elif kind == "double":
            out.append(struct.pack("<d", v))
        elif kind == "enum":
            if v not in UNITS:
                return None
            out.append(_zigzag(UNITS.index(v)))
        elif kind == "millis":
            out.append(_zigzag(_millis(v)))
        else:
            out.append(_zigzag(int(v)))
    return b"".join(out)


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise ValueError("cut short")
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        n = shift = 0
        while True:
            (b,) = self.take(1)
            n |= (b & 0x7F) << shift
            if b < 0x80:
                break
            shift += 7
            if shift > 63:
                raise ValueError("a number of over 64 bits")
        return (n >> 1) ^ -(n & 1)

    def value(self, kind: str):
        if kind.endswith("?"):
            branch = self.long()
            if branch not in (0, 1):
                raise ValueError("no such branch")
            return self.value(kind[:-1]) if branch else None
        if kind == "string":
            return self.take(self.long()).decode("utf-8")
        if kind == "double":
            return struct.unpack("<d", self.take(8))[0]
        if kind == "enum":
            n = self.long()
            if not 0 <= n < len(UNITS):
                raise ValueError("no such symbol")
            return UNITS[n]
        if kind == "int":
            n = self.long()
            if not -(1 << 31) <= n < 1 << 31:
                raise ValueError("no 32-bit number")
            return n
        return self.long()


def decode(data: bytes | None) -> tuple | None:
    """The record's values, times as milliseconds; None for an unreadable payload."""
    if data is None:
        return None
    reader = _Reader(bytes(data))
    try:
        return tuple(reader.value(kind) for _, kind in FIELDS)
    except (ValueError, UnicodeDecodeError, struct.error):
        return None


_ARROW = {"string": pa.string(), "millis": pa.int64(), "double": pa.float64(), "enum": pa.string(), "int": pa.int32(), "long": pa.int64()}
_SPARK = {"string": T.StringType(), "millis": T.LongType(), "double": T.DoubleType(), "enum": T.StringType(), "int": T.IntegerType(), "long": T.LongType()}
_WIRE = T.StructType([T.StructField("ok", T.BooleanType()), *(T.StructField(n, _SPARK[k.rstrip("?")]) for n, k in FIELDS)])


def _pieces(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of all bytes of pieces that begin at ``start`` and have ``size`` bytes."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class _Batch:
    """Payloads side by side; ``at`` is each row's place, ``ok`` whether it can still be read."""

    def __init__(self, payloads: pa.Array):
        payloads = payloads.cast(pa.large_binary())
        size = pc.fill_null(pc.binary_length(payloads), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ok = pc.is_valid(payloads).to_numpy(zero_copy_only=False).copy()
        data = np.frombuffer(b"".join(v for v in payloads.to_pylist() if v is not None), np.uint8)
        self.data = np.append(data, np.zeros(8, np.uint8))  # reads behind the end are caught by ``end``
        self.end = np.cumsum(size)
        self.at = self.end - size

    def _need(self, size) -> None:
        self.ok &= (size >= 0) & (self.at + np.maximum(size, 0) <= self.end)

    def long(self, where: np.ndarray) -> np.ndarray:
        """The numbers of rows ``where``; 0 elsewhere."""
        n, going = np.zeros(len(self.at), np.uint64), where & self.ok
        for shift in range(0, 70, 7):
            if not going.any():
                break
            short = going & (self.at >= self.end)
            self.ok &= ~short
            going &= ~short
            byte = np.where(going, self.data[np.where(going, self.at, 0)], 0).astype(np.uint64)
            n |= (byte & np.uint64(0x7F)) << np.uint64(min(shift, 63)) if shift < 63 else (byte & np.uint64(1)) << np.uint64(63)
            self.at += going
            more = going & (byte >= 0x80)
            if shift == 63:
                self.ok &= ~more & ~(going & (byte > 1))
            going = more
        return (n >> np.uint64(1)).view(np.int64) ^ -(n & np.uint64(1)).view(np.int64)

    def double(self, where: np.ndarray) -> np.ndarray:
        mine = where & self.ok
        self._need(np.where(mine, 8, 0))
        mine &= self.ok
        out = np.zeros(len(self.at))
        out[mine] = self.data[self.at[mine][:, None] + np.arange(8)].copy().view("<f8").ravel()
        self.at = self.at + np.where(mine, 8, 0)
        return out

    def string(self, where: np.ndarray) -> pa.Array:
        size = np.where(where & self.ok, self.long(where), 0)
        self._need(size)
        size = np.where(self.ok, size, 0)
        text = self.data[_pieces(self.at, size)]
        self.at = self.at + size
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        raw = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(text.tobytes())])
        try:
            return raw.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # some text is no UTF-8
            out = []
            for i, v in enumerate(raw.to_pylist()):
                try:
                    out.append(v.decode("utf-8"))
                except UnicodeDecodeError:
                    self.ok[i] = False
                    out.append(None)
            return pa.array(out, pa.string())


def _decode(payloads: pa.Array) -> pa.Array:
    """Structs of ``_WIRE``."""
    b, columns = _Batch(payloads), []
    every = np.ones(len(payloads), bool)
    for _, kind in FIELDS:
        where = every
        if kind.endswith("?"):
            branch = b.long(every)
            b.ok &= (branch == 0) | (branch == 1)
            where = branch == 1
        kind, none = kind.rstrip("?"), ~where
        if kind == "string":
            columns.append(b.string(where))
        elif kind == "double":
            columns.append(pa.array(b.double(where), mask=none))
        elif kind == "enum":
            n = b.long(where)
            b.ok &= (n >= 0) & (n < len(UNITS))
            columns.append(pa.array(UNITS).take(pa.array(np.where(b.ok, n, 0))))
        else:
            n = b.long(where)
            if kind == "int":
                b.ok &= (n >= -(1 << 31)) & (n < 1 << 31)
                n = np.where(b.ok, n, 0)
            columns.append(pa.array(n, mask=none).cast(_ARROW[kind]))
    return pa.StructArray.from_arrays([pa.array(b.ok), *columns], ["ok", *(n for n, _ in FIELDS)])


def schema_json() -> str:
    """The record's Avro schema."""
    kinds = {"string": "string", "double": "double", "int": "int", "long": "long", "millis": {"type": "long", "logicalType": "timestamp-millis"}, "enum": {"type": "enum", "name": "unit_kind", "symbols": list(UNITS)}}
    fields = [{"name": n, "type": ["null", kinds[k[:-1]]] if k.endswith("?") else kinds[k]} for n, k in FIELDS]
    return json.dumps({"type": "record", "name": "reading", "fields": fields})


def native(spark: SparkSession | None) -> bool:
    """Whether Spark's Avro module is on the class path."""
    if spark is None:
        return False
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        return False
    return True


def decoded(payload: Column) -> Column:
    """The payload's record as a struct; a null struct where it cannot be read."""
    if native(SparkSession.getActiveSession()):
        from pyspark.sql.avro.functions import from_avro

        wire = from_avro(payload, schema_json(), {"mode": "PERMISSIVE"})
        # a record that cannot be read has null fields; the numbering never is null in one that can
        fields = [wire[f.name].cast(f.dataType).alias(f.name) for f in EVENT.fields]
        return F.when(wire["sequence_no"].isNotNull(), F.struct(*fields))
    wire = F.arrow_udf(_decode, _WIRE)(payload)
    fields = []
    for f, (_, kind) in zip(EVENT.fields, FIELDS, strict=True):
        value = wire[f.name]
        fields.append((F.timestamp_millis(value) if kind == "millis" else value).cast(f.dataType).alias(f.name))
    return F.when(wire["ok"], F.struct(*fields))


def _varints(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the numbers behind each other, and each one's number of bytes."""
    rest = ((n << 1) ^ (n >> 63)).view(np.uint64)
    rows, size = np.zeros((len(n), 10), np.uint8), np.ones(len(n), np.int64)
    for i in range(10):
        left = rest >> np.uint64(7)
        rows[:, i] = (rest & np.uint64(0x7F)).astype(np.uint8) | np.where(left > 0, 0x80, 0).astype(np.uint8)
        size += (left > 0) & (size == i + 1)
        rest = left
    return rows[np.arange(10) < size[:, None]], size


def _encode(*columns: pa.Array) -> pa.Array:
    """The records' bytes; null where a required field is null or a unit is unknown."""
    n = len(columns[0])
    parts, good = [], np.ones(n, bool)
    for (_, kind), column in zip(FIELDS, columns, strict=True):
        there = pc.is_valid(column).to_numpy(zero_copy_only=False)
        if kind.endswith("?"):
            parts.append((np.where(there, 2, 0).astype(np.uint8), np.ones(n, np.int64)))
        else:
            good &= there
        kind = kind.rstrip("?")
        if kind == "string":
            text = column.cast(pa.large_binary())
            size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            parts += [_varints(size), (np.frombuffer(b"".join(v or b"" for v in text.to_pylist()), np.uint8), size)]
            continue
        if kind == "double":
            data, size = pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False).astype("<f8").view(np.uint8), np.full(n, 8)
        else:
            if kind == "enum":
                column = pc.index_in(column, pa.array(UNITS))
                good &= pc.is_valid(column).to_numpy(zero_copy_only=False)
            elif kind == "millis":
                column = column.cast(pa.timestamp("us")).cast(pa.int64())
            number = pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            data, size = _varints(number // 1000 if kind == "millis" else number)
        data, keep = np.asarray(data), np.repeat(there, size)
        parts.append((data[keep], np.where(there, size, 0)))
    total = sum(size for _, size in parts)
    begin = np.cumsum(total) - total
    out, at = np.empty(int(total.sum()), np.uint8), begin.copy()
    for data, size in parts:
        out[_pieces(at, size)] = data
        at = at + size
    ends = np.append(begin, total.sum()).astype(np.int64)
    whole = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())])
    return pc.if_else(pa.array(good), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def encoded() -> Column:
    """The Avro bytes of the columns named as the record's fields; null where a required one is null or the unit unknown."""
    return F.arrow_udf(_encode, T.BinaryType())(*[F.col(n) for n, _ in FIELDS])
