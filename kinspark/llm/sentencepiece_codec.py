"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps a score-ordered agenda of adjacent symbol pairs: the pair whose union has the best score is merged first,
the leftmost of equal scores, and its new neighbours join the agenda. Texts are cut where no piece of the vocabulary can
reach across (before a run of spaces, around characters that occur in no longer piece), so equal chunks are encoded
once per task. In each Arrow batch the chunks met for the first time, and some whole texts, are encoded by the
sentencepiece library too; a difference raises an error. Decoding is the library's own.

Defined cases: null is the empty text; the empty text has only the begin and end ids and decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import re
import struct
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, frugal

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Chunks of each of the two generations that a task remembers, the longest worth remembering, and the whole texts of
#: a batch that are checked.
CACHE, LONGEST, WHOLE = 250_000, 48, 2
#: Symbols up to which the agenda is a plain list, and the cost of a pair that makes no piece.
SHORT, NEVER = 40, float("inf")


def _varint(b: bytes, i: int) -> tuple[int, int]:
    shift = out = 0
    while True:
        x = b[i]
        i += 1
        out |= (x & 127) << shift
        shift += 7
        if x < 128:
            return out, i


def _fields(b: bytes):
    """(number, value) of each field of a serialized protocol buffer."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        else:
            if kind == 2:
                n, i = _varint(b, i)
            else:
                n = {1: 8, 5: 4}[kind]
            value, i = b[i : i + n], i + n
        yield key >> 3, value


class _Known(dict):
    """Packed ids by chunk. A chunk that neither generation knows is merged, and noted as fresh until it is checked."""

    def __init__(self, merge):
        self.merge, self.old, self.fresh = merge, {}, []

    def __missing__(self, chunk: str) -> bytes:
        b = self.old.get(chunk)
        if b is None:
            b = self.merge(chunk)
            self.fresh.append((chunk, b))
        if len(chunk) <= LONGEST:
            self[chunk] = b
        return b

    def age(self) -> None:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()

    def forget(self) -> None:
        self.clear()
        self.old = {}
        self.fresh.clear()


class Codec:
    """Encoder of one model. begin and end are the ids around each text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces, norm, trainer = [], {}, {}
        for k, v in _fields(model):
            if k == 1:
                d = dict(_fields(v))
                pieces.append((d[1].decode(), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, NORMAL)))
            elif k == 2:
                trainer = dict(_fields(v))
            elif k == 3:
                norm = dict(_fields(v))
        if trainer.get(3, 1) != 2 or {t for _, _, t in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge-type vocabularies without user-defined or unused pieces are supported")
        if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only the identity normalizer that keeps and escapes white space is supported")
        self.prefix = " " if norm.get(3, 1) else ""
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t == NORMAL}
        self.cost = {p: -s for p, s, t in pieces if t == NORMAL}
        self.unknown = next(i for i, x in enumerate(pieces) if x[2] == UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE} if trainer.get(35, 0) else {}
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        longer = [p for p in self.ids if len(p) > 1]
        pairs = {p[i : i + 2] for p in longer for i in range(len(p) - 1)}  # neighbours that a merge can join
        self.chunks = None
        if self.bytes and not any(SPACE in p.lstrip(SPACE) for p in longer) and not any("\n" in x for x in pairs):
            # signs that pieces join to hardly any letter, figure or other character before them, and those exceptions
            signs = {c for c in {x[1] for x in pairs} | set(self.ids) if len(c) == 1 and not c.isalnum() and c not in (SPACE, " ")}
            before = {c: {x[0] for x in pairs if x[1] == c and x[0] != SPACE and x[0].isalnum()} for c in signs}
            signs = {c for c in signs if len(before[c]) <= 3 and not any(x.isascii() for x in before[c])}
            rare = {x[0] for x in pairs if x[1] in signs and x[0] not in signs and x[0] != SPACE}
            sign, rare = ("".join(map(re.escape, sorted(x))) for x in (signs, rare))
            word = f"[^ {SPACE}\n{sign}]+" + (f"(?:(?<=[{rare}])[{sign}]+[^ {SPACE}\n{sign}]*)*" if sign and rare else "")
            self.chunks = re.compile((f"[ {SPACE}]*[{sign}]*{word}|[ {SPACE}]*[{sign}]+" if sign else f"[ {SPACE}]*{word}") + f"|[ {SPACE}]+|\n+").findall
        self.known = _Known(self._packed)

    def merge(self, chunk: str) -> list[int]:
        """Ids of a text with escaped spaces."""
        sym = list(chunk)
        return self._ids(self._short(sym) if len(sym) <= SHORT else self._long(sym))

    def _packed(self, chunk: str) -> bytes:
        ids = self.merge(chunk.replace(" ", SPACE))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _short(self, sym: list[str]) -> list[str]:
        """The agenda as a list, one cost for each adjacent pair in order: its least, leftmost entry is next."""
        get = self.cost.get
        agenda = [get(a + b, NEVER) for a, b in zip(sym, sym[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            p = sym[i] = sym[i] + sym.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = get(p + sym[i + 1], NEVER)
            if i:
                agenda[i - 1] = get(sym[i - 1] + p, NEVER)
        return sym

    def _long(self, sym: list[str]) -> list[str]:
        """The agenda as a heap, for texts in which a list would cost the square of the length."""
        n, cost = len(sym), self.cost
        nxt, prv = [*range(1, n), -1], [*range(-1, n - 1)]
        agenda = [(cost[p], i, i + 1, p) for i in range(n - 1) if (p := sym[i] + sym[i + 1]) in cost]
        heapify(agenda)
        while agenda:
            _, a, b, p = heappop(agenda)
            if nxt[a] != b or sym[a] is None or sym[a] + sym[b] != p:
                continue  # one of the two has been merged since
            sym[a], sym[b] = p, None
            c = nxt[a] = nxt[b]
            if c >= 0:
                prv[c] = a
                if (q := p + sym[c]) in cost:
                    heappush(agenda, (cost[q], a, c, q))
            z = prv[a]
            if z >= 0 and (q := sym[z] + p) in cost:
                heappush(agenda, (cost[q], z, a, q))
        return [s for s in sym if s is not None]

    def _ids(self, symbols: list[str]) -> list[int]:
        out = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[x] for x in s.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids, with those of begin and end, as little-endian unsigned 32-bit integers."""
        middle = b""
        if text:
            text = self.prefix + text
            if self.chunks is None:
                ids = self.merge(text.replace(" ", SPACE))
                middle = struct.pack(f"<{len(ids)}I", *ids)
            else:
                middle = b"".join(map(self.known.__getitem__, self.chunks(text)))
        return struct.pack("<I", self.begin) + middle + struct.pack("<I", self.end)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)

    def check(self, texts: list[str | None], encoded: list[bytes]) -> None:
        """Compare this batch's first-met chunks and its first whole texts with the library."""
        fresh, lead = self.known.fresh, len(self.library.encode("\n"))  # a line break lets nothing reach across
        for i in range(0, len(fresh), 5000):
            part = fresh[i : i + 5000]
            for (c, b), ids in zip(part, self.library.encode(["\n" + c for c, _ in part], num_threads=1), strict=True):
                if struct.pack(f"<{len(ids) - lead}I", *ids[lead:]) != b:
                    raise ValueError(f"the agenda's ids differ from the library's for {c!r}")
        fresh.clear()
        for t, b in list(zip(texts, encoded, strict=True))[:WHOLE]:
            if [self.begin, *self.library.encode(t or ""), self.end] != list(struct.unpack(f"<{len(b) // 4}I", b)):
                raise ValueError("the agenda's ids of a whole text differ from the library's")
        self.known.age()


_codecs: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    key = hashlib.sha256(model).digest()
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


def encode_documents(df: DataFrame, model: bytes, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True, with_text: bool = False) -> DataFrame:
    """keep, n_tokens, ids_sha256, decoded_sha256 of each row, and its ids (array<int>) and decoded text if asked for."""
    spark = df.sparkSession
    arrow_limits(spark)
    shared = spark.sparkContext.broadcast(model)  # half a megabyte, whatever the input
    src = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.col(text_col).alias("t"))
    schema = src.drop("t").withColumns({"n_tokens": F.lit(0).cast("long"), "ids_sha256": F.lit(""), "decoded_sha256": F.lit("")} | ({"ids": F.array(F.lit(0))} if with_ids else {}) | ({"decoded": F.lit("")} if with_text else {})).schema

    def run(batches):
        c = codec(shared.value)
        try:
            yield from encoded(c, batches)
        finally:  # Spark keeps the worker for tasks of other stages
            c.known.forget()

    def encoded(c, batches):
        for batch in batches:
            texts = batch.column("t").to_pylist()
            enc = [c.encode(t) for t in texts]
            c.check(texts, enc)
            dec, digests = [] if with_text else None, []
            for b in enc:  # one text's ids as Python numbers at a time
                d = c.decode(list(struct.unpack(f"<{len(b) // 4}I", b)))
                digests.append(hashlib.sha256(d.encode()).hexdigest())
                if with_text:
                    dec.append(d)
            cols = batch.columns[: len(keep)]
            cols += [pa.array([len(b) // 4 for b in enc], pa.int64()), pa.array([hashlib.sha256(b).hexdigest() for b in enc], pa.string()), pa.array(digests, pa.string())]
            if with_ids:
                ends = np.cumsum([0, *(len(b) // 4 for b in enc)], dtype=np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(enc), "<i4"))))
            if with_text:
                cols.append(pa.array(dec, pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    for f in schema.fields:
        f.nullable = True
    return src.mapInArrow(frugal(run), schema).toDF(*keep, *schema.fieldNames()[len(keep) :])
