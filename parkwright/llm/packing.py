"""Token sequences of balanced cost, without padding.

A document is its token ids and one end id. Full pieces of CAPACITY ids are
sequences of their own. What remains of the documents is packed in windows of
about WINDOW_IDS ids: the window's sequences are filled in descending order of
length, each piece going to the sequence with the least cost so far (linear in
tokens plus quadratic in the length of each piece, as attention is) that has room
for it; a piece that fits nowhere whole is cut over the sequences with room, the
cheapest first. Ids beyond the last full sequence go on to the next window; at the
end of a task they fill sequences whose lengths are powers of two, which need no
padding.

Token ids come from ranks of the byte-level vocabulary. Text is split at single
spaces between visible characters, where no token can cross, so that each distinct
piece of a batch is encoded once; texts with other white space around a space are
encoded whole. The strings of the tokenizer file's added tokens (the end-of-text mark)
become those tokens wherever they occur, and what lies between is encoded by itself.
All give the ids of the tokenizer file as it is called without further settings.

Scale: everything happens in one pass within the tasks that read the table:
nothing is shuffled or collected, and a task holds one window. Sequence ids are
the partition number and a count within it, so they never clash.

Defined cases: null and empty texts have the end id only. A null id is kept.
Repeated rows are packed each. Very long texts are encoded whole, in the memory of
their task, and cut into full pieces. Of pieces of equal length the first read is
placed first, and of sequences of equal cost the first opened is taken. Columns beyond
doc_id and text are not looked at, whatever their names. No rows in, no rows out.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parkwright.llm.shared import cut, grouped_rank

CAPACITY, END_ID, WINDOW_IDS, BATCH_BYTES = 1024, 0, 1 << 20, 4 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 512
#: White space around a space, or at an end, where a token may cross the space.
_UNSAFE = re.compile(r"\A\s|\s\Z|\s |[ ]\s|\x1e")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def added_tokens(path: str) -> dict[str, int]:
    """String to id of the tokens that a tokenizer file adds to its vocabulary."""
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


class Encoder:
    """Ids of many texts at once, from a tiktoken file, its pattern and added tokens."""

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int]):
        import tiktoken

        self.added = added
        # the longest of strings that start alike
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.bytes_of[rank] = len(token)

    def alone(self, text: str) -> list[int]:
        """The ids of one text, added tokens among them."""
        if self.marks is None:
            return self.plain(text)
        ids: list[int] = []
        for part in self.marks.split(text):
            ids += [self.added[part]] if part in self.added else self.plain(part)
        return ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        marked = lambda t: self.marks is not None and any(a in t for a in self.added)
        safe = [i for i, t in enumerate(texts) if t and not _UNSAFE.search(t) and not marked(t)]
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        rest = set(range(len(texts))) - set(safe)
        for i in rest:
            if texts[i]:
                out[i] = np.array(self.alone(texts[i]), np.int64)
        if not safe:
            return out
        pieces = pc.split_pattern(pc.replace_substring(pa.array([texts[i] for i in safe], pa.large_string()), " ", "\x1e "), "\x1e")
        coded = pc.dictionary_encode(pieces.flatten())
        index, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        firsts = [k for k, w in enumerate(words) if not w.startswith(" ")]
        others = [k for k, w in enumerate(words) if w.startswith(" ")]
        ids: list = [None] * len(words)
        for k in firsts:
            ids[k] = self.plain(words[k])
        if others:
            flat = np.array(self.plain("".join([words[k] for k in others])), np.int64)
            ends = np.cumsum([len(words[k].encode()) for k in others])
            cuts = np.r_[0, np.searchsorted(np.cumsum(self.bytes_of[flat]), ends) + 1]
            for j, k in enumerate(others):
                ids[k] = flat[cuts[j] : cuts[j + 1]]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        pool, starts = np.concatenate([np.asarray(x, np.int64) for x in ids]), np.cumsum(sizes) - sizes
        n = sizes[index]
        ends = np.cumsum(n)
        stream = pool[np.repeat(starts[index] - (ends - n), n) + np.arange(ends[-1])]
        bounds = np.r_[0, ends][pieces.offsets.to_numpy()]
        for j, i in enumerate(safe):
            out[i] = stream[bounds[j] : bounds[j + 1]]
        return out


def powers_of_two(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of at most ``capacity`` (a power of two) that sum to ``n``, largest first."""
    return [capacity] * (n // capacity) + [1 << b for b in range(capacity.bit_length() - 2, -1, -1) if n % capacity >> b & 1]


def balance(lengths: list[int], rooms: list[int]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Place pieces in sequences with ``rooms``; (piece, from, length, sequence), and what finds no room (piece, from)."""
    free, cost = np.array(rooms, np.int64), np.zeros(len(rooms))
    placed, left = [], []

    def put(i: int, start: int, n: int, s: int) -> None:
        placed.append((i, start, n, s))
        free[s] -= n
        cost[s] += LINEAR * n + QUADRATIC * n * n

    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        start, n = 0, lengths[i]
        while n:
            fits = np.where(free >= n, cost, np.inf)
            s = int(fits.argmin()) if len(fits) else 0
            if not len(fits) or not np.isfinite(fits[s]):
                open_ = np.where(free > 0, cost, np.inf)
                s = int(open_.argmin()) if len(open_) else 0
                if not len(open_) or not np.isfinite(open_[s]):
                    left.append((i, start))
                    break
            take = min(n, int(free[s]))
            put(i, start, take, s)
            start, n = start + take, n - take
    return placed, left


class Packer:
    """Pieces of one task's documents, window by window."""

    def __init__(self, partition: int, capacity: int = CAPACITY):
        self.capacity, self.next, self.base = capacity, 0, partition << 36
        self.waiting: list[tuple] = []  # (doc_id, ids of the document, first id left)
        self.held, self.rows = 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        ids = np.append(ids, END_ID).astype("<u4")
        full = len(ids) // self.capacity
        for k in range(full):
            self._row(doc_id, ids, k * self.capacity, self.capacity, self._open(), 0)
        if len(ids) % self.capacity:
            self.waiting.append((doc_id, ids, full * self.capacity))
            self.held += len(ids) % self.capacity

    def _open(self) -> int:
        self.next += 1
        return self.base + self.next - 1

    def _row(self, doc_id, ids, start: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), sequence, offset))

    def pack(self, rooms: list[int]) -> None:
        sequences, used = [self._open() for _ in rooms], [0] * len(rooms)
        placed, left = balance([len(ids) - at for _, ids, at in self.waiting], rooms)
        for i, start, n, s in placed:
            doc_id, ids, at = self.waiting[i]
            self._row(doc_id, ids, at + start, n, sequences[s], used[s])
            used[s] += n
        self.waiting = [(self.waiting[i][0], self.waiting[i][1], self.waiting[i][2] + start) for i, start in sorted(left)]
        self.held = sum(len(ids) - at for _, ids, at in self.waiting)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(SCHEMA)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


_ENCODERS: dict[tuple, Encoder] = {}


def pack(docs: DataFrame, ranks_path: str, pattern: str, added: dict[str, int], capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for each piece of ``docs``."""
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (ranks_path, pattern, *added.items())
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(ranks_path, pattern, added)
        encoder, packer = _ENCODERS[key], Packer(TaskContext.get().partitionId(), capacity)

        def feed(ids: list, texts: list[str]) -> None:
            for doc_id, found in zip(ids, encoder.encode(texts), strict=True):
                packer.add(doc_id, found)

        for b in batches:
            ids, texts, size = [], [], 0
            for i in range(b.num_rows):
                text = b.column(1)[i].as_py() or ""
                ids.append(b.column(0)[i].as_py())
                texts.append(text)
                size += len(text)
                if size >= BATCH_BYTES:
                    feed(ids, texts)
                    ids, texts, size = [], [], 0
                    if packer.held >= WINDOW_IDS:
                        packer.pack([capacity] * (packer.held // capacity))
                    yield packer.take()
            feed(ids, texts)
            if packer.held >= WINDOW_IDS:
                packer.pack([capacity] * (packer.held // capacity))
            yield packer.take()
        packer.pack(powers_of_two(packer.held, capacity))
        yield packer.take()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(work, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def in_order(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """``pieces`` with their sequences numbered from 0 by the least place (doc_id, place) of the documents in them; sequences without one come last."""
    pieces = cut(pieces, "pieces")
    placed = pieces.alias("p").join(places.groupBy("doc_id").agg(F.min("place").alias("place")).alias("o"), F.col("p.doc_id") == F.col("o.doc_id"), "left")
    firsts = placed.groupBy("p.sequence_id").agg(F.min("o.place").alias("place")).select("sequence_id", F.coalesce("place", F.lit(2**62)).alias("place"), F.lit(0).alias("all"))
    ranks = cut(grouped_rank(firsts, ["all"], ["place", "sequence_id"], "rank"), "sequences").alias("r")
    return pieces.alias("p").join(ranks, "sequence_id").select(*[F.col("r.rank" if c == "sequence_id" else f"p.{c}").alias(c) for c in pieces.columns])
