"""Language identification by cross-parsing against labelled text.

Some labelled text of each language is held as a suffix automaton, which knows every
substring of it. A text is parsed against each language in turn: from where the last
phrase ended, the longest match in that language's text is the next phrase (or one byte,
where none begins with it). Phrases times the logarithm of the length of the language's
text is what the text costs in that language, per byte once divided by its length; the
language of least cost wins. The walk follows transitions only: where the automaton has
none, a phrase begins. So the automata are held as tables in which each entry is the next
state and whether a phrase begins, and many texts are walked at a time.

Texts are lower-cased, ASCII bytes other than letters count as spaces, and runs of
spaces as one. A text is parsed in blocks of BLOCK bytes, the same in every language;
a phrase ends where its block does, which adds at most one phrase in BLOCK bytes.

Learning takes a bounded sample: LEARN_BYTES of distinct whole texts of each language, in
the order of their hash, those of over a quarter of that last; only the text that
passes the limit is cut there. With many languages each has an even share of MODEL_BYTES.
A language is learnt in a task of its own, from its sample alone. Automata have at most
two states for each byte. Scoring streams Arrow batches of whole texts and shuffles nothing.

Defined cases: null texts, empty ones and those without a letter are UND, with score 0. Rows
without a language are not learnt from, and a null id counts as not held out (crc32 of the
empty text is 0). Copies of a text are learnt once for each language that labels it. Of
equal costs the language that comes first by its name wins. The score is the runner-up's
share of the two least costs, 0.5 to 1; 1 where only one language is known; without any
language all texts are UND. Very long texts are parsed whole, a bounded number of blocks
at a time. Repeated rows are scored each. Columns beyond doc_id, text and lang are not
looked at, whatever their names. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parkwright.llm.shared import cut, slices, small

LEARN_BYTES, MODEL_BYTES, BLOCK, LANES, UND = 32_768, 1 << 20, 4096, 1024, "und"
#: For each byte, itself if it is a small ASCII letter or part of another character, else a space.
_FOLD = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))


def fold(text: str) -> bytes:
    """``text`` as it is parsed: words between single spaces; empty without a letter."""
    raw = text.lower().encode()
    words = raw.translate(_FOLD).split()
    if not words or (not raw.isascii() and not any(map(str.isalpha, text))):
        return b""
    return b" " + b" ".join(words) + b" "


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """The transitions of each state; state 0 knows nothing yet, and every substring of ``text`` is a path from it."""
    moves, links, lengths, last = [{}], [-1], [0], 0
    for byte in text:
        new, at = len(moves), last
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        while at >= 0 and byte not in moves[at]:
            moves[at][byte] = new
            at = links[at]
        if at >= 0:
            known = moves[at][byte]
            if lengths[known] == lengths[at] + 1:
                links[new] = known
            else:
                # the shorter part of what ``known`` stood for gets a state of its own
                short = len(moves)
                moves.append(dict(moves[known]))
                lengths.append(lengths[at] + 1)
                links.append(links[known])
                links[known] = links[new] = short
                while at >= 0 and moves[at].get(byte) == known:
                    moves[at][byte] = short
                    at = links[at]
        last = new
    return moves


class Language:
    """An automaton as a table: an entry is twice the row that follows, plus one if a phrase begins there.

    The last row is where texts start, and where a byte that the language lacks leads.
    """

    def __init__(self, text: bytes):
        moves, known = suffix_automaton(text), sorted(set(text))
        self.width, self.size = len(known) + 1, max(len(text), 2)
        self.codes = np.full(256, len(known), np.int32)
        self.codes[known] = np.arange(len(known))
        start = len(moves) * self.width
        begins = np.full(self.width, 2 * start + 1, np.int32)
        for byte, to in moves[0].items():
            begins[self.codes[byte]] = 2 * to * self.width + 1
        table = np.tile(begins, (len(moves) + 1, 1))
        for state, own in enumerate(moves):
            for byte, to in own.items():
                table[state, self.codes[byte]] = 2 * to * self.width
        table[0] = begins
        self.table, self.start = table.ravel(), start

    def phrases(self, blocks: np.ndarray, alive: np.ndarray) -> np.ndarray:
        """Phrases in each row of ``blocks`` (bytes by place and row, the longest rows first; ``alive`` rows have a byte at a place)."""
        symbols = self.codes[blocks]
        state, count = np.full(blocks.shape[1], self.start, np.int32), np.zeros(blocks.shape[1], np.int32)
        for own, n in zip(symbols, alive.tolist(), strict=True):
            to = self.table.take(state[:n] + own[:n])
            count[:n] += to & 1
            np.right_shift(to, 1, out=state[:n])
        return count


class Model:
    """The learnt languages, by name."""

    def __init__(self, texts: dict[str, bytes]):
        self.names = sorted(texts)
        self.languages = [Language(texts[n]) for n in self.names]

    def costs(self, texts: list[bytes]) -> np.ndarray:
        """For each of the folded ``texts``, its bits in each language."""
        out = np.zeros((len(texts), len(self.names)))
        pieces = [(t[at : at + BLOCK], i) for i, t in enumerate(texts) for at in range(0, len(t), BLOCK)]
        pieces.sort(key=lambda p: -len(p[0]))
        for at in range(0, len(pieces), LANES):
            part = pieces[at : at + LANES]
            sizes = np.array([len(p) for p, _ in part])
            blocks = np.frombuffer(b"".join(p.ljust(sizes[0], b" ") for p, _ in part), np.uint8).reshape(len(part), sizes[0]).T
            alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
            owners = [i for _, i in part]
            for k, language in enumerate(self.languages):
                out[:, k] += np.bincount(owners, language.phrases(np.ascontiguousarray(blocks), alive) * np.log2(language.size), len(texts))
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        folded = [fold(t or "") for t in texts]
        if not self.names:
            return [(UND, 0.0)] * len(texts)
        costs = self.costs(folded)
        best = costs.argmin(1)
        two = np.sort(np.c_[costs, np.full(len(texts), np.inf)], 1)[:, :2]
        score = np.where(np.isinf(two[:, 1]), 1.0, two[:, 1] / np.maximum(two[:, 0] + np.where(np.isinf(two[:, 1]), 0, two[:, 1]), 1e-9))
        return [(self.names[b], float(s)) if f else (UND, 0.0) for b, s, f in zip(best, score, folded, strict=True)]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample(docs: DataFrame, learn_bytes: int = LEARN_BYTES, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """(lang, text): of each language distinct texts of ``docs`` in the order of their hash, enough for its share of bytes."""
    text = F.col("text").cast("string")
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & text.rlike(r"\p{L}"))
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.xxhash64(text).alias("h"), F.octet_length(text).cast("long").alias("bytes"), text.alias("text"))
    keys = cut(rows.groupBy("lang", "h").agg(F.max("bytes").alias("bytes")), "keys")
    share = max(1, min(learn_bytes, model_bytes // max(1, keys.select("lang").distinct().count())))
    # keys of least hash, some eight times as many bytes as are asked for, so that no task orders a language's texts
    drawn = F.lit(8.0 * share) / F.sum(F.least("bytes", F.lit(share))) + 64 / F.count(F.lit(1))
    parts = cut(keys.groupBy("lang").agg(drawn.alias("drawn")), "parts")
    likely = keys.join(small(parts), "lang").where(F.xxhash64("h", F.lit(1)) / 2.0**64 + 0.5 < F.col("drawn"))
    order = [(F.col("bytes") * 4 > share), F.xxhash64("h", F.lit(1)), F.col("h")]
    before = F.coalesce(F.sum("bytes").over(Window.partitionBy("lang").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = cut(likely.withColumn("before", before).where(F.col("before") < share).select("lang", "h", "before"), "chosen")
    # bounded by the share: a few hundred texts of a language
    found = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h", "before").agg(F.max("text").alias("text"))
    return found.select("lang", "before", "text", F.lit(share).alias("share"))


def learn(docs: DataFrame, learn_bytes: int = LEARN_BYTES, model_bytes: int = MODEL_BYTES) -> Model:
    """The languages of ``docs`` (doc_id, text, lang) outside the held-out third."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["before", "text"])
        text = b"".join(map(fold, rows["text"]))[: int(rows["share"].iloc[0])]
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "learnt": [text]})

    got = sample(docs, learn_bytes, model_bytes).groupBy("lang").applyInPandas(one, "lang string, learnt binary").collect()
    return Model({r["lang"]: bytes(r["learnt"]) for r in got})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = shared.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(work, "doc_id long, lang_pred string, score double")
