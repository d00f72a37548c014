"""Batched prediction functions by name, set up once in a task; a failing row keeps its error beside it."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

Model = Callable[[list], list]


@dataclass(frozen=True)
class Predictor:
    """How a task gets its model, how many rows the model takes at a time, and how often a failed batch is tried again whole."""

    setup: Callable[[], Model]
    batch: int = 4
    retries: int = 1


_PREDICTORS: dict[str, Predictor] = {}


def register(name: str, setup: Callable[[], Model], batch: int = 4, retries: int = 1) -> None:
    """Add a predictor; ``setup`` runs in each task that has rows, and gives a function of a batch of inputs to as many texts."""
    _PREDICTORS[name] = Predictor(setup, batch, retries)


def names() -> list[str]:
    return list(_PREDICTORS)


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _frame_labels() -> Model:
    """Frame paths as text: runs of a label are one letter, 0 parts runs, the label after the last letter's parts words."""
    spelt = {0: "", len(LETTERS) + 1: " "} | {i: x for i, x in enumerate(LETTERS, 1)}

    def one(path: list[int]) -> str:
        unknown = next((x for x in path if x not in spelt), None)
        if unknown is not None:
            raise ValueError(f"label {unknown}")
        return " ".join("".join(spelt[x] for x, _ in groupby(path)).split())

    return lambda batch: [one(path or []) for path in batch]


def _anti_loop() -> Model:
    """Texts without words that repeat the one before, in any case."""

    def one(text: str) -> str:
        words = text.split()
        return " ".join(w for i, w in enumerate(words) if not i or w.lower() != words[i - 1].lower())

    return lambda batch: [one(x or "") for x in batch]


def _casing() -> Model:
    """Texts whose sentences begin in upper case."""
    begins = re.compile(r"(^|[.!?]\s+)([a-zà-ɏ])")
    return lambda batch: [begins.sub(lambda m: m[1] + m[2].upper(), (x or "").strip()) for x in batch]


#: Decoders of what models give; a deployment registers its models beside them.
register("frame_labels", _frame_labels, batch=16)
register("anti_loop", _anti_loop, batch=64)
register("casing", _casing, batch=64)


def answered(model: Model, inputs: list, retries: int) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each input: the whole batch is tried, then again, then each row alone."""
    failure: Exception | None = None
    for _ in range(1 + retries):
        try:
            found = model(inputs)
            if len(found) != len(inputs):
                raise ValueError(f"{len(found)} answers for {len(inputs)} rows")
            return [(y, None) for y in found]
        except Exception as e:  # noqa: BLE001  the row keeps what went wrong
            failure = e
    return [(None, f"[ERROR: {failure}]")] if len(inputs) == 1 else [answered(model, [x], 0)[0] for x in inputs]


def predict(rows: DataFrame, name: str, key: str, audio: str, batch: int | None = None) -> DataFrame:
    """(key, prediction, error, decode_wall_s): rows go to the predictor in batches of one size, whatever Arrow batches they come in; only a task's last is smaller.

    decode_wall_s is a row's share of its batch's seconds, tries included.
    """
    how, kind = _PREDICTORS[name], rows.schema[key].dataType.simpleString()
    size = batch or how.batch

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, keys, inputs, key_type = None, [], [], None

        def done(n: int) -> pa.RecordBatch:
            began = time.perf_counter()
            found = answered(model, inputs[:n], how.retries)
            wall = (time.perf_counter() - began) / n
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys[:n], key_type), pa.array([p for p, _ in found], pa.string()), pa.array([e for _, e in found], pa.string()), pa.array([wall] * n, pa.float64())], names=[key, "prediction", "error", "decode_wall_s"]
            )
            del keys[:n], inputs[:n]
            return out

        for part in parts:
            if model is None and part.num_rows:
                model, key_type = how.setup(), part.schema.field(0).type
            for at in range(0, part.num_rows, size):
                piece = part.slice(at, size)
                keys += piece.column(0).to_pylist()
                inputs += piece.column(1).to_pylist()
                if len(inputs) >= size:
                    yield done(size)
        if inputs:
            yield done(len(inputs))

    return rows.select(key, audio).mapInArrow(work, f"{key} {kind}, prediction string, error string, decode_wall_s double")
