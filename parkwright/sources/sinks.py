"""Writers: prepared tables, row files, result sets, metrics documents, comparison tables."""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from csv import writer

import pyarrow as pa
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parkwright.operators.merging import group_order


def prepared(df: DataFrame, path: str, by: str = "split") -> str:
    """Replace what is at ``path`` with ``df``, in a folder for each split."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)
    return path


def json_rows(df: DataFrame, path: str) -> str:
    """One JSON object a line; other than ASCII is kept as it is."""
    df.write.mode("overwrite").json(path)
    return path


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in order over its partitions, each sorted."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def joined_file(lines: DataFrame, path: str, ends: str, head: str = "", between: str = "", tail: str = "", none: str = "") -> str:
    """One file of the values of ``lines`` (value), each closed by ``ends``, in place of what is at ``path``.

    ``lines`` are in order over their partitions. Each task writes its partition as a part;
    ``head``, ``between`` two parts and ``tail`` are small parts of their own. The parts are
    joined by the store's own concatenation, which moves no bytes where files are lists of
    blocks; where the store has none, the driver's JVM copies them through a buffer. Without lines the file is ``none``.
    """
    spark = lines.sparkSession
    jvm, conf, draft = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), f"{path}.{uuid.uuid4().hex}"
    lines.select("value").write.option("lineSep", ends).option("compression", "none").text(draft)
    at = jvm.org.apache.hadoop.fs.Path
    final, folder = at(path), at(draft)
    store = final.getFileSystem(conf)
    if store.getUri().getScheme() == "file":
        store = store.getRawFileSystem()  # without checksums beside the files
    parts = sorted((f.getPath().toString() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-") and f.getLen() > 0), key=lambda p: p.rsplit("/", 1)[-1])

    def edge(text: str, k: int) -> list[str]:
        if not text:
            return []
        out = store.create(at(f"{draft}/edge-{k}"))
        out.write(text.encode())
        out.close()
        return [f"{draft}/edge-{k}"]

    pieces = edge(head, 0) if parts else edge(none, 0)
    for k, part in enumerate(parts):
        pieces += (edge(between, k) if k else []) + [part]
    pieces += edge(tail, len(parts) + 1) if parts else []
    whole = at(pieces[0]) if pieces else at(f"{draft}/empty")
    if not pieces:
        store.create(whole).close()
    if len(pieces) > 1:
        _concatenate(spark, store, whole, [at(p) for p in pieces[1:]])
    store.delete(final, True)
    if not store.rename(whole, final):
        raise OSError(f"can't write {path}")
    store.delete(folder, True)
    return path


def _concatenate(spark: SparkSession, store, whole, rest: list) -> None:
    """Append the files in ``rest`` to ``whole``."""
    context, first = spark.sparkContext, whole.suffix(".first")
    if store.getUri().getScheme() == "file":
        # this store writes the target anew, from the others
        store.rename(whole, first)
        rest = [first, *rest]
    files = context._gateway.new_array(context._jvm.org.apache.hadoop.fs.Path, len(rest))
    for k, part in enumerate(rest):
        files[k] = part
    try:
        store.concat(whole, files)
    except UnsupportedOperationException:
        store.rename(whole, first)
        out = store.create(whole)
        for part in [first, *rest]:
            given = store.open(part)
            context._jvm.org.apache.hadoop.io.IOUtils.copyBytes(given, out, 1 << 20, False)
            given.close()
        out.close()


def _as_text(rows: DataFrame, one) -> DataFrame:
    """(value) with the text that ``one`` makes of each row's values and of whether it is the first of its partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for b in batches:
            values = []
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                values.append(one(row, first))
                first = False
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])

    return rows.mapInArrow(work, "value string")


def json_array(df: DataFrame, order: list[str], path: str) -> str:
    """One file with an indented JSON array of the rows in order, and a line break at its end; other than ASCII is kept as it is."""
    columns = df.columns

    def one(row: tuple, first: bool) -> str:
        body = json.dumps(dict(zip(columns, row, strict=True)), indent=2, ensure_ascii=False, default=str).replace("\n", "\n  ")
        return f"{'' if first else ','}\n  {body[:-1]}"

    # an object's last brace closes its line, so that no row needs to know which is the last
    return joined_file(_as_text(_ranged(df, order), one), path, ends="}", head="[", between=",", tail="\n]\n", none="[]\n")


def _csv_line(row: tuple) -> str:
    out = io.StringIO()
    writer(out, lineterminator="").writerow(row)
    return out.getvalue()


def csv_file(df: DataFrame, order: list[str], path: str, optional: tuple[str, ...] = ()) -> str | None:
    """One CSV file of the rows in order; none without rows. Its columns are those of the first row: ``optional`` ones that are null there are left out."""
    first = df.orderBy(*order).first()
    if first is None:
        return None
    columns = [c for c in df.columns if c not in optional or first[c] is not None]
    lines = _as_text(_ranged(df, order).select(*columns), lambda row, _: _csv_line(row))
    return joined_file(lines, path, ends="\r\n", head=_csv_line(tuple(columns)) + "\r\n")


def report(lines: DataFrame, path: str) -> str:
    """One text file of (place, line) rows."""
    return joined_file(_ranged(lines.select("place", F.col("line").alias("value")), ["place"]), path, ends="\n")


def csv(df: DataFrame, path: str) -> str:
    """CSV with a header; quotes are doubled, and blank fields kept apart from none."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', quoteAll=True, lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def metrics_value(rates: DataFrame, mode: str) -> DataFrame:
    """One nested document of long (group, n, wer, cer) rows, as JSON text in ``value``."""
    entry = F.struct("wer", "cer", "n")
    sets = F.map_from_entries(F.collect_list(F.when(F.col("group") != "pooled", F.struct(F.col("group").alias("k"), entry.alias("v")))))
    pooled = F.first(F.when(F.col("group") == "pooled", entry), ignorenulls=True)
    return rates.agg(pooled.alias("pooled"), sets.alias("per_set")).select(F.to_json(F.struct(F.lit(mode).alias("text_normalize"), "pooled", "per_set")).alias("value"))


def metrics_document(rates: DataFrame, mode: str, path: str) -> str:
    metrics_value(rates, mode).coalesce(1).write.mode("overwrite").text(path)
    return path


def result_set(rows: DataFrame, rates: DataFrame, mode: str, path: str, order: list[str], optional: tuple[str, ...] = ()) -> dict[str, str | None]:
    """Predictions as one CSV file and one JSON array, in order, and their metrics document."""
    return {"csv": csv_file(rows, order, f"{path}/predictions.csv", optional), "json": json_array(rows, order, f"{path}/predictions.json"), "metrics": metrics_document(rates, mode, f"{path}/metrics.json")}


def markdown(sides: DataFrame) -> DataFrame:
    """(place, line) of a comparison table of (group, base_wer, tuned_wer): pooled first, then by name."""
    part = lambda c: F.floor(F.col(c) * 10000).cast("string")
    line = F.concat(F.lit("| "), "group", F.lit(" | "), part("base_wer"), F.lit(" | "), part("tuned_wer"), F.lit(" |"))
    return sides.select(line.alias("line"), F.row_number().over(Window.orderBy(*group_order())).alias("place"))


def flush(df: DataFrame, by: str, path: str) -> str:
    """Replace only the partitions that ``df`` has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return path
