"""Readers: datasets by split, files by kind, metrics documents, sample bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parkwright.operators.merging import concatenated
from parkwright.sources.shared import cut

#: Names that a column of audio or of text may have, in order of preference.
AUDIO_COLUMNS = ("audio", "speech", "path")
TEXT_COLUMNS = ("text", "transcript", "sentence", "transcription", "normalized_text", "clean_transcription")
METRICS = "text_normalize string, pooled struct<wer:double,cer:double,n:long>, per_set map<string,struct<wer:double,cer:double,n:long>>"


def resolve(columns: list[str], candidates: tuple[str, ...], given: str | None = None) -> str:
    """The table's own name of the first candidate it has, in any case; of names that differ in case only, the last."""
    by_name = {c.lower(): c for c in columns}
    for name in [given] if given else candidates:
        if name.lower() in by_name:
            return by_name[name.lower()]
    raise ValueError(f"none of {list(candidates) if not given else [given]} in {columns}")


def canonical(df: DataFrame, names: dict[str, tuple[str, ...]]) -> DataFrame:
    """Columns found by their candidates, renamed; the others stay."""
    found = {resolve(df.columns, candidates): name for name, candidates in names.items()}
    return df.select(*[F.col(f"`{c}`").alias(found.get(c, c)) for c in df.columns])


def with_default(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that it may already have."""
    return df if name in df.columns else df.withColumn(name, value)


def load_many(named: dict[str, DataFrame], suite: str | None = None) -> DataFrame:
    rows = concatenated(named)
    return rows if suite is None else rows.withColumn("suite", F.lit(suite))


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def load_split(df: DataFrame, column: str, split: str, order: list[str], cap: int | None = None) -> DataFrame:
    rows = df.where(F.col(column) == split)
    return rows if cap is None else head(rows, order, cap)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any store that Spark reaches."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().getName() for f in found)


def by_extension(files: DataFrame, path: str, extensions: tuple[str, ...], cap: int | None = None) -> DataFrame:
    """Files with one of the extensions, in any case, sorted, at most ``cap``."""
    suffix = F.regexp_extract(F.lower(F.col(path)), r"\.[^./]*$", 0)
    rows = files.where(suffix.isin(*[e.lower() for e in extensions])).orderBy(path)
    return rows if cap is None else rows.limit(cap)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def csv(spark: SparkSession, path: str, columns: list[str], **options: str) -> DataFrame:
    """Every column as text, by position; quoted fields may hold line breaks and quotes, and blank fields read ''.

    Read in as many tasks as the files have splits. Quotes stand around fields, doubled inside them, so a
    line begins inside a field if the number of quotes before it in the file is odd. Lines are numbered and their quotes summed in their own split;
    of the splits, a row each, follows what each begins with. Only lines of records with line breaks are gathered.
    """
    options = {"lineSep": "\n"} | options
    own = Window.partitionBy("file", "start").orderBy("at")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path, lineSep=options["lineSep"]).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), quotes.cast("long").alias("quotes"))
    earlier = F.coalesce(F.sum("quotes").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = cut(lines.select("file", "start", "value", "quotes", F.row_number().over(own).alias("n"), (earlier % 2).alias("odd")), "lines")

    last = lambda odd: F.max(F.when(F.col("odd") == odd, F.col("n")))
    splits = lines.groupBy("file", "start").agg((F.sum("quotes") % 2).alias("quotes"), last(0).alias("even_at"), last(1).alias("odd_at"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    splits = splits.withColumn("last", F.when(F.col("inside") == 0, F.col("even_at")).otherwise(F.col("odd_at")))
    begun = F.last(F.when(F.col("last").isNotNull(), F.struct("start", F.col("last").alias("n"))), ignorenulls=True).over(before)
    splits = splits.select("file", "start", "inside", begun.alias("begun"))

    # a line that begins outside of fields begins a record, and one with even quotes ends it
    placed = lines.join(F.broadcast(splits), ["file", "start"]).withColumn("begins", F.col("odd") == F.col("inside"))
    whole = F.col("begins") & (F.col("quotes") % 2 == 0)
    of = F.coalesce(F.last(F.when(F.col("begins"), F.struct("start", "n")), ignorenulls=True).over(Window.partitionBy("file", "start").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)), "begun")
    parts = placed.where(~whole).withColumn("of", of).groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("start", "n", "value"))).alias("parts"))
    joined = parts.select("of.start", "of.n", F.array_join(F.transform("parts", lambda p: p["value"]), options["lineSep"]).alias("value"))
    records = placed.where(whole).select("start", "n", "value").unionByName(joined)
    # the first record of each file is its header
    records = records.where("not (start = 0 and n = 1) and value <> ''")
    schema = ", ".join(f"`{c}` string" for c in columns)
    return records.select(F.from_csv("value", F.lit(schema), {"quote": '"', "escape": '"', "nullValue": "\u0000"} | options).alias("row")).select("row.*")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a file that holds one JSON array."""
    return spark.read.schema(schema).json(path, multiLine=True)


def indented_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a file that holds one JSON array of objects, indented by two blanks a level, read in as many tasks as it has splits.

    Strings hold no raw line breaks, so a brace after a line break and two blanks ends an object of the array and nothing else.
    """
    one = F.concat(F.regexp_replace("value", r"^[\[,\s]+", ""), F.lit("}"))
    return spark.read.text(path, lineSep="\n  }").where(F.contains("value", F.lit("{"))).select(F.from_json(one, schema).alias("row")).select("row.*")


def parsed_metrics(documents: DataFrame, c: str = "value") -> DataFrame:
    """(group, n, wer, cer) rows of nested documents: pooled, then each set; keys that hold no rates are skipped."""
    doc = documents.select(F.from_json(c, METRICS).alias("m"))
    rows = F.concat(F.array(F.struct(F.lit("pooled").alias("key"), F.col("m.pooled").alias("value"))), F.map_entries("m.per_set"))
    return doc.select(F.explode(rows).alias("e")).where("e.value is not null").select(F.col("e.key").alias("group"), "e.value.n", "e.value.wer", "e.value.cer")


def metrics(spark: SparkSession, path: str) -> DataFrame:
    return parsed_metrics(spark.read.text(path, wholetext=True))


def log_hits(lines: DataFrame, line: str, c: str, patterns: dict[str, str]) -> DataFrame:
    """(line, kind, value): the first group of each pattern that a log line matches."""
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), F.when(F.col(c).rlike(p), F.regexp_extract(c, p, 1)).alias("value")) for kind, p in patterns.items()])
    return lines.select(F.col(line).alias("line"), F.inline(each)).where("value is not null")
