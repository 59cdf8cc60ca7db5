"""Interview transcripts: labelled lines, caption cues and documents as segments, then turns with roles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as x
from ..operators import conversation

# Forms of a time stamp, of lines that open a turn, and of names.
STAMP = r"\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?"
STAMP_FIRST = rf"^[\[(]?({STAMP})[\])]?\s*[-–—]?\s*([^:]{{1,40}}?)\s*:\s*(.*)$"
SPEAKER_STAMP = rf"^([^:\[\]()]{{1,40}}?)\s*[\[(]?({STAMP})[\])]?\s*:\s*(.*)$"
HEADER = rf"^(.{{1,40}}?)\s+[\[(]?({STAMP})[\])]?\s*$"
SPEAKER = r"^([^:]{1,40}?)\s*:\s*(.*)$"
NAME = r"(?U)^[^\W_][\w .'\-()#]{0,39}$"
SURE = 3  # candidate names up to which every one counts


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


@F.pandas_udf(T.StringType())
def _paragraphs(files: pd.Series) -> pd.Series:
    import io
    import xml.etree.ElementTree as tree
    import zipfile

    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

    def one(data: bytes) -> str:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            body = tree.fromstring(z.read("word/document.xml"))
        parts = {f"{space}t": lambda e: e.text or "", f"{space}tab": lambda e: "\t", f"{space}br": lambda e: "\n"}
        return "\n".join("".join(parts[e.tag](e) for e in p.iter() if e.tag in parts) for p in body.iter(f"{space}p"))

    return files.map(one)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of word-processor files, a line a paragraph."""
    read = spark.read.format("binaryFile").load(path)
    return read.select(F.element_at(F.split("path", "/"), -1).alias("file"), _paragraphs("content").alias("text"))


def valid_speaker(name: Column) -> Column:
    """A name of at most four words with a letter in it."""
    name = F.trim(name)
    return F.coalesce(F.regexp_like(name, F.lit(NAME)) & (x.n_words(name) <= 4) & F.regexp_like(name, F.lit(r"\p{L}")), F.lit(False))


def opened(line: Column) -> Column:
    """struct(speaker, stamp, said) of a line that opens a turn, by the first form that fits; else null."""
    forms = ((STAMP_FIRST, 2, 1, 3), (SPEAKER_STAMP, 1, 2, 3), (HEADER, 1, 2, None), (SPEAKER, 1, None, 2))
    out = None
    for pattern, who, stamp, said in forms:
        name = F.regexp_extract(line, pattern, who)
        fits = F.regexp_like(line, F.lit(pattern)) & valid_speaker(name)
        value = F.struct(
            F.trim(name).alias("speaker"), (F.regexp_extract(line, pattern, stamp) if stamp else F.lit(None).cast("string")).alias("stamp"),
            (F.regexp_extract(line, pattern, said) if said else F.lit("")).alias("said"),
        )
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def line_segments(texts: DataFrame) -> DataFrame:
    """``texts`` (file, text) of labelled lines -> (file, ord, speaker, start_s, end_s, text).

    Of more than three candidate names only those seen twice count, as a colon in prose makes a name once. Lines that open no turn belong
    to the turn before; those ahead of the first one to a speaker ``UNKNOWN``.
    """
    lines = texts.select("file", F.posexplode(F.split("text", "\r\n|\n|\r")).alias("pos", "line")).withColumn("line", F.trim("line")).filter("line <> ''")
    lines = lines.withColumn("o", opened(F.col("line")))
    names = lines.filter("o IS NOT NULL").groupBy("file", F.col("o.speaker").alias("who")).agg(F.count(F.lit(1)).alias("seen"))
    names = names.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("file"))).filter(f"many <= {SURE} OR seen >= 2").select("file", "who", F.lit(True).alias("ok"))
    lines = lines.withColumn("who", F.col("o.speaker")).join(F.broadcast(names), ["file", "who"], "left")  # the names of speakers
    w = Window.partitionBy("file").orderBy("pos")
    lines = lines.withColumn("ord", F.count("ok").over(w))
    said = F.when(F.col("ok"), F.trim("o.said")).otherwise(F.col("line"))
    pieces = F.array_sort(F.collect_list(F.struct("pos", said.alias("said"))))
    out = lines.groupBy("file", "ord").agg(F.max(F.when(F.col("ok"), F.col("who"))).alias("speaker"), F.max(F.when(F.col("ok"), F.col("o.stamp"))).alias("stamp"), F.array_join(F.transform(pieces, lambda r: r["said"]), " ").alias("text"))
    start = F.when(F.coalesce("stamp", F.lit("")) != "", F.round(x.ts_to_sec(F.col("stamp")), 3))
    return out.select("file", "ord", F.coalesce("speaker", F.lit("UNKNOWN")).alias("speaker"), start.alias("start_s"), F.lit(None).cast("double").alias("end_s"), F.trim("text").alias("text"))


def cue_segments(texts: DataFrame) -> DataFrame:
    """``texts`` (file, text) of caption files -> segments; cues without a name have a null speaker."""
    blocks = F.split(F.regexp_replace("text", "\r\n", "\n"), r"\n\s*\n")
    rows = texts.select("file", F.posexplode(blocks).alias("ord", "b")).withColumn("ls", F.filter(F.split("b", "\n"), lambda s: F.trim(s) != ""))
    at = F.array_min(F.transform("ls", lambda s, i: F.when(F.contains(s, F.lit("-->")), i + 1)))
    rows = rows.withColumn("at", at).filter("at IS NOT NULL")
    times = rf"^\s*({STAMP})\s*-->\s*({STAMP})"
    rows = rows.withColumns({"t": F.element_at("ls", F.col("at")), "body": F.array_join(F.expr("slice(ls, at + 1, size(ls))"), " ")})
    voice, named = r"^\s*<v(?:\.[^ >]*)?\s+([^>]+)>(.*)", F.regexp_extract("body", SPEAKER, 1)
    is_voice, is_named = F.regexp_like("body", F.lit(voice)), F.regexp_like("body", F.lit(SPEAKER)) & valid_speaker(named)
    speaker = F.when(is_voice, F.trim(F.regexp_extract("body", voice, 1))).when(is_named, F.trim(named))
    said = F.when(is_voice, F.regexp_extract("body", voice, 2)).when(is_named, F.regexp_extract("body", SPEAKER, 2)).otherwise(F.col("body"))
    time = lambda k: F.when(F.regexp_like("t", F.lit(times)), F.round(x.ts_to_sec(F.regexp_extract("t", times, k)), 3))
    out = rows.select("file", "ord", speaker.alias("speaker"), time(1).alias("start_s"), time(2).alias("end_s"), F.trim(F.regexp_replace(said, "<[^>]+>", "")).alias("text"))
    return out.filter("text <> ''")


def turns(segments: DataFrame) -> DataFrame:
    """Segments -> turns (file, place, speaker, start_s, end_s, text): consecutive segments of a speaker are one.

    A segment without a name continues the speaker before; one without words makes no turn, though it may end one.
    """
    w = Window.partitionBy("file").orderBy("ord")
    said = F.trim(F.regexp_replace(x.clean_quotes(F.col("text")), r"(?U)\s+", " "))
    rows = segments.withColumns({"text": said, "who": F.coalesce(F.last("speaker", ignorenulls=True).over(w), F.lit("UNKNOWN"))})
    spoke = F.when(F.col("text") != "", F.col("who"))
    rows = rows.withColumn("_was", F.last(spoke, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    new = (F.col("text") != "") & ~F.col("who").eqNullSafe(F.col("_was"))
    rows = rows.withColumn("place", F.sum(new.cast("int")).over(w)).filter((F.col("text") != "") | F.col("who").eqNullSafe(F.col("_was"))).filter("place > 0")
    texts = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("ord", "text"))))
    return rows.groupBy("file", "place").agg(
        F.min_by("who", "ord").alias("speaker"), F.min_by("start_s", "ord").alias("start_s"), F.max_by("end_s", F.when(F.col("end_s").isNotNull(), F.col("ord"))).alias("end_s"),
        F.array_join(F.transform(texts, lambda r: r["text"]), " ").alias("text"),
    )


def with_roles(said: DataFrame, names: tuple[str, ...] = ()) -> DataFrame:
    """Turns with ``role`` and ``method``."""
    rows = said.select(F.col("file").alias("thread"), F.col("place").alias("ord"), "speaker", "text")
    roles = conversation.role_guess(rows, names).withColumnRenamed("thread", "file")
    return said.join(roles, ["file", "speaker"])
