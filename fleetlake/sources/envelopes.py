"""JSON envelopes: one object per file (or text value), accepted root keys, arrays of records.

A file is read as bytes, decoded by its byte order mark or the zeros among its first bytes, and parsed under
a fixed schema, so no inference pass runs and no batch can change a column's type.  A file whose records
are all objects is parsed once, records and all.  Any other is parsed again more
patiently, so that an odd record can't spoil the others: a top-level array holds several envelopes, and
records come as text.  Whatever follows the first JSON value makes the file corrupt; nothing of it is passed over.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from fleetlake import workspace
from fleetlake.functions.names import base_name, decoded
from fleetlake.registry import CORRUPT, FileType

ANY_JSON = "*.[jJ][sS][oO][nN]"
#: Characters of a refused file that its reject row shows.
SHOWN = 4096
_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
# The columns of Spark's binary file source, which a stream must be told.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
_LENIENT = "spark.sql.legacy.codingErrorAction"


def literal_path(path: str) -> str:
    """A path that Spark must not expand as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _lenient_decoding(spark: SparkSession):
    """What is analysed in here replaces malformed characters; otherwise one bad file would end a whole job."""
    return workspace.configured(spark, _LENIENT, "true")


def _text_of(content: Column) -> Column:
    """Bytes as text in the encoding that JSON files come in: UTF-8, or UTF-16 or UTF-32 of either byte order."""
    head = F.hex(F.substring(content, 1, 4))
    after = lambda n: F.substring(content, n + 1, (1 << 31) - 1)
    big_endian_32 = F.concat(F.lit(b"\x00\x00\xfe\xff"), content)
    little_endian_32 = F.concat(F.lit(b"\xff\xfe\x00\x00"), content)
    return (
        F.when(head.startswith("EFBBBF"), after(3).cast("string"))
        .when(head.isin("0000FEFF", "FFFE0000"), F.decode(content, "UTF-32"))
        .when(head.startswith("FEFF"), F.decode(after(2), "UTF-16BE"))
        .when(head.startswith("FFFE"), F.decode(after(2), "UTF-16LE"))
        .when(head.startswith("000000"), F.decode(big_endian_32, "UTF-32"))
        .when(head.rlike("^..000000"), F.decode(little_endian_32, "UTF-32"))
        .when(head.startswith("00"), F.decode(content, "UTF-16BE"))
        .when(head.rlike("^..00"), F.decode(content, "UTF-16LE"))
        .otherwise(content.cast("string"))
    )


def _texts(files: DataFrame) -> DataFrame:
    with _lenient_decoding(files.sparkSession):
        return files.select(F.col("_metadata.file_path").alias("file_path"), _text_of(F.col("content")).alias("content"))


def read_envelopes(spark: SparkSession, paths: Sequence[str], file_type: FileType, files_per_read: int | None = None) -> DataFrame:
    """Exactly the given files, as ``parse_envelopes`` has them; a reader gets ``files_per_read`` paths at most.

    Raises if a path does not exist.
    """
    step = files_per_read or len(paths)
    readers = (paths[k : k + step] for k in range(0, len(paths), step))
    with workspace.few_listing_tasks(spark):
        texts = [_texts(spark.read.format("binaryFile").load([literal_path(p) for p in r])) for r in readers]
    return parse_envelopes(reduce(DataFrame.unionByName, texts), file_type)


def read_envelope_folder(
    spark: SparkSession, folder: str, file_type: FileType, pattern: str = ANY_JSON, recursive: bool = False
) -> DataFrame:
    """Every file under ``folder`` whose name fits ``pattern``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return parse_envelopes(_texts(reader.option("pathGlobFilter", pattern).load(folder)), file_type)


def stream_envelopes(
    spark: SparkSession,
    folder: str,
    file_type: FileType,
    pattern: str = ANY_JSON,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of ``folder`` as a stream, each read once per checkpoint."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", pattern)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_envelopes(_texts(reader.load(folder)), file_type)


def parse_envelopes(texts: DataFrame, file_type: FileType, text: str = "content") -> DataFrame:
    """Envelopes held as text in a column, one row each.

    ``clean`` has the records by root key where all are objects.  Elsewhere it is null and a
    column per root key has them as text; ``_corrupt_record`` has the text of a corrupt file.
    """
    content = F.col("content")
    # One value and nothing after it: anything more would not parse inside the list, or make it longer.
    listed = F.concat(F.lit('{"envelopes":['), content, F.lit("]}"))
    once = texts.select("file_path", F.col(text).alias("content")).withColumn("once", F.from_json(listed, file_type.clean_envelope, _JSON_OPTIONS))
    clean = F.col(f"once.{CORRUPT}").isNull() & F.coalesce(F.size("once.envelopes") == 1, F.lit(False))
    # Again for the others: only tokens are looked at to tell whether there is one value.
    one = F.array(F.from_json(content, file_type.envelope, _JSON_OPTIONS))
    several = F.from_json(content, ArrayType(file_type.envelope), _JSON_OPTIONS)
    whole = F.json_array_length(F.concat(F.lit("["), content, F.lit("]"))).eqNullSafe(F.lit(1))
    corrupt = F.array(F.lit(None).cast(file_type.envelope))
    found = F.when(whole, F.coalesce(F.when(F.startswith(F.ltrim(content), F.lit("[")), several).otherwise(one), corrupt)).otherwise(corrupt)
    split = once.select("file_path", "content", F.when(clean, F.col("once.envelopes")[0]).alias("clean"))
    parsed = split.select("file_path", "content", "clean", F.explode_outer(F.when(F.col("clean").isNull(), found)).alias("envelope"))
    name = base_name(decoded(F.col("file_path")))
    broken = F.col("clean").isNull() & (F.col("envelope").isNull() | F.col(f"envelope.{CORRUPT}").isNotNull())
    return parsed.select(
        "file_path",
        name.alias("file_name"),
        "clean",
        *(F.col(f"envelope.{k}").alias(k) for k in file_type.root_keys),
        F.when(broken, F.col("content")).alias(CORRUPT),
        "content",
    )
