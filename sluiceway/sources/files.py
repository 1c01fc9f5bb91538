"""CSV, JSON Lines and paged JSON, as batch and as stream.

Every reader takes a declared schema and looks into subfolders. Declared fields are taken by name. What does not fit
them, or is not declared, goes to the rescue column as text; nothing is lost at landing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from sluiceway.operators.conform import union_all
from sluiceway.sources.schemas import INVOICE_PAGE, RESCUE, TEXT, with_hints, with_rescue

SOURCE_FILE = "_source_file"


def _limited(reader, max_files: int | None):
    """A stream reader that takes at most so many files into a micro-batch; the others wait for the next."""
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def csv_files(spark: SparkSession, path: str | Sequence[str], schema: StructType, stream: bool = False) -> DataFrame:
    """CSV files whose header lines name exactly the columns of ``schema``, in its order; others stop the job.

    A line is judged on all its columns, whichever are asked for later: rescue depends on every one of them.
    """
    reader = (
        (spark.readStream if stream else spark.read)
        .schema(with_rescue(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUE)
        .option("recursiveFileLookup", True)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
    )
    whole = F.length(F.concat_ws("", *(F.col(f"`{name}`").cast("string") for name in schema.names))) >= 0
    return reader.csv(path).withColumn(RESCUE, F.when(whole, F.col(RESCUE)))


def file_names(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream of the names of new files, for readers that choose how to read each."""
    reader = _limited(spark.readStream.format("binaryFile").option("recursiveFileLookup", True), max_files)
    return reader.schema("path string, modificationTime timestamp, length long, content binary").load(path).select("path")


def header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, header`` of every file that has a line, in one job: the first line that is not blank of each file's first block.

    A task looks at the lines of its blocks and passes on one a file.
    """
    place = F.monotonically_increasing_id()  # grows in reading order within a task; the first block of a file is in one task
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", place.alias("place")
    )
    return lines.where("start = 0 AND trim(value) <> ''").groupBy("path").agg(F.min_by("value", "place").alias("header"))


def csv_by_name(spark: SparkSession, paths: Sequence[str], declared: StructType) -> DataFrame:
    """CSV files of any column order: declared columns by name, absent ones NULL, unknown ones as text behind them.

    One job finds the header lines, whatever the number of files; one more looks at each different header. The names of the files come to
    the driver, so give it the files of one micro-batch. A file without a line has no rows.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for row in header_lines(spark, paths).collect() if paths else []:
        groups[row["header"]].append(unquote(row["path"]))  # the metadata column holds an encoded URI
    frames = [csv_files(spark, sorted(group), header_schema(spark, min(group), declared)) for _, group in sorted(groups.items())]
    frames.append(spark.createDataFrame([], with_rescue(declared)))
    both = union_all(frames, allow_missing=True)
    added = [c for c in both.columns if c not in declared.names and c != RESCUE]
    return both.select(*declared.names, *added, RESCUE)


def _has_unknown(text: Column, kind: DataType) -> Column:
    """Does a JSON text hold a field that its declared type does not name, at any depth?"""
    if isinstance(kind, StructType):
        fields = F.from_json(text, "map<string,string>")
        found = F.size(F.array_except(F.map_keys(fields), F.array(*map(F.lit, kind.names)))) > 0
        for field in kind.fields:
            if isinstance(field.dataType, StructType | ArrayType):
                found = found | _has_unknown(fields[field.name], field.dataType)
    elif isinstance(kind, ArrayType):
        items = F.from_json(text, "array<string>")
        found = F.exists(items, lambda item: _has_unknown(item, kind.elementType))
    else:
        return F.lit(False)
    return F.coalesce(found, F.lit(False))


def with_declared_fields(df: DataFrame, record: str, schema: StructType) -> DataFrame:
    """Add the declared fields of a JSON record, as the struct ``_parsed``, and what is left of it, as ``_left``.

    What is left is the whole record if it is no JSON object or a declared field does not fit its type, else the
    fields that are not declared, else NULL. A nested field that is not declared leaves its whole branch.
    """
    read = {"_fields": F.from_json(record, "map<string,string>"), "_parsed": F.from_json(record, schema)}
    df = df.withColumns(read)  # columns, so that each text is read twice and not once for every use
    fields, parsed, record = F.col("_fields"), F.col("_parsed"), F.col(record)
    misfit = fields.isNull()
    branches = F.lit(False)
    beyond = unknown = F.map_filter(fields, lambda name, _: ~name.isin(schema.names))
    for field in schema.fields:
        misfit = misfit | (fields[field.name].isNotNull() & parsed[field.name].isNull())
        if isinstance(field.dataType, StructType | ArrayType):
            branch = _has_unknown(fields[field.name], field.dataType)
            branches = branches | branch
            kept = F.when(branch, F.map_from_arrays(F.array(F.lit(field.name)), F.array(fields[field.name])))
            unknown = F.map_concat(unknown, F.coalesce(kept, F.create_map().cast("map<string,string>")))
    # The maps are put together only where there is something to keep.
    rescue = F.when(record.isNotNull() & F.coalesce(misfit, F.lit(True)), record).when((F.size(beyond) > 0) | branches, F.to_json(unknown))
    return df.withColumn("_left", rescue).drop("_fields")


def _shapes(kind: DataType) -> str:
    """A pattern of the types, as ``schema_of_variant`` writes them, of JSON values whose objects name declared fields only."""
    if isinstance(kind, StructType):
        found = "".join(f"(?:{re.escape(_quoted(f.name))}: {_shapes(f.dataType)}(?:, |(?=>)))?" for f in sorted(kind.fields, key=lambda f: f.name))
        found = f"OBJECT<{found}>"
    elif isinstance(kind, ArrayType):
        found = f"ARRAY<{_shapes(kind.elementType)}>"
    else:
        found = r"[A-Z_]+(?:\([0-9, ]+\))?"  # an object or a list in the place of a value is none of these
    return f"(?:{found}|VOID)"


def _quoted(name: str) -> str:
    return name if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name) else f"`{name.replace('`', '``')}`"


def json_lines(spark: SparkSession, path: str, schema: StructType, stream: bool = False, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    reader = _limited(reader, max_files if stream else None).option("recursiveFileLookup", True)
    lines = reader.text(path).where("trim(value) <> ''")
    return with_declared_fields(lines, "value", schema).select("_parsed.*", F.col("_left").alias(RESCUE))


def invoice_pages(
    spark: SparkSession, path: str, stream: bool = False, schema: StructType = INVOICE_PAGE, max_files: int | None = None
) -> DataFrame:
    """One JSON document per file, ``{"data": [record, ...]}``; one row per record, with the file it came from.

    What a record has beyond the declared fields is in its own rescue text. A page that cannot be read at all
    gives one row, empty but for the text of the page. Other fields of the page, beside ``data``, are rescued on its first row.
    """
    reader = spark.readStream if stream else spark.read
    reader = _limited(reader, max_files if stream else None).option("recursiveFileLookup", True)
    record = schema["data"].dataType.elementType
    # A page whose records all fit, and name nothing beyond the declared fields, is read as a whole; the records of other pages are judged one
    # by one. Its shape names every field of any record and is NULL if a name is there twice or the page is too long for it.
    page = F.from_json("value", StructType([StructField("data", ArrayType(record)), StructField("_misfit", TEXT)]), {"columnNameOfCorruptRecord": "_misfit"})
    declared = F.schema_of_variant(F.try_parse_json("value")).rlike(f"^{_shapes(schema)}$")
    fits = F.coalesce(declared & F.col("_page._misfit").isNull() & F.forall("_page.data", lambda one: one.isNotNull()), F.lit(False))
    read = {"_data": F.from_json("value", "struct<data:array<string>>")["data"], "_fields": F.from_json("value", "map<string,string>")}
    # A page that is broken, has no data, or has data that is no list is kept as one row without a record.
    unreadable = F.col("_fields").isNull() | F.col("_data").isNull()
    texts = F.when(unreadable, F.array(F.lit(None).cast("string"))).otherwise(F.col("_data"))
    beside = F.map_filter("_fields", lambda name, _: name != "data")
    # What concerns the page goes into the exploded rows: columns beside an explode are computed, or copied, for every record.
    judged = F.transform(
        texts,
        lambda text, at: F.struct(
            F.lit(None).cast(record).alias("_whole_record"),
            text.alias("_record"),
            F.when((at == 0) & (F.size("_beside") > 0), F.to_json("_beside")).alias("_first"),
            F.when(text.isNull(), F.col("value")).alias("_whole"),
        ),
    )
    nothing = F.lit(None).cast("string")
    as_read = F.transform(
        "_page.data",
        lambda one: F.struct(one.alias("_whole_record"), nothing.alias("_record"), nothing.alias("_first"), nothing.alias("_whole")),
    )
    pages = (
        reader.text(path, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))
        .withColumn("_page", page)
        .withColumn("_fits", fits)
        .withColumns({name: F.when(~F.col("_fits"), column) for name, column in read.items()})
        .withColumn("_beside", beside)
        .select(SOURCE_FILE, F.inline(F.when(F.col("_fits"), as_read).otherwise(judged)))
    )
    pages = with_declared_fields(pages, "_record", record).withColumn("_parsed", F.coalesce("_whole_record", "_parsed"))
    both = F.when(F.col("_first").isNotNull() | F.col("_left").isNotNull(), F.concat_ws("\n", "_first", "_left"))
    return pages.select(F.coalesce("_whole", both).alias(RESCUE), SOURCE_FILE, "_parsed.*")


def stored_files(spark: SparkSession, path: str, schema: StructType | None = None, stream: bool = False) -> DataFrame:
    """A Parquet table by its directory; a stream must be given the schema."""
    if stream:
        return spark.readStream.schema(schema or spark.read.parquet(path).schema).parquet(path)
    return spark.read.parquet(path)


def infer_with_hints(spark: SparkSession, path: str, hints: str, file_format: str = "csv") -> StructType:
    """Infer a schema and force the hinted types. Point it at one small file: inference reads all of it."""
    reader = spark.read.option("header", True).option("inferSchema", True)
    return with_hints(reader.format(file_format).load(path).schema, hints)


def header_schema(spark: SparkSession, path: str, declared: StructType) -> StructType:
    """The columns one CSV delivery really has, typed as declared; unknown ones are text.

    Only the header line is read.
    """
    known = {field.name: field for field in declared.fields}
    names = spark.read.option("header", True).csv(path).columns
    return StructType([known.get(name, StructField(name, TEXT)) for name in names])


def drift(spark: SparkSession, declared: StructType, actual: StructType) -> DataFrame:
    """Columns that are new, missing or of another type, compared with the declared schema."""
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = [(c, "new", None, have[c]) for c in have if c not in want]
    rows += [(c, "missing", want[c], None) for c in want if c not in have]
    rows += [(c, "retyped", want[c], have[c]) for c in want if c in have and want[c] != have[c]]
    return spark.createDataFrame(rows, "column_name string, change string, declared string, actual string")


def csv_deliveries(spark: SparkSession, paths: list[str], declared: StructType) -> DataFrame:
    """Deliveries whose columns were added to over time, as one frame; absent columns are NULL."""
    frames = [csv_files(spark, p, header_schema(spark, p, declared)) for p in paths]
    return union_all(frames, allow_missing=True)


def with_row_id(df: DataFrame) -> DataFrame:
    """Stamp an id at landing, so that exact copies of a line can be told apart later."""
    return df.withColumn("_row_id", F.expr("uuid()"))
