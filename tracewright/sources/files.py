"""Files and collections: reading envelopes and profiles, inventories with digests, receipts, and releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.operators.release import manifest


def read_texts(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text): a row a file; the id is the file's name."""
    rows = spark.read.text(path, wholetext=True).withColumn("_path", F.col("_metadata.file_name"))
    return rows.select(F.col("_path").alias(id_col), F.col("value").alias("text"))


def numbered_lines(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, line_no from 1, line) of text files, a file a document; the id is the file's name.

    Files are split by bytes among tasks. Lines are numbered inside a split, and the splits' counts, a row a split, are summed over
    the file. A line end of two characters counts as one; what follows the last line end is a line unless it is empty. The
    files must not change between the two passes.
    """
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_name").alias(id_col), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"), F.regexp_replace("value", r"\r\z", "").alias("line"))
    before = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_n")).select("_file", "_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_nth", F.row_number().over(Window.partitionBy("_file", "_split").orderBy("_at")))
    return inside.join(splits, ["_file", "_split"]).select(id_col, (F.col("_before") + F.col("_nth")).alias("line_no"), "line")


def read_collection(spark: SparkSession, path: str, record: T.StructType, multi_line: bool = True) -> DataFrame:
    """Records of JSON envelopes {profile, releaseId, recordType, recordCount, records}, with the envelope's fields: an envelope a file, or a line."""
    envelope = T.StructType([T.StructField("profile", T.StringType()), T.StructField("releaseId", T.StringType()), T.StructField("recordType", T.StringType()), T.StructField("recordCount", T.LongType()), T.StructField("records", T.ArrayType(record))])
    rows = spark.read.schema(envelope).json(path, multiLine=multi_line)
    return rows.select(F.col("profile"), F.col("releaseId").alias("release_id"), F.col("recordType").alias("record_type"), F.col("recordCount").alias("record_count"), F.explode("records").alias("_r")).select("profile", "release_id", "record_type", "record_count", "_r.*")


def read_profile(spark: SparkSession, root: str, names: list[str], **options) -> dict[str, DataFrame]:
    """Parquet tables of a profile by name."""
    return {name: spark.read.options(**options).parquet(f"{root.rstrip('/')}/{name}.parquet") for name in names}


#: The lists of an edge-spec module and what their tuples hold, in order.
SPEC_LISTS = {
    "middleRequired": ("from_code", "to_code", "text", "page"),
    "middleCommentaryRequired": ("from_code", "to_code", "page", "text"),
    "elementaryToMiddleRequired": ("from_code", "to_code", "domain", "page", "text"),
    "elementaryCommentaryRequired": ("from_code", "to_code", "page", "text"),
    "middleToHighRequired": ("from_code", "to_code", "page", "text"),
    "highRequired": ("from_code", "to_code", "text", "page"),
    "highCommentaryRequired": ("from_code", "to_code", "page", "text"),
}


def edge_specs(spark: SparkSession, path: str, multi_line: bool = True, lists: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(subject, annex, level, kind, place, arity, from_code, to_code, page, text, domain): a row for each tuple of JSON modules {subject, annexId, level, <kind>: [[...], ...]}.

    ``place`` is the tuple's in its list, from 0, and ``arity`` its length; what a tuple of another length lacks is null.
    """
    lists = lists or SPEC_LISTS
    rows = T.ArrayType(T.ArrayType(T.StringType()))
    module = T.StructType([T.StructField(n, T.StringType()) for n in ("subject", "annexId", "level")] + [T.StructField(k, rows) for k in lists])
    found = spark.read.schema(module).json(path, multiLine=multi_line)
    named = lambda k, names: lambda t, i: F.struct(F.lit(k).alias("kind"), i.alias("place"), F.size(t).alias("arity"), *[(F.get(t, names.index(n)) if n in names else F.lit(None).cast("string")).alias(n) for n in ("from_code", "to_code", "page", "text", "domain")])
    each = [F.transform(F.coalesce(F.col(k), F.array().cast(rows)), named(k, names)) for k, names in lists.items()]
    flat = found.select("subject", F.col("annexId").alias("annex"), "level", F.explode(F.concat(*each)).alias("t")).select("subject", "annex", "level", "t.*")
    return flat.withColumn("page", F.col("page").try_cast("int"))


def spec_tables(kinds: dict[str, DataFrame]) -> DataFrame:
    """One table of spec rows that are tables already, each kind named."""
    out = None
    for kind, df in kinds.items():
        part = df.withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def binary_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def file_inventory(files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of binary files."""
    return files.select("path", F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def magic_is(magic: bytes) -> Column:
    return F.substring("content", 1, len(magic)) == F.lit(magic)


def scan_files(files: DataFrame, extensions: list[str], exclude: list[str] = ()) -> DataFrame:
    """Files with one of the extensions outside the excluded folders."""
    rows = files.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*extensions))
    for name in exclude:
        rows = rows.filter(~F.col("path").contains(f"/{name}/"))
    return rows


def receipts(inventory: DataFrame, catalog: DataFrame, on: str = "path") -> DataFrame:
    """Catalogue rows with the size and digest of their files."""
    return catalog.join(inventory, on).select(*catalog.columns, "bytes", "sha256")


def total_bytes(rows: DataFrame) -> DataFrame:
    return rows.agg(F.sum("bytes").alias("total_bytes"), F.count(F.lit(1)).alias("files"))


def with_provenance(rows: DataFrame, sources: DataFrame, on: str) -> DataFrame:
    return rows.join(sources, on)


def write_release(tables: dict[str, DataFrame], release_id: str, path: str, profile_col: str | None = None) -> DataFrame:
    """Writes each table to path/name and returns (release_id, dataset, value): rows by dataset, counted from what was written."""
    spark, counts = next(iter(tables.values())).sparkSession, []
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        (writer.partitionBy(profile_col) if profile_col and profile_col in df.columns else writer).parquet(f"{path.rstrip('/')}/{name}")
        counts.append(spark.read.parquet(f"{path.rstrip('/')}/{name}").agg(F.count(F.lit(1)).alias("value")).select(F.lit(release_id).alias("release_id"), F.lit(name).alias("dataset"), "value"))
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out


def _folder(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, function from a path below it to Hadoop's path)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), lambda *below: hadoop.Path("/".join([path.rstrip("/"), *below]))


def publish_release(tables: dict[str, DataFrame], release_id: str, root: str) -> DataFrame:
    """Writes a release beside the earlier ones and makes it the current one, all or nothing; returns its manifest.

    Tables go to root/staging/<id>; one that is whole there already (an earlier call was interrupted) isn't written again. The
    manifest (release_id, dataset, n, hash_xor, hash_sum) is counted from what was written. Then the folder is renamed to
    root/releases/<id>, and last the pointer root/CURRENT is replaced by a rename, so a reader sees the release before or
    this one, never a mix. A release that exists is not overwritten. Tables must be made alike at every call.
    """
    spark = next(iter(tables.values())).sparkSession
    fs, at = _folder(spark, root)
    if fs.exists(at("releases", release_id)):
        raise FileExistsError(f"release {release_id} is published already")
    staged = at("staging", release_id).toString()
    for name, df in tables.items():
        if not fs.exists(at("staging", release_id, name, "_SUCCESS")):
            df.write.mode("overwrite").parquet(f"{staged}/{name}")
    found = manifest({name: spark.read.schema(df.schema).parquet(f"{staged}/{name}").select(df.columns) for name, df in tables.items()})
    found.withColumn("release_id", F.lit(release_id)).coalesce(1).write.mode("overwrite").json(f"{staged}/_manifest")
    fs.mkdirs(at("releases"))
    if not fs.rename(at("staging", release_id), at("releases", release_id)):
        raise OSError(f"{staged} could not be renamed")
    make_current(spark, root, release_id)
    return release_manifest(spark, root, release_id)


def make_current(spark: SparkSession, root: str, release_id: str) -> None:
    """Points root/CURRENT to a published release: a new file replaces the old one by one rename."""
    fs, at = _folder(spark, root)
    if not fs.exists(at("releases", release_id)):
        raise FileNotFoundError(f"no release {release_id}")
    new = at(f"CURRENT-{release_id}")
    out = fs.create(new, True)
    out.write(bytearray(release_id.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(at("CURRENT")), how)


def current_release(spark: SparkSession, root: str) -> str | None:
    fs, at = _folder(spark, root)
    return spark.read.text(at("CURRENT").toString()).first()["value"] if fs.exists(at("CURRENT")) else None


def release_manifest(spark: SparkSession, root: str, release_id: str | None = None) -> DataFrame:
    at = f"{root.rstrip('/')}/releases/{release_id or current_release(spark, root)}/_manifest"
    return spark.read.schema("release_id string, dataset string, n long, hash_xor long, hash_sum string").json(at)


def read_release(spark: SparkSession, root: str, names: list[str], release_id: str | None = None) -> dict[str, DataFrame]:
    """Tables of a release, the current one unless another is named; they stay that release's, whatever is published meanwhile."""
    at = f"{root.rstrip('/')}/releases/{release_id or current_release(spark, root)}"
    return {name: spark.read.parquet(f"{at}/{name}") for name in names}


def forbid_dataset(spark: SparkSession, path: str) -> bool:
    """Whether a data set is absent or empty."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path).isEmpty()
    except AnalysisException:
        return True
