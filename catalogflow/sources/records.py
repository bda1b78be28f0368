"""Record files: JSON arrays, NDJSON, tables, catalogs, batches, and how they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.codes import coerce_text, table_upc
from ..functions.nested import dotted_columns
from ..functions.text import canonical_key, slugify
from ..functions.values import blank_text
from ..operators.aggregate import last_wins
from ..session import materialize
from .documents import elements
from ..operators.order import allocate_skus, group_position, mark_used, nest, sku_base, split_batches

# A bare NaN token, not one inside quotes.
_NAN = r'(?<!")\bNaN\b(?!")'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and a per-file increasing position."""
    lines = spark.read.text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def _broken() -> Column:
    return (F.trim("line") != "") & F.try_parse_json(F.regexp_replace("line", _NAN, "null")).isNull()


def bad_lines(spark: SparkSession, path: str, parts: int | None = None) -> DataFrame:
    """(file, line_no, line) of the NDJSON lines that are no JSON: the reject table of a lenient read."""
    numbered = group_position(_lines(spark, path), ["file"], ["pos"], "line_no", parts)
    return numbered.filter(_broken()).select("file", "line_no", "line")


def _fail_on_bad_line(spark: SparkSession, path: str) -> None:
    """One pass that keeps a single row; the line number is counted only when there is a bad line."""
    lines = _lines(spark, path)
    first = lines.filter(_broken()).agg(F.min(F.struct("file", "pos")).alias("at")).first()["at"]
    if first:
        number = lines.filter((F.col("file") == first["file"]) & (F.col("pos") <= first["pos"])).count()
        raise ValueError(f"{first['file']}: bad JSON on line {number}")


def read_records(
    spark: SparkSession, path: str, schema: str | T.StructType, ndjson: bool = True, fix_nan: bool = False, strict: bool = True
) -> DataFrame:
    """Objects of an NDJSON file or of a JSON array as rows.

    fix_nan turns bare NaN tokens into null. Blank NDJSON lines are skipped. strict raises on the first bad line,
    naming file and line; otherwise bad lines are left out (see `bad_lines`). A JSON array is read by many tasks, too (see
    `documents.elements`); strict raises where a file is no array or one of its elements is no JSON object.
    """
    if not ndjson:
        found = elements(spark, path, strict)
        value = F.regexp_replace("element", _NAN, "null") if fix_nan else F.col("element")
        read = found.select("file", "kind", "idx", value.alias("v"))
        fine = (F.col("kind") == "[") & F.col("v").startswith("{") & F.try_parse_json("v").isNotNull()
        if strict:
            odd = read.filter(~fine).select("file", "idx").head()
            if odd:
                raise ValueError(f"{odd['file']}: expected a JSON array of objects at the top level; element {odd['idx']} is none")
            return read.select(F.from_json("v", schema).alias("r")).select("r.*")  # all are fine
        return read.filter(fine).select(F.from_json("v", schema).alias("r")).select("r.*")
    if strict:
        _fail_on_bad_line(spark, path)
    lines = _lines(spark, path).filter(F.trim("line") != "")
    value = F.regexp_replace("line", _NAN, "null") if fix_nan else F.col("line")
    parsed = lines.select(F.from_json(value, schema).alias("r"), value.alias("v"))
    return parsed.filter(F.try_parse_json("v").isNotNull()).select("r.*")


def normalize_input(documents: DataFrame, text: str) -> DataFrame:
    """Records of whole JSON documents: (keys.., index, record as JSON text).

    A list of objects gives its objects; an object with exactly one list-of-objects field gives that list; any other
    object is one record; a list with scalars gives {value, index} records; a scalar or unreadable document fails the
    job; a null one holds no records.
    """
    keys = [c for c in documents.columns if c != text]
    doc = F.try_parse_json(F.col(text))
    empty = F.array().cast("array<string>")
    is_list = F.schema_of_variant(doc).startswith("ARRAY")

    def texts(variant_array: Column) -> Column:
        return F.transform(variant_array, lambda v: F.to_json(v))

    def all_objects(items: Column) -> Column:
        return F.forall(items, lambda v: F.schema_of_variant(v).startswith("OBJECT"))

    as_list = F.try_variant_get(doc, "$", "array<variant>")
    fields = F.map_values(F.try_variant_get(doc, "$", "map<string,variant>"))
    lists = F.filter(
        F.transform(fields, lambda v: F.try_variant_get(v, "$", "array<variant>")),
        lambda items: items.isNotNull() & all_objects(items),
    )
    wrapped = F.transform(
        texts(as_list), lambda j, i: F.concat(F.lit('{"value":'), F.coalesce(j, F.lit("null")), F.lit(',"index":'), i.cast("string"), F.lit("}"))
    )
    records = F.when(is_list & all_objects(as_list), texts(as_list)).when(is_list, wrapped).when(
        F.size(lists) == 1, texts(F.get(lists, F.lit(0)))
    ).when(F.schema_of_variant(doc).startswith("OBJECT"), F.array(F.to_json(doc))).when(F.col(text).isNotNull(), F.raise_error(F.lit("a scalar document holds no records, nor does an unreadable one")))
    return documents.select(*keys, F.posexplode(F.coalesce(records, empty)).alias("index", "record"))


def read_table(spark: SparkSession, path: str, header: bool = True, upc_columns: list[str] = ()) -> DataFrame:
    """A product table as text columns: empty cells '', code columns as 12-digit text or null.

    Without header the columns are col_1..n.
    """
    df = spark.read.option("header", header).option("inferSchema", False).csv(path)
    if not header:
        df = df.toDF(*[f"col_{i + 1}" for i in range(len(df.columns))])
    return df.select(
        *[
            (table_upc(F.col(f"`{c}`")) if c in upc_columns else F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c)
            for c in df.columns
        ]
    )


def read_catalog(spark: SparkSession, path: str, key: str = "upc", value: str = "url") -> DataFrame:
    """Catalog files {key: value} or [{key, value}] as rows; a file is read by many tasks."""
    found = elements(spark, path)
    pair = F.element_at(F.map_entries(F.from_json(F.concat(F.lit("{"), "element", F.lit("}")), "map<string,string>")), 1)
    listed = F.from_json("element", f"struct<{key}:string,{value}:string>")
    read = found.select("file", "idx", F.when(F.col("kind") == "{", F.struct(pair["key"].alias(key), pair["value"].alias(value))).otherwise(listed).alias("e"))
    return _last_entries(read.select("file", F.col("idx").alias("pos"), F.trim(F.col(f"e.{key}")).alias(key), F.trim(F.col(f"e.{value}")).alias(value)), key, value)


def catalog_entries(documents: DataFrame, key: str = "upc", value: str = "url") -> DataFrame:
    """Entries of catalog documents (file, value): trimmed, blanks dropped, later entry of a key wins."""
    text = documents.select("file", F.trim("value").alias("value"))
    pairs = F.from_json("value", "map<string,string>")
    listed = F.from_json("value", f"array<struct<{key}:string,{value}:string>>")
    from_map = text.filter(F.col("value").startswith("{")).select("file", F.posexplode(F.map_entries(pairs)).alias("pos", "e")).select(
        "file", "pos", F.trim("e.key").alias(key), F.trim("e.value").alias(value)
    )
    from_list = text.filter(F.col("value").startswith("[")).select("file", F.posexplode(listed).alias("pos", "e")).select(
        "file", "pos", F.trim(F.col(f"e.{key}")).alias(key), F.trim(F.col(f"e.{value}")).alias(value)
    )
    return _last_entries(from_map.unionByName(from_list), key, value)


def _last_entries(entries: DataFrame, key: str, value: str) -> DataFrame:
    good = entries.filter(~blank_text(F.col(key)) & ~blank_text(F.col(value)))
    return last_wins(good, [key], ["file", "pos"]).select(key, value)


def write_records(df: DataFrame, path: str) -> None:
    """NDJSON, all or nothing: the committer publishes a job's files together with _SUCCESS."""
    df.write.mode("overwrite").json(path)


def write_array_batches(df: DataFrame, path: str, size: int, order: list[str]) -> None:
    """JSON arrays of at most `size` records: one document per batch, in folders batch=NNN."""
    labelled = split_batches(df, size, order)
    record = F.to_json(F.struct(*df.columns))
    # a batch is at most `size` rows, so its document is bounded
    documents = labelled.groupBy("batch_label").agg(
        F.array_sort(F.collect_list(F.struct(*order, record.alias("__record")))).alias("rows")
    )
    text = F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["__record"]), ","), F.lit("]"))
    documents.select(F.col("batch_label").alias("batch"), text.alias("value")).write.mode("overwrite").partitionBy("batch").text(path)


def write_version(df: DataFrame, path: str) -> str:
    """Write a new version next to the ones in use, so a table can be replaced while it is read."""
    last = current_version(df.sparkSession, path)
    number = int(last.rsplit("v", 1)[1]) + 1 if last else 1
    target = f"{path.rstrip('/')}/v{number:09d}"
    df.write.mode("overwrite").parquet(target)
    return target


def current_version(spark: SparkSession, path: str) -> str | None:
    """Newest complete version (one with _SUCCESS), None before the first."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop):
        return None
    done = [
        s.getPath().toString()
        for s in files.listStatus(hadoop)
        if s.isDirectory() and files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    ]
    return max(done) if done else None


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    found = current_version(spark, path)
    return spark.read.parquet(found) if found else None


def commit_skus(
    df: DataFrame, path: str, order: list[str], start: int, parts: int | None = None
) -> DataFrame:
    """New stock numbers for the rows, recorded in the registry at `path` by one commit per batch of rows."""
    spark = df.sparkSession
    registry = read_version(spark, path)
    if registry is None:
        registry = spark.createDataFrame([], "sku string, next_auto_sku bigint")
    numbered = materialize(allocate_skus(df, registry, order, start, parts))
    used = mark_used(registry.select("sku"), numbered)
    ahead = sku_base(registry.unionByName(numbered.select(F.col("sku").cast("string")), allowMissingColumns=True), start).select("next_auto_sku")
    # the next number is a row of its own, so it outlives the rows it was promised after
    write_version(used.unionByName(ahead, allowMissingColumns=True).filter("sku IS NOT NULL OR next_auto_sku IS NOT NULL"), path)
    return numbered


def write_batches(df: DataFrame, path: str, size: int, order: list[str]) -> None:
    """Batches as folders batch=NNN of NDJSON."""
    labelled = split_batches(df, size, order).drop("batch").withColumnRenamed("batch_label", "batch")
    # one file per batch, so that file name and position give the order back
    grouped = labelled.repartition("batch").sortWithinPartitions("batch", *order)
    grouped.write.mode("overwrite").partitionBy("batch").json(path)


def read_batches(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of batch files with their file and position; (file, pos) is the original order."""
    lines = _lines(spark, path).filter(F.trim("line") != "")
    return lines.select("file", "pos", F.from_json("line", schema).alias("r")).select("file", "pos", "r.*")


def bucket_key(c: Column, mode: str = "normalize", missing: str = "_missing", mapping: dict[str, str] | None = None) -> Column:
    key = canonical_key(c, mode, mapping)
    return F.when(blank_text(c.cast("string")) | (key == ""), F.lit(missing)).otherwise(key)


def split_by_key(
    df: DataFrame,
    key: str,
    order: list[str],
    mode: str = "normalize",
    min_bucket: int = 0,
    missing: str = "_missing",
    max_per_file: int = 0,
    mapping: dict[str, str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Rows with bucket, slug and part (from 1); buckets under min_bucket are left out as asked.

    Parts come from hot-safe positions, so one bucket may hold most of the table.
    """
    keyed = df.withColumn("bucket", bucket_key(F.col(key), mode, missing, mapping))
    if min_bucket:
        kept = keyed.groupBy("bucket").count().filter(F.col("count") >= min_bucket).select("bucket")
        keyed = keyed.join(kept, "bucket", "left_semi")
    if max_per_file:
        placed = group_position(keyed, ["bucket"], order, "__pos", parts)
        keyed = placed.withColumn("part", F.floor((F.col("__pos") - 1) / max_per_file) + 1).drop("__pos")
    else:
        keyed = keyed.withColumn("part", F.lit(1).cast("bigint"))
    return keyed.withColumn("slug", slugify(F.col("bucket")))


def split_manifest(split: DataFrame) -> DataFrame:
    """(key, count, file) per bucket and part, sorted by key without case."""
    counts = split.groupBy("bucket", "slug", "part").agg(F.count(F.lit(1)).alias("count"))
    parts = counts.groupBy("bucket").agg(F.max("part").alias("parts"))
    label = F.lpad(F.col("part").cast("string"), F.greatest(F.lit(3), F.length(F.col("parts").cast("string"))), F.lit("0"))
    named = counts.join(parts, "bucket").select(
        F.col("bucket").alias("key"),
        "count",
        F.concat(F.lit("key="), "slug", F.lit("_part="), label, F.lit("_count="), F.col("count").cast("string"), F.lit(".json")).alias("file"),
    )
    return named.orderBy(F.lower("key"), "key", "file")


def write_split(split: DataFrame, path: str, keep: list[str]) -> None:
    """One folder per key and part; the key itself is written with the rows, as two keys may share a slug."""
    folder = F.concat_ws("-", F.nullif("slug", F.lit("")), F.substring(F.sha2("bucket", 256), 1, 16))
    rows = split.select(*keep, *[c for c in ["bucket"] if c not in keep], folder.alias("folder"), "part")
    rows.write.mode("overwrite").partitionBy("folder", "part").json(path)


def flatten_wide(df: DataFrame, id_field: str | None = None) -> DataFrame:
    """Arrays as columns k_0..k_max, nested objects as JSON text, booleans as numbers, integer ids as numbers.

    Column order: id, plain columns, array columns in text order. One small pass finds the longest arrays.
    """
    arrays = [f for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    longest = df.agg(*[F.coalesce(F.max(F.size(f.name)), F.lit(0)).alias(f.name) for f in arrays]).first() if arrays else {}

    def plain(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.BooleanType):
            return c.cast("int")
        if isinstance(kind, T.StringType):
            return coerce_text(c)
        if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
            return F.to_json(c)
        return c

    out = {f.name: plain(F.col(f.name), f.dataType) for f in df.schema.fields if f not in arrays}
    if id_field in out and isinstance(df.schema[id_field].dataType, T.StringType):
        ids = df.agg(F.bool_and(blank_text(F.col(id_field)) | F.col(id_field).try_cast("bigint").isNotNull()).alias("ok")).first()
        out[id_field] = F.col(id_field).try_cast("bigint") if ids["ok"] else F.col(id_field)
    wide = {
        f"{f.name}_{i}": plain(F.get(F.col(f.name), F.lit(i)), f.dataType.elementType) for f in arrays for i in range(longest[f.name])
    }
    names = [*([id_field] if id_field in out else []), *[n for n in out if n != id_field]]
    return df.select(*[out[n].alias(n) for n in names], *[wide[n].alias(n) for n in sorted(wide)])


def flatten_dotted(df: DataFrame) -> DataFrame:
    """Nested objects as a.b.c columns; arrays whole."""
    return df.select(*[F.col(path).alias(name) for path, name in dotted_columns(df.schema)])


def discover_keys(df: DataFrame, text: str) -> DataFrame:
    """Top-level keys of JSON text records with their counts, over all rows."""
    keys = F.json_object_keys(text)
    return df.select(F.explode(keys).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def route_outputs(df: DataFrame, status: str = "status") -> dict[str, DataFrame]:
    """Products, unmatched rows, and errors (every failed row, unmatched ones included)."""
    return {
        "products": df.filter(F.col(status) == "ok"),
        "unmatched": df.filter(F.col(status) == "unmatched"),
        "errors": df.filter(F.col(status).isin("unmatched", "error")),
    }


def write_outputs(df: DataFrame, path: str, status: str = "status") -> None:
    """The three tables, from one materialized frame so its sources are read once."""
    kept = materialize(df)
    for name, part in route_outputs(kept, status).items():
        part.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")
