"""JSON lines, sidecar folders, image listings, nested feeds, and the sinks of each stage.

Readers take explicit schemas. Nothing lists or opens files on the driver; Spark's
sources do, so any store that Spark reads will do.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import blank
from ..functions.text import clean_main_text, clean_side_text
from ..operators.records import distinct_images, usable_image
from .scratch import save

PUBLIC = ("image", "label", "ground_truth", "side_matter", "boxes", "post_link")
SUBMIT = ("image", "label", "ground_truth", "boxes", "post_link")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of a JSON-lines table; blank, broken and non-object lines go."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_jsonl_strict(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): blank lines and # comments are skipped; every other line that is no object is a reject."""
    lines = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file")).where(~blank(F.col("value")) & ~F.ltrim("value").startswith("#"))
    parsed = lines.withColumn("r", F.from_json("value", schema, {"mode": "PERMISSIVE"})).withColumn("ok", F.expr("try_parse_json(value)").isNotNull() & F.ltrim("value").startswith("{"))
    return parsed.where("ok").select("r.*"), parsed.where("not ok").select("file", "value")


def require_no_rejects(rows: DataFrame, rejects: DataFrame) -> DataFrame:
    """rows, or an error that names a rejected line."""
    bad = rejects.limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['file']}: not a JSON object: {bad[0]['value'][:80]}")
    return rows


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object per row; nulls stay."""
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def scan_sidecars(spark: SparkSession, folder: str, schema: str, key: str, suffix: str = ".json") -> tuple[DataFrame, DataFrame]:
    """(rows, counts): one row per sidecar file with its path, and (files, unreadable).

    Broken and blank files, files of another kind of value than an object, and records
    without their key are unreadable; Spark's sources do not see files of no bytes at all. Files are read once; rows and counts come from the same saved scan.
    """
    files = spark.read.option("wholetext", True).option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True).text(folder)
    parsed = files.select(F.col("_metadata.file_path").alias("file"), F.from_json("value", schema).alias("r"), F.expr("try_parse_json(value)").alias("v"))
    object_ = F.coalesce(F.expr("schema_of_variant(v) like 'OBJECT%'"), F.lit(False))
    # Few large files: a task reads some dozens of sidecars, and a file for each task would be opened again by every use.
    scanned = save(parsed.select("file", "r", (object_ & F.col("r").isNotNull() & ~blank(F.col(f"r.{key}").cast("string"))).alias("ok")).hint("rebalance"), "sidecars")
    counts = scanned.agg(F.count("*").alias("files"), F.count_if(~F.col("ok")).alias("unreadable"))
    return scanned.where("ok").select("r.*", "file"), counts


def posts_from_images(spark: SparkSession, folder: str) -> DataFrame:
    """(post_id, images) from image files in one folder per post; only paths are read."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    return posts_from_paths(paths)


def posts_from_paths(paths: DataFrame) -> DataFrame:
    post, name = F.regexp_extract("path", r"/([^/]+)/([^/]+)$", 1), F.regexp_extract("path", r"/([^/]+)/([^/]+)$", 2)
    found = paths.select(post.alias("post_id"), name.alias("image")).where((F.col("post_id") != "") & F.lower("image").rlike(r"\.(jpe?g|png|webp|gif)$"))
    return found.groupBy("post_id").agg(F.array_sort(F.collect_set("image")).alias("images"))


def walk_json(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, depth, path, name, value): every value of the JSON texts, as a variant; broken texts go.

    One explode per level of nesting, until no nested value is left. Each level is saved
    as it is made, so the look for objects and arrays and the level below read it, and
    not the text and all levels above again.
    """
    level = rows.select(F.col(key), F.lit(0).alias("depth"), F.lit("$").alias("path"), F.lit(None).cast("string").alias("name"), F.expr(f"try_parse_json({text})").alias("value")).where("value is not null")
    level = out = save(level, "json-level")
    for d in count(1):
        inner = level.where("schema_of_variant(value) like 'OBJECT%' or schema_of_variant(value) like 'ARRAY%'")
        if not inner.limit(1).count():
            break
        level = save(_explode(inner, key, d), "json-level")
        out = out.unionByName(level)
    return out


def _explode(inner: DataFrame, key: str, d: int) -> DataFrame:
    step = "case when e.key is null then concat('[', e.pos, ']') else concat('.', e.key) end"
    return inner.sparkSession.sql(f"select {key}, {d} as depth, concat(w.path, {step}) as path, e.key as name, e.value as value from {{level}} w, lateral variant_explode(w.value) as e", level=inner)


def feed_candidates(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Objects with a numeric post_id in nested JSON: (key, post_id, message, created), one per id and key, the outermost."""
    nodes = walk_json(rows, key, text).where("schema_of_variant(value) like 'OBJECT%'")
    field = lambda p, t: F.expr(f"try_variant_get(value, '$.{p}', '{t}')")
    found = nodes.select(key, "depth", field("post_id", "string").alias("post_id"), F.coalesce(field("message.text", "string"), field("message", "string")).alias("message"), field("creation_time", "bigint").alias("created")).where(F.col("post_id").rlike(r"^\d+$"))
    return found.groupBy(key, "post_id").agg(F.min_by("message", "depth").alias("message"), F.min_by("created", "depth").alias("created"))


# Names under which nested feeds keep image addresses, times and authors.
IMAGE_NAMES = ("uri", "url", "src", "image_url", "preview_image")
TIME_NAMES = ("creation_time", "created_time", "publish_time", "timestamp")
AUTHOR_NAMES = ("name", "short_name", "username")


def nested_media(rows: DataFrame, key: str, text: str, usable=None) -> DataFrame:
    """(key, image_urls, posted_at, author) of nested JSON texts, one row per key.

    Images: every usable address under a known name, one per base, the outermost first.
    posted_at: the outermost time in seconds after 2001, as ISO text. author: a name of
    the object itself, else the first actor's, else the outermost name of 2 to 80
    characters; empty if there is none. Broken texts give no row.
    """
    usable = usable or usable_image
    nodes = walk_json(rows, key, text)
    value, name = F.expr("try_variant_get(value, '$', 'string')"), F.lower("name")
    at = F.struct("depth", "path")
    seconds = value.try_cast("long")
    urls = F.transform(F.array_sort(F.collect_list(F.when(name.isin(*IMAGE_NAMES) & usable(value), F.struct("depth", "path", value.alias("u"))))), lambda x: x["u"])
    told = lambda when: F.min_by(F.trim(value), F.when(when & ~blank(value), at))
    own = [F.max(F.when((F.col("path") == f"$.{n}") & ~blank(value), F.trim(value))) for n in AUTHOR_NAMES]
    actor = [F.max(F.when(F.col("path") == f"$.{n}[0].name", F.trim(value))) for n in ("actors", "actors_list")]
    author = F.coalesce(*own, *actor, told((name == "name") & F.length(value).between(2, 80)), F.lit(""))
    time = F.min_by(seconds, F.when(name.isin(*TIME_NAMES) & (seconds > 1_000_000_000), at))
    out = nodes.groupBy(key).agg(distinct_images(urls).alias("image_urls"), time.alias("_t"), author.alias("author"))
    iso = F.concat(F.date_format(F.timestamp_seconds("_t"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return out.select(key, "image_urls", iso.alias("posted_at"), "author")


def clean_dataset(rows: DataFrame, main: tuple[str, ...] = ("ground_truth", "gt", "text"), side: tuple[str, ...] = ("side_matter", "side"), keep_han_punctuation: bool = True) -> DataFrame:
    """rows with the first of the known text columns cleaned, under their own names."""
    column = lambda names: next((n for n in names if n in rows.columns), None)
    m, s = column(main), column(side)
    if m is None:
        raise ValueError(f"none of {main} is a column")
    out = rows.withColumn(m, clean_main_text(F.col(m), keep_han_punctuation)["text"])
    return out.withColumn(s, clean_side_text(F.col(s))) if s else out


def write_split(rows: DataFrame, path: str, flag: str = "is_valid") -> None:
    """Valid and invalid rows below one folder each; only the parts that rows are written to are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(flag).parquet(path)


def public_rows(rows: DataFrame, submit: bool = False) -> DataFrame:
    """The columns that leave the house; missing texts are empty."""
    fill = lambda c: F.col(c) if c == "boxes" else F.coalesce(F.col(c), F.lit("")).alias(c)
    return rows.select(*[fill(c) for c in (SUBMIT if submit else PUBLIC)])


def write_both(rows: DataFrame, operational: str, shared: str) -> None:
    """The same rows under two prefixes: written once, and copied from there."""
    rows.write.mode("overwrite").parquet(operational)
    rows.sparkSession.read.schema(rows.schema).parquet(operational).write.mode("overwrite").parquet(shared)


def alias_images(*columns: Column) -> Column:
    """The first column that holds images: an array, or a text that is one address or a JSON array of them."""
    none = F.array().cast("array<string>")
    one = lambda c: F.when(blank(c), none).when(F.ltrim(c).startswith("["), F.coalesce(F.from_json(c, "array<string>"), none)).otherwise(F.array(F.trim(c)))
    kept = [F.filter(one(c), lambda u: ~blank(u)) for c in columns]
    return F.coalesce(*[F.when(F.size(k) > 0, k) for k in kept], none)
