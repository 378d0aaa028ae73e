"""KV1 deliveries: pipe-separated tables, optionally zipped (O-S1..O-S10).

A delivery folder holds one file per table (``DEST.TMI``, ``USRSTOPX.csv``,
...).  All files are read in one distributed text scan; the table of a row
comes from its file name (``_metadata.file_path``), header rows are recognised
by content (no driver-side peek), and each table gets its explicit schema,
positional columns and ``''`` -> NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gtfsforge.sources.archives import expand_archives  # noqa: F401  (O-S4)

# Owners whose deliveries are ISO-8859-15 encoded (the rest is UTF-8).
LATIN9_OWNERS = ("QBUZZ", "CXX", "EBS")

# Names of the second column, the version, by which a KV1 header line is known.
HEADER_MARKERS = ("Version_Number", "VersionNumber", "VERSIONNUMBER", "version")


def table_of(path) -> F.Column:
    """File path -> KV1 table name: strip folder, ``.TMI``/``.csv`` suffix and a trailing ``X`` (O-S3)."""
    p = F.col(path) if isinstance(path, str) else path
    name = F.substring_index(F.substring_index(p, "/", -1), "\\", -1)
    name = F.when(F.lower(F.right(name, F.lit(4))).isin(".tmi", ".csv"), F.substring(name, F.lit(1), F.length(name) - 4)).otherwise(name)
    return F.lower(F.when(F.right(name, F.lit(1)) == "X", F.substring(name, F.lit(1), F.length(name) - 1)).otherwise(name))


def charset_for(owner: str) -> str:
    return "ISO-8859-15" if owner.upper() in LATIN9_OWNERS else "UTF-8"


def read_kv1(spark: SparkSession, path: str, table: str, schema, owner: str = "", profile_absent=()) -> DataFrame:
    """One KV1 table from a delivery folder (O-S1, O-S2).

    ``schema`` lists the columns in file order (common prefix included);
    ``profile_absent`` names columns a delivery profile lacks: they are not in
    the file and are added as NULL so one schema serves every operator.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    fields = [f for f in schema.fields if f.name not in set(profile_absent)]
    as_text = StructType([StructField(f.name, StringType()) for f in fields])
    raw = (spark.read.schema(as_text).option("sep", "|").option("header", "false").option("nullValue", "")
           .option("quote", '"').option("escape", '"').option("encoding", charset_for(owner)).csv(path)
           .withColumn("__table", table_of(F.col("_metadata.file_path"))))
    second = F.trim(F.col(fields[1].name))
    df = raw.filter(F.col("__table") == table).filter(second.isNull() | ~second.isin(*HEADER_MARKERS))
    cols = []
    for f in schema.fields:
        if f.name in set(profile_absent):
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.dataType.simpleString() == "boolean":
            cols.append(F.lower(F.trim(F.col(f.name))).isin("t", "true", "1", "yes", "y").alias(f.name))
        else:
            cols.append(F.trim(F.col(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _typed(c, kind) -> F.Column:
    """A trimmed text field as its type, null if it can't be (O-S19)."""
    c = F.nullif(F.trim(c), F.lit(""))
    if kind.simpleString() == "boolean":
        low = F.lower(c)
        return F.when(low.isin("t", "true", "1", "yes", "y"), True).when(low.isin("f", "false", "0", "no", "n"), False)
    return c if kind.simpleString() == "string" else c.try_cast(kind)


def parse_lines(lines: DataFrame, table: str, schema, profile_absent=()) -> tuple[DataFrame, DataFrame]:
    """(rows, bad) of one KV1 table from lines (file, pos, line) of any files (O-S1, O-S2, O-S3).

    rows: file, pos and the schema's columns, typed.  bad: file, pos, line and
    reason (``fields`` or the first column whose value isn't of its type), so
    that a line that doesn't parse is reported and not loaded as nulls.  Fields
    are separated by ``|`` and may be quoted; header and blank lines are none.
    """
    fields = [f for f in schema.fields if f.name not in set(profile_absent)]
    text = ", ".join(f"`{f.name}` string" for f in fields)
    how = {"sep": "|", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    second = F.trim(F.get(F.split("line", r"\|", 3), 1))
    mine = lines.where((table_of("file") == table) & (F.trim("line") != "")).where(second.isNull() | ~second.isin(*HEADER_MARKERS))
    # exploded, so that a line is parsed and trimmed once and not for every field, nor again for the filter on what it came to
    read = F.from_csv("line", F.lit(f"{text}, `__bad` string"), how)
    mine = mine.withColumn("__x", F.explode(F.array(read)))
    texts = F.transform(F.array(*[F.col("__x").getField(f.name) for f in fields]), lambda c: F.nullif(F.trim(c), F.lit("")))
    mine = mine.select("file", "pos", "line", F.col("__x.__bad").isNotNull().alias("__wrong"), F.explode(F.array(texts)).alias("__t"))
    at = {f.name: F.get("__t", i) for i, f in enumerate(fields)}
    # text is always of its type
    other = [f for f in fields if f.dataType.simpleString() != "string"]
    mine = mine.select("*", F.explode(F.array(F.struct(*[_typed(at[f.name], f.dataType).alias(f.name) for f in other], F.lit(0).alias("__none")))).alias("__v"))
    value = {f.name: F.col("__v").getField(f.name) for f in other}
    wrong = [F.when(value[f.name].isNull() & at[f.name].isNotNull(), F.lit(f.name)) for f in other]
    mine = mine.withColumn("reason", F.coalesce(F.when(F.col("__wrong"), F.lit("fields")), *wrong, F.lit(None).cast("string")))
    columns = [(F.lit(None).cast(f.dataType) if f.name in set(profile_absent) else value.get(f.name, at.get(f.name))).alias(f.name) for f in schema.fields]
    return mine.where("reason is null").select("file", "pos", *columns), mine.where("reason is not null").select("file", "pos", "line", "reason")


def delivery_meta(operday_lines: DataFrame) -> DataFrame:
    """Owner and first/last operating day of a delivery from its OPERDAY rows (O-S5).

    A header line and rows with fewer than 8 fields are skipped.  Input: a
    ``value`` text column.
    """
    parts = F.split("value", r"\|")
    ok = operday_lines.filter((F.size(parts) >= 8) & ~F.trim(F.get(parts, 1)).isin(*HEADER_MARKERS))
    return ok.select(F.trim(F.get(parts, 3)).alias("dataownercode"),
                     F.trim(F.get(parts, 7)).try_cast("date").alias("validdate")).filter(
        F.col("validdate").isNotNull()).groupBy("dataownercode").agg(
        F.min("validdate").alias("validfrom"), F.max("validdate").alias("validthru"))


def not_expired(meta: DataFrame, as_of: str) -> DataFrame:
    """Skip deliveries whose last day lies before ``as_of`` - 1 day (O-S6)."""
    return meta.filter(F.col("validthru") >= F.date_sub(F.lit(as_of).cast("date"), 1))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Feed index XML: one row per ``periode`` (O-S7)."""
    df = spark.read.format("xml").option("rowTag", "periode").load(path)
    cols = {c.lower(): c for c in df.columns}

    def col(n):
        return F.col(cols[n]) if n in cols else F.lit(None)

    return df.select(
        col("_key").cast("string").alias("key"), col("zipfile").cast("string").alias("zipfile"),
        col("versie").cast("int").alias("versie"), col("isgepubliceerd").cast("string").alias("isgepubliceerd"),
        col("publicatiedatum").cast("string").alias("publicatiedatum"), col("isbaseline").cast("string").alias("isbaseline"),
        col("startdatum").cast("string").alias("startdatum"), col("einddatum").cast("string").alias("einddatum"),
        col("index").cast("int").alias("index"))


def new_deliveries(index: DataFrame, version: DataFrame, purged: DataFrame) -> DataFrame:
    """Published index entries whose (key, version) was never loaded (O-S8)."""
    seen = version.select("filename", "dataownerversion").unionByName(purged.select("filename", "dataownerversion"))
    pub = index.filter(F.lower(F.col("isgepubliceerd")) == "true")
    return pub.join(seen, (pub.key == seen.filename) & (pub.versie == seen.dataownerversion), "left_anti")


def index_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries that are new or carry a higher version than in the old index (O-S9)."""
    o = old.select("key", F.col("versie").alias("__old"))
    return new.join(o, "key", "left").filter(F.col("__old").isNull() | (F.col("versie") > F.col("__old"))).drop("__old")


def load_order(index: DataFrame, forced_baseline=()) -> DataFrame:
    """Baselines first, then by index, then by publication date (O-S10)."""
    base = (F.lower(F.col("isbaseline")) == "true") | F.col("key").isin(*forced_baseline)
    return index.withColumn("__b", base).orderBy(F.desc("__b"), "index", "publicatiedatum").drop("__b")


def load_plan(index: DataFrame, meta: DataFrame, version: DataFrame, purged: DataFrame, as_of: str, forced_baseline=()) -> DataFrame:
    """What to load and when: the index's entries with dataownercode, baseline and step, counted for each owner (O-S6, O-S8, O-S10).

    Published deliveries that weren't loaded (or purged) in this version and
    whose last day isn't over, an owner's baselines first, then by index,
    publication date and key.  meta: key, dataownercode, validfrom, validthru.
    """
    todo = new_deliveries(index, version, purged).join(not_expired(meta, as_of).select("key", "dataownercode"), "key")
    todo = todo.withColumn("baseline", (F.lower(F.col("isbaseline")) == "true") | F.col("key").isin(*forced_baseline))
    order = Window.partitionBy("dataownercode").orderBy(F.desc("baseline"), "index", "publicatiedatum", "key")
    return todo.withColumn("step", F.row_number().over(order))


def conform(df: DataFrame, schema) -> DataFrame:
    """Typed load (O-S19): select the schema's columns in order, cast each, add absent ones as NULL.

    Text fields are trimmed and ``''`` becomes NULL before the cast, as the
    bulk loader's NULL marker does; booleans accept t/true/1/yes.
    """
    from pyspark.sql.types import BooleanType, StringType

    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if dict(df.dtypes)[f.name] == "string":
            c = F.nullif(F.trim(c), F.lit(""))
        if isinstance(f.dataType, BooleanType) and dict(df.dtypes)[f.name] == "string":
            c = F.lower(c).isin("t", "true", "1", "yes", "y")
        elif not isinstance(f.dataType, StringType):
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)
