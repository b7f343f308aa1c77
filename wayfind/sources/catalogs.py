"""Text catalogs, packed CSV, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: log levels by rank.
LEVELS = ["DEBUG", "INFO", "WARN", "ERROR"]
#: Lines of a split, where lines come with numbers only.
LINES = 65_536


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split, line_no, value of text files: a large file is read as several splits, in which line_no rises without counting from the file's start."""
    rows = spark.read.text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line_no"), "value")


def sectioned(lines: DataFrame, sections: dict[str, str], attribute: tuple[str, str] | None = None) -> DataFrame:
    """File, kind, label, value, attribute of lines(file, line_no, value): values under known `### ` headings.

    A `## ` heading or an unknown section ends the section; other `#` lines, fences and lines that are
    no `host:port[:user:password]` or URL are skipped; the first of equal values stays and values of a
    kind are labelled kind_1, kind_2, … in order. attribute names a line by its beginning and a kind:
    what follows the first `=` in the last such line of a file's sections is the attribute of all
    values of the kind in that file.

    Lines of a file are read in splits, of read_lines() or else of LINES lines. What a split needs of
    those before is the section that was open and how many values of each kind there were: one row
    per split tells that, so a file's lines don't meet.
    """
    text = F.trim(F.col("value"))
    heading = F.lower(F.trim(F.regexp_replace(text, "^#+", "")))
    known = F.create_map(*(x for k, v in sections.items() for x in (F.lit(k), F.lit(v))))
    mark = F.when(text.startswith("###"), F.coalesce(F.try_element_at(known, heading), F.lit(""))).when(text.startswith("##"), F.lit(""))
    split = F.col("split") if "split" in lines.columns else F.floor(F.col("line_no") / LINES)
    rows = lines.select("file", split.cast("long").alias("split"), F.col("line_no").cast("long").alias("line_no"), text.alias("value"), mark.alias("mark"), F.lit(False).alias("carried"))
    upto = Window.partitionBy("file").orderBy("split")  # a row per split
    ends = rows.groupBy("file", "split").agg(F.max_by("mark", F.when(F.col("mark").isNotNull(), F.col("line_no"))).alias("mark"))
    ends = ends.withColumn("mark", F.last("mark", ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, -1))).filter("mark is not null")
    rows = rows.unionByName(ends.withColumn("carried", F.lit(True)), allowMissingColumns=True)
    within = Window.partitionBy("file", "split").orderBy(F.desc("carried"), "line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("kind", F.last("mark", ignorenulls=True).over(within)).filter("not carried and kind <> '' and not startswith(value, '#') and not startswith(value, '```')").drop("mark", "carried")
    named = F.lower("value").startswith(attribute[0].lower()) if attribute else F.lit(False)
    values = rows.filter(~named & F.col("value").rlike(r"(?i)^([a-z][a-z0-9+.-]*://[^/\s]+:[0-9]+|[^:\s]+:[^:\s]+(:[^:\s]+:[^:\s]+)?)"))
    once = values.groupBy("file", "value").agg(F.min(F.struct("split", "line_no", "kind")).alias("x")).select("file", "value", "x.*")
    counts = once.groupBy("file", "kind", "split").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("file", "kind").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = once.withColumn("place", F.row_number().over(Window.partitionBy("file", "kind", "split").orderBy("line_no"))).join(counts.drop("n"), ["file", "kind", "split"])
    out = placed.select("file", "kind", F.concat_ws("_", "kind", (F.col("place") + F.col("before")).cast("string")).alias("label"), "value")
    if not attribute:
        return out.withColumn("attribute", F.lit(None).cast("string"))
    last = rows.filter(named).groupBy("file").agg(F.max_by("value", F.struct("split", "line_no")).alias("line"))
    last = last.select("file", F.nullif(F.trim(F.regexp_extract("line", "=(.*)$", 1)), F.lit("")).alias("attribute"), F.lit(attribute[1]).alias("kind"))
    return out.join(last, ["file", "kind"], "left").select("file", "kind", "label", "value", "attribute")


def packed_registry(rows: DataFrame, name: str, packed: str) -> DataFrame:
    """Province, tier, places, hashtags of a two-column table whose second column is `tier | places; … | hashtags; …`."""
    cut = F.split(F.col(packed), r"\|")
    listed = lambda k, strip: F.filter(F.transform(F.split(F.regexp_replace(F.coalesce(F.get(cut, F.lit(k)), F.lit("")), r"^[^:]*:", ""), ";"), lambda x: F.regexp_replace(F.trim(x), strip, "")), lambda x: x != "")
    tier = F.regexp_extract(F.coalesce(F.get(cut, F.lit(0)), F.lit("")), r"\b([ABC])\b", 1)
    return rows.select(F.trim(F.regexp_replace(F.col(name), "^\\x{FEFF}", "")).alias("province"), F.nullif(tier, F.lit("")).alias("tier"), listed(1, "^$").alias("places"), listed(2, "^#").alias("hashtags"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    return packed_registry(rows, rows.columns[0], rows.columns[1])


def level_rank(level: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(x for k, v in enumerate(LEVELS) for x in (F.lit(v), F.lit(k)))), F.upper(level)), F.lit(1))


def log_lines(lines: DataFrame, threshold: str, value: str = "value") -> DataFrame:
    """Ts, level, context, msg, fields (the rest, as JSON) of JSON log lines at or above a level; other lines are skipped."""
    m = F.from_json(F.col(value), "map<string,string>")
    rows = lines.withColumn("m", m).filter(F.col("m").isNotNull() & F.col("m")["msg"].isNotNull())
    rest = F.map_filter("m", lambda k, _: ~k.isin("ts", "level", "context", "msg"))
    return rows.filter(level_rank(F.col("m")["level"]) >= LEVELS.index(threshold)).select(F.col("m")["ts"].alias("ts"), F.col("m")["level"].alias("level"), F.col("m")["context"].alias("context"), F.col("m")["msg"].alias("msg"), F.to_json(rest).alias("fields"))
