"""Documents: choosing them by path, reading them, and turning them into line tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions import text as tx
from zoneflow.session import checked_broadcast


PATH_COLUMNS = ["path", "root", "city", "scrape_date", "title", "section"]


def list_documents(spark: SparkSession, root: str) -> DataFrame:
    """Paths below ``root`` as ``path`` (root/city/date/title.txt), without reading text."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
        .load(root).select("path")
    )
    return listed.select(_below(spark, root, F.col("path")).alias("path")).orderBy("path")


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """``path`` and whole ``text`` of every .txt below ``root``."""
    raw = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
        .text(root, wholetext=True)
    )
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    # Bytes that are not UTF-8 are dropped.
    return raw.select(
        _below(spark, root, path).alias("path"),
        F.translate(F.col("value"), "�", "").alias("text"),
    )


def _below(spark: SparkSession, root: str, path: Column) -> Column:
    """The path from the root's own name on. The root is cut off by its length, so folders below
    that repeat its name stay as they are."""
    given = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given)
    at = len(whole.toUri().getPath()) + 1
    return F.concat(F.lit(whole.getName()), F.substring(F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), at, 1 << 30))


def path_columns(docs: DataFrame, path: str = "path") -> DataFrame:
    """Add root, city, scrape_date, title and section taken from the path."""
    parts = F.split(F.col(path), "/")
    return (
        docs.withColumn("root", F.get(parts, F.lit(0)))
        .withColumn("city", F.get(parts, F.lit(1)))
        .withColumn("scrape_date", tx.short_date(F.get(parts, F.lit(2))))
        .withColumn("title", F.array_join(F.slice(parts, 4, F.greatest(F.size(parts), F.lit(4))), "/"))
        .withColumn("section", tx.path_section(path))
    )


def on_whitelist(path: Column | str, terms: list[str]) -> Column:
    """Some term is a word of the path."""
    wanted = F.array(*[F.lit(t.lower()) for t in terms])
    return F.arrays_overlap(tx.path_tokens(path), wanted)


def select_documents(
    docs: DataFrame,
    whitelist: list[str] | None = None,
    city: str | None = None,
    most_recent: bool = False,
) -> DataFrame:
    """Documents kept by whitelist, city and, per (root, city, title), latest scrape."""
    if city is not None:
        docs = docs.where(tx.path_part("path", 1) == city)
    if whitelist is not None:
        docs = docs.where(on_whitelist("path", whitelist))
    docs = path_columns(docs)
    if most_recent:
        row_id = "path" if set(docs.columns) - set(PATH_COLUMNS) else None
        docs = latest(docs, ["root", "city", "title"], ["scrape_date", "path"], row_id)
    return docs


def latest(df: DataFrame, keys: list[str], newest: list[str], row_id: str | None = None) -> DataFrame:
    """Newest row per key, by the ``newest`` columns.

    Without ``row_id`` the whole row travels with the aggregation, which combines before the
    shuffle. With it (wide rows, such as texts) only keys, dates and ids are compared, and
    the superseded rows, usually few, are removed by an anti join that leaves the wide rows
    where they are when the list measures small.
    """
    rank = F.struct(*newest)
    if row_id is None:
        rest = [c for c in df.columns if c not in keys]
        best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("best"))
        return best.select(*[F.col(c) if c in keys else F.col(f"best.{c}").alias(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.max(rank).alias("_best"))
    superseded = (
        df.select(*dict.fromkeys([*keys, *newest, row_id])).join(best, keys)
        .where(rank < F.col("_best")).select(row_id).distinct()
    )
    return df.join(checked_broadcast(superseded), row_id, "left_anti")


def lines(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per line: the ``keep`` columns, ``n_lines``, ``line_no`` (from 1) and ``line``.

    A split on line feeds, so a trailing feed leaves an empty last line; non-breaking spaces
    become spaces. Blank lines stay: windows count them. The line count comes from the same
    array, so no shuffle is needed.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c != text]
    # The count is its own projection below the explode, so the array is not copied along
    # with every line; the outer form keeps Spark from splitting again to filter.
    return (
        docs.where(F.col(text).isNotNull())
        .select(*keep, F.split(tx.plain_spaces(text), "\n").alias("_lines"))
        .select(*keep, "_lines", F.size("_lines").alias("n_lines"))
        .select(*keep, "n_lines", F.posexplode_outer("_lines").alias("_pos", "line"))
        .select(*keep, "n_lines", (F.col("_pos") + 1).alias("line_no"), "line")
    )


def cities(docs: DataFrame) -> DataFrame:
    return docs.select(tx.path_part("path", 1).alias("city")).distinct()


def city_documents(docs: DataFrame, city: str) -> DataFrame:
    """Documents of a city, its name compared in lower case."""
    return docs.where(F.lower(tx.path_part("path", 1)) == city.lower())
