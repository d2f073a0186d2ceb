"""SRC-1 from files: RSS dumps read item by item with the XML file source, as a batch or a stream.

The row tag is ``item``, so a feed of any size is read entry by entry and never held as one
value, and a file that is broken at one place still gives its other entries.  Folder names such as
``source=a/feed_no=7`` give the feed's keys.  The file source does not say where in a file an
element stood; ``number_items`` restores the feed's order: a file is read by one task from
front to back, so ids that grow within a task order its items, and the files of a
feed follow each other by path.

Defined cases: an element that cannot be read keeps its position and goes to ``item_problems``
(for a file cut short, what stands before the cut stays, and the open element is a problem); files without
items, empty ones too, give no rows; markup inside CDATA and comments is no element.  A stream hands over whole files, so positions hold
within a micro-batch: let the files of one feed land together, or make each file a feed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from inkwell.schemas import RSS_DOC
from inkwell.sources.rss import item_columns

_ITEM = RSS_DOC["channel"].dataType["item"].dataType.elementType
_RAW = "_corrupt_record"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def bounded_listing(spark: SparkSession):
    """Files are listed by a few tasks per core inside, also by streams started inside.

    Spark lists up to 10,000 folders or files with a task each, and what a task reports to the driver besides its
    listing is far more than one file's entry.
    """
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def read_feed_files(spark: SparkSession, path: str, keys: str = "source string, feed_no long", stream: bool = False,
                    glob: str = "*.xml", max_files: int | None = None) -> DataFrame:
    """The item elements of all files below ``path``, unnumbered; ``keys`` are the folder columns (DDL).

    ``max_files`` bounds the files of a micro-batch.  Start a stream inside ``bounded_listing``.
    """
    folders = StructType.fromDDL(keys).fields if keys else []
    schema = StructType([*_ITEM.fields, StructField(_RAW, StringType()), *folders])
    reader = (spark.readStream if stream else spark.read).format("xml").schema(schema).option("rowTag", "item") \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with bounded_listing(spark):
        elements = reader.load(path)
    # The parser's record of a bad element is the whole file: only that there is one is kept.
    return elements.select(*[f.name for f in folders], *item_columns(lambda c: F.col(f"`{c}`")),
                                    F.col(_RAW).isNotNull().alias("unreadable"), F.col("_metadata.file_path").alias("source_file"))


def number_items(items: DataFrame, feed: Sequence[str] = ("source", "feed_no")) -> DataFrame:
    """Adds ``item_pos`` (0-based, in the order of file path and place) and ``n_in_feed``.

    ``items`` is what ``read_feed_files`` gives, unfiltered, and of a stream one micro-batch.  Without
    ``feed`` columns each file is a feed.  The elements are stored once, because their ids must not be
    drawn twice; positions are counted per file and never by a window over items.
    """
    from inkwell.session import checkpoint_root

    checkpoint_root(items.sparkSession)
    rows = items.withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    files = rows.groupBy("source_file", *feed).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*(feed or ["source_file"]))
    before = F.sum("_n").over(whole.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("source_file", (F.coalesce(before, F.lit(0)) - F.col("_from")).alias("_shift"),
                         F.sum("_n").over(whole).cast("int").alias("n_in_feed")).checkpoint(eager=True)
    numbered = rows.join(files, "source_file").withColumn("item_pos", (F.col("_at") + F.col("_shift")).cast("int"))
    return numbered.select(*items.columns, "item_pos", "n_in_feed")


def feed_file_items(numbered: DataFrame) -> DataFrame:
    """The readable items, as ``rss.rss_items`` gives them (``feed_entries`` takes them)."""
    return numbered.filter(~F.col("unreadable")).drop("unreadable", "source_file")


def item_problems(numbered: DataFrame, feed: Sequence[str] = ("source", "feed_no")) -> DataFrame:
    """V-2: the elements that could not be read, by feed, file and position."""
    return numbered.filter("unreadable").select(*feed, "source_file", "item_pos", F.lit("unreadable item").alias("reason"))


def feed_file_sink(write: Callable[[DataFrame, int], None], feed: Sequence[str] = ("source", "feed_no")):
    """``foreachBatch`` function that numbers a micro-batch's items and hands them to ``write(numbered, batch_id)``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(number_items(batch, feed), batch_id)

    return run
