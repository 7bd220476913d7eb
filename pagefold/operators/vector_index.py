"""The keyed vector index: preparing entries, adding what is new, counting, resetting."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagefold import schemas
from pagefold.functions.text import is_blank, strip
from pagefold.settings import Settings
from pagefold.sources.tables import path_exists

CUSTOM_PREFIX = "custom_"


@dataclass(frozen=True)
class Layout:
    """What an index was made with; it is stored beside the entries and no caller's setting changes it."""

    buckets: int
    dimension: int


def entry_id(source_file: Column, chunk_id: Column) -> Column:
    return F.concat_ws("_", source_file, chunk_id.cast("string"))


def flatten_metadata(metadata: Column) -> Column:
    """Prefix every key; values are text already."""
    return F.transform_keys(metadata, lambda key, _: F.concat(F.lit(CUSTOM_PREFIX), key))


def bucket_of(source_file: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(source_file), F.lit(buckets)).cast("int")


def pair_vectors(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Chunks with their vectors, matched by document and chunk number.

    Both keys are hashed together, so one huge document spreads over all tasks.
    """
    return chunks.drop("embedding").join(
        vectors.select("source_file", "chunk_id", "embedding"), ["source_file", "chunk_id"]
    )


def unpaired_documents(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Documents with vectors but without chunks, each once."""
    return (
        vectors.select("source_file").distinct()
        .join(chunks.select("source_file").distinct(), "source_file", "left_anti")
    )


def index_entries(embedded: DataFrame) -> DataFrame:
    """Chunk rows with vectors to index rows; a blank document is stored as one space."""
    text = F.col("text")
    metadata = F.col("metadata") if "metadata" in embedded.columns else F.lit(None)
    return embedded.select(
        entry_id(F.col("source_file"), F.col("chunk_id")).alias("id"),
        "embedding",
        F.when(is_blank(text), F.lit(" ")).otherwise(strip(text)).alias("document"),
        "source_file",
        F.coalesce("chunk_id", F.lit(0)).alias("chunk_id"),
        F.coalesce("page_num", F.lit(1)).alias("page_num"),
        F.coalesce("char_count", F.lit(0)).alias("char_count"),
        flatten_metadata(metadata.cast("map<string,string>")).alias("custom"),
    )


def new_entries(entries: DataFrame, existing: DataFrame) -> DataFrame:
    """Entries whose id is not among the ids of ``existing``, each id once (the first text wins).

    Known ids go first, and what remains is already placed for the window that drops repeated ones.
    """
    fresh = entries.join(existing.select("id"), "id", "left_anti")
    order = Window.partitionBy("id").orderBy("document")
    once = fresh.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return once.select(entries.columns)


class VectorIndex:
    """A Parquet table of entries, partitioned by a hash of the document name."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings | None = None) -> None:
        self.spark = spark
        self.path = path
        self.settings = settings or Settings()

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def read(self) -> DataFrame:
        """Current entries; an index that was never written is empty."""
        if not self.exists():
            return self.spark.createDataFrame([], schemas.INDEX)
        return self.spark.read.schema(schemas.INDEX).parquet(self.path)

    def layout(self) -> Layout | None:
        """The stored layout; none before the first entries."""
        path = f"{self.path}/_layout"
        if not path_exists(self.spark, path):
            return None
        return Layout(*self.spark.read.schema("buckets int, dimension int").json(path).first())

    def _keep_layout(self, layout: Layout) -> None:
        row = self.spark.range(1).select(
            F.lit(layout.buckets).alias("buckets"), F.lit(layout.dimension).alias("dimension")
        )
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/_layout")

    def _write(self, entries: DataFrame, layout: Layout, mode: str) -> None:
        # Rebalancing makes files of even size: big buckets are split, small ones share a task.
        columns = [f.split()[0] for f in schemas.INDEX.split(", ")]
        fits = F.size("embedding") == layout.dimension
        wrong = F.concat(F.lit("vector of another dimension: "), F.coalesce("id", F.lit("")))
        (
            entries.withColumn("embedding", F.when(fits, F.col("embedding")).otherwise(F.raise_error(wrong)))
            .withColumn("source_bucket", bucket_of(F.col("source_file"), layout.buckets))
            .select(columns)
            .hint("rebalance", "source_bucket")
            .write.mode(mode)
            .partitionBy("source_bucket")
            .parquet(self.path)
        )

    def fresh(self, entries: DataFrame) -> DataFrame:
        """Those of ``entries`` whose id the index lacks.

        Only ids of buckets the entries touch are read, by the stored number of buckets: the
        semi-join on the partition column lets the planner prune the folders.
        """
        layout = self.layout()
        if layout is None:
            return new_entries(entries, self.read())
        touched = entries.select(bucket_of(F.col("source_file"), layout.buckets).alias("source_bucket")).distinct()
        return new_entries(entries, self.read().join(touched, "source_bucket", "left_semi"))

    def add(self, entries: DataFrame) -> None:
        """Append the entries that are not there yet; running it again adds nothing.

        The first entries settle the dimension; a vector of another one fails the write.
        """
        layout = self.layout()
        if layout is None:
            sizes = entries.where(F.col("embedding").isNotNull()).select(F.size("embedding")).first()
            if sizes is None:
                return
            layout = Layout(self.settings.index_buckets, sizes[0])
            self._keep_layout(layout)
        self._write(self.fresh(entries), layout, "append")

    def reset(self) -> None:
        """Empty the index and keep it, and its layout, in place."""
        layout = self.layout() or Layout(self.settings.index_buckets, 0)
        self._write(self.spark.createDataFrame([], schemas.INDEX), layout, "overwrite")
        if layout.dimension:
            self._keep_layout(layout)

    def count(self) -> int:
        return self.read().count()


def upload_summary(chunks: DataFrame, vectors: DataFrame, index: DataFrame) -> DataFrame:
    """One row: documents paired, documents without chunks, vectors paired, entries in the index."""
    documents = vectors.groupBy("source_file").agg(F.count("*").alias("vectors"))
    known = chunks.select("source_file").distinct().withColumn("known", F.lit(True))
    joined = documents.join(known, "source_file", "left")
    found = F.col("known").isNotNull()
    paired = joined.select(
        found.cast("long").alias("succeeded"),
        (~found).cast("long").alias("failed"),
        F.when(found, F.col("vectors")).otherwise(0).alias("uploaded"),
        F.lit(0).cast("long").alias("in_index"),
    )
    none = F.lit(0).cast("long")
    total = index.select(
        none.alias("succeeded"), none.alias("failed"), none.alias("uploaded"),
        F.lit(1).cast("long").alias("in_index"),
    )
    names = ("succeeded", "failed", "uploaded", "in_index")
    return paired.unionByName(total).agg(
        *[F.coalesce(F.sum(name), none).alias(name) for name in names]
    )
