"""Text embeddings, computed once for each distinct text."""

from __future__ import annotations

import uuid
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.store import Files


class Embedder(Protocol):
    """``column`` turns a text column into a vector column: built-in functions, or a pandas
    UDF over an iterator of batches, which loads its model once for each worker."""

    size: int

    def column(self, text: Column) -> Column: ...


class HashEmbedder:
    """Not a language model: a stand-in whose values, in [-1, 1], follow from md5 alone."""

    def __init__(self, size: int = 512):
        self.size = size

    def value(self, text: Column, j: Column) -> Column:
        digest = F.md5(F.concat(text, F.lit("#"), j.cast("string")))
        code = lambda i: F.instr(F.lit("0123456789abcdef"), F.substring(digest, i, 1)) - 1
        n = code(1) * 4096 + code(2) * 256 + code(3) * 16 + code(4)
        return n / F.lit(32767.5) - 1

    def column(self, text: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(self.size - 1)), lambda j: self.value(text, j).cast("float"))


def embed_distinct(df: DataFrame, text: str, embedder: Embedder, name: str) -> DataFrame:
    """``df`` with the embedding of ``text``. The model sees each distinct text once; the
    vectors come back by a join that Spark plans by their size."""
    vectors = df.select(text).where(F.col(text).isNotNull()).distinct().withColumn(name, embedder.column(F.col(text)))
    return df.join(vectors, text, "left")


BROADCAST_BYTES = 1 << 26  # of the vectors


def embed_in_place(df: DataFrame, texts: DataFrame, text: str, embedder: Embedder, name: str, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, whose rows may be large and are not shuffled, with the embedding of ``text``.
    ``texts`` has the texts alone. If the vectors of the distinct ones take ``most`` bytes at
    most, they are made once and broadcast, else each row's is made where the row is."""
    distinct = texts.select(text).where(F.col(text).isNotNull()).distinct()
    few = most // (4 * embedder.size)
    if distinct.limit(few + 1).count() > few:
        return df.withColumn(name, F.when(F.col(text).isNotNull(), embedder.column(F.col(text))))
    return df.join(F.broadcast(distinct.withColumn(name, embedder.column(F.col(text)))), text, "left")


class EmbeddingStore:
    """Vectors by text, kept between builds: a text is embedded once over the store's life.

    A folder of Parquet parts and a log that names those that count. ``add`` embeds the texts
    that no part has, writes them as a part, and enters it in the log in one step; if another
    writer was faster, it compares again. A store belongs to one embedder, whose name its first
    entry holds."""

    def __init__(self, spark: SparkSession, folder: str, embedder: Embedder, name: str):
        self.spark, self.folder, self.embedder = spark, folder.rstrip("/"), embedder
        self._files = Files(spark, self.folder)
        own = f"{name}/{embedder.size}"
        if not self._files.publish("log/00000000.txt", own) and (have := self._files.read("log/00000000.txt")) != own:
            raise ValueError(f"the store is of {have}, not of {own}")

    def _parts(self) -> list[str]:
        return [self._files.read(f"log/{x}") for x in self._files.names("log") if x.endswith(".txt") and x != "00000000.txt"]

    def vectors(self) -> DataFrame:
        """text and vector of all that is stored."""
        parts = [f"{self.folder}/{p}" for p in self._parts()]
        schema = "text string, vector array<float>"
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def add(self, texts: DataFrame, text: str) -> int:
        """Embeds and stores the texts that are new; returns their number."""
        while True:
            entry = len(self._parts()) + 1
            distinct = texts.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct()
            new = distinct.join(self.vectors().select("text"), "text", "left_anti")
            part, seen = f"part-{uuid.uuid4().hex}", Observation()
            new.withColumn("vector", self.embedder.column(F.col("text"))).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.folder}/{part}")
            n = seen.get["n"]
            if not n or self._files.publish(f"log/{entry:08d}.txt", part):
                if not n:
                    self._files.delete(part)
                return n
            self._files.delete(part)

    def embed(self, df: DataFrame, text: str, name: str) -> DataFrame:
        """``df`` with the stored vectors of its texts, new ones added first. Null texts have
        none. The join is Spark's, by the vectors' size."""
        self.add(df, text)
        known = self.vectors().select(F.col("text").alias("q_text"), F.col("vector").alias(name))
        return df.join(known, F.col(text) == F.col("q_text"), "left").drop("q_text")
