"""Text search by trigrams: which rows can match a LIKE pattern, without reading all texts.

``build`` writes the postings (trigram, key) of the lower-cased texts, partitioned by a
hash bucket of the trigram and ordered by trigram, and a small table of their counts.
``search`` takes the literal parts of a pattern, reads the counts of their trigrams,
and looks for the rows that hold the rarest ones: only those buckets are read. The
pattern itself is then checked on these rows, so the result is that of a scan with
ILIKE. A pattern without three literal characters in a row is a scan.

Postings only say where to look: texts that have changed since are still checked, and
``extend`` adds the trigrams of new or changed rows. Doing that twice changes nothing.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

#: Hash buckets of trigrams, one folder each; an index is built and read with the same number.
BUCKETS = 256
#: Trigrams of a pattern that are looked up.
RAREST = 3
#: Up to this many candidates, known from the counts, their keys go into the scan's filter; more are joined.
INLINE_KEYS = 1000


def _trigrams(text: Column) -> Column:
    """Distinct stretches of three characters, overlapping ones included."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(...))"), F.lit(1)))


def literal_parts(pattern: str) -> list[str]:
    """Stretches of a LIKE pattern between its wildcards; a backslash takes the next character literally."""
    parts = [""]
    for escaped, wildcard, plain in re.findall(r"\\(.)|([%_])|(.)", pattern, re.DOTALL):
        if wildcard:
            parts.append("")
        else:
            parts[-1] += escaped or plain
    return [p for p in parts if p]


class TextIndex:
    """Trigram postings below ``path`` for the text columns ``texts`` of a table with the key column ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, texts: list[str], key_type: str = "bigint", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.texts = spark, path.rstrip("/"), key, texts
        self.buckets = buckets
        self.schemas = {"postings": f"key {key_type}, trigram string, bucket int", "counts": "trigram string, n bigint, bucket int"}

    def _bucket(self, trigram: Column) -> Column:
        return F.pmod(F.xxhash64(trigram), F.lit(self.buckets)).cast("int")

    @staticmethod
    def build(table: DataFrame, path: str, key: str, texts: list[str], buckets: int = BUCKETS) -> TextIndex:
        """Index all rows. Null texts have no trigrams; rows with a null key are indexed under it."""
        index = TextIndex(table.sparkSession, path, key, texts, dict(table.dtypes)[key], buckets)
        index.extend(table)
        return index

    def extend(self, rows: DataFrame) -> None:
        """Add the trigrams of new or changed rows. The counts come last: until then the rows are not found."""
        grams = reduce(F.array_union, [_trigrams(F.lower(F.coalesce(F.col(c), F.lit("")))) for c in self.texts])
        path = scratch_path(self.spark, "postings")
        rows.select(F.col(self.key).alias("key"), F.explode(grams).alias("trigram")).withColumn("bucket", self._bucket(F.col("trigram"))).write.parquet(path)
        posted = self.spark.read.schema(self.schemas["postings"]).parquet(path)  # texts are taken apart once for both
        # a common trigram makes its bucket large: rebalancing splits it over tasks and files
        posted.hint("rebalance", "bucket").sortWithinPartitions("bucket", "trigram").write.partitionBy("bucket").mode("append").parquet(f"{self.path}/postings")
        counts = posted.groupBy("bucket", "trigram").agg(F.count(F.lit(1)).alias("n"))
        counts.repartition("bucket").sortWithinPartitions("bucket", "trigram").write.partitionBy("bucket").mode("append").parquet(f"{self.path}/counts")

    def _looked_up(self, pattern: str) -> dict[str, int] | None:
        """Rows at most that hold each of the pattern's rarest trigrams; None if it has none. Reads as many rows as the pattern has trigrams."""
        lowered = self.spark.range(1).select(F.lower(F.lit(pattern))).first()[0]  # as ILIKE does it
        parts = literal_parts(lowered)
        if not any(len(p) >= 3 for p in parts):
            return None
        asked = self.spark.range(1).select(F.explode(F.array_distinct(F.flatten(F.array(*[_trigrams(F.lit(p)) for p in parts])))).alias("trigram"))
        wanted = {r.trigram: r.bucket for r in asked.select("trigram", self._bucket(F.col("trigram")).alias("bucket")).collect()}
        counts = self._read("counts", wanted).groupBy("trigram").agg(F.sum("n").alias("n"))
        found = {r.trigram: r.n for r in counts.collect()}
        rarest = sorted(wanted, key=lambda t: (found.get(t, 0), t))[:RAREST]
        return {t: found.get(t, 0) for t in rarest}

    def _read(self, part: str, trigrams: dict[str, int]) -> DataFrame:
        rows = self.spark.read.schema(self.schemas[part]).parquet(f"{self.path}/{part}")
        return rows.where(F.col("bucket").isin(sorted(set(trigrams.values()))) & F.col("trigram").isin(sorted(trigrams)))

    def candidates(self, rarest: dict[str, int]) -> DataFrame:
        """Keys of the rows that hold all of the trigrams."""
        order = sorted(rarest)
        buckets = self.spark.range(1).select(*[self._bucket(F.lit(t)) for t in order]).first()
        bit = reduce(lambda c, i: c.when(F.col("trigram") == order[i], 1 << i), range(len(order)), F)
        held = self._read("postings", dict(zip(order, buckets))).groupBy("key").agg(F.bit_or(bit).alias("held"))
        return held.where(F.col("held") == (1 << len(order)) - 1).select("key")

    def search(self, table: DataFrame, pattern: str) -> DataFrame:
        """Rows of ``table`` where one of the text columns is ILIKE ``pattern``."""
        matches = reduce(lambda a, b: a | b, [F.col(c).ilike(pattern) for c in self.texts])
        rarest = self._looked_up(pattern)
        if rarest is None:
            return table.where(matches)
        if min(rarest.values()) == 0:
            return table.where(F.lit(False))
        keys = self.candidates(rarest)
        if min(rarest.values()) <= INLINE_KEYS:
            found = [r.key for r in keys.collect()]
            known = F.col(self.key).isin([k for k in found if k is not None])
            return table.where((known | F.col(self.key).isNull() if None in found else known) & matches)
        held = keys.withColumnRenamed("key", "_held")
        return table.join(held, F.col(self.key).eqNullSafe(F.col("_held")), "left_semi").where(matches)
