"""Raw JSON envelopes: ``{_meta: {...}, dados: [...]}`` per document.

A dataset folder holds one *snapshot* per extraction, named
``<timestamp>.json`` (a listing) or ``<timestamp>_<id>.json`` (a detail or a
sub-resource). A snapshot is a single file, as the crawler leaves it, or a
folder of part files, as a Spark job lands it; its name is the first path
component below the dataset folder in both cases.

Records keep their origin: ``_snapshot``, ``_part`` (file and page inside the
snapshot) and ``_pos`` (position in the array), so that "first record" has one
meaning however the read is parallelised.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

META = "STRUCT<endpoint: STRING, params: STRING, fetched_at: STRING, count: INT, source: STRING>"
ORIGIN = ("_snapshot", "_part", "_pos")


def snapshot_name(entity: str) -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), f"/{entity}/([^/]+)", 1)


def is_listing(snapshot: Column) -> Column:
    """Listings carry no '_' in their name."""
    return ~snapshot.contains("_")


# Digits of the largest BIGINT: a page number is never cut.
_PAGE_DIGITS = 19

#: Documents of a landed part file.
FILE_PAGES = 20_000


def _page_part() -> Column:
    page = F.coalesce(F.get_json_object("_meta.params", "$.pagina").try_cast("bigint"), F.lit(0))
    return F.concat_ws("#", F.col("_metadata.file_name"), F.lpad(page.cast("string"), _PAGE_DIGITS, "0"))


def read_envelopes(
    spark: SparkSession,
    raw_dir: str,
    entity: str,
    payload_ddl: str,
    *,
    multi_line: bool | None = None,
    streaming: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Envelopes of one dataset with their lineage; malformed documents keep
    only ``_corrupt``.

    Both layouts are read and told apart by the file name: a crawler's file
    ``<snapshot>.json`` holds one document over many lines, a landed part file
    one document a line. ``multi_line`` reads every file
    as the one (True) or the other (False)."""
    if multi_line is None:
        layouts = [_read_layout(spark, raw_dir, entity, payload_ddl, many, streaming, max_files, glob)
                   for many, glob in ((True, "*.json"), (False, "part-*"))]
        return layouts[0].unionByName(layouts[1])
    return _read_layout(spark, raw_dir, entity, payload_ddl, multi_line, streaming, max_files)


def _read_layout(
    spark: SparkSession, raw_dir: str, entity: str, payload_ddl: str, multi_line: bool, streaming: bool,
    max_files: int | None, glob: str | None = None,
) -> DataFrame:
    schema = f"_meta {META}, dados {payload_ddl}, _corrupt STRING"
    reader = spark.readStream if streaming else spark.read
    reader = (
        reader.schema(schema)
        .option("multiLine", str(multi_line).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(f"{raw_dir}/{entity}").select(
        snapshot_name(entity).alias("_snapshot"),
        _page_part().alias("_part"),
        F.col("_meta.endpoint").alias("_endpoint"),
        F.col("_meta.params").alias("_params"),
        F.col("_meta.fetched_at").alias("_fetched_at"),
        F.col("_meta.count").alias("_count"),
        "dados",
        "_corrupt",
    )


def latest_listing(spark: SparkSession, raw_dir: str, entity: str) -> str | None:
    """Name of the newest listing, from the file listing alone (no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{raw_dir}/{entity}")
    name = F.regexp_extract("path", f"/{entity}/([^/]+)", 1)
    return files.select(name.alias("s")).where(is_listing(F.col("s"))).agg(F.max("s")).first()[0]


def _is_broken() -> Column:
    return F.col("_corrupt").isNotNull() & F.col("dados").isNull()


def unreadable(envelopes: DataFrame) -> DataFrame:
    """Malformed documents: (_snapshot, _part), one row each."""
    return envelopes.where(_is_broken()).select("_snapshot", "_part")


def records(envelopes: DataFrame) -> DataFrame:
    """One row per array element with the element's fields and its origin."""
    rows = envelopes.select(
        "_snapshot", "_part", "_endpoint", "_params", "_fetched_at", F.posexplode("dados").alias("_pos", "_record")
    )
    return rows.select("_snapshot", "_part", "_pos", "_endpoint", "_params", "_fetched_at", "_record.*")


def all_records(
    spark: SparkSession, raw_dir: str, entity: str, record_ddl: str, seen: Observation | None = None, **options
) -> DataFrame:
    """Records of every listing, in (snapshot, part, position) order semantics. ``seen`` counts
    the malformed documents (``broken``) in the first job that reads the records."""
    envelopes = read_envelopes(spark, raw_dir, entity, f"ARRAY<STRUCT<{record_ddl}>>", **options).where(is_listing(F.col("_snapshot")))
    return records(envelopes.observe(seen, F.count_if(_is_broken()).alias("broken")) if seen else envelopes)


def latest_records(spark: SparkSession, raw_dir: str, entity: str, record_ddl: str, **options) -> DataFrame:
    """Records of the newest listing only; file pruning skips the others."""
    newest = latest_listing(spark, raw_dir, entity)
    envelopes = read_envelopes(spark, raw_dir, entity, f"ARRAY<STRUCT<{record_ddl}>>", **options)
    return records(envelopes.where(F.col("_snapshot") == F.lit(newest)))


def sub_resource_records(
    spark: SparkSession, raw_dir: str, entity: str, record_ddl: str, key: Column, key_name: str, **options
) -> DataFrame:
    """Records whose owner id sits in the endpoint; envelopes without a
    readable owner are left out, empty arrays yield nothing."""
    envelopes = read_envelopes(spark, raw_dir, entity, f"ARRAY<STRUCT<{record_ddl}>>", **options)
    return records(envelopes).withColumn(key_name, key).where(F.col(key_name).isNotNull())


def details(spark: SparkSession, raw_dir: str, entity: str, record_ddl: str, **options) -> DataFrame:
    """Detail objects; ``dados`` may be an object or a list of one. An empty
    payload gives a row of NULLs."""
    envelopes = read_envelopes(spark, raw_dir, entity, "STRING", **options)
    as_list = F.get(F.from_json("dados", f"ARRAY<STRUCT<{record_ddl}>>"), F.lit(0))
    as_object = F.from_json("dados", f"STRUCT<{record_ddl}>")
    record = F.when(F.ltrim("dados").startswith("["), as_list).otherwise(as_object)
    return envelopes.where(~is_listing(F.col("_snapshot"))).select(
        "_snapshot", "_part", "_endpoint", "_corrupt", record.alias("_record")
    ).select("_snapshot", "_part", "_endpoint", "_corrupt", "_record.*")


def lineage(envelopes: DataFrame) -> DataFrame:
    """Envelope audit: announced count against the real number of records."""
    return envelopes.select(
        "_snapshot",
        F.col("_endpoint").alias("endpoint"),
        F.col("_params").alias("params"),
        F.col("_fetched_at").alias("fetched_at"),
        F.col("_count").alias("announced"),
        F.coalesce(F.size("dados"), F.lit(0)).alias("found"),
    ).withColumn("consistent", F.col("announced").eqNullSafe(F.col("found")))


def newest_per_owner(envelopes: DataFrame, owner: Column, name: str) -> DataFrame:
    """(owner, newest snapshot) pairs: the one fetch of a sub-resource that counts."""
    keyed = envelopes.select(owner.alias(name), "_snapshot").where(F.col(name).isNotNull())
    return keyed.groupBy(name).agg(F.max("_snapshot").alias("_snapshot"))


def _documents(snapshot: str, page_size: int):
    """One document for each endpoint of every ``page_size`` rows (seq, endpoint, record)."""
    def text(page: int, endpoint: str | None, found: list[str]) -> str:
        meta = {"endpoint": endpoint} if endpoint is not None else {}
        meta |= {"params": {"pagina": page}, "fetched_at": snapshot, "count": len(found), "source": "landed"}
        return f'{{"_meta":{json.dumps(meta, ensure_ascii=False, separators=(",", ":"))},"dados":[{",".join(found)}]}}'

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_page = None, {}
        for batch in batches:
            done = []
            for seq, endpoint, record in zip(*(batch.column(c).to_pylist() for c in ("seq", "endpoint", "record"))):
                page = seq // page_size
                if page != current:
                    done += [text(current, *entry) for entry in open_page.items()]
                    current, open_page = page, {}
                open_page.setdefault(endpoint, []).append(record)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([text(current, *entry) for entry in open_page.items()], pa.string())], ["value"])

    return run


def land(
    df: DataFrame,
    raw_dir: str,
    entity: str,
    snapshot: str,
    *,
    endpoint: Column | None = None,
    page_size: int = 100,
) -> str:
    """Write rows as envelopes, one compact document per line, never replacing
    an existing snapshot. Pages hold at most ``page_size`` rows of one task's
    input, so no page can grow with a hot key. The rows of a page lie together in
    their task: records become text there and are written without a shuffle, compressed
    (a compressed file is read by one task, so it holds ``FILE_PAGES`` documents at most)."""
    rows = df.select(
        F.monotonically_increasing_id().alias("seq"),
        (endpoint if endpoint is not None else F.lit(f"/{entity.replace('_', '/')}")).cast("string").alias("endpoint"),
        F.to_json(F.struct(*df.columns)).alias("record"),
    )
    pages = rows.mapInArrow(_documents(snapshot, page_size), "value string")
    target = f"{raw_dir}/{entity}/{snapshot}.json"
    pages.write.mode("error").option("maxRecordsPerFile", FILE_PAGES).text(target, compression="snappy")
    return target
