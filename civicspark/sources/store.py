"""Star tables as immutable Parquet folders, named by one manifest per load.

A load writes new folders only (``<root>/<table>/v=<load>-<unique>/``) and never the ones
it reads. It counts when its manifest ``<root>/_loads/<load>.json`` appears, which names
the newest folder of every table: readers see all tables of a load or none. A manifest
is created only if it does not exist, so of two loads that began at the same one the
second fails cleanly and is run again (``atomic``). Reading follows the manifests and
lists no folder.

Big facts are split by ranges of their key (``v=.../faixa=<range>/``). Source
ids grow with time, so a daily batch touches a few ranges; a load reads and
writes only those, and the manifest keeps the newest folder of each range.
A row's key fixes its range, so matching never has to look elsewhere.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas

RANGE_KEYS = {
    "fato_proposicoes": "proposicao_id",
    "fato_votacoes": "votacao_id",
    "ponte_proposicao_autores": "proposicao_id",
    "fato_votacao_votos": "votacao_id",
    "fato_despesas": "cod_documento",
}
#: Column, and folder name, of the key range.
RANGE = "faixa"
APPEND_ONLY = ("pipeline_erros",)
RANGE_WIDTH = 1_000_000
# Keys that do not start with digits spread over this many negative ranges.
TEXT_RANGES = 64


def key_range(key: Column, width: int = RANGE_WIDTH) -> Column:
    digits = F.nullif(F.regexp_extract(key.cast("string"), r"^([0-9]{1,15})", 1), F.lit(""))
    number = F.floor(digits.cast("bigint") / F.lit(width)).cast("bigint")
    return F.coalesce(number, F.lit(-1) - F.pmod(F.xxhash64(key), F.lit(TEXT_RANGES)))


class ConcurrentLoad(RuntimeError):
    """Another load has changed what this one was computed from; run it again."""


@dataclass(frozen=True)
class Manifest:
    """Load number, and for each table the folders (below the root) of each key range; undivided tables have the range ''."""
    number: int = 0
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)


class StarStore:
    def __init__(self, spark: SparkSession, root: str, range_width: int = RANGE_WIDTH):
        self.spark = spark
        self.root = root.rstrip("/")
        self.range_width = range_width
        self._seen: dict[str, dict[str, list[str]]] = {}

    # --- manifests ---

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _text(self, name: str) -> str | None:
        path, fs = self._path(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, name: str, text: str, overwrite: bool) -> None:
        path, fs = self._path(name)
        stream = fs.create(path, overwrite)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def _name(self, number: int) -> str:
        return f"_loads/{number:010d}.json"

    def manifest(self) -> Manifest:
        """The newest load: from the last one noted, which may lag behind or be just being written, to the last that exists."""
        try:
            number = int(self._text("_loads/_newest") or 0)
        except (Py4JJavaError, ValueError):
            number = 0
        while self._path(self._name(number + 1))[1].exists(self._path(self._name(number + 1))[0]):
            number += 1
        return Manifest(number, json.loads(self._text(self._name(number)))) if number else Manifest()

    def _publish(self, base: Manifest, changes: dict[str, dict[str, list[str]]]) -> int:
        """Create the manifest after ``base``, only if it does not exist: a finished file is renamed to its name."""
        tables = {t: {**base.tables.get(t, {}), **changes.get(t, {})} for t in {*base.tables, *changes}}
        number, draft = base.number + 1, f"_loads/_draft-{uuid.uuid4().hex}"
        self._put(draft, json.dumps(tables), False)
        jvm = self.spark._jvm
        (source, _), (target, _) = self._path(draft), self._path(self._name(number))
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            files.rename(source, target, self.spark.sparkContext._gateway.new_array(rename, 0))  # fails if the target exists
        except Py4JJavaError as exc:
            self._path(draft)[1].delete(source, False)
            if "AlreadyExists" in exc.java_exception.getClass().getName():
                raise ConcurrentLoad(f"load {number} exists: another load has been published meanwhile") from exc
            raise
        self._put("_loads/_newest", str(number), True)
        return number

    def _state(self, table: str) -> dict[str, list[str]]:
        """Folders of a table as this store sees them; what has been read is what a later write relies on."""
        self._seen[table] = self.manifest().tables.get(table, {})
        return self._seen[table]

    def begin(self) -> StarLoad:
        """A load of several tables: its writes become visible together, by ``commit`` or at the end of a ``with`` block."""
        return StarLoad(self)

    # --- tables ---

    def versions(self, table: str) -> list[int]:
        """Numbers of the loads whose folders are in use, oldest first."""
        folders = [f for found in self._state(table).values() for f in found]
        return sorted({int(f.split("/v=")[1][:8]) for f in folders})

    def ranges(self, table: str) -> dict[int, str]:
        """Key range -> its newest folder."""
        return {int(key): f"{self.root}/{found[-1]}" for key, found in self._state(table).items() if key}

    def touched(self, table: str, batch: DataFrame) -> list[int] | None:
        """Key ranges a staged batch falls into; None for undivided tables."""
        key = RANGE_KEYS.get(table)
        if key is None:
            return None
        found = batch.select(key_range(F.col(key), self.range_width).alias("r")).distinct().collect()
        return sorted(row["r"] for row in found)

    def read(self, table: str, only: Iterable[int] | None = None) -> DataFrame:
        """Current rows, of the given key ranges only where ``only`` is set;
        an unknown table is empty."""
        state = self._state(table)
        wanted = state if only is None else {str(n) for n in only}
        return self._read(table, [f for key, found in state.items() if key in wanted for f in found])

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        shape = schemas.struct_type(table)
        if not folders:
            return schemas.empty_table(self.spark, table)
        reader = self.spark.read.schema(shape).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*[f"{self.root}/{f}" for f in folders]).select(*shape.names)

    def _stored(self, table: str, df: DataFrame, load: int) -> dict[str, list[str]]:
        """Write a folder that no manifest names yet; the ranges it holds. The rebalance
        hint lets AQE spread a hot range over several files."""
        folder = f"{table}/v={load:08d}-{uuid.uuid4().hex[:12]}"
        out, key = schemas.conform(df, table), RANGE_KEYS.get(table)
        if key is None:
            out.write.parquet(f"{self.root}/{folder}")
            return {"": [folder]}
        split = out.withColumn(RANGE, key_range(F.col(key), self.range_width))
        split.hint("rebalance", RANGE).write.partitionBy(RANGE).parquet(f"{self.root}/{folder}")
        return self.written(folder)

    def written(self, folder: str) -> dict[str, list[str]]:
        """Key range -> its folder, of those in a written folder: one listing, however many they are."""
        path, fs = self._path(f"{folder}/{RANGE}=*")
        names = [status.getPath().getName() for status in fs.globStatus(path) or []]
        return {name.split("=")[1]: [f"{folder}/{name}"] for name in names}

    def write(self, table: str, df: DataFrame) -> int:
        """Write a table as a load of its own and return the load's number. Of a divided table
        the frame must hold every row of each range it contains. Fails if another load
        has changed these ranges since the table was read."""
        with self.begin() as load:
            load.expected = {table: self._seen[table]} if table in self._seen else {}
            load.write(table, df)
        self._seen.pop(table, None)
        return load.base.number + 1

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in schemas.TABLES}


class StarLoad(StarStore):
    """One load: reads the manifest it began with and its own writes, and publishes all of them at once."""

    def __init__(self, store: StarStore):
        super().__init__(store.spark, store.root, store.range_width)
        self.base = store.manifest()
        self.changes: dict[str, dict[str, list[str]]] = {}
        #: Folders that the caller has read before this load began.
        self.expected: dict[str, dict[str, list[str]]] = {}

    def begin(self) -> StarLoad:
        """A load within this one is part of it."""
        return _Within(self)

    def _state(self, table: str) -> dict[str, list[str]]:
        return {**self.base.tables.get(table, {}), **self.changes.get(table, {})}

    def write(self, table: str, df: DataFrame) -> int:
        before = self._state(table)
        seen = self.expected.get(table)
        found = self._stored(table, df, self.base.number + 1)
        if table in APPEND_ONLY:
            found = {"": [*before.get("", []), *found[""]]}
        elif seen is not None and any(self.base.tables.get(table, {}).get(k) != seen.get(k) for k in found):
            raise ConcurrentLoad(f"{table} has changed since it was read")
        self.changes.setdefault(table, {}).update(found)
        return self.base.number + 1

    def commit(self) -> int:
        """Publish; returns the number of the load. Without changes nothing is published."""
        if not self.changes:
            return self.base.number
        return self._publish(self.base, self.changes)

    def replace(self, name: str, found: dict[str, list[str]]) -> None:
        """Enter folders, or other notes of a derived table, into the manifest."""
        self.changes.setdefault(name, {}).update(found)

    def noted(self, name: str) -> dict[str, list[str]]:
        return self._state(name)

    def __enter__(self) -> StarLoad:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.commit()


class _Within:
    def __init__(self, load: StarLoad):
        self.load = load

    def __enter__(self) -> StarLoad:
        return self.load

    def __exit__(self, *_) -> None:
        pass


def atomic(store: StarStore, job: Callable[[StarStore], object], attempts: int = 5):
    """Run ``job`` on a load of ``store`` and publish it whole; again from the start if another load came first."""
    for attempt in range(attempts):
        try:
            with store.begin() as load:
                result = job(load)
            return result
        except ConcurrentLoad:
            if attempt + 1 == attempts:
                raise


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabela, linhas) for every table: the load check."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
