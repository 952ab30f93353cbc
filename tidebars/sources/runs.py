"""Tables that grow by runs: attempts in folders of their own, one commit a run, folders merged as they pile up.

A run writes every table into folders that no other attempt uses and then its manifest, a small file named by the run's number. The
manifest is created only if there is none of that name: of two runs at once one commits, the other gets
:class:`Conflict` and its folders are deleted. The newest manifest names the folders that make up each table; what it doesn't name isn't
read, so a run that broke off leaves nothing to be seen, and no reader lists the folders of a table.

``FAN`` folders of a level are merged by the run that would make them too many into one of the next level, by month; its manifest has the merged
folder in their place. A table of n runs thus has at most ``FAN - 1`` folders for each digit of n written to the base ``FAN``, and a row is
rewritten once a level.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FAN = 16  # folders of a level before they are merged


class Conflict(RuntimeError):
    """Another run has committed under the number."""


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


@dataclass(frozen=True)
class Manifest:
    """A committed run: its number, what it says of itself, and by table the folders (level, name) and the schema."""

    run: int
    facts: dict
    folders: dict[str, list[list]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)


def _name(run: int) -> str:
    return f"run-{run:09d}.json"


def newest(spark: SparkSession, folder: str) -> Manifest | None:
    """The last committed run."""
    fs, path = _hadoop(spark, f"{folder}/runs")
    if not fs.exists(path):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    numbers = [int(n[4:-5]) for n in names if n.startswith("run-") and n.endswith(".json")]
    return manifest(spark, folder, max(numbers)) if numbers else None


def manifest(spark: SparkSession, folder: str, run: int) -> Manifest:
    fs, path = _hadoop(spark, f"{folder}/runs/{_name(run)}")
    source = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    return Manifest(**json.loads(text))


def facts(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A row for each committed run: what it says of itself."""
    fs, path = _hadoop(spark, f"{folder}/runs")
    kind = T.StructType([T.StructField("facts", T._parse_datatype_string(schema))])
    if not fs.exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(kind).json(f"{folder}/runs").select("facts.*")


def read(spark: SparkSession, folder: str, table: str, known: Manifest | None) -> DataFrame | None:
    """The rows of a table as of a run, with its partition columns; None if it has none."""
    names = [] if known is None else [name for _, name in known.folders.get(table, [])]
    if not names:
        return None
    schema = T.StructType.fromJson(json.loads(known.schemas[table]))
    parts = [spark.read.schema(schema).parquet(f"{folder}/{table}/{name}") for name in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class Run:
    """One attempt at the run after ``before``."""

    def __init__(self, spark: SparkSession, folder: str, before: Manifest | None, fan: int = FAN):
        self.spark, self.folder, self.fan = spark, folder, fan
        self.number = 1 if before is None else before.run + 1
        self.attempt = f"{self.number:09d}-{uuid.uuid4().hex[:12]}"
        self.folders = {} if before is None else {t: [list(x) for x in parts] for t, parts in before.folders.items()}
        self.schemas = {} if before is None else dict(before.schemas)
        self.written: list[str] = []

    def write(self, table: str, rows: DataFrame, by: tuple[str, ...] = (), replace: bool = False) -> None:
        """Add a folder of rows to a table; ``replace``: it becomes the whole table. Columns of earlier runs stay known."""
        name = self._store(table, rows, by)
        fields = {} if replace or table not in self.schemas else {f.name: f for f in T.StructType.fromJson(json.loads(self.schemas[table]))}
        fields |= {f.name: T.StructField(f.name, f.dataType) for f in rows.schema}
        self.schemas[table] = T.StructType(list(fields.values())).json()
        self.folders[table] = [*([] if replace else self.folders.get(table, [])), [0, name]]
        self._merge(table, by)

    def _store(self, table: str, rows: DataFrame, by: tuple[str, ...]) -> str:
        name = f"{self.attempt}-{len(self.written):03d}"
        path = f"{self.folder}/{table}/{name}"
        self.written.append(path)
        rows.write.partitionBy(*by).parquet(path)
        return name

    def _merge(self, table: str, by: tuple[str, ...]) -> None:
        level = 0
        while True:
            own = [name for at, name in self.folders[table] if at == level]
            if len(own) < self.fan:
                return
            whole = read(self.spark, self.folder, table, Manifest(0, {}, {table: [[level, n] for n in own]}, self.schemas))
            name = self._store(table, whole.repartition(*by) if by else whole, by)
            rest = [part for part in self.folders[table] if part[0] != level]
            self.folders[table] = [*rest, [level + 1, name]]
            level += 1

    def commit(self, said: dict) -> Manifest:
        done = Manifest(self.number, said, self.folders, self.schemas)
        fs, path = _hadoop(self.spark, f"{self.folder}/runs/{_name(self.number)}")
        _, part = _hadoop(self.spark, f"{self.folder}/runs/_{self.attempt}")
        target = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), self.spark._jsc.hadoopConfiguration())
        out = fs.create(part, True)
        out.write(bytearray(json.dumps(done.__dict__, default=str).encode()))
        out.close()
        try:  # a rename that doesn't overwrite: the file appears whole and once
            target.rename(part, path, self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as failed:
            fs.delete(part, False)
            if not fs.exists(path):
                raise
            self.abandon()
            raise Conflict(f"run {self.number} was committed by another load") from failed
        return done

    def abandon(self) -> None:
        """Delete what this attempt has written."""
        for path in self.written:
            fs, hadoop_path = _hadoop(self.spark, path)
            fs.delete(hadoop_path, True)
