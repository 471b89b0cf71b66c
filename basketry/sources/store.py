"""Published layers: versions made of parts, switched together; tables, models."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import TASK_ROWS, task_count
from basketry.sources.files import SmallFiles

#: A layer whose stored statistics put it below this is broadcast to its joins.
BROADCAST_BYTES = 64 << 20


class CommitConflict(RuntimeError):
    """A layer that a draft was made from has a newer version."""


@dataclass(frozen=True)
class Part:
    """One folder of files: all of a generation, or one partition folder of it.
    ``columns`` has nulls, smallest and largest value of each (numbers only)."""

    gen: str
    folder: str | None
    rows: int
    columns: dict[str, list]


@dataclass(frozen=True)
class Version:
    """What a layer is made of."""

    layer: str
    number: int
    parts: tuple[Part, ...]
    schema: str
    buckets: tuple[int, tuple[str, ...]] | None = None
    built_from: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)

    @property
    def kind(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    @property
    def gens(self) -> list[str]:
        return list(dict.fromkeys(p.gen for p in self.parts))

    def row_bytes(self) -> int:
        """Bytes of a row in memory, about; a text counts as 32."""
        sizes = {"string": 32, "tinyint": 8, "smallint": 8, "int": 8, "bigint": 8, "double": 8, "float": 8, "boolean": 8, "date": 8}
        return 16 + sum(sizes.get(f.dataType.simpleString(), 24) for f in self.kind)

    def statistics(self) -> list[tuple]:
        """``(column, nulls, low, high)`` over all parts."""
        out = []
        for f in self.kind:
            known = [p.columns[f.name] for p in self.parts if f.name in p.columns]
            low, high = ([k[i] for k in known if k[i] is not None] for i in (1, 2))
            out.append((f.name, sum(k[0] for k in known), min(low, default=None), max(high, default=None)))
        return out

    def line(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(line: str) -> Version:
        d = json.loads(line)
        buckets = d["buckets"] and (d["buckets"][0], tuple(d["buckets"][1]))
        return Version(d["layer"], d["number"], tuple(Part(**p) for p in d["parts"]), d["schema"], buckets, d["built_from"])


@dataclass(frozen=True)
class Snapshot:
    """One consistent set of versions: what a commit left current."""

    store: FeatureStore
    commit: int
    layers: dict[str, Version]

    def version(self, layer: str) -> Version:
        if layer not in self.layers:
            raise LookupError(f"no published version of {layer}")
        return self.layers[layer]

    def number(self, layer: str) -> int:
        return self.layers[layer].number if layer in self.layers else 0

    def read(self, layer: str) -> DataFrame:
        return self.store.read_parts(self.version(layer))

    def read_folders(self, layer: str, folders: Iterable[str]) -> DataFrame:
        """Only the given partition folders: no other file is listed or opened."""
        version, chosen = self.version(layer), set(folders)
        return self.store.read_parts(replace(version, parts=tuple(p for p in version.parts if p.folder in chosen)))

    def read_small(self, layer: str, limit: int = BROADCAST_BYTES) -> DataFrame:
        """The layer, marked for broadcast if its stored row count allows it.  A
        plan knows that before it runs, where file sizes of encoded columns would
        tell too little."""
        version = self.version(layer)
        df = self.read(layer)
        return F.broadcast(df) if version.rows * version.row_bytes() <= limit else df

    def statistics(self, *layers: str) -> DataFrame:
        """``(layer, column_name, row_count, null_count, low, high)``, as stored."""
        rows = [
            (layer, name, self.version(layer).rows, nulls, low, high)
            for layer in layers or sorted(self.layers)
            for name, nulls, low, high in self.version(layer).statistics()
        ]
        kind = "layer string, column_name string, row_count long, null_count long, low double, high double"
        return self.store.spark.createDataFrame(rows, kind)


@dataclass(frozen=True)
class Draft:
    """A version that is written but not yet current."""

    version: Version
    store: FeatureStore

    @property
    def layer(self) -> str:
        return self.version.layer

    def read(self) -> DataFrame:
        return self.store.read_parts(self.version)


class FeatureStore:
    """Layers under one root folder.

    A commit is one small file that names the current version of every layer.  It
    is numbered and written once, so two writers cannot take one number, and
    several layers are switched together: readers hold a snapshot, the set of
    versions of one commit, and keep its files.  A writer that dies half-way is
    never seen.

    Files of a layer lie in ``<layer>/gen=<id>/[<column>=<value>/]``.  A version
    is a list of such parts, so a new version may share most of them with the one
    before.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._commits = SmallFiles(spark, f"{self.root}/_commits")

    # -- reading -----------------------------------------------------------------

    def _numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self._commits.names())

    def snapshot(self, commit: int | None = None) -> Snapshot:
        """The current set of versions, or that of an earlier commit."""
        numbers = self._numbers()
        if commit is None:
            commit = numbers[-1] if numbers else 0
        if commit == 0:
            return Snapshot(self, 0, {})
        lines = self._commits.read(f"{commit:08d}.json").splitlines()
        return Snapshot(self, commit, {v.layer: v for v in map(Version.of, lines)})

    def versions(self, layer: str) -> list[Version]:
        """All published versions of a layer, oldest first."""
        found = {}
        for n in self._numbers():
            version = self.snapshot(n).layers.get(layer)
            if version:
                found[version.number] = version
        return [found[n] for n in sorted(found)]

    def current_version(self, layer: str) -> int:
        return self.snapshot().number(layer)

    def read(self, layer: str, version: int | None = None) -> DataFrame:
        return self.snapshot().read(layer) if version is None else self.read_parts(self.version(layer, version))

    def version(self, layer: str, number: int) -> Version:
        for known in self.versions(layer):
            if known.number == number:
                return known
        raise LookupError(f"no published version {number} of {layer}")

    def read_parts(self, version: Version) -> DataFrame:
        """The rows of a version, in the columns of its schema."""
        kind, base = version.kind, f"{self.root}/{version.layer}"
        names = [f.name for f in kind]
        if not version.parts:
            return self.spark.createDataFrame([], kind)
        if version.buckets and len(version.gens) == 1:
            return self.spark.table(self._bucketed_table(version)).select(*names)
        reader = self.spark.read.schema(kind)
        if any(p.folder for p in version.parts):
            reader = reader.option("basePath", base)
        paths = [f"{base}/gen={p.gen}" + (f"/{p.folder}" if p.folder else "") for p in version.parts]
        return reader.parquet(*paths).select(*names)

    def _bucketed_table(self, version: Version) -> str:
        """A name in this session's catalog for a bucketed version: the catalog is
        what tells a plan that the files are laid out by key."""
        name = f"basketry_{version.layer}_{version.gens[0]}"
        if not self.spark.catalog.tableExists(name):
            count, by = version.buckets
            keys = ", ".join(by)
            place = f"{self.root}/{version.layer}/gen={version.gens[0]}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.kind)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {count} BUCKETS LOCATION '{place}'"
            )
        return name

    # -- writing -----------------------------------------------------------------

    def write_version(
        self,
        layer: str,
        df: DataFrame,
        cluster_by: list[str] | None = None,
        partition_by: list[str] | None = None,
        bucket_by: list[str] | None = None,
        buckets: int = 200,
        find_by: list[str] | None = None,
        built_from: dict[str, int] | None = None,
        keep: Iterable[Part] = (),
        rows: int = 0,
    ) -> Draft:
        """Write the files of a next version; readers do not see it yet.

        ``cluster_by`` range-partitions and sorts the files by these columns, so
        a filter on them skips row groups; ranges follow the data, so a hot key
        only makes its own files larger.  ``find_by`` adds Bloom filters of these
        columns to the files.  ``partition_by`` names one column, whose values are folders.
        ``bucket_by`` stores the rows as a join on these columns needs them.
        ``keep`` are parts of earlier versions that belong to this one unchanged.
        ``rows``, about how many there are, bounds what a task sorts for ``cluster_by``.
        """
        gen = uuid.uuid4().hex[:12]
        path = f"{self.root}/{layer}/gen={gen}"
        laid_out = df
        if cluster_by:
            ranges = [task_count(self.spark, rows)] if rows > TASK_ROWS else []
            laid_out = df.repartitionByRange(*ranges, *cluster_by).sortWithinPartitions(*cluster_by)
        if bucket_by:
            laid_out = df.repartition(buckets, *bucket_by)
        writer = laid_out.write
        for column in find_by or []:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            table = f"basketry_{layer}_{gen}"
            writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by).option("path", path).saveAsTable(table)
            self.spark.sql(f"DROP TABLE {table}")  # its files stay; a reader names them again
        else:
            writer.parquet(path)
        kind = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema])
        made = Version(
            layer, 0, (), kind.json(), (buckets, tuple(bucket_by)) if bucket_by else None, dict(built_from or {})
        )
        whole = replace(made, parts=(Part(gen, None, 0, {}),))
        parts = _measured(self.read_parts(whole), gen, partition_by[0] if partition_by else None)
        return Draft(replace(made, parts=(*keep, *parts)), self)

    def commit(self, *drafts: Draft, base: Snapshot | None = None, reads: Iterable[str] = ()) -> Snapshot:
        """Make written versions current, all in one step.

        With ``base``, the snapshot they were made from, a newer version of a written
        layer or of one in ``reads`` is a conflict, and nothing is switched.
        """
        watched = {d.layer for d in drafts} | set(reads)
        while True:
            now = self.snapshot()
            moved = sorted(x for x in watched if base is not None and now.number(x) != base.number(x))
            if moved:
                raise CommitConflict(f"changed since commit {base.commit}: {', '.join(moved)}")
            new = {d.layer: replace(d.version, number=now.number(d.layer) + 1) for d in drafts}
            layers = {**now.layers, **new}
            text = "".join(f"{layers[x].line()}\n" for x in sorted(layers))
            if self._commits.write_once(f"{now.commit + 1:08d}.json", text):
                return Snapshot(self, now.commit + 1, layers)

    def publish(self, layer: str, df: DataFrame, **layout) -> DataFrame:
        """Write ``df`` as the next version, switch to it and read it back."""
        return self.commit(self.write_version(layer, df, **layout)).read(layer)

    def refresh(self, layer: str, build: Callable[[], DataFrame], **layout) -> DataFrame:
        """Rebuild a layer and switch to it."""
        return self.publish(layer, build(), **layout)


def _measured(df: DataFrame, gen: str, column: str | None) -> list[Part]:
    """The parts of a written generation with their statistics, one scan."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    sums = [F.count("*").alias("rows")]
    for i, name in enumerate(df.columns):
        value = F.col(name).cast("double") if name in numeric else F.lit(None).cast("double")
        sums += [F.count_if(F.col(name).isNull()).alias(f"n{i}"), F.min(value).alias(f"a{i}"), F.max(value).alias(f"b{i}")]
    grouped = df.groupBy(F.col(column).cast("string").alias("_value")) if column else df.groupBy()
    parts = []
    for r in grouped.agg(*sums).collect():  # one row per folder
        stats = {name: [r[f"n{i}"], r[f"a{i}"], r[f"b{i}"]] for i, name in enumerate(df.columns)}
        parts.append(Part(gen, f"{column}={r['_value']}" if column else None, r.rows, stats))
    return parts


def save_table(
    df: DataFrame,
    table: str,
    path: str,
    bucket_by: list[str] | None = None,
    buckets: int = 200,
    sort_by: list[str] | None = None,
) -> DataFrame:
    """Save as a catalog table, replacing an older one.  Bucketing on the join
    key stores the shuffle: later joins of tables with the same buckets read
    matching files and move no rows."""
    laid_out = df.repartition(buckets, *bucket_by) if bucket_by else df
    writer = laid_out.write.mode("overwrite").option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def analyze_table(spark: SparkSession, table: str) -> None:
    """Collect row counts and column statistics for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_catalogue(df: DataFrame) -> DataFrame:
    """Columns of a relation in order, with type and number of nulls: one scan,
    turned from one wide row into one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = [
        F.struct(
            F.lit(place).alias("ordinal_position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col(field.name).alias("null_count"),
        )
        for place, field in enumerate(df.schema.fields, start=1)
    ]
    return counts.select(F.inline(F.array(*entries)))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
