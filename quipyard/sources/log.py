"""Insert-only log with many writers: blind appends, atomic commits, merging on read.

    LOG/commits/000000000007.json   what the log holds as of commit 7
    LOG/data/NAME/part-*.json       the rows of one append, or of several merged ones

An append writes its rows into a folder of its own and then publishes a commit that lists all folders in
order. A commit number can be taken once: who comes second reads the new state and tries the next number.
So a writer that dies leaves nothing visible, and any number of them may work at once.

Nothing is read on appending: of rows with the same key, the one in the earliest folder counts, which
readers find by one aggregate. Merging adjacent folders drops the others for good; it happens after
every FAN appends, FAN merged ones are merged again, and so on, so that a log of n appends has fewer
than FAN * log(n) folders and a row is rewritten log(n) times. Files no longer listed are removed KEEP commits
later, for readers that still use them.

Commits need a file system with atomic renames or, on a local one, hard links.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipyard.session import store

#: Folders that are merged at once; commits that are kept; sources whose last batch is remembered.
FAN = 8
KEEP = 100
SOURCES = 1000
ATTEMPTS = 1000
#: Repeated keys in one append up to which they are broadcast; beyond, all rows are shuffled.
REPEATED = 100_000


@dataclass
class State:
    """A commit: folders in order, each (name, level), the last batch of each source, and what was dropped."""

    version: int = 0
    folders: list[list] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)
    dropped: list[list] = field(default_factory=list)


class _Files:
    """The few calls to the file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(self.root).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        with_utf8 = self.jvm.java.nio.charset.StandardCharsets.UTF_8
        stream = self.fs.open(self._path(f"{self.root}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, with_utf8)
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.root}/{name}"), True)

    def publish(self, name: str, text: str) -> bool:
        """Whole file under a name that nobody has taken; False if somebody has."""
        target = self._path(f"{self.root}/{name}")
        draft = self._path(f"{self.root}/drafts/{uuid.uuid4().hex}")
        stream = self.fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.mkdirs(target.getParent())
        try:
            real = [self.fs.resolvePath(p).suffix(s) for p, s in ((draft, ""), (target.getParent(), f"/{target.getName()}"))]
            if real[0].toUri().getScheme() == "file":
                source, goal = (self.jvm.java.nio.file.Paths.get(p.toUri().getPath(), self._array("java.lang.String")) for p in real)
                self.jvm.java.nio.file.Files.createLink(goal, source)
            else:
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
                context.rename(draft, target, self._array("org.apache.hadoop.fs.Options$Rename"))
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.fs.delete(draft, False)

    def _array(self, name: str):
        return self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName(name), 0)


def _file(version: int) -> str:
    return f"commits/{version:012d}.json"


def state_of(spark: SparkSession, path: str) -> State:
    """The last commit."""
    files = _Files(spark, path)
    names = [n for n in files.names("commits") if n.endswith(".json") and not n.startswith(".")]
    return State(**json.loads(files.read(f"commits/{names[-1]}"))) if names else State()


def _commit(spark: SparkSession, path: str, change) -> State | None:
    """Publish what `change` makes of the last state; None if it makes nothing of it."""
    files = _Files(spark, path)
    for _ in range(ATTEMPTS):
        state = state_of(spark, path)
        after = change(State(state.version + 1, [*state.folders], {**state.batches}, [*state.dropped]))
        if after is None:
            return None
        gone = [d for d in after.dropped if d[1] <= after.version - KEEP]
        after.dropped = [d for d in after.dropped if d[1] > after.version - KEEP]
        if files.publish(_file(after.version), json.dumps(after.__dict__)):
            for name, _ in gone:
                files.remove(f"data/{name}")
            if after.version > KEEP:
                files.remove(_file(after.version - KEEP))
            return after
    raise RuntimeError(f"no free commit number at {path} in {ATTEMPTS} attempts")


def _write(rows: DataFrame, path: str) -> str:
    name = uuid.uuid4().hex
    rows.write.option("ignoreNullFields", "false").json(f"{path.rstrip('/')}/data/{name}")
    return name


def _least(rows: DataFrame, schema: T.StructType, key: str, *order: str) -> DataFrame:
    """One row per key: the least by the columns `order`, then by all others."""
    rest = [c for c in schema.names if c != key]
    least = F.min(F.struct(*order, *rest)).alias("row")
    return rows.groupBy(key).agg(least).select(*[F.col(c) if c == key else F.col("row")[c].alias(c) for c in schema.names])


def _once(rows: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """As `_least`, of a table that may be read twice: keys are counted, and only rows with a repeated one move."""
    repeated = store(rows.groupBy(key).count().where("count > 1").select(key), "repeated-keys")
    found = repeated.count()
    if found > REPEATED:
        return _least(rows, schema, key)
    if not found:
        return rows.select(*schema.names)
    repeated = F.broadcast(repeated)
    alone = rows.join(repeated, key, "left_anti").select(*schema.names)
    return alone.union(_least(rows.join(repeated, key, "left_semi"), schema, key))


def _read(spark: SparkSession, path: str, schema: T.StructType, key: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).json([f"{path.rstrip('/')}/data/{n}" for n in names], mode="FAILFAST")
    if len(names) == 1:
        return rows  # has each key once
    place = F.create_map(*[F.lit(x) for pair in zip(names, range(len(names))) for x in pair])
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return _least(rows.withColumn("_place", F.try_element_at(place, folder)), schema, key, "_place")


def read(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """One row per key as of the last commit; no rows where there is no log."""
    return _read(spark, path, schema, key, [name for name, _ in state_of(spark, path).folders])


def append(
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    key: str,
    source: str | None = None,
    batch: int | None = None,
    stored: bool = False,
) -> None:
    """Add rows; those whose key the log holds already, in any commit before this one, never count.

    Of several new rows with one key the smallest (by all columns) is kept. A `source` numbers its
    batches: one that is in the log already is not written again. `stored` rows, of which every reading
    gives the same, are shuffled only where their key is repeated.
    """
    spark = rows.sparkSession

    def known(state: State) -> bool:
        return source is not None and state.batches.get(source, -1) >= batch

    if known(state_of(spark, path)):
        return
    name = _write((_once if stored else _least)(rows, schema, key), path)

    def add(state: State) -> State | None:
        if known(state):
            return None
        state.folders.append([name, 0])
        if source is not None:
            state.batches.pop(source, None)
            state.batches[source] = batch
            state.batches = dict(list(state.batches.items())[-SOURCES:])
        return state

    if _commit(spark, path, add) is None:
        _Files(spark, path).remove(f"data/{name}")
    else:
        compact(spark, path, schema, key)


def _mergeable(folders: list[list]) -> tuple[int, int] | None:
    """Begin and end of the last FAN adjacent folders of one level."""
    end = len(folders)
    while end:
        begin = end
        while begin and folders[begin - 1][1] == folders[end - 1][1]:
            begin -= 1
        if end - begin >= FAN:
            return begin, begin + FAN
        end = begin
    return None


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str) -> None:
    """Merge folders while FAN adjacent ones have the same level; leaves it to another writer who is first."""
    while place := _mergeable(folders := state_of(spark, path).folders):
        old = folders[place[0] : place[1]]
        name = _write(_read(spark, path, schema, key, [n for n, _ in old]), path)

        def swap(state: State) -> State | None:
            begin = next((i for i, f in enumerate(state.folders) if f == old[0]), None)
            if begin is None or state.folders[begin : begin + len(old)] != old:
                return None
            state.folders[begin : begin + len(old)] = [[name, old[0][1] + 1]]
            state.dropped += [[n, state.version] for n, _ in old]
            return state

        if _commit(spark, path, swap) is None:
            _Files(spark, path).remove(f"data/{name}")
            return
