"""The import history: commits that appear whole or not at all, and can be read as of any of them.

Data files are written first, under a name of their own that no reader looks at. A
commit is one small file that lists them; it gets the next number by a rename that
fails if that number is taken. So a reader sees all tables of an import or none, a
writer that dies leaves nothing behind but files that no commit lists, and of two
writers at once the later one tries again with the next number. Nothing that a commit
lists is ever changed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import UTC, datetime
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazardlens.operators.joins import at_once
from hazardlens.operators.quality import ImportFailure

_ENTRY = """version long, committed_at string, table string, import_id string, n_rows long, digest string,
schema string, files array<string>"""
# columns that tell when and as what rows came, not what they hold
_STAMPS = ("import_id", "imported_at")
# a commit that meets this many others in a row has a cause worth looking into
ATTEMPTS = 100


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


class History:
    """The tables below one folder, all under one sequence of commits numbered from 0."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._log, self._data = f"{self.folder}/_log", f"{self.folder}/data"

    def version(self) -> int | None:
        """The number of the last commit, or None before the first."""
        files = _files(self.spark, self.folder)
        if not files.exists(_path(self.spark, self._log)):
            return None
        names = [s.getPath().getName() for s in files.listStatus(_path(self.spark, self._log))]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()), default=None)

    def entries(self, version: int | None = None) -> DataFrame:
        """What each commit up to ``version`` added: table, import, rows, digest, schema and files."""
        last = self.version()
        if last is None:
            return self.spark.createDataFrame([], _ENTRY)
        if version is not None and not 0 <= version <= last:
            raise ValueError(f"{self.folder} has the commits 0 to {last}, not {version}")
        return self.spark.read.schema(_ENTRY).json(self._log).where(F.col("version") <= (last if version is None else version))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """All rows of a table as of a commit, the last one if none is named.

        Columns are those of the latest import read; older rows are null where they had none.
        """
        # a commit per import: names of files, as any reader lists them
        found = self.entries(version).where(F.col("table") == table).orderBy("version").collect()
        if not found:
            raise ValueError(f"{self.folder} has no table {table} in this commit")
        schema = StructType.fromJson(json.loads(found[-1]["schema"]))
        paths = [f"{self._data}/{table}/{name}" for entry in found for name in entry["files"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self._data}/{table}").parquet(*paths)
        return rows.select(*schema.names)

    def begin(self) -> Pending:
        return Pending(self)

    def append(self, import_id: str, **tables: DataFrame) -> int | None:
        """Adds the tables of one import in one commit; gives its number, or None if all was there."""
        pending = self.begin()
        try:
            pending.write_all(tables, import_id)
            return pending.publish()
        except BaseException:
            pending.abandon()
            raise


class Pending:
    """A commit in the making: tables are written one by one and appear together."""

    def __init__(self, history: History):
        self.history, self._name = history, uuid.uuid4().hex
        self._entries: list[dict] = []
        self._tables: list[str] = []

    def _place(self, table: str) -> str:
        return f"{self.history._data}/{table}/commit={self._name}"

    def write(
        self,
        table: str,
        rows: DataFrame,
        import_id: str,
        measures: dict[str, Column] | None = None,
        hidden: Sequence[str] = (),
    ) -> tuple[DataFrame, dict]:
        """Writes a table of one import, and gives its rows as written and the measures taken on the way.

        ``measures`` are aggregates over the rows; they, the number of rows and the digest
        of their content come from the one pass that writes. ``hidden`` columns can be
        read here, before the commit, and are not part of the table.
        """
        spark = self.history.spark
        stamped = rows.withColumn("import_id", F.lit(import_id))
        public = stamped.drop(*hidden)
        names = sorted(c for c in public.columns if c not in _STAMPS)
        digest = F.sum(F.xxhash64(F.to_json(F.struct(*names))).cast("decimal(38,0)"))
        seen = Observation(f"{table}-{self._name}")
        taken = {"_rows": F.count(F.lit(1)), "_digest": digest, **(measures or {})}
        observed = stamped.observe(seen, *(c.alias(n) for n, c in taken.items()))
        place = self._place(table)
        self._tables.append(table)
        observed.write.partitionBy("import_id").parquet(place)
        found = dict(seen.get)
        prefix = f"commit={self._name}/"
        self._entries.append(
            {
                "table": table,
                "import_id": import_id,
                "n_rows": found.pop("_rows"),
                "digest": str(found.pop("_digest") or 0),
                "schema": public.schema.json(),
                "files": [prefix + f for f in self._written(place)],
            }
        )
        back = spark.read.schema(stamped.schema).option("basePath", place).parquet(place)
        return back.select(*stamped.columns), found

    def write_all(self, tables: Mapping[str, DataFrame], import_id: str) -> None:
        """Writes several tables of one import at the same time; the commit lists them in the order given."""
        jobs = [partial(self.write, name, rows, import_id) for name, rows in tables.items()]
        at_once(self.history.spark, jobs)
        order = list(tables)
        self._entries.sort(key=lambda e: order.index(e["table"]) if e["table"] in tables else -1)

    def _written(self, place: str) -> list[str]:
        files = _files(self.history.spark, place)
        root = files.makeQualified(_path(self.history.spark, place)).toString()
        listed, names = files.listFiles(_path(self.history.spark, place), True), []
        while listed.hasNext():
            name = listed.next().getPath().toString().removeprefix(root).lstrip("/")
            if name.endswith(".parquet") and not name.split("/")[-1].startswith(("_", ".")):
                names.append(name)
        return sorted(names)

    def _fresh(self) -> list[dict]:
        """The entries whose import is not in the history yet; raises if it is there with other rows."""
        mine = {(e["table"], e["import_id"]): e for e in self._entries}
        ids = sorted({e["import_id"] for e in self._entries})
        there = self.history.entries().where(F.col("import_id").isin(ids)).select("table", "import_id", "n_rows", "digest").collect()
        for entry in there:
            new = mine.get((entry["table"], entry["import_id"]))
            if new is None:
                continue
            if (new["n_rows"], new["digest"]) != (entry["n_rows"], entry["digest"]):
                raise ImportFailure(f"import {entry['import_id']} is in {self.history.folder} with other rows of {entry['table']}")
            del mine[entry["table"], entry["import_id"]]
        return list(mine.values())

    def publish(self) -> int | None:
        """Makes the tables visible; gives the commit's number.

        What an earlier commit holds with the same rows is left out, so a repeated import
        adds nothing, and gives None; the same import with other rows is refused.
        """
        history = self.history
        for _ in range(ATTEMPTS):
            # the number is read before the imports: a commit in between takes it, and all is looked at again
            last = history.version()
            entries = self._fresh()
            if not entries:
                self.abandon()
                return None
            number = 0 if last is None else last + 1
            if self._renamed(number, entries):
                kept = {e["table"] for e in entries}
                self._tables = [t for t in self._tables if t not in kept]
                self.abandon()
                return number
        raise ImportFailure(f"{ATTEMPTS} commits in a row were overtaken in {history.folder}")

    def _renamed(self, number: int, entries: Sequence[dict]) -> bool:
        spark, history = self.history.spark, self.history
        stamp = {"version": number, "committed_at": datetime.now(UTC).isoformat(timespec="milliseconds")}
        text = "".join(json.dumps({**stamp, **entry}) + "\n" for entry in entries)
        files = _files(spark, history.folder)
        draft = _path(spark, f"{history._log}/.{self._name}.{number}")
        out = files.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        keep = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        none = spark._jvm.java.lang.reflect.Array.newInstance(keep, 0)
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(_path(spark, f"{history._log}/{number:020d}.json")), none)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def _remove(self, tables: Iterable[str]) -> None:
        for table in tables:
            _files(self.history.spark, self.history.folder).delete(_path(self.history.spark, self._place(table)), True)

    def abandon(self) -> None:
        """Removes what was written for this commit; after ``publish`` there is nothing to remove."""
        self._remove(self._tables)
        self._entries, self._tables = [], []
