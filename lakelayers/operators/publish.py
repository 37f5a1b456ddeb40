"""Tables on plain Parquet, published version by version.

Layout of one table under the target root::

    <root>/<schema>/<table>/_write=<id>/_part=<p>/*.parquet   rows, never changed
    <root>/<schema>/<table>/_versions/<n>.json                what is current

Every write makes a new ``_write`` folder. A version says which one is current
for each part, so a merge rewrites only the parts it touches and a reader of
the version before is not disturbed. A job that dies leaves folders that no
version names, and those are never read. Publishing a version also points the
catalog view ``schema.table`` at it. What was replaced long enough ago goes once per run.

One writer per table, any number of readers.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.session import hadoop_path, read_text, write_text

ROWS_PER_FILE = 20_000_000
WHOLE = "all"
NO_DATE = "none"
MARK, NO_MARK = "_mark", -(1 << 63)
UNIT_FORMATS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}
# How long a replaced version, and what no version names, stays readable.
RETENTION = timedelta(days=7)

# What makes a row fail, by the name of the test; the same at any time.
Tests = dict[str, Column]


@dataclass(frozen=True)
class Layout:
    """Rows are split into parts by ``unit`` of the date ``column`` and by a hash of ``keys``.

    A choice of the model: a part is what a merge rewrites, and within it files
    are sorted by date. With ``buckets``, the number of parts of each unit, a
    merge by those keys also reads no other buckets than its own. Choose as
    many as keep a bucket of a unit small; a replaced table may have others.

    ``mark`` names a time column whose maximum is asked for again and again. It
    is stored as a number beside the row, so the maximum is in the statistics
    of the files, which for times it is not.
    """

    column: str | None = None
    unit: str = "month"
    keys: tuple[str, ...] = ()
    buckets: int = 1
    mark: str | None = None

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def part(self) -> Column:
        if self.column is None:
            unit = F.lit(WHOLE)
        else:
            unit = F.coalesce(F.date_format(F.col(self.column), UNIT_FORMATS[self.unit]), F.lit(NO_DATE))
        return unit if self.buckets == 1 else F.concat(unit, F.lit("."), self.bucket().cast("string"))

    def between(self, parts: Iterable[str], first: date, last: date) -> list[str]:
        """Those of the parts that can hold a day from ``first`` to ``last``."""
        if self.column is None:
            return list(parts)
        width = len(UNIT_FORMATS[self.unit])
        low, high = first.isoformat()[:width], last.isoformat()[:width]
        return [p for p in parts if unit_of(p) != NO_DATE and low <= unit_of(p) <= high]

    def holding(self, parts: Iterable[str], buckets: Iterable[int]) -> list[str]:
        """Those of the parts that are one of the buckets of some unit."""
        ends = {str(b) for b in buckets}
        return [p for p in parts if p.partition(".")[2] in ends]


def unit_of(part: str) -> str:
    """The date unit of a part, whatever its bucket."""
    return part.partition(".")[0]


@dataclass
class Version:
    number: int
    schema: T.StructType
    layout: Layout
    parts: dict[str, str]
    """The write that holds each part."""
    tags: dict[str, int] = field(default_factory=dict)
    """Last batch taken in, by stream."""
    inputs: dict[str, dict[str, str]] = field(default_factory=dict)
    """The parts of other tables that this version was computed from."""
    failing: dict[str, list[str]] = field(default_factory=dict)
    """The parts with rows that fail a test which was counted while they were written, by test."""
    reading: str | None = None
    """SQL over ``{rows}``, the stored rows, that gives the table's; None if they are the table's."""

    def to_json(self) -> str:
        return json.dumps({
            "number": self.number,
            "schema": self.schema.jsonValue(),
            "layout": asdict(self.layout),
            "parts": self.parts,
            "tags": self.tags,
            "inputs": self.inputs,
            "failing": self.failing,
            "reading": self.reading,
        })

    @staticmethod
    def from_json(text: str) -> Version:
        d = json.loads(text)
        return Version(
            d["number"], T.StructType.fromJson(d["schema"]),
            Layout(**{**d["layout"], "keys": tuple(d["layout"]["keys"])}), d["parts"], d["tags"], d["inputs"],
            d["failing"], d["reading"],
        )

    def of_units(self, units: Iterable[str]) -> list[str]:
        wanted = set(units)
        return [p for p in self.parts if unit_of(p) in wanted]

    def after(self, parts: dict[str, str], rewritten: Iterable[str], failing: dict[str, list[str]], **other) -> Version:
        """The next version: ``parts`` are current, and of them ``rewritten`` were tested anew."""
        anew = set(rewritten)
        now = {
            test: sorted({p for p in was if p in parts and p not in anew} | set(failing[test]))
            for test, was in self.failing.items() if test in failing
        }
        return replace(self, number=self.number + 1, parts=parts, failing=now, **other)

    def stale_parts(self, sources: dict[str, Version]) -> set[str]:
        """Parts in which a source differs from what this version was made of."""
        stale = set()
        for name, now in sources.items():
            was = self.inputs.get(name, {})
            stale |= {p for p in {*was, *now.parts} if was.get(p) != now.parts.get(p)}
        return stale


@dataclass(frozen=True)
class Shown:
    """The version a catalog view shows, and the external table it reads."""

    version: int
    table: str


class TableStore:
    """Published tables below one root."""

    def __init__(self, spark: SparkSession, root: str, catalog: bool = True):
        """With ``catalog``, every commit flips the table's view as well."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog = catalog

    # --- reading -------------------------------------------------------------

    def path(self, name: str) -> str:
        schema, table = name.split(".")
        return f"{self.root}/{schema}/{table}"

    def _names(self, pattern: str) -> list[str]:
        fs, jpath = hadoop_path(self.spark, pattern)
        return [s.getPath().toString() for s in fs.globStatus(jpath) or []]

    def versions(self, name: str) -> list[int]:
        """Numbers of the published versions, oldest first."""
        files = self._names(f"{self.path(name)}/_versions/*.json")
        return sorted(int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in files)

    def version(self, name: str, number: int | None = None) -> Version | None:
        """One version, the newest by default; None if there is none."""
        if number is None:
            numbers = self.versions(name)
            if not numbers:
                return None
            number = numbers[-1]
        return Version.from_json(read_text(self.spark, f"{self.path(name)}/_versions/{number}.json"))

    def names(self) -> list[str]:
        """All published tables, as ``schema.table``."""
        found = self._names(f"{self.root}/*/*/_versions")
        return sorted(".".join(p.split("/")[-3:-1]) for p in found)

    def read(
        self,
        name: str,
        number: int | None = None,
        parts: list[str] | None = None,
        with_part: bool = False,
        dates: tuple[date, date] | None = None,
    ) -> DataFrame:
        """The rows of a version, or only those of some of its parts, or of the days from
        one to another, for which only the parts that can hold them are read."""
        v = self.version(name, number)
        if v is None:
            raise LookupError(f"no version of table {name} is published")
        if v.reading is not None:
            if parts is not None or with_part or dates is not None:
                raise ValueError(f"{name} is made from its stored rows, which cannot be read by part")
            return self.spark.sql(v.reading, rows=self.read_version(name, v))
        if dates is None:
            return self.read_version(name, v, parts, with_part)
        held = self.read_version(name, v, v.layout.between(v.parts, *dates), with_part)
        return held.filter(F.col(v.layout.column).between(*[F.lit(d) for d in dates]))

    def read_version(
        self, name: str, v: Version, parts: list[str] | None = None, with_part: bool = False
    ) -> DataFrame:
        base = self.path(name)
        wanted = v.parts if parts is None else {p: v.parts[p] for p in parts if p in v.parts}
        stored = T.StructType(
            [*v.schema.fields, T.StructField("_write", T.StringType()), T.StructField("_part", T.StringType())]
        )
        columns = v.schema.names + (["_part"] if with_part else [])
        if not wanted:
            return self.spark.createDataFrame([], stored).select(*columns)
        writes = _by_write(wanted)
        df = self.spark.read.schema(stored).option("basePath", base).parquet(*[f"{base}/_write={w}" for w in writes])
        current = [(F.col("_write") == w) & F.col("_part").isin(ps) for w, ps in writes.items()]
        return df.filter(reduce(lambda a, b: a | b, current)).select(*columns)

    def newest(self, name: str, v: Version) -> Column | None:
        """The maximum of the marked column of a version, as a literal; None if there is no value."""
        value = self.marks(name, v).agg(F.max(MARK)).first()[0] if v.parts else None
        return None if value in (None, NO_MARK) else F.timestamp_micros(F.lit(value))

    def marks(self, name: str, v: Version) -> DataFrame:
        """The marks of a version. Their maximum is taken from the files' footers: no row is read.

        The reader that can do so is asked for in a session of its own, with the
        same catalog and executors, so that other reads stay as they are.
        """
        aside = self.spark.newSession()
        v1 = aside.conf.get("spark.sql.sources.useV1SourceList").split(",")
        aside.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in v1 if x != "parquet"))
        aside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return aside.read.schema(f"{MARK} bigint").parquet(*[f"{self.path(name)}/_write={w}/_part={p}" for p, w in v.parts.items()]).select(MARK)

    # --- writing -------------------------------------------------------------

    def write_rows(
        self, name: str, df: DataFrame, layout: Layout, part: Column | None = None, tests: Tests | None = None
    ) -> tuple[dict[str, str], dict[str, list[str]]]:
        """Write rows to a new folder that no version names yet; gives the parts written, as
        a version names them, and for each of ``tests`` those with a row that fails it, seen
        as the rows go by.

        Rows of one part go to one task, so a part is few files; run-time
        splitting breaks up a part that is too big for one. Each file is sorted
        by date, so a date filter skips row groups by their statistics.
        """
        write_id = uuid.uuid4().hex[:16]
        rows = df.withColumn("_part", layout.part() if part is None else part)
        seen = Observation()
        if tests:
            # A set, so what is seen twice because a task was run again counts once.
            rows = rows.observe(seen, *[F.collect_set(F.when(fails, F.col("_part"))).alias(t) for t, fails in tests.items()])
        if layout.mark:
            # First in the file, because footers are asked by the place of a column in the schema that
            # is read, and never null, because a file of nulls has no maximum to tell.
            mark = F.coalesce(F.unix_micros(F.col(layout.mark).cast("timestamp")), F.lit(NO_MARK))
            rows = rows.select(mark.alias(MARK), "*")
        if layout.column is not None or layout.buckets > 1 or part is not None:
            rows = rows.hint("rebalance", F.col("_part"))
            rows = rows.sortWithinPartitions("_part", *([layout.column] if layout.column else []))
        rows.write.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("_part").parquet(f"{self.path(name)}/_write={write_id}")
        found = self._names(f"{self.path(name)}/_write={write_id}/_part=*")
        parts = dict.fromkeys(sorted(p.rsplit("_part=", 1)[1] for p in found), write_id)
        # Where there are no rows Spark may leave out to look at them.
        return parts, {t: sorted(seen.get[t]) if parts else [] for t in tests or ()}

    def commit(self, name: str, v: Version) -> Version:
        """Make ``v`` the current version, for readers of the store and of the catalog."""
        path = f"{self.path(name)}/_versions/{v.number}.json"
        if not write_text(self.spark, path, v.to_json()):
            raise RuntimeError(f"another writer published version {v.number} of {name}")
        if self.catalog:
            self.publish_view(name, v)
        return v

    def replace(
        self,
        name: str,
        df: DataFrame,
        layout: Layout | None = None,
        tags: dict[str, int] | None = None,
        sources: dict[str, Version] | None = None,
        tests: Tests | None = None,
    ) -> Version:
        """Publish ``df`` as the whole table. It may read the table's old version."""
        layout = layout or Layout()
        old = self.versions(name)
        parts, failing = self.write_rows(name, df, layout, tests=tests)
        number = old[-1] + 1 if old else 1
        return self.commit(name, Version(number, _nullable(df.schema), layout, parts, tags or {}, _inputs(sources), failing))

    def replace_parts(
        self, name: str, df: DataFrame, units: list[str], sources: dict[str, Version] | None = None
    ) -> Version:
        """Publish ``df`` in place of some date units; the others stay as they are.

        Every row of ``df`` must belong to one of ``units``.
        """
        old = self.version(name)
        new, failing = self.write_rows(name, df.select(*old.schema.names), old.layout)
        outside = {unit_of(p) for p in new} - set(units)
        if outside:
            raise ValueError(f"rows outside the replaced parts of {name}: {sorted(outside)[:5]}")
        now = {p: w for p, w in old.parts.items() if unit_of(p) not in units}
        return self.commit(name, old.after({**now, **new}, new, failing, inputs=_inputs(sources)))

    def expire(self, name: str, retention: timedelta = RETENTION) -> None:
        """Delete what was replaced longer ago than ``retention``: versions, but for the newest
        and the one the catalog view names, and as old folders of parts that no version left names."""
        before = time.time() * 1000 - retention / timedelta(milliseconds=1)
        base = self.path(name)
        published = sorted((int(p.rsplit("/", 1)[1].removesuffix(".json")), t) for p, t in self._ages(f"{base}/_versions/*.json"))
        shown = self._shown(name)
        for (n, _), (_, replaced) in zip(published, published[1:]):
            if replaced <= before and (shown is None or n != shown.version):
                self._delete(f"{base}/_versions/{n}.json")
        held = [self.version(name, n).parts.items() for n in self.versions(name)]
        used = {f"_write={w}{inside}" for parts in held for p, w in parts for inside in ("", f"/_part={p}")}
        found = [x for pattern in ("_write=*", "_write=*/_part=*") for x in self._ages(f"{base}/{pattern}")]
        gone = [f for f, changed in found if changed <= before and f[f.rindex("_write=") :] not in used]
        for folder in gone:
            self._delete(folder)
        if shown is not None:
            pairs = [tuple(x.partition("=")[2] for x in f.split("/")[-2:]) for f in gone if "/_part=" in f]
            self._partitions(shown.table, "DROP IF EXISTS", pairs, ", ")

    def expire_all(self, retention: timedelta = RETENTION) -> None:
        for name in self.names():
            self.expire(name, retention)

    def _ages(self, pattern: str) -> list[tuple[str, int]]:
        fs, jpath = hadoop_path(self.spark, pattern)
        return [(s.getPath().toString(), s.getModificationTime()) for s in fs.globStatus(jpath) or []]

    def _delete(self, path: str) -> None:
        fs, jpath = hadoop_path(self.spark, path)
        fs.delete(jpath, True)

    @contextmanager
    def staging(self) -> Iterator[Callable[[DataFrame], DataFrame]]:
        """Write intermediate results beside the tables; deleted afterwards."""
        base = f"{self.root}/_staging/{uuid.uuid4().hex}"

        def stage(df: DataFrame) -> DataFrame:
            path = f"{base}/{uuid.uuid4().hex}"
            df.write.parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        try:
            yield stage
        finally:
            self._delete(base)

    # --- views ---------------------------------------------------------------

    def _shown(self, name: str) -> Shown | None:
        """What the catalog view shows, if it is one of this store's."""
        if not self.spark.catalog.tableExists(name):
            return None
        told = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if told.get("lakelayers.root") != self.root:
            return None
        return Shown(int(told["lakelayers.version"]), told["lakelayers.table"])

    def publish_view(self, name: str, v: Version | None = None) -> None:
        """Point the catalog view ``schema.table`` at a version, the newest by default.

        Folders of parts are partitions of an external table. A commit adds
        those it wrote, which no reader sees yet, and then replaces the view, in
        one step, by one that names the current ones. What was replaced stays in
        the catalog until ``expire``, for plans that were made before. So a
        commit tells the catalog about changed parts only. Other columns make
        another table, and the one before is dropped.
        """
        v = v or self.version(name)
        shown = self._shown(name)
        if shown is not None and shown.version == v.number:
            return
        schema, columns = name.split(".")[0], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in v.schema.fields)
        table = f"{name}__v{zlib.crc32(f'{self.root} {columns}'.encode()):08x}"
        was: set[tuple[str, str]] = set()
        if shown is not None and shown.table == table and shown.version in self.versions(name):
            was = {(w, p) for p, w in self.version(name, shown.version).parts.items()}
        else:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{self.root}/{schema}'")
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}, `_write` string, `_part` string) USING parquet "
                f"PARTITIONED BY (`_write`, `_part`) LOCATION '{self.path(name)}'"
            )
        self._partitions(table, "ADD IF NOT EXISTS", sorted({(w, p) for p, w in v.parts.items()} - was), " ")
        current = " OR ".join(
            f"(`_write` = '{w}' AND `_part` IN ({', '.join(f"'{p}'" for p in ps)}))" for w, ps in sorted(_by_write(v.parts).items())
        )
        rows = f"(SELECT {', '.join(f'`{c}`' for c in v.schema.names)} FROM {table} WHERE {current or 'false'})"
        told = {"root": self.root, "version": v.number, "table": table}
        properties = ", ".join(f"'lakelayers.{k}' = '{x}'" for k, x in told.items())
        text = (v.reading or "SELECT * FROM {rows}").format(rows=rows)
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS {text}")
        if shown is not None and shown.table != table:
            self.spark.sql(f"DROP TABLE IF EXISTS {shown.table}")

    def _partitions(self, table: str, what: str, pairs: list[tuple[str, str]], between: str) -> None:
        for i in range(0, len(pairs), 500):
            named = between.join(f"PARTITION (`_write`='{w}', `_part`='{p}')" for w, p in pairs[i : i + 500])
            self.spark.sql(f"ALTER TABLE {table} {what} {named}")

    def publish_views(self) -> list[str]:
        """All views that do not name the newest version, as at the start of a session without a metastore."""
        names = self.names()
        for name in names:
            self.publish_view(name)
        return names


def create_latest_version_view(
    spark: SparkSession, relation: str, view: str, columns: list[str] | None = None
) -> None:
    """Create or replace ``view`` as all rows of ``relation``."""
    chosen = ", ".join(f"`{c}`" for c in columns) if columns else "*"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {chosen} FROM {relation}")


def as_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """A model that is not stored: the catalog view ``schema.table``, planned anew by each reader."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def _by_write(parts: dict[str, str]) -> dict[str, list[str]]:
    writes: dict[str, list[str]] = {}
    for p, w in parts.items():
        writes.setdefault(w, []).append(p)
    return writes


def _inputs(sources: dict[str, Version] | None) -> dict[str, dict[str, str]]:
    return {name: v.parts for name, v in (sources or {}).items()}


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
