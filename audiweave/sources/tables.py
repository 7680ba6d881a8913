"""Landing readers, tables and exports. A table is ``<root>/<dataset>/<table>`` as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audiweave.functions.text import clean_columns
from audiweave.sources.scratch import written


@dataclass(frozen=True)
class Warehouse:
    """Tables under one root folder of any file system that Spark opens."""

    spark: SparkSession
    root: str

    def path(self, dataset: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{dataset}/{table}"

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def exists(self, dataset: str, table: str) -> bool:
        files, at = self._files(self.path(dataset, table))
        return files.exists(at)

    def read(self, dataset: str, table: str) -> DataFrame:
        """A4: the rows of a table."""
        return self.spark.read.parquet(self.path(dataset, table))

    def load_if_absent(self, df: DataFrame, dataset: str, table: str) -> bool:
        """A2: writes unless the table is there; tells whether it wrote."""
        new = not self.exists(dataset, table)
        df.write.mode("ignore").parquet(self.path(dataset, table))
        return new

    def write(self, df: DataFrame, dataset: str, table: str, mode: str = "append", schema: T.StructType | None = None, by: list[str] | None = None) -> None:
        """A3: append or overwrite. An overwrite is staged, so a plan may read what it replaces; the old table keeps its files
        under another name until the new one is in place, and comes back where that fails."""
        if mode not in ("append", "overwrite"):
            raise ValueError(f"mode is append or overwrite, not {mode}")
        out = df.select(*(F.col(f.name).cast(f.dataType) for f in schema)) if schema else df
        target = self.path(dataset, table)
        if mode == "append":
            out.write.mode("append").partitionBy(*by or ()).parquet(target)
            return
        run = uuid.uuid4().hex
        staged = f"{self.root.rstrip('/')}/.staged-{run}"
        out.write.partitionBy(*by or ()).parquet(staged)
        files, at = self._files(target)
        old = self._files(f"{self.root.rstrip('/')}/.old-{run}")[1]
        was = files.exists(at)
        files.mkdirs(at.getParent())
        if was and not files.rename(at, old):
            raise OSError(f"could not move {target} aside")
        if not files.rename(self._files(staged)[1], at):
            if was:
                files.rename(old, at)
            raise OSError(f"could not move {staged} to {target}")
        files.delete(old, True)

    def drop(self, dataset: str, table: str) -> None:
        """No error where it is absent."""
        files, at = self._files(self.path(dataset, table))
        files.delete(at, True)

    def replace_snapshot(self, df: DataFrame, dataset: str, table: str) -> bool:
        """An empty snapshot replaces nothing; tells whether it replaced."""
        if df.isEmpty():
            return False
        self.write(df, dataset, table, "overwrite")
        return True

    def catalog(self) -> DataFrame:
        """Dataset, table, column and type of everything under the root."""
        files, at = self._files(self.root)
        rows = []
        for dataset in files.listStatus(at) if files.exists(at) else []:
            if dataset.getPath().getName().startswith("."):
                continue
            for table in files.listStatus(dataset.getPath()):
                own = (dataset.getPath().getName(), table.getPath().getName())
                rows += [(*own, f.name, f.dataType.simpleString()) for f in self.spark.read.parquet(str(table.getPath())).schema]
        return self.spark.createDataFrame(rows, "dataset string, table string, column string, type string")

    def append_once(self, df: DataFrame, dataset: str, table: str, keys: list[str], by: str | None = None) -> DataFrame:
        """Writes the rows whose key isn't stored yet, and returns them. ``by``, one of the keys, partitions the table;
        then only the partitions of the values that ``df`` holds are read, which the driver gathers."""
        new = df
        if self.exists(dataset, table):
            stored = self.read(dataset, table)
            if by:
                stored = stored.where(F.col(by).isin([r[0] for r in df.select(by).distinct().collect()]))
            new = df.join(stored.select(*keys).distinct(), keys, "left_anti")
        self.write(new, dataset, table, by=[by] if by else None)
        return new

    def cached(self, dataset: str, table: str, key: dict, build: Callable[[], DataFrame]) -> DataFrame:
        """Stored rows of a key, built and appended where there are none."""
        match = lambda df: df.where(reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.lit(v)) for k, v in key.items()), F.lit(True)))
        if not self.exists(dataset, table) or match(self.read(dataset, table)).isEmpty():
            made = build().withColumns({k: F.lit(v) for k, v in key.items()})
            self.write(made, dataset, table, by=list(key))
        return match(self.read(dataset, table))

    def log_run(self, dataset: str, table: str, message: str, at: str) -> None:
        """A line of one run."""
        self.log_runs(self.spark.createDataFrame([(at, f"{dataset}.{table}", message)], "at string, table string, message string"))

    def log_runs(self, lines: DataFrame) -> None:
        """Lines (at, table, message) of several runs, in one write."""
        self.write(lines.select("at", "table", "message"), "runs", "log")

    def log_failed(self, ev: DataFrame, run: str) -> None:
        """The first and last event time that a failed run had in hand; without events nothing."""
        self.write(ev.agg(F.min("ts").alias("start"), F.max("ts").alias("end")).where("start is not null").withColumn("run", F.lit(run)), "runs", "failed")

    def failed_windows(self, run: str) -> DataFrame:
        """(start, end) of the failed runs of a name, a row per run."""
        return self.read("runs", "failed").where(F.col("run") == run).select("start", "end").distinct()


def read_landing_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A1: CSV named ``<dataset>__<table>_<time>.csv``; adds dataset and table, drops ``Unnamed`` columns."""
    df = spark.read.csv(path, header=True, schema=schema)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    df = df.drop(*(c for c in df.columns if c.startswith("Unnamed")))
    return df.withColumns({"dataset": F.regexp_extract(name, "^(.*?)__", 1), "table": F.regexp_extract(name, r"^.*?__(.*)_[^_]*\.csv", 1)})


def mirror_jdbc(df: DataFrame, url: str, table: str, mode: str, batch: int = 20_000) -> None:
    """A5: rows into a relational table, lower-case names, in batches."""
    df.toDF(*(c.lower() for c in df.columns)).write.option("batchsize", batch).jdbc(url, table, mode)


def scan_events(ev: DataFrame, end, lookback: int) -> DataFrame:
    """Events of ``lookback`` days up to ``end``, by the partition column ``event_date``."""
    last = F.lit(end).cast("date")
    return ev.where(F.col("event_date").between(F.date_sub(last, lookback), last))


def read_json_pages(spark: SparkSession, path: str, schema: str, field: str = "data") -> DataFrame:
    """Records of landed JSON pages, with the page's file name as ``page``."""
    pages = spark.read.json(path, schema=schema, multiLine=True).withColumn("page", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
    rest = [c for c in pages.columns if c != field]
    return pages.select(*rest, F.explode(field).alias("_r")).select(*rest, "_r.*")


def read_xml_pages(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """A10: none, one or many records of each page."""
    return spark.read.schema(schema).option("rowTag", row_tag).format("xml").load(path)


def load_csv_set(spark: SparkSession, mapping: dict[str, str]) -> dict[str, DataFrame]:
    """Tables by file, clean names, ``date`` as a date whether or not it has hyphens."""
    out = {}
    for table, path in mapping.items():
        df = clean_columns(spark.read.csv(path, header=True))
        out[table] = df.withColumn("date", plain_date(F.col("date"))) if "date" in df.columns else df
    return out


def plain_date(col):
    return F.try_to_date(F.regexp_replace(col, "-", ""), "yyyyMMdd")


def is_newer(candidate: DataFrame, stored: DataFrame, date: str) -> bool:
    """The candidate's newest date is past the stored one."""
    a, b = (df.agg(F.max(date)).first()[0] for df in (candidate, stored))
    return a is not None and (b is None or a > b)


def export_table(df: DataFrame, path: str, fmt: str, allowed: tuple[str, ...] = ("csv", "json")) -> None:
    """Gzip CSV or JSON."""
    if fmt not in allowed:
        raise ValueError(f"format is one of {allowed}, not {fmt}")
    writer = df.write.option("compression", "gzip")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path)


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Written to the shared folder once and read back, for any number of uses; no executor's memory holds it."""
    return written(df, name)


def cap_rows(df: DataFrame, n: int, keys: list[str], seed: int = 0) -> DataFrame:
    """N rows, the same in every run: those whose keys have the least 60-bit hash; all rows where there are no more.

    The cut is found by counts: how many rows begin with each 15 bits of the hash,
    then within the one group of bits that holds the cut, and so on, for the
    hash of the keys and, among equal ones, that of the whole row. The driver gets
    2^15 counts at a time and no task sorts or holds n rows. Rows alike in
    everything are taken by number. Null keys are texts of their own.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\\N"))
    hashed = lambda *parts: F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 15), 16, 10).cast("long")
    whole = F.to_json(F.struct(*df.columns))
    rest = df.withColumns({"_k": hashed(*map(text, keys), F.lit(str(seed))), "_w": hashed(whole, F.lit(str(seed)))})
    every, left = rest, n
    taken = F.lit(False)
    same = F.lit(True)
    for name in ("_k", "_w"):
        for down in (45, 30, 15, 0):
            bits = F.shiftright(name, down).bitwiseAND((1 << 15) - 1)
            counts = sorted((r["b"], r["n"]) for r in rest.groupBy(bits.alias("b")).agg(F.count("*").alias("n")).collect())
            if not counts or sum(c for _, c in counts) <= left:
                return every.where(taken | same).select(df.columns)
            for at, c in counts:
                if c > left:
                    break
                left -= c
            taken = taken | (same & (bits < at))
            if not left:
                return every.where(taken).select(df.columns)
            same = same & (bits == at)
            rest = every.where(same)
    tied = written(rest.withColumn("_at", F.monotonically_increasing_id()), "tied")
    part = F.shiftright("_at", 33)
    quota = []
    for r in sorted(tied.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        quota.append((r["part"], min(left, r["n"])))
        left -= quota[-1][1]
    quota = df.sparkSession.createDataFrame(quota, "part long, quota long")
    some = tied.withColumn("part", part.cast("long")).join(F.broadcast(quota), "part").where(F.col("_at").bitwiseAND((1 << 33) - 1) < F.col("quota"))
    return every.where(taken).select(df.columns).union(some.select(df.columns))


