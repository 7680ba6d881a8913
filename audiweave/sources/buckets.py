"""Tables in hashed buckets of entities, of which an update reads and rewrites only what it touches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audiweave.operators.incremental import delete_entities, upsert
from audiweave.sources.scratch import written
from audiweave.sources.tables import Warehouse

#: The partition column that holds the bucket.
BUCKET = "_bucket"


@dataclass(frozen=True)
class EntityTable:
    """A table of ``warehouse`` in which all rows of an entity lie in one of ``buckets`` folders, by a hash of its columns.

    Updates collect the numbers of the buckets that they touch (``buckets`` at
    most), read these folders alone, and put new ones in their place by dynamic
    partition overwrite, when all tasks have written: a write that fails leaves
    the table as it was, and the files of other buckets are never touched. Give
    so many buckets that one holds a few tasks' worth of rows.
    """

    warehouse: Warehouse
    dataset: str
    table: str
    entity: tuple[str, ...]
    buckets: int = 64

    def _number(self) -> Column:
        return F.pmod(F.xxhash64(*self.entity), F.lit(self.buckets)).cast("int")

    def _path(self) -> str:
        return self.warehouse.path(self.dataset, self.table)

    def exists(self) -> bool:
        return self.warehouse.exists(self.dataset, self.table)

    def read(self) -> DataFrame:
        """All rows, without the bucket."""
        return self._stored().drop(BUCKET)

    def _stored(self) -> DataFrame:
        # an update may have brought columns that other buckets lack
        return self.warehouse.spark.read.option("mergeSchema", True).parquet(self._path())

    def touched(self, df: DataFrame) -> list[int]:
        """Buckets of the entities of ``df``."""
        return sorted(r[0] for r in df.select(self._number()).distinct().collect())

    def rows_of(self, numbers: list[int]) -> DataFrame:
        """Rows of some buckets; other folders aren't opened."""
        return self._stored().where(F.col(BUCKET).isin(numbers)).drop(BUCKET)

    def create(self, df: DataFrame) -> None:
        """Write the table anew."""
        self.warehouse.write(df.withColumn(BUCKET, self._number()), self.dataset, self.table, "overwrite", by=[BUCKET])

    def _files(self, numbers: list[int]) -> dict[int, list[str]]:
        out = {}
        for n in numbers:
            files, at = self.warehouse._files(f"{self._path()}/{BUCKET}={n}")
            out[n] = sorted(x.getPath().getName() for x in files.listStatus(at)) if files.exists(at) else []
        return out

    def replace(self, df: DataFrame, numbers: list[int]) -> None:
        """The rows of the numbered buckets become ``df``, which may be a plan over them."""
        before = self._files(numbers)
        out = df.withColumn(BUCKET, self._number()).repartition(max(1, len(numbers)), BUCKET)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self._path())
        # a bucket that got no row keeps its old folder until here
        for n, names in self._files(numbers).items():
            if names and names == before[n]:
                files, at = self.warehouse._files(f"{self._path()}/{BUCKET}={n}")
                files.delete(at, True)

    def upsert(self, new: DataFrame, keys: list[str], now, dated: str = "last_updated_date", int_null_zero: bool = False) -> None:
        """B1, B2 in place: the rules of ``incremental.upsert`` for the entities of ``new``, whose column is the first of
        ``entity``; other entities of their buckets stay. No rows change nothing; without a table it is made."""
        if not self.exists():
            self.create(new.withColumn(dated, F.lit(now)))
            return
        new = written(new, "upsert")
        if numbers := self.touched(new):
            old = self.rows_of(numbers)
            merged = upsert(old, new, self.entity[0], keys, now, dated, int_null_zero)
            self.replace(delete_entities(old, new, self.entity[0]).unionByName(merged, allowMissingColumns=True), numbers)

    def delete(self, ids: DataFrame) -> None:
        """B3 in place: rows of given entities go; those of a null entity stay."""
        ids = written(ids.select(*self.entity).distinct(), "deleted")
        if numbers := self.touched(ids):
            self.replace(self.rows_of(numbers).join(ids, list(self.entity), "left_anti"), numbers)

    def put_changed(self, new: DataFrame, value: str, batch: str) -> tuple[DataFrame, list[int]]:
        """B20 over a table of the latest row of each entity: (changed, buckets). Changed rows of ``new`` (one per
        entity) differ in ``value`` from the stored row or have none, or were put by this very ``batch``: then it is run again."""
        new = written(new, "new")
        numbers = self.touched(new)
        if not self.exists():
            return new, numbers
        old = self.rows_of(numbers).select(*(F.col(c).alias(f"_old_{c}") for c in self.entity), F.col(value).alias("_value"), F.col("_batch"))
        same = F.lit(True)
        for c in self.entity:
            same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
        kept = F.coalesce(F.col("_value").eqNullSafe(F.col(value)) & (F.col("_batch") != batch), F.lit(False))
        both = new.join(old.withColumn("_there", F.lit(True)), same, "left")
        return written(both.where(F.col("_there").isNull() | ~kept).select(*new.columns), "changed"), numbers

    def store_latest(self, changed: DataFrame, numbers: list[int], batch: str) -> None:
        """The changed rows of ``put_changed`` take the place of their entities' rows."""
        changed = changed.withColumn("_batch", F.lit(batch))
        if not self.exists():
            self.create(changed)
        elif numbers:
            old, ids = self.rows_of(numbers), changed.select(*(F.col(c).alias(f"_new_{c}") for c in self.entity))
            same = F.lit(True)
            for c in self.entity:
                same = same & F.col(c).eqNullSafe(F.col(f"_new_{c}"))
            self.replace(old.join(ids, same, "left_anti").unionByName(changed), numbers)
