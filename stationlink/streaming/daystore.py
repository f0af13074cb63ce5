"""Tables of landed batches by day, and tables rebuilt day by day.

A batch adds its rows (or partial sums) under ``<table>/day=<d>/batch=<n>``; a batch that
is run again replaces its own partitions, so nothing is counted twice. The days it
touches are listed beside it. A table built from such rows is replaced by whole days:
only the partitions of touched days are read, computed and written. A commit records, for
each table of batches, the last batch that the built tables hold; what came after is
pending, also when a run died in between.

Days are calendar days: a list of touched days is small however many rows they hold.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY, BATCH, YEAR = "day", "batch", "year"
TOUCHED = T.StructType([T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.LongType())])
COMMITS = T.StructType([T.StructField("table", T.StringType()), T.StructField(BATCH, T.LongType()), T.StructField("mark", T.StringType()),
                        T.StructField("seq", T.LongType())])


class DayStore:
    """The tables below ``root``. ``batches`` and ``built`` give the columns of each table
    (without the partition columns): those that batches add to, those rebuilt by day."""

    def __init__(self, spark: SparkSession, root: str, batches: dict[str, T.StructType], built: dict[str, T.StructType]):
        self.spark, self.root = spark, root.rstrip("/")
        self.batches, self.built = dict(batches), dict(built)

    # ---- files ----------------------------------------------------------------------

    def _path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, *parts: str) -> bool:
        p, fs = self._fs(self._path(*parts))
        return fs.exists(p)

    def _read(self, schema: T.StructType, *parts: str) -> DataFrame:
        if not self.exists(*parts):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(*parts))

    def _write(self, df: DataFrame, by: list[str], *parts: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
           .partitionBy(*by).parquet(self._path(*parts)))

    # ---- batches --------------------------------------------------------------------

    def add(self, table: str, df: DataFrame, batch: int, day: Column | None = None) -> None:
        """ACTION. The rows of one batch, by ``day`` (default: the column of that name). Rows
        without a day have a partition of their own."""
        cols = [f.name for f in self.batches[table].fields]
        rows = df.withColumn(DAY, (F.col(DAY) if day is None else day).cast("date")).select(*cols, DAY).withColumn(BATCH, F.lit(batch).cast("long"))
        self._write(rows, [DAY, BATCH], table)
        days = self.rows(table).where(F.col(BATCH) == batch).select(DAY).distinct()
        self._write(days.withColumn(BATCH, F.lit(batch).cast("long")), [BATCH], "_touched", table)

    def rows(self, table: str, days: list | None = None) -> DataFrame:
        """The rows of all batches with ``day`` and ``batch``; of some days only their partitions."""
        df = self._read(T.StructType([*self.batches[table].fields, *TOUCHED.fields]), table)
        return df if days is None else df.where(on_days(days))

    def pending(self, table: str) -> list:
        """Days touched by batches that no commit holds yet."""
        done = self.committed().get(table, (-1, None))[0]
        return [r[DAY] for r in self._read(TOUCHED, "_touched", table).where(F.col(BATCH) > done).select(DAY).distinct().collect()]

    def last_batch(self, table: str) -> int:
        return self._read(TOUCHED, "_touched", table).agg(F.coalesce(F.max(BATCH), F.lit(-1))).first()[0]

    # ---- commits --------------------------------------------------------------------

    def committed(self) -> dict[str, tuple[int, str | None]]:
        """Batch and mark of each table in its last commit: one small row a table and commit."""
        rows = self._read(COMMITS, "_commits").groupBy("table").agg(F.max_by(F.struct(BATCH, "mark"), "seq").alias("x"))
        return {r["table"]: (r.x[BATCH], r.x.mark) for r in rows.collect()}

    def next_commit(self) -> int:
        return self._read(COMMITS, "_commits").agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0] + 1

    def commit(self, marks: dict[str, tuple[int, str | None]]) -> None:
        """ACTION. The built tables now hold the batches up to these."""
        rows = [(t, b, m, self.next_commit()) for t, (b, m) in marks.items()]
        self._write(self.spark.createDataFrame(rows, COMMITS), ["seq"], "_commits")

    # ---- built tables ---------------------------------------------------------------

    def replace_days(self, table: str, df: DataFrame) -> None:
        """ACTION. Replace the days present in ``df``. The writer's tasks are rebalanced, so
        a day of very many rows is written by several tasks and small days share one."""
        cols = [f.name for f in self.built[table].fields]
        self._write(df.select(*cols, DAY).hint("rebalance", DAY), [DAY], table)

    def live(self, table: str) -> DataFrame:
        return self._read(T.StructType([*self.built[table].fields, T.StructField(DAY, T.DateType())]), table)

    def archived(self, table: str) -> DataFrame:
        fields = [*self.built[table].fields, T.StructField(YEAR, T.IntegerType()), T.StructField(DAY, T.DateType())]
        return self._read(T.StructType(fields), f"{table}_archive")

    def days(self, df: DataFrame) -> list:
        return [r[DAY] for r in df.select(DAY).distinct().collect()]

    def whole(self, table: str) -> DataFrame:
        """Live and archived days as one table. A day in both (it was built again after its
        year was archived, or a run died between copy and removal) counts as live."""
        live = self.live(table)
        return live.unionByName(self.archived(table).drop(YEAR).where(~on_days(self.days(live))))

    def archive(self, table: str) -> list:
        """ACTION. Move the days of every year before the newest one from the live table to
        ``<table>_archive/year=/day=``. The copy is written first and replaces what the
        archive has of these days, then the live partitions go: a run that dies in between
        loses nothing, doubles nothing in ``whole``, and is made good by the next."""
        live = self.live(table)
        known = [d for d in self.days(live) if d is not None]
        old = [d for d in known if d.year < max(known).year]
        if old:
            part = live.where(on_days(old)).withColumn(YEAR, F.year(DAY))
            self._write(part.hint("rebalance", YEAR, DAY), [YEAR, DAY], f"{table}_archive")
            for d in old:
                self.drop_day(table, d)
        return old

    def drop_day(self, table: str, day: datetime.date) -> None:
        p, fs = self._fs(self._path(table, f"{DAY}={day.isoformat()}"))
        fs.delete(p, True)


def on_days(days: list) -> Column:
    """Rows of these days, null among them: a filter that prunes partitions."""
    known = [d for d in days if d is not None]
    test = F.col(DAY).isin(known) if known else F.lit(False)
    test = F.coalesce(test, F.lit(False))
    return test | F.col(DAY).isNull() if None in days else test
