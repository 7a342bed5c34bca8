"""Messages delivered more than once: keep exactly one copy of each.

Two rows are copies if their key columns agree and their times lie less than
``tolerance_us`` apart (chains of such rows are one message); the row with the
smallest id stays.

1. Rows per time bucket are counted; this fixes the filters' layout.
2. Every task hashes (key, time cell) of its rows, sorted within the task, into Bloom
   filters per time bucket, merged per filter and written to the shared folder.
3. The rows are read again, sorted likewise, and screened against the filters of
   their own and of the neighbouring cells: a row whose cell was hit once and whose
   neighbour cells were not hit is definitely new.  Such rows are never shuffled.
4. The possible repeats are stored once, reduced per (key, cell) and compared exactly
   within stretches of a day; whatever crosses a day's end is joined through two rows
   a key and day.

``DeliveryLog`` keeps filters and rows of one batch after another, so that a later
batch is screened against the earlier ones and verified only against the stored
days that its possible repeats fall in.

Defined cases: a null id, key or time never matches anything, so such a row is
no repeat; rows with one id twice are one row; an empty table gives no rows;
further columns are not read, so clashing names do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsforge.catalog import micros
from obsforge.operators.bloomstore import Builder, Gathered, Layout, Reader, mix, open_fs
from obsforge.session import materialize, scratch_path

BUCKET_US = 3_600_000_000
DAY_US = 86_400_000_000
PART = "file long, filter long, bits long, hashes binary, once binary, again binary"


def _narrow(df: DataFrame, id_col: str, keys: Sequence[str], ts_col: str) -> DataFrame:
    return df.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(*keys).alias("kh"),
        F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"),
        micros(ts_col).alias("us"),
    ).where(" AND ".join(["id IS NOT NULL", "us IS NOT NULL", *[f"key.k{i} IS NOT NULL" for i in range(len(keys))]]))


def build_filters(rows: DataFrame, tolerance_us: int, bucket_us: int, uri: str | None = None) -> tuple[Layout, str]:
    """Write the filters of (kh, us) rows; returns their layout and folder."""
    spark = rows.sparkSession
    # One row per occupied bucket: bounded by the calendar, not by the rows.
    counts = rows.groupBy(F.floor(F.col("us") / bucket_us).cast("long").alias("b")).count().collect()
    layout = Layout.of([(r[0], r[1]) for r in counts], bucket_us, tolerance_us)
    uri = uri or scratch_path(spark, "filters")
    shared = spark.sparkContext.broadcast(layout)

    def partial(batches):
        build = Builder(shared.value)
        names = [c.split()[0] for c in PART.split(", ")]
        for pdf in batches:
            cell, kh = pdf["us"].to_numpy() // tolerance_us, pdf["kh"].to_numpy()
            if got := list(build.add(cell * tolerance_us, kh, mix(kh, cell))):
                yield pd.DataFrame(got, columns=names)
        yield pd.DataFrame(list(build.flush()), columns=names)

    def write(batches):
        import pyarrow as pa

        fs, base = open_fs(uri)
        fs.create_dir(base, recursive=True)
        schema = pa.schema([("filter", pa.int64()), ("once", pa.binary()), ("again", pa.binary())])
        held, at = {}, None

        def put():
            # The content follows from the input alone, so a task that runs twice writes the same file.
            with fs.open_output_stream(f"{base}/f{at}.arrow") as sink, pa.ipc.new_stream(sink, schema) as out:
                s = sorted(held)
                done = [held[x].done() for x in s]
                out.write_table(pa.table({"filter": s, "once": [d[0] for d in done], "again": [d[1] for d in done]}, schema=schema))

        for pdf in batches:
            for f, number, bits, *part in pdf.itertuples(index=False):
                if at is not None and f != at:
                    put()
                    held = {}
                at = f
                held.setdefault(number, Gathered(int(bits))).add(*part)
        if at is not None:
            put()
        yield pd.DataFrame({"n": [len(held)]})

    cell = F.floor(F.col("us") / tolerance_us)
    parts = rows.select("kh", "us").sortWithinPartitions(cell, "kh").mapInPandas(partial, PART)
    n = max(1, min(layout.files, 4096))
    parts.repartition(n, "file").sortWithinPartitions("file", "filter").mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return layout, uri


def screen(rows: DataFrame, stores: Sequence[tuple[Layout, str]], tolerance_us: int, own: bool = True) -> DataFrame:
    """The rows which the filters can't call new; ``own``: the rows themselves are in the filters."""
    shared = rows.sparkSession.sparkContext.broadcast(list(stores))

    def keep(batches):
        import pyarrow as pa

        readers = [Reader(layout, uri) for layout, uri in shared.value]
        for batch in batches:
            us, kh = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("us", "kh"))
            cell, maybe = us // tolerance_us, np.zeros(len(us), bool)
            for k, again in ((0, own), (-1, False), (1, False)):
                h = mix(kh, cell + k)
                for r in readers:
                    maybe |= r.test((cell + k) * tolerance_us, kh, h, again)
            yield batch.filter(pa.array(maybe))

    return rows.sortWithinPartitions(F.floor(F.col("us") / tolerance_us), "kh").mapInArrow(keep, rows.schema)


def islands(maybe: DataFrame, tolerance_us: int) -> DataFrame:
    """(key, cell, first_id): the first of the message that the rows of a cell belong to.

    A key may hold a third of all rows in any number of cells, so its cells are linked day by day.
    """
    # All rows of a cell are one message, so a cell needs one row, made before the shuffle.
    cells = maybe.groupBy("key", "cell").agg(F.min("id").alias("first"), F.min("us").alias("lo"), F.max("us").alias("hi"))
    cells = cells.withColumn("day", F.floor(F.col("lo") / DAY_US))
    day = Window.partitionBy("key", "day")
    order = day.orderBy("cell")
    cut = F.coalesce((F.col("lo") - F.lag("hi").over(order) >= tolerance_us).cast("int"), F.lit(0))
    linked = cells.withColumn("island", F.sum(cut).over(order))
    linked = linked.withColumn("first", F.min("first").over(Window.partitionBy("key", "day", "island"))).withColumn("last_island", F.max("island").over(day))
    # Two places a key and day: its first and its last island, which are one if nothing cuts the day.
    ends = linked.groupBy("key", "day", "last_island").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min(F.when(F.col("island") == 0, F.col("first"))).alias("head"), F.min(F.when(F.col("island") == F.col("last_island"), F.col("first"))).alias("tail"),
    )
    by_day = Window.partitionBy("key").orderBy("day")
    joined = F.coalesce(F.col("lo") - F.lag("hi").over(by_day) < tolerance_us, F.lit(False))
    ends = ends.withColumn("new_head", (~joined).cast("int")).withColumn("new_tail", (F.col("last_island") > 0).cast("int"))
    ends = ends.withColumn("tail_chain", F.sum(F.col("new_head") + F.col("new_tail")).over(by_day)).withColumn("head_chain", F.col("tail_chain") - F.col("new_tail"))
    place = lambda island, chain, first: F.struct(F.col(island).alias("island"), F.col(chain).alias("chain"), F.col(first).alias("first"))
    both = ends.withColumn("zero", F.lit(0).cast("long")).select("key", "day", F.explode(F.array(place("zero", "head_chain", "head"), place("last_island", "tail_chain", "tail"))).alias("e")).select("key", "day", "e.*")
    chained = both.withColumn("across", F.min("first").over(Window.partitionBy("key", "chain"))).where("across < first").select("key", "day", "island", "across").distinct()
    return linked.join(chained, ["key", "day", "island"], "left").select("key", "cell", F.coalesce("across", "first").alias("first_id"))


def redelivered(
    df: DataFrame, id_col: str, keys: Sequence[str], ts_col: str, tolerance_us: int = 1_000_000, bucket_us: int = BUCKET_US
) -> DataFrame:
    """(id, first_id) of each row to drop and the row that stays in its place."""
    rows = _narrow(df, id_col, keys, ts_col)
    store = build_filters(rows, tolerance_us, bucket_us)
    maybe = materialize(screen(rows, [store], tolerance_us).withColumn("cell", F.floor(F.col("us") / tolerance_us)), "repeats")
    return maybe.join(islands(maybe, tolerance_us), ["key", "cell"]).where("id <> first_id").select("id", "first_id").distinct()


def delivered_once(df: DataFrame, id_col: str, keys: Sequence[str], ts_col: str, tolerance_us: int = 1_000_000) -> DataFrame:
    """``df`` without its repeated deliveries, with all columns; rows without id, key or time stay."""
    drop = redelivered(df, id_col, keys, ts_col, tolerance_us).select(F.col("id").alias("_dropped_id"))
    return df.join(drop, df[id_col].cast("long") == F.col("_dropped_id"), "left_anti")


class DeliveryLog:
    """Batches of deliveries, each screened against all before it.

    The folder holds, per batch, the filters of its rows, and the rows themselves by day with the row that stands
    for each.  A row of a later batch repeats a stored one if it lies near enough to it; then all rows of its own
    batch's message take the stored message's first row.  Stored rows are never joined with each other again.
    """

    def __init__(self, spark: SparkSession, uri: str, id_col: str, keys: Sequence[str], ts_col: str, tolerance_us: int = 1_000_000, bucket_us: int = BUCKET_US):
        self.spark, self.uri, self.columns = spark, uri.rstrip("/"), (id_col, keys, ts_col)
        self.tolerance_us, self.bucket_us, self.stores = tolerance_us, bucket_us, []

    def accept(self, batch: DataFrame) -> DataFrame:
        """(id, first_id) of each row of the batch to drop; the batch is stored."""
        n, tol = len(self.stores), self.tolerance_us
        rows = materialize(_narrow(batch, *self.columns), "batch")
        own = build_filters(rows, tol, self.bucket_us, f"{self.uri}/filters-{n}")
        cell = F.floor(F.col("us") / tol)
        inside = screen(rows, [own], tol)
        maybe = inside if not n else inside.unionByName(screen(rows, self.stores, tol, own=False)).distinct()
        maybe = materialize(maybe.withColumn("cell", cell), "repeats")
        first = islands(maybe, tol)
        if n:
            # Days on which possible repeats fall: bounded by the calendar.
            days = [r[0] for r in maybe.select(F.explode(F.array(*[F.floor((F.col("us") + k * tol) / DAY_US) for k in (-1, 0, 1)])).alias("d")).distinct().collect()]
            stored = self.spark.read.schema("kh long, id long, us long, stands_for long, batch int, day long").parquet(f"{self.uri}/rows").where(F.col("day").isin(days))
            near = maybe.select("key", "cell", F.xxhash64("key.*").alias("kh"), "us", F.explode(F.array(*[F.col("cell") + k for k in (-1, 0, 1)])).alias("at"))
            old = near.join(stored.select("kh", cell.alias("at"), F.col("us").alias("then"), "stands_for"), ["kh", "at"]).where(F.abs(F.col("us") - F.col("then")) < tol)
            old = old.groupBy("key", "cell").agg(F.min("stands_for").alias("old"))
            message = first.join(old, ["key", "cell"], "left")
            first = message.withColumn("first_id", F.coalesce(F.min("old").over(Window.partitionBy("key", "first_id")), "first_id")).drop("old")
        drop = materialize(maybe.join(first, ["key", "cell"]).where("id <> first_id").select("id", "first_id").distinct(), "drops")
        rows.join(drop, "id", "left").select("kh", "id", "us", F.coalesce("first_id", "id").alias("stands_for"), F.floor(F.col("us") / DAY_US).alias("day")).write.partitionBy("day").parquet(f"{self.uri}/rows/batch={n}")
        self.stores.append(own)
        return drop
