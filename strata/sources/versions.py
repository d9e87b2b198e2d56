"""Tables that grow in committed steps.

A step writes its rows under a folder of its own and then a small commit table.
Readers take only what is committed. A step that died half way leaves rows
nobody reads, and running it again overwrites them: the data lands exactly once.

A commit may name its origin, for instance the stream and the batch that made
it, so that work which comes a second time is recognised. Batch numbers alone
would not do: every new stream counts from 0 again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STEP = "_step"
ORIGIN = "_origin"
BUCKET = "_bucket"
GONE = "_gone"
#: Where a row lies: its file, its number there from 1, and the block of that number.
_FILE, _ROW, _BLOCK = "_file", "_row", "_block"


class SteppedTable:
    """A folder of rows in committed steps.

    ``schema`` describes the rows without the step column. ``facts`` is the
    schema of what a commit says about its step.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str,
        facts: str = "note STRING",
        partition_by: Sequence[str] = (),
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = StructType.fromDDL(f"{schema}, {STEP} BIGINT")
        self.facts = StructType.fromDDL(f"{facts}, {ORIGIN} STRING, {STEP} BIGINT")
        self.partition_by = list(partition_by)

    def _nothing(self, schema: StructType) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def _rows_of(self, steps: Sequence[int]) -> DataFrame:
        """Rows of these steps; a folder that is not there is an error."""
        if not steps:
            return self._nothing(self.schema)
        base = f"{self.root}/rows"
        paths = [f"{base}/{STEP}={s}" for s in steps]
        return self.spark.read.schema(self.schema).option("basePath", base).parquet(*paths)

    def commits(self) -> DataFrame:
        """What each step says; nothing only if no step was ever committed."""
        try:
            return self.spark.read.schema(self.facts).parquet(f"{self.root}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        return self._nothing(self.facts)

    def steps(self) -> list[int]:
        """Numbers of the committed steps: one for each folder that a reader lists anyway."""
        return sorted(r[STEP] for r in self.commits().select(STEP).distinct().collect())

    def next_step(self) -> int:
        last = self.commits().agg(F.max(STEP)).first()[0]
        return 0 if last is None else last + 1

    def has(self, origin: str) -> bool:
        return not self.commits().filter(F.col(ORIGIN) == origin).isEmpty()

    def step_of(self, origin: str) -> int | None:
        """The step that names this origin."""
        return self.commits().filter(F.col(ORIGIN) == origin).agg(F.min(STEP)).first()[0]

    def rows_at(self, step: int) -> DataFrame:
        """Rows of one committed step."""
        return self._rows_of([step]).drop(STEP)

    def stage(self, rows: DataFrame, step: int) -> None:
        """Write the rows of a step; they stay invisible until it is committed."""
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.root}/rows/{STEP}={step}")

    def commit(self, facts: DataFrame, step: int, origin: str | None = None) -> None:
        named = facts.withColumn(ORIGIN, F.lit(origin).cast("string"))
        named.write.mode("overwrite").parquet(f"{self.root}/commits/{STEP}={step}")

    def note(self, text: str) -> DataFrame:
        """A commit that says only this, for tables with no other facts."""
        return self.spark.range(1, numPartitions=1).select(F.lit(text).alias("note"))

    def rows(self) -> DataFrame:
        """Rows of all committed steps."""
        return self._rows_of(self.steps()).drop(STEP)


class KeyedLog(SteppedTable):
    """Rows by key, of which later steps replace earlier ones; nothing is rewritten.

    A step appends, for each key it changes, all rows that the key has from then
    on, or one row marked as gone. The current rows of a key are those of its
    last step. Rows lie in folders by a hash of the keys, so reading a few keys
    opens few folders. The number of these buckets is stored with the first step;
    opening the table with another number is an error.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: str, keys: Sequence[str], buckets: int = 64, notes: str = ""
    ) -> None:
        """``notes``: more columns of the stored rows, such as what was done to them."""
        stored = f"{schema}, {notes + ', ' if notes else ''}{GONE} BOOLEAN, {BUCKET} INT"
        super().__init__(spark, root, stored, "buckets INT, last_order BIGINT", partition_by=[BUCKET])
        self.columns = StructType.fromDDL(schema).names
        self.keys = list(keys)
        self.buckets = buckets
        other = self.commits().filter(F.col("buckets") != buckets).select("buckets").first()
        if other:
            raise ValueError(f"{root} was made with {other[0]} buckets, not {buckets}")

    def bucket_of(self, *keys: Column) -> Column:
        return F.pmod(F.xxhash64(*(keys or self.keys)), F.lit(self.buckets)).cast("int")

    def append(
        self, rows: DataFrame, step: int, origin: str, order: int | None = None, derived: Mapping[str, Column] | None = None
    ) -> None:
        """Write and commit a step. ``rows`` may mark rows as gone; ``order`` is the delivery they come from.

        ``derived`` columns are made from the others behind the shuffle, which need not carry them.
        """
        if GONE not in rows.columns:
            rows = rows.withColumn(GONE, F.lit(False))
        bucket = self.bucket_of(*[(derived or {}).get(k, F.col(k)) for k in self.keys])
        # rebalance gathers a bucket into few files and still splits a large one
        placed = rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).withColumns(dict(derived or {}))
        self.stage(placed.select(*[c for c in self.schema.names if c != STEP]), step)
        facts = self.spark.range(1, numPartitions=1).select(F.lit(self.buckets).alias("buckets"), F.lit(order).cast("bigint").alias("last_order"))
        self.commit(facts, step, origin)

    def last_order(self) -> int | None:
        return self.commits().agg(F.max("last_order")).first()[0]

    def history(self, of: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """Rows of all steps, or of those before a step, or those of the keys in ``of``, with their step.

        The buckets of the wanted keys, at most ``buckets`` numbers, pick the folders.
        """
        return self._of_keys(self._steps_before(before), of)

    def _steps_before(self, before: int | None) -> list[int]:
        return [s for s in self.steps() if before is None or s < before]

    def _of_keys(self, steps: Sequence[int], of: DataFrame | None) -> DataFrame:
        rows = self._rows_of(steps)
        if of is None or not steps:
            return rows
        wanted = of.select(*self.keys).distinct()
        near = [r[0] for r in wanted.select(self.bucket_of().alias(BUCKET)).distinct().collect()]
        return rows.filter(F.col(BUCKET).isin(near)).join(wanted, self.keys, "left_semi")

    def current(self, of: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """The rows as they are now, or as they were before a step, of all keys or of those in ``of``."""
        steps = self._steps_before(before)
        if len(steps) < 2:
            # no later step replaces a row
            return self._of_keys(steps, of).filter(~F.col(GONE)).select(*self.columns)
        if of is None:
            return self._not_replaced(steps).filter(~F.col(GONE)).select(*self.columns)
        rows = self._of_keys(steps, of).withColumn("_rank", self._newest())
        return rows.filter(((F.col("_rank") == 1) | ~self._has_key()) & ~F.col(GONE)).select(*self.columns)

    def _newest(self) -> Column:
        """1 for the rows of a key's last step."""
        return F.rank().over(Window.partitionBy(*self.keys).orderBy(F.desc(STEP)))

    def _has_key(self) -> Column:
        """A null key is no key: its rows are never replaced."""
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])

    def _not_replaced(self, steps: Sequence[int]) -> DataFrame:
        """Rows of these steps but those that a later one replaces; only their keys and places are shuffled.

        What is replaced goes to the readers of the rows as one bit for each row
        of the blocks that have any, an eighth of a byte for a row.
        """
        located = self._rows_of(steps).select("*", F.col("_metadata.file_name").alias(_FILE), (F.col("_metadata.row_index") + 1).alias(_ROW))
        place = [STEP, BUCKET, _FILE, _BLOCK]
        located = located.withColumn(_BLOCK, F.bitmap_bucket_number(_ROW))
        bit = F.bitmap_bit_position(_ROW)
        ranked = located.filter(self._has_key()).select(*self.keys, *place, bit.alias("_bit")).withColumn("_rank", self._newest())
        replaced = ranked.filter(F.col("_rank") > 1).groupBy(*place).agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        read = located.join(F.broadcast(replaced), place, "left")
        return read.filter(F.col("_bits").isNull() | (F.getbit(byte, (bit % 8).cast("int")) == 0))
