"""Event deduplication against a table of all events seen, of which a batch reads little.

Events lie in folders by step and by a hash of their key. Beside each folder
stands a Bloom filter of its keys: ``HASHES`` bits for each key, gathered with
``bit_or`` into words of 64. A batch asks the filters which folders may hold one
of its keys and reads the keys of those alone. A filter that is too full lets a
folder be read for nothing, and never hides one, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.refine import keep_one
from strata.sources.versions import BUCKET, STEP, SteppedTable
from strata.streaming.ingest import run_batches

KEY = "_key"
HASHES = 4
WORD_BITS = 64


class SeenEvents(SteppedTable):
    """Every event once, by key.

    A row with a null among its keys is known by all its columns: it is the same
    event only as a row that equals it. ``filter_bits`` is the size of a folder's
    filter; ten for each key that a step brings to a bucket keep it sharp. It and
    the number of buckets are stored with the first step and cannot change.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: Sequence[str], buckets: int = 64, filter_bits: int = 1 << 16) -> None:
        super().__init__(spark, root, f"{schema}, {KEY} STRING, {BUCKET} INT", "buckets INT, filter_bits INT", [BUCKET])
        self.columns = [c for c in self.schema.names if c not in (KEY, BUCKET, STEP)]
        self.keys, self.buckets, self.filter_bits = list(keys), buckets, filter_bits
        other = self.commits().filter((F.col("buckets") != buckets) | (F.col("filter_bits") != filter_bits)).first()
        if other:
            raise ValueError(f"{root} was made with {other['buckets']} buckets and filters of {other['filter_bits']} bits")

    def keyed(self, rows: DataFrame) -> DataFrame:
        """Rows with the text that identifies them, and its bucket."""
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        every = F.struct(*[F.col(c) for c in self.columns])
        # the two texts have different names in them, so none equals one of the other kind
        key = F.when(no_key, F.to_json(F.struct(every.alias("row")))).otherwise(F.to_json(F.struct(F.struct(*self.keys).alias("key"))))
        named = rows.select(*self.columns).withColumn(KEY, key)
        return named.withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int"))

    def _bits(self, keyed: DataFrame) -> DataFrame:
        """(_key, _bucket, word, bit) of each of a key's hashes."""
        numbers = F.explode(F.array(*[F.lit(k) for k in range(HASHES)])).alias("_k")
        # two hashes make all others; cut short, they cannot overflow
        first, step = (F.xxhash64(F.lit(name), KEY).bitwiseAND((1 << 48) - 1) for name in ("first", "step"))
        place = F.pmod(first + F.col("_k") * step, F.lit(self.filter_bits))
        placed = keyed.select(KEY, BUCKET, numbers).select(KEY, BUCKET, place.alias("_place"))
        return placed.select(KEY, BUCKET, F.expr(f"_place div {WORD_BITS}").cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(_place % {WORD_BITS} as int))").alias("bit"))

    def add(self, keyed: DataFrame, step: int, origin: str) -> None:
        """Write and commit a step of rows and its filters."""
        self.stage(keyed.hint("rebalance", BUCKET), step)
        staged = self._rows_of([step])
        filters = self._bits(staged).groupBy(BUCKET, "word").agg(F.bit_or("bit").alias("bits"))
        filters.coalesce(1 + self.buckets // 64).write.mode("overwrite").parquet(f"{self.root}/filters/{STEP}={step}")
        facts = self.spark.range(1, numPartitions=1).select(F.lit(self.buckets).alias("buckets"), F.lit(self.filter_bits).alias("filter_bits"))
        self.commit(facts, step, origin)

    def folders_of(self, keyed: DataFrame) -> list[tuple[int, int]]:
        """(step, bucket) of the folders that may hold one of these keys: numbers of folders, not of rows."""
        steps = self.steps()
        if not steps:
            return []
        base = f"{self.root}/filters"
        paths = [f"{base}/{STEP}={s}" for s in steps]
        filters = self.spark.read.schema(f"{BUCKET} INT, word INT, bits BIGINT, {STEP} BIGINT").option("basePath", base).parquet(*paths)
        asked = self._bits(keyed.select(KEY, BUCKET).distinct())
        hits = asked.join(filters, [BUCKET, "word"]).filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)
        # two of a key's hashes may fall on one bit
        wanted = asked.groupBy(KEY).agg(F.count_distinct("word", "bit").alias("wanted"))
        full = hits.groupBy(KEY, STEP, BUCKET).agg(F.count_distinct("word", "bit").alias("found")).join(wanted, KEY).filter("found = wanted")
        return sorted((r[0], r[1]) for r in full.select(STEP, BUCKET).distinct().collect())

    def held(self, keyed: DataFrame) -> DataFrame:
        """The keys in the folders that may hold one of these."""
        folders = self.folders_of(keyed)
        if not folders:
            return self._nothing(self.schema).select(KEY)
        base = f"{self.root}/rows"
        paths = [f"{base}/{STEP}={s}/{BUCKET}={b}" for s, b in folders]
        return self.spark.read.schema(self.schema).option("basePath", base).parquet(*paths).select(KEY)

    def events(self) -> DataFrame:
        return self.rows().select(*self.columns)


def dedup_seen(events: DataFrame, target: SeenEvents, checkpoint: str) -> None:
    """Append each event once to ``target``, however late it comes.

    Of copies that come together the first in the order of all columns stays, as in a batch.
    """

    def apply(batch: DataFrame, origin: str) -> None:
        if target.has(origin):
            return
        order: list[Column] = [F.asc_nulls_last(c) for c in target.columns]
        once = keep_one(target.keyed(batch), [KEY], order)
        target.add(once.join(target.held(target.keyed(batch)), KEY, "left_anti").select(*target.columns, KEY, BUCKET), target.next_step(), origin)

    run_batches(events, apply, checkpoint)
