"""Session helpers shared by every operator: table access, parallelism, checkpoints, size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes (of its rows as JSON) up to which a side of a join is broadcast after it has been measured; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20


def local_session(cores: str = "8", app: str = "pagemill") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core for a small input: a scan with fewer splits than cores is redistributed.

    For scans with filters and projections only, whose splits are known from the files; over a shuffle it would run that
    shuffle. At scale a scan has many more splits than the cluster has cores and nothing moves.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def checkpoint_dir(spark: SparkSession) -> None:
    """Take the folder that the cluster names in spark.checkpoint.dir; only a local session without one makes its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    Its files go when the frame is no longer referenced if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Checkpoint a side that is expected to be small, measure its bytes, and mark it for broadcast if they are few.

    A side over the bound is returned without the mark, so that Spark shuffles the join instead.
    """
    kept = checkpointed(df)
    size = kept.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(kept) if size <= most else kept


def ranked(keys: DataFrame, group: list[str], order: list[str], name: str = "rank", value: str | None = None) -> DataFrame:
    """Every row with the number of rows before it in its group by `order`, or with the sum of their `value`.

    For groups of any size: the rows are cut into ranges of (group, order), added up within each part of a group, and
    shifted by the parts before. Give it keys only. Nulls form a group; rows equal in both stand in any order.
    """
    one = F.lit(1) if value is None else F.col(value)
    cut = checkpointed(keys.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    ahead = lambda *g: Window.partitionBy(*g).rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*group, "_part").agg(F.sum(one).alias("_n"))
    offsets = sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(ahead(*group).orderBy("_part")), F.lit(0)).alias("_ahead"))
    local = cut.withColumn("_k", F.coalesce(F.sum(one).over(ahead(*group, "_part").orderBy(*order)), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return local.join(offsets, same).withColumn(name, (F.col("_k") + F.col("_ahead")).cast("int")).select(*keys.columns, name)


def bounded_sample(df: DataFrame, text: str, rows: int) -> DataFrame:
    """(h, all columns) of at most `rows` rows, the lowest by the hash of `text`, ties by the text itself.

    A threshold on the hash, from the number of rows, comes first: so tasks together pass on a few times `rows` rows,
    however many tasks there are, and the ordered limit does not gather a full list from each.
    """
    n = df.count()
    h = F.xxhash64(text)
    if n > 4 * rows:
        df = df.filter(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 4 * rows / n)))
    return df.withColumn("h", h).orderBy(F.pmod("h", F.lit(1 << 30)), text).limit(rows)
