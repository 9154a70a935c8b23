"""Session settings for data-quality runs.

The measures are scans, map-side-combined aggregates and equi-joins, so the
settings that matter at scale are the adaptive ones: AQE re-plans joins from
runtime sizes (a small side becomes a broadcast only once its real size is
known), coalesces small shuffle partitions and splits skewed join partitions.
``maxPartitionBytes`` keeps scan tasks large enough that a 100 TB table is
read in a manageable number of tasks.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings applied by :func:`configure` (any of them can be overridden).
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 512 * 1024**2, floor: int = 200) -> int:
    """A ``spark.sql.shuffle.partitions`` for an input of ``input_bytes``.

    AQE merges small shuffle partitions but never splits large ones outside
    skewed joins, and the row expansion of the accuracy report uses the count
    as is, so the count has to be sized for the biggest shuffle: about one
    partition per ``target_bytes`` of input (100 TB -> ~200 000).
    """
    return max(floor, -(-int(input_bytes) // int(target_bytes)))


def configure(builder: SparkSession.Builder, overrides: dict | None = None) -> SparkSession.Builder:
    for k, v in {**RECOMMENDED, **(overrides or {})}.items():
        builder = builder.config(k, v)
    return builder


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vigil") -> SparkSession:
    """A local session for tests and the bench (no UI, few shuffle partitions)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    b = configure(
        b,
        {
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
            # small shuffles still spread over the cores (the default floor is 1 MB)
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        },
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
