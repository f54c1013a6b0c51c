"""Session helpers: local sessions for tests and checkpoint directory lookup."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


HUGE_METHODS = "-XX:-DontCompileHugeMethods"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripmart")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        # Rule projections generate wide methods; let the JIT compile methods
        # above 8000 bytecodes instead of interpreting them (set the same
        # option in spark.executor.extraJavaOptions on a cluster).
        .config("spark.driver.extraJavaOptions", HUGE_METHODS)
        .config("spark.executor.extraJavaOptions", HUGE_METHODS)
        # Plans are built from many Column expressions; skip per-call Python
        # stack capture (only used to decorate error messages).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for published layers and cut lineage.

    The value of ``spark.checkpoint.dir`` is used as is. Only a session whose
    executors are threads of the driver (``local`` masters, as in tests) may
    do without it and gets a private folder; any other master must name a
    folder all its machines share, since a machine-local one loses files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_one_machine(sc.master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder with master {sc.master}")
        configured = tempfile.mkdtemp(prefix="tripmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_folder(spark: SparkSession) -> str:
    """The folder of published layers: the one the cluster names, the same for every session that names it.

    (``getCheckpointDir`` has a level of its own for each application.)
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return named or checkpoint_dir(spark)


def fixed_zone(spark: SparkSession) -> str:
    """The session's time zone, which must have one offset all year.

    Raw timestamps are wall-clock times. Zones that turn their clocks have no
    such time for an hour a year, and would move it before it is hashed; layers
    of sessions in different zones are kept apart.
    """
    name = spark.conf.get("spark.sql.session.timeZone")
    zone = spark._jvm.java.time.ZoneId.of(name, spark._jvm.java.time.ZoneId.SHORT_IDS)
    if not zone.getRules().isFixedOffset():
        raise ValueError(f"spark.sql.session.timeZone is {name}: a zone of one fixed offset, such as UTC, is needed")
    return zone.normalized().getId()


def is_one_machine(master: str) -> bool:
    """Whether executors share the driver's machine and process (``local``, ``local[n]``)."""
    return master == "local" or master.startswith("local[")
