"""Session for local runs (tests, bench).  On a cluster pass your own session."""

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", app: str = "corpuslake", **conf) -> SparkSession:
    """A session on this machine; name ``spark.checkpoint.dir`` in ``conf``, as on a cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
