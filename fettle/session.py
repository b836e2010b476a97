"""Session settings the operators are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "fettle", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and RocksDB streaming state.

    Nothing here fixes a cluster's size: pass ``spark.sql.shuffle.partitions`` and memory
    settings at submit time. ``master`` is for local runs and tests.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", os.environ.get("FETTLE_LOCAL_MEMORY", "8g"))
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
