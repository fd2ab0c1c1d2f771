"""Session helper and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Spark hands generated methods above this many bytes to the compiler, which leaves them interpreted.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def settle(spark: SparkSession) -> SparkSession:
    """The method limit of ``build_session``, in a session made elsewhere that names none of its own."""
    if spark.conf.get(METHOD_LIMIT[0], None) is None:
        spark.conf.set(*METHOD_LIMIT)
    return spark


def build_session(app: str = "cantus", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; anything else is left to the cluster.

    Shuffle partitions are not pinned here: adaptive execution coalesces them, and a cluster
    sets its own starting number (a multiple of its cores).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # the JVM does not compile methods above 8000 bytes of bytecode; past that, plain (split)
        # projections are about twice as fast as one huge fused method
        METHOD_LIMIT[0]: METHOD_LIMIT[1],
        # call-site capture on every column call makes building large plans several times slower
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback: str | None = None


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a single-machine session (master ``local``) that names none gets a temporary folder; on a
    cluster executors would each write to their own disk, so there the setting is required.
    """
    global _fallback
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[[^,]*(,\s*\d+)?\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _fallback = _fallback or tempfile.mkdtemp(prefix="cantus-")
        base = _fallback
    return f"{base.rstrip('/')}/cantus/{purpose}-{uuid.uuid4().hex[:12]}"
