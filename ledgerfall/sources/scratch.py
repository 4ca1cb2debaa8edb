"""A new folder for tables that only live as long as the work they are for."""

import re
import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession) -> str:
    """A folder nobody else uses, under the shared one the session names; always with a scheme.

    Only a session whose driver and executors are one process may name none: it gets
    a local one.  Nothing removes these folders while a session may still read them;
    whoever runs the cluster expires the shared folder, as for checkpoints.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the executors of {master} share")
        shared = tempfile.gettempdir()
    base = shared.rstrip("/")
    if not re.match(r"[A-Za-z][\w+.-]*:/", base):
        base = Path(base).absolute().as_uri()
    return f"{base}/ledgerfall-{uuid4().hex}"
