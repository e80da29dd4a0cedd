"""The folder where jobs may put files that all executors can reach."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared one, named in the session.

    Only a local session may do without the setting; there the machine's own
    temporary folder is shared by all threads, and what is in it goes when Python
    ends. What is under the shared folder is left to its owner to clear.
    """
    shared = spark.conf.get(SETTING, None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        folder = tempfile.mkdtemp(prefix=f"umbu-{purpose}-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
