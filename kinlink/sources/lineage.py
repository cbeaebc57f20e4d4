"""Tables that several later steps read are computed once."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def once(df: DataFrame) -> DataFrame:
    """df from a reliable checkpoint in the shared folder that the session names in spark.checkpoint.dir.

    Without one only a local master gets a folder of its own: elsewhere executors would not share it, and this raises.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return df.checkpoint(eager=True)
