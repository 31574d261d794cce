"""What the tasks of a barrier stage tell each other, through files of the folder they share.

``BarrierTaskContext.allGather`` looks for an answer once a second. A file is there as soon as it is
written, so thousands of small rounds pass in seconds. A task takes back its message of a round
as soon as it has those of the next one: all others have read it by then.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable

from pyspark import BarrierTaskContext
from pyspark.sql import SparkSession

from clientela.functions.storage import scratch_path

#: What all tasks have to say, by task.
Exchange = Callable[[bytes], list[bytes]]
#: Seconds between two looks for a message: the first, and the most.
LOOK, REST = 0.0005, 0.02


def slots(spark: SparkSession) -> int:
    """The tasks that a barrier stage can have: all of them run at once, on executors that stay."""
    if (spark.conf.get("spark.dynamicAllocation.enabled", None) or "false").lower() == "true":
        return 1
    context = spark.sparkContext._jsc.sc()
    most = context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())
    return max(1, min(spark.sparkContext.defaultParallelism, most))


def message_folder(spark: SparkSession) -> str | None:
    """A folder for messages in the shared one, or None if that is no path of the machines."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "messages"))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = files.makeQualified(path).toUri()
    return full.getPath() if full.getScheme() == "file" else None


def _look(path: str) -> bytes:
    wait = LOOK
    while True:
        try:
            with open(path, "rb") as file:
                return file.read()
        except FileNotFoundError:
            time.sleep(wait)
            wait = min(2 * wait, REST)


def among(folder: str, context: BarrierTaskContext) -> Exchange:
    """Exchange by files. A restarted stage has a folder of its own."""
    at = f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}"
    os.makedirs(at, exist_ok=True)
    own, tasks = context.partitionId(), len(context.getTaskInfos())
    sent = 0

    def exchange(message: bytes) -> list[bytes]:
        nonlocal sent
        with open(f"{at}/new-{own}", "wb") as file:
            file.write(message)
        os.rename(f"{at}/new-{own}", f"{at}/{sent}-{own}")
        told = [message if t == own else _look(f"{at}/{sent}-{t}") for t in range(tasks)]
        if sent:
            os.remove(f"{at}/{sent - 1}-{own}")
        sent += 1
        return told

    return exchange
