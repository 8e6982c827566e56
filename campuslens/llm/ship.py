"""Giving the executors this package, and their Python workers batches of bounded size."""

from __future__ import annotations

import os
import tempfile
import zipfile

import campuslens

_SHIPPED: set = set()
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark) -> None:
    """Send the package's modules to the executors, once an application.

    Texts are long: a batch for a Python worker is bounded by bytes (4 MB,
    unless the session says less), not only by its 10,000 rows.

    Spark's own file server distributes the archive; nothing is read from a
    folder of the driver.
    """
    set_ = spark.conf.get(BATCH_BYTES, str((1 << 31) - 1))
    if not set_.rstrip("b").isdigit() or int(set_.rstrip("b")) > 4 << 20:
        spark.conf.set(BATCH_BYTES, str(4 << 20))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(campuslens.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="campuslens-"), "campuslens_modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("campuslens", os.path.relpath(full, top)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
