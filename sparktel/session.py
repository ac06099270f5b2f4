"""Making the package importable on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent


#: Bytes of an Arrow batch between the JVM and Python, unless the session says otherwise: both hold several at once.
ARROW_BYTES = 8 << 20
#: The same for chains of operators, whose workers and buffers live side by side in an executor.
CHAIN_ARROW_BYTES = 2 << 20
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession, chain: bool = False) -> None:
    """Send this package to the executors, once a context, unless PYTHONPATH already names its place; bound Arrow batches.

    chain: to the smaller bound, which the session then keeps, as its last stage may run later.
    """
    sc, now = spark.sparkContext, spark.conf.get(_BATCH, None)
    if chain and now in (_DEFAULT, str(ARROW_BYTES)):
        spark.conf.set(_BATCH, str(CHAIN_ARROW_BYTES))
    elif now == _DEFAULT:
        spark.conf.set(_BATCH, str(ARROW_BYTES))
    if getattr(sc, "_sparktel_shipped", False) or str(_ROOT.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = Path(tempfile.mkdtemp(prefix="sparktel-")) / "sparktel.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(_ROOT.rglob("*.py")):
            z.write(f, f.relative_to(_ROOT.parent))
    sc.addPyFile(str(path))
    sc._sparktel_shipped = True
