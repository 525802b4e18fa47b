"""A UDF that fails while a marker file is absent, then creates it: the
first attempt of a task that sees ``fail_on`` dies, later attempts pass."""

import os

from pyspark.sql import functions as F


def failing_once(marker: str, fail_on: int):
    @F.udf("int")
    def passthrough(x):
        if x == fail_on and not os.path.exists(marker):
            with open(marker, "w") as f:
                f.write("failed once\n")
            raise RuntimeError("injected task failure")
        return x

    return passthrough
