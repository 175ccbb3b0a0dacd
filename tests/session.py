"""One local session for all tests."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from editsieve.session import get_session  # noqa: E402


def local_session():
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    spark = get_session(
        "editsieve-tests",
        spark__master="local[8]",
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__session__timeZone="UTC",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
