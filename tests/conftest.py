import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tokenizer():
    from sftprep.plans.catalog import TOKENIZER

    return TOKENIZER


EXAMPLE = (
    "row_idx bigint, prompt string, query string, response string, "
    "history array<struct<q:string,r:string>>, system string"
)


@pytest.fixture
def example(spark):
    """Examples from (turns, system) pairs."""

    def make(*conversations):
        rows = [(i, t[-1][0], "", t[-1][1], list(t[:-1]), s) for i, (t, s) in enumerate(conversations)]
        return spark.createDataFrame(rows, EXAMPLE)

    return make


@pytest.fixture
def turn_table(spark):
    """A turn-per-row table from {conv_id: [(role, text), ...]}."""

    def make(conversations):
        rows = [(c, i, r, t) for c, ms in conversations.items() for i, (r, t) in enumerate(ms)]
        return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")

    return make
