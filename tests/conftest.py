import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumefeed import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    found = session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.log.level": "ERROR",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield found
    found.stop()


@pytest.fixture(scope="session")
def toy_vocab(spark):
    tokens = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
    tokens += ["##berg", "##e", "snow", "moon", "over", "the", "old", "1990", "##s"]
    return spark.createDataFrame(list(enumerate(tokens)), "token_id int, token string")
