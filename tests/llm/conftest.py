import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

from llm.workers import importable


@pytest.fixture(autouse=True)
def repository_on_workers(spark):
    importable(spark)
